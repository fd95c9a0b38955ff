"""Rule maps from source text to concept ids (Column -> Column, all JVM-side).

Each function cleans its input the way the source rules do (strip white space, lower
case), treats NULL and the empty string as "no value" (concept 0), and then walks an
ordered list of tests; the first hit wins.  ``map_admit`` keeps the rule set's NULL
results: a nested test that misses, or no hit at all, gives NULL, not 0.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the source rule set for results to agree.
# ---------------------------------------------------------------------------

GENDER_MALE = ("male",)
GENDER_FEMALE = ("female", "f")
GENDER_IDS = {"male": 8507, "female": 8532}

RACE_RULES = [
    (8516, ("black or african american", "black", "african american")),
    (8657, ("american indian or alaska native", "american indian", "alaska native", "native american")),
    (8515, ("asian",)),
    (8557, ("native hawaiian or other pacific islander", "native hawaiian", "pacific islander")),
    (8527, ("white", "caucasian")),
]

ETHNICITY_RULES = [
    (38003563, ("hispanic or latino", "hispanic", "latino")),
    (38003564, ("not hispanic or latino", "not hispanic", "non-hispanic")),
]

VISIT_TYPE_RULES = [
    ("clinic", 38004247),
    ("emergency", 9203),
    ("inpatient", 9201),
    ("outpatient", 9202),
    ("phone", 722455),
    ("outreach", 38004202),
    ("research", 38004259),
    ("lab", 32036),
]

# Admission source: (keyword, result) where result is an id, or a nested list of
# (inner keyword, id) tried in order; a nested miss yields NULL.
ADMIT_RULES = [
    ("clinic", [("physician", 38004247)]),
    ("emergency", 9203),
    ("routine", 9201),
    ("self", 0),
    ("nurs", 8863),
    ("lab", 32036),
    ("born", [("out", 0), ("sick", 38004444), ("", 8650)]),
    ("hospice", 8546),
    ("law", 32761),
    ("correctional", 32761),
    ("ambulatory", [("surgery", 8883)]),
    ("acute", 38004279),
    ("info", [("not", 0)]),
    ("hospital", [("transfer", 38004515)]),
    ("outpatient", 9202),
    ("delivery", 8650),
    ("non", 0),
    ("transfer", [("hc", 38004515)]),
]

# Discharge destination: any facility keyword wins first with this id.
DISCHARGE_FACILITY_ID = 38004515
DISCHARGE_FACILITY_KEYWORDS = (
    "hospital", "iu health", "community", "st vincent", "st vincents", "eskenazi", "riley", "methodist",
    "baptist", "floyd", "bedford", "harsha", "ball", "neuro", "psych", "fayette", "eskenazi", "rehabilitation",
    "white", "norton", "columbus", "developmental", "children", "blackford", "hendricks", "midtown", "monroe",
    "especially kids", "elizabeth", "jay", "skilled nursing", "damar", "valle vista", "university", "nursing home",
    "jasper", "francis", "beech grove", "good samaritan", "morgan", "north", "deaconess", "sycamore", "wishard",
    "west", "rehab", "ltac", "arnett", "schneck", "clark", "terre haute", "frankfort", "extended care",
    "meridian", "va hospital", "tipton", "heart center", "acute care", "union", "witham", "river bend",
    "options", "wellstone", "wabash valley", "meadows", "saxony", "paoli", "bloomington", "meadows", "meadows",
    "lifesprings", "turning pt", "indiana heart", "indiana", "rahe", "clay county", "south", "central", "east",
)
# Then ordered rules; a nested miss falls through to 0.
DISCHARGE_RULES = [
    ("home", 0),
    ("lab", 32036),
    ("long", 38004277),
    ("nurs", 8863),
    ("born", [("out", 0), ("sick", 38004444), ("", 8650)]),
    ("hospice", 8546),
    ("law", 32761),
    ("correctional", 32761),
    ("ambulatory", [("surgery", 8883)]),
    ("acute", 38004279),
    ("info", [("not", 0)]),
    ("outpatient", 9202),
    ("delivery", 8650),
    ("non", 0),
    ("transfer", [("hc", 38004515)]),
]

# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's str.strip() removes (derived, not listed by hand).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3100)) if ch.isspace())


def strip_ws(c) -> Column:
    """Remove leading and trailing white space of any kind (not just blanks); a plain
    character-set trim, no regex."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def clean(c) -> Column:
    return F.lower(strip_ws(c))


def _blank(c) -> Column:
    c = _col(c)
    return c.isNull() | (c == F.lit(""))


def _lit_id(v) -> Column:
    return F.lit(v).cast("long")


def _nested(text: Column, rule, miss: Column) -> Column:
    if not isinstance(rule, list):
        return _lit_id(rule)
    out = None
    for kw, cid in rule:
        test = F.lit(True) if kw == "" else text.contains(kw)
        out = F.when(test, _lit_id(cid)) if out is None else out.when(test, _lit_id(cid))
    return out.otherwise(miss)


def _chain(text: Column, rules, miss: Column, nested_miss: Column) -> Column:
    out = None
    for kw, rule in rules:
        val = _nested(text, rule, nested_miss)
        out = F.when(text.contains(kw), val) if out is None else out.when(text.contains(kw), val)
    return out.otherwise(miss)


def map_gender(c) -> Column:
    t = clean(c)
    return (F.when(_blank(c), _lit_id(0))
            .when(t.isin(*GENDER_MALE), _lit_id(GENDER_IDS["male"]))
            .when(t.isin(*GENDER_FEMALE), _lit_id(GENDER_IDS["female"]))
            .otherwise(_lit_id(0)))


def _isin_chain(c, rules) -> Column:
    t = clean(c)
    out = F.when(_blank(c), _lit_id(0))
    for cid, values in rules:
        out = out.when(t.isin(*values), _lit_id(cid))
    return out.otherwise(_lit_id(0))


def map_race(c) -> Column:
    return _isin_chain(c, RACE_RULES)


def map_ethnicity(c) -> Column:
    return _isin_chain(c, ETHNICITY_RULES)


def map_visit_type(c) -> Column:
    t = clean(c)
    out = F.when(_blank(c), _lit_id(0))
    for kw, cid in VISIT_TYPE_RULES:
        out = out.when(t.contains(kw), _lit_id(cid))
    return out.otherwise(_lit_id(0))


def map_admit(c) -> Column:
    """Admission source; NULL where the rule set returns nothing."""
    t = clean(c)
    null = F.lit(None).cast("long")
    return F.when(_blank(c), _lit_id(0)).otherwise(_chain(t, ADMIT_RULES, null, null))


def map_discharge(c) -> Column:
    t = clean(c)
    # one regex scan for the whole keyword set instead of one substring test per keyword
    facility = t.rlike("|".join(re.escape(k) for k in dict.fromkeys(DISCHARGE_FACILITY_KEYWORDS)))
    zero = _lit_id(0)
    return (F.when(_blank(c), zero)
            .when(facility, _lit_id(DISCHARGE_FACILITY_ID))
            .otherwise(_chain(t, DISCHARGE_RULES, zero, zero)))


REGISTRY = {
    "map_gender": map_gender,
    "map_race": map_race,
    "map_ethnicity": map_ethnicity,
    "map_visit_type": map_visit_type,
    "map_admit": map_admit,
    "map_discharge": map_discharge,
}
