"""Random keyword combinations: the Column rule maps equal a plain-Python walk of the same
ordered rule tables (first hit wins; nested misses give NULL for admission, 0 for discharge)."""
import random

from cdmspark.functions import rules as R


def _walk(text, rules, miss, nested_miss):
    for kw, rule in rules:
        if kw in text:
            if not isinstance(rule, list):
                return rule
            for inner, cid in rule:
                if inner == "" or inner in text:
                    return cid
            return nested_miss
    return miss


def spec(name, v):
    if v is None or v == "":
        return 0
    t = v.strip().lower()
    if name == "map_admit":
        return _walk(t, R.ADMIT_RULES, None, None)
    if name == "map_discharge":
        if any(k in t for k in R.DISCHARGE_FACILITY_KEYWORDS):
            return R.DISCHARGE_FACILITY_ID
        return _walk(t, R.DISCHARGE_RULES, 0, 0)
    if name == "map_visit_type":
        return next((cid for kw, cid in R.VISIT_TYPE_RULES if kw in t), 0)
    raise ValueError(name)


def _words():
    ws = {kw for kw, _ in R.ADMIT_RULES} | {kw for kw, _ in R.DISCHARGE_RULES} | {kw for kw, _ in R.VISIT_TYPE_RULES}
    ws |= {i for _, r in R.ADMIT_RULES + R.DISCHARGE_RULES if isinstance(r, list) for i, _ in r if i}
    ws |= set(R.DISCHARGE_FACILITY_KEYWORDS[::7]) | {"zz", "visit", "to", "from"}
    return sorted(ws)


def test_rule_maps_match_the_ordered_walk(spark):
    rnd = random.Random(11)
    words = _words()
    vals = [None, "", "  "]
    for _ in range(400):
        parts = rnd.sample(words, rnd.randint(1, 3))
        s = " ".join(p.upper() if rnd.random() < 0.3 else p for p in parts)
        vals.append(("\t " if rnd.random() < 0.2 else "") + s + (" \n" if rnd.random() < 0.2 else ""))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    for name in ("map_admit", "map_discharge", "map_visit_type"):
        got = {r.i: r.c for r in df.select("i", R.REGISTRY[name]("v").alias("c")).collect()}
        bad = [(v, got[i], spec(name, v)) for i, v in enumerate(vals) if got[i] != spec(name, v)]
        assert not bad, (name, bad[:5])
