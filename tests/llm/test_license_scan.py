"""License scan against brute force over the same windows without MinHash, and odd rows."""
import random
import re

from cdmspark.llm import license_scan as S


def words(text):
    return re.findall(r"[^\s!-/:-@\[-`{-~]+", (text or "").lower(), re.A)


def sets(ws, width):
    return [tuple(ws[i:i + width]) for i in range(len(ws) - width + 1)]


def brute(text):
    found = []
    for name, notice in sorted(S.TEMPLATES.items()):
        ws = words(notice)
        width = min(5, len(ws))
        mine, all_ = set(sets(ws, width)), sets(words(text), width)
        step = 1 << (len(mine) - 1).bit_length()
        best = max((len(mine & set(all_[k:k + 2 * step])) for k in range(0, max(1, len(all_)), step)), default=0)
        if best >= S.CONTAINMENT * len(mine):
            found.append(name)
    return ",".join(found)


def planted():
    rng = random.Random(4)
    filler = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, "All rights reserved"), (3, "all RIGHTS, reserved!"), (4, "All rights\nreserved")]
    for name, notice in S.TEMPLATES.items():
        for k in range(6):
            ws = notice.split()
            for _ in range(k // 2):
                ws[rng.randrange(len(ws))] = "changed"
            before, after = (" ".join(rng.choices(filler, k=rng.randrange(0, 200))) for _ in range(2))
            rows.append((len(rows), f"{before}\n{' '.join(ws)} {after}"))
        rows.append((len(rows), notice[: len(notice) // 2]))
    rows.append((len(rows), "\n".join(S.TEMPLATES.values())))
    return rows


def test_equals_brute_force(spark):
    rows = planted()
    got = {r.doc_id: r for r in S.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i: brute(t) for i, t in rows}
    assert {i: r.licenses for i, r in got.items()} == want
    assert len({n for v in want.values() for n in v.split(",")} - {""}) == len(S.TEMPLATES)
    for i, t in rows:
        assert got[i].n_words == len(words(t)) and got[i].n_licenses == len(want[i].split(",")) * bool(want[i])


def anywhere(text):
    """Names of templates of which a window of their size holds enough, at whatever shingle it starts."""
    found = []
    for name, notice in sorted(S.TEMPLATES.items()):
        ws = words(notice)
        width = min(5, len(ws))
        mine, all_ = set(sets(ws, width)), sets(words(text), width)
        size = 2 << (len(mine) - 1).bit_length()
        if max((len(mine & set(all_[k:k + size])) for k in range(max(1, len(all_)))), default=0) >= S.CONTAINMENT * len(mine):
            found.append(name)
    return ",".join(found)


def test_inserted_words_at_every_start(spark):
    rng = random.Random(7)
    bsd = S.TEMPLATES["bsd-disclaimer"].replace("COPYRIGHT HOLDERS", "UNIVERSITY OF ILLINOIS AT URBANA CHAMPAIGN")
    mit = S.TEMPLATES["mit-permission"].split()
    texts = [bsd, " ".join(mit[:30] + [f"in{i}" for i in range(25)] + mit[30:])]
    for name in ("isc", "bsd-disclaimer", "mit-permission", "gpl-header"):
        ws, at = S.TEMPLATES[name].split(), rng.randrange(10, 20)
        texts.append(" ".join(ws[:at] + ["in"] * rng.randrange(1, 20) + ws[at:]))
    rows = [(1000 * t + k, " ".join(f"w{i}" for i in range(k)) + f" {x} after it") for t, x in enumerate(texts) for k in range(0, 128, 1 + t // 2)]
    rows += [(9000, f"{bsd} {texts[1]} x {texts[0]} {texts[4]}"), (9001, " ".join(mit[:45] * 3)), (9002, " ".join(["again", *mit[5:], *mit[:9]] * 3))]
    got = {r.doc_id: r.licenses for r in S.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: anywhere(t) for i, t in rows}
    assert all("bsd-disclaimer" in got[k] for k in range(128)) and all("mit-permission" in got[1000 + k] for k in range(128))


def test_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.licenses for r in S.license_scan(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()} and any(got.values())


def test_no_python_in_the_plan(docs):
    plan = S.license_scan(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_odd_rows(odd, nothing, docs, corpus):
    assert S.license_scan(odd).filter("n_licenses = 0 and best = 0").count() == odd.count()
    assert S.license_scan(nothing).count() == 0
    assert S.license_scan(docs).count() == len(corpus)
