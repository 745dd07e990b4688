"""The stages of the corpus pipeline against plain versions, on the smallest tables."""

import random

import corpus_pipeline as cp
from tests.llm.test_jaccard import brute
from thicket.llm import mixing, pii

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        if i < len(cp.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append([r.asDict() for r in docs.collect()])
    good, single, hidden, mixed, packed = kept
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in good}
    assert sum((k in ids) == bool(q) for k, q in labels.items()) >= 0.95 * len(labels)
    assert sorted(r["doc_id"] for r in single) == [k for k, _, c in brute([(r["doc_id"], r["text"]) for r in good], 5, 4, 5) if k == c]
    names = pii.Pseudonyms(cp.DEMO_KEY)
    assert {r["doc_id"]: r["text"] for r in hidden} == {r["doc_id"]: pii.replace_all(r["text"], names)[0] for r in single}
    assert all(r["n_chars"] == len(r["text"]) for r in hidden)
    size = lambda r: len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", r["text"]) if w])
    whole = {}
    for r in sorted(hidden, key=lambda r: r["source"]):
        whole[r["source"]] = whole.get(r["source"], 0) + size(r)
    for s, target in mixing.targets(whole).items():
        sums = {0}  # of all choices of up to two copies of each document
        for n in (size(r) for r in hidden if r["source"] == s):
            sums |= {x + k * n for x in sums for k in (1, 2)}
        best = min(abs(x - round(target)) for x in sums)
        assert abs(sum(size(r) for r in mixed if r["source"] == s) - target) <= best + 0.5
    times = {}
    for r in mixed:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times.values()) <= 2 and set(times) <= {r["doc_id"] for r in hidden}
    assert sorted(r["doc_id"] for r in packed if r["piece"] == 0) == sorted(r["doc_id"] for r in mixed)


def test_near_copies_go_by_row(spark):
    """Rows that share a key are documents of their own; copies go whether or not they have a key."""
    text = lambda w: " ".join(f"{w}{i}" for i in range(40))
    rows = [(1, text("a")), (1, text("b")), (1, text("c")), (2, text("a")), (3, text("d")), (None, text("d")), (None, text("e")), (None, text("e") + " x"), (None, text("f")), (None, ""), (4, None), (5, text("g")), (5, text("g"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in cp.drop_near_copies(spark, docs, SF).collect()]
    least = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    e = [r for r in got if (r[1] or "").startswith("e0 ")]
    assert len(e) == 1 and e[0] in rows
    want = [(1, text("a")), (1, text("b")), (1, text("c")), (3, text("d")), (None, text("f")), (None, ""), (4, None), (5, text("g"))]
    assert sorted((r for r in got if r not in e), key=least) == sorted(want, key=least)


CLASHES = ["_score", "score", "_row", "__row", "_order", "_pii", "pii", "_copies", "copies", "_key", "_salt", "component_id", "note"]


def test_stages_keep_any_columns(spark):
    """Nulls in every column, empty and long texts, repeated rows and columns named like the stages' own."""
    text = lambda w, n=40: " ".join(f"{w}{i}" for i in range(n))
    rows = [(1, text("a"), "en", "s", 5), (2, text("b"), None, None, None), (None, text("c", 5000), "en", "s", 9), (3, None, "en", None, 0), (4, "", None, "s", 0), (5, text("d") + " mail a.b@example.com", "en", "t", 1)]
    rows += [(6, text("e"), "en", "s", 1)] * 3 + [(None, None, None, None, None)] * 2
    docs = spark.createDataFrame([(*r, *range(len(CLASHES))) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} long" for c in CLASHES)).repartition(3)
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []
        got = stage(spark, docs, SF)
        found = got.collect()
        if name == "packing":
            assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found if r["piece"] == 0) == sorted((r[0] is None, r[0] or 0) for r in rows)
            continue
        assert got.columns == docs.columns and all(tuple(r)[5:] == tuple(range(len(CLASHES))) for r in found)
        if name == "near_copies":
            assert len(found) == len(rows) - 2
        if name == "pii":
            assert len(found) == len(rows) and not any("a.b@example.com" in (r["text"] or "") for r in found)
        if name == "mixing":
            assert all(r["text"] for r in found) and {r["source"] for r in found} == {"s", "t", None}
            assert got.orderBy(*docs.columns).collect() == stage(spark, docs.repartition(5), SF).orderBy(*docs.columns).collect()


def test_near_copies_keep_no_texts(spark, tmp_path):
    """Texts without near copies are not written beside their table; of repeated rows one stays, of those without words all."""
    text = lambda w: random.Random(w).randbytes(20_000).hex(" ", 4)
    rows = [(i, text(i)) for i in range(60)] + [(7, text(7))] * 30 + [(None, " ")] * 3 + [(None, text(999))] * 3
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "docs"))
    kept = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path / "kept"))
    try:
        got = cp.drop_near_copies(spark, spark.read.parquet(str(tmp_path / "docs")), SF).collect()
    finally:
        spark.sparkContext.setCheckpointDir(kept or str(tmp_path / "other"))
    assert sorted(map(tuple, got), key=str) == sorted([*{r for r in rows if r[1] != " "}, *[(None, " ")] * 3], key=str)
    assert sum(p.stat().st_size for p in (tmp_path / "kept").rglob("part-*")) < 60 * 45_000
