"""Samples and quotas against sequential models."""

import hashlib
import random

from pyspark.sql import functions as F

from thicket.functions import scalars as fn
from thicket.operators import aggregate, sampling, select
from thicket.plans import profiles

OCC = "gbifID long, sci string, taxonKey long, lat double, lon double, y int, m int"


def occurrences(seed, n, species=3, cells=6):
    r = random.Random(seed)
    return [(i, f"s{r.randrange(species)}", None, 50.0 + r.randrange(cells), 10.0, r.choice([None, 2020, 2021, 2022]), r.choice([None, 0, 1, 5, 12, 99])) for i in r.sample(range(10 * n), n)]


def greedy(rows, k, most):
    """Newest first; a row is kept while its cell has fewer than k and its species fewer than most."""
    newest = sorted(rows, key=lambda x: (-(x[5] if x[5] is not None else -1), -(x[6] if x[6] is not None else -1), x[0]))
    cells, kept = {}, {}
    for x in newest:
        if cells.get((x[1], x[3]), 0) < k and len(kept.setdefault(x[1], [])) < most:
            cells[x[1], x[3]] = cells.get((x[1], x[3]), 0) + 1
            kept[x[1]].append(x[0])
    return kept


def test_newest_per_cell_and_cap_equal_a_greedy_scan(spark):
    for seed, (k, most) in enumerate([(1, 100), (3, 10), (6, 7), (50, 20)]):
        rows = occurrences(seed, 300)
        for parts in (1, 7):
            got = {}
            for r in sampling.sparse_sample(spark.createDataFrame(rows, OCC).repartition(parts), 5, k, most).orderBy("sci", "rank").collect():
                got.setdefault(r["sci"], []).append(r["gbifID"])
            assert got == greedy(rows, k, most)


def loop(cells, target, least, most):
    """Quotas one step at a time in rounds over cells, heaviest first, until the target or until none can move."""
    w = {c: int((n**0.5) * 1e9) for c, n in cells.items()}
    total = sum(w.values())
    q = {}
    for c in cells:
        x = round(target * w[c] / total)
        q[c] = min(max(x, least) if x > 0 else x, most)
    order = sorted(cells, key=lambda c: (-w[c], c))
    step = -1 if sum(q.values()) > target else 1
    while sum(q.values()) != target:
        movable = [c for c in order if (q[c] > least if step < 0 else q[c] < most)]
        if not movable:
            break
        for c in movable:
            if sum(q.values()) == target:
                break
            q[c] += step
    return q


def test_quotas_equal_the_loop(spark):
    r, rows, want = random.Random(5), [], {}
    settings = [(40, 1, 5), (200, 1, 5), (7, 1, 30), (3, 2, 4)]
    for target, least, most in settings:
        rows, want = [], {}
        for s in range(40):
            cells = {f"c{i:03d}": r.choice([1, 2, 5, 30, 400, 9000]) for i in range(r.randint(1, 60))}
            want[f"s{s}"] = loop(cells, target, least, most)
            rows += [(f"s{s}", c, n) for c, n in cells.items()]
        df = sampling.cell_quotas(spark.createDataFrame(rows, "sci string, cell string, n long"), target, least, most)
        got = {}
        for x in sampling.balanced_quotas(df, target, least, most).collect():
            got.setdefault(x["sci"], {})[x["cell"]] = x["quota"]
        assert got == want


def test_half_even_quotas(spark):
    df = spark.createDataFrame([("a", c, 1) for c in "wxyz"], "sci string, cell string, n long")
    assert {x["q"] for x in sampling.cell_quotas(df, 2, 0, 9).collect()} == {0}
    assert {x["q"] for x in sampling.cell_quotas(df, 6, 0, 9).collect()} == {2}


def test_unreachable_targets(spark):
    df = sampling.cell_quotas(spark.createDataFrame([("a", "c", 50)], "sci string, cell string, n long"), 900, 1, 30)
    assert sampling.balanced_quotas(df, 900, 1, 30).first()["quota"] == 30
    rows = [(i, "a", None, -80 + i * 0.1, 10.0, 2020, 1) for i in range(1000)]
    assert sampling.stratified_sample(spark.createDataFrame(rows, OCC), 7, 900, 1, 30).count() == 900


def test_reservoir_keeps_quota_rows_and_repeats(spark):
    rows = occurrences(9, 400)
    a, b = (sorted(map(tuple, sampling.stratified_sample(spark.createDataFrame(rows, OCC).repartition(p), 5, 60, 1, 8).collect())) for p in (1, 13))
    assert a == b and len(a) == 3 * 6 * 8 if len(a) < 180 else a == b
    assert all(x[2] < 30 for x in a)


def test_top_species_counts_a_missing_name(spark):
    rows = [(i, None if i < 5 else "a" if i < 8 else "b", None, 1.0, 1.0, 2020, 1) for i in range(10)]
    assert [tuple(r) for r in select.top_species(spark.createDataFrame(rows, OCC), 2).collect()] == [("a", 3)]


def test_last_observation_differs_between_full_and_kept(spark):
    rows = [(1, "a", None, 1.0, 1.0, 2022, 99), (2, "a", None, 1.0, 1.0, 2022, 6), (3, "a", 7, 1.0, 1.0, None, 1)]
    df = spark.createDataFrame(rows, OCC)
    assert tuple(df.groupBy("sci").agg(aggregate.last_obs_full().alias("l")).first()["l"]) == (2022, 6)
    kept = aggregate.kept_aggregates(sampling.sparse_sample(df)).first()
    assert tuple(kept["last"]) == (2022, None) and [p["m"] for p in kept["points"]] == [None, 6, 1]


def slots(rows, quota):
    """One pass over a cell's rows by identifier; a full reservoir gives a place by hash."""
    kept = {}
    for nth, (identifier, sci, cell) in enumerate(sorted(rows, key=lambda x: x[0]), 1):
        text = "\x1f".join(map(str, (sci, cell, nth, identifier)))
        slot = nth - 1 if nth <= quota else int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % nth
        if slot < quota:
            kept[slot] = identifier
    return kept


def hot_rows():
    """Rows of which 90 % are in one cell, with identifiers in clumps."""
    r = random.Random(8)
    ids = r.sample(range(10**9, 10**9 + 3000), 1800) + r.sample(range(10**15), 600) + r.sample(range(-500, 0), 300)
    return [(i, "s", "hot" if k % 10 else f"c{k % 7}", 1.0, 2.0, 2020, 1) for k, i in enumerate(ids)]


def test_hot_cell_is_ranked_in_pieces(spark):
    rows, piece = hot_rows(), 60
    df = spark.createDataFrame(rows, "gbifID long, sci string, cell string, lat double, lon double, y int, m int").repartition(5)
    n = {}
    for x in rows:
        n[x[2]] = n.get(x[2], 0) + 1
    assert n["hot"] > 0.89 * len(rows)
    quotas = spark.createDataFrame([("s", c, 1, 8 if c == "hot" else 3) for c in n], "sci string, cell string, w long, quota long")
    got = {}
    for x in sampling.reservoir(df, quotas, piece).collect():
        got.setdefault(x["cell"], {})[x["slot"]] = x["gbifID"]
    assert got == {c: slots([(x[0], x[1], x[2]) for x in rows if x[2] == c], 8 if c == "hot" else 3) for c in n}
    # no group that is ranked together is larger than the piece
    cut, starts = sampling.cut_cells(df.join(sampling.cell_spans(df), ["sci", "cell"]), piece)
    groups = cut.groupBy("sci", "cell", "_cut").agg(F.count(F.lit(1)).alias("k"), F.min("gbifID").alias("least"), F.max("gbifID").alias("most")).filter("cell = 'hot'").orderBy("least").collect()
    assert len(groups) > 40 and max(g["k"] for g in groups) <= piece and max(len(g["_cut"]) for g in groups) > 1
    assert all(a["most"] < b["least"] and a["_cut"] < b["_cut"] for a, b in zip(groups, groups[1:]))
    before, told = 0, {tuple(r["_cut"]): r["_before"] for r in starts.collect()}
    for g in groups:
        assert told[tuple(g["_cut"])] == before
        before += g["k"]


def test_place_grows_with_the_identifier(spark):
    ids = [-(2**63), -5, -1, 0, 3, 4, 2**63 - 1]
    places = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i long").coalesce(1).select(fn.place_of(F.col("i"))).collect()]
    assert places == sorted(places) and places[-1] - places[0] < 2**63


def test_quotas_touch_cells_once(spark):
    df = sampling.cell_quotas(spark.createDataFrame([("a", "c", 50)], "sci string, cell string, n long"), 900, 1, 30)
    plan = sampling.balanced_quotas(df, 900, 1, 30)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "explode" not in plan


def test_dense_profile_equals_separate_aggregates(spark):
    rows = [(i, s, (i % 5 or None), lat, lon, y, m) for i, s, _, lat, lon, y, m in occurrences(21, 500)] + [(10**6, "s0", 3, 0.0, 0.0, None, None), (10**6 + 1, None, 3, 0.0, 0.0, 2020, 1)]
    df = spark.createDataFrame(rows, OCC).withColumns({"country": F.lit("DE"), "eventDate": F.lit("2020-01-01")}).repartition(4)
    c = profiles.Config(top_n=2, points=40, max_per_cell=9)
    got = {r["sci"]: r for r in profiles.dense(df, c).collect()}
    top = {r["sci"] for r in select.top_species(df, 2).collect()}
    whole = {r["sci"]: r for r in aggregate.full_aggregates(df).collect()}
    years = {r["sci"]: r["year_counts"] for r in aggregate.year_pairs(aggregate.year_counts(df)).collect()}
    points = {}
    for r in sampling.stratified_sample(df, c.precision, c.points, c.min_per_cell, c.max_per_cell).orderBy("rank").collect():
        points.setdefault(r["sci"], []).append((r["rank"], r["lat"], r["lon"], r["y"]))
    assert set(got) == top
    for s, r in got.items():
        assert (r["total"], r["month_counts_all"], r["bbox"], r["taxonKey"]) == tuple(whole[s][k] for k in ("total", "month_counts_all", "bbox", "taxonKey"))
        assert r["year_counts"] == years[s] and r["last_obs"]["year"] == whole[s]["last"]["y"]
        assert [tuple(p)[:4] for p in r["points"]] == points[s]


def test_dense_profile_reads_its_rows_twice(spark, tmp_path):
    """Counted by what the scans of the rows give, in all jobs that building and reading the profile run."""
    rows = [(i, s, t, lat, lon, y, m) for i, s, t, lat, lon, y, m in occurrences(22, 400)]
    spark.createDataFrame(rows, OCC).withColumns({"country": F.lit("DE"), "eventDate": F.lit("2020-01-01")}).write.parquet(str(tmp_path / "rows"))
    read = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        read.add(1)
        return True

    df = spark.read.parquet(str(tmp_path / "rows")).filter(seen.asNondeterministic()("gbifID"))
    assert len(profiles.dense(df, profiles.Config(top_n=50, points=60, max_per_cell=8)).collect()) == 3
    assert read.value == 2 * len(rows)
