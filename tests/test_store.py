"""The store: which files an upsert writes, what readers hold, what is deleted, and what a predicate reads."""

import hashlib
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from thicket import fixture, queries
from thicket.functions import scalars as fn
from thicket.operators import select
from thicket.sources import files
from thicket.sources.store import Store
from thicket.sources.tables import normalize

DATA = "/root/testdata/sf0.001"
OCC = "gbifID long, species string, taxonKey long, lat double, lon double, year int, month int, countryCode string, eventDate string, lastInterpreted string"


def rows(spark, ids, species="a", day="2020-01-02"):
    return spark.createDataFrame([(i, species, 5, 1.0, 2.0, 2020, 1, "DE", "2020-01-01", day) for i in ids], OCC)


def names(store):
    return {b: set(own) for b, own in store.manifest()["files"].items()}


def on_disk(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(f"{path}/data") for f in fs if f.endswith(".parquet")}


def newest():
    return [F.col("lastInterpreted").desc()]


def test_one_key_leaves_other_buckets_in_place(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=8)
    assert store.read() is None and store.apply(rows(spark, range(200)), order=newest()) == 200
    before = names(store)
    assert set(before) == set(map(str, range(8)))
    stamps = {f: os.stat(tmp_path / f).st_mtime_ns for own in before.values() for f in own}
    assert store.apply(rows(spark, [7], "new", "2021-01-01"), order=newest()) == 1
    after = names(store)
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) == 1 and all(os.stat(tmp_path / f).st_mtime_ns == stamps[f] for b in before if b not in changed for f in after[b])
    got = {r["gbifID"]: r["species"] for r in store.read().collect()}
    assert len(got) == 200 and got.pop(7) == "new" and set(got.values()) == {"a"}


def test_a_bucket_is_written_in_pieces(spark, tmp_path):
    """a task holds a piece of a bucket; there are as many as Spark's shuffles have tasks, whatever the buckets."""
    store, name = Store(spark, str(tmp_path), buckets=2), "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "8")
    try:
        for day in (1, 2):
            store.apply(rows(spark, range(0, 800, day), f"d{day}", f"2021-01-0{day}"), order=newest())
            files_of = [f for own in names(store).values() for f in own]
            many = [spark.read.parquet(f"{tmp_path}/{f}").count() for f in files_of]
            assert len(many) == 8 * day and max(many) < 2 * min(many)
    finally:
        spark.conf.set(name, before)
    got = {r["gbifID"]: r["species"] for r in store.read().collect()}
    assert got == {i: "d1" if i % 2 else "d2" for i in range(800)} and store.read().count() == 800


def test_a_batch_is_written_once_and_old_rows_apart(spark, tmp_path):
    """the files that the ranked batch is written to stay as they are; only what it leaves of old rows is written beside them."""
    store = Store(spark, str(tmp_path), buckets=3)
    store.apply(rows(spark, range(60)), order=newest())
    store.apply(rows(spark, range(30, 90), "b", "2021-01-01"), order=newest())
    held = [{r["species"] for r in spark.read.parquet(f"{tmp_path}/{f}").collect()} for own in names(store).values() for f in own]
    assert all(len(x) == 1 for x in held) and not (tmp_path / "data/v=1/layer").exists()
    got = {r["gbifID"]: r["species"] for r in store.read().collect()}
    assert got == {i: "a" if i < 30 else "b" for i in range(90)} and store.read().count() == 90


def test_upserts_equal_a_dictionary(spark, tmp_path):
    r, store, want = random.Random(1), Store(spark, str(tmp_path), buckets=5, keep=2), {}
    for day in range(6):
        batch = [(r.randrange(60), f"s{r.randrange(9)}", f"2020-01-{day + 1:02d}-{k:03d}") for k in range(40)]
        df = spark.createDataFrame([(i, s, None, 1.0, 2.0, 2020, 1, "DE", None, w) for i, s, w in batch], OCC).repartition(3)
        for _ in range(2):  # redelivery changes nothing
            assert store.apply(df, order=newest()) == 40
        want |= {i: (s, w) for i, s, w in batch}
        assert {x["gbifID"]: (x["species"], x["lastInterpreted"]) for x in store.read().collect()} == want


def test_layers_are_written_alone_and_folded(spark, tmp_path):
    r, store, want = random.Random(2), Store(spark, str(tmp_path), buckets=4, keep=3, layers=2), {}
    held, count = {}, []
    for day in range(8):
        batch = {r.randrange(80): f"d{day}" for _ in range(60 if day == 0 else 9)}
        before = names(store)
        store.apply(rows(spark, batch).drop("species").join(spark.createDataFrame(list(batch.items()), "gbifID long, species string"), "gbifID"), order=newest())
        want |= batch
        held[day] = dict(want)
        count.append(len(store.manifest()["layers"]))
        if count[-1]:  # the batch is all that was written
            assert names(store) == before and all(f"/v={day}/" not in f for own in before.values() for f in own)
        for v in store.versions():
            assert {x["gbifID"]: x["species"] for x in store.read(v).collect()} == held[v]
    assert count == [0, 1, 2, 0, 1, 2, 0, 1]
    assert on_disk(tmp_path) == {f for v in store.versions() for m in [store.manifest(v)] for own in [*m["files"].values(), *m["layers"]] for f in own}
    assert store.read().filter("lastInterpreted >= '2000'").count() == len(want) and store.read().columns == store.read(5).columns


def test_what_a_failed_fold_left_is_not_read(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=2)
    store.apply(rows(spark, range(30)), order=newest())
    real, store.note = store.note, None  # the run ends after its files are written
    with pytest.raises(TypeError):
        store.apply(rows(spark, range(5), "lost", "2021-01-01"), order=newest())
    store.note = real
    store.apply(rows(spark, range(9, 12), "kept", "2021-01-01"), order=newest())
    got = [x["species"] for x in store.read().collect()]
    assert len(got) == 30 and got.count("kept") == 3 and "lost" not in got


def test_a_snapshot_that_is_held_stays_and_others_go(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=4, keep=2)
    store.apply(rows(spark, range(50)), order=newest())
    with store.hold() as held:
        for day in range(1, 6):
            store.apply(rows(spark, range(0, 50, 2), f"d{day}", f"2021-01-{day:02d}"), order=newest())
        assert store.versions() == [0, 4, 5]
        assert {r["species"] for r in held.collect()} == {"a"} and held.count() == 50
        with pytest.raises(ValueError):
            store.read(2)
    assert store.expire() == [0] and store.versions() == [4, 5]
    assert on_disk(tmp_path) == {f for v in (4, 5) for own in store.manifest(v)["files"].values() for f in own}
    assert store.read(4).filter("species = 'd4'").count() == 25 and not os.path.exists(tmp_path / "staged/5")


def test_disk_stays_flat_over_ten_deltas(spark, tmp_path):
    store, sizes = Store(spark, str(tmp_path), buckets=4, keep=2), []
    for day in range(11):
        store.apply(rows(spark, range(400), f"d{day}", f"2021-01-{day + 1:02d}"), order=newest())
        sizes.append(sum(os.stat(tmp_path / f).st_size for f in on_disk(tmp_path)))
    assert max(sizes[2:]) < 1.1 * sizes[1] and store.read().count() == 400


def test_holds_of_dead_readers_end(spark, tmp_path):
    store = Store(spark, str(tmp_path), keep=1)
    store.apply(rows(spark, [1]), order=newest())
    with store.hold(0):
        for name, _ in store._list("holds"):
            os.utime(tmp_path / "holds" / name, (1, 1))
        store.apply(rows(spark, [2]), order=newest())
        assert store.versions() == [1] and not store._list("holds")
    with pytest.raises(ValueError), store.hold(0):
        pass


def test_empty_batches_and_new_columns(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.apply(rows(spark, [1]).limit(0), order=newest()) == 0 and store.read().count() == 0
    store.apply(rows(spark, range(20)), order=newest())
    store.apply(rows(spark, [3]).limit(0), order=newest(), since="x")
    assert store.state()["since"] == "x" and store.read().count() == 20
    store.apply(rows(spark, [3]).withColumn("extra", F.lit(9)), order=newest())
    assert {r["gbifID"]: r["extra"] for r in store.read().collect() if r["extra"]} == {3: 9}
    assert store.read(1).columns == rows(spark, [1]).columns


def test_a_failed_apply_is_run_again(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.apply(rows(spark, range(9)), order=newest())
    before = names(store)

    def fail(df):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        store.apply(rows(spark, [1], "b", "2021-01-01"), order=newest(), check=fail)
    assert names(store) == before and store.state()["version"] == 0
    store.apply(rows(spark, [1], "b", "2021-01-01"), order=newest())
    assert store.read().filter("species = 'b'").count() == 1 and store.read().count() == 9


def scanned(df):
    """What the scan of a collected plan says: its description, and the rows that it gave."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaf = plan.collectLeaves().apply(0)
    return leaf.verboseStringWithOperatorId(), leaf.metrics().apply("numOutputRows").value()


def test_predicate_is_pushed_down_and_skips_row_groups(spark, tmp_path):
    days = [f"{2000 + i // 360}-{1 + i // 30 % 12:02d}-{1 + i % 30:02d}" for i in range(7200)]
    df = spark.createDataFrame([(i, f"s{i % 7}", i % 5, 1.0, 2.0, int(d[:4]), 1, "DE", d, d) for i, d in enumerate(days)], OCC)
    store = Store(spark, str(tmp_path), buckets=2, options={"parquet.block.size": "8192", "parquet.block.size.row.check.min": "50", "parquet.page.size.row.check.min": "50", "parquet.page.row.count.limit": "200"})
    store.apply(df.repartition(5), order=newest())
    tree = select.delta_tree("2019-06-01", country="DE", years=(2000, None))
    found = select.delta_rows(normalize(store.read(), "sparse"), tree).select("gbifID")
    assert len(found.collect()) == sum(d >= "2019-06-01" for d in days)
    told, read = scanned(found)
    assert "GreaterThanOrEqual(lastInterpreted,2019-06-01)" in told and "EqualTo(countryCode,DE)" in told and "IsNotNull(lat)" in told
    assert read < 0.2 * len(days), read
    keyed = select.delta_rows(normalize(store.read(), "sparse"), select.delta_tree("2019-06-01", keys=[1, 2])).select("gbifID")
    assert len(keyed.collect()) == sum(d >= "2019-06-01" and i % 5 in (1, 2) for i, d in enumerate(days)) and "In(taxonKey, [1,2])" in scanned(keyed)[0]


def test_default_order_is_that_of_files_and_splits(spark, tmp_path):
    header = "\t".join(files.DELTA_COLUMNS)
    for k in range(3):
        body = "\n".join(f"{i % 500}\tn{k}-{i:06d}\t5\t1.0\t2.0\t2020\t1\tDE\t\t2020-01-01" for i in range(20000))
        (tmp_path / f"part-{k}.txt").write_text(f"{header}\n{body}\n")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(1 << 17))
    try:
        batch = files.read_delta(spark, str(tmp_path))
        assert batch.rdd.getNumPartitions() > 12
        store = Store(spark, str(tmp_path / "store"))
        store.apply(batch)
    finally:
        spark.conf.set(name, before)
    assert {r["gbifID"]: r["scientificName"] for r in store.read().collect()} == {i: f"n2-{19500 + i:06d}" for i in range(500)}


def test_ordered_files_grow_in_number(spark):
    """rows in source order are written by as many tasks as Spark's shuffles have, and splits follow the files' size."""
    name, splits = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name), spark.conf.get(splits)
    spark.conf.set(name, "9")
    try:
        path = queries._ordered_tsv(spark, DATA, fixture.raw(spark, DATA))
    finally:
        spark.conf.set(name, before[0])
    n, size = files.folder_size(spark, path)
    assert n == 9
    largest = max(spark.read.csv(path, sep="\t", header=True).groupBy(F.input_file_name()).count().collect(), key=lambda r: r["count"])["count"]
    assert largest < spark.read.parquet(f"{DATA}/lineitem.parquet").count() / 4
    ids = [int(r["gbifID"]) for r in files.read_archive(spark, path, keep_raw=False).orderBy(*files.POSITION).collect()]
    want = fixture.raw(spark, DATA).orderBy("l_shipdate", "l_partkey", "l_suppkey", "gbifID").select("gbifID").collect()
    assert ids == [r["gbifID"] for r in want]
    seen = []
    queries._small_splits(spark, path, lambda: seen.append(int(spark.conf.get(splits))))
    assert seen == [max(1 << 18, size // 36)] and spark.conf.get(splits) == before[1]


def test_the_stream_makes_its_rows_once(spark, tmp_path, monkeypatch):
    """both batches of stream_delta come from one making of the occurrences; the input may be gone by then."""
    data, stream = str(tmp_path / "sf"), queries.stream_deltas
    shutil.copytree(DATA, data)
    want = queries.stream_delta(spark, data).count()

    def without_input(*args):
        if os.path.exists(data):
            os.rename(data, data + "-gone")
        return stream(*args)

    monkeypatch.setattr(queries, "stream_deltas", without_input)
    assert queries.stream_delta(spark, data).count() == want > 0


def test_scratch_folders_are_swept(spark, tmp_path):
    old, new = files.scratch(spark), files.scratch(spark)
    for path in (old, new):
        spark.range(3).write.parquet(path)
    for d, _, fs in os.walk(old):
        for f in [d, *(os.path.join(d, f) for f in fs)]:
            os.utime(f, (1_000_000_000, 1_000_000_000))
    gone = files.sweep_scratch(spark, hours=24 * 365 * 5)
    assert os.path.basename(old) in gone and not os.path.exists(old) and spark.read.parquet(new).count() == 3


def test_blake2b_hash_on_fixed_values(spark):
    parts = [("a", 1), ("", None), (None, None), ("ä\x1f", -7), ("x" * 500, 2**40)]
    got = [r[0] for r in spark.createDataFrame(parts, "s string, n long").coalesce(1).select(fn.stable_u32(F.col("s"), F.col("n"))).collect()]
    texts = ["\x1f".join("" if p is None else str(p) for p in row) for row in parts]
    assert got == [int.from_bytes(hashlib.blake2b(t.encode(), digest_size=4).digest(), "big") for t in texts]
    assert got[0] == 92031305 and got[2] == 1570991642  # fixed values
    assert all(0 <= x < 2**32 for x in got)
