"""Files, tables, the store and the daily update."""

import json

import pytest
from pyspark.sql import functions as F

from thicket.operators import select, stats, taxa
from thicket.plans import daily, profiles
from thicket.sources import files, tables
from thicket.sources.store import Store, upsert
from thicket.streaming.deltas import stream_deltas

HEADER = "\t".join(files.DELTA_COLUMNS)


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_archive_fallbacks_and_short_lines(spark, tmp_path):
    p = write(tmp_path / "a.txt", "gbifID\tid\tspecies\tcanonicalName\ttaxonID\tyear\tdecimalLatitude", "1\t9\tx\ty\t5\t2020\t1.5", "\t7\t\tz\t12.0\t 12 \tnan", "\t\tq\tq\t1\t1\t1", "3")
    got = files.read_archive(spark, p).orderBy("gbifID").collect()
    assert [(r["gbifID"], r["species"], r["taxonKey"], r["year"], r["lat"]) for r in got] == [("1", "x", 5, 2020, 1.5), ("3", None, None, None, None), ("7", "z", None, 12, None)]
    assert got[0]["raw_tsv"] == "1\t9\tx\ty\t5\t2020\t1.5" and got[1]["raw_tsv"] == "3" + "\t" * 6


def test_stray_quote(spark, tmp_path):
    p = write(tmp_path / "q.txt", "gbifID\tspecies", '1\t"open', "2\tb")
    assert [r["species"] for r in files.read_archive(spark, p).orderBy("gbifID").collect()] == ['"open', "b"]
    assert files.read_archive(spark, p, quoted=True).count() == 1


def test_archive_choice(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.archive_file(spark, str(tmp_path))
    write(tmp_path / "small.txt", "x")
    write(tmp_path / "large.TXT", "x" * 100)
    assert files.archive_file(spark, str(tmp_path)).endswith("large.TXT")
    write(tmp_path / "occurrence.txt", "x")
    assert files.archive_file(spark, str(tmp_path)).endswith("occurrence.txt")


def test_delta_columns_are_required(spark, tmp_path):
    with pytest.raises(ValueError, match="lastInterpreted"):
        files.read_delta(spark, write(tmp_path / "d.txt", HEADER.removesuffix("\tlastInterpreted"), "1"))


def test_limit_is_in_source_order(spark, tmp_path):
    p = write(tmp_path / "l.txt", "gbifID\tspecies", *[f"{i}\ts" for i in range(50)])
    rows = files.read_archive(spark, p, keep_raw=False)
    assert sorted(int(r["gbifID"]) for r in files.load_limit(rows, 7).collect()) == list(range(7)) and files.load_limit(rows, 0).count() == 50


def test_last_row_of_a_file_wins_whole(spark, tmp_path):
    p = write(tmp_path / "u.txt", "gbifID\tspecies\tyear", "1\ta\t2020", "2\tb\t2020", "1\tc\t")
    new = upsert(None, files.read_archive(spark, p, keep_raw=False))
    assert {(r["gbifID"], r["species"], r["year"]) for r in new.collect()} == {("1", "c", None), ("2", "b", 2020)}


def test_names(spark, tmp_path):
    p = write(tmp_path / "n.json", '{"b": "B", "a": "Ä", "b": "C"}')
    assert sorted(map(tuple, files.read_names(spark, p).collect())) == [(0, "b", "C"), (1, "a", "Ä")]
    assert files.read_names(spark, None).count() == 0
    for bad in ('["a"]', '{"a": 1}', "no json"):
        with pytest.raises(ValueError):
            files.read_names(spark, write(tmp_path / "bad.json", bad))


def test_images(spark, tmp_path):
    for text in ('{"plants": {"a": {"u": 1}}}', '{"a": {"u": 1}}'):
        assert [tuple(r) for r in files.read_images(spark, write(tmp_path / "i.json", text)).collect()] == [("a", '{"u":1}')]
    assert files.read_images(spark, str(tmp_path / "none.json")).count() == 0
    assert files.read_images(spark, write(tmp_path / "blank.json", " ")).count() == 0
    assert files.read_images(spark, write(tmp_path / "broken.json", "{")).count() == 0


def test_meta_upsert(spark):
    old = files.ingest_meta(None, spark, "one.txt", ["a"])
    new = files.ingest_meta(old.unionByName(spark.createDataFrame([("other", "kept")], old.schema)), spark, "two.txt", ["a", "b"])
    assert {tuple(r) for r in new.collect()} == {("occurrence_file", "two.txt"), ("columns", "a,b"), ("other", "kept")}


def test_table_and_columns_by_name(spark):
    assert tables.pick_table({"x": ["lat"], "occurrence": [], "occ": []}) == "occ"
    assert tables.pick_table({"x": ["lat", "lon"], "y": ["lat", "lon", "species", "year"]}) == "y"
    with pytest.raises(ValueError):
        tables.pick_table({"x": ["lat"]})
    with pytest.raises(ValueError):
        tables.normalize(spark.createDataFrame([(1,)], "species int"))
    with pytest.raises(ValueError):
        select.year_filter_for(["species"])
    assert select.year_filter_for(["eventDate"]) == "eventDate" and select.year_filter_for(["eventDate"], dense=False) is None
    both = spark.createDataFrame([("s", 1.0, 2.0, 3.0, 4.0, "2020-05-06")], "species string, decimalLatitude double, lat double, decimalLongitude double, lon double, eventDate string")
    assert [(r["lat"], r["lon"], r["y"], r["m"]) for o in ("dense", "sparse") for r in tables.normalize(both, o).collect()] == [(1.0, 3.0, 2020, 5), (2.0, 4.0, None, None)]
    both.createOrReplaceTempView("occ")
    assert tables.pick_table(tables.catalog_tables(spark)) == "occ"
    spark.catalog.dropTempView("occ")


OCC = "gbifID long, species string, taxonKey long, lat double, lon double, year int, month int, countryCode string, eventDate string, lastInterpreted string"


def test_stream_applies_files_once_and_resumes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    store = Store(spark, str(tmp_path / "store"))
    run = lambda: stream_deltas(spark, str(tmp_path / "in"), store, str(tmp_path / "check")).awaitTermination()
    row = "{}\t{}\t5\t1.0\t2.0\t2020\t1\tDE\t2020-01-01\t2020-01-02"
    write(tmp_path / "in" / "a.txt", HEADER, row.format(1, "a"), row.format(2, "b"))
    run()
    first = store.state()
    run()
    assert store.state() == first
    write(tmp_path / "in" / "b.txt", HEADER, row.format(1, "new"), row.format("", "dropped"))
    run()
    assert {(r["gbifID"], r["scientificName"]) for r in store.read().collect()} == {(1, "new"), (2, "b")}


def test_failed_run_leaves_the_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    rows = spark.createDataFrame([(1, "a", 5, 1.0, 2.0, 2020, 1, "DE", "2020-01-01", "2020-01-02")], OCC)
    assert store.apply(rows.unionByName(rows), order=[F.col("year")], since="2020-01-01") == 2
    before = store.state()
    with pytest.raises(Exception):
        store.apply(rows.withColumn("species", F.raise_error(F.lit("broken")).cast("string")), order=[F.col("year")], since="2021-01-01")
    assert store.state() == before and store.read().count() == 1


def test_daily_update(spark, tmp_path):
    names = spark.createDataFrame([(0, "a", "A"), (1, "none", "N")], files.NAMES_SCHEMA)
    match = "name string, usageKey long, matchType string, confidence string, canonicalName string, scientificName string, rank string, status string"
    good = spark.createDataFrame([(n, k, "EXACT", "95", n, n, "SPECIES", "ACCEPTED") for n, k in (("a", 5), ("none", 6))], match)
    delta = spark.createDataFrame([(1, "a", 5, 1.0, 2.0, 2020, 1, "DE", "2020-01-01", "2026-01-01"), (2, "a", 5, 1.0, 2.0, 2020, 1, "DE", "2020-01-01", "2025-12-01"), (3, "x", 9, 1.0, 2.0, 2020, 1, "DE", "2020-01-01", "2026-01-01")], OCC)
    store = Store(spark, str(tmp_path / "s"))
    config = profiles.Config(country="DE")
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="none.*NONE"):
        daily.update(store, delta, names, good.filter("name = 'a'"), config, "2026-01-02", out, order=[F.col("year")])
    # the resolved table is there, the store isn't
    assert store.read() is None and {r["scientificName"]: r["ok"] for r in spark.read.json(f"{out}/resolved").collect()} == {"a": True, "none": False}
    assert daily.update(store, delta, names, good, config, "2026-01-02", out, order=[F.col("year")], mode="db-only") is None
    assert store.read().count() == 1 and "since" not in store.state()
    broken = names.withColumn("de", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        daily.update(store, delta, broken, good, config, "2026-01-02", out, mode="export-only")
    assert "since" not in store.state()  # an export that fails leaves the date
    got = {r["sci"]: json.loads(r["profile"]) for r in daily.update(store, delta, names, good, config, "2026-01-02", out, mode="export-only").collect()}
    assert [(k, v["de"], v["total"], v["sampled_total"], v["bbox"]) for k, v in sorted(got.items())] == [("a", "A", 1, 1, [1.0, 1.0, 2.0, 2.0]), ("none", "N", 0, 0, None)]
    assert store.state()["since"] == "2026-01-02" and got["none"]["month_counts_all"] == [0] * 12
    summary = json.loads(spark.read.text(f"{out}/stats_summary.json", wholetext=True).first()[0])
    assert summary["counts"] == {"plants": 2, "sampled_points_total": 1} and summary["meta"]["country"] == "DE"


def test_no_keys_is_an_error(spark):
    with pytest.raises(ValueError):
        taxa.keys(spark.createDataFrame([(None,)], "taxonKey long"))
    with pytest.raises(ValueError):
        select.delta_tree("2020-01-01", keys=[])


@pytest.mark.parametrize("dense", [True, False])
def test_document(spark, tmp_path, dense):
    rows = [(1, "a ä\"", 5, 1.5, 2.0, 2020, 99, "DE", "", ""), (2, "b", None, 1.0, 2.0, None, 3, "DE", "", "")]
    df = tables.normalize(spark.createDataFrame(rows, OCC), "sparse")
    images = spark.createDataFrame([("b", '{"u": [1, null]}')], "sci string, image string")
    made = profiles.dense(df, images=images) if dense else profiles.sparse(df, images=images)
    path = files.write_document(profiles.envelope(made, profiles.Config(), {"country": None}, dense), str(tmp_path / "doc"), gzip=True)
    text = spark.read.text(path, wholetext=True).first()[0]
    got = json.loads(text)
    assert "ä" in text and got["meta"] == {"country": None}
    assert got["region"]["center"] == ([51.0, 10.0] if dense else {"lat": 51.0, "lon": 10.0})
    a, b = got["plants"]['a ä"'], got["plants"]["b"]
    assert a["points"] == [[1.5, 2, 2020, None]] and a["last_obs"] == {"year": 2020, "month": None} and "image" not in a
    assert a["year_counts"] == ([[2020, 1]] if dense else {"2020": 1}) and b["taxonKey"] is None and b["last_obs"] is None and b["image"] == {"u": [1, None]}
    species = files.read_document(spark, str(tmp_path / "doc"))
    assert tuple(stats.counts(species).first()) == (2, 2) and [tuple(r) for r in stats.years(species).collect()] == [("2020", 1)]
    summary = json.loads(stats.summary(species).first()[0])
    assert summary["counts"] == {"plants": 2, "sampled_points_total": 2} and len(summary["top_by_total"]) == 2


def test_profiles_by_line(spark, tmp_path):
    rows = [(i, f'n"{i} ä', 5, 1.5, 2.0, 2020, 1, "DE", "", "") for i in range(40)] + [(100, "n\"0 ä", 5, 1.5, 2.0, 2021, 1, "DE", "", "")]
    made = profiles.profile_json(profiles.sparse(tables.normalize(spark.createDataFrame(rows, OCC), "sparse")))
    want = {r["sci"]: json.loads(r["profile"]) for r in made.collect()}
    for gzip in (False, True):
        path = str(tmp_path / f"lines{gzip}")
        told = files.write_lines(made.repartition(7), path, {"country": "DE"}, gzip)
        assert told == files.document_info(spark, path) == {"country": "DE", "species": 40, "scanned_rows": 41}
        assert len([f for f in (tmp_path / f"lines{gzip}").iterdir() if f.name.startswith("part-") and f.name.endswith(".gz" if gzip else ".txt")]) == 7
        assert {r["sci"]: json.loads(r["profile"]) for r in files.read_document(spark, path).collect()} == want
    # lines without their marker are no document; neither are they while they are replaced
    marker = tmp_path / "linesFalse" / files.MARKER
    marker.unlink()
    with pytest.raises(ValueError, match="no whole document"):
        files.read_document(spark, str(tmp_path / "linesFalse"))
    marker.write_text("{}")
    with pytest.raises(Exception, match="broken"):
        files.write_lines(made.withColumn("profile", F.raise_error(F.lit("broken")).cast("string")), str(tmp_path / "linesFalse"))
    assert not marker.exists()
    with pytest.raises(FileNotFoundError):
        files.read_document(spark, str(tmp_path / "nowhere"))
    assert files.write_lines(made.limit(0), str(tmp_path / "none")) == {"species": 0, "scanned_rows": 0} and files.read_document(spark, str(tmp_path / "none")).count() == 0


def test_scanned_rows_in_the_document(spark):
    rows = [(i, "a" if i < 5 else None if i < 7 else "b", 5, 1.5, 2.0 if i else None, 2020, 1, "DE", "", "") for i in range(9)]
    df = tables.normalize(spark.createDataFrame(rows, OCC), "sparse")
    names = spark.createDataFrame([(0, "a", "A"), (1, "none", "N")], files.NAMES_SCHEMA)
    of = lambda made: json.loads(profiles.envelope(made, profiles.Config(), {"source": "s"}, scanned=True).first()[0])["meta"]
    assert of(profiles.sparse(df, names=names)) == {"source": "s", "scanned_rows": 4}
    assert of(profiles.sparse(df)) == {"source": "s", "scanned_rows": 6}
    assert of(profiles.sparse(df.limit(0), names=names)) == {"source": "s", "scanned_rows": 0}


def test_fuzzy_matches_are_taken_where_allowed(spark):
    names = spark.createDataFrame([(i, n, "") for i, n in enumerate(["exact", "fuzzy", "weak", "keyless", "none"])], files.NAMES_SCHEMA)
    match = "name string, usageKey long, matchType string, confidence string, canonicalName string, scientificName string, rank string, status string"
    rows = [("exact", 1, "EXACT", "95"), ("fuzzy", 2, "FUZZY", "99"), ("weak", 3, "EXACT", "1"), ("keyless", None, "EXACT", "99")]
    matches = spark.createDataFrame([(n, k, t, c, n, n, "SPECIES", "ACCEPTED") for n, k, t, c in rows], match)
    ok = lambda fuzzy: {r["scientificName"] for r in taxa.resolve(names, matches, allow_fuzzy=fuzzy).filter("ok AND taxonKey IS NOT NULL").collect()}
    assert ok(False) == {"exact"} and ok(True) == {"exact", "fuzzy", "weak"}
    assert {tuple(r) for r in taxa.unresolved(taxa.resolve(names, matches, allow_fuzzy=True)).collect()} == {("keyless", "EXACT"), ("none", "NONE")}
