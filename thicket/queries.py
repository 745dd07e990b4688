"""Queries of the occurrence operators over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket import fixture
from thicket.functions import scalars as fn
from thicket.operators import aggregate, sampling, select, stats, taxa
from thicket.plans import daily, profiles
from thicket.sources import files
from thicket.sources.store import Store, upsert
from thicket.sources.tables import normalize
from thicket.streaming.deltas import stream_deltas

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

CONFIG = profiles.Config(max_points=300)
QUOTA = {"target": 200, "least": 1, "most": 5}


def _geohash_sql(precision: int = 5) -> str:
    bits = 5 * precision
    n_lon, n_lat = (bits + 1) // 2, bits // 2
    index = lambda v, low, span, n: f"least(greatest(floor(({v} - {low}) / {span} * {1 << n}), 0), {(1 << n) - 1})::BIGINT"
    x, y = index("lon", "(-180.0)", "360.0", n_lon), index("lat", "(-90.0)", "180.0", n_lat)
    digits = []
    for d in range(precision):
        terms = [f"((({x if b % 2 == 0 else y}) >> {(n_lon if b % 2 == 0 else n_lat) - 1 - b // 2}) & 1) * {1 << (5 * d + 4 - b)}" for b in range(5 * d, 5 * d + 5)]
        digits.append(f"substr('{fn.GEOHASH_DIGITS}', ({' + '.join(terms)})::INT + 1, 1)")
    return " || ".join(digits)


_BASE = f"""
WITH raw AS (
  SELECT (l_orderkey * 10 + l_linenumber)::BIGINT AS gbifID, p_name AS sci, CASE WHEN p_size % 7 <> 0 THEN p_partkey END AS taxonKey,
         year(l_shipdate)::INT AS y, month(l_shipdate)::INT AS m, n_name AS country,
         CASE WHEN l_linenumber <> 7 THEN 47.0::DOUBLE + ((l_suppkey % 8) * (l_suppkey % 3)) * 0.5::DOUBLE + (l_orderkey % 2) * 0.03::DOUBLE END AS lat,
         6.0::DOUBLE + (l_partkey % 9) * 1.0::DOUBLE + (l_orderkey % 2) * 0.03::DOUBLE AS lon,
         strftime(l_shipdate, '%Y-%m-%d') AS eventDate, strftime(l_shipdate, '%Y-%m-%d') AS lastInterpreted, l_shipdate, l_partkey, l_suppkey
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
), occ AS (
  SELECT * EXCLUDE (l_shipdate, l_partkey, l_suppkey) FROM raw
  QUALIFY row_number() OVER (PARTITION BY gbifID ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1
), f AS (
  SELECT *, {_geohash_sql()} AS cell FROM occ WHERE lat IS NOT NULL
), nm AS (
  SELECT sci, row_number() OVER (ORDER BY sci) - 1 AS pos FROM (SELECT DISTINCT p_name AS sci FROM part)
), names AS (
  SELECT (pos // 2)::INT AS ord, sci, 'de ' || sci AS de FROM nm WHERE pos % 2 = 0
  UNION ALL SELECT (n + k)::INT, 'none ' || k, 'de none ' || k FROM (SELECT count(*) AS n FROM nm), (SELECT unnest([0, 1]) AS k)
), matches AS (
  SELECT sci AS name, (ord + 1000)::BIGINT AS usageKey, ['EXACT', 'EXACT', 'HIGHERRANK', 'HIGHERRANK', 'FUZZY'][ord % 5 + 1] AS matchType,
         [80, 79, 90, 89, 99][ord % 5 + 1] AS confidence FROM names WHERE ord % 7 <> 6
), s1 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sci, cell ORDER BY y DESC NULLS LAST, m DESC NULLS LAST, gbifID)::INT AS cell_rank FROM f) WHERE cell_rank <= 6
), s AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sci ORDER BY y DESC NULLS LAST, m DESC NULLS LAST, gbifID)::INT AS rank FROM s1) WHERE rank <= 300
), w AS (
  SELECT sci, cell, count(*)::BIGINT AS n, floor(sqrt(count(*)::DOUBLE) * 1e9)::BIGINT AS w FROM f GROUP BY ALL
), q AS (
  SELECT *, least(CASE WHEN share > 0 THEN greatest(share, 1) ELSE share END, 5)::BIGINT AS q
  FROM (SELECT *, round_even(200.0::DOUBLE * w / sum(w) OVER (PARTITION BY sci), 0)::BIGINT AS share FROM w)
), b AS (
  SELECT *, sum(q) OVER (PARTITION BY sci) > 200 AS over FROM q
), r AS (
  SELECT sci, r, any_value(over) AS over, sum(CASE WHEN over THEN greatest(q - r, least(q, 1)) ELSE least(q + r, greatest(q, 5)) END) AS total
  FROM b, (SELECT unnest(range(0, 6)) AS r) GROUP BY sci, r
), c AS (
  SELECT sci, max(r) AS r, max_by(total, r) AS total FROM r WHERE CASE WHEN over THEN total >= 200 ELSE total <= 200 END GROUP BY sci
), v AS (
  SELECT *, CASE WHEN over THEN moved > 1 ELSE moved < 5 END AS can
  FROM (SELECT b.*, c.total, CASE WHEN over THEN greatest(q - r, least(q, 1)) ELSE least(q + r, greatest(q, 5)) END AS moved FROM b JOIN c USING (sci))
), bq AS (
  SELECT sci, cell, n, w, q, (CASE WHEN over THEN moved - step ELSE moved + step END)::BIGINT AS quota
  FROM (SELECT *, (can AND sum(can::INT) OVER (PARTITION BY sci ORDER BY w DESC, cell ROWS UNBOUNDED PRECEDING) <= abs(total - 200))::INT AS step FROM v)
), seen AS (
  SELECT f.*, bq.w, quota, row_number() OVER (PARTITION BY sci, cell ORDER BY gbifID)::INT AS seen FROM f JOIN bq USING (sci, cell) WHERE quota > 0
), slots AS (
  SELECT *, (CASE WHEN seen <= quota THEN seen - 1 ELSE ('0x' || substr(md5(sci || chr(31) || cell || chr(31) || seen || chr(31) || gbifID), 1, 8))::BIGINT % seen END)::BIGINT AS slot FROM seen
), st AS (
  SELECT *, row_number() OVER (PARTITION BY sci ORDER BY w DESC, cell, slot)::INT AS rank
  FROM (SELECT * FROM slots WHERE slot < quota QUALIFY row_number() OVER (PARTITION BY sci, cell, slot ORDER BY seen DESC) = 1)
), strat AS (
  SELECT * FROM st WHERE rank <= 200
)
"""


def query(sql: str | None = None, base: bool = True) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if there is any."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = (_BASE if base else "") + sql
        return f

    return add


def _occ(spark: SparkSession, d: str) -> DataFrame:
    return normalize(fixture.occurrences(spark, d), "sparse")


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return select.base_filter(_occ(spark, d))


# Sources


def _write_tsv(df: DataFrame) -> str:
    path = files.scratch(df.sparkSession)
    df.select(*[F.col(c).cast("string") for c in df.columns]).write.csv(path, sep="\t", header=True, quote="", emptyValue="")
    return path


def _archive(spark: SparkSession, d: str) -> str:
    raw = fixture.raw(spark, d)
    return _write_tsv(raw.select(F.when(F.col("gbifID") % 3 != 0, F.col("gbifID")).alias("gbifID"), F.col("gbifID").alias("id"), F.when(F.col("gbifID") % 2 == 0, F.col("species")).alias("species"), F.col("species").alias("canonicalName"), "taxonKey", "year", "month", "countryCode", "eventDate", F.col("lat").alias("decimalLatitude"), F.col("lon").alias("decimalLongitude")))


def _delta(df: DataFrame) -> DataFrame:
    return df.select("gbifID", F.col("species").alias("scientificName"), "taxonKey", F.col("lat").alias("decimalLatitude"), F.col("lon").alias("decimalLongitude"), "year", "month", "countryCode", "eventDate", "lastInterpreted")


@query("SELECT gbifID::VARCHAR AS gbifID, sci AS species, taxonKey, y::BIGINT AS year, m::BIGINT AS month, country AS countryCode, eventDate, lat, lon FROM raw")
def src_archive(spark: SparkSession, d: str) -> DataFrame:
    return files.read_archive(spark, _archive(spark, d), keep_raw=False).select("gbifID", "species", "taxonKey", "year", "month", "countryCode", "eventDate", "lat", "lon")


@query("SELECT sci AS species, count(*)::BIGINT AS n, count(taxonKey)::BIGINT AS with_taxon, count(lat)::BIGINT AS with_lat, sum(gbifID)::BIGINT AS ids FROM raw GROUP BY sci")
def ingest_archive(spark: SparkSession, d: str) -> DataFrame:
    rows = files.read_archive(spark, _archive(spark, d))
    return rows.groupBy("species").agg(F.count(F.lit(1)).alias("n"), F.count("taxonKey").alias("with_taxon"), F.count("lat").alias("with_lat"), F.sum(F.col("gbifID").cast("bigint")).alias("ids"))


@query("SELECT gbifID::VARCHAR AS gbifID, sci AS scientificName, taxonKey::VARCHAR AS taxonKey, y::VARCHAR AS year, m::VARCHAR AS month, country AS countryCode, eventDate FROM raw")
def src_delta(spark: SparkSession, d: str) -> DataFrame:
    return files.read_tsv(spark, _write_tsv(_delta(fixture.raw(spark, d)))).select("gbifID", "scientificName", "taxonKey", "year", "month", "countryCode", "eventDate")


@query("SELECT gbifID, sci AS scientificName, taxonKey, lat AS decimalLatitude, lon AS decimalLongitude, y::BIGINT AS year, m::BIGINT AS month, country AS countryCode, eventDate, lastInterpreted FROM raw WHERE lat IS NOT NULL")
def ingest_delta(spark: SparkSession, d: str) -> DataFrame:
    return files.read_delta(spark, _write_tsv(_delta(fixture.raw(spark, d)))).drop(*files.POSITION)


@query("SELECT concat_ws(chr(9), gbifID, coalesce(taxonKey::VARCHAR, ''), sci, y, country) AS line FROM raw")
def raw_line(spark: SparkSession, d: str) -> DataFrame:
    raw = fixture.raw(spark, d)
    return raw.select(fn.raw_line([F.col(c) for c in ("gbifID", "taxonKey", "species", "year", "countryCode")]).alias("line"))


@query("SELECT least(count(*), 1000)::BIGINT AS n, 0::BIGINT AS unlimited FROM raw")
def load_limit(spark: SparkSession, d: str) -> DataFrame:
    rows = files.read_archive(spark, _archive(spark, d), keep_raw=False)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    both = count(files.load_limit(rows, 0), "all").join(count(fixture.raw(spark, d), "raw"), F.lit(True))  # one row each
    return count(files.load_limit(rows, 1000), "n").join(both, F.lit(True)).select("n", (F.col("all") - F.col("raw")).alias("unlimited"))


def _ordered_tsv(spark: SparkSession, d: str, df: DataFrame) -> str:
    """Rows of df in upsert order, oldest first, in several files whose names sort, as many as Spark's shuffles have tasks."""
    return _write_tsv(df.repartitionByRange(max(6, int(spark.conf.get("spark.sql.shuffle.partitions"))), "l_shipdate", "l_partkey", "l_suppkey", "gbifID").sortWithinPartitions("l_shipdate", "l_partkey", "l_suppkey", "gbifID").drop("l_shipdate", "l_partkey", "l_suppkey"))


def _small_splits(spark: SparkSession, path: str, run: Callable[[], None]) -> None:
    """Run a job whose files are read in splits of 256 KB, or of a quarter of a file where files are large, so that tasks are as many at any size."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    n, size = files.folder_size(spark, path)
    spark.conf.set(name, str(max(1 << 18, size // (4 * max(n, 1)))))
    try:
        run()
    finally:
        spark.conf.set(name, before)


@query("SELECT gbifID FROM raw ORDER BY l_shipdate, l_partkey, l_suppkey, gbifID LIMIT 1000")
def load_limit_rows(spark: SparkSession, d: str) -> DataFrame:
    """Which rows a limit loads: the first in source order, over several files."""
    rows = files.read_archive(spark, _ordered_tsv(spark, d, fixture.raw(spark, d)), keep_raw=False)
    return files.load_limit(rows, 1000).select(F.col("gbifID").cast("bigint").alias("gbifID"))


@query("SELECT gbifID, sci AS scientificName, taxonKey, lat AS decimalLatitude, lon AS decimalLongitude, y::BIGINT AS year, m::BIGINT AS month, country AS countryCode, eventDate, lastInterpreted FROM f")
def source_order(spark: SparkSession, d: str) -> DataFrame:
    """An upsert in the default order, that of the source: several files, each read in many splits. The last row wins."""
    raw = fixture.raw(spark, d)
    path = _ordered_tsv(spark, d, raw.select("gbifID", F.col("species").alias("scientificName"), "taxonKey", F.col("lat").alias("decimalLatitude"), F.col("lon").alias("decimalLongitude"), "year", "month", "countryCode", "eventDate", "lastInterpreted", "l_shipdate", "l_partkey", "l_suppkey"))
    store = Store(spark, files.scratch(spark))
    _small_splits(spark, path, lambda: store.apply(files.read_delta(spark, path)))
    return store.read()


@query("SELECT (row_number() OVER (ORDER BY ord) - 1)::INT AS ord, sci, de FROM names")
def src_names(spark: SparkSession, d: str) -> DataFrame:
    path = files.scratch(spark)
    entries = F.transform(F.sort_array(F.collect_list(F.struct("ord", "sci", "de"))), lambda x: F.struct(x["sci"], x["de"]))
    fixture.names(spark, d).agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.text(path)
    return files.read_names(spark, path)


@query("SELECT sci, '{\"u\":' || ord || '}' AS image FROM names")
def src_images(spark: SparkSession, d: str) -> DataFrame:
    path = files.scratch(spark)
    one = F.map_from_entries(F.collect_list(F.struct("sci", F.struct(F.col("ord").alias("u")))))
    fixture.names(spark, d).agg(F.to_json(F.struct(one.alias("plants"))).alias("value")).write.text(path)
    return files.read_images(spark, path)


@query("SELECT gbifID, sci, taxonKey, lat, lon, y, m, eventDate, country, lastInterpreted FROM occ")
def normalized(spark: SparkSession, d: str) -> DataFrame:
    return normalize(fixture.occurrences(spark, d).withColumnsRenamed({"lat": "decimalLatitude", "lon": "longitude", "countryCode": "country_code"}))


# Scalars

_TEXTS = {1: "l_orderkey", 2: "' ' || l_orderkey || ' '", 3: "l_quantity", 4: "'+' || l_orderkey", 5: "''", 6: "NULL", 7: "'x' || l_orderkey"}


def _texts(spark: SparkSession, d: str) -> DataFrame:
    cases = " ".join(f"WHEN {k} THEN cast({v} AS string)" for k, v in _TEXTS.items())
    return spark.read.parquet(f"{d}/lineitem.parquet").selectExpr("l_orderkey", "l_linenumber", f"CASE l_linenumber {cases} END AS t")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 2, 4) THEN l_orderkey END AS v FROM lineitem", base=False)
def parse_strict(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("l_orderkey", "l_linenumber", fn.to_int(F.col("t")).alias("v"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 2, 4) THEN l_orderkey WHEN l_linenumber = 3 THEN trunc(l_quantity)::BIGINT END AS v FROM lineitem", base=False)
def parse_loose(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("l_orderkey", "l_linenumber", fn.parse_int(F.col("t")).alias("v"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 2, 4) THEN l_orderkey::DOUBLE WHEN l_linenumber = 3 THEN l_quantity END AS v FROM lineitem", base=False)
def parse_float(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("l_orderkey", "l_linenumber", fn.to_float(F.col("t")).alias("v"))


@query("SELECT gbifID, y, m FROM occ")
def ym_from_eventdate(spark: SparkSession, d: str) -> DataFrame:
    return normalize(fixture.occurrences(spark, d).drop("year", "month")).select("gbifID", "y", "m")


@query("SELECT gbifID, cell FROM f")
def geohash_cells(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.with_cell(_rows(spark, d)).select("gbifID", "cell")


@query("SELECT gbifID, ('0x' || substr(md5(sci || chr(31) || coalesce(taxonKey::VARCHAR, '') || chr(31) || gbifID), 1, 8))::BIGINT AS h FROM occ")
def stable_hash(spark: SparkSession, d: str) -> DataFrame:
    return _occ(spark, d).select("gbifID", fn.stable_hash(F.col("sci"), F.col("taxonKey"), F.col("gbifID")).alias("h"))


# Filters


@query("SELECT gbifID FROM f WHERE country = 'NATION_7'")
def base_filter(spark: SparkSession, d: str) -> DataFrame:
    return select.base_filter(_occ(spark, d), "NATION_7").select("gbifID")


@query("SELECT gbifID FROM f WHERE y BETWEEN 1996 AND 1999")
def year_filter(spark: SparkSession, d: str) -> DataFrame:
    return select.year_filter(_rows(spark, d), 1996, 1999).select("gbifID")


@query("SELECT gbifID FROM f WHERE substr(eventDate, 1, 4) >= '1997'")
def year_filter_eventdate(spark: SparkSession, d: str) -> DataFrame:
    return select.year_filter(_rows(spark, d), 1997, None, on="eventDate").select("gbifID")


@query("SELECT gbifID FROM f WHERE y >= 1996 AND y <= 2000 AND lastInterpreted >= '1997-03-05' AND taxonKey % 3 = 1")
def delta_predicate(spark: SparkSession, d: str) -> DataFrame:
    keys = spark.read.parquet(f"{d}/part.parquet").filter("p_partkey % 3 = 1").select(F.col("p_partkey").alias("taxonKey"))
    tree = select.delta_tree("1997-03-05", years=(1996, 2000))
    return select.delta_rows(_occ(spark, d), tree, keys).select("gbifID")


@query("SELECT gbifID, country FROM f WHERE country = 'NATION_7' AND y >= 1996 AND y <= 2000 AND lastInterpreted >= '1997-03-05'")
def delta_scan(spark: SparkSession, d: str) -> DataFrame:
    """The predicate on a store whose files are sorted by lastInterpreted: it goes into the scan, which passes over row groups."""
    store = Store(spark, files.scratch(spark))
    store.apply(fixture.raw(spark, d), order=fixture.latest())
    tree = select.delta_tree("1997-03-05", country="NATION_7", years=(1996, 2000))
    return select.delta_rows(normalize(store.read(), "sparse"), tree).select("gbifID", "country")


@query("SELECT DISTINCT lastInterpreted, strftime(lastInterpreted::DATE - 2, '%Y-%m-%d') AS since FROM raw")
def delta_since(spark: SparkSession, d: str) -> DataFrame:
    return fixture.raw(spark, d).select("lastInterpreted").distinct().withColumn("since", select.since(F.col("lastInterpreted"), 2))


# Store

_OCC = "SELECT gbifID, sci AS species, taxonKey, y AS year, m AS month, country AS countryCode, lat, lon, eventDate, lastInterpreted FROM occ"


@query(_OCC)
def upsert_replace(spark: SparkSession, d: str) -> DataFrame:
    return fixture.occurrences(spark, d)


@query(_OCC)
def upsert_update(spark: SparkSession, d: str) -> DataFrame:
    raw = fixture.raw(spark, d)
    store = upsert(None, raw.filter("year < 1999"), order=fixture.latest())
    return upsert(store, raw.filter("year >= 1999"), order=fixture.latest()).drop("l_shipdate", "l_partkey", "l_suppkey")


@query(_OCC)
def apply_delta(spark: SparkSession, d: str) -> DataFrame:
    raw, store = fixture.raw(spark, d), Store(spark, files.scratch(spark))
    for part in ("year < 1998", "year >= 1998", "year >= 1998"):  # redelivered rows change nothing
        store.apply(raw.filter(part), order=fixture.latest())
    return store.read().drop("l_shipdate", "l_partkey", "l_suppkey")


@query(_OCC)
def apply_layers(spark: SparkSession, d: str) -> DataFrame:
    """Deltas that are kept as layers beside the buckets and left out or added by the reader; the fourth one folds the first three."""
    raw, store = fixture.raw(spark, d), Store(spark, files.scratch(spark), layers=2)
    for part in ("year < 1998", "year = 1998", "year = 1999", "year = 2000", "year > 2000"):
        store.apply(raw.filter(part), order=fixture.latest())
    return store.read().drop("l_shipdate", "l_partkey", "l_suppkey")


@query("SELECT gbifID, sci AS scientificName, taxonKey, lat AS decimalLatitude, lon AS decimalLongitude, y::BIGINT AS year, m::BIGINT AS month, country AS countryCode, eventDate, lastInterpreted FROM f")
def stream_delta(spark: SparkSession, d: str) -> DataFrame:
    top, store = files.scratch(spark), Store(spark, files.scratch(spark))
    rows = files.stored(_delta(fixture.occurrences(spark, d)).select(*[F.col(c).cast("string") for c in files.DELTA_COLUMNS]))  # made once for both batches
    # two batches: rows of 1999 and later come first as well, under another name, and are delivered again
    for part in (rows.filter("year >= 1999").withColumn("scientificName", F.lit("first")), rows):
        part.write.mode("append").csv(f"{top}/in", sep="\t", header=True, quote="", emptyValue="")
        stream_deltas(spark, f"{top}/in", store, f"{top}/checkpoint").awaitTermination()
    return store.read()


@query("""
SELECT 0 AS version, sci AS species, count(*)::BIGINT AS n, max(y)::INT AS newest FROM
  (SELECT * FROM raw WHERE y < 1998 QUALIFY row_number() OVER (PARTITION BY gbifID ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1) GROUP BY sci
UNION ALL SELECT 1, sci, count(*)::BIGINT, max(y)::INT FROM occ GROUP BY sci
""")
def store_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Species in the snapshots before and after a replacing upsert; the older one is read after it."""
    raw, store = fixture.raw(spark, d), Store(spark, files.scratch(spark), buckets=8)
    for part in ("year < 1998", "year >= 1998"):
        store.apply(raw.filter(part), order=fixture.latest())
    of = lambda v: store.read(v).groupBy("species").agg(F.count(F.lit(1)).alias("n"), F.max("year").alias("newest")).select(F.lit(v).alias("version"), "*")
    return of(0).unionByName(of(1))


@query("SELECT count(*)::BIGINT AS rows, count(DISTINCT gbifID)::BIGINT AS stored FROM raw WHERE lat IS NOT NULL")
def ingest_counts(spark: SparkSession, d: str) -> DataFrame:
    store = Store(spark, files.scratch(spark))
    rows = store.apply(select.base_filter(fixture.raw(spark, d)), order=fixture.latest())
    return store.read().agg(F.lit(rows).cast("bigint").alias("rows"), F.count(F.lit(1)).alias("stored"))


# Species


@query("SELECT sci, n FROM (SELECT sci, count(*)::BIGINT AS n FROM f GROUP BY sci ORDER BY n DESC, sci LIMIT 10) WHERE sci <> ''")
def top_species(spark: SparkSession, d: str) -> DataFrame:
    return select.top_species(_rows(spark, d), 10)


@query("SELECT gbifID FROM f WHERE sci IN (SELECT sci FROM names)")
def whitelist_semi(spark: SparkSession, d: str) -> DataFrame:
    return select.whitelist(_rows(spark, d), fixture.names(spark, d)).select("gbifID")


@query("SELECT sci, count(*)::BIGINT AS n FROM f WHERE sci IN (SELECT sci FROM names WHERE ord < 20) GROUP BY sci")
def whitelist_totals(spark: SparkSession, d: str) -> DataFrame:
    return select.totals(select.whitelist(_rows(spark, d), select.first_names(fixture.names(spark, d), 20)))


@query("SELECT names.sci, count(f.gbifID)::BIGINT AS total FROM names LEFT JOIN f USING (sci) GROUP BY names.sci")
def whitelist_totals_zero(spark: SparkSession, d: str) -> DataFrame:
    return profiles.sparse(_occ(spark, d), CONFIG, fixture.names(spark, d)).select("sci", "total")


@query("SELECT f.sci, count(*)::BIGINT AS n, any_value(coalesce(de, '')) AS de FROM f LEFT JOIN names USING (sci) GROUP BY f.sci")
def attach_names(spark: SparkSession, d: str) -> DataFrame:
    return profiles.attach_names(select.totals(_rows(spark, d)), fixture.names(spark, d))


@query("SELECT f.sci, count(*)::BIGINT AS n, any_value('{\"u\":' || ord || '}') AS image FROM f LEFT JOIN names USING (sci) GROUP BY f.sci")
def attach_images(spark: SparkSession, d: str) -> DataFrame:
    images = fixture.names(spark, d).select("sci", F.to_json(F.struct(F.col("ord").alias("u"))).alias("image"))
    return profiles.attach_images(select.totals(_rows(spark, d)), images)


@query("SELECT sci, count(*)::BIGINT AS n FROM f GROUP BY sci")
def species_totals(spark: SparkSession, d: str) -> DataFrame:
    return select.totals(_rows(spark, d))


# Aggregates over all rows and over the sample

_MONTHS = "SELECT sci, k::INT AS month, (SELECT count(*) FROM {t} x WHERE x.sci = g.sci AND x.m = k)::BIGINT AS n FROM (SELECT DISTINCT sci FROM {t}) g, (SELECT unnest(range(1, 13)) AS k)"
_BBOX = "SELECT sci, min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon FROM {t} GROUP BY sci"


def _months(df: DataFrame) -> DataFrame:
    return df.groupBy("sci").agg(aggregate.month_counts().alias("c")).select("sci", F.posexplode("c").alias("month", "n")).withColumn("month", F.col("month") + 1)


def _bbox(df: DataFrame) -> DataFrame:
    return df.groupBy("sci").agg(aggregate.bbox().alias("b")).select("sci", *[F.col("b")[i].alias(n) for i, n in enumerate(("min_lat", "max_lat", "min_lon", "max_lon"))])


def _sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.sparse_sample(_rows(spark, d), CONFIG.precision, CONFIG.keep_per_cell, CONFIG.max_points)


@query("SELECT sci, y, count(*)::BIGINT AS n FROM f GROUP BY ALL")
def year_counts_full(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.year_counts(_rows(spark, d))


@query(_MONTHS.format(t="f"))
def month_counts_full(spark: SparkSession, d: str) -> DataFrame:
    return _months(_rows(spark, d))


@query(_BBOX.format(t="f"))
def bbox_full(spark: SparkSession, d: str) -> DataFrame:
    return _bbox(_rows(spark, d))


@query("SELECT sci, max(y * 100 + m) // 100 AS year, (max(y * 100 + m) % 100)::INT AS month FROM f GROUP BY sci")
def last_obs_full(spark: SparkSession, d: str) -> DataFrame:
    last = _rows(spark, d).groupBy("sci").agg(aggregate.last_obs_full().alias("l"))
    return last.select("sci", fn.last_obs(F.col("l.y"), F.col("l.m")).alias("l")).select("sci", "l.year", "l.month")


@query("SELECT sci, cell, count(*)::BIGINT AS n FROM f GROUP BY ALL")
def cell_counts(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.cell_counts(_rows(spark, d))


@query("SELECT sci, min_by(taxonKey, gbifID) FILTER (taxonKey IS NOT NULL) AS taxonKey FROM f GROUP BY sci")
def taxon_key(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).groupBy("sci").agg(aggregate.taxon_key().alias("taxonKey"))


@query("SELECT gbifID, cell, cell_rank FROM s1")
def newest_per_cell(spark: SparkSession, d: str) -> DataFrame:
    return sampling.newest_per_cell(_rows(spark, d)).select("gbifID", "cell", "cell_rank")


@query("SELECT gbifID, sci, cell, rank FROM s")
def sparse_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d).select("gbifID", "sci", "cell", "rank")


@query("SELECT sci, y::VARCHAR AS y, count(*)::BIGINT AS n FROM s GROUP BY ALL")
def year_counts_kept(spark: SparkSession, d: str) -> DataFrame:
    pairs = aggregate.year_pairs(aggregate.year_counts(_sample(spark, d)), newest_first=True)
    return pairs.select("sci", F.explode(F.map_from_entries(F.transform("year_counts", lambda p: F.struct(p["y"].cast("string"), p["n"])))).alias("y", "n"))


@query(_MONTHS.format(t="s"))
def month_counts_kept(spark: SparkSession, d: str) -> DataFrame:
    return _months(_sample(spark, d))


@query(_BBOX.format(t="s"))
def bbox_kept(spark: SparkSession, d: str) -> DataFrame:
    return _bbox(_sample(spark, d))


@query("SELECT sci, y AS year, m AS month FROM s WHERE y IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sci ORDER BY rank) = 1")
def last_obs_kept(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d).groupBy("sci").agg(aggregate.last_obs_kept().alias("l")).select("sci", F.col("l.y").alias("year"), F.col("l.m").alias("month"))


@query("SELECT sci, rank, lat, lon, y, m FROM s")
def points_kept(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.kept_aggregates(_sample(spark, d)).select("sci", F.inline("points"))


@query("SELECT sci, count(*)::BIGINT AS sampled_total FROM s GROUP BY sci")
def sampled_total(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.kept_aggregates(_sample(spark, d)).select("sci", "sampled_total")


@query("SELECT count(*)::BIGINT AS scanned_rows FROM f WHERE sci IN (SELECT sci FROM names)")
def scanned_rows(spark: SparkSession, d: str) -> DataFrame:
    return select.whitelist(_rows(spark, d), fixture.names(spark, d)).agg(F.count(F.lit(1)).alias("scanned_rows"))


# Quotas


@query("SELECT sci, cell, n, w, q FROM q")
def cell_quotas(spark: SparkSession, d: str) -> DataFrame:
    return sampling.cell_quotas(aggregate.cell_counts(_rows(spark, d)), **QUOTA)


@query("SELECT sci, cell, n, w, q, quota FROM bq")
def quotas_balanced(spark: SparkSession, d: str) -> DataFrame:
    return sampling.balanced_quotas(sampling.cell_quotas(aggregate.cell_counts(_rows(spark, d)), **QUOTA), **QUOTA)


@query("SELECT sci, cell, slot, gbifID FROM st")
def strat_sample(spark: SparkSession, d: str) -> DataFrame:
    celled = aggregate.with_cell(_rows(spark, d))
    return sampling.quota_sample(celled, files.checkpoint(sampling.cell_spans(celled)), **QUOTA).select("sci", "cell", "slot", "gbifID")


@query("SELECT sci, rank, gbifID, lat, lon, y, m FROM strat")
def points_strat(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified_sample(_rows(spark, d), **QUOTA).select("sci", "rank", "gbifID", "lat", "lon", "y", "m")


# Taxa


@query("SELECT name, matchType, confidence, matchType = 'EXACT' AND confidence >= 80 OR matchType = 'HIGHERRANK' AND confidence >= 90 AS ok FROM matches")
def taxon_accept(spark: SparkSession, d: str) -> DataFrame:
    m = fixture.matches(fixture.names(spark, d))
    return m.select("name", "matchType", F.col("confidence").cast("int").alias("confidence"), taxa.accepted(F.col("matchType"), F.col("confidence")).alias("ok"))


@query("SELECT sci AS scientificName, de, usageKey AS taxonKey, matchType, sci || ' L.' AS matched FROM names LEFT JOIN matches ON sci = name WHERE usageKey IS NOT NULL UNION ALL SELECT sci, de, NULL, NULL, NULL FROM names WHERE sci NOT IN (SELECT name FROM matches)")
def taxon_resolve(spark: SparkSession, d: str) -> DataFrame:
    n = fixture.names(spark, d)
    return taxa.resolve(n, fixture.matches(n)).select("scientificName", "de", "taxonKey", "match.matchType", F.col("match.scientificName").alias("matched"))


@query("SELECT sci FROM names WHERE sci NOT IN (SELECT name FROM matches)")
def taxon_missing(spark: SparkSession, d: str) -> DataFrame:
    n = fixture.names(spark, d)
    return taxa.missing(n, fixture.matches(n))


@query("SELECT sci AS scientificName, coalesce(matchType, 'NONE') AS matchType FROM names LEFT JOIN matches ON sci = name WHERE NOT coalesce(matchType = 'EXACT' AND confidence >= 80 OR matchType = 'HIGHERRANK' AND confidence >= 90, false)")
def taxon_unresolved(spark: SparkSession, d: str) -> DataFrame:
    n = fixture.names(spark, d)
    return taxa.unresolved(taxa.resolve(n, fixture.matches(n)))


# Profiles, documents, summaries

_SPARSE = """
SELECT n.sci, n.de, count(f.gbifID)::BIGINT AS total, min_by(f.taxonKey, f.gbifID) FILTER (f.taxonKey IS NOT NULL) AS taxonKey,
       (SELECT count(*) FROM s WHERE s.sci = n.sci)::BIGINT AS sampled_total, (SELECT min_by(y, rank) FROM s WHERE s.sci = n.sci) AS last_year,
       (SELECT min_by(m, rank) FROM s WHERE s.sci = n.sci) AS last_month, (SELECT min(lat) FROM s WHERE s.sci = n.sci) AS min_lat,
       (SELECT max(lon) FROM s WHERE s.sci = n.sci) AS max_lon, (SELECT count(DISTINCT y) FROM s WHERE s.sci = n.sci)::INT AS years,
       (SELECT count(*) FROM s WHERE s.sci = n.sci AND m = 1)::BIGINT AS januaries
FROM names n LEFT JOIN f ON f.sci = n.sci GROUP BY n.sci, n.de
"""


@query(_SPARSE)
def profile_sparse(spark: SparkSession, d: str) -> DataFrame:
    p = profiles.sparse(_occ(spark, d), CONFIG, fixture.names(spark, d))
    return p.select(
        "sci", "de", "total", "taxonKey", "sampled_total", F.col("last_obs.year").alias("last_year"), F.col("last_obs.month").alias("last_month"),
        F.col("bbox")[0].alias("min_lat"), F.col("bbox")[3].alias("max_lon"), F.size("year_counts").alias("years"), F.col("month_counts_all")[0].alias("januaries"),
    )


@query("""
SELECT f.sci, count(*)::BIGINT AS total, min_by(taxonKey, gbifID) FILTER (taxonKey IS NOT NULL) AS taxonKey, max(y * 100 + m) // 100 AS last_year, (max(y * 100 + m) % 100)::INT AS last_month,
       min(lat) AS min_lat, max(lon) AS max_lon, count(DISTINCT y)::INT AS years, count(*) FILTER (m = 1)::BIGINT AS januaries, (SELECT count(*) FROM strat WHERE strat.sci = f.sci)::INT AS points
FROM f WHERE sci IN (SELECT sci FROM f GROUP BY sci ORDER BY count(*) DESC, sci LIMIT 50) GROUP BY f.sci
""")
def profile_dense(spark: SparkSession, d: str) -> DataFrame:
    p = profiles.dense(_occ(spark, d), profiles.Config(top_n=50, points=QUOTA["target"], min_per_cell=QUOTA["least"], max_per_cell=QUOTA["most"]))
    return p.select(
        "sci", "total", "taxonKey", F.col("last_obs.year").alias("last_year"), F.col("last_obs.month").alias("last_month"), F.col("bbox")[0].alias("min_lat"), F.col("bbox")[3].alias("max_lon"),
        F.size("year_counts").alias("years"), F.col("month_counts_all")[0].alias("januaries"), F.size("points").alias("points"),
    )


_JOINED = "(SELECT string_agg(x, ';' ORDER BY {by}) FROM (SELECT {text} AS x, {keys} FROM s WHERE s.sci = n.sci {rest}))"


@query(f"""
SELECT n.sci, coalesce({_JOINED.format(by="y DESC", text="y || ',' || count(*)", keys="y", rest="AND y IS NOT NULL GROUP BY y")}, '') AS years,
       (SELECT string_agg(c::VARCHAR, ';' ORDER BY k) FROM (SELECT k, (SELECT count(*) FROM s WHERE s.sci = n.sci AND s.m = k) AS c FROM (SELECT unnest(range(1, 13)) AS k))) AS months,
       coalesce({_JOINED.format(by="rank", text="rank || ',' || round(lat * 100)::BIGINT || ',' || round(lon * 100)::BIGINT || ',' || y || ',' || m", keys="rank", rest="")}, '') AS points,
       coalesce((SELECT round(min(lat) * 100)::BIGINT || ',' || round(max(lat) * 100)::BIGINT || ',' || round(min(lon) * 100)::BIGINT || ',' || round(max(lon) * 100)::BIGINT FROM s WHERE s.sci = n.sci), '') AS bbox
FROM names n
""")
def profile_sparse_fields(spark: SparkSession, d: str) -> DataFrame:
    """Every element of the nested fields of a sparse profile, as text; coordinates in hundredths."""
    p = profiles.sparse(_occ(spark, d), CONFIG, fixture.names(spark, d))
    whole = lambda x: F.round(x * 100).cast("bigint").cast("string")
    text = lambda *xs: F.concat_ws(",", *[x.cast("string") for x in xs])
    points = F.transform("points", lambda x: text(x["rank"], whole(x["lat"]), whole(x["lon"]), x["y"], x["m"]))
    return p.select("sci", F.array_join(F.transform("year_counts", lambda x: text(x["y"], x["n"])), ";").alias("years"), F.array_join(F.transform("month_counts_all", lambda n: n.cast("string")), ";").alias("months"), F.array_join(points, ";").alias("points"), F.coalesce(F.array_join(F.transform("bbox", whole), ","), F.lit("")).alias("bbox"))


def _sparse_json(spark: SparkSession, d: str) -> DataFrame:
    return profiles.profile_json(profiles.sparse(_occ(spark, d), CONFIG))


def _envelope(spark: SparkSession, d: str) -> DataFrame:
    return profiles.envelope(profiles.sparse(_occ(spark, d), CONFIG, fixture.names(spark, d)), CONFIG, {"source": "lineitem", "top_n": CONFIG.top_n}, scanned=True)


@query("""
SELECT names.sci, de, count(gbifID)::BIGINT AS total, (SELECT count(*) FROM s WHERE s.sci = names.sci)::BIGINT AS sampled_total, (SELECT min(lat) FROM s WHERE s.sci = names.sci) AS min_lat,
       'Germany' AS region, 51.0::DOUBLE AS center_lat, 'lineitem' AS source, 250::BIGINT AS top_n, (SELECT count(*) FROM f WHERE sci IN (SELECT sci FROM names))::BIGINT AS scanned_rows
FROM names LEFT JOIN f USING (sci) GROUP BY names.sci, de
""")
def doc_envelope(spark: SparkSession, d: str) -> DataFrame:
    """The document, read back: one row for each species, with the document's own fields."""
    whole = _envelope(spark, d)
    own = lambda path, kind: F.get_json_object("value", f"$.{path}").cast(kind)
    fields = whole.select(own("region.name", "string").alias("region"), own("region.center.lat", "double").alias("center_lat"), own("meta.source", "string").alias("source"), own("meta.top_n", "bigint").alias("top_n"), own("meta.scanned_rows", "bigint").alias("scanned_rows"))
    of = lambda path, kind: F.get_json_object("profile", f"$.{path}").cast(kind)
    species = files.document_species(whole).select("sci", of("de", "string").alias("de"), stats.number("total").alias("total"), stats.number("sampled_total").alias("sampled_total"), of("bbox[0]", "double").alias("min_lat"))
    return species.join(F.broadcast(fields), F.lit(True))  # fields are one row


@query("SELECT names.sci, count(gbifID)::BIGINT AS total, (SELECT count(*) FROM s WHERE s.sci = names.sci)::INT AS points FROM names LEFT JOIN f USING (sci) GROUP BY names.sci")
def doc_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = files.write_document(_envelope(spark, d), files.scratch(spark), gzip=True)
    back = files.read_document(spark, path.removesuffix(".gz"))
    return back.select("sci", stats.number("total").alias("total"), F.json_array_length(F.get_json_object("profile", "$.points")).alias("points"))


@query("""
SELECT names.sci, de, count(gbifID)::BIGINT AS total, (SELECT count(*) FROM s WHERE s.sci = names.sci)::INT AS points, 'lineitem' AS source,
       (SELECT count(*) FROM names)::BIGINT AS species, (SELECT count(*) FROM f WHERE sci IN (SELECT sci FROM names))::BIGINT AS scanned_rows
FROM names LEFT JOIN f USING (sci) GROUP BY names.sci, de
""")
def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    """A profile a line, in several compressed files, read back with what the marker says."""
    path = files.scratch(spark)
    told = files.write_lines(profiles.profile_json(profiles.sparse(_occ(spark, d), CONFIG, fixture.names(spark, d))).repartition(5, "sci"), path, {"source": "lineitem"}, gzip=True)
    assert told == files.document_info(spark, path)
    said = [F.lit(told["source"]).alias("source"), *[F.lit(told[k]).cast("bigint").alias(k) for k in ("species", "scanned_rows")]]
    of = lambda path, kind: F.get_json_object("profile", f"$.{path}").cast(kind)
    return files.read_document(spark, path).select("sci", of("de", "string").alias("de"), stats.number("total").alias("total"), F.json_array_length(F.get_json_object("profile", "$.points")).alias("points"), *said)


@query("SELECT count(DISTINCT sci)::BIGINT AS plants, count(*)::BIGINT AS sampled_points_total FROM s")
def stats_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.counts(_sparse_json(spark, d))


@query("SELECT sci, count(*)::BIGINT AS total FROM f GROUP BY sci ORDER BY total DESC, sci LIMIT 50")
def stats_top(spark: SparkSession, d: str) -> DataFrame:
    return stats.top(_sparse_json(spark, d))


@query("SELECT y::VARCHAR AS y, count(*)::BIGINT AS n FROM s GROUP BY ALL")
def stats_year_global(spark: SparkSession, d: str) -> DataFrame:
    return stats.years(_sparse_json(spark, d))


@query("SELECT sci, count(DISTINCT cell)::BIGINT AS cells_total, (SELECT count(DISTINCT cell) FROM s WHERE s.sci = f.sci)::BIGINT AS cells, (SELECT count(DISTINCT cell) FROM s WHERE s.sci = f.sci)::DOUBLE / count(DISTINCT cell) AS ratio FROM f GROUP BY sci")
def stats_coverage(spark: SparkSession, d: str) -> DataFrame:
    return stats.coverage(_sample(spark, d), aggregate.with_cell(_rows(spark, d)))


def _with_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose total is that of the sample, with all rows and covered cells beside it."""
    covered = stats.coverage(_sample(spark, d), aggregate.with_cell(_rows(spark, d)))
    both = covered.join(select.totals(_rows(spark, d)), "sci").join(_sample(spark, d).groupBy("sci").agg(F.count(F.lit(1)).alias("kept")), "sci")
    fields = F.struct(F.col("kept").alias("total"), F.col("n").alias("total_raw"), F.col("cells").alias("coverage_cells"), F.col("cells_total").alias("coverage_cells_total"))
    return both.select("sci", F.to_json(fields).alias("profile"))


_COVERAGE = """
SELECT f.sci, (SELECT count(*) FROM s WHERE s.sci = f.sci)::BIGINT AS total, count(*)::BIGINT AS total_raw,
       (SELECT count(DISTINCT cell) FROM s WHERE s.sci = f.sci)::DOUBLE / count(DISTINCT cell) AS coverage
FROM f GROUP BY f.sci
"""


@query(_COVERAGE)
def stats_rollup(spark: SparkSession, d: str) -> DataFrame:
    return stats.rollup(_with_coverage(spark, d))


@query(f"SELECT count(*)::BIGINT AS plants, sum(total)::BIGINT AS total, sum(total_raw)::BIGINT AS total_raw FROM ({_COVERAGE})")
def stats_totals(spark: SparkSession, d: str) -> DataFrame:
    return stats.totals(_with_coverage(spark, d))


@query("""
SELECT row_number() OVER (ORDER BY total DESC, sci)::INT AS nth, sci, total, (SELECT count(DISTINCT sci) FROM s)::BIGINT AS plants, (SELECT count(*) FROM s)::BIGINT AS sampled_points_total
FROM (SELECT sci, count(*)::BIGINT AS total FROM f GROUP BY sci ORDER BY total DESC, sci LIMIT 50)
""")
def stats_summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary, written and read back: a row for each species that it lists."""
    path = daily.write_summary(_sparse_json(spark, d), {"source": "lineitem"}, files.scratch(spark))
    shape = "counts struct<plants:bigint,sampled_points_total:bigint>, top_by_total array<struct<sci:string,total:bigint>>"
    back = spark.read.text(path, wholetext=True).select(F.from_json("value", shape).alias("v"))
    return back.select(F.posexplode("v.top_by_total").alias("nth", "t"), "v.counts").select((F.col("nth") + 1).alias("nth"), "t.sci", "t.total", "counts.plants", "counts.sampled_points_total")


@query("""
, known AS (
  SELECT sci, de, key FROM names JOIN matches ON sci = name JOIN (SELECT p_name, min(p_partkey)::BIGINT AS key FROM part GROUP BY p_name) ON sci = p_name WHERE matchType = 'EXACT' AND confidence = 80
), old AS (
  SELECT * FROM raw WHERE y < 1999 QUALIFY row_number() OVER (PARTITION BY gbifID ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1
), fresh AS (
  SELECT * FROM raw WHERE gbifID IN (SELECT gbifID FROM raw WHERE lat IS NOT NULL AND lon IS NOT NULL AND taxonKey IN (SELECT key FROM known) AND lastInterpreted >= '1998-12-29')
  QUALIFY row_number() OVER (PARTITION BY gbifID ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1
), stored AS (
  SELECT * FROM fresh UNION ALL SELECT * FROM old WHERE gbifID NOT IN (SELECT gbifID FROM fresh)
), g AS (
  SELECT * FROM stored WHERE lat IS NOT NULL AND lon IS NOT NULL
)
SELECT known.sci, de, count(gbifID)::BIGINT AS total, min_by(taxonKey, gbifID) FILTER (taxonKey IS NOT NULL) AS taxonKey, max(y)::BIGINT AS last_year, '2001-12-31' AS since, (SELECT count(*) FROM stored)::BIGINT AS stored
FROM known LEFT JOIN g USING (sci) GROUP BY known.sci, de
""")
def daily_update(spark: SparkSession, d: str) -> DataFrame:
    """The exported profiles after an update of a store that holds the years before 1999, with its date and size."""
    names = fixture.names(spark, d)
    # match records carry keys of parts, so that rows of the fixture have them
    parts = spark.read.parquet(f"{d}/part.parquet").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("usageKey"))
    known = fixture.matches(names).filter("matchType = 'EXACT' AND confidence = '80'").drop("usageKey").join(parts, "name")
    accepted = names.join(known, F.col("sci") == F.col("name"), "left_semi")
    store, raw = Store(spark, files.scratch(spark)), fixture.raw(spark, d)
    store.apply(raw.filter("year < 1999"), order=fixture.latest(), since="1998-12-31")
    made = daily.update(store, raw, accepted, known, CONFIG, "2001-12-31", files.scratch(spark), order=fixture.latest())
    of = lambda path, kind: F.get_json_object("profile", f"$.{path}").cast(kind)
    return made.select(
        "sci", of("de", "string").alias("de"), stats.number("total").alias("total"), of("taxonKey", "bigint").alias("taxonKey"), of("last_obs.year", "bigint").alias("last_year"),
        F.lit(store.state()["since"]).alias("since"), F.lit(store.read().count()).cast("bigint").alias("stored"),
    )
