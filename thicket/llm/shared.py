"""Small helpers that several operators use: checkpoints, folds, hot-safe ranks."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one key that are ranked together at most, about.
RANK_CELL = 1000


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder that the cluster names in spark.checkpoint.dir.

    A folder of our own is set only where the session has none, as in tests; on a cluster that is an error.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts go to Python workers in batches of so many rows, which bounds what a batch takes in either."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def others(df: DataFrame, *taken: str) -> list[str]:
    """Columns of df but those with a taken name; names are told apart as Spark does, without regard to case."""
    low = {t.lower() for t in taken}
    return [c for c in df.columns if c.lower() not in low]


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as make it none of df's columns."""
    while len(others(df, name)) < len(df.columns):
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo folds (null keys: fold of the empty text)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def hash_sample(df: DataFrame, key: str, rows: int, salt: int = 29) -> DataFrame:
    """About rows of the rows (all, if there are no more), chosen by a hash of the key; nothing is sorted or gathered."""
    n = df.select(key).count()
    share = 1.0 if n <= rows else rows / n
    return df.filter(F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 30)) < int(share * (1 << 30)))


def mark_likely(df: DataFrame, key: str, ids: DataFrame, out: str) -> DataFrame:
    """Mark the rows of df whose key may be among ids (which have a column key): all that are, and few others.

    ids become bits of 2**23, at most 256 rows of 4 KB whatever their number, so that the side that is broadcast is bounded;
    rows that are not marked need no shuffle to be told apart.
    """
    bucket, held = free_name(df, "_bucket"), free_name(df, "_bits")
    place = f"pmod(xxhash64(`{key}`), {1 << 23})"
    bits = ids.select(F.expr(f"bitmap_bucket_number({place})").alias(bucket), F.expr(f"bitmap_bit_position({place})").alias("_bit"))
    bits = bits.groupBy(bucket).agg(F.bitmap_construct_agg("_bit").alias(held))
    at = f"bitmap_bit_position({place})"
    there = F.expr(f"((cast(conv(hex(substring(`{held}`, cast({at} div 8 as int) + 1, 1)), 16, 10) as int) >> cast({at} % 8 as int)) & 1) = 1")
    found = df.withColumn(bucket, F.expr(f"bitmap_bucket_number({place})")).join(F.broadcast(bits), bucket, "left")
    return found.withColumn(out, F.coalesce(there, F.lit(False))).select(*df.columns, out)


def hot_rank(df: DataFrame, keys: list[str], n: str, order: list[str], salt: str, out: str) -> DataFrame:
    """Rank rows from 0 within keys, where a key may hold any share of the rows.

    n names a column with the number of rows of the key; salt one with a
    deterministic long hash of the row. Large keys are cut into cells of about
    RANK_CELL rows by the salt; cells are counted, their counts accumulated, and
    rows ranked inside their own cell only. Ranks are dense and do not depend on
    how rows are partitioned; rows equal in all order columns are interchangeable.
    """
    cell = F.pmod(F.col(salt), F.greatest(F.ceil(F.col(n) / RANK_CELL), F.lit(1)))
    df = df.withColumn("_cell", cell)
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        df.filter(F.col(n) > RANK_CELL)
        .groupBy(*keys, "_cell")
        .agg(F.count(F.lit(1)).alias("_in"))
        .select(*keys, "_cell", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"))
    )
    ranked = df.withColumn("_at", F.row_number().over(Window.partitionBy(*keys, "_cell").orderBy(*order)) - 1)
    return (
        ranked.join(counts, [*keys, "_cell"], "left")
        .withColumn(out, (F.col("_at") + F.coalesce("_before", F.lit(0))).cast("long"))
        .drop("_cell", "_at", "_before")
    )
