"""Occurrences derived from the order tables: lineitem with part, supplier and nation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thicket.sources.store import upsert


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each line; identifiers repeat. part and supplier are dimension tables that Spark broadcasts by their size."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    lines = read("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    df = lines.join(read("part").select("p_partkey", "p_name", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    df = df.join(read("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    df = df.join(read("nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    odd = (F.col("l_orderkey") % 2) * F.lit(0.03)
    lat = F.lit(47.0) + ((F.col("l_suppkey") % 8) * (F.col("l_suppkey") % 3)) * F.lit(0.5) + odd
    return df.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("gbifID"),
        F.col("p_name").alias("species"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_partkey")).alias("taxonKey"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.col("n_name").alias("countryCode"),
        F.when(F.col("l_linenumber") != 7, lat).alias("lat"),
        (F.lit(6.0) + (F.col("l_partkey") % 9) * F.lit(1.0) + odd).alias("lon"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("eventDate"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("lastInterpreted"),
        "l_shipdate", "l_partkey", "l_suppkey",
    )


def latest() -> list[Column]:
    return [F.col("l_shipdate").desc(), F.col("l_partkey").desc(), F.col("l_suppkey").desc()]


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each identifier: the latest line of it."""
    return upsert(None, raw(spark, sf_dir), order=latest()).drop("l_shipdate", "l_partkey", "l_suppkey")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ord, sci, de: every second name by alphabet, and two names without rows."""
    found = spark.read.parquet(f"{sf_dir}/part.parquet").groupBy(F.col("p_name").alias("sci")).agg(F.min("p_partkey").alias("k"))
    ranked = found.withColumn("at", F.row_number().over(Window.orderBy("sci")) - 1)  # distinct names only
    own = ranked.filter("at % 2 = 0").select((F.col("at") / 2).cast("int").alias("ord"), "sci", F.concat(F.lit("de "), F.col("sci")).alias("de"))
    extra = ranked.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(*[F.struct((F.col("n") + k).cast("int").alias("ord"), F.lit(f"none {k}").alias("sci"), F.lit(f"de none {k}").alias("de")) for k in (0, 1)])).alias("x")).select("x.*")
    return own.unionByName(extra)


def matches(names_df: DataFrame) -> DataFrame:
    """A match record for each name, of a kind that depends on its place."""
    kinds = F.array(*map(F.lit, ["EXACT", "EXACT", "HIGHERRANK", "HIGHERRANK", "FUZZY"]))
    confidence = F.array(*map(F.lit, [80, 79, 90, 89, 99]))
    k = F.col("ord") % 5
    return names_df.filter("ord % 7 <> 6").select(
        F.col("sci").alias("name"), (F.col("ord") + 1000).cast("bigint").alias("usageKey"), kinds[k].alias("matchType"), confidence[k].cast("string").alias("confidence"),
        F.upper("sci").alias("canonicalName"), F.concat("sci", F.lit(" L.")).alias("scientificName"), F.lit("SPECIES").alias("rank"), F.lit("ACCEPTED").alias("status"),
    )
