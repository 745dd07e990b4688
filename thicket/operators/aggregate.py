"""Aggregates by species, over all rows or over a sample. One grouped pass gives them all; each is map-side combined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thicket.functions import scalars as fn


def month_counts(month: str = "m") -> Column:
    """Twelve counts, January first."""
    return F.array(*[F.count_if(F.col(month) == k) for k in range(1, 13)])


def bbox() -> Column:
    """Least and greatest latitude, least and greatest longitude."""
    return F.array(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon"))


def last_obs_full() -> Column:
    """The greatest (year, valid month or 0) of rows with a year."""
    return F.max(F.when(F.col("y").isNotNull(), F.struct(F.col("y").alias("y"), F.coalesce(fn.valid_month(F.col("m")), F.lit(0)).alias("m"))))


def last_obs_kept() -> Column:
    """Year and valid month of the first row with a year, in keep order."""
    return F.min_by(F.struct(F.col("y").alias("y"), fn.valid_month(F.col("m")).alias("m")), F.when(F.col("y").isNotNull(), F.col("rank")))


def taxon_key() -> Column:
    """The taxon key of the row with the least identifier that has one."""
    return F.min_by("taxonKey", F.when(F.col("taxonKey").isNotNull(), F.col("gbifID")))


def year_counts(df: DataFrame) -> DataFrame:
    """sci, y, n; rows without a year don't count."""
    return df.filter("y IS NOT NULL").groupBy("sci", "y").agg(F.count(F.lit(1)).alias("n"))


def year_pairs(counts: DataFrame, newest_first: bool = False) -> DataFrame:
    """sci, year_counts: an array of (y, n) by year."""
    return counts.groupBy("sci").agg(F.sort_array(F.collect_list(F.struct("y", "n")), asc=not newest_first).alias("year_counts"))


def point_years(points: str) -> Column:
    """An array of (y, n), newest first, of the years of a sample's points, of which a species has some hundreds at most."""
    years = F.array_distinct(F.filter(F.transform(points, lambda p: p["y"]), lambda y: y.isNotNull()))
    return F.transform(F.sort_array(years, asc=False), lambda y: F.struct(y.alias("y"), F.size(F.filter(points, lambda p: p["y"] == y)).cast("bigint").alias("n")))


def cell_counts(df: DataFrame, precision: int = 5) -> DataFrame:
    """sci, cell, n."""
    return with_cell(df, precision).groupBy("sci", "cell").agg(F.count(F.lit(1)).alias("n"))


def with_cell(df: DataFrame, precision: int = 5) -> DataFrame:
    """df with the geohash cell of each point, NULL without coordinates. Places on the axes are columns of their own, computed once."""
    x, y = fn.geohash_axes(F.col("lat"), F.col("lon"), precision)
    df = df.withColumns({"_x": x, "_y": y})
    there = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return df.withColumn("cell", F.when(there, fn.geohash_digits(F.col("_x"), F.col("_y"), precision))).drop("_x", "_y")


def grain(df: DataFrame, precision: int = 5) -> DataFrame:
    """One row for each species, cell and year, with counts and extremes from which all aggregates of a dense profile follow.

    sci, cell, y, n, m1 to m12 (rows of each month), last_m (the greatest valid month, or 0), lo, hi (the range of identifiers'
    places), min_lat, max_lat, min_lon, max_lon, first_id, taxon (the least identifier with a taxon key, and that key). All are
    numbers, so that rows are combined before the shuffle.
    """
    place = fn.place_of(F.col("gbifID"))
    keyed = F.when(F.col("taxonKey").isNotNull(), F.col("gbifID"))
    return with_cell(df, precision).groupBy("sci", "cell", "y").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("m") == k).alias(f"m{k}") for k in range(1, 13)], F.max(F.coalesce(fn.valid_month(F.col("m")), F.lit(0))).alias("last_m"),
        F.min(place).alias("lo"), F.max(place).alias("hi"), F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"), F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
        F.min(keyed).alias("first_id"), F.min_by("taxonKey", keyed).alias("taxon"),
    )


def grain_totals(grain: DataFrame) -> DataFrame:
    """sci, n."""
    return grain.groupBy("sci").agg(F.sum("n").alias("n"))


def grain_cells(grain: DataFrame) -> DataFrame:
    """sci, cell, n, lo, hi."""
    return grain.groupBy("sci", "cell").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def grain_years(grain: DataFrame) -> DataFrame:
    """sci, y, n; rows without a year don't count."""
    return grain.filter("y IS NOT NULL").groupBy("sci", "y").agg(F.sum("n").alias("n"))


def grain_aggregates(grain: DataFrame) -> DataFrame:
    """sci, total, month_counts_all, last, bbox, taxonKey, as full_aggregates has them."""
    months = F.array(*[F.sum(f"m{k}") for k in range(1, 13)])
    last = F.max(F.when(F.col("y").isNotNull(), F.struct("y", F.col("last_m").alias("m"))))
    box = F.array(F.min("min_lat"), F.max("max_lat"), F.min("min_lon"), F.max("max_lon"))
    return grain.groupBy("sci").agg(F.sum("n").alias("total"), months.alias("month_counts_all"), last.alias("last"), box.alias("bbox"), F.min_by("taxon", "first_id").alias("taxonKey"))


def full_aggregates(df: DataFrame) -> DataFrame:
    """sci, total, month_counts_all, last, bbox, taxonKey over all rows."""
    return df.groupBy("sci").agg(F.count(F.lit(1)).alias("total"), month_counts().alias("month_counts_all"), last_obs_full().alias("last"), bbox().alias("bbox"), taxon_key().alias("taxonKey"))


def kept_aggregates(df: DataFrame) -> DataFrame:
    """sci, sampled_total, month_counts_all, last, bbox, points over a ranked sample."""
    point = F.struct("rank", "lat", "lon", "y", fn.valid_month(F.col("m")).alias("m"))
    return df.groupBy("sci").agg(
        F.count(F.lit(1)).alias("sampled_total"), month_counts().alias("month_counts_all"), last_obs_kept().alias("last"), bbox().alias("bbox"), F.sort_array(F.collect_list(point)).alias("points")
    )
