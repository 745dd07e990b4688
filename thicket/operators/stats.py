"""Summaries of profile documents: rows of sci and profile (JSON text)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def number(field: str) -> F.Column:
    """A whole number of the profile, 0 if it is missing or none."""
    return F.coalesce(F.get_json_object("profile", f"$.{field}").try_cast("bigint"), F.lit(0))


def counts(species: DataFrame) -> DataFrame:
    """plants, sampled_points_total. Points are those of points, else of pointsSample."""
    size = lambda f: F.coalesce(F.json_array_length(F.get_json_object("profile", f"$.{f}")), F.lit(0))
    points = F.when(size("points") > 0, size("points")).otherwise(size("pointsSample"))
    return species.agg(F.count(F.lit(1)).alias("plants"), F.coalesce(F.sum(points), F.lit(0)).cast("bigint").alias("sampled_points_total"))


def top(species: DataFrame, n: int = 50) -> DataFrame:
    return species.select("sci", number("total").alias("total")).orderBy(F.desc("total"), "sci").limit(n)


def years(species: DataFrame) -> DataFrame:
    """y, n over all species. year_counts may be an object or an array of pairs."""
    text = F.get_json_object("profile", "$.year_counts")
    pairs = F.from_json(text, "array<array<bigint>>")
    as_object = species.filter(F.startswith(F.ltrim(text), F.lit("{"))).select(F.explode(F.from_json(text, "map<string,bigint>")).alias("y", "n"))
    as_pairs = species.filter(F.startswith(F.ltrim(text), F.lit("["))).select(F.explode(pairs).alias("p")).select(F.col("p")[0].cast("string").alias("y"), F.col("p")[1].alias("n"))
    return as_object.unionByName(as_pairs).groupBy("y").agg(F.sum("n").cast("bigint").alias("n"))


def totals(species: DataFrame) -> DataFrame:
    """One row: plants, and the sums of total and total_raw over all species."""
    sums = [F.coalesce(F.sum(number(c)), F.lit(0)).cast("bigint").alias(c) for c in ("total", "total_raw")]
    return species.agg(F.count(F.lit(1)).alias("plants"), *sums)


def rollup(species: DataFrame) -> DataFrame:
    """total, total_raw over all species, and the ratio of covered cells of each (0 without cells)."""
    cells, of = number("coverage_cells"), number("coverage_cells_total")
    return species.select("sci", number("total").alias("total"), number("total_raw").alias("total_raw"), F.when(of > 0, cells / of).otherwise(0.0).alias("coverage"))


def coverage(sample: DataFrame, rows: DataFrame) -> DataFrame:
    """sci, cells of the sample, cells of all rows, and their ratio; both inputs have cells."""
    part, whole = (df.groupBy("sci").agg(F.countDistinct("cell").alias(name)) for df, name in ((sample, "cells"), (rows, "cells_total")))
    both = whole.join(part, "sci", "left").select("sci", F.coalesce("cells", F.lit(0)).alias("cells"), "cells_total")
    return both.withColumn("ratio", F.when(F.col("cells_total") > 0, F.col("cells") / F.col("cells_total")).otherwise(0.0))


def summary(species: DataFrame, meta: dict | None = None, n: int = 50) -> DataFrame:
    """One row: value, the summary as JSON text with all parts."""
    best = top(species, n).groupBy().agg(F.sort_array(F.collect_list(F.struct((-F.col("total")).alias("o"), "sci", "total"))).alias("t"))
    listed = F.transform("t", lambda x: F.struct(x["sci"].alias("sci"), x["total"].alias("total")))
    info = F.struct(*[F.lit(v).alias(k) for k, v in (meta or {"source": None}).items()])
    both = counts(species).select(F.struct("plants", "sampled_points_total").alias("counts")).unionByName(best.select(listed.alias("top_by_total")), allowMissingColumns=True)
    whole = F.struct(info.alias("meta"), F.any_value("counts", True).alias("counts"), F.any_value("top_by_total", True).alias("top_by_total"))
    return both.groupBy().agg(F.to_json(whole, {"ignoreNullFields": "false", "pretty": "true"}).alias("value"))
