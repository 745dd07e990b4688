"""Species profiles: dense (all rows, quota sample) and sparse (newest in each cell)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thicket.functions import scalars as fn
from thicket.operators import aggregate, sampling, select
from thicket.sources.files import checkpoint


@dataclass(frozen=True)
class Config:
    country: str | None = None
    year_from: int | None = None
    year_to: int | None = None
    top_n: int = 250
    precision: int = 5
    keep_per_cell: int = 6
    max_points: int = 700
    points: int = 900
    min_per_cell: int = 1
    max_per_cell: int = 30
    overlap_days: int = 2
    require_coordinate: bool = True
    region: str = "Germany"
    center: tuple[float, float] = field(default=(51.0, 10.0))


def _filtered(df: DataFrame, c: Config, year_on: str | None = "year") -> DataFrame:
    df = select.base_filter(df, c.country)
    return select.year_filter(df, c.year_from, c.year_to, year_on) if year_on else df


def _last(last: str) -> Column:
    return fn.last_obs(F.col(f"{last}.y"), F.col(f"{last}.m"))


def attach_names(df: DataFrame, names: DataFrame | None) -> DataFrame:
    """de: the common name, empty without one."""
    if names is None:
        return df.withColumn("de", F.lit(""))
    return df.join(names.select("sci", "de"), "sci", "left").withColumn("de", F.coalesce("de", F.lit("")))


def attach_images(df: DataFrame, images: DataFrame | None) -> DataFrame:
    """image: JSON text, NULL without one."""
    return df.withColumn("image", F.lit(None).cast("string")) if images is None else df.join(images, "sci", "left")


def dense(df: DataFrame, c: Config = Config(top_n=50), names: DataFrame | None = None, images: DataFrame | None = None, year_on: str = "year") -> DataFrame:
    """One row for each of the most frequent species, aggregates over all of its rows, and a quota sample of points.

    Rows are read once for the grain, of which totals, histograms, boxes and cell counts are sums, and once for points
    (and once more if a cell is so large that its rows are ranked in parts).
    """
    rows = _filtered(df, c, year_on)
    grain = checkpoint(aggregate.grain(rows, c.precision))
    grain = select.whitelist(grain, select.most_frequent(aggregate.grain_totals(grain), c.top_n))
    whole, years = aggregate.grain_aggregates(grain), aggregate.year_pairs(aggregate.grain_years(grain))
    sample = sampling.quota_sample(aggregate.with_cell(rows, c.precision), aggregate.grain_cells(grain), c.points, c.min_per_cell, c.max_per_cell)
    sample = sampling.cut_to_target(sample, c.points)
    points = sample.groupBy("sci").agg(F.sort_array(F.collect_list(F.struct("rank", "lat", "lon", "y", fn.valid_month(F.col("m")).alias("m")))).alias("points"))
    out = whole.join(years, "sci", "left").join(points, "sci", "left")
    out = attach_images(attach_names(out, names), images)
    return out.select("sci", "de", "taxonKey", "total", F.coalesce("year_counts", F.array()).alias("year_counts"), "month_counts_all", _last("last").alias("last_obs"), "bbox", F.coalesce("points", F.array()).alias("points"), "image")


def sparse(df: DataFrame, c: Config = Config(), names: DataFrame | None = None, images: DataFrame | None = None, year_on: str | None = "year") -> DataFrame:
    """One row for each name of the whitelist, or for each of the most frequent species, aggregates over the sample of newest rows.

    Rows are read once for totals and taxon keys and once for the sample (and before, to choose species where no names are given).
    """
    rows = _filtered(df, c, year_on)
    chosen = (select.first_names(names, c.top_n) if names is not None else select.top_species(rows, c.top_n)).select("sci")
    rows = select.whitelist(rows, chosen)
    whole = rows.groupBy("sci").agg(F.count(F.lit(1)).alias("total"), aggregate.taxon_key().alias("taxonKey"))
    kept = aggregate.kept_aggregates(sampling.sparse_sample(rows, c.precision, c.keep_per_cell, c.max_points))
    kept = kept.withColumn("year_counts", aggregate.point_years("points"))
    out = chosen.join(kept, "sci", "left").join(whole, "sci", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    out = attach_images(attach_names(out, names), images)
    zeros = F.array_repeat(F.lit(0).cast("bigint"), 12)
    return out.select(
        "sci", "de", "taxonKey", "total", F.coalesce("year_counts", F.array()).alias("year_counts"), F.coalesce("month_counts_all", zeros).alias("month_counts_all"),
        _last("last").alias("last_obs"), "bbox", F.coalesce("points", F.array()).alias("points"), F.coalesce("sampled_total", F.lit(0)).alias("sampled_total"), "image",
    )


def profile_json(profiles: DataFrame, *others: str) -> DataFrame:
    """sci, profile (and other columns): each profile as compact JSON text, one row for each species, which is the output at scale.

    Points mix reals, whole numbers and nulls, so they are arrays of variants. image is there only if there is one.
    """
    v = lambda x: x.cast("variant")
    points = F.transform("points", lambda p: F.array(v(p["lat"]), v(p["lon"]), v(p["y"]), v(p["m"])))
    sparse_form = "sampled_total" in profiles.columns
    years = (
        F.map_from_entries(F.transform("year_counts", lambda p: F.struct(p["y"].cast("string"), p["n"])))
        if sparse_form
        else F.transform("year_counts", lambda p: F.array(p["y"].cast("bigint"), p["n"]))
    )
    fields = ["de", "taxonKey", "total", years.alias("year_counts"), "month_counts_all", "last_obs", "bbox", points.alias("points")] + ["sampled_total"] * sparse_form
    options = {"ignoreNullFields": "false"}
    plain = F.to_json(F.struct(*fields), options)
    pictured = F.to_json(F.struct(*fields, F.parse_json("image").alias("image")), options)
    return profiles.select("sci", F.when(F.col("image").isNull(), plain).otherwise(pictured).alias("profile"), *others)


def envelope(profiles: DataFrame, c: Config, meta: dict, dense_form: bool = False, scanned: bool = False) -> DataFrame:
    """One row: value, the whole document as JSON text. An export of hundreds of species; files.write_lines is the form for more.

    scanned adds scanned_rows to meta: the rows of the species, which are the sum of their totals, so that nothing is read again.
    """
    quoted = F.to_json(F.array("sci"))
    entry = F.concat(F.substr(quoted, F.lit(2), F.length(quoted) - 2), F.lit(":"), F.col("profile"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("sci", entry.alias("e")))), lambda x: x["e"]), ",")
    plants = profile_json(profiles, "total").groupBy().agg(joined.alias("plants"), F.coalesce(F.sum("total"), F.lit(0)).alias("scanned_rows"))
    center = F.array(*map(F.lit, c.center)) if dense_form else F.struct(F.lit(c.center[0]).alias("lat"), F.lit(c.center[1]).alias("lon"))
    options = {"ignoreNullFields": "false"}
    region = F.to_json(F.struct(F.lit(c.region).alias("name"), center.alias("center")), options)
    info = F.to_json(F.struct(*[F.lit(x).alias(k) for k, x in meta.items()], *["scanned_rows"] * scanned), options)
    parts = [F.lit('{"region":'), region, F.lit(',"plants":{'), F.col("plants"), F.lit('},"meta":'), info, F.lit("}")]
    if dense_form:
        parts = [F.lit('{"meta":'), info, F.lit(',"region":'), region, F.lit(',"plants":{'), F.col("plants"), F.lit("}}")]
    return plants.select(F.concat(*parts).alias("value"))
