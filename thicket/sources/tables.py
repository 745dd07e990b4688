"""Finding the occurrence table and its columns by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.functions import scalars as fn

#: Table names in order of preference, and the aliases of each logical column.
TABLES = ["occ", "occurrence", "occurrences", "gbif_occurrence", "gbif_occurrences"]
LATITUDES = ["decimalLatitude", "lat", "latitude"]
LONGITUDES = ["decimalLongitude", "lon", "longitude"]
NAMES = ["species", "scientificName", "speciesName", "taxon_name"]
SCORED = [(2, LATITUDES), (2, LONGITUDES), (2, ["scientificName", "species", "speciesName", "taxon_name"]), (1, ["year", "eventDate", "event_date"])]
OPTIONAL = {"taxonKey": ["taxonKey", "taxon_key"], "y": ["year"], "m": ["month"], "country": ["countryCode", "country_code", "country"], "eventDate": ["eventDate", "event_date"], "lastInterpreted": ["lastInterpreted"]}
LEAST_SCORE = 4


def pick_table(tables: dict[str, list[str]]) -> str:
    """The preferred table, else that with the best columns, the first of equals."""
    for name in TABLES:
        if name in tables:
            return name
    scores = {name: sum(points for points, names in SCORED if set(names) & set(columns)) for name, columns in tables.items()}
    best = max(scores, key=scores.get, default=None)
    if best is None or scores[best] < LEAST_SCORE:
        raise ValueError(f"no occurrence table among {list(tables)}")
    return best


def catalog_tables(spark: SparkSession) -> dict[str, list[str]]:
    return {t.name: [c.name for c in spark.catalog.listColumns(t.name)] for t in spark.catalog.listTables()}


def resolve(columns: list[str], names: list[str], required: bool = True) -> str | None:
    for name in names:
        if name in columns:
            return name
    if required:
        raise ValueError(f"none of {names} among {columns}")
    return None


def normalize(df: DataFrame, order: str = "dense") -> DataFrame:
    """gbifID, sci, taxonKey, lat, lon, y, m, eventDate, country, lastInterpreted from whatever names df has.

    dense takes decimalLatitude before lat, sparse the other way round. In dense order a missing year or month comes from
    eventDate; else it is NULL. has_year and has_event say what there was.
    """
    names = lambda n: n if order == "dense" else [n[1], n[0], *n[2:]]
    found = {k: resolve(df.columns, v, required=False) for k, v in OPTIONAL.items()}
    event = F.col(found["eventDate"]) if found["eventDate"] else None

    def part(key: str, of) -> F.Column:
        if found[key]:
            return F.col(found[key]).cast("int")
        return of(event) if event is not None and order == "dense" else F.lit(None).cast("int")

    text = lambda k: F.col(found[k]).cast("string") if found[k] else F.lit(None).cast("string")
    return df.select(
        (F.col("gbifID") if "gbifID" in df.columns else F.lit(None)).cast("bigint").alias("gbifID"),
        F.col(resolve(df.columns, NAMES)).alias("sci"),
        (F.col(found["taxonKey"]) if found["taxonKey"] else F.lit(None)).cast("bigint").alias("taxonKey"),
        F.col(resolve(df.columns, names(LATITUDES))).cast("double").alias("lat"),
        F.col(resolve(df.columns, names(LONGITUDES))).cast("double").alias("lon"),
        part("y", fn.year_of).alias("y"),
        part("m", fn.month_of).alias("m"),
        text("eventDate").alias("eventDate"), text("country").alias("country"), text("lastInterpreted").alias("lastInterpreted"),
    )
