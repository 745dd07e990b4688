"""Names and their match records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accepted(match_type: Column, confidence: Column) -> Column:
    """EXACT with a confidence of 80, or HIGHERRANK with 90; a confidence that is no number is 0."""
    kind = F.upper(F.coalesce(match_type, F.lit("")))
    sure = F.coalesce(confidence.cast("string").try_cast("int"), F.lit(0))
    return ((kind == "EXACT") & (sure >= 80)) | ((kind == "HIGHERRANK") & (sure >= 90))


def clean(names: DataFrame) -> DataFrame:
    """sci and de without blanks around them; nameless rows are dropped."""
    return names.withColumn("sci", F.trim("sci")).withColumn("de", F.trim(F.coalesce("de", F.lit("")))).filter("sci <> ''")


def resolve(names: DataFrame, matches: DataFrame, allow_fuzzy: bool = False) -> DataFrame:
    """scientificName, de, taxonKey, match, ok for each name. matches has name, usageKey and the fields of the record."""
    m = matches.withColumnRenamed("scientificName", "matchedName")
    found = clean(names).join(m, F.col("sci") == F.col("name"), "left")
    ok = F.col("usageKey").isNotNull() if allow_fuzzy else accepted(F.col("matchType"), F.col("confidence"))
    record = F.struct("matchType", "confidence", "canonicalName", F.col("matchedName").alias("scientificName"), "rank", "status")
    return found.select(F.col("sci").alias("scientificName"), "de", F.col("usageKey").alias("taxonKey"), record.alias("match"), ok.alias("ok")).orderBy(F.lower("scientificName"), "scientificName")


def missing(names: DataFrame, matches: DataFrame) -> DataFrame:
    """Names without any match record."""
    return clean(names).join(matches, F.col("sci") == F.col("name"), "left_anti").select("sci")


def unresolved(resolved: DataFrame) -> DataFrame:
    """Names that were not accepted or have no key, with the kind of their match."""
    return resolved.filter(~F.col("ok") | F.col("taxonKey").isNull()).select("scientificName", F.coalesce(F.nullif("match.matchType", F.lit("")), F.lit("NONE")).alias("matchType"))


def require_resolved(resolved: DataFrame) -> None:
    """Fail if a name is unresolved, listing all of them (names of one list); to be called after the outputs are written."""
    if some := unresolved(resolved).orderBy("scientificName").collect():
        raise ValueError(f"unresolved names: {[tuple(r) for r in some]}")


def keys(resolved: DataFrame) -> DataFrame:
    """Distinct taxon keys; none at all is an error."""
    found = resolved.filter("taxonKey IS NOT NULL").select("taxonKey").distinct()
    if not found.limit(1).count():
        raise ValueError("no taxon keys")
    return found
