"""Which rows and which species."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def base_filter(df: DataFrame, country: str | None = None) -> DataFrame:
    """Rows with coordinates, of one country if any is given."""
    df = df.filter("lat IS NOT NULL AND lon IS NOT NULL")
    return df.filter(F.col("country") == country) if country else df


def year_filter(df: DataFrame, first: int | None = None, last: int | None = None, on: str = "year") -> DataFrame:
    """Rows of the years first to last, either end open; on="eventDate" compares the first four characters as text."""
    year, kind = (F.col("y"), int) if on == "year" else (F.substring("eventDate", 1, 4), str)
    for bound, test in ((first, year.__ge__), (last, year.__le__)):
        if bound is not None:
            df = df.filter(test(F.lit(kind(bound))))
    return df


def year_filter_for(columns: list[str], dense: bool = True) -> str | None:
    """What a year filter works on: the year, else the event date in dense profiles, which fail without either; nothing in sparse ones."""
    if "year" in columns:
        return "year"
    if not dense:
        return None
    if not {"eventDate", "event_date"} & set(columns):
        raise ValueError("a year filter needs a year or an event date")
    return "eventDate"


def top_species(df: DataFrame, n: int) -> DataFrame:
    """sci, n of the most frequent species, ties by name. A missing or empty name uses up a place and is dropped afterwards."""
    return most_frequent(totals(df), n)


def most_frequent(counts: DataFrame, n: int) -> DataFrame:
    """top_species of counts: sci, n."""
    return counts.orderBy(F.desc("n"), F.col("sci").asc_nulls_first()).limit(n).filter("sci <> ''")


def first_names(names: DataFrame, n: int) -> DataFrame:
    """The first n names (one at least) in file order, each once."""
    return names.filter(F.col("ord") < max(1, n)).dropDuplicates(["sci"])


def whitelist(df: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of the species in names. The list is a dictionary file or a top-n result; Spark broadcasts it if it is small."""
    return df.join(names.select("sci"), "sci", "left_semi")


def totals(df: DataFrame) -> DataFrame:
    return df.groupBy("sci").agg(F.count(F.lit(1)).alias("n"))


#: Keys of the predicate tree and the columns they test.
PREDICATE_KEYS = {"COUNTRY": "country", "TAXON_KEY": "taxonKey", "YEAR": "y", "LAST_INTERPRETED": "lastInterpreted"}


def predicate(tree: dict) -> Column:
    """A tree of and / equals / in / greaterThanOrEquals / lessThanOrEquals as a column; Spark pushes it down to the scan."""
    if tree["type"] == "and":
        return reduce(Column.__and__, (predicate(p) for p in tree["predicates"]), F.lit(True))
    if tree["key"] == "HAS_COORDINATE":
        there = F.col("lat").isNotNull() & F.col("lon").isNotNull()
        return there if str(tree["value"]).lower() == "true" else ~there
    column = F.col(PREDICATE_KEYS[tree["key"]])
    kind = int if tree["key"] in ("TAXON_KEY", "YEAR") else str
    if tree["type"] == "in":
        return column.isin([kind(v) for v in tree["values"]])
    tests = {"equals": column.__eq__, "greaterThanOrEquals": column.__ge__, "lessThanOrEquals": column.__le__}
    return tests[tree["type"]](F.lit(kind(tree["value"])))


def delta_tree(since: str, country: str | None = None, years: tuple[int | None, int | None] = (None, None), keys: list[int] | None = None, require_coordinate: bool = True) -> dict:
    """The predicate tree of a delta; keys may be None if they come as a table (see delta_rows)."""
    leaf = lambda kind, key, value: {"type": kind, "key": key, "value": str(value)}
    parts = [leaf("equals", "HAS_COORDINATE", "true")] if require_coordinate else []
    parts += [leaf("equals", "COUNTRY", country)] if country else []
    if keys is not None:
        if not keys:
            raise ValueError("no taxon keys")
        parts.append({"type": "in", "key": "TAXON_KEY", "values": [str(k) for k in keys]})
    parts += [leaf(kind, "YEAR", y) for kind, y in zip(("greaterThanOrEquals", "lessThanOrEquals"), years, strict=True) if y is not None]
    return {"type": "and", "predicates": [*parts, leaf("greaterThanOrEquals", "LAST_INTERPRETED", since)]}


def delta_rows(df: DataFrame, tree: dict, taxa: DataFrame | None = None) -> DataFrame:
    """Rows that the tree accepts, of the taxon keys in taxa if that is given."""
    df = df.filter(predicate(tree))
    return df if taxa is None else df.join(taxa.filter("taxonKey IS NOT NULL").select("taxonKey"), "taxonKey", "left_semi")


def since(state: Column, overlap_days: int | Column = 2, today: Column | None = None) -> Column:
    """The date as text from which a delta is read: the state's date less the overlap (no less than 0 days); today if it is no date."""
    day = F.coalesce(F.try_to_date(F.substring(state, 1, 10)), today if today is not None else F.current_date())
    days = F.lit(overlap_days) if isinstance(overlap_days, int) else overlap_days
    return F.date_format(F.date_sub(day, F.greatest(days, F.lit(0))), "yyyy-MM-dd")


