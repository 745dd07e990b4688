"""The daily update: resolve names, take the delta, upsert, export, move the state, summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thicket.operators import select, stats, taxa
from thicket.plans import profiles
from thicket.sources import files
from thicket.sources.store import Store
from thicket.sources.tables import normalize


def update(store: Store, delta: DataFrame, names: DataFrame, matches: DataFrame, config: profiles.Config, today: str, out: str, order: list | None = None, mode: str = "all", stats_enabled: bool = True) -> DataFrame | None:
    """Write the outputs of today's delta under out, and return the exported profiles: sci, profile (JSON text).

    delta has the columns of the store. Outputs, in this order: resolved (a table of names and matches), the store,
    profiles (a table) and occurrences.json.gz (one document), then the state's date, then stats_summary.json, made from
    the document. Names without an accepted match fail the run once resolved is written. An export that fails leaves the
    date, so that the next run takes the delta again. mode "db-only" stops after the upsert, "export-only" begins after it.
    """
    spark = delta.sparkSession
    if mode != "export-only":
        taxa.resolve(names, matches).write.mode("overwrite").json(f"{out}/resolved")
        resolved = spark.read.schema(taxa.resolve(names, matches).schema).json(f"{out}/resolved")
        taxa.require_resolved(resolved)
        last = store.state().get("since")
        since = spark.range(1).select(select.since(F.lit(last).cast("string"), config.overlap_days, F.to_date(F.lit(today)))).first()[0]
        tree = select.delta_tree(since, config.country, (config.year_from, config.year_to), require_coordinate=config.require_coordinate)
        wanted = normalize(delta, "sparse").select("gbifID", "sci", "taxonKey", "lat", "lon", "y", "m", "country", "lastInterpreted")
        accepted = select.delta_rows(wanted, tree, taxa.keys(resolved)).select("gbifID").distinct()
        store.apply(delta.join(accepted, "gbifID", "left_semi"), order=order)
    if mode == "db-only":
        return None
    made = profiles.sparse(normalize(store.read(), "sparse"), config, names)
    made.write.mode("overwrite").parquet(f"{out}/profiles")
    made = spark.read.parquet(f"{out}/profiles")
    meta = {"country": config.country, "year_from": config.year_from, "year_to": config.year_to}
    files.write_document(profiles.envelope(made, config, meta, scanned=True), f"{out}/occurrences.json", gzip=True)
    store.note(since=today)
    exported = files.read_document(spark, f"{out}/occurrences.json")
    if stats_enabled:
        write_summary(exported, {"source_occ_json": f"{out}/occurrences.json.gz"} | meta, f"{out}/stats_summary.json")
    return exported


def write_summary(species: DataFrame, meta: dict, path: str) -> str:
    """The summary of a document's species as a file."""
    return files.write_document(stats.summary(species, meta), path)
