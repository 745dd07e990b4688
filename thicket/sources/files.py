"""Tab-separated archives and deltas, JSON side inputs, profile documents, metadata."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from thicket.functions import scalars as fn

#: Column names of the files, which are public field names of occurrence data.
ID_COLUMNS = ["gbifID", "id", "occurrenceID"]
SPECIES_COLUMNS = ["species", "acceptedScientificName", "canonicalName"]
TAXON_COLUMNS = ["taxonKey", "taxonID"]
DELTA_COLUMNS = ["gbifID", "scientificName", "taxonKey", "decimalLatitude", "decimalLongitude", "year", "month", "countryCode", "eventDate", "lastInterpreted"]
STORE_TEXTS = ["eventDate", "countryCode", "stateProvince", "basisOfRecord", "datasetKey", "license"]


def _scratch_top(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir), or a local one where there is no cluster."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        top = tempfile.gettempdir()
    return top.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A new folder path in the shared folder; sweep_scratch takes old ones away."""
    return f"{_scratch_top(spark)}/thicket-{uuid.uuid4().hex}"


def sweep_scratch(spark: SparkSession, hours: float = 24, now: float | None = None) -> list[str]:
    """Delete scratch folders last written to more than so many hours ago, whose readers should be done; their names.

    Times are the file system's, now too: that of a file that is written for it.
    """
    p, fs = _fs(spark, _scratch_top(spark))
    if not fs.exists(p):
        return []
    if now is None:
        clock, _ = _fs(spark, f"{_scratch_top(spark)}/thicket-clock-{uuid.uuid4().hex}")
        fs.create(clock, True).close()
        now = fs.getFileStatus(clock).getModificationTime() / 1000
        fs.delete(clock, True)
    newest = lambda s: max([s.getModificationTime(), *(x.getModificationTime() for x in fs.listStatus(s.getPath()))]) / 1000
    old = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("thicket-") and now - newest(s) > hours * 3600]
    for x in old:
        fs.delete(x, True)
    return [x.getName() for x in old]


def checkpoint(df: DataFrame) -> DataFrame:
    """The same rows, held in the folder that driver and executors share, without what they were made from."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch(spark))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The same rows from a table written in the scratch folder, for rows that are dear to make and read more than once."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of files in a folder that Spark has written, markers left out, and their bytes."""
    p, fs = _fs(spark, path)
    found = [s.getLen() for s in fs.listStatus(p) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    return len(found), sum(found)


def load_json(spark: SparkSession, path: str) -> dict | None:
    """The object in a small file, None if there is no such file; no job is run for it."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    into = fs.open(p)
    try:
        return json.loads(bytes(into.readAllBytes()).decode())
    finally:
        into.close()


def save_json(spark: SparkSession, path: str, content: dict) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(content, ensure_ascii=False).encode()))
    out.close()


def archive_file(spark: SparkSession, folder: str) -> str:
    """occurrence.txt if it is there, else the largest .txt file, else an error."""
    path, fs = _fs(spark, folder)
    found = {s.getPath().getName(): (s.getLen(), s.getPath().toString()) for s in fs.listStatus(path) if s.isFile()}
    if "occurrence.txt" in found:
        return found["occurrence.txt"][1]
    texts = [v for name, v in found.items() if name.lower().endswith(".txt")]
    if not texts:
        raise FileNotFoundError(f"no text file in {folder}")
    return max(texts, key=lambda v: v[0])[1]


def read_tsv(spark: SparkSession, path: str, quoted: bool = False) -> DataFrame:
    """All columns as text, with _file, _block and _line giving the order of rows in the source.

    Unquoted files can be split; in quoted ones a field may hold line breaks, so each is read by one task.
    """
    options = {"sep": "\t", "header": True, "quote": '"' if quoted else "", "mode": "PERMISSIVE", "encoding": "UTF-8"}
    if quoted:
        options |= {"escape": '"', "multiLine": True}
    return with_position(spark.read.options(**options).csv(path))


def with_position(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))


POSITION = ["_file", "_block", "_line"]


def _column(df: DataFrame, name: str) -> Column:
    """A column, or NULL text if the file has none of the name."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def read_archive(spark: SparkSession, path: str, keep_raw: bool = True, quoted: bool = False) -> DataFrame:
    """Rows of an archive in the form of the store; rows without an identifier are dropped."""
    df = read_tsv(spark, path, quoted)
    names = [c for c in df.columns if c not in POSITION]
    c = lambda name: _column(df, name)
    return df.select(
        fn.first_filled(*[c(n) for n in ID_COLUMNS]).alias("gbifID"),
        fn.filled(c("scientificName")).alias("scientificName"),
        fn.first_filled(*[c(n) for n in SPECIES_COLUMNS]).alias("species"),
        fn.to_int(fn.first_filled(*[c(n) for n in TAXON_COLUMNS])).alias("taxonKey"),
        *[fn.to_int(c(n)).alias(n) for n in ("year", "month", "day")],
        *[fn.filled(c(n)).alias(n) for n in STORE_TEXTS],
        fn.to_float(c("decimalLatitude")).alias("lat"),
        fn.to_float(c("decimalLongitude")).alias("lon"),
        (fn.raw_line([F.col(n) for n in names]) if keep_raw else F.lit("")).alias("raw_tsv"),
        *POSITION,
    ).filter("gbifID IS NOT NULL")


def read_delta(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a delta file; rows without identifier or coordinates are dropped. The ten columns must be there."""
    df = read_tsv(spark, path)
    missing = [n for n in DELTA_COLUMNS if n not in df.columns]
    if missing:
        raise ValueError(f"the delta lacks columns: {missing}")
    return delta_rows(df)


def delta_rows(df: DataFrame) -> DataFrame:
    """Text columns of a delta, typed; POSITION columns are kept where there are any."""
    return df.select(
        fn.parse_int(F.col("gbifID")).alias("gbifID"),
        fn.filled(F.col("scientificName")).alias("scientificName"),
        fn.parse_int(F.col("taxonKey")).alias("taxonKey"),
        *[fn.to_float(F.trim(F.col(n))).alias(n) for n in ("decimalLatitude", "decimalLongitude")],
        *[fn.parse_int(F.col(n)).alias(n) for n in ("year", "month")],
        *[fn.filled(F.col(n)).alias(n) for n in ("countryCode", "eventDate", "lastInterpreted")],
        *[n for n in POSITION if n in df.columns],
    ).filter("gbifID IS NOT NULL AND decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL")


def load_limit(df: DataFrame, n: int) -> DataFrame:
    """The first n rows in source order, before any upsert; 0 means all."""
    return df.orderBy(*POSITION).limit(n) if n else df


NAMES_SCHEMA = "ord int, sci string, de string"


def names_from_json(texts: DataFrame) -> DataFrame:
    """texts has one row with a JSON object of texts: ord, sci, de; a repeated name keeps its first place and its last value."""
    entries = F.from_json("value", "map<string,string>")
    each = texts.select(F.posexplode(F.map_entries(entries)).alias("ord", "e")).select("ord", F.col("e.key").alias("sci"), F.col("e.value").alias("de"))
    return each.groupBy("sci").agg(F.min("ord").alias("ord"), F.max_by("de", "ord").alias("de")).select("ord", "sci", "de")


def read_names(spark: SparkSession, path: str | None) -> DataFrame:
    """The dictionary of common names; anything but an object of texts is an error; no path gives no names."""
    if not path:
        return spark.createDataFrame([], NAMES_SCHEMA)
    texts = spark.read.text(path, wholetext=True)
    values = F.map_values(F.from_json("value", "map<string,variant>"))  # NULL for anything but an object
    if texts.filter(values.isNull() | F.exists(values, lambda v: v.isNull() | (F.schema_of_variant(v) != "STRING"))).limit(1).count():
        raise ValueError("names must be a JSON object of texts")
    return names_from_json(texts)


def images_from_json(texts: DataFrame) -> DataFrame:
    """texts has one row with either layout of an image index: sci, image (JSON text)."""
    inner = F.get_json_object("value", "$.plants")
    body = F.when(F.startswith(F.ltrim(inner), F.lit("{")), inner).otherwise(F.col("value"))
    return texts.select(F.explode(F.from_json(body, "map<string,string>")).alias("sci", "image"))


def read_images(spark: SparkSession, path: str | None) -> DataFrame:
    """The image index; a missing, blank or unreadable file gives no images."""
    empty = spark.createDataFrame([], "sci string, image string")
    if not path:
        return empty
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return empty
    texts = spark.read.text(path, wholetext=True).filter(F.try_parse_json("value").isNotNull())
    return images_from_json(texts)


def write_document(df: DataFrame, path: str, gzip: bool = False) -> str:
    """One row with a column value (JSON text) as a text file folder; .gz is appended if compressed."""
    gzip = gzip or path.endswith(".gz")
    path = path if not gzip or path.endswith(".gz") else path + ".gz"
    df.select("value").coalesce(1).write.mode("overwrite").option("compression", "gzip" if gzip else "none").text(path)
    return path


#: The marker of a document of lines: there when all lines are. Spark's readers pass over names that begin so.
MARKER = "_document"


def write_lines(profiles: DataFrame, path: str, info: dict | None = None, gzip: bool = False) -> dict:
    """sci, profile (JSON text) as one profile a line, each an object with the species as its only key, in as many files as there are partitions.

    The marker is written last: info, the number of species, and scanned_rows, the sum of their totals, both counted while
    lines are written. A folder without it is no document. Returns what the marker says.
    """
    seen = Observation()
    key = F.to_json(F.array("sci"))
    line = F.concat(F.lit("{"), F.substr(key, F.lit(2), F.length(key) - 2), F.lit(":"), F.col("profile"), F.lit("}"))
    total = F.coalesce(F.get_json_object("profile", "$.total").try_cast("bigint"), F.lit(0))
    counted = profiles.select(line.alias("value"), total.alias("total")).observe(seen, F.count(F.lit(1)).alias("species"), F.coalesce(F.sum("total"), F.lit(0)).alias("scanned_rows"))
    spark = profiles.sparkSession
    marker, fs = _fs(spark, f"{path}/{MARKER}")
    fs.delete(marker, True)  # while lines are replaced there is no document
    counted.select("value").write.mode("overwrite").option("compression", "gzip" if gzip else "none").text(path)
    # the optimizer leaves an observation out with the rows of a relation that is known to be empty
    told = dict(info or {}) | ({"species": 0, "scanned_rows": 0} if spark.read.text(path).isEmpty() else seen.get)
    save_json(spark, f"{path}/{MARKER}", told)
    return told


def document_info(spark: SparkSession, path: str) -> dict | None:
    """What the marker of a document of lines says; None if there is none."""
    return load_json(spark, f"{path}/{MARKER}")


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """The species of a profile document, one object or lines: sci, profile (JSON text); path + ".gz" is tried if path is missing.

    A folder that Spark has not finished writing, or lines without their marker, are an error.
    """
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        path += ".gz"
        p, fs = _fs(spark, path)
        if not fs.exists(p):
            raise FileNotFoundError(path)
    if document_info(spark, path) is not None:
        entries = F.from_json("value", "map<string,string>")
        return spark.read.text(path).select(F.explode(entries).alias("sci", "profile"))
    texts = spark.read.text(path, wholetext=True)
    if fs.getFileStatus(p).isDirectory() and texts.filter(F.get_json_object("value", "$.plants").isNull()).limit(1).count():
        raise ValueError(f"{path} is no whole document, and has no {MARKER}")
    return document_species(texts)


def document_species(texts: DataFrame) -> DataFrame:
    return texts.select(F.explode(F.from_json(F.get_json_object("value", "$.plants"), "map<string,string>")).alias("sci", "profile"))


def ingest_meta(old: DataFrame | None, spark: SparkSession, file: str, columns: list[str]) -> DataFrame:
    """key, value: what was ingested last replaces older entries of its key."""
    new = spark.createDataFrame([("occurrence_file", file), ("columns", ",".join(columns))], "key string, value string")
    if old is None:
        return new
    return old.join(new, "key", "left_anti").unionByName(new)
