"""The occurrence store: whole-row upserts into snapshots of hash buckets, with retention."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from thicket.sources.files import POSITION, _fs, load_json, save_json

#: A file's place under the store's folder: the version that wrote it, its bucket (or that it is a layer), its name.
PLACE = re.compile(r"data/v=\d+/(?:_bucket=(\d+)|layer)/[^/]+$")
#: The column by which rows are dealt to tasks: a bucket's piece.
PART = "_part"


def latest(batch: DataFrame, key: str | list[str] = "gbifID", order: list | None = None) -> DataFrame:
    """The last row of each key of a batch. order (descending) ranks rows; by default it is their place in the source."""
    order = order or [F.col(c).desc() for c in POSITION]
    return batch.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_rank = 1").drop("_rank", *POSITION)


def upsert(store: DataFrame | None, batch: DataFrame, key: str = "gbifID", order: list | None = None) -> DataFrame:
    """The store with rows of batch in the place of those with their key; of equal keys the last row wins, whole, NULLs included.

    Applying a batch twice changes nothing. The Store does this with files, and ranks the batch once.
    """
    last = latest(batch, key, order)
    if store is None:
        return last
    # one shuffle of either side on the key; the store's rows that stay don't pass the ranking
    return store.join(last, key, "left_anti").unionByName(last, allowMissingColumns=True)


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows with a count that is there, without another scan, once an action has read them all."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


class Store:
    """Snapshots 0, 1, ... under a folder, and a pointer file; readers see whole snapshots only.

    A snapshot is a manifest: for each bucket (hash of the key) the files that hold it. An upsert ranks its batch where
    its buckets are, writes it there, reads only the buckets that the batch touches, writes what stays of them beside it,
    and names the other buckets' files again. A bucket is worked on in pieces, by as many tasks as Spark's shuffles have. The pointer moves
    when all is written, so a run that fails leaves the store and its state as they were. Rows of a file are sorted by
    sort, so that readers with a predicate on those columns skip row groups.

    Small batches with keys from everywhere touch all buckets. With layers above 0 up to so many batches are kept as they
    are, ranked, beside the buckets: applying one writes the batch only, readers leave out the buckets' rows whose keys are
    in a layer (an anti join with few keys, which Spark broadcasts while they are small) and add the layers' newest rows.
    The batch after them folds all into the buckets.

    The newest keep snapshots can be read, and older ones while a reader holds them (hold); files that no such
    snapshot names are deleted after each commit. One writer at a time.

        data/v=3/_bucket=5/...  files that version 3 wrote        manifest/3  schema, buckets, files, layers
        data/v=3/layer/...      the batch of version 3, ranked    state       the pointer, and what callers note
        holds/2_...             readers of version 2
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "gbifID", buckets: int = 16, sort: tuple[str, ...] = ("lastInterpreted",), keep: int = 3, layers: int = 0, options: dict[str, str] | None = None) -> None:
        """buckets counts for a new store only, which keeps its number. A bucket should fit a few tasks: 20,000 of them for 100 TB. options are the Parquet writer's."""
        self.spark, self.path, self.key, self.buckets, self.sort, self.keep, self.layers, self.options = spark, path.rstrip("/"), key, buckets, sort, max(1, keep), layers, options or {}

    def on(self, spark: SparkSession) -> Store:
        """The same store for another session; a stream's batches have one of their own."""
        return Store(spark, self.path, self.key, self.buckets, self.sort, self.keep, self.layers, self.options)

    # Small files

    def _load(self, name: str) -> dict | None:
        return load_json(self.spark, f"{self.path}/{name}")

    def _save(self, name: str, content: dict) -> None:
        save_json(self.spark, f"{self.path}/{name}", content)

    def _drop(self, name: str) -> None:
        p, fs = _fs(self.spark, f"{self.path}/{name}")
        fs.delete(p, True)

    def _list(self, folder: str) -> list[tuple[str, float]]:
        """Names in a folder, and when they were written (seconds)."""
        p, fs = _fs(self.spark, f"{self.path}/{folder}")
        return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(p)] if fs.exists(p) else []

    # Reading

    def state(self) -> dict:
        # a run may have ended between taking the old pointer away and moving the new one
        return self._load("state") or self._load("state.next") or {"version": -1}

    def versions(self) -> list[int]:
        """Snapshots that can be read, oldest first."""
        newest = self.state()["version"]
        return sorted(int(name) for name, _ in self._list("manifest") if name.isdigit() and int(name) <= newest)

    def manifest(self, version: int | None = None) -> dict:
        version = self.state()["version"] if version is None else version
        return (self._load(f"manifest/{version}") if version >= 0 else None) or {"buckets": self.buckets, "schema": None, "files": {}, "layers": []}

    def _files(self, manifest: dict, files: list[str]) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in files]) if files else self.spark.createDataFrame([], schema)

    def _buckets(self, manifest: dict, buckets: list[int]) -> DataFrame:
        return self._files(manifest, [f for b in buckets for f in manifest["files"].get(str(b), [])])

    def _newest(self, layers: list[DataFrame]) -> DataFrame:
        """The rows of layers, oldest first, of each key that of the last layer that has it."""
        if len(layers) == 1:
            return layers[0]
        each = [rows.withColumn("_layer", F.lit(k)) for k, rows in enumerate(layers)]
        whole = each[0]
        for rows in each[1:]:
            whole = whole.unionByName(rows, allowMissingColumns=True)
        return latest(whole, self.key, [F.col("_layer").desc()]).drop("_layer")

    def _rows(self, manifest: dict) -> DataFrame | None:
        if manifest["schema"] is None:
            return None
        base = self._files(manifest, [f for own in manifest["files"].values() for f in own])
        if not manifest["layers"]:
            return base
        newest = self._newest([self._files(manifest, files) for files in manifest["layers"]])
        return base.join(newest.select(self.key), self.key, "left_anti").select(*base.columns).unionByName(newest)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a snapshot, of the newest if none is named; None if there is none. See hold for readers that take long."""
        if version is not None and version not in self.versions():
            raise ValueError(f"no snapshot {version}")
        return self._rows(self.manifest(version))

    @contextmanager
    def hold(self, version: int | None = None) -> Iterator[DataFrame | None]:
        """The rows of a snapshot, whose files stay until the block ends, whatever is applied meanwhile."""
        while True:
            held = self.state()["version"] if version is None else version
            name = f"holds/{held}_{uuid.uuid4().hex}"
            self._save(name, {})
            if held < 0 or held in self.versions():  # else it went before it was held
                break
            self._drop(name)
            if version is not None:
                raise ValueError(f"no snapshot {version}")
        try:
            yield self._rows(self.manifest(held))
        finally:
            self._drop(name)

    # Writing

    def note(self, **state: object) -> None:
        """Change entries of the state; readers see the old pointer or the new one."""
        self._save("state.next", self.state() | state)
        p, fs = _fs(self.spark, f"{self.path}/state.next")
        target, _ = _fs(self.spark, f"{self.path}/state")
        fs.delete(target, True)
        fs.rename(p, target)

    def apply(self, rows: DataFrame, order: list | None = None, check: Callable[[DataFrame], None] | None = None, **state: object) -> int:
        """Upsert rows as a new snapshot, with entries of the state; the number of rows before equal keys met.

        check may look at the rows that are written, those of touched buckets, and fail the run.
        """
        old, version = self.manifest(), self.state()["version"] + 1
        files, layers = dict(old["files"]), list(old["layers"])
        counted, seen = observed(rows)
        by = [c for c in self.sort if c in rows.columns]
        self._drop(f"data/v={version}")  # what a run that failed may have left
        if files and len(layers) < self.layers:
            ranked = latest(counted, self.key, order)
            (ranked.sortWithinPartitions(*by) if by else ranked).write.mode("overwrite").options(**self.options).parquet(f"{self.path}/data/v={version}/layer")
            batch, made = self._made(version, ranked.schema)
            some = not batch.isEmpty()
            layers += [made["layer"]] if some else []
        else:
            ranked = latest(self._dealt(counted, old["buckets"]), [PART, self.key], order)
            self._write(ranked, version, by)
            batch, made = self._made(version, ranked.drop("_bucket", PART).schema)
            some = bool(made)
        schema = batch.schema if old["schema"] is None else self.spark.createDataFrame([], StructType.fromJson(old["schema"])).unionByName(batch.limit(0), allowMissingColumns=True).schema
        if some and "layer" not in made:
            if files or layers:
                self._fold(old, batch, list(made), version, by)
                _, made = self._made(version, schema)
            files, layers = files | made, []
        if some and check:
            check(self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for own in made.values() for f in own]))
        self._save(f"manifest/{version}", {"buckets": old["buckets"], "schema": schema.jsonValue(), "files": files, "layers": layers})
        self.note(**state, version=version)
        if not some:
            self._drop(f"data/v={version}")
        self.expire()
        return int(seen.get["rows"]) if some else 0

    def _dealt(self, rows: DataFrame, buckets: int, touched: list[int] | None = None) -> DataFrame:
        """Rows with _bucket and PART, a partition for each piece of a bucket; rows of a key are in one.

        Tasks are as many as Spark's shuffles have, so that what one of them holds doesn't grow with a bucket.
        """
        pieces = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // buckets)
        text = F.col(self.key).cast("string")
        rows = rows.withColumn("_bucket", self._bucket(buckets))
        nth = F.col("_bucket")
        if touched is not None:
            place = {b: k for k, b in enumerate(touched)}
            nth = F.element_at(F.lit([place.get(b, 0) for b in range(buckets)]), nth + 1)
        # another hash than the bucket's, so that its pieces are even
        part = (nth * pieces + F.pmod(F.xxhash64(text, F.lit(5)), F.lit(pieces))).cast("int")
        return rows.withColumn(PART, part).repartitionById((buckets if touched is None else len(touched)) * pieces, PART)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, version: int, by: list[str]) -> None:
        rows.drop(PART).sortWithinPartitions("_bucket", *by).write.mode("append").options(**self.options).partitionBy("_bucket").parquet(f"{self.path}/data/v={version}")

    def _made(self, version: int, schema: StructType) -> tuple[DataFrame, dict[str, list[str]]]:
        """The rows that a version has written, and their files by bucket (or layer)."""
        rows = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.path}/data/v={version}")
        made: dict[str, list[str]] = {}
        for f in rows.inputFiles():
            if place := PLACE.search(f):
                made.setdefault(place[1] or "layer", []).append(place[0])
        return rows, made

    def _fold(self, old: dict, batch: DataFrame, buckets: list[str], version: int, by: list[str]) -> None:
        """Write the rows of touched buckets, and of layers, that a batch leaves, beside the batch's own files.

        Old rows are shuffled once, and of the batch its keys only.
        """
        layers = [self._files(old, f) for f in old["layers"]]
        touched = set(map(int, buckets))
        for rows in layers:
            touched |= {r[0] for r in rows.select(self._bucket(old["buckets"])).distinct().collect()}  # as many as there are buckets, at most
        rows = self._buckets(old, sorted(touched)).withColumn("_layer", F.lit(0))
        for k, layer in enumerate([*layers, batch.select(self.key)], 1):
            rows = rows.unionByName(layer.withColumn("_layer", F.lit(k)), allowMissingColumns=True)
        first = F.row_number().over(Window.partitionBy(PART, self.key).orderBy(F.col("_layer").desc()))
        left = self._dealt(rows, old["buckets"], sorted(touched)).withColumn("_nth", first).filter(F.col("_nth") == 1).filter(F.col("_layer") <= len(layers))
        self._write(left.drop("_nth", "_layer"), version, [c for c in by if c in left.columns])

    def expire(self, held_hours: float = 24) -> list[int]:
        """Delete snapshots before the newest keep ones that no reader holds, and files that no other names; what was deleted.

        A hold older than held_hours is one of a reader that died.
        """
        clock = max([t for _, t in self._list("")], default=0.0)  # the file system's: the pointer has just been written
        held = set()
        for name, when in self._list("holds"):
            if clock - when > held_hours * 3600:
                self._drop(f"holds/{name}")
            else:
                held.add(int(name.split("_")[0]))
        there = self.versions()
        gone = [v for v in there[: -self.keep] if v not in held]
        if gone:
            named = lambda versions: {f for m in map(self.manifest, versions) for own in [*m["files"].values(), *m["layers"]] for f in own}
            stay = named(set(there) - set(gone))
            folders = {f.split("/")[1] for f in stay}
            lost = named(gone) - stay
            for folder in {f.split("/")[1] for f in lost} - folders:
                self._drop(f"data/{folder}")
            for f in lost:
                if f.split("/")[1] in folders:
                    self._drop(f)
            for v in gone:
                self._drop(f"manifest/{v}")
        return gone
