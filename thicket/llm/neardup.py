"""Embedding near-duplicates by sorted projection passes.

Equal vectors form a class. For each pass, vectors are ordered lexicographically by the
signs of 64 random projections, and each is compared, in double precision, with the next
window ones. Verified pairs of all passes are united. A pair that lies inside the window
in an earlier pass as well counts there only, which its ranks tell, so that links are
counted without a table of pairs; components are contracted inside each task first.

The number of passes grows with the number of distinct vectors, so that a pair at the
threshold is found with the stated probability (passes_for). Windows are bounded, and in a
family of more vectors than a window holds they miss links. So each vector for which as many
partners as a window holds were found is compared with its whole component, in tiles, and
those links are its count; nothing is emitted but sums. Recall against all pairs is measured
in the README; no pair below the threshold is ever linked.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
link with nothing, and nor do vectors of different lengths; equal vectors are linked with
each other; rows with a null key are members of their class, and a class without any key
has no component; an empty table gives no rows. Only the key and the vector are read, so that
other columns' names don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components, local_components
from .shared import checkpoint

#: Passes at least, and the probability with which a pair at the threshold is to be found.
PASSES, RECALL = 16, 0.99
WINDOW = 256
#: Vectors of one pass that are compared in one task, besides the window that overlaps.
BLOCK = 4096
BITS = 64
#: Vectors of a component on either side of a comparison, about.
TILE = 16384
#: Parts of a component that meet its sizes in tasks of their own.
SALTS = 64


def passes_for(n: int, threshold: float, window: int, recall: float = RECALL) -> int:
    """Passes for a pair at the threshold among n vectors.

    In one pass it lies inside a window, about, if the signs of log2(n / window) projections agree.
    """
    same = 1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi
    found = same ** np.log2(max(1.0, n / window))
    return PASSES if found >= 1 else max(PASSES, int(np.ceil(np.log(1 - recall) / np.log1p(-found))))


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors over their lengths in double precision."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)  # squares of very large or small numbers stay finite
    v /= np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
    return v + 0.0  # one zero only


def rows_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors of the rows that have a direction, by length of vector."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    flat = column.flatten()  # without what null rows may hide
    begin = np.cumsum(sizes) - sizes
    whole = np.asarray(pc.fill_null(flat, float("nan")))
    for dim in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == dim)
        vectors = whole[begin[at][:, None] + np.arange(dim)]
        good = np.isfinite(vectors).all(1) & vectors.any(1)
        yield at[good], vectors[good]


def keys(vectors: np.ndarray, passes: int, seed: int) -> np.ndarray:
    """For each vector and pass the signs of BITS projections as one sortable number."""
    dim = vectors.shape[1]
    planes = np.random.default_rng([seed, dim]).standard_normal((dim, passes * BITS))
    signs = (vectors @ planes > 0).reshape(len(vectors), passes, BITS)
    return np.packbits(signs, axis=2).view(">u8")[:, :, 0].astype(np.uint64).view(np.int64)


def compare(vectors: np.ndarray, ranks: np.ndarray, at: int, own: np.ndarray, weight: np.ndarray, window: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of rows in order of rank in pass at: how many vectors each links to, and the pairs (first, second).

    Rows that own is False for are only partners of those before them.
    """
    n, links, firsts, seconds = len(vectors), np.zeros(len(vectors), np.int64), [], []
    for s in range(0, n, 512):
        part = slice(s, min(n, s + 512 + window))
        dots = vectors[s : s + 512] @ vectors[part].T
        i, j = np.nonzero(dots >= threshold)
        i, j = i + s, j + s
        keep = (j > i) & (ranks[j, at] - ranks[i, at] <= window) & own[i]
        i, j = i[keep], j[keep]
        if at:
            seen = (np.abs(ranks[i, :at] - ranks[j, :at]) <= window).any(1)
            i, j = i[~seen], j[~seen]
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        firsts.append(i)
        seconds.append(j)
    return links, np.concatenate(firsts), np.concatenate(seconds)


def count_dense(members: DataFrame, threshold: float, matrix: Callable[[list[bytes]], np.ndarray], tile: int) -> DataFrame:
    """node, exact: how many rows each dense node links to in its component.

    members: component, node, size, raw, dense. Both sides are dealt into tiles by hash: dense nodes go to each tile of all
    nodes and those to each tile of dense ones, so that a tile's size is bounded whatever the component's.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count_if("dense") / tile).cast("int").alias("_across"), F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("_down")).filter("_across > 0")
    # a component may hold most nodes, so that its row of sizes meets them in SALTS places
    salted = sizes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    held = members.withColumn("_hash", F.xxhash64("node")).withColumn("_salt", F.pmod("_hash", F.lit(SALTS)).cast("int")).join(salted, ["component", "_salt"])
    part = lambda n: F.pmod(F.shiftright("_hash", 16), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = held.filter("dense").select("component", "node", "size", "raw", F.lit(True).alias("asks"), part("_across").alias("a"), every("_down").alias("b"))
    asked = asked.unionByName(held.select("component", "node", "size", "raw", F.lit(False).alias("asks"), part("_down").alias("b"), every("_across").alias("a")))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows["asks"].to_numpy(bool)
        mine, others = rows[asks], rows[~asks]
        if mine.empty or others.empty:
            return pd.DataFrame({"node": [], "exact": []}).astype("int64")
        vectors, against, weight = matrix(mine["raw"].tolist()), matrix(others["raw"].tolist()), others["size"].to_numpy(np.int64)
        total = np.zeros(len(mine), np.int64)
        for i in range(0, len(mine), 256):
            total[i : i + 256] = (vectors[i : i + 256] @ against.T >= threshold) @ weight
        own = mine["node"].isin(others["node"]).to_numpy()
        total[own] -= mine["size"].to_numpy(np.int64)[own]  # a node is linked with itself
        return pd.DataFrame({"node": mine["node"].to_numpy(np.int64), "exact": total})

    return asked.groupBy("component", "a", "b").applyInPandas(run, "node long, exact long").groupBy("node").agg(F.sum("exact").alias("exact"))


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9, passes: int | None = None, window: int = WINDOW, block: int = BLOCK, seed: int = 23, tile: int = TILE) -> DataFrame:
    """One row for each row of df: key, n_links, component_id, kept. Keys are integers; passes follow from the number of vectors."""
    if window > block:
        raise ValueError("a window must fit a block")

    kind = np.float32 if df.schema[vector].dataType.jsonValue().get("elementType") == "float" else np.float64
    element = "float" if kind is np.float32 else "double"

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, raw = [None] * len(batch), [None] * len(batch)
            for at, vectors in rows_of(batch.column(1)):
                for i, v, u in zip(at.tolist(), vectors, units(vectors), strict=True):
                    classes[i], raw[i] = sha256(u.tobytes()).digest(), v.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(classes, pa.binary()), pa.array(raw, pa.binary())], names=["key", "class", "raw"])

    rows = checkpoint(df.select(F.col(key).cast("long"), F.col(vector).cast(f"array<{element}>")).mapInArrow(prepare, "key long, class binary, raw binary"))
    classes = rows.filter("raw IS NOT NULL").groupBy("class").agg(F.min("key").alias("node"), F.count(F.lit(1)).alias("size"), F.min("raw").alias("raw"))
    nodes = checkpoint(classes.filter("node IS NOT NULL"))
    n = nodes.count()
    if passes is None:
        passes = passes_for(n, threshold, window)

    def matrix(raw: list[bytes]) -> np.ndarray:
        return units(np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, raw = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for dim in {len(r) for r in raw}:
                mine = [i for i, r in enumerate(raw) if len(r) == dim]
                found = keys(matrix([raw[i] for i in mine]), passes, seed)
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(passes, dtype=np.int32), len(mine))), pa.array(np.full(found.size, dim, np.int64)), pa.array(found.ravel()), pa.array(np.repeat(node[mine], passes))], names=["pass", "dim", "sort", "node"])

    # a checkpoint of the sorted partitions fixes their numbers; a rank is a row's place in its partition after all rows before
    projected = nodes.select("node", "raw").mapInArrow(project, "pass int, dim long, sort long, node long")
    order = ["pass", "dim", "sort", "node"]
    placed = checkpoint(projected.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.select("pass", "node", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_at"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # one row for each partition
    # a pass has a rank for each vector
    rank = (F.col("_before") + F.col("_at") - F.col("pass") * F.lit(n)).cast("int" if n < 1 << 31 else "long")
    ranks = placed.join(F.broadcast(starts), "_part").select("node", F.struct("pass", rank.alias("rank")).alias("r"))
    ranks = ranks.groupBy("node").agg(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["rank"]).alias("ranks"))
    each = nodes.select("node", "size", "raw").join(ranks, "node").select("*", F.posexplode("ranks").alias("pass", "rank"))
    home = F.floor(F.col("rank") / block)
    blocks = F.when(F.col("rank") % block < window, F.array(home, home - 1)).otherwise(F.array(home))
    # a pass needs its own ranks and those of the passes before it
    each = each.withColumn("ranks", F.slice("ranks", 1, F.col("pass") + 1)).withColumn("block", F.explode(blocks)).withColumn("own", F.col("block") == home).drop("rank")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        at = int(part["pass"].iloc[0])
        ranks = np.array(part["ranks"].tolist(), np.int64)
        sizes = part["raw"].map(len).to_numpy()
        order = np.argsort(ranks[:, at])
        node = part["node"].to_numpy(np.int64)
        weight, own = part["size"].to_numpy(np.int64), part["own"].to_numpy(bool)
        out = []
        for dim in np.unique(sizes):
            o = order[sizes[order] == dim]
            vectors = matrix(part["raw"].iloc[o].tolist())
            links, i, j = compare(vectors, ranks[o], at, own[o], weight[o], window, threshold)
            linked = np.flatnonzero(links)
            pairs = np.bincount(i, minlength=len(o)) + np.bincount(j, minlength=len(o))
            found, root = local_components(node[o][i], node[o][j])
            out.append(pd.DataFrame({"node": node[o][linked], "links": links[linked], "pairs": pairs[linked], "root": root[np.searchsorted(found, node[o][linked])]}))
        return pd.concat(out)

    found = checkpoint(each.groupBy("pass", "block").applyInPandas(run, "node long, links long, pairs long, root long"))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"), (F.sum("pairs") >= window).alias("dense"))
    groups = components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    exact = count_dense(groups.join(linked.select("node", "dense"), "node").join(nodes.select("node", "size", "raw"), "node"), threshold, matrix, tile)
    linked = linked.join(exact, "node", "left").select("node", F.coalesce("exact", "links").alias("links"))
    known = classes.select("class", "node", "size").join(linked, "node", "left").join(groups, "node", "left")
    known = known.select("class", "size", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component"))
    alone = F.col("raw").isNull()
    component = F.when(alone, F.col("key")).otherwise(F.col("component"))
    return rows.join(known, "class", "left").select(
        F.col("key").alias(key), F.when(alone, 0).otherwise(F.col("links") + F.col("size") - 1).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )
