"""Ranked lexical search: items' accumulators pass from one owner of terms to the next.

Documents are cut into blocks, and each block's postings of the items' terms are written as a
table. A term belongs to one of four owners by the share of documents that hold it, rarest first.
Items travel in bundles: one row for each bundle and block, with sparse accumulators of the
block's documents. At each owner in turn, a bundle meets the block's postings of the owner's terms
(cogroup), adds whole-number contributions and goes on. A document leaves a bundle when what the
owners to come can add at most would not bring it to the k-th best sum of its block; that is exact.
The block's best are ranked over all blocks at the end.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are
lower-cased. With N documents that hold a term, L their terms, n a document's terms, df the
documents with a term and tf its occurrences: m = 100 - b + (b * n * N) div L with b = 25, a weight
is floor(1000 * ln((2 * N + 2) / (2 * df + 1))), and a sum has weight * ((10^9 * tf) div (1000 * tf + 12 * m))
for each term of the item, repeats included. All but the weight is 64-bit integers.

Defined cases: null and empty texts hold no terms; an item without terms, or whose terms no document
holds, gives no rows, and so do empty tables; rows of one item key are one item with the terms of all
of them, a null key too; rows of one document key are documents of their own, a null key comes last
among equal sums; other columns, whatever their names, are left alone; texts are read whole,
a very long one is a block of its own.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thicket.sources.files import stored

from . import text as tx
from .shared import checkpoint

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Owners by the greatest share of documents that hold their terms.
OWNERS = [1 / 256, 1 / 32, 1 / 8, 1.0]
#: Documents and bytes of text of a block, at most (a longer text is alone in one).
BLOCK, BLOCK_BYTES = 4096, 16 << 20
#: Items of a bundle, about.
BUNDLE = 256
#: Hashes by which workers tell which terms no item holds.
HASHES = 1 << 20
#: Terms whose answer a worker remembers.
REMEMBERED = 500_000

#: Bytes as they are in terms; all others are spaces.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """_item, terms (array of term and times) of each item."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    each = items.select(F.col(key).alias("_item"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term"))
    return each.groupBy("_item", "term").agg(F.count(F.lit(1)).alias("times")).groupBy("_item").agg(F.collect_list(F.struct("term", "times")).alias("terms"))


def wanted_hashes(slots: DataFrame) -> np.ndarray:
    """Which of HASHES values the hash of some item's term has; 32 rows of 4 KB go to the driver."""
    place = F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit(HASHES - 1)) + 1
    bits = slots.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("at")).groupBy("b").agg(F.bitmap_construct_agg("at").alias("bits"))
    out = np.zeros((HASHES // 32768, 32768), bool)
    for row in bits.collect():
        out[row["b"] - 1] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
    return out.ravel()


def index(docs: DataFrame, key: str, text: str, wanted: np.ndarray) -> DataFrame:
    """Blocks of documents: a row for each (keys, sizes; its documents in the order of their keys), and one for each term of it (at, tf)."""
    kind = docs.schema[key].dataType.simpleString()
    names = ["block", "keys", "sizes", "term", "at", "tf"]
    packed = np.packbits(wanted, bitorder="little").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").astype(bool)
        first, number, known = TaskContext.get().partitionId() << 32, 0, {}

        def asked(term: bytes) -> bool:
            if (found := known.get(term)) is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = known[term] = bool(bits[zlib.crc32(term) & (HASHES - 1)])
            return found

        def blocks() -> Iterator[tuple[list, list]]:
            keys, texts, held = [], [], 0
            for batch in batches:
                column = batch.column(1)
                for i in range(batch.num_rows):
                    own = column[i].as_buffer()
                    own = own.to_pybytes() if own is not None else b""
                    if texts and (len(texts) == BLOCK or held + len(own) > BLOCK_BYTES):
                        yield keys, texts
                        keys, texts, held = [], [], 0
                    keys.append(batch.column(0)[i])
                    texts.append(own)
                    held += len(own)
            if texts:
                yield keys, texts

        for keys, texts in blocks():
            column = pa.array([k.as_py() for k in keys], keys[0].type)
            order = pc.sort_indices(pa.table({"k": column}), sort_keys=[("k", "ascending")], null_placement="at_end").to_numpy()
            at, tf, sizes = defaultdict(list), defaultdict(list), []
            for place, i in enumerate(order.tolist()):
                terms = terms_of(texts[i])
                sizes.append(len(terms))
                for term, n in Counter(terms).items():
                    if asked(term):
                        at[term].append(place)
                        tf[term].append(n)
            every = list(at)
            null = lambda t, n=len(every): pa.nulls(n, t)
            listed = lambda rows, t: pa.array([None, *rows], pa.list_(t))
            ordered = column.take(pa.array(order))
            both = [
                pa.array([first + number] * (len(every) + 1), pa.int64()),
                pa.concat_arrays([pa.ListArray.from_arrays(pa.array([0, len(ordered)], pa.int32()), ordered), null(pa.list_(ordered.type))]),
                pa.concat_arrays([pa.array([sizes], pa.list_(pa.int64())), null(pa.list_(pa.int64()))]),
                pa.array([None, *(t.decode("utf-8", "replace") for t in every)], pa.string()),
                listed((at[t] for t in every), pa.int16()), listed((tf[t] for t in every), pa.int32()),
            ]
            number += 1
            yield pa.RecordBatch.from_arrays(both, names=names)

    return docs.select(F.col(key), F.col(text)).mapInArrow(tx.giving_back(run), f"block long, keys array<{kind}>, sizes array<long>, term string, at array<smallint>, tf array<int>")


STATE = "bundle int, block long, sizes array<long>, bounds array<long>, open array<boolean>, slot array<int>, at array<int>, score array<long>"


def owner_step(owner: int, k: int, n_docs: int, n_terms: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """What happens to one bundle at one owner, for one block."""
    last = owner == len(OWNERS) - 1

    def run(bundle: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        state = bundle.iloc[0]
        sizes = np.asarray(state["sizes"], np.int64)
        bounds = np.asarray(state["bounds"], np.int64).reshape(-1, len(OWNERS))
        m = 75 + 25 * sizes * n_docs // n_terms
        score, listed = np.zeros((len(bounds), len(sizes)), np.int64), np.zeros((len(bounds), len(sizes)), bool)
        listed[state["slot"], state["at"]] = True
        score[state["slot"], state["at"]] = state["score"]
        listed |= np.asarray(state["open"], bool)[:, None]
        for weight, at, tf, slots, times in zip(*(postings[c] for c in ("weight", "at", "tf", "slots", "times")), strict=True):
            at, tf = np.asarray(at), np.asarray(tf, np.int64)
            adds = weight * (1_000_000_000 * tf // (1000 * tf + 12 * m[at]))
            for slot, often in zip(slots, times, strict=True):
                score[slot, at] += often * adds
        score[~listed] = 0
        least = np.partition(score, len(sizes) - k, axis=1)[:, len(sizes) - k] if len(sizes) > k else np.zeros(len(bounds), np.int64)
        after = bounds[:, owner + 1 :].sum(1)
        slot, at = np.nonzero((score > 0) & (score + after[:, None] >= least[:, None]))
        found = score[slot, at]
        if last:  # of equal sums the first documents
            order = np.lexsort([at, -found, slot])
            slot, at, found = slot[order], at[order], found[order]
            nth = np.arange(len(slot)) - np.searchsorted(slot, slot)
            slot, at, found = slot[nth < k], at[nth < k], found[nth < k]
        row = {"bundle": state["bundle"], "block": state["block"], "sizes": sizes, "bounds": bounds.ravel(), "open": after >= np.maximum(least, 1), "slot": slot, "at": at, "score": found}
        return pd.DataFrame({c: [v] for c, v in row.items()})

    return run


def weights(postings: DataFrame, n_docs: int) -> DataFrame:
    """term, weight, owner of the terms that documents hold."""
    df = postings.groupBy("term").agg(F.sum(F.size("at")).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    owner: Column = F.lit(len(OWNERS) - 1)
    for k in reversed(range(len(OWNERS) - 1)):
        owner = F.when(F.col("df") <= OWNERS[k] * n_docs, F.lit(k)).otherwise(owner)
    return df.select("term", weight.alias("weight"), owner.alias("owner"))


def search(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """_item, rank (from 1), _key, score of the k best documents of each item."""
    asked = item_terms(items, item, text)
    bundles = max(1, -(-asked.count() // BUNDLE))
    member = asked.groupBy(F.pmod(F.xxhash64("_item"), F.lit(bundles)).cast("int").alias("bundle")).agg(F.sort_array(F.collect_list(F.struct("_item", "terms"))).alias("items"))
    places = checkpoint(member.select("bundle", F.posexplode("items").alias("slot", "i")).select("bundle", "slot", "i._item", "i.terms"))
    slots = places.select("bundle", "slot", F.inline("terms"))
    table = stored(index(docs, key, text, wanted_hashes(slots)))
    blocks, postings = table.filter("keys IS NOT NULL").select("block", "keys", "sizes"), table.filter("term IS NOT NULL").select("block", "term", "at", "tf")
    found = blocks.select(F.size(F.filter("sizes", lambda n: n > 0)).alias("d"), F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n).alias("t")).agg(F.sum("d"), F.sum("t")).first()
    n_docs, n_terms = (x or 0 for x in found)
    weighed = checkpoint(slots.join(weights(postings, n_docs), "term"))
    most = [F.coalesce(F.sum(F.when(F.col("owner") == o, F.col("weight") * F.col("times") * 1_000_000)), F.lit(0)) for o in range(len(OWNERS))]
    bounds = weighed.groupBy("bundle", "slot").agg(F.array(*most).alias("b"))
    bounds = places.select("bundle", "slot").join(bounds, ["bundle", "slot"], "left").withColumn("b", F.coalesce("b", F.array_repeat(F.lit(0).cast("long"), len(OWNERS))))
    bounds = bounds.groupBy("bundle").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("slot", "b"))), lambda x: x["b"])).alias("bounds"), F.count(F.lit(1)).cast("int").alias("_n"))
    routes = weighed.groupBy("bundle", "owner", "term", "weight").agg(F.collect_list("slot").alias("slots"), F.collect_list("times").alias("times"))
    none = lambda t: F.array().cast(f"array<{t}>")
    # each bundle visits each block: a row for both, which begins without accumulators and open to any document
    state = blocks.select("block", "sizes", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle")).join(bounds, "bundle")
    state = state.select("bundle", "block", "sizes", "bounds", F.array_repeat(F.lit(True), F.col("_n")).alias("open"), none("int").alias("slot"), none("int").alias("at"), none("long").alias("score"))
    for owner in range(len(OWNERS)):
        own = postings.join(routes.filter(F.col("owner") == owner), "term").select(F.col("bundle").alias("_bundle"), F.col("block").alias("_block"), "weight", "at", "tf", "slots", "times")
        state = state.groupBy("bundle", "block").cogroup(own.groupBy("_bundle", "_block")).applyInPandas(owner_step(owner, k, n_docs, n_terms), STATE)
    best = state.select("bundle", "block", F.arrays_zip("slot", "at", "score").alias("best")).join(blocks.select("block", "keys"), "block")
    each = best.select("bundle", F.inline(F.transform("best", lambda x: F.struct(x["slot"].alias("slot"), x["score"].alias("score"), F.get("keys", x["at"]).alias("_key")))))
    order = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.col("_key").asc_nulls_last())
    ranked = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(places.select("bundle", "slot", "_item"), ["bundle", "slot"]).select("_item", "rank", "_key", "score")
