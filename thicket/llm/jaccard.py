"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Two documents link when the Jaccard similarity of their sets of word shingles is at least
num/den. The join is exact, up to collisions of 64-bit hashes of shingles:

1. Documents with equal sets form one class; copies are never expanded into pairs.
2. Linked classes of sizes a and b differ in d = (a + b)(den - num)/(den + num) shingles at
   most. The hash range is cut into more than d segments, so two linked sets agree on a
   whole segment; a segment's content is a signature. Shingles of very many documents
   (by counters of fixed size over all of them) are left out of segments, so that passages
   in common use make no candidates; sets that are left with too few segments are cut whole,
   by other hashes, as well, until a cut has enough: of two linked sets one may stop first,
   and the other has its cut as well. A set with f filled segments in its last cut shares f - d of
   its signatures with each set it links with, at least; so a set that shares fewer, with whatever sets, has no
   links by that cut, and goes, before classes that share a signature are put into one block by connected
   components. That keeps blocks apart whose sets share passages only, of which there are the more the larger the table.
   Signatures are packed into binary columns, nine bytes each.
3. Inside a block an inverted index from shingles to classes answers T-occurrence searches:
   the short lists of a query are merged with a heap, classes that occur often enough are
   probed in the long lists by binary search, and those that reach the overlap are linked.
   Classes outside the largest component found so far are searched for, whatever their
   order; a pair inside one component needs no search.
4. Blocks of more than block_size classes are cut into parts that share a pivot; classes
   that did not join the pivot's component then visit all other parts, in groups of
   block_size visits at most, about.

Defined cases: null and empty texts and texts of separators only have an empty set and
link with nothing; with fewer words than a shingle has, the whole sequence is one shingle;
repeated rows are one class; very long texts are whole sets like others; an empty table gives
no rows. Only the key and the text are read, so that other columns' names don't matter. Rows with a null
key take the component of a row with a key and an equal set, else null. Rows that share a
key with different texts are one node.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import count, groupby
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .components import components, local_components
from .shared import checkpoint, mark_likely

#: Classes that are indexed together, at most about.
BLOCK_SIZE = 2048
#: Signatures that one bucket holds, about, and that a batch gathers before it is sent.
BUCKET = 1_000_000
_SEED = np.uint64(0xA0761D6478BD642F)
#: Counters of shingles (powers of two), the pieces they are sent in, and the groups in which they are added up first.
COUNTERS, PIECES, SALTS = 18, 16, 256
#: Bits of the map of sets that share enough signatures (a power of two, at most), and its slices.
MAP_BITS, SLICES = 25, 256


def counter_of(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - COUNTERS)).astype(np.int64)


def needed(a: int, b: int, num: int, den: int) -> int:
    """The overlap that sets of sizes a and b need."""
    return -(-num * (a + b) // (num + den))


def size_classes(num: int, den: int, top: int) -> list[int]:
    """First sizes of the classes; a set links only within its class and the next."""
    out = [1]
    while out[-1] <= top:
        out.append(out[-1] * den // num + 1)
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int, powers: tx.Powers) -> Iterator[np.ndarray]:
    words, first, _, _ = tx.word_hashes(data, offsets, powers)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield np.unique(tx.shingles(words[a:b], k))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    m = tx.mix(s ^ _SEED)
    both = np.array([m.sum(dtype=np.uint64), (m * s).sum(dtype=np.uint64)], np.uint64)
    return tuple(tx.mix(both + np.uint64(len(s))).view(np.int64).tolist())


class Signatures:
    """Signatures of sets, such that linked sets of different content share one."""

    def __init__(self, num: int, den: int, heavy: np.ndarray | None = None) -> None:
        self.num, self.den, self.firsts = num, den, size_classes(num, den, 1)
        self.heavy = heavy if heavy is not None else np.zeros(1 << COUNTERS, bool)

    def of(self, s: np.ndarray) -> np.ndarray:
        return np.concatenate([s[:0], *(cut for cut, _ in self.cuts(s))])

    def cuts(self, s: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """Signatures of each cut with its mark: 128 if they are of the set's own class, plus how many of them a set that links by
        this cut shares at least (127 for all above; 0: not told, as it isn't the last)."""
        n = len(s)
        if n > self.firsts[-2]:
            self.firsts = size_classes(self.num, self.den, 2 * n)
        own = int(np.searchsorted(self.firsts, n, "right")) - 1
        light = s[~self.heavy[counter_of(s)]]
        for tag in (own - 1, own):
            if tag >= 0:
                for cut, least in self._tagged(s, light, tag):
                    yield cut, 128 * (tag == own) + min(127, least)

    def _tagged(self, s: np.ndarray, light: np.ndarray, tag: int) -> Iterator[tuple[np.ndarray, int]]:
        """For pairs of class tag, or of it and the next: one signature for each segment with content, and how many linked sets share."""
        top = self.firsts[tag + 1] - 1
        d = (self.den - self.num) * (top + top * self.den // self.num) // (self.den + self.num)
        if not d:
            return
        segments = d + 2 + d // 8
        edges = (np.arange(segments + 1, dtype=np.float64) * (2.0**64 / segments)).clip(0, 2.0**64 - 2048).astype(np.uint64)
        # a set with few filled segments might agree on empty ones only: it is cut anew, whole and by other hashes, as well
        for turn in count():
            cut = light if not turn else np.sort(tx.mix(s + np.uint64(turn)))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tx.mix(cut ^ _SEED))])
            at = np.searchsorted(cut, edges)
            at[-1] = len(cut)
            filled = np.flatnonzero(at[1:] > at[:-1])
            yield tx.mix((sums[at[filled + 1]] - sums[at[filled]]) + filled.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64((tag << 20) + turn)), max(0, len(filled) - d)
            if len(filled) > d:
                return


class Index:
    """Inverted lists from shingles to the sets of a block."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int) -> None:
        self.num, self.den, self.sizes = num, den, np.array([len(s) for s in sets], np.int64)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        self.tokens, at = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_inverse=True)
        self.members = memoryview(np.ascontiguousarray(owners[np.argsort(at, kind="stable")]))  # ascending in each list
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(self.tokens)))]).astype(np.int64)

    def search(self, s: np.ndarray, label: np.ndarray, own: int, share: float = 0.0085) -> list[int]:
        """One set that reaches the overlap with s for each label that has any, but for the label own."""
        n = len(s)
        low, high = ceil(n * self.num / self.den), n * self.den // self.num
        wanted = (self.sizes >= low) & (self.sizes <= high) & (label != own)
        if not n or not wanted.any() or not len(self.tokens):
            return []
        at = np.minimum(np.searchsorted(self.tokens, s), len(self.tokens) - 1)
        at = at[self.tokens[at] == s]
        least = needed(n, low, self.num, self.den)
        if len(at) < least:
            return []
        lens = self.begin[at + 1] - self.begin[at]
        order = np.argsort(-lens, kind="stable")
        many = min(least - 1, int(least / (share * log2(max(2, int(lens.max()))) + 1)))
        lists = [(int(self.begin[i]), int(self.begin[i + 1])) for i in at[order]]
        long, short = lists[:many], lists[many:]
        found = []
        for c, run in groupby(heapq.merge(*(self.members[i:j] for i, j in short))):
            if not wanted[c] or (shared := sum(1 for _ in run)) < least - many:
                continue
            need, left = needed(n, int(self.sizes[c]), self.num, self.den), len(long)
            for i, j in long:
                if shared >= need or shared + left < need:
                    break
                k = bisect_left(self.members, c, i, j)
                shared += k < j and self.members[k] == c
                left -= 1
            if shared >= need:
                found.append(c)
                wanted &= label != label[c]
        return found


def link_block(sets: list[np.ndarray], visits: np.ndarray, num: int, den: int) -> np.ndarray:
    """Component label of each set. Visits are only searched for in the others, which are not searched for themselves if there are any."""
    label = np.arange(len(sets))
    index = Index([s if not v else s[:0] for s, v in zip(sets, visits, strict=True)], num, den)
    done = ~visits if visits.any() else np.zeros(len(sets), bool)
    while True:
        anchor = int(np.bincount(label).argmax())  # labels are places of members
        todo = np.flatnonzero(~done & ((label != anchor) | visits))
        if done.any() and not len(todo):
            return label
        # first a set whose size is in the middle: the likeliest centre of a large group
        for q in todo if done.any() else np.argsort(index.sizes, kind="stable")[[len(sets) // 2]]:
            if label[q] == label[anchor] and done.any() and not visits[q]:
                continue
            done[q] = True
            for c in index.search(sets[q], label, label[q]):
                label[label == label[q]] = label[c]


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 4, den: int = 5, block_size: int = BLOCK_SIZE) -> DataFrame:
    """One row for each document: key, n_shingles, component_id (least key reachable by links).

    Keys are integers. The similarity is at least num/den.
    """
    found = checkpoint(_classes(docs, key, text, words))
    light = found.filter("piece IS NULL").drop("piece", "packed")
    heavy, total = _heavy(found.filter("piece IS NOT NULL").select("piece", "packed"))
    nodes = light.filter("n > 0").groupBy("f1", "f2", "n").agg(F.min("key").alias("node"))
    blocks = components(_candidates(docs, text, words, Signatures(num, den, heavy), max(1, int(total * 0.4 / BUCKET))))
    # one member of a class stands for it: its text is read again, once
    blocks = blocks.withColumnRenamed("node", "owner")
    owners = nodes.filter("node IS NOT NULL").select("node", F.shiftrightunsigned("f1", 32).alias("owner"))
    # sets whose hashes agree when they are cut are one owner there: they meet in its block or, if it has none, in one of their own
    alike = owners.groupBy("owner").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1").join(blocks, "owner", "left_anti")
    blocks = blocks.unionByName(alike.select("owner", F.col("owner").alias("component")))
    active = owners.join(blocks, "owner").select("node", F.col("component").alias("block"))
    sizes = active.groupBy("block").agg(F.countDistinct("node").alias("size"), F.min("node").alias("pivot")).withColumn("parts", F.ceil(F.col("size") / block_size))
    active = checkpoint(active.distinct().join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))))
    pivots = active.filter("node = pivot AND parts > 1").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    members = active.unionByName(pivots).select("node", "block", "part", F.lit(False).alias("visit")).distinct()
    links = checkpoint(_link(docs, key, text, members.withColumn("group", F.lit(0).cast("long")), words, num, den))
    groups = components(links)
    big = active.filter("parts > 1")
    if big.limit(1).count():
        found = big.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
        main = found.filter("node = pivot").select("block", F.col("component").alias("main"))
        strays = checkpoint(found.join(main, "block").filter("component <> main"))
        # visits of a block come in groups, each of which meets every part
        groups_of = strays.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / block_size).alias("groups"))
        come = strays.join(groups_of, "block").withColumn("group", F.pmod(F.xxhash64("node", F.lit(3)), F.col("groups")))
        come = come.withColumn("own", F.col("part")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        visits = come.filter("part <> own").select("node", "block", "part", "group", F.lit(True).alias("visit"))
        residents = members.join(groups_of, "block").withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).drop("groups")
        links = links.unionByName(_link(docs, key, text, residents.unionByName(visits), words, num, den))
        groups = components(links)
    labelled = nodes.join(groups, "node", "left").select("f1", "f2", "n", F.coalesce("component", "node").alias("component"))
    out = light.join(labelled, ["f1", "f2", "n"], "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component_id"))


def _classes(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """A row for each document with its set's hashes and size, and rows with pieces of the task's counters of shingles."""
    names = ["key", "f1", "f2", "n", "piece", "packed"]
    types = [pa.int64()] * 4 + [pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, counters = tx.Powers(), np.zeros(1 << COUNTERS, np.int64)
        for batch in batches:
            rows = []
            for _, _, data, offsets in tx.slices(batch.column(1)):
                sets = list(shingle_sets(data, offsets, words, powers))
                counters += np.bincount(counter_of(np.concatenate(sets)), minlength=1 << COUNTERS)
                rows += [(*fingerprint(s), len(s)) for s in sets]
            f1, f2, n = np.array(rows, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f1), pa.array(f2), pa.array(n), *(pa.nulls(len(n), t) for t in types[4:])], names=names)
        if counters.any():
            packed = [c.tobytes() for c in np.split(counters, PIECES)]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(PIECES, t) for t in types[:4]), pa.array(range(PIECES), pa.int32()), pa.array(packed, pa.binary())], names=names)

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(tx.giving_back(run), "key long, f1 long, f2 long, n long, piece int, packed binary")


def _heavy(pieces: DataFrame) -> tuple[np.ndarray, int]:
    """Which counters stand out, twice the mean and more, and the number of shingles. The counters have a fixed size."""

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in part["packed"])
        return pd.DataFrame({"piece": part["piece"].iloc[:1], "packed": [total.tobytes()]})

    salted = pieces.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    some = salted.groupBy("piece", "salt").applyInPandas(add, "piece int, packed binary")
    counters = np.zeros((PIECES, (1 << COUNTERS) // PIECES), np.int64)
    for r in some.groupBy("piece").applyInPandas(add, "piece int, packed binary").collect():
        counters[r["piece"]] = np.frombuffer(r["packed"], np.int64)
    counters = counters.ravel()
    return counters > 2 * counters.mean() + 100, int(counters.sum())


#: What a signature is packed as: the part of its hash that isn't told by its bucket, the owner's first hash, cut, and the mark.
_PACKED = (np.uint32, np.uint32, np.uint8)


def _pack(*columns: np.ndarray) -> bytes:
    return b"".join(x.astype(kind, copy=False).tobytes() for x, kind in zip(columns, _PACKED, strict=True))


def _unpack(rows: Iterator[bytes]) -> list[np.ndarray]:
    out = [[np.zeros(0, kind)] for kind in _PACKED]
    for x in rows:
        n, at = len(x) // sum(np.dtype(kind).itemsize for kind in _PACKED), 0
        for to, kind in zip(out, _PACKED, strict=True):
            to.append(np.frombuffer(x, kind, n, at))
            at += to[-1].nbytes
    return [np.concatenate(x) for x in out]


def _repeated(tokens: np.ndarray) -> np.ndarray:
    """Which tokens occur more than once."""
    order = np.argsort(tokens)
    same = np.concatenate([[False], tokens[order][1:] == tokens[order][:-1], [False]])
    out = np.zeros(len(tokens), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _shared(tokens: np.ndarray, owners: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those that have a token in common with others, each once, by token and owner."""
    twice = _repeated(tokens)
    tokens, ids = tokens[twice], _id(owners[twice], marks[twice])
    order = np.lexsort((ids, tokens))
    tokens, ids = tokens[order], ids[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (ids[1:] != ids[:-1])
    tokens, ids = tokens[new], ids[new]
    twice = _repeated(tokens)
    return tokens[twice], ids[twice] >> np.uint64(8), (ids[twice] & np.uint64(255)).astype(np.uint8)


def _id(owners: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return owners.astype(np.uint64) << np.uint64(8) | marks


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    return (tx.mix(ids) >> np.uint64(64 - bits)).astype(np.int64)


def _candidates(docs: DataFrame, text: str, words: int, signatures: Signatures, buckets: int) -> DataFrame:
    """Edges between (first hashes, cut to 32 bits, of) classes that share a signature and may share enough: src, dst."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, done = tx.Powers(), set()
        tokens, owners, marks, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            t, o, m = np.concatenate(tokens), np.concatenate(owners), np.concatenate(marks)
            bucket = (t >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            order = np.argsort(bucket)
            t, o, m = t[order], o[order], m[order]
            at = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            full = np.flatnonzero(at[1:] > at[:-1])
            packed = [_pack(t[i:j] & np.uint64(0xFFFFFFFF), o[i:j], m[i:j]) for i, j in zip(at[full], at[full + 1], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(packed, pa.binary())], names=["bucket", "packed"])

        for batch in batches:
            for _, _, data, offsets in tx.slices(batch.column(0)):
                for s in shingle_sets(data, offsets, words, powers):
                    if not len(s) or (whole := fingerprint(s)) in done:
                        continue
                    done.add(whole)
                    for t, mark in signatures.cuts(s):
                        tokens.append(t)
                        owners.append(np.full(len(t), whole[0] >> 32 & 0xFFFFFFFF, np.uint32))
                        marks.append(np.full(len(t), mark, np.uint8))
                        held += len(t)
                if held > BUCKET:
                    yield flush()
                    tokens, owners, marks, held = [], [], [], 0
        if held:
            yield flush()

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        found = _shared(*_unpack(part["packed"]))
        return pd.DataFrame({"packed": [_pack(*found)] if len(found[0]) else []})

    signed = docs.select(text).mapInArrow(tx.giving_back(sign), "bucket int, packed binary")
    shared = checkpoint(signed.groupBy("bucket").applyInPandas(meet, "packed binary"))
    bits = min(MAP_BITS, max(16, (buckets * BUCKET // 32).bit_length()))
    enough = _enough(shared, bits)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                tokens, owners, marks = _unpack([x.as_py()])
                at = _places(_id(owners, marks), bits)
                stay = (enough[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
                tokens, owners, _ = _shared(tokens[stay], owners[stay], marks[stay])
                new = np.ones(len(tokens), bool)
                new[1:] = tokens[1:] != tokens[:-1]
                nodes, roots = local_components(owners[new][np.cumsum(new) - 1], owners)
                other = nodes != roots
                yield pa.RecordBatch.from_arrays([pa.array(nodes[other].astype(np.int64)), pa.array(roots[other].astype(np.int64))], names=["src", "dst"])

    return shared.mapInArrow(tx.giving_back(link), "src long, dst long")


def _enough(shared: DataFrame, bits: int) -> np.ndarray:
    """A map of bits, of bounded size, with the places of all cuts of sets that share as many signatures as links by them need, and of few others."""

    def count_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                ids, times = np.unique(_id(*_unpack([x.as_py()])[1:]), return_counts=True)
                place = _places(ids, bits)
                order = np.argsort(place)
                at = np.searchsorted(place[order], np.arange(SLICES + 1) << bits >> SLICES.bit_length() - 1)
                full = np.flatnonzero(at[1:] > at[:-1])
                packed = [_pack(ids[k] >> np.uint64(8), np.minimum(times[k], 127), ids[k] & np.uint64(255)) for k in (order[i:j] for i, j in zip(at[full], at[full + 1], strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(packed, pa.binary())], names=["slice", "packed"])

    def mark(part: pd.DataFrame) -> pd.DataFrame:
        owners, times, marks = _unpack(part["packed"])
        ids, at = np.unique(_id(owners, marks), return_inverse=True)
        stay = np.bincount(at, times) >= (ids & np.uint64(127)).astype(np.int64)
        own = np.zeros((1 << bits) // SLICES, bool)
        own[_places(ids[stay], bits) % len(own)] = True
        return pd.DataFrame({"slice": part["slice"].iloc[:1], "bits": [np.packbits(own).tobytes()]})

    counted = shared.mapInArrow(tx.giving_back(count_), "slice int, packed binary")
    out = np.zeros((SLICES, (1 << bits) // SLICES // 8), np.uint8)
    for r in counted.groupBy("slice").applyInPandas(mark, "slice int, bits binary").collect():
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def _link(docs: DataFrame, key: str, text: str, members: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Edges of the links that searches inside each block part find."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates().sort_values("node", kind="stable")
        powers = tx.Powers()
        sets = [s for _, _, data, offsets in tx.slices(pa.array(part["text"], pa.string())) for s in shingle_sets(data, offsets, words, powers)]
        label = link_block(sets, part["visit"].to_numpy(bool), num, den)
        node = part["node"].to_numpy(np.int64)
        root = node[np.unique(label, return_index=True)[1]][np.unique(label, return_inverse=True)[1]]
        return pd.DataFrame({"src": node[root != node], "dst": root[root != node]})

    # most texts have no likely partner and stay where they are
    texts = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))
    texts = mark_likely(texts, "node", members.select("node"), "likely").filter("likely")
    # rows may be repeated, any share of them: a task sends each text once
    texts = texts.groupBy("node").agg(F.collect_set("text").alias("text")).select("node", F.explode("text").alias("text"))
    return members.join(texts, "node").groupBy("block", "part", "group").applyInPandas(run, "src long, dst long")
