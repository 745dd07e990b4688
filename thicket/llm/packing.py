"""Best-fit packing by a configuration linear program.

Texts become token ids and an end id; only longer ones are cut into pieces of the
sequence length, the first piece being the shorter. The length histogram (at most as many
entries as the sequence length, whatever the input) goes to the driver. There the
configuration linear program "cover each length's pieces with as few filled sequences as
possible" is solved by multiplicative weights: prices grow on what is covered least, and a
knapsack dynamic program finds the best filled sequence at these prices. Prices are also a
solution of the dual program, so that each pass gives a lower bound. The best cover is
rounded down, and what is left is packed best fit first, longest first. Each piece then
finds its sequence and place from its rank among the pieces of its length.

Defined cases: null and empty texts are the end id alone; repeated rows are packed each;
an empty table gives no rows; very long texts are many pieces; rows without a key are packed
like others. Only the key and the text are read, so that other columns' names don't matter. Ranks of a length that holds most pieces are made in cells.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from . import tokens
from .shared import checkpoint, hot_rank

#: Share of the dual bound that a plan may lie above it before better prices are looked for.
GAP = 0.0005
#: Phases of the search for prices, and steps of each: after each phase it begins anew at the best prices, with half the share a step covers.
PHASES, STEPS = 5, 300
#: Steps in which whole configurations are taken at these prices, at most (best fit packs the rest), and the share that a step takes.
DIVES, DIVE = 2500, 0.3


def knapsack(prices: np.ndarray, lengths: np.ndarray, room: int) -> tuple[np.ndarray, float]:
    """Unbounded knapsack: which length is taken last in the dearest filling of each room (-1: none), and the whole room's value."""
    of, index = np.full(room + 1, -1e9), np.full(room + 1, -1)
    of[lengths], index[lengths] = prices, np.arange(len(lengths))
    value, last = np.zeros(room + 1), np.full(room + 1, -1)  # value[room - j] is that of room j
    for j in range(int(lengths[0]), room + 1):
        gain = value[room - j + 1 :] + of[1 : j + 1]
        k = int(gain.argmax())
        if gain[k] > value[room - j + 1]:
            value[room - j], last[j] = gain[k], index[k + 1]
        else:
            value[room - j] = value[room - j + 1]
    return last, float(value[0])


def config_of(first: int | None, last: np.ndarray, lengths: np.ndarray, room: int) -> dict[int, int]:
    """The dearest sequence that holds a piece of the length first, or any."""
    out, j = ({}, room) if first is None else ({first: 1}, room - int(lengths[first]))
    while j > 0:
        if (k := int(last[j])) < 0:
            j -= 1
        else:
            out[k] = out.get(k, 0) + 1
            j -= int(lengths[k])
    return out


@dataclass
class Program:
    """Fractional configurations that cover all pieces, their number, and the dual bound: no packing has fewer sequences."""

    used: list[tuple[float, int, dict[int, int]]]  # how often, the length they are priced for, {index of length: pieces}
    primal: float
    dual: float


def cover(lengths: np.ndarray, counts: np.ndarray, room: int, base: np.ndarray, sharpness: float) -> Program:
    """One pass: cover all lengths, each price being base times an exponential that falls from exp(sharpness) as its length is covered.

    Each step prices the dearest sequence that holds the longest uncovered length by the knapsack, and uses it until one of
    its lengths is covered whole, whose price is 0 from then on; so there are as many steps as lengths, at most. Prices over
    the value of the dearest sequence of all are a solution of the dual program.
    """
    covered, used, dual = np.zeros(len(lengths)), {}, 0.0
    while len(open_ := np.flatnonzero(covered < 1 - 1e-9)):
        k = open_[-1]
        prices = base[open_] * np.exp(sharpness * (1 - covered[open_]))
        last, value = knapsack(prices, lengths[open_], room)
        dual = max(dual, float(prices @ counts[open_]) / value)
        config = {int(open_[i]): a for i, a in config_of(len(open_) - 1, last, lengths[open_], room).items()}
        at, a = np.fromiter(config, np.int64), np.fromiter(config.values(), np.float64)
        often = float(((1 - covered[at]) * counts[at] / a).min())
        covered[at] = np.minimum(1.0, covered[at] + a * often / counts[at])
        key = (int(k), tuple(sorted(config.items())))
        used[key] = used.get(key, 0.0) + often
    return Program([(often, k, dict(config)) for (k, config), often in used.items()], sum(used.values()), dual)


def weigh(lengths: np.ndarray, counts: np.ndarray, room: int, enough: float = np.inf, phases: int = PHASES, steps: int = STEPS, share: float = 0.3) -> tuple[np.ndarray, float]:
    """Prices by multiplicative weights, and their dual bound; it ends when that is enough.

    Each step uses the dearest sequence for a share of the length in it that it covers fastest; a price falls exponentially
    as its length is covered, by this step and all before. A phase's prices are the average over its steps, which is what
    converges, and the next phase begins at the best ones so far.
    """
    best, dual = lengths / room, 0.0
    for _ in range(phases):
        covered, total = np.zeros(len(lengths)), np.zeros(len(lengths))
        for _ in range(steps):
            prices = best * np.exp(covered.min() - covered)
            last, value = knapsack(prices, lengths, room)
            bound = float(prices @ counts)
            if bound / value > dual and bound / value >= enough:
                return prices / value, bound / value
            total += prices / bound
            config = config_of(None, last, lengths, room)
            at, a = np.fromiter(config, np.int64), np.fromiter(config.values(), np.float64)
            covered[at] += a / counts[at] * (share * (counts[at] / a).min())
        _, value = knapsack(total, lengths, room)
        bound = float(total @ counts) / value
        if bound > dual:
            best, dual = total / value, bound
        if dual >= enough:
            break
        share /= 2
    return best, dual


def solve(lengths: np.ndarray, counts: np.ndarray, room: int, sharpness: float = 0.2, gap: float = 0.002) -> Program:
    """The better of two covers, and the best dual bound.

    The first starts from the share of a sequence that each length takes. If it isn't within gap of its bound, better prices
    are looked for, and a second cover starts from these.
    """
    first = cover(lengths, counts, room, lengths / room, sharpness)
    if first.primal <= first.dual * (1 + gap):
        return first
    prices, dual = weigh(lengths, counts, room, first.primal / (1 + gap))
    second = cover(lengths, counts, room, prices + lengths / room / 1000, sharpness)
    best = min(first, second, key=lambda x: x.primal)
    return Program(best.used, best.primal, max(first.dual, second.dual, dual))


def dive(lengths: np.ndarray, counts: np.ndarray, room: int, prices: np.ndarray, steps: int = DIVES, share: float = DIVE, sharpness: float = 0.5) -> list[tuple[int, dict[int, int]]]:
    """Whole configurations at prices: each step takes the dearest one for a share of what its scarcest length has left.

    The price of a length whose share left is above the mean rises exponentially, below it falls, so that lengths run
    out together. What is left after the steps is packed best fit.
    """
    left, out = counts.astype(np.int64).copy(), []
    for _ in range(steps):
        open_ = np.flatnonzero(left)
        if not len(open_):
            break
        rest = left[open_] / counts[open_]
        now = prices[open_] * np.exp(np.clip(sharpness * (rest / rest.mean() - 1), -3, 3))
        last, _ = knapsack(now, lengths[open_], room)
        config = {int(open_[i]): min(a, int(left[open_[i]])) for i, a in config_of(None, last, lengths[open_], room).items()}
        many = max(1, int(share * min(left[i] // a for i, a in config.items())))
        for i, a in config.items():
            left[i] -= a * many
        out.append((many, config))
    return out + best_fit(lengths, left, room)


def best_fit(lengths: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[int, dict[int, int]]]:
    """Best fit of whole groups of pieces, longest first: (how many sequences, {index: pieces})."""
    open_: dict[int, list[list]] = {}
    for k in np.argsort(-lengths, kind="stable"):
        size, left = int(lengths[k]), int(counts[k])
        for free in sorted(f for f in open_ if f >= size):
            kept = []
            for many, config in open_.pop(free):
                each = free // size
                whole = min(many, left // each)
                odd = left - whole * each if whole < many else 0
                odd = min(odd, each - 1) if each > 1 else 0
                left -= whole * each + odd
                if whole:
                    open_.setdefault(free - each * size, []).append([whole, config | {int(k): each}])
                if odd:
                    open_.setdefault(free - odd * size, []).append([1, config | {int(k): odd}])
                if many - whole - bool(odd):
                    kept.append([many - whole - bool(odd), config])
            if kept:
                open_.setdefault(free, []).extend(kept)
            if not left:
                break
        if left:
            each = room // size
            if left // each:
                open_.setdefault(room - each * size, []).append([left // each, {int(k): each}])
            if left % each:
                open_.setdefault(room - left % each * size, []).append([1, {int(k): left % each}])
    return [(many, config) for groups in open_.values() for many, config in groups]


def rounded(program: Program, lengths: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[int, dict[int, int]]]:
    """Whole configurations: the cover rounded down, then best fit of what is left."""
    left, out, carried = counts.astype(np.int64).copy(), [], np.zeros(len(lengths))
    for often, k, config in sorted(program.used, key=lambda x: -x[0]):
        # what rounding takes from one configuration of a length goes to its next one
        wanted = often + carried[k] + 1e-9
        many = min(int(wanted), *(int(left[i]) // a for i, a in config.items()))
        carried[k] = min(wanted - many, 1.0)
        if many:
            out.append((many, config))
            for i, a in config.items():
                left[i] -= many * a
    return out + best_fit(lengths, left, room)


def sequences(found: list[tuple[int, dict[int, int]]]) -> int:
    return sum(many for many, _ in found)


def plan(lengths: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[int, dict[int, int]]]:
    """Whole configurations that hold exactly counts pieces: the best of the rounded cover, best fit, and, if neither is close to the bound, a dive at better prices."""
    if not len(lengths):
        return []
    program = cover(lengths, counts.astype(float), room, lengths / room, 0.2)
    best = min(rounded(program, lengths, counts, room), best_fit(lengths, counts, room), key=sequences)
    close = lambda dual: sequences(best) <= max(dual, float(lengths @ counts) / room) * (1 + GAP) + 1
    if close(program.dual):
        return best
    prices, dual = weigh(lengths, counts.astype(float), room)
    return best if close(dual) else min(best, dive(lengths, counts, room, prices), key=sequences)


def pieces(docs: DataFrame, key: str, text: str, room: int, end_id: int, path: str, with_ids: bool = False) -> DataFrame:
    """key, piece, start, length, ids_crc32 (of little-endian unsigned 32-bit ids), _salt; and ids (array) if asked for."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokens.worker_ids(path)
        for batch in batches:
            for i, j, data, offsets in tx.slices(batch.column(1)):
                ids, first = ids_of.encode(data, offsets)
                rows: tuple[list, ...] = ([], [], [], [], [], [])
                for at in range(j - i):
                    own = np.append(ids[first[at] : first[at + 1]], end_id).astype("<u4")
                    head = (len(own) - 1) % room + 1
                    for n, start in enumerate([0, *range(head, len(own), room)]):
                        stop = head if n == 0 else start + room
                        for column, x in zip(rows, (i + at, n, start, stop - start, zlib.crc32(own[start:stop].tobytes()), own[start:stop].tolist() if with_ids else None), strict=True):
                            column.append(x)
                out = [batch.column(0).take(pa.array(rows[0], pa.int64())), *(pa.array(c, t) for c, t in zip(rows[1:5], (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))]
                if with_ids:
                    out.append(pa.array(rows[5], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=["_key", "piece", "start", "length", "ids_crc32", "ids"][: len(out)])

    return docs.select(F.col(key), F.col(text)).mapInArrow(tx.giving_back(run), f"_key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", room: int = 1024, end_id: int = 2, path: str = tokens.BYTE_BPE, with_ids: bool = False, seed: int = 5) -> DataFrame:
    """One row for each piece: _key, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    cut = checkpoint(pieces(docs, key, text, room, end_id, path, with_ids))
    found = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).orderBy("length").collect()  # room rows at most
    lengths, counts = np.array([r["length"] for r in found], np.int64), np.array([r["n"] for r in found], np.int64)
    rows, sequence = [], 0
    for many, config in plan(lengths, counts, room):
        offset = 0
        for k, a in config.items():
            rows.append((k, many, a, sequence, offset))
            offset += a * int(lengths[k])
        sequence += many
    # places of each length's pieces, by rank: rank range, pieces in a sequence, first sequence, first offset
    slots = np.array(sorted(rows, key=lambda r: r[0]), np.int64).reshape(-1, 5)
    held = slots[:, 1] * slots[:, 2]
    begin = np.cumsum(held) - held
    base = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "_rank"))
            global_rank = base[np.searchsorted(lengths, length)] + rank
            slot = np.searchsorted(begin, global_rank, "right") - 1
            within, a = global_rank - begin[slot], slots[slot, 2]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(slots[slot, 3] + within // a), pa.array(slots[slot, 4] + within % a * length)], names=[*names, "sequence_id", "offset"])

    names = cut.columns
    sizes = docs.sparkSession.createDataFrame([(int(a), int(n)) for a, n in zip(lengths, counts, strict=True)], "length long, _n long")
    salted = cut.withColumn("_salt", F.xxhash64("_key", "piece", "ids_crc32", F.lit(seed)))
    # sizes has one row for each length, room at most
    ranked = hot_rank(salted.join(F.broadcast(sizes), "length"), ["length"], "_n", ["_salt", "_key", "piece", "ids_crc32"], "_salt", "_rank")
    schema = cut.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    return ranked.select(*names, "_rank").mapInArrow(tx.giving_back(place), schema)
