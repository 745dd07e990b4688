"""Mixing sources to target weights: subset-sum budget fitting.

Documents are counted by exact length for each source. A source's target is its share
by weight of share times all words, at most cap times its own words, the excess being
shared again by weight. Each length gives its proportion of the budget but for a remaining part,
which a bounded-knapsack dynamic program over the copies left fills with lengths. Documents are then chosen by a seeded
hash, as many of each length as the fit says.

Defined cases: null and empty texts have length 0 and are taken 0 times; a null source
is a source of its own that sorts last; a source without words has target 0; repeated
rows count as documents of their own, and rows without a key too; very long texts are
counted whole; an empty table gives no rows; results do not depend on partitioning, but
which of rows that are equal in key and salt is taken. Only the key, the text, the source
and the salt are read, so that other columns' names don't matter.

Sizes: the driver gets one row for each source; a source's fit sees one row for each of
its lengths. Rows of one source and length are dealt to SALTS tasks by the join, and ranked
in cells (shared.hot_rank).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import checkpoint, hot_rank

WORDS = r"[^\x20\x09-\x0D]+"
#: Tasks that rows of one source and length are dealt to.
SALTS = 32
#: Longest documents that the part of a budget which the knapsack fills could hold, at most.
DEPTH = 32


def targets(sizes: dict[str, int], weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> dict[str, float]:
    """Targets of the sources, given in their order; weights repeat."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    left, open_, out = share * sum(sizes.values()), list(sizes), dict.fromkeys(sizes, 0.0)
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total >= cap * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = float(cap * sizes[s])
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in set(full)]
    return out


def fill(lengths: np.ndarray, counts: np.ndarray, rest: int) -> np.ndarray:
    """How many documents of each length, counts at most, for the sum that is nearest to rest (below it, of two): a bounded knapsack.

    Counts are split into powers of two; by[b] is the part that reached the sum b first, so that parts reached before it
    lead back to 0. Memory grows with rest and the longest length alone.
    """
    taken = np.zeros(len(lengths), np.int64)
    top = rest + int(lengths.max(initial=0))
    reached, by, parts = np.zeros(top + 1, bool), np.full(top + 1, -1, np.int32), []
    reached[0] = True
    for i in np.argsort(-lengths, kind="stable"):
        left, n = min(int(counts[i]), top // int(lengths[i]) if lengths[i] > 0 else 0), 1
        while left > 0 and not reached[rest]:
            n = min(n, left)
            width = n * int(lengths[i])
            new = np.flatnonzero(reached[: top + 1 - width] & ~reached[width:]) + width
            reached[new], by[new] = True, len(parts)
            parts.append((i, n))
            left, n = left - n, n * 2
    sums = np.flatnonzero(reached)
    at = int(sums[np.abs(sums - rest).argmin()])
    while at:
        i, n = parts[by[at]]
        taken[i] += n
        at -= n * int(lengths[i])
    return taken


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, copies: int = 2) -> tuple[int, np.ndarray]:
    """Whole rounds, and how many copies of documents of each length to take besides, for about budget words.

    A document has as many copies as whole rounds need, at most, and one or two fewer at least; if the budget can't be met so,
    it may have up to copies. Each length gives its proportion, rounded down, of what is not kept for the knapsack; then lengths
    give one copy more, those that rounding cost most first, until what is left is below DEPTH times the longest length. That
    is the knapsack's.
    """
    extra = np.zeros(len(lengths), np.int64)
    total = int(lengths @ counts)
    if total <= 0 or budget <= 0:
        return 0, extra
    most = -(-budget // total)
    rounds = max(0, most - 2)
    rest, longest, limit = budget - rounds * total, int(lengths.max()), counts * (most - rounds)
    spread = max(0, rest - DEPTH // 2 * longest)
    share = [int(c) * spread for c in counts.tolist()]  # may pass 64 bits
    extra = np.where(lengths > 0, [x // total for x in share], 0).astype(np.int64)
    rest -= int(lengths @ extra)
    for i in sorted(np.flatnonzero(lengths > 0).tolist(), key=lambda i: (-(share[i] % total), -lengths[i])):
        if rest < DEPTH * longest:
            break
        if extra[i] < limit[i]:
            extra[i] += 1
            rest -= int(lengths[i])
    filled = fill(lengths, limit - extra, rest)
    if most < copies and (gap := abs(int(lengths @ filled) - rest)):
        more = fill(lengths, counts * copies - extra, rest)
        filled = more if abs(int(lengths @ more) - rest) < gap else filled
    return rounds, extra + filled


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 17, salt: Column | None = None) -> DataFrame:
    """One row for each row of docs: _key, _source, size, source_size, target, copies. salt, a long hash, decides which documents of a length are taken."""
    # "s" before the name keeps a null source apart from every text; "t" sorts it last
    of = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("t"))
    salt = F.xxhash64(F.col(key), F.xxhash64(text), F.lit(seed)) if salt is None else salt
    light = checkpoint(docs.select(F.col(key).alias("_key"), salt.alias("_salt"), of.alias("_source"), F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long").alias("size")))
    lengths = checkpoint(light.groupBy("_source", "size").agg(F.count(F.lit(1)).alias("n")))
    sizes = {r["_source"]: int(r["s"]) for r in sorted(lengths.groupBy("_source").agg(F.sum(F.col("size") * F.col("n")).alias("s")).collect(), key=lambda r: r["_source"])}
    goal = targets(sizes, weights, share, cap)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        name = part["_source"].iloc[0]
        part = part.sort_values("size")
        rounds, extra = fit_lengths(part["size"].to_numpy(np.int64), part["n"].to_numpy(np.int64), round(goal[name]))
        return part.assign(source_size=sizes[name], target=goal[name], rounds=rounds, extra=extra)

    plan = lengths.groupBy("_source").applyInPandas(fit, "_source string, size long, n long, source_size long, target double, rounds long, extra long")
    # a source may hold a third of the rows, and one of its lengths most of these
    dealt = plan.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = light.withColumn("_deal", F.pmod(F.xxhash64("_salt", "_key"), F.lit(SALTS)).cast("int")).join(dealt, ["_source", "size", "_deal"])
    chosen = hot_rank(rows, ["_source", "size"], "n", ["_salt", "_key"], "_salt", "_rank")
    return chosen.select("_key", "_source", "size", "source_size", "target", (F.col("rounds") + (F.col("_rank") < F.col("extra")).cast("long") + (F.col("_rank") < F.col("extra") - F.col("n")).cast("long")).alias("copies"))
