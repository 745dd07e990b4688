"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

A text becomes a sparse vector over 2**bits buckets: words, word pairs, the shapes
of words ("Ab9%" for "Haus42%%") and pairs of shapes, a pair of equal words having a
shape of its own. Each family is divided by its number of n-grams. The model is
fitted with FTRL-proximal updates, one example at a time, on the features of a bounded
sample of labelled rows, in one task, which gives the driver the weights; scoring is a sparse dot product for each text, inside Arrow batches,
and reads every whole text.

Defined cases: a null or empty text is scored by the bias alone; null labels are not
learned from; without any label every score is 0.5; repeated rows get equal scores;
rows with a null key are scored and count as held out only if the fold of "" is; very long
texts are scored whole; an empty table gives no rows. Columns of docs stay, but for one
named like the score, which the score replaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import fold, hash_sample, others

#: Labelled rows that the model is fitted on, about (those with the least hashes of their keys).
FIT_ROWS = 8000
BITS = 18
#: Fitting ends when the mean log loss of a pass is below ENOUGH, or PATIENCE passes have not lowered it by a share of LEAST_GAIN.
ENOUGH, PATIENCE, LEAST_GAIN = 0.02, 3, 0.01


@dataclass(frozen=True)
class QualityModel:
    bits: int
    weights: np.ndarray
    bias: float


def _shapes() -> np.ndarray:
    kinds = np.arange(256, dtype=np.uint8)
    kinds[97:123] = 97
    kinds[65:91] = 65
    kinds[48:58] = 48
    kinds[128:] = 97
    return kinds


def features(data: np.ndarray, offsets: np.ndarray, bits: int, powers: tx.Powers) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, four for each word, in text order; the first word of each text."""
    words, first, starts, ends = tx.word_hashes(data, offsets, powers)
    kinds = _shapes()[data]
    turn = np.ones(len(data), bool)
    turn[1:] = kinds[1:] != kinds[:-1]
    turn[starts] = True
    place = np.concatenate([[0], np.cumsum(turn)])
    shapes = tx.span_hash(kinds[turn], place[starts], place[ends], powers)
    out = np.empty((4, len(words)), np.int64)
    last = np.zeros(len(words), bool)
    last[first[1:][first[1:] > first[:-1]] - 1] = True
    shift = np.uint64(64 - bits)
    for at, (one, salt) in enumerate(((words, 1), (shapes, 3))):
        following = np.where(last, np.uint64(salt), np.roll(one, -1))
        pair = one * np.uint64(0x9FB21C651E98DF25) + following
        if at:
            pair = np.where(~last & (words == np.roll(words, -1)), np.uint64(0x517CC1B727220A95), pair)
        out[2 * at] = tx.mix(one + np.uint64(salt)) >> shift
        out[2 * at + 1] = tx.mix(pair + np.uint64(salt + 1)) >> shift
    return out, first


def example(buckets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A text's buckets and their shares of its words; the last one is the bias."""
    at, counts = np.unique(buckets, return_counts=True)
    return np.append(at, 1 << bits).astype(np.uint32), np.append(counts / max(1, buckets.shape[1]), 1.0).astype(np.float32)


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: list[int], bits: int = BITS, alpha: float = 0.3, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3, seed: int = 7) -> QualityModel:
    """FTRL-proximal over the examples in seeded orders, until the mean loss of a pass is small or falls no more."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    rng = np.random.default_rng(seed)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= l1, 0.0, (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(n[at])) / alpha + l2))

    lowest, since = np.inf, 0
    while len(examples) and since < PATIENCE and lowest > ENOUGH:
        loss = 0.0
        for k in rng.permutation(len(examples)):
            at, x = examples[k]
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            loss -= np.log(max(1e-15, p if labels[k] else 1 - p))
            g = (p - labels[k]) * x
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
        loss /= len(examples)
        since = 0 if loss < lowest * (1 - LEAST_GAIN) else since + 1
        lowest = min(lowest, loss)
    final = weights(slice(None))
    return QualityModel(bits, final[:-1].astype(np.float32), float(final[-1]))


def _packed(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[tuple[bytes, int]]:
    """Packed examples (buckets, then shares) and labels of batches of _y, _t; a text of any length has at most 2**bits + 1 of each."""
    powers = tx.Powers()
    for batch in batches:
        labels = batch.column(0).to_pylist()
        for i, _, data, offsets in tx.slices(batch.column(1)):
            buckets, first = features(data, offsets, bits, powers)
            for k, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True), i):
                yield b"".join(x.tobytes() for x in example(buckets[:, a:b], bits)), labels[k]


def learn(texts: DataFrame, bits: int = BITS) -> DataFrame:
    """texts has _y, _t, in one partition. One row: the weights, the bias; examples stay in the task, so that the driver gets the model alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(_packed(batches, bits))  # an order that does not depend on how rows came
        cut = [len(packed) // 2 for packed, _ in found]
        made = fit([(np.frombuffer(x, np.uint32, n // 4), np.frombuffer(x, np.float32, n // 4, n)) for (x, _), n in zip(found, cut, strict=True)], [y for _, y in found], bits)
        yield pa.RecordBatch.from_arrays([pa.array([made.weights.tobytes()], pa.binary()), pa.array([made.bias])], names=["weights", "bias"])

    return texts.select("_y", "_t").mapInArrow(tx.giving_back(run), "weights binary, bias double")


def fit_on(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 5, held_out: int = 0, fit_rows: int = FIT_ROWS) -> QualityModel:
    """Fit on about fit_rows labelled rows, chosen by a hash of their keys, whose crc32(key) mod folds is not held_out."""
    known = labels.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y")).filter(F.col("_y").isin(0, 1) & F.col("_k").isNotNull() & (fold("_k", folds) != held_out))
    chosen = hash_sample(known.distinct(), "_k", fit_rows, 11)
    # chosen has about fit_rows keys with two labels at most, so that it can be broadcast whatever the input's size, and whatever keys repeat
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(F.broadcast(chosen), "_k").orderBy(F.xxhash64("_k", F.lit(11)), "_k", "_y", F.xxhash64("_t")).limit(fit_rows)
    model = learn(rows.coalesce(1)).first()
    return fit([], []) if model is None else QualityModel(BITS, np.frombuffer(model["weights"], np.float32), model["bias"])


def score(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability of label 1 of each whole text."""
    names = others(docs, out)
    docs, at = docs.select(*names), names.index(text)
    schema = docs.select("*", F.lit(0.0).alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = tx.Powers()
        for batch in batches:
            scores = np.empty(len(batch))
            for i, j, data, offsets in tx.slices(batch.column(at)):
                buckets, first = features(data, offsets, model.bits, powers)
                sums = tx.segment_sums(model.weights[buckets].sum(0, dtype=np.float64), first)
                scores[i:j] = model.bias + sums / np.maximum(1, np.diff(first))
            columns = [*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(scores, -35, 35))))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, out])

    return docs.mapInArrow(tx.giving_back(run), schema)
