"""Language ID by word-first backoff.

A word seen in training scores by its log frequency in each language; an unseen word
falls back to the longest known character n-gram that ends at each of its characters
(4, then 3, 2, 1 characters, word borders counting as one). Word scores add up over
the whole text; the score of the prediction is its share after a softmax.

The model is fitted on a bounded sample of labelled rows, about docs_per_lang for each
language (rows with the least hash of their key). Counting runs on the executors; the
driver gets one row for each word or n-gram of the sample.

Defined cases: null texts and texts without a letter give "und" with score 0; rows with
a null language are not learned from; without training rows all is "und"; ties go to the
language that sorts first; rows with a null key take part like others; repeated rows get
equal results; very long texts are read whole; an empty table gives no rows. Columns of
docs stay, but for those named like an output, which the output replaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .shared import fold, others

#: Labelled rows of each language that the model is fitted on, about.
DOCS_PER_LANG = 2000
ORDER = 4


@dataclass(frozen=True)
class LangModel:
    langs: list[str]
    words: np.ndarray
    word_scores: np.ndarray
    grams: np.ndarray
    gram_scores: np.ndarray


def letters() -> np.ndarray:
    """For code points up to 65535 the lower-case letter, or 0 for what isn't one."""
    table = np.zeros(65536, np.uint32)
    for i in range(65536):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def runs(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters as code points with a 0 before each text and at the end; starts and ends of words; first word of each text."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    low = table[np.minimum(points, 65535)]
    if (high := points > 65535).any():
        found, at = np.unique(points[high], return_inverse=True)
        low[high] = np.array([ord(chr(c).lower()) if chr(c).isalpha() else 0 for c in found.tolist()], np.uint32)[at]
    low = np.insert(low, places, 0)
    starts, ends, _ = tx.spans(low != 0, np.array([0, len(low)]))
    return low, starts, ends, np.searchsorted(starts, places + np.arange(len(places)))


def grams_of(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: tx.Powers) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, longest first: hashes of the n-grams that end at each place of each word, and which places have one."""
    sizes = ends - starts + 1
    first = np.concatenate([[0], np.cumsum(sizes)])
    within = np.arange(first[-1]) - np.repeat(first[:-1], sizes)
    at = np.repeat(starts, sizes) + within
    for n in range(ORDER, 0, -1):
        valid = within - n + 1 >= -1
        begin = np.where(valid, at - n + 1, at)
        yield tx.span_hash(low, begin, at + 1, powers), valid


def fit_on(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5, held_out: int = 0, docs_per_lang: int = DOCS_PER_LANG) -> LangModel:
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.col(lang).alias("_l")).filter(F.col("_l").isNotNull() & F.col("_t").isNotNull() & (fold("_k", folds) != held_out))
    sizes = {r["_l"]: r["n"] for r in rows.groupBy("_l").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return LangModel([], *(np.zeros(0, np.uint64), np.zeros((0, 0), np.float32)) * 2)
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, docs_per_lang / n)))])
    sample = rows.filter(F.pmod(F.xxhash64("_k", F.lit(13)), F.lit(1_000_000)) < share[F.col("_l")] * 1_000_000).select("_t", "_l")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, table = tx.Powers(), letters()
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            for i, j, data, offsets in tx.slices(batch.column(0)):
                low, starts, ends, first = runs(data, offsets, table)
                owner = np.repeat(np.arange(i, j), np.diff(first))
                for name in dict.fromkeys(names[i:j]):
                    mine = names[owner] == name
                    found = [(0, tx.span_hash(low, starts[mine], ends[mine], powers))]
                    found += [(n, h[valid]) for n, (h, valid) in zip(range(ORDER, 0, -1), grams_of(low, starts[mine], ends[mine], powers), strict=True)]
                    for kind, hashes in found:
                        u, c = np.unique(hashes, return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(u), pa.string()), pa.array(np.full(len(u), kind, np.int32)), pa.array(u.view(np.int64)), pa.array(c.astype(np.int64))], names=["lang", "kind", "hash", "n"])

    counts = sample.mapInArrow(count, "lang string, kind int, hash long, n long").groupBy("kind", "hash", "lang").agg(F.sum("n").alias("n")).toPandas()
    tables = []
    for kinds in ([0], list(range(1, ORDER + 1))):
        of = counts[counts["kind"].isin(kinds)]
        keys, at = np.unique(of["hash"].to_numpy().view(np.uint64), return_inverse=True)
        scores = np.zeros((len(keys), len(langs)))
        totals = np.zeros((ORDER + 1, len(langs)))
        lang_at = of["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=np.int64)
        kind_at = of["kind"].to_numpy(dtype=np.int64)
        n = of["n"].to_numpy(dtype=np.float64)
        np.add.at(totals, (kind_at, lang_at), n)
        np.add.at(scores, (at, lang_at), n)
        kind_of = np.zeros(len(keys), np.int64)
        kind_of[at] = kind_at
        logs = np.log((scores + 0.5) / (totals[kind_of] + 0.5 * max(1, len(keys))))
        tables += [keys, (logs - logs.mean(1, keepdims=True)).astype(np.float32)]
    return LangModel(langs, *tables)


def find(keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes in sorted keys, and which are there."""
    if not len(keys):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return at, keys[at] == hashes


def word_scores(model: LangModel, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: tx.Powers) -> tuple[np.ndarray, np.ndarray]:
    """Scores of each distinct word (rows) by language, and the row of each word."""
    u, index, inverse = np.unique(tx.span_hash(low, starts, ends, powers), return_index=True, return_inverse=True)
    out = np.zeros((len(u), len(model.langs)), np.float32)
    at, known = find(model.words, u)
    out[known] = model.word_scores[at[known]]
    new = index[~known]
    if len(new):
        sizes = ends[new] - starts[new] + 1
        rows = np.zeros((int(sizes.sum()), len(model.langs)), np.float32)
        done = np.zeros(len(rows), bool)
        for hashes, valid in grams_of(low, starts[new], ends[new], powers):
            left = np.flatnonzero(valid & ~done)
            at, there = find(model.grams, hashes[left])
            rows[left[there]] = model.gram_scores[at[there]]
            done[left[there]] = True
        out[~known] = np.add.reduceat(rows, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
    return out, inverse


def predict(docs: DataFrame, model: LangModel, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the predicted language and its score."""
    names = others(docs, out, score)
    docs, at = docs.select(*names), names.index(text)
    schema = docs.select(*names, F.lit("").alias(out), F.lit(0.0).alias(score)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, table = tx.Powers(), letters()
        for batch in batches:
            best, sure = np.full(len(batch), -1), np.zeros(len(batch))
            for i, j, data, offsets in tx.slices(batch.column(at)):
                if not model.langs:
                    break
                low, starts, ends, first = runs(data, offsets, table)
                scores, inverse = word_scores(model, low, starts, ends, powers)
                sums = np.stack([tx.segment_sums(scores[inverse, k], first) for k in range(len(model.langs))], 1)
                sums = np.exp(sums - sums.max(1, keepdims=True))
                some = np.diff(first) > 0
                best[i:j] = np.where(some, sums.argmax(1), -1)
                sure[i:j] = np.where(some, sums.max(1) / sums.sum(1), 0.0)
            labels = pa.array([*model.langs, "und"], pa.string()).take(pa.array(np.where(best < 0, len(model.langs), best)))
            yield pa.RecordBatch.from_arrays([*batch.columns, labels, pa.array(sure)], names=[*names, out, score])

    return docs.mapInArrow(tx.giving_back(run), schema)
