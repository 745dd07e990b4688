"""Token counts with a cache: each distinct text is encoded once for each version of a tokenizer.

A text's normal form is what its count depends on: null is empty text, and where the tokenizer
has a normaliser of its own, what that gives. The cache is a folder of Parquet rows (digest of the
normal form, count) for each version; the version is a digest of the tokenizer's library, the
library's version and the tokenizer's file, so that counts of another version are never met.

Defined cases: null and empty texts have as many tokens as the library gives for empty text;
rows without a key, of equal keys and of equal texts each have their own result; an empty table
gives no rows and appends nothing; other columns, whatever their names, are left alone; texts are
encoded whole, whatever their length; special strings inside texts are what the library takes
them for by default. A run that fails may leave counts in the cache; they are right, and the
next run finds them. A digest that two runs at once append twice counts once.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from importlib import metadata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thicket.sources.files import _fs

from . import text as tx
from . import tokens
from .shared import checkpoint, mark_likely

LIBRARIES = {".json": "tokenizers", ".model": "sentencepiece", ".tiktoken": "tiktoken"}
STORED = "digest binary, n_tokens long"


def library(path: str) -> str:
    kind = os.path.splitext(path)[1]
    if kind not in LIBRARIES:
        raise ValueError(f"no library for {path}")
    return LIBRARIES[kind]


def version(path: str) -> str:
    """A digest of what counts depend on besides the text."""
    with open(path, "rb") as f:
        return hashlib.sha256(b"\n".join([library(path).encode(), metadata.version(library(path)).encode(), f.read()])).hexdigest()


def _by_library(path: str) -> Callable[[list[str]], list[int]]:
    """Counts of texts as the library gives them by default, without begin, end, truncation or padding."""
    if library(path) == "sentencepiece":
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
    tokenizer = tokens.Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _rules(path: str) -> tuple[list[str], bool]:
    """Special strings of a tokenizer, and whether it is a plain byte-level one, whose words tokens.Ids remembers."""
    if library(path) != "tokenizers":
        return [], library(path) == "tiktoken"
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    before = rules["pre_tokenizer"] or {}
    plain = rules["normalizer"] is None and rules["post_processor"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    return [t["content"] for t in rules["added_tokens"]], plain


def counter(path: str) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function from bytes and offsets of texts to their numbers of tokens.

    Texts without special strings go through the worker's memory of words; the others whole through the library.
    """
    special, plain = _rules(path)
    whole = None if library(path) == "tiktoken" else _by_library(path)
    marks = [s.encode() for s in special]

    def count(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        raw = data.tobytes()
        texts = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        odd = [i for i, t in enumerate(texts) if not plain or any(m in t for m in marks)]
        out = np.diff(tokens.worker_ids(path).encode(data, offsets)[1]) if plain else np.zeros(len(texts), np.int64)
        if odd:
            out[odd] = whole([texts[i].decode("utf-8", "replace") for i in odd])
        return out

    return count


def normal_form(text: Column, path: str) -> Column:
    """What the count of a text depends on. Texts in which, or in whose normal form, a special string stands are their own form."""
    whole = F.coalesce(text, F.lit(""))
    if library(path) != "tokenizers" or tokens.Tokenizer.from_file(path).normalizer is None:
        return whole
    special, _ = _rules(path)

    @F.pandas_udf("string")
    def form(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        normalizer = tokens.Tokenizer.from_file(path).normalizer
        for texts in batches:
            forms = texts.map(normalizer.normalize_str)
            odd = [any(s in t or s in f for s in special) for t, f in zip(texts, forms, strict=True)]
            yield forms.mask(odd, texts)

    return form(whole)


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def stored(spark: SparkSession, cache: str, path: str) -> DataFrame:
    """The counts of a tokenizer's version that a cache holds, each digest once."""
    p, fs = _fs(spark, f"{cache}/{version(path)}")
    if not fs.exists(p):
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(f"{cache}/{version(path)}").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode(texts: DataFrame, path: str) -> DataFrame:
    """digest, n_tokens of rows digest, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            n = [count(data, offsets) for _, _, data, offsets in tx.slices(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([*n, np.zeros(0, np.int64)]), pa.int64())], names=["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(tx.giving_back(run), STORED)


def count_tokens(docs: DataFrame, cache: str, path: str = tokens.BYTE_BPE, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """_key, n_bytes, n_tokens, over_limit of each row of docs; counts that cache lacks are appended to it.

    Texts move only where they may have to be encoded: those of misses, of which one of each kind leaves a task. All else
    is done on digests. Whether a text may be a miss is told from bits of bounded size, and then by a join.
    """
    form = normal_form(F.col(text), path)
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"), form.alias("text"))
    keyed = checkpoint(rows.select("_key", F.octet_length("_text").cast("long").alias("n_bytes"), digest(F.col("text")).alias("digest")))
    wanted = checkpoint(keyed.select("digest").distinct().join(stored(docs.sparkSession, cache, path), "digest", "left"))
    misses = wanted.filter("n_tokens IS NULL").select("digest")
    held = mark_likely(rows.select(digest(F.col("text")).alias("digest"), "text"), "digest", misses, "_miss").filter("_miss")
    fresh = checkpoint(encode(held.select("digest", "text").dropDuplicates(["digest"]).join(misses, "digest", "left_semi"), path))
    if not fresh.isEmpty():
        fresh.write.mode("append").parquet(f"{cache}/{version(path)}")
    counts = wanted.filter("n_tokens IS NOT NULL").unionByName(fresh)
    found = keyed.join(counts, "digest")
    return found.select("_key", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
