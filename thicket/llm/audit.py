"""How filters interact: what each removes in every order, from wide packed counters.

A document's failures are a mask of five bits. Each mask has an integer whose 600 fields of
64 bits say in which step of each of the 120 orders a document with the mask is removed; a
last field counts documents. Integers of all documents of a part are summed, those of good
and of toxic documents apart, and every figure of the audit is unpacked from the three sums.
A field holds a count of rows, which Spark keeps in 63 bits, so that none reaches its neighbour.

Defined cases: null and empty texts fail no filter but E, which tells them from nothing (null is
empty text); rows without a key are nobody's later copies; rows that share a key and a text are
no copies of each other; a null part is the part of the empty text; a document is good or toxic
if any label of its key says so, and labels without a key say nothing; an empty table has no
parts and so gives no rows; other columns, whatever their names, are left alone; texts are read
whole, whatever their length.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)
#: Bits of a field: a sum of rows fits, whatever their number.
FIELD = 64
#: Bit of the filter that looks at other documents.
COPY = 1 << FILTERS.index("E")

WORD = r"[^\x20\x09-\x0D]+"
RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def own_failures(text: Column) -> Column:
    """The bits of the filters that look at one text only: few words, repeated words, capitals, signs."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    found = {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }
    bits = [F.when(failed, F.lit(1 << FILTERS.index(name))).otherwise(F.lit(0)) for name, failed in found.items()]
    return sum(bits[1:], bits[0])


def packed(mask: int) -> int:
    """The integer of a mask: field 5 * order + step is 1 where that step removes the document; the last field is 1."""
    out = 1 << (FIELD * STEPS)
    for k, order in enumerate(ORDERS):
        for step, name in enumerate(order):
            if mask >> FILTERS.index(name) & 1:
                out |= 1 << (FIELD * (len(FILTERS) * k + step))
                break
    return out


def unpacked(total: int) -> tuple[np.ndarray, int]:
    """The fields of a sum of packed masks, orders by steps, and the number of documents."""
    fields = np.frombuffer(total.to_bytes((STEPS + 1) * FIELD // 8, "little"), "<i8")
    return fields[:-1].reshape(len(ORDERS), len(FILTERS)), int(fields[-1])


def tally(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """part, mask, good, toxic, n: the number of documents of each kind; 128 rows a part at most.

    Copies are found by the SHA-256 of the text. All rows of one text in one part with the same labels are one row,
    summed before the shuffle, so that a text of a third of all rows is no hot key.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("_text"))
    marked = rows.select("_key", "part", own_failures(F.col("_text")).alias("mask"), F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_same"))
    each = marked.groupBy("_key", "part", "mask", "_same").agg(F.count(F.lit(1)).alias("_rows"))
    told = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
    told = told.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    no = F.lit(False)
    known = each.join(told, "_key", "left").withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})
    groups = known.groupBy("_same", "part", "mask", "good", "toxic").agg(
        F.sum("_rows").alias("n"), F.min("_key").alias("_first"), F.min_by("_rows", "_key").alias("_tied"), F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_rows"))), F.lit(0)).alias("_keyless")
    )
    least = F.min("_first").over(Window.partitionBy("_same"))
    first = F.col("_keyless") + F.when(F.col("_first") == least, F.col("_tied")).otherwise(0)
    kinds = F.array(F.struct(F.col("mask"), F.col("_own").alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(COPY)).alias("mask"), (F.col("n") - F.col("_own")).alias("n")))
    split = groups.withColumn("_own", F.coalesce(first, F.lit(0))).select("part", "good", "toxic", F.inline(kinds)).filter("n > 0")
    return split.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def outcomes(part: pd.DataFrame) -> pd.DataFrame:
    """The audit of one part, from its tally."""
    every = good = toxic = 0
    for mask, is_good, is_toxic, n in zip(part["mask"], part["good"], part["toxic"], part["n"], strict=True):
        many = packed(int(mask)) * int(n)
        every += many
        good += many if is_good else 0
        toxic += many if is_toxic else 0
    removed, documents = unpacked(every)
    place = np.array([[FILTERS.index(name) for name in order] for order in ORDERS])
    fails, alone, shares = (np.zeros(len(FILTERS), np.int64) for _ in range(3))
    fails[place[:, 0]] = removed[:, 0]  # the first filter removes all that fail it
    alone[place[:, -1]] = removed[:, -1]  # the last one those that fail no other
    np.add.at(shares, place, removed)
    of = place.ravel()
    return pd.DataFrame({
        "part": part["part"].iloc[0], "filter_order": np.repeat(ORDERS, len(FILTERS)), "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS)),
        "kept": (documents - removed.cumsum(1)).ravel(), "removed": removed.ravel(), "redundant": fails[of] - removed.ravel(), "unique_fails": alone[of],
        "good_lost": unpacked(good)[0].ravel(), "toxic_lost": unpacked(toxic)[0].ravel(), "shapley": shares[of],
    })


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """For each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    docs has the columns key, text and part; labels the columns key, quality and toxic.
    """
    return tally(docs, labels, key, text, part).groupBy("part").applyInPandas(outcomes, RESULT)
