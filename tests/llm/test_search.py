"""The ranked search against a plain one, its pruning and its edge cases."""

import math
import random
import re
from collections import Counter

import pytest

from thicket.llm import search

TERM = re.compile(search.TERM)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k=20):
    terms = [(key, TERM.findall((t or "").translate(LOWER))) for key, t in docs]
    terms = [(key, Counter(t), len(t)) for key, t in terms]
    n_docs, n_terms = sum(n > 0 for *_, n in terms), sum(n for *_, n in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    asked = {}
    for item, t in items:
        asked.setdefault(item, Counter()).update(TERM.findall((t or "").translate(LOWER)))
    out = set()
    for item, of in asked.items():
        found = []
        for key, c, n in terms:
            m = 75 + 25 * n * n_docs // n_terms if n_terms else 0
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, times in of.items() if c[t])
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        out |= {(item, rank, key, -s) for rank, (s, _, _, key) in enumerate(sorted(found)[:k], 1)}
    return out


def tables(spark, docs, items):
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, block int").repartition(3)
    return d, spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, term string")


def found(df):
    return {tuple(r) for r in df.collect()}


def drawn(n, seed=1, vocabulary=300):
    r = random.Random(seed)
    word = lambda: f"w{int(vocabulary * r.random() ** 3)}"
    docs = [(i, " ".join(word() for _ in range(r.randrange(60)))) for i in range(n)]
    items = [(i, " ".join(word() for _ in range(r.randrange(1, 30)))) for i in range(40)]
    return docs, items


@pytest.mark.parametrize("sizes", [(4096, 256), (30, 256), (30, 7)])
def test_ranks_equal_the_plain_ones(spark, monkeypatch, sizes):
    monkeypatch.setattr(search, "BLOCK", sizes[0])
    monkeypatch.setattr(search, "BUNDLE", sizes[1])
    docs, items = drawn(700)
    assert found(search.search(*tables(spark, docs, items))) == plain(docs, items)
    assert found(search.search(*tables(spark, docs, items), k=3)) == plain(docs, items, 3)


def test_edges(spark):
    docs = [(1, "One two TWO three"), (2, None), (3, ""), (4, "Äpfel äpfel café_x 12-12"), (5, "two"), (5, "two"), (None, "two"), (None, "three two"), (6, "... !!"), (7, "word " * 50000), (8, "two two two one")]
    items = [(1, "two, one"), (2, None), (3, "nowhere"), (4, "Äpfel 12 x"), (None, "three word"), (9, "two"), (9, "two one"), (10, "äpfel")]
    got, want = found(search.search(*tables(spark, docs, items))), plain(docs, items)
    assert got == want and {r[0] for r in got} == {1, 4, None, 9, 10}


def test_ties_go_by_key_and_ranks_are_unique(spark):
    docs, items = [(i, "same words here") for i in range(500, 0, -1)] + [(1000 + i, "other") for i in range(50)], [(1, "same here")]
    got = sorted(search.search(*tables(spark, docs, items)).collect(), key=lambda r: r["rank"])
    assert [r["_key"] for r in got] == list(range(1, 21)) and [r["rank"] for r in got] == list(range(1, 21))


def test_empty_tables(spark):
    docs, items = tables(spark, [(1, "a")], [(1, "a")])
    assert search.search(docs.limit(0), items).collect() == [] and search.search(docs, items.limit(0)).collect() == []


def test_pruned_documents_are_not_carried(monkeypatch):
    """One rare term settles an item: at later owners only its best documents are left, and none are added."""
    import numpy as np
    import pandas as pd

    n, k = 1000, 5
    state = pd.DataFrame({"bundle": [0], "block": [0], "sizes": [np.full(n, 10)], "bounds": [np.array([9_000_000, 0, 0, 1_000])], "open": [np.array([True])], "slot": [np.zeros(0, int)], "at": [np.zeros(0, int)], "score": [np.zeros(0, int)]})
    rare = pd.DataFrame({"weight": [9], "at": [np.arange(10)], "tf": [np.full(10, 2)], "slots": [np.array([0])], "times": [np.array([1])]})
    common = pd.DataFrame({"weight": [1], "at": [np.arange(n)], "tf": [np.full(n, 1)], "slots": [np.array([0])], "times": [np.array([1])]})
    after = search.owner_step(0, k, 1000, 10000)(state, rare)
    assert sorted(after["at"][0]) == list(range(10)) and not after["open"][0][0]
    end = search.owner_step(3, k, 1000, 10000)(after, common)
    assert end["at"][0].tolist() == [0, 1, 2, 3, 4]
