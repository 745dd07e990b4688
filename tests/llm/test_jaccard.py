"""The Jaccard join against all pairs, on small collections with near copies."""

import random
import re

import numpy as np
import pytest

from thicket.llm import jaccard
from thicket.llm import text as tx

SCHEMA = "doc_id long, text string, n_shingles string"


def brute(rows, words, num, den):
    sets = []
    for _, text, *_ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((r[0], len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def near_copies(seed, families, most):
    """Families whose members differ in a few words, among texts that share passages."""
    r = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    out = []
    for f in range(families):
        n = r.choice([3, 6, 8, 13, 25, 60, 150])
        base = [f"w{f}_{r.randrange(n)}" if r.random() < 0.9 else "the" for _ in range(n)]
        if r.random() < 0.5:
            base[n // 2 : n // 2] = passage
        for _ in range(r.randint(1, most)):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                at = r.randrange(len(t) + 1)
                t[at : at + r.randint(0, 2)] = [f"x{r.randrange(10**6)}"] * r.randint(0, 2)
            out.append(" ".join(t))
    r.shuffle(out)
    return [(i * 7 + 3, t, "extra") for i, t in enumerate(out)]


@pytest.mark.parametrize(("words", "num", "den", "block"), [(4, 85, 100, 4096), (5, 4, 5, 4096), (4, 85, 100, 5)])
def test_components_are_those_of_all_pairs(spark, words, num, den, block):
    rows = near_copies(words * 100 + block, 60, 14) + [(100001, None, ""), (100002, "", ""), (100003, " \n ", ""), (100004, "One two", ""), (100005, "one TWO", "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = jaccard.join(df, words=words, num=num, den=den, block_size=block).collect()
    assert sorted(map(tuple, got)) == brute(rows, words, num, den)


def test_edge_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert jaccard.join(empty).collect() == []
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(None, "a b c d e f", ""), (4, "a b c d e f", ""), (4, "a b c d e f", ""), (9, long, ""), (8, long + " end", ""), (None, "alone in the world of it", "")]
    got = sorted(map(tuple, jaccard.join(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(None, 2, 4), (4, 2, 4), (4, 2, 4), (9, 49_996, 8), (8, 49_997, 8), (None, 2, None)], key=str)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    signatures = jaccard.Signatures(85, 100)
    for _ in range(3000):
        n = int(rng.integers(6, 60))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        drop, add = rng.integers(0, 4, 2)
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**64, add, dtype=np.uint64)]))
        if len(b) and 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)) and len(a) + len(b) > len(np.intersect1d(a, b)) * 2:
            assert len(np.intersect1d(signatures.of(a), signatures.of(b)))


def test_word_spans_respect_text_borders():
    data, offsets = tx.utf8(__import__("pyarrow").array(["ab c", "", None, "d", "É e\t"]))
    starts, ends, first = tx.spans(tx.WORD[data], offsets)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)] == [b"ab", b"c", b"d", "É".encode(), b"e"]
    assert first.tolist() == [0, 2, 2, 2, 3, 5]


def test_passages_alone_make_hardly_any_candidates(spark):
    """Texts that share passages in common use and nothing else don't meet in blocks, but for few, however many they are."""
    r = random.Random(5)
    passages = [" ".join(f"p{k}_{i}" for i in range(12)) for k in range(8)]
    rows = []
    for i in range(400):
        lines = [" ".join(f"t{i}_{k}_{j}" for j in range(r.randint(20, 40))) for k in range(5)]
        for p in r.sample(passages, 3):
            lines.insert(r.randrange(6), p)
        rows.append((" ".join(lines),))
    docs = spark.createDataFrame(rows, "text string").repartition(3)
    assert jaccard._candidates(docs, "text", 5, jaccard.Signatures(4, 5), 3).count() <= 10


def test_sets_whose_cut_hashes_agree_are_compared(spark):
    base = " ".join(f"b{i}" for i in range(30))
    rows = [(1, f"{base} x16690", ""), (2, f"{base} x68805", ""), (3, "one other text that is nobody's copy", "")]
    words, first, _, _ = tx.word_hashes(*tx.utf8(__import__("pyarrow").array([r[1] for r in rows])), tx.Powers())
    cut = [jaccard.fingerprint(np.unique(tx.shingles(words[a:b], 5)))[0] >> 32 for a, b in zip(first[:-1], first[1:], strict=True)]
    assert cut[0] == cut[1] != cut[2]
    assert sorted(map(tuple, jaccard.join(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows, 5, 4, 5)


def test_linked_sets_share_as_many_signatures_as_their_marks_say():
    rng = np.random.default_rng(4)
    signatures = jaccard.Signatures(4, 5)
    told = 0
    for _ in range(1000):
        a = np.unique(rng.integers(0, 2**64, int(rng.integers(6, 300)), dtype=np.uint64))
        drop = int(rng.integers(0, len(a) // 5 + 1))
        b = np.sort(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**64, int(rng.integers(0, 3)), dtype=np.uint64)]))
        if len(both := np.intersect1d(a, b)) == len(np.union1d(a, b)) or 5 * len(both) < 4 * len(np.union1d(a, b)):
            continue
        cuts = [[(set(t.tolist()), mark % 128) for t, mark in signatures.cuts(s)] for s in (a, b)]
        pairs = [(t & u, max(j, k)) for t, j in cuts[0] for u, k in cuts[1] if t & u]
        assert any(least and len(shared) >= least for shared, least in pairs)
        told += 1
    assert told > 300
