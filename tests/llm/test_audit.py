"""The filter audit against a plain one, and its edge cases."""

import re
from itertools import permutations

import pytest

from thicket.llm import audit

WORDS = [f"w{i}" for i in range(150)]


def plain(docs, labels):
    """docs: (key, text, part); labels: (key, quality, toxic)."""
    first = {}
    for key, text, _ in docs:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))
    seen = []
    for key, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        fails |= {"A"} if len(words) < 100 else set()
        fails |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
        fails |= {"D"} if set(text) & set("#$%&*|") else set()
        fails |= {"E"} if key is not None and key > first[text] else set()
        own = [r for r in labels if r[0] is not None and r[0] == key]
        seen.append((part or "", fails, any(r[1] == 1 for r in own), any(r[2] == 1 for r in own)))
    out = {}
    for part in {p for p, *_ in seen}:
        rows = [r[1:] for r in seen if r[0] == part]
        shares = dict.fromkeys("ABCDE", 0)
        made = []
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shares[f] += len(gone)
                made.append((order, step, f, len(left), len(gone), sum(f in r[0] for r in rows) - len(gone), sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)))
        for order, step, f, *rest in made:
            out[part, order, step] = (*rest, shares[f])
    return out


DOCS = [
    (1, " ".join(WORDS), "xx"), (2, " ".join(WORDS), "yy"), (3, " ".join(WORDS), "xx"), (3, " ".join(WORDS), "xx"), (1, " ".join(WORDS), "xx"), (None, " ".join(WORDS), "xx"), (None, " ".join(WORDS), None),
    (4, None, None), (5, "", "xx"), (6, "", "xx"), (7, "A B C", "xx"), (8, "a " * 200, "yy"), (9, "# " + " ".join(WORDS), ""), (10, "ÄÖ Ü", "yy"), (11, "long|word " * 5000, "xx"), (12, "X" * 10 + "y" * 90, "zz"), (13, "X" * 11 + "y" * 89, "zz"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 0, 1), (3, 1, None), (7, 1, 1), (None, 1, 1), (99, 1, 1), (11, None, 1)]


def tables(spark, docs=DOCS, labels=LABELS):
    d = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, lang string, mask string").repartition(3)
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_audit_equals_the_plain_one(spark):
    got = audit.audit(*tables(spark)).collect()
    fields = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in fields) for r in got} == plain(DOCS, LABELS)
    assert len(got) == 600 * len({p or "" for *_, p in DOCS})


def test_audit_of_nothing(spark):
    docs, labels = tables(spark)
    assert audit.audit(docs.limit(0), labels).collect() == []
    assert all(r["good_lost"] == 0 for r in audit.audit(docs, labels.limit(0)).collect())


def test_repartitioning_changes_nothing(spark):
    docs, labels = tables(spark)
    rows = lambda n: sorted(map(tuple, audit.audit(docs.repartition(n), labels).collect()))
    assert rows(1) == rows(7)


@pytest.mark.parametrize("n", [1, 10**6, 2**63 - 1])
def test_fields_do_not_overflow(n):
    removed, documents = audit.unpacked(audit.packed(0b10101) * n)
    assert documents == n and set(removed.ravel()) == {0, n} and (removed.sum(1, dtype=object) == n).all()
    assert not audit.unpacked(audit.packed(0))[0].any()


def test_equal_texts_in_one_part_are_one_row(spark):
    docs, labels = tables(spark, [(i, "same text", "xx") for i in range(5000)], [])
    assert sorted((r["mask"], r["n"]) for r in audit.tally(docs, labels).collect()) == [(1, 1), (17, 4999)]
