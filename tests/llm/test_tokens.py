"""Ids of cut texts are those of whole texts, with either library."""

import random

import pyarrow as pa

from thicket.llm import text as tx
from thicket.llm import tokens


def test_cuts_do_not_change_ids():
    r = random.Random(1)
    parts = [*" \n\t\r  ''sStdlr,.!?-_|aZ9é 　ñ漢😀\u0085\x1c ½ªʼ", "'ll", " don't", "\r\n", "  ", "<|endoftext|>"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(5000)] + [None, "", "x" * 5000, "a b " * 3000]
    library = tokens.by_tokenizer(tokens.BYTE_BPE)
    whole = [library.encode(t or "") for t in texts]
    for path in (tokens.BYTE_BPE, tokens.BYTE_RANKS):
        ids_of, got = tokens.Ids(path), []
        for _, _, data, offsets in tx.slices(pa.array(texts), 20_000):
            ids, first = ids_of.encode(data, offsets)
            got += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
        assert got == whole


def test_forgetting_keeps_ids_right(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    texts = [" ".join(f"w{i + j}" for j in range(30)) for i in range(0, 600, 7)]
    ids_of, got = tokens.Ids(), []
    for _, _, data, offsets in tx.slices(pa.array(texts), 300):
        ids, first = ids_of.encode(data, offsets)
        got += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == [ids_of.library.encode(t) for t in texts]
