"""Token counts against the libraries, and the cache."""

import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from thicket.llm import counts, tokens
from thicket.llm.queries import QUERIES

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def texts():
    r = random.Random(4)
    odd = [None, "", " ", "\n\n a", "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "<|ENDOFTEXT|> b", "<|endoftext", "éß 한국", "é", "don't\r\n\tstop", "A" * 3000, "word " * 20000, "12345678901 + 2€"]
    return odd + ["".join(r.choice("ab cD\n.'s<|>endoftext ä中") for _ in range(r.randrange(80))) for _ in range(150)]


def plain(path):
    if path == PIECE:
        return lambda t, p=sentencepiece.SentencePieceProcessor(model_file=path): len(p.encode(t or ""))
    return lambda t, k=Tokenizer.from_file(path): len(k.encode(t or "", add_special_tokens=False).ids)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, -1) for i, t in rows], "doc_id long, text string, digest int").repartition(3)


@pytest.mark.parametrize("path", [tokens.BYTE_BPE, WORD, PIECE])
def test_counts_equal_the_library(spark, tmp_path, path):
    rows = list(enumerate(texts()))
    rows += [(None, "no key"), (0, "again"), (0, "again")]
    want = plain(path)
    for _ in range(2):  # from the library, then from the cache
        got = counts.count_tokens(docs_of(spark, rows), str(tmp_path), path).collect()
        assert sorted(map(str, ((r["_key"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got))) == sorted(map(str, ((k, len((t or "").encode()), want(t), want(t) > 1024) for k, t in rows)))


def test_only_distinct_misses_are_encoded_and_appended(spark, tmp_path, monkeypatch):
    encoded, real = [], counts.encode
    monkeypatch.setattr(counts, "encode", lambda df, path: encoded.append([r["text"] for r in df.collect()]) or real(df, path))
    run = lambda rows: {r["_key"]: r["n_tokens"] for r in counts.count_tokens(docs_of(spark, rows), str(tmp_path)).collect()}
    first = run([(i, f"text {i % 3}") for i in range(900)])
    second = run([(1, "text 1"), (2, "new one"), (3, "new one"), (4, None)])
    third = run([(1, "text 2")])
    assert [sorted(x) for x in encoded] == [["text 0", "text 1", "text 2"], ["", "new one"], []]
    assert second[1] == first[1] == third[1] and second[4] == 0
    stored = spark.read.parquet(f"{tmp_path}/{counts.version(tokens.BYTE_BPE)}")
    assert stored.count() == stored.select("digest").distinct().count() == 5


def test_another_version_finds_nothing(spark, tmp_path):
    counts.count_tokens(docs_of(spark, [(1, "a b")]), str(tmp_path)).collect()
    assert counts.stored(spark, str(tmp_path), tokens.BYTE_BPE).count() == 1 and counts.stored(spark, str(tmp_path), WORD).count() == 0
    assert counts.version(WORD) != counts.version(tokens.BYTE_BPE)
    with pytest.raises(ValueError):
        counts.library("x.txt")


def test_equal_normal_forms_share_a_count(spark, tmp_path):
    got = counts.count_tokens(docs_of(spark, [(1, "Big  WORDS"), (2, "big words"), (3, "big\nwords")]), str(tmp_path), WORD).collect()
    assert len({r["n_tokens"] for r in got}) == 1 and counts.stored(spark, str(tmp_path), WORD).count() == 1


def test_doubled_cache_rows_and_empty_tables(spark, tmp_path):
    docs = docs_of(spark, [(1, "a b"), (2, "c")])
    assert counts.count_tokens(docs.limit(0), str(tmp_path)).collect() == [] and not list(tmp_path.iterdir())
    counts.count_tokens(docs, str(tmp_path)).collect()
    folder = f"{tmp_path}/{counts.version(tokens.BYTE_BPE)}"
    spark.read.parquet(folder).collect()
    spark.createDataFrame(spark.read.parquet(folder).collect(), counts.STORED).write.mode("append").parquet(folder)
    assert sorted(r["n_tokens"] for r in counts.count_tokens(docs, str(tmp_path)).collect()) == [1, 2]


def test_query_over_the_table(spark):
    sf, want = "/root/testdata/sf0.001", plain(tokens.BYTE_BPE)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in QUERIES["op12_token_counts"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r["doc_id"]: (len((r["text"] or "").encode()), want(r["text"]), want(r["text"]) > 1024) for r in rows}
