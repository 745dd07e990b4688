"""Language-model scoring: a causal self-attention model beside an add-one word model.

Texts are lower-cased (A-Z) and cut into words; an end follows the last word. The base
score is the add-one unigram score with counts over all training documents. The model's
score is the log10 probability of the subword ids of " word" for each word and of the end,
by attention.py: ids' counts, shares and classes come from all training documents, and its
parameters from every window of all of them, each once, in shards whose number grows with
the input; in each of ROUNDS rounds shards fit the same parameters, on windows of that
round, which are then averaged, an id's embedding by how often a shard uses it.

Texts are encoded once, into chunks of about CHUNK ids that later steps read. Words are
told apart by their ids. To count them, a chunk sends its distinct words, once each, to
ranges of their hash; a range adds up and answers each chunk. So no word, however frequent,
has more than one entry for each chunk, and the end mark none.

Defined cases: null and empty texts are the end alone; an empty table gives no rows;
without training documents all counts are 0; very long texts are chunks of their own; rows
with a null key take part (the fold is that of the empty text); rows with equal key and
text get equal results, each its own row. Only the key and the text are read, so that
other columns' names don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import attention as nn
from . import text as tx
from . import tokens
from .shared import checkpoint, fold

#: Windows are learnt from in shards of about SHARD, each in one of so many rounds, of at least STEPS batches.
SHARD, ROUNDS, STEPS, BATCH, RATE = 160_000, 4, 150, 80, 0.03
#: Ids of a chunk, about, and entries of distinct words that a range of hashes holds.
CHUNK, RANGE = 1_000_000, 2_000_000
#: Parts of tables that are added up apart, and groups in which they are added up first.
PIECES, SALTS = 32, 64

Batches = Iterator[pa.RecordBatch]


def word_ids(data: np.ndarray, offsets: np.ndarray, ids_of: tokens.Ids) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of all texts, each with its end, and where each text's begin (one more at the end)."""
    spaced, starts, ends, first = tx.spaced_words(data, offsets)
    ids, at = ids_of.encode_spans(spaced, starts, ends)
    borders = at[first]
    return np.insert(ids.astype(np.int64), borders[1:], nn.END), borders + np.arange(len(borders))


def word_starts(path: str) -> np.ndarray:
    """Which ids begin with a space, as the first id of each word does and no other."""
    begins = np.zeros(nn.VOCAB, bool)
    found = tokens.worker_ids(path).library.spaced
    begins[: len(found)] = found
    return begins


def words_of(ids: np.ndarray, first: np.ndarray, begins: np.ndarray, powers: tx.Powers) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word's ids, and the first word of each text."""
    bounds = np.flatnonzero(np.take(begins, ids) | (ids == nn.END))  # each text's last id is the end
    starts = np.flatnonzero(ids[bounds] != nn.END)
    return tx.span_hash(ids, bounds[starts], bounds[starts + 1] if len(starts) else bounds[starts], powers), np.searchsorted(bounds[starts], first)


_CHUNKS = "chunk long, keys array<long>, seeds array<long>, train array<boolean>, sizes array<int>, ids binary"


def encode(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """docs has _key, _seed, _train, _text. Rows are chunks of whole texts; ids are 16-bit."""

    def run(batches: Batches) -> Batches:
        ids_of, part, seq = tokens.worker_ids(path), TaskContext.get().partitionId(), 0
        held: list[list] = [[], [], [], [], []]
        waiting = 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array([(part << 32) + seq])]
            columns += [pa.array([np.concatenate(x) if as_numpy else sum(x, [])], kind) for x, kind, as_numpy in ((held[0], pa.list_(pa.int64()), False), (held[1], pa.list_(pa.int64()), False), (held[2], pa.list_(pa.bool_()), False), (held[3], pa.list_(pa.int32()), True))]
            columns.append(pa.array([b"".join(held[4])], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "keys", "seeds", "train", "sizes", "ids"])

        for batch in batches:
            given = [batch.column(k).to_pylist() for k in range(3)]
            for i, j, data, offsets in tx.slices(batch.column(3)):
                ids, first = word_ids(data, offsets, ids_of)
                for to, x in zip(held, (*(g[i:j] for g in given), np.diff(first), ids.astype(np.uint16).tobytes()), strict=True):
                    to.append(x)
                waiting += len(ids)
                if waiting >= chunk:
                    yield flush()
                    held, waiting, seq = [[], [], [], [], []], 0, seq + 1
        if held[0]:
            yield flush()

    return docs.select("_key", "_seed", "_train", "_text").mapInArrow(tx.giving_back(run), _CHUNKS)


def opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a chunk, where each text's begin, and which texts are for training."""
    ids = np.frombuffer(row["ids"], np.uint16).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(np.array(row["sizes"], np.int64))]), np.array(row["train"], bool)


def chunk_rows(batches: Batches) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


def _split(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _ask(chunks: DataFrame, ranges: int, path: str) -> DataFrame:
    """A chunk's distinct words in a range: hashes in order, and how often training documents have each."""

    def run(batches: Batches) -> Batches:
        powers, begins = tokens.worker_ids(path).powers, word_starts(path)
        for row in chunk_rows(batches):
            ids, first, train = opened(row)
            found, texts = words_of(ids, first, begins, powers)
            u, at = np.unique(found, return_inverse=True)
            often = np.bincount(at, np.repeat(train, np.diff(texts)), len(u)).astype(np.uint32)
            cut = np.searchsorted(_split(u, ranges), np.arange(ranges + 1, dtype=np.uint64))
            some = np.flatnonzero(cut[1:] > cut[:-1])
            packed = [u[cut[r] : cut[r + 1]].tobytes() + often[cut[r] : cut[r + 1]].tobytes() for r in some]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), row["chunk"])), pa.array(packed, pa.binary())], names=["range", "chunk", "packed"])

    return chunks.mapInArrow(tx.giving_back(run), "range int, chunk long, packed binary")


def _answer(part: pd.DataFrame) -> pd.DataFrame:
    """For each chunk the counts of its words; and in a row without a chunk how many words the range has and how often."""
    asked = [(np.frombuffer(raw, np.uint64, len(raw) // 12), np.frombuffer(raw, np.uint32, len(raw) // 12, len(raw) // 12 * 8)) for raw in part["packed"]]
    u, at = np.unique(np.concatenate([h for h, _ in asked]), return_inverse=True)
    total = np.bincount(at, np.concatenate([n for _, n in asked]), len(u)).astype(np.int64)
    ends = np.cumsum([len(h) for h, _ in asked])
    short = total.astype(np.uint32) if total.max(initial=0) < 1 << 32 else total
    packed = [short[at[j - len(h) : j]].tobytes() for (h, _), j in zip(asked, ends.tolist(), strict=True)]
    return pd.DataFrame({
        "range": part["range"].iloc[0], "chunk": pd.array([*part["chunk"], None], "Int64"), "width": short.itemsize, "packed": [*packed, None],
        "words": pd.array([None] * len(packed) + [int((total > 0).sum())], "Int64"), "tokens": pd.array([None] * len(packed) + [int(total.sum())], "Int64"),
    })


def _ids_counts(chunks: DataFrame) -> np.ndarray:
    """How often training documents have each id, the end included."""

    def run(batches: Batches) -> Batches:
        total = np.zeros(nn.VOCAB, np.int64)
        for row in chunk_rows(batches):
            ids, first, train = opened(row)
            total += np.bincount(ids[np.repeat(train, np.diff(first))], minlength=nn.VOCAB)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "n"])

    out = np.zeros(nn.VOCAB, np.int64)
    for r in chunks.select("sizes", "train", "ids").mapInArrow(tx.giving_back(run), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most one row for each id of the vocabulary
        out[r["id"]] = r["n"]
    return out


def _merged(cells: list[np.ndarray], often: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(cells), return_inverse=True)
    return found, np.bincount(at, np.concatenate(often), len(found)).astype(np.int64)


def _cells(chunks: DataFrame, column: np.ndarray) -> DataFrame:
    """Counts of ids after frequent ids in training documents, by piece."""

    def run(batches: Batches) -> Batches:
        cells, often = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for row in chunk_rows(batches):
            ids, first, train = opened(row)
            ids, first = _taught(ids, first, train)
            c, n = nn.contexts(ids, first, column)
            cells, often = _merged([cells, c], [often, n])
        piece = cells // nn.COLUMNS % PIECES
        own = np.unique(piece)
        packed = [cells[piece == p].tobytes() + often[piece == p].tobytes() for p in own]
        salt = TaskContext.get().partitionId() % SALTS
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array([salt] * len(own), pa.int32()), pa.array(packed, pa.binary())], names=["part", "salt", "packed"])

    return chunks.select("train", "sizes", "ids").mapInArrow(tx.giving_back(run), "part int, salt int, packed binary")


def _taught(ids: np.ndarray, first: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the training texts alone, and where each of these begins."""
    sizes = np.diff(first)
    return ids[np.repeat(train, sizes)], np.concatenate([[0], np.cumsum(sizes[train])])


def _lessons(chunks: DataFrame, shards: int, nth: int, rounds: int) -> DataFrame:
    """Windows of a round, by shard. Each window of the training documents has its round and its shard by a hash of text, key and place."""

    def run(batches: Batches) -> Batches:
        rows, places, waiting = [], [], 0

        def flush() -> pa.RecordBatch:
            all_rows, shard = np.concatenate(rows), np.concatenate(places)
            order = np.argsort(shard, kind="stable")
            own, begin = np.unique(shard[order], return_index=True)
            packed = [x.tobytes() for x in np.split(all_rows[order], begin[1:])]
            return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(packed, pa.binary())], names=["shard", "packed"])

        for row in chunk_rows(batches):
            ids, first, train = opened(row)
            ids, first = _taught(ids, first, train)
            many = nn.many_windows(np.diff(first))
            place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            seeds = np.array(row["seeds"], np.int64).view(np.uint64)[train]
            h = tx.mix(np.repeat(seeds, many) + place.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
            chosen = np.flatnonzero(h % np.uint64(rounds) == nth)
            rows.append(nn.sequences(ids, first, chosen))
            places.append(_split(h[chosen], shards).astype(np.int64))
            waiting += len(chosen)
            if waiting > SHARD:
                yield flush()
                rows, places, waiting = [], [], 0
        if waiting:
            yield flush()

    return chunks.select("seeds", "train", "sizes", "ids").mapInArrow(tx.giving_back(run), "shard int, packed binary")


def _summed(df: DataFrame, add: Callable[[list[bytes]], bytes]) -> dict[int, bytes]:
    """Add up the packed values of each part, in groups first; add must not mind the order of its values."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": part["part"].iloc[:1], "packed": [add(sorted(part["packed"]))]})

    some = df.groupBy("part", "salt").applyInPandas(run, "part int, packed binary")
    return {r["part"]: r["packed"] for r in some.groupBy("part").applyInPandas(run, "part int, packed binary").collect()}


def _add_cells(packed: list[bytes]) -> bytes:
    pairs = [np.frombuffer(raw, np.int64).reshape(2, -1) for raw in packed]
    return b"".join(x.tobytes() for x in _merged([c for c, _ in pairs], [n for _, n in pairs]))


def _add_changes(packed: list[bytes]) -> bytes:
    """Values are rows of doubles, the first an id (or a place) and the others summed."""
    width = int.from_bytes(packed[0][:8], "little")
    rows = np.concatenate([np.frombuffer(raw, np.float64, -1, 8).reshape(-1, width) for raw in packed])
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    begin = np.flatnonzero(np.diff(rows[:, 0], prepend=-1))
    sums = np.add.reduceat(rows, begin, axis=0)
    sums[:, 0] = rows[begin, 0]
    return width.to_bytes(8, "little") + sums.tobytes()


def _round(model: nn.Model, lessons: DataFrame, nth: int, rounds: int, shards: int) -> None:
    """Fit the model on each shard's windows of a round, and take the average over shards."""
    names = [k for k in model.parts if k != "embed"]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        shard = int(part["shard"].iloc[0])
        rows = np.concatenate([np.frombuffer(raw, np.uint16).reshape(-1, nn.WINDOW + 1) for raw in part["packed"]])
        rows = rows[np.lexsort(rows.T)]  # an order that does not depend on how rows came
        rng = np.random.default_rng([shard, nth])
        steps = max(STEPS, -(-len(rows) // BATCH))
        # few windows are gone through several times
        order = np.concatenate([rng.permutation(len(rows)) for _ in range(-(-steps * BATCH // len(rows)))])
        order = order[: max(len(rows), STEPS * BATCH)]
        own = nn.Model({k: v.copy() for k, v in model.parts.items()}, model.class_of, model.unseen, model.squares.copy())
        used = nn.fit(own, rows, np.array_split(order, steps), steps, RATE * (1 - nth / rounds))
        ids = np.flatnonzero(used)
        n = used[ids, None].astype(np.float64)
        change = np.hstack([ids[:, None], n, n * (own.parts["embed"][ids] - model.parts["embed"][ids]), n * (own.squares[ids] - model.squares[ids])])
        whole = np.concatenate([(own.parts[k] - model.parts[k]).ravel() for k in names]).astype(np.float64)
        whole = np.stack([np.arange(len(whole)), np.full(len(whole), len(rows)), whole * len(rows)], 1)
        parts = [(-1, whole), *((p, change[ids % PIECES == p]) for p in range(PIECES))]
        parts = [(p, x.shape[1].to_bytes(8, "little") + x.tobytes()) for p, x in parts if len(x)]
        return pd.DataFrame({"part": [p for p, _ in parts], "salt": shard % max(1, round(shards**0.5)), "packed": [x for _, x in parts]})

    changes = lessons.repartition(shards, "shard").groupBy("shard").applyInPandas(run, "part int, salt int, packed binary")
    for part, raw in _summed(changes, _add_changes).items():
        rows = np.frombuffer(raw, np.float64, -1, 8).reshape(-1, int.from_bytes(raw[:8], "little"))
        mean = (rows[:, 2:] / rows[:, 1:2]).astype(np.float32)
        if part >= 0:
            ids, d = rows[:, 0].astype(np.int64), mean.shape[1] // 2
            model.parts["embed"][ids] += mean[:, :d]
            model.squares[ids] += mean[:, d:]
            continue
        at = 0
        for k in names:
            size = model.parts[k].size
            model.parts[k] += mean[at : at + size, 0].reshape(model.parts[k].shape)
            at += size


def learn(chunks: DataFrame, n_ids: np.ndarray, shard: int = SHARD, rounds: int = ROUNDS) -> nn.Model:
    """The attention model of all training documents, whose ids' counts are n_ids."""
    shards = max(1, round(int(n_ids.sum()) / nn.STRIDE / shard))
    cells = [np.frombuffer(raw, np.int64).reshape(2, -1) for raw in _summed(_cells(chunks, nn.columns(n_ids)), _add_cells).values()]
    class_of = nn.classes(n_ids, *(np.concatenate([np.zeros(0, np.int64), *(c[i] for c in cells)]) for i in (0, 1)))
    model = nn.start(class_of, n_ids)
    for nth in range(rounds):
        _round(model, _lessons(chunks, shards, nth, rounds), nth, rounds, shards)
    return model


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, held_out: int = 2, path: str = tokens.BYTE_RANKS, chunk: int = CHUNK) -> DataFrame:
    """One row for each document: key, held_out, n_tokens, n_known, train_tokens, base_score, score. Keys are integers."""
    full = F.coalesce(F.col(text), F.lit(""))
    k = F.col(key).cast("long")
    seed = F.xxhash64(F.xxhash64(full, F.length(full)), F.coalesce(k, F.lit(-1)))
    chunks = checkpoint(encode(docs.select(k.alias("_key"), seed.alias("_seed"), (fold(key, folds) != held_out).alias("_train"), full.alias("_text")), path, chunk))
    n_ids = _ids_counts(chunks)
    size = chunks.agg(F.sum(F.length("ids"))).first()[0] or 0
    asked = _ask(chunks.select("chunk", "train", "sizes", "ids"), max(1, round(size / 20 / RANGE)), path)  # a chunk has a distinct word for ten ids, about
    answers = checkpoint(asked.groupBy("range").applyInPandas(_answer, "range int, chunk long, width int, packed binary, words long, tokens long"))
    totals = answers.filter("chunk IS NULL").agg(F.sum("words"), F.sum("tokens")).first()
    ends = int(n_ids[nn.END])  # one for each training document
    distinct, train_tokens = int(totals[0] or 0) + (ends > 0), int(totals[1] or 0) + ends
    model = learn(chunks, n_ids)
    share_logs = nn.shares(model.class_of, n_ids)
    schema = "_key long, _train boolean, n_tokens long, n_known long, base double, score double"

    def run(batches: Batches) -> Batches:
        powers, begins = tokens.worker_ids(path).powers, word_starts(path)
        for row in chunk_rows(batches):
            ids, first, _ = opened(row)
            found, texts = words_of(ids, first, begins, powers)
            at = np.unique(found, return_inverse=True)[1]
            total = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(a["packed"], f"u{a['width']}").astype(np.int64) for a in row["answers"] or [])])[at]
            n = np.diff(texts)
            text_of = np.repeat(np.arange(len(n)), n)
            base = np.bincount(text_of, np.log10(total + 1.0), len(n)) + np.log10(ends + 1.0)
            known = np.bincount(text_of, total > 0, len(n)).astype(np.int64) + (ends > 0)
            logs = nn.score(model, ids, first, share_logs) / np.log(10)
            yield pa.RecordBatch.from_arrays([pa.array(row["keys"], pa.int64()), pa.array(row["train"], pa.bool_()), pa.array(n + 1), pa.array(known), pa.array(base), pa.array(logs)], names=["_key", "_train", "n_tokens", "n_known", "base", "score"])

    # a chunk's answers are as many as its distinct words, in order of their hashes
    own = answers.filter("chunk IS NOT NULL").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("range", "width", "packed"))).alias("answers"))
    both = chunks.join(own.hint("shuffle_hash"), "chunk", "left").select("keys", "train", "sizes", "ids", "answers").mapInArrow(tx.giving_back(run), schema)
    return both.select(
        F.col("_key").alias(key), (~F.col("_train")).alias("held_out"), "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(float(np.log10(train_tokens + distinct + 1)))).alias("base_score"), "score",
    )
