"""Language-model scoring against plain counting, and the model's own properties."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from thicket.llm import attention as nn
from thicket.llm import lm, tokens
from thicket.llm import text as tx


def brute(rows):
    def words(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), None]

    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2 for k, _ in rows]
    c = Counter(w for (_, t), h in zip(rows, held, strict=True) if not h for w in words(t))
    n = sum(c.values())
    return {k: (h, len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in words(t))) for (k, t), h in zip(rows, held, strict=True)}


def test_counts_and_base_scores(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"W{int(x)}" for x in rng.zipf(1.3, rng.integers(0, 200)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, " \t "), (1003, "Ünd ÜND x y"), (None, "w1 w2 w3"), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, score double").repartition(3)
    got, want = lm.score(df, chunk=5000).collect(), brute(rows)
    # the repeated row is counted in training as well
    assert len(got) == len(rows)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert abs(r["base_score"] - w[4]) < 1e-6 * abs(w[4]) + 1e-9
        assert r["score"] < 0


def test_empty_table(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def sample(n=60):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["the cat", "sat on", "a mat", "while it", "rained"], rng.integers(1, 80))) for _ in range(n)]
    ids, first = [], [0]
    of = tokens.Ids()
    for _, _, data, offsets in tx.slices(pa.array(texts)):
        own, at = lm.word_ids(data, offsets, of)
        ids.append(own)
        first += (first[-1] + at[1:]).tolist()
    return np.concatenate(ids), np.array(first)


def trained(ids, first, steps, rate=0.03):
    counts = np.bincount(ids, minlength=nn.VOCAB)
    model, rows = nn.start(nn.classes(counts, *nn.contexts(ids, first, nn.columns(counts))), counts), nn.sequences(ids, first)
    rng = np.random.default_rng(3)
    nn.fit(model, rows, (rng.integers(0, len(rows), 80) for _ in range(steps)), steps, rate)
    return model


def test_each_id_is_scored_once():
    first = np.array([0, 1, 1, 40, 40 + nn.WINDOW, 400])
    scored = nn.windows(first)[:, nn.LEAD :]
    assert sorted(scored[scored >= 0].tolist()) == list(range(400))


def test_model_learns_and_is_a_distribution():
    ids, first = sample()
    model = trained(ids, first, 200)
    logs = nn.shares(model.class_of, np.bincount(ids, minlength=nn.VOCAB))
    assert np.allclose(np.bincount(model.class_of, np.exp(logs))[np.unique(model.class_of)], 1)
    unigram = np.log((np.bincount(ids, minlength=nn.VOCAB) + 1) / (len(ids) + nn.VOCAB))
    assert nn.score(model, ids, first, logs).sum() > 0.8 * unigram[ids].sum()


def test_later_ids_do_not_change_earlier_scores():
    ids, first = sample()
    model = trained(ids, first, 20)
    one = ids[:20]
    other = np.concatenate([one[:-1], [ids[-2]]])
    at = nn.windows(np.array([0, 20]))
    a, b = (nn.forward(model.parts, nn.befores(x, np.array([0, 20]))[at], at[:, 0] < 0, nn.Room())[0].copy() for x in (one, other))
    assert np.allclose(a[0, :20], b[0, :20], atol=1e-5)
    assert np.isfinite(nn.score(model, one, np.array([0, 20]), np.zeros(nn.VOCAB))).all()


def test_scores_are_those_of_the_model():
    """Scoring makes each id's part of the layer once; a plain version looks at each place with all places before it in its window."""
    ids, first = sample()
    model = trained(ids, first, 60)
    p, d = {k: v.astype(np.float64) for k, v in model.parts.items()}, 16
    want = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own, total = [nn.END, *ids[a:b].tolist()], 0.0
        for n in range(b - a):
            begin = n // nn.STRIDE * nn.STRIDE - nn.LEAD
            seen = np.arange(max(0, begin), n + 1)
            x = p["embed"][[own[i] for i in seen]] + p["place"][seen - begin]
            q, k, v = (x @ p["qkv"][:, i * d : (i + 1) * d] for i in range(3))
            w = np.exp(k @ q[-1] * d**-0.5)
            h = x[-1] + w @ v / w.sum() @ p["out"]
            g = h + np.maximum(h @ p["up"], 0) @ p["down"]
            z = g @ p["classes"] + p["bias"]
            total += z[model.class_of[own[n + 1]]] - np.log(np.exp(z).sum()) + np.log1p(-model.unseen)
        want.append(total)
    assert np.allclose(nn.score(model, ids, first, np.zeros(nn.VOCAB)), want, rtol=1e-4)


def test_a_step_follows_the_slope():
    """The first step of Adam moves each parameter by the rate, against the sign of its slope as differences of the loss give it."""
    ids, first = sample()
    counts = np.bincount(ids, minlength=nn.VOCAB)
    model, rows = nn.start(nn.classes(counts, *nn.contexts(ids, first, nn.columns(counts))), counts), nn.sequences(ids, first)[:50]

    def loss(p):
        p = {k: v.astype(np.float64) for k, v in p.items()}
        into, d = np.minimum(rows[:, :-1], nn.END), 16
        x = p["embed"][into] + p["place"]
        q, k, v = (x @ p["qkv"][:, i * d : (i + 1) * d] for i in range(3))
        seen = np.tri(nn.STRIDE, nn.WINDOW, nn.LEAD) * ~((rows[:, :1, None] == 65535) & (np.arange(nn.WINDOW) < nn.LEAD))
        w = np.exp(q[:, nn.LEAD :] @ k.transpose(0, 2, 1) * d**-0.5) * seen
        h = x[:, nn.LEAD :] + w @ v / w.sum(-1, keepdims=True) @ p["out"]
        z = (h + np.maximum(h @ p["up"], 0) @ p["down"]) @ p["classes"] + p["bias"]
        aim = rows[:, nn.LEAD + 1 :].astype(int)
        own = np.take_along_axis(z, model.class_of[np.minimum(aim, nn.END)][..., None], -1)[..., 0]
        return (np.log(np.exp(z).sum(-1)) - own)[aim != 65535].mean()

    rng, before = np.random.default_rng(5), {k: v.copy() for k, v in model.parts.items()}
    nn.fit(model, rows, [np.arange(len(rows))], 1, 0.03)
    for name in before:
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in before[name].shape)
            if name == "embed":
                at = (int(rng.choice(rows[:, 10][rows[:, 10] < nn.END])), at[1])
            near = [{**before, name: before[name].astype(np.float64)} for _ in range(2)]
            near[0][name][at] += 1e-4
            near[1][name][at] -= 1e-4
            slope = (loss(near[0]) - loss(near[1])) / 2e-4
            if abs(slope) > 1e-5:
                assert np.sign(before[name][at] - model.parts[name][at]) == np.sign(slope), name


def test_large_products_are_clipped_with_their_bias():
    """A class's product may be above 60 where its bias brings it below; only the sum is held there."""
    ids, first = sample()
    counts = np.bincount(ids, minlength=nn.VOCAB)
    model, rows = nn.start(nn.classes(counts, *nn.contexts(ids, first, nn.columns(counts))), counts), nn.sequences(ids, first)[:80]
    p, end = model.parts, nn.END
    p["classes"] *= 300
    into = np.minimum(rows[:, :-1], end).astype(np.int64)
    z = nn.forward(p, into, rows[:, 0] == 65535, nn.Room())[0].reshape(-1, 16) @ p["classes"]
    assert z.max() > 61
    p["bias"] -= np.float32(z.max() - 50)
    w = np.exp(np.clip(z + p["bias"], -60, 60).astype(np.float64))
    aim = rows[:, nn.LEAD + 1 :].ravel().astype(int)
    mine = aim != 65535
    slope = (w / w.sum(1, keepdims=True))[mine].sum(0) - np.bincount(model.class_of[aim[mine]], minlength=w.shape[1])
    before = p["bias"].copy()
    nn.fit(model, rows, [np.arange(len(rows))], 1, 0.03)
    sure = np.abs(slope) > 1e-2
    assert (np.sign(before - model.parts["bias"]) == np.sign(slope))[sure].all()


def test_classes_are_looked_at_in_blocks():
    """What a step holds for a window does not include a number for each scored place and class, nor keys and values."""
    ids, first = sample()
    counts = np.bincount(ids, minlength=nn.VOCAB)
    model, rows = nn.start(nn.classes(counts, *nn.contexts(ids, first, nn.columns(counts))), counts), nn.sequences(ids, first)
    pick = np.arange(2000) % len(rows)
    tracemalloc.start()
    nn.fit(model, rows, [pick], 1, 0.03)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / len(pick) < 40_000  # numbers of all places and classes would take 10,000 bytes more


def test_spaced_words():
    texts = ["", "A  b\tc", " \n", "d", "", "É x ", "e f"]
    _, _, data, offsets = next(tx.slices(pa.array(texts)))
    out, starts, ends, first = tx.spaced_words(data, offsets)
    words = [[" " + "".join(c.lower() if c.isascii() else c for c in w) for w in t.split()] for t in texts]
    assert [out[i:j].tobytes().decode() for i, j in zip(starts.tolist(), ends.tolist(), strict=True)] == sum(words, [])
    assert np.diff(first).tolist() == [len(w) for w in words]


def test_training_lowers_the_loss():
    """More steps are better on the sample."""
    ids, first = sample()
    losses = []
    for steps in (1, 60, 300):
        m = trained(ids, first, steps)
        losses.append(-nn.score(m, ids, first, np.zeros(nn.VOCAB)).sum())
    assert losses[0] > losses[1] > losses[2]


def test_model_keeps_its_size():
    """The context, classes and hidden units that the model was designed with, whatever the CPU budget."""
    assert (nn.WINDOW, nn.STRIDE, nn.SINGLE, nn.GROUPS) == (32, 26, 48, 48)
    assert nn.start(np.zeros(nn.VOCAB, np.int64), np.zeros(nn.VOCAB, np.int64)).parts["up"].shape == (16, 32)


def chunks_of(spark, rows, parts=3):
    df = spark.createDataFrame([(i, i * 7919, True, t) for i, t in rows], "_key long, _seed long, _train boolean, _text string")
    return lm.encode(df.repartition(parts), tokens.BYTE_RANKS, 3000)


def test_all_training_documents_teach(spark):
    """Learning covers all of them, whatever chunks they come in; ids that none has are a class apart."""
    rows = [(i, "the cat sat on a mat") for i in range(40)] + [(100 + i, "zebra quartz " * 30) for i in range(800)]
    of = tokens.Ids()
    _, _, data, offsets = next(tx.slices(pa.array([t for _, t in rows])))
    ids, first = lm.word_ids(data, offsets, of)
    counts, known = np.bincount(ids, minlength=nn.VOCAB), np.unique(ids)
    assert (lm._ids_counts(chunks_of(spark, rows)) == counts).all()
    few, all_ = (lm.learn(chunks_of(spark, r), counts, shard=1500, rounds=2) for r in (rows[:60], rows))
    assert (all_.class_of[known] != nn.UNSEEN).all() and (np.delete(all_.class_of, known) == nn.UNSEEN).all()
    before, after = (nn.score(m, ids, first, nn.shares(m.class_of, counts)).sum() for m in (few, all_))
    assert after > before
    again = lm.learn(chunks_of(spark, rows, 5), counts, shard=1500, rounds=2)
    assert all(np.allclose(again.parts[k], all_.parts[k], atol=1e-4) for k in again.parts)


def test_words_are_told_apart_by_their_ids():
    texts = ["a b a", "", " ab a b \u00a0x é漢 é漢 don't don't.", "x" * 500]
    of = tokens.Ids(tokens.BYTE_RANKS)
    _, _, data, offsets = next(tx.slices(pa.array(texts)))
    ids, first = lm.word_ids(data, offsets, of)
    found, texts_at = lm.words_of(ids, first, lm.word_starts(tokens.BYTE_RANKS), tx.Powers())
    words = [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert np.diff(texts_at).tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
    pairs = set(zip(words, found.tolist(), strict=True))
    assert len(pairs) == len(set(words)) == len(set(found.tolist()))
