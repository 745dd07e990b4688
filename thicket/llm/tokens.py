"""Token ids of Arrow text columns with a public byte-level tokenizer.

Texts are cut where the tokenizer's own pattern always cuts (before a space that a
visible character follows, around a single line break, before ASCII punctuation after
a letter or digit), and each distinct cut is encoded once by the tokenizers library.
The ids are those of encoding the whole text.
"""

from __future__ import annotations

import base64
import os
import sys
from collections.abc import Callable
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from . import text as tx

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: The same vocabulary as ranks, for a library that is faster on single words.
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Distinct cuts that are remembered, at most; then remembering starts anew.
REMEMBERED = 500_000
#: Bytes of cuts that are encoded at once, about; the library's results are large.
AT_ONCE = 1 << 16

#: Bytes that are or may begin white space of any kind.
_BLANK = tx.byte_set(b"\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\xc2\xe1\xe2\xe3")
_NAME = tx.byte_set(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_MARK = tx.byte_set(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where cuts begin; every text that isn't empty begins one."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    blank, line = _BLANK[data], data == 10
    begin = edge[:-1].copy()
    follows = np.zeros(n, bool)
    follows[:-1] = ~blank[1:] & ~edge[1:-1]
    begin |= (data == 32) & follows
    plain = np.zeros(n, bool)
    plain[1:] = ~blank[:-1] & (data[:-1] < 128) & ~edge[1:-1]
    alone = line & follows & plain
    begin |= alone
    begin[1:] |= alone[:-1]
    begin[1:] |= _MARK[data[1:]] & _NAME[data[:-1]]
    return np.flatnonzero(begin)


@dataclass(frozen=True)
class Library:
    """Encodes strings; sizes has the number of bytes of each id, and spaced which ids begin with a space."""

    encode: Callable[[str], list[int]]
    sizes: np.ndarray
    spaced: np.ndarray


def by_tokenizer(path: str) -> Library:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    sizes, spaced = np.zeros(tokenizer.get_vocab_size(), np.int64), np.zeros(tokenizer.get_vocab_size(), bool)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():  # a byte-level token has a character for each byte
        sizes[i], spaced[i] = len(token), token[0] == "\u0120"
    return Library(lambda s: tokenizer.encode_batch_fast([s], add_special_tokens=False)[0].ids, sizes, spaced)


def by_ranks(path: str) -> Library:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    sizes, spaced = np.zeros(max(ranks.values()) + 1, np.int64), np.zeros(max(ranks.values()) + 1, bool)
    for token, i in ranks.items():
        sizes[i], spaced[i] = len(token), token[:1] == b" "
    return Library(tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, sizes, spaced)


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of all spans, one after another."""
    ends = np.cumsum(sizes)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


class Ids:
    """Encodes slices of texts; holds the tokenizer and what it has encoded, by hash."""

    def __init__(self, path: str = BYTE_BPE) -> None:
        self.library = by_ranks(path) if path.endswith(".tiktoken") else by_tokenizer(path)
        self.powers = tx.Powers()
        self.forget()

    def forget(self) -> None:
        # sorted hashes of spans, and where each one's ids begin in flat and how many they are
        self.hashes, self.begin, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, where those of each span begin, and how many each has.

        Spans that begin with a visible character, or with one space before it, don't change their ids
        when they follow another span at once, or after a line break that is encoded alone; they go to
        the library as one string, whose ids are dealt out by their bytes. The others go one by one.
        """
        sizes, n = ends - starts, len(data)
        visible = ~_BLANK[data[starts]]
        spaced = (data[starts] == 32) & (sizes > 1) & ~_BLANK[data[np.minimum(starts + 1, n - 1)]]
        begin, counts, ids, held = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), [], 0
        alone = ~visible & ~spaced
        for mine, breaks in ((spaced, 0), (visible, 1)):
            at = np.flatnonzero(mine)
            cut = np.searchsorted(np.cumsum(sizes[at]), np.arange(0, int(sizes[at].sum()) + AT_ONCE, AT_ONCE))
            for own in (at[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True) if j > i):
                width = sizes[own] + breaks
                place = np.cumsum(width) - sizes[own]  # of each span's own bytes
                joined = gathered(data, starts[own] - breaks, width)
                if breaks:
                    joined[place - 1] = 10
                found = np.array(self.library.encode(joined.tobytes().decode("utf-8", "replace")), np.int32)
                edges = np.concatenate([[0], np.cumsum(self.library.sizes[found])])
                first, last = np.searchsorted(edges, place), np.searchsorted(edges, place + sizes[own])
                if edges[-1] != len(joined) or (edges[first] != place).any() or (edges[last] != place + sizes[own]).any():
                    alone[own] = True  # bytes that are no UTF-8
                    continue
                begin[own], counts[own] = held + first, last - first
                ids.append(found)
                held += len(found)
        for k in np.flatnonzero(alone).tolist():
            ids.append(np.array(self.library.encode(data[starts[k] : ends[k]].tobytes().decode("utf-8", "replace")), np.int32))
            begin[k], counts[k] = held, len(ids[-1])
            held += len(ids[-1])
        return np.concatenate([*ids, np.zeros(0, np.int32)]), begin, counts

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        ids, begin, counts = self._encoded(data, starts, ends)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.begin, self.sizes = np.insert(self.begin, at, begin + len(self.flat)), np.insert(self.sizes, at, counts)
        self.flat = np.concatenate([self.flat, ids])

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of hashes among those that are remembered, and which are there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def encode_spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans, one after another, and where each span's ids begin (one more at the end)."""
        hashes, inverse = np.unique(tx.span_hash(data, starts, ends, self.powers), return_inverse=True)
        at, known = self._find(hashes)
        if not known.all():
            if len(self.hashes) + len(hashes) - known.sum() > REMEMBERED:  # what is needed together is remembered together
                self.forget()
                known[:] = False
            index = np.zeros(len(hashes), np.int64)
            index[inverse] = np.arange(len(inverse))  # any span with the hash
            new = index[~known]
            self._learn(hashes[~known], data, starts[new], ends[new])
            at, _ = self._find(hashes)
        at = at[inverse]
        sizes = self.sizes[at]
        return gathered(self.flat, self.begin[at], sizes), np.concatenate([[0], np.cumsum(sizes)])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's ids begin (one more at the end)."""
        starts = cuts(data, offsets)
        ids, out = self.encode_spans(data, starts, np.append(starts[1:], len(data)).astype(np.int64))
        return ids, out[np.searchsorted(starts, offsets)]


def worker_ids(path: str = BYTE_BPE) -> Ids:
    """The Ids of this Python worker. Spark uses workers again, so that tasks that follow know what has been encoded.

    This package goes to workers by value, so that its own globals are new in each task; a module of the worker's stays.
    """
    kept = sys.modules.setdefault("_thicket_worker", ModuleType("_thicket_worker")).__dict__
    if path not in kept:
        kept[path] = Ids(path)
    return kept[path]
