"""Token ids of whole texts, each distinct word encoded once per batch.

Texts are cut before single spaces, where no token can cross; equal words are found by
hash and told apart by their bytes, only the distinct ones are encoded, and ids are
spread back.
"""

from __future__ import annotations

import base64
import json
import re
import sys
from collections.abc import Callable
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import cloudpickle

from evidencepanel.llm.common import SLICE_BYTES, span_hashes, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END_ID = 1
#: What the words a worker remembers may take, their ids included.
CACHE_BYTES = 24 << 20
#: About what a remembered word takes besides its bytes and ids.
WORD_OVERHEAD = 150


def vocabulary_path(name: str) -> str:
    """Where the installed public vocabulary files are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of the ranges, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def after_white_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the places (of spaces) follow a white space character or the start."""
    one = data[np.maximum(at - 1, 0)]
    two = np.where(at > 1, data[np.maximum(at - 2, 0)], 0)
    three = np.where(at > 2, data[np.maximum(at - 3, 0)], 0)
    wide = (
        ((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
        | ((three == 0xE1) & (two == 0x9A) & (one == 0x80))
        | ((three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF)))
        | ((three == 0xE2) & (two == 0x81) & (one == 0x9F))
        | ((three == 0xE3) & (two == 0x80) & (one == 0x80))
    )
    return (at == 0) | ((one >= 9) & (one <= 13)) | ((one >= 28) & (one <= 32)) | ((one >= 0x80) & wide)


def equal_spans(joined: bytes, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte range the number of its class of equal ranges, and the place of the
    first of each class.  Ranges of one hash are compared byte by byte with the first of
    them; where one differs, the bytes themselves decide for all."""
    codes, distinct = pd.factorize(span_hashes(joined, starts, ends))
    first = np.zeros(len(distinct), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    again = np.flatnonzero(first[codes] != np.arange(len(codes)))
    model = first[codes[again]]
    lengths = (ends - starts)[again]
    same = np.array_equal(lengths, (ends - starts)[model])
    if same and np.array_equal(data[spread(starts[again], lengths)], data[spread(starts[model], lengths)]):
        return codes, first
    words = np.empty(len(starts), object)
    words[:] = [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    codes, distinct = pd.factorize(words)
    first = np.zeros(len(distinct), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return codes, first


class DistinctWords:
    """The words of a batch of texts: the distinct ones, and which one stands where."""

    def __init__(self, texts: list[bytes], any_space: bool = False) -> None:
        """``any_space``: only a space, not other white space, keeps a space from being a cut."""
        known: dict[bytes, int] = {}
        inverse, counts = [], []
        at = 0
        while at < len(texts):
            end, total = at, 0
            while end < len(texts) and (end == at or total + len(texts[end]) <= SLICE_BYTES):
                total += len(texts[end])
                end += 1
            joined = b"".join(texts[at:end])
            data = np.frombuffer(joined, np.uint8)
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts[at:end]])])
            spaces = np.flatnonzero(data == 32)
            blocked = ((spaces == 0) | (data[spaces - 1] == 32)) if any_space else after_white_space(data, spaces)
            cut = np.zeros(len(joined) + 1, bool)
            cut[bounds[:-1]] = True
            cut[spaces[~blocked]] = True
            cut[-1] = False
            starts = np.flatnonzero(cut)
            ends = np.append(starts[1:], len(joined)) if len(starts) else starts
            codes, first = equal_spans(joined, data, starts, ends)
            spans = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
            numbers = np.array([known.setdefault(joined[a:b], len(known)) for a, b in spans], np.int64)
            inverse.append(numbers[codes] if len(codes) else codes)
            counts.append(np.diff(np.searchsorted(starts, bounds)))
            at = end
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.inverse = np.concatenate(inverse) if inverse else np.zeros(0, np.int64)
        self.distinct = list(known)

    def per_text(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """For every text, the values of its words (ranges of ``flat``) one after another."""
        out = []
        edges = np.concatenate([[0], np.cumsum(self.counts)])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            used = self.inverse[a:b]
            out.append(flat[spread(starts[used], lengths[used])])
        return out


class WordCache:
    """Values of words already encoded by this worker, found by their bytes; starts anew
    when it takes more memory than allowed."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], kind: type, size: int = CACHE_BYTES) -> None:
        self.encode, self.kind, self.size = encode, kind, size
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.starts, self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.kind)
        self.used = self.taken = 0

    def _append(self, values: np.ndarray, count: np.ndarray) -> None:
        need = self.used + len(values)
        if need > len(self.flat):
            grown = np.zeros(max(need, 3 * len(self.flat) // 2), self.kind)
            grown[: self.used] = self.flat[: self.used]
            self.flat = grown
        self.flat[self.used : need] = values
        self.starts = np.concatenate([self.starts, np.cumsum(count) - count + self.used])
        self.lengths = np.concatenate([self.lengths, count])
        self.used = need

    def values(self, found: DistinctWords) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``flat, starts, lengths`` of the distinct words of a batch."""
        if self.taken > self.size:
            self._clear()
        known = self.place.get
        at = np.fromiter((known(w, -1) for w in found.distinct), np.int64, len(found.distinct))
        new = np.flatnonzero(at < 0)
        if len(new):
            words = [found.distinct[i] for i in new.tolist()]
            values, count = self.encode(words)
            at[new] = np.arange(len(self.place), len(self.place) + len(new))
            self.place.update(zip(words, at[new].tolist(), strict=True))
            self._append(values.astype(self.kind, copy=False), count)
            self.taken += sum(map(len, words)) + WORD_OVERHEAD * len(words) + values.nbytes
        return self.flat, self.starts[at], self.lengths[at]


class ByteLevelTokenizer:
    """Ids of a byte-level BPE vocabulary file.

    The rank file holds the vocabulary of the JSON file of the same stem; both give the
    same ids, which a test confirms.  Strings that the JSON file adds as tokens of their
    own are found first, longest first, and keep their ids.
    """

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        stem = path.removesuffix(".json").removesuffix(".tiktoken")
        with open(stem + ".tiktoken", "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        with open(stem + ".json", encoding="utf-8") as file:
            added = json.load(file)["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.added = {t["content"].encode(): t["id"] for t in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")") if longest else None
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        self.cache = WordCache(self._encode_words, np.uint32)

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        encode = self.encoding.encode_ordinary
        ids = [encode(w.decode()) for w in words]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        found = DistinctWords(texts)
        return found.per_text(*self.cache.values(found))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if self.cut is None or not any(self.cut.search(t) for t in texts):
            return self._plain(texts)
        parts = [self.cut.split(t) for t in texts]
        plain = iter(self._plain([p for t in parts for p in t[::2]]))
        out = []
        for t in parts:
            ids = [next(plain) if k % 2 == 0 else np.array([self.added[p]], np.uint32) for k, p in enumerate(t)]
            out.append(np.concatenate(ids))
        return out


def byte_level(path: str) -> ByteLevelTokenizer:
    return worker_cache(f"byte_level {path}", lambda: ByteLevelTokenizer(path))
