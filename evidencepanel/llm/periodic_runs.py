"""Periodic runs of words: seeds on diagonals, extended once per lag.

A run of period ``q`` and length ``n >= max(6, 4 q)`` repeats itself at lag ``q`` over
``n - q`` words.  Lags are taken in scales ``[2**j, 2**(j + 1))``; within a scale every
run repeats at least ``3 * 2**j`` words (5 for lag 1), so grams of that many words are
indexed, named exactly by pairs of the names of shorter grams.  A gram is no shorter than
the lags of its scale, so inside a run it comes again one period later and not before:
only consecutive occurrences need to be looked at.  Each is extended to both sides unless
the table of its lag says that its place is covered already.

All of a slice of texts is named at once; a border word of its own stands between texts.
A text is worked on in one task, in arrays of a few numbers per word.
"""

from __future__ import annotations

import hashlib
import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from evidencepanel.llm.common import id_and_text, text_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_WORDS = 6
LEAST_TURNS = 4

RUNS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
SPANS = "doc_id long, start long, length long, period long, passage string"

Run = tuple[int, int, int]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a repetition planted by the number: one document in ten repeats a
    stretch of itself from some word on.  No number, no change."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + p]
    turns, rest = divmod(n - a, p)
    return words[:a] + stretch * turns + stretch[:rest]


def named(names: np.ndarray, at: np.ndarray, width: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the grams of ``wanted`` words that start at ``at`` (increasing) from the
    names of those of ``width`` words, ``width <= wanted <= 2 * width``; only grams that
    occur more than once, with their places."""
    second = np.searchsorted(at, at + (wanted - width))
    inside = second < len(at)
    inside[inside] = at[second[inside]] == at[inside] + (wanted - width)
    first = np.flatnonzero(inside)
    if not len(first):
        return names[:0], at[:0]
    codes, uniques = pd.factorize(names[first] * (int(names.max()) + 1) + names[second[first]])
    often = np.bincount(codes, minlength=len(uniques))[codes] > 1
    return codes[often], at[first[often]]


def repeats(codes: np.ndarray, at: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of consecutive occurrences of a gram, for lags in ``[least, most)``."""
    order = np.argsort(codes, kind="stable")
    place, lag = at[order][:-1], np.diff(at[order])
    hit = (np.diff(codes[order]) == 0) & (lag >= least) & (lag < most)
    order = np.argsort(place[hit], kind="stable")
    return place[hit][order], lag[hit][order]


def stretch(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest ``[start, end)`` around ``at`` whose words equal those ``lag`` further."""
    end, step = at, 16
    while end < len(ids) - lag:
        to = min(end + step, len(ids) - lag)
        unequal = np.flatnonzero(ids[end:to] != ids[end + lag : to + lag])
        if len(unequal):
            end += int(unequal[0])
            break
        end, step = to, 2 * step
    start, step = at, 16
    while start > 0:
        to = max(start - step, 0)
        unequal = np.flatnonzero(ids[to:start] != ids[to + lag : start + lag])
        if len(unequal):
            start = to + int(unequal[-1]) + 1
            break
        start, step = to, 2 * step
    return start, end


def primitive(root: np.ndarray) -> bool:
    """Whether a word is no power of a shorter one."""
    n = rest = len(root)
    d = 2
    while rest > 1:
        if d * d > rest:
            d = rest
        if rest % d == 0:
            while rest % d == 0:
                rest //= d
            part = n // d
            if np.array_equal(root[part:], root[: n - part]):
                return False
        d += 1
    return True


def periodic_stretches(ids: np.ndarray) -> list[Run]:
    """All runs ``(start, length, period)`` of a sequence of word ids, by start and period."""
    found: list[Run] = []
    everywhere = np.arange(len(ids))
    two = named(ids.astype(np.int64), everywhere, 1, 2)
    three = named(*two, 2, 3)
    five = named(*three, 3, 5)
    scales = [(5, 1, 2, five)] if len(five[0]) else []
    width, grams = 6, named(*three, 3, 6)
    while len(grams[0]):
        scales.append((width, width // 3, 2 * width // 3, grams))
        width, grams = 2 * width, named(*grams, width, 2 * width)
    for _, least, most, (codes, at) in scales:
        covered: dict[int, int] = {}
        for place, lag in zip(*(x.tolist() for x in repeats(codes, at, least, most)), strict=True):
            if place < covered.get(lag, 0):
                continue
            start, end = stretch(ids, place, lag)
            covered[lag] = end
            length = end - start + lag
            if length >= max(LEAST_WORDS, LEAST_TURNS * lag) and primitive(ids[start : start + lag]):
                found.append((start, length, lag))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of_texts(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of every list of words; places count from its first word."""
    words: list[bytes] = []
    for t in texts:
        words += t
    sizes = np.array([len(t) for t in texts], np.int64)
    flat, _ = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, np.int64), None)
    starts = np.cumsum(sizes + 1) - sizes - 1
    top = int(flat.max()) + 1 if len(flat) else 0
    ids = np.arange(top, top + int(sizes.sum()) + len(texts), dtype=np.int64)
    inside = np.ones(len(ids), bool)
    inside[starts + sizes] = False
    ids[inside] = flat
    out: list[list[Run]] = [[] for _ in texts]
    for start, length, period in periodic_stretches(ids):
        k = int(np.searchsorted(starts, start, side="right")) - 1
        out[k].append((start - int(starts[k]), length, period))
    return out


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length over period; ties: least start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words but those that a run holds behind its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [w for w, k in zip(words, kept.tolist(), strict=True) if k]


def _looked_at(batches, plant: bool = False):
    """Numbers, texts, their words and the runs of these, slice by slice."""
    for ids, texts in text_slices(batches):
        words = [t.split() for t in texts]
        if plant:
            words = [planted(w, i) for w, i in zip(words, ids, strict=True)]
        yield ids, texts, words, runs_of_texts(words)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run: ``doc_id, start, length, period`` and the repeated ``passage`` (the
    first period, words joined by one space).

    Words lie between ASCII white space; a run has at least 6 words and 4 periods, its
    period is the smallest and no neighbouring word extends it.  Texts that are null,
    empty or without runs give no rows.  Rows that repeat a number or a text are each
    looked at; a null number stays null.  Other columns are ignored.
    """

    def run(batches):
        for ids, _, words, runs in _looked_at(batches):
            rows = [(i, *r, b" ".join(w[r[0] : r[0] + r[2]])) for i, w, found in zip(ids, words, runs, strict=True) for r in found]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            arrays = [pa.array(list(c), pa.int64()) for c in columns[:4]]
            passage = pa.array(list(columns[4]), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, passage], names=["doc_id", "start", "length", "period", "passage"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SPANS)


def without_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: every text with each run cut to its first period; kept words are
    joined by one space.  A text without runs stays as it is; null becomes empty."""

    def run(batches):
        for ids, texts, words, runs in _looked_at(batches):
            cut = [b" ".join(collapsed(w, r)) if r else t for t, w, r in zip(texts, words, runs, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(cut, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, text string")


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """One row per input row: number of runs, the strongest run, a digest of all runs and
    one of the words left when runs are cut to their first period.

    The strongest run has the greatest exact length over period (ties: least start, then
    period); without a run its columns are null and the digests are those of no runs and
    of all words.  Null and empty texts have no words.  Rows that repeat are each
    returned; a null number has nothing planted.  An empty table gives no rows; other
    columns are ignored.  ``plant`` repeats stretches of some documents first, by number.
    """

    def run(batches):
        for ids, _, words, runs in _looked_at(batches, plant):
            best = [strongest(r) for r in runs]
            lines = [b"".join(b"%d,%d,%d\n" % x for x in r) for r in runs]
            left = [b" ".join(collapsed(w, r)) for w, r in zip(words, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(r) for r in runs], pa.int64()),
                    *[pa.array([None if b is None else b[k] for b in best], pa.int64()) for k in range(3)],
                    pa.array([None if b is None else 1000 * b[1] // b[2] for b in best], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in lines]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in left]),
                ],
                names=[f.split()[0] for f in RUNS.split(", ")],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, RUNS)
