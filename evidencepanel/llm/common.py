"""Shared pieces of the text operators: written tables, text batches, word hashes."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidencepanel.plans.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 1 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once below the session's checkpoint folder and reads it back.

    What is read back has no lineage beyond files that every executor reaches, so a
    lost executor costs a re-read, not the work before it.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as make it unlike any column's."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The number and the text (null as empty, UTF-8 bytes) of every document."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )


def text_slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Numbers and texts in runs of at most ``most`` bytes (or one text), so that work
    arrays stay small."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        if not len(texts):
            continue
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            before = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield ids.slice(at, end - at).to_pylist(), texts.slice(at, end - at).to_pylist()
            at = end


def batch_slices(batches: Iterator[pa.RecordBatch], text_col: str, most: int = 4 * SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows with at most ``most`` bytes of text (or one row)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < len(ends):
            before = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def worker_cache(key: str, make):
    """A value that one Python worker makes once and keeps between its tasks."""
    kept = sys.__dict__.setdefault("_evidencepanel_llm", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


# ------------------------------------------------------------------- word hashes
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (shift, multiply, shift)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as long as asked for."""

    def __init__(self) -> None:
        self.inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            with np.errstate(over="ignore"):
                self.up = np.concatenate([self.up[:1], np.full(size - 1, BASE)]).cumprod(dtype=np.uint64)
                self.down = np.concatenate([self.down[:1], np.full(size - 1, self.inverse)]).cumprod(dtype=np.uint64)
        return self.up, self.down


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range: equal bytes give equal hashes wherever they stand.

    For features, where a chance meeting of two words does no harm, and as a first sieve:
    made-up words can be given equal hashes.  What must tell words apart uses
    ``word_hashes`` or compares the bytes as well.
    """
    up, down = worker_cache("powers", _Powers).upto(len(data) + 1)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=prefix[1:])
        return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64) * BASE)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash (XXH3) of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` word hashes, scrambled word by word; fewer words are one run."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = mix64(out * BASE + words[i : i + n])
    return out


def words_of(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words between ASCII white space, A-Z lowered, joined by one space; their ranges."""
    joined = b" ".join(text.lower().split())
    if not joined:
        none = np.zeros(0, np.int64)
        return joined, none, none
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return joined, np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(joined)]])
