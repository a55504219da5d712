"""Concatenate and cut: token streams end to end, cut into windows of fixed length.

First pass: every partition tokenizes its documents, notes how many tokens stand before
each document in the partition, and stores ids.  Prefix sums over the partition totals
(one number per partition) give global offsets.  Second pass: every document is cut
where global offsets cross a window border; what is left at the end is cut at powers of
two, which need no padding.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame

from evidencepanel.llm.common import id_and_text, stored
from evidencepanel.llm.pieces import text_groups
from evidencepanel.llm.subwords import END_ID, byte_level, vocabulary_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 2048

TOKENS = "part int, before long, doc_id long, n_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def token_table(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """The ids of every document, ``end_id`` behind each, with the number of tokens before
    it in its partition.  Store it before use: places hold for one run of the tasks."""
    path = vocabulary or vocabulary_path("byte_bpe_50k.json")

    def run(batches):
        tokenizer, part, before = byte_level(path), TaskContext.get().partitionId(), 0
        for ids, texts in text_groups(batches):
            tokens = [np.append(t, np.uint32(end_id)) for t in tokenizer.encode(texts)]
            counts = np.array([len(t) for t in tokens], np.int64)
            places = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(places),
                    pa.array(ids, pa.int64()),
                    pa.array(counts),
                    pa.array([t.astype("<u4").tobytes() for t in tokens], pa.binary()),
                ],
                names=["part", "before", "doc_id", "n_tokens", "ids"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, TOKENS)


def tail_borders(total: int, window: int) -> list[int]:
    """Starts of the sequences behind the last whole window: its rest in powers of two."""
    at, rest, out = total - total % window, total % window, []
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append(at)
        at, rest = at + size, rest - size
    return out


def pieces_of(begin: int, end: int, window: int, tail: list[int], total: int) -> list[tuple[int, int, int]]:
    """``(place, sequence, offset)`` of the pieces of a document at ``[begin, end)``."""
    whole = total - total % window
    out = []
    at = begin
    while at < end:
        if at < whole:
            sequence, first = divmod(at, window)
            out.append((at, sequence, first))
            at = (sequence + 1) * window
        else:
            k = int(np.searchsorted(tail, at, side="right")) - 1
            out.append((at, whole // window + k, at - tail[k]))
            at = tail[k + 1] if k + 1 < len(tail) else total
    return out


def concatenate_and_cut(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """The boundary records of a stored token table: one row per piece of a document.

    ``sequence_id`` and ``offset`` say where the piece lies; every sequence but those of
    the tail holds exactly ``window`` tokens.  The totals that cross the driver are one
    number per input partition.
    """
    parts = sorted((r.part, r.total) for r in tokens.groupBy("part").agg({"n_tokens": "sum"}).toDF("part", "total").collect())
    offsets, total = {}, 0
    for part, n in parts:
        offsets[part] = total
        total += n
    tail = tail_borders(total, window)

    def run(batches):
        for batch in batches:
            columns = [[] for _ in range(7)]
            for part, before, doc, count, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                begin = offsets[part] + before
                found = pieces_of(begin, begin + count, window, tail, total)
                for (at, sequence, offset), after in zip(found, [*(p[0] for p in found[1:]), begin + count], strict=True):
                    crc = zlib.crc32(data[4 * (at - begin) : 4 * (after - begin)])
                    for column, value in zip(columns, (doc, at - begin, after - at, crc, count, sequence, offset), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in PIECES.split(", ")])

    return tokens.select("part", "before", "doc_id", "n_tokens", "ids").mapInArrow(run, PIECES)


def packed_pieces(docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs all documents into sequences of at most ``window`` tokens; one row per piece.

    A null or empty text is its end id alone.  Every row is a document of its own, also
    where numbers or texts repeat or the number is null.  An empty table gives no rows;
    other columns are ignored.
    """
    return concatenate_and_cut(stored(token_table(docs, vocabulary, id_col, text_col), "tokens"), window)
