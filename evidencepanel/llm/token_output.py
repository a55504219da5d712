"""Packed id matrices by best-fit decreasing, written as binary rows.

A batch's pieces are placed largest first, each into the fullest open sequence that
still takes it.  Free space is searched in a segment tree over capacities: node counts
say whether a sequence with at least so much room exists, the least such capacity is
found going down.  Documents longer than a sequence are split losslessly.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame

from evidencepanel.llm.common import id_and_text
from evidencepanel.llm.pieces import text_groups
from evidencepanel.llm.subwords import END_ID, byte_level, vocabulary_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 2048

PACKED = (
    "part int, sequence int, n_tokens int, ids binary, positions binary, "
    "cu_seqlens array<int>, doc_ids array<long>, starts array<long>"
)


class CapacityTree:
    """Open sequences by free space; finds the least space of at least a given size."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, space: int, n: int) -> None:
        node = self.leaves + space
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, space: int, sequence: int) -> None:
        self.open[space].append(sequence)
        self._add(space, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns ``(space, sequence)`` of the best fit."""
        node = self.leaves + size
        if not self.count[node]:
            # Up to the first ancestor whose right sibling holds something, then down its left edge.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        space = node - self.leaves
        self._add(space, -1)
        return space, self.open[space].pop()


def best_fit_decreasing(sizes: np.ndarray, window: int) -> list[list[int]]:
    """The pieces in each sequence; sizes are 1 to ``window``."""
    tree, sequences = CapacityTree(window), []
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        fit = tree.take(size)
        if fit is None:
            sequences.append([piece])
            space, sequence = window, len(sequences) - 1
        else:
            space, sequence = fit
            sequences[sequence].append(piece)
        if space > size:
            tree.put(space - size, sequence)
    return sequences


def packed_matrices(docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """One row per sequence: its ids (little-endian 32-bit, padded with ``end_id`` to
    ``window``), positions (16-bit, from 0 again at each segment and over the padding),
    cumulative segment lengths, and the document and first token of every segment.

    Rows pack within one partition and batch, so nothing is shuffled and a lost task is
    redone alone.  A null or empty text is its end id alone; rows with repeated or null
    numbers are documents of their own; an empty table gives no rows; other columns are
    ignored.  ``n_tokens`` does not count padding.
    """
    path = vocabulary or vocabulary_path("byte_bpe_50k.json")
    if window > 65536:
        raise ValueError("positions are 16 bits wide: a window holds at most 65536 tokens")

    def run(batches):
        tokenizer, part, sequence = byte_level(path), TaskContext.get().partitionId(), 0
        for ids, texts in text_groups(batches):
            pieces, owner, first = [], [], []
            for doc, tokens in zip(ids, tokenizer.encode(texts), strict=True):
                tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                for at in range(0, len(tokens), window):
                    pieces.append(tokens[at : at + window])
                    owner.append(doc)
                    first.append(at)
            sizes = np.array([len(p) for p in pieces], np.int64)
            packed = best_fit_decreasing(sizes, window)
            for at in range(0, len(packed), 1024):
                rows = packed[at : at + 1024]
                matrix = np.full((len(rows), window), end_id, "<u4")
                places = np.zeros((len(rows), window), "<u2")
                borders, docs_in, starts_in, used = [], [], [], []
                for row, members in enumerate(rows):
                    ends = np.cumsum(sizes[members])
                    matrix[row, : ends[-1]] = np.concatenate([pieces[m] for m in members])
                    begins = np.append(ends - sizes[members], ends[-1])
                    places[row] = np.arange(window) - np.repeat(begins, np.append(sizes[members], window - ends[-1]))
                    borders.append([0, *ends.tolist()])
                    docs_in.append([owner[m] for m in members])
                    starts_in.append([first[m] for m in members])
                    used.append(int(ends[-1]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), part, np.int32)),
                        pa.array(np.arange(sequence, sequence + len(rows), dtype=np.int32)),
                        pa.array(used, pa.int32()),
                        pa.array([m.tobytes() for m in matrix], pa.binary()),
                        pa.array([p.tobytes() for p in places], pa.binary()),
                        pa.array(borders, pa.list_(pa.int32())),
                        pa.array(docs_in, pa.list_(pa.int64())),
                        pa.array(starts_in, pa.list_(pa.int64())),
                    ],
                    names=[f.split()[0] for f in PACKED.split(", ")],
                )
                sequence += len(rows)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, PACKED)
