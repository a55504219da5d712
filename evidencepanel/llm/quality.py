"""A factorisation machine that scores documents for quality.

Inputs are hashed words, structure statistics in levels, and metadata columns.  The
score is ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; the pairs cost linear time
by ``((sum v_i x_i)**2 - sum (v_i x_i)**2) / 2``.  It is trained in numpy on a bounded
sample of labelled rows; scoring is one pass over all documents.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencepanel.llm.common import SLICE_BYTES, batch_slices, span_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD_BINS = 1 << 14
LEVELS = 16
TRAINING_ROWS = 8_000
FOLDS = 5

#: One group of levels each; a metadata column adds one more.
STATISTICS = (
    "words",
    "mean_word_length",
    "distinct_share",
    "commonest_share",
    "same_as_previous",
    "upper_words",
    "title_words",
    "symbol_ends",
    "lone_symbols",
    "digit_words",
    "letters",
    "digits",
    "marks",
    "words_per_line",
    "repeated_lines",
    "longest_word",
)


def _share(part: float, whole: float) -> int:
    """A share as a level: nothing, then finer steps near nothing and near all."""
    if whole <= 0 or part <= 0:
        return 0
    return 1 + min(LEVELS - 2, int((part / whole) ** 0.5 * (LEVELS - 1)))


def _size(value: float) -> int:
    return min(LEVELS - 1, int(np.log2(1 + max(0.0, value))))


def features(text: bytes, meta: tuple = ()) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one text; an empty one has its levels alone."""
    parts = text.split()
    joined = b" ".join(parts)
    data = np.frombuffer(joined, np.uint8)
    n = len(parts)
    levels = [0] * len(STATISTICS)
    if n:
        gaps = np.flatnonzero(data == 32)
        starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(joined)]])
        hashes = span_hashes(joined.lower(), starts, ends)
        bins, counts = np.unique((hashes % np.uint64(WORD_BINS)).astype(np.int64), return_counts=True)
        first, last = data[starts], data[ends - 1]
        upper = (data >= 65) & (data <= 90)
        letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
        digit = (data >= 48) & (data <= 57)
        word_upper, word_letters = np.add.reduceat(upper, starts, dtype=np.int64), np.add.reduceat(letter, starts, dtype=np.int64)
        word_digits = np.add.reduceat(digit, starts, dtype=np.int64)
        ends_in_symbol = np.isin(last, np.frombuffer(b"#$%&*!|@~^=<>{}[]\\_+/", np.uint8))
        lines = [x for x in text.split(b"\n") if x.strip()]
        length = len(data) - (n - 1)
        levels = [
            _size(n),
            min(LEVELS - 1, int(length / n)),
            _share(len(bins), n),
            _share(int(counts.max()), n),
            _share(int((hashes[1:] == hashes[:-1]).sum()), n),
            _share(int(((word_upper > 1) & (word_upper == word_letters)).sum()), n),
            _share(int(((first >= 65) & (first <= 90)).sum()), n),
            _share(int((ends_in_symbol & (word_letters > 0)).sum()), n),
            _share(int((word_letters + word_digits == 0).sum()), n),
            _share(int((word_digits > 0).sum()), n),
            _share(int(letter.sum()), length),
            _share(int(digit.sum()), length),
            _share(length - int(letter.sum()) - int(digit.sum()), length),
            _size(n / len(lines)),
            _share(len(lines) - len(set(lines)), len(lines)),
            _size(int((ends - starts).max())),
        ]
        words = np.log1p(counts.astype(np.float32))
        words /= np.sqrt(np.dot(words, words))
    else:
        bins, words = np.zeros(0, np.int64), np.zeros(0, np.float32)
    levels += [_size(float(m)) if m is not None and np.isfinite(float(m)) else 0 for m in meta]
    place = WORD_BINS + LEVELS * np.arange(len(levels)) + levels
    return np.concatenate([bins, place]), np.concatenate([words, np.full(len(levels), 0.3, np.float32)]).astype(np.float32)


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The probability of label 1; never an empty row, as levels are always there."""
        sizes = np.array([len(i) for i, _ in rows])
        starts = np.cumsum(sizes) - sizes
        where, value = np.concatenate([i for i, _ in rows]), np.concatenate([x for _, x in rows])
        return sigmoid(self._sums(where, value, starts)[0])

    def _sums(self, where: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        scaled = self.factors[where] * value[:, None]
        total = np.add.reduceat(scaled, starts)
        squares = np.add.reduceat((scaled * scaled).sum(axis=1), starts)
        out = self.bias + np.add.reduceat(self.linear[where] * value, starts) + 0.5 * ((total * total).sum(axis=1) - squares)
        return out, total, scaled


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, rank: int = 6, epochs: int = 12, rate: float = 0.08, decay: float = 2e-5, seed: int = 7) -> FactorisationMachine:
    """Minibatch Adagrad on the logistic loss.  One label alone gives its base rate."""
    random = np.random.default_rng(seed)
    share = float((labels.sum() + 1) / (len(labels) + 2))
    model = FactorisationMachine(float(np.log(share / (1 - share))), np.zeros(size, np.float32), random.normal(0, 0.02, (size, rank)).astype(np.float32))
    if len(labels) == 0 or labels.min() == labels.max():
        model.factors[:] = 0
        return model
    seen_linear, seen_factors = np.full(size, 1e-4, np.float32), np.full((size, rank), 1e-4, np.float32)
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), 64):
            batch = [rows[i] for i in order[at : at + 64]]
            sizes = np.array([len(i) for i, _ in batch])
            starts = np.cumsum(sizes) - sizes
            where, value = np.concatenate([i for i, _ in batch]), np.concatenate([x for _, x in batch])
            out, total, scaled = model._sums(where, value, starts)
            error = (sigmoid(out) - labels[order[at : at + 64]]).astype(np.float32)
            wide = np.repeat(error, sizes) * value
            pull = wide[:, None] * (np.repeat(total, sizes, axis=0) - scaled)
            used, local = np.unique(where, return_inverse=True)
            linear = np.bincount(local, wide, len(used)).astype(np.float32) + decay * model.linear[used]
            factors = np.stack([np.bincount(local, pull[:, k], len(used)) for k in range(rank)], axis=1).astype(np.float32) + decay * model.factors[used]
            seen_linear[used] += linear**2
            seen_factors[used] += factors**2
            model.linear[used] -= rate * linear / np.sqrt(seen_linear[used])
            model.factors[used] -= rate * factors / np.sqrt(seen_factors[used])
            model.bias -= 0.02 * float(error.mean())
    return model


def held_out(column: Column) -> Column:
    """Whether a number belongs to the fold that is never learned from."""
    return (F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % FOLDS) == 0


def _frame(docs: DataFrame, id_col: str, text_col: str, meta: tuple[str, ...]) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        F.array(*(F.col(m).cast("double") for m in meta)).cast("array<double>").alias("meta"),
    )


def _rows(batches):
    """Numbers and features, in runs of a few MB of text."""
    for batch in batches:
        ids, texts, meta = (c.to_pylist() for c in batch.columns[:3])
        at = 0
        while at < len(ids):
            end, total = at, 0
            while end < len(ids) and (end == at or total + len(texts[end]) <= SLICE_BYTES):
                total += len(texts[end])
                end += 1
            yield ids[at:end], [features(t, tuple(m)) for t, m in zip(texts[at:end], meta[at:end], strict=True)]
            at = end


def learn_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", meta: tuple[str, ...] = ("n_chars",), training_rows: int = TRAINING_ROWS) -> FactorisationMachine:
    """Fits the model on at most ``training_rows`` labelled rows outside the held-out fold,
    those with the least hash of their number.  Rows without a label or number are left out."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    chosen = (
        usable.groupBy(F.col(id_col).cast("long").alias("doc_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(training_rows)
    )
    # Bounded by training_rows, so it may travel to every task.
    found = _frame(docs, id_col, text_col, meta).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "meta", "label")

    def run(batches):
        for batch in batches:
            known = batch.column(3).to_pylist()
            at = 0
            for ids, rows in _rows([batch]):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(known[at : at + len(ids)], pa.int32()),
                        pa.array([i.astype("<i4").tobytes() for i, _ in rows], pa.binary()),
                        pa.array([x.astype("<f4").tobytes() for _, x in rows], pa.binary()),
                    ],
                    names=["doc_id", "label", "where", "value"],
                )
                at += len(ids)

    got = found.mapInArrow(run, "doc_id long, label int, where binary, value binary").toArrow()
    got = got.sort_by("doc_id")
    rows = [(np.frombuffer(w, "<i4").astype(np.int64), np.frombuffer(x, "<f4")) for w, x in zip(got["where"].to_pylist(), got["value"].to_pylist(), strict=True)]
    return train(rows, np.array(got["label"].to_pylist(), np.float32), WORD_BINS + LEVELS * (len(STATISTICS) + len(meta)))


def score_quality(docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text", meta: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """``doc_id, score`` of every row."""

    def run(batches):
        for ids, rows in _rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(model.scores(rows).astype(np.float64))], names=["doc_id", "score"])

    return _frame(docs, id_col, text_col, meta).mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", meta: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Labels are learned only from numbers whose CRC-32 (as text) is not divisible by five;
    numbers, labels, language and source are never inputs.  Null text counts as empty and
    is scored by its levels; null or non-finite metadata is the lowest level.  A null
    number is in the fold of the empty text.  Without labels every score is one half,
    with one label alone all have its base rate.  Repeated rows are scored alike; an
    empty table gives no rows.
    """
    model = learn_quality(docs, labels, label_col, id_col, text_col, meta)
    scored = score_quality(docs, model, id_col, text_col, meta)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", meta: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """The documents scored at ``threshold`` or more, all columns as given.

    Rows are filtered where they are scored, so nothing is joined back.
    """
    model = learn_quality(docs, labels, label_col, id_col, text_col, meta)

    def run(batches):
        for batch in batch_slices(batches, text_col):
            texts = [t.encode() if t is not None else b"" for t in batch.column(text_col).to_pylist()]
            given = list(zip(*(batch.column(m).to_pylist() for m in meta), strict=True)) if meta else [()] * len(texts)
            scores = [model.scores([features(t, m)])[0] for t, m in zip(texts, given, strict=True)]
            yield batch.filter(pa.array(np.array(scores) >= threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
