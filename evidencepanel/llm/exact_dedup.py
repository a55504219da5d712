"""Exact duplicates by composable polynomial fingerprints.

A text is cut into chunks.  Each is hashed (16-bit words times a vector of powers,
modulo two primes), one after another, and chunk hashes combine to the hash of the whole: ``hash(a + b) = hash(a) * base ** words(b) + hash(b)``.  Texts whose
fingerprint and length agree are then compared chunk by chunk in a streaming
aggregate; a group that holds different texts is split by their SHA-256.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencepanel.llm.common import fresh, id_and_text, stored, text_slices
from evidencepanel.operators.groups import same_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIMES = (2**31 - 1, 2**31 - 19)
BASES = (1_103_515_245, 826_366_247)
CHUNK_BYTES = 1 << 16
CHUNK_WORDS = CHUNK_BYTES // 2

FINGERPRINT = "doc_id long, n_bytes long, fingerprint long, text_sha256 string"


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """``base ** (n - 1), ..., base, 1`` modulo the prime."""
    out = np.ones(n, np.int64)
    filled = 1
    while filled < n:
        take = min(filled, n - filled)
        out[filled : filled + take] = out[:take] * pow(base, filled, prime) % prime
        filled += take
    return out[::-1].copy()


def combine(left: int, right: int, right_words: int, base: int, prime: int) -> int:
    """The hash of two joined pieces from their hashes and the length of the second."""
    return (left * pow(base, right_words, prime) + right) % prime


def text_fingerprint(data: bytes, tables: list[np.ndarray]) -> int:
    """62 bits of two polynomial hashes; an odd last byte is filled with zero."""
    whole = len(data) // CHUNK_BYTES
    head = np.frombuffer(data, "<u2", whole * CHUNK_WORDS).reshape(whole, CHUNK_WORDS) if whole else None
    tail = data[whole * CHUNK_BYTES :]
    rest = np.frombuffer(tail + b"\0" * (len(tail) % 2), "<u2").astype(np.int64)
    out = 0
    for table, base, prime in zip(tables, BASES, PRIMES, strict=True):
        value = 0
        for chunk in head if whole else ():
            value = combine(value, int(chunk.astype(np.int64) @ table % prime), CHUNK_WORDS, base, prime)
        if len(rest):
            value = combine(value, int(rest @ table[CHUNK_WORDS - len(rest) :] % prime), len(rest), base, prime)
        out = out << 31 | value
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Length, fingerprint and SHA-256 of every text with A-Z lowered; null counts as empty."""

    def run(batches):
        tables = [powers(b, p, CHUNK_WORDS) for b, p in zip(BASES, PRIMES, strict=True)]
        for ids, texts in text_slices(batches):
            low = [t.lower() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(t) for t in low], pa.int64()),
                    pa.array([text_fingerprint(t, tables) for t in low], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in low], pa.string()),
                ],
                names=["doc_id", "n_bytes", "fingerprint", "text_sha256"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, FINGERPRINT)


def _grouped(prints: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with its group's keeper and size; a hot group can be split over tasks."""
    groups = prints.groupBy(*keys).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.withColumnsRenamed({k: f"_{k}" for k in keys})
    joined = prints.join(groups, same_key((prints[k], groups[f"_{k}"]) for k in keys))
    return joined.drop(*[f"_{k}" for k in keys])


def lowered(text_col: str) -> Column:
    """The text with A-Z lowered; null counts as empty."""
    return F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unequal_groups(docs: DataFrame, grouped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint groups whose texts differ in some chunk.

    Every chunk of every suspect goes into a min and a max per group and chunk number:
    the two agree exactly if all copies of that chunk do.  Copies fold before the
    shuffle, so a group of any size is compared without meeting in one task.
    """
    suspects = grouped.where("group_size > 1").select("doc_id", "fingerprint", "n_bytes").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), lowered(text_col).cast("binary").alias("low"))
    pieces = texts.join(suspects, "doc_id").select(
        "fingerprint",
        "n_bytes",
        "low",
        F.explode(F.sequence(F.lit(0), F.expr(f"cast(greatest(octet_length(low) - 1, 0) div {CHUNK_BYTES} as int)"))).alias("chunk"),
    )
    piece = F.substring(F.col("low"), F.col("chunk") * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES))
    return (
        pieces.select("fingerprint", "n_bytes", "chunk", piece.alias("piece"))
        .groupBy("fingerprint", "n_bytes", "chunk")
        .agg(F.min("piece").alias("low"), F.max("piece").alias("high"))
        .where("low <> high")
        .select("fingerprint", "n_bytes")
        .distinct()
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lowering A-Z; of equal texts the largest number
    stays.  Null and empty texts are equal to each other.  Rows that repeat a number are
    the same document: each is returned, counted in ``group_size`` and kept or dropped
    alike.  A null number stays only if all of its group are null.  An empty table gives
    no rows; other columns are ignored.
    """
    prints = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    grouped = _grouped(prints, ["fingerprint", "n_bytes"])
    broken = stored(unequal_groups(docs, grouped, id_col, text_col), "collisions")
    if not broken.isEmpty():
        hit = broken.withColumn("_split", F.lit(True))
        keyed = prints.join(hit, ["fingerprint", "n_bytes"], "left").withColumn("_split", F.when(F.col("_split"), F.col("text_sha256")).otherwise(F.lit("")))
        grouped = _grouped(keyed, ["fingerprint", "n_bytes", "_split"])
    return grouped.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_one_copy(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, all columns as given.

    A row stays if its number is the largest of its equal texts; rows of one number and
    equal texts fold to one.  Two texts under one number are two documents.  Null and empty
    texts are equal to each other.  A null number cannot be told apart from another; such
    rows stay.  An empty table gives no rows; other columns, whatever their names, pass
    through, and of folded rows any one's are kept.
    """
    found = stored(exact_duplicates(docs, id_col, text_col), "kept")
    number, digest = fresh(docs, "_kept"), fresh(docs, "_digest")
    kept = found.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(number), F.col("text_sha256").alias(digest))
    given = F.col(f"`{id_col}`")
    if found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        one = docs.join(kept.select(number), given.cast("long") == F.col(number), "left_semi")
    else:
        mine = docs.withColumn(digest, F.sha2(lowered(text_col).cast("binary"), 256))
        same = [given.cast("long") == F.col(number), mine[digest] == F.col(f"k.{digest}")]
        one = mine.join(kept.distinct().alias("k"), same, "left_semi").dropDuplicates([id_col, digest]).drop(digest)
    return one.unionByName(docs.where(given.isNull()))
