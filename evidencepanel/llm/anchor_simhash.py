"""Near duplicates by 64-bit SimHash, compared at the anchor points of a covering code.

The anchors are the words of a product of three binary Golay codes, on bits 0-22, 23-45
and 46-63 (the last filled up with five zeros).  Each block has covering radius 3: every
block value lies within 3 bits of exactly one code word.  The *excess* of a fingerprint at
an anchor is the number of bits by which it lies beyond the covering radius, summed over
the blocks; that many flips take it into the anchor's own region.

Two fingerprints that differ in at most ``1 + 2`` bits have one between them that is one
flip from the first and two from the second.  So, at the anchor of that one, the first
has excess at most 1 and the second at most 2.  Every fingerprint is dealt to all its
anchors of excess at most 2 (at most 139 of them; at most 16 have excess 1 or less), and is
compared there with those of excess at most 1: no linked pair is missed, and of ``2**36``
anchors two unlike texts rarely share one.

Equal fingerprints are folded first.  Anchors with one fingerprint are dropped.  The rest
are compared tile by tile, and a tile gives one edge per fingerprint, to the least that it
is tied to there, never all its pairs.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidencepanel.llm.common import id_and_text, stored, text_slices, words_of, worker_cache
from evidencepanel.llm.near_dedup import components
from evidencepanel.operators.groups import same_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE_WORDS = 3
SEED = 42
#: The generator polynomial of the binary Golay code of length 23 (fixed value).
GENERATOR = 0b101011100011
CODE_BITS, CHECK_BITS = 23, 11
BLOCKS = (23, 23, 18)
NEAR, FAR = 1, 2
TILE = 2048
HASHED_AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 22

FINGERPRINTS = "doc_id long, fingerprint long"


def simhash(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if set in over half of the hashes of the runs of ``width`` words,
    repeats included; a shorter text is one run, a text without words gives 0."""
    joined, starts, ends = words_of(text)
    if not len(starts):
        return 0
    n = max(1, len(starts) - width + 1)
    begin, end = starts[:n], ends[len(ends) - n :]
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, HASHED_AT_ONCE):
        spans = zip(begin[at : at + HASHED_AT_ONCE].tolist(), end[at : at + HASHED_AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """Number and fingerprint (as a signed long) of every document; null text counts as empty."""

    def run(batches):
        for ids, texts in text_slices(batches):
            values = np.array([simhash(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values)], names=["doc_id", "fingerprint"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, FINGERPRINTS)


# ----------------------------------------------------------------------- anchors
def syndromes(values: np.ndarray) -> np.ndarray:
    """What is left of 23-bit values when divided by the generator."""
    left = values.astype(np.int64)
    for bit in range(CODE_BITS - 1, CHECK_BITS - 1, -1):
        left = np.where(left >> bit & 1, left ^ (GENERATOR << (bit - CHECK_BITS)), left)
    return left


class Anchors:
    """For every syndrome of a block, the anchors within the excess asked for.

    ``offsets[s, i]`` is an anchor relative to a value of syndrome ``s``: value xor offset is
    the code word.  ``excess[s, i]`` is its excess; unused places have excess 9.
    """

    def __init__(self, free: int) -> None:
        flips = [0, *(1 << i for i in range(free)), *(1 << i | 1 << j for i in range(free) for j in range(i))]
        whole = range(CODE_BITS)
        patterns = [0, *(1 << i for i in whole), *(1 << i | 1 << j for i in whole for j in range(i))]
        patterns += [1 << i | 1 << j | 1 << k for i in whole for j in range(i) for k in range(j)]
        errors = np.array(patterns, np.int64)
        leader = np.zeros(1 << CHECK_BITS, np.int64)
        leader[syndromes(errors)] = errors
        flips_of = np.array(flips, np.int64)
        cost = np.bitwise_count(flips_of).astype(np.int64)
        reached = flips_of[None, :] ^ leader[np.arange(1 << CHECK_BITS)[:, None] ^ syndromes(flips_of)[None, :]]
        lists = []
        for row in reached:
            found, first = np.unique(row, return_index=True)
            best = np.full(len(found), 9)
            np.minimum.at(best, np.searchsorted(found, row), cost)
            order = np.argsort(best, kind="stable")
            lists.append((found[order], best[order]))
        most = max(len(f) for f, _ in lists)
        self.offsets = np.zeros((1 << CHECK_BITS, most), np.int64)
        self.excess = np.full((1 << CHECK_BITS, most), 9, np.int64)
        for s, (found, best) in enumerate(lists):
            self.offsets[s, : len(found)], self.excess[s, : len(found)] = found, best


def anchors_of(prints: np.ndarray, limit: int = FAR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, anchor, excess`` of every fingerprint at all its anchors within the limit.

    An anchor is told by the data bits of its three code words (twelve of each block).
    """
    row = np.arange(len(prints))
    anchor = np.zeros(len(prints), np.int64)
    excess = np.zeros(len(prints), np.int64)
    shift = 0
    for free in BLOCKS:
        table = worker_cache(f"anchors {free}", lambda free=free: Anchors(free))
        value = (prints[row] >> np.uint64(shift) & np.uint64((1 << free) - 1)).astype(np.int64)
        own = syndromes(value)
        total = excess[:, None] + table.excess[own]
        at, column = np.nonzero(total <= limit)
        word = (value[at] ^ table.offsets[own[at], column]) >> CHECK_BITS
        row, anchor, excess = row[at], anchor[at] << (CODE_BITS - CHECK_BITS) | word, total[at, column]
        shift += free
    return row, anchor, excess


def dealt(classes: DataFrame) -> DataFrame:
    """``anchor, fingerprint, near``: every fingerprint at its anchors; near ones have
    excess at most 1."""

    def run(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(values), 4096):
                own = values[at : at + 4096]
                row, anchor, excess = anchors_of(own.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(own[row]), pa.array(excess <= NEAR)], names=["anchor", "fingerprint", "near"])

    # A fingerprint becomes about 120 rows: few input rows a task.
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return classes.select("fingerprint").repartition(tasks, "fingerprint").mapInArrow(run, "anchor long, fingerprint long, near boolean")


# --------------------------------------------------------------------- comparing
def tied(groups: np.ndarray, prints: np.ndarray, near: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by group, edges ``(fingerprint, least fingerprint tied to it)`` over
    the links of a near with any row of its group."""
    starts = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1)) if len(groups) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(groups)))
    which = np.repeat(np.arange(len(starts)), sizes)
    lead = np.flatnonzero(near)
    number, into = sizes[which[lead]], starts[which[lead]]
    ends = np.cumsum(number)
    left, right = [], []
    at = 0
    while at < len(lead):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + PAIRS_AT_ONCE, side="right")))
        n = number[at:to]
        a = np.repeat(lead[at:to], n)
        b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(into[at:to], n)
        hit = np.bitwise_count(prints[a] ^ prints[b]) <= bits
        hit &= a != b
        left.append(a[hit])
        right.append(b[hit])
        at = to
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    label = np.arange(len(prints))
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    some = label != np.arange(len(prints))
    return prints[some], prints[label[some]]


def tile_edges(rows: DataFrame, bits: int) -> DataFrame:
    """Edges ``a, b`` from rows ``anchor, one, other, fingerprint, near``: each tile of an
    anchor stands together in one partition and is compared there."""

    def run(batches):
        kept: list[np.ndarray] = []

        def edges(columns):
            keys = columns[:3]
            change = np.any([np.diff(k) != 0 for k in keys], axis=0)
            groups = np.concatenate([[0], np.cumsum(change)])
            found = tied(groups, columns[3].view(np.uint64), columns[4].astype(bool), bits)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in found], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]
            joined = [np.concatenate([a, b]) for a, b in zip(kept, own, strict=True)] if kept else own
            last = np.all([k == k[-1] for k in joined[:3]], axis=0)
            cut = int(np.flatnonzero(~last)[-1]) + 1 if (~last).any() else 0
            if cut:
                yield edges([c[:cut] for c in joined])
            kept = [c[cut:] for c in joined]
        if kept:
            yield edges(kept)

    keys = ["anchor", "one", "other"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "fingerprint", "near").mapInArrow(run, "a long, b long")


def links_of_anchors(classes: DataFrame, bits: int = NEAR + FAR, tile: int = TILE) -> DataFrame:
    """Edges that tie all fingerprints linked at some anchor.

    An anchor with more than ``tile`` fingerprints is cut into parts by hash; every two
    parts make a tile, so that any number at one anchor is compared whole, by many tasks.
    """
    if bits > NEAR + FAR:
        raise ValueError(f"anchors are laid out for at most {NEAR + FAR} differing bits")
    rows = stored(dealt(classes), "anchors")
    sizes = rows.groupBy("anchor").agg(F.count("*").alias("size"), F.bool_or("near").alias("some")).where("size > 1 AND some")
    sizes = sizes.select(F.col("anchor").alias("at"), F.ceil(F.col("size") / tile).cast("int").alias("parts"))
    shared = rows.join(sizes, same_key([(rows["anchor"], sizes["at"])])).drop("at")
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    placed = shared.withColumn("part", part)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o")
    tiles = placed.select("anchor", "part", "fingerprint", "near", other)
    tiles = tiles.selectExpr("anchor", "least(part, o) AS one", "greatest(part, o) AS other", "fingerprint", "near")
    return tile_edges(tiles, bits).distinct()


def simhash_duplicates(docs: DataFrame, bits: int = NEAR + FAR, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    Fingerprints link when at most ``bits`` (3 or fewer) differ; ``component_id`` is the
    least number reachable.  Null, empty and wordless texts have fingerprint zero and link
    like any other.  Rows that repeat a number are each placed by their own text.  A null
    number makes no component smaller; a component of null numbers alone is null.  An
    empty table gives no rows; other columns are ignored.
    """
    prints = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    classes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links_of_anchors(classes, bits)).select(F.col("doc_id").alias("print"), F.col("component_id").alias("root"))
    rooted = classes.join(roots, classes["fingerprint"] == roots["print"], "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fingerprint").alias("print"), "component_id")
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return prints.join(named, same_key([(prints["fingerprint"], named["print"])])).select("doc_id", hexed, "component_id")
