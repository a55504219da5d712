"""Exact top-k by integer inner product, in tiles.

Vectors are packed into blocks.  A tile is one block of queries times one block of
candidates: a matrix product, then a partial selection of each query's best.  A task
folds the tiles it meets, and lists merge in a tree of bounded fan-in until one list per
query is left.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidencepanel.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_NUMBERS = 1 << 19  # components in a block of candidates
QUERY_ROWS = 1024
FAN_IN = 16
LEAST, MOST = -(2**63), 2**63 - 1

BLOCKS = "size int, block long, ids binary, data binary, wide boolean"
LISTS = "query_id long, tile long, found array<struct<score:long,vec_id:long>>"


def usable(vector: Column) -> Column:
    """Vectors without null and non-finite components; a null vector is not usable."""
    wide = vector.cast("array<double>")
    return vector.isNotNull() & F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def blocks(vectors: DataFrame, rows: int | None = None) -> DataFrame:
    """``vec_id, vector`` packed where they lie, by length, as scaled integers in doubles."""

    def run(batches):
        number = 0
        for batch in batches:
            ids = np.array(batch.column(0).to_pylist(), np.int64)
            lists = batch.column(1)
            sizes = np.array([len(v) for v in lists.to_pylist()]) if len(ids) else np.zeros(0, int)
            flat = np.array(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
            begins = np.cumsum(sizes) - sizes
            for size in np.unique(sizes).tolist():
                chosen = np.flatnonzero(sizes == size)
                step = rows or max(1, BLOCK_NUMBERS // max(1, size))
                for at in range(0, len(chosen), step):
                    some = chosen[at : at + step]
                    data = np.floor(1024.0 * flat[begins[some][:, None] + np.arange(size)])
                    wide = bool(size and np.abs(data).max() ** 2 * size >= 2.0**53)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([size], pa.int32()),
                            pa.array([number], pa.int64()),
                            pa.array([ids[some].tobytes()], pa.binary()),
                            pa.array([data.astype("<f8").tobytes()], pa.binary()),
                            pa.array([wide], pa.bool_()),
                        ],
                        names=["size", "block", "ids", "data", "wide"],
                    )
                    number += 1

    return vectors.mapInArrow(run, BLOCKS)


def tile_best(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int, wide: bool) -> list[tuple[int, list[tuple[int, int]]]]:
    """The best ``(score, vec_id)`` of one tile per query, ties to the smaller number."""
    if wide:
        # Beyond 53 bits in sum: whole-number arithmetic, results held to 64 bits.
        a, b = (np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object) for x in (queries, data))
        product = np.vectorize(lambda v: min(max(int(v), LEAST), MOST), otypes=[np.int64])(a.dot(b.T))
    else:
        product = (queries @ data.T).astype(np.int64)
    out = []
    for row, query in enumerate(query_ids.tolist()):
        scores = product[row]
        other = ids != query
        candidates = np.flatnonzero(other)
        if len(candidates) > k:
            cut = np.partition(scores[candidates], len(candidates) - k)[len(candidates) - k]
            candidates = candidates[scores[candidates] >= cut]
        order = candidates[np.lexsort((ids[candidates], -scores[candidates].astype(object) if wide else -scores[candidates]))][:k]
        out.append((query, list(zip(scores[order].tolist(), ids[order].tolist(), strict=True))))
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of every query row.

    The score is the inner product of ``floor(1024 * x)``, ties go to the smaller number,
    fewer candidates give fewer rows.  Vectors that are null or hold null or non-finite
    components take no part, nor do rows without a number; vectors meet only vectors of
    their own length.  Rows that repeat a number are candidates of their own, but a
    query's own number is never its candidate; repeated queries give one list.  Scores
    beyond 64 bits are held at the limit.  An empty table gives no rows.
    """
    clean = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    columns = [F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")]
    candidates = stored(blocks(clean.select(*columns)).withColumn("tile", F.monotonically_increasing_id()), "blocks")
    asked = clean.where(is_query).select(*columns).dropDuplicates(["vec_id"])
    questions = stored(blocks(asked, QUERY_ROWS).select("size", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("wide").alias("q_wide")), "queries")
    # Every block of queries meets every block of candidates of its length: the candidate
    # blocks are dealt to shards, and query blocks are sent once to each shard.
    shards = max(1, min(candidates.count(), 4 * vectors.sparkSession.sparkContext.defaultParallelism))
    dealt = candidates.withColumn("shard", F.pmod(F.xxhash64("tile"), F.lit(shards)))
    sent = questions.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    tiles = dealt.join(sent, ["size", "shard"])

    def run(batches):
        best: dict[int, list[tuple[int, int]]] = {}
        first = 0
        for batch in batches:
            for size, tile, ids, data, wide, q_ids, q_data, q_wide in zip(*(batch.column(c).to_pylist() for c in ("size", "tile", "ids", "data", "wide", "q_ids", "q_data", "q_wide")), strict=True):
                ids, q_ids = np.frombuffer(ids, np.int64), np.frombuffer(q_ids, np.int64)
                matrix, asks = np.frombuffer(data, "<f8").reshape(len(ids), size), np.frombuffer(q_data, "<f8").reshape(len(q_ids), size)
                for query, found in tile_best(asks, q_ids, matrix, ids, k, wide or q_wide):
                    known = best.get(query)
                    best[query] = found if known is None else sorted(known + found, key=lambda f: (-f[0], f[1]))[:k]
                first = tile
                if len(best) >= 64 * QUERY_ROWS:
                    yield _lists(best, first)
                    best = {}
        if best:
            yield _lists(best, first)

    lists = tiles.mapInArrow(run, LISTS)
    rounds = 1
    while FAN_IN**rounds < 4 * shards:
        rounds += 1
    for left in range(rounds - 1, -1, -1):
        # A group of lists is bounded by the fan-in on average; each list holds k entries.
        group = F.pmod(F.xxhash64("tile"), F.lit(FAN_IN**left))
        merged = F.flatten(F.collect_list("found"))
        ordered = F.array_sort(F.transform(merged, lambda f: F.struct((F.lit(-1) - f["score"]).alias("down"), f["vec_id"].alias("vec_id"), f["score"].alias("score"))))
        lists = (
            lists.withColumn("tile", group)
            .groupBy("query_id", "tile")
            .agg(F.transform(F.slice(ordered, 1, k), lambda f: F.struct(f["score"].alias("score"), f["vec_id"].alias("vec_id"))).alias("found"))
        )
    rows = lists.select("query_id", F.posexplode("found").alias("at", "f"))
    return rows.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))


def _lists(best: dict[int, list[tuple[int, int]]], tile: int) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64())]))
    found = [[{"score": s, "vec_id": v} for s, v in f] for f in best.values()]
    return pa.RecordBatch.from_arrays([pa.array(best, pa.int64()), pa.array([tile] * len(best), pa.int64()), pa.array(found, kind)], names=["query_id", "tile", "found"])
