"""Exact centroid clustering of whole-numbered vectors, with bounds tightened by geometry.

Every vector keeps an upper bound of the distance to its own centroid and a lower bound
of that to any other.  When centroids move, the upper bound grows by the own centroid's
drift.  The lower bound need not shrink by the full drift of the others: the vectors of a
cluster lie in a sphere around its old centroid, and in the plane of that sphere's centre
and the path of another centroid the most that a distance can shrink is

    drift * cos(angle),

the angle, at the middle of the path, between its direction and the sphere (``shrink``).
A vector whose upper bound stays below its lower bound keeps its cluster unseen; all
others are ambiguous and scanned exactly, in whole numbers.

Vectors are stored once in blocks, bucketed by block number; the small state of a block
(clusters, bounds, sums per cluster) is written once a round, bucketed alike, so a round
reads both and exchanges neither.  What crosses the driver is one sum, count and radius
per cluster.
"""

from __future__ import annotations

import hashlib
import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidencepanel.llm.common import stored
from evidencepanel.plans.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 4096
#: Largest magnitude of a scaled component: squared distances of 64 of them fit a long.
LARGEST = 1 << 27
#: Up to here products of 64 components add up exactly in double precision.
EXACT_DOUBLE = 1 << 22
#: Bounds are doubles; they decide only beyond this share of the lengths involved.
SLACK = 1e-9

BLOCKS = "block long, ids array<long>, vectors binary"
#: ``totals``: vectors per cluster, their sums per cluster and component, and how many were scanned.
STATE = "block long, clusters binary, upper binary, lower binary, totals array<long>, radius array<double>"
ASSIGNED = "vec_id long, cluster int, distance long"


def shrink(centre: np.ndarray, radius: float, before: np.ndarray, after: np.ndarray) -> float:
    """The most by which the distance to a centroid that moves from ``before`` to ``after``
    can shrink for a point of the sphere.

    With ``m`` the middle of the path, ``s`` its length and ``x`` a point whose place along
    the path, seen from ``m``, is ``t``: ``|x - before|**2 - |x - after|**2 = 2 s t`` and
    ``|x - before| + |x - after| >= 2 |x - m|``, so the distance shrinks by at most
    ``s * t / |x - m|``, the drift times the cosine of the angle at ``m``.
    """
    path = after - before
    drift = float(np.sqrt(path @ path))
    if drift == 0.0:
        return 0.0
    to_centre = centre - (before + after) / 2
    far = float(np.sqrt(to_centre @ to_centre))
    if far <= radius * (1 + SLACK):
        return drift
    angle = np.arccos(np.clip(to_centre @ path / (far * drift), -1.0, 1.0)) - np.arcsin(min(1.0, radius / far))
    return drift * float(np.clip(np.cos(max(0.0, angle - 1e-7)), 0.0, 1.0))


def loosened(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, by how much lower bounds of its vectors shrink: the worst over
    all other centroids."""
    k = len(old)
    return np.array([max((shrink(old[a], radius[a], old[j], new[j]) for j in range(k) if j != a), default=0.0) for a in range(k)])


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-numbered vectors, as 64-bit numbers."""
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT_DOUBLE:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        dots = np.rint(v @ c.T).astype(np.int64)
        return (vectors * vectors).sum(1)[:, None] - 2 * dots + (centroids * centroids).sum(1)[None, :]
    return np.stack([((vectors - c) ** 2).sum(1) for c in centroids], axis=1)


def scan(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number), its distance and that of the next one."""
    squares = squared_distances(vectors, centroids)
    nearest = squares.argmin(1)
    rows = np.arange(len(vectors))
    upper = np.sqrt(squares[rows, nearest].astype(np.float64))
    if squares.shape[1] == 1:
        return nearest, upper, np.full(len(vectors), np.inf)
    squares[rows, nearest] = np.iinfo(np.int64).max
    return nearest, upper, np.sqrt(squares.min(1).astype(np.float64))


def moved(centroids: np.ndarray, counts: list[int], sums: list[list[int]]) -> np.ndarray:
    """Centroids at the rounded-down means of their vectors; empty clusters stay."""
    out = centroids.copy()
    for j, n in enumerate(counts):
        if n:
            out[j] = [s // n for s in sums[j]]
    return out


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """``vec_id, x``: ``floor(scale * x)`` of the vectors with ``size`` finite components."""
    x = F.col(vector_col)
    sound = x.isNotNull() & (F.size(x) == size) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    kept = table.where(F.coalesce(sound, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    whole = F.transform("x", lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    too_large = F.exists("x", lambda v: F.abs(v) >= F.lit(LARGEST))
    return kept.select("vec_id", whole.alias("x")).select(
        "vec_id", F.when(too_large, F.raise_error(F.lit(f"a scaled component reaches {LARGEST}; distances would not fit a long"))).otherwise(F.col("x")).alias("x")
    )


def first_centroids(whole: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the least hash of salt and number, in that order."""
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = whole.where("vec_id IS NOT NULL").select(key.alias("h"), "vec_id", "x").orderBy("h", "x").limit(k).collect()
    return np.array([r.x for r in rows], np.int64)


def vector_blocks(whole: DataFrame, size: int) -> DataFrame:
    """Vectors in blocks of up to 4096, with a number for each block.  Store before use."""

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(at, BLOCK)
                values = piece.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i8", copy=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | n], pa.int64()), pa.array([piece.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([values.tobytes()], pa.binary())],
                    names=["block", "ids", "vectors"],
                )
                n += 1

    return whole.select("vec_id", "x").mapInArrow(run, BLOCKS)


class Buckets:
    """Tables below the shared folder, bucketed alike by block number."""

    def __init__(self, spark: SparkSession, n: int) -> None:
        self.spark, self.n, self.names = spark, n, []

    def write(self, df: DataFrame, spread: bool = False) -> DataFrame:
        name = f"centroids_{uuid.uuid4().hex}"
        rows = df.repartition(self.n, "block") if spread else df
        rows.write.bucketBy(self.n, "block").option("path", scratch_path(self.spark, name)).saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def forget(self) -> None:
        """Drops the names; the files stay readable for plans that use them."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _beside(blocks: DataFrame, state: DataFrame) -> DataFrame:
    """Blocks with their state: equal buckets meet without an exchange; the state, about a
    twentieth of the vectors, is the hashed side."""
    return blocks.join(state.hint("shuffle_hash"), "block")


def _totals(vectors: np.ndarray, clusters: np.ndarray, k: int) -> np.ndarray:
    sums = [vectors[clusters == j].sum(0) for j in range(k)]
    return np.concatenate([np.bincount(clusters, minlength=k), *sums, [0]])


def _state_batch(block: int, clusters: np.ndarray, upper: np.ndarray, lower: np.ndarray, totals: np.ndarray, k: int) -> pa.RecordBatch:
    radius = np.zeros(k)
    np.maximum.at(radius, clusters, upper)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block], pa.int64()),
            *[pa.array([x.tobytes()], pa.binary()) for x in (clusters.astype("<i4"), upper, lower)],
            pa.array([totals.tolist()], pa.list_(pa.int64())),
            pa.array([radius.tolist()], pa.list_(pa.float64())),
        ],
        names=[f.split()[0] for f in STATE.split(", ")],
    )


def first_state(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector scanned once."""
    k, size = centroids.shape

    def run(batches):
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                vectors = np.frombuffer(data, "<i8").reshape(-1, size)
                clusters, upper, lower = scan(vectors, centroids)
                totals = _totals(vectors, clusters, k)
                totals[-1] = len(vectors)
                yield _state_batch(block, clusters, upper, lower, totals, k)

    return blocks.select("block", "vectors").mapInArrow(run, STATE)


def next_state(blocks: DataFrame, state: DataFrame, old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> DataFrame:
    """Bounds moved along with the centroids; ambiguous vectors scanned."""
    k, size = new.shape
    drift = np.sqrt(((new - old).astype(np.float64) ** 2).sum(1))
    loss = loosened(old.astype(np.float64), new.astype(np.float64), radius)

    def run(batches):
        for batch in batches:
            for block, data, c, u, low, totals in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                clusters = np.frombuffer(c, "<i4").astype(np.int64)
                upper = np.frombuffer(u, np.float64) + drift[clusters]
                lower = np.frombuffer(low, np.float64) - loss[clusters]
                totals = np.array(totals, np.int64)
                open_ = np.flatnonzero(~(upper * (1 + SLACK) + SLACK < lower * (1 - SLACK)))
                if len(open_):
                    vectors = np.frombuffer(data, "<i8").reshape(-1, size)
                    found, upper[open_], lower[open_] = scan(vectors[open_], new)
                    if (found != clusters[open_]).any():
                        clusters[open_] = found
                        totals = _totals(vectors, clusters, k)
                totals[-1] = len(open_)
                yield _state_batch(block, clusters, upper, lower, totals, k)

    used = _beside(blocks.select("block", "vectors"), state)
    return used.select("block", "vectors", "clusters", "upper", "lower", "totals").mapInArrow(run, STATE)


def folded(state: DataFrame, k: int, size: int) -> tuple[list[int], list[list[int]], np.ndarray, int]:
    """Count, sums and radius of every cluster, and the number of vectors scanned: about
    ``k`` times ``size`` numbers."""
    each = state.select(F.posexplode(F.arrays_zip("totals", "radius")).alias("pos", "c"))
    total = F.sum(F.col("c.totals").cast("decimal(38,0)")).alias("n")
    rows = sorted(each.groupBy("pos").agg(total, F.max("c.radius").alias("r")).collect(), key=lambda r: r.pos)
    values = [int(r.n) for r in rows]
    sums = [values[k + j * size : k + (j + 1) * size] for j in range(k)]
    return values[:k], sums, np.array([r.r for r in rows[:k]]), values[-1]


def _assigned(blocks: DataFrame, state: DataFrame, centroids: np.ndarray) -> DataFrame:
    size = centroids.shape[1]

    def run(batches):
        for batch in batches:
            for ids, data, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                vectors, clusters = np.frombuffer(data, "<i8").reshape(-1, size), np.frombuffer(c, "<i4")
                distance = ((vectors - centroids[clusters]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(clusters), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return _beside(blocks, state).select("ids", "vectors", "clusters").mapInArrow(run, ASSIGNED)


def clustered(
    table: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, salt: str = "3:", id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, np.ndarray, list[int]]:
    """Every vector's cluster and squared distance, the final centroids, and how many
    vectors were scanned before each of the ``rounds`` moves (all, at first).

    Vectors take part if they have ``size`` components, none null or non-finite; a
    component ``x`` counts as ``floor(scale * x)``.  The first centroids are the ``k``
    vectors (all, if fewer) with the least SHA-256 of ``salt`` and number, equal numbers
    by their components; a vector without a number is clustered but starts no centroid.
    Ties go to the smaller cluster, an empty cluster stays where it is.  Rows that repeat
    count each.  An empty table, or one without numbers, gives no rows.  Other columns
    are ignored.  A component that reaches 2**27 after scaling is an error, since squared
    distances would not fit a long.
    """
    spark = table.sparkSession
    whole = whole_vectors(table, id_col, vector_col, size, scale)
    centroids = first_centroids(whole, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], ASSIGNED), centroids, []
    given = stored(vector_blocks(whole, size), "vectors")
    tables = Buckets(spark, max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), given.count())))
    blocks = tables.write(given, spread=True)
    state = tables.write(first_state(blocks, centroids))
    scanned = []
    for _ in range(rounds):
        counts, sums, radius, seen = folded(state, len(centroids), size)
        after = moved(centroids, counts, sums)
        state = tables.write(next_state(blocks, state, centroids, after, radius))
        scanned.append(seen)
        centroids = after
    out = _assigned(blocks, state, centroids)
    tables.forget()
    return out, centroids, scanned


def cluster_digests(table: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, salt: str = "3:", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every
    vector that takes part (see ``clustered``).

    The sums meet the rows by one lookup of ``k`` rows.
    """
    assigned, centroids, _ = clustered(table, k, rounds, size, scale, salt, id_col, vector_col)
    rows = stored(assigned, "assigned")
    own = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(own.values())
    facts = [(j, own.get(j, 0), total, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(centroids)]
    small = table.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(small), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
