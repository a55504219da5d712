"""Near duplicates: one-permutation MinHash, banded buckets, star-shaped candidates.

One permutation: the 64-bit hash range is cut into equal bins, the least hash in each
bin is the signature.  Empty bins borrow from a bin drawn by a hash of (bin, attempt),
the same for every document, until a filled one is met (optimal densification).  Bands
of the signature name buckets.

Candidates never are all pairs of a bucket.  Each member meets the head of its bucket (a
star; see ``stars``), and the exact overlap is kept.  Links found merge documents into
components.  Where a bucket still holds several, members meet a few pivots more and found
components merge.  What the differences from the head do not rule out then (see
``open_members``) is compared in tiles, which give one edge per member, not the pairs (see
``tile_links``).  Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidencepanel.llm.common import fresh, id_and_text, mix64, run_hashes, stored, text_slices, word_hashes
from evidencepanel.operators.groups import same_key, top_per_group

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE_WORDS = 5
BINS = 192
MISS = 1e-6
#: Members that all others under a head are compared with, and how often they are drawn.
PIVOTS = 8
PIVOT_ROUNDS = 1
#: Members, and shingles in which they differ from their head, on one side of a tile.
TILE = 256
TILE_SHINGLES = 1 << 20

SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, buckets array<long>"


def banding(percent: int, bins: int = BINS, miss: float = MISS) -> tuple[int, int]:
    """Rows per band and bands: the longest bands that miss a pair at the threshold with
    a chance of at most ``miss``."""
    best = (1, bins)
    for rows in range(1, bins + 1):
        bands = bins // rows
        if (1 - (percent / 100) ** rows) ** bands <= miss:
            best = (rows, bands)
    return best


def shingle_set(text: bytes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one run."""
    return np.unique(run_hashes(word_hashes(text.lower().split()), width))


def donor(bins: int, attempt: int) -> np.ndarray:
    """For every bin, the bin it asks on the given attempt."""
    step = np.uint64(attempt * 0x5851F42D4C957F2D % (1 << 64))
    return (mix64(np.arange(bins, dtype=np.uint64) * np.uint64(1_000_003) + step) % np.uint64(bins)).astype(np.int64)


def signatures(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` minima per non-empty set, densified."""
    low = np.zeros((len(sets), bins), np.uint64)
    filled = np.zeros((len(sets), bins), bool)
    for row, hashes in enumerate(sets):
        where = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(where, prepend=-1))
        low[row, where[first]] = hashes[first]
        filled[row, where[first]] = True
    row, column = np.nonzero(~filled & filled.any(axis=1)[:, None])
    attempt = 0
    while len(row):
        asked = donor(bins, attempt)[column]
        hit = filled[row, asked]
        low[row[hit], column[hit]] = low[row[hit], asked[hit]]
        row, column = row[~hit], column[~hit]
        attempt += 1
    return low


def band_buckets(low: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """A 64-bit bucket name for each band of each signature."""
    out = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), (len(low), bands)).copy()
    cut = low[:, : rows * bands].reshape(len(low), bands, rows)
    for i in range(rows):
        out = mix64(out * np.uint64(31) + cut[:, :, i])
    return out


def minhash(docs: DataFrame, percent: int, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, bins: int = BINS) -> DataFrame:
    """Set size, a 128-bit name of the shingle set, and the bucket names of every document."""
    rows, bands = banding(percent, bins)

    def run(batches):
        for ids, texts in text_slices(batches):
            sets = [shingle_set(t, width) for t in texts]
            names = band_buckets(signatures(sets, bins), rows, bands).view(np.int64)
            some = np.array([len(s) > 0 for s in sets])
            offsets = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
            add = [int(np.sum(s, dtype=np.uint64)) if len(s) else 0 for s in sets]
            mixed = [int(np.sum(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)) if len(s) else 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array(add, np.uint64).view(np.int64)),
                    pa.array(np.array(mixed, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(names[some].ravel())),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "buckets"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SIGNATURE)


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """The full shingle set of every document, as sorted 64-bit hashes."""

    def run(batches):
        for ids, texts in text_slices(batches):
            sets = [shingle_set(t, width).view(np.int64) for t in texts]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets)))],
                names=["doc_id", "shingles"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, shingles array<long>")


def _with_sets(edges: DataFrame, sets: DataFrame) -> DataFrame:
    left = edges.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s_a")), "a")
    return left.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("s_b")), "b")


def compared(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """The edges ``a, b, n_a, n_b`` with the number of shingles both full sets hold."""
    return _with_sets(edges, sets).select("a", "b", "n_a", "n_b", F.size(F.array_intersect("s_a", "s_b")).cast("long").alias("common"))


def linked(facts: DataFrame, percent: int) -> DataFrame:
    return facts.where(f"100 * common >= {percent} * (n_a + n_b - common)").select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``doc_id, component_id`` for every linked document but the least of each component.

    Alternates the two star operations until nothing changes: every neighbour above a
    node, then every one below it, is tied to the least neighbour.  Minima fold before
    the shuffle; a hub is only a key of an equality join.
    """
    edges = stored(links.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v").distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(floor, "u")
        small = joined.selectExpr("v AS u", "m AS v").union(joined.selectExpr("u", "m AS v")).where("u <> v").distinct()
        edges = stored(small, "edges")
        state = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
        if state == seen:
            return edges.selectExpr("u AS doc_id", "v AS component_id")
        seen = state


def stars(reps: DataFrame) -> DataFrame:
    """``bucket, doc, n, head`` of the buckets with several members.

    The degree of a document is the number of documents in all its buckets.  A bucket's
    head is the document of highest degree, then least number, among its members and
    those that share a bucket with them: in a group of copies that is the text that the
    others were made from, if it is there, also for buckets that it is not in itself.
    """
    sizes = reps.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(reps.join(sizes, "bucket"), "members")
    degree = members.groupBy("doc").agg(F.sum("size").alias("degree"))
    own = F.struct("degree", (-F.col("doc")).alias("least"))
    top = members.join(degree, "doc").groupBy("bucket").agg(F.max(own).alias("top"))
    hub = members.join(top, "bucket").groupBy("doc").agg(F.max("top").alias("hub"))
    heads = members.join(hub, "doc").groupBy("bucket").agg(F.max("hub").alias("head"))
    return stored(members.join(heads, "bucket").select("bucket", "doc", "n", (-F.col("head.least")).alias("head")), "stars")


def families(members: DataFrame, facts: DataFrame, labels: DataFrame) -> DataFrame:
    """``head, doc, n, n_h, common`` of the members of buckets with several components,
    the head left out; ``common`` is what head and member share."""
    known = labels.select(F.col("doc_id").alias("doc"), F.col("component_id").alias("comp"))
    labelled = members.join(known, "doc", "left").select("bucket", "head", "doc", "n", F.coalesce("comp", "doc").alias("comp"))
    mixed = labelled.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("bucket")
    # A head may stand for buckets that it is not in: its component counts as one of theirs.
    rows = labelled.join(mixed, "bucket").where("doc <> head").select("head", "doc", "n").distinct()
    shared = facts.select(F.col("a").alias("head"), F.col("b").alias("doc"), F.col("n_a").alias("n_h"), "common")
    return stored(rows.join(shared, ["head", "doc"]), "families")


def with_components(family: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of heads under which several components are left, with their components."""
    known = labels.select(F.col("doc_id").alias("doc"), F.col("component_id").alias("comp"))
    tops = known.select(F.col("doc").alias("head"), F.col("comp").alias("comp_h"))
    rows = family.join(known, "doc", "left").join(tops, "head", "left")
    rows = rows.select("head", "doc", "n", "n_h", "common", F.coalesce("comp", "doc").alias("comp"), F.coalesce("comp_h", "head").alias("comp_h"))
    several = rows.groupBy("head").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("head")
    return rows.join(several, "head")


def pivot_pairs(rows: DataFrame, percent: int, turn: int, pivots: int = PIVOTS) -> DataFrame:
    """Every row with a few pivots of its head: members outside the head's component, drawn
    by a hash.  Linear in the rows, however many stand under one head."""
    outside = rows.where("comp <> comp_h").select("head", F.col("doc").alias("pivot"), F.col("n").alias("n_p"), F.col("comp").alias("comp_p"))
    drawn = top_per_group(outside, ["head"], [F.xxhash64(F.col("pivot"), F.lit(turn)), F.col("pivot")], pivots)
    able = F.expr(f"comp <> comp_p AND 100 * least(n, n_p) >= {percent} * greatest(n, n_p)")
    met = rows.join(drawn, "head").where(able)
    return met.selectExpr("least(doc, pivot) AS a", "greatest(doc, pivot) AS b", "IF(doc < pivot, n, n_p) AS n_a", "IF(doc < pivot, n_p, n) AS n_b").distinct()


def open_members(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``head, doc, n, comp, apart`` of the members that may still be linked to one of
    another component; ``apart`` are the shingles that only one of member and head holds.
    No link under a head is missed.

    Let ``d`` of a member be the shingles that only one of it and the head holds, and ``c``
    be ``(100 - percent) / (100 + percent)``.  Two texts are linked exactly if at most
    ``c * (n_a + n_b)`` shingles are in only one of them, and those are the ones in only one
    of ``d_a`` and ``d_b``.  If ``|d_a| + |d_b|`` is no more than that, both are linked to the
    head, so of one component.  So an open pair shares ``(|d_a| + |d_b| - c (n_a + n_b)) / 2``
    shingles of ``d`` or more, and (prefix filter) one among the rarest
    ``|d| - shared + 1`` of each.  At most one of the two is linked to the head, which
    bounds ``shared`` from below for either alone:

    * partner not linked: ``|d_b| > c (n_h + n_b)``, prefix ``(|d_a| + c (n_a - n_h)) / 2 + 1``;
    * partner linked: ``|d_b| >= |d_a| - c (n_a + n_b)``, prefix ``(100 - percent) / percent * n_a + 1``.

    Rare first: what many members lack or add comes last, and seldom into a prefix.
    """
    whole, rest = 100 + percent, 100 - percent
    own = sets.select(F.col("doc_id").alias("doc"), F.col("shingles").alias("s_d"))
    top = sets.select(F.col("doc_id").alias("head"), F.col("shingles").alias("s_h"))
    both = rows.join(own, "doc").join(top, "head")
    apart = F.concat(F.array_except("s_d", "s_h"), F.array_except("s_h", "s_d"))
    size = "n + n_h - 2 * common"
    to_open = f"({whole} * ({size}) + {rest} * (n - n_h)) div {2 * whole} + 1"
    to_linked = f"({rest} * n) div {percent} + 1"
    unlinked = f"100 * common < {percent} * (n + n_h - common)"
    prefix = F.expr(f"IF({unlinked}, greatest({to_open}, {to_linked}), {to_open})")
    wide = stored(both.select("head", "doc", "n", "comp", prefix.alias("prefix"), apart.alias("apart")), "apart")
    spread = wide.select("head", "doc", "comp", "prefix", F.explode("apart").alias("shingle"))
    often = spread.groupBy("head", "shingle").agg(F.count("*").alias("often"))
    order = Window.partitionBy("head", "doc").orderBy("often", "shingle")
    first = spread.join(often, ["head", "shingle"]).withColumn("place", F.row_number().over(order)).where("place <= prefix AND often > 1")
    first = stored(first.select("head", "doc", "comp", "shingle"), "first")
    shared = first.groupBy("head", "shingle").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("head", "shingle")
    still = first.join(shared, ["head", "shingle"]).select("head", "doc").distinct()
    return wide.drop("prefix").join(still, ["head", "doc"])


def tile_edges(docs: np.ndarray, sizes: np.ndarray, apart: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of each member of a tile to the least one that it is tied to there."""
    lengths = np.array([len(x) for x in apart], np.int64)
    owner = np.repeat(np.arange(len(docs)), lengths)
    _, code, times = np.unique(np.concatenate(apart), return_inverse=True, return_counts=True)
    several = times[code] > 1  # what one member alone holds is common to no pair
    column = (np.cumsum(times > 1) - 1)[code[several]]
    owner = owner[several]
    common = np.zeros((len(docs), len(docs)), np.int64)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [at, at + 4096])
        held = np.zeros((len(docs), 4096), np.float32)
        held[owner[a:b], column[a:b] - at] = 1
        common += np.rint(held @ held.T).astype(np.int64)
    unlike = lengths[:, None] + lengths[None, :] - 2 * common
    both = sizes[:, None] + sizes[None, :]
    near = (100 + percent) * unlike <= (100 - percent) * both
    label = np.arange(len(docs))
    while True:
        after = np.where(near, label[None, :], len(docs)).min(1)
        after = np.minimum(after, label)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    some = label != np.arange(len(docs))
    return docs[some], docs[label[some]]


def tile_links(members: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` that tie all linked members of each head.

    The members of a head are dealt into parts by hash, so that a part holds a few hundred;
    every two parts make a tile, compared by itself.  A head with any number of members
    is compared whole, by many tasks, and no pair leaves a tile.
    """
    rows = stored(members, "open")
    sizes = rows.groupBy("head").agg(F.greatest(F.count("*") / TILE, F.sum(F.size("apart")) / TILE_SHINGLES).alias("load"))
    parts = sizes.select(F.col("head").alias("top"), F.ceil("load").cast("int").alias("parts"))
    placed = rows.join(parts, same_key([(rows["head"], parts["top"])])).withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int"))
    spread = placed.select("head", "part", "doc", "n", "apart", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o"))
    keys = ["head", "one", "other"]
    tiles = spread.selectExpr("head", "least(part, o) AS one", "greatest(part, o) AS other", "doc", "n", "apart")

    def run(batches):
        own: list[tuple] = []
        at = None

        def edges():
            docs, sizes, apart = zip(*sorted(own, key=lambda r: r[0]), strict=True)
            found = tile_edges(np.array(docs, np.int64), np.array(sizes, np.int64), list(apart), percent)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b"])

        for batch in batches:
            for head, one, other, doc, n, apart in zip(*(c if i == 5 else c.to_pylist() for i, c in enumerate(batch.columns)), strict=True):
                if (head, one, other) != at:
                    if len(own) > 1:
                        yield edges()
                    own, at = [], (head, one, other)
                own.append((doc, n, apart.values.to_numpy()))
        if len(own) > 1:
            yield edges()

    return tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, bins: int = BINS) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Words lie between ASCII white space, A-Z is lowered; a document's set holds its
    distinct runs of ``width`` words, or its whole sequence if shorter.  Documents are
    linked when ``100 * common >= percent * union`` on the full sets;
    ``component_id`` is the least number reachable.  A document without words (null
    text too) has an empty set and links with nothing.  Rows that repeat a number are each
    placed by their own text; equal rows give equal rows.  A null number links with
    nothing, its component is null and it is kept.  An empty table gives no rows.
    """
    found = stored(minhash(docs, percent, id_col, text_col, width, bins), "signatures")
    if not found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        return _of_rows(docs, percent, id_col, text_col, width, bins)
    named = found.where("doc_id IS NOT NULL AND n_shingles > 0")
    key = ["n_shingles", "set_a", "set_b"]
    classes = stored(named.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    firsts = named.join(classes.where("copies > 1").withColumnRenamed("rep", "first"), key, "left")
    reps = firsts.where("first IS NULL OR first = doc_id").select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), F.explode("buckets").alias("bucket"))
    members = stars(reps)

    used = members.select(F.col("doc").alias("doc_id")).distinct()
    # The list of numbers grows with the documents: it is dealt out, never sent whole.
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = given.join(used.hint("merge"), "doc_id", "left_semi")
    sets = stored(shingle_sets(texts, "doc_id", "text", width), "sets")

    sizes = members.selectExpr("doc AS a", "n AS n_a").distinct()
    edges = members.where("doc <> head").selectExpr("head AS a", "doc AS b", "n AS n_b").distinct().join(sizes, "a")
    facts = stored(compared(edges, sets), "facts")
    links = linked(facts, percent)
    labels = components(links)

    family = families(members, facts, labels)
    for turn in range(PIVOT_ROUNDS + 1):
        rows = stored(with_components(family, labels), "rows")
        if rows.isEmpty():
            break
        if turn < PIVOT_ROUNDS:
            more = stored(linked(compared(pivot_pairs(rows, percent, turn), sets), percent), "links")
        else:
            more = stored(tile_links(open_members(rows, sets, percent), percent), "links")
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(links)

    own = found.join(classes.where("copies > 1").select(*key, "rep"), key, "left")
    rep = F.when(F.col("n_shingles") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id"))
    ids = own.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), rep).alias("rep"))
    roots = labels.withColumnRenamed("doc_id", "rep")
    return ids.join(roots, "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "rep").alias("component_id")
    ).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _rows_told_apart(docs: DataFrame, columns: list, name: str) -> DataFrame:
    """The rows with a number for each, as a stored table."""
    return stored(docs.select(*columns, F.monotonically_increasing_id().alias(name)), "rows")


def _of_rows(docs: DataFrame, percent: int, id_col: str, text_col: str, width: int, bins: int) -> DataFrame:
    """As ``near_duplicates`` where numbers repeat: each row is a document of its own."""
    rows = _rows_told_apart(docs, [F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")], "row")
    named = rows.where("doc_id IS NOT NULL")
    found = stored(near_duplicates(named, percent, "row", "text", width, bins), "found").select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("group"))
    own = named.select("row", "doc_id").join(found, "row")
    least = own.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    out = own.join(least, "group").select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    bare = near_duplicates(rows.where("doc_id IS NULL"), percent, "doc_id", "text", width, bins)
    return out.unionByName(bare)


def keep_one_of_group(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the least number of their group, all columns as given.

    Of rows that repeat the least number of a group one stays, any one of them.  Null, empty
    and wordless texts are in no group and stay, as do rows without a number.  An empty
    table gives no rows; other columns, whatever their names, pass through.
    """
    given, gone_col = F.col(f"`{id_col}`").cast("long"), fresh(docs, "_gone")
    if docs.where(given.isNotNull()).groupBy(given.alias("n")).count().where("count > 1").isEmpty():
        found = near_duplicates(docs, percent, id_col, text_col)
        gone = found.where("NOT kept").select(F.col("doc_id").alias(gone_col))
        return docs.join(gone, given == F.col(gone_col), "left_anti")
    row = fresh(docs, "_row_number")
    rows = _rows_told_apart(docs, [F.col(f"`{c}`") for c in docs.columns], row)
    found = near_duplicates(rows.where(given.isNotNull()), percent, row, text_col).select(F.col("doc_id").alias(gone_col), "component_id")
    own = rows.select(F.col(row).alias(gone_col), given.alias("number")).join(stored(found, "found"), gone_col)
    best = own.groupBy("component_id").agg(F.min(F.struct("number", gone_col))[gone_col].alias("stays"))
    gone = own.join(best, "component_id").where(F.col(gone_col) != F.col("stays")).select(gone_col)
    return rows.join(gone, F.col(row) == F.col(gone_col), "left_anti").drop(row)
