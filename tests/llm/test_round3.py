"""Anchor SimHash, centroid clustering and periodic runs against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import xxhash

from evidencepanel.llm import anchor_simhash, centroids, periodic_runs


def words(text):
    return (text or "").encode().split()


# ------------------------------------------------------------------ anchor SimHash
def brute_print(text):
    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=3):
    """Least number reachable per (number, fingerprint) row; equal prints are one node."""
    nodes = sorted(set(p for _, p in prints))
    root = {p: p for p in nodes}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for n, p in prints:
        if n is not None:
            least[find(p)] = min(least.get(find(p), n), n)
    return [least.get(find(p)) for _, p in prints]


def test_simhash_of_awkward_texts(docs, nothing):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [(n, brute_print(t)) for n, t in rows]
    want = [(n, f"{p:016x}", c) for (n, p), c in zip(prints, brute_components(prints))]
    got = [tuple(r) for r in anchor_simhash.simhash_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert anchor_simhash.simhash_duplicates(nothing).count() == 0


def test_simhash_blocks_of_a_long_text(monkeypatch):
    text = " ".join(f"w{i % 91}" for i in range(3000)).encode()
    whole = anchor_simhash.simhash(text)
    monkeypatch.setattr(anchor_simhash, "HASHED_AT_ONCE", 7)
    assert anchor_simhash.simhash(text) == whole


def test_anchors_miss_no_pair_and_have_the_stated_excess():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**64 - 1, 400, dtype=np.uint64, endpoint=True)
    row, anchor, excess = anchor_simhash.anchors_of(x)
    assert np.bincount(row).max() <= 139 and (excess == 0).sum() == len(x)
    near = set(zip(row[excess <= 1].tolist(), anchor[excess <= 1].tolist()))
    for k in (0, 1, 2, 3):
        y = x.copy()
        for i in range(len(y)):
            for bit in rng.choice(64, k, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(bit)
        r2, a2, _ = anchor_simhash.anchors_of(y)
        assert {r for r, _ in near & set(zip(r2.tolist(), a2.tolist()))} == set(range(len(x)))


def test_golay_code_covers_with_radius_three():
    table = anchor_simhash.Anchors(23)
    assert ((table.excess == 0).sum(1) == 1).all()
    own = table.offsets[np.arange(2048), table.excess.argmin(1)]
    assert np.bitwise_count(own).max() == 3
    assert (anchor_simhash.syndromes(own) == np.arange(2048)).all()


@pytest.mark.parametrize("tile", [2048, 7])
def test_simhash_components_of_dense_groups(spark, tile):
    random.seed(11)
    prints = set()
    for _ in range(6):
        base = random.getrandbits(64)
        for _ in range(60):
            p = base
            for _ in range(random.randint(0, 6)):
                p ^= 1 << random.randrange(64)
            prints.add(p)
    prints |= {random.getrandbits(64) for _ in range(300)} | {0, 1, 2**63, 2**64 - 1}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = anchor_simhash.links_of_anchors(spark.createDataFrame(signed, "fingerprint long"), tile=tile).collect()
    want = dict(zip(prints, brute_components([(p, p) for p in prints])))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for e in edges:
        a, b = (find(x % (1 << 64)) for x in e)
        root[max(a, b)] = min(a, b)
    assert {p: find(p) for p in prints} == want
    assert all(want[e.a % (1 << 64)] == want[e.b % (1 << 64)] for e in edges)


# ------------------------------------------------------------- centroid clustering
def plain_clusters(rows, k, rounds, size):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in start[:k]]
    if not middle:
        return []
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min(range(len(middle)), key=lambda j: (far(v, middle[j]), j))
    for _ in range(rounds):
        groups = [near(v) for _, v in kept]
        for j in range(len(middle)):
            own = [v for (_, v), g in zip(kept, groups) if g == j]
            if own:
                middle[j] = [sum(c) // len(own) for c in zip(*own)]
    groups = [near(v) for _, v in kept]
    sums = [sum(far(v, middle[j]) for (_, v), g in zip(kept, groups) if g == j) for j in range(len(middle))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return [(i, g, far(v, middle[g]), sums[g], sum(sums), names[g]) for (i, v), g in zip(kept, groups)]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 3, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, cluster int, block string, distance double")


def test_clusters_of_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=6) + 3 * (i % 5)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200, None), (201, []), (202, [1.0] * 5), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (204, [float("nan")] * 6), (205, [float("inf")] * 6)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (300, rows[0][1]), (301, rows[0][1])]
    for k, rounds in ((8, 6), (1, 1), (4, 0)):
        got = centroids.cluster_digests(vectors(spark, rows), k=k, rounds=rounds, size=6)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_clusters(rows, k, rounds, 6), key=repr)


def test_clusters_of_equal_and_few_vectors(spark):
    same = [(i, [0.5] * 6) for i in range(20)]
    few = [(1, [0.0] * 6), (2, [-9.25] * 6)]
    for rows in (same, few, [(None, [0.5] * 6)]):
        got = centroids.cluster_digests(vectors(spark, rows), rounds=2, size=6)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_clusters(rows, 8, 2, 6), key=repr)
    assert centroids.cluster_digests(vectors(spark, []), size=6).count() == 0


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32) * 30_000]) for i in range(60)]
    got = centroids.cluster_digests(vectors(spark, rows), k=3, rounds=4, size=6)
    assert sorted(map(tuple, got.collect())) == sorted(plain_clusters(rows, 3, 4, 6))
    with pytest.raises(Exception, match="a scaled component reaches"):
        centroids.cluster_digests(vectors(spark, [(1, [1e9] * 6)]), size=6).collect()


def test_bounds_spare_most_scans(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=6) * 0.2 + 4 * np.eye(6)[i % 6]).astype(np.float32).tolist()) for i in range(3000)]
    _, _, scanned = centroids.clustered(vectors(spark, rows), k=6, rounds=7, size=6)
    assert len(scanned) == 7 and scanned[0] == 3000 and scanned[-1] < 300


def test_shrink_bounds_every_point_and_stays_below_the_drift():
    rng = np.random.default_rng(1)
    below = 0
    for _ in range(300):
        centre, before, after = rng.normal(size=(3, 4)) * [[1], [3], [3]]
        after = before + 0.2 * (after - before)
        radius = rng.random() * 2
        points = rng.normal(size=(2000, 4))
        points = centre + points / np.linalg.norm(points, axis=1)[:, None] * radius * rng.random((2000, 1)) ** 0.25
        lost = np.linalg.norm(points - before, axis=1) - np.linalg.norm(points - after, axis=1)
        bound, drift = centroids.shrink(centre, radius, before, after), np.linalg.norm(after - before)
        assert lost.max() <= bound + 1e-12 and bound <= drift + 1e-12
        below += bound < 0.9 * drift
    assert below > 100


def test_rounds_exchange_no_vectors(spark):
    rows = [(i, [float(i), float(-i)]) for i in range(50)]
    out, _, _ = centroids.clustered(vectors(spark, rows), k=2, rounds=1, size=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Exchange" not in plan


# ------------------------------------------------------------------- periodic runs
def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            n = i - s + q
            if n >= max(6, 4 * q) and all(any(w[k] != w[k + p] for k in range(s, s + n - p)) for p in range(1, q)):
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, plant):
    w = words(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    head = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *head, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_random_words():
    random.seed(1)
    for _ in range(1500):
        texts = []
        for _ in range(random.randint(1, 4)):
            n, k = random.randint(0, 90), random.choice([1, 2, 3, 6])
            w = [b"%d" % random.randrange(k) for _ in range(n)]
            if n and random.random() < 0.6:
                a = random.randrange(n)
                p = 1 + (n - a) // random.randint(3, 10)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        assert periodic_runs.runs_of_texts(texts) == [brute_runs(w) for w in texts]


def test_run_digests(spark, docs, nothing):
    random.seed(6)
    line = "the quick brown fox jumps over it "
    texts = ["a " * 6, "a " * 5, "a b " * 4, "a b " * 3 + "a", line * 4, line * 3 + "the", None, "", "  ", "x " + line * 9 + "tail", "é é é é é é é"]
    texts += [" ".join(random.choice("abcd") for _ in range(random.randint(0, 120))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, texts[4]), (None, texts[4])]
    table = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, start int, period int, passage string")
    for plant in (False, True):
        got = [tuple(r) for r in periodic_runs.run_digests(table, plant=plant).collect()]
        assert sorted(got, key=repr) == sorted((brute_row(i, t, plant) for i, t in rows), key=repr)
    own = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 2000]
    small = docs.where("text IS NULL OR length(text) < 2000")
    assert sorted((tuple(r) for r in periodic_runs.run_digests(small).collect()), key=repr) == sorted((brute_row(i, t, False) for i, t in own), key=repr)
    assert periodic_runs.run_digests(nothing).count() == 0 and periodic_runs.periodic_runs(nothing).count() == 0


def test_run_rows_and_cut_texts(spark):
    table = spark.createDataFrame([(1, "go " + "a b c  " * 5 + "end"), (2, "plain  text"), (3, None)], "doc_id long, text string")
    assert [tuple(r) for r in periodic_runs.periodic_runs(table).collect()] == [(1, 1, 15, 3, "a b c")]
    assert sorted(map(tuple, periodic_runs.without_periods(table).collect())) == [(1, "go a b c end"), (2, "plain  text"), (3, "")]


def test_runs_of_a_very_long_text():
    w = [b"%d" % (i * i % 100_003) for i in range(150_000)]
    w[40_000:90_000] = (w[40_000:52_345] * 5)[:50_000]
    found = periodic_runs.runs_of_texts([w])[0]
    assert [r for r in found if r[2] == 12_345][0][0] <= 40_000 and max(r[1] for r in found) >= 50_000


def test_operators_on_given_tables(spark):
    from evidencepanel.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    prints = [(n, brute_print(t)) for n, t in rows]
    want = sorted((n, f"{p:016x}", c) for (n, p), c in zip(prints, brute_components(prints)))
    assert sorted(map(tuple, QUERIES["op11_anchor_simhash"](spark, folder).collect())) == want
    short = {n: t for n, t in rows if len(t or "") < 6000}
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, folder).collect()]
    assert len(got) == len(rows)
    assert sorted(r for r in got if r[0] in short) == sorted(brute_row(n, t, True) for n, t in short.items())
