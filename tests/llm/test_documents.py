"""Each text operator on awkward rows, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from evidencepanel.llm import exact_dedup, near_dedup, packing, pieces, pii, pseudo_likelihood, quality, subwords, token_output


def low(text):
    return (text or "").encode().lower()


def texts_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


# ------------------------------------------------------------------- exact copies
def test_exact_duplicates(docs, nothing):
    rows = docs.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[low(r.text)].append(r.doc_id)
    want = []
    for r in rows:
        ids = groups[low(r.text)]
        keep = max((i for i in ids if i is not None), default=None)
        want.append((r.doc_id, keep, len(ids), r.doc_id == keep, hashlib.sha256(low(r.text)).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_duplicates(nothing).count() == 0


def test_keep_one_copy(docs, nothing):
    kept = exact_dedup.keep_one_copy(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([2, 4, 5, 6, 7, 8, 9, 10, 11, None, 12], key=repr)
    assert exact_dedup.keep_one_copy(nothing).count() == 0


def test_fingerprints_combine():
    random.seed(3)
    tables = [exact_dedup.powers(b, p, exact_dedup.CHUNK_WORDS) for b, p in zip(exact_dedup.BASES, exact_dedup.PRIMES)]
    for n in (0, 1, 2, 3, 65535, 65536, 65537, 200_001):
        data = random.randbytes(n)
        padded = data + b"\0" * (n % 2)
        want = 0
        for base, prime in zip(exact_dedup.BASES, exact_dedup.PRIMES):
            value = 0
            for i in range(0, len(padded), 2):
                value = (value * base + int.from_bytes(padded[i : i + 2], "little")) % prime
            want = want << 31 | value
        assert exact_dedup.text_fingerprint(data, tables) == want


def test_equal_fingerprints_of_different_texts_are_told_apart(spark, monkeypatch):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["aa", "bb", "AA", "ab", "bb"])], "doc_id long, text string")
    true = exact_dedup.fingerprints
    monkeypatch.setattr(exact_dedup, "fingerprints", lambda *a: true(*a).selectExpr("doc_id", "n_bytes", "0L AS fingerprint", "text_sha256"))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(rows).collect()}
    assert got == {0: (2, 2, False), 2: (2, 2, True), 1: (4, 2, False), 4: (4, 2, True), 3: (3, 1, True)}


# -------------------------------------------------------------------- near copies
def shingles(text):
    words = low(text).split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows, percent):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            common = len(sets[i] & sets[j])
            if i < j and common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited_copies(seed, bases, copies, words):
    """Bases with copies of every degree of change, and copies of copies."""
    random.seed(seed)
    rows = []
    for _ in range(bases):
        base = [f"w{random.randrange(4000)}" for _ in range(random.randrange(5, words))]
        family = [base]
        for _ in range(copies):
            copy = list(random.choice(family))
            for _ in range(random.randrange(0, 4)):
                copy[random.randrange(len(copy))] = f"n{random.randrange(10**6)}"
            if random.random() < 0.3:
                copy = copy[random.randrange(0, 3) :]
            family.append(copy)
        rows += [" ".join(f) for f in family]
    random.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_lose_no_link(spark, percent):
    rows = edited_copies(percent, 12, 25, 160)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()
    want = brute_components(rows, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


FAMILIES = ["cut", "cut and edited", "line added", "part of a line added"]


def one_family(kind, copies, seed=4):
    """Copies of one text that differ by more than replaced words."""
    random.seed(seed)
    base = [f"w{random.randrange(4000)}" for _ in range(200)]
    line = [f"l{i}" for i in range(60)]
    out = [base]
    for _ in range(copies - 1):
        copy = list(base)
        if kind.startswith("cut"):
            copy = copy[: random.randint(100, 200)]
        if kind != "cut":
            for _ in range(random.randint(0, 8)):
                copy[random.randrange(len(copy))] = f"n{random.randrange(10**6)}"
        if kind == "line added" and random.random() < 0.5:
            copy += line
        if kind == "part of a line added":
            copy += line[: random.randint(0, 60)]
        out.append(copy)
    return list(enumerate(" ".join(c) for c in out))


@pytest.mark.parametrize("kind", FAMILIES)
def test_near_duplicates_of_families(spark, monkeypatch, kind):
    edges = []
    true = near_dedup.tile_links
    monkeypatch.setattr(near_dedup, "TILE", 64)
    monkeypatch.setattr(near_dedup, "tile_links", lambda *a: edges.append(near_dedup.stored(true(*a), "counted")) or edges[-1])
    rows = one_family(kind, 250)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 80)
    assert sum(e.count() for e in edges) < 10 * len(rows)  # edges of tiles, never the pairs


def thue_morse(letter, other, turns=11):
    out = letter
    for _ in range(turns):
        out += out.translate(str.maketrans(letter + other, other + letter))
    return out


def test_words_made_to_collide_are_told_apart(spark):
    one, two = thue_morse("a", "b"), thue_morse("b", "a")
    pair = [one, two]
    rows = spark.createDataFrame([(1, " ".join([one] * 6)), (2, " ".join([two] * 6))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(rows, 80).collect()} == {1: 1, 2: 2}
    found = subwords.ByteLevelTokenizer(subwords.vocabulary_path("byte_bpe_50k.json")).encode([t.encode() for t in pair])
    assert [ids.tolist() + [1] for ids in found] == [byte_level_ids(t) for t in pair]
    model = pieces.PieceModel(subwords.vocabulary_path("piece_bpe_32k.model"))
    assert [back.decode() for _, back in pieces.encode_texts(model, [t.encode() for t in pair])] == pair


def test_remembered_words_are_bounded():
    tokenizer = subwords.ByteLevelTokenizer(subwords.vocabulary_path("byte_bpe_50k.json"))
    tokenizer.cache.size = 20_000
    texts = [f"start{i} " + f"x{i}" * 300 for i in range(60)]
    for text in texts + texts:
        assert tokenizer.encode([text.encode()])[0].tolist() + [1] == byte_level_ids(text)
        assert tokenizer.cache.taken < 20_000 + 6 * len(text) + 1000


@pytest.mark.parametrize("name", ["_kept", "_digest", "_gone", "_row_number", "_doc", "_more", "_hash"])
def test_stages_take_clashing_names_and_repeated_numbers(spark, name):
    long = " ".join(f"t{i}" for i in range(40))
    rows = [(5, "first text of five", 1), (5, "second text, me@mail.example", 2), (5, "second text, me@mail.example", 2), (7, "second text, me@mail.example", 3), (8, long, 4), (9, long + " more", 5), (9, "nine again", 6), (None, "no number", 7), (4, None, 8), (3, "", 9)]
    table = spark.createDataFrame(rows, f"doc_id long, text string, `{name}` int")
    one = exact_dedup.keep_one_copy(table)
    assert one.columns == table.columns
    assert sorted((r.doc_id, r.text) for r in one.collect() if r.doc_id) == sorted([(5, rows[0][1]), (7, rows[1][1]), (8, long), (9, long + " more"), (9, "nine again"), (4, None)], key=repr)
    near = near_dedup.keep_one_of_group(table)
    assert near.columns == table.columns
    want = [(5, rows[0][1]), (5, rows[1][1]), (8, long), (9, "nine again"), (None, "no number"), (4, None), (3, "")]
    assert sorted(((r.doc_id, r.text) for r in near.collect()), key=repr) == sorted(want, key=repr)
    blank = pii.redact(table)
    assert blank.columns == table.columns and blank.where("text LIKE '%[EMAIL]%'").count() == 3 and blank.count() == len(rows)


def test_near_duplicates_of_awkward_rows(docs, nothing):
    got = near_dedup.near_duplicates(docs, 80)
    want = brute_components([(i, t) for i, t in texts_of(docs)], 80)
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    kept = near_dedup.keep_one_of_group(docs, 80)
    assert kept.columns == docs.columns and kept.where("doc_id IN (2, 7, 9)").count() == 0
    assert near_dedup.near_duplicates(nothing).count() == 0 and near_dedup.keep_one_of_group(nothing).count() == 0


def test_banding_and_densification():
    for percent in (60, 80, 85, 95):
        rows, bands = near_dedup.banding(percent)
        assert rows * bands <= near_dedup.BINS and (1 - (percent / 100) ** rows) ** bands <= near_dedup.MISS
    one = near_dedup.signatures([np.array([5], np.uint64), np.zeros(0, np.uint64)])
    assert set(one[0].tolist()) == {5} and not one[1].any()


# ------------------------------------------------------------------------- tokens
def byte_level_ids(text):
    tokenizers = pytest.importorskip("tokenizers")
    tok = tokenizers.Tokenizer.from_file(subwords.vocabulary_path("byte_bpe_50k.json"))
    return tok.encode(text, add_special_tokens=False).ids + [1]


def strange_texts(n=400):
    random.seed(5)
    alphabet = "ab cde fgh  \n\t é中あ😀　 ﬁ▁12.,'s<>\x00́ñ​\x85\x1c "
    made = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 50))) for _ in range(n)]
    return made + ["", " ", "  ", "\n", "▁", "a" * 5000, "中文" * 1500, " " * 3000, "<s> </s> <unk> <|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|",  "don't we'll", "x \n y", "   b", "a  b"]


def test_byte_level_ids_equal_the_library():
    texts = strange_texts()
    found = subwords.ByteLevelTokenizer(subwords.vocabulary_path("byte_bpe_50k.json")).encode([t.encode() for t in texts])
    for text, ids in zip(texts, found):
        assert ids.tolist() + [1] == byte_level_ids(text), repr(text)


def test_piece_ids_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    path = subwords.vocabulary_path("piece_bpe_32k.model")
    library, texts = sentencepiece.SentencePieceProcessor(model_file=path), strange_texts()
    for text, (ids, back) in zip(texts, pieces.encode_texts(pieces.PieceModel(path), [t.encode() for t in texts])):
        want = [1, *library.encode(text), 2]
        assert ids.tolist() == want and back.decode() == library.decode(want), repr(text)


def test_piece_digests(docs, nothing):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=subwords.vocabulary_path("piece_bpe_32k.model"))
    want = []
    for i, text in texts_of(docs):
        ids = [1, *library.encode(text), 2]
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = [tuple(r) for r in pieces.piece_digests(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    full = {r.doc_id: r for r in pieces.piece_ids(docs).collect()}
    assert full[3].ids == [1, 2] and full[3].decoded == "" and full[1].decoded == "Hello World"
    assert pieces.piece_digests(nothing).count() == 0


def check_packing(rows, ids, window):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, found in by_doc.items():
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[doc])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[doc][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[doc])
    assert set(by_doc) == set(ids)
    padding = 0
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert 0 < at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding == 0 and sorted(by_sequence) == list(range(len(by_sequence)))


@pytest.mark.parametrize("window", [64, 2048])
def test_packing(docs, nothing, window):
    once = docs.dropDuplicates(["doc_id"])
    ids = {i: byte_level_ids(t) for i, t in texts_of(once)}
    check_packing(packing.packed_pieces(once, window).collect(), ids, window)
    assert packing.packed_pieces(docs, window).groupBy().sum("length").first()[0] == sum(len(byte_level_ids(t)) for _, t in texts_of(docs))
    assert packing.packed_pieces(nothing).count() == 0


def test_packed_matrices(docs, nothing):
    once = docs.dropDuplicates(["doc_id"])
    ids, found = {i: byte_level_ids(t) for i, t in texts_of(once)}, defaultdict(dict)
    for r in token_output.packed_matrices(once, 128).collect():
        row, places = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u2")
        assert len(row) == len(places) == 128 and r.cu_seqlens[-1] == r.n_tokens
        for a, b, doc, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.starts):
            found[doc][start] = row[a:b].tolist()
            assert places[a:b].tolist() == list(range(b - a))
    assert {d: sum((p[k] for k in sorted(p)), []) for d, p in found.items()} == ids
    assert token_output.packed_matrices(nothing).count() == 0
    with pytest.raises(ValueError):
        token_output.packed_matrices(docs, 70_000)


def test_best_fit_decreasing_against_a_plain_search():
    random.seed(9)
    for _ in range(60):
        window = random.choice([1, 7, 64, 100])
        sizes = np.array([random.randint(1, window) for _ in range(random.randint(0, 80))], np.int64)
        space = []
        for size in sorted(sizes.tolist(), reverse=True):
            fits = [s for s in space if s >= size]
            if fits:
                space.remove(min(fits))
                space.append(min(fits) - size)
            else:
                space.append(window - size)
        packed = token_output.best_fit_decreasing(sizes, window)
        assert sorted(window - int(sizes[p].sum()) for p in packed) == sorted(space)
        assert sorted(i for p in packed for i in p) == list(range(len(sizes)))


# -------------------------------------------------------------------- personal data
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in double) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_against_plain_patterns():
    random.seed(2)
    for n in range(20_000):
        text = "".join(random.choice("ab@.1-+ ()9%2é4") for _ in range(random.randint(0, 40)))
        text = re.sub("[abé]", "4", text) if n % 3 == 0 else text
        assert pii.base_spans(text) == brute_spans(text), repr(text)
    assert pii.base_spans("a" * 300_000 + "1" * 300_000 + "+" * 1000) == []


def test_personal_data(docs, nothing):
    rows = pii.personal_data(docs).collect()
    texts = dict(texts_of(docs))
    assert len(rows) == docs.count()
    for r in rows:
        spans = brute_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.spans == joined and r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in FORMS]
    assert pii.personal_data(nothing).count() == 0 and pii.redact(nothing).count() == 0
    new = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert new[11].text == "mail [EMAIL] and [PHONE] ip [IP] card [CARD]" and new[11].n_chars == len(new[11].text)
    assert new[3].text is None and new[1].text == "Hello World" and pii.redact(docs).columns == docs.columns


def test_contexts_find_identifiers_of_no_fixed_form(spark):
    random.seed(4)
    words = "alpha beta gamma delta eps zeta eta theta iota kappa".split()
    filler = lambda n: " ".join(random.choice(words) for _ in range(n))
    rows = []
    for i in range(60):
        middle = f"staff badge +1 555 {1000 + i} 77{i:02d} issued" if i < 20 else f"staff badge QX-{90000 + i} issued" if i < 25 else f"eta {80000 + i} beta"
        rows.append((i, f"{filler(20)} {middle} {filler(9)}"))
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        learned = [s for s in got[i].spans.split(",") if s]
        if 20 <= i < 25:
            start = text.index("QX-")
            assert learned == [f"phone:{start}:{start + 8}"] and got[i].n_phone == 0
        else:
            assert len(learned) == (1 if i < 20 else 0)


# ------------------------------------------------------------------ learned scores
def test_quality_separates_held_out_rows(spark):
    from pyspark.sql import functions as F

    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    good = [r.score for r in rows if r.held_out and r.quality == 1]
    poor = [r.score for r in rows if r.held_out and r.quality == 0]
    assert sum(g > p for g in good for p in poor) > 0.97 * len(good) * len(poor)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    # Names, languages and sources are no inputs.
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    again = quality.quality_scores(other, labels).where("held_out").agg(F.sum("score")).first()[0]
    assert abs(again - sum(r.score for r in quality.quality_scores(docs, labels).where("held_out").collect())) < 1e-6


def test_quality_of_awkward_rows(spark, docs, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = spark.createDataFrame([(1, 1), (5, 0), (6, 1), (None, 1), (7, None)], "doc_id long, quality int")
    for labels in (none, some):
        rows = quality.quality_scores(docs, labels).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.quality_scores(nothing, some).count() == 0 and quality.keep_good(nothing, none).count() == 0


def test_sum_of_squares_identity():
    random = np.random.default_rng(1)
    model = quality.FactorisationMachine(0.1, random.normal(size=9).astype(np.float32), random.normal(size=(9, 3)).astype(np.float32))
    rows = [(np.array([0, 3, 8]), np.array([1.0, 0.5, 2.0], np.float32)), (np.array([4]), np.array([1.0], np.float32))]
    for (where, value), got in zip(rows, model.scores(rows)):
        pairs = sum(float(model.factors[where[i]] @ model.factors[where[j]]) * value[i] * value[j] for i in range(len(where)) for j in range(i))
        assert abs(got - 1 / (1 + np.exp(-(0.1 + float(model.linear[where] @ value) + pairs)))) < 1e-5


def test_pseudo_likelihood(spark, docs, nothing):
    network = pseudo_likelihood.WindowNetwork(50)
    padded = np.array([50, 50, 3, 4, 5, 50, 50, 50], np.int32)
    total = 0.0
    for word in range(50):
        padded[3] = word
        total += float(np.exp(network.log_probability(padded, np.array([3])))[0])
    assert abs(total - 1) < 1e-4
    rows = {r.doc_id: r for r in pseudo_likelihood.pseudo_likelihood(docs, every=1).collect()}
    assert rows[3].n_tokens == rows[10].n_tokens == 0 and rows[3].log_likelihood == 0 and rows[3].perplexity is None
    assert rows[5].n_tokens == 60_000 and rows[5].log_likelihood < 0 and rows[1].log_likelihood == rows[2].log_likelihood
    assert pseudo_likelihood.pseudo_likelihood(nothing).count() == 0


def test_pseudo_likelihood_learns_both_sides(spark):
    random.seed(6)
    # The middle word follows from the words on both sides, from neither alone.
    line = lambda: (lambda a, b: f"l{a} m{(a + b) % 4} r{b}")(random.randrange(4), random.randrange(4))
    rows = [(i, " stop stop ".join(line() for _ in range(40))) for i in range(300)]
    got = pseudo_likelihood.pseudo_likelihood(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), rounds=2, every=1)
    mean = got.agg({"mean_log_likelihood": "avg"}).first()[0]
    assert mean > -1.2  # knowing only how often each word stands gives about -1.9


def test_a_training_step_follows_the_slope():
    def steps(network, room):
        random_ = np.random.default_rng(2)
        seen = [np.full_like(p, 1.0) for p in network.parameters()]
        batches = [(random_.integers(0, 51, (n, 4)).astype(np.int32), random_.integers(0, 50, n).astype(np.int32)) for n in (40, 25, 40)]
        return [network.train_batch(w, t, seen, 0.1, room) for w, t in batches], batches

    kept, new = pseudo_likelihood.WindowNetwork(50), pseudo_likelihood.WindowNetwork(50)
    room = {}
    (found, batches), (again, _) = steps(kept, room), steps(new, None)
    assert found == again and all((a == b).all() for a, b in zip(kept.parameters(), new.parameters()))
    assert max(a.shape[0] for name, a in room.items() if name != "spare") == 160  # work arrays are made once, for the largest batch

    # A step of Adagrad from squares of 1: slopes as small differences give them, in double precision.
    network, (window, target) = pseudo_likelihood.WindowNetwork(50), batches[0]
    before = [p.copy() for p in network.parameters()]
    padded = np.concatenate([np.r_[w[:2], t, w[2:]] for w, t in zip(window, target)]).astype(np.int32)
    places = np.arange(2, len(padded), 5)
    total = lambda: float(network.log_probability(padded, places).astype(np.float64).sum())
    first = total()
    network.train_batch(window, target, [np.full_like(p, 1.0) for p in before], 0.1)
    after = [p.copy() for p in network.parameters()]
    for k, at in ((0, (int(window[0, 0]), 3)), (1, (5, 7)), (2, (4,)), (3, (2, 1)), (4, (1,)), (5, (int(target[0]) // network.span, 3, int(target[0]) % network.span))):
        ends = []
        for by in (-0.01, 0.01):
            network.set_parameters([b.copy() for b in before])
            network.parameters()[k][at] += by
            ends.append(total())
        slope = -(ends[1] - ends[0]) / 0.02 / len(target) ** 0.5
        assert abs(before[k][at] - 0.1 * slope / (1 + slope * slope) ** 0.5 - after[k][at]) < 2e-4
    network.set_parameters(after)
    assert total() > first


def test_every_place_is_trained_on(spark, monkeypatch):
    texts = ["p q r"] * 3 + ["one"] + [" ".join(f"w{i % 7}" for i in range(n)) for n in (2, 15, 16, 17, 100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weights, mean = [], pseudo_likelihood.averaged

    def averaged(parts):
        weights.append(sum(r.weight for r in parts.collect()))
        return mean(parts)

    monkeypatch.setattr(pseudo_likelihood, "averaged", averaged)
    assert pseudo_likelihood.pseudo_likelihood(docs).count() == len(texts)
    assert sum(weights) == sum(len(t.split()) for t in texts)


def test_words_outside_the_vocabulary_have_their_share(spark):
    words = [("the", 300), ("often", 60), ("some", 12), ("once", 1)]
    texts = [w for w, n in words for _ in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pseudo_likelihood.pseudo_likelihood(docs, vocabulary_size=2).collect()
    score = {texts[r.doc_id]: r.log_likelihood for r in rows}
    assert len(rows) == len(texts) and abs(sum(np.exp(v) for v in score.values()) - 1) < 1e-4
    assert abs(score["often"] - score["some"] - np.log(5)) < 1e-6 and abs(score["often"] - score["once"] - np.log(60)) < 1e-6
    assert pseudo_likelihood.vocabulary_for(10**4) == 4096 < pseudo_likelihood.vocabulary_for(10**7) < pseudo_likelihood.vocabulary_for(10**9)


def test_few_words_outside_are_joined(spark, monkeypatch):
    texts = ["A b\x0bB\tc\x0c b\r\n", " \x1cb\x85 ÄA a\u00a0a ", "", None, "c rare a rare once", "b " * 70]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    words = [(t or "").encode().lower().split() for t in texts]
    counts = Counter(w.decode() for ws in words for w in ws)
    assert {r.word: r.n for r in pseudo_likelihood.word_counts(docs).collect()} == counts
    order = sorted(counts, key=lambda w: (-counts[w], w))
    for least, most in ((0, 0), (2, 2), (3, 5), (4, 4), (50, 50)):
        got = [r.word for r in pseudo_likelihood.commonest(pseudo_likelihood.word_counts(docs), least, most)]
        assert got == order[: len(got)] and min(least, len(order)) <= len(got) <= most
    # The two commonest have numbers, the next two shares; only others are left for the join.
    rows = {r.doc_id: r for r in pseudo_likelihood.word_ids(docs, order[:2], near=order[2:4], shares=[-0.5, -0.25]).collect()}
    for i, ws in enumerate(words):
        names = [w.decode() for w in ws]
        assert rows[i].n_tokens == len(ws)
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == [order.index(w) + 1 if w in order[:2] else 0 for w in names]
        assert rows[i].share == sum({order[2]: -0.5, order[3]: -0.25}.get(w, 0) for w in names)
        assert {o.word: o.times for o in rows[i].outside} == Counter(w for w in names if w not in order[:4])
    # Scores are the same whether shares come from the tasks or from the join.
    scores = []
    for name in ("NEAR", "LOOKED_UP"):
        monkeypatch.setattr(pseudo_likelihood, name, 0)
        scores.append({r.doc_id: r.log_likelihood for r in pseudo_likelihood.pseudo_likelihood(docs, vocabulary_size=2).collect()})
    assert scores[0] == pytest.approx(scores[1], rel=1e-6)  # training is in single precision


def test_probabilities_and_sums_in_single_precision():
    random_ = np.random.default_rng(4)
    for scale in (1, 30, 300, 3000):  # beyond 60 the largest of each row is taken off first
        x = (random_.normal(size=(50, 9)) * scale).astype(np.float32)
        column = random_.integers(0, 9, 50)
        exact = x.astype(np.float64) - x.max(axis=1, keepdims=True)
        exact -= np.log(np.exp(exact).sum(axis=1, keepdims=True))
        found, total = pseudo_likelihood.log_softmax_at(given := x.copy(), column)
        assert np.allclose(found, exact[np.arange(50), column], rtol=1e-5, atol=1e-4) and np.allclose(given / total[:, None], np.exp(exact), atol=1e-4)
    number = np.concatenate([np.zeros(300, np.int32), random_.integers(0, 40, 100).astype(np.int32)])
    random_.shuffle(number)
    rows = random_.normal(size=(400, 16)).astype(np.float32)
    at, sums = pseudo_likelihood.summed_by(number, rows)
    assert at.tolist() == sorted(set(number.tolist()))
    assert np.allclose(sums, [rows[number == k].astype(np.float64).sum(axis=0) for k in at], atol=1e-4)


def badge_texts(values):
    random.seed(5)
    words = "alpha beta gamma delta eps zeta eta theta iota kappa".split()
    filler = lambda n: " ".join(random.choice(words) for _ in range(n))
    return [f"{filler(20)} staff badge {v} issued {filler(9)}" for v in values]


def check_badges(spark, texts, first):
    got = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts)
    for r in got:
        start = texts[r.doc_id].find("QX-")
        assert r.doc_id < first or r.spans == f"email:{start}:{start + 8}"


def test_contexts_with_more_unseen_than_seed_values(spark):
    check_badges(spark, badge_texts([f"a{i}@b.example" for i in range(20)] + [f"QX-{90000 + i}" for i in range(30)]), 20)


def test_a_mass_copied_text_does_not_remove_a_pattern(spark):
    texts = badge_texts([f"a{i}@b.example" for i in range(20)] + ["QX-90000"])
    plain = "alpha beta staff badge lost again"
    check_badges(spark, texts[:20] + texts[20:] * 1000, 20)
    check_badges(spark, texts[:20] + [plain] * 1000 + texts[20:], 1020)


def test_found_identifiers_induce_patterns(spark):
    """Codes found beside seeds stand in a second context that no seed shares, where they name others."""
    random.seed(6)
    words = "alpha beta gamma delta eps zeta eta theta iota kappa".split()
    filler = lambda n: " ".join(random.choice(words) for _ in range(n))
    seeds = [f"staff badge a{i}@b.example issued" for i in range(30)]
    both = [f"staff badge QX-{90000 + i} issued" for i in range(12)]
    again = [f"locker card QX-{90000 + i} lost" for i in range(12)]
    unseen = [f"locker card QX-{91000 + i} lost" for i in range(4)]
    loose = [f"{random.choice(words)} {95000 + i} {random.choice(words)}" for i in range(40)]
    texts = [f"{filler(12)} {x} {filler(12)}" for x in seeds + both + again + unseen + loose]
    for r in pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        start = texts[r.doc_id].find("QX-")
        if 30 <= r.doc_id < 58:
            assert r.spans == f"email:{start}:{start + 8}", r
        else:
            assert r.spans.count(":") == (2 if r.doc_id < 30 else 0), r


def test_slots_of_random_strings_are_found_without_seeds(spark):
    rng = random.Random(7)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    slots = [f'set the token = "{key()}" before {i} starts' for i in range(12)]
    few = [f"see commit {key()} please" for _ in range(4)]  # too few of them to say
    counts = [f"a total of {100000 + i} rows" for i in range(50)]  # numbers, not random strings
    texts = slots + few + counts + ["nothing here", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    for i, text in enumerate(slots):
        start = text.index('"') + 1
        assert got[i] == f"token:{start}:{start + 40}"
    assert all(got[i] == "" for i in range(12, len(texts)))
    new = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert all(new[i] == f'set the token = "[TOKEN]" before {i} starts' for i in range(12))
    assert all(new[i] == texts[i] for i in range(12, len(texts)))
    assert all(s == "" for s in (r.spans for r in pii.personal_data(docs, trust=pii.Trust(slot_values=13)).collect()))


def test_identifiers_join_neighbouring_digits():
    def found(text):
        return [text[a:b] for _, a, b in pii.identifiers(text, pii.base_spans(text))]

    assert found("call (555) 123-4567 now") == ["(555) 123-4567"]
    assert found("or 020 7946 0958, 12 of them") == ["020 7946 0958"]
    assert found("card 4111 1111 1111 1112.") == ["4111 1111 1111 1112"]
    assert found("iban DE89 3704 0044 0532 0130 00 end") == ["DE89 3704 0044 0532 0130 00"]
    assert found("mail a@b and 12 34") == ["a@b"] and found("1 2\t3 4 5 6") == [] and found("") == []
    assert found("a@b.example 12345\n678901") == ["12345", "678901"]
    long = " ".join(str(100 + i) for i in range(50))
    assert found(long) == [] and found(f"{long} 12345") == ["12345"]
    assert pii.random_looking("04dbebab91ab85687d33eeaaf9ac699e1188f962") and pii.random_looking("123e4567-e89b-12d3-a456-426614174000")
    assert not any(map(pii.random_looking, ["2019-2020-annual-report", "12345678901234567890", "antidisestablishmentarianism", "", "short1a2b3c"]))


def test_counting_filter_is_exact_when_bits_are_shared(spark, docs, monkeypatch):
    """Whatever the filter's size, counts are those of the contexts asked for."""
    rows = docs.select("doc_id", "text")
    wanted = spark.createDataFrame(
        [(int(c),) for c in np.unique(pii.contexts_everywhere(rows.where("doc_id = 5").first().text.encode()))[::2]], "context long"
    )
    plain = {tuple(r) for r in pii.occurrences(rows, wanted).collect()}
    monkeypatch.setattr(pii, "FILTER_BITS", 7)
    assert {tuple(r) for r in pii.occurrences(rows, wanted).collect()} == plain and len(plain) == wanted.count()


def test_pieces_around_the_long_word_length():
    sentencepiece = pytest.importorskip("sentencepiece")
    path = subwords.vocabulary_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    random.seed(8)
    texts = ["".join(random.choice("aetions中é1+/") for _ in range(n)) for n in range(pieces.LONG_WORD - 2, pieces.LONG_WORD + 3)]
    for text, (ids, back) in zip(texts, pieces.encode_texts(pieces.PieceModel(path), [t.encode() for t in texts])):
        assert ids.tolist() == [1, *library.encode(text), 2] and back.decode() == library.decode(ids.tolist()), len(text)
