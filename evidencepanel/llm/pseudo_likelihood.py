"""Masked pseudo-likelihood: every word predicted from the words on both its sides.

All words are counted over all documents.  The commonest, a number that grows with the
distinct words, have outputs of their own; every other word has its share of the counts
of all others: the commoner ones are looked up in the tasks, the rest is joined to the
documents in Spark.  A small window network reads the two
words before and the two after a masked place; a two-level softmax (class, word in
class) gives a proper distribution.  Training is data-parallel: in each round every
partition trains numpy parameters on its share of the windows of *all* its documents,
and the parameters are averaged in a tree.  The rounds share out the places of every
document, so that each place is a training target once.  A document's score is the sum of the
conditional log-probabilities of all its words.
"""

from __future__ import annotations

import io
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from evidencepanel.llm.common import batch_slices, id_and_text, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = 4096  # words with an output of their own, at least
GROWTH = 4.0  # and so many times the square root of the distinct words
NEAR = 4  # times as many words are looked up in the tasks; only rarer ones are joined
LOOKED_UP = 1 << 18  # and so many at least
OFFSETS = (-2, -1, 1, 2)
WIDTH, HIDDEN = 16, 32
ROUNDS = 2
EVERY = ROUNDS  # one place in so many is trained on, per document and round; as many rounds take all
BATCH = 2048
FAN_IN = 16
BYTES_AT_ONCE = 1 << 24  # text whose words are counted or looked up together
TOKENS_AT_ONCE = 1 << 17
ROWS_AT_ONCE = 1 << 11  # rows of an output layer worked on together, to stay in cache
CLASSES_AT_ONCE = 8  # neighbouring classes whose words are moved together, likewise
COMMON = 64  # rows of one number that are worth a product of their own
EXPONENT = 60.0  # powers of e up to this, and their sums, are far inside the range of floats


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, between ASCII white space, A-Z lowered; how many each text has."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    words, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    if not real.all():  # white space at the end of a text leaves an empty one
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[real], minlength=len(sizes))
        words = words.filter(pa.array(real))
    return words, sizes


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_and_text(docs, id_col, text_col).withColumn("text", F.col("text").cast("string"))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` over all documents; words lie between ASCII white space, A-Z lowered."""

    def run(batches):
        for batch in batch_slices(batches, "text", BYTES_AT_ONCE):
            found = pc.value_counts(words_in(batch.column(1))[0])
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "n"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def commonest(counts: DataFrame, least: int, most: int) -> list[Row]:
    """Rows of ``word, n`` from the commonest word down (ties by the word): ``least`` of them, if there
    are so many, and up to ``most`` where equal counts need not be parted for it.

    Only the numbers of words of each count are ordered in the driver, not the words themselves."""
    floor, found, below = None, 0, None
    for row in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toLocalIterator():
        if found + row.words > max(least, most):
            below = row.n
            break
        floor, found = row.n, found + row.words
    rows = [] if floor is None else sorted(counts.where(F.col("n") >= floor).collect(), key=lambda r: (-r.n, r.word))
    if found < least and below is not None:
        rows += counts.where(F.col("n") == below).orderBy("word").limit(least - found).collect()
    return rows


def word_ids(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text", near: list[str] | None = None, shares: list[float] | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids, share, outside``: 32-bit numbers of the words, 0 for words outside
    the vocabulary; the sum of the shares of those that are near it; the other words outside
    and how often each stands in the text."""
    known = pa.array([*vocabulary, *(near or [])], pa.string())
    size, given = len(vocabulary), np.concatenate([np.zeros(len(vocabulary) + 1), shares or []])

    def run(batches):
        for batch in batch_slices(batches, "text", BYTES_AT_ONCE):
            words, sizes = words_in(batch.column(1))
            numbers = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False) + 1
            text, rare, listed = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), numbers == 0, numbers > size
            share = np.bincount(text[listed], given[numbers[listed]], len(sizes))
            ids = np.where(listed, 0, numbers).astype("<u4")
            ends = np.cumsum(sizes)
            # Words outside, once a text: a text and a word are one number.
            coded = words.filter(pa.array(rare)).dictionary_encode()
            pair, times = np.unique(text[rare].astype(np.int64) * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            where, code = np.divmod(pair, len(coded.dictionary) + 1)
            pairs = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(code)), pa.array(times, pa.int64())], names=["word", "times"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes),
                    pa.array([ids[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)], pa.binary()),
                    pa.array(share, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(where, np.arange(len(sizes) + 1)), pa.int32()), pairs),
                ],
                names=["doc_id", "n_tokens", "ids", "share", "outside"],
            )

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary, share double, outside array<struct<word:string,times:long>>")


class WindowNetwork:
    """Embeddings of the window, one hidden layer, classes, words in classes."""

    NAMES = ("embedding", "inner", "inner_bias", "classes", "class_bias", "words", "word_bias")

    def __init__(self, size: int, seed: int = 11) -> None:
        random = np.random.default_rng(seed)
        self.size = size
        self.span = max(1, int(np.ceil(np.sqrt(size))))
        count = -(-size // self.span)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return random.normal(0, scale, shape).astype(np.float32)

        self.embedding = normal(size + 1, WIDTH, scale=0.1)  # the last row stands beyond the text
        self.inner = normal(len(OFFSETS) * WIDTH, HIDDEN, scale=(len(OFFSETS) * WIDTH) ** -0.5)
        self.inner_bias = np.zeros(HIDDEN, np.float32)
        # Biases are the last row of their weights, met by a 1 after the hidden values.
        self.class_rows = np.zeros((HIDDEN + 1, count), np.float32)
        self.class_rows[:HIDDEN] = normal(HIDDEN, count, scale=0.05)
        self.word_rows = np.zeros((count, HIDDEN + 1, self.span), np.float32)
        self.word_rows[:, :HIDDEN] = normal(count, HIDDEN, self.span, scale=0.05)
        self.word_bias[np.arange(count * self.span).reshape(count, self.span) >= size] = -1e9  # no such words

    classes = property(lambda self: self.class_rows[:HIDDEN])
    class_bias = property(lambda self: self.class_rows[HIDDEN])
    words = property(lambda self: self.word_rows[:, :HIDDEN])
    word_bias = property(lambda self: self.word_rows[:, HIDDEN])

    def parameters(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.NAMES]

    def set_parameters(self, values: list[np.ndarray]) -> None:
        for held, value in zip(self.parameters(), values, strict=True):
            held[...] = value

    def log_probability(self, padded: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Of the words at the places of a padded id array, each given its neighbours."""
        offsets = np.array(OFFSETS)
        group, slot = np.divmod(padded[places].astype(np.int64), self.span)
        hidden = np.empty((len(places), HIDDEN + 1), np.float32)
        hidden[:, HIDDEN] = 1
        out = np.empty(len(places), np.float32)
        some_rows = min(len(places), ROWS_AT_ONCE)
        shapes = (len(OFFSETS) * WIDTH, HIDDEN, HIDDEN + 1, self.class_rows.shape[1], self.span)
        near, total, chosen_rows, by_class, by_word = (np.empty((some_rows, k), np.float32) for k in shapes)
        for at in range(0, len(places), ROWS_AT_ONCE):
            here = places[at : at + ROWS_AT_ONCE]
            rows, n = slice(at, at + len(here)), len(here)
            np.take(self.embedding, padded[here[:, None] + offsets], axis=0, out=near[:n].reshape(n, len(OFFSETS), WIDTH), mode="clip")
            given = np.matmul(near[:n], self.inner, out=total[:n])
            given += self.inner_bias
            hidden[rows, :HIDDEN] = np.tanh(given, out=given)
            out[rows] = log_softmax_at(np.matmul(hidden[rows], self.class_rows, out=by_class[:n]), group[rows])[0]
        for which, chosen in by_group(group):
            for at in range(0, len(chosen), ROWS_AT_ONCE):
                some = chosen[at : at + ROWS_AT_ONCE]
                x = np.take(hidden, some, axis=0, out=chosen_rows[: len(some)], mode="clip")
                out[some] += log_softmax_at(np.matmul(x, self.word_rows[which], out=by_word[: len(some)]), slot[some])[0]
        return out

    def train_batch(self, window: np.ndarray, target: np.ndarray, seen: list[np.ndarray], rate: float, room: dict | None = None) -> float:
        """One Adagrad step; returns the summed log-probability before it.

        ``room`` keeps the work arrays from one step to the next."""
        room = {} if room is None else room
        n = len(target)

        def array(name: str, *shape: int, kind: type = np.float32) -> np.ndarray:
            if name not in room or len(room[name]) < shape[0]:
                room[name] = np.empty(shape, kind)
            return room[name][: shape[0]]

        group, slot = np.divmod(target, self.span)
        order = np.argsort(group.astype(np.uint16), kind="stable")
        group, slot, rows = group[order], slot[order], np.arange(n)
        near = window[order].ravel()
        x = np.take(self.embedding, near, axis=0, out=array("x", len(near), WIDTH), mode="clip").reshape(n, -1)
        given = np.matmul(x, self.inner, out=array("given", n, HIDDEN))
        given += self.inner_bias
        np.tanh(given, out=given)
        hidden, weighted = array("hidden", n, HIDDEN + 1), array("weighted", n, HIDDEN + 1)
        hidden[:, :HIDDEN] = given
        hidden[:, HIDDEN] = 1
        # Slopes are left in proportion to the probabilities: what they meet is divided by the sums instead.
        d_class = np.matmul(hidden, self.class_rows, out=array("classes", n, self.class_rows.shape[1]))
        log_class, sums = log_softmax_at(d_class, group)
        total = float(log_class.sum())
        d_class[rows, group] -= sums
        share = (n**-0.5 / sums)[:, None]
        d_class_rows = np.multiply(hidden, share, out=weighted).T @ d_class
        d_hidden = np.matmul(d_class, self.classes.T, out=array("d_hidden", n, HIDDEN))
        d_hidden *= share
        # Rows of one class lie together: a product each, all else over all rows at once.
        starts = starts_of(group)
        which, cut = group[starts], [*starts.tolist(), n]
        spans = [slice(a, b) for a, b in zip(cut, cut[1:])]
        d = array("d", n, self.span)
        parts = [(at, self.word_rows[w], d[at]) for w, at in zip(which.tolist(), spans, strict=True)]
        for at, weights, here in parts:
            np.dot(hidden[at], weights, out=here)
        log_word, sums = log_softmax_at(d, slot)
        total += float(log_word.sum())
        d[rows, slot] -= sums
        share = (n**-0.5 / sums)[:, None]
        np.multiply(hidden, share, out=weighted)
        back, d_word_bias = array("back", n, HIDDEN + 1), array("d_word_bias", *self.word_bias.shape)[: len(which)]
        d_words = array("d_words", CLASSES_AT_ONCE, HIDDEN + 1, self.span)

        def move(value: np.ndarray, square: np.ndarray, slope: np.ndarray) -> None:
            spare = array("spare", max(slope.size, d_words.size))[: slope.size].reshape(slope.shape)
            square += np.multiply(slope, slope, out=spare)
            slope *= rate
            slope /= np.sqrt(square, out=spare)
            value -= slope

        # Neighbouring classes move together, few enough to stay in cache.
        first = 0
        while first < len(which):
            last = first + 1
            while last < len(which) and last - first < CLASSES_AT_ONCE and which[last] == which[last - 1] + 1:
                last += 1
            for (at, weights, here), slope in zip(parts[first:last], d_words):
                np.dot(weighted[at].T, here, out=slope)
                np.dot(here, weights.T, out=back[at])
            slopes, at = d_words[: last - first], slice(which[first], which[last - 1] + 1)
            d_word_bias[first:last] = slopes[:, HIDDEN]
            move(self.words[at], seen[5][at], slopes[:, :HIDDEN])
            first = last
        back *= share
        d_hidden += back[:, :HIDDEN]
        slope = np.multiply(given, given, out=given)
        d_hidden *= np.subtract(1, slope, out=slope)
        d_x = np.matmul(d_hidden, self.inner.T, out=array("d_x", n, len(OFFSETS) * WIDTH)).reshape(-1, WIDTH)
        words_at, d_embedding = summed_by(near, d_x)
        # Rows that no place of the batch touches have no slope: the step leaves them as they are.
        for number, at, slope in ((0, words_at, d_embedding), (6, which, d_word_bias)):
            some, square = self.parameters()[number], seen[number]
            value, squares = some[at], square[at]
            move(value, squares, slope)
            some[at], square[at] = value, squares
        for number, slope in ((1, x.T @ d_hidden), (2, np.ones(n, np.float32) @ d_hidden), (3, d_class_rows[:HIDDEN]), (4, d_class_rows[HIDDEN])):
            move(self.parameters()[number], seen[number], slope)
        return total


def starts_of(run: np.ndarray) -> np.ndarray:
    """Where equal neighbours begin."""
    first = np.empty(len(run), bool)
    first[:1] = True
    np.not_equal(run[1:], run[:-1], out=first[1:])
    return np.flatnonzero(first)


def summed_by(number: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that occur, and the sum of the rows of each; those of common numbers by a product."""
    order = np.argsort(number.astype(np.min_scalar_type(int(number.max()))), kind="stable")  # short numbers sort faster
    run = number[order]
    starts = starts_of(run)
    sizes = np.diff(starts, append=len(run))
    common = sizes >= COMMON
    found, rare = run[starts], ~common
    out = np.empty((len(found), rows.shape[1]), np.float32)
    if rare.any():
        # Two floats are added at once as one complex number.
        rows_of_rare = np.take(rows.view(np.complex64), order[np.repeat(rare, sizes)], axis=0)
        out[rare] = np.add.reduceat(rows_of_rare, np.cumsum(sizes[rare]) - sizes[rare], axis=0).view(np.float32)
    for k in np.flatnonzero(common).tolist():
        at, n = int(starts[k]), int(sizes[k])
        np.dot(np.ones(n, np.float32), np.take(rows, order[at : at + n], axis=0), out=out[k])
    return found, out


def log_softmax_at(x: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of one column of every row; ``x`` becomes what is in proportion to all
    probabilities, and the second result its sums."""
    chosen = x[np.arange(len(x)), column]
    if x.max() > EXPONENT or chosen.min() < -EXPONENT:  # else no power and no sum leaves the range of floats
        most = x.max(axis=1)
        x -= most[:, None]
        chosen -= most
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    return chosen - np.log(total), total


def by_group(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places of every group number that occurs."""
    order = np.argsort(group.astype(np.uint16), kind="stable")  # classes are few: the root of the words
    cut = starts_of(group[order])
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(order)], strict=True):
        yield int(group[order[a]]), order[a:b]


def padded_ids(texts: list[bytes], beyond: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids with two marks between documents; where each document starts, and lengths."""
    ids = [np.frombuffer(t, "<u4") for t in texts]
    sizes = np.array([len(i) for i in ids], np.int64)
    starts = np.cumsum(sizes + 2) - sizes
    out = np.full(int(sizes.sum()) + 2 * len(ids) + 2, beyond, np.int32)
    for at, part in zip(starts.tolist(), ids, strict=True):
        out[at : at + len(part)] = part
    return out, starts, sizes


def _pack(values: list[np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, *values)
    return out.getvalue()


def _unpack(data: bytes) -> list[np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return [found[k] for k in found.files]


def averaged(parts: DataFrame) -> list[np.ndarray] | None:
    """The mean of ``weight, data`` rows, summed in a tree of bounded fan-in."""

    def run(batches):
        total, weight = None, 0.0
        for batch in batches:
            for w, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = _unpack(data.as_py())
                total = [v * w for v in values] if total is None else [t + v * w for t, v in zip(total, values, strict=True)]
                weight += w
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([_pack([t / weight for t in total])], pa.binary())], names=["weight", "data"])

    left = parts.count()
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        parts = stored(parts.repartition(left).mapInArrow(run, "weight double, data binary"), "means")
    rows = [(r.weight, _unpack(bytes(r.data))) for r in parts.collect()]  # at most FAN_IN models
    if not rows:
        return None
    weight = sum(w for w, _ in rows)
    return [sum(v[k] * (w / weight) for w, v in rows).astype(np.float32) for k in range(len(rows[0][1]))]


def train(ids: DataFrame, size: int, rounds: int = ROUNDS, every: int = EVERY, rate: float = 0.1) -> WindowNetwork:
    """A network trained on one place in ``every`` of every document and round.

    Rounds start at different places: ``every`` rounds take each place of each document,
    however short, once."""
    network = WindowNetwork(size)
    for number in range(rounds):
        given = network.parameters()

        def run(batches, number=number, given=given):
            local = WindowNetwork(size)
            local.set_parameters([g.copy() for g in given])
            seen = [np.full_like(p, 1.0) for p in local.parameters()]
            held_windows, held_targets, held, weight, room = [], [], 0, 0, {}

            def step(last: bool) -> int:
                windows, targets = np.concatenate(held_windows), np.concatenate(held_targets)
                done = 0
                while len(targets) - done >= (1 if last else BATCH):
                    local.train_batch(windows[done : done + BATCH], targets[done : done + BATCH], seen, rate, room)
                    done = min(len(targets), done + BATCH)
                held_windows[:], held_targets[:] = [windows[done:]], [targets[done:]]
                return len(targets) - done

            for batch in batches:
                docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                padded, starts, sizes = padded_ids(texts, size)
                first = [(hash_number(d) + number) % every for d in docs]
                places = np.concatenate([np.arange(s + f, s + n, every) for s, f, n in zip(starts.tolist(), first, sizes.tolist(), strict=True)])
                for at in range(0, len(places), TOKENS_AT_ONCE):
                    some = places[at : at + TOKENS_AT_ONCE]
                    held_windows.append(np.stack([padded[some + o] for o in OFFSETS], axis=1))
                    held_targets.append(padded[some])
                    held += len(some)
                    weight += len(some)
                    if held >= BATCH:
                        held = step(False)
            if held:
                step(True)
            if weight:
                yield pa.RecordBatch.from_arrays([pa.array([float(weight)]), pa.array([_pack(local.parameters())], pa.binary())], names=["weight", "data"])

        found = averaged(stored(ids.select("doc_id", "ids").mapInArrow(run, "weight double, data binary"), "models"))
        if found is not None:
            network.set_parameters(found)
    return network


def hash_number(x: int | None) -> int:
    """A fixed scrambling of a document number."""
    return ((x or 0) * 0x9E3779B1 & 0xFFFFFFFF) >> 7


def vocabulary_for(distinct: int) -> int:
    """How many outputs a corpus of so many distinct words gets."""
    return max(VOCABULARY, math.ceil(GROWTH * math.sqrt(distinct)))


def pseudo_likelihood(
    docs: DataFrame, vocabulary_size: int | None = None, rounds: int = ROUNDS, every: int = EVERY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, mean_log_likelihood, perplexity`` of every row.

    The ``vocabulary_size - 1`` commonest words (ties by the word) have an output of their
    own; by default their number grows with the distinct words (``vocabulary_for``).  All
    others share one, and each has the part of it that its count is of all their counts.
    Null and empty texts have no tokens, a sum of 0 and no mean.  Repeated rows are scored
    alike; a null number is carried through.  An empty table gives no rows; other columns
    are ignored.
    """
    counts = stored(word_counts(docs, id_col, text_col), "words")
    if vocabulary_size is None:
        vocabulary_size = vocabulary_for(counts.count())
    if vocabulary_size < 2:
        raise ValueError("a vocabulary has 2 words at least")
    rows = commonest(counts, vocabulary_size - 1, max(LOOKED_UP, NEAR * vocabulary_size))
    top, near = [r.word for r in rows[: vocabulary_size - 1]], rows[vocabulary_size - 1 :]
    least = rows[-1] if rows else None
    others = counts.where((F.col("n") < least.n) | ((F.col("n") == least.n) & (F.col("word") > least.word))) if rows else counts
    outside = sum(r.n for r in near) + (others.agg(F.sum("n")).first()[0] or 0) or 1
    # The commonest words outside go with the vocabulary, so that few are left for the join.
    found = word_ids(docs, top, id_col, text_col, [r.word for r in near], [math.log(r.n / outside) for r in near])
    ids = stored(found.withColumn("row", F.monotonically_increasing_id()), "word-ids")
    network = train(ids, len(top) + 1, rounds, every)

    def run(batches):
        for batch in batches:
            docs_in, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            padded, starts, sizes = padded_ids(texts, network.size)
            inside = np.flatnonzero(padded != network.size)
            value = np.zeros(len(padded))
            for at in range(0, len(inside), TOKENS_AT_ONCE):
                some = inside[at : at + TOKENS_AT_ONCE]
                value[some] = network.log_probability(padded, some)
            sums = np.array([value[s : s + n].sum() for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)], np.float64)
            sums += batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(docs_in, pa.int64()), pa.array(sizes), pa.array(sums), batch.column(2)], names=["doc_id", "n_tokens", "log_likelihood", "row"])

    scored = ids.select("doc_id", "ids", "row", "share").mapInArrow(run, "doc_id long, n_tokens long, log_likelihood double, row long")
    # Rows of a text and of its outside words meet in one sum, by the row's own number.
    rare = ids.select("row", F.explode("outside").alias("o")).select("row", "o.word", "o.times").join(others, "word")
    shares = rare.select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_tokens"), (F.col("times") * F.log(F.col("n") / F.lit(outside))).alias("log_likelihood"), "row"
    )
    whole = scored.unionByName(shares).groupBy("row").agg(*(f(c).alias(c) for f, c in ((F.max, "doc_id"), (F.max, "n_tokens"), (F.sum, "log_likelihood"))))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return whole.select("doc_id", "n_tokens", "log_likelihood", mean.alias("mean_log_likelihood"), F.exp(-mean).alias("perplexity"))
