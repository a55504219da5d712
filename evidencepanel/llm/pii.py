"""Personal data: fixed forms as seeds, and contexts learned from them.

Seeds are spans of four fixed forms.  The words around identifiers are contexts (two words
before; one before and one after).  A context must be selective to become a pattern: of all
places where its words occur in the corpus, a share is followed by an identifier, seed or
not.  Copies of a text count once on both sides.  The occurrences are counted in two
steps: each slice of text counts the contexts of its own identifiers, which bounds the total
from below and settles common word pairs; what is left is counted in one pass over all texts.

Selective contexts and the identifiers they stand beside form a graph, which Spark scores in
rounds.  In every round the identifiers known so far induce patterns: first the seeds, then
what the patterns of the rounds before found, so a context that no seed ever shared is
reached through found values.  A slot filled nearly always, and by many different
random-looking strings (keys, tokens), induces a pattern by itself.  Sure patterns name
identifiers of no fixed form.
"""

from __future__ import annotations

import hashlib
import re
import sys
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidencepanel.llm.common import batch_slices, fresh, id_and_text, mix64, span_hashes, stored, text_slices, words_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts inside a run of digits: the run before it was taken whole or failed whole.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
HOLDS = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
TRIM = "\"'()[]{}<>,;:.!?"

LEAST_DIGITS = 5
MOST_DIGITS = 34  # of neighbouring tokens taken as one identifier
FILTER_BITS = 26  # at most 8 MB of bits tell which contexts to count


@dataclass(frozen=True)
class Trust:
    """When a context becomes a pattern, and when a pattern names an identifier."""

    support: int = 5  # different known identifiers a pattern needs
    selective: float = 0.5  # least share of a context's places that an identifier follows
    sure: float = 0.8  # least score of patterns and identifiers that count as known
    rounds: int = 4
    slot_values: int = 10  # different random-looking strings that make a slot a pattern


TRUST = Trust()

FOUND = (
    "doc_id long, text_hash long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "base array<struct<kind:string,start:int,stop:int>>, "
    "candidates array<struct<start:int,stop:int,kind:string,opaque:boolean,value:long,contexts:array<long>>>, "
    "counts array<struct<context:long,n:long>>"
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        total += n if i % 2 == 0 else (n * 2 - 9 if n > 4 else n * 2)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, at sign and dotted domain, in linear time."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the fixed forms, by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def joined_spans(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def random_looking(token: str) -> bool:
    """At least 16 letters and digits, of both at least 5, that change places often."""
    plain = [c for c in token if c not in "-_+/="]
    digit = [c in "0123456789" for c in plain]
    if len(plain) < 16 or not all(c.isascii() and c.isalnum() for c in plain):
        return False
    return min(sum(digit), len(digit) - sum(digit)) >= 5 and sum(x != y for x, y in zip(digit, digit[1:])) >= 4


def identifiers(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """What looks like an identifier but has no fixed form: a token with an at sign, or several
    digits in one token or in neighbouring tokens that all hold some."""
    if not DIGIT.search(text) and "@" not in text:
        return []
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    out: list[tuple[str, int, int]] = []

    def add(a: int, b: int) -> None:
        token = text[a:b]
        a, b = a + len(token) - len(token.lstrip(TRIM)), b - (len(token) - len(token.rstrip(TRIM)))
        if a < b and text[a:b].count(")") > text[a:b].count("(") and text[a - 1 : a] == "(":
            a -= 1
        out.append(("", a, b)) if a < b else None

    def close(run: list[tuple[int, int, int]]) -> None:
        if len(run) > 1 and LEAST_DIGITS <= sum(n for _, _, n in run) <= MOST_DIGITS:
            add(run[0][0], run[-1][1])
        else:
            for a, b, n in run:
                if n >= LEAST_DIGITS:
                    add(a, b)

    run: list[tuple[int, int, int]] = []
    for m in TOKEN.finditer(text):
        token, (a, b) = m.group(), m.span()
        if not HOLDS.search(token):
            if run:
                close(run)
                run = []
            continue
        digits = sum(c in "0123456789" for c in token)
        i = bisect_left(starts, b)
        free = not any(x < b and y > a for x, y in taken[max(0, i - 2) : i])
        if not digits or not free or "@" in token or (run and text[run[-1][1] : a] != " "):
            close(run)
            run = []
        if free and "@" in token:
            add(a, b)
        elif free and digits:
            run.append((a, b, digits))
            if token[-1] in ",;:.!?":
                close(run)
                run = []
    close(run)
    return out


def around(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The context of a word before and a word after."""
    return mix64(before * np.uint64(3) + mix64(after))


def contexts_everywhere(raw: bytes) -> np.ndarray:
    """The contexts of every word of a text, as if it alone were a span."""
    joined, starts, ends = words_of(raw)
    if len(starts) < 3:
        return np.zeros(0, np.int64)
    single = span_hashes(joined, starts, ends)
    return np.concatenate([span_hashes(joined, starts[:-2], ends[1:-1]), around(single[:-2], single[2:])]).view(np.int64)


class Contexts:
    """The contexts of spans of one text."""

    def __init__(self, text: str) -> None:
        joined, starts, ends = words_of(text.encode())
        self.starts = [m.start() for m in TOKEN.finditer(text)]
        self.single = span_hashes(joined, starts, ends)
        self.pair = span_hashes(joined, starts[:-1], ends[1:])

    def of_span(self, start: int, stop: int) -> list[int]:
        """Two words before the span; the word before and the word after it."""
        first = bisect_left(self.starts, start + 1) - 1  # the token that holds the start
        after = bisect_left(self.starts, stop)
        out = []
        if first >= 2:
            out.append(self.pair[first - 2 : first - 1])
        if first >= 1 and after < len(self.starts):
            out.append(around(self.single[first - 1 : first], self.single[after : after + 1]))
        return [int(h.view(np.int64)[0]) for h in out]


def text_mark(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _count(known: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Which of the known contexts stand in a text, and how often."""
    contexts = contexts_everywhere(raw)
    at = np.minimum(np.searchsorted(known, contexts), len(known) - 1)
    which, times = np.unique(at[known[at] == contexts], return_counts=True)
    return known[which], times


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans, identifier-like tokens with their contexts, and counts of the slice's contexts."""

    def run(batches):
        for ids, texts in text_slices(batches):
            columns: list[list] = [[] for _ in range(10)]
            decoded = [t.decode() for t in texts]
            seen: set[int] = set()
            for doc, text, raw in zip(ids, decoded, texts, strict=True):
                base = base_spans(text)
                spans = base + identifiers(text, base)
                candidates = []
                if spans:
                    contexts = Contexts(text)
                    for kind, a, b in spans:
                        value = int.from_bytes(hashlib.blake2b(text[a:b].encode(), digest_size=8).digest(), "little", signed=True)
                        around = contexts.of_span(a, b)
                        opaque = not kind and random_looking(text[a:b])
                        candidates.append({"start": a, "stop": b, "kind": kind or None, "opaque": opaque, "value": value, "contexts": around})
                        seen.update(around)
                row = (
                    doc,
                    text_mark(raw),
                    *(sum(k == kind for k, _, _ in base) for kind in KINDS),
                    hashlib.sha256(joined_spans(base).encode()).hexdigest(),
                    [{"kind": k, "start": a, "stop": b} for k, a, b in base],
                    candidates,
                    [],
                )
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            if seen:
                known = np.array(sorted(seen), np.int64)
                first = {mark: i for i, mark in reversed(list(enumerate(columns[1])))}
                for i in first.values():
                    which, times = _count(known, texts[i])
                    columns[9][i] = [{"context": c, "n": n} for c, n in zip(which.tolist(), times.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, FOUND_TYPES, strict=True)], names=FOUND_NAMES)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, FOUND)


FOUND_NAMES = ["doc_id", "text_hash", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "candidates", "counts"]
FOUND_TYPES = [
    *[pa.int64()] * 6,
    pa.string(),
    pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])),
    pa.list_(
        pa.struct(
            [("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string()), ("opaque", pa.bool_()), ("value", pa.int64()), ("contexts", pa.list_(pa.int64()))]
        )
    ),
    pa.list_(pa.struct([("context", pa.int64()), ("n", pa.int64())])),
]


def occurrences(docs: DataFrame, contexts: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each of the contexts stands in all different texts, in one pass over them.

    A bit per context, in a filter of bounded size, tells tasks what to count.  Contexts that
    share a bit with another are counted too; a join with the contexts drops them, so more
    contexts than the filter can tell apart cost rows, never results or passes.
    """
    bits = 1 << min(FILTER_BITS, max(16, (64 * contexts.count()).bit_length()))
    place = contexts.select(F.pmod("context", F.lit(bits)).alias("p"))
    words = place.groupBy(F.floor(F.col("p") / 64).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")).toArrow()
    known = np.zeros(bits // 64, np.uint64)
    known[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    texts = id_and_text(docs.select(F.lit(0).alias("_id"), F.col(text_col).alias("_text")), "_id", "_text")

    def counted(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        met = contexts_everywhere(raw)
        at = met.view(np.uint64) & np.uint64(bits - 1)
        hit = (known[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        return np.unique(met[hit.astype(bool)], return_counts=True)

    def run(batches):
        for _, part in text_slices(batches):
            found = {text_mark(raw): raw for raw in part}
            counts = [counted(raw) for raw in found.values()]
            marks = np.repeat(np.array(list(found), np.int64), [len(which) for which, _ in counts])
            which, times = (np.concatenate(c).astype(np.int64) for c in zip(*counts, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(marks), pa.array(which), pa.array(times)], names=["text_hash", "context", "n"])

    near = texts.mapInArrow(run, "text_hash long, context long, n long")
    return once_a_text(near.join(contexts.select("context"), "context", "left_semi"))


def once_a_text(counts: DataFrame) -> DataFrame:
    """``context, n`` from counts by text, those of copies taken once."""
    return counts.groupBy("text_hash", "context").agg(F.max("n").alias("n")).groupBy("context").agg(F.sum("n").alias("n"))


def patterns_of(graph: DataFrame, scores: DataFrame, trust: Trust) -> DataFrame:
    """``context, trust, names``: the patterns that identifiers known so far induce, and slots of random-looking strings."""
    known = F.col("score") >= trust.sure
    folded = graph.join(scores, "value").groupBy("context").agg(
        F.count_if(known).alias("known"),
        F.count("*").alias("all"),
        F.count_if("opaque").alias("opaque"),
        F.max("slot").alias("slot"),
        F.sum("score").alias("sum"),
        F.mode(F.when(known, F.col("name")), deterministic=True).alias("names"),
    )
    size = F.col("all") + F.lit(0.5)
    induced = F.when(F.col("known") >= trust.support, F.col("sum") / size)
    slot = F.col("slot") & (F.col("opaque") >= trust.slot_values) & (F.col("opaque") >= trust.sure * F.col("all"))
    return folded.select(
        "context", F.greatest(induced, F.when(slot, F.col("opaque") / size)).alias("trust"), F.coalesce("names", F.lit("token")).alias("names")
    ).where("trust IS NOT NULL")


def learned_spans(docs: DataFrame, found: DataFrame, text_col: str = "text", trust: Trust = TRUST) -> DataFrame:
    """``doc_id, text_hash, kind, start, stop`` of identifiers that sure patterns name."""
    edges = found.select("doc_id", "text_hash", F.explode("candidates").alias("c")).select(
        "doc_id", "text_hash", "c.start", "c.stop", "c.kind", "c.opaque", "c.value", F.explode("c.contexts").alias("context")
    )
    # Copies of a text fold first, then each context and value, so that a hot context shrinks before they meet.
    places = edges.select("text_hash", "start", "kind", "opaque", "value", "context").distinct()
    values = places.groupBy("context", "value").agg(F.max("kind").alias("kind"), F.max("opaque").alias("opaque"), F.count("*").alias("times"))
    shared = values.groupBy("context").agg(F.count("*").alias("different"), F.sum("times").alias("hits")).where(F.col("different") >= trust.support)
    bound = once_a_text(found.select("text_hash", F.explode("counts").alias("c")).select("text_hash", "c.context", "c.n"))
    # Where no single word has the context (identifiers of several words), its places are the hits.
    places_of = F.coalesce("n", "hits")
    selective = F.col("hits") >= trust.selective * places_of
    able = stored(shared.join(bound, "context", "left").where(selective).select("context", "hits"), "contexts")
    empty = docs.sparkSession.createDataFrame([], "doc_id long, text_hash long, kind string, start int, stop int")
    if able.isEmpty():
        return empty
    exact = occurrences(docs, able, text_col)
    slot = (F.col("hits") >= trust.sure * places_of).alias("slot")
    patterns = stored(able.join(exact, "context", "left").where(selective).select("context", slot), "patterns")
    if patterns.isEmpty():
        return empty
    graph = stored(values.join(patterns, "context"), "graph")
    seed = F.max("kind")
    scores = graph.groupBy("value").agg(seed.alias("name"), F.when(seed.isNotNull(), 1.0).otherwise(0.0).alias("score"))
    for _ in range(trust.rounds):
        # A seed stays sure; another value is as sure as its patterns together make it, and named by the surest.
        told = graph.join(patterns_of(graph, scores, trust), "context", "left").groupBy("value").agg(
            seed.alias("seed"),
            F.coalesce(F.sum(F.log(F.lit(1.0000001) - F.col("trust"))), F.lit(0.0)).alias("doubt"),
            F.min(F.when(F.col("trust").isNotNull(), F.struct(-F.col("trust"), "names"))).getField("names").alias("surest"),
        )
        score = F.when(F.col("seed").isNotNull(), 1.0).otherwise(1.0 - F.exp("doubt"))
        scores = stored(told.select("value", F.coalesce("seed", "surest").alias("name"), score.alias("score")), "scores")
    sure = patterns_of(graph, scores, trust).where(F.col("trust") >= trust.sure)
    named = edges.where("kind IS NULL").drop("kind").join(sure, "context").join(scores.where(F.col("score") >= trust.sure).select("value"), "value")
    # Where patterns name different kinds, the surer one wins; ties go to the name.
    return named.groupBy("doc_id", "text_hash", "start", "stop").agg(
        F.min(F.struct(-F.col("trust"), F.col("names"))).getField("names").alias("kind")
    ).select("doc_id", "text_hash", "kind", "start", "stop")


def _by_document(spans: DataFrame) -> DataFrame:
    return spans.distinct().groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("more"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trust: Trust = TRUST) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row.

    Counts and digest are those of the fixed forms; ``spans`` lists these and the learned
    ones as ``kind:start:stop`` in code points, by kind in the order of ``KINDS`` (then
    ``token``: strings of slots that hold nothing else), then start.  Null text counts as empty: no spans.  Repeated rows give repeated results and
    count once as support.  A null number is carried through.  An empty table gives no
    rows; other columns are ignored.
    """
    found = stored(scan(docs, id_col, text_col), "spans")
    more = _by_document(learned_spans(docs, found, text_col, trust))
    same = [F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")), F.col("l.text_hash") == F.col("r.text_hash")]
    both = found.drop("candidates", "counts").alias("l").join(more.alias("r"), same, "left").select("l.*", "r.more")
    place = lambda s: F.struct(F.array_position(F.array(*map(F.lit, (*KINDS, "token"))), s["kind"]).alias("k"), s["start"].alias("a"), s["stop"].alias("b"), s["kind"].alias("name"))
    spans = F.array_sort(F.transform(F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:string,start:int,stop:int>>"))), place))
    text = F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["a"].cast("string"), s["b"].cast("string"))), ",")
    return both.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", text.alias("spans"))


def blanked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping spans fold into the first."""
    out, at = [], 0
    for start, stop, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", trust: Trust = TRUST) -> DataFrame:
    """All rows and columns, personal data in the text replaced by ``[KIND]``.

    ``length_col``, where there is one, gets the new length of changed texts.  A null
    text stays null, an empty one empty; texts of any length are searched whole.  Rows that
    repeat are each returned and blanked alike.  An empty table gives no rows.  Other
    columns, whatever their names, pass through.
    """
    found = stored(scan(docs, id_col, text_col), "spans")
    names, doc, more_col = docs.columns, fresh(docs, "_doc"), fresh(docs, "_more")
    more = _by_document(learned_spans(docs, found, text_col, trust)).withColumnRenamed("doc_id", doc)
    # Joined by number alone; the text hash picks the right row where a number repeats.
    mine = more.groupBy(doc).agg(F.collect_list(F.struct(F.col("text_hash").alias("_hash"), F.col("more").alias("_more"))).alias(more_col))
    wide = docs.join(mine, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(doc)), "left").select(*(F.col(f"`{n}`") for n in names), more_col)

    def run(batches):
        for batch in batch_slices(batches, text_col):
            texts, extra = batch.column(text_col).to_pylist(), batch.column(len(names)).to_pylist()
            new = []
            for text, given in zip(texts, extra, strict=True):
                if text is None:
                    new.append(None)
                    continue
                spans = base_spans(text)
                if given:
                    mark = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)
                    spans = spans + [(s["kind"], s["start"], s["stop"]) for g in given if g["_hash"] == mark for s in g["_more"]]
                new.append(blanked(text, spans) if spans else text)
            out = {n: batch.column(i) for i, n in enumerate(names)}
            out[text_col] = pa.array(new, batch.schema.field(text_col).type)
            if length_col in out:
                was = out[length_col].to_pylist()
                out[length_col] = pa.array([len(b) if b is not None and a != b else w for a, b, w in zip(texts, new, was, strict=True)], out[length_col].type)
            yield pa.RecordBatch.from_arrays(list(out.values()), names=names)

    return wide.mapInArrow(run, docs.schema)
