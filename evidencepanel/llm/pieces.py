"""SentencePiece encoding and decoding in vectorised merge rounds.

All distinct words of a batch lie in flat symbol arrays.  In a round every word finds
its best-ranked neighbouring pair (a segmented minimum), the leftmost such pair of each
word merges, merged symbols are compacted, and words without a pair leave.  One merge
per word and round is exactly the order of the sequential algorithm.
"""

from __future__ import annotations

import hashlib
import heapq
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from evidencepanel.llm.common import id_and_text, text_slices, worker_cache
from evidencepanel.llm.subwords import DistinctWords, WordCache, spread, vocabulary_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"
NO_RANK = np.int32(2**31 - 1)
LONG_WORD = 2048  # symbols; beyond, a heap merges one word in n log n
GROUP_BYTES = 4 << 20


class PieceModel:
    """The pieces of a BPE model with byte fallback, as lookup arrays."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.byte_id = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.size = size
        ids = {names[i]: i for i in plain}
        self.symbol = np.full(0x110000, -1, np.int32)
        for name, i in ids.items():
            if len(name) == 1:
                self.symbol[ord(name)] = i
        order = {score: rank for rank, score in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        pairs = {}
        for name, i in ids.items():
            for cut in range(1, len(name)):
                left, right = ids.get(name[:cut]), ids.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * size + right] = (order[model.get_score(i)], i)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        sort = np.argsort(keys)
        self.keys = keys[sort]
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)[sort]
        self.ranks, self.merged = values[:, 0].copy(), values[:, 1].copy()
        # What a piece writes when decoded: bytes pieces one byte, controls nothing.
        text = [b""] * size
        for i in plain:
            text[i] = names[i].replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_id.tolist()):
            text[i] = bytes([b])
        text[self.unknown] = " ⁇ ".encode()
        self.text_length = np.array([len(t) for t in text], np.int64)
        self.text_start = np.cumsum(self.text_length) - self.text_length
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.cache = WordCache(self.encode_words, np.int32)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of the pairs; no pair has the largest rank."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NO_RANK), np.where(hit, self.merged[at], -1)

    def merge_rounds(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols (negative ones untouched) and lengths of words in flat arrays."""
        done_words, done_symbols, done_lengths = [], [], []
        word = np.arange(len(lengths))
        rank = np.full(len(symbols), NO_RANK, np.int32)
        into = np.full(len(symbols), -1, np.int32)
        if len(symbols) > 1:
            rank[:-1], into[:-1] = self.look_up(symbols[:-1], symbols[1:])
        ends = np.cumsum(lengths)
        rank[ends - 1] = NO_RANK
        while len(lengths):
            starts = ends - lengths
            best = np.minimum.reduceat(rank, starts)
            going = best < NO_RANK
            if not going.all():
                over = np.repeat(~going, lengths)
                done_words.append(word[~going])
                done_lengths.append(lengths[~going])
                done_symbols.append(symbols[over])
                symbols, rank, into = symbols[~over], rank[~over], into[~over]
                word, lengths, best = word[going], lengths[going], best[going]
                ends = np.cumsum(lengths)
                starts = ends - lengths
                if not len(lengths):
                    break
            owner = np.repeat(np.arange(len(lengths)), lengths)
            at = np.flatnonzero(rank == best[owner])
            first = np.ones(len(at), bool)
            first[1:] = owner[at[1:]] != owner[at[:-1]]
            at = at[first]  # one place per word, in word order
            symbols[at] = into[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, rank, into = symbols[keep], rank[keep], into[keep]
            at = at - np.arange(len(at))
            lengths = lengths - 1
            ends = np.cumsum(lengths)
            starts = ends - lengths
            for place in (at, at - 1):
                inside = (place >= starts) & (place + 1 < ends)
                p = place[inside]
                rank[p], into[p] = self.look_up(symbols[p], symbols[p + 1])
                gone = place[(place >= starts) & (place + 1 >= ends)]
                rank[gone] = NO_RANK
        count = np.concatenate(done_lengths) if done_lengths else np.zeros(0, np.int64)
        flat = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int32)
        order = np.argsort(np.concatenate(done_words)) if done_words else np.zeros(0, np.int64)
        begin = np.cumsum(count) - count
        return flat[spread(begin[order], count[order])], count[order]

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The same merges for one very long word, by a heap of (rank, place)."""
        n = len(symbols)
        value = symbols.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks, into = self.look_up(symbols[:-1], symbols[1:])
        heap = [(int(r), i, value[i], value[i + 1], int(m)) for i, (r, m) in enumerate(zip(ranks, into, strict=True)) if r < NO_RANK]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if value[i] != left or j >= n or value[j] != right:
                continue
            value[i], value[j] = merged, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    r, m = self.look_up(np.array([value[a]]), np.array([value[b]]))
                    if r[0] < NO_RANK:
                        heapq.heappush(heap, (int(r[0]), a, value[a], value[b], int(m[0])))
        return np.array([v for v in value if v is not None], np.int32)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for words in which a space stands for the space symbol."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        joined = b"".join(words)
        data = np.frombuffer(joined, np.uint8)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        lengths = np.diff(chars[np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)])
        points = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32).copy()
        points[points == 32] = ord(SPACE)
        symbols = self.symbol[points]
        symbols = np.where(symbols < 0, -2 - points.astype(np.int32), symbols)  # unknown characters keep their code
        long = lengths > LONG_WORD
        if not long.any():
            flat, count = self.merge_rounds(symbols, lengths)
        else:
            ends = np.cumsum(lengths)
            parts: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
            short_flat, short_count = self.merge_rounds(symbols[np.repeat(~long, lengths)], lengths[~long])
            for i, part in zip(np.flatnonzero(~long), np.split(short_flat, np.cumsum(short_count)[:-1]), strict=False):
                parts[i] = part
            for i in np.flatnonzero(long):
                parts[i] = self.merge_long(symbols[ends[i] - lengths[i] : ends[i]])
            flat, count = np.concatenate(parts), np.array([len(p) for p in parts])
        if (flat < 0).any():
            flat, count = self._fall_back(flat, count)
        return flat, count

    def _fall_back(self, flat: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters as the pieces of their UTF-8 bytes."""
        strange = np.flatnonzero(flat < 0)
        points = (-2 - flat[strange]).astype("<u4")
        data = np.frombuffer(points.tobytes().decode("utf-32-le").encode(), np.uint8)
        width = np.ones(len(flat), np.int64)
        width[strange] = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        out = np.repeat(flat, width)
        out[out < 0] = self.byte_id[data]
        owner = np.repeat(np.arange(len(count)), count)
        return out, np.bincount(owner, weights=width, minlength=len(count)).astype(np.int64)

    def decode_words(self, flat: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes the ids of each word write, and their number; broken UTF-8 from byte
        pieces becomes replacement characters."""
        length = self.text_length[flat]
        out = self.text[spread(self.text_start[flat], length)]
        ends = np.cumsum(count)
        total = np.concatenate([[0], np.cumsum(length)])
        size = total[ends] - total[ends - count]
        if not len(count):
            return out, size
        try:
            out.tobytes().decode()
            return out, size
        except UnicodeDecodeError:
            edges = np.concatenate([[0], np.cumsum(size)]).tolist()
            fixed = [out[a:b].tobytes().decode(errors="replace").encode() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            return np.frombuffer(b"".join(fixed), np.uint8), np.array([len(f) for f in fixed], np.int64)


def piece_model(path: str) -> PieceModel:
    return worker_cache(f"pieces {path}", lambda: PieceModel(path))


def encode_texts(model: PieceModel, texts: list[bytes]) -> list[tuple[np.ndarray, bytes]]:
    """Ids with begin and end, and the text decoded from them."""
    # The model writes a space before the text; a literal space symbol is a space too.
    spaced = [b" " + t.replace(SPACE.encode(), b" ") if t else b"" for t in texts]
    found = DistinctWords(spaced, any_space=True)
    flat, starts, count = model.cache.values(found)
    ids = found.per_text(flat, starts, count)
    out, size = model.decode_words(flat[spread(starts, count)], count)
    written = found.per_text(out, np.cumsum(size) - size, size)
    frame = [np.array([i], np.int32) for i in (model.begin, model.end)]
    return [(np.concatenate([frame[0], i, frame[1]]), w.tobytes()[1:]) for i, w in zip(ids, written, strict=True)]


def text_groups(batches):
    """Numbers and texts in groups that share the work on distinct words."""
    return text_slices(batches, GROUP_BYTES)


def piece_ids(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: ids with begin and end of every whole text, and the text
    decoded from them.

    Exactly the ids of the model file; characters outside it fall back to bytes.  A null
    or empty text has only the begin and the end.  One row per input row, whatever
    repeats; an empty table gives no rows; other columns are ignored.
    """
    path = model_path or vocabulary_path("piece_bpe_32k.model")

    def run(batches):
        model = piece_model(path)
        for ids, texts in text_groups(batches):
            found = encode_texts(model, texts)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(i) for i, _ in found])]).astype(np.int32), pa.array(np.concatenate([i for i, _ in found])))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists, pa.array([d.decode() for _, d in found], pa.string())], names=["doc_id", "ids", "decoded"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def piece_digests(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the same work, without moving
    ids and texts out of the Python workers."""
    path = model_path or vocabulary_path("piece_bpe_32k.model")

    def run(batches):
        model = piece_model(path)
        for ids, texts in text_groups(batches):
            found = encode_texts(model, texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(i) for i, _ in found], pa.int64()),
                    pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i, _ in found], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for _, d in found], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
