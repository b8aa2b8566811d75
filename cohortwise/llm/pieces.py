"""SentencePiece encoding: the N best segmentations of a whole text, and decoding.

A piece lattice is scored forward by Viterbi; the scores of all prefixes are exact
heuristics for an A-star search that runs backward from the end and gives the
segmentations in order. Pieces start with a blank or hold none, so a text's
lattice falls apart before every run of blanks: words are searched one by one, and
the best combinations of a few words' segmentations are those of the text.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from cohortwise.llm.common import _power_tables, mix
from cohortwise.llm.spans import ragged

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 4
# Fixed value: the mark that pieces write for a blank.
MARK = "▁"
# Longer words are scored one at a time.
LONG_WORD = 48
# Text that is worked on at once, and words that a task remembers.
BLOCK_BYTES = 3_000_000
WORD_MEMORY = 400_000
# How far below the rarest piece a byte lies, in natural logarithms.
BYTE_PENALTY = 10.0
# Scores of one word's segmentations are compared in whole numbers of 1 / EXACT.
EXACT = 1 << 40


@dataclass
class PieceTable:
    """Pieces as bytes with their scores. Bytes are pieces, too, so every text has
    a segmentation and decodes to itself."""

    pieces: list[bytes]  # by id; empty for control pieces
    scores: np.ndarray
    byte_ids: np.ndarray  # id of the piece of each byte
    keys: np.ndarray = field(init=False)

    def __post_init__(self):
        bytewise = set(self.byte_ids.tolist())
        normal = [i for i, p in enumerate(self.pieces) if p and i not in bytewise]
        self.find = {self.pieces[i]: i for i in normal}
        self.byte_score = float(self.scores[normal].min() - BYTE_PENALTY) if normal else -BYTE_PENALTY
        self.scores = self.scores.copy()
        self.scores[self.byte_ids] = self.byte_score
        self.longest = max([1, *map(len, self.find)])
        hashes = np.array([piece_hash(self.pieces[i]) for i in normal], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.key_ids = hashes[order], np.array(normal, np.int64)[order]
        self.slots = np.zeros(1 << 18, bool)
        self.slots[(self.keys >> np.uint64(46)).astype(np.int64)] = True
        self.exact = {i: round(float(self.scores[i]) * EXACT) for i in normal}
        self.exact_byte = round(self.byte_score * EXACT)
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.pieces), np.uint8)
        inside = set(b"".join(self.find))
        self.alone = np.array([b not in inside for b in range(256)])  # bytes that only byte pieces hold

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Piece id of each hash, or -1."""
        out = np.full(len(hashes), -1)
        maybe = np.flatnonzero(self.slots[(hashes >> np.uint64(46)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == hashes[maybe]
        out[maybe[hit]] = self.key_ids[at[hit]]
        return out


def piece_hash(piece: bytes) -> int:
    data = np.frombuffer(piece, np.uint8) + np.uint64(1)
    power, _ = _power_tables(len(data) + 1)
    total = (data * power[: len(data)]).sum(dtype=np.uint64)
    return int(mix(np.array([total]) + np.uint64(len(data)))[0])


def load_pieces(path: str = MODEL) -> PieceTable:
    """The pieces of a model file. Scores of a model made by merging are ranks; by
    Zipf's law a piece of rank r has the log probability -ln(r + 2.7), up to a
    constant. Scores that are no ranks (unigram models) are kept."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces, scores, byte_ids = [], np.zeros(n), np.full(256, -1)
    for i in range(n):
        text, scores[i] = model.id_to_piece(i), model.get_score(i)
        if model.is_byte(i):
            byte_ids[int(text[3:5], 16)] = i
            pieces.append(bytes([int(text[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            pieces.append(b"")
        else:
            if MARK in text.lstrip(MARK):
                raise ValueError(f"piece {i} holds a blank inside a word")
            pieces.append(text.replace(MARK, " ").encode())
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces")
    plain = [i for i, p in enumerate(pieces) if p and i not in set(byte_ids.tolist())]
    if (scores[plain] == np.round(scores[plain])).all():
        scores = -np.log(np.clip(-scores, 0, n) + 2.7)
    return PieceTable(pieces, scores, byte_ids)


def edges_before(table: PieceTable, word: bytes, end: int) -> Iterator[tuple[int, int, float]]:
    """Pieces that end at a place of a word: start, id, score; the longest first."""
    for length in range(min(table.longest, end), 0, -1):
        i = table.find.get(word[end - length : end])
        if i is not None:
            yield end - length, i, float(table.scores[i])
    yield end - 1, int(table.byte_ids[word[end - 1]]), table.byte_score


def forward(table: PieceTable, word: bytes) -> tuple[list[float], list[tuple[int, int]], float]:
    """Best score of every prefix, the last piece (start, id) of each, and the
    second best score of the whole word."""
    best, last, second = [0.0], [(0, -1)], [-np.inf]
    for end in range(1, len(word) + 1):
        one, two, piece = -np.inf, -np.inf, (0, -1)
        for start, i, score in edges_before(table, word, end):
            for value in (best[start] + score, second[start] + score):
                if value > one:
                    one, two, piece = value, one, (start, i)
                elif value > two:
                    two = value
        best.append(one)
        second.append(two)
        last.append(piece)
    return best, last, second[-1]


def n_best(table: PieceTable, word: bytes, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best segmentations of a word, best first: A-star from the end, where the
    best score of the remaining prefix is the exact rest. Scores are whole numbers here
    (of 1 / EXACT), so that equal ones are equal; of those the path found first counts,
    longer last pieces before shorter ones.

    The queue holds, by what they lose against the best, paths' last pieces: the next
    choice for the same place, and the best one for the place reached. So it grows by
    two entries for each step. A path is its last piece and a link to what follows.
    """
    exact, byte = table.exact, table.exact_byte
    best = [0]
    for end in range(1, len(word) + 1):
        best.append(max(best[start] + exact.get(i, byte) for start, i, _ in edges_before(table, word, end)))
    if not word:
        return [(0.0, ())]

    def choices(end: int) -> list[tuple[int, int, int]]:
        found = [(best[end] - best[s] - exact.get(i, byte), s, i) for s, i, _ in edges_before(table, word, end)]
        return sorted(found, key=lambda c: c[0])

    follows, piece, out, order = [], [], [], 0
    heap = [(0, 0, len(word), 0, -1)]
    while heap and len(out) < n:
        lost, _, end, k, node = heapq.heappop(heap)
        options = choices(end)
        gap, start, i = options[k]
        if k + 1 < len(options):
            order -= 1
            heapq.heappush(heap, (lost - gap + options[k + 1][0], order, end, k + 1, node))
        follows.append(node)
        piece.append(i)
        node = len(piece) - 1
        if start:
            order -= 1
            heapq.heappush(heap, (lost, order, start, 0, node))
            continue
        path = []
        while node >= 0:
            path.append(piece[node])
            node = follows[node]
        out.append(((best[-1] - lost) / EXACT, tuple(path)))
    return out


def viterbi(table: PieceTable, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For many words at once: piece ids (one after the other), how many of each
    word, best and second best scores."""
    counts = np.zeros(len(words), np.int64)
    best, second = np.zeros(len(words)), np.full(len(words), -np.inf)
    found: list[np.ndarray | None] = [None] * len(words)
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        if length > LONG_WORD:
            for r in rows:
                prefix, last, second[r] = forward(table, words[r])
                best[r], end, ids = prefix[-1], length, []
                while end:
                    end, i = last[end]
                    ids.append(i)
                found[r] = np.array(ids[::-1], np.int32)
                counts[r] = len(ids)
            continue
        for a in range(0, len(rows), 50_000):
            part = rows[a : a + 50_000]
            _viterbi_equal(table, [words[r] for r in part], int(length), part, found, counts, best, second)
    return (np.concatenate(found) if found else np.zeros(0, np.int32)), counts, best, second


def _viterbi_equal(table, words, length, rows, found, counts, best, second) -> None:
    """The same for words of one length, place by place."""
    data = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)
    power, inverse = _power_tables(length + 1)
    sums = np.zeros((len(words), length + 1), np.uint64)
    np.cumsum((data + np.uint64(1)) * power[:length], axis=1, out=sums[:, 1:])
    one, two = np.full((length + 1, len(words)), -np.inf), np.full((length + 1, len(words)), -np.inf)
    one[0] = 0
    back, piece = np.zeros((length + 1, len(words)), np.int64), np.zeros((length + 1, len(words)), np.int32)
    for end in range(1, length + 1):
        for size in range(min(table.longest, end), -1, -1):  # 0: the byte itself
            if size:
                start = end - size
                ids = table.lookup(mix((sums[:, end] - sums[:, start]) * inverse[start] + np.uint64(size)))
                at = np.flatnonzero(ids >= 0)
                ids = ids[at]
            else:
                start, at, ids = end - 1, np.arange(len(words)), table.byte_ids[data[:, end - 1]]
            if not len(at):
                continue
            score = table.scores[ids]
            for value in (one[start, at] + score, two[start, at] + score):
                better = value > one[end, at]
                two[end, at] = np.where(better, one[end, at], np.maximum(two[end, at], value))
                won = at[better]
                one[end, won], back[end, won], piece[end, won] = value[better], start, ids[better]
    best[rows], second[rows] = one[length], two[length]
    ends, steps = np.full(len(words), length), []
    while ends.any():
        here = np.flatnonzero(ends)
        chosen = np.full(len(words), -1, np.int32)
        chosen[here] = piece[ends[here], here]
        steps.append(chosen)
        ends[here] = back[ends[here], here]
    grid = np.stack(steps[::-1], axis=1)
    used = grid >= 0
    counts[rows] = used.sum(axis=1)
    flat, stops = grid[used], np.cumsum(used.sum(axis=1))[:-1]
    for r, ids in zip(rows, np.split(flat, stops)):
        found[r] = ids


@dataclass
class Block:
    """Encoded texts: all ids, where each text's begin and end, the best scores, what the
    further segmentations change (word number and ids), and whether the ids return the
    text."""

    ids: np.ndarray
    stops: np.ndarray
    scores: list[list[float]]
    changes: list[list[list[tuple[int, tuple[int, ...]]]]]
    returns: np.ndarray

    def ids_of(self, i: int) -> np.ndarray:
        return self.ids[self.stops[i] : self.stops[i + 1]]


class Encoder:
    """Encodes blocks of texts and remembers words."""

    def __init__(self, table: PieceTable, best: int):
        self.table, self.best = table, best
        self.forget()

    def forget(self) -> None:
        self.keys, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.flat, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.scores, self.gaps = np.zeros(0), np.zeros(0)
        self.searched: dict[int, list] = {}

    def _cut(self, data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Starts of the words of a block: every run of blanks starts one, and a
        byte that no longer piece holds is one."""
        blank = data == 0x20
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        alone = self.table.alone[data] & (data < 0x80)
        start |= alone
        start[1:] |= alone[:-1]
        start[firsts] = True
        return np.flatnonzero(start)

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        flat, counts, best, second = viterbi(self.table, words)
        begin = len(self.counts)
        self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
        self.scores, self.gaps = np.concatenate([self.scores, best]), np.concatenate([self.gaps, best - second])
        self.starts = np.concatenate([[0], np.cumsum(self.counts)[:-1]]).astype(np.int64)
        every = np.concatenate([self.keys, keys])
        places = np.concatenate([self.places, np.arange(begin, begin + len(keys))])
        order = np.argsort(every)
        self.keys, self.places = every[order], places[order]

    def block(self, texts: list[str]) -> Block:
        """All texts of a block at once."""
        raw = [b" " + t.encode() if t else b"" for t in texts]
        whole = b"".join(raw)
        edges = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        if not whole:
            nothing = np.zeros(len(texts) + 1, np.int64)
            return Block(np.zeros(0, np.int32), nothing, [[0.0] for _ in texts], [[] for _ in texts], nothing[1:] == 0)
        data = np.frombuffer(whole, np.uint8)
        filled = np.diff(edges) > 0
        starts = self._cut(data, edges[:-1][filled])
        ends = np.append(starts[1:], len(data))
        power, inverse = _power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * power[: len(data)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > WORD_MEMORY:
            self.forget()
        known = np.isin(keys, self.keys, assume_unique=True)
        new = np.flatnonzero(~known)
        if len(new):
            self._learn(keys[new], [whole[starts[f] : ends[f]] for f in first[new]])
        place = self.places[np.searchsorted(self.keys, keys)][which]
        counts = self.counts[place]
        upto = np.concatenate([[0], np.cumsum(counts)])
        ids = self.flat[ragged(self.starts[place], counts)]
        words = np.searchsorted(starts, edges)
        scores, changes = [], []
        for i in range(len(texts)):
            a, b = words[i], words[i + 1]
            here = place[a:b]
            score = float(self.scores[here].sum())
            near = self.gaps[here]
            take = np.argsort(near, kind="stable")[: self.best - 1] if len(near) < 64 else _smallest(near, self.best - 1)
            options = [self._search(int(here[k]), whole[starts[a + k] : ends[a + k]]) for k in take]
            own, other = [score], []
            for loss, choice in _combinations(options, self.best)[1:]:
                own.append(score - loss)
                other.append([(int(k), o[c][1]) for k, o, c in zip(take, options, choice) if c])
            scores.append(own)
            changes.append(other)
        return Block(ids, upto[words], scores, changes, self._returns(ids, upto[words], data, edges))

    def _returns(self, ids: np.ndarray, stops: np.ndarray, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Whether the bytes of each text's ids, in turn, are the text's."""
        sizes = self.table.lengths[ids]
        again = self.table.flat[ragged(self.table.begins[ids], sizes)]
        upto = np.concatenate([[0], np.cumsum(sizes)])[stops]
        if np.array_equal(upto, edges) and np.array_equal(again, data):
            return np.ones(len(edges) - 1, bool)
        pairs = zip(upto[:-1], upto[1:], edges[:-1], edges[1:])
        return np.array([np.array_equal(again[a:b], data[c:d]) for a, b, c, d in pairs], bool)

    def _search(self, place: int, word: bytes) -> list[tuple[float, tuple[int, ...]]]:
        """A word's segmentations as (loss against its best, ids); the first is that of
        the forward pass."""
        found = self.searched.get(place)
        if found is None:
            start = self.starts[place]
            own = tuple(self.flat[start : start + self.counts[place]].tolist())
            paths = n_best(self.table, word, self.best)
            others = [(paths[0][0] - s, ids) for s, ids in paths if ids != own]
            found = self.searched[place] = [(0.0, own), *others][: self.best]
        return found


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """Places of the n smallest values, ties to the first."""
    limit = np.partition(values, n - 1)[n - 1]
    at = np.flatnonzero(values <= limit)
    return at[np.argsort(values[at], kind="stable")][:n]


def _combinations(options: list[list], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n choices (one option of each word) of least loss. Words of larger gaps
    cannot take part: each would lose more than all of these alone."""
    start = (0,) * len(options)
    heap, seen, out = [(0.0, start)], {start}, []
    while heap and len(out) < n:
        loss, choice = heapq.heappop(heap)
        out.append((loss, choice))
        for k, o in enumerate(options):
            if choice[k] + 1 < len(o):
                after = (*choice[:k], choice[k] + 1, *choice[k + 1 :])
                if after not in seen:
                    seen.add(after)
                    heapq.heappush(heap, (loss - o[choice[k]][0] + o[choice[k] + 1][0], after))
    return out


ENCODED = (
    "doc_id bigint, n_pieces bigint, ids_sha256 string, scores array<double>, decoded boolean, "
    "ids array<int>, changes array<array<struct<word:int,ids:array<int>>>>"
)
def _lists(sizes: list[int], values: pa.Array) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _changes(found: list[list[list[tuple[int, tuple[int, ...]]]]]) -> pa.ListArray:
    """Per text, per segmentation, the changed words, out of flat arrays."""
    ways = [way for text in found for way in text]
    words = [word for way in ways for word in way]
    ids = pa.array(np.fromiter((i for _, own in words for i in own), np.int32))
    own = _lists([len(own) for _, own in words], ids)
    changed = pa.StructArray.from_arrays([pa.array([w for w, _ in words], pa.int32()), own], ["word", "ids"])
    return _lists([len(text) for text in found], _lists([len(way) for way in ways], changed))


def _encoded(table: Broadcast, best: int, with_ids: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(table.value, best)
        for batch in batches:
            a = 0
            texts = [t.as_py() or "" for t in batch.column(1)]
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b]) <= BLOCK_BYTES):
                    size += len(texts[b])
                    b += 1
                found = encoder.block(texts[a:b])
                sizes = np.diff(found.stops)
                raw = [found.ids_of(i).astype("<i4").tobytes() for i in range(b - a)]
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array(sizes, pa.int64()),
                    pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
                    pa.array(found.scores, pa.list_(pa.float64())),
                    pa.array(found.returns, pa.bool_()),
                ]
                if with_ids:
                    columns += [_lists(sizes, pa.array(found.ids, pa.int32())), _changes(found.changes)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ENCODED.split(", ")][: len(columns)])
                a = b

    return encode


def encode(
    docs: DataFrame,
    model: str = MODEL,
    best: int = BEST,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """The ``best`` segmentations of every whole text.

    Gives ``doc_id, n_pieces, ids_sha256`` (of the best one's ids, as little-endian
    32-bit integers), ``scores`` (falling; fewer if there are no more), ``decoded``
    (the bytes of the best one's ids are those of the text), and with ``with_ids`` the
    best one's ``ids`` and, for each further one, the words (by number) that it cuts
    otherwise.

    The driver reads the model file once and sends its pieces, whose number the file
    bounds. A text is encoded with a blank before it. Null and empty texts have no
    pieces and one score, 0. Null ids and repeated rows are rows like others; a
    blank mark inside a text is kept, as bytes. Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    table = spark.sparkContext.broadcast(load_pieces(model))
    schema = ENCODED if with_ids else ENCODED[: ENCODED.index(", ids array")]
    rows = docs.select(docs[key].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(_encoded(table, best, with_ids), schema)


def decode(table: PieceTable, ids) -> str:
    return b"".join(map(table.pieces.__getitem__, ids))[1:].decode(errors="replace")
