"""Alignment of two tokenizers over the same texts, with corpus-wide counts of linked ids.

Both cut a text into tokens of bytes; where tokens of both end, a group ends. A token of
A and one of B are linked when they share a group. Most groups are one token each with
the same bytes: for these an array from A's ids to B's ids of the same bytes is made
beforehand, and they are counted in one vector as long as A's vocabulary. Only pairs of
the other groups are shuffled to be counted.

Texts fall apart at places that no token of either crosses. Such units repeat, so each
is encoded and aligned once in a task and kept as its ids' links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from cohortwise.llm.bytepairs import MERGES, Merges, byte_lengths, code_points, load_merges, merged, pretoken_starts
from cohortwise.llm.common import Workspace
from cohortwise.llm.pieces import MARK, MODEL
from cohortwise.llm.spans import Numbers, blocks, ragged, span_hashes, sums_by

# Bytes of distinct units that a task remembers.
MEMORY_BYTES = 6_000_000
# Links of a group from which on its repeated ids are multiplied, not listed.
LARGE_GROUP = 1 << 14
# Most frequent irregular pairs, whose counts go to all tasks; all others are joined.
FREQUENT = 1 << 17


@dataclass
class Vocabularies:
    """A's merges, B's model, and B's id of the same bytes for each id of A (-1: none)."""

    merges: Merges
    model: bytes
    pieces: list[bytes]  # of B, by id
    same: np.ndarray
    alone: np.ndarray  # whether a byte below 128 occurs in no piece of several characters

    @property
    def size_b(self) -> int:
        return len(self.pieces)


def load_vocabularies(path_a: str = MERGES, path_b: str = MODEL) -> Vocabularies:
    """Both files. B must add one blank before a text and have no piece with a blank
    inside, so that its tokens never cross the start of a run of blanks."""
    merges = load_merges(path_a)
    with open(path_b, "rb") as file:
        model = file.read()
    b = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces, inside, first = [], set(), {}
    for i in range(b.get_piece_size()):
        text = b.id_to_piece(i)
        if b.is_byte(i):
            pieces.append(bytes([int(text[3:5], 16)]))
            continue
        pieces.append(text.replace(MARK, " ").encode())
        if b.is_control(i) or b.is_unknown(i) or b.is_unused(i):
            continue
        if MARK in text.lstrip(MARK):
            raise ValueError(f"piece {i} holds a blank inside a word")
        first.setdefault(pieces[-1], i)
        inside |= set(pieces[-1])
    for i, piece in enumerate(pieces):
        if b.is_byte(i):
            first.setdefault(piece, i)
    if b"".join(pieces[i] for i in b.encode("  a b")) != b"   a b":
        raise ValueError("the model adds no blank, or changes those of the text")
    same = np.array([first.get(t, -1) if t else -1 for t in merges.tokens], np.int64)
    alone = np.array([c not in inside for c in range(128)])
    return Vocabularies(merges, model, pieces, same, alone)


def in_order(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and where the first of each stands, out of sorted ones."""
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    return values[first], first


class Aligner:
    """Aligns texts. Links are codes: an id of A stands for its pair with the id of the
    same bytes; other pairs are numbered after them as they are met."""

    def __init__(self, vocab: Vocabularies, written: bool):
        self.vocab, self.written = vocab, written
        self.size_a = vocab.merges.size
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocab.model)
        self.bytes_a = np.array([len(t) for t in vocab.merges.tokens], np.int64)
        self.bytes_b = np.array([len(t) for t in vocab.pieces], np.int64)
        lone = np.flatnonzero(vocab.alone)
        self.before = chr(lone[0]) if len(lone) else ""  # set before a unit without a blank
        self.cut_off, self.lone_blank = self.b.encode(self.before), self.b.piece_to_id(MARK)
        self.forget()

    def forget(self) -> None:
        self.numbers, self.pairs, self.held = Numbers(), Numbers(), 0
        self.met = np.zeros(0, np.int64)  # irregular pairs by number, a * size of B + b
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A and of B, groups, links
        self.broken = np.zeros(0, bool)
        self.codes, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.lines: list[str] = []

    def units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of texts with a blank before each, and how many each
        has. They hold until ``forget``."""
        found, total = [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
        for block in blocks([" " + t if t else "" for t in texts]):
            numbers, counts = self._block([part for _, part in block])
            found.append(numbers)
            np.add.at(total, [i for i, _ in block], counts)
        return np.concatenate(found), total

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = code_points("".join(texts))
        edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        begins = pretoken_starts(self.vocab.merges.classes, points, edges[:-1])
        blank, alone = points == 0x20, self.vocab.alone[np.minimum(points, 127)] & (points < 128)
        apart = blank | alone
        apart[1:] = (blank[1:] & ~blank[:-1]) | alone[1:] | alone[:-1]
        apart[edges[:-1][np.diff(edges) > 0]] = True
        upto = np.concatenate([[0], np.cumsum(byte_lengths(points))])
        cuts, firsts = np.flatnonzero(begins), np.flatnonzero(begins & apart)
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        marked = data.astype(np.uint16)
        marked[upto[cuts]] += 256  # a unit is its bytes and its pre-tokens
        starts, ends = upto[firsts], upto[np.append(firsts[1:], len(points))]
        numbers, new = self.numbers.of(span_hashes(marked, starts, ends))
        if len(new):
            self._learn(data, upto[np.append(cuts, len(points))], starts[new], ends[new])
        return numbers, np.diff(np.searchsorted(firsts, edges))

    def _encode(self, data: np.ndarray, cuts: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Ids of A and of B of units, one after the other, and how many each has."""
        first, after = np.searchsorted(cuts, starts), np.searchsorted(cuts, ends)
        own = ragged(first, after - first)
        sizes = cuts[own + 1] - cuts[own]
        ids_a, made = merged(self.vocab.merges, data[ragged(cuts[own], sizes)], sizes)
        n_a = sums_by(made, np.concatenate([[0], np.cumsum(after - first)]))
        whole = data.tobytes()
        raw = [whole[s:e].decode() for s, e in zip(starts.tolist(), ends.tolist())]
        spoken = self.b.encode([r[1:] if r[0] == " " else self.before + r for r in raw], num_threads=1)
        skip = len(self.cut_off)
        for i, r in enumerate(raw):
            if r == " ":  # the blank that B adds, which it does not for an empty text
                spoken[i] = [self.lone_blank]
            elif r[0] != " ":
                spoken[i] = spoken[i][skip:] if spoken[i][:skip] == self.cut_off else []
        n_b = np.array([len(s) for s in spoken], np.int64)
        ids_b = np.fromiter((i for s in spoken for i in s), np.int64, int(n_b.sum()))
        pieces = self.vocab.pieces
        right = [b"".join(map(pieces.__getitem__, s)) == r.encode() for s, r in zip(spoken, raw)]
        return ids_a.astype(np.int64), n_a, ids_b, n_b, np.array(right, bool)

    def _learn(self, data: np.ndarray, cuts: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        self.held += int((ends - starts).sum())
        ids_a, n_a, ids_b, n_b, right = self._encode(data, cuts, starts, ends)
        keep_a, keep_b = np.repeat(right, n_a), np.repeat(right, n_b)
        ids_a, ids_b = ids_a[keep_a], ids_b[keep_b]
        n_a, n_b = np.where(right, n_a, 0), np.where(right, n_b, 0)
        unit = np.repeat(np.arange(len(starts)), n_a)
        stop_a, stop_b = np.cumsum(self.bytes_a[ids_a]), np.cumsum(self.bytes_b[ids_b])
        last_a, last_b = np.isin(stop_a, stop_b, assume_unique=True), np.isin(stop_b, stop_a, assume_unique=True)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        groups = int(last_a.sum())
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        of_unit = unit[last_a]
        self.sizes = np.concatenate(
            [
                self.sizes,
                np.stack(
                    [
                        n_a,
                        n_b,
                        np.bincount(of_unit, minlength=len(starts)),
                        np.bincount(of_unit, in_a * in_b, minlength=len(starts)).astype(np.int64),
                    ],
                    axis=1,
                ),
            ]
        )
        self.broken = np.concatenate([self.broken, ~right])
        self._link(ids_a, ids_b, unit, group_a, in_a, in_b, of_unit, len(starts))
        if self.written:
            self._write(ids_a, ids_b, n_a, n_b, group_a, group_b, in_a, in_b, last_a, last_b)

    def _link(self, ids_a, ids_b, unit, group_a, in_a, in_b, of_unit, n_units) -> None:
        """Distinct codes of each unit and how often each occurs in it."""
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        large = in_a * in_b > LARGE_GROUP
        listed = np.flatnonzero(~large[group_a])
        counts = in_b[group_a[listed]]
        one = np.repeat(ids_a[listed], counts)
        two = ids_b[ragged(first_b[group_a[listed]], counts)]
        owners, times = [np.repeat(unit[listed], counts)], [np.ones(len(one), np.int64)]
        pairs = [one * self.vocab.size_b + two]
        for g in np.flatnonzero(large):
            a, many_a = np.unique(ids_a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            b, many_b = np.unique(ids_b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            pairs.append((a[:, None] * self.vocab.size_b + b).ravel())
            times.append((many_a[:, None] * many_b).ravel())
            owners.append(np.full(len(pairs[-1]), of_unit[g]))
        pair, owner, time = np.concatenate(pairs), np.concatenate(owners), np.concatenate(times)
        a = pair // self.vocab.size_b
        code, odd = a.copy(), np.flatnonzero(self.vocab.same[a] != pair % self.vocab.size_b)
        number, new = self.pairs.of(pair[odd].view(np.uint64))
        self.met = np.concatenate([self.met, pair[odd][new]])
        code[odd] = self.size_a + number
        order = np.lexsort((code, owner))
        span = self.size_a + len(self.met) + 1
        distinct, at = in_order((owner * span + code)[order])
        times = np.add.reduceat(time[order], at) if len(at) else np.zeros(0, np.int64)
        counts = np.bincount(distinct // span, minlength=n_units)
        self.starts = np.concatenate([self.starts, len(self.codes) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.codes = np.concatenate([self.codes, distinct % span])
        self.times = np.concatenate([self.times, times])

    def _write(self, ids_a, ids_b, n_a, n_b, group_a, group_b, in_a, in_b, last_a, last_b) -> None:
        """Each unit's groups as text: ``a1,a2|b1;a3|b2,b3``."""
        upto_a, upto_b = np.cumsum(in_a), np.cumsum(in_b)
        words = np.empty(len(ids_a) + len(ids_b), object)
        words[np.arange(len(ids_a)) + (upto_b - in_b)[group_a]] = [
            f"{i}|" if last else f"{i}," for i, last in zip(ids_a.tolist(), last_a.tolist())
        ]
        words[np.arange(len(ids_b)) + upto_a[group_b]] = [
            f"{i};" if last else f"{i}," for i, last in zip(ids_b.tolist(), last_b.tolist())
        ]
        ends = np.cumsum(n_a + n_b)
        words = words.tolist()
        for begin, end in zip((ends - n_a - n_b).tolist(), ends.tolist()):
            self.lines.append("".join(words[begin:end])[:-1])

    def by_text(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct codes of each whole text and how often each occurs in it, with the
        text's place, in order of both."""
        place = np.repeat(np.arange(len(counts)), counts)
        span = len(self.numbers) + 1
        used, first = in_order(np.sort(place * span + numbers))
        often = np.diff(np.append(first, len(numbers)))
        place, unit = used // span, used % span
        sizes = self.counts[unit]
        at = ragged(self.starts[unit], sizes)
        span = self.size_a + len(self.met) + 1
        keys, times = np.repeat(place, sizes) * span + self.codes[at], np.repeat(often, sizes) * self.times[at]
        order = np.argsort(keys, kind="stable")
        keys, first = in_order(keys[order])
        times = np.add.reduceat(times[order], first) if len(first) else np.zeros(0, np.int64)
        return keys // span, keys % span, times


PARTIAL = "a int, b int, n bigint"


def _counted(vocab: Broadcast):
    """Texts that hold each pair linked, summed per task: first the vector of A's ids
    (b is null), then the irregular pairs."""

    def sums(aligner: Aligner, held: np.ndarray) -> pa.RecordBatch:
        size_b, n = aligner.vocab.size_b, np.zeros(aligner.size_a + len(aligner.met), np.int64)
        n[: len(held)] = held
        vector, pairs = np.flatnonzero(n[: aligner.size_a]), np.flatnonzero(n[aligner.size_a :])
        met = aligner.met[pairs]
        b = np.concatenate([np.zeros(len(vector), np.int64), met % size_b])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([vector, met // size_b]).astype(np.int32)),
                pa.array(b.astype(np.int32), mask=np.arange(len(b)) < len(vector)),
                pa.array(np.concatenate([n[vector], n[aligner.size_a + pairs]])),
            ],
            ["a", "b", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, held = Aligner(vocab.value, False), np.zeros(0, np.int64)
        for batch in batches:
            for texts in _dealt([t.as_py() or "" for t in batch.column(0)]):
                numbers, counts = aligner.units(texts)
                numbers, counts = _unbroken(aligner, numbers, counts)
                _, codes, _ = aligner.by_text(numbers, counts)
                found = np.bincount(codes, minlength=len(held))
                found[: len(held)] += held
                held = found
                if aligner.held > MEMORY_BYTES:
                    yield sums(aligner, held)
                    aligner.forget()
                    held = np.zeros(0, np.int64)
        yield sums(aligner, held)

    return count


def _dealt(texts: list[str]) -> Iterator[list[str]]:
    """Texts in turn, some at a time; a long text is whole."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size > 1_000_000:
            yield texts[begin : i + 1]
            begin, size = i + 1, 0
    if begin < len(texts):
        yield texts[begin:]


def _unbroken(aligner: Aligner, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same without the units of texts whose bytes a tokenizer changes."""
    edges = np.concatenate([[0], np.cumsum(counts)])
    right = sums_by(aligner.broken[numbers].astype(np.int64), edges) == 0
    return numbers[np.repeat(right, counts)], np.where(right, counts, 0)


SCORED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups_sha256 string, pairs array<bigint>, times array<bigint>"
)


@dataclass
class Counts:
    """Corpus-wide counts that every task needs: of A's ids with the same bytes in B, of
    the most frequent other pairs (sorted), and the highest count of each id of A."""

    vector: np.ndarray
    highest: np.ndarray
    pairs: np.ndarray
    n: np.ndarray


def _scored(vocab: Broadcast, counts: Broadcast):
    def known(aligner: Aligner, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each code (-1: not known here), and whether it is its id's highest."""
        c, n = counts.value, np.full(len(codes), -1)
        plain = codes < aligner.size_a
        n[plain] = c.vector[codes[plain]]
        pair = aligner.met[codes[~plain] - aligner.size_a]
        if len(c.pairs):
            at = np.minimum(np.searchsorted(c.pairs, pair), len(c.pairs) - 1)
            n[~plain] = np.where(c.pairs[at] == pair, c.n[at], -1)
        a = codes.copy()
        a[~plain] = pair // aligner.vocab.size_b
        return n, n == c.highest[a]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(vocab.value, True)
        for batch in batches:
            ids, done = batch.column(0), 0
            for texts in _dealt([t.as_py() or "" for t in batch.column(1)]):
                numbers, sizes = _unbroken(aligner, *aligner.units(texts))
                edges = np.concatenate([[0], np.cumsum(sizes)])
                place, codes, times = aligner.by_text(numbers, sizes)
                n, best = known(aligner, codes)
                rare = n < 0
                sums = [sums_by(aligner.sizes[numbers, k], edges) for k in range(4)]
                for values in (best * times, np.where(rare, 0, n) * times):
                    sums.append(sums_by(values, np.searchsorted(place, np.arange(len(texts) + 1))))
                met, lines = aligner.met[codes[rare] - aligner.size_a], aligner.lines
                cuts = pa.array(np.searchsorted(place[rare], np.arange(len(texts) + 1)).astype(np.int32))
                own = [";".join(map(lines.__getitem__, x.tolist())) for x in np.split(numbers, edges[1:-1])]
                digests = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(done, len(texts)),
                        *(pa.array(s.astype(np.int64)) for s in sums),
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(cuts, pa.array(met)),
                        pa.ListArray.from_arrays(cuts, pa.array(times[rare])),
                    ],
                    [c.split()[0] for c in SCORED.split(", ")],
                )
                done += len(texts)
                if aligner.held > MEMORY_BYTES:
                    aligner.forget()

    return score


def align(
    docs: DataFrame,
    path_a: str = MERGES,
    path_b: str = MODEL,
    key: str = "doc_id",
    text: str = "text",
    frequent: int | None = None,
    work: Workspace | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Per row ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``,
    and the corpus-wide table ``a, b, n`` of linked id pairs.

    A (byte-level pairs) takes each text with a blank before it, B (pieces) adds that
    itself; strings of special tokens are text. ``n`` counts the rows that hold a pair
    linked at least once. ``n_best`` counts a row's links whose pair has its A id's
    highest n, ties included; ``count_sum`` adds n over its links. The digest is of the
    groups ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and texts whose bytes either tokenizer changes, have no
    tokens: zeros, and an empty digest. Null ids and repeated rows are rows like others;
    other columns are not read. An empty table gives empty tables.

    Texts are read twice: for the counts and for the sums. Three tables are broadcast,
    all of a size that the vocabularies or ``frequent`` bound: the vector and the highest
    count of A's ids, and the ``frequent`` pairs of highest n. The other pairs of a row
    are joined with their counts; each of them is in fewer rows than any frequent one.
    """
    spark = docs.sparkSession
    work = work or Workspace(spark, "alignment")
    frequent = FREQUENT if frequent is None else frequent
    loaded = load_vocabularies(path_a, path_b)
    vocab = spark.sparkContext.broadcast(loaded)
    size_b = loaded.size_b
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    partial = work.stored(rows.select("text").mapInArrow(_counted(vocab), PARTIAL), "partial")
    vector = partial.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    odd = work.stored(partial.filter("b IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    highest = vector.unionByName(odd.select("a", "n")).groupBy("a").agg(F.max("n").alias("n"))

    def by_id(table: DataFrame) -> np.ndarray:
        found, out = table.select("a", "n").toArrow(), np.zeros(loaded.merges.size, np.int64)
        out[found.column("a").to_numpy()] = found.column("n").to_numpy()
        return out

    top = odd.orderBy(F.desc("n"), "a", "b").limit(frequent).toArrow()
    pairs = top.column("a").to_numpy().astype(np.int64) * size_b + top.column("b").to_numpy()
    order = np.argsort(pairs)
    of_id = by_id(highest)
    counts = spark.sparkContext.broadcast(Counts(by_id(vector), of_id, pairs[order], top.column("n").to_numpy()[order]))
    scored = rows.mapInArrow(_scored(vocab, counts), SCORED)
    scored = work.stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")

    rare = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    pair = (F.col("a").cast("bigint") * size_b + F.col("b")).alias("pairs")
    best = F.broadcast(highest.withColumnRenamed("n", "most"))  # one row per id of A
    counted = odd.join(best, "a").select(pair, "n", (F.col("n") == F.col("most")).alias("best"))
    met = rare.join(counted, "pairs").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )
    out = scored.drop("pairs", "times").join(met, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
    same = spark.createDataFrame(pa.table({"a": np.arange(len(loaded.same)), "b": loaded.same}))
    named = vector.join(F.broadcast(same), "a").select("a", F.col("b").cast("int").alias("b"), "n")
    return out, named.unionByName(odd.select("a", "b", "n"))

