"""Byte-level pair merging: pre-tokens of whole texts, merged rank by rank in arrays."""

from __future__ import annotations

import functools
import heapq
import json
from dataclasses import dataclass

import numpy as np
from tokenizers import Tokenizer

from cohortwise.llm.spans import ragged

MERGES = "/opt/tokenizers/byte_bpe_50k.json"
# Sequences of more symbols are merged one at a time, through a heap of their pairs.
LONG = 256
NONE = np.iinfo(np.int32).max
OTHER, LETTER, NUMBER, SPACE = range(4)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    are themselves, the others follow 255 in turn."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


@dataclass
class Merges:
    """A vocabulary's merges. ``keys`` are sorted pairs (left * size + right)."""

    size: int
    tokens: list[bytes]  # by id
    symbols: np.ndarray  # id of each byte
    keys: np.ndarray
    ranks: np.ndarray
    results: np.ndarray  # id by rank
    specials: list[str]
    runs: tuple[np.ndarray, np.ndarray]

    @functools.cached_property
    def classes(self) -> np.ndarray:
        """Class of each code point: letter, number, white space or other."""
        begins, kinds = self.runs
        return np.repeat(kinds, np.diff(np.append(begins, 0x110000)))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], NONE)


def load_merges(path: str = MERGES) -> Merges:
    """Merges of a vocabulary file. Rank by rank merging is exact only where each merge
    uses symbols made by earlier ones; other files are an error, as are files whose
    pre-tokens or special tokens follow other rules."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, cut = spec["model"], spec["pre_tokenizer"]
    plain = cut["type"] == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"]
    extras = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    if not plain or spec["normalizer"] or any(model.get(k) for k in extras):
        raise ValueError("not a plain byte-level vocabulary")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
        raise ValueError("special tokens must match as they are")
    vocab, letters = model["vocab"], byte_letters()
    size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
    of_letter = {c: b for b, c in enumerate(letters)}
    tokens = [b""] * size
    for token, i in vocab.items():
        if all(c in of_letter for c in token):
            tokens[i] = bytes(of_letter[c] for c in token)
    made, keys, results = {letters[b]: -1 for b in range(256)}, [], []
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        if made.get(left, rank) >= rank or made.get(right, rank) >= rank or left + right in made:
            raise ValueError(f"merge {rank} does not follow those that made its parts")
        made[left + right] = rank
        keys.append(vocab[left] * size + vocab[right])
        results.append(vocab[left + right])
    order = np.argsort(np.array(keys, np.int64))
    return Merges(
        size,
        tokens,
        np.array([vocab[c] for c in letters], np.int32),
        np.array(keys, np.int64)[order],
        order.astype(np.int32),
        np.array(results, np.int32),
        [t["content"] for t in spec["added_tokens"]],
        class_runs(Tokenizer.from_file(path).pre_tokenizer),
    )


def class_runs(cut) -> tuple[np.ndarray, np.ndarray]:
    """Runs of code points of one class, as the library's own pre-tokenizer tells them
    apart: where each begins, and its class. The string of all characters falls into
    its runs; one character of each is then tried beside a letter, a digit and a mark."""
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    begins, kinds = [], []
    for _, (begin, end) in cut.pre_tokenize_str("".join(map(chr, every))):
        for at in {begin, begin + 1} if every[begin] == 0x20 else {begin}:
            near = [len(cut.pre_tokenize_str(c + chr(every[at]))) == 1 for c in "x1!"]
            begins.append(every[at])
            kinds.append((LETTER, NUMBER, OTHER)[near.index(True)] if any(near) else SPACE)
    order = np.argsort(begins)
    return np.array(begins)[order], np.array(kinds, np.uint8)[order]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def byte_lengths(points: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of each code point."""
    out = np.ones(len(points), np.int64)
    for limit in (0x80, 0x800, 0x10000):
        out += points >= limit
    return out


def pretoken_starts(classes: np.ndarray, points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Which code points begin a pre-token; ``edges`` are the places where a text begins.

    Runs of letters, of numbers and of other characters are pre-tokens, each with the
    one blank before it; of white space the last character is left to what follows.
    After a lone apostrophe the endings s, t, m, d, re, ve and ll are cut off.
    """
    n = len(points)
    kind = classes[points]
    edge = np.zeros(n + 1, bool)
    edge[edges] = True
    run = edge.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    start = run.copy()
    after = np.flatnonzero(run[1:n] & ~edge[1:n] & (kind[:-1] == SPACE)) + 1
    start[after - 1] = True
    start[after[points[after - 1] == 0x20]] = False
    mark = np.flatnonzero(run[:n] & start[:n] & (points == 0x27))
    mark = mark[mark + 1 < n]
    mark = mark[run[mark + 1] & ~edge[mark + 1] & (kind[mark + 1] == LETTER)]
    one = points[mark + 1]
    follows = np.zeros(len(mark), bool)
    follows[mark + 2 < n] = ~run[mark[mark + 2 < n] + 2]
    two = np.where(follows, points[np.minimum(mark + 2, n - 1)], 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(mark), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    for found, length in ((mark[short], 2), (mark[long & ~short], 3)):
        start[found + 1] = False
        start[found + length] = True
    return start[:n]


def merged(table: Merges, data: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of many sequences of bytes, one after the other, merged until no pair of
    them has a rank; and how many are left of each.

    In each round every sequence applies its pair of lowest rank, at all places from
    the left, all sequences at once. Merging makes pairs of later ranks only, so this
    is merging by rank. Only ranks beside a merge are looked up again.
    """
    left_over = np.zeros(len(counts), np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    begins = np.cumsum(counts) - counts
    for i in np.flatnonzero(counts > LONG):
        ids = merged_long(table, data[begins[i] : begins[i] + counts[i]])
        left_over[i] = len(ids)
        done.append((np.full(len(ids), i), ids))
    rows = np.flatnonzero((counts > 0) & (counts <= LONG))
    owner = np.repeat(rows, counts[rows])
    symbol = table.symbols[data[ragged(begins[rows], counts[rows])]]
    rank = np.full(len(symbol), NONE, np.int32)
    joined = np.flatnonzero(owner[1:] == owner[:-1])
    rank[joined] = table.rank(symbol[joined], symbol[joined + 1])
    while len(owner):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        lengths = np.diff(np.append(starts, len(owner)))
        lowest = np.minimum.reduceat(rank, starts)
        alive = lowest < NONE
        left_over[owner[starts[~alive]]] = lengths[~alive]
        mask = np.repeat(alive, lengths)
        if not alive.all():
            done.append((owner[~mask], symbol[~mask]))
            owner, symbol, rank = owner[mask], symbol[mask], rank[mask]
        low = np.repeat(lowest[alive], lengths[alive])
        at = np.flatnonzero(rank == low)
        if not len(at):
            break
        fresh = np.concatenate([[True], np.diff(at) > 1])  # of aaa only the first two merge
        place = np.arange(len(at))
        at = at[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
        symbol[at] = table.results[rank[at]]
        keep = np.ones(len(owner), bool)
        keep[at + 1] = False
        owner, symbol, rank = owner[keep], symbol[keep], rank[keep]
        at = at - np.arange(len(at))
        near = np.concatenate([at, at[at > 0] - 1])
        rank[near] = NONE
        near = near[near + 1 < len(owner)]
        near = near[owner[near] == owner[near + 1]]
        rank[near] = table.rank(symbol[near], symbol[near + 1])
    if not done:
        return np.zeros(0, np.int32), left_over
    owners, ids = (np.concatenate(x) for x in zip(*done))
    return ids[np.argsort(owners, kind="stable")].astype(np.int32), left_over


def merged_long(table: Merges, data: np.ndarray) -> np.ndarray:
    """The same for one long sequence: its places wait in a heap by rank, so a round
    touches only the places of its pair."""
    symbol = table.symbols[data].tolist()
    n = len(symbol)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    first = table.rank(np.array(symbol[:-1]), np.array(symbol[1:]))
    heap = [(int(r), i) for i, r in enumerate(first) if r < NONE]
    heapq.heapify(heap)
    known = dict(zip(table.keys.tolist(), table.ranks.tolist()))
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if symbol[i] >= 0 else n
        if j >= n or known.get(symbol[i] * table.size + symbol[j]) != rank:
            continue  # merged away meanwhile
        symbol[i], symbol[j] = int(table.results[rank]), -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n:
                new = known.get(symbol[a] * table.size + symbol[b])
                if new is not None:
                    heapq.heappush(heap, (new, a))
    return np.array([s for s in symbol if s >= 0], np.int32)
