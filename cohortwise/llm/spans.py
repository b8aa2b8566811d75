"""Whole texts cut into spans that are worked out once: blocks, hashes, memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from cohortwise.llm.common import _power_tables, mix

# Characters that are worked on at once.
BLOCK_CHARS = 2_000_000


def parts(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut before a blank that follows a
    character other than white space; without such a place the part goes on."""
    begin = 0
    while len(text) - begin > size:
        cut = text.find(" ", begin + size)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[begin:cut]
        begin = cut
    yield text[begin:] if begin else text


def blocks(texts: list[str], size: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The parts of texts with the text's number, together about ``size`` characters."""
    held, chars = [], 0
    for i, text in enumerate(texts):
        for part in parts(text, size):
            if held and chars + len(part) > size:
                yield held
                held, chars = [], 0
            held.append((i, part))
            chars += len(part)
    if held:
        yield held


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of an array of small numbers: polynomials modulo 2^64, all
    out of one running sum."""
    power, inverse = _power_tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values + np.uint64(1)) * power[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


class Numbers:
    """Numbers hashes in the order in which they are first met."""

    def __init__(self):
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each hash, and the places where new ones are first met, in
        the order of their numbers."""
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        fresh = ~known
        found = np.empty(len(keys), np.int64)
        found[known] = self.numbers[at[known]]
        found[fresh] = len(self.keys) + np.arange(np.count_nonzero(fresh))
        self.numbers = np.insert(self.numbers, at[fresh], found[fresh])
        self.keys = np.insert(self.keys, at[fresh], keys[fresh])
        return found[which], first[fresh]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of all elements of runs that begin at ``starts``, run after run."""
    upto = np.cumsum(counts)
    total = int(upto[-1]) if len(upto) else 0
    return np.repeat(starts - (upto - counts), counts) + np.arange(total)


def sums_by(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive edges."""
    upto = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=upto[1:])
    return upto[edges[1:]] - upto[edges[:-1]]


