"""Token counts of whole texts by rank-synchronous merging in arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from cohortwise.llm.bytepairs import MERGES, Merges, byte_lengths, code_points, load_merges, merged, pretoken_starts
from cohortwise.llm.spans import Numbers, blocks, ragged, span_hashes, sums_by

# Bytes of distinct pre-tokens that a task remembers the counts of.
MEMORY_BYTES = 30_000_000
COUNTED = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def segments(text: str, specials: list[str]) -> tuple[list[str], int]:
    """A text between its special tokens, and how many there are. The leftmost match
    counts, and of several there the one listed first."""
    if not any(s in text for s in specials):
        return [text] if text else [], 0
    found, begin, number = [], 0, 0
    while hits := [(at, k) for k, s in enumerate(specials) if (at := text.find(s, begin)) >= 0]:
        at, k = min(hits)
        found.append(text[begin:at])
        begin, number = at + len(specials[k]), number + 1
    return [s for s in [*found, text[begin:]] if s], number


class Counter:
    """Counts tokens of texts; counts of pre-tokens are remembered by hash."""

    def __init__(self, table: Merges):
        self.table = table
        self.forget()

    def forget(self) -> None:
        self.numbers, self.counts, self.held = Numbers(), np.zeros(0, np.int64), 0

    def pretokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts of all pre-tokens of texts, in order, and how many each text has."""
        points = code_points("".join(texts))
        edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        begins = np.flatnonzero(pretoken_starts(self.table.classes, points, edges[:-1]))
        upto = np.concatenate([[0], np.cumsum(byte_lengths(points))])
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        starts, ends = upto[begins], upto[np.append(begins[1:], len(points))]
        if self.held > MEMORY_BYTES:
            self.forget()
        numbers, new = self.numbers.of(span_hashes(data, starts, ends))
        if len(new):
            sizes = ends[new] - starts[new]
            self.held += int(sizes.sum())
            _, counts = merged(self.table, data[ragged(starts[new], sizes)], sizes)
            self.counts = np.concatenate([self.counts, counts])
        return self.counts[numbers], np.diff(np.searchsorted(begins, edges))

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, special tokens among them."""
        total = np.zeros(len(texts), np.int64)
        whole, owners = [], []
        for i, text in enumerate(texts):
            between, total[i] = segments(text, self.table.specials)
            whole += between
            owners += [i] * len(between)
        for block in blocks(whole):
            counts, sizes = self.pretokens([part for _, part in block])
            sums = sums_by(counts, np.concatenate([[0], np.cumsum(sizes)]))
            np.add.at(total, [owners[k] for k, _ in block], sums)
        return total


def _counted(table: Broadcast, limit: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(table.value)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            tokens = counter.count(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens),
                    pa.array(tokens > limit),
                ],
                [c.split()[0] for c in COUNTED.split(", ")],
            )

    return count


def token_counts(
    docs: DataFrame, path: str = MERGES, limit: int = 1024, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``n_tokens`` are the tokens that the vocabulary file gives for the whole text,
    without begin or end; strings of special tokens inside it are one token each.
    ``over_limit`` tells counts above ``limit``. The text is cut into pre-tokens; those
    not met before are merged as ragged arrays, each by its lowest rank at once.

    The driver reads the file and sends its merges, whose number the file bounds. Rows
    are independent: nothing is shuffled. Null and empty texts have no bytes and no
    tokens. Null ids and repeated rows are rows like others; other columns are not read.
    Texts of any length are worked off in parts; pre-tokens are remembered by 64-bit
    hashes.
    """
    table = docs.sparkSession.sparkContext.broadcast(load_merges(path))
    rows = docs.select(docs[key].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(_counted(table, limit), COUNTED)
