"""Jaccard join of word shingles by parity sketches.

A document's shingles are hashed, and the hashes are spread over the words of a
bit sketch in which every shingle flips one bit. The Hamming distance of two
sketches is at most the symmetric difference of the sets, and every differing
shingle touches one word alone. So where the sets of a size band can differ in d
shingles, a sketch of d + 1 words leaves one word untouched: linked documents
share a word at the same place. Documents meet in these buckets, and what meets
is verified on the whole sets.

Groups of copies are worked off without all their pairs. Equal sets are one class
from the start. A bucket first verifies its members against its best connected
member. Only buckets that still hold several components are compared further, each
by itself and one for all those of the same members: in blocks, by sketches, inside
the tasks; just the pairs of different components that can still link leave them and
are verified. A pair inside one
component needs no look, since components are what is asked for.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortwise.llm.common import Workspace, mix, partitions, sorted_groups, word_hashes
from cohortwise.llm.graph import components

# Ratio of the sizes of a band, and the largest size provided for.
BAND = 1.5
LARGEST = 1 << 40
# 64-bit words of the sketches that pairs are compared by, at least; larger sets
# have a word for every SKETCH_LOAD shingles. Rows of a block.
SKETCH_WORDS = 32
SKETCH_LOAD = 16
BLOCK_ROWS = 512
# Words of the sketches that go to the blocks, at most, and rows of a block that are
# compared with the others at once.
BLOCK_WORDS = 128
PAIR_ROWS = 64
# Contents that a task remembers, to send the buckets of a copy only once.
COPY_MEMORY = 200_000
# Bucket keys handed on at once.
KEY_BATCH = 200_000
SETS = "rep bigint, shingles binary"
# Pairs are verified in so many turns, each of which moves a part of the sets.
VERIFY_PARTS = 3


def band_limits() -> np.ndarray:
    limits = [1]
    while limits[-1] < LARGEST:
        limits.append(max(limits[-1] + 1, int(limits[-1] * BAND)))
    return np.array(limits, np.int64)


LIMITS = band_limits()


class Shingler:
    """Sets of shingle hashes (64 bits, sorted) of texts."""

    def __init__(self, words: int):
        self.words = words

    def of(self, text: str | None) -> np.ndarray:
        hashed = word_hashes(text)
        if not len(hashed):
            return hashed
        size = min(self.words, len(hashed))
        out = np.full(len(hashed) - size + 1, size, np.uint64)
        for i in range(size):
            out = mix(out + hashed[i : i + len(out)] * np.uint64(2 * i + 3))
        return np.unique(out)


def set_address(shingles: np.ndarray) -> tuple[int, int]:
    """128-bit address of a set, as two signed integers."""
    digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(digest[0]), int(digest[1])


class Limit:
    """Similarity of at least percent / 100, in whole numbers."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("the similarity must be 50 to 100 percent")
        self.percent = percent

    def difference(self, sizes: np.ndarray | int):
        """Largest symmetric difference of linked sets whose sizes sum to ``sizes``:
        with i common of u, i >= p u and 2 i + (u - i) = sizes."""
        return (100 - self.percent) * sizes // (100 + self.percent)

    def partner(self, size: np.ndarray | int):
        """Largest set that a set of this size can link with."""
        return 100 * size // self.percent

    def links(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)


def bands(size: int, limit: Limit) -> range:
    """Bands whose larger member a set of this size can be, or be linked with."""
    low, high = np.searchsorted(LIMITS, [size, limit.partner(size)], "right") - 1
    return range(int(low), int(high) + 1)


def sketch(shingles: np.ndarray, words: int, flips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and contents of a sketch's touched words. The leading bits of a hash
    choose the word, so sorted shingles fall word by word; ``flips`` has the bits
    that each shingle flips there."""
    place = ((shingles >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return place[starts].astype(np.int64), np.bitwise_xor.reduceat(flips, starts)


def one_bit(shingles: np.ndarray) -> np.ndarray:
    """One flipped bit each: Hamming distances are at most the sets' difference."""
    return np.uint64(1) << (shingles & np.uint64(63))


def all_bits(shingles: np.ndarray) -> np.ndarray:
    """Each shingle's own pattern of flips: words that are equal hold equal shingles,
    also where they hold few."""
    return mix(shingles)


def pair_sketch(shingles: np.ndarray) -> np.ndarray:
    """One-bit sketch whose width, a power of two, follows the size of the set."""
    words = max(SKETCH_WORDS, 1 << max(0, math.ceil(len(shingles) / SKETCH_LOAD) - 1).bit_length())
    full = np.zeros(words, np.uint64)
    place, parity = sketch(shingles, words, one_bit(shingles))
    full[place] = parity
    return full


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A sketch of a power of two words at a lower width: neighbours flip together."""
    while len(bits) > words:
        bits = bits[0::2] ^ bits[1::2]
    return bits


def folded_rows(raw: list[bytes]) -> np.ndarray:
    return np.stack([folded(np.frombuffer(r, np.uint64), SKETCH_WORDS) for r in raw])


def far_apart(x: bytes, y: bytes, limit: int) -> bool:
    """Whether two sketches, at the width of the narrower, differ in too many bits."""
    words = min(len(x), len(y)) // 8
    one, two = (folded(np.frombuffer(v, np.uint64), words) for v in (x, y))
    return int(np.bitwise_count(one ^ two).sum()) > limit


@functools.cache
def scheme(band: int, percent: int) -> tuple[int, int]:
    """Words of a band's sketches, and how many of them may be untouched.

    Linked sets differ in at most d places, which spoil d words. Words that are
    empty in both tell nothing, so there are ``spare`` words more: a set with no
    more empty words than that shares a word with content with every set that it
    links with, and needs no buckets for its empty ones. The spare words are as many
    as a small member's empty words, but for rare cases; these use all words.
    """
    limit = Limit(percent)
    difference = int(limit.difference(2 * (int(LIMITS[band + 1]) - 1)))
    least = int(LIMITS[band]) * percent / 100
    words = difference + 1
    for _ in range(8):
        empty = words * math.exp(-least / words)
        spare = min(math.ceil(empty + 3 * math.sqrt(empty)), difference // 4) if difference else 0
        words = difference + 1 + spare
    return words, spare


def bucket_keys(shingles: np.ndarray, limit: Limit) -> np.ndarray:
    """Keys of the sketch words of a set, over its bands."""
    keys, flips = [], all_bits(shingles)
    for band in bands(len(shingles), limit):
        words, spare = scheme(band, limit.percent)
        place, parity = sketch(shingles, words, flips)
        if words - len(place) > spare:
            full = np.zeros(words, np.uint64)
            full[place] = parity
            place, parity = np.arange(words), full
        where = place.astype(np.uint64) + np.uint64((band << 44) + 1)
        keys.append(mix(parity ^ mix(where)))
    return np.concatenate(keys)


SIZES = "doc_id bigint, n bigint, h1 bigint, h2 bigint, sketch binary"


def _sizes(words: int):
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            counts, ends, bits = [], [], []
            for text in batch.column(1):
                shingles = shingler.of(text.as_py())
                counts.append(len(shingles))
                ends.append(set_address(shingles))
                bits.append(pair_sketch(shingles).tobytes() if len(shingles) else None)
            ends = np.array(ends, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(ends[:, 0]),
                    pa.array(ends[:, 1]),
                    pa.array(bits, pa.binary()),
                ],
                [c.split()[0] for c in SIZES.split(", ")],
            )

    return sizes


def _keys(words: int, percent: int):
    """Keys with the first half of the set's address: equal sets send the same rows,
    whatever document they are found in."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, limit, sent = Shingler(words), Limit(percent), set()
        for batch in batches:
            names, found, held = [], [], 0
            for text in batch.column(0):
                shingles = shingler.of(text.as_py())
                if not len(shingles):
                    continue
                address = set_address(shingles)
                if address in sent:
                    continue
                if len(sent) >= COPY_MEMORY:
                    sent.clear()
                sent.add(address)
                found.append(bucket_keys(shingles, limit))
                names.append(address[0])
                held += len(found[-1])
                if held >= KEY_BATCH:
                    yield _key_batch(names, found)
                    names, found, held = [], [], 0
            if names:
                yield _key_batch(names, found)

    return keys


def _key_batch(names: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
    h1 = np.repeat(np.array(names, np.int64), [len(f) for f in found])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(h1)], ["key", "h1"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose key has several sets, out of rows sorted by key and set, each row once.
    Only the last row is held, so a bucket may be of any size."""
    held_key = held_set = None
    held_out = False  # whether the held row has been given out
    for batch in batches:
        key, h1 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(key):
            continue
        if held_key is not None:
            key, h1 = np.concatenate([[held_key], key]), np.concatenate([[held_set], h1])
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (h1[1:] != h1[:-1])
        key, h1 = key[fresh], h1[fresh]
        same = key[1:] == key[:-1]
        out = np.zeros(len(key), bool)
        out[1:] |= same
        out[:-1] |= same
        last_out = bool(out[-1]) or (len(key) == 1 and held_out)
        if held_key is not None and held_out:
            out[0] = False
        held_key, held_set, held_out = key[-1], h1[-1], last_out
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(h1[out])], ["key", "h1"])


def _sets(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(words), set()
        for batch in batches:
            reps, packed = [], []
            for doc, text, h1, h2 in zip(*batch.columns):
                doc = doc.as_py()
                if doc in seen:
                    continue
                shingles = shingler.of(text.as_py())
                if set_address(shingles) != (h1.as_py(), h2.as_py()):
                    continue  # another text under the same id
                seen.add(doc)
                reps.append(doc)
                packed.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(reps, pa.int64()), pa.array(packed, pa.binary())], ["rep", "shingles"]
            )

    return sets


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = Limit(percent)
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([a, b])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                ok.append(limit.links(common, len(a), len(b)))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(mask) for c in batch.columns[:2]], ["a", "b"])

    return verify


def _near(percent: int):
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = Limit(percent)
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            x, y = (batch.column(i).to_pylist() for i in (4, 5))
            apart = np.bitwise_count(folded_rows(x) ^ folded_rows(y)).sum(axis=1, dtype=np.int64)
            most = limit.difference(n + m)
            fit = (apart <= most) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent)
            for i in np.flatnonzero(fit & (np.minimum(n, m) > SKETCH_WORDS * SKETCH_LOAD)):
                fit[i] = not far_apart(x[i], y[i], int(most[i]))
            mask = pa.array(fit)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return near


def _can_link(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and sketches allow a link; the sets themselves stay away."""
    one = sketches.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    two = sketches.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
    full = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "x", "y")
    return full.mapInArrow(_near(percent), "a bigint, b bigint")


def _verified(pairs: DataFrame, texts: DataFrame, classes: DataFrame, words: int, percent: int, work: Workspace):
    """Pairs that link, by their whole sets. These are made from the texts that occur in
    a pair, one of each class; what they take goes before the links are returned."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    wanted = classes.join(ends, "rep", "left_semi").select(F.col("rep").alias("doc_id"), "h1", "h2")
    # The ids have no bound: never broadcast, so the join is planned alike at every size.
    kept = texts.join(wanted.hint("merge"), "doc_id").select("doc_id", "text", "h1", "h2")
    sets, sets_path = work.keep(kept.mapInArrow(_sets(words), SETS), "sets")
    work.release()
    found = []
    for part in range(VERIFY_PARTS):
        one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
        two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
        own = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(VERIFY_PARTS)) == part)
        full = own.join(two, "b").join(one, "a").select("a", "b", "x", "y")
        found.append(work.stored(full.mapInArrow(_verify(percent), "a bigint, b bigint"), "links"))
        work.release()
    work.drop(sets_path)
    return functools.reduce(DataFrame.unionByName, found)


def _small_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches of at most `BLOCK_WORDS` words, for the comparison in blocks."""
    for batch in batches:
        raw = [folded(np.frombuffer(r, np.uint64), BLOCK_WORDS).tobytes() for r in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(raw, pa.binary())], ["rep", "n", "sketch"])


def _block_pairs(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit, found, held = Limit(percent), [], 0
        for group in sorted_groups(batches, ["key", "i", "j"]):
            rep, n, comp, block, i, j = (group.column(c).to_numpy() for c in ("rep", "n", "component", "block", "i", "j"))
            raw = group.column("sketch").to_pylist()
            bits = folded_rows(raw)
            inside = i[0] == j[0]
            left = np.arange(len(rep)) if inside else np.flatnonzero(block == i)
            right = left if inside else np.flatnonzero(block == j)
            for a in range(0, len(left), PAIR_ROWS):
                x, y = (v.ravel() for v in np.meshgrid(left[a : a + PAIR_ROWS], right, indexing="ij"))
                fit = comp[x] != comp[y]
                if inside:
                    fit &= x < y
                x, y = x[fit], y[fit]
                low, high = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
                fit = low * 100 >= high * percent
                x, y, low = x[fit], y[fit], low[fit]
                fit = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64) <= limit.difference(n[x] + n[y])
                for k in np.flatnonzero(fit & (low > SKETCH_WORDS * SKETCH_LOAD // 2)):
                    fit[k] = not far_apart(raw[x[k]], raw[y[k]], int(limit.difference(n[x[k]] + n[y[k]])))
                one, two = rep[x[fit]], rep[y[fit]]
                found.append((np.minimum(one, two), np.maximum(one, two)))
                held += len(one)
            if held >= KEY_BATCH:
                yield _pair_batch(found)
                found, held = [], 0
        if held:
            yield _pair_batch(found)

    return compare


def _pair_batch(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate(x) for x in zip(*found))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def jaccard_components(
    docs: DataFrame,
    words: int = 3,
    percent: int = 90,
    key: str = "doc_id",
    text: str = "text",
    work: Workspace | None = None,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z in lower case; a text's set
    holds its distinct shingles of ``words`` words, or its whole sequence if it has
    fewer. Sets link when they share ``percent`` in 100 of their union. The
    component is the smallest id reachable by links.

    A text without words, null or empty, has an empty set and links with nothing.
    A null id keeps its size, links with nothing and has a null component. Of
    different texts under one id, that with the smallest address of its set stands
    for the id; each row keeps its own size. Equal texts with words are always
    linked. Other columns are not read. Shingles are compared by 64-bit hashes,
    whole sets by 128 bits.
    """
    spark = docs.sparkSession
    work = work or Workspace(spark, "parity")
    texts = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sizes = work.stored(texts.mapInArrow(_sizes(words), SIZES), "sizes")
    full = sizes.filter("n > 0 AND doc_id IS NOT NULL")
    full = full.groupBy("doc_id").agg(F.min(F.struct("h1", "h2")).alias("s")).select("doc_id", "s.*")
    classes = work.stored(full.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep")), "classes")
    member = work.stored(full.join(classes, ["h1", "h2"]).select("doc_id", "rep"), "member")

    rows = texts.filter(F.col("doc_id").isNotNull()).select("text")
    rows = rows.mapInArrow(_keys(words, percent), "key bigint, h1 bigint")
    rows = rows.repartition(partitions(spark), "key").sortWithinPartitions("key", "h1")
    shared, shared_path = work.keep(rows.mapInArrow(_shared, "key bigint, h1 bigint"), "shared")
    work.release()
    # Texts that stand for no id have no class; two classes may share half an address.
    meets, meets_path = work.keep(shared.join(classes.select("h1", "rep"), "h1").select("key", "rep"), "meets")
    work.drop(shared_path)

    # The member with most buckets is the likeliest source of the others.
    weight = work.stored(meets.groupBy("rep").agg(F.count(F.lit(1)).alias("w")), "weight")
    best = meets.join(weight, "rep").groupBy("key")
    best = best.agg(F.max(F.struct("w", (-F.col("rep")).alias("low"))).alias("best"), F.count(F.lit(1)).alias("m"))
    best = best.filter("m > 1").select("key", (-F.col("best.low")).alias("center"), "m")
    best, best_path = work.keep(best, "centers")
    work.release()
    stars = meets.join(best, "key").filter("rep <> center")
    pairs = stars.select(F.least("rep", "center").alias("a"), F.greatest("rep", "center").alias("b")).distinct()
    pairs, pairs_path = work.keep(pairs, "pairs")
    # Only buckets of three or more can still hold several components afterwards.
    many = best.filter("m > 2")
    later, later_path = work.keep(meets.join(many.select("key"), "key", "left_semi"), "later")
    work.drop(meets_path, best_path)
    named = classes.join(weight.select("rep"), "rep", "left_semi")
    own = sizes.join(named, ["h1", "h2"]).filter("doc_id = rep").select("rep", "n", "sketch")
    sketches, sketches_path = work.keep(own.dropDuplicates(["rep"]), "sketches")
    work.release()
    near, near_path = work.keep(_can_link(pairs, sketches, percent), "near")
    work.drop(pairs_path)
    work.release()
    links = _verified(near, texts, classes, words, percent, work)
    joined = components(links, work)
    work.drop(near_path)

    state = weight.select("rep").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    state = work.stored(state.select("rep", F.coalesce("component", "rep").alias("component")), "state")
    open_keys = (
        later.join(state, "rep")
        .groupBy("key")
        .agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
        .filter("c1 <> c2")
    )
    left = work.stored(later.join(open_keys.select("key"), "key", "left_semi").select("key", "rep"), "open")
    # Near copies share many buckets; those of the same members are worked off once.
    marks = [F.bit_xor(F.xxhash64("rep", F.lit(k))).alias(f"s{k}") for k in (1, 2)]
    alike = left.groupBy("key").agg(*marks, F.count(F.lit(1)).alias("size"))
    alike = alike.groupBy("s1", "s2", "size").agg(F.min("key").alias("key")).select("key", "size")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK_ROWS)).cast("int")
    small = work.stored(sketches.mapInArrow(_small_sketches, "rep bigint, n bigint, sketch binary"), "small")
    dealt = (
        left.join(alike, "key")
        .join(state, "rep")
        .join(small, "rep")
        .withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    )
    others = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda b: F.struct(F.least(b, F.col("block")).alias("i"), F.greatest(b, F.col("block")).alias("j")),
    )
    dealt = dealt.select("key", "block", "rep", "n", "component", "sketch", F.inline(others))
    dealt = dealt.repartition(partitions(spark), "key", "i", "j").sortWithinPartitions("key", "i", "j")
    close = work.stored(dealt.mapInArrow(_block_pairs(percent), "a bigint, b bigint").distinct(), "close")
    work.release()
    more = work.stored(_can_link(close, sketches, percent), "more")
    work.drop(later_path, sketches_path)
    work.release()
    late = _verified(more, texts, classes, words, percent, work)
    # Late links join components of the first round, which are few by now.
    ends = [state.select(F.col("rep").alias(c), F.col("component").alias(f"c{c}")) for c in ("a", "b")]
    bridges = late.join(ends[0], "a").join(ends[1], "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    merged = components(bridges.distinct(), work).select(F.col("id").alias("component"), F.col("component").alias("_m"))
    final = state.join(merged, "component", "left").select("rep", F.coalesce("_m", "component").alias("_c"))
    found = member.join(final, "rep", "left").select("doc_id", F.coalesce("_c", "rep").alias("component_id"))
    out = sizes.select("doc_id", "n").join(found, "doc_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
