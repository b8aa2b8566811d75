"""Spelling variants: words one edit apart, found in a trie that is a table of edges.

All words, and all words reversed, are tries whose nodes are hashes of prefixes. Only
prefixes where words part or end are nodes; an edge holds the letters between two of
them. A frontier of states (word, position, node, edits) starts on each word's own path
and is joined with the edges level by level. A state that has not edited yet takes any
edge whose rest fits after one replaced or one left out letter; a state that has edited
follows the one edge that spells the word on. States at the end of their word on a node
that ends a word are neighbours.

Words one edit apart agree before the edit or after it for half of their length. So
the trie of words is entered in the second half of a word only, and the trie of reversed
words sees to edits in the first half: no state starts near the root, where a few nodes
hold all words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.llm.common import Workspace, mix
from cohortwise.llm.spans import ragged, span_hashes

# The letters, upper case and lower case; one run in CHANGED loses a letter.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "([a-zÀ-ÿ]+)"
CHANGED = 31
# A node that holds one in HOT_SHARE path rows or more is hot: there are at most as many.
HOT_SHARE = 1024
# Letters whose paths a task hands on at once.
PATH_BATCH = 500_000
PATHS = "id bigint, turned boolean, depth int, node bigint, next int"


def counted_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 7, least: int = 2, changed: int = CHANGED
) -> DataFrame:
    """``(word, n)``: words of texts with at least ``shortest`` letters and ``least``
    occurrences, some of them misspelt.

    Runs of letters, A-Z in lower case, are words. Where ``changed`` divides h, the
    crc32 of ``<key>:<run>``, the run's letter h % length is left out. A null key is
    the text ``null``; null texts have no words.
    """
    lower = F.translate(F.col(text).cast("string"), UPPER, LOWER)
    runs = docs.select(F.col(key).cast("string").alias("key"), F.explode(F.regexp_extract_all(lower, F.lit(RUN))).alias("run"))
    hashed = F.crc32(F.concat(F.coalesce("key", F.lit("null")), F.lit(":"), "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    runs = runs.filter(F.length("run") >= shortest).withColumn("h", hashed)
    words = runs.select(F.when(F.col("h") % changed == 0, shorter).otherwise(F.col("run")).alias("word"))
    words = words.filter(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def path_nodes(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray, lows: np.ndarray, turned: bool):
    """Depths, nodes and next letters (-1: none) of words' prefixes from ``lows`` on."""
    counts = sizes - lows + 1
    depth = ragged(lows, counts)
    start = np.repeat(begins, counts)
    node = mix(span_hashes(values, start, start + depth) ^ np.uint64(1 + turned))
    following = np.append(values, 0)[start + depth].astype(np.int32)
    following[depth == np.repeat(sizes, counts)] = -1
    return depth.astype(np.int32), node.view(np.int64), following


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, words = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        sizes = np.array([len(w) for w in words], np.int64)
        group = np.cumsum(sizes) // PATH_BATCH
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            own, size = ids[rows], sizes[rows]
            values = np.frombuffer("".join(words[r] for r in rows).encode("utf-32-le"), np.uint32).astype(np.uint64)
            begins = np.cumsum(size) - size
            for turned in (False, True):
                lows = -(-size // 2) if turned else size // 2
                used = values[::-1] if turned else values
                first = len(values) - begins - size if turned else begins
                depth, node, following = path_nodes(used, first, size, lows, turned)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own, size - lows + 1)),
                        pa.array(np.full(len(depth), turned)),
                        pa.array(depth),
                        pa.array(node),
                        pa.array(following),
                    ],
                    [c.split()[0] for c in PATHS.split(", ")],
                )


def _met(states: DataFrame, table: DataFrame, hot: DataFrame) -> DataFrame:
    """States joined with the rows of a table at their node. Rows of hot nodes, which
    are few, go to all tasks, so that no task takes all states of such a node."""
    hot = F.broadcast(hot)
    few = F.broadcast(table.join(hot, "node", "left_semi"))
    rest = table.join(hot, "node", "left_anti")
    one = states.join(hot, "node", "left_semi").join(few, "node")
    return one.unionByName(states.join(hot, "node", "left_anti").join(rest, "node"))


def _cut(text: Column, begin: Column, length: Column) -> Column:
    return F.substr(text, (begin + 1).cast("int"), length.cast("int"))


def _trie(words: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Edges ``(node, label, child)``, first states ``(id, word, position, node)``, ends
    of words ``(node, turned, other)``, and the hot nodes."""
    paths = work.stored(words.select("id", "word").mapInArrow(_paths, PATHS), "paths")
    nodes = paths.groupBy("node").agg(F.min("next").alias("a"), F.max("next").alias("b"), F.count(F.lit(1)).alias("m"))
    nodes = work.stored(nodes.filter("a < b").select("node", "m"), "nodes")
    total = paths.count()
    hot = work.stored(nodes.filter(F.col("m") * HOT_SHARE >= max(total, 1)).select("node"), "hot")
    inner = paths.filter("next >= 0").select("id", "turned", "depth", "node")
    own = _met(inner, nodes.select("node"), hot)
    own = own.groupBy("id", "turned").agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("stops"))
    ends = paths.filter("next < 0").select("node", "id", "turned")
    walked = own.join(words.select("id", "word"), "id").join(ends.withColumnRenamed("node", "end"), ["id", "turned"])
    word = F.when(F.col("turned"), F.reverse("word")).otherwise(F.col("word"))
    walked = walked.select("id", word.alias("word"), "stops", "end")
    walked = work.stored(walked, "walked")
    after = F.concat(
        F.slice("stops", 2, F.greatest(F.size("stops") - 1, F.lit(0))),
        F.array(F.struct(F.length("word").alias("depth"), F.col("end").alias("node"))),
    )
    steps = F.arrays_zip(F.col("stops").alias("from"), after.alias("to"))
    edges = walked.select("word", F.explode(steps).alias("s")).select(
        F.col("s.from.node").alias("node"),
        _cut(F.col("word"), F.col("s.from.depth"), F.col("s.to.depth") - F.col("s.from.depth")).alias("label"),
        F.col("s.to.node").alias("child"),
    )
    edges = work.stored(edges.distinct(), "edges")
    first = walked.select("id", "word", F.explode("stops").alias("s"))
    first = first.select("id", "word", F.col("s.depth").alias("position"), F.col("s.node").alias("node"))
    return edges, first, ends.select("node", "turned", F.col("id").alias("other")), hot


def _edited(first: DataFrame, edges: DataFrame, hot: DataFrame) -> DataFrame:
    """States after one edit: a letter replaced by a later one, or left out. Of a run of
    equal letters the last is left out; words that are one letter longer are found from
    their own side."""
    word, place, label = F.col("word"), F.col("position"), F.col("label")
    size = F.length(label)
    here, then = _cut(word, place, F.lit(1)), _cut(word, place + 1, F.lit(1))
    replaced = (_cut(label, F.lit(0), F.lit(1)) > here) & (
        _cut(word, place + 1, size - 1) == _cut(label, F.lit(1), size - 1)
    )
    left_out = (then != here) & (_cut(word, place + 1, size) == label)
    option = lambda ok, end: F.when(ok & (end <= F.length(word)), end)
    after = F.array_compact(F.array(option(replaced, place + size), option(left_out, place + 1 + size)))
    met = _met(first, edges, hot)
    states = met.select("id", "word", F.explode(after).alias("to"), F.col("child").alias("node"), "position")
    last = first.filter(place + 1 == F.length(word)).select("id", "word", (place + 1).alias("to"), "node", "position")
    states = states.unionByName(last)
    return states.select(
        "id", "word", F.col("to").alias("position"), "node", F.lit(1).alias("edits"), F.col("position").alias("place")
    )


def near_words(words: DataFrame, work: Workspace) -> DataFrame:
    """``words(id, word, n)`` to ``(id, other_word, other_n)`` of all words one edit
    apart, each pair both ways."""
    edges, first, ends, hot = _trie(words, work)
    size, at_end = F.length("label"), F.col("position") == F.length("word")
    frontier = work.stored(_edited(first, edges, hot), "frontier")
    done = frontier.filter(at_end)
    while not frontier.filter(~at_end).isEmpty():
        spelt = _cut(F.col("word"), F.col("position"), size) == F.col("label")
        moved = _met(frontier.filter(~at_end), edges, hot).filter(spelt)
        after = (F.col("position") + size).alias("position")
        moved = moved.select("id", "word", after, F.col("child").alias("node"), "edits", "place")
        frontier = work.stored(moved, "frontier")
        done = done.unionByName(frontier.filter(at_end))
    met = done.select("id", "node", "place").join(ends, "node").select("id", "other", "turned", "place").distinct()
    others = words.select(F.col("id").alias("other"), F.col("word").alias("other_word"), F.col("n").alias("other_n"))
    met = met.join(words, "id").join(others, "other")
    one, two = (F.when(F.col("turned"), F.reverse(w)).otherwise(F.col(w)) for w in ("word", "other_word"))
    place = F.col("place")
    before, rest = _cut(one, F.lit(0), place), F.substr(one, place + 2)
    replaced = (one != two) & (two == F.concat(before, _cut(two, place, F.lit(1)), rest))
    met = met.filter(replaced | (two == F.concat(before, rest)))
    met = work.stored(met.select("id", "word", "n", "other", "other_word", "other_n"), "met")
    back = met.select(F.col("other").alias("id"), F.col("word").alias("other_word"), F.col("n").alias("other_n"))
    return met.select("id", "other_word", "other_n").unionByName(back).distinct()


def _roots(forms: DataFrame, work: Workspace) -> DataFrame:
    """``(word, root)`` of words that have a form: forms are followed to the last. Each
    step goes to a word at least some times as frequent, so the steps are few."""
    held, path = work.keep(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "roots")
    next_ = forms.select(F.col("word").alias("root"), F.col("form").alias("_next"))
    while not held.filter("open").isEmpty():
        moved = held.filter("open").join(next_, "root", "left")
        moved = moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("open"))
        after, after_path = work.keep(held.filter("NOT open").unionByName(moved), "roots")
        work.drop(path)
        held, path = after, after_path
    return held.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shortest: int = 7,
    least: int = 2,
    times: int = 10,
    work: Workspace | None = None,
) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of the words of ``counted_words``.

    Two words are near if one inserted, left out or replaced letter makes one the other;
    ``n_near`` counts a word's near words. Its ``form`` is the near word of largest n
    (ties: smallest in code-point order) if that is at least ``times`` its own n, else
    null; ``root`` follows forms to the last and is the word itself if it has none.

    Words are letters of any number; a word of many letters has few nodes. Null ids,
    repeated rows and other columns as in ``counted_words``; without words no rows.
    Nodes are 64-bit hashes; the pairs found are compared letter by letter, so equal
    hashes of different prefixes change nothing.
    """
    if not 2 <= times:
        raise ValueError("a form must be at least twice as frequent")
    spark = docs.sparkSession
    work = work or Workspace(spark, "variants")
    counted = counted_words(docs, key, text, shortest, least)
    words = work.stored(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    near = near_words(words, work).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("low"), "other_word")).alias("best")
    )
    full = words.join(near, "id", "left")
    formed = -F.col("best.low") >= times * F.col("n")
    full = full.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(formed, F.col("best.other_word")).alias("form"),
        F.when(formed, -F.col("best.low")).alias("form_n"),
    )
    full = work.stored(full, "forms")
    roots = _roots(full.filter("form IS NOT NULL"), work)
    return full.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
