"""Scores of whole documents by a gated recurrent language model.

The model reads the most frequent training words and one sign for all others. Its
output softmax is factored: first the class of the next word, then the word
within its class. It is trained in numpy by truncated backpropagation: state is
carried from window to window, gradients are not. Words outside the model's list
get the probability of the sign times their smoothed share of the rest, so every
text has a proper probability.

Counts and gradient steps cover all training documents. Every round runs on all executors:
a task learns from its documents alone, starting at the common weights, and the
weights are averaged by tokens, summed by place in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortwise.llm.common import Workspace, word_hashes

# Words of the model, size of the classes, and width of the state.
MODEL_WORDS = 2048
CLASS_SIZE = 64
STATE = 16
# Most frequent words whose counts go to every task; all others are joined.
COMMON_WORDS = 1 << 18
# Steps of a window, and documents read side by side.
WINDOW = 32
TRAIN_ROWS = 128
SCORE_ROWS = 1024
SCORE_TOKENS = 16384
# Tokens after which a training text goes on as a stream of its own.
TRAIN_LENGTH = 512
# Rounds of averaging. Round r learns from the documents whose share number is r;
# there are as many shares as rounds, so that every document is learned from once.
ROUNDS = 2
SHARES = ROUNDS
RATE = 0.08
SEED = 5
LARGEST_WEIGHT = 3.0
# Word counts that a task holds before it hands them on.
HELD_TOKENS = 4_000_000
# The hash that stands for the end of a text; words are hashed, too.
END = np.uint64(0x9E3779B97F4A7C15)


def token_hashes(text: str | None) -> np.ndarray:
    return np.append(word_hashes(text), END)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush():
        words, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "c"])

    for batch in batches:
        for text in batch.column(0):
            held.append(token_hashes(text.as_py()))
            size += len(held[-1])
            if size >= HELD_TOKENS:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


@dataclass
class Vocabulary:
    """The common words, by falling count."""

    hashes: np.ndarray
    counts: np.ndarray
    total: int  # all training tokens
    distinct: int  # all distinct training tokens

    def __post_init__(self):
        # Ranks by the leading bits of the hash: most words are found at once.
        bits = len(self.hashes).bit_length() + 2
        self.shift = np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, np.int32)
        self.slots[(self.hashes >> self.shift).astype(np.int64)[::-1]] = np.arange(len(self.hashes))[::-1]
        self.order = np.argsort(self.hashes)
        self.sorted = self.hashes[self.order]
        self.model = min(MODEL_WORDS, len(self.hashes))
        listed = int(self.counts[: self.model].sum())
        self.rest_tokens = self.total - listed
        self.rest_words = self.distinct - self.model

    def find(self, words: np.ndarray) -> np.ndarray:
        """Rank of each word, -1 for words that are not common."""
        if not len(self.sorted):
            return np.full(len(words), -1)
        ranks = self.slots[(words >> self.shift).astype(np.int64)].astype(np.int64)
        missed = np.flatnonzero(self.hashes[ranks] != words)
        at = np.minimum(np.searchsorted(self.sorted, words[missed]), len(self.sorted) - 1)
        ranks[missed] = np.where(self.sorted[at] == words[missed], self.order[at], -1)
        return ranks

    def model_ids(self, ranks: np.ndarray) -> np.ndarray:
        """0 for words outside the model's list, else rank + 1."""
        return np.where((ranks >= 0) & (ranks < self.model), ranks + 1, 0)

    def base(self, counts):
        return np.log10((counts + 1) / (self.total + self.distinct + 1))

    def rest(self, counts):
        """log10 share of a word among those outside the list; never-seen words
        share the place of one."""
        return np.log10((counts + 1) / (self.rest_tokens + self.rest_words + 1))


class Model:
    """Weights, forward pass and truncated backpropagation."""

    NAMES = ("x", "u", "wc", "bc", "wi", "bi")

    def __init__(self, counts: np.ndarray, rest: int):
        """Starts at the counts: outputs without state give each word its share."""
        rng = np.random.default_rng(SEED)
        self.words = len(counts)
        self.classes = 1 + -(-self.words // CLASS_SIZE)
        self.x = (0.1 * rng.standard_normal((self.words + 1, 3 * STATE))).astype(np.float32)
        self.x[:, :STATE] += 1.0  # at first, states are kept longer
        self.u = (rng.standard_normal((STATE, 3 * STATE)) / np.sqrt(STATE)).astype(np.float32)
        self.wc = np.zeros((STATE, self.classes), np.float32)
        self.wi = np.zeros((self.classes, STATE, CLASS_SIZE), np.float32)
        shares = np.zeros((self.classes, CLASS_SIZE))
        shares[1:].ravel()[: self.words] = counts + 1
        mass = shares.sum(axis=1)
        mass[0] = rest + 1
        self.bc = np.log(mass / mass.sum()).astype(np.float32)
        inside = np.full(shares.shape, -30.0)
        np.log(shares / np.maximum(mass, 1)[:, None], out=inside, where=shares > 0)
        self.bi = inside.astype(np.float32)

    def values(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.NAMES]

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.values()])

    def load(self, flat: np.ndarray) -> Model:
        at = 0
        for v in self.values():
            v[...] = flat[at : at + v.size].reshape(v.shape)
            at += v.size
        return self

    def step(self, gates: np.ndarray, state: np.ndarray) -> tuple:
        """The next state from the rows of ``x`` of the words read and the state."""
        from_state = state @ self.u
        zr = gates[:, : 2 * STATE] + from_state[:, : 2 * STATE]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r = zr[:, :STATE], zr[:, STATE:]
        part = from_state[:, 2 * STATE :]
        new = r * part
        new += gates[:, 2 * STATE :]
        np.tanh(new, out=new)
        after = state - new
        after *= z
        after += new
        return after, zr, new, part

    def outputs(self, states: np.ndarray, goals: np.ndarray, grads: list[np.ndarray] | None = None):
        """Natural log probability of each goal; with ``grads``, also adds the
        weights' gradients and gives those of the states."""
        of, place = (goals - 1) // CLASS_SIZE + 1, (goals - 1) % CLASS_SIZE
        of[goals == 0] = 0
        rows = np.arange(len(goals))
        logits = states @ self.wc
        logits += self.bc
        found = logits[rows, of]
        share = np.exp(logits, out=logits)
        total = share.sum(axis=1, keepdims=True)
        found -= np.log(total[:, 0])
        back = None
        if grads is not None:
            share /= total
            share[rows, of] -= 1
            grads[2] += states.T @ share
            grads[3] += share.sum(axis=0)
            back = share @ self.wc.T
        order = np.argsort(of.astype(np.int16), kind="stable")
        ends = np.searchsorted(of[order], np.arange(self.classes + 1))
        sorted_states, sorted_place = states[order], place[order]
        inside = np.zeros(len(goals), found.dtype)
        further = None if grads is None else np.zeros_like(sorted_states)
        for c in range(1, self.classes):
            a, b = ends[c], ends[c + 1]
            if a == b:
                continue
            own, goal, local = sorted_states[a:b], sorted_place[a:b], rows[: b - a]
            inner = own @ self.wi[c]
            inner += self.bi[c]
            reached = inner[local, goal]
            share = np.exp(inner, out=inner)
            total = share.sum(axis=1, keepdims=True)
            inside[a:b] = reached - np.log(total[:, 0])
            if grads is not None:
                share /= total
                share[local, goal] -= 1
                grads[4][c] += own.T @ share
                grads[5][c] += share.sum(axis=0)
                further[a:b] = share @ self.wi[c].T
        found[order] += inside
        if grads is not None:
            back[order] += further
        return found, back


def _batches(texts: list[np.ndarray], rows: int) -> Iterator[list[int]]:
    """Numbers of texts to be read side by side: of similar length, longest first."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    for a in range(0, len(order), rows):
        yield order[a : a + rows]


def _grid(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts (longest first) as columns of a table, and how many reach each row."""
    lengths = np.array([len(t) for t in texts])
    table = np.zeros((lengths[0], len(texts)), np.int32)
    for i, t in enumerate(texts):
        table[: len(t), i] = t
    return table, np.searchsorted(-lengths, -np.arange(lengths[0]), "left")


def log_scores(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each whole text. The state goes on from window to
    window, to the text's end; a window holds ``SCORE_TOKENS`` tokens of all texts."""
    out = np.zeros(len(texts))
    for rows in _batches(texts, SCORE_ROWS):
        table, alive = _grid([texts[i] for i in rows])
        state, ids = np.zeros((len(rows), STATE), np.float32), np.zeros(len(rows), np.int32)
        sums, states, goals, owner, held = np.zeros(len(rows)), [], [], [], 0
        for t in range(len(table)):
            n = alive[t]
            state = model.step(model.x[ids[:n]], state[:n])[0]
            ids = table[t, :n]
            states.append(state)
            goals.append(ids)
            owner.append(np.arange(n))
            held += n
            if held >= SCORE_TOKENS or t == len(table) - 1:
                found, _ = model.outputs(np.concatenate(states), np.concatenate(goals))
                sums += np.bincount(np.concatenate(owner), found, len(rows))
                states, goals, owner, held = [], [], [], 0
        out[rows] = sums
    return out


def train(model: Model, texts: list[np.ndarray], memory: list[np.ndarray], rate: float = RATE) -> None:
    """One pass over the texts by Adagrad; ``memory`` holds its squared gradients.
    All tokens are learned from; texts go on as new streams after ``TRAIN_LENGTH``."""
    texts = [t[a : a + TRAIN_LENGTH] for t in texts for a in range(0, len(t), TRAIN_LENGTH)]
    for rows in _batches(texts, TRAIN_ROWS):
        table, alive = _grid([texts[i] for i in rows])
        state, ids = np.zeros((len(rows), STATE), np.float32), np.zeros(len(rows), np.int32)
        for a in range(0, len(table), WINDOW):
            lengths = alive[a : a + WINDOW]
            ends = np.cumsum(lengths)
            spans = [slice(e - n, e) for e, n in zip(ends, lengths)]
            goals = np.concatenate([table[a + k, :n] for k, n in enumerate(lengths)])
            read = np.concatenate([ids[: lengths[0]], *[table[a + k - 1, :n] for k, n in enumerate(lengths) if k]])
            ids = table[a + len(lengths) - 1]
            gates, size = model.x[read], (ends[-1], STATE)
            before, states, new, part = (np.empty(size, gates.dtype) for _ in range(4))
            zr = np.empty((ends[-1], 2 * STATE), gates.dtype)
            for at, n in zip(spans, lengths):
                before[at] = state[:n]
                state, zr[at], new[at], part[at] = model.step(gates[at], before[at])
                states[at] = state
            grads = [np.zeros((0, 3 * STATE), np.float32), *[np.zeros_like(v) for v in model.values()[1:]]]
            _, back = model.outputs(states, goals, grads)
            # What a state's gradient is multiplied by on its way to each gate.
            z, r = zr[:, :STATE], zr[:, STATE:]
            to_new = (1 - z) * (1 - new * new)
            to_z = (before - new) * z * (1 - z)
            to_r = to_new * part * r * (1 - r)
            moved, later = np.empty_like(gates), np.zeros((0, STATE), gates.dtype)
            d_u = np.empty_like(gates)
            for at in reversed(spans):
                d = back[at]
                d[: len(later)] += later
                np.multiply(d, to_z[at], out=d_u[at, :STATE])
                np.multiply(d, to_r[at], out=d_u[at, STATE : 2 * STATE])
                np.multiply(d, to_new[at], out=moved[at, 2 * STATE :])
                np.multiply(moved[at, 2 * STATE :], r[at], out=d_u[at, 2 * STATE :])
                later = d_u[at] @ model.u.T
                later += d * z[at]
            moved[:, : 2 * STATE] = d_u[:, : 2 * STATE]
            grads[1] += before.T @ d_u
            order = np.argsort(read, kind="stable")
            starts = np.flatnonzero(np.diff(read[order], prepend=-1))
            touched = read[order[starts]]
            grads[0] = np.add.reduceat(moved[order], starts, axis=0)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads)) / len(read)
            scale = min(1.0, 0.5 / max(norm, 1e-9)) / len(read)
            for name, v, g, m in zip(model.NAMES, model.values(), grads, memory):
                g *= scale
                if name == "x":  # only the words that were read
                    m[touched] += g * g
                    v[touched] -= rate * g / (np.sqrt(m[touched]) + 1e-4)
                else:
                    m += g * g
                    v -= rate * g / (np.sqrt(m) + 1e-4)
                if name in ("wc", "wi"):  # states lie in (-1, 1): exponents stay in range
                    np.clip(v, -LARGEST_WEIGHT, LARGEST_WEIGHT, out=v)


def _learner(model: Broadcast, vocabulary: Broadcast):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        own = Model(words.counts[: words.model], words.rest_tokens).load(model.value)
        memory, seen = [np.full_like(v, 1e-6) for v in own.values()], 0
        for batch in batches:
            texts = []
            for text in batch.column(0):
                texts.append(words.model_ids(words.find(token_hashes(text.as_py()))))
                seen += len(texts[-1])
            if texts:
                train(own, texts, memory)
        if seen:
            flat = own.flat().astype(np.float64) * seen
            places = np.arange(len(flat) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(flat, seen))], ["place", "value"])

    return learn


def _scorer(model: Broadcast, vocabulary: Broadcast):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        own = Model(words.counts[: words.model], words.rest_tokens).load(model.value)
        for batch in batches:
            ids, n, known, base, rest, far, far_n = [], [], [], [], [], [], []
            for text in batch.column(1):
                tokens = token_hashes(text.as_py())
                ranks = words.find(tokens)
                common = ranks >= 0
                counts = words.counts[ranks[common]]
                ids.append(words.model_ids(ranks))
                n.append(len(tokens))
                known.append(int(common.sum()))
                base.append(float(words.base(counts).sum()))
                rest.append(float(words.rest(counts[ranks[common] >= words.model]).sum()))
                other, times = np.unique(tokens[~common], return_counts=True)
                far.append(other.view(np.int64))
                far_n.append(times.astype(np.int64))
            scores = log_scores(own, ids) / np.log(10) + np.array(rest)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in far])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(base, pa.float64()),
                    pa.array(scores, pa.float64()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(far))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(far_n))),
                ],
                ["doc_id", "n_tokens", "n_known", "base_score", "score", "far", "far_n"],
            )

    return score


SCORED = (
    "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double, "
    "far array<bigint>, far_n array<bigint>"
)


def _common(counted: DataFrame, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most frequent words, ``COMMON_WORDS`` at most, by
    falling count. A histogram of the counts (a few hundred steps) tells from which
    count on words are so few; only these reach the driver."""
    least = 0
    if distinct > COMMON_WORDS:
        step = F.floor(F.log2("c") * 16).cast("int")
        steps = counted.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()
        above, least = 0, float("inf")
        for r in sorted(steps, key=lambda r: -r["s"]):
            above += r["n"]
            if above > COMMON_WORDS:
                break
            least = r["least"]
    top = counted.filter(F.col("c") >= F.lit(least)).toArrow()
    words, counts = top.column("word").to_numpy().view(np.uint64), top.column("c").to_numpy()
    order = np.lexsort((words, -counts))
    return words[order], counts[order]


def model_scores(
    docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", work: Workspace | None = None
) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    Tokens are the words of the whole text in lower case and one end. ``learn``
    (over ``doc_id``) selects the documents that counts and model learn from.
    ``base_score`` is the add-one unigram score, ``score`` the model's, both log10.

    Counts cover all training documents, and so do the rounds of gradient steps
    together: each reads the documents that a hash of the id assigns to it, whole,
    and every document is in one round. Null and empty texts have the end alone;
    null ids are rows of their own; repeated rows are scored each, and learned
    from each. Without training documents every word is unknown. An empty table
    gives no rows. Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    work = work or Workspace(spark, "recurrent")
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    used = rows.filter(F.coalesce(learn, F.lit(False)))
    counted = used.select("text").mapInArrow(_counts, "word bigint, c bigint").groupBy("word").agg(F.sum("c").alias("c"))
    counted = work.stored(counted, "words")
    total, distinct = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    vocabulary = Vocabulary(*_common(counted, int(distinct)), int(total), int(distinct))
    words = spark.sparkContext.broadcast(vocabulary)
    weights = Model(vocabulary.counts[: vocabulary.model], vocabulary.rest_tokens).flat()
    share = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(SHARES))
    for turn in range(ROUNDS if total else 0):
        start = spark.sparkContext.broadcast(weights)
        part = used.filter(share == turn).select("text")
        learned = part.mapInArrow(_learner(start, words), "place bigint, value double")
        sums = learned.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
        if sums.num_rows:
            flat = np.empty(len(weights) + 1)
            flat[sums.column("place").to_numpy()] = sums.column("value").to_numpy()
            weights = (flat[:-1] / flat[-1]).astype(np.float32)
    trained = spark.sparkContext.broadcast(weights)
    scored = work.stored(
        rows.mapInArrow(_scorer(trained, words), SCORED).withColumn("_row", F.monotonically_increasing_id()), "scored"
    )
    # Words that are not common: their counts come by a join.
    far = scored.select("_row", F.explode(F.arrays_zip("far", "far_n")).alias("w"))
    far = far.select("_row", F.col("w.far").alias("word"), F.col("w.far_n").alias("times"))
    far = far.join(counted, "word", "left")
    seen = F.coalesce("c", F.lit(0))
    base = F.log10((seen + 1) / F.lit(float(total + distinct + 1)))
    rest = F.log10((seen + 1) / F.lit(float(vocabulary.rest_tokens + vocabulary.rest_words + 1)))
    far = far.groupBy("_row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times"))).alias("_known"),
        F.sum(F.col("times") * base).alias("_base"),
        F.sum(F.col("times") * rest).alias("_rest"),
    )
    out = scored.drop("far", "far_n").join(far, "_row", "left")
    return out.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("_rest", F.lit(0.0))).alias("score"),
    )
