from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import corpus_pipeline as pipeline
from cohortwise.llm import pieces, queries
from support import awkward

TABLE = pieces.load_pieces()


def every(text):
    """All segmentations, best first."""
    word, out = b" " + text.encode(), []

    def go(end, ids, score):
        if not end:
            out.append((score, tuple(ids[::-1])))
            return
        for start, i, s in pieces.edges_before(TABLE, word, end):
            go(start, [*ids, i], score + s)

    go(len(word), [], 0.0)
    return sorted(out, reverse=True)


def ids_and_scores(found):
    return [(found.ids_of(i).tolist(), scores) for i, scores in enumerate(found.scores)]


@pytest.mark.parametrize("text", ["the cat", "a b", " hi", "x\ny", "é▁ü", "aa  bb", "zq", "\n"])
def test_n_best_equals_all_paths(text):
    best = 6
    found = pieces.Encoder(TABLE, best).block([text])
    ids, scores, changes = found.ids, found.scores[0], found.changes[0]
    want = every(text)[:best]
    assert pieces.decode(TABLE, ids) == text and found.returns.tolist() == [True]
    assert np.allclose(scores, [s for s, _ in want])
    assert len(scores) == len(changes) + 1
    assert np.isclose(sum(TABLE.scores[ids]), want[0][0])


def test_a_star_gives_paths_in_order():
    word = b" station"
    found = pieces.n_best(TABLE, word, 10)
    want = every("station")[:10]
    assert np.allclose([s for s, _ in found], [s for s, _ in want])
    assert len({ids for _, ids in found}) == 10
    assert all(b"".join(TABLE.pieces[i] for i in ids) == word for _, ids in found)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=6))
def test_round_trip(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    found = pieces.Encoder(TABLE, 3).block(texts)
    assert found.returns.all() and len(found.returns) == len(texts)
    for i, text in enumerate(texts):
        assert pieces.decode(TABLE, found.ids_of(i)) == text
        assert found.scores[i] == sorted(found.scores[i], reverse=True)


def test_memory_does_not_matter(monkeypatch):
    texts = [f"some words {i} and words{i % 5} again" for i in range(60)]
    one = ids_and_scores(pieces.Encoder(TABLE, 4).block(texts))
    monkeypatch.setattr(pieces, "WORD_MEMORY", 20)
    encoder = pieces.Encoder(TABLE, 4)
    two = [x for a in range(0, 60, 7) for x in ids_and_scores(encoder.block(texts[a : a + 7]))]
    assert [x[0] for x in one] == [x[0] for x in two] and np.allclose([x[1][-1] for x in one], [x[1][-1] for x in two])


def test_long_words_equal_short_ones(monkeypatch):
    texts = ["internationalisation antidisestablishmentarianism " * 2, "x" * 300, "ab" * 400 + " tail"]
    one = ids_and_scores(pieces.Encoder(TABLE, 3).block(texts))
    monkeypatch.setattr(pieces, "LONG_WORD", 4)
    two = ids_and_scores(pieces.Encoder(TABLE, 3).block(texts))
    assert [x[0] for x in one] == [x[0] for x in two]
    assert all(np.allclose(a[1], b[1]) for a, b in zip(one, two))


def test_a_changed_text_is_told():
    encoder = pieces.Encoder(TABLE, 2)
    found = encoder.block(["one two", "", "three"])
    data = np.frombuffer(b" one twx three", np.uint8)
    edges = np.array([0, 8, 8, 14])
    assert encoder._returns(found.ids, found.stops, data, edges).tolist() == [False, True, True]


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefghijklmnopqrstuvwxyz0123456789+/"])
def test_long_run_without_blanks(letters):
    """100,000 letters within a gigabyte; the first paths differ and spell the word."""
    rng = random.Random(1)
    word = " " + "".join(rng.choice(letters) for _ in range(100_000))
    tracemalloc.start()
    found = pieces.n_best(TABLE, word.encode(), 4)
    assert tracemalloc.get_traced_memory()[1] < 1 << 29
    tracemalloc.stop()
    assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)
    assert len({ids for _, ids in found}) == 4
    assert all(b"".join(TABLE.pieces[i] for i in ids) == word.encode() for _, ids in found)


def test_further_segmentations_differ_from_the_best():
    """Also where several have the best score."""
    found = pieces.Encoder(TABLE, 4).block(["aaaaaaaaaaa", "aaaa aaaa"])
    for i in range(2):
        words = {tuple(map(tuple, way)) for way in found.changes[i]}
        assert len(words) == len(found.changes[i]) == 3


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = pieces.encode(docs).collect()
    assert len(out) == docs.count() and all(r["decoded"] for r in out)
    by = {r["doc_id"]: r for r in out}
    assert by[3]["n_pieces"] == by[4]["n_pieces"] == 0 and by[3]["scores"] == [0.0]
    assert len(by[6]["ids"]) == by[6]["n_pieces"] > 30_000
    assert all(len(r["changes"]) == len(r["scores"]) - 1 for r in out)
    assert pieces.encode(docs.limit(0)).collect() == []


@pytest.mark.parametrize("of", ["query", "stage"])
def test_whole_segmentations_are_returned(spark, tmp_path, of):
    """The written ids decode to the texts, and the further ones to the same words."""
    awkward(spark).dropDuplicates(["doc_id"]).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    encode = {
        "query": lambda: queries.QUERIES["op9_nbest_pieces"](spark, str(tmp_path)),
        "stage": lambda: pipeline.encoded(spark, docs, str(tmp_path)),
    }
    encode[of]().write.parquet(f"{tmp_path}/out")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    out = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(out) == len(texts)
    for r in out:
        text = texts[r["doc_id"]]
        assert pieces.decode(TABLE, r["ids"]) == text and r["decoded"]
        assert len(r["changes"]) == len(r["scores"]) - 1
        raw = b" " + text.encode() if text else b""
        encoder = pieces.Encoder(TABLE, 4)
        starts = encoder._cut(np.frombuffer(raw, np.uint8), np.zeros(1, np.int64)).tolist() if raw else []
        words = [raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)])]
        for score, changes in zip(r["scores"][1:], r["changes"]):
            assert changes and score <= r["scores"][0]
            for c in changes:
                assert b"".join(TABLE.pieces[i] for i in c["ids"]) == words[c["word"]]
