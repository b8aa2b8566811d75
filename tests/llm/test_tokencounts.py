"""Token counts against the library that the vocabulary file belongs to."""

from __future__ import annotations

import random

import numpy as np
import pytest
from support import awkward, documents
from tokenizers import Tokenizer

from cohortwise.llm import bytepairs, spans, tokencounts
from cohortwise.llm.common import table
from cohortwise.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bytepairs.MERGES)


@pytest.fixture(scope="module")
def merges():
    return bytepairs.load_merges()


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_random_texts(library, merges):
    rnd = random.Random(7)
    letters = "aabst'  \n\t1é東 !smdrevl 　🙂AB\x1ć٣"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["I'll've it's 'south ''s 5's\n's'", " ", "  ", "\n\n a", "'", "'r", "x'"]
    counted = tokencounts.Counter(merges).count(texts)
    assert counted.tolist() == [expected(library, t) for t in texts]


def test_special_strings_and_long_runs(library, merges):
    rnd = random.Random(8)
    texts = [
        "<|endoftext|>" * 3,
        "a  <|endoftext|>  b <|endoftext",
        "a" * 5000,
        "ab" * 3000 + "xyzzy" * 1000,
        "".join(rnd.choice("abcdefgh") for _ in range(20_000)),
        "".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(2000)),
    ]
    assert tokencounts.Counter(merges).count(texts).tolist() == [expected(library, t) for t in texts]


def test_ids_of_merged_sequences(library, merges):
    words = [b" running", b"aaaaaaa", b"\xff\xfe", b"", b"Uncharacteristically", b"x"]
    data = np.frombuffer(b"".join(words), np.uint8)
    ids, counts = bytepairs.merged(merges, data, np.array([len(w) for w in words]))
    own = np.split(ids, np.cumsum(counts)[:-1])
    assert [b"".join(merges.tokens[i] for i in o) for o in own] == words
    for word, o in zip(words, own):
        assert bytepairs.merged_long(merges, np.frombuffer(word, np.uint8)).tolist() == o.tolist() if word else not len(o)
    assert own[0].tolist() == library.encode(" running").ids


def test_parts_do_not_change_the_count(library, merges, monkeypatch):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("ab  \n'st") for _ in range(400)) for _ in range(40)]
    monkeypatch.setattr(spans.parts, "__defaults__", (20,))
    monkeypatch.setattr(spans.blocks, "__defaults__", (20,))
    monkeypatch.setattr(tokencounts, "MEMORY_BYTES", 50)
    assert all("".join(spans.parts(t)) == t for t in texts)
    assert tokencounts.Counter(merges).count(texts).tolist() == [expected(library, t) for t in texts]


def test_awkward_rows(spark, library):
    docs = awkward(spark)
    rows = tokencounts.token_counts(docs, limit=8).collect()
    want = [
        (r.doc_id, len((r.text or "").encode()), (n := expected(library, r.text)), n > 8) for r in docs.collect()
    ]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert tokencounts.token_counts(documents(spark, [])).count() == 0


def test_query_over_whole_table(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op11_token_counts"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = expected(library, texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 1024)


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError):
        bytepairs.load_merges("/opt/tokenizers/word_bpe_49k.json")
