"""Alignment against both libraries, text by text."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from support import awkward, documents
from tokenizers import Tokenizer

from cohortwise.llm import alignment, spans
from cohortwise.llm.common import table
from cohortwise.llm.queries import QUERIES


@pytest.fixture(scope="module")
def plain():
    """Rows of ``align`` for texts, and the counts of pairs, by the libraries."""
    vocab = alignment.load_vocabularies()
    a, b = Tokenizer.from_file(alignment.MERGES), sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL)
    a.encode_special_tokens = True

    def groups(text):
        if not text:
            return []
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts = [[vocab.merges.tokens[i] for i in ids[0]], [vocab.pieces[i] for i in ids[1]]]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            return []
        found, now, at = [], ([], []), [0, 0]
        queues = [list(zip(i, map(len, p))) for i, p in zip(ids, parts)]
        while queues[0] or queues[1]:
            side = 0 if at[0] <= at[1] else 1
            token, size = queues[side].pop(0)
            now[side].append(token)
            at[side] += size
            if at[0] == at[1]:
                found.append(now)
                now = ([], [])
        return found

    def run(rows):
        cut = [groups(text) for _, text in rows]
        counts = Counter(p for g in cut for p in {(x, y) for one, two in g for x in one for y in two})
        most = defaultdict(int)
        for (x, _), n in counts.items():
            most[x] = max(most[x], n)
        out = []
        for (doc, _), g in zip(rows, cut):
            links = [(x, y) for one, two in g for x in one for y in two]
            line = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, two)) for one, two in g)
            out.append(
                (
                    doc,
                    sum(len(one) for one, _ in g),
                    sum(len(two) for _, two in g),
                    len(g),
                    len(links),
                    sum(counts[p] == most[p[0]] for p in links),
                    sum(counts[p] for p in links),
                    hashlib.sha256(line.encode()).hexdigest() if g else "",
                )
            )
        return out, counts

    return run


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


def random_rows(n, seed):
    rnd = random.Random(seed)
    words = ["the", "of", "Unbeknownst", "naïve", "東京都", "🙂🙂", "<s>", "</s>", "<unk>", "<|endoftext|>", "x'll"]
    words += ["".join(rnd.choice("abcdeé'1 ") for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", "\n \n", "\t", " ", "\x01", "\r\n", "<0x0A>", "　"]
    return [
        (i, "".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.randint(1, 40)))) for i in range(n)
    ]


@pytest.mark.parametrize("frequent", [0, 50, 1 << 17])
def test_random_texts(spark, plain, monkeypatch, frequent):
    """Also with small memories, parts and blocks, and whatever is broadcast."""
    rows = [*random_rows(150, 3), (900, "blank ▁ mark"), (901, "a" * 3000), (902, " "), (903, "\n"), (904, "\x00 a")]
    if frequent == 50:
        monkeypatch.setattr(spans.parts, "__defaults__", (50,))
        monkeypatch.setattr(spans.blocks, "__defaults__", (70,))
    want, counts = plain(rows)
    got, pairs = alignment.align(documents(spark, rows), frequent=frequent)
    assert by_text(got.collect()) == by_text(want)
    assert {(r.a, r.b): r.n for r in pairs.collect()} == counts


def test_one_text_at_a_time(plain):
    rows = random_rows(30, 4)
    aligner = alignment.Aligner(alignment.load_vocabularies(), True)
    want = plain(rows)[0]
    for (_, text), row in zip(rows, want):
        numbers, counts = aligner.units([text])
        sizes = aligner.sizes[numbers].sum(axis=0)
        if not aligner.broken[numbers].any():
            assert tuple(sizes) == row[1:5] and counts[0] == len(numbers)
        aligner.forget()


def test_large_groups_are_multiplied(plain, monkeypatch):
    rows = random_rows(40, 5)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 3)
    aligner = alignment.Aligner(alignment.load_vocabularies(), False)
    numbers, counts = alignment._unbroken(aligner, *aligner.units([t for _, t in rows]))
    place, codes, _ = aligner.by_text(numbers, counts)
    found = Counter()
    for c in codes.tolist():
        pair = divmod(int(aligner.met[c - aligner.size_a]), aligner.vocab.size_b) if c >= aligner.size_a else (
            c, int(aligner.vocab.same[c]))
        found[pair] += 1
    assert found == plain(rows)[1]


def test_awkward_rows(spark, plain):
    docs = awkward(spark)
    got, _ = alignment.align(docs, frequent=10)
    assert by_text(got.collect()) == by_text(plain([(r.doc_id, r.text) for r in docs.collect()])[0])
    empty, pairs = alignment.align(documents(spark, []))
    assert empty.count() == 0 and pairs.count() == 0


def test_query_over_whole_table(spark, sf_dir, plain):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    assert by_text(QUERIES["op12_token_alignment"](spark, sf_dir).collect()) == by_text(plain(rows)[0])
