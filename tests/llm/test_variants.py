"""Spelling variants against a plain search of all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

from support import awkward, documents

from cohortwise.llm import variants
from cohortwise.llm.common import table
from cohortwise.llm.queries import QUERIES

LOWERED = str.maketrans(variants.UPPER, variants.LOWER)


def plain(rows, shortest=7, least=2, times=10):
    """(word, form, root, n, n_near, form_n) by one pattern for each place of a word."""
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWERED)
            h = zlib.crc32(f"{'null' if key is None else key}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    near, alike = defaultdict(set), defaultdict(set)
    for word in counts:
        for i in range(len(word)):
            alike[word[:i], word[i + 1 :]].add(word)
            if (other := word[:i] + word[i + 1 :]) in counts:
                near[word].add(other)
                near[other].add(word)
    for group in alike.values():
        for word in group:
            near[word] |= group - {word}
    forms = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        if best is not None and counts[best] >= times * n:
            forms[word] = best
    out = []
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        out.append((word, forms.get(word), root, n, len(near[word]), counts.get(forms.get(word))))
    return sorted(out)


def found(docs, **options):
    rows = variants.spelling_variants(docs, **options)
    return sorted(map(tuple, rows.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_dense_words(spark):
    """Few letters, so that most words have neighbours; forms lead over several steps."""
    rnd = random.Random(3)
    rows = []
    for i in range(40):
        words = ["".join(rnd.choice("abÉ") for _ in range(rnd.randint(5, 9))) for _ in range(150)]
        rows.append((i if i % 7 else None, " ".join(words)))
    rows += [(100 + i, "Harbours " * 1500 + "harbour, " * 120 + "harbouur " * 9) for i in range(2)]
    got = found(documents(spark, rows))
    assert got == plain(rows)
    assert any(form and root != form for _, form, root, *_ in got)


def test_long_runs_of_letters(spark):
    n = 20_000
    text = " ".join(["a" * n, "a" * (n - 1), "a" * (n // 2) + "b" + "a" * (n // 2 - 1), "x" * n])
    got = found(documents(spark, [(1, text), (1, text)]))
    assert [(len(w), w[0], n_near) for w, _, _, _, n_near, _ in got] == [
        (n - 1, "a", 2), (n, "a", 2), (n, "a", 2), (n, "x", 0),
    ]


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs, shortest=3) == plain(rows, shortest=3)
    assert found(documents(spark, [])) == []
    assert found(documents(spark, [(1, None), (2, ""), (None, "short words")])) == []


def test_hot_nodes_are_broadcast(spark, monkeypatch):
    """Nodes count as hot from any share on without a change of the rows."""
    rnd = random.Random(5)
    rows = [(i, " ".join("prefix" + "".join(rnd.choice("ab") for _ in range(4)) for _ in range(80))) for i in range(10)]
    monkeypatch.setattr(variants, "HOT_SHARE", 20)
    few = found(documents(spark, rows))
    monkeypatch.setattr(variants, "HOT_SHARE", 1 << 30)
    assert found(documents(spark, rows)) == few == plain(rows)


def test_query_over_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    got = QUERIES["op13_spelling_trie"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in got) == plain(rows)
