from __future__ import annotations

from cohortwise.llm import secrets
from support import awkward, documents

KEY = "AKIA" + "A1B2C3D4E5F6G7H8"


def findings(df):
    return {
        (r["doc_id"]): [(s["kind"], s["start"], s["end"]) for s in r["findings"]]
        for r in df.select("doc_id", "findings").collect()
    }


def test_base_kinds(spark):
    rows = [
        (1, 'é password = "hunter22" and'),
        (2, f"x {KEY} y AKIASHORT1"),
        (3, "ab" * 12 + " " + "ab" * 11),
        (4, "secret: token: abcdefgh"),  # the short value takes the second word with it
        (5, "API_KEY=abc; apikey:'zzzzzz' TOKEN=aaaaaa"),
        (6, "token=" + "ab" * 12),
        (7, "ſecret=aaaaaaaa"),  # letters in either case are A-Z
        (8, None),
    ]
    out, _ = secrets.scan_versions(documents(spark, rows), ["doc_id"])
    assert findings(out) == {
        1: [("assign", 2, 22)],
        2: [("access", 2, 22)],
        3: [("hex", 0, 24)],
        4: [],
        5: [("assign", 13, 27), ("assign", 29, 41)],
        6: [("assign", 0, 30), ("hex", 6, 30)],
        7: [],
        8: [],
    }


def test_ledger_is_scanned_once(spark):
    rows = [(i, f"token=abcdef{i % 4}") for i in range(12)]
    docs = documents(spark, rows)
    out, fresh = secrets.scan_versions(docs, ["doc_id"])
    assert fresh.count() == 4 * 3  # each content and rule, not each path
    assert all(len(v) == 1 for v in findings(out).values())
    more = docs.unionByName(documents(spark, [(50, "token=abcdef9"), (51, "token=abcdef0")]))
    out, again = secrets.scan_versions(more, ["doc_id"], ledger=fresh)
    assert again.count() == 3  # one new content
    assert len(findings(out)) == 14 and all(len(v) == 1 for v in findings(out).values())
    rules = (secrets.Rule("assign", 2, lambda text, data: []), *secrets.BASE_RULES[1:])
    out, newer = secrets.scan_versions(more, ["doc_id"], ledger=fresh.unionByName(again), rules=rules)
    assert {(r["rule"], r["rule_version"]) for r in newer.collect()} == {("assign", 2)}
    assert newer.count() == 5 and not any(findings(out).values())


def test_versions_of_a_path(spark):
    rows = [(1, "token=aaaaaa"), (1, "clean"), (1, "token=aaaaaa")]
    out, fresh = secrets.scan_versions(documents(spark, rows), ["doc_id"])
    assert sorted(len(r["findings"]) for r in out.collect()) == [0, 1, 1]
    assert fresh.count() == 6


def test_awkward_rows(spark):
    docs = awkward(spark)
    out, _ = secrets.scan_versions(docs, ["doc_id", "source"])
    assert out.count() == docs.count()
    assert out.columns == ["doc_id", "source", "blob", "findings"]
    empty, fresh = secrets.scan_versions(docs.limit(0), ["doc_id"])
    assert empty.collect() == [] and fresh.collect() == []
