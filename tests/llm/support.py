"""Small tables with the awkward cases that every operator must take."""

from __future__ import annotations

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, label int, component string, size int"


def documents(spark, rows):
    """``(doc_id, text)`` or ``(doc_id, text, lang, source)`` as documents, with
    further columns whose names clash with those that operators give."""
    full = [(*r, *(("en", "src0") if len(r) == 2 else ())) for r in rows]
    return spark.createDataFrame([(*r, len(r[1] or ""), 1, "x", 5) for r in full], DOCUMENTS)


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return documents(
        spark,
        [
            (1, "a plain text of some words here"),
            (2, "a plain text of some words here", None, "src1"),
            (2, "a plain text of some words here", None, "src1"),
            (3, None),
            (4, ""),
            (5, "  \t\n "),
            (6, long, "de", None),
            (7, long + " more", "de", None),
            (8, "one"),
            (9, "one two"),
            (None, "a text without an id", None, None),
            (10, "Été à l'école ▁ 東京 🙂\x00", "fr", "src2"),
        ],
    )
