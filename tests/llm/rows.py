"""Small tables with the cases every operator must stand."""

from __future__ import annotations

EXTRA = "lang string, source string, n_chars long, score double, key long, word string, size int, digest string, shard int"
LONG = "lorem ipsum dolor sit amet " * 5_000


def documents(spark, *rows: tuple):
    """Rows (doc_id, text[, lang]) with more columns, of names that operators use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 1, 0.25, 7, "w", 3, "d", 2) for r in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, {EXTRA}")


def hard(spark):
    """Null ids and texts, empty, blank and very long texts, repeated rows, letters beyond ASCII, no letters."""
    return documents(
        spark,
        (1, None),
        (2, ""),
        (3, " \t\n\x0b "),
        (4, LONG),
        (5, LONG.upper()),
        (6, "a b c d e f g"),
        (6, "a b c d e f g"),
        (None, "a b c d e f g"),
        (None, None),
        (7, "É é ΣΑΣ İ 漢字 🙂 \x00 <|endoftext|> ▁x▁"),
        (8, "12 34 !!"),
        (9, "x" * 40_000, None),
    )
