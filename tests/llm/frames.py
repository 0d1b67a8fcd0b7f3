"""Small frames for the corpus tests."""

from __future__ import annotations

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for themselves.
CLASHING = ["cell", "rank", "key", "node", "block", "slot", "shard", "text_hash", "Lang_Pred", "score", "tree", "w", "n",
            "key1", "partition", "phase", "mix_position", "rep_id", "predicted", "got", "source_no"]


def words(rng, n: int, size: int = 400) -> str:
    return " ".join(f"w{x}" for x in rng.integers(0, size, n))


def docs(spark, rows):
    """rows: (doc_id, text[, source[, lang]])."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s0", len(r[1]) if r[1] is not None else None)
            for r in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    """Nulls in any column, empty, wordless, very long and repeated texts."""
    return [(1, None, "s1", "en"), (2, "", "s1", "en"), (3, "", "s1", "en"), (4, "?!? ... ---", "s1", "en"), (None, "one two three four five six", "s2", "en"),
            (6, "one two three four five six", None, None), (7, "short text", "s2", "en"), (7, "short text", "s2", "en"),
            (8, "x" * 50_000 + " tail", "s2", "de"), (9, "the cat and the dog " * 4_000, "s2", "en"),
            (10, "\u0000퟿ \U0001f600 été", "s3", "fr"), (None, None, None, None)]


def with_clashes(df):
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})
