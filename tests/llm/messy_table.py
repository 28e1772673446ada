"""A small table with everything that may go wrong in one."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        T.StructField("kept", T.StringType()),
        T.StructField("_hash", T.LongType()),
        T.StructField("copy_no", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("_c0", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)
ROW = ("x", 1, "c", "d", "e", 0.5)
PROSE = "the quick brown fox jumps over the lazy dog near the old river bank today"


def messy_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, odd characters."""
    long = " ".join(f"word{i} von der" for i in range(30_000))
    return [
        (1, PROSE, "en", "a", 10, *ROW),
        (2, PROSE.upper(), "en", "a", 10, *ROW),
        (3, PROSE, "en", "b", 10, *ROW),
        (3, PROSE, "en", "b", 10, *ROW),
        (4, "", "en", "b", 0, *ROW),
        (5, None, "de", None, None, *ROW),
        (6, " \t\n ", None, None, 4, *ROW),
        (7, "Straße ÄÖÜ Ünïcödé 的 语言 \U0001f600 é  x", "de", "a", 5, *ROW),
        (8, long, "de", "c", 9, *ROW),
        (None, PROSE, None, None, None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None, None, None, None),
        (9, "a\nb\na\n\n\nb\n$$$ ### %%%", "en", "c", 3, *ROW),
        (10, "lonely", "en", "c", 3, *ROW),
    ]
