"""Rows with every odd case: nulls in any column, empty and long texts, ties, repeated rows, clashing names."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, part string, fp long, quality string, size string, start string, shard string, units string, taken string"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def documents(spark, rows=None):
    """Documents with extra columns whose names the operators use themselves."""
    if rows is None:
        rows = [
            (1, "The quick brown fox jumps over the lazy dog", "en", "a"),
            (2, "the quick brown fox jumps over the lazy dog", "en", "a"),
            (2, "the quick brown fox jumps over the lazy dog", "en", "a"),
            (3, None, None, None),
            (4, "", "en", "b"),
            (5, " \t\n ", None, "b"),
            (None, "Un texte sans identité", "fr", None),
            (None, None, None, None),
            (6, "word " * 6000, "en", "c"),
            (7, "12345 !!! 678", "de", "c"),
            (8, "ÉTÉ naïve ß ﬁ 漢字 😀", "fr", "a"),
            (9, "a", "en", "b"),
            (10, "one two three", "en", "b"),
        ]
    more = ("x", "y", 7, "q", "s", "t", "h", "u", "k")
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *more) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
