"""Rows for edge cases that every operator must take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, row string, label long"


def docs(spark, rows):
    """Documents from (doc_id, text), with null and clashing extra columns."""
    return spark.createDataFrame([(i, t, None, "s", len(t or ""), "k", None, 1) for i, t in rows], SCHEMA)


EDGE = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two"),
    (5, "one two"),
    (5, "one two"),
    (None, "one two"),
    (6, "word " * 30_000),
    (7, "é ü — ok\n" * 50),
]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
