"""Small tables of documents for the tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """Rows (doc_id, text) or (doc_id, text, source) as a table of documents."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def clashing(frame):
    """The table with more columns, named like those the operators make for themselves."""
    names = ("id", "digest", "row", "size", "key", "shard", "slot", "range", "unit", "share", "n", "term", "score", "counts",
             "body", "signature", "length", "piece", "n_words", "copies", "_key", "_size", "block")
    return frame.selectExpr("*", *[f"{i} AS `{c}`" for i, c in enumerate(names)])
