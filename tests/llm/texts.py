"""Rows that every operator must stand."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, text2 string, size bigint, id bigint"

LONG = "lorem ipsum dolor sit amet " * 8000

EDGES = [
    (1, "the same text", "en", "a", 13, None, 1, 1),
    (2, "the same text", "en", "b", 13, None, 2, 2),
    (3, None, None, None, None, None, None, None),
    (4, "", "en", "a", 0, "", 0, 0),
    (5, " \n\t ", "en", None, 4, "", 0, 0),
    (6, LONG, "de", "a", len(LONG), "x", 9, 9),
    (7, "ünïcödé 漢字 🎉 \x00 end", "de", "c", 5, "x", 9, 9),
    (None, "without an id", "en", "a", 1, None, None, None),
    (None, "the same text", "en", None, 1, None, None, None),
    (8, "a repeated row", "en", "a", 1, None, None, None),
    (8, "a repeated row", "en", "a", 1, None, None, None),
    (8, "another text of the same id", "en", "c", 1, None, None, None),
]


def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def frame(spark, rows, schema="doc_id bigint, text string, source string"):
    return spark.createDataFrame(rows, schema)
