"""Tables with nulls, empty and long texts, ties, repeated rows and columns that clash with results."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "long words " * 30_000
ROWS = [
    (1, "one two three four", "en", "a", 18), (None, "no id here", None, None, None), (2, None, "en", "a", 0),
    (3, "", None, "b", 0), (4, "same text twice", "en", "b", 15), (4, "same text twice", "en", "b", 15),
    (5, "same text twice", "de", None, 15), (6, LONG, "en", "a", len(LONG)), (7, " \n\t ", "en", "c", 4),
    (8, "éß 🙂 “x” <|endoftext|> don't", "fr", "c", 9),
]
#: Names that operators use for results or on the way.
CLASHES = ["score", "bucket", "place", "size", "target", "class", "token", "component_id", "_hash", "_source", "held_out", "ids", "n_tokens", "start", "bits"]


def documents(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def clashing(spark):
    return documents(spark).withColumns({c: F.lit("clash") for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check_shapes(spark, operator, columns):
    """Every row once, whatever else is in the table; nothing from nothing."""
    plain = operator(documents(spark))
    assert plain.columns[: len(columns)] == columns
    got = rows(plain)
    assert len(got) == len(ROWS)
    assert rows(operator(clashing(spark))) == got
    assert operator(empty(spark)).collect() == []
    return {r["doc_id"]: r for r in plain.collect()}
