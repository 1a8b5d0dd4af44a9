"""Small document tables with the awkward rows that every operator must take."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves, as extra input columns.
CLASH = ("fp", "label", "size", "key", "bucket", "kept", "score", "recipe", "n", "row", "features", "word", "rank",
         "component_id", "keep_id", "__copies", "source_size", "target", "rest", "c0", "a.b", "text.x", "back`tick")


def frame(spark, rows):
    """(doc_id, text[, lang[, source]]) -> documents."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None,
             None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("clash").alias(c) for c in CLASH])


PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree at dusk"
AWKWARD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a"), (2, None, "en", "a"), (3, "", None, None),
    (4, " \t\n ", "fr", "b"), (None, "null id text with some words in it", "en", "b"), (5, PROSE, "en", None),
    (5, PROSE, "en", None), (6, "Ünïcödé 日本語 текст straße", "de", "ü"), (7, (PROSE + "\n") * 400, "en", "a"),
    (8, "alpha beta gamma delta  epsilon zeta eta theta", "en", "a"), (9, "x", None, "c"),
    (10, "\U0001f600 \U0001f600 emoji\x00nul\x0bvt\x0cff\rcr", "es", "c"), (-3, PROSE.upper(), "en", "c"),
]


@pytest.fixture
def awkward(spark):
    return frame(spark, AWKWARD)


@pytest.fixture
def nothing(spark):
    return frame(spark, [])
