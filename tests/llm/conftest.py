"""Small document tables with the awkward rows every operator has to take."""

import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
LINE = "this line is long enough to be dropped"
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.\nAnd again, it jumps.", "en", "a", 10),
    (2, "", "en", "a", 0),
    (3, None, None, None, None),
    (None, "A text without an id, but with words in it.", "en", "b", 4),
    (5, LONG, "fr", "a", 9),
    (6, f"{LINE}\nsix", "de", "b", 3),
    (7, f"  {LINE.upper()}\t\nseven\n{LINE}", "de", "b", 3),
    (8, f"eight\n{LINE}\n{LINE}", None, "b", 3),
    (9, " \t\n ", "en", "c", 1),
    (10, "The quick brown fox jumps over the lazy dog.\nAnd again, it jumps.", "en", "a", 10),
    (10, "The quick brown fox jumps over the lazy dog.\nAnd again, it jumps.", "en", "a", 10),
    (11, "ÄÖÜ straße — naïve  double  spaces\x01mark\x85end <|endoftext|> 😀😀", "de", "c", 2),
    (12, "x", "en", "a", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ("row", "shard", "slot", "key", "position", "hash", "class", "kept", "bitmap", "n", "_id", "block")


@pytest.fixture(scope="module")
def awkward(spark):
    """The rows above, with further columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
