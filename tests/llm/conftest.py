import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use inside.
    T.StructField("row", T.StringType()), T.StructField("key", T.LongType()), T.StructField("h", T.StringType()), T.StructField("size", T.StringType()),
])

PLAIN = (
    "The harbour lay quiet under a pale morning while two boats waited for the tide and the keeper of the light wrote "
    "down the hour the wind the height of the water and the names of all who had come ashore during the night"
)
LONG = " ".join(f"word{i % 977} und{i % 31}" for i in range(60_000))
TEXTS = [
    PLAIN, PLAIN, PLAIN.replace("pale", "grey"), "", None, "   \n\t ", "!!! ???", "a", "é ß 漢字 😀", LONG,
    "Licensed under CC BY 4.0. All rights reserved.", "token = abcdefgh12345678 and mail me@example.org", "the the the the the the the",
    PLAIN.upper() + "\n\nThis work is licensed under the GNU General Public License, version 3.",
]


def doc(i, text, lang="en", source="a"):
    return (i, text, lang, source, len(text or ""), "r", 7, "x", "y")


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows):
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(frame):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rows = [doc(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3]) for i, t in enumerate(TEXTS)]
    rows += [doc(0, TEXTS[0]), doc(0, TEXTS[0]), doc(None, "no number here at all"), doc(None, None, None, None), (None,) * 9]
    return frame(rows)


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])
