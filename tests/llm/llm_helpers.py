"""Small tables with the cases that every operator must take."""

import pytest
from pyspark.sql import Row

EDGE_TEXTS = [
    "The cat sat on the mat and looked at the dog for a long long time.",
    "The cat sat on the mat and looked at the dog for a long long time.",
    "THE CAT sat on the mat and looked at the dog for a long long time.",
    "", None, " \n\t", "one", "one two", "It's a   strange\n\n text, isn't it? <|endoftext|> 12 34 ###",
    "Über größere Häuser\x85 und \xa0 ein paar Zeichen: 漢字 한국어 ﬁ é 😀",
]


def edge_documents(spark):
    """Repeated rows, null ids, null, empty, blank and long texts, and names that clash."""
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(1, EDGE_TEXTS[1]), (None, "a text without an id"), (None, None), (50, "word " * 30_000)]
    data = [Row(doc_id=i, text=t, lang="en", source="s", n_chars=0, part=7, place="p", fp=1,
                kept=False, score=0.5, block=3, length=9, key=None) for i, t in rows]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, part int, "
              "place string, fp long, kept boolean, score double, block long, length long, key int")


def no_documents(spark):
    return edge_documents(spark).where("false")


def rows_of(df, *order):
    return sorted((r.asDict() for r in df.collect()),
                  key=lambda r: tuple((r[c] is not None, r[c]) for c in order))


@pytest.fixture(scope="session")
def edges(spark):
    return edge_documents(spark).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return no_documents(spark)
