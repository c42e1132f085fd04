import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LONG = " ".join(f"word{i % 997} and{i % 13}." for i in range(4000))
BASE = "The old house on the hill was sold in May to a painter who came from the north of the country."


# Names that the operators use for columns of their own.
OWN = ("id", "_id", "row", "_row", "rows", "_rows", "rank", "times", "_times", "_copy", "removed", "others", "node", "key_", "place")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns named like the operators' own."""
    rows = [
        (1, BASE, "en", "a", 1, "x"),
        (1, BASE, "en", "a", 1, "x"),
        (2, None, None, None, None, None),
        (3, "", "de", "b", 0, "y"),
        (4, " \n\t ", "de", None, 0, "y"),
        (5, LONG, "en", "a", len(LONG), "z"),
        (6, BASE.replace("May", "June"), "en", "b", 1, "z"),
        (None, "no id at all", "en", "a", 1, "x"),
        (7, "Ünï çödé 漢字かな交じり文", None, "c", 1, "x"),
        (8, "x", "fr", "c", 1, "x"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, size string"
    ).selectExpr("*", "size key").drop("size").selectExpr("*", *(f"concat('{c}', doc_id) AS {c}" for c in OWN))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
