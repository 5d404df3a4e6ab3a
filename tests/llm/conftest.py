import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


#: Rows that every operator on documents must take: NULLs in each column, empty and long texts, repeated rows,
#: and columns with names that the operators use themselves.
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key long, size long, target double, ids string, set string, __id long"
LONG = "Long words of prose, told again and again by someone. " * 6000


def odd_rows():
    plain = "The quick brown fox jumps over the lazy dog and runs away from 3 hounds."
    texts = [None, "", " ", "\n\t", plain, plain, LONG, "été ça où 🙂 中文 ñandú", "x", "12345", "  two  spaces ", "ends with space ", plain + " Mail a.b@c.org now"]
    rows = [(i, t, ("en", None)[i % 2], ("s1", "s2", None)[i % 3], i, 1, 2, 3, 4.0, "a", "b", 5) for i, t in enumerate(texts)]
    return [*rows, rows[4], (None, plain, None, None, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
