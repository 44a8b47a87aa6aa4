from __future__ import annotations

import duckdb
import pytest

from tests.conftest import SF_SMALL

WORDS = [f"w{i}" for i in range(400)]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, fp long, key long, s int, "
          "chunk string, rk long, y int, node long, rank int, length long, at int, `group` string")


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, and columns named like internal ones."""
    long_text = "\n".join(" ".join([f"n{i}", *(WORDS[(i * 7 + j) % 400] for j in range(40))]) for i in range(1500))
    passage = " ".join(WORDS[:60])
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, long_text), (5, passage + "\nshared line one\nshared line two\nshared line three\ntail five"),
        (6, "other head\n" + passage + "\nshared line one\nshared line two\nshared line three\ntail six"), (7, passage), (7, passage), (7, "same id, another text"),
        (None, "no id at all but some words"), (8, "12345 !!! ###"), (9, "Ünïcödé ßtraße ñandú façade"), (10, "\n\n\n\n"), (11, None),
    ]
    rows = [(d, t, "en", "src", 3, 0.5, True, 1, 2, 3, "c", 4, 5, 6, 7, 8, 9, "g") for d, t in texts]
    rows.append((12, "every other column is null", *[None] * 16))
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c
