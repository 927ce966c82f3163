"""What the tests of this folder share."""

from __future__ import annotations

import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

#: Texts that every operator must take: null, empty, blank, short, odd characters, long words and lines.
ODD = [None, "", " \t\n", "a", "A b", "\x1c \x85  ", "ü😀漢字 ß", "<|endoftext|> </turn> ###", "x" * 30_000, "1 " * 20_000,
       "!!! @@@ ...", "1.2.3.4.5", "\\", "word " * 9_000 + "\n" * 500]


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (doc_id, text) as a table with columns whose names operators use for themselves."""

    def make(rows):
        more = [(i, t, "x", 1, None, 2.0) for i, t in rows]
        return spark.createDataFrame(
            more, "doc_id bigint, text string, component string, key int, held_out string, score double"
        )

    return make


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
