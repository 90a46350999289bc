from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text), with columns whose names the operators use inside."""
    def build(rows, id_type="long"):
        schema = f"doc_id {id_type}, text string, id string, body string, key int, n int, `group` int"
        return spark.createDataFrame([(i, t, "x", "y", 1, 2, 3) for i, t in rows], schema)
    return build


@pytest.fixture(scope="session")
def by_id():
    """Rows of a frame as {id: [row, ...]}."""
    def collect(df, key="id"):
        out = {}
        for row in df.collect():
            out.setdefault(row[key], []).append(row)
        return out
    return collect


LONG = "word " * 40_000
EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "Same text here"), (5, "same TEXT here"),
         (5, "same TEXT here"), (None, "no id"), (6, LONG), (7, "É È"), (8, "é è")]


@pytest.fixture(scope="session")
def edges(docs):
    return docs(EDGES)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs([])
