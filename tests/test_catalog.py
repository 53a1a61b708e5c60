"""Every catalogued query against its DuckDB oracle."""

import math

import duckdb
import pytest

from catalog.oracles import ORACLES
from catalog.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_plain(row[i]) for i in order) for row in rows], key=repr)


def _family(kind: str) -> str:
    kind = kind.lower()
    for family in ("int", "double", "bool", "timestamp"):
        if family in kind:
            return kind if family == "int" else family
    return "string" if kind in ("string", "varchar") else kind


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(name, spark, folder, database):
    result = QUERIES[name](spark, folder)
    cursor = database.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    kinds = {c[0]: _family({"INTEGER": "int", "BIGINT": "bigint"}.get(str(c[1]), str(c[1]))) for c in cursor.description}
    expected = _rows(columns, cursor.fetchall())
    assert sorted(result.columns) == sorted(columns)
    assert {f.name: _family(f.dataType.simpleString()) for f in result.schema} == kinds
    found = _rows(result.columns, [tuple(r) for r in result.collect()])
    assert len(found) == len(expected)
    different = [(a, b) for a, b in zip(found, expected) if a != b]
    assert not different, different[:3]
