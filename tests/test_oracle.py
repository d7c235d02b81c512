"""Correctness gate: every registered query against its DuckDB oracle at sf0.01
(row count, column names, order-insensitive value hash)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from paths import SF01
from oracle_compare import compare

from pagemart.registry import QUERIES

NAMES = list(QUERIES)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF01, [name], verbose=False)[name]
    assert res["spark_rows"] == res["oracle_rows"]
    assert res["cols_match"], res
    assert res["hash_match"], res


# Spark type -> DuckDB type of the same values
TYPE_NAMES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
              "boolean": "BOOLEAN", "double": "DOUBLE"}


def test_result_types_agree(spark):
    from paths import SF001
    from oracle_compare import duck
    con = duck(SF001)
    ora = E.oracle_sql()
    for name, fn in QUERIES.items():
        spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
                       for f in fn(spark, SF001).schema.fields}
        duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ora[name]}").fetchall()}
        assert spark_types == duck_types, name
