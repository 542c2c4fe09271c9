"""Every registered query of the library's own operators against its DuckDB form."""

import decimal
import math
import os

import duckdb
import pytest

from fjordlake.plans import cube_queries, payload_queries, posting_queries, rule_queries, signal_queries, store_queries

MODULES = (signal_queries, posting_queries, payload_queries, cube_queries, store_queries, rule_queries)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in MODULES for k, v in m.ORACLES.items()}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


@pytest.fixture(scope="module")
def duck(sf_dir):
    own = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        own.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return own


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return None if math.isnan(value) else float(f"{float(value):.9g}")
    return value


def in_order(names, rows):
    cols = sorted(names)
    return cols, sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    found = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in found.collect()]
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        names = [d[0] for d in result.description]
        assert in_order(found.columns, rows) == in_order(names, result.fetchall())
    else:
        assert rows
