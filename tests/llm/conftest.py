import os

import pytest

from tools.check_oracle import TABLES, digest


@pytest.fixture
def matches_oracle(spark):
    """Compares a registered query with its DuckDB SQL: column names and rows in any order."""

    def check(name, sf):
        import duckdb

        from tradescope.llm import queries

        con = duckdb.connect()
        for t in TABLES:
            if os.path.exists(p := f"{sf}/{t}.parquet"):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
        df = queries.QUERIES[name](spark, sf)
        result = con.execute(queries.ORACLE_SQL[name])
        names = [d[0] for d in result.description]
        rows = result.fetchall()
        assert sorted(df.columns) == sorted(names)
        assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(names, rows)
        return len(rows)

    return check
