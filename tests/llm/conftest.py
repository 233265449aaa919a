import duckdb
import pytest

from orebed.llm.oracle import statements

TABLES = "documents pages benchmark labels conversations"


def plain(value):
    return f"{value:.12g}" if isinstance(value, float) else str(value)


@pytest.fixture
def matches_sql(sf_dir):
    """Compare a query's rows with its reference SQL, on the given tables or on other rows in their place."""

    def compare(df, name, **tables):
        con = duckdb.connect()
        for table in TABLES.split():
            if table in tables:
                frame = tables[table].toArrow()
                con.register(f"{table}_rows", frame)
                con.execute(f"create view {table} as select * from {table}_rows")
            else:
                con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
        answer = con.execute(statements()[name])
        names = [part[0] for part in answer.description]
        assert sorted(names) == sorted(df.columns)
        expected = sorted(tuple(plain(v) for _, v in sorted(zip(names, row))) for row in answer.fetchall())
        found = sorted(tuple(plain(row[c]) for c in sorted(df.columns)) for row in df.collect())
        assert found == expected

    return compare
