import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def equals_sql(spark):
    """Compare a query with its SQL over the smallest tables, column by column."""

    def check(name, folder=FOLDER):
        from lettora.llm.queries import LLM_ORACLE, LLM_QUERIES

        with duckdb.connect() as connection:
            for table in ("documents", "pages", "benchmark", "labels"):
                connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
            answer = connection.execute(LLM_ORACLE[name])
            names = [part[0] for part in answer.description]
            expected = answer.fetchall()
        found = [tuple(row) for row in LLM_QUERIES[name](spark, folder).select(*names).collect()]
        assert len(found) > 0 and sorted(map(repr, found)) == sorted(map(repr, expected))

    return check
