"""The driver contract: every registered query has oracle SQL, and every SQL text is valid
DuckDB over the driver's table names (checked with EXPLAIN on empty views of the same schema)."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_every_query_has_oracle_sql():
    # the corpus operators that SQL cannot express are tested against brute force in tests/llm
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own = {name for name in entry.queries() if name not in entry._LLM}
    assert own <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle_sql_plans(name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet') LIMIT 0")
    con.execute("EXPLAIN " + entry.oracle_sql()[name])
