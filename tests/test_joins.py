"""Joins against their DuckDB text, and how often tables are read."""

import duckdb

from censuskit.plans import registry


def test_table_diff_joins_once(spark, tmp_path):
    rows = [(i if i < 58 else None, None if i in (10, 22) else float(i) / 3, None if i in (4, 30) else "FOP"[i % 3]) for i in range(60)]
    spark.createDataFrame(rows, "o_orderkey long, o_totalprice double, o_orderstatus string").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    got = registry.queries()["table_diff"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    told = con.execute(registry.oracle_sql()["table_diff"]).fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, told)) and told
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join FullOuter") == 1
