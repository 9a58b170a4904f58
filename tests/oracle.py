"""Run a registered query and its SQL on the same tables and compare everything."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def frames(spark_df, con, sql):
    got = spark_df.toArrow()
    relation = con.sql(sql)
    want = relation.to_arrow_table() if hasattr(relation, "to_arrow_table") else relation.arrow()
    return got, want


def rows(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return names, sorted(zip(*columns), key=lambda row: tuple((v is not None, str(v)) for v in row))


def difference(spark_df, con, sql) -> str | None:
    """None when equal, else what differs."""
    got, want = frames(spark_df, con, sql)
    names, got_rows = rows(got)
    want_names, want_rows = rows(want)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got_rows) != len(want_rows):
        return f"row count {len(got_rows)} != {len(want_rows)}"
    for name in names:
        a, b = str(got.schema.field(name).type), str(want.schema.field(name).type)
        if a.replace("large_", "") != b.replace("large_", "").replace("_view", ""):
            return f"type of {name}: {a} != {b}"
    for a, b in zip(got_rows, want_rows):
        if a != b:
            return f"row {a} != {b}"
    return None
