"""Run oracle SQL on the parquet test tables with DuckDB (test helper)."""
from __future__ import annotations

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run(sf_dir: str, sql: str):
    con = connect(sf_dir)
    return con.execute(sql).fetchdf()
