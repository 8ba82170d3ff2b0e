"""Compare registered queries with their oracle SQL on the sample tables."""
from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return repr(value)


def normalised(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_side(df):
    return normalised(df.columns, [tuple(r) for r in df.collect()])


def oracle_side(con, sql: str):
    cursor = con.execute(sql)
    return normalised([d[0] for d in cursor.description], cursor.fetchall())


def main(sf_dir: str, only: list[str]) -> int:
    from pyspark.sql import SparkSession

    from pitf.catalog import registered

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), registered.oracle_sql(), 0
    for name, query in registered.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            mine = spark_side(query(spark, sf_dir))
            took, note = time.time() - start, "rows only"
            if name in oracle:
                start = time.time()
                theirs = oracle_side(con, oracle[name])
                note = f"oracle {time.time() - start:.1f}s"
                if mine != theirs:
                    bad += 1
                    diff = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
                    note += f" MISMATCH columns {set(mine[0]) ^ set(theirs[0])} rows {len(mine[1])}/{len(theirs[1])} " \
                            f"first {diff[:1]}"
            print(f"{name:36s} {len(mine[1]):7d} rows {took:6.1f}s  {note}", flush=True)
        except Exception as error:
            bad += 1
            print(f"{name:36s} FAILED {type(error).__name__}: {str(error)[:1500]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
