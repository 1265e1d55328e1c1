"""Run registered queries beside their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with a view per supplied table."""
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def _family(name: str) -> str:
    name = name.lower()
    return {"string": "varchar", "int": "integer"}.get(name, name)


def normal(columns, rows):
    """Columns by name, rows in a fixed order, floats as their exact text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple("NULL" if row[i] is None else repr(row[i]) for i in order) for row in rows
    )


def difference(df, db, sql) -> str | None:
    """None when the results agree, else what differs first."""
    result = db.execute(sql)
    types = {d[0]: _family(str(d[1])) for d in result.description}
    want = normal([d[0] for d in result.description], result.fetchall())
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    mine = {f.name: _family(f.dataType.simpleString()) for f in df.schema.fields}
    if mine != types:
        odd = {c: (mine[c], types[c]) for c in mine if mine[c] != types[c]}
        return f"types {odd}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    odd = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(odd)} rows differ, first {odd[0]}" if odd else None


def main(sf_dir: str, names: list[str]) -> int:
    """Print one line per query; the exit code counts the failures."""
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, bad = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                problem = difference(df, db, sql[name])
            else:
                problem = None if df.collect() else "no rows"
        except Exception as error:  # report every query, whatever fails
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        verdict = problem or ("same" if name in sql else "rows only")
        print(f"{name:26} {time.time() - start:6.1f}s  {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
