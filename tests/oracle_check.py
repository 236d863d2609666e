"""Compare every query with its SQL twin: column names, types and values.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences, empty when both sides agree."""
    relation = con.sql(sql)
    want_types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    got_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    problems = []
    if got_types != want_types:
        problems.append(f"schema {set(got_types.items()) ^ set(want_types.items())}")
    if set(got_types) != set(want_types):
        return problems
    names = sorted(got_types)
    picked = relation.project(", ".join(f'"{n}"' for n in names))
    want = Counter(picked.fetchall())
    got = Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if got != want:
        problems.append(
            f"rows got={got.total()} want={want.total()} only_spark={list((got - want).items())[:3]} "
            f"only_sql={list((want - got).items())[:3]} columns={names}"
        )
    elif not want:
        problems.append("EMPTY")
    return problems


def main() -> None:
    from tidelake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problems = compare(query(spark, sf_dir), con, sql[name]) if name in sql else ["no sql"]
        except Exception:
            problems = [traceback.format_exc()[-1500:]]
        print(f"{'ok  ' if not problems else 'FAIL'} {name} {time.time() - start:.1f}s", *problems, flush=True)
        failed += [name] if problems else []
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main()
