"""Run registered queries and compare them with their oracle SQL in DuckDB.

usage: python tools/verify.py [sf_dir] [name prefix ...]
"""

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from paddock.registry import load  # noqa: E402
from paddock.session import local_session  # noqa: E402


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(kind: pa.DataType) -> str:
    text = str(kind).replace("large_string", "string").replace("string_view", "string")
    return "timestamp" if text.startswith("timestamp") else text


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr) if columns else []


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (a != a and b != b)
    return type(a) is type(b) and a == b


def compare(got: pa.Table, want: pa.Table) -> str:
    kinds = [{f.name: _plain(f.type) for f in t.schema} for t in (got, want)]
    if kinds[0] != kinds[1]:
        keys = sorted(set(kinds[0]) | set(kinds[1]))
        return "schema " + str([(k, kinds[0].get(k), kinds[1].get(k)) for k in keys if kinds[0].get(k) != kinds[1].get(k)])
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} != {want.num_rows}"
    for a, b in zip(_rows(got), _rows(want)):
        if len(a) != len(b) or not all(_same(x, y) for x, y in zip(a, b)):
            return f"values {a} != {b}"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = local_session(8)
    connection = oracle(sf_dir)
    bad = 0
    for name, query in load().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            got = query.run(spark, sf_dir).toArrow()
            took = time.time() - start
            problem = "" if query.sql is None else compare(got, connection.sql(query.sql).to_arrow_table())
        except Exception as error:
            took, got, problem = time.time() - start, None, f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem)
        verdict = "FAIL" if problem else "ok" if query.sql else "ran"
        print(f"{verdict:5}{name:45}{took:7.2f}s rows={got.num_rows if got else '-'} {problem}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
