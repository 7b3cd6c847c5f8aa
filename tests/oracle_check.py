"""Run registered queries and their SQL checks side by side: python tests/oracle_check.py [names...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(pdf):
    """Rows as sorted tuples of plain values, columns by name."""
    import math

    def plain(v):
        if v is None:
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float):
            return None if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    cols = sorted(pdf.column_names)
    data = [pdf.column(c).to_pylist() for c in cols]
    rows = [tuple("" if plain(v) is None else plain(v) for v in r) for r in zip(*data)] if data else []
    return cols, sorted(rows)


def compare(spark_table, duck_table) -> str:
    a_cols, a = canonical(spark_table)
    b_cols, b = canonical(duck_table)
    if a_cols != b_cols:
        return f"columns {sorted(set(a_cols) ^ set(b_cols))}"
    types = []
    for c in a_cols:
        x, y = str(spark_table.schema.field(c).type), str(duck_table.schema.field(c).type)
        if x != y and {x, y} != {"string", "large_string"}:
            types.append(f"{c}: {x} / {y}")
    if types:
        return "types " + "; ".join(types)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"values differ in {len(bad)} rows, columns {a_cols}, first {bad[0]}"
    return ""


def main(names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    queries, checks = entry.queries(), entry.oracle_sql()
    failed = []
    for name, fn in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = fn(spark, sf).toArrow()
            took = time.time() - start
            if name in checks:
                problem = compare(got, con.sql(checks[name]).to_arrow_table())
                mark = "ok" if not problem else "DIFF " + problem
            else:
                problem, mark = "", f"rows only ({got.num_rows})"
        except Exception as exc:  # report and go on with the next query
            took, problem, mark = time.time() - start, "error", "ERROR " + str(exc)[:1500]
        if problem:
            failed.append(name)
        rows = got.num_rows if problem != "error" else "-"
        print(f"{name:24s} {took:6.2f}s {rows!s:>8} {mark}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
