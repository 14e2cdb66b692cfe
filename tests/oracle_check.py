"""Compare registered queries with their SQL twins: python -m tests.oracle_check FOLDER [name ...]."""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows), sorted(columns)


def compare(spark, con, folder, build, sql):
    """None when equal, else the first difference."""
    frame = build(spark, folder)
    ours, our_names = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs, their_names = _rows(names, result.fetchall())
    if our_names != their_names:
        return f"columns {our_names} != {their_names}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{our_names}\n  spark  {mine}\n  oracle {other}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, folder, build, oracle[name])
            else:
                problem = None if build(spark, folder).count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name}{'' if name in oracle else ' (rows only)'}")
        if problem:
            print("   ", problem)
        sys.stdout.flush()
    print(f"{bad} of {len(queries)} failed")
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
