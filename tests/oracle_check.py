"""Runs registered queries against their SQL: python tests/check_oracle.py SF_DIR [name ...]"""

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return repr(value)


def compare(spark_df, con, sql):
    """None if the rows are equal as multisets with columns by name, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    order = sorted(names)
    at = [names.index(n) for n in order]
    want = sorted(tuple(canonical(row[i]) for i in at) for row in expected)
    got = sorted(tuple(canonical(v) for v in row) for row in spark_df.select(*[f"`{n}`" for n in order]).collect())
    if want != got:
        extra, missing = [r for r in got if r not in set(want)][:2], [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows, expected {len(want)}; {order} only here {extra}, only there {missing}"
    return None


def main(sf_dir, names):
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                verdict = compare(df, con, oracle[name])
                rows = ""
            else:
                verdict, rows = None, f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += verdict is not None
        print(f"{'FAIL' if verdict else 'ok  '} {name} {time.time() - start:.2f}s {verdict or rows}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
