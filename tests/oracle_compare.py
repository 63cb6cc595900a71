"""Compare a registered query with its SQL counterpart, rows and types."""

import time
import traceback

import duckdb
import pyarrow as pa

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _type(t):
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    return str(t)


def _cell(v):
    return v


def _rows(arrow, columns):
    data = [[_cell(v) for v in arrow.column(c).to_pylist()] for c in columns]
    return sorted(zip(*data), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, con, sql):
    """None if equal, else what differs."""
    got, want = df.toArrow(), con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} vs {sorted(want.column_names)}"
    columns = sorted(got.column_names)
    types = {c: (_type(got.schema.field(c).type), _type(want.schema.field(c).type)) for c in columns}
    wrong = {c: t for c, t in types.items() if t[0] != t[1]}
    if wrong:
        return f"types {wrong}"
    a, b = _rows(got, columns), _rows(want, columns)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}"
    if not a:
        return "no rows"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else None


def compare_all(sf_dir, names=()):
    import __spark_entry__ as entry
    from mirepoix.session import build_session

    spark = build_session("check", "local[8]", spark_sql_shuffle_partitions="8",
                          spark_ui_enabled="false", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if names and not any(n in name for n in names):
            continue
        t0 = time.time()
        try:
            if name in oracles:
                problem = compare(fn(spark, sf_dir), con, oracles[name])
            else:
                n = fn(spark, sf_dir).count()
                problem = None if n else "no rows"
        except Exception as e:
            problem = "error " + str(e)[:1500]
            if names:
                traceback.print_exc()
        failed += problem is not None
        kind = "" if name in oracles else " (rows only)"
        print(f"{time.time() - t0:6.1f}s {name}{kind}: {problem or 'ok'}", flush=True)
    print(f"{failed} failed of {len(queries)}, {len(oracles)} with SQL")
    return failed
