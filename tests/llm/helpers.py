import itertools

import duckdb

SF = "/root/testdata/sf0.001"
#: columns that operators use inside, as extra columns of their inputs
CLASHING = ("size", "key", "part", "same", "gram", "n", "found", "digest", "label", "node", "bucket", "rank", "_d", "_key")


def duck(**tables):
    """DuckDB over the smallest test tables, or over Spark DataFrames given by name."""
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        if t not in tables:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return con


def canon(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def same_as_sql(df, sql, **tables):
    rel = duck(**tables).sql(sql)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    want = rel.select(*[f'"{c}"' for c in cols]).fetchall()
    assert canon(map(tuple, df.select(*cols).collect())) == canon(want)


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


def repacked(monkeypatch, spark, module):
    """After every other step that ``module`` stores, Spark packs files into
    other partitions, as it does when an executor is lost or joins."""
    plain, turn = module.stored, itertools.cycle(("2k", "128m"))

    def stored(df, name):
        out = plain(df, name)
        spark.conf.set("spark.sql.files.maxPartitionBytes", next(turn))
        return out

    monkeypatch.setattr(module, "stored", stored)
