"""Small helpers shared by the operator tests."""
import os

import duckdb

TABLES = "documents embeddings pages benchmark labels".split()
DIR = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def duck(sql, sf_dir=DIR, **paths):
    """Column names and rows of a query over the tables (or given Parquet paths)."""
    con = duckdb.connect()
    for t in TABLES:
        p = paths.get(t, f"{sf_dir}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def same(spark_df, duck_rows):
    names, rows = duck_rows
    assert sorted(spark_df.columns) == sorted(names)
    got = sorted((tuple(r) for r in spark_df.select(*names).collect()), key=repr)
    want = sorted(map(tuple, rows), key=repr)
    assert len(got) == len(want)
    assert got == want


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t))
                                  for i, t in zip(ids, texts)], DOC)
