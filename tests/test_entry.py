"""Driver contract: entry smoke, and every SQL-checked query against DuckDB."""
import os

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_id" in df.columns and "target_conversion" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con(smoke_dir):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{smoke_dir}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _canon(df):
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
    from compare_oracle import digest
    return digest(df)[0]


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, smoke_dir, name):
    frame = E.queries()[name](spark, smoke_dir)
    rel = con.sql(E.oracle_sql()[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in frame.schema.fields:
        st = f.dataType.simpleString()
        assert SPARK_TO_DUCKDB.get(st, st) == duck_types.get(f.name), (f.name, st, duck_types.get(f.name))
    sdf = frame.toPandas()
    odf = rel.df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert _canon(sdf) == _canon(odf)


def test_marts_satisfy_their_contracts(spark, smoke_dir):
    checks = E.queries()["mart_contract_checks"](spark, smoke_dir).collect()
    assert checks and all(r.violations == 0 for r in checks), [r for r in checks if r.violations]
    uniq = E.queries()["mart_contract_unique"](spark, smoke_dir).collect()
    assert all(r.duplicate_keys == 0 for r in uniq)


@pytest.mark.parametrize("name", ["dq_report", "customer_features", "roc_auc", "roc_curve", "qini_curve",
                                  "stratified_split", "uplift_by_decile", "bootstrap_allocation",
                                  "budget_allocation", "cohort_retention", "attribution_mix"])
def test_same_result_at_1_and_16_partitions(spark, smoke_dir, name):
    from tidewell.session import sql_conf
    digests = []
    for n in ("1", "16"):
        with sql_conf(spark, {"spark.sql.shuffle.partitions": n}):
            digests.append(_canon(E.queries()[name](spark, smoke_dir).toPandas()))
    assert digests[0] == digests[1]
