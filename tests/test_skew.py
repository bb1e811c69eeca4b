"""A customer holding a third of all line items: results still equal DuckDB."""
import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewell.functions.hashing import hash_uniform
from tidewell.operators import features, metrics
from tidewell.plans.oracle import CUT, features_sql
from tidewell.plans.layers import Layers, round_doubles


@pytest.fixture(scope="module")
def skewed(spark, smoke_dir):
    p = Layers(spark, smoke_dir)
    from tidewell.operators.cleaning import SILVER_COLUMNS
    silver = p.silver.select(*SILVER_COLUMNS)
    hot = hash_uniform(7, F.concat_ws(":", "invoice", "stock_code"), "hot") < 1 / 3
    fact = silver.withColumn("customer_id", F.when(hot, F.lit("HOT")).otherwise(F.col("customer_id")))
    path = os.path.join(tempfile.mkdtemp(prefix="tw-skew-"), "fact")
    fact.write.parquet(path)
    return spark.read.parquet(path), path


def test_hot_customer_holds_a_third(skewed):
    fact, _ = skewed
    share = fact.filter(F.col("customer_id") == "HOT").count() / fact.count()
    assert 0.28 < share < 0.38


def test_features_under_skew_match_duckdb(spark, skewed):
    fact, path = skewed
    dim = features.dim_customers(fact)
    got = round_doubles(features.feature_snapshots(fact, dim, CUT.distinct(), CUT.window_days)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW silver AS SELECT * FROM read_parquet('{path}/*.parquet')")
    con.execute("""CREATE VIEW dim AS
        SELECT f.customer_id, f.first_purchase_date, m.country FROM
        (SELECT customer_id, min(invoice_date) AS first_purchase_date FROM silver GROUP BY 1) f JOIN
        (SELECT customer_id, country FROM (SELECT customer_id, country,
             row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, country) AS rn
             FROM (SELECT customer_id, country, count(*) AS n FROM silver GROUP BY 1, 2)) WHERE rn = 1) m
        ON f.customer_id = m.customer_id""")
    exp = con.execute(f"SELECT * FROM ({features_sql('silver', CUT.distinct(), CUT.window_days)})").df()
    assert len(got) == len(exp)
    import pandas as pd
    for df in (got, exp):
        df["as_of"] = pd.to_datetime(df["as_of"]).astype("datetime64[ns]")
        df["customer_id"] = df["customer_id"].astype(str)
    g = got.set_index(["as_of", "customer_id"]).sort_index()
    e = exp.set_index(["as_of", "customer_id"]).sort_index()
    for c in ("recency_days", "frequency", "product_diversity", "tenure_days", "target_conversion"):
        assert (g[c].astype("int64") == e[c].astype("int64")).all(), c
    for c in ("monetary", "avg_days_between_orders", "spend_trend_slope"):
        assert ((g[c] - e[c]).abs().fillna(0) < 1e-6).all(), c
    hot = g.xs("HOT", level="customer_id")
    assert (hot["frequency"] > 100).all()


def test_cohorts_under_skew(spark, skewed):
    fact, _ = skewed
    dim = features.dim_customers(fact)
    rows = metrics.cohort_retention(fact, dim, CUT.t_test).collect()
    assert sum(r.cohort_size for r in rows) == dim.count()
