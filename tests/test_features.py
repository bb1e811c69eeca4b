"""Point-in-time features, label windows and leakage."""
import pytest
from pyspark.sql import functions as F

from fixtures import BRONZE_SCHEMA, FACT_SCHEMA, SAMPLE_TRANSACTIONS, SMOKE_CODES, d
from tidewell.operators import cleaning, features
from tidewell.params import FeatureParams

AS_OF = d("2023-01-31")
UK = FeatureParams(home_country="United Kingdom")

EXPECTED = {
    "1001": (10, 2, 22.5, 2, 15.0, False, 2.410714, 25, True, 1),
    "1002": (20, 1, 13.0, 1, None, True, 1.392857, 20, True, 0),
    "1003": (29, 1, 2.0, 1, None, True, 0.214286, 29, False, 0),
    "1004": (18, 1, 40.0, 1, None, True, 4.285714, 18, False, 0),
    "1007": (12, 1, 22.0, 1, None, True, 2.357143, 12, True, 1),
    "1008": (8, 1, 36.0, 1, None, True, 3.857143, 8, False, 0),
}
COLS = ("recency_days", "frequency", "monetary", "product_diversity", "avg_days_between_orders", "single_buyer",
        "spend_trend_slope", "tenure_days", "is_uk", "target_conversion")


@pytest.fixture(scope="module")
def silver(spark):
    return cleaning.clean_silver(spark.createDataFrame(SAMPLE_TRANSACTIONS, BRONZE_SCHEMA), SMOKE_CODES).cache()


def test_smoke_features_match_expected_table(silver):
    dim = features.dim_customers(silver)
    rows = {r.customer_id: r for r in features.customer_features(silver, dim, AS_OF, 90, UK).collect()}
    assert set(rows) == set(EXPECTED)  # 1005 and 1006 never reach silver
    for cid, exp in EXPECTED.items():
        got = tuple(rows[cid][c] for c in COLS)
        for g, e in zip(got, exp):
            assert (g is None and e is None) or g == pytest.approx(e, abs=1e-6), (cid, got, exp)


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


def feats(spark, rows, as_of=AS_OF, window=90):
    f = fact(spark, rows)
    return {r.customer_id: r for r in features.customer_features(f, features.dim_customers(f), as_of, window, UK).collect()}


ROW_1 = ("1007", "5013", "10009", d("2023-01-18"), 22.0, "United Kingdom")
ROW_2 = ("1007", "5014", "10009", d("2023-02-25"), 22.0, "United Kingdom")


def test_future_rows_never_change_features(spark):
    a, b = feats(spark, [ROW_1])["1007"], feats(spark, [ROW_1, ROW_2])["1007"]
    for c in COLS[:-1]:
        if c != "tenure_days":
            assert a[c] == b[c], c
    assert (b.frequency, b.recency_days, b.monetary) == (1, 13, 22.0)


def test_label_moves_with_the_future_row(spark):
    assert feats(spark, [ROW_1])["1007"].target_conversion == 0
    assert feats(spark, [ROW_1, ROW_2])["1007"].target_conversion == 1


def test_window_is_exclusive_inclusive(spark):
    rows = [("A", "a1", "s", d("2023-01-31"), 1.0, "X"), ("A", "a2", "s", d("2023-01-31"), 1.0, "X"),
            ("B", "b1", "s", d("2023-01-31"), 1.0, "X"), ("B", "b2", "s", d("2023-05-01"), 1.0, "X"),
            ("C", "c1", "s", d("2023-01-31"), 1.0, "X"), ("C", "c2", "s", d("2023-05-02"), 1.0, "X")]
    got = {k: v.target_conversion for k, v in feats(spark, rows).items()}
    assert got == {"A": 0, "B": 1, "C": 0}


def test_single_buyer_has_null_gap(spark):
    r = feats(spark, [("SOLO", "9", "s", d("2023-01-10"), 5.0, "X")])["SOLO"]
    assert r.single_buyer and r.avg_days_between_orders is None


def test_gaps_are_floored_per_gap_across_month_buckets(spark):
    # 23:00 → 01:00 next day is 0 elapsed days; gaps cross a month boundary
    rows = [("G", "1", "s", d("2022-12-30 23:00:00"), 1.0, "X"), ("G", "2", "s", d("2022-12-31 01:00:00"), 1.0, "X"),
            ("G", "3", "s", d("2023-01-02 00:30:00"), 1.0, "X"), ("G", "4", "s", d("2023-01-20 12:00:00"), 1.0, "X")]
    # gaps: 0, 1 (1d23.5h), 18 (18d11.5h) → mean 19/3
    assert feats(spark, rows)["G"].avg_days_between_orders == pytest.approx(19 / 3)


def test_mode_country_ties_go_to_smallest(spark):
    rows = [("T", "1", "s", d("2023-01-01"), 1.0, "Zeta"), ("T", "2", "s", d("2023-01-02"), 1.0, "Alpha")]
    assert features.dim_customers(fact(spark, rows)).first().country == "Alpha"


def test_snapshots_equal_single_cutoff_runs(spark, silver):
    dim = features.dim_customers(silver)
    cut = [d("2023-01-15"), AS_OF]
    snap = features.feature_snapshots(silver, dim, cut, 90, UK)
    for a in cut:
        one = features.customer_features(silver, dim, a, 90, UK)
        from tidewell.functions.timecols import as_ts
        from pyspark.sql import functions as F
        assert snap.filter(F.col("as_of") == as_ts(a)).exceptAll(one).count() == 0


def test_leakage_audit_finds_a_planted_leak(spark, silver):
    import datetime as dt
    dim = features.dim_customers(silver)

    def leaky(fact, dim, as_ofs, window_days, params):
        later = features.feature_snapshots(fact, dim, [a + dt.timedelta(days=40) for a in as_ofs], window_days, params)
        return later.withColumn("as_of", F.col("as_of") - F.expr("INTERVAL 40 DAYS"))

    res = features.leakage_audit(silver, dim, [d("2023-01-15")], UK, snapshots=leaky).collect()
    assert sum(r.mismatched_rows for r in res) > 0


def test_snapshots_prune_months_and_share_the_invoice_grain(spark, tmp_path, silver):
    path = str(tmp_path / "fact")
    silver.withColumn("month", (F.year("invoice_date") * 100 + F.month("invoice_date")).cast("int")) \
        .write.partitionBy("month").parquet(path)
    fact = spark.read.parquet(path)
    plan = features.feature_snapshots(fact, features.dim_customers(silver), [AS_OF], 30, UK)
    text = plan._jdf.queryExecution().executedPlan().toString()
    # locations are cut short in plans: look at the columns that a scan prunes by
    scans = [x.split("PartitionFilters: [")[1].split("]")[0] for x in text.splitlines()
             if "FileScan" in x and "PartitionFilters: [" in x]
    assert len([x for x in scans if "month" in x]) == 2
    assert len([x for x in text.splitlines() if "Exchange hashpartitioning(as_of" in x and "invoice" in x]) == 1


def test_products_of_all_cutoffs_are_shuffled_once(spark, silver):
    cuts = [d("2023-01-15"), AS_OF]
    some = silver.withColumn("stock_code", F.when(F.col("stock_code") != "s", F.col("stock_code")))
    plan = features.feature_snapshots(some, features.dim_customers(silver), cuts, 30, UK)
    got = {(r.as_of, r.customer_id): r.product_diversity for r in plan.collect()}
    want = (features.expand_to_cutoffs(some, cuts, None).groupBy("as_of", "customer_id")
            .agg(F.count_distinct("stock_code").alias("n")).collect())
    assert got and got == {(r.as_of, r.customer_id): r.n for r in want}
    pairs = [x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines()
             if "Exchange hashpartitioning(" in x and "stock_code" in x]
    assert pairs and all("as_of" not in x for x in pairs)


def test_leakage_audit_is_clean(spark, silver):
    dim = features.dim_customers(silver)
    res = features.leakage_audit(silver, dim, [d("2023-01-15"), AS_OF], UK).collect()
    assert all(r.mismatched_rows == 0 and r.rows_full == r.rows_truncated for r in res)


def test_label_requires_window():
    with pytest.raises(ValueError):
        features.feature_snapshots(None, None, [AS_OF], None, UK, include_target=True)


def test_same_day_invoices_have_zero_gap(spark):
    rows = [("S", "1", "s", d("2023-01-05 08:00:00"), 1.0, "X"), ("S", "2", "s", d("2023-01-05 20:00:00"), 1.0, "X"),
            ("S", "3", "s", d("2023-01-07 09:00:00"), 1.0, "X"), ("S", "3", "t", d("2023-01-07 10:00:00"), 1.0, "X")]
    # invoice 3's time is its earliest row; gaps 0 (same day) and 1 (1 d 13 h)
    assert feats(spark, rows)["S"].avg_days_between_orders == pytest.approx(0.5)


def test_cutoffs_of_a_block_share_the_shuffled_rows(spark, silver):
    """Two cutoffs, one row an invoice; more than a block of them still equal single runs, in other block sizes too."""
    dim = features.dim_customers(silver)
    inv = features._invoice_grain(silver, features._blocks([d("2023-01-15"), AS_OF]), 90, 6)
    assert inv.count() == inv.select("customer_id", "invoice").distinct().count()
    cuts = [d("2022-12-10 10:00:00"), d("2023-01-05"), d("2023-01-15"), d("2023-01-15 09:30:00"), AS_OF, d("2023-03-01")]
    from tidewell.plans.layers import round_doubles
    rows = lambda df: sorted(map(repr, round_doubles(df).collect()))
    alone = sorted(r for a in cuts for r in rows(features.customer_features(silver, dim, a, 90, UK)))
    for size in (2, 4):
        features.BLOCK, kept = size, features.BLOCK
        try:
            assert rows(features.feature_snapshots(silver, dim, cuts, 90, UK)) == alone
        finally:
            features.BLOCK = kept
