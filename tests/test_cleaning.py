"""Cleaning waterfall (C1–C9) and contracts (K1–K3)."""
import pytest
from pyspark.sql import functions as F

from fixtures import BRONZE_SCHEMA, SAMPLE_TRANSACTIONS, SMOKE_CODES
from tidewell.operators import cleaning, contracts
from tidewell.operators.audited import counters
from tidewell.params import CLEANING_STEPS


def bronze(spark):
    return spark.createDataFrame(SAMPLE_TRANSACTIONS, BRONZE_SCHEMA)


def test_rule_order_is_fixed():
    assert CLEANING_STEPS == ("cancellations_c_invoices", "non_product_stock_code", "invalid_quantity_or_price",
                              "missing_customer_id", "duplicate_line_items", "standardize_types")


def test_drop_cancellations(spark):
    df = spark.createDataFrame([("5001", "A"), ("C5002", "B")], "invoice string, stock_code string")
    assert [r.invoice for r in cleaning.drop_cancellations(df).collect()] == ["5001"]


def test_drop_non_product_is_exact_and_case_sensitive(spark):
    df = spark.createDataFrame([("10001",), ("POST",), ("M",), ("post",)], "stock_code string")
    assert sorted(r.stock_code for r in cleaning.drop_non_product(df).collect()) == ["10001", "post"]


def test_drop_invalid_quantity_price(spark):
    df = spark.createDataFrame([(2, 5.0), (0, 5.0), (2, -1.0), (-3, 5.0)], "quantity long, unit_price double")
    assert cleaning.drop_invalid_qty_price(df).count() == 1


def test_drop_missing_customer_includes_nan(spark):
    df = spark.createDataFrame([(1001.0,), (float("nan"),), (None,)], "customer_id double")
    assert cleaning.drop_missing_customer(df).count() == 1


def test_null_values_never_fire_a_rule(spark):
    df = spark.createDataFrame([(None, None, None, 5.0, 1.0), ("5", "X", 2, None, 1.0)],
                               "invoice string, stock_code string, quantity long, unit_price double, customer_id double")
    kept = cleaning.drop_invalid_qty_price(cleaning.drop_non_product(cleaning.drop_cancellations(df)))
    assert kept.count() == 2


def test_dedupe_keeps_one_and_first_by_ordinal(spark):
    rows = [("1", "A", None, 1, None, 1.0, 5.0, "x", 2), ("1", "A", None, 1, None, 1.0, 5.0, "y", 1)]
    df = spark.createDataFrame(rows, "invoice string, stock_code string, description string, quantity long, "
                                     "invoice_date timestamp_ntz, unit_price double, customer_id double, "
                                     "country string, ord int")
    out = cleaning.dedupe_line_items(df, order_col="ord").collect()
    assert len(out) == 1 and out[0].country == "y"


def test_standardize(spark):
    df = spark.createDataFrame([("1", "A", "d", 3, None, 2.5, 1001.0, " United Kingdom ")], BRONZE_SCHEMA)
    r = cleaning.standardize(df).first()
    assert r.revenue == 7.5 and r.customer_id == "1001" and r.country == "United Kingdom"


def test_smoke_waterfall_counts(spark):
    b = bronze(spark)
    rep = {r.rule: r for r in cleaning.dq_report(b, SMOKE_CODES).collect()}
    removed = [rep[n].rows_removed for n in CLEANING_STEPS]
    assert removed == [1, 1, 2, 1, 1, 0]
    assert rep[CLEANING_STEPS[0]].rows_raw == 15 and rep[CLEANING_STEPS[0]].rows_silver == 9
    assert rep[CLEANING_STEPS[2]].rows_before == 13
    assert cleaning.clean_silver(b, SMOKE_CODES).count() == 9


def test_dq_active_rules_labels(spark):
    act = cleaning.dq_active_rules(cleaning.dq_report(bronze(spark), SMOKE_CODES)).collect()
    assert [r.rule_label for r in sorted(act, key=lambda r: r.rule_order)][0] == "Cancellations C Invoices"
    assert len(act) == 5


def test_silver_contract_holds(spark):
    silver = cleaning.clean_silver(bronze(spark), SMOKE_CODES)
    contracts.assert_contract(silver, contracts.SILVER)
    checks = contracts.contract_checks(silver, contracts.SILVER).collect()
    assert all(r.violations == 0 for r in checks)


def test_contract_reports_every_violation(spark):
    bad = bronze(spark).withColumn("revenue", F.col("quantity") * F.col("unit_price"))
    res = {(r.column, r.check): r.violations for r in contracts.contract_checks(bad, contracts.SILVER).collect()}
    assert res[("quantity", "gt_0")] == 2 and res[("unit_price", "gt_0")] == 1
    types = {r.column: r.status for r in contracts.contract_types(bad, contracts.SILVER).collect()}
    assert types["customer_id"] == "type_mismatch"
    uniq = contracts.contract_unique(bad, contracts.SILVER).first()
    assert uniq.duplicate_keys == 1


def test_counters_observed_on_the_way_equal_a_plain_count(spark):
    from tidewell.session import observer_session
    own = observer_session(spark)
    for b in (bronze(own), bronze(own).filter("quantity < 0"), own.createDataFrame([], BRONZE_SCHEMA)):
        plain = cleaning.counted_rules(b, SMOKE_CODES)
        assert cleaning.rule_counts(b, SMOKE_CODES) == plain
        silver, rules = cleaning.clean_silver_observed(b, SMOKE_CODES)
        assert silver.count() == plain["rows_silver"]
        assert counters(rules) in (None, {k: n for k, n in plain.items() if k != "rows_silver"})
        assert counters(rules) or not plain["rows_silver"]
    empty = cleaning.dq_report(b, SMOKE_CODES).collect()
    assert [r.rows_removed for r in empty] == [0] * 6 and {r.retention_pct for r in empty} == {None}


def test_a_run_with_failed_tasks_is_told(spark):
    from tidewell.operators.audited import undisturbed
    df = spark.range(100).repartition(3)
    save = lambda x: x.write.format("noop").mode("overwrite").save()
    assert undisturbed(spark, lambda: save(df.groupBy(F.col("id") % 7).count()))
    before = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
    with pytest.raises(Exception):
        undisturbed(spark, lambda: save(df.select(F.raise_error(F.lit("no")))))
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == before

    class Retried:
        jobs = stageIds = (1,)
        status, numFailedTasks, currentAttemptId = "SUCCEEDED", 1, 0

        def getJobIdsForGroup(self, _):
            return [1]

        def getJobInfo(self, _):
            return self

        getStageInfo = getJobInfo

    sc = spark.sparkContext
    real = sc.statusTracker
    sc.statusTracker = Retried
    try:
        assert not undisturbed(spark, lambda: None)
        from tidewell.session import observer_session
        assert cleaning.rule_counts(bronze(observer_session(spark)), SMOKE_CODES) == cleaning.counted_rules(
            bronze(spark), SMOKE_CODES)
    finally:
        sc.statusTracker = real


def test_report_of_a_stored_silver_reads_no_source(spark, smoke_dir):
    from tidewell.plans.layers import Layers
    p = Layers(spark, smoke_dir)
    rows = sorted(map(tuple, cleaning.dq_report(p.bronze).collect()))
    assert p.silver.count() == rows[0][8]
    plan = p.dq._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Exchange" not in plan
    assert sorted(map(tuple, p.dq.collect())) == rows
    want = {(r.column, r.check): r.violations for r in contracts.contract_checks(p.silver_plan, contracts.SILVER).collect()}
    assert {(r.column, r.check): r.violations for r in p.silver_checks.collect()} == want


def test_plans_over_silver_pass_bronze_once(spark, smoke_dir, monkeypatch):
    """With no silver stored, a plan that needs it takes the rule counts from its write, not from a pass before."""
    import uuid
    from tidewell.plans import registry
    q = registry.queries()
    names = ("write_summary", "export_csv", "layer_row_counts")
    want = {n: sorted(map(tuple, q[n](spark, smoke_dir).collect())) for n in names}
    passes, plain = [], cleaning.rule_counts
    monkeypatch.setattr(cleaning, "rule_counts", lambda *a: passes.append(1) or plain(*a))
    try:
        for n in names:
            spark.conf.set("spark.tidewell.mart.namespace", uuid.uuid4().hex)
            assert sorted(map(tuple, q[n](spark, smoke_dir).collect())) == want[n] and not passes, n
    finally:
        spark.conf.unset("spark.tidewell.mart.namespace")


def test_line_items_are_not_shuffled_for_their_supplier(spark, smoke_dir, monkeypatch):
    """Where a plan by size would not broadcast the suppliers, up to so many rows they are all the same."""
    from tidewell.session import sql_conf
    from tidewell.sources import testdata
    def shuffled():
        plan = testdata.bronze_from_testdata(spark, smoke_dir)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning(l_suppkey")

    with sql_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert not shuffled()
        rows = testdata.bronze_from_testdata(spark, smoke_dir)
        want = rows.groupBy().agg(F.count("*"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38)"))).first()
        monkeypatch.setattr(testdata, "BROADCAST_SUPPLIERS", 0)
        assert shuffled() == 1
        rows = testdata.bronze_from_testdata(spark, smoke_dir)
        assert rows.groupBy().agg(F.count("*"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38)"))).first() == want
