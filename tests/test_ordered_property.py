"""Property test: range-partitioned running totals equal a pandas cumsum."""
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.operators.ordered import running_totals

rows = st.lists(st.tuples(st.integers(0, 3), st.integers(-1000, 1000), st.integers(-50, 50)),
                min_size=1, max_size=300, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, parts=st.integers(1, 9), desc=st.booleans())
def test_running_totals_match_pandas(spark, data, parts, desc):
    df = spark.createDataFrame(data, "g int, k int, v int")
    order = [F.col("k").desc() if desc else F.col("k").asc()]
    got = running_totals(df, order, {"v": F.col("v")}, ("g",), parts).toPandas()
    pdf = pd.DataFrame(data, columns=["g", "k", "v"]).sort_values(["g", "k"], ascending=[True, not desc])
    pdf["pos"] = pdf.groupby("g").cumcount() + 1
    pdf["cum_v"] = pdf.groupby("g")["v"].cumsum()
    merged = got.merge(pdf, on=["g", "k"], suffixes=("", "_exp"))
    assert len(merged) == len(data)
    assert (merged["pos"] == merged["pos_exp"]).all()
    assert (merged["cum_v"] == merged["cum_v_exp"]).all()
