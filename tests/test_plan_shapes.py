"""Plan-shape checks on every oracle-checked query: no cross products, no unpartitioned window over rows."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_products(spark):
    qs, oracle = E.queries(), E.oracle_sql()
    bad = []
    for name in sorted(oracle):
        plan = _plan(qs[name](spark, SF))
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            bad.append(name)
    assert not bad, bad


def test_scan_prunes_columns(spark):
    df = E.queries()["eda1_rate_deposit_x_refundable"](spark, SF)
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schema_line = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert schema_line.split(":", 1)[1].count(":") == 4  # date, deposit, refundable, target
    assert "LessThan(date_reservation" in plan  # train split pushed to the scan
