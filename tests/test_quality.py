"""Cleaning, splitting, conflicts and checks on literal rows."""

import datetime as dt

from pyspark.sql import functions as F

from tidelake.functions import rules
from tidelake.operators import quality, versions

RAW = "order_id string, customer_id string, order_date string, status string, ingestion_date string, _rescued_data string"


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def test_clean_and_quarantine(spark):
    df = rules.normalize_orders(
        raw(
            spark,
            ("77", "31", "2025-02-03", "  Shipped ", "2025-02-05", None),
            ("78", "32", "2025-02-03", "lost", "2025-02-05", None),
            ("seven", "33", "2025-02-04", "paid", "2025-02-05", None),
            ("79", "34", "2025-02-04", None, "2025-02-05", None),
            ("80", "35", "4 Feb", "created", "2025-02-05", None),
            ("81", "36", "2025-02-04", "cancelled", "2025-02-05", '{"x":"1"}'),
            ("82", "37", "2025-02-04", "pending", "2025-02-05", None),
        )
    )
    valid = quality.valid_orders(df).collect()
    assert [(r.order_id, r.customer_id, r.status, r.order_date) for r in valid] == [
        (77, 31, "shipped", dt.date(2025, 2, 3))
    ]
    customers = lambda frame: sorted(r.customer_id for r in frame.collect())
    assert customers(quality.invalid_orders(df)) == [32, 33, 34, 35, 36, 37]
    # Negating the rules one by one loses the row whose only fault is a NULL status.
    assert customers(quality.invalid_orders_strict(df)) == [32, 33, 35, 36, 37]
    assert customers(quality.valid_orders(df, ("shipped", "pending"))) == [31, 37]


def test_contract_on_null_and_bad_paths(spark):
    good = "s3://lake/orders/ingestion_date=2026-08-23/batch_004/orders.csv"
    paths = [good, good.replace("_date", "_dt"), good.replace("orders.csv", "orders_bad.csv"), None]
    df = spark.createDataFrame([(p,) for p in paths], "_source_file string")
    valid, broken = rules.split_by_contract(df)
    assert [r[0] for r in valid.collect()] == [good]
    assert broken.count() == 3 and broken.filter("_quarantine_reason = 'INVALID_SOURCE_PATH'").count() == 3
    dated = {r._source_file: r.ingestion_date for r in rules.with_ingestion_date(df).collect()}
    assert dated[good] == dt.date(2026, 8, 23) and dated[paths[1]] is None


def test_stats_conflicts_checks(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", None), (1, 1, "a", None), (1, 1, "b", None), (None, 1, "c", 1), (2, 1, "d", 1)],
        "k int, seq int, v string, w int",
    )
    assert quality.key_stats(df, "k").first()[:] == (5, 2, 3, 2, 1)
    assert [r[:] for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 3)]
    assert [r[:] for r in quality.conflicts(df, ["k", "seq"], ["v", "w"]).collect()] == [(1, 1, 2)]
    assert quality.idempotence_check(df, "k").first()[0] == "FAIL"
    assert versions.drop_exact(df, ["k", "seq", "v"]).count() == 4
    result = quality.mismatch(quality.double_native(df, "seq", "p"), F.col("seq") * 2, "p").first()
    assert result[:] == (5, 0, "PASS")
    assert quality.mismatch(df.withColumn("p", F.lit(3)), F.col("seq") * 2, "p").first()[1:] == (5, "FAIL")


def test_event_category(spark):
    rows = [("403", "getTable"), (None, "deleteTable"), ("200", "DELETETable"), ("200", "get"), ("n/a", "listTokens")]
    df = spark.createDataFrame(rows, "code string, action string")
    found = [r[0] for r in df.select(rules.event_category(F.col("code"), F.col("action"))).collect()]
    assert found == ["ERROR", "SENSITIVE", "SENSITIVE", "STANDARD", "SENSITIVE"]


def test_anomaly_profile(spark):
    t = dt.datetime(2026, 1, 1)
    orders = spark.createDataFrame([(1,), (1,), (2,)], "customer_id int")
    payments = spark.createDataFrame([(None, "accepted"), (1.0, "INVALID"), (2.0, "refused")], "amount double, status string")
    events = spark.createDataFrame([(1, t), (1, t - dt.timedelta(days=14)), (2, t)], "event_id int, event_time timestamp")
    got = {r.metric: (r.rows, r.oldest) for r in quality.anomaly_profile(orders, payments, events).collect()}
    assert got == {
        "hottest_key_rows": (2, None),
        "null_amounts": (1, None),
        "invalid_statuses": (1, None),
        "duplicate_ids": (1, t - dt.timedelta(days=14)),
    }


def test_snapshot_refuses_to_cut(spark):
    df = spark.range(4)
    assert len(versions.snapshot(df, "id", 4)) == 4
    try:
        versions.snapshot(df, "id", 3)
    except ValueError as error:
        assert "SNAPSHOT_TOO_LARGE" in str(error)
    else:
        raise AssertionError("a cut snapshot must be an error")
