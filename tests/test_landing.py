"""Landing: incremental files, contract routing, evolving schema, rescued data, retries, lost checkpoints."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tidelake.functions import rules
from tidelake.operators.quality import duplicate_keys, idempotence_check, key_stats
from tidelake.operators.versions import latest_per_key
from tidelake.sources import landing, tables
from tidelake.sources.schemas import stored_schema
from tidelake.streaming import ingest

HINTS = {"channel": "string"}
ORDERS = {"order_id": "bigint", "customer_id": "bigint", "order_date": "date", "status": "string", "channel": "string"}
HEADER4 = "order_id,customer_id,order_date,status"


class Lake:
    def __init__(self, root):
        self.root, self.raw = root, root / "raw"
        self.valid, self.quarantine = f"{root}/valid", f"{root}/quarantine"
        self.schema = f"{root}/schema"

    def drop(self, folder, lines, name="orders.csv", bom=False):
        target = self.raw / folder
        target.mkdir(parents=True, exist_ok=True)
        text = "\n".join(lines) + "\n"
        (target / name).write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())

    def land(self, spark, checkpoint="checkpoint", handler=None, **options):
        options.setdefault("schema_location", self.schema)
        options.setdefault("hints", HINTS)
        return landing.land_files(
            spark,
            str(self.raw),
            f"{self.root}/{checkpoint}",
            handler or ingest.route_batch(self.valid, self.quarantine),
            **options,
        )


@pytest.fixture()
def lake(tmp_path):
    made = Lake(tmp_path)
    made.drop(
        "ingestion_date=2026-08-20/batch_001",
        [HEADER4, "1,10,2026-08-20,paid", "2,11,2026-08-20,created", "3,12,2026-08-20,shipped"],
    )
    return made


def ids(df):
    return sorted(r[0] for r in df.select("order_id").collect())


def test_incremental_route_and_evolution(spark, lake):
    lake.land(spark)
    assert ids(tables.read_evolving(spark, lake.valid)) == [1, 2, 3]

    # A new file is taken alone; a folder outside the contract goes to quarantine.
    lake.drop(
        "ingestion_date=2026-08-23/batch_004",
        [HEADER4, "900001,1001,2026-08-23,paid", "900002,1002,2026-08-23,pending"],
        bom=True,
    )
    lake.drop("ingestion_dt=2026-08-23/batch_005", [HEADER4, "910001,1001,2026-08-23,paid"])
    lake.land(spark)
    valid = tables.read_evolving(spark, lake.valid)
    assert ids(valid) == [1, 2, 3, 900001, 900002]
    rejected = tables.read_evolving(spark, lake.quarantine)
    assert [(r.order_id, r._quarantine_reason) for r in rejected.collect()] == [(910001, "INVALID_SOURCE_PATH")]
    assert key_stats(valid, "order_id", "_source_file").first()["source_files"] == 2

    # A new column reaches both tables; the older files stay valid, columns match by name.
    lake.drop(
        "ingestion_date=2026-08-23/batch_006",
        ["status,channel,order_id,customer_id,order_date", "paid,mobile,930001,1001,2026-08-23"],
    )
    lake.drop(
        "ingestion_dt=2026-08-23/batch_007", [f"{HEADER4},channel", "930003,1003,2026-08-23,paid,web"]
    )
    lake.land(spark)
    valid, rejected = tables.read_evolving(spark, lake.valid), tables.read_evolving(spark, lake.quarantine)
    for frame in (valid, rejected):
        assert dict(frame.dtypes)["channel"] == "string"
    assert dict(valid.dtypes)["order_id"] in ("int", "bigint") and dict(valid.dtypes)["order_date"] == "date"
    new = valid.filter("channel IS NOT NULL").first()
    assert (new.order_id, new.status, new.channel, str(new.ingestion_date)) == (930001, "paid", "mobile", "2026-08-23")
    assert valid.filter("_rescued_data IS NOT NULL").count() == 0
    assert stored_schema(spark, lake.schema)[1] == 2
    lake.land(spark)
    assert tables.read_evolving(spark, lake.valid).count() == valid.count()


def test_values_and_lines_that_do_not_fit_are_rescued(spark, lake):
    lake.land(spark)
    lake.drop(
        "ingestion_date=2026-08-24/batch_008",
        [HEADER4, "BAD_ID,10,2026-08-24,paid", "5,10,someday,paid", "6,10,2026-08-24,paid,extra", "7,8,2026-08-24,"],
    )
    lake.land(spark)
    rows = tables.read_evolving(spark, lake.valid).filter("ingestion_date = '2026-08-24'")
    rescued = {r.customer_id: r for r in rows.filter("order_id IS NULL").collect()}
    assert rescued[10]._rescued_data == '{"order_id":"BAD_ID"}'
    by_id = {r.order_id: r._rescued_data for r in rows.filter("order_id IS NOT NULL").collect()}
    assert by_id[5] == '{"order_date":"someday"}'
    assert "extra" in by_id[6] and by_id[7] is None


def test_given_schema_and_quoted_headers(spark, lake):
    lake.drop(
        "ingestion_date=2026-08-21/batch_002",
        ['"order_id","customer_id","order_date","status","channel"', '8,1,2026-08-21,paid,"web, mobile"'],
    )
    lake.land(spark, schema=ORDERS, schema_location=None)
    valid = tables.read_evolving(spark, lake.valid)
    assert [t for c, t in valid.dtypes if c in ORDERS] == list(ORDERS.values())
    assert valid.filter("order_id = 8").first().channel == "web, mobile"


def test_old_files_are_landed_too(spark, lake):
    lake.land(spark)
    for number, days in ((2, 30), (3, 400), (4, 0)):
        folder = f"ingestion_date=2026-08-2{number}/batch_00{number}"
        lake.drop(folder, [HEADER4, f"{10 * number},1,2026-08-21,paid"])
        then = time.time() - days * 86400
        os.utime(lake.raw / folder / "orders.csv", (then, then))
        lake.land(spark)
    assert ids(tables.read_evolving(spark, lake.valid)) == [1, 2, 3, 20, 30, 40]


@pytest.mark.parametrize("lines", [1, 40_000])
def test_one_header_rule_at_every_size(spark, lake, lines):
    head = ["", "\ufeff order_id, customer_id ,,a,a,Status", *["7,1,x,y,z,paid"] * lines]
    lake.drop("ingestion_date=2026-08-21/batch_002", head)
    lake.land(spark, handler=ingest.route_batch(lake.valid, lake.quarantine))
    row = tables.read_evolving(spark, lake.valid).filter("order_id = 7").first()
    assert (row.customer_id, row._c2, row.a3, row.a4) == (1, "x", "y", "z")
    # The first file has a column "status": a name that differs in case is not that column.
    assert row.status is None and json.loads(row._rescued_data) == {"Status": "paid"}
    assert tables.read_evolving(spark, lake.valid).filter("order_id = 7").count() == lines


def test_columns_outside_a_given_schema_are_rescued(spark, lake):
    lake.drop("ingestion_date=2026-08-21/batch_002", ["order_id,STATUS,channel,note", "x,paid,web,hello", "8,paid,,"])
    given = {"order_id": "bigint", "status": "string"}
    lake.land(spark, schema=given, schema_location=None)
    rows = {r.order_id: r for r in tables.read_evolving(spark, lake.valid).filter("_source_file like '%batch_002%'").collect()}
    assert json.loads(rows[None]._rescued_data) == {"order_id": "x", "STATUS": "paid", "channel": "web", "note": "hello"}
    assert rows[8].status is None and json.loads(rows[8]._rescued_data) == {"STATUS": "paid"}


def test_names_that_differ_in_case_do_not_stop_the_stream(spark, lake):
    lake.drop("ingestion_date=2026-08-21/batch_002", ["Order_ID,channel", "5,web"])
    for _ in range(2):
        lake.land(spark)
    known, _ = stored_schema(spark, lake.schema)
    assert "Order_ID" not in known and "channel" in known
    row = tables.read_evolving(spark, lake.valid).filter("channel = 'web'").first()
    assert row.order_id is None and json.loads(row._rescued_data) == {"Order_ID": "5"}


def test_headers_are_read_in_one_job(spark, lake):
    for number in range(2, 12):
        lake.drop(f"ingestion_date=2026-08-21/batch_{number:03d}", [f"{HEADER4},c{number}", *["1,2,2026-08-21,paid,x"] * 50_000])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(lake.raw)).select("path", "length")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        groups = landing.group_by_header(files)
        jobs = len(tracker.getJobIdsForGroup("headers"))
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert len(groups) == 11 and jobs <= 3  # the list of files, its listing, the headers


def test_a_quarantine_without_rows_reads_as_empty(spark, lake):
    lake.land(spark)
    empty = tables.read_evolving(spark, lake.quarantine)
    assert empty.count() == 0 and "_quarantine_reason" in empty.columns and "order_id" in empty.columns


def test_failure_between_the_two_writes_is_repaired(spark, lake):
    lake.drop("ingestion_dt=2026-08-20/batch_002", [HEADER4, "4,1,2026-08-20,paid"])
    route = ingest.route_batch(lake.valid, lake.quarantine)
    calls = []

    def fails_once(batch, batch_id):
        valid, _ = rules.split_by_contract(batch)
        if not calls:
            calls.append(1)
            tables.write_batch_once(valid, lake.valid, ingest.streaming_query_id(batch), batch_id)
            raise RuntimeError("lost between the writes")
        route(batch, batch_id)

    with pytest.raises(Exception, match="lost between the writes"):
        lake.land(spark, handler=fails_once)
    assert tables.read_evolving(spark, lake.valid).count() == 3
    lake.land(spark, handler=fails_once)
    assert ids(tables.read_evolving(spark, lake.valid)) == [1, 2, 3]
    assert ids(tables.read_evolving(spark, lake.quarantine)) == [4]


def test_lost_checkpoint_doubles_bronze_but_not_silver(spark, lake):
    lake.drop("ingestion_date=2026-08-21/batch_002", [HEADER4, "3,12,2026-08-21,paid", ",5,2026-08-21,paid"])
    lake.land(spark, max_files=1)
    first = tables.read_evolving(spark, lake.valid)
    assert first.count() == 5
    lake.land(spark, checkpoint="new_checkpoint")
    bronze = tables.read_evolving(spark, lake.valid)
    stats = key_stats(bronze, "order_id").first()
    assert (stats.total_rows, stats.distinct_keys, stats.duplicate_rows, stats.null_keys) == (10, 3, 7, 2)
    assert duplicate_keys(bronze.dropna(subset=["order_id"]), ["order_id"], ordered=True).first()[:] == (3, 4)
    order = ["_ingestion_timestamp", "_source_file"]
    silver = latest_per_key(bronze, ["order_id"], order, drop_null_keys=True)
    assert idempotence_check(silver, "order_id").first()[0] == "PASS"
    assert silver.filter("order_id = 3").first().status == "paid"
    # A NULL key is one more group unless it is left out.
    assert latest_per_key(bronze, ["order_id"], order).count() == 4


def test_fixed_schema_stream(spark, tmp_path):
    lake = Lake(tmp_path)
    for i in range(3):
        lake.drop(f"batch_80000{i}", [f"{HEADER4},channel", f"{i},1,2026-08-25,paid,web"])
    schema = ", ".join(f"{c} {t}" for c, t in ORDERS.items())
    rows = landing.csv_stream(spark, str(lake.raw), schema)
    kept = rules.only_paths(rows, r".*/batch_80000[01]/orders\.csv$")
    ingest.run_available_now(kept, f"{tmp_path}/out", f"{tmp_path}/cp")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert ids(out) == [0, 1]
    assert out.select(F.countDistinct("_source_file")).first()[0] == 2


def test_rows_with_nothing_to_rescue_build_no_map(spark):
    rows = [("1", "x", None), ("n/a", "x", None), ("1", "x", {}), ("1", "x", {"more": "z", "none": None}), (None, None, {"none": None})]
    df = spark.createDataFrame(rows, "a string, b string, others map<string,string>")
    got = rules.with_rescued(df, {"a": "bigint", "b": "string"}, "others")
    assert [r._rescued_data for r in got.collect()] == [None, '{"a":"n/a"}', None, '{"more":"z"}', None]
    text = got._jdf.queryExecution().analyzed().toString()
    # The map is made inside another condition only.
    assert text.count("CASE WHEN (size(map_filter(") == text.count("THEN CASE WHEN (size(map_filter(") == 1
