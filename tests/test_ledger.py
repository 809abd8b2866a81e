"""Landing by a ledger: every file once, whatever stops a run."""

import pytest
from pyspark.sql import functions as F

from tidelake.sources import ledger, tables
from tidelake.streaming import ingest

TYPES = {"order_id": "bigint", "status": "string"}


def drop(root, folder, name, rows, header="order_id,status"):
    place = root / folder if folder else root
    place.mkdir(parents=True, exist_ok=True)
    (place / name).write_text("\n".join([header, *rows]) + "\n")


def route(tmp_path):
    return ingest.route_batch(f"{tmp_path}/valid", f"{tmp_path}/quarantine", r".*\.csv$")


def land(spark, tmp_path, handler=None, name="ledger", max_files=2):
    handler = handler or route(tmp_path)
    return ledger.land_with_ledger(spark, f"{tmp_path}/raw", f"{tmp_path}/{name}", handler, schema=TYPES, max_files=max_files)


def landed(spark, tmp_path):
    return sorted(r.order_id for r in tables.read_evolving(spark, f"{tmp_path}/valid").collect())


def test_files_are_taken_once_however_late_they_come(spark, tmp_path):
    raw = tmp_path / "raw"
    for i in range(5):
        drop(raw, "ingestion_date=2026-01-01/b", f"{i}.csv", [f"{i},paid"])
    assert land(spark, tmp_path) >= 1 and landed(spark, tmp_path) == [0, 1, 2, 3, 4]
    assert land(spark, tmp_path) == 0
    drop(raw, "ingestion_date=2026-01-01/late", "x y%2.csv", ["10,paid", "11,paid"])
    drop(raw, "ingestion_date=2025-12-31", "old.csv", ["12,paid"])
    drop(raw, "", "loose.csv", ["13,paid"])
    drop(raw, "ingestion_date=2026-01-02", "empty.csv", [], header="")
    (raw / "_hidden").mkdir()
    (raw / "_hidden" / "no.csv").write_text("order_id,status\n99,paid\n")
    land(spark, tmp_path)
    assert landed(spark, tmp_path) == [0, 1, 2, 3, 4, 10, 11, 12, 13]
    assert land(spark, tmp_path) == 0
    assert ledger.landed_files(spark, f"{tmp_path}/ledger").count() == 9


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_run_that_dies_is_repeated_under_its_number(spark, tmp_path, when):
    for i in range(4):
        drop(tmp_path / "raw", "d", f"{i}.csv", [f"{i},paid"])
    put, numbers = route(tmp_path), []

    def dies(batch, number):
        numbers.append(number)
        if when == "after":
            put(batch, number)
        raise InterruptedError

    with pytest.raises(InterruptedError):
        land(spark, tmp_path, dies)
    # Files that come in between get numbers of their own.
    drop(tmp_path / "raw", "d", "4.csv", ["4,paid"])
    again = []

    def counts(batch, number):
        again.append(number)
        put(batch, number)

    land(spark, tmp_path, counts)
    assert landed(spark, tmp_path) == [0, 1, 2, 3, 4]
    assert numbers[0] in again and len(again) == len(set(again))


def test_a_lost_ledger_lands_again_beside_the_first(spark, tmp_path):
    drop(tmp_path / "raw", "d", "1.csv", ["1,paid"])
    land(spark, tmp_path)
    land(spark, tmp_path, name="anew")
    assert landed(spark, tmp_path) == [1, 1]
    runs = tables.read_evolving(spark, f"{tmp_path}/valid").select("_run_id").distinct().count()
    assert runs == 2
    assert spark.sparkContext.getLocalProperty(ingest.RUN_ID) is None


def test_batches_are_of_about_the_size_asked_for(spark, tmp_path):
    book = ledger.Ledger(spark, f"{tmp_path}/ledger")
    listed = spark.range(1000).select(F.concat(F.lit("f"), "id").alias("path"), F.lit(1).cast("long").alias("length"))
    book.take(listed, "d", 100)
    sizes = [r["count"] for r in book.files().groupBy("batch_id").count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10 and max(sizes) < 150
    book.take(listed, "d", 100)
    assert book.files().count() == 1000
