from datetime import datetime, timedelta

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from tillmart.operators import (
    append_ledger,
    in_flight_names,
    ledger_close,
    ledger_in_flight,
    ledger_open,
    ledger_reject,
    ledger_state,
    pending_files,
    read_ledger,
)
from tillmart.schemas import LEDGER

T0 = datetime(2024, 1, 1, 6)
T1, T2 = T0 + timedelta(hours=1), T0 + timedelta(hours=2)


@pytest.fixture
def files(spark):
    def make(*rows):
        rows = [(path, path.split("/")[-1], 10, mtime, path.endswith(".csv")) for path, mtime in rows]
        return spark.createDataFrame(rows, "path string, file_name string, length long, mtime timestamp, is_csv boolean")
    return make


def status(events):
    return {(r["file_location"], r["file_mtime"]): r["status"] for r in ledger_state(events).collect()}


def test_open_then_close(files):
    both, one = files(("s/a.csv", T0), ("s/b.csv", T0)), files(("s/a.csv", T0))
    opened = ledger_open(both, T1)
    assert opened.schema.names == LEDGER.names
    events = opened.unionByName(ledger_close(opened, one, T2))
    assert tuples(ledger_state(events)) == [
        ("a.csv", "s/a.csv", T0, T1, T2, "I"),
        ("b.csv", "s/b.csv", T0, T1, None, "A"),
    ]


def test_opened_and_closed_at_the_same_instant_is_finished(files):
    f = files(("s/a.csv", T0))
    opened = ledger_open(f, T1)
    assert status(opened.unionByName(ledger_close(opened, f, T1))) == {("s/a.csv", T0): "I"}


def test_same_name_in_two_folders_is_two_files(files):
    f = files(("s/x/a.csv", T0), ("s/y/a.csv", T0))
    opened = ledger_open(f, T1)
    events = opened.unionByName(ledger_close(opened, files(("s/x/a.csv", T0)), T2))
    assert status(events) == {("s/x/a.csv", T0): "I", ("s/y/a.csv", T0): "A"}
    assert tuples(ledger_in_flight(events, files(("s/x/a.csv", T0)))) == []
    assert tuples(ledger_in_flight(events, f), "file_location") == [("s/y/a.csv",)]
    assert tuples(in_flight_names(events, files(("elsewhere/a.csv", T0)))) == [("a.csv",)]


def test_closing_covers_versions_left_open_by_older_runs(files):
    opened = ledger_open(files(("s/a.csv", T0)), T0).unionByName(ledger_open(files(("s/a.csv", T1)), T1))
    events = opened.unionByName(ledger_close(opened, files(("s/a.csv", T1)), T2))
    assert set(status(events).values()) == {"I"}


def test_pending(files):
    listed = files(
        ("s/new.csv", T0), ("s/open.csv", T0), ("s/done.csv", T0), ("s/again.csv", T1), ("s/bad.csv", T0), ("s/empty.csv", None)
    )
    opened = ledger_open(files(("s/open.csv", T0), ("s/done.csv", T0), ("s/again.csv", T0)), T1)
    events = (
        opened
        .unionByName(ledger_close(opened, files(("s/done.csv", T0), ("s/again.csv", T0)), T2))
        .unionByName(ledger_reject(files(("s/bad.csv", T0), ("s/empty.csv", None)), T1))
    )
    assert tuples(pending_files(listed, events), "file_name") == [("again.csv",), ("new.csv",), ("open.csv",)]


def test_ledger_table(spark, files, tmp_path):
    folder = str(tmp_path / "ledger")
    assert read_ledger(spark, folder).count() == 0
    f = files(("s/a.csv", T0))
    append_ledger(ledger_open(f, T1), folder)
    append_ledger(ledger_close(read_ledger(spark, folder), f, T2), folder)
    assert read_ledger(spark, folder).count() == 2
    assert status(read_ledger(spark, folder)) == {("s/a.csv", T0): "I"}


def test_state_against_brute_force(spark):
    events = spark.range(3000).select(
        F.concat((F.col("id") % 37).cast("string"), F.lit(".csv")).alias("file_name"),
        F.concat(F.lit("s/"), (F.col("id") % 37).cast("string"), F.lit(".csv")).alias("file_location"),
        F.timestamp_seconds(F.col("id") % 3).alias("file_mtime"),
        F.timestamp_seconds(F.hash("id") % 1000).alias("created_date"),
        F.when(F.col("id") % 2 == 0, F.timestamp_seconds(F.hash("id", F.lit(1)) % 1000)).alias("updated_date"),
        F.element_at(F.array(F.lit("A"), F.lit("I"), F.lit("R")), (F.hash("id", F.lit(2)) % 2 + 2).cast("int")).alias("status"),
    )
    latest = {}
    for e in events.collect():
        key, at = (e["file_location"], e["file_mtime"]), (e["updated_date"] or e["created_date"], e["status"])
        latest[key] = max(latest.get(key, at), at)
    assert status(events) == {key: at[1] for key, at in latest.items()}
