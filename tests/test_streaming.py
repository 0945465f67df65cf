import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from helpers import DAY, raw_rows
from rxstrata.operators.validation import validate
from rxstrata.operators import enrichment
from rxstrata.streaming import accounting, snapshots
from rxstrata.streaming import events as ev

START = dt.datetime(2024, 1, 1)


def write(spark, folder, *rows):
    """One file of (event_id, seconds after start, type, value, props)."""
    table = spark.createDataFrame(
        [(i, START + dt.timedelta(seconds=s), t, float(v), p) for i, s, t, v, p in rows],
        "event_id long, ts timestamp, event_type string, value double, props string",
    )
    table.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


def event(i, seconds, value=1.0, kind="click", props=None):
    return (i, seconds, kind, value, props)


@pytest.fixture
def run(spark, tmp_path):
    """Run a job over the files there are, one file per batch; again to go on."""

    def go(job, partition_by=()):
        stream = ev.instants(ev.read_table_stream(spark, str(tmp_path), "events", 1))
        return ev.run_to_files(job(stream), str(tmp_path / "out"), str(tmp_path / "ck"), partition_by)

    return go


def test_redelivery_across_batches_and_a_restart(spark, tmp_path, run):
    write(spark, tmp_path, event(1, 0), event(2, 10), event(1, 0))
    assert run(ev.without_redelivery).count() == 2
    write(spark, tmp_path, event(2, 10), event(3, 20))
    rows = run(ev.without_redelivery).orderBy("event_id").collect()
    assert [r.event_id for r in rows] == [1, 2, 3]


def test_volume_windows_close_and_late_rows_drop(spark, tmp_path, run):
    def job(stream):
        return ev.volume(stream, "30 seconds")

    write(spark, tmp_path, event(1, 5), event(2, 59), event(3, 70))
    run(job)
    write(spark, tmp_path, event(4, 200))
    run(job)
    write(spark, tmp_path, event(5, 10), event(6, 400))  # the first is beyond the watermark
    got = {
        (r.window_start - START).seconds: (r.events, r.per_second)
        for r in run(job).collect()
    }
    assert got == {0: (2, 2 / 60), 60: (1, 1 / 60), 180: (1, 1 / 60)}


def test_stream_equals_batch(spark, tmp_path, run):
    rows = [event(i, i * 37, i % 13) for i in range(200)]
    write(spark, tmp_path, *rows)
    write(spark, tmp_path, event(999, 10**6))

    def job(stream):
        return ev.mean_of(stream, "value", 6, "7 days")

    streamed = run(lambda s: ev.mean_of(s, "value", 6, "0 seconds"))
    batch = ev.mean_of(ev.instants(spark.read.parquet(f"{tmp_path}/events.parquet")), "value")
    batch = batch.where(F.col("window_end") < F.lit(START + dt.timedelta(seconds=10**6 - 300)))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_used_up_source_keeps_every_window_and_late_row(spark, tmp_path):
    """Batches in any order of time: nothing is dropped, the last window is there."""
    far = 40 * 86_400
    for seconds in (far, 5, far // 2, 59, far + 3):
        write(spark, tmp_path, event(seconds, seconds))
    stream = ev.instants(ev.read_table_stream(spark, str(tmp_path), "events", 1))
    paths = str(tmp_path / "out"), str(tmp_path / "ck")
    rows = ev.run_to_end(ev.volume(stream), *paths).collect()
    got = {int((r.window_start - START).total_seconds()): r.events for r in rows}
    assert got == {0: 2, far // 2 // 60 * 60: 1, far: 2}
    write(spark, tmp_path, event(7, 7))
    again = ev.run_to_end(ev.volume(stream), *paths).collect()
    assert sum(r.events for r in again) == 6


def test_first_deliveries_of_any_age_stay(spark, tmp_path):
    for i, seconds in ((1, 40 * 86_400), (2, 0), (1, 40 * 86_400), (3, 86_400)):
        write(spark, tmp_path, event(i, seconds))
    stream = ev.instants(ev.read_table_stream(spark, str(tmp_path), "events", 1))
    rows = ev.run_to_files(
        ev.without_redelivery(stream, within=None), str(tmp_path / "out"), str(tmp_path / "ck")
    )
    assert sorted(r.event_id for r in rows.collect()) == [1, 2, 3]


def test_alert_sides(spark):
    means = spark.createDataFrame([(0.79,), (0.8,), (0.81,), (None,)], "mean double")
    assert [r.mean for r in ev.alerts(means, 0.8).collect()] == [0.79]
    assert [r.mean for r in ev.alerts(means, 0.8, above=True).collect()] == [0.81]


def test_incidents_close_after_the_gap(spark):
    def window(start, mean):
        begin = START + dt.timedelta(seconds=start)
        return (begin, begin + dt.timedelta(seconds=300), mean)

    breaches = spark.createDataFrame(
        [window(0, 0.5), window(1800, 0.4), window(3900, 0.7)],
        "window_start timestamp, window_end timestamp, mean double",
    )
    rows = ev.incidents(breaches).orderBy("opened_at").collect()
    assert [(r.windows, r.worst_mean) for r in rows] == [(2, 0.4), (1, 0.7)]
    assert rows[0].last_breach_end == START + dt.timedelta(seconds=2100)


def test_live_incidents_outlast_a_restart(spark, tmp_path, run):
    """An incident that is open when the job stops is written once, later, and whole."""

    def job(stream):
        return ev.live_incidents(stream, "value", 0.8, "event_type", late_by="0 seconds")

    def low(i, seconds, kind="a"):
        return event(i, seconds, 0.5, kind)

    write(spark, tmp_path, low(1, 0), low(2, 310), event(3, 320, 0.6, "b"), event(4, 900, 0.9, "a"))
    write(spark, tmp_path, low(5, 2000))
    assert run(job).count() == 0
    write(spark, tmp_path, low(6, 2400), event(7, 9000, 1.0, "b"))
    write(spark, tmp_path, low(8, 20_000))
    run(job)
    write(spark, tmp_path, event(9, 10**6, 1.0, "z"))
    got = run(job)
    batch = ev.live_incidents(ev.instants(spark.read.parquet(f"{tmp_path}/events.parquet")), "value", 0.8, "event_type")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert sorted((r.event_type, (r.opened_at - START).seconds, r.windows) for r in got.collect()) == [
        ("a", 0, 4), ("a", 19_800, 1), ("b", 300, 1),
    ]
    # the same runs as the batch aggregate over finished windows finds
    means = ev.mean_of(ev.instants(spark.read.parquet(f"{tmp_path}/events.parquet")).where("event_type = 'a'"), "value")
    twin = ev.incidents(ev.alerts(means, 0.8))
    mine = batch.where("event_type = 'a'").drop("event_type")
    assert sorted(map(tuple, twin.collect())) == sorted(map(tuple, mine.collect()))


def accounted(spark, tmp_path, keeps):
    stream = ev.instants(ev.read_table_stream(spark, str(tmp_path), "events", 1))
    return accounting.run_accounted(
        stream, str(tmp_path / "acc"), str(tmp_path / "acc-ck"), keeps, topic="event_type"
    )


def test_every_event_is_accepted_or_set_aside(spark, tmp_path):
    """By the marks of the batches before, per topic, across a restart."""
    keeps = {"fast": 60, "slow": 3600}
    write(spark, tmp_path, event(1, 1000, kind="fast"), event(2, 0, kind="fast"), event(3, 5000, kind="slow"))
    accepted, late = accounted(spark, tmp_path, keeps)
    assert (accepted.count(), late.count()) == (3, 0)
    write(spark, tmp_path, event(4, 939, kind="fast"), event(5, 940, kind="fast"), event(6, 1400, kind="slow"), event(7, 1399, kind="slow"))
    write(spark, tmp_path, event(8, 2000, kind="fast"), event(9, 950, kind="fast"), event(10, 1, kind="other"))
    undated = spark.createDataFrame([(11, None, "fast", 1.0, None)], spark.read.parquet(f"{tmp_path}/events.parquet").schema)
    undated.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    write(spark, tmp_path, event(12, 1939, kind="fast"), event(13, 1401, kind="slow"))
    accepted, late = accounted(spark, tmp_path, keeps)
    assert {r.event_id for r in accepted.collect()} == {1, 2, 3, 5, 6, 8, 9, 13}
    assert {r.event_id: r.late_reason for r in late.collect()} == {
        4: accounting.TOO_OLD, 7: accounting.TOO_OLD, 10: accounting.UNKNOWN_TOPIC,
        11: accounting.NO_TIME, 12: accounting.TOO_OLD,
    }
    assert len(accounting.batches(spark, f"{tmp_path}/acc/marks")) == accounting.KEPT_MARKS


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    """A crash after the outputs but before the commit: the batch runs again alike."""
    keeps = {"fast": 60}
    write(spark, tmp_path, event(1, 1000, kind="fast"))
    write(spark, tmp_path, event(2, 900, kind="fast"), event(3, 1100, kind="fast"))
    first = [sorted(map(str, df.collect())) for df in accounted(spark, tmp_path, keeps)]
    commits = sorted((tmp_path / "acc-ck" / "commits").glob("[0-9]*"))
    (tmp_path / "acc-ck" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    commits[-1].unlink()
    assert [sorted(map(str, df.collect())) for df in accounted(spark, tmp_path, keeps)] == first


def prices(spark, *values):
    return spark.createDataFrame([(float(v),) for v in values], "price_usd double")


def test_streamed_records_get_the_tier_of_their_date(spark, tmp_path):
    """The newest snapshot not after the record's date; a repeated batch sees the old ones."""
    known, schema = f"{tmp_path}/snapshots", "id int, price_usd double, at timestamp"

    def records(*rows):
        table = spark.createDataFrame([(i, float(p), d and dt.datetime(2001, 6, d)) for i, p, d in rows], schema)
        table.coalesce(1).write.mode("append").parquet(f"{tmp_path}/records")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/records")
        rows = snapshots.run_tiered(stream, known, f"{tmp_path}/out", f"{tmp_path}/ck", "at")
        return {r.id: (r.price_tier, r.snapshot_from and r.snapshot_from.day) for r in rows.collect()}

    records((1, 5, 9))
    assert run() == {1: (None, None)}
    snapshots.save_snapshot(prices(spark, *range(1, 101)), known, "2001-06-02")
    snapshots.save_snapshot(prices(spark, *range(1, 11)), known, dt.date(2001, 6, 5))
    records((2, 24, 2), (3, 25, 4), (4, 2, 5), (5, 60, 9), (6, 1, 1), (7, 1, None))
    want = {1: (None, None), 2: ("BUDGET", 2), 3: ("STANDARD", 2), 4: ("BUDGET", 5), 5: ("LUXURY", 5), 6: (None, None), 7: (None, None)}
    assert run() == want
    snapshots.save_snapshot(prices(spark, 1000), known, "2001-06-09")
    commits = sorted((tmp_path / "ck" / "commits").glob("[0-9]*"))
    (tmp_path / "ck" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    commits[-1].unlink()
    assert run() == want
    records((8, 60, 9))
    assert run() == {**want, 8: ("BUDGET", 9)}
    batch = validate(raw_rows(spark, *[{"price": float(p)} for p in range(1, 101)]), DAY)
    tiers = enrichment.add_price_tier(batch, enrichment.price_quartiles(batch)).select("record_id", "price_tier")
    snapshots.save_snapshot(batch, f"{tmp_path}/same", DAY)
    streamed = snapshots.add_price_tier(batch, snapshots.snapshots(spark, f"{tmp_path}/same"), "validation_timestamp")
    assert sorted(map(tuple, tiers.collect())) == sorted(map(tuple, streamed.select("record_id", "price_tier").collect()))


def test_error_gauge_reads_json(spark, tmp_path, run):
    write(
        spark, tmp_path,
        event(1, 0, kind="error", props='{"k": 3}'), event(2, 10, kind="error", props="broken"),
        event(3, 20, props='{"k": 50}'), event(4, 30, kind="error", props='{"k": 4}'),
        event(5, 9000, kind="error", props='{"k": 1}'),
    )
    rows = run(lambda s: ev.error_gauge(s, late_by="0 seconds")).collect()
    assert [(r.error_events, r.error_count) for r in rows] == [(3, 7)]


def test_ingestion_events_split_good_from_bad(spark, tmp_path, run):
    def body(priority):
        return json.dumps({"file_path": "f", "file_size": 1, "timestamp": 2, "source_system": "s",
                           "data_type": "d", "priority": priority})

    write(
        spark, tmp_path,
        event(1, 0, props=body("HIGH")), event(2, 1, props=body("high")),
        event(3, 2, props="not json"), event(4, 3, props=None), event(5, 4, props="{}"),
        event(6, 5, props='{"file_path":"a","priority":"LOW"}'),
        event(7, 6, props=body("LOW").replace('"file_size": 1', '"file_size": "big"')),
    )

    def job(stream):
        return ev.parse_ingestion(stream, "props").select("event_id", "event", "outcome")

    got = {r.event_id: r.outcome for r in run(job, ("outcome",)).collect()}
    assert got == {1: "accepted", **{i: "rejected" for i in range(2, 8)}}
    accepted = spark.read.parquet(str(tmp_path / "out/outcome=accepted"))
    assert accepted.first().event.priority == "HIGH"


def test_validation_streams_as_it_batches(spark, tmp_path):
    rows = raw_rows(spark, {}, {"price": -1.0}, {"drug_name": None}, {"country": "Brazil"})
    rows.write.parquet(f"{tmp_path}/raw.parquet")
    stream = ev.read_table_stream(spark, str(tmp_path), "raw")
    checked = validate(stream, DAY)
    got = ev.run_to_files(checked, str(tmp_path / "out"), str(tmp_path / "ck"))
    want = validate(rows, DAY)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
