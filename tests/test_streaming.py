"""The window stream: equal to the batch run, late rows dropped, restart from a checkpoint."""

import json
import os
import random

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from kerbline.sources.readers import read_events_json
from kerbline.streaming import intake, manifest, sinks, windows

COLUMNS = ["window_start", "window_end", "street_marker", "occupancy_rate", "event_count"]


def drop(folder, number, events):
    """One event file; its time of change puts the files in order."""
    path = folder / f"event_{number}.json"
    keys = ("device_id", "street_marker", "event_time", "occupied")
    path.write_text("".join(json.dumps(dict(zip(keys, e, strict=True))) + "\n" for e in events))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def run(spark, tmp_path, mode="update"):
    stream = windows.window_occupancy(windows.stream_events(spark, str(tmp_path / "in"), 1))
    query = sinks.start_window_sink(
        stream, str(tmp_path / "out"), str(tmp_path / "state"), mode=mode, once=True
    )
    assert query.awaitTermination(120)
    assert query.exception() is None
    return query


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in"


def test_stream_equals_batch_and_restarts(spark, tmp_path, folder):
    drop(folder, 0, [("1", "A", "2024-01-01 10:00:30+00:00", 1), ("2", "B", "2024-01-01 10:01:00", 0)])
    drop(folder, 1, [("1", "A", "2024-01-01 10:02:10", 0), ("x", "A", "bad", 1)])
    run(spark, tmp_path)
    drop(folder, 2, [("1", "A", "2024-01-01 10:04:00", 1)])
    run(spark, tmp_path)
    batch = windows.window_occupancy(read_events_json(spark, str(folder)))
    got = sinks.latest_windows(spark, str(tmp_path / "out"))
    assert sorted(rows(got, *COLUMNS)) == sorted(rows(batch, *COLUMNS))
    assert got.filter("street_marker = 'A'").agg({"event_count": "max"}).first()[0] == 3
    changed = rows(
        windows.occupancy_change(got, 1).filter("street_marker = 'B'").orderBy("window_start"),
        "occupancy_change",
    )
    assert changed == [(None,), (0.0,), (0.0,), (0.0,), (0.0,)]


def test_late_rows_are_dropped(spark, tmp_path, folder):
    drop(folder, 0, [("1", "A", "2019-09-03 13:30:00+00:00", 0)])
    drop(folder, 1, [("1", "A", "2019-09-03 13:31:00+00:00", 1)])
    drop(folder, 2, [("1", "A", "2019-09-01 08:06:25+00:00", 1)])
    run(spark, tmp_path)
    got = sinks.latest_windows(spark, str(tmp_path / "out"))
    starts = [r.window_start for r in got.collect()]
    assert min(starts) == at("2019-09-03 13:26:00")
    assert windows.window_occupancy(read_events_json(spark, str(folder))).count() == len(starts) + 5


def test_append_sink_waits_for_the_watermark(spark, tmp_path, folder):
    drop(folder, 0, [("1", "A", "2024-01-01 10:00:00", 1)])
    drop(folder, 1, [("1", "A", "2024-01-01 10:30:00", 1)])
    drop(folder, 2, [("1", "A", "2024-01-01 10:31:00", 1)])
    stream = windows.window_occupancy(windows.stream_events(spark, str(folder), 1))
    query = sinks.start_append_sink(
        stream, str(tmp_path / "out"), str(tmp_path / "state"), once=True
    )
    assert query.awaitTermination(120)
    starts = [r.window_start for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(starts) == 5 and max(starts) == at("2024-01-01 10:00:00")


def test_sorted_windows_need_complete_mode(spark, tmp_path, folder):
    drop(folder, 0, [("1", "A", "2024-01-01 10:00:00", 1)])
    stream = windows.sorted_windows(
        windows.window_occupancy(windows.stream_events(spark, str(folder), 1))
    )
    with pytest.raises(Exception, match="(?i)sort"):
        sinks.start_window_sink(stream, str(tmp_path / "a"), str(tmp_path / "s1"), once=True)
    query = sinks.start_window_sink(
        stream, str(tmp_path / "b"), str(tmp_path / "s2"), mode="complete", once=True
    )
    assert query.awaitTermination(120)
    assert sinks.latest_windows(spark, str(tmp_path / "b")).count() == 5


def test_console_sink_runs(spark, tmp_path, folder, capfd):
    drop(folder, 0, [("1", "A", "2024-01-01 10:00:00", 1)])
    stream = windows.window_occupancy(windows.stream_events(spark, str(folder)))
    query = sinks.start_console(stream, str(tmp_path / "state"), once=True)
    assert query.awaitTermination(120) and query.exception() is None


def test_new_checkpoint_keeps_old_windows(spark, tmp_path, folder):
    drop(folder, 0, [("1", "A", "2024-01-01 10:00:30", 1)])
    run(spark, tmp_path)
    (folder / "event_0.json").rename(tmp_path / "read.json")
    drop(folder, 1, [("1", "A", "2024-01-01 10:02:30", 0), ("1", "B", "2024-01-01 12:00:00", 1)])
    stream = windows.window_occupancy(windows.stream_events(spark, str(folder), 1))
    query = sinks.start_window_sink(stream, str(tmp_path / "out"), str(tmp_path / "fresh"), once=True)
    assert query.awaitTermination(120) and query.exception() is None
    got = {(r.window_start, r.street_marker): r.occupancy_rate for r in sinks.latest_windows(spark, str(tmp_path / "out")).collect()}
    assert got[at("2024-01-01 09:56:00"), "A"] == 1.0  # only the first run saw it
    assert got[at("2024-01-01 10:00:00"), "A"] == 0.0  # the second run's version is newer
    assert got[at("2024-01-01 12:00:00"), "B"] == 1.0 and len(got) == 4 + 1 + 2 + 5
    assert len(manifest.read(spark, str(tmp_path / "out")).done) == 2


def test_folders_stay_few_and_repeats_are_left_out(spark, tmp_path):
    path, seen = str(tmp_path / "out"), {}
    for number in range(23):
        made = [(at("2024-01-01 10:00:00"), at("2024-01-01 10:05:00"), f"s{number % 5}", float(number), number)]
        made += [(at("2024-01-01 10:00:00"), at("2024-01-01 10:05:00"), f"t{number}", 0.5, 1)]
        batch = spark.createDataFrame(made, "window_start timestamp, window_end timestamp, street_marker string, occupancy_rate double, event_count long")
        sinks.write_windows(batch, number, path, "r", fanout=3)
        sinks.write_windows(batch.withColumn("event_count", F.lit(-1).cast("long")), number, path, "r", fanout=3)
        seen |= {r[2]: r[4] for r in made}
        # two levels of at most two folders, and those replaced by the last change
        held = manifest.read(spark, path)
        assert len(held.entries) <= 2 * 3 and sinks.written_folders(spark, path) <= len(held.entries) + 3
        assert len(os.listdir(tmp_path / "out" / "manifest")) <= manifest.KEPT
    got = dict(rows(sinks.latest_windows(spark, path), "street_marker", "event_count"))
    assert got == seen
    assert [e["level"] for e in held.entries] == sorted((e["level"] for e in held.entries), reverse=True)


def test_a_change_that_fails_leaves_the_list_before(spark, tmp_path):
    path = str(tmp_path / "t")
    held = manifest.commit(spark, path, manifest.read(spark, path), lambda m: m.entries.append({"folder": "a"}) or [])
    (tmp_path / "t" / "manifest" / f"{2:012d}").mkdir()  # begun, never marked
    assert manifest.read(spark, path).entries == held.entries == [{"folder": "a"}]


def test_change_stream_equals_batch(spark, tmp_path, folder):
    pick = random.Random(3)
    events = [
        ("d", pick.choice("AB"), f"2024-01-01 10:{m:02d}:{pick.randrange(60):02d}", pick.randrange(2))
        for m in range(40) for _ in range(pick.randrange(4))
    ]
    for number in range(4):
        drop(folder, number, events[number * len(events) // 4 : (number + 1) * len(events) // 4])
    for number, hour in enumerate((20, 21, 22)):  # later events close the windows and the join
        drop(folder, 4 + number, [("d", "Z", f"2024-01-01 {hour}:00:00", 1)])
    stream = windows.occupancy_change_stream(windows.stream_events(spark, str(folder), 1))
    query = sinks.start_append_sink(stream, str(tmp_path / "out"), str(tmp_path / "state"), once=True)
    assert query.awaitTermination(300) and query.exception() is None
    got = rows(spark.read.parquet(str(tmp_path / "out")), *COLUMNS, "occupancy_change")
    batch = windows.occupancy_change(windows.window_occupancy(read_events_json(spark, str(folder))))
    wanted = rows(batch.filter("street_marker <> 'Z'"), *COLUMNS, "occupancy_change")
    assert sorted((r for r in got if r[2] != "Z"), key=str) == sorted(wanted, key=str)
    assert any(r[5] is not None for r in wanted)
    kept = sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"])
    assert kept < 60  # windows of the last event, not those of the morning


def test_intake_splits_every_line(spark, tmp_path, folder):
    drop(folder, 0, [("1", "A", "2024-01-01 10:00:00", 1), ("1", "A", "bad", 1), ("1", None, "2024-01-01 10:00:00", 1)])
    (folder / "event_1.json").write_text('{"device_id": "2", "street\n{"device_id": "3", "street_marker": "B", '
                                         '"event_time": "2024-01-01 10:30:00", "occupied": "x"}\n')
    os.utime(folder / "event_1.json", (1_700_000_001, 1_700_000_001))
    drop(folder, 2, [("4", "B", "2024-01-01 11:00:00", 0)])
    drop(folder, 3, [("5", "A", "2024-01-01 10:45:30", 1), ("5", "A", "2024-01-01 10:44:59", 1), ("5", "A", "2024-01-01 12:00:00", 1)])
    out = str(tmp_path / "in2")

    def take(**given):
        query = intake.start_intake(spark, str(folder), out, str(tmp_path / "s1"), max_files=1, once=True, **given)
        assert query.awaitTermination(300) and query.exception() is None

    take()
    reasons = sorted(rows(intake.rejects(spark, out), "reason"))
    # 10:44 is in windows up to 10:49; 11:00 less ten minutes closed those. 10:45 is in one up to 10:50 too.
    assert reasons == [("corrupt",), ("corrupt",), ("late",), ("late",), ("no street",), ("no time",)]
    assert sorted(rows(intake.events(spark, out), "device_id")) == [("1",), ("4",), ("5",)]
    assert intake.events(spark, out).count() + intake.rejects(spark, out).count() == 9
    drop(folder, 4, [("6", "A", "2024-01-01 11:00:00", 1), ("6", "A", "2024-01-01 11:59:00", 1)])
    take()
    assert rows(intake.rejects(spark, out).filter("reason = 'late'").filter("value like '%\"6\"%'").select(F.count("*"))) == [(1,)]
    stream = windows.window_occupancy(intake.event_stream(spark, out))
    query = sinks.start_window_sink(stream, str(tmp_path / "w"), str(tmp_path / "s2"), once=True)
    assert query.awaitTermination(300) and query.exception() is None
    batch = windows.window_occupancy(intake.events(spark, out))
    assert sorted(rows(sinks.latest_windows(spark, str(tmp_path / "w")), *COLUMNS)) == sorted(rows(batch, *COLUMNS))
