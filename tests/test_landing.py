from datetime import datetime, timedelta, timezone

import pytest
from conftest import plan, tuples
from pyspark.sql import functions as F

from ratestrata import schemas
from ratestrata.functions.text import double_text
from ratestrata.operators.upsert import upsert
from ratestrata.sources import audit
from ratestrata.sources import landing as L
from ratestrata.streaming.landing import land_stream

NOW = datetime(2024, 1, 15, tzinfo=timezone.utc)
KEYS = ["base_currency", "target_currency", "rate_date"]
SMALL = "k string, d string, v string, _extracted_at int"


def batch(spark, *rows):
    """Landing rows of (target, day, rate, extraction second)."""
    cells = [("USD", target, rate, day, "0", "s", second, None) for target, day, rate, second in rows]
    frame = spark.createDataFrame(cells, "base_currency string, target_currency string, rate string, rate_date string,"
                                         "timestamp string, _source string, second bigint, _pipeline_run_id string")
    stamped = frame.withColumn("_extracted_at", F.timestamp_seconds("second"))
    return L.to_landing(stamped, schemas.RATE_FIELDS, NOW)


def stored(spark, path):
    return tuples(L.read_landing(spark, path, schemas.RAW_RATES).select("target_currency", "rate_date", "rate"))


def test_landing_is_text(frame):
    rows = frame("b boolean, n bigint, d double, x string, extra int", (True, 5, 17098242.0, None, 1))
    landed = L.to_landing(rows, ["b", "n", "d", "x", "absent"], NOW)
    assert landed.columns == ["b", "n", "d", "x", "absent", *schemas.LINEAGE, "_loaded_at"]
    row = landed.first()
    assert tuple(row)[:5] == ("true", "5", "17098242.0", None, None)
    assert row._source is None and row._loaded_at is not None


@pytest.mark.parametrize("value", [0.0, 1.5, 0.0001, 0.00012345678901234567, 12345678.9, 9007199254740993.0, -17098242.25, 1e16, -2.5e-7, 1e-05, 1.2345e+20, 1e300, 3e-10])
def test_doubles_land_in_plain_digits(frame, value):
    assert frame("d double", (value,)).select(double_text(F.col("d"))).first()[0] == repr(value)


def test_upsert_inserts_overwrites_and_keeps(frame):
    target = frame(SMALL, ("a", "1", "old", 1), ("b", "1", "kept", 1))
    updates = frame(SMALL, ("a", "1", "first", 2), ("a", "1", "second", 3), ("c", "1", "new", 1))
    once = upsert(target, updates, ["k", "d"])
    assert tuples(once) == [("a", "1", "second", 3), ("b", "1", "kept", 1), ("c", "1", "new", 1)]
    assert tuples(upsert(once, updates, ["k", "d"])) == tuples(once)


def test_null_keys_match_nothing(frame):
    target = frame(SMALL, (None, "1", "a", 1))
    updates = frame(SMALL, (None, "1", "b", 2), (None, "1", "c", 2))
    assert [row[2] for row in tuples(upsert(target, updates, ["k", "d"]))] == ["a", "b", "c"]


def test_last_writer_wins_unless_the_newest_shall(frame):
    target, late = frame(SMALL, ("a", "1", "newer", 9)), frame(SMALL, ("a", "1", "older", 2))
    assert tuples(upsert(target, late, ["k", "d"]))[0][2] == "older"
    assert tuples(upsert(target, late, ["k", "d"], newest_wins=True))[0][2] == "newer"
    same = frame(SMALL, ("a", "1", "again", 9))
    assert tuples(upsert(target, same, ["k", "d"], newest_wins=True))[0][2] == "again"


def test_empty_batch_changes_nothing(frame):
    target = frame(SMALL, ("a", "1", "x", 1))
    assert tuples(upsert(target, target.limit(0), ["k", "d"])) == tuples(target)


@pytest.mark.parametrize("partition", [L.RATE_DAY, L.RATE_MONTH, None])
def test_landed_table(spark, tmp_path, partition):
    path = str(tmp_path / "t")

    def land(*rows):
        return L.land(spark, path, batch(spark, *rows), KEYS, schemas.RAW_RATES, partition)

    assert land(("EUR", "2024-01-01", "1", 1), ("EUR", "2024-01-01", "2", 2), ("EUR", "2024-02-01", "3", 1)) == (3, 2)
    assert land(("EUR", "2024-02-01", "4", 3), ("GBP", "2024-02-01", "5", 3), ("GBP", None, "6", 3)) == (3, 3)
    expected = [("EUR", "2024-01-01", "2"), ("EUR", "2024-02-01", "4"), ("GBP", "2024-02-01", "5"), ("GBP", None, "6")]
    assert stored(spark, path) == sorted(expected, key=str)
    assert land() == (0, 0)
    assert land(("EUR", "2024-02-01", "4", 3), ("GBP", "2024-02-01", "5", 3)) == (2, 2)
    assert stored(spark, path) == sorted(expected, key=str)


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    path = tmp_path / "t"
    L.land(spark, str(path), batch(spark, ("A", "2024-01-01", "1", 1), ("A", "2024-01-02", "1", 1)), KEYS,
           schemas.RAW_RATES, L.RATE_DAY)
    first = path / "data" / "version=1" / "folder=2024-01-01"
    files = {p.name for p in first.iterdir()}
    L.land(spark, str(path), batch(spark, ("A", "2024-01-02", "2", 2)), KEYS, schemas.RAW_RATES, L.RATE_DAY)
    assert {p.name for p in first.iterdir()} == files
    assert [p.name for p in (path / "data" / "version=2").iterdir() if p.is_dir()] == ["folder=2024-01-02"]
    assert stored(spark, str(path)) == [("A", "2024-01-01", "1"), ("A", "2024-01-02", "2")]


def test_versions_that_nothing_refers_to_go(spark, tmp_path):
    path = tmp_path / "t"
    for second in range(1, 6):
        L.land(spark, str(path), batch(spark, ("A", "2024-01-02", str(second), second)), KEYS, schemas.RAW_RATES, L.RATE_MONTH)
    assert sorted(p.name for p in (path / "data").iterdir()) == ["version=4", "version=5"]
    assert sorted(p.name for p in (path / "live").iterdir()) == ["4", "5"]
    assert not (path / "incoming").exists()
    assert stored(spark, str(path)) == [("A", "2024-01-02", "5")]


@pytest.mark.parametrize("partition", [L.RATE_MONTH, None])
@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("step", ["counted_per_key", "_publish", "_tidy"])
def test_readers_see_a_whole_table_wherever_a_driver_dies(spark, tmp_path, monkeypatch, partition, first, step):
    path = str(tmp_path / "t")
    args = (KEYS, schemas.RAW_RATES, partition)
    before = [] if first else [("A", "2024-01-01", "1"), ("B", "2024-01-02", "1")]
    if not first:
        L.land(spark, path, batch(spark, ("A", "2024-01-01", "1", 1), ("B", "2024-01-02", "1", 1)), *args)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(L, step, dies)
        with pytest.raises(KeyboardInterrupt):
            L.land(spark, path, batch(spark, ("A", "2024-01-01", "2", 2)), *args)
    after = [("A", "2024-01-01", "2"), *before[1:]]
    assert stored(spark, path) == (after if step == "_tidy" else before)
    L.land(spark, path, batch(spark, ("A", "2024-01-01", "2", 2), ("C", "2024-01-03", "3", 3)), *args)
    assert stored(spark, path) == [*after, ("C", "2024-01-03", "3")]


def test_a_pointer_counts_once_it_is_complete(spark, tmp_path):
    path = tmp_path / "t"
    L.land(spark, str(path), batch(spark, ("A", "2024-01-01", "1", 1)), KEYS, schemas.RAW_RATES)
    (path / "live" / "2").mkdir()
    assert L.current_version(spark, str(path)) == 1
    assert stored(spark, str(path)) == [("A", "2024-01-01", "1")]


def test_the_partition_must_be_of_a_key(spark, tmp_path):
    with pytest.raises(ValueError, match="key"):
        L.land(spark, str(tmp_path / "t"), batch(spark), ["target_currency"], schemas.RAW_RATES, L.RATE_DAY)


def test_arriving_files_update_late_rows(spark, tmp_path):
    arrivals, path = str(tmp_path / "in"), str(tmp_path / "t")

    def run():
        stream = spark.readStream.schema(schemas.RAW_RATES).parquet(arrivals)
        writer = land_stream(stream, path, KEYS, schemas.RAW_RATES, str(tmp_path / "cp"), L.RATE_MONTH)
        writer.trigger(availableNow=True).start().awaitTermination()

    batch(spark, ("A", "2024-01-01", "1", 1)).write.mode("append").parquet(arrivals)
    run()
    batch(spark, ("A", "2024-01-01", "2", 2), ("B", "2024-01-01", "1", 2)).write.mode("append").parquet(arrivals)
    run()
    assert stored(spark, path) == [("A", "2024-01-01", "2"), ("B", "2024-01-01", "1")]


def test_a_repeated_batch_of_a_stream_is_skipped(spark, tmp_path):
    path = str(tmp_path / "t")
    first = batch(spark, ("A", "2024-01-01", "1", 1), (None, "2024-01-01", "7", 1), (None, None, "8", 1))

    def land(rows, number, stream="cp"):
        return L.land(spark, path, rows, KEYS, schemas.RAW_RATES, L.RATE_MONTH, batch=(stream, number))

    assert land(first, 0) == (3, 3) and land(first, 0) == (0, 0)
    assert stored(spark, path) == [("A", "2024-01-01", "1"), (None, "2024-01-01", "7"), (None, None, "8")]
    assert land(batch(spark, (None, "2024-02-01", "9", 2)), 1) == (1, 1) and land(first, 0) == (0, 0)
    assert L.landed_batch(spark, path, "cp") == 1 and L.landed_batch(spark, path, "other") is None
    assert land(first, 0, "other") == (3, 3)  # another stream counts its own batches
    assert len(stored(spark, path)) == 6 and {r.folder for r in L.landed_folders(spark, path).collect()} == {"2024-01", "2024-02", "none"}


def test_a_stream_whose_checkpoint_is_behind_its_table(spark, tmp_path):
    """The driver died after the landing of a batch: Spark repeats it."""
    import shutil

    path, arrivals, checkpoint = (str(tmp_path / name) for name in ("t", "in", "cp"))
    batch(spark, (None, "2024-01-01", "1", 1)).write.parquet(arrivals)

    def run():
        stream = spark.readStream.schema(schemas.RAW_RATES).parquet(arrivals)
        land_stream(stream, path, KEYS, schemas.RAW_RATES, checkpoint).trigger(availableNow=True).start().awaitTermination()

    run()
    shutil.rmtree(f"{checkpoint}/commits")
    run()
    assert stored(spark, path) == [(None, "2024-01-01", "1")]
    batch(spark, (None, "2024-01-02", "2", 1)).write.mode("append").parquet(arrivals)
    run()
    assert stored(spark, path) == [(None, "2024-01-01", "1"), (None, "2024-01-02", "2")]


def test_the_log_of_many_events_stays_small(spark, tmp_path):
    path = str(tmp_path / "runs")
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    events = [
        audit.run_started(spark, f"r{i}", "d", "s", start + timedelta(minutes=i)) if i % 2 == 0
        else audit.run_finished(spark, f"r{i - 1}", "d", "s", "success", start + timedelta(minutes=i), i, i)
        for i in range(40)
    ]
    whole = events[0]
    for event in events[1:]:
        whole = whole.unionByName(event)
    wanted = tuples(audit.run_state(whole))
    for event in events:
        audit.append_event(event, path, most_files=8)
    assert len(audit._files(spark, path)) < 16 and tuples(audit.run_state(audit.read_events(spark, path))) == wanted
    whole.write.mode("append").parquet(path)  # as a merge leaves them that died before it removed its sources
    assert tuples(audit.run_state(audit.read_events(spark, path))) == wanted
    whole.repartition(1000).write.mode("append").parquet(path)
    audit.merge_events(spark, path)
    assert len(audit._files(spark, path)) < 10 and audit.read_events(spark, path).count() == 40
    assert tuples(audit.run_state(audit.read_events(spark, path))) == wanted


def test_runs(spark, tmp_path):
    path = str(tmp_path / "runs")

    def at(minute):
        return datetime(2024, 1, 1, 0, minute, tzinfo=timezone.utc)

    audit.append_event(audit.run_started(spark, "r1", "d", "a", at(0)), path)
    audit.append_event(audit.run_finished(spark, "r1", "d", "a", "success", at(1), 10, 9), path)
    audit.append_event(audit.run_started(spark, "r2", "d", "a", at(2)), path)
    audit.append_event(audit.run_finished(spark, "r2", "d", "a", "failed", at(3), error_message="boom"), path)
    audit.append_event(audit.run_started(spark, "r3", "d", "a", at(4)), path)
    state = audit.run_state(audit.read_events(spark, path))
    assert tuples(state.select("run_id", "status", "records_loaded", "error_message", F.minute("started_at"))) == [
        ("r1", "success", 9, None, 0), ("r2", "failed", 0, "boom", 2), ("r3", "running", None, None, 4),
    ]
    assert [row.status for row in audit.recent_runs(state, 2).collect()] == ["running", "failed"]
    assert "TakeOrderedAndProject(limit=2" in plan(audit.recent_runs(state, 2))


def test_most_rows_of_a_batch_in_one_key_or_without_a_key(spark):
    hot = spark.range(0, 3000, 1, 6).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else cast(id as string) end as k",
        "'1' as d", "cast(id as string) as v", "id as _extracted_at")
    written = upsert(hot.limit(0), hot, ["k", "d"])
    text = plan(written)
    assert text.index("Exchange hashpartitioning") < text.index(", Partial")
    rows = tuples(written)
    assert len(rows) == 1 + 1000 + 1000 and [r for r in rows if r[0] == "hot"] == [("hot", "1", "2997", 2997)]


def test_a_hot_key_sends_a_row_per_map_task_to_both_sides(spark):
    rows = spark.range(0, 3000, 1, 6).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) as k", "'1' as d", "cast(id as string) as v", "id as _extracted_at")
    target = spark.range(0, 3000, 1, 6).selectExpr("if(id = 0, 'hot', concat('t', id)) as k", "'1' as d", "'old' as v", "id as _extracted_at")
    written = upsert(target, rows, ["k", "d"])
    assert written.filter("v = 'old'").count() == 2999 and written.filter("k = 'hot'").collect()[0].v == "2997"
    counted = L.counted_per_key(rows, ["k", "d"], "_extracted_at")
    assert [tuple(r) for r in counted.filter("k = 'hot'").collect()] == [("hot", "1", "2997", 2997, 1000)]
