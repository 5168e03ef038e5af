import math
import random
import statistics
from datetime import date, timedelta

import pytest
from conftest import plan, tuples
from pyspark.sql import Window, functions as F

from ratestrata.operators import moments, segments
from ratestrata.sources.published import Tables


def rows(frame, n=400, seed=1):
    rng = random.Random(seed)
    cells = [(rng.choice(["long"] * 8 + ["short", None]), i, (i + rng.randrange(3)) // 7 if i % 50 else i // 7, rng.random()) for i in range(n)]
    return frame("k string, t int, seg int, v double", *[(k, t, t // 7, v) for k, t, _, v in cells])


def test_segments_equal_whole_windows(frame):
    df = rows(frame)
    got = segments.segmented(
        df, ["k"], "seg", ["t"], 6,
        lambda w: {"lag": F.lag("v").over(w), "lag5": F.lag("v", 5).over(w), "mean": F.sum("v").over(w.rowsBetween(-6, 0))},
    )
    whole = Window.partitionBy("k").orderBy("t")
    wanted = df.withColumns({"lag": F.lag("v").over(whole), "lag5": F.lag("v", 5).over(whole), "mean": F.sum("v").over(whole.rowsBetween(-6, 0))})
    rounded = lambda x: tuples(x.withColumn("mean", F.round("mean", 9)))
    assert rounded(got) == rounded(wanted) and got.count() == 400


def test_halo_reaches_over_short_and_missing_segments(frame):
    df = frame("k string, t int, seg int, v int", ("a", 1, 0, 10), ("a", 15, 2, 20), ("a", 16, 2, 30), ("a", 80, 11, 40), ("b", 3, 0, 5))
    got = segments.segmented(df, ["k"], "seg", ["t"], 3, lambda w: {"third": F.lag("v", 3).over(w), "last": F.lag("v").over(w)})
    assert tuples(got.select("t", "last", "third")) == [(1, None, None), (15, 10, None), (16, 20, None), (3, None, None), (80, 30, 10)]
    empty = segments.segmented(df.limit(0), ["k"], "seg", ["t"], 3, lambda w: {"last": F.lag("v").over(w)})
    assert empty.count() == 0


def test_no_window_holds_a_whole_series(frame):
    text = plan(segments.segmented(rows(frame), ["k"], "seg", ["t"], 1, lambda w: {"lag": F.lag("v").over(w)}))
    # the only windows of a whole series run over last rows
    assert "WindowGroupLimit" in text and "hashpartitioning(k" in text and "SinglePartition" not in text


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_moments_merge_from_any_parts(frame, parts):
    rng = random.Random(parts)
    values = [1e9 + rng.random() for _ in range(60)]
    df = frame("k string, rate_date date, v double", *[("a", date(2023, 3, 1) + timedelta(days=i % (parts * 3)), v) for i, v in enumerate(values)],
               ("b", date(2023, 3, 1), 5.0), ("b", date(2023, 3, 1), None), (None, date(2023, 3, 2), 7.0))
    days = moments.daily_moments(df, ["k"], "v")
    got = {row.k: row for row in moments.merge_moments(days, ["k"]).select(
        "*", moments.deviation(F.col("n"), F.col("squares")).alias("sd")).collect()}
    assert math.isclose(got["a"].sd, statistics.stdev(values), rel_tol=1e-6) and got["a"].n == 60
    assert math.isclose(got["a"].mean, statistics.fmean(values), rel_tol=1e-12) and got["a"].low == min(values) and got["a"].high == max(values)
    assert (got["b"].n, got["b"].sd, got["b"].mean) == (1, None, 5.0) and got[None].n == 1


def test_trailing_moments_equal_trailing_stats(frame):
    from ratestrata.operators.series import trailing_stats

    rng = random.Random(3)
    df = frame("k string, rate_date date, v double", *[(rng.choice("abc"), date(2023, 3, 1) + timedelta(days=rng.randrange(50)), rng.random()) for _ in range(300)])
    direct = {row.k: row for row in trailing_stats(df, ["k"], "v", "2023-04-10", 30).collect()}
    merged = {row.k: row for row in moments.trailing_from_moments(moments.daily_moments(df, ["k"], "v"), ["k"], "2023-04-10", 30).collect()}
    assert direct.keys() == merged.keys()
    for key, row in direct.items():
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(row[1:], merged[key][1:]))


def folders(spark, tables, name):
    return {(e.folder, e.version) for e in tables.entries() if e.table == name and e.folder}


def test_tables_are_published_together(spark, frame, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    with pytest.raises(LookupError):
        tables.read("a")
    batch = tables.begin()
    first = batch.write("a", frame("m string, v int", ("x", 1), ("y", 2), (None, 3)), F.col("m"))
    batch.write("b", frame("w int", (1,)))
    assert first.count() == 3 and tables.version() is None
    batch.publish()
    assert folders(spark, tables, "a") == {("x", 1), ("y", 1), ("none", 1)} and tables.read("b").count() == 1

    batch = tables.begin()  # dies before it publishes
    batch.write("a", frame("m string, v int", ("x", 9)), F.col("m"), ["x"])
    assert tuples(tables.read("a")) == [("x", 1), ("y", 2), (None, 3)]

    batch = tables.begin()
    after = batch.write("a", frame("m string, v int", ("x", 5)), F.col("m"), ["x", "y"])
    assert tuples(after) == [("x", 5), (None, 3)] and batch.read("b").count() == 1
    batch.publish()
    assert tuples(tables.read("a")) == [("x", 5), (None, 3)] and folders(spark, tables, "a") == {("x", 2), ("none", 1)}
    assert tuples(tables.read("b")) == [(1,)]

    with pytest.raises(ValueError, match="columns"):
        tables.begin().write("a", frame("m string, v string", ("x", "5")), F.col("m"), ["x"])
    batch = tables.begin()
    batch.write("a", frame("m string, v int", ("z", 0)).limit(0), F.col("m"))
    batch.write("b", frame("w int", (2,)))
    batch.publish(["a"])
    assert tables.read("a").count() == 0 and tables.read("a").columns == ["m", "v"] and tuples(tables.read("b")) == [(1,)]


def test_unique_after_batches(spark, frame, tmp_path):
    from ratestrata.plans import quality
    from ratestrata.plans.uniqueness import KeyIndex

    batches = [frame("k string, d int", *rows) for rows in (
        [("a", 1), ("b", 1), ("b", 1), (None, 1)], [("a", 2), ("c", 1), (None, 1)], [("a", 1), ("c", None), ("d", 1), ("d", 1)],
    )]
    index = KeyIndex(spark, str(tmp_path / "keys"), batches[0].schema)
    whole = None
    for i, rows in enumerate(batches):
        whole = rows if whole is None else whole.unionByName(rows)
        assert tuples(index.check(rows)) == tuples(quality.unique(whole, "k", "d"))
        index.add(rows, f"batch {i}")
        index.add(rows, f"batch {i}")  # landed again
    assert tuples(index.check(batches[0].limit(0))) == tuples(quality.unique(whole, "k", "d"))
    assert "keys" in plan(index.check(rows)) and index.read().count() == 6


def test_published_folders_are_chosen_without_moving_rows(spark, frame, tmp_path):
    from ratestrata.plans.uniqueness import KeyIndex

    rows = frame("k string, d int", ("a", 1), ("b", 1), ("b", 1))
    index = KeyIndex(spark, str(tmp_path / "keys"), rows.schema)
    for name in ("one", "two/2", "three = 3%"):
        index.add(rows, name)
    text = plan(index.read())
    # a join with the list of folders would send every key to the task of its folder
    assert "Join" not in text and "Exchange" not in text and "PartitionFilters: [" in text and "createDataFrame" not in text
    assert tuples(index.read()) == sorted([("a", 1, 1), ("b", 1, 2)] * 3)
    index.add(rows.filter("k = 'a'"), "two/2")
    assert tuples(index.check(rows)) == [("a", 1, 4), ("b", 1, 6)]
    assert {e.folder: e.version for e in index.tables.entries() if e.folder} == {"one": 1, "two/2": 4, "three = 3%": 3}
