import json
from datetime import date, datetime, timezone

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from ratestrata.plans import daily, increment, quality
from ratestrata.sources.landing import landed_folders
from ratestrata.sources.payloads import CountriesSource, RatesSource
from ratestrata.sources.published import Batch

AT = datetime(2023, 9, 1, tzinfo=timezone.utc)
AS_OF = date(2023, 8, 20)


def seconds(day):
    return int(datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp())


def batch_of(folder, *rates):
    """A folder of payloads of (day, target, rate)."""
    folder.mkdir(parents=True)
    for i, (day, target, rate) in enumerate(rates):
        (folder / f"{i}.json").write_text(json.dumps({"base": "USD", "timestamp": seconds(day), "rates": {target: rate}}))
    return RatesSource("rates_api", str(folder))


def countries(path, nok="Norge"):
    rows = [
        {"cca2": "NO", "name": {"common": nok}, "region": "Europe", "population": 5, "currencies": {"NOK": {"name": "Krone"}}},
        {"cca2": "PE", "name": {"common": "Perú"}, "region": "Americas", "population": 9, "currencies": {"PEN": {"name": "Sol"}}},
    ]
    path.write_text(json.dumps(rows))
    return CountriesSource("countries_api", str(path))


FIRST = [("2023-03-05", "NOK", 10.0), ("2023-03-30", "NOK", 11.0), ("2023-06-02", "NOK", 12.0), ("2023-06-03", "NOK", 12.5),
         ("2023-08-01", "NOK", 13.0), ("2023-03-10", "PEN", 3.0), ("2023-04-10", "PEN", 3.5), ("2023-08-20", "PEN", 4.0)]
CASES = {
    "last row of a month changes": ([("2023-03-30", "NOK", 20.0)], ["2023-03", "2023-06"]),
    "a row in between changes, and a new code": ([("2023-03-05", "NOK", 20.0), ("2023-04-02", "NEW", 1.0)], ["2023-03", "2023-04"]),
    "last row turns implausible": ([("2023-03-30", "NOK", 0)], ["2023-03", "2023-06"]),
    "month gets its first row": ([("2023-05-15", "PEN", 9.0)], ["2023-05", "2023-08"]),
    "month loses its only row": ([("2023-04-10", "PEN", 0)], ["2023-04", "2023-08"]),
    "nothing": ([], []),
}


def go(spark, out, rates, places, run, **more):
    return daily.run_daily(spark, rates, places, str(out), run, AS_OF, AT, [quality.PAIR_RULE], **more)


def state(spark, out):
    layers = daily.Layers(str(out))
    tables = {}
    for layer, names in {"silver": ["fct_exchange_rates", "pair_months", "daily_moments"],
                         "gold": ["agg_currency_summary", "agg_rates_by_region", "agg_country_currency_map"]}.items():
        for name in names:
            df = daily.read_table(spark, layers, layer, name)
            tables[name] = tuples(df.drop("pipeline_run_id", "extracted_at"))
    return tables


def versions(spark, out, table="silver.fct_exchange_rates"):
    entries = daily.published(spark, daily.Layers(str(out))).entries()
    return {e.folder: e.version for e in entries if e.table == table and e.folder}


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    """A root after the first run, to be copied."""
    root = tmp_path_factory.mktemp("first")
    go(spark, root / "out", batch_of(root / "in", *FIRST), countries(root / "c.json"), "r1", incremental=True)
    return root / "out"


@pytest.fixture
def out(first, tmp_path):
    import shutil

    shutil.copytree(first, tmp_path / "out")
    return tmp_path / "out"


@pytest.mark.parametrize("case", CASES)
def test_touched_months_only_and_equal_to_a_rebuild(spark, out, tmp_path, case):
    late, months = CASES[case]
    before = versions(spark, out)
    rates = batch_of(tmp_path / "late", *(late or FIRST[:1]))
    if late:
        go(spark, out, rates, countries(tmp_path / "c.json"), "r2", incremental=True)
    else:
        daily.transform(spark, daily.Layers(str(out)), AS_OF, [quality.PAIR_RULE], incremental=True)
    after = versions(spark, out)
    changed = {month for month in before.keys() | after.keys() if before.get(month) != after.get(month)}
    assert changed == set(months)
    got = state(spark, out)
    daily.transform(spark, daily.Layers(str(out)), AS_OF, [quality.PAIR_RULE])
    assert state(spark, out) == got


def test_only_landed_files_of_the_months_are_read(spark, out):
    path = daily.Layers(str(out)).path("bronze", "raw_currencies")
    clean = increment.clean_rates(spark, path, ["2023-06"])
    clean.collect()
    metrics = clean._jdf.queryExecution().executedPlan().toString()
    assert tuples(clean.select("rate_month").distinct()) == [("2023-06",)] and "dynamicpruning" in metrics
    assert landed_folders(spark, path).count() == 4


def test_a_country_that_changes_rebuilds_the_months_of_its_codes(spark, out, tmp_path):
    before = versions(spark, out)
    rates = batch_of(tmp_path / "late", ("2023-08-20", "PEN", 4.0))
    go(spark, out, rates, countries(tmp_path / "c.json", "Noreg"), "r2", incremental=True)
    after = versions(spark, out)
    assert {m for m in after if after[m] != before[m]} == {"2023-03", "2023-06", "2023-08"}
    got = state(spark, out)
    assert {row[-1] for row in got["fct_exchange_rates"]} == {"Noreg", "Perú"}
    daily.transform(spark, daily.Layers(str(out)), AS_OF, [quality.PAIR_RULE])
    assert state(spark, out) == got


def test_a_run_that_dies_changes_no_published_table(spark, out, tmp_path, monkeypatch):
    before = state(spark, out)
    rates = batch_of(tmp_path / "late", ("2023-03-30", "NOK", 20.0))
    places = countries(tmp_path / "c.json", "Noreg")
    write, publish = Batch.write, Batch.publish
    for step in (1, 5, 10):
        calls = []

        def dying(self, *arguments, **named):
            calls.append(1)
            if len(calls) > step:
                raise RuntimeError("died")
            return write(self, *arguments, **named)

        monkeypatch.setattr(Batch, "write", dying)
        with pytest.raises(RuntimeError, match="died"):
            go(spark, out, rates, places, f"died{step}", incremental=True)
        assert state(spark, out) == before
    monkeypatch.setattr(Batch, "write", write)

    def unfinished(self, only=None):
        raise RuntimeError("died")

    monkeypatch.setattr(Batch, "publish", unfinished)
    with pytest.raises(RuntimeError, match="died"):
        go(spark, out, rates, places, "died", incremental=True)
    assert state(spark, out) == before
    monkeypatch.setattr(Batch, "publish", publish)
    go(spark, out, rates, places, "r2", incremental=True)
    got = state(spark, out)
    assert got != before
    daily.transform(spark, daily.Layers(str(out)), AS_OF, [quality.PAIR_RULE])
    assert state(spark, out) == got


def test_a_failed_check_leaves_the_tables(spark, out, tmp_path):
    before = state(spark, out)
    rates = batch_of(tmp_path / "late", ("2023-03-30", "NOK", 20.0))
    rule = quality.Rule("agg_currency_summary", "target_currency", "accepted_values", values=("PEN",))
    with pytest.raises(quality.CheckFailure):
        daily.run_daily(spark, rates, countries(tmp_path / "c.json"), str(out), "r2", AS_OF, AT, [rule], incremental=True)
    assert state(spark, out) == before
    assert daily.read_table(spark, daily.Layers(str(out)), "gold", "check_results").filter("not passed").count() == 1


def test_a_late_batch_comes_from_the_stored_series(spark, frame, tmp_path):
    from datetime import datetime

    from conftest import plan

    from ratestrata import catalog

    line = "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    day, other = datetime(1998, 11, 25), datetime(1998, 11, 3)
    frame(line, (1, 1, 1, 5.0, "A", "O", day), (2, 1, 2, 6.0, "A", "O", day), (3, 1, 2, 70.0, "A", "O", day), (3, 1, 1, 8.0, "N", "O", day),
          (4, 1, 1, 9.0, "A", "F", other), (4, 1, 1, 9.0, None, "F", None)).write.parquet(str(tmp_path / "lineitem.parquet"))
    frame("p_partkey bigint, p_brand string", (1, "B")).write.parquet(str(tmp_path / "part.parquet"))
    rates, late = catalog._late_rates(spark, str(tmp_path))
    assert "lineitem" not in plan(rates) + plan(late) and "Window" not in plan(late)
    short = [F.col("base_currency"), F.col("rate_date"), F.col("rate").cast("double")]
    assert tuples(rates.select(*short)) == sorted([("A", "1998-11-25", 70.0), ("N", "1998-11-25", 8.0), ("A", "1998-11-03", 9.0), (None, None, 9.0)], key=str)
    assert tuples(late.select(*short)) == [("A", "1998-11-25", 170.0), ("N", "1998-11-25", 0.0)]
