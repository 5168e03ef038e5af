import json
from datetime import date, datetime, timezone

import pytest
from conftest import tuples

from ratestrata.plans import daily, quality
from ratestrata.sources import audit
from ratestrata.sources.base import ExtractionError
from ratestrata.sources.payloads import CountriesSource, RatesSource

AT = datetime(2023, 6, 20, 7, 30, tzinfo=timezone.utc)
AS_OF = date(2023, 6, 20)
NOK_DAYS = {1687132800: 10.0, 1687219200: 10.5}  # 19 and 20 June


def payloads(tmp_path, rates=None, name="Norge"):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    for stamp, nok in NOK_DAYS.items():
        body = {"base": "USD", "timestamp": stamp, "rates": rates or {"NOK": nok, "PEN": 3.6512345678, "BAD": 0}}
        (folder / f"{stamp}.json").write_text(json.dumps(body))
    countries = [
        {"cca2": "NO", "cca3": "NOR", "name": {"common": name}, "region": "Europe", "population": 5500001,
         "area": 385000.5, "currencies": {"NOK": {"name": "Krone"}}, "unMember": True},
        {"cca2": "PE", "cca3": "PER", "name": {"common": "Perú"}, "region": "Americas", "population": 34000002,
         "area": 1285000.0, "currencies": {"PEN": {"name": "Sol"}}, "unMember": True},
    ]
    (tmp_path / "countries.json").write_text(json.dumps(countries))
    return RatesSource("rates_api", str(folder)), CountriesSource("countries_api", str(tmp_path / "countries.json"))


def run(spark, tmp_path, run_id="run_001", **more):
    rates, countries = payloads(tmp_path, **more)
    return daily.run_daily(spark, rates, countries, str(tmp_path / "out"), run_id, AS_OF, AT)


def gold_tables(spark, tmp_path):
    layers = daily.Layers(str(tmp_path / "out"))
    names = ["agg_currency_summary", "agg_rates_by_region", "agg_country_currency_map"]
    return {name: tuples(daily.read_table(spark, layers, "gold", name).drop("pipeline_run_id")) for name in names}


def test_the_run_and_its_repetition(spark, tmp_path):
    results = run(spark, tmp_path)
    assert results.count() == 11 and results.filter("not passed").count() == 0
    first = gold_tables(spark, tmp_path)
    summary = {row[1]: row for row in first["agg_currency_summary"]}
    assert set(summary) == {"NOK", "PEN"}
    assert float(summary["NOK"][2]) == 10.5 and float(summary["NOK"][5]) == 5.0
    assert summary["NOK"][6:8] == ("Europe", "Norge")
    assert len(first["agg_rates_by_region"]) == 4 and len(first["agg_country_currency_map"]) == 2

    run(spark, tmp_path, "run_002")
    assert gold_tables(spark, tmp_path) == first
    state = audit.run_state(audit.read_events(spark, daily.Layers(str(tmp_path / "out")).runs))
    assert tuples(state.select("run_id", "source_name", "status", "records_loaded")) == [
        ("run_001", "countries_api", "success", 2), ("run_001", "rates_api", "success", 6),
        ("run_002", "countries_api", "success", 2), ("run_002", "rates_api", "success", 6),
    ]


def test_validation_is_optional(spark, tmp_path):
    rates, countries = payloads(tmp_path)
    daily.run_daily(spark, rates, countries, str(tmp_path / "out"), "r", AS_OF, AT, validated=True)
    state = audit.run_state(audit.read_events(spark, daily.Layers(str(tmp_path / "out")).runs))
    assert {(row.source_name, row.records_loaded) for row in state.collect()} == {("rates_api", 4), ("countries_api", 2)}


def test_failed_extraction_is_recorded(spark, tmp_path):
    rates, countries = payloads(tmp_path)
    (tmp_path / "in" / "bad.json").write_text('{"base": "USD", "timestamp": 1}')
    with pytest.raises(ExtractionError, match="missing field 'rates'"):
        daily.run_daily(spark, rates, countries, str(tmp_path / "out"), "r", AS_OF, AT)
    (row,) = audit.run_state(audit.read_events(spark, daily.Layers(str(tmp_path / "out")).runs)).collect()
    assert row.status == "failed" and "missing field" in row.error_message and row.records_loaded == 0


def test_failed_check_raises_after_it_is_stored(spark, tmp_path):
    with pytest.raises(quality.CheckFailure, match="name_common not_null: 1"):
        run(spark, tmp_path, name=" ")
    stored = daily.read_table(spark, daily.Layers(str(tmp_path / "out")), "gold", "check_results")
    assert stored.count() == 11 and stored.filter("not passed").count() == 1


def test_the_whole_error_is_recorded_and_load_time_is_its_own(spark, tmp_path):
    class Failing(RatesSource):
        def read(self, spark):
            raise RuntimeError("x" * 5000)

    layers = daily.Layers(str(tmp_path / "out"))
    with pytest.raises(ExtractionError):
        daily.ingest(spark, Failing("rates_api"), layers, "raw_currencies", daily.schemas.RATE_FIELDS, daily.RATE_KEYS, "r", AT)
    (row,) = audit.run_state(audit.read_events(spark, layers.runs)).collect()
    assert "x" * 5000 in row.error_message

    rates, _ = payloads(tmp_path)
    later = datetime(2023, 6, 20, 9, 0, tzinfo=timezone.utc)
    daily.ingest(spark, rates, layers, "raw_currencies", daily.schemas.RATE_FIELDS, daily.RATE_KEYS, "r", AT, loaded_at=later)
    landed = daily.read_landing(spark, layers.path("bronze", "raw_currencies"), daily.schemas.RAW_RATES)
    assert {(r.e, r.l) for r in landed.selectExpr("unix_timestamp(_extracted_at) e", "unix_timestamp(_loaded_at) l").collect()} == {
        (int(AT.timestamp()), int(later.timestamp()))
    }
    assert {r.rate for r in landed.collect()} == {"10.0", "10.5", "3.6512345678", "0"}


def test_gold_of_one_base_is_unique(spark, tmp_path):
    rates, countries = payloads(tmp_path)
    (tmp_path / "in" / "other.json").write_text(json.dumps({"base": "CHF", "timestamp": 1687219200, "rates": {"NOK": 11.5}}))
    with pytest.raises(quality.CheckFailure, match="unique"):
        daily.run_daily(spark, rates, countries, str(tmp_path / "out"), "r1", AS_OF, AT)
    results = daily.run_daily(spark, rates, countries, str(tmp_path / "out"), "r2", AS_OF, AT, base="USD")
    assert results.filter("not passed").count() == 0
    assert daily.read_table(spark, daily.Layers(str(tmp_path / "out")), "silver", "fct_exchange_rates").count() == 5


def test_facts_are_written_without_sampling_and_without_a_second_scan(spark, tmp_path):
    from conftest import plan

    from ratestrata.plans import silver, staging

    run(spark, tmp_path)
    layers = daily.Layers(str(tmp_path / "out"))
    rates = staging.stage_rates(daily.read_landing(spark, layers.path("bronze", "raw_currencies"), daily.schemas.RAW_RATES))
    dim = daily.read_table(spark, layers, "silver", "dim_countries")
    text = plan(silver.fct_rates(rates, dim, code_lengths=daily.ISO_LENGTHS))
    assert text.count("target_currency:string") == 1 and "rangepartitioning" not in text


def test_targets_of_any_length_meet_their_countries(spark, tmp_path):
    rates, _ = payloads(tmp_path, rates={"NOK": 10.5, "DIGIKRONE": 2.0, "X": 3.0, "NONE": 4.0})
    path = tmp_path / "countries.json"
    norway, peru = json.loads(path.read_text())
    norway["currencies"] = {"NOK": {"name": "Krone"}, "DIGIKRONE": {"name": "Digital krone"}}
    peru["currencies"] = {"X": {"name": "X"}}
    path.write_text(json.dumps([norway, peru]))
    daily.run_daily(spark, rates, CountriesSource("countries_api", str(path)), str(tmp_path / "out"), "r", AS_OF, AT)
    layers = daily.Layers(str(tmp_path / "out"))
    fct = daily.read_table(spark, layers, "silver", "fct_exchange_rates")
    names = fct.select("target_currency", "currency_region", "primary_country_name").distinct()
    assert tuples(names) == [
        ("DIGIKRONE", "Europe", "Norge"), ("NOK", "Europe", "Norge"), ("NONE", None, None), ("X", "Americas", "Perú"),
    ]
    region = daily.read_table(spark, layers, "gold", "agg_rates_by_region").select("target_currency", "region", "country_count")
    assert tuples(region.distinct()) == [("DIGIKRONE", "Europe", 1), ("NOK", "Europe", 1), ("NONE", "Unknown", 0), ("X", "Americas", 1)]
