from datetime import date, datetime

import pytest
from conftest import tuples

from ratestrata.plans import feeds, quality

SUMMARY = ("base_currency string, target_currency string, latest_rate double, inverse_rate double, rate_date date, "
           "day_over_day_change_pct double, region string, primary_country_name string, rate_avg_30d double, "
           "volatility_tier string")
DAY = date(2024, 1, 15)


@pytest.fixture
def summary(frame):
    return frame(
        SUMMARY,
        ("USD", "MDL", 17.31268, 0.05776, DAY, 0.617, "Europe", "Moldova", 17.2051, "low"),
        ("USD", "LAK", 21873.5, 0.0000457, DAY, -1.372, "Asia", "Laos", 21740.25, "medium"),
        ("USD", "XXX", None, None, None, None, None, None, None, "odd"),
        ("GBP", "MDL", 22.5, 0.04, DAY, 0.0, "Europe", "Moldova", 22.5, None),
    )


SUMMARY_RULES = [rule for rule in quality.GOLD_RULES if rule.model == "agg_currency_summary"]


def test_rules_count_their_failures(summary):
    results = quality.run_checks({"agg_currency_summary": summary}, [*SUMMARY_RULES, quality.PAIR_RULE])
    assert tuples(results.select("column", "check", "failures", "passed")) == [
        ("base_currency, target_currency", "unique", 0, True),
        ("latest_rate", "not_null", 1, False),
        ("rate_date", "not_null", 1, False),
        ("target_currency", "not_null", 0, True),
        ("target_currency", "unique", 1, False),
        ("volatility_tier", "accepted_values", 1, False),
    ]
    with pytest.raises(quality.CheckFailure, match="latest_rate not_null: 1"):
        quality.require_passed(results)
    quality.require_passed(results.filter("passed"))


def test_eleven_gold_rules():
    kinds = [rule.check for rule in quality.GOLD_RULES]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (8, 2, 1)


def test_accepted_values_skip_null_and_excluded_rows(frame):
    rows = frame("v string, w int", ("low", 1), ("bad", 1), ("bad", 1), ("ugly", 2), (None, 1))
    assert tuples(quality.accepted_values(rows, "v", ["low"], "w = 1")) == [("bad", 2)]
    assert tuples(quality.unique(rows, "v")) == [("bad", 2)]
    assert quality.not_null(rows, "v").count() == 1


def test_table_panel(summary):
    assert [(r.target_currency, r.rate, r.inverse, r.direction, r.change_pct) for r in
            feeds.rates_table(summary, "eUr").orderBy("base_currency").collect()] == [
        ("MDL", 22.5, 0.04, "up", 0.0), ("MDL", 17.3127, 0.0578, "up", 0.62),
    ]
    assert [r.direction for r in feeds.rates_table(summary, "lak").collect()] == ["down"]
    assert feeds.rates_table(summary, "asia").count() == 1 and feeds.rates_table(summary).count() == 4


def test_tiers_without_currencies_are_listed(summary):
    assert tuples(feeds.volatility_distribution(summary)) == [("high", 0), ("low", 1), ("medium", 1)]


def test_currencies_by_region(frame):
    dim = frame("region string, cca2 string, currencies string", ("Europe", "DE", "EUR"), ("Europe", "CH", "CHF, EUR"),
                ("Asia", "XX", None), (None, "YY", "EUR"))
    assert tuples(feeds.currencies_by_region(dim)) == [("Asia", 0, 1), ("Europe", 2, 2), (None, 1, 1)]


def test_trend(frame):
    rows = frame("rate_date date, base_currency string, target_currency string, rate_7d_moving_avg double",
                 (date(2024, 1, 15), "USD", "EUR", 1.0), (date(2024, 1, 15), "USD", "JPY", 150.0),
                 (date(2024, 1, 14), "USD", "EUR", 2.0), (date(2024, 1, 13), "USD", "EUR", 3.0),
                 (date(2024, 1, 16), "USD", "EUR", 4.0), (date(2024, 1, 15), "GBP", "EUR", 9.0))
    got = feeds.trend(rows, ["EUR", "JPY", "GBP"], DAY, days=2, base="USD", scale={"JPY": 100})
    assert got.columns == ["rate_date", "EUR", "JPY", "GBP"]
    assert tuples(got) == [(date(2024, 1, 14), 2.0, None, None), (date(2024, 1, 15), 1.0, 1.5, None)]


def test_kpis(frame, summary):
    fct = frame("target_currency string, rate_date date, inverse_rate double, rate_change_pct double",
                ("EUR", date(2024, 1, 14), 1.0, 0.5), ("EUR", DAY, 1.1, 0.617), ("EUR", date(2023, 12, 15), 9.0, 0.0),
                ("JPY", DAY, 5.0, 0.0))
    runs = frame("status string, started_at timestamp", ("success", datetime(2024, 1, 10)), ("failed", datetime(2024, 1, 11)),
                 ("success", datetime(2024, 1, 12)), ("success", datetime(2023, 1, 1)))
    checks = quality.run_checks({"agg_currency_summary": summary}, SUMMARY_RULES)
    got = dict(tuples(feeds.kpis(summary, summary, fct, runs, [summary, fct], checks, DAY)))
    assert got == {
        "currencies_tracked": 3.0, "countries_mapped": 4.0, "avg_inverse_rate": 1.05, "latest_change_pct": 0.62,
        "runs": 3.0, "run_success_pct": 66.67, "landed_rows": 8.0, "checks_passed": 1.0, "checks_total": 5.0,
    }
