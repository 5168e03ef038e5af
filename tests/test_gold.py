import random
import statistics
from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import plan, tuples
from pyspark.sql import functions as F

from ratestrata.functions.tiers import volatility_tier
from ratestrata.operators import series
from ratestrata.plans import gold

AS_OF = date(2024, 3, 1)
FCT = ("base_currency string, target_currency string, rate decimal(20,8), rate_date date, inverse_rate decimal(18,8), "
       "rate_change_pct decimal(30,4), currency_region string, primary_country_name string, pipeline_run_id string")
DIM = ("cca2 string, cca3 string, name_common string, region string, subregion string, capital string, "
       "population bigint, population_tier string, population_density decimal(20,2), area_km2 decimal(15,4), "
       "currencies string, is_un_member boolean, flag_emoji string")


def fact(target, day, rate, base="USD", region="Europe", name="Germany", change=None, run="r"):
    rate = Decimal(str(rate))
    change = None if change is None else Decimal(str(change))
    return (base, target, rate, day, round(1 / rate, 8), change, region, name, run)


def country(cca2, region, currencies, population=1, name=None):
    return (cca2, cca2, name or cca2, region, None, None, population, "micro", None, None, currencies, True, "")


def random_facts(seed):
    rng = random.Random(seed)
    rows = []
    for base in ("USD", "GBP", None):
        for target in ("EUR", "EURO", "USD", "ZZZ"):
            region, name = rng.choice([("Europe", "Germany"), ("Asia", "Japan"), (None, None), (None, "Nowhere")])
            for back in rng.sample(range(-3, 60), 12):
                day = AS_OF - timedelta(days=back)
                copies = 2 if rng.random() < 0.2 else 1
                value, change = round(rng.uniform(0.5, 150), 4), round(rng.uniform(-9, 9), 4)
                for copy in range(copies):
                    rows.append(fact(target, day, value, base, region, name and f"{name}{copy}", change, f"r{back}"))
    return rows


DIM_ROWS = [
    country("DE", "Europe", "EUR"), country("FR", "Europe", "EUR, USD"), country("XX", "Europe", None),
    country("JP", "Asia", "JPY, EURO"), country("CN", "Asia", "EURO"), country("NN", None, "EUR"),
]


@pytest.mark.parametrize("seed", range(3))
def test_summary_in_one_pass_equals_window_and_join(frame, seed):
    facts = frame(FCT, *random_facts(seed))
    one, two = gold.currency_summary(facts, AS_OF), gold.currency_summary_joined(facts, AS_OF)
    assert one.columns == two.columns

    def near(df):
        return df.withColumn("rate_volatility_30d", F.round("rate_volatility_30d", 6))

    assert tuples(near(one)) == tuples(near(two))
    assert plan(one).count("Exchange") == 1


def test_summary_values(frame):
    days = [AS_OF - timedelta(days=n) for n in (31, 30, 1, 0, -1)]
    facts = frame(FCT, *[fact("EUR", day, value) for day, value in zip(days, (9, 1, 2, 3, 4))], fact("OLD", days[0], 5),
                  fact("ONE", days[3], 5), fact("EUR", AS_OF, 8, base=None))
    got = {(r.base_currency, r.target_currency): r for r in gold.currency_summary(facts, AS_OF).collect()}
    eur = got["USD", "EUR"]
    assert (eur.latest_rate, eur.rate_date, eur.days_of_data) == (4, AS_OF + timedelta(days=1), 4)
    assert (eur.rate_avg_30d, eur.rate_min_30d, eur.rate_max_30d) == (Decimal("2.500000"), 1, 4)
    assert eur.rate_volatility_30d == pytest.approx(statistics.stdev([1, 2, 3, 4]), abs=1e-8)
    old, one, none = got["USD", "OLD"], got["USD", "ONE"], got[None, "EUR"]
    assert (old.days_of_data, old.rate_avg_30d, old.volatility_tier) == (None, None, "high")
    assert (one.days_of_data, one.rate_volatility_30d, one.volatility_tier) == (1, None, "high")
    assert (none.latest_rate, none.days_of_data) == (8, None)


@pytest.mark.parametrize("ratio,tier", [(0.0099, "low"), (0.01, "medium"), (0.0499, "medium"), (0.05, "high"), (None, "high")])
def test_tier_bounds(frame, ratio, tier):
    row = frame("s double, a double", (ratio, 1.0)).select(volatility_tier(F.col("s"), F.col("a"))).first()
    assert row[0] == tier


def test_tier_of_a_zero_mean(frame):
    assert frame("s double, a decimal(9,2)", (0.0, Decimal(0))).select(volatility_tier(F.col("s"), F.col("a"))).first()[0] == "high"


def naive_regional(facts, dim):
    """The plain join of every fact to all countries of its region that list its code."""
    r, c = facts.alias("r"), dim.alias("c")
    on = (F.col("c.region") == F.col("r.currency_region")) & F.col("c.currencies").contains(F.col("r.target_currency"))
    return r.filter(F.col("rate_date") >= F.date_sub(F.lit(AS_OF), 30)).join(c, on, "left").groupBy(
        "rate_date", "base_currency", "target_currency",
        F.coalesce("r.currency_region", F.lit("Unknown")).alias("region"), "primary_country_name",
    ).agg(
        F.avg("rate").alias("avg_rate"), F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"),
        F.avg("rate_change_pct").alias("avg_rate_change_pct"), F.count_distinct("c.cca2").alias("country_count"),
    )


@pytest.mark.parametrize("seed", range(3))
def test_regional_days_equal_the_plain_join(frame, seed):
    facts, dim = frame(FCT, *random_facts(seed)), frame(DIM, *DIM_ROWS)
    got = gold.regional_daily(facts, dim, AS_OF)
    assert tuples(got) == tuples(naive_regional(facts, dim))
    assert "NestedLoop" not in plan(got)


def test_two_countries_of_a_region_share_a_code(frame):
    facts = frame(FCT, fact("EUR", AS_OF, 1), fact("EUR", AS_OF, 1, base="GBP", region=None, name=None))
    got = {r.base_currency: (r.region, r.country_count) for r in gold.regional_daily(facts, frame(DIM, *DIM_ROWS), AS_OF).collect()}
    assert got == {"USD": ("Europe", 2), "GBP": ("Unknown", 0)}


def test_moving_average_equals_a_loop(frame):
    rng = random.Random(5)
    rows = [(key, day, float(rng.randint(1, 999))) for key in "ab" for day in rng.sample(range(100), 23)]
    got = series.moving_avg(frame("k string, d int, v double", *rows), ["k"], ["d"], "v", 7, "m")
    for key in "ab":
        own = [value for _, _, value in sorted(row for row in rows if row[0] == key)]
        loop = [statistics.fmean(own[max(0, i - 6): i + 1]) for i in range(len(own))]
        assert [row.m for row in got.filter(F.col("k") == key).orderBy("d").collect()] == pytest.approx(loop)


def test_rates_by_region_lookback_and_order(frame):
    days = [AS_OF - timedelta(days=n) for n in (31, 30, 2, -2)]
    rows = gold.rates_by_region(frame(FCT, *[fact("EUR", d, i + 1) for i, d in enumerate(days)]), frame(DIM, *DIM_ROWS), AS_OF)
    shown = gold.in_report_order(rows).collect()
    assert [(r.rate_date, float(r.rate_7d_moving_avg)) for r in shown] == [(days[3], 3.0), (days[2], 2.5), (days[1], 2.0)]


def test_trailing_statistics_filter_reaches_the_files(spark, frame, tmp_path):
    frame(FCT, *random_facts(1)).write.parquet(str(tmp_path / "f"))
    text = plan(series.trailing_stats(spark.read.parquet(str(tmp_path / "f")), gold.PAIR, "rate", AS_OF))
    assert "GreaterThanOrEqual(rate_date,2024-01-31)" in text
    assert "ReadSchema: struct<base_currency:string,target_currency:string,rate:decimal(20,8),rate_date:date>" in text


def test_country_map(frame):
    dim = frame(DIM, country("FR", "Europe", "EUR, USD", 5), country("NO", "Europe", None, None), country("UZ", "Asia", "UZS", 9))
    summary = gold.currency_summary(frame(FCT, fact("EUR", AS_OF, 2), fact("EUR", AS_OF, 3, base="GBP")), AS_OF)
    rows = gold.in_report_order(gold.country_currency_map(dim, summary)).collect()
    assert [(r.cca2, r.primary_currency, r.latest_rate and float(r.latest_rate)) for r in rows][0] == ("UZ", "UZS", None)
    assert rows[-1].cca2 == "NO" and rows[-1].primary_currency is None
    assert sorted(float(r.latest_rate) for r in rows if r.cca2 == "FR") == [2.0, 3.0]
