import random
from datetime import date
from decimal import Decimal

import pytest
from conftest import plan, settled_plan, tuples
from pyspark.sql import functions as F

from ratestrata.operators import containment, series
from ratestrata.plans import silver, staging

RAW_COUNTRY = ("cca2 string, cca3 string, name_common string, name_official string, region string, subregion string, "
               "capital string, population string, area_km2 string, currencies string, languages string, "
               "timezones string, is_un_member string, flag_emoji string, _source string, _extracted_at string, "
               "_pipeline_run_id string")
RAW_RATE = ("base_currency string, target_currency string, rate string, rate_date string, timestamp string, "
            "_source string, _extracted_at string, _pipeline_run_id string")
AT = "2024-01-15T00:10:00Z"


def country(cca2, population="1", area="1", currencies=None, member="true", at=AT, region="Europe", name=None):
    return (cca2, "x", cca2 if name is None else name, "official", region, " ", "", population, area, currencies, "l", "t", member, "f",
            "s", at, "r")


def rate(target, value, day, at=AT, base="USD", run="r"):
    return (base, target, value, day, "1677888000", "s", at, run)


def staged_rates(frame, *rows):
    return staging.stage_rates(frame(RAW_RATE, *rows))


def dim(frame, *rows):
    return silver.dim_countries(staging.stage_countries(frame(RAW_COUNTRY, *rows)))


def test_staged_rates_are_typed_and_complete(frame):
    staged = staged_rates(
        frame, rate("MDL", "17.3127", "2023-03-04"), rate(None, "1", "2023-03-04"), rate("MDL", None, "2023-03-04"),
        rate("MDL", "1", None),
    )
    assert dict(staged.dtypes) | {"rate": "decimal(20,8)", "rate_date": "date", "unix_timestamp": "bigint",
                                  "extracted_at": "timestamp"} == dict(staged.dtypes)
    assert [row.rate for row in staged.collect()] == [Decimal("17.31270000")]


def test_bad_text_fails_the_job(frame):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staged_rates(frame, rate("EUR", "abc", "2024-01-15")).collect()


def test_staged_countries(frame):
    spellings = ["TRUE", "1", "T", "Yes", "False", "0", "f", "NO", "maybe", "", None]
    rows = [country(f"C{i}", member=word) for i, word in enumerate(spellings)]
    staged = staging.stage_countries(frame(RAW_COUNTRY, *rows, country("", "1"), country(None), country("ZZ", "", "")))
    flags = {row.cca2: row.is_un_member for row in staged.collect()}
    assert [flags[f"C{i}"] for i in range(11)] == [True] * 4 + [False] * 4 + [None] * 3
    empty = staged.filter("cca2 = 'ZZ'").first()
    assert len(flags) == 12 and empty.population is None and empty.area_km2 is None


def test_newest_row_and_null_is_newest(frame):
    rows = frame("k string, t int, v string", ("a", 1, "old"), ("a", 2, "new"), ("b", 5, "x"), ("b", None, "undated"),
                 ("c", 1, "y"), ("c", 1, "z"), (None, 1, "p"), (None, 2, "q"))
    assert tuples(series.dedup_latest(rows, ["k"], "t")) == [
        ("a", 2, "new"), ("b", None, "undated"), ("c", 1, "z"), (None, 2, "q"),
    ]


def test_copies_are_dropped_before_the_shuffle(spark):
    copies = spark.range(0, 1000, 1, 8).selectExpr("if(id < 999, 'hot', 'cold') as k", "id as t")
    newest = series.dedup_latest(copies, ["k"], "t")
    text = plan(newest)
    assert 0 < text.index("Exchange hashpartitioning") < text.index(", Partial")
    assert tuples(newest) == [("cold", 999), ("hot", 998)]


def test_population_bands_and_density(frame):
    edges = [10**9, 10**9 - 1, 10**8, 10**8 - 1, 10**7, 10**7 - 1, 10**6, 10**6 - 1, 0]
    rows = [country(f"C{i}", str(n), "3") for i, n in enumerate(edges)]
    extra = [country("N0", "", "3"), country("N1", "10", "0"), country("N2", "10", ""), country("N3", "100", "3")]
    got = {row.cca2: row for row in dim(frame, *rows, *extra).collect()}
    assert [got[f"C{i}"].population_tier for i in range(9)] == [
        "mega", "large", "large", "medium", "medium", "small", "small", "micro", "micro",
    ]
    assert got["N0"].population_tier is None and got["N0"].population_density is None
    assert got["N1"].population_density is None and got["N2"].population_density is None
    assert got["N3"].population_density == Decimal("33.33")
    assert got["N3"].capital is None and got["N3"].subregion is None


def test_several_currencies(frame):
    got = {row.cca2: row.has_multiple_currencies for row in dim(
        frame, country("A"), country("B", currencies="EUR"), country("C", currencies="EUR, USD")).collect()}
    assert got == {"A": False, "B": False, "C": True}


def test_change_uses_the_previous_clean_day(frame):
    days = [("1", 2), ("2", 0), ("3", 4), ("7", 1)]
    rows = frame("k string, d string, v decimal(20,8)", *[("a", day, Decimal(value)) for day, value in days])
    got = series.daily_change(series.plausible(rows, "v"), ["k"], "d", "v")
    assert tuples(got.select("d", "inverse_rate", "previous_day_rate", "rate_change_pct")) == [
        ("1", Decimal("0.50000000"), None, None),
        ("3", Decimal("0.25000000"), Decimal("2.00000000"), Decimal("100.0000")),
        ("7", Decimal("1.00000000"), Decimal("4.00000000"), Decimal("-75.0000")),
    ]
    assert plan(got).count("Window ") == 1


def test_change_keeps_all_digits(frame):
    rows = frame("k string, d int, v decimal(20,8)", ("a", 1, Decimal("0.00000003")), ("a", 2, Decimal("999999.99999999")))
    got = series.daily_change(rows, ["k"], "d", "v").orderBy("d").collect()
    assert got[0].inverse_rate == Decimal("33333333.33333333") and got[1].inverse_rate == Decimal("0.00000100")
    assert got[1].rate_change_pct == Decimal("3333333333333200.0000")


def test_bounds_are_exclusive(frame):
    rows = frame("v decimal(20,8)", *[(Decimal(v),) for v in ("0", "-1", "0.00000001", "999999.99999999", "1000000")])
    assert series.plausible(rows, "v").count() == 2


# ---- containment ------------------------------------------------------------------

DIM = "cca2 string, currencies string, population bigint, region string"
DIM_ROWS = [
    ("A", "EUR, USD", 5, "r1"), ("B", "EUR", 9, "r2"), ("C", "EUR", 9, "r3"), ("D", "EURO", 50, "r4"),
    ("E", None, 99, "r5"), ("F", "USD", None, "r6"), ("G", "EURO, EURO", 2, None),
]
CODES = ["EUR", "USD", "EURO", "R", "ZZZ", "", ", "]


def naive(rows, code, match):
    """The definition, in plain Python."""
    if match == "substring":
        held = [r for r in rows if r[1] is not None and code in r[1]]
    else:
        held = [r for r in rows if r[1] is not None and code in r[1].split(", ")]
    best = max((r[2] for r in held if r[2] is not None), default=None)
    return [r[3] for r in held if best is not None and r[2] == best] or [None]


@pytest.mark.parametrize("match", ["substring", "token"])
def test_top_container_equals_its_definition(frame, match):
    facts = frame("code string, n int", *[(code, i) for code in CODES for i in range(2)], (None, 7))
    got = containment.top_container(
        facts, frame(DIM, *DIM_ROWS), "code", "currencies", "population", {"region": "where"}, match
    )
    expected = [(code, i, where) for code in CODES for i in range(2) for where in naive(DIM_ROWS, code, match)]
    assert got.columns == ["code", "n", "where"]
    assert tuples(got) == sorted([*expected, (None, 7, None)], key=str)


def test_top_container_with_known_lengths_and_without_ties(frame):
    facts = frame("code string", ("EUR",), ("USD",))
    got = containment.top_container(
        facts, frame(DIM, *DIM_ROWS), "code", "currencies", "population", {"region": "where"},
        code_lengths=[3], unique_by=["cca2"],
    )
    assert tuples(got) == [("EUR", "r4"), ("USD", "r1")]
    tied = containment.top_container(
        facts.limit(1), frame(DIM, *DIM_ROWS), "code", "currencies", "population", {"region": "where"}, "token",
        unique_by=["cca2"],
    )
    assert tuples(tied) == [("EUR", "r2")]
    with pytest.raises(ValueError, match="fuzzy"):
        containment.listed_codes(facts, "code", match="fuzzy")


def test_containment_needs_no_nested_loop(spark, frame):
    facts = spark.range(1000).selectExpr("concat('C', id % 50) as code")
    big = spark.range(500).selectExpr(
        "cast(id as string) as cca2", "concat('C', id % 60, ', C', id % 7) as currencies", "id as population", "'r' as region"
    )
    got = containment.top_container(facts, big, "code", "currencies", "population", {"region": "where"})
    text = settled_plan(got)
    assert "NestedLoop" not in text and "Cartesian" not in text


# ---- facts ------------------------------------------------------------------------


def test_facts(frame):
    staged = staged_rates(
        frame,
        rate("EUR", "0.9", "2024-01-01", "2024-01-01T01:00:00Z"), rate("EUR", "0.8", "2024-01-01", "2024-01-01T02:00:00Z"),
        rate("EUR", "0", "2024-01-02"), rate("EUR", "1.0", "2024-01-04"), rate("XAU", "1000000", "2024-01-01"),
        rate("ZZZ", "5", "2024-01-01"), rate("EUR", "7", "2024-01-01", base="GBP"),
    )
    countries = dim(frame, country("DE", "83", currencies="EUR"), country("FR", "67", currencies="EUR", region="F"))
    fct = silver.fct_rates(staged, countries)
    assert fct.columns == silver.FACT_COLUMNS
    assert tuples(fct.select("base_currency", "target_currency", "rate_date", "rate", "rate_change_pct", "currency_region",
                             "primary_country_name")) == sorted([
        ("USD", "EUR", date(2024, 1, 1), Decimal("0.80000000"), None, "Europe", "DE"),
        ("USD", "EUR", date(2024, 1, 4), Decimal("1.00000000"), Decimal("25.0000"), "Europe", "DE"),
        ("USD", "ZZZ", date(2024, 1, 1), Decimal("5.00000000"), None, None, None),
        ("GBP", "EUR", date(2024, 1, 1), Decimal("7.00000000"), None, "Europe", "DE"),
    ], key=str)


def test_equal_top_populations_repeat_the_fact(frame):
    staged = staged_rates(frame, rate("EUR", "1", "2024-01-01"))
    countries = dim(frame, country("DE", "83", currencies="EUR"), country("FR", "83", currencies="EUR"))
    assert silver.fct_rates(staged, countries).count() == 2
    assert silver.fct_rates(staged, countries, unique_by=["name_common"]).count() == 1


def test_facts_shuffle_twice(spark, frame, tmp_path):
    """By pair and day, then by pair; the dimension is broadcast and no fact row is shuffled for it."""
    staged_rates(frame, *[rate("EUR", "1", f"2024-01-{d:02}") for d in range(1, 29)]).write.parquet(str(tmp_path / "f"))
    dim(frame, country("DE", "83", currencies="EUR")).write.parquet(str(tmp_path / "d"))
    fct = silver.fct_rates(
        spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "d")), code_lengths=[3]
    )
    text = plan(fct)
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text
    facts_side = text[: text.index("BroadcastExchange")]
    assert facts_side.count("Exchange hashpartitioning") == 2
    assert "PushedFilters" in text and "flag_emoji" not in text


def brute_force_facts(rows, countries, lo, hi):
    """Facts by plain loops over staged rows and (name, region, population, list) tuples."""
    newest = {}
    for row in rows:
        base, target, value, day, second, run = row
        key = (base, target, day)
        if key not in newest or (second, value, run) > newest[key][0]:
            newest[key] = ((second, value, run), value)
    out, previous = [], {}
    for base, target, day in sorted(newest, key=lambda key: key[2]):
        value = newest[base, target, day][1]
        if not lo < value < hi:
            continue
        before = previous.get((base, target))
        change = before and round(float((value - before) / before * 100), 3)
        previous[base, target] = value
        held = [c for c in countries if c[3] and target in c[3]]
        top = max((c[2] for c in held), default=None)
        for _, region in [(c[0], c[1]) for c in held if c[2] == top] or [(None, None)]:
            out.append((base, target, day, value, before, change, region))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_facts_equal_brute_force_with_a_dominant_pair(spark, frame, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(1500):
        hot = rng.random() < 0.35
        target = "EUR" if hot else rng.choice(["EURO", "USD", "U", "ZZZ"])
        day = "2024-01-01" if hot and rng.random() < 0.5 else f"2024-01-{rng.randint(1, 28):02}"
        rows.append(("USD" if hot else rng.choice("ab"), target, Decimal(rng.randint(0, 4000)) / 4, day,
                     rng.randint(0, 50), str(rng.randint(100, 999))))
    countries = [("A", "r1", 5, "EUR, USD"), ("B", "r2", 9, "EURO"), ("C", "r3", 9, "EUR"), ("D", "r4", 1, None)]
    staged = frame("base_currency string, target_currency string, rate decimal(20,8), day string, second int, "
                   "pipeline_run_id string", *rows).repartition(6).selectExpr(
        "base_currency", "target_currency", "rate", "cast(day as date) as rate_date", "0L as unix_timestamp",
        "'s' as source_system", "timestamp_seconds(second) as extracted_at", "pipeline_run_id")
    dim_rows = frame("name_common string, region string, population bigint, currencies string", *countries)
    got = silver.fct_rates(staged, dim_rows, hi=900).select(
        "base_currency", "target_currency", F.col("rate_date").cast("string"), "rate", "previous_day_rate",
        F.round("rate_change_pct", 3).cast("double"), "currency_region")
    expected = [
        (*row[:3], row[3].quantize(Decimal("1e-8")), row[4] and row[4].quantize(Decimal("1e-8")), row[5], row[6])
        for row in brute_force_facts(rows, countries, 0, 900)
    ]
    near = [(*row[:5], row[5] and pytest.approx(row[5], abs=0.0011), row[6]) for row in sorted(expected, key=lambda r: str((*r[:5], r[6])))]
    assert sorted(map(tuple, got.collect()), key=lambda r: str((*r[:5], r[6]))) == near


def test_only_codes_reach_the_window(frame):
    dim = frame("cca2 string, currencies string, population int", ("A", "NOK, PEN, DIGIKRONE", 5), ("B", "PEN", 9), ("C", None, 1))
    codes = frame("code string", ("PEN",), ("PEN",), ("KRO",), ("XXX",), (None,))
    pieces = containment.matching_pieces(dim, "currencies", codes, "code")
    assert tuples(pieces.select("cca2", containment.CODE)) == [("A", "KRO"), ("A", "PEN"), ("B", "PEN")]
    assert containment.matching_pieces(dim, "currencies", code_lengths=[3]).count() > 20


def test_the_newest_row_is_sorted_by_a_number_first(frame):
    rows = frame("a string, b string, t int, v string", ("x", None, 1, "p"), (None, "x", 1, "q"), ("x", None, 2, "r"), ("y", "y", None, "s"), ("y", "y", 9, "t"))
    newest = series.dedup_latest(rows, ["a", "b"], "t")
    # text keys often begin alike: the first eight bytes, by which Spark sorts, then tell nothing
    assert "Sort [_key_hash" in plan(newest) and newest.columns == ["a", "b", "t", "v"]
    assert tuples(newest) == sorted([("x", None, 2, "r"), (None, "x", 1, "q"), ("y", "y", None, "s")], key=str)
