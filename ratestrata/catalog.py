"""One query per operator over the supplied tables. `oracles.py` holds the SQL of each."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ratestrata import adapters as A, schemas
from ratestrata.functions import text
from ratestrata.functions.tiers import volatility_tier as tier_of
from ratestrata.operators import cleaning, containment, moments, segments, series
from ratestrata.operators.upsert import upsert as upsert_rows
from ratestrata.plans import daily, feeds, gold, quality, silver, staging
from ratestrata.plans.uniqueness import KeyIndex
from ratestrata.session import shared_folder
from ratestrata.sources import audit
from ratestrata.sources.base import with_lineage
from ratestrata.sources.csv import CsvSource, read_csv
from ratestrata.sources.landing import RATE_DAY, RATE_MONTH, land, read_landing, to_landing
from ratestrata.sources.payloads import (
    CountriesSource, RatesSource, broken_payloads, flatten_countries, flatten_rates, parse_payloads,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAIR = ["base_currency", "target_currency"]
PAIR_DAY = [*PAIR, "rate_date"]
HIGHEST_PRICE = 100_000
EXTRACTED_AT = "2024-01-15 00:05:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Types that every engine prints alike."""

    def column(field: T.StructField) -> str:
        col, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, T.DecimalType):
            return f"cast({col} as double) as {col}"
        if isinstance(kind, (T.DateType, T.BooleanType)):
            return f"cast({col} as string) as {col}"
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return f"date_format({col}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') as {col}"
        if isinstance(kind, (T.IntegerType, T.ShortType)):
            return f"cast({col} as bigint) as {col}"
        return col

    return df.selectExpr(*map(column, df.schema))


# ---- shared inputs ----------------------------------------------------------------


def countries(spark: SparkSession, sf: str) -> DataFrame:
    return silver.dim_countries(staging.stage_countries(A.raw_countries(spark, sf)))


def facts(spark: SparkSession, sf: str) -> DataFrame:
    return silver.fct_rates(
        A.staged_rates(spark, sf), countries(spark, sf), hi=HIGHEST_PRICE, codes=A.target_codes(spark, sf)
    )


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return gold.currency_summary(facts(spark, sf), A.AS_OF)


def regional(spark: SparkSession, sf: str) -> DataFrame:
    return gold.rates_by_region(
        facts(spark, sf), countries(spark, sf), A.AS_OF, codes=A.target_codes(spark, sf)
    )


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder, as the daily job leaves it, and read from there."""
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def event_series(spark: SparkSession, sf: str) -> DataFrame:
    """Events, newest per pair and day."""
    return series.dedup_latest(A.event_rates(spark, sf), PAIR_DAY, "extracted_at")


def rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name in names})


# ---- ingest and landing -----------------------------------------------------------


@query
def csv_table(spark, sf):
    """Customers written as semicolon CSV with quotes inside cells, read back as text."""
    folder = shared_folder(spark, "csv")
    customers = A.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Cust Key"),
        F.concat("c_name", F.lit('; "x", '), "c_mktsegment").alias(" Full-Name "),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("Mkt.Segment"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("Acct Bal (USD)"),
    )
    customers.write.csv(folder, header=True, sep=";", quote='"', escape='"')
    return plain(cleaning.normalize_columns(read_csv(spark, folder)))


@query
def csv_counts(spark, sf):
    """Rows of written orders by `count`, by `isEmpty` and by one column alone, in files of all names."""
    folder = shared_folder(spark, "csv")
    A.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").write.csv(folder + "/a[1] {x}", header=True)
    rows = read_csv(spark, folder + "/*")
    keys = rows.select("o_orderkey").filter("o_orderkey is not null").count()
    return spark.range(1).select(
        F.lit(rows.count()).alias("rows"), F.lit(str(rows.isEmpty()).lower()).alias("empty"), F.lit(keys).alias("keys")
    )


@query
def csv_source(spark, sf):
    """Orders as CSV through the whole cleaning chain: headers, missing tokens, casts."""
    folder = shared_folder(spark, "csv")
    orders = A.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Order-Key"),
        F.when(F.col("o_orderstatus") == "P", "N/A").otherwise(F.concat(F.lit("  "), "o_orderstatus")).alias("Status"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("Total Price"),
        F.when(F.col("o_orderpriority") == "5-LOW", "-").otherwise(F.col("o_orderpriority")).alias("Priority"),
    )
    orders.write.csv(folder, header=True, sep="|", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    source = CsvSource(
        "orders_csv", folder, column_mapping={"Total Price": "price"},
        types={"order_key": "int64", "price": "float64", "priority": "int64", "absent": "int64"},
    )
    return plain(source.read(spark))


@query
def csv_line_breaks(spark, sf):
    """Orders as CSV in which most cells of one column hold line breaks, quotes and delimiters, read in splits."""
    folder = shared_folder(spark, "csv")
    orders = A.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise(
            F.concat("o_orderpriority", F.lit('\n"quoted", '), "o_orderstatus", F.lit("\n\nlast; "))
        ).alias("note"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("price"),
    )
    orders.write.csv(folder, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return plain(read_csv(spark, folder, delimiter=","))


@query
def normalize_columns(spark, sf):
    odd = A.table(spark, sf, "customer").toDF(" Cust  Key", "Full-Name", "Nation.Key", "Acct Bal ($)", "Mkt Segment ")
    return plain(cleaning.normalize_columns(odd, {"Mkt-Segment": "segment"}))


@query
def null_tokens(spark, sf):
    """Every token stands in some rows, beside texts that look like one."""
    tokens = F.array(*map(F.lit, [*text.MISSING_TOKENS, "na", "N/A ", "none", "0"]))
    orders = A.table(spark, sf, "orders").select(
        "o_orderkey",
        F.get(tokens, (F.col("o_orderkey") % 24).cast("int")).alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "null").otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    return plain(cleaning.null_tokens(orders))


@query
def trim_and_drop_empty(spark, sf):
    """Rows without any value go, rows of blanks stay as empty text."""
    orders = A.table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit(" \t "), "o_orderpriority", F.lit("\n\u3000 ")))
        .when(F.col("o_orderstatus") == "P", "  \t").alias("priority"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("\r"), "o_orderstatus")).alias("status"),
    )
    return plain(cleaning.trim_strings(cleaning.drop_empty_rows(orders)))


@query
def cast_columns(spark, sf):
    """`p_name` and `p_size` hold cells that do not cast, so those columns stay text."""
    parts = A.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        "p_name",
        F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("p_retailprice"),
        F.when(F.col("p_size") == 1, "one").otherwise(F.col("p_size").cast("string")).alias("p_size"),
    )
    return plain(
        cleaning.cast_columns(
            parts, {"p_partkey": "int64", "p_name": "int64", "p_retailprice": "float64", "p_size": "int64", "no": "int64"}
        )
    )


def _event_payloads(spark, sf) -> DataFrame:
    """One JSON payload per event: the value under the user, and the number from its properties.
    Errors come without a base."""
    events = A.table(spark, sf, "events")
    rates = F.create_map(
        F.col("user_id").cast("string"), F.col("value").cast("decimal(20,8)"),
        F.lit("k"), F.get_json_object("props", "$.k").cast("decimal(20,8)"),
    )
    base = F.nullif(F.col("event_type"), F.lit("error")).alias("base")
    seconds = (F.expr(A.EPOCH.format("ts")) + F.hour("ts") * 3600).alias("timestamp")
    return events.select(F.to_json(F.struct(base, seconds, rates.alias("rates"))).alias("body"))


@query
def flatten_rates_payloads(spark, sf):
    rows = flatten_rates(parse_payloads(_event_payloads(spark, sf), "body"))
    return plain(rows.withColumn("rate", F.col("rate").cast("decimal(20,8)")))


@query
def exact_rates(spark, sf):
    """Rates with more than eight digits and above 1e12: landed as written, staged rounded or, where too large, rejected."""
    body = "concat('{\"base\":\"B\",\"timestamp\":0,\"rates\":{\"E', event_id, '\":', %s, '}}')"
    digits = "if(event_id % 7 = 0, concat('9', lpad(event_id, 13, '0'), '.25'), concat(event_id % 10, '.00001488', lpad(event_id, 9, '0'), '1'))"
    payloads = A.table(spark, sf, "events").selectExpr(body % digits + " as body")
    landed = to_landing(flatten_rates(parse_payloads(payloads, "body")), schemas.RATE_FIELDS, F.lit(EXTRACTED_AT).cast("timestamp"))
    small, _ = cleaning.validate(landed, F.col("rate").try_cast("decimal(20,8)").isNotNull())
    staged = staging.stage_rates(small).select("target_currency", F.col("rate").alias("staged"))
    return plain(landed.select("target_currency", "rate").join(staged, "target_currency", "left"))


@query
def broken_rates_payloads(spark, sf):
    broken = broken_payloads(parse_payloads(_event_payloads(spark, sf), "body"))
    return plain(broken.groupBy("missing_fields", "timestamp").agg(F.count("*").alias("payloads")))


@query
def flatten_countries_payloads(spark, sf):
    """One nested country object per customer."""
    customers = A.table(spark, sf, "customer").join(
        A.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key, odd = F.col("c_custkey"), F.col("c_custkey") % 2 == 1
    unit = F.struct(F.col("c_mktsegment").alias("name"), F.lit("¤").alias("symbol"))
    body = F.struct(
        key.cast("string").alias("cca2"),
        F.when(odd, F.col("n_name")).alias("cca3"),
        F.struct(F.col("c_name").alias("common"), F.when(odd, F.col("n_name")).alias("official")).alias("name"),
        F.when(odd, F.col("n_name")).alias("region"),
        F.when(odd, F.lit("")).otherwise(F.col("c_mktsegment")).alias("subregion"),
        F.when(odd, F.array("c_mktsegment", "n_name")).otherwise(F.array().cast("array<string>")).alias("capital"),
        F.when(odd, key).alias("population"),
        F.when(odd, F.col("c_acctbal")).otherwise(F.lit(0.0)).alias("area"),
        F.when(odd, F.create_map("n_name", unit, F.col("c_mktsegment"), unit)).alias("currencies"),
        F.when(odd, F.create_map("c_mktsegment", "c_name", F.col("n_name"), F.lit("A"))).alias("languages"),
        F.when(odd, F.array(F.lit("UTC+01:00"), F.col("c_mktsegment"))).alias("timezones"),
        F.when(odd, F.lit(True)).alias("unMember"),
        F.lit("🇩🇪").alias("flag"),
    )
    parsed = parse_payloads(customers.select(F.to_json(body).alias("body")), "body", schemas.COUNTRY_PAYLOAD)
    return plain(flatten_countries(parsed))


@query
def join_sorted(spark, sf):
    """Brands and line counts of each nation, as sorted text."""
    nations = A.listed_brands(spark, sf).groupBy("s_nationkey").agg(
        F.map_from_entries(F.collect_list(F.struct("p_brand", F.concat(F.lit("n"), F.col("n").cast("string"))))).alias("m")
    )
    everyone = A.table(spark, sf, "nation").join(nations, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return plain(
        everyone.select(
            "n_name",
            text.join_sorted(F.col("m"), "keys").alias("brands"),
            text.join_sorted(F.col("m"), "values").alias("counts"),
            text.join_sorted(F.sort_array(F.map_keys("m"), asc=False), "array").alias("backwards"),
        )
    )


@query
def lineage(spark, sf):
    orders = A.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    stamped = with_lineage(orders, "orders", "run_001", F.lit(EXTRACTED_AT).cast("timestamp"))
    return plain(stamped)


@query
def validate(spark, sf):
    """Events whose value is a rate, and those whose value is not."""
    rates = A.event_rates(spark, sf).select(*PAIR, "rate", "pipeline_run_id")
    good, rejected = cleaning.validate(rates, cleaning.rate_rule())
    return plain(good.withColumn("kept", F.lit(True)).unionByName(rejected.withColumn("kept", F.lit(False))))


@query
def validate_countries(spark, sf):
    """Countries by the code rule, and orders without a filled cell by the rule of CSV rows."""
    codes = A.raw_countries(spark, sf).selectExpr("cca2", "if(cca2 = '' or population > 9000, null, cca3) as cca3", "languages as origin")
    cells = A.table(spark, sf, "orders").selectExpr(
        "if(o_orderstatus = 'P', ' ', null) as cca2", "if(o_orderpriority = '5-LOW', o_orderpriority, '\\t') as cca3", "'order' as origin"
    )
    parts = []
    for rows, rule in ((codes, cleaning.country_rule()), (cells, cleaning.any_value_rule(cells.drop("origin")))):
        good, rejected = cleaning.validate(rows, rule)
        parts += [good.withColumn("kept", F.lit(True)), rejected.withColumn("kept", F.lit(False))]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return plain(whole.groupBy("origin", "kept").agg(F.count("*").alias("n")))


@query
def validate_text(spark, sf):
    """Rates as text, some of which are no numbers: these are rejected, and fail nothing."""
    rates = A.table(spark, sf, "events").selectExpr(
        "event_id", "case event_id % 6 when 0 then 'abc' when 1 then '' when 2 then '-1.5' when 3 then '1e-9' when 4 then 'NaN' else '12' end as rate"
    )
    good, rejected = cleaning.validate(rates, cleaning.rate_rule())
    return plain(good.withColumn("kept", F.lit(True)).unionByName(rejected.withColumn("kept", F.lit(False))))


@query
def landing_text(spark, sf):
    orders = A.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"), "o_custkey"
    )
    stamped = with_lineage(orders, "orders", None, F.lit(EXTRACTED_AT).cast("timestamp"))
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus", "absent"]
    return plain(to_landing(stamped, columns, F.lit(EXTRACTED_AT).cast("timestamp")))


@query
def upsert(spark, sf):
    """Later events written over earlier ones, per type and user. Signups of the second batch
    have no user, so each of them is a row of its own."""
    events = A.event_landing(spark, sf)
    later = F.col("rate_date") >= "2024-01-16"
    anonymous = F.col("base_currency") == "signup"
    target = series.dedup_latest(events.filter(~later), PAIR, "_extracted_at")
    updates = events.filter(later).withColumn("target_currency", F.when(~anonymous, F.col("target_currency")))
    return plain(upsert_rows(target, updates, PAIR, "_extracted_at"))


@query
def upsert_hot_key(spark, sf):
    """A batch of which a third has one key, over a table that holds it: the last writer of every key."""
    events = A.event_landing(spark, sf)
    target = series.dedup_latest(events, PAIR, "_extracted_at").withColumn("rate", F.lit("0"))
    hot = F.col("_pipeline_run_id").cast("bigint") % 3 == 0
    updates = events.filter(F.col("base_currency") != "view").withColumns(
        {name: F.when(hot, F.lit("hot")).otherwise(F.col(name)) for name in PAIR}
    )
    both = target.unionByName(target.limit(1).withColumns({name: F.lit("hot") for name in PAIR}))
    written = upsert_rows(both, updates, PAIR, "_extracted_at")
    return plain(written.select(*PAIR, "rate", "_pipeline_run_id"))


@query
def upsert_newest(spark, sf):
    """The same batches in the wrong order: with `newest_wins`, older rows lose."""
    events = A.event_landing(spark, sf)
    later = F.col("rate_date") >= "2024-01-16"
    target = series.dedup_latest(events.filter(later), PAIR, "_extracted_at")
    return plain(upsert_rows(target, events.filter(~later), PAIR, "_extracted_at", newest_wins=True))


@query
def landed_table(spark, sf):
    """Two overlapping batches, landed by day; the second one is landed twice."""
    path = shared_folder(spark, "landed") + "/raw_currencies"
    events, day = A.event_landing(spark, sf), F.col("rate_date")
    first, second = events.filter(day <= "2024-01-17"), events.filter(day >= "2024-01-15")
    for batch in (first, second, second):
        land(spark, path, batch, PAIR_DAY, schemas.RAW_RATES, RATE_DAY)
    return plain(read_landing(spark, path, schemas.RAW_RATES))


@query
def landed_months(spark, sf):
    """Prices of years, landed by month in two overlapping batches: many partitions, of which the second touches some."""
    path = shared_folder(spark, "landed") + "/raw_currencies"
    rates = series.dedup_latest(A.raw_rates(spark, sf), PAIR_DAY, "_extracted_at")
    later = rates.filter("rate_date >= '2000-01-01'").withColumn("rate", F.concat("rate", F.lit("1")))
    for batch in (rates, later):
        land(spark, path, batch, PAIR_DAY, schemas.RAW_RATES, RATE_MONTH)
    return plain(read_landing(spark, path, schemas.RAW_RATES).select(*PAIR_DAY, "rate"))


@query
def run_state(spark, sf):
    return plain(audit.run_state(A.event_runs(spark, sf)))


@query
def recent_runs(spark, sf):
    return plain(audit.recent_runs(audit.run_state(A.event_runs(spark, sf)), 10))


# ---- staging and silver -----------------------------------------------------------


@query
def stage_rates(spark, sf):
    return plain(staging.stage_rates(A.raw_rates(spark, sf)))


@query
def stage_countries(spark, sf):
    return plain(staging.stage_countries(A.raw_countries(spark, sf)))


@query
def dedup_latest(spark, sf):
    return plain(event_series(spark, sf))


@query
def dim_countries(spark, sf):
    return plain(countries(spark, sf))


@query
def daily_change(spark, sf):
    """Change between the clean days of each event series."""
    clean = series.plausible(event_series(spark, sf), "rate", 1, 400)
    changed = series.daily_change(clean, PAIR, "rate_date", "rate")
    return plain(changed.select(*PAIR_DAY, "rate", "inverse_rate", "previous_day_rate", "rate_change_pct"))


@query
def plausible(spark, sf):
    return plain(series.plausible(A.staged_rates(spark, sf), "rate", 1000, HIGHEST_PRICE))


def _part_regions(spark, sf, match):
    parts = A.table(spark, sf, "part").select("p_partkey", "p_brand")
    return plain(
        containment.top_container(
            parts, countries(spark, sf), "p_brand", "currencies", "population",
            {"region": "region", "name_common": "country"}, match,
        )
    )


@query
def top_container(spark, sf):
    """The most populous nation that lists the brand of each part, also inside a longer brand."""
    return _part_regions(spark, sf, "substring")


@query
def top_container_token(spark, sf):
    return _part_regions(spark, sf, "token")


@query
def fct_rates(spark, sf):
    return plain(facts(spark, sf))


def _late_rates(spark, sf):
    """The price series in landing form, one row per pair and day, and a late batch of it: the last days of three months
    again, with other prices, and with none that is plausible where the base is N. The series is stored: both batches come from one scan."""
    rates = stored(spark, series.dedup_latest(A.raw_rates(spark, sf), PAIR_DAY, "_extracted_at"), "rates")
    late = F.substring("rate_date", 1, 7).isin(*A.LATE_MONTHS) & (F.substring("rate_date", 9, 2) >= "20")
    price = F.when(F.col("base_currency") == "N", "0").otherwise(F.concat(F.lit("1"), "rate"))
    return rates, rates.filter(late).withColumn("rate", price)


def _after_late_batch(spark: SparkSession, sf: str) -> daily.Layers:
    """The daily job's tables after the whole series and then the late batch, for which only the touched months are built."""
    layers = daily.Layers(shared_folder(spark, "increment"))
    nations = to_landing(A.raw_countries(spark, sf), schemas.COUNTRY_FIELDS, F.lit(EXTRACTED_AT).cast("timestamp"))
    land(spark, layers.path("bronze", "raw_countries"), nations, ["cca2", "languages"], schemas.RAW_COUNTRIES)
    for batch in _late_rates(spark, sf):
        land(spark, layers.path("bronze", "raw_currencies"), batch, PAIR_DAY, schemas.RAW_RATES, RATE_MONTH)
        daily.transform(spark, layers, date.fromisoformat(A.AS_OF), [quality.PAIR_RULE], incremental=True)
    return layers


@query
def facts_after_batch(spark, sf):
    """Facts of which a late batch touched three months: these and the months behind them are built again, the others keep their files."""
    return plain(daily.read_table(spark, _after_late_batch(spark, sf), "silver", "fct_exchange_rates"))


@query
def segmented_series(spark, sf):
    """Previous value and mean of seven of event series, one of which owns most rows, in segments of an hour."""
    events = A.table(spark, sf, "events").select(
        F.when(F.col("event_id") % 10 < 7, "most").otherwise(F.col("event_type")).alias("series"), "event_id", "ts", "value",
        F.date_trunc("hour", "ts").alias("hour"),
    )
    found = segments.segmented(
        events, ["series"], "hour", ["ts", "event_id"], 6,
        lambda window: {"previous": F.lag("value").over(window), "mean_of_7": F.avg("value").over(window.rowsBetween(-6, 0))},
    )
    return plain(rounded(found.select("series", "event_id", "value", "previous", "mean_of_7"), 6, "mean_of_7"))


# ---- gold -------------------------------------------------------------------------


@query
def latest_per_key(spark, sf):
    return plain(series.latest_per_key(event_series(spark, sf), PAIR, "rate_date"))


def _event_stats(spark, sf):
    return series.trailing_stats(event_series(spark, sf), PAIR, "rate", A.EVENTS_AS_OF, 10)


@query
def trailing_stats(spark, sf):
    stats = rounded(_event_stats(spark, sf), 8, "rate_avg_30d")
    return plain(rounded(stats, 6, "rate_stddev_30d"))


@query
def stats_from_moments(spark, sf):
    """Trailing statistics and those of all time, of all extracted prices, merged from a stored table of daily moments."""
    days = moments.daily_moments(A.staged_rates(spark, sf), PAIR, "rate")
    path = shared_folder(spark, "moments")
    days.withColumn("rate_month", F.date_format("rate_date", "yyyy-MM")).write.partitionBy("rate_month").parquet(path)
    days = spark.read.schema(days.schema).parquet(path)
    recent = moments.trailing_from_moments(days, PAIR, A.AS_OF)
    ever = moments.merge_moments(days, PAIR).select(
        *PAIR, moments.deviation(F.col("n"), F.col("squares")).alias("rate_stddev"), F.col("mean").alias("rate_avg"), F.col("n").alias("rates")
    )
    both = ever.join(recent, PAIR, "left")
    return plain(rounded(both, 5, "rate_stddev_30d", "rate_avg_30d", "rate_stddev", "rate_avg"))


@query
def volatility_tier(spark, sf):
    stats = _event_stats(spark, sf)
    return plain(
        stats.select(
            *PAIR, "days_of_data", tier_of(F.col("rate_stddev_30d"), F.col("rate_avg_30d") * 10).alias("volatility_tier")
        )
    )


@query
def currency_summary(spark, sf):
    return plain(rounded(summary(spark, sf), 6, "rate_volatility_30d"))


@query
def regional_daily(spark, sf):
    daily_rows = gold.regional_daily(
        facts(spark, sf), countries(spark, sf), A.AS_OF, codes=A.target_codes(spark, sf)
    )
    return plain(rounded(daily_rows, 6, "avg_rate", "avg_rate_change_pct"))


@query
def moving_avg(spark, sf):
    averaged = series.moving_avg(event_series(spark, sf), PAIR, ["rate_date"], "rate")
    return plain(rounded(averaged.select(*PAIR_DAY, "rate", "rate_7d_moving_avg"), 6, "rate_7d_moving_avg"))


@query
def rates_by_region(spark, sf):
    return plain(regional(spark, sf))


@query
def country_currency_map(spark, sf):
    return plain(gold.in_report_order(gold.country_currency_map(countries(spark, sf), summary(spark, sf))))


# ---- quality ----------------------------------------------------------------------


@query
def not_null(spark, sf):
    """Facts without a previous day: the first of every pair."""
    return plain(quality.not_null(facts(spark, sf), "previous_day_rate").select(*PAIR_DAY, "rate"))


@query
def unique(spark, sf):
    return plain(quality.unique(A.table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber"))


@query
def unique_after_batch(spark, sf):
    """Repeated keys of all order lines, found from the index of the earlier ones and the rows of the last batch alone."""
    lines = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    keys = lines.select("l_orderkey", "l_linenumber")
    index = KeyIndex(spark, shared_folder(spark, "keys"), keys.schema)
    index.add(lines.filter("l_shipdate < '1997-01-01'"), "first")
    index.add(lines.filter("l_shipdate >= '1997-01-01' and l_shipdate < '2001-01-01'"), "second")
    return plain(index.check(lines.filter("l_shipdate >= '2001-01-01'")))


@query
def accepted_values(spark, sf):
    orders = A.table(spark, sf, "orders")
    return plain(quality.accepted_values(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"], "o_orderstatus <> 'P'"))


@query
def run_checks(spark, sf):
    """All gold and dimension checks on the price series: three bases, so the target alone is not unique."""
    dim = stored(spark, countries(spark, sf), "dim")
    fct = stored(spark, facts(spark, sf), "fct")
    latest = stored(spark, gold.currency_summary_joined(fct, A.AS_OF), "summary")
    tables = {
        "agg_currency_summary": latest,
        "agg_rates_by_region": stored(spark, gold.rates_by_region(fct, dim, A.AS_OF, codes=A.target_codes(spark, sf)), "region"),
        "agg_country_currency_map": stored(spark, gold.country_currency_map(dim, latest), "map"),
        "dim_countries": dim,
    }
    return plain(quality.run_checks(tables, [*quality.GOLD_RULES, *quality.DIM_RULES, quality.PAIR_RULE]))


# ---- report feeds -----------------------------------------------------------------


@query
def kpis(spark, sf):
    dim = stored(spark, countries(spark, sf), "dim")
    fct = stored(spark, facts(spark, sf), "fct")
    latest = stored(spark, gold.currency_summary_joined(fct, A.AS_OF), "summary")
    tables = {
        "agg_currency_summary": latest,
        "agg_rates_by_region": stored(spark, gold.rates_by_region(fct, dim, A.AS_OF, codes=A.target_codes(spark, sf)), "region"),
        "agg_country_currency_map": stored(spark, gold.country_currency_map(dim, latest, base="A"), "map"),
    }
    figures = feeds.kpis(
        latest,
        dim,
        fct,
        audit.run_state(A.event_runs(spark, sf)),
        [A.raw_rates(spark, sf), A.raw_countries(spark, sf)],
        quality.run_checks(tables, quality.GOLD_RULES),
        A.AS_OF,
        code="Brand#7",
        days=10,
        runs_as_of=A.EVENTS_AS_OF,
    )
    return plain(figures)


@query
def trend(spark, sf):
    lines = feeds.trend(regional(spark, sf), ["Brand#1", "Brand#2", "Brand#25"], A.AS_OF, base="A", scale={"Brand#25": 100})
    return plain(rounded(lines.withColumnsRenamed({"Brand#1": "b1", "Brand#2": "b2", "Brand#25": "b25"}), 6, "b25"))


@query
def currencies_by_region(spark, sf):
    return plain(feeds.currencies_by_region(countries(spark, sf)))


@query
def volatility_distribution(spark, sf):
    return plain(feeds.volatility_distribution(summary(spark, sf)))


@query
def rates_table(spark, sf):
    return plain(feeds.rates_table(summary(spark, sf), "BRAND#2"))


# ---- the daily job ----------------------------------------------------------------


def _daily(spark: SparkSession, sf: str) -> daily.Layers:
    """The whole job from JSON payloads to stored tables, with all gold rules, gold of one base."""
    root = shared_folder(spark, "daily")
    rates = A.raw_rates(spark, sf).select(
        F.col("base_currency").alias("base"),
        F.col("timestamp").cast("bigint").alias("timestamp"),
        F.create_map("target_currency", F.col("rate").cast("decimal(20,8)")).alias("rates"),
    )
    rates.write.json(f"{root}/rates_payloads")
    listed = F.split("currencies", ", ")
    unit = F.struct(F.lit("").alias("name"), F.lit("").alias("symbol"))
    nations = staging.stage_countries(A.raw_countries(spark, sf)).select(
        "cca2", "cca3", F.struct(F.trim("name_common").alias("common"), F.col("name_official").alias("official")).alias("name"),
        "region", "subregion", F.array_compact(F.array("capital")).alias("capital"), "population",
        F.col("area_km2").cast("double").alias("area"),
        F.map_from_arrays(listed, F.transform(listed, lambda code: unit)).alias("currencies"),
        F.col("is_un_member").alias("unMember"), F.col("flag_emoji").alias("flag"),
    )
    nations.write.json(f"{root}/countries_payloads")
    daily.run_daily(
        spark,
        RatesSource("rates_api", f"{root}/rates_payloads", multiline=False),
        CountriesSource("countries_api", f"{root}/countries_payloads", multiline=False),
        f"{root}/tables",
        "run_001",
        date.fromisoformat(A.AS_OF),
        datetime(2024, 1, 15, tzinfo=timezone.utc),
        [*quality.GOLD_RULES, quality.PAIR_RULE],
        base="A",
        loaded_at=datetime(2024, 1, 16, tzinfo=timezone.utc),
    )
    return daily.Layers(f"{root}/tables")


@query
def daily_run(spark, sf):
    """The summary that the daily job stores."""
    summary_ = daily.read_table(spark, _daily(spark, sf), "gold", "agg_currency_summary")
    return plain(rounded(summary_, 6, "rate_volatility_30d"))


@query
def daily_tables(spark, sf):
    """Rows and figures of the other tables that the daily job stores."""
    layers = _daily(spark, sf)
    bronze = read_landing(spark, layers.path("bronze", "raw_currencies"), schemas.RAW_RATES)
    fct, dim = (daily.read_table(spark, layers, "silver", name) for name in ("fct_exchange_rates", "dim_countries"))
    region, places, checks = (
        daily.read_table(spark, layers, "gold", name) for name in ("agg_rates_by_region", "agg_country_currency_map", "check_results")
    )

    def row(name, df, value):
        return df.agg(F.count("*").alias("rows"), F.round(value.cast("double"), 4).alias("value")).select(F.lit(name).alias("table"), "rows", "value")

    lag = F.sum(F.unix_timestamp("_loaded_at") - F.unix_timestamp("_extracted_at"))
    parts = [
        row("bronze", bronze, lag),
        row("bronze rates", bronze, F.sum(F.col("rate").cast("decimal(20,8)"))),
        row("facts", fct, F.sum("rate")),
        row("facts with region", fct.filter("currency_region is not null"), F.sum("rate_change_pct")),
        row("countries", dim, F.sum("population")),
        row("regions", region, F.sum("country_count")),
        row("map", places, F.count("latest_rate")),
        row("checks", checks, F.sum("failures")),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
