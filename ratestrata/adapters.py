"""The supplied star schema and event tables, read as rates, countries and runs.

Everything is derived from whole tables. The same derivations stand in SQL in `oracles.py`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Last shipping day of every supplied scale factor.
AS_OF = "2001-11-04"
EVENTS_AS_OF = "2024-01-20"
# Months of the price series that a late batch writes again.
LATE_MONTHS = ("1996-02", "1998-11", "1998-12")

# Seconds at the start of a day in UTC, whatever the session time zone.
EPOCH = "cast(date_diff(cast({0} as date), date'1970-01-01') as bigint) * 86400"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(parts, lines.l_partkey == parts.p_partkey)


def staged_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price series in staged form: return flag as base, brand as target, price as rate.

    A pair has many lines per day, which play the part of repeated extractions.
    """
    return priced_lines(spark, sf_dir).selectExpr(
        "l_returnflag as base_currency",
        "p_brand as target_currency",
        "cast(l_extendedprice as decimal(20,8)) as rate",
        "cast(l_shipdate as date) as rate_date",
        EPOCH.format("l_shipdate") + " as unix_timestamp",
        "l_linestatus as source_system",
        "timestampadd(SECOND, l_linenumber, cast(l_shipdate as timestamp)) as extracted_at",
        "cast(l_orderkey as string) as pipeline_run_id",
    )


LANDED = [
    "base_currency",
    "target_currency",
    "cast(rate as string) as rate",
    "cast(rate_date as string) as rate_date",
    "cast(unix_timestamp as string) as timestamp",
    "source_system as _source",
    "extracted_at as _extracted_at",
    "pipeline_run_id as _pipeline_run_id",
    "extracted_at as _loaded_at",
]


def raw_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same series in landing form, as text."""
    return staged_rates(spark, sf_dir).selectExpr(*LANDED)


def target_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All codes that can be a target: a far smaller table than the series."""
    return table(spark, sf_dir, "part").selectExpr("p_brand as target_currency")


def listed_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation the brands that its suppliers ship in more lines than their mean brand.

    Lines shrink to one row per supplier and brand before they meet the suppliers.
    """
    shipped = priced_lines(spark, sf_dir).groupBy("l_suppkey", "p_brand").count()
    suppliers = table(spark, sf_dir, "supplier")
    brands = (
        shipped.join(suppliers, shipped.l_suppkey == suppliers.s_suppkey)
        .groupBy("s_nationkey", "p_brand")
        .sum("count")
        .toDF("s_nationkey", "p_brand", "n")
    )
    return brands.selectExpr(
        "*", "sum(n) over (partition by s_nationkey) as total", "count(*) over (partition by s_nationkey) as brands"
    ).filter("n * brands > total").select("s_nationkey", "p_brand", "n")


def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries in landing form: a nation, extracted once per market segment of its customers."""
    # A list has at most as many members as there are brands.
    lists = listed_brands(spark, sf_dir).selectExpr("s_nationkey as l_home", "p_brand").groupBy("l_home")
    lists = lists.agg({"p_brand": "collect_list"}).toDF("l_home", "brands")
    capitals = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg({"s_name": "min"}).toDF("c_home", "capital")
    segments = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg({"c_custkey": "max"})
    segments = segments.toDF("c_nationkey", "c_mktsegment", "top")
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = (
        segments.join(nations, segments.c_nationkey == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
        .join(lists, nations.n_nationkey == lists.l_home, "left")
        .join(capitals, nations.n_nationkey == capitals.c_home, "left")
        .selectExpr("*", "cast(n_nationkey as bigint) as n")
    )
    return rows.selectExpr(
        "case when n = 24 and c_mktsegment = 'MACHINERY' then '' else concat('N', n) end as cca2",
        "n_name as cca3",
        "concat(' ', n_name, ' ') as name_common",
        "case when c_mktsegment = 'HOUSEHOLD' then '  ' else concat('Nation of ', n_name) end as name_official",
        "r_name as region",
        "case when n % 4 = 0 then '' else concat(r_name, ' ', n % 4) end as subregion",
        "capital",
        "case when n = 13 then '' else cast(top * cast(pow(10, n % 6) as bigint) as string) end as population",
        "case when n % 5 = 0 then '' when n % 7 = 0 then '0' "
        "else cast(cast((n + 1) * 1000.5 as decimal(15,4)) as string) end as area_km2",
        "array_join(sort_array(brands), ', ') as currencies",
        "c_mktsegment as languages",
        "'' as timezones",
        "get(array('TRUE', 'yes', '0', 'No', 'maybe'), cast(n % 6 as int)) as is_un_member",
        "concat('flag ', n) as flag_emoji",
        "'countries' as _source",
        "case when top % 17 <> 0 then timestampadd(SECOND, cast(top % 86400 as int), "
        "cast(timestamp_ntz'2024-01-01 00:00:00' as timestamp)) end as _extracted_at",
        "c_mktsegment as _pipeline_run_id",
    )


def event_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in staged form: event type as base, user as target, value as rate."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_type as base_currency",
        "cast(user_id as string) as target_currency",
        "cast(value as decimal(20,8)) as rate",
        "cast(ts as date) as rate_date",
        EPOCH.format("ts") + " as unix_timestamp",
        "'events' as source_system",
        "cast(ts as timestamp) as extracted_at",
        "cast(event_id as string) as pipeline_run_id",
    )


def event_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in landing form."""
    return event_rates(spark, sf_dir).selectExpr(*LANDED)


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a run: `error` fails, `view` never finishes, the rest succeeds."""
    events = table(spark, sf_dir, "events")
    run = ["cast(event_id as string) as run_id", "event_type as dag_id", "'events' as source_name"]
    started = events.selectExpr(
        *run, "'running' as status", "cast(null as bigint) as records_extracted",
        "cast(null as bigint) as records_loaded", "cast(ts as timestamp) as started_at",
        "cast(null as timestamp) as finished_at", "cast(null as string) as error_message",
    )
    finished = events.filter("event_type <> 'view'").selectExpr(
        *run, "if(event_type = 'error', 'failed', 'success') as status", "user_id as records_extracted",
        "if(event_type = 'error', 0L, user_id) as records_loaded", "cast(null as timestamp) as started_at",
        "cast(ts + make_dt_interval(0, 0, 0, cast(value as decimal(18,6))) as timestamp) as finished_at",
        "if(event_type = 'error', props, null) as error_message",
    )
    return started.unionByName(finished)
