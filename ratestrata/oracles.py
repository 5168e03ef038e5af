"""The SQL each catalog query must equal, written in the plain (naive) form of its operator."""

from __future__ import annotations

from ratestrata.adapters import AS_OF, EVENTS_AS_OF, LATE_MONTHS

STAMP = "'%Y-%m-%d %H:%M:%S.%f'"
# The tokens that mean "missing", written out so that the SQL does not follow the code.
TOKENS = """'', '#N/A', '#N/A N/A', '#NA', '-', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',
    '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"""
HIGHEST_PRICE = 100000


def stamp(col: str, name: str | None = None) -> str:
    return f"strftime({col}, {STAMP}) AS {name or col}"


def text(col: str, name: str | None = None) -> str:
    return f"cast({col} AS varchar) AS {name or col}"


def number(col: str, name: str | None = None) -> str:
    return f"cast({col} AS double) AS {name or col}"


def long(col: str, name: str | None = None) -> str:
    return f"cast({col} AS bigint) AS {name or col}"


def whole(*parts: str) -> str:
    """CTEs and a final SELECT as one statement."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def newest(source: str, keys: str, order: str, ties: list[str]) -> str:
    tail = ", ".join(f"{name} DESC NULLS LAST" for name in ties)
    return f"""(SELECT * FROM {source}
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order} DESC NULLS FIRST, {tail}) = 1)"""


def change_pct(rate: str, previous: str) -> str:
    """Change in percent, rounded half away from zero at four places, in whole numbers: the
    division of decimals would pass through a double and round exact halves either way."""
    step = f"abs(cast(({rate} - {previous}) * 100000000 AS hugeint))"
    unit = f"cast({previous} * 100000000 AS hugeint)"
    return f"sign({rate} - {previous}) * ((2 * {step} * 1000000 + {unit}) // (2 * {unit})) / 10000.0"


PAIR = "base_currency, target_currency"
PAIR_DAY = f"{PAIR}, rate_date"
STAGED_TIES = ["rate", "unix_timestamp", "source_system", "pipeline_run_id"]

RAW_RATES = """raw_rates AS (
    SELECT l_returnflag AS base_currency, p_brand AS target_currency,
        cast(l_extendedprice AS decimal(20,8)) AS rate, cast(l_shipdate AS date) AS rate_date,
        date_diff('day', date '1970-01-01', cast(l_shipdate AS date)) * 86400 AS unix_timestamp,
        l_linestatus AS source_system, l_shipdate + to_seconds(l_linenumber) AS extracted_at,
        cast(l_orderkey AS varchar) AS pipeline_run_id
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""

BRANDS = """brands AS (
    SELECT s_nationkey, p_brand, count(*) AS n FROM lineitem
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
listed AS (
    SELECT * FROM brands b WHERE n > (SELECT avg(n) FROM brands a WHERE a.s_nationkey = b.s_nationkey))"""

RAW_COUNTRIES = BRANDS + """,
lists AS (SELECT s_nationkey, string_agg(p_brand, ', ' ORDER BY p_brand) AS currencies FROM listed GROUP BY 1),
capitals AS (SELECT s_nationkey, min(s_name) AS capital FROM supplier GROUP BY 1),
segments AS (SELECT c_nationkey, c_mktsegment, max(c_custkey) AS top FROM customer GROUP BY ALL),
raw_countries AS (
    SELECT CASE WHEN n_nationkey = 24 AND c_mktsegment = 'MACHINERY' THEN '' ELSE 'N' || n_nationkey END AS cca2,
        n_name AS cca3, ' ' || n_name || ' ' AS name_common,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '  ' ELSE 'Nation of ' || n_name END AS name_official,
        r_name AS region,
        CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE r_name || ' ' || (n_nationkey % 4) END AS subregion,
        capital,
        CASE WHEN n_nationkey <> 13 THEN top * cast(pow(10, n_nationkey % 6) AS bigint) END AS population,
        CASE WHEN n_nationkey % 5 = 0 THEN NULL WHEN n_nationkey % 7 = 0 THEN 0
            ELSE cast((n_nationkey + 1) * 1000.5 AS decimal(15,4)) END AS area_km2,
        currencies, c_mktsegment AS languages, '' AS timezones,
        CASE n_nationkey % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false END AS is_un_member,
        'flag ' || n_nationkey AS flag_emoji, 'countries' AS source_system,
        CASE WHEN top % 17 <> 0 THEN timestamp '2024-01-01' + to_seconds(top % 86400) END AS extracted_at,
        c_mktsegment AS pipeline_run_id
    FROM segments JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN lists l ON l.s_nationkey = n_nationkey LEFT JOIN capitals c ON c.s_nationkey = n_nationkey),
stg_countries AS (SELECT * FROM raw_countries WHERE cca2 <> '')"""


def dim_cte(ties: list[str] | None = None, source: str = "stg_countries") -> str:
    ties = ties or [
        "cca3", "name_common", "name_official", "region", "subregion", "capital", "population", "area_km2",
        "currencies", "languages", "timezones", "is_un_member", "flag_emoji", "source_system", "pipeline_run_id",
    ]
    return f"""dim AS (
    SELECT cca2, cca3, nullif(trim(name_common), '') AS name_common, nullif(trim(name_official), '') AS name_official,
        nullif(trim(region), '') AS region, nullif(trim(subregion), '') AS subregion,
        nullif(trim(capital), '') AS capital, population, area_km2,
        CASE WHEN population >= 1000000000 THEN 'mega' WHEN population >= 100000000 THEN 'large'
            WHEN population >= 10000000 THEN 'medium' WHEN population >= 1000000 THEN 'small'
            WHEN population IS NOT NULL THEN 'micro' END AS population_tier,
        CASE WHEN area_km2 > 0 THEN round(population / area_km2, 2) END AS population_density,
        currencies, languages, coalesce(currencies LIKE '%,%', false) AS has_multiple_currencies,
        is_un_member, timezones, flag_emoji, source_system, extracted_at, pipeline_run_id
    FROM {newest(source, "cca2", "extracted_at", ties)})"""


DIM = RAW_COUNTRIES + ",\n" + dim_cte()


def fct_cte(source: str = "raw_rates", hi: int = HIGHEST_PRICE, ties: list[str] = STAGED_TIES) -> str:
    """The facts with the containment written as the naive pattern match."""
    return f"""deduped AS (SELECT * FROM {newest(source, PAIR_DAY, "extracted_at", ties)}),
changed AS (
    SELECT *, round(1.0 / nullif(rate, 0), 8) AS inverse_rate, {change_pct("rate", "previous_day_rate")} AS rate_change_pct
    FROM (SELECT *, lag(rate) OVER (PARTITION BY {PAIR} ORDER BY rate_date) AS previous_day_rate
        FROM deduped WHERE rate > 0 AND rate < {hi})),
codes AS (SELECT DISTINCT target_currency AS code FROM changed),
holders AS (SELECT code, dim.* FROM codes JOIN dim ON currencies LIKE '%' || code || '%'),
winners AS (
    SELECT * FROM holders h WHERE population = (SELECT max(population) FROM holders a WHERE a.code = h.code)),
fct AS (
    SELECT changed.*, region AS currency_region, name_common AS primary_country_name
    FROM changed LEFT JOIN winners ON code = target_currency)"""


FCT = ",\n".join([DIM, RAW_RATES, fct_cte()])


def summary_cte(as_of: str = AS_OF) -> str:
    return f"""latest AS (
    SELECT * FROM fct QUALIFY row_number() OVER (PARTITION BY {PAIR} ORDER BY rate_date DESC NULLS FIRST,
        currency_region DESC NULLS LAST, primary_country_name DESC NULLS LAST, pipeline_run_id DESC NULLS LAST) = 1),
stats AS (
    SELECT {PAIR}, stddev_samp(cast(rate AS double)) AS sd, avg(rate) AS mean, min(rate) AS low, max(rate) AS high,
        count(*) AS days_of_data
    FROM fct WHERE rate_date >= date '{as_of}' - interval 30 days GROUP BY ALL),
summary AS (
    SELECT base_currency, target_currency, rate AS latest_rate, inverse_rate, rate_date,
        rate_change_pct AS day_over_day_change_pct, currency_region AS region, primary_country_name,
        round(mean, 6) AS rate_avg_30d, round(low, 6) AS rate_min_30d, round(high, 6) AS rate_max_30d,
        round(round(sd, 8), 6) AS rate_volatility_30d,
        CASE WHEN sd / nullif(mean, 0) < 0.01 THEN 'low' WHEN sd / nullif(mean, 0) < 0.05 THEN 'medium'
            ELSE 'high' END AS volatility_tier,
        days_of_data, pipeline_run_id
    FROM latest LEFT JOIN stats USING (base_currency, target_currency))"""


SUMMARY = FCT + ",\n" + summary_cte()

SUMMARY_SELECT = f"""SELECT {PAIR}, {number("latest_rate")}, {number("inverse_rate")}, {text("rate_date")},
    {number("day_over_day_change_pct")}, region, primary_country_name, {number("rate_avg_30d")},
    {number("rate_min_30d")}, {number("rate_max_30d")}, rate_volatility_30d, volatility_tier, days_of_data,
    pipeline_run_id FROM summary"""

REGIONAL_CTE = f"""regional AS (
    SELECT r.rate_date, r.base_currency, r.target_currency, coalesce(r.currency_region, 'Unknown') AS region,
        r.primary_country_name, avg(r.rate) AS avg_rate, min(r.rate) AS min_rate, max(r.rate) AS max_rate,
        avg(r.rate_change_pct) AS avg_rate_change_pct, count(DISTINCT c.cca2) AS country_count
    FROM fct r LEFT JOIN dim c
        ON c.region = r.currency_region AND c.currencies LIKE '%' || r.target_currency || '%'
    WHERE r.rate_date >= date '{AS_OF}' - interval 30 days GROUP BY ALL)"""
REGIONAL = FCT + ",\n" + REGIONAL_CTE

BY_REGION = REGIONAL + """,
by_region AS (
    SELECT rate_date, base_currency, target_currency, region, primary_country_name, round(avg_rate, 6) AS avg_rate,
        round(min_rate, 6) AS min_rate, round(max_rate, 6) AS max_rate,
        round(avg_rate_change_pct, 4) AS avg_rate_change_pct, country_count,
        round(avg(avg_rate) OVER (PARTITION BY base_currency, target_currency, region
            ORDER BY rate_date, primary_country_name NULLS FIRST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6)
            AS rate_7d_moving_avg
    FROM regional)"""

COUNTRY_MAP = SUMMARY + """,
country_map AS (
    SELECT cca2, cca3, name_common, d.region, subregion, capital, population, population_tier, population_density,
        area_km2, currencies, is_un_member, flag_emoji, split_part(currencies, ', ', 1) AS primary_currency,
        s.latest_rate, s.rate_date AS latest_rate_date, s.day_over_day_change_pct AS day_change_pct, s.volatility_tier
    FROM dim d LEFT JOIN summary s ON s.target_currency = split_part(d.currencies, ', ', 1))"""

EVENTS = """event_rates AS (
    SELECT event_type AS base_currency, cast(user_id AS varchar) AS target_currency,
        cast(value AS decimal(20,8)) AS rate, cast(ts AS date) AS rate_date,
        date_diff('day', date '1970-01-01', cast(ts AS date)) * 86400 AS unix_timestamp,
        'events' AS source_system, ts AS extracted_at, cast(event_id AS varchar) AS pipeline_run_id FROM events)"""

SERIES = EVENTS + f""",
series AS (SELECT * FROM {newest("event_rates", PAIR_DAY, "extracted_at", STAGED_TIES)})"""

EVENT_STATS = SERIES + f""",
stats AS (
    SELECT {PAIR}, stddev_samp(cast(rate AS double)) AS sd, avg(rate) AS mean, min(rate) AS low, max(rate) AS high,
        count(*) AS days_of_data
    FROM series WHERE rate_date >= date '{EVENTS_AS_OF}' - interval 10 days GROUP BY ALL)"""

EVENT_LANDING = EVENTS + """,
landing AS (
    SELECT base_currency, target_currency, cast(rate AS varchar) AS rate, cast(rate_date AS varchar) AS rate_date,
        cast(unix_timestamp AS varchar) AS "timestamp", source_system AS _source, extracted_at AS _extracted_at,
        pipeline_run_id AS _pipeline_run_id FROM event_rates)"""
LANDING_TIES = ["rate", "rate_date", '"timestamp"', "_source", "_pipeline_run_id"]
LANDING_SELECT = f"""SELECT base_currency, target_currency, rate, rate_date, "timestamp", _source,
    {stamp("_extracted_at")}, _pipeline_run_id, {stamp("_extracted_at", "_loaded_at")}"""

RUNS = """runs AS (
    SELECT cast(event_id AS varchar) AS run_id, event_type AS dag_id, 'events' AS source_name,
        CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'success' END AS status,
        CASE WHEN event_type <> 'view' THEN user_id END AS records_extracted,
        CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN 0 ELSE user_id END AS records_loaded,
        ts AS started_at,
        CASE WHEN event_type <> 'view' THEN ts + to_microseconds(cast(cast(value AS decimal(18,6)) * 1000000 AS bigint))
            END AS finished_at,
        CASE WHEN event_type = 'error' THEN props END AS error_message
    FROM events)"""

STAGED_SELECT = f"""SELECT base_currency, target_currency, {number("rate")}, {text("rate_date")}, {long("unix_timestamp")},
    source_system, {stamp("extracted_at")}, pipeline_run_id"""

FCT_SELECT = f"""SELECT {PAIR}, {number("rate")}, {text("rate_date")}, {number("inverse_rate")},
    {number("previous_day_rate")}, {number("rate_change_pct")}, {long("unix_timestamp")}, source_system,
    {stamp("extracted_at")}, pipeline_run_id, currency_region, primary_country_name FROM fct"""

COUNTRY_SELECT = f"""SELECT cca2, cca3, name_common, name_official, region, subregion, capital, {long("population")},
    {number("area_km2")}, currencies, languages, timezones, {text("is_un_member")}, flag_emoji, source_system,
    {stamp("extracted_at")}, pipeline_run_id"""


def part_regions(condition: str) -> str:
    return whole(
        DIM,
        f"holders AS (SELECT p_partkey, p_brand, region, name_common, population FROM part JOIN dim ON {condition})",
        """winners AS (SELECT * FROM holders QUALIFY population = max(population) OVER (PARTITION BY p_partkey))""",
        """SELECT p.p_partkey, p.p_brand, region, name_common AS country
        FROM part p LEFT JOIN winners w ON w.p_partkey = p.p_partkey""",
    )


def check(model: str, column: str, name: str, failures: str) -> str:
    return f"""SELECT '{model}' AS model, '{column}' AS "column", '{name}' AS "check",
        cast(({failures}) AS bigint) AS failures"""


def nulls(model: str, table: str, column: str) -> str:
    return check(model, column, "not_null", f"SELECT count(*) FROM {table} WHERE {column} IS NULL")


def repeats(model: str, table: str, column: str) -> str:
    inner = f"SELECT {column} FROM {table} GROUP BY {column} HAVING count(*) > 1 AND count({column.split(',')[0]}) > 0"
    return check(model, column, "unique", f"SELECT count(*) FROM ({inner})")


SUMMARY_CHECKS = [
    nulls("agg_currency_summary", "summary", "target_currency"),
    repeats("agg_currency_summary", "summary", "target_currency"),
    nulls("agg_currency_summary", "summary", "latest_rate"),
    nulls("agg_currency_summary", "summary", "rate_date"),
    check("agg_currency_summary", "volatility_tier", "accepted_values",
          "SELECT count(DISTINCT volatility_tier) FROM summary WHERE volatility_tier NOT IN ('low', 'medium', 'high')"),
]
MAP_OF_A = """country_map_of_a AS (
    SELECT cca2, name_common, s.latest_rate FROM dim d
    LEFT JOIN (SELECT * FROM summary WHERE base_currency = 'A') s ON s.target_currency = split_part(d.currencies, ', ', 1))"""
GOLD_CHECKS = SUMMARY_CHECKS + [
    nulls("agg_rates_by_region", "by_region", "rate_date"),
    nulls("agg_rates_by_region", "by_region", "region"),
    nulls("agg_rates_by_region", "by_region", "avg_rate"),
    nulls("agg_country_currency_map", "country_map_of_a", "cca2"),
    repeats("agg_country_currency_map", "country_map_of_a", "cca2"),
    nulls("agg_country_currency_map", "country_map_of_a", "name_common"),
]
ALL_CHECKS = SUMMARY_CHECKS + [
    repeats("agg_currency_summary", "summary", "base_currency, target_currency"),
    nulls("agg_rates_by_region", "by_region", "rate_date"),
    nulls("agg_rates_by_region", "by_region", "region"),
    nulls("agg_rates_by_region", "by_region", "avg_rate"),
    nulls("agg_country_currency_map", "country_map", "cca2"),
    repeats("agg_country_currency_map", "country_map", "cca2"),
    nulls("agg_country_currency_map", "country_map", "name_common"),
    nulls("dim_countries", "dim", "cca2"),
    repeats("dim_countries", "dim", "cca2"),
    check("dim_countries", "region", "accepted_values", """SELECT count(DISTINCT region) FROM dim
        WHERE region NOT IN ('Africa', 'Americas', 'Antarctic', 'Asia', 'Europe', 'Oceania')"""),
]


def figure(name: str, value: str) -> str:
    return f"SELECT '{name}' AS kpi, cast(({value}) AS double) AS value"


def stored(name: str, source: str, value: str) -> str:
    return f"""SELECT '{name}' AS "table", count(*) AS rows, round(cast(sum({value}) AS double), 4) AS value FROM {source}"""


SINCE = f"date '{AS_OF}' - interval 30 days"

PAYLOADS = """payloads AS (
    SELECT nullif(event_type, 'error') AS base,
        date_diff('day', date '1970-01-01', cast(ts AS date)) * 86400 + hour(ts) * 3600 AS seconds,
        user_id, value, props, ts FROM events)"""

DAILY = ",\n".join([
    RAW_COUNTRIES,
    """day_countries AS (
        SELECT cca2, cca3, trim(name_common) AS name_common, name_official, region, nullif(subregion, '') AS subregion,
            capital, coalesce(population, 0) AS population, cast(coalesce(population, 0) AS varchar) AS people,
            nullif(area_km2, 0) AS area_km2, currencies, NULL AS languages, '' AS timezones,
            coalesce(is_un_member, false) AS is_un_member, flag_emoji, '' AS source_system,
            timestamp '2024-01-15' AS extracted_at, '' AS pipeline_run_id FROM stg_countries)""",
    dim_cte(["cca3", "name_common", "name_official", "region", "subregion", "capital", "people"], "day_countries"),
    RAW_RATES,
    """day_rates AS (
        SELECT base_currency, target_currency, rate, cast(rate AS varchar) AS digits, rate_date, unix_timestamp,
            'rates_api' AS source_system, timestamp '2024-01-15' AS extracted_at, 'run_001' AS pipeline_run_id
        FROM raw_rates)""",
    fct_cte("day_rates", 1000000, ["digits"]),
    summary_cte(),
])

LATE = f"""late_rates AS (
    SELECT * REPLACE (CASE WHEN strftime(rate_date, '%Y-%m') IN {LATE_MONTHS} AND day(rate_date) >= 20
        THEN CASE WHEN base_currency = 'N' THEN 0 ELSE cast('1' || cast(rate AS varchar) AS decimal(20,8)) END
        ELSE rate END AS rate)
    FROM {newest("raw_rates", PAIR_DAY, "extracted_at", ["cast(rate AS varchar)", "cast(unix_timestamp AS varchar)", "source_system", "pipeline_run_id"])})"""

ORACLES = {
    "csv_table": """SELECT cast(c_custkey AS varchar) AS cust_key, c_name || '; "x", ' || c_mktsegment AS full_name,
        nullif(c_mktsegment, 'BUILDING') AS mkt_segment, cast(cast(c_acctbal AS decimal(12,2)) AS varchar) AS acct_bal_usd
        FROM customer""",
    "csv_counts": "SELECT count(*) AS rows, 'false' AS empty, count(*) AS keys FROM orders",
    "csv_source": """SELECT o_orderkey AS order_key, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
        cast(cast(o_totalprice AS decimal(14,2)) AS double) AS price,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority FROM orders""",
    "csv_line_breaks": """SELECT cast(o_orderkey AS varchar) AS o_orderkey,
        CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority
            ELSE o_orderpriority || chr(10) || '"quoted", ' || o_orderstatus || chr(10) || chr(10) || 'last; ' END AS note,
        cast(cast(o_totalprice AS decimal(14,2)) AS varchar) AS price FROM orders""",
    "normalize_columns": """SELECT c_custkey AS cust_key, c_name AS full_name, cast(c_nationkey AS bigint) AS nation_key,
        c_acctbal AS acct_bal_, c_mktsegment AS segment FROM customer""",
    "null_tokens": f"""SELECT o_orderkey, CASE WHEN s NOT IN ({TOKENS}) THEN s END AS status,
        CASE WHEN p NOT IN ({TOKENS}) THEN p END AS priority
        FROM (SELECT o_orderkey, [{TOKENS}, 'na', 'N/A ', 'none', '0'][o_orderkey % 24 + 1] AS s,
            CASE o_orderpriority WHEN '5-LOW' THEN 'null' ELSE o_orderpriority END AS p FROM orders)""",
    "trim_and_drop_empty": """SELECT CASE o_orderstatus WHEN 'O' THEN o_orderpriority WHEN 'P' THEN '' END AS priority,
        CASE WHEN o_orderpriority = '5-LOW' THEN o_orderstatus END AS status
        FROM orders WHERE o_orderstatus IN ('O', 'P') OR o_orderpriority = '5-LOW'""",
    "cast_columns": """SELECT p_partkey, p_name, cast(cast(p_retailprice AS decimal(12,2)) AS double) AS p_retailprice,
        CASE WHEN p_size = 1 THEN 'one' ELSE cast(p_size AS varchar) END AS p_size FROM part""",
    "flatten_rates_payloads": whole(
        PAYLOADS,
        """pairs AS (
            SELECT base, cast(user_id AS varchar) AS target, cast(value AS double) AS rate, seconds, ts FROM payloads
            UNION ALL SELECT base, 'k', cast(json_extract(props, '$.k') AS double), seconds, ts FROM payloads)""",
        f"""SELECT base AS base_currency, target AS target_currency, rate, {text("cast(ts AS date)", "rate_date")},
            {long("seconds", '"timestamp"')} FROM pairs WHERE base IS NOT NULL""",
    ),
    "exact_rates": """SELECT 'E' || event_id AS target_currency, rate,
        CASE WHEN event_id % 7 <> 0 THEN cast(cast(rate AS decimal(20,8)) AS double) END AS staged
        FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '9' || lpad(cast(event_id AS varchar), 13, '0') || '.25'
            ELSE (event_id % 10) || '.00001488' || lpad(cast(event_id AS varchar), 9, '0') || '1' END AS rate FROM events)""",
    "broken_rates_payloads": whole(
        PAYLOADS,
        f"""SELECT 'base' AS missing_fields, {long("seconds", '"timestamp"')}, count(*) AS payloads
            FROM payloads WHERE base IS NULL GROUP BY seconds""",
    ),
    "flatten_countries_payloads": """SELECT cast(c_custkey AS varchar) AS cca2,
        CASE WHEN odd THEN n_name ELSE '' END AS cca3, c_name AS name_common,
        CASE WHEN odd THEN n_name ELSE '' END AS name_official, CASE WHEN odd THEN n_name ELSE '' END AS region,
        CASE WHEN NOT odd THEN c_mktsegment END AS subregion, CASE WHEN odd THEN c_mktsegment END AS capital,
        CASE WHEN odd THEN c_custkey ELSE 0 END AS population, CASE WHEN odd THEN nullif(c_acctbal, 0) END AS area_km2,
        CASE WHEN odd THEN least(n_name, c_mktsegment) || ', ' || greatest(n_name, c_mktsegment) END AS currencies,
        CASE WHEN odd THEN least('A', c_name) || ', ' || greatest('A', c_name) END AS languages,
        CASE WHEN odd THEN 'UTC+01:00, ' || c_mktsegment ELSE '' END AS timezones,
        cast(odd AS varchar) AS is_un_member, '🇩🇪' AS flag_emoji
        FROM (SELECT *, c_custkey % 2 = 1 AS odd FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "join_sorted": whole(
        BRANDS,
        """SELECT n_name, string_agg(p_brand, ', ' ORDER BY p_brand) AS brands,
            string_agg('n' || n, ', ' ORDER BY 'n' || n) AS counts,
            coalesce(string_agg(p_brand, ', ' ORDER BY p_brand DESC), '') AS backwards
        FROM nation LEFT JOIN listed ON s_nationkey = n_nationkey GROUP BY n_name""",
    ),
    "lineage": """SELECT o_orderkey, o_totalprice, 'orders' AS _source, '2024-01-15 00:05:00.000000' AS _extracted_at,
        'run_001' AS _pipeline_run_id FROM orders""",
    "validate": whole(EVENTS, f"SELECT {PAIR}, {number('rate')}, pipeline_run_id, {text('rate > 0', 'kept')} FROM event_rates"),
    "validate_text": """SELECT event_id,
        CASE event_id % 6 WHEN 0 THEN 'abc' WHEN 1 THEN '' WHEN 2 THEN '-1.5' WHEN 3 THEN '1e-9' WHEN 4 THEN 'NaN' ELSE '12' END AS rate,
        CASE WHEN event_id % 6 IN (3, 5) THEN 'true' ELSE 'false' END AS kept FROM events""",
    "validate_countries": whole(
        RAW_COUNTRIES,
        """codes AS (
            SELECT cca2, CASE WHEN cca2 = '' OR try_cast(population AS bigint) > 9000 THEN NULL ELSE cca3 END AS cca3, languages AS origin FROM raw_countries)""",
        """SELECT origin, kept, count(*) AS n FROM (
            SELECT origin, cast(coalesce(cca2, '') <> '' OR coalesce(cca3, '') <> '' AS varchar) AS kept FROM codes
            UNION ALL SELECT 'order', cast(o_orderpriority = '5-LOW' AS varchar) FROM orders) GROUP BY ALL""",
    ),
    "landing_text": """SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_totalprice AS varchar) AS o_totalprice,
        nullif(o_orderstatus, 'P') AS o_orderstatus, cast(NULL AS varchar) AS absent, 'orders' AS _source,
        '2024-01-15 00:05:00.000000' AS _extracted_at, cast(NULL AS varchar) AS _pipeline_run_id,
        '2024-01-15 00:05:00.000000' AS _loaded_at FROM orders""",
    "upsert": whole(
        EVENT_LANDING,
        "first AS (SELECT * FROM landing WHERE rate_date < '2024-01-16')",
        "second AS (SELECT * FROM landing WHERE rate_date >= '2024-01-16')",
        f"target AS (SELECT * FROM {newest('first', PAIR, '_extracted_at', LANDING_TIES)})",
        "keyed AS (SELECT * FROM second WHERE base_currency <> 'signup')",
        f"fresh AS (SELECT * FROM {newest('keyed', PAIR, '_extracted_at', LANDING_TIES)})",
        """result AS (
            SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM fresh f
                WHERE f.base_currency = t.base_currency AND f.target_currency = t.target_currency)
            UNION ALL SELECT * FROM fresh
            UNION ALL SELECT * REPLACE (NULL AS target_currency) FROM second WHERE base_currency = 'signup')""",
        f"{LANDING_SELECT} FROM result",
    ),
    "upsert_hot_key": whole(
        EVENT_LANDING,
        f"target AS (SELECT * FROM {newest('landing', PAIR, '_extracted_at', LANDING_TIES)})",
        """second AS (
            SELECT * REPLACE (CASE WHEN cast(_pipeline_run_id AS bigint) % 3 = 0 THEN 'hot' ELSE base_currency END AS base_currency,
                CASE WHEN cast(_pipeline_run_id AS bigint) % 3 = 0 THEN 'hot' ELSE target_currency END AS target_currency)
            FROM landing WHERE base_currency <> 'view')""",
        f"fresh AS (SELECT * FROM {newest('second', PAIR, '_extracted_at', LANDING_TIES)})",
        f"""SELECT {PAIR}, rate, _pipeline_run_id FROM fresh UNION ALL
            SELECT {PAIR}, '0', _pipeline_run_id FROM target t WHERE NOT EXISTS (SELECT 1 FROM fresh f
                WHERE f.base_currency = t.base_currency AND f.target_currency = t.target_currency)""",
    ),
    "upsert_newest": whole(
        EVENT_LANDING, f"{LANDING_SELECT} FROM {newest('landing', PAIR, '_extracted_at', LANDING_TIES)}"
    ),
    "landed_table": whole(
        EVENT_LANDING, f"{LANDING_SELECT} FROM {newest('landing', PAIR_DAY, '_extracted_at', LANDING_TIES)}"
    ),
    "landed_months": whole(
        RAW_RATES,
        f"""SELECT {PAIR}, {text("rate_date")}, rate || CASE WHEN rate_date >= date '2000-01-01' THEN '1' ELSE '' END AS rate
        FROM (SELECT * REPLACE (cast(rate AS varchar) AS rate) FROM {newest("raw_rates", PAIR_DAY, "extracted_at", ["cast(rate AS varchar)", "cast(unix_timestamp AS varchar)", "source_system", "pipeline_run_id"])})""",
    ),
    "run_state": whole(
        RUNS,
        f"""SELECT run_id, dag_id, source_name, status, records_extracted, records_loaded, {stamp("started_at")},
            {stamp("finished_at")}, error_message FROM runs""",
    ),
    "recent_runs": whole(
        RUNS,
        f"""SELECT source_name, status, records_loaded, {stamp("started_at")}, {stamp("finished_at")}
            FROM (SELECT * FROM runs ORDER BY started_at DESC, run_id, source_name LIMIT 10)""",
    ),
    "stage_rates": whole(RAW_RATES, f"{STAGED_SELECT} FROM raw_rates"),
    "stage_countries": whole(RAW_COUNTRIES, f"{COUNTRY_SELECT} FROM stg_countries"),
    "dedup_latest": whole(SERIES, f"{STAGED_SELECT} FROM series"),
    "dim_countries": whole(
        DIM,
        f"""{COUNTRY_SELECT}, population_tier, {number("population_density")},
            {text("has_multiple_currencies")} FROM dim""",
    ),
    "daily_change": whole(
        SERIES,
        f"""SELECT {PAIR}, {text("rate_date")}, {number("rate")}, {number("round(1.0 / nullif(rate, 0), 8)", "inverse_rate")},
            {number("prev", "previous_day_rate")}, {number(change_pct("rate", "prev"), "rate_change_pct")}
        FROM (SELECT *, lag(rate) OVER (PARTITION BY {PAIR} ORDER BY rate_date) AS prev
            FROM series WHERE rate > 1 AND rate < 400)""",
    ),
    "plausible": whole(RAW_RATES, f"{STAGED_SELECT} FROM raw_rates WHERE rate > 1000 AND rate < {HIGHEST_PRICE}"),
    "top_container": part_regions("currencies LIKE '%' || p_brand || '%'"),
    "top_container_token": part_regions("list_contains(string_split(currencies, ', '), p_brand)"),
    "fct_rates": whole(FCT, FCT_SELECT),
    "facts_after_batch": whole(DIM, RAW_RATES, LATE, fct_cte("late_rates", 1000000), FCT_SELECT),
    "segmented_series": """SELECT series, event_id, value, lag(value) OVER w AS previous,
            round(avg(value) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS mean_of_7
        FROM (SELECT *, CASE WHEN event_id % 10 < 7 THEN 'most' ELSE event_type END AS series FROM events)
        WINDOW w AS (PARTITION BY series ORDER BY ts, event_id)""",
    "stats_from_moments": whole(
        RAW_RATES,
        f"""SELECT {PAIR}, round(stddev_samp(cast(rate AS double)), 5) AS rate_stddev, round(avg(rate), 5) AS rate_avg, count(*) AS rates,
            round(stddev_samp(cast(rate AS double)) FILTER (WHERE rate_date >= {SINCE}), 5) AS rate_stddev_30d,
            round(avg(rate) FILTER (WHERE rate_date >= {SINCE}), 5) AS rate_avg_30d,
            cast(min(rate) FILTER (WHERE rate_date >= {SINCE}) AS double) AS rate_min_30d,
            cast(max(rate) FILTER (WHERE rate_date >= {SINCE}) AS double) AS rate_max_30d,
            nullif(count(*) FILTER (WHERE rate_date >= {SINCE}), 0) AS days_of_data
        FROM raw_rates GROUP BY ALL""",
    ),
    "latest_per_key": whole(
        SERIES,
        f"""{STAGED_SELECT} FROM series
            QUALIFY row_number() OVER (PARTITION BY {PAIR} ORDER BY series.rate_date DESC NULLS FIRST) = 1""",
    ),
    "trailing_stats": whole(
        EVENT_STATS,
        f"""SELECT {PAIR}, round(sd, 6) AS rate_stddev_30d, round(mean, 8) AS rate_avg_30d,
            {number("low", "rate_min_30d")}, {number("high", "rate_max_30d")}, days_of_data FROM stats""",
    ),
    "volatility_tier": whole(
        EVENT_STATS,
        f"""SELECT {PAIR}, days_of_data, CASE WHEN sd / nullif(mean * 10, 0) < 0.01 THEN 'low'
            WHEN sd / nullif(mean * 10, 0) < 0.05 THEN 'medium' ELSE 'high' END AS volatility_tier FROM stats""",
    ),
    "currency_summary": whole(SUMMARY, SUMMARY_SELECT),
    "regional_daily": whole(
        REGIONAL,
        f"""SELECT {text("rate_date")}, {PAIR}, region, primary_country_name, round(avg_rate, 6) AS avg_rate,
            {number("min_rate")}, {number("max_rate")}, round(avg_rate_change_pct, 6) AS avg_rate_change_pct,
            country_count FROM regional""",
    ),
    "moving_avg": whole(
        SERIES,
        f"""SELECT {PAIR}, {text("rate_date")}, {number("rate")}, round(avg(rate) OVER (PARTITION BY {PAIR}
            ORDER BY series.rate_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rate_7d_moving_avg FROM series""",
    ),
    "rates_by_region": whole(
        BY_REGION,
        f"""SELECT {text("rate_date")}, {PAIR}, region, primary_country_name, {number("avg_rate")}, {number("min_rate")},
            {number("max_rate")}, {number("avg_rate_change_pct")}, country_count, rate_7d_moving_avg FROM by_region""",
    ),
    "country_currency_map": whole(
        COUNTRY_MAP,
        f"""SELECT cca2, cca3, name_common, region, subregion, capital, {long("population")}, population_tier,
            {number("population_density")}, {number("area_km2")}, currencies, {text("is_un_member")}, flag_emoji,
            primary_currency, {number("latest_rate")}, {text("latest_rate_date")}, {number("day_change_pct")},
            volatility_tier FROM country_map""",
    ),
    "not_null": whole(
        FCT, f"SELECT {PAIR}, {text('rate_date')}, {number('rate')} FROM fct WHERE previous_day_rate IS NULL"
    ),
    "unique": """SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, count(*) AS n FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""",
    "unique_after_batch": """SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, count(*) AS n FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""",
    "accepted_values": """SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus <> 'P'
        AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1""",
    "run_checks": whole(
        BY_REGION, COUNTRY_MAP.removeprefix(FCT).lstrip(",\n"), "results AS (" + " UNION ALL ".join(ALL_CHECKS) + ")",
        """SELECT model, "column", "check", failures, cast(failures = 0 AS varchar) AS passed FROM results""",
    ),
    "kpis": whole(
        BY_REGION,
        COUNTRY_MAP.removeprefix(FCT).lstrip(",\n"),
        MAP_OF_A,
        RUNS,
        "results AS (" + " UNION ALL ".join(GOLD_CHECKS) + ")",
        " UNION ALL ".join([
            figure("currencies_tracked", "SELECT count(DISTINCT target_currency) FROM summary"),
            figure("countries_mapped", "SELECT count(*) FROM dim"),
            figure("avg_inverse_rate", f"""SELECT round(avg(inverse_rate), 4) FROM fct
                WHERE target_currency = 'Brand#7' AND rate_date >= date '{AS_OF}' - interval 10 days"""),
            figure("latest_change_pct", f"""SELECT round(rate_change_pct, 2) FROM fct WHERE target_currency = 'Brand#7'
                AND rate_date >= date '{AS_OF}' - interval 10 days ORDER BY rate_date DESC, rate_change_pct DESC NULLS LAST LIMIT 1"""),
            figure("runs", f"SELECT count(*) FROM runs WHERE started_at >= date '{EVENTS_AS_OF}' - interval 10 days"),
            figure("run_success_pct", f"""SELECT round(count(*) FILTER (WHERE status = 'success') * 100 / count(*), 2)
                FROM runs WHERE started_at >= date '{EVENTS_AS_OF}' - interval 10 days"""),
            figure("landed_rows", "(SELECT count(*) FROM raw_rates) + (SELECT count(*) FROM raw_countries)"),
            figure("checks_passed", "SELECT count(*) FROM results WHERE failures = 0"),
            figure("checks_total", "SELECT count(*) FROM results"),
        ]),
    ),
    "trend": whole(
        BY_REGION,
        f"""SELECT {text("rate_date")}, max(rate_7d_moving_avg) FILTER (WHERE target_currency = 'Brand#1') AS b1,
            max(rate_7d_moving_avg) FILTER (WHERE target_currency = 'Brand#2') AS b2,
            round(max(rate_7d_moving_avg) FILTER (WHERE target_currency = 'Brand#25') / 100, 6) AS b25
        FROM by_region WHERE base_currency = 'A' AND target_currency IN ('Brand#1', 'Brand#2', 'Brand#25')
            AND by_region.rate_date > {SINCE} AND by_region.rate_date <= date '{AS_OF}' GROUP BY by_region.rate_date""",
    ),
    "currencies_by_region": whole(
        DIM,
        """SELECT region, count(DISTINCT code) AS currency_count, count(DISTINCT cca2) AS country_count
        FROM dim LEFT JOIN (SELECT cca2, unnest(string_split(currencies, ', ')) AS code FROM dim) USING (cca2)
        GROUP BY region""",
    ),
    "volatility_distribution": whole(
        SUMMARY,
        """SELECT t.tier AS volatility_tier, count(s.volatility_tier) AS currencies
        FROM (VALUES ('low'), ('medium'), ('high')) t(tier) LEFT JOIN summary s ON s.volatility_tier = t.tier GROUP BY 1""",
    ),
    "rates_table": whole(
        SUMMARY,
        f"""SELECT {PAIR}, primary_country_name, {number("round(latest_rate, 4)", "rate")},
            {number("round(inverse_rate, 4)", "inverse")},
            CASE WHEN day_over_day_change_pct >= 0 THEN 'up' WHEN day_over_day_change_pct < 0 THEN 'down' END AS direction,
            {number("round(abs(day_over_day_change_pct), 2)", "change_pct")}, round(rate_avg_30d, 4) AS avg_30d,
            volatility_tier, region
        FROM summary WHERE lower(target_currency) LIKE '%brand#2%' OR lower(primary_country_name) LIKE '%brand#2%'
            OR lower(region) LIKE '%brand#2%'""",
    ),
    "daily_run": whole(DAILY, SUMMARY_SELECT + " WHERE base_currency = 'A'"),
    "daily_tables": whole(
        DAILY,
        f"bronze AS (SELECT * FROM {newest('day_rates', PAIR_DAY, 'extracted_at', ['digits'])})",
        REGIONAL_CTE,
        MAP_OF_A,
        " UNION ALL ".join([
            stored("bronze", "bronze", "86400"),
            stored("bronze rates", "bronze", "rate"),
            stored("facts", "fct", "rate"),
            stored("facts with region", "fct WHERE currency_region IS NOT NULL", "rate_change_pct"),
            stored("countries", "dim", "population"),
            stored("regions", "regional WHERE base_currency = 'A'", "country_count"),
            stored("map", "country_map_of_a", "CASE WHEN latest_rate IS NOT NULL THEN 1 ELSE 0 END"),
            stored("checks", "range(12)", "0"),
        ]),
    ),
}
