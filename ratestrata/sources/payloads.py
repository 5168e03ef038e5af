"""JSON payloads of the two sources, flattened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ratestrata import schemas
from ratestrata.functions.text import empty_to_null, epoch_day, join_sorted
from ratestrata.operators.cleaning import country_rule, rate_rule
from ratestrata.sources.base import Source

REQUIRED = ["base", "rates", "timestamp"]


# A number outside of texts, behind whatever stands before it: texts, which are skipped whole whatever they hold, and other signs. JSON
# readers turn a number into a double, which loses digits, so it is quoted before. A match starts
# where the one before ended, so never inside a text, and nothing is tried twice.
TEXT = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
NUMBER = rf'\G((?:{TEXT}|[^"0-9-]++)*+)(-?[0-9][0-9.eE+-]*+)'


def _parsed_rates(body: Column, mode: str) -> Column:
    """Payloads of one JSON document, an object or an array of them, numbers as the text they are written in."""
    quoted = F.regexp_replace(body, NUMBER, '$1"$2"')
    return F.from_json(quoted, T.ArrayType(schemas.WRITTEN_RATES_PAYLOAD), {"mode": mode})


def _typed_rates(payloads: DataFrame) -> DataFrame:
    """Whole seconds of the timestamp, which may be written with a fraction or an exponent; `written_timestamp` is its text."""
    written = F.col("payload.timestamp")
    seconds = F.floor(written.try_cast("decimal(38,9)")).try_cast("bigint")
    return payloads.select("payload.base", seconds.alias("timestamp"), "payload.rates", written.alias("written_timestamp"))


def parse_payloads(df: DataFrame, col: str, schema=schemas.RATES_PAYLOAD) -> DataFrame:
    """Payloads from a text column; text that is no such JSON gives a row of NULLs."""
    if schema == schemas.RATES_PAYLOAD:
        return _typed_rates(df.select(F.explode_outer(_parsed_rates(F.col(col), "PERMISSIVE")).alias("payload")))
    return df.select(F.from_json(F.col(col), schema).alias("payload")).select("payload.*")


def broken_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads without one of the required fields, with the names of those they lack."""
    lacking = F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in REQUIRED]))
    return payloads.withColumn("missing_fields", F.array_join(lacking, ", ")).filter(
        F.col("missing_fields") != ""
    )


def require_complete(payloads: DataFrame) -> DataFrame:
    """The payloads; the job that unfolds one without a required field, or with a timestamp that is none, fails and names the field.

    The check is part of the `rates` expression, so the files are not scanned a second time
    for it, and no filter can drop the payload before it.
    """
    rates = F.col("rates")
    for name in reversed(REQUIRED):
        reason = F.lit(f"unexpected payload: missing field '{name}'")
        if name == "timestamp" and "written_timestamp" in payloads.columns:
            bad = F.concat(F.lit("unexpected payload: bad value of field 'timestamp': "), "written_timestamp")
            reason = F.coalesce(bad, reason)
        failure = F.raise_error(reason)
        rates = F.when(F.col(name).isNull(), failure.cast(schemas.RATES_PAYLOAD["rates"].dataType)).otherwise(rates)
    return payloads.withColumn("rates", rates)


def _unfold(payloads: DataFrame) -> DataFrame:
    return payloads.select(
        F.col("base").alias("base_currency"),
        F.explode("rates").alias("target_currency", "rate"),
        F.date_format(epoch_day(F.col("timestamp")), "yyyy-MM-dd").alias("rate_date"),
        "timestamp",
    )


def flatten_rates(payloads: DataFrame) -> DataFrame:
    """One row per payload and currency; payloads that lack a field give none."""
    return _unfold(payloads.na.drop("any", subset=REQUIRED))


def flatten_countries(payloads: DataFrame) -> DataFrame:
    """One flat row per country object. JSON null is treated like an absent field."""

    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(""))

    return payloads.select(
        text("cca2").alias("cca2"),
        text("cca3").alias("cca3"),
        text("name.common").alias("name_common"),
        text("name.official").alias("name_official"),
        text("region").alias("region"),
        empty_to_null(F.col("subregion")).alias("subregion"),
        F.get("capital", F.lit(0)).alias("capital"),
        F.coalesce("population", F.lit(0)).cast("bigint").alias("population"),
        F.nullif(F.col("area"), F.lit(0.0)).alias("area_km2"),
        join_sorted(F.col("currencies"), "keys").alias("currencies"),
        join_sorted(F.col("languages"), "values").alias("languages"),
        join_sorted(F.col("timezones"), "array").alias("timezones"),
        F.coalesce("unMember", F.lit(False)).alias("is_un_member"),
        text("flag").alias("flag_emoji"),
    )


class _JsonSource(Source):
    """JSON files: whole documents (`multiline`), or one object per line, which Spark can split."""

    schema = None

    def __init__(self, name: str, path: str, multiline: bool = True) -> None:
        super().__init__(name)
        self.path = str(path)
        self.multiline = multiline

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).json(self.path, multiLine=self.multiline, mode="FAILFAST")


class RatesSource(_JsonSource):
    """Daily rate payloads. A payload without a required field fails the extraction."""

    schema = schemas.RATES_PAYLOAD

    def __init__(self, name: str = "rates_api", path: str = "", multiline: bool = True) -> None:
        super().__init__(name, path, multiline)

    def payloads(self, spark: SparkSession) -> DataFrame:
        bodies = spark.read.text(self.path, wholetext=self.multiline).filter("trim(value) != ''")
        return _typed_rates(bodies.select(F.explode(_parsed_rates(F.col("value"), "FAILFAST")).alias("payload")))

    def read(self, spark: SparkSession) -> DataFrame:
        return _unfold(require_complete(self.payloads(spark)))

    def rule(self, df: DataFrame) -> Column:
        return rate_rule()


class CountriesSource(_JsonSource):
    schema = schemas.COUNTRY_PAYLOAD

    def __init__(self, name: str = "countries_api", path: str = "", multiline: bool = True) -> None:
        super().__init__(name, path, multiline)

    def read(self, spark: SparkSession) -> DataFrame:
        return flatten_countries(self.payloads(spark))

    def rule(self, df: DataFrame) -> Column:
        return country_rule()
