"""Column layouts of every layer. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

LINEAGE = ["_source", "_extracted_at", "_pipeline_run_id"]

RATE_FIELDS = ["base_currency", "target_currency", "rate", "rate_date", "timestamp"]

COUNTRY_FIELDS = [
    "cca2", "cca3", "name_common", "name_official", "region", "subregion", "capital",
    "population", "area_km2", "currencies", "languages", "timezones", "is_un_member", "flag_emoji",
]


def landing_schema(fields: list[str]) -> T.StructType:
    """Landed tables hold text, apart from the two typed lineage times."""
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in fields]
        + [
            T.StructField("_source", T.StringType()),
            T.StructField("_extracted_at", T.TimestampType()),
            T.StructField("_pipeline_run_id", T.StringType()),
            T.StructField("_loaded_at", T.TimestampType()),
        ]
    )


RAW_RATES = landing_schema(RATE_FIELDS)
RAW_COUNTRIES = landing_schema(COUNTRY_FIELDS)

def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _COUNT, _TIME = T.StringType(), T.LongType(), T.TimestampType()

# Rates are read as the text they have in the payload: no digit is lost, and no value is too large to land.
RATES_PAYLOAD = _struct(base=_TEXT, timestamp=_COUNT, rates=T.MapType(_TEXT, _TEXT))
WRITTEN_RATES_PAYLOAD = _struct(base=_TEXT, timestamp=_TEXT, rates=T.MapType(_TEXT, _TEXT))

COUNTRY_PAYLOAD = _struct(
    cca2=_TEXT,
    cca3=_TEXT,
    name=_struct(common=_TEXT, official=_TEXT),
    region=_TEXT,
    subregion=_TEXT,
    capital=T.ArrayType(_TEXT),
    population=_COUNT,
    area=T.DoubleType(),
    currencies=T.MapType(_TEXT, _struct(name=_TEXT, symbol=_TEXT)),
    languages=T.MapType(_TEXT, _TEXT),
    timezones=T.ArrayType(_TEXT),
    unMember=T.BooleanType(),
    flag=_TEXT,
)

RUN_EVENTS = _struct(
    run_id=_TEXT,
    dag_id=_TEXT,
    source_name=_TEXT,
    status=_TEXT,
    records_extracted=_COUNT,
    records_loaded=_COUNT,
    started_at=_TIME,
    finished_at=_TIME,
    error_message=_TEXT,
)
