from datetime import datetime, timezone

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from ratestrata import schemas
from ratestrata.functions import text
from ratestrata.operators import cleaning
from ratestrata.sources.base import ExtractionError, Source, with_lineage
from ratestrata.sources.csv import CsvSource, read_csv, sniff_delimiter
from ratestrata.sources.payloads import (
    CountriesSource, RatesSource, broken_payloads, flatten_countries, flatten_rates, parse_payloads,
)

NOW = datetime(2024, 1, 15, 0, 5, tzinfo=timezone.utc)
LAKES_CSV = "Lake Name,Depth (m),Max-Width\nInari,92,50\nTiticaca,281,80\n"


def write(tmp_path, content, name="test.csv", encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(content.encode(encoding))
    return str(path)


# ---- CSV --------------------------------------------------------------------------


def test_headers_are_normalised_and_cells_are_text(spark, tmp_path):
    rows = CsvSource("c", write(tmp_path, LAKES_CSV)).read(spark)
    assert rows.columns == ["lake_name", "depth_m", "max_width"]
    assert {kind for _, kind in rows.dtypes} == {"string"}
    assert tuples(rows) == [("Inari", "92", "50"), ("Titicaca", "281", "80")]


def test_column_mapping(spark, tmp_path):
    rows = CsvSource("c", write(tmp_path, LAKES_CSV), column_mapping={"Lake Name": "lake"}).read(spark)
    assert rows.columns == ["lake", "depth_m", "max_width"]


def test_missing_file_is_named(spark):
    with pytest.raises(ExtractionError, match="not found"):
        CsvSource("c", "/nonexistent/data.csv").extract(spark, None, NOW)


def test_empty_row_is_dropped(spark, tmp_path):
    assert tuples(CsvSource("c", write(tmp_path, "Key,Amount\nred,7\n,\nblue,8\n")).read(spark)) == [
        ("blue", "8"), ("red", "7"),
    ]


def test_delimiter_is_found(spark, tmp_path):
    rows = CsvSource("c", write(tmp_path, "Day;Low;High\nMon;-3;4\nTue;0;9\n")).read(spark)
    assert rows.columns == ["day", "low", "high"]
    assert tuples(rows)[0] == ("Mon", "-3", "4")


@pytest.mark.parametrize("sample,found", [("a,b\n1,2\n", ","), ("a\tb\n1\t2\n", "\t"), ("a|b\n1|2\n", "|"), ("a\n1\n", ",")])
def test_sniffing(sample, found):
    assert sniff_delimiter(sample) == found


def test_each_file_is_read_in_its_own_encoding(spark, tmp_path):
    write(tmp_path, "name,v\nMünchen,1\n", "a.csv", "latin-1")
    write(tmp_path, "name,v\nKöln �,2\n", "b.csv")
    assert tuples(read_csv(spark, str(tmp_path))) == [("Köln �", "2"), ("München", "1")]


def test_quoted_line_breaks_delimiters_and_quotes(spark, tmp_path):
    path = write(tmp_path, 'n,v\n"x\ny",1\n"a ""b"", c",2\n')
    assert tuples(read_csv(spark, path)) == [('a "b", c', "2"), ("x\ny", "1")]


def test_short_lines_are_filled_and_long_lines_fail(spark, tmp_path):
    assert tuples(read_csv(spark, write(tmp_path, "a,b\n1\n2,3\n"), delimiter=",")) == [("1", None), ("2", "3")]
    with pytest.raises(Exception, match="too many cells: 1,2,"):
        read_csv(spark, write(tmp_path, "a,b\n1,2,\n3,4\n", "long.csv"), delimiter=",").collect()


def test_unlike_headers_fail(spark, tmp_path):
    write(tmp_path, "a,b\n1,2\n", "a.csv")
    write(tmp_path, "b,a\n1,2\n", "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_counts_read_what_they_need(spark, tmp_path):
    rows = read_csv(spark, write(tmp_path, "a,b\n1,2\n3\n"), delimiter=",")
    assert rows.count() == 2 and not rows.isEmpty() and tuples(rows.select("b")) == [("2",), (None,)]
    long = read_csv(spark, write(tmp_path, "a,b\n1,2\n3,4,5\n", "long.csv"), delimiter=",")
    for job in (long.count, long.select("b").collect):
        with pytest.raises(Exception, match="too many cells"):
            job()


def test_an_empty_file_is_an_error(spark, tmp_path):
    with pytest.raises(ExtractionError, match="empty"):
        CsvSource("c", write(tmp_path, "")).extract(spark, None, NOW)


def test_names_with_glob_characters_in_a_folder(spark, tmp_path):
    write(tmp_path, "a,b\n1,2\n", "a[1].csv")
    write(tmp_path, "a,b\n3,4\n", "{b}*.csv")
    assert tuples(read_csv(spark, str(tmp_path))) == [("1", "2"), ("3", "4")]


def test_the_sample_holds_all_its_characters(spark, tmp_path):
    content = "k;v\n" + "1;2\n" * 1000
    assert read_csv(spark, write(tmp_path, content)).columns == ["k", "v"]
    blank = "key\n" + "\n" * 300 + "a;b\n" * 20
    assert read_csv(spark, write(tmp_path, blank, "blank.csv")).count() >= 20


def test_line_breaks_can_be_named(spark, tmp_path):
    path = write(tmp_path, 'n,v\n"x\ny",1\n')
    assert tuples(CsvSource("c", path, encoding="UTF-8", multiline=True).read(spark)) == [("x\ny", "1")]


def test_headers_of_latin_files(spark, tmp_path):
    write(tmp_path, "größe,v\nMünchen,1\n", "a.csv", "latin-1")
    assert tuples(read_csv(spark, str(tmp_path))) == [("München", "1")]


# ---- cleaning ---------------------------------------------------------------------


def test_names():
    assert text.normal_name("  Country-Name (EN).x ") == "country_name_en_x"


def test_names_that_collide(frame):
    with pytest.raises(ValueError, match="a_b"):
        cleaning.normalize_columns(frame("`A b` int, `a-b` int", (1, 2)))


def test_blank_rows_survive_as_empty_text(frame):
    rows = frame("a string, b string", (None, None), (" \t", None), ("　x\x1f", "y "))
    cleaned = cleaning.trim_strings(cleaning.drop_empty_rows(rows))
    assert tuples(cleaned) == [("", None), ("x", "y")]


def test_missing_tokens(frame):
    rows = frame("a string", *[(token,) for token in (*text.MISSING_TOKENS, "N/A ", "na", "0")])
    assert tuples(cleaning.null_tokens(rows).dropna()) == [("0",), ("N/A ",), ("na",)]


def test_a_column_with_one_bad_cell_stays_text(frame, caplog):
    rows = frame("a string, b string, c string", ("1", "x", "1.5"), (None, "2", "1e3"))
    cast = cleaning.cast_columns(rows, {"a": "int64", "b": "int64", "c": "float64", "no": "int64"})
    assert cast.dtypes == [("a", "bigint"), ("b", "string"), ("c", "double")]
    assert tuples(cast) == [(1, "x", 1.5), (None, "2", 1000.0)]
    assert "column b stays text: 1 cells" in caplog.text


def test_rules(frame):
    good, bad = cleaning.validate(frame("rate string", ("0",), ("-1.5",), ("1.23",), (None,), ("abc",), ("",), ("NaN",), ("1e-12",)), cleaning.rate_rule())
    assert tuples(good) == [("1.23",), ("1e-12",)] and bad.count() == 6
    codes = frame("cca2 string, cca3 string", ("", ""), ("DE", None), (None, "FRA"), (None, None))
    good, bad = cleaning.validate(codes, cleaning.country_rule())
    assert good.count() == 2 and bad.count() == 2
    cells = frame("a string, b int", (" ", None), (None, 1), ("x", None))
    good, bad = cleaning.validate(cells, cleaning.any_value_rule(cells))
    assert good.count() == 2 and bad.count() == 1
    good, bad = cleaning.validate(cells)
    assert good.count() == 3 and bad.count() == 0


# ---- lineage ----------------------------------------------------------------------


class Numbers(Source):
    def read(self, spark):
        return spark.range(100).withColumnRenamed("id", "n")


class Failing(Source):
    def read(self, spark):
        raise RuntimeError("simulated")


def test_lineage(spark):
    rows = Numbers("numbers").extract(spark, "run_001", NOW)
    assert rows.columns == ["n", "_source", "_extracted_at", "_pipeline_run_id"]
    assert rows.count() == 100
    stamps = rows.select("_source", "_extracted_at", "_pipeline_run_id").distinct()
    assert stamps.select("_source", F.unix_timestamp("_extracted_at"), "_pipeline_run_id").collect() == [
        ("numbers", int(NOW.timestamp()), "run_001")
    ]


def test_lineage_without_run(spark):
    assert with_lineage(spark.range(1), "s", None, NOW).first()["_pipeline_run_id"] is None


def test_failure_names_the_source(spark):
    with pytest.raises(ExtractionError, match="'broken': simulated"):
        Failing("broken").extract(spark, None, NOW)
    assert repr(Failing("broken")) == "Failing(name='broken')"


# ---- payloads ---------------------------------------------------------------------

RATES = '{"note": "n", "timestamp": 1650000000, "base": "CHF", "rates": {"NOK": 9.4, "CLP": 0.0000148884412345, "VND": 12345678901234.5}}'
COUNTRY = """[{"cca2": "BO", "cca3": "BOL", "name": {"common": "Bolivia", "official": "Estado Plurinacional de Bolivia"},
 "region": "Americas", "subregion": "Andes", "capital": ["Sucre", "La Paz"], "population": 12000003,
 "area": 1098581.5, "currencies": {"USD": {"name": "x", "symbol": "y"}, "BOB": {"name": "Boliviano", "symbol": "Bs"}},
 "languages": {"spa": "Spanish", "aym": "Aymara"}, "timezones": ["UTC-04:00", "UTC-05:00"], "unMember": true, "flag": "🇧🇴"},
 {"cca2": "YY", "area": 0, "subregion": "", "capital": [], "currencies": {}}]"""


def test_one_row_per_rate(spark, tmp_path):
    rows = RatesSource(path=write(tmp_path, RATES, "r.json")).read(spark)
    assert rows.columns == schemas.RATE_FIELDS
    # digits as in the payload, however small or large
    assert tuples(rows) == [
        ("CHF", "CLP", "0.0000148884412345", "2022-04-15", 1650000000),
        ("CHF", "NOK", "9.4", "2022-04-15", 1650000000),
        ("CHF", "VND", "12345678901234.5", "2022-04-15", 1650000000),
    ]


def test_rate_day_is_utc_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tashkent")
    try:
        bodies = spark.createDataFrame([('{"base":"USD","timestamp":1705276799,"rates":{"A":1}}',),
                                        ('{"base":"USD","timestamp":-1,"rates":{"A":1}}',)], "body string")
        days = flatten_rates(parse_payloads(bodies, "body")).select("rate_date")
        assert tuples(days) == [("1969-12-31",), ("2024-01-14",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_missing_field(spark, frame, tmp_path):
    with pytest.raises(Exception, match="missing field 'rates'"):
        RatesSource(path=write(tmp_path, '{"base": "USD", "timestamp": 1}', "r.json")).extract(spark, None, NOW).collect()
    with pytest.raises(Exception, match="missing field 'base'"):
        RatesSource(path=write(tmp_path, '{"timestamp": 1, "rates": {"A": 1}}', "r.json")).read(spark).count()
    payloads = parse_payloads(frame("body string", ("no json",), (RATES,)), "body")
    assert [row.missing_fields for row in broken_payloads(payloads).collect()] == ["base, rates, timestamp"]
    assert flatten_rates(payloads).count() == 3


def test_countries_are_flattened(spark, tmp_path):
    rows = CountriesSource(path=write(tmp_path, COUNTRY, "c.json")).read(spark)
    assert rows.columns == schemas.COUNTRY_FIELDS
    assert tuples(rows) == [
        ("BO", "BOL", "Bolivia", "Estado Plurinacional de Bolivia", "Americas", "Andes", "Sucre", 12000003,
         1098581.5, "BOB, USD", "Aymara, Spanish", "UTC-04:00, UTC-05:00", True, "🇧🇴"),
        ("YY", "", "", "", "", None, None, 0, None, None, None, "", False, ""),
    ]


def test_join_sorted_of_nothing(frame):
    empty = frame("m map<string,string>, a array<string>", ({}, []), (None, None))
    joined = empty.select(
        text.join_sorted(F.col("m"), "keys"), text.join_sorted(F.col("m"), "values"), text.join_sorted(F.col("a"), "array")
    )
    assert tuples(joined) == [(None, None, ""), (None, None, "")]


def test_flat_country_of_json_null(frame):
    parsed = parse_payloads(frame("b string", ('{"cca2": null, "population": null}',)), "b", schemas.COUNTRY_PAYLOAD)
    row = flatten_countries(parsed).first()
    assert (row.cca2, row.population, row.is_un_member) == ("", 0, False)


@pytest.mark.parametrize("written, day", [
    ("1687219200.0", "2023-06-20"), ("1687219199.999", "2023-06-19"), ("1.6872192e9", "2023-06-20"), ("-0.5", "1969-12-31"), ("1687219200", "2023-06-20"),
])
def test_timestamps_are_any_numbers(frame, written, day):
    body = f'{{"base": "USD", "timestamp": {written}, "rates": {{"NOK": 1.50}}}}'
    rows = flatten_rates(parse_payloads(frame("body string", (body,)), "body"))
    assert tuples(rows.select("rate_date", "rate")) == [(day, "1.50")]


def test_a_timestamp_that_is_none_is_named(spark, tmp_path, frame):
    body = '{"base": "USD", "timestamp": "soon", "rates": {"NOK": 1}}'
    with pytest.raises(Exception, match="bad value of field 'timestamp': soon"):
        RatesSource(path=write(tmp_path, body, "r.json")).read(spark).collect()
    assert broken_payloads(parse_payloads(frame("body string", (body,)), "body")).first().missing_fields == "timestamp"


def test_numbers_inside_texts_stay_texts(frame):
    """Texts that look like fields, escaped quotes and keys, numbers without blanks, and long payloads."""
    odd = r'{"rates":{"{":2,"a\":1,\"b":0.10,":5":1.5,"c\\":-3e-2,"A":7},"note":"{\"x\":1, 2","timestamp":86400,"base":"U-1"}'
    rows = flatten_rates(parse_payloads(frame("body string", (odd,)), "body"))
    assert tuples(rows.select("base_currency", "target_currency", "rate")) == sorted(
        ("U-1", key, rate) for key, rate in {"{": "2", 'a":1,"b': "0.10", ":5": "1.5", "c\\": "-3e-2", "A": "7"}.items()
    )
    many = ",".join(f'"T{i}":{i}.{i:05d}' for i in range(20_000))
    words = ",".join(f'"w{i}"' for i in range(20_000))
    body = f'{{"note":"{"x" * 100_000}","words":[{words}],"base":"B","timestamp":0,"rates":{{{many}}}}}'
    rows = flatten_rates(parse_payloads(frame("body string", (body,)), "body"))
    assert rows.count() == 20_000 and rows.filter("target_currency = 'T123'").first().rate == "123.00123"


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
def test_records_of_quoted_breaks_are_read_in_splits(spark, tmp_path, split):
    """Against Python's reader, in splits that end anywhere, with files of two encodings and one without breaks."""
    import csv
    import random

    rng = random.Random(split)
    cells = ["x", "", 'q"q', "a,b", "line\nbreak", "\n\n", '"', "\n\"\n,", "é", "word " * 9, " \n "]
    wanted = []
    for name, encoding, breaks in (("a", "utf-8", True), ("b", "latin-1", True), ("c", "utf-8", False)):
        with open(tmp_path / f"{name}.csv", "w", encoding=encoding, newline="") as file:
            writer = csv.writer(file, lineterminator="\n")
            writer.writerow(["k", "größe", "v"])
            for i in range(120):
                row = [f"{name}{i}", *(c if breaks or "\n" not in c else "-" for c in rng.choices(cells, k=2))]
                writer.writerow(row)
                wanted.append(tuple(c or None for c in row))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        rows = read_csv(spark, str(tmp_path), delimiter=",")
        assert rows.columns == ["k", "größe", "v"] and tuples(rows) == sorted(wanted, key=str)
        # the lines of a file are read by more than one task
        assert split > 1000 or spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 3
    finally:
        for name, value in zip(("maxPartitionBytes", "openCostInBytes"), before):
            spark.conf.set(f"spark.sql.files.{name}", value)


def test_a_quote_that_is_never_closed_is_an_error(spark, tmp_path):
    with pytest.raises(ExtractionError, match="never closed"):
        read_csv(spark, write(tmp_path, 'a,b\n"1,2\n3,4\n'))


def test_headers_with_breaks_must_be_alike(spark, tmp_path):
    write(tmp_path, '"a\nx",b\n1,2\n', "a.csv")
    write(tmp_path, '"a\nx",b\n"3\n",4\n\n', "b.csv")
    assert tuples(read_csv(spark, str(tmp_path))) == [("1", "2"), ("3\n", "4")]
    write(tmp_path, 'b,a\n"1\n",2\n', "c.csv")
    with pytest.raises(Exception, match="other headers"):
        read_csv(spark, str(tmp_path)).collect()


def test_long_records_with_breaks_fail(spark, tmp_path):
    with pytest.raises(Exception, match="too many cells"):
        read_csv(spark, write(tmp_path, 'a,b\n"1\n",2,3\n4,5\n')).collect()
