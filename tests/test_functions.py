import pytest
from pyspark.sql import functions as F

from tidegate.functions import identity, lines, places, text, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, valid",
    [("abc", True), ("", True), (None, True), ("a b", False), ("a\tb", False), ("a\n", False), ("a\u2003b", False), ("a\u00a0b", True)],
)
def test_whitespace_check(spark, value, valid):
    assert one(spark, text.has_no_whitespace(F.lit(value).cast("string"))) is valid


def test_every_special_character_is_replaced(spark):
    assert one(spark, text.sanitize(F.lit("a" + text.SPECIAL_CHARACTERS + "b"))) == "a" + "_" * 21 + "b"
    assert one(spark, text.sanitize(F.lit("a,b=c/d\"e\tf"))) == "a,b=c/d\"e\tf"


@pytest.mark.parametrize(
    "account, tenant",
    [("acct:1", "CORE-acct:1"), ("acct :1", "CORE-acct__1"), ("a\tb.c", "CORE-a\tb_c"), ("", "CORE-")],
)
def test_tenant_is_cleaned_only_when_spaced(spark, account, tenant):
    assert one(spark, identity.tenant_id(F.lit("CORE"), F.lit(account))) == tenant


def test_trim_takes_control_characters(spark):
    assert one(spark, text.trim_controls(F.lit("\x00\t a b \x1f\n"))) == "a b "
    assert one(spark, text.wrap(F.lit(None).cast("string"))) == '"null"'


@pytest.mark.parametrize(
    "instant, seconds",
    [
        ("1970-01-01T00:00:00Z", 0),
        ("1969-12-31T23:59:59.5Z", -1),
        ("2019-05-13T19:54:27.999999999Z", 1557777267),
        ("2019-05-13t19:54:27z", 1557777267),
        ("2019-05-13T19:54:27+02:00", None),
        ("2019-05-13T19:54Z", None),
        ("2019-05-13 19:54:27Z", None),
        ("2019-02-30T00:00:00Z", None),
        ("2019-05-13", None),
        ("junk", None),
        (None, None),
    ],
)
def test_event_time(spark, instant, seconds):
    assert one(spark, times.event_time_seconds(F.lit(instant).cast("string"))) == seconds


@pytest.mark.parametrize(
    "duration, seconds", [("5d", 432000), ("1440h", 5184000), ("2w", 1209600), ("30m", 1800), ("7s", 7), ("x", None), ("5", None), (None, None)]
)
def test_retention(spark, duration, seconds):
    assert one(spark, times.retention_seconds(F.lit(duration).cast("string"))) == seconds


@pytest.mark.parametrize(
    "number, shown",
    [(1.0, "1.0"), (1e20, "100000000000000000000.0"), (1e-5, "0.00001"), (0.1 + 0.2, "0.30000000000000004"), (12345678.0, "12345678.0"), (-2.5, "-2.5")],
)
def test_number_text_has_no_exponent(spark, number, shown):
    assert one(spark, lines.decimal_text(F.lit(number))) == shown


@pytest.mark.parametrize(
    "path, host",
    [
        ("https://influx-test.com:8080", "influx-test.com"),
        ("http://test_x.com:8086/a?b", "test_x.com"),
        ("http://user:pw@h.com/", "h.com"),
        ("http://[::1]:80/", "[::1]"),
        ("http://:8086", ""),
    ],
)
def test_host(spark, path, host):
    assert one(spark, places.instance_host(F.lit(path))) == host


def test_backup_location(spark):
    seconds = places.payload_timestamp(F.lit("testPayload 1557777267"))
    where = places.backup_location(F.lit("https://influx-test.com:8080"), F.lit("myDB"), F.lit("1440h"), seconds)
    assert one(spark, where) == "influx-test.com/myDB/1440h/20190513"
    spaced = places.backup_location(F.lit("http://test_x.com"), F.lit("a/b"), F.lit("a b"), F.lit(0).cast("bigint"))
    assert one(spark, spaced) == "test_x.com/a%2Fb/a+b/19700101"


def test_payload_timestamp_is_the_last_one(spark):
    assert one(spark, places.payload_timestamp(F.lit("m f=1 5\nm f=2 7"))) == 7
    assert one(spark, places.payload_timestamp(F.lit("m f=1"))) is None
    assert one(spark, places.payload_timestamp(F.lit("m f=1 99999999999999999999"))) is None


def test_day_of_a_time_out_of_range_is_null(spark):
    assert one(spark, times.utc_day(F.lit(2**62))) is None


def test_line_round_trip_with_every_odd_character(spark):
    tags = {"a b": 'x,y=z"', "c=d": "p\\q", "\x01b": "\x01\x02\x01a", "plain": "v"}
    fields = {"f,1": 1.5, "g": -0.0, "zi": 2.0}
    rows = spark.createDataFrame(
        [("m e=a,s", tags, fields, {"start": 5}, 7), ("m", {}, {"f": 1.0}, {}, None)],
        "measurement STRING, tags MAP<STRING,STRING>, fields MAP<STRING,DOUBLE>, int_fields MAP<STRING,BIGINT>, ts_s BIGINT",
    )
    c = F.col
    line = lines.encode_line(c("measurement"), c("tags"), c("fields"), c("ts_s"), c("int_fields"))
    coded = rows.select(line.alias("line"))
    assert coded.collect()[1]["line"] == "m f=1.0"
    assert r"m\ e\=a\,s,\x01b".replace(r"\x01", "\x01") in coded.first()["line"]
    back = lines.parse_lines(coded).collect()
    assert (back[0]["measurement"], back[0]["tags"], back[0]["fields"], back[0]["int_fields"], back[0]["ts_s"]) == (
        "m e=a,s", tags, fields, {"start": 5}, 7,
    )
    assert (back[1]["tags"], back[1]["fields"], back[1]["ts_s"]) == ({}, {"f": 1.0}, None)


def test_keys_are_ordered_by_key_not_by_pair(spark):
    rows = spark.sql("SELECT map('a-b', '1', 'a', '2') AS t, map('f', 1.0D) AS f, 1L AS s")
    line = lines.encode_line(F.lit("m"), F.col("t"), F.col("f"), F.col("s"))
    assert rows.select(line).first()[0] == "m,a=2,a-b=1 f=1.0 1"


@pytest.mark.parametrize("ints", [None, "i"])
def test_a_line_writes_each_number_once(spark, ints):
    # Uses of an expression in one column are computed one by one.
    rows = spark.range(1).select(F.create_map(F.lit("a"), F.col("id") / 2).alias("f"), F.create_map(F.lit("b"), "id").alias("i"))
    line = lines.encode_line(F.lit("m"), F.create_map(F.lit("t"), F.lit("x")), F.col("f"), F.lit(1), ints and F.col(ints))
    plan = rows.select(line.alias("line"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_number") <= 2  # with and without escaping, of which a row takes one
    assert rows.select(line.alias("line")).first()["line"] == ("m,t=x a=0.0 1" if ints is None else "m,t=x a=0.0,b=0i 1")


@pytest.mark.parametrize("number", [0.001, 0.0009999, 9999999.999999998, 1e7, -1e7, -0.0, 123456.789, 5e-324, float("nan")])
def test_numbers_are_written_alike_on_both_sides_of_the_limits(spark, number):
    plain = F.call_function("format_number", F.lit(number), F.lit(lines._DECIMAL))
    assert one(spark, lines.decimal_text(F.lit(number))) == one(spark, plain)
