from datetime import date, datetime

from pyspark.sql import functions as F, types as T

from obslake.functions.names import normalize_col_name, quoted, unique_names
from obslake.functions.shapes import ddl, type_of_shape
from obslake.functions.text import fails_not_blank, is_blank, strip_whitespace, trim_control
from obslake.functions.times import (
    epoch_seconds, hour_partitions, instant_from_ntz, parse_instant, utc_date, wire_timestamp,
)


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("r")).first()["r"]


def ms(c):
    return F.unix_millis(c)


def test_trim_control_drops_control_characters_only(spark):
    assert one(spark, "\t\x01 a b \r\n\x00", trim_control) == "a b"
    assert one(spark, "　a", trim_control) == "　a"
    assert one(spark, "　 a ", strip_whitespace) == "a"


def test_blank_checks(spark):
    for text in (None, "", "  \t", "　"):
        assert one(spark, text, is_blank) is True
    assert one(spark, "\xa0", is_blank) is False
    assert one(spark, " x ", is_blank) is False
    assert one(spark, "　", fails_not_blank) is False
    assert one(spark, None, fails_not_blank) is True


def test_parse_instant(spark):
    parse = lambda c: ms(parse_instant(c))
    assert one(spark, "2024-01-15T10:30:00.123Z", parse) == 1705314600123
    assert one(spark, "2024-01-15T10:30:00Z", parse) == 1705314600000
    assert one(spark, "2024-01-15T11:30:00+01:00", parse) == 1705314600000
    for text in ("2024-13-45T10:30:00Z", "2024-01-15", "2024-01-15T10:30Z", "2024", None):
        assert one(spark, text, parse) is None


def test_wire_timestamp_reads_both_forms(spark):
    read = lambda c: ms(wire_timestamp(c))
    assert one(spark, "1705314600.123000000", read) == 1705314600123
    assert one(spark, "2024-01-15T10:30:00.123Z", read) == 1705314600123
    assert one(spark, "1705314600", read) == 1705314600000
    assert one(spark, "-0.001", read) == -1
    assert one(spark, "junk", read) is None
    assert one(spark, "9" * 19, read) is None


def test_epoch_seconds_round_trip(spark):
    back = lambda c: ms(wire_timestamp(epoch_seconds(F.timestamp_millis(c)).cast("string")))
    assert one(spark, 1705314600123, back, "long") == 1705314600123
    assert one(spark, -1, back, "long") == -1


def test_calendar_parts_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(1714478400000,), (-1,), (1710054000000,)], "v long")
            rows = df.select(
                utc_date(F.col("v")).alias("d"), *[c.alias(n) for n, c in hour_partitions(F.col("v")).items()]
            ).collect()
            assert rows[0]["d"] == date(2024, 4, 30)
            assert tuple(rows[0])[1:] == ("2024", "04", "30", "12")
            assert tuple(rows[1])[1:] == ("1969", "12", "31", "23")
            assert tuple(rows[2])[1:] == ("2024", "03", "10", "07")
            ntz = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30),)], "v timestamp_ntz")
            assert ntz.select(ms(instant_from_ntz(F.col("v")))).first()[0] == 1710037800000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_names():
    assert [normalize_col_name(n) for n in ("My_Column", "field-name.1", "amount", "my field")] == [
        "my_column", "field_name_1", "amount", "my_field",
    ]
    assert unique_names(["id", "id", "a", "id"]) == ["id", "id_2", "a", "id_3"]
    assert unique_names(["a", "a", "a_2"]) == ["a", "a_3", "a_2"]
    assert quoted("_data", "a.b", "c`d") == "`_data`.`a.b`.`c``d`"


def test_types_of_shapes(spark):
    shape = "OBJECT<_data: OBJECT<`Order-Id`: BIGINT, `a``b: OBJECT<`: VOID, e: OBJECT<>, l: ARRAY<OBJECT<p: DECIMAL(3,1), q: DECIMAL(30,0)>>, m: VARIANT>>"
    kind = type_of_shape(shape)
    data = {f.name: f.dataType.simpleString() for f in kind["_data"].dataType.fields}
    assert data == {"Order-Id": "bigint", "a`b: OBJECT<": "string", "l": "array<struct<p:double,q:decimal(30,0)>>", "m": "string"}
    assert T._parse_datatype_string(ddl(kind)) == kind
    assert type_of_shape("VOID") is None and type_of_shape(None) is None and type_of_shape("VARIANT") == T.StringType()
