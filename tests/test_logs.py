from datetime import date

import pytest
from pyspark.sql import functions as F

from obslake.operators.logs import LOG_PATTERN, extract_log_fields, log_to_metric, parse_log_metrics
from obslake.sources.tables import seed_metadata


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_extract_groups(spark):
    a = "2023-11-02T04:05:06Z [INFO] [mailer] sent 3 letters"
    b = "2023-11-02T04:05:07Z [ERROR] [printer] out of paper in tray 2"
    rows = {r.service_id: r for r in extract_log_fields(lines(spark, a, b)).collect()}
    assert tuple(rows["mailer"]) == (
        "2023-11-02T04:05:06Z", "INFO", "mailer", "sent 3 letters", a, date(2023, 11, 2),
    )
    assert rows["printer"].level == "ERROR"


def test_extract_drops_other_lines(spark):
    assert extract_log_fields(lines(spark, "only words", "", None)).count() == 0
    mixed = lines(
        spark,
        "2023-11-02T04:05:00Z [INFO] [mailer] a",
        "noise",
        "2023-11-02T04:05:01Z [WARN] [mailer] b",
        "",
        "2023-11-02T04:05:02Z [info] [mailer] c",
    )
    assert [r.level for r in extract_log_fields(mixed).orderBy("timestamp").collect()] == ["INFO", "WARN", "info"]


def test_cutting_a_match_gives_the_groups_of_the_pattern(spark):
    awkward = lines(
        spark,
        "x2023-11-02T04:05:00Z [INFO] [a[b] [c] [d] Z] e",
        "2024-01-15T1:.Z\t[I_1]  [ ]\t \x0b [x] ",
        "2023-11-02T04:05:00Z [INFO] [svc] ",
        "2023-11-02T04:05:00Z [INFO] [svc] \u00a0m\u2028n",
        "2023-11-02T04:05:00Z [IN FO] [svc] m 2023-11-02T04:05:00Z [OK] [Z] Z [y] z",
        "2023-11-02T04:05:00Z [INFO] [] m",
        "\u20ac 2023-11-02T04:05:00Z [INFO] [\u20ac] \U0001f600 m",
    )
    groups = [F.regexp_extract("value", LOG_PATTERN, i).alias(n) for i, n in enumerate(("timestamp", "level", "service_id", "message"), 1)]
    plain = awkward.select(*groups, F.col("value").alias("raw_line")).filter("timestamp <> ''")
    found = extract_log_fields(awkward).drop("date")
    assert sorted(found.collect()) == sorted(plain.collect()) and found.count() == 6


def test_extract_keeps_the_line_and_survives_bad_dates(spark):
    line = '2023-11-02T04:05:06Z [DEBUG] [mailer] sizes={"a":[1,2]}'
    assert extract_log_fields(lines(spark, line)).first().raw_line == line
    bad = extract_log_fields(lines(spark, "2024-13-45T10:30:00Z [INFO] [svc-api] m")).first()
    assert bad.timestamp == "2024-13-45T10:30:00Z" and bad.date is None


@pytest.mark.parametrize(
    "line, level, service, millis",
    [
        ("2023-11-02T04:05:06.789Z [INFO] [mailer] sent 3 letters, 12 s", "INFO", "mailer", 1698897906789),
        ("2022-02-28T23:59:59.000Z [WARN] [printer] toner at 4 %", "WARN", "printer", 1646092799000),
        ("\t2020-02-29T12:00:00.250Z [error] [mailer] relay refused, 2 tries \n", "ERROR", "mailer", 1582977600250),
    ],
)
def test_parse(spark, line, level, service, millis):
    row = parse_log_metrics(lines(spark, line)).first()
    assert (row.metric_name, row.value, row.unit) == ("log.event", 1.0, "count")
    assert (row.parsed_level, row.service_id, row.timestamp_ms) == (level, service, millis)
    assert (row.service_name, row.team, row.environment, row.region, row.tags) == (service, "unknown", "unknown", "unknown", None)


def test_parse_rejects(spark):
    bad = lines(
        spark,
        "only words, no header",
        "WARN nothing in brackets",
        None,
        "   ",
        "2023-11-02T04:05:06.000Z [INFO] mailer sent",
        "junk 2023-11-02T04:05:00Z [INFO] [svc-api] m",
        "2023-11-02T04:05:00Z [INFO] [svc-api] ",
        "2023-11-02T04:05:00Z [INFO] [svc-api] two\nlines",
        "2023-11-02T04:05:00Z [INFO] [svc-api] m ",
    )
    assert parse_log_metrics(bad).count() == 0
    # The searching parser takes leading junk and an empty message.
    assert extract_log_fields(bad).count() == 4


def test_bad_date_becomes_now(spark):
    line = lines(spark, "2024-13-45T00:00:00Z [INFO] [mailer] m")
    age = F.unix_millis(F.current_timestamp()) - F.col("timestamp_ms")
    assert parse_log_metrics(line).select(age.alias("age")).first().age == 0
    assert parse_log_metrics(line, now=F.timestamp_millis(F.lit(77))).first().timestamp_ms == 77


def test_lookup_replaces_placeholders(spark):
    parsed = parse_log_metrics(
        lines(spark, "2023-11-02T04:05:00Z [warn] [svc-api] m", "2023-11-02T04:05:00Z [INFO] [nobody] m")
    )
    rows = {r.service_id: r for r in log_to_metric(parsed, seed_metadata(spark)).collect()}
    assert (rows["svc-api"].service_name, rows["svc-api"].team, rows["svc-api"].parsed_level) == ("API Service", "platform", "WARN")
    assert (rows["nobody"].service_name, rows["nobody"].team, rows["nobody"].log_message) == ("Unknown Service", "unknown", "m")
