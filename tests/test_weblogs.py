"""Log lines, user agents and generated lines."""

import re
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmart.adapters import AGENTS
from starmart.functions.useragent import classify_user_agent
from starmart.functions.weblog import LINE, UNREADABLE_TIME, parse_weblogs, quarantine, readable
from starmart.operators.synth import synth_weblogs

GOOD = (
    '10.1.0.7 - user7 [10/Jan/2021:14:03:00 -0700] "GET /x HTTP/1.1" 404 209 '
    '"http://www.example.com/start.html" "curl/7.79.1"'
)


def parse(spark, *lines, **options):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string")
    ordered = parse_weblogs(df.coalesce(1), **options)
    return [r.asDict() for r in ordered.collect()]


def test_a_full_line(spark):
    (row,) = parse(spark, GOOD)
    assert row == {
        "ipaddr": "10.1.0.7",
        "identity": "-",
        "username": "user7",
        "time": datetime(2021, 1, 10, 14, 3),
        "request": "GET /x HTTP/1.1",
        "status": 404,
        "bytes": 209,
        "referer": "http://www.example.com/start.html",
        "useragent": "curl/7.79.1",
        "value": GOOD,
    }


def test_utc_applies_the_offset(spark):
    assert parse(spark, GOOD, tz="utc")[0]["time"] == datetime(2021, 1, 10, 21, 3)
    east = GOOD.replace("-0700", "+0530")
    assert parse(spark, east, tz="utc")[0]["time"] == datetime(2021, 1, 10, 8, 33)


def test_wall_clock_ignores_the_session_zone(spark):
    """02:30 does not exist in New York on that day; the log says so all the same."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        line = GOOD.replace("10/Jan/2021:14:03:00", "10/Mar/2024:02:30:00")
        assert parse(spark, line)[0]["time"] == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "stamp",
    [
        "99/Foo/2024:00:00:00 -0700",
        "30/Feb/2024:00:00:00 -0700",
        "10/Jan/2021:25:00:00 -0700",
        "10-Jan-2021 14:03:00",
        "x",
    ],
)
def test_bad_times_are_null_but_the_rest_is_parsed(spark, stamp):
    (row,) = parse(spark, GOOD.replace("10/Jan/2021:14:03:00 -0700", stamp))
    assert row["time"] is None and row["ipaddr"] == "10.1.0.7" and row["status"] == 404


@pytest.mark.parametrize("line", ["", "garbage", "a b c", GOOD[:60], "\u0001" * 9])
def test_garbage_gives_nulls(spark, line):
    (row,) = parse(spark, line)
    assert [v for k, v in row.items() if v is not None] == [line]


def test_common_format_without_referer_and_agent(spark):
    (row,) = parse(spark, GOOD.split(' "http')[0])
    assert row["bytes"] == 209 and row["referer"] is None and row["useragent"] is None


def test_dashes_escapes_and_ipv6(spark):
    line = (
        '2001:db8::1 - - [01/Dec/2021:00:00:59 -0700] "GET /\\"q\\" HTTP/1.1" - - "-" "a \\"b\\""'
    )
    (row,) = parse(spark, line)
    assert row["ipaddr"] == "2001:db8::1" and row["username"] == "-"
    assert row["request"] == 'GET /\\"q\\" HTTP/1.1' and row["useragent"] == 'a \\"b\\"'
    assert row["status"] is None and row["bytes"] is None


def test_a_line_holding_the_field_mark(spark):
    (row,) = parse(spark, GOOD.replace("curl", "cu\u0001rl"))
    assert row["useragent"] == "cu\u0001rl/7.79.1" and row["ipaddr"] == "10.1.0.7"


def test_a_very_long_field(spark):
    """A field of 200,000 characters, one in four of them guarded, does not exhaust the stack."""
    agent = 'a\\"b' * 50_000
    (row,) = parse(spark, GOOD.replace("curl/7.79.1", agent))
    assert row["useragent"] == agent and row["bytes"] == 209


FIELD = st.text(alphabet='abZ09./:;"\\[] -\u0001$é', max_size=12)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(FIELD, FIELD, FIELD), min_size=1, max_size=30))
def test_fields_equal_python_regex_groups(spark, parts):
    lines = [f'{a} - u [10/Jan/2021:14:03:00 -0700] "{b}" 200 5 "r" "{c}"' for a, b, c in parts]
    for line, row in zip(lines, parse(spark, *lines)):
        # Spark's \S and \s are ASCII; the alphabet has no other blanks.
        m = re.match(LINE, line)
        want = m.groups() if m else (None,) * 9
        assert (row["ipaddr"], row["username"]) == (want[0], want[2])
        assert row["request"] == want[4]
        assert (row["useragent"] or "") == (want[8] or "")


def test_unreadable_rows_are_split_or_marked(spark):
    df = spark.createDataFrame([(GOOD,), ("garbage",)], "value string")
    parsed = parse_weblogs(df)
    assert readable(parsed).count() == 1
    assert [r["value"] for r in quarantine(parsed).collect()] == ["garbage"]
    marked = {str(r["time"]) for r in readable(parsed, keep_unparsable=True).collect()}
    assert marked == {"2021-01-10 14:03:00", UNREADABLE_TIME}


def test_agents(spark):
    want = [
        ("Windows", 0, 1, 0),
        ("Mac OS X", 0, 1, 0),
        ("Ubuntu", 0, 1, 0),
        ("Linux", 0, 1, 0),
        ("Chrome OS", 0, 1, 0),
        ("iOS", 1, 0, 0),
        ("iOS", 0, 0, 1),
        ("Android", 1, 0, 0),
        ("Android", 0, 0, 1),
        ("Windows Phone", 1, 0, 0),
        ("Other", 0, 0, 0),
        ("Other", 0, 0, 0),
        ("Other", 0, 0, 0),
    ]
    df = spark.createDataFrame(
        [(i, a) for i, a in enumerate([*AGENTS, "", None])], "i int, useragent string"
    )
    out = classify_user_agent(df)
    assert out.columns == ["i", "useragent", "device", "is_mobile", "is_pc", "is_tablet"]
    assert [tuple(r)[2:] for r in out.orderBy("i").collect()] == want


@pytest.fixture
def made(spark):
    people = spark.range(50).select(
        F.col("id").alias("customer_id"),
        F.concat(F.lit("user"), F.col("id").cast("string")).alias("username"),
    )
    agents = spark.createDataFrame([(a,) for a in AGENTS], "value string")

    def make(**options):
        return synth_weblogs(spark, people, agents, 2000, **options)

    return make


def test_generated_lines_all_parse(spark, made):
    parsed = parse_weblogs(made(seed=3))
    assert parsed.count() == 2000
    assert quarantine(parsed).count() == 0
    row = parsed.agg(
        F.min("time"), F.max("time"), F.countDistinct("username"), F.countDistinct("useragent"),
        F.countDistinct("ipaddr"), F.countDistinct(F.minute("time")),
    ).first()
    assert row[0] >= datetime(2021, 1, 1) and row[1] < datetime(2021, 12, 31, 23, 59, 59)
    assert row[2] == 50 and row[3] == len(AGENTS) and row[4] > 1990 and row[5] == 60


def test_generated_lines_depend_on_the_seed_only(spark, made):
    one = made(seed=3, partitions=1)
    assert one.exceptAll(made(seed=3, partitions=13)).count() == 0
    assert one.intersect(made(seed=4)).count() == 0


def test_generated_times_ignore_the_session_zone(spark, made):
    """Lines for the hour New York skips in 2021."""
    hour = dict(start=datetime(2021, 3, 14, 2, 0), end=datetime(2021, 3, 14, 3, 0))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert made(seed=1, **hour).filter(~F.col("value").contains("14/Mar/2021:02:")).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
