import datetime as dt

import pytest

from tickloom.operators.decode import accepted, decode_bars, rejected
from tests.support import at

GOOD = '{"stock":"A","date":"2024-01-02T09:30:00","open":1,"high":2,"low":0.5,"close":1.5,"volume":10}'

REJECTS = {
    None: "null",
    "": "empty",
    "   ": "empty",
    "{bad": "malformed",
    "null": "malformed",
    f"[{GOOD}]": "malformed",
    GOOD[:-1]: "malformed",
    "{}": "no stock",
    '{"stock":"A"}': "no date",
    '{"date":"2024-01-02T09:30:00"}': "no stock",
    '{"stock":"A","date":"junk"}': "bad date",
    GOOD.replace('"open":1', '"open":"x"'): "bad field",
    GOOD + " trailing": "malformed",
    GOOD + GOOD: "malformed",
    f"{GOOD},{GOOD}": "malformed",
    GOOD + " }": "malformed",
    GOOD.replace('"A"', '"  "'): "no stock",
    GOOD.replace('"A"', '{"a":1}'): "bad stock",
}


def decode(spark, *texts):
    return decode_bars(spark.createDataFrame([(t,) for t in texts], "value string"))


@pytest.mark.parametrize("text,reason", REJECTS.items())
def test_refused_with_reason(spark, text, reason):
    decoded = decode(spark, text)
    assert [tuple(r) for r in rejected(decoded).collect()] == [(text, reason)]
    assert accepted(decoded).count() == 0


def test_integers_are_accepted_as_doubles(spark):
    row = accepted(decode(spark, GOOD)).first()
    assert tuple(row) == ("A", at("2024-01-02T09:30:00"), 1.0, 2.0, 0.5, 1.5, 10.0)


def test_extra_fields_are_ignored_and_missing_ones_null(spark):
    row = accepted(decode(spark, '{"stock":"A","date":"2024-01-02T09:30:00","extra":1}')).first()
    assert tuple(row)[2:] == (None,) * 5


def test_nested_and_quoted_braces_are_part_of_a_record(spark):
    texts = [GOOD[:-1].replace('1.5', '1.5,"nan":NaN') + ',"more":{"a":[1,{"b":2}]}}', GOOD.replace('"A"', '"A}{\\"}"'), f"  {GOOD}\n"]
    assert [r.close for r in accepted(decode(spark, *texts)).collect()] == [1.5] * 3


def test_nan_is_kept(spark):
    row = accepted(decode(spark, GOOD.replace("0.5", "NaN"))).first()
    assert row.low != row.low


@pytest.mark.parametrize(
    "text,instant",
    [
        ("2024-01-02T09:30:00-05:00", dt.datetime(2024, 1, 2, 14, 30)),
        ("2024-01-02T09:30:00Z", dt.datetime(2024, 1, 2, 9, 30)),
        ("2024-01-02T09:30:00.250000", dt.datetime(2024, 1, 2, 9, 30, 0, 250000)),
    ],
)
def test_date_forms(spark, text, instant):
    frame = accepted(decode(spark, GOOD.replace("2024-01-02T09:30:00", text)))
    assert frame.selectExpr("cast(date as timestamp_ntz)").first()[0] == instant


def test_binary_input_and_noted_ingest_time(spark):
    text = GOOD[:-1] + ',"ingest_ts":"2024-01-02T09:31:00Z"}'
    frame = spark.createDataFrame(
        [(bytearray(t.encode()), at("2024-05-05T00:00:00")) for t in (text, GOOD)],
        "value binary, seen timestamp",
    )
    rows = accepted(decode_bars(frame, "value", "seen"), "ingest_ts").collect()
    assert sorted(str(r.ingest_ts) for r in rows) == ["2024-01-02 09:31:00", "2024-05-05 00:00:00"]


def test_filters_do_not_repeat_the_parse(spark):
    plan = accepted(decode(spark, GOOD))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
