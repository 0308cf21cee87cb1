"""CSV, Parquet and message forms of the table."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from kerbstat.schema import ACCIDENTS, canonical, header_name
from kerbstat.sources import files, messages

RAW = """ID, Severity ,Start_Time,State,Temperature(F),Humidity(%),Junction,Extra Note
A-1,3,2016-02-08 05:46:00,OH,36.9,91,True,first
A-2,2.0,2016-02-08 06:07:59.000000000,,37.9,,False,
A-3,x,yesterday,CA,warm,100,1,third
A-4,4,2016-02-09,CA,,50,0,
A-5,1,,TX,10,50,x,
"""


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(RAW)
    return str(path)


@pytest.mark.parametrize("name", ACCIDENTS.names)
def test_header_names_round_trip(name):
    assert canonical(header_name(name)) == name


def test_canonical_headers():
    assert canonical("  Wind_Speed(mph) ") == "wind_speed_mph"
    assert canonical("Humidity(%)") == "humidity_pct"


def test_raw_csv_becomes_typed(spark, csv_path):
    df = files.read_csv(spark, csv_path)
    assert dict(df.dtypes)["severity"] == "int"
    assert dict(df.dtypes)["start_time"] == "timestamp_ntz"
    assert dict(df.dtypes)["extra_note"] == "string"
    rows = {r.id: r for r in df.collect()}
    assert [rows[f"A-{i}"].severity for i in range(1, 6)] == [3, 2, None, 4, 1]
    assert [rows[f"A-{i}"].junction for i in range(1, 6)] == [True, False, True, False, None]
    assert rows["A-1"].start_time == dt.datetime(2016, 2, 8, 5, 46)
    assert rows["A-2"].start_time == dt.datetime(2016, 2, 8, 6, 7, 59)
    assert rows["A-3"].start_time is None and rows["A-3"].temperature_f is None
    assert rows["A-2"].state is None and rows["A-5"].start_time is None


def test_csv_scan_reads_only_needed_columns(spark, csv_path):
    plan = files.read_csv(spark, csv_path).select("state")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<State:string>" in plan


def test_csv_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,State\nA-1,OH\n")
    (tmp_path / "b.csv").write_text("State,ID\nCA,A-2\n")
    with pytest.raises(Exception, match="(?s)CSV header does not conform"):
        files.read_csv(spark, str(tmp_path)).collect()


def test_time_columns_are_added_only_when_missing(make):
    df = make([{"id": "a", "start_time": dt.datetime(2024, 1, 7, 6)}]).withColumn("hour", F.lit(99))
    row = files.add_time_columns(df).first()
    assert (row.hour, row.month, row.day_of_week, row.year) == (99, 1, 6, 2024)


def test_view_under_published_headers(spark, small):
    files.register_view(small, "accidents_by_header", header_names=True)
    text = """
        SELECT State, ROUND(AVG(`Temperature(F)`), 2) AS t, SUM(CASE WHEN Severity >= 3 THEN 1 ELSE 0 END) AS severe
        FROM accidents_by_header WHERE Weather_Condition IS NOT NULL AND HOUR(Start_Time) BETWEEN 6 AND 9
        GROUP BY State ORDER BY severe DESC"""
    assert spark.sql(text).count() > 0
    files.register_view(small, "accidents_plain")
    assert spark.table("accidents_plain").columns == small.columns


def test_preview(small):
    rows = files.preview(small.drop("humidity_pct"))
    assert rows.columns == ["severity", "state", "temperature_f", "weather_condition", "distance_mi"]
    assert rows.count() == 8


def test_random_sample_repeats(small):
    first = files.random_sample(small, 0.3).count()
    assert first == files.random_sample(small, 0.3).count()
    assert 0 < first < small.count()


@pytest.mark.parametrize("n", [0, 1, 500, 995, 996, 1000, 5000])
def test_earliest_rows_equal_a_full_sort(small, n):
    in_order = [r.id for r in small.orderBy(F.asc_nulls_last("start_time"), F.asc_nulls_last("id")).collect()]
    assert [r.id for r in files.earliest_rows(small, n).collect()] == in_order[:n]


def test_earliest_rows_of_one_instant_and_of_none(make):
    noon = dt.datetime(2024, 1, 1, 12)
    same = make([{"id": f"A-{i}", "start_time": noon} for i in range(20)])
    assert [r.id for r in files.earliest_rows(same, 3).collect()] == ["A-0", "A-1", "A-10"]
    undated = make([{"id": "b"}, {"id": "a"}])
    assert [r.id for r in files.earliest_rows(undated, 1).collect()] == ["a"]


def test_year_folders_and_pushdown(spark, small, tmp_path):
    path = str(tmp_path / "table")
    files.write_parquet(small, path, by_year=True)
    table = files.read_parquet(spark, path)
    assert table.count() == small.count()
    plan = table.filter("year = 2024 AND severity >= 3").select("state")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(severity,3)" in text
    assert "ReadSchema: struct<severity:int,state:string>" in text
    assert "PartitionFilters: [isnotnull(year" in text


def test_messages_keep_malformed_text(spark):
    good = json.dumps({"id": "A-1", "severity": 3, "start_time": "2024-01-01T00:00:07.179575"})
    raw = spark.createDataFrame([(good,), ("{not json",), ('{"id": "A-3"}',)], "value string")
    rows = messages.parse_messages(raw).collect()
    assert rows[0].start_time == dt.datetime(2024, 1, 1, 0, 0, 7, 179575) and rows[0]._malformed is None
    assert rows[1].id is None and rows[1]._malformed == "{not json"
    assert rows[2].id == "A-3" and rows[2].severity is None and rows[2]._malformed is None


def test_messages_parse_bytes(spark):
    raw = spark.createDataFrame([(bytearray(b'{"id": "A-1"}'),)], "value binary")
    assert messages.parse_messages(raw).first().id == "A-1"


def test_messages_carry_their_offset(spark):
    raw = spark.createDataFrame([(7, '{"id": "A-1"}')], "offset bigint, value string")
    row = messages.parse_messages(raw, keep=["offset"]).first()
    assert (row.offset, row.id) == (7, "A-1")


def test_topics_and_keys(make):
    df = make([{"id": "A-1", "state": "NEW YORK"}, {"id": "A-2"}])
    plain = messages.to_messages(df).collect()
    assert {r.topic for r in plain} == {"traffic-accidents"} and plain[0].key == "A-1"
    per_state = messages.to_messages(df, key="state", topic_per_state=True).collect()
    assert [r.topic for r in per_state] == ["traffic-accidents-NEW_YORK", "traffic-accidents-unknown"]
    assert per_state[0].key == "NEW YORK" and json.loads(per_state[0].value)["id"] == "A-1"


def test_kafka_calls_fail_only_for_want_of_the_connector(spark, small):
    for call in (lambda: messages.kafka_stream(spark, max_offsets=10), lambda: messages.publish(small)):
        with pytest.raises(Exception, match="(?i)kafka"):
            call()


def test_quotes_nan_and_fractions_in_csv(spark, make, tmp_path):
    text = 'ID,Severity,Street,State,Temperature(F)\nA-1,3,"crash at ""Main"", two lanes",OH,36\nA-2,3.7,x,OH,NaN\n'
    (tmp_path / "in.csv").write_text(text)
    rows = sorted(files.read_csv(spark, str(tmp_path / "in.csv")).collect())
    assert tuple(rows[0]) == ("A-1", 3, 'crash at "Main", two lanes', "OH", 36.0)
    assert tuple(rows[1]) == ("A-2", None, "x", "OH", None)
    table = make([{"id": "A", "street": 'a "b", c'}, {"id": "B", "street": 'line"'}])
    files.write_csv(table, str(tmp_path / "out"))
    assert sorted(r.street for r in files.read_csv(spark, str(tmp_path / "out")).collect()) == ['a "b", c', 'line"']
