"""Scalar functions, text path, CSV parsing and documents."""

import pytest
from pyspark.sql import functions as F

from loadcast.functions.docs import parse_prediction, parse_raw, prediction_json, raw_json
from loadcast.functions.keys import key_parse, key_string, scaled_avg, value_parse
from loadcast.functions.text import cleanse, tokenize_ws
from loadcast.sources import parse_lines, read_csv


def test_malformed_lines(spark, tmp_path):
    lines = ["1,1704067200,2.5,1,0,0,0", "2,xx,2.5,1,0,0,0", "3,1704067200,2.5,1,0",
             "4,1704067200,2.5,1,0,0,0,99"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert sorted(r.id for r in parse_lines(df).collect()) == [1, 4]
    p = tmp_path / "in.csv"
    p.write_text("\n".join(lines) + "\n")
    got = read_csv(spark, str(p)).collect()
    assert sorted(r.id for r in got) == [1, 4]
    assert all(r.house_id == 0 and r.value == 2.5 for r in got)


def test_failfast(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("1,1704067200,2.5,1,0,0,0\n2,xx,2.5,1,0,0,0\n")
    with pytest.raises(Exception):
        read_csv(spark, str(p), mode="FAILFAST").collect()


def test_tokenize(spark):
    df = spark.createDataFrame([(" a  b\tc  ",), ("x",)], "line string")
    got = [r.t for r in df.select(tokenize_ws(F.col("line")).alias("t")).collect()]
    assert got == [["", "a", "b", "c"], ["x"]]


def test_cleanse(spark):
    df = spark.createDataFrame([(["1", "2", "3", "1", "5", "6", "7"],), (["1", "2", "3", "2", "5", "6", "7"],),
                                (["1", "2"],)], "tokens array<string>")
    assert cleanse(df).count() == 1


def test_key_strings(spark):
    df = spark.createDataFrame([(5, None, None), (1, 2, 3)], "house_id long, household_id long, plug_id long")
    got = df.select(key_string().alias("k"), key_string(mode="as_written").alias("w")).collect()
    assert [(r.k, r.w) for r in got] == [("5", "5-1-1"), ("1|2|3", "1|2|2")]
    parsed = df.select(key_parse(key_string()).alias("p")).select("p.*").collect()
    assert [tuple(r) for r in parsed] == [(5, None, None), (1, 2, 3)]


def test_value_parse_and_scale(spark):
    df = spark.createDataFrame([("1.5",), ("junk",)], "v string")
    got = df.select(value_parse(F.col("v")).alias("x")).select("x.*").collect()
    assert [tuple(r) for r in got] == [(1.5, 1, None), (0.0, 1, None)]
    s = spark.createDataFrame([(1.2345,), (-1.2345,)], "avg double").select(scaled_avg(F.col("avg")).alias("s"))
    assert [r.s for r in s.collect()] == [1234, -1234]


def test_documents_round_trip(golden):
    raw = parse_raw(golden.select(raw_json().alias("value")))
    assert sorted(tuple(r) for r in raw.collect()) == sorted(tuple(r) for r in golden.collect())
    from loadcast.config import HOUSE
    from loadcast.plans.pipeline import predictions
    p = predictions(golden, HOUSE, (1,))
    docs = p.select(prediction_json(123).alias("value"))
    text = docs.first().value
    assert '"averageWithKey":{"house_id":0,' in text and "household_id" not in text
    back = parse_prediction(docs)
    assert sorted(r.predicted_value for r in back.collect()) == sorted(r.predicted_value for r in p.collect())
    assert {r.timestamp for r in back.collect()} == {123}


def test_document_field_names(spark, golden):
    """Fields by their paths in the documents' text, not by the engine's parser."""
    from loadcast.config import PLUG
    from loadcast.functions.docs import prediction_json, raw_json
    from loadcast.plans.pipeline import predictions
    raw = golden.select(raw_json().alias("v"), "*")
    for c in golden.columns:
        assert raw.where(F.get_json_object("v", f"$.{c}") != F.col(c).cast("string")).count() == 0
    p = predictions(golden, PLUG, (1,)).select(prediction_json(7).alias("v"), "*")
    paths = {"$.averageWithKey.house_id": "house_id", "$.averageWithKey.household_id": "household_id",
             "$.averageWithKey.plug_id": "plug_id", "$.averageWithKey.sum": "sum", "$.averageWithKey.count": "count",
             "$.averageWithKey.avg": "avg", "$.averageWithKey.eventTimestamp": "event_timestamp", "$.medianLoad.load": "median_load",
             "$.key": "entity", "$.slidingWindowDuration": "sliding_window_ms", "$.predictedValue": "predicted_value"}
    for path, c in paths.items():
        assert p.where(F.get_json_object("v", path).eqNullSafe(F.col(c).cast("string"))).count() == p.count() > 0, path
    assert {r[0] for r in p.select(F.get_json_object("v", "$.timestamp")).collect()} == {"7"}


def test_files_of_the_sorted_table_are_in_order(spark, golden, tmp_path):
    from loadcast.config import HOUSE
    from loadcast.plans.pipeline import averages_table
    from loadcast.sinks.store import write_averages
    write_averages(averages_table(golden, HOUSE), str(tmp_path / "t"), mode="overwrite", sort_by_value=True)
    seen = spark.read.parquet(str(tmp_path / "t")).select("window_minutes", "avg", F.input_file_name().alias("f"),
                                                          F.monotonically_increasing_id().alias("i")).collect()
    ranges = {}
    for r in sorted(seen, key=lambda r: r.i):
        ranges.setdefault((r.window_minutes, r.f), []).append(r.avg)
    assert all(v == sorted(v) for v in ranges.values())
    for m in {k[0] for k in ranges}:
        files = sorted((min(v), max(v)) for k, v in ranges.items() if k[0] == m)
        assert all(a[1] <= b[0] for a, b in zip(files, files[1:]))
