import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.functions.columns import Rule, apply_map
from tidemark.operators.quality import (
    append_profile,
    continuous_state,
    discrete_state,
    distinct_sketch,
    merge_continuous,
    merge_discrete,
    merge_sketches,
    stored_ranges,
)
from tidemark.plans.star import BASE_MAP, _raw_base
from tidemark.sources.shards import read_json_shards, widen
from tidemark.sources.sinks import write_weeks


def _write(path, name, lines):
    (path / name).write_text("\n".join(lines) + "\n")


def test_shards_with_broken_lines_missing_and_widened_columns(spark, tmp_path):
    _write(tmp_path, "a.json", ['{"k": 1, "v": 5, "d": "2020-01-01", "s": "x"}', '{"k": 2, "v": null', "", '{"k": 3, "v": 7, "d": "2020-01-02", "s": "y"}'])
    _write(tmp_path, "b.json", ['{"k": 3000000000, "d": "2020-01-01 10:00:00"}', "no json", "[1, 2", '{"k": 5, "v": 1.5, "extra": true}'])
    rows, bad = read_json_shards(spark, str(tmp_path), {"k": "int", "v": "int", "d": "date", "s": "string", "gone": "int"})
    assert dict(rows.dtypes) == {"k": "bigint", "v": "double", "d": "timestamp", "s": "string", "gone": "int"}
    assert sorted((r["k"], r["v"], r["s"]) for r in rows.where("k <> 5 and k < 10").collect()) == [(1, 5.0, "x"), (3, 7.0, "y")]
    assert rows.count() == 4 and rows.where("gone is null").count() == 4
    assert sorted(r["line"] for r in bad.collect()) == ["[1, 2", "no json", '{"k": 2, "v": null']
    assert {r["file"].rsplit("/", 1)[1] for r in bad.collect()} == {"a.json", "b.json"}


def test_types_widen_to_text_and_empty_columns_stay_narrow(spark):
    df = spark.createDataFrame([("1", None, "true", "2020-01-01"), ("x", None, "false", None)], "a string, b string, c string, d string")
    assert widen(df, {"a": "int", "b": "bigint", "c": "boolean", "d": "date"}) == {"a": "string", "b": "bigint", "c": "boolean", "d": "date"}
    with pytest.raises(ValueError):
        widen(df, {"a": "blob"})
    exact = spark.createDataFrame([("9007199254740993", "9007199254740993"), ("7", "0.5")], "a string, b string")
    assert widen(exact, {"a": "int", "b": "int"}) == {"a": "bigint", "b": "string"}


def test_only_broken_lines(spark, tmp_path):
    _write(tmp_path, "a.json", ["x", "y"])
    rows, bad = read_json_shards(spark, str(tmp_path), {"k": "int"})
    assert rows.count() == 0 and bad.count() == 2


def test_column_map_is_one_projection_of_its_sources(spark):
    base = _raw_base(spark, SF_SMALL)
    out = apply_map(base, BASE_MAP)
    assert out.columns == [r.target for r in BASE_MAP]
    assert sum(r.how == "strip" for r in BASE_MAP) >= 11 and sum(r.how == "date" for r in BASE_MAP) == 3
    assert "unused" not in out._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError, match="gone.*lost"):
        apply_map(base, [Rule("a", "gone"), Rule("b", "lost")])
    with pytest.raises(ValueError, match="clash"):
        apply_map(base, [Rule("A b", "week"), Rule("ab", "week")])
    with pytest.raises(ValueError, match="not one of"):
        apply_map(base, [Rule("a", "week", "fold")])


def test_merged_states_equal_the_profile_of_the_rows(spark):
    rng = random.Random(2)
    rows = [(rng.randint(1, 30), 1e9 + rng.random() if i % 5 else None, rng.choice(["p", "q", None, str(rng.randint(0, 99))])) for i in range(2000)]
    df = spark.createDataFrame(rows, "week int, x double, t string").repartition(4)
    whole = [x for _, x, _ in rows if x is not None]
    one = merge_continuous(continuous_state(df, ["x"]), ["colname"]).first()
    assert one["n_values"] == len(whole) and one["maximum_value"] == max(whole) and one["minimum_value"] == min(whole)
    assert math.isclose(one["mean_value"], statistics.fmean(whole), rel_tol=1e-12)
    assert math.isclose(one["standard_deviation"], statistics.stdev(whole), rel_tol=1e-6)  # a spread 10^9 times smaller than the values
    late = merge_continuous(continuous_state(df, ["x"]).where("week > 20"), ["colname"]).first()
    assert late["n_values"] == sum(w > 20 and x is not None for w, x, _ in rows)
    values = {r["unique_value"]: (r["n_rows"], r["number_of_categories"]) for r in merge_discrete(discrete_state(df, ["t"]), ["colname"]).collect()}
    texts = [t for _, _, t in rows]
    assert values == {t: (texts.count(t), len(set(texts))) for t in set(texts)}
    about = merge_sketches(distinct_sketch(df, ["t"]), ["colname"]).first()["about"]
    assert abs(about - len(set(texts) - {None})) <= 5


def test_single_values_have_no_deviation_and_empty_columns_no_row(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, None)], "week int, x double, y double")
    got = merge_continuous(continuous_state(df, ["x", "y"]), ["colname"]).collect()
    assert [(r["colname"], r["n_values"], r["standard_deviation"]) for r in got] == [("x", 1, None)]


def test_a_run_appends_few_files(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 350).cast("int").alias("week"), F.col("id").cast("double").alias("x"))
    for _ in range(2):
        append_profile(continuous_state(df, ["x"]), str(tmp_path / "p"))
    files = list((tmp_path / "p").glob("**/*.parquet"))
    assert len(files) <= 4 and spark.read.parquet(str(tmp_path / "p")).count() == 700


def _by_key(df):
    return {(r["colname"], r["week"]): tuple(r)[2:] for r in df.collect()}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_ranges_equal_the_scan_with_null_weeks_and_nan(spark, scratch):
    rng = random.Random(4)
    rows = [(202401 + i % 3, rng.randint(-9, 9), None if i % 3 == 1 else i, float("nan") if i == 4 else i / 7, f"v{i % 5}", dt.date(2024, 1, 1 + i % 28)) for i in range(400)]
    schema = "week int, a int, holes bigint, x double, t string, day date"
    write_weeks(spark.createDataFrame(rows, schema), scratch)
    cols = ["a", "holes", "x", "t", "day"]
    got = _by_key(stored_ranges(spark, scratch, cols))
    names = schema.replace(",", "").split()[::2]
    assert len(got) == 15
    for (c, w), (n, values, low, high) in got.items():
        mine = [r[names.index(c)] for r in rows if r[0] == w]
        held = [v for v in mine if v is not None]
        assert (n, values) == (len(mine), len(held))
        if c == "x":
            big = [v for v in held if not math.isnan(v)]
            assert float(low) == min(big) and (math.isnan(float(high)) if len(big) < len(held) else float(high) == max(big))
        else:
            assert (low, high) == ((str(min(held)), str(max(held))) if held else (None, None))


def test_ranges_of_whole_columns_come_from_footers(spark, scratch):
    rows = spark.range(300).select((F.col("id") % 2 + 202401).cast("int").alias("week"), "id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("holes"))
    write_weeks(rows, scratch)
    whole = _plan(stored_ranges(spark, scratch, ["id"]))
    assert "PushedAggregation: [COUNT(*), COUNT(id)]" in whole and "PushedAggregation: [MIN(id), MAX(id)]" in whole
    holes = _plan(stored_ranges(spark, scratch, ["id", "holes"]))
    assert "MIN(id), MAX(id)]" in holes and "MIN(holes)" not in holes and "COUNT(holes)" in holes
    # The caller's own session keeps its Parquet source.
    assert "PushedAggregation" not in _plan(spark.read.parquet(scratch).groupBy("week").agg(F.max("id")))


def test_stored_ranges_over_several_files_and_no_columns(spark, scratch):
    for start in (0, 100, 200):
        part = spark.range(start, start + 50).select(F.lit(202401).alias("week"), F.col("id").alias("key_id"))
        part.write.mode("append").partitionBy("week").parquet(scratch)
    assert stored_ranges(spark, scratch, []).collect() == []
    assert _by_key(stored_ranges(spark, scratch, ["key_id"])) == {("key_id", 202401): (150, 150, "0", "249")}
