"""Filters, sort, counts, validation and profiles on hand-made tables."""

import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from lanewatch.operators.filters import filter_terms, where_equals, where_greater, where_less
from lanewatch.operators.metrics import count_rows, observe_rows
from lanewatch.operators.profile import (
    check_profile_arguments, exact_medians, group_profile, numeric_report,
)
from lanewatch.operators.sorting import sort_terms
from lanewatch.sinks.tables import write_csv_table
from lanewatch.sources.tables import read_csv_table


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [
        (1, "Tcp", 1.0, "5"), (2, "UDP", float("nan"), "x"), (3, None, 7.5, " 12 "),
        (None, "tcp", None, None), (443, "nan", -2.0, "1.0d"), (6, "icmp", 5.0, "-inf"),
    ]
    return spark.createDataFrame(rows, "i int, s string, d double, t string")


def values(df, column):
    return sorted((r[column] for r in df.collect()), key=lambda v: (v is None, str(v)))


def test_text_equality_ignores_case(mixed):
    assert values(where_equals(mixed, "s", "TCP"), "i") == [1, None]


def test_nan_selects_missing_values(mixed):
    assert values(where_equals(mixed, "s", "nan"), "i") == [3, 443]
    assert values(where_equals(mixed, "d", "NaN"), "i") == [2, None]
    assert where_equals(mixed, "i", "nan").count() == 1


def test_integers_match_as_integers_despite_nulls(mixed):
    assert where_equals(mixed, "i", "443").count() == 1
    assert where_equals(mixed, "i", "443.0").count() == 0
    assert where_equals(mixed, "i", "0443").count() == 0


def test_doubles_match_by_their_text(mixed):
    assert where_equals(mixed, "d", "5.0").count() == 1
    assert where_equals(mixed, "d", "5").count() == 0


def test_comparisons_drop_nan_null_and_text(mixed):
    assert values(where_greater(mixed, "d", 0), "d") == [1.0, 5.0, 7.5]
    assert values(where_less(mixed, "d", 5), "d") == [-2.0, 1.0]
    assert values(where_greater(mixed, "t", 4), "t") == [12.0, 5.0]
    assert values(where_less(mixed, "t", 4), "t") == [float("-inf")]
    assert where_greater(mixed, "t", 4).schema["t"].dataType == T.DoubleType()


def test_integer_comparison_with_fraction(mixed):
    assert values(where_greater(mixed, "i", 2.5), "i") == [3, 443, 6]
    assert values(where_less(mixed, "i", 2.5), "i") == [1, 2]
    assert values(where_greater(mixed, "i", -0.5), "i") == [1, 2, 3, 443, 6]
    assert where_greater(mixed, "i", float("inf")).count() == 0


def test_terms_are_all_applied_and_unknown_ones_warned_about(mixed):
    with pytest.warns(UserWarning, match="skipped"):
        assert filter_terms(mixed, "s=tcp, i<5 ,whatever").count() == 1
    assert filter_terms(mixed, None).count() == 6


def test_unknown_columns_and_double_signs_are_errors(mixed):
    with pytest.raises(ValueError, match="unknown column"):
        filter_terms(mixed, "nope=1")
    with pytest.raises(ValueError, match="'i>'"):
        filter_terms(mixed, "i>=5")


def test_filters_reach_the_scan(spark, tmp_path, mixed):
    path = str(tmp_path / "t")
    mixed.write.parquet(path)
    plan = filter_terms(spark.read.parquet(path), "i=443,d>2").select("i")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(i,443)" in text and "GreaterThan(d,2.0)" in text
    assert "ReadSchema: struct<i:int,d:double>" in text


def test_sort_puts_missing_last_both_ways(mixed):
    ascending = [r["d"] for r in sort_terms(mixed, "d.1").collect()]
    descending = [r["d"] for r in sort_terms(mixed, "d.0").collect()]
    assert ascending[:4] == [-2.0, 1.0, 5.0, 7.5] and descending[:4] == [7.5, 5.0, 1.0, -2.0]
    for tail in (ascending[4:], descending[4:]):
        assert all(v is None or math.isnan(v) for v in tail)


def test_sort_by_several_keys(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("a", 3), (None, 2)], "k string, n int")
    assert [tuple(r) for r in sort_terms(df, "k.1,n.0").collect()] == [
        ("a", 3), ("a", 1), ("b", 1), (None, 2)]
    with pytest.raises(ValueError, match="sort term"):
        sort_terms(df, "k")


def test_sort_spreads_one_hot_value(spark, tmp_path):
    path = str(tmp_path / "hot")
    spark.range(200_000).select(F.lit(7).alias("k"), "id").write.parquet(path)
    ordered = sort_terms(spark.read.parquet(path), "k.1")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = str(tmp_path / "out")
        ordered.write.parquet(out)
        sizes = [r["count"] for r in spark.read.parquet(out).groupBy(
            F.input_file_name()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(sizes) == 200_000 and max(sizes) < 100_000


def test_count_drops_the_sort(mixed):
    counted = count_rows(sort_terms(mixed, "d.1"))
    assert counted.columns == ["count"] and counted.first()["count"] == 6
    assert "Sort" not in counted._jdf.queryExecution().optimizedPlan().toString()


def test_observed_rows(mixed):
    seen, rows = observe_rows(mixed, "seen")
    seen.write.format("noop").mode("overwrite").save()
    assert rows.get["rows"] == 6


SMALL = [("a", 1.0, None), ("a", 2.0, None), ("b", 3.0, None), (None, 4.0, None), ("b", None, None)]


@pytest.mark.parametrize("median", ["exact", "single_pass", "approx"])
def test_profile_of_nulls(spark, median):
    df = spark.createDataFrame(SMALL, "k string, v double, w double")
    got = {r["k"]: r.asDict() for r in group_profile(
        df, ["k"], ["v", "w"], median=median, check=False).collect()}
    assert set(got) == {"a", "b"}
    a, b = got["a"], got["b"]
    assert (a["v_count"], a["v_min"], a["v_max"], a["v_mean"], a["v_sum"]) == (2, 1, 2, 1.5, 3)
    assert a["v_median"] == (1.0 if median == "approx" else 1.5)
    assert a["v_std"] == pytest.approx(0.7071067811865476) and a["v_var"] == 0.5
    assert b["v_count"] == 1 and b["v_std"] is None and b["v_var"] is None and b["v_sum"] == 3
    for row in (a, b):
        assert row["w_count"] == 0 and row["w_sum"] == 0.0
        assert all(row[f"w_{s}"] is None for s in ("min", "max", "mean", "median", "std", "var"))


def test_profile_columns_and_order(spark):
    df = spark.createDataFrame([(2, 1), (1, 5), (1, 7)], "k int, n int")
    result = group_profile(df, ["k"], ["n"], ordered=True)
    assert result.columns == ["k"] + [f"n_{s}" for s in (
        "count", "min", "max", "mean", "median", "std", "var", "sum")]
    assert [r["k"] for r in result.collect()] == [1, 2]
    assert result.schema["n_min"].dataType == T.IntegerType()


def test_profile_treats_nan_as_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0)], "k string, v double")
    row = group_profile(df, ["k"], ["v"]).first()
    assert (row["v_count"], row["v_max"], row["v_median"], row["v_sum"]) == (2, 3.0, 2.0, 4.0)


def test_profile_argument_errors(spark, mixed):
    for keys, columns, text in (
        (["s"], ["nope"], "not found"), (["s"], ["s"], "both"), (["i"], ["s"], "must be numeric"),
        (["i"], ["t"], "non-numeric"), ([], ["d"], "at least one"),
    ):
        with pytest.raises(ValueError, match=text):
            check_profile_arguments(mixed, keys, columns)


def test_numeric_report(mixed):
    report = {r["column"]: (r["non_null"], r["numeric"], r["status"])
              for r in numeric_report(mixed, ["i", "s", "d", "t"]).collect()}
    assert report == {"i": (5, 5, "ok"), "s": (5, 0, "empty"), "d": (4, 4, "ok"),
                      "t": (5, 3, "mixed")}


number = st.one_of(
    st.floats(allow_nan=False), st.integers(-5, 5).map(float),
    st.sampled_from([0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, 1.0, 1.0000000000000002,
                     float("inf"), float("-inf")]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(number, min_size=1, max_size=40), min_size=1, max_size=30))
def test_exact_median_of_any_numbers(spark, groups):
    rows = [(i, v) for i, group in enumerate(groups) for v in group]
    got = {r["k"]: r["v_median"] for r in exact_medians(
        spark.createDataFrame(rows, "k int, v double"), ["k"], ["v"]).collect()}
    for i, group in enumerate(groups):
        ordered = sorted(group)
        low, high = ordered[(len(group) - 1) // 2], ordered[len(group) // 2]
        expected = low if low == high else (low + high) / 2
        assert got[i] == expected or (math.isnan(got[i]) and math.isnan(expected))


def test_exact_median_zooms_into_one_crowded_bin(spark):
    """Values so close together that both cuts and the last step matter."""
    n = 50_001
    df = spark.range(n).select(
        F.lit("k").alias("k"), (F.lit(1.0) + F.col("id") * F.lit(2.0 ** -50)).alias("v"))
    extra = spark.createDataFrame([("k", -1e300), ("k", 1e300)], "k string, v double")
    row = exact_medians(df.union(extra), ["k"], ["v"]).first()
    assert row["v_median"] == 1.0 + (n // 2) * 2.0 ** -50
    assert row["v_median"] == statistics.median(
        [1.0 + i * 2.0 ** -50 for i in range(n)] + [-1e300, 1e300])


def test_csv_round_trip_keeps_nulls_and_reads_null_texts(spark, tmp_path):
    schema = "n int, s string, d double"
    path = str(tmp_path / "csv")
    write_csv_table(spark.createDataFrame([(1, "a", 0.5), (None, None, None)], schema), path)
    back = read_csv_table(spark, path, T._parse_datatype_string(schema))
    assert sorted(back.collect(), key=str) == [(1, "a", 0.5), (None, None, None)]
    raw = tmp_path / "raw.csv"
    raw.write_text("n,s,d\n1,N/A,nan\nx,NULL,2.5\n3,nano,\n")
    rows = read_csv_table(spark, str(raw), T._parse_datatype_string(schema)).collect()
    assert [tuple(r) for r in rows] == [(1, None, None), (None, None, 2.5), (3, "nano", None)]
    inferred = read_csv_table(spark, str(raw))
    assert inferred.dtypes == [("n", "string"), ("s", "string"), ("d", "double")]
    raw.write_text("n,s,e\n1,0.5,\nNA,inf,\n-3,1e3,\n")
    inferred = read_csv_table(spark, str(raw))
    assert inferred.dtypes == [("n", "bigint"), ("s", "double"), ("e", "string")]
    assert [tuple(r) for r in inferred.collect()] == [
        (1, 0.5, None), (None, float("inf"), None), (-3, 1000.0, None)]
