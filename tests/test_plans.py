"""What the physical plans must look like."""

import pytest
from pyspark.sql import functions as F

from slotwise.operators import changes, ordering, patterns, search, windows
import slotwise.plans.all  # noqa: F401
from slotwise.plans.registry import QUERIES, table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    df = QUERIES["where_conditions"](spark, SF)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = next(line for line in text.split("\n") if "PushedFilters" in line)
    assert "GreaterThan(c_acctbal,100.0)" in pushed and "In(c_mktsegment, [BUILDING,MACHINERY])" in pushed
    df = QUERIES["dataset_query"](spark, SF)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "In(o_orderstatus, [F,P])" in text
    text = plan(QUERIES["agg_search_stats"](spark, SF))
    assert "ReadSchema: struct<l_extendedprice:double>" in text


@pytest.mark.parametrize("name", ["collapse", "terminate_after", "expand_collapsed", "term_suggest", "prefix_suggest"])
def test_row_limits_are_applied_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(QUERIES[name](spark, SF))


def test_top_hits_are_not_sorted_whole(spark):
    text = plan(ordering.top_docs(table(spark, SF, "orders"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 10, 5))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_scoring_shuffles_only_the_statistics(spark):
    scored = search.match_score(table(spark, SF, "documents"), "text", "with from")
    text = plan(scored)
    assert text.count("Exchange") == 1 and "SinglePartition" in text


def test_plans_of_patterns_do_not_grow_with_their_steps(spark):
    import datetime

    keyed = patterns.keyed(table(spark, SF, "events"), "user_id", "ts", "event_id", F.col("event_type"))
    sizes = []
    for times in (3, 6):
        steps = [patterns.Step(F.col("event_type") == "view", "followed_by")] * times
        text = plan(patterns.pattern_match(keyed, steps, datetime.timedelta(hours=5)).matched)
        sizes.append((text.count("FileScan"), text.count("Exchange"), text.count("Window [")))
        assert "Window [last" in text
    assert sizes[0] == sizes[1] and sizes[0][0] <= 7  # two scans, each reading twice, and the last event


def test_running_values_shuffle_wide_rows_once(spark):
    import datetime

    out = windows.running_reduce(
        table(spark, SF, "events"), "event_type", "ts", "event_id", F.lit(1), datetime.timedelta(days=1)
    )
    wide = [line for line in plan(out).split("\n") if "Exchange" in line]
    assert len(wide) <= 4  # rows; slice totals; totals per key; totals back
    assert plan(out).count("props") <= 12


def test_no_plan_multiplies_rows(spark):
    """No cross joins or nested loops anywhere."""
    for name, query in QUERIES.items():
        if name.endswith("_stream") or name in ("watermark", "print_sink", "checkpointing", "stream_source", "scroll_pages"):
            continue
        text = plan(query(spark, SF))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_both_parts_of_applied_changes_share_a_shuffle(spark, tmp_path):
    base = spark.range(2000).select("id", (F.col("id") * 2).alias("v"))
    base.write.parquet(str(tmp_path / "b"))
    ops = spark.range(500).select(
        F.col("id").alias("seq"), F.lit("index").alias("op"), (F.col("id") * 7).alias("id"), F.col("id").alias("v")
    )
    ops.write.parquet(str(tmp_path / "o"))
    out = changes.apply_changes(spark.read.parquet(str(tmp_path / "b")), spark.read.parquet(str(tmp_path / "o")), "id", ["v"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out.table.collect()
        assert "ReusedExchange" in plan(out.table)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
