"""Plan shape checks: shared window, pushed filters, pruned scans."""

from tickwise.plans.catalog import QUERIES
from conftest import SF_SMALL


import re


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    """Full formatted explain text (scan details are not truncated), ids stripped."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.sub(r"#\d+L?", "", text)


def test_enrich_one_exchange_one_sort(spark):
    p = plan(QUERIES["enrich_ticks"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning") == 1
    assert p.count("Sort [") == 1


def test_symbol_filter_pushed_below_window(spark):
    p = plan(QUERIES["symbol_series"](spark, SF_SMALL))
    # the symbol predicate is evaluated before the exchange (on the scan side)
    assert p.index("Filter") > p.index("Exchange")


def test_scan_prunes_columns(spark):
    p = plan(QUERIES["rows_per_symbol"](spark, SF_SMALL))
    # every path that reads the table reads this column, and the filter's time
    assert re.findall(r"ReadSchema: struct<([^>]*)>", p) == ["ts:timestamp_ntz,user_id:bigint"]


def test_enriched_reads_prune_partitions(spark):
    p = formatted(QUERIES["scan_enriched"](spark, SF_SMALL))
    part = [l for l in p.splitlines() if l.startswith("PartitionFilters")][0]
    pushed = [l for l in p.splitlines() if l.startswith("PushedFilters")][0]
    assert "date >=" in part and "In(symbol" in pushed


def test_recent_read_pushes_time_predicate(spark):
    p = formatted(QUERIES["scan_recent"](spark, SF_SMALL))
    pushed = [l for l in p.splitlines() if l.startswith("PushedFilters")][0]
    part = [l for l in p.splitlines() if l.startswith("PartitionFilters")][0]
    assert "GreaterThanOrEqual(event_time" in pushed and "date >=" in part


def test_hot_symbols_are_not_gathered_before_they_are_split(spark):
    from tickwise.operators.split_enrich import blocks
    from tickwise.plans.catalog import feed
    p = formatted(blocks(feed(spark, SF_SMALL), 40, 20, open_from_close=True))
    tree = p[:p.index("(1)")]
    # the only window by symbol alone runs over the small table of minutes
    keys = re.findall(r"Arguments: hashpartitioning\(symbol, (\S+?),", p)
    assert "_g" in keys and "_m" in keys
    assert "persist" not in tree and "InMemoryRelation" not in p


def test_split_rows_are_worked_out_once(spark):
    """The plan left reads the written blocks, twice besides the ends' second table, and not the input."""
    p = formatted(QUERIES["enrich_split"](spark, SF_SMALL))
    assert "events.parquet" not in p and "/blocks-" in p
    # windows are left only over the ends of blocks and sub-blocks
    assert p[:p.index("(1)")].count("Window") <= 2


def test_views_without_indicators_plan_no_window(spark):
    for name in ("rows_per_symbol", "data_type_breakdown", "distinct_symbols", "recent_rows"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "Window" not in p, name


def test_correlation_reads_its_input_once(spark):
    p = formatted(QUERIES["corr_matrix"](spark, SF_SMALL))
    assert "lineitem.parquet" not in p and "points-" in p


def test_percentile_has_no_single_task_over_the_data(spark):
    p = plan(QUERIES["latency_stats"](spark, SF_SMALL))
    assert "percentile" not in p
