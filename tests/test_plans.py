"""What the plans must look like for large tables."""

import re

import pytest

import __spark_entry__ as entry
from duelframe.operators import ranks, ratings
from duelframe.plans import adapters as A

SF = "/root/testdata/sf0.001"
# Queries that write or stream run when they are built; the rest only plan.
SINKS = {"scan_games", "week_partitions", "week_sink", "staging_append", "timeline_sink", "changed_weeks", "sorted_output", "stream_odds", "stream_quotes",
         "stream_week_windows", "stream_pin", "late_scores", "late_finals"}


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def nodes(node):
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def has_one_row(node) -> bool:
    """An aggregate without keys, below operators that add no rows."""
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().apply(0)
    return "Aggregate" in node.nodeName() and "(keys=[]," in node.simpleString(10000)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SINKS])
def test_no_cross_products_or_global_windows(spark, name):
    df = entry.queries()[name](spark, SF)
    text = plan(df)
    assert "CartesianProduct" not in text
    # Only a one-row side may be joined without keys.
    for node in nodes(df._jdf.queryExecution().sparkPlan()):
        if node.nodeName() == "BroadcastNestedLoopJoin":
            sides = node.children()
            assert has_one_row(sides.apply(0)) or has_one_row(sides.apply(1)), node.simpleString(1000)
    assert "BatchEvalPython" not in text
    for block in re.findall(r"\(\d+\) Window\n.*?\n\n", text, flags=re.S):
        args = re.search(r"Arguments: \[.*?\], \[(.*?)\], \[", block, flags=re.S)
        assert args and args.group(1).strip(), f"window without partition key in {name}"


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(A.games(spark, SF).where("game_id > 100").select("game_id", "home_id"))
    assert "GreaterThan(o_orderkey,100)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_newest_per_key_prunes_before_the_shuffle(spark):
    text = plan(ranks.latest_per_key(A.odds(spark, SF), ["game_id"], "fetch_ts", A.QUOTE_TIES))
    assert "Partial" in text and text.count("WindowGroupLimit") >= 2


def test_entities_are_decoded_once(spark):
    pages = A.table(spark, SF, "pages").select("page_id", ratings.strip_html("html").alias("text"))
    text = plan(ratings.parse_rating_pages(pages, ["page_id"]))
    assert len(re.findall(r"\(\d+\) ArrowEvalPython\n", text)) == 1


def test_team_rows_scan_once(spark):
    from duelframe.operators import teams

    text = plan(teams.to_team_rows(A.games(spark, SF), ["game_id"]))
    assert len(re.findall(r"\(\d+\) Scan parquet", text)) == 1 and "Exchange" not in text


def test_grid_is_partitioned_by_team(spark):
    text = plan(entry.queries()["season_to_date"](spark, SF))
    window = re.search(r"\(\d+\) Window\n.*?\n\n", text, flags=re.S).group(0)
    assert "team" in window
