"""The plans the operators promise: pushed filters, pruned columns, few shuffles, no Python workers."""

import re

import pytest
from conftest import rows

from flowtide.operators import aggregates, network
from flowtide.operators.changes import compare_periods, historical_changes
from flowtide.operators.flows import value_flows
from flowtide.plans.skew import expand_copies, skewed_join
from flowtide.schemas import FACTS
from flowtide.workload import all_queries

PROTOCOL = "id string, name string, slug string, tvl double, category string, type string"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("stored") / "facts")
    data = spark.range(20_000).selectExpr(
        "cast(id % 50 as string) id", "'E' chain_name", "cast(id * 3600 as bigint) date",
        "concat('T', cast(id % 9 as string)) token_name", "cast(id as double) quantity", "cast(id as double) value_usd",
    )
    data.write.parquet(place)
    protocols = spark.createDataFrame([(str(i), f"P{i}", f"p{i}", 1.0, "Dexes", "x") for i in range(50)], PROTOCOL)
    protocols.write.parquet(place + "-protocols")
    return spark.read.schema(FACTS).parquet(place), spark.read.schema(PROTOCOL).parquet(place + "-protocols")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hashpartitioning|rangepartitioning|Single)", text))


def test_compare_periods_is_one_shuffle_with_pushed_dates(stored):
    text = plan(compare_periods(*stored, "1970-02-01", "month", unique=True))
    assert shuffles(text) == 1 and "BroadcastHashJoin" in text
    assert "GreaterThanOrEqual(date," in text and "LessThanOrEqual(date," in text
    assert "SortAggregate" not in text and "Window" not in text


def test_general_comparison_has_no_window(stored, spark):
    df = compare_periods(*stored, "1970-02-01", "month", folded=True)
    df.collect()
    assert "Window" not in plan(df)


def test_history_is_one_shuffle(stored):
    assert shuffles(plan(historical_changes(*stored, "month", "1970-01-01", unique=True))) == 1


def test_links_do_not_window_or_collect_groups(stored, spark):
    owners = spark.createDataFrame([("T1", "1")], "token_name string, mapped_id string")
    flows = value_flows(compare_periods(*stored, "1970-02-01", "month", unique=True, folded=True), owners)
    for made in (network.links(flows), network.node_sizes(flows), network.link_composition(flows)):
        assert "Window" not in plan(made) and "collect_list" not in plan(made)


def test_token_distribution_reads_only_its_columns(stored):
    text = plan(aggregates.token_distribution_sum(*stored, "T1", "month"))
    assert "EqualTo(token_name,T1)" in text and "GreaterThan(value_usd,0.0)" in text
    assert "slug" not in text and "isnotnull(cast" not in text


def test_means_are_added_up_once(stored):
    """Behind the join with the protocols nothing is aggregated again, whatever rows the dimension repeats."""
    facts, protocols = stored
    categories = protocols.limit(0).select(protocols.name.alias("broad"), protocols.category.alias("detailed"))
    made = aggregates.aggregated_positions(facts, protocols, categories, "month", ordered=False)
    assert len(re.findall(r"HashAggregate\(keys=\[[^]]*token_name", plan(made))) == 2
    again = aggregates.aggregated_positions(facts, protocols.unionByName(protocols), categories, "month", ordered=False)
    assert rows(again) == rows(made) and made.count()


def test_a_document_follows_the_flows_once(stored, spark):
    owners = spark.createDataFrame([("T1", "1")], "token_name string, mapped_id string")
    flows = value_flows(compare_periods(*stored, "1970-02-01", "month", unique=True, folded=True), owners)
    made = network.network_document(flows)
    assert "FileScan" not in plan(made) and made.count() > 0


def test_day_filters_reach_the_scan(stored):
    text = plan(aggregates.tvl_distribution_on_day(*stored, "1970-03-01"))
    assert "GreaterThanOrEqual(date,5097600)" in text and "LessThan(date,5184000)" in text


def test_skewed_join_keeps_rows(spark):
    big = spark.range(5_000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 100 as string)) k", "id v").unionByName(
        spark.sql("select cast(null as string) k, -1L v")
    )
    small = spark.sql("select 'hot' k, 1 w union all select '7', 2 union all select null, 3")
    plain = big.join(small, "k", "left")
    assert rows(skewed_join(big, small, ["k"])) == rows(plain)
    safe = skewed_join(big, small, ["k"], "inner", null_safe=True)
    assert safe.where("k is null").count() == 1 and safe.count() == plain.where("w is not null").count() + 1


def test_a_hot_key_is_split(spark):
    """With a third of all rows in one key and no broadcast, adaptive execution splits that key's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        big = spark.range(0, 300_000, 1, 16).selectExpr("if(id % 3 = 0, -1, id % 1000) k", "xxhash64(id) v")
        small = spark.range(-1, 1000).selectExpr("id k", "id * 2 w")
        joined = skewed_join(big, small, ["k"])
        joined.write.format("noop").mode("overwrite").save()
        assert joined.collect() and "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_expand_copies(spark):
    given = spark.sql("select 'a' x, 5L copies union all select 'b', 1L union all select 'c', 2500L union all select 'd', 40001L")
    for block in (100, 7):
        got = {r.x: r["count"] for r in expand_copies(given, block=block).groupBy("x").count().collect()}
        assert got == {"a": 5, "b": 1, "c": 2500, "d": 40001}


def test_registered_queries_have_oracles():
    assert not {name for name, q in all_queries().items() if not q.sql}


#: At least one query of each operator module, without variants and those that iterate or write tables.
PLANNED = """
    price_rows facts_of_protocols protocol_info tokens_of_chains category_to_type token_distribution_sum
    aggregated_positions month_averages detect_duplicates compare_periods compare_periods_folded historical_changes_folded
    period_snapshots rule_token_map lookup_tokens value_flows network_nodes canonical_links network_links
    sector_flows top_shares weekly_pool_tvl token_balances token_moving_averages clean_balance_sheet
""".split()


@pytest.mark.parametrize("name", PLANNED)
def test_plans_have_no_python_workers_and_no_products(spark, name):
    text = plan(all_queries()[name].run(spark, "/root/testdata/sf0.001"))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text
