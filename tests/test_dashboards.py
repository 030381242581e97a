from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.operators import balance, pools, sectors, shares
from flowtide.plans.rolling import with_rolling_mean
from flowtide.plans.running import with_running_totals

T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def network_frames(spark):
    edges = spark.createDataFrame([(T1, "a", "b", 10.0)], "time timestamp, source string, target string, size double")
    nodes = spark.createDataFrame(
        [(T1, "a", 1.0, "L"), (T2, "a", 1.0, "L"), (T1, "b", 1.0, "D"), (T1, "b", 1.0, "Unknown")],
        "time timestamp, id string, size double, type string",
    )
    return edges, nodes


@pytest.mark.parametrize("match_time, flow", [(False, 20.0), (True, 10.0)])
@pytest.mark.parametrize("folded", [True, False])
def test_sector_flows(network_frames, match_time, flow, folded):
    typed = sectors.typed_edges(*network_frames, match_time=match_time, folded=folded)
    assert rows(sectors.sector_flows(typed), "type", "inflow", "outflow") == [("D", flow, None), ("L", None, -flow)]


def test_sector_flows_fill_the_grid_of_each_side(spark):
    typed = spark.createDataFrame(
        [(T1, "A", "B", 1.0), (T2, "A", "C", 2.0), (T2, None, "C", 4.0)],
        "time timestamp, source_type string, target_type string, size double",
    )
    got = rows(sectors.sector_flows(typed))
    inflows = [(T1, "B", 1.0, None), (T1, "C", 0.0, None), (T2, "B", 0.0, None), (T2, "C", 6.0, None)]
    assert got == sorted([*inflows, (T1, "A", None, -1.0), (T2, "A", None, -2.0)], key=repr)


def test_flow_ratio_rules(spark):
    data = [
        (1, "S", 10.0, None), (1, "S", None, -4.0), (1, "R", 3.0, None), (1, "R", None, 0.0), (1, "Q", 5.0, None),
        (1, "P", 2.0, None), (1, "P", 8.0, None), (1, "O", None, 2.0), (1, "O", None, 8.0),
    ]
    given = spark.createDataFrame(data, "time int, type string, inflow double, outflow double")
    got = {(r.type, r.inflow): r.ratio for r in sectors.flow_ratio(given).collect()}
    assert got == {
        ("S", 10.0): 2.5, ("S", None): None, ("R", 3.0): None, ("R", None): None, ("Q", 5.0): None,
        ("P", 2.0): 0.25, ("P", 8.0): 0.25, ("O", None): None,
    }
    with pytest.raises(ValueError):
        sectors.flow_ratio(given.drop("outflow"))


def test_incident_frame(spark):
    given = spark.createDataFrame(
        [(T1, "Asset Management", 3e10, None, None)], "time timestamp, type string, inflow double, outflow double, ratio double"
    )
    row = sectors.incident_frame(given, "2024-01-01").first()
    assert (row.time, row.flow, row.sector, row.is_incident) == ("2024-01-01", 3.0, "Liquid Staking & Asset Management", True)


def test_shares_and_labels(spark):
    day = 19_723 * 86_400  # 2024-01-01
    facts = spark.createDataFrame(
        [(str(i), "E", day + i, "A", 1.0, v) for i, v in enumerate([60.0, 30.0, 10.0])] + [("0", "E", day - 1, "A", 1.0, 5.0)],
        "id string, chain_name string, date bigint, token_name string, quantity double, value_usd double",
    )
    protocols = spark.createDataFrame([(str(i), f"P{i}") for i in range(3)], "id string, name string")
    ranked = shares.top_shares(facts, protocols, [date(2024, 1, 1)])
    assert rows(ranked, "protocol_amount", "individual_share", "cumulative_share_percentage") == [
        (0, 0.6, 60.0), (1, 0.3, 90.0), (2, 0.1, 100.0),
    ]
    labelled = shares.threshold_labels(ranked, 90)
    assert {r.legend_label for r in labelled.collect()} == {"2024 (1/3)"}
    tree = {(r.level, r.year, r.name): r.total_usd_value for r in shares.treemap(ranked).collect()}
    assert tree[(0, None, None)] == tree[(1, "2024", None)] == 100.0 and tree[(2, "2024", "P1")] == 30.0


def test_running_totals_over_many_slices_equal_one_window(spark):
    data = spark.range(2_000).selectExpr("cast(id % 2 as string) g", "id k", "cast(if(id % 3 = 0, 0, id % 97) as double) v")
    got = with_running_totals(data, "g", [F.desc("v"), F.asc("k")], "v")
    whole = W.partitionBy("g").orderBy(F.desc("v"), "k")
    expected = data.withColumns(
        {
            "row_number": F.row_number().over(whole),
            "running_total": F.sum("v").over(whole.rowsBetween(W.unboundedPreceding, 0)),
            "group_total": F.sum("v").over(W.partitionBy("g")),
        }
    )
    assert rows(got) == rows(expected)


def test_pools_outside_the_band_are_left_out(spark):
    data = [("p", date(2024, 1, 1 + 7 * w), "T", "U", 10.0 + w) for w in range(4)]
    data += [("q", date(2024, 1, 2), "T", "V", 10_000.0), ("r", date(2024, 1, 3), "T", "W", 9.0)]
    given = spark.createDataFrame(data, "pool_id string, date date, token0 string, token1 string, tvl_usd double")
    weekly = pools.weekly_pool_tvl(given, top=2)
    assert {r.pool_category for r in weekly.collect()} == {"T/U", "Other"}
    assert [r[0] for r in pools.rank_pool_categories(weekly).collect()] == ["T/U", "Other"]


SHEET = "type string, liquidity string, source string, token string, date bigint, amount string, usd_value string"


def test_outlying_asset_rows_are_dropped(spark):
    data = [("asset", "T1", 0, 100), ("asset", "T2", 0, 5), ("asset", "T1", 86_400, 6), ("liability", "T1", 0, 50)]
    given = spark.createDataFrame([(k, "v", "s", t, d, "bad", str(v)) for k, t, d, v in data], SHEET)
    clean = balance.clean_balance_sheet(given, largest=2)
    assert rows(clean, "type", "token", "usd_value", "amount") == [("asset", "T2", 5.0, 0.0), ("liability", "T1", 50.0, 0.0)]


def test_rolling_means_need_seven_rows(spark):
    data = [("asset", "v", "s", "T", i * 86_400, "1", str(i + 1)) for i in range(8)]
    clean = balance.clean_balance_sheet(spark.createDataFrame(data, SHEET), largest=0)
    overview = balance.balance_overview(clean)
    assert [r.asset_ma for r in overview.orderBy("date_str").collect()] == [None] * 6 + [4.0, 5.0]
    moving = balance.token_moving_average(balance.token_balances(clean), "T")
    assert [r.moving_average for r in moving.orderBy("date_str").collect()] == [None] * 6 + [4.0, 5.0]
    series = rows(balance.area_series(overview).where("value is not null"), "series", "value")
    assert ("asset", 5.0) in series and len(series) == 6


def test_one_sided_balances(spark):
    data = [("asset", "v", "s", "T", 0, "2", "3"), ("liability", "v", "s", "U", 0, "4", "5")]
    clean = balance.clean_balance_sheet(spark.createDataFrame(data, SHEET), largest=0)
    assert rows(balance.token_balances(clean), "token", "usd_value_balance", "amount_balance") == [("T", 3.0, 2.0), ("U", -5.0, -4.0)]


def test_rolling_mean_hands_rows_from_slice_to_slice(spark):
    """One group with nearly all rows covers many slices, some shorter than the window, and equals the window."""
    rows_ = [("hot", i, float(i * i % 101)) for i in range(900)] + [(f"g{i % 9}", i, float(i)) for i in range(60)]
    rows_ += [(None, i, 1.0) for i in range(8)] + [("nulls", i, None if i == 9 else 2.0) for i in range(20)] + [("ties", 1, float(i % 2)) for i in range(12)]
    df = spark.createDataFrame(rows_, "g string, t int, v double")
    settings = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = with_rolling_mean(df, "g", ["t"], "v", "m", 7)
        slices = df.where("g = 'hot'").repartitionByRange("g", "t", "v").select(F.spark_partition_id()).distinct().count()
        got = sorted((repr(r.g), r.t, repr(r.v), r.m and round(r.m, 9)) for r in found.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    frame = W.partitionBy("g").orderBy("t", "v").rowsBetween(-6, 0)
    mean = F.when(F.count("v").over(frame) == 7, F.avg("v").over(frame))
    assert got == sorted((repr(r.g), r.t, repr(r.v), r.m and round(r.m, 9)) for r in df.withColumn("m", mean).collect())
    assert slices > 100 and found.columns == ["g", "t", "v", "m"]
