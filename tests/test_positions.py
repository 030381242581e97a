from datetime import date, datetime

import pytest
from conftest import rows

from flowtide.functions.calendar import bucket, date_spine, epoch_seconds, first_days_of_years, shift
from flowtide.functions.values import to_number
from flowtide.operators import aggregates, lookup
from flowtide.operators.changes import compare_periods, historical_changes, period_snapshots
from flowtide.schemas import FACTS, Position, schema_of

PROTOCOL = "id string, name string, slug string, tvl double, category string, type string"
DAY = 86_400


def facts(spark, *values):
    return spark.createDataFrame(list(values), FACTS)


def protocols(spark, *ids):
    return spark.createDataFrame([(i, f"P{i}", f"p{i}", 1.0, "Dexes", "default") for i in ids], PROTOCOL)


def position(id, token, date, quantity, value, chain="E"):
    return (id, chain, date, token, float(quantity), float(value))


THREE = [position("1", "A", 0, 10, 100), position("1", "A", DAY, 7, 60), position("1", "A", DAY + 1, 9, 90)]
CHANGE = ("first_date", "last_date", "qty", "usd", "qty_change", "usd_change")


@pytest.mark.parametrize("unique", [True, False])
def test_compare_periods_includes_the_end_instant(spark, unique):
    result = compare_periods(facts(spark, *THREE), protocols(spark, "1"), "1970-01-01", "day", unique=unique)
    assert rows(result, *CHANGE) == [(0, DAY, 10.0, 100.0, -3.0, -40.0)]


def test_compare_periods_fans_out(spark):
    twice = [*THREE, position("1", "A", 0, 1, 5)]
    result = compare_periods(facts(spark, *twice), protocols(spark, "1"), "1970-01-01", "day", folded=False)
    assert rows(result, "qty", "usd", "qty_change", "usd_change") == [(1.0, 5.0, 6.0, 55.0), (10.0, 100.0, -3.0, -40.0)]


def test_equal_rows_fan_out_as_copies(spark):
    repeated = [THREE[0]] * 3 + [THREE[1]] * 2
    given = facts(spark, *repeated), protocols(spark, "1"), "1970-01-01", "day"
    assert rows(compare_periods(*given, folded=False), *CHANGE) == [(0, DAY, 10.0, 100.0, -3.0, -40.0)] * 6
    assert rows(compare_periods(*given), "usd_change", "copies") == [(-40.0, 6)]


@pytest.mark.parametrize("tasks", [1, 3])
@pytest.mark.parametrize("at", [0, DAY])
@pytest.mark.parametrize("value", [60, 61])
def test_a_broken_promise_is_an_error(spark, tasks, at, value):
    """Equal or unequal rows, of one task or of several, at the first date or the last one."""
    given = [position("1", "A", 0, 10, 60), position("1", "A", 9, 1, 1), position("1", "A", DAY, 10, 60)]
    known = protocols(spark, "1")
    fine = facts(spark, *given, position("1", "A", 9, 1, 1)).repartition(tasks)  # no boundary date
    assert rows(compare_periods(fine, known, "1970-01-01", "day", unique=True), *CHANGE) == [(0, DAY, 10.0, 60.0, 0.0, 0.0)]
    broken = facts(spark, *given, position("1", "A", at, 10, value)).repartition(tasks)
    for make in (
        lambda: compare_periods(broken, known, "1970-01-01", "day", unique=True),
        lambda: historical_changes(broken, known, "month", "1970-01-01", unique=True),
        lambda: period_snapshots(broken, known, "1970-01-01", "1970-01-01", "day", unique=True),
    ):
        with pytest.raises(Exception, match="several rows: 1, E, A"):
            make().collect()


def test_unique_rows_before_1970_and_far_dates(spark):
    """Dates of either sign, one beyond the bits of the check."""
    given = facts(spark, position("1", "A", -DAY, 1, 10), position("1", "A", 5, 2, 30), position("1", "B", 1 << 40, 3, 7))
    result = historical_changes(given.repartition(2), protocols(spark, "1"), "year", "1900-01-01", unique=True)
    assert rows(result, "token_name", "usd", "usd_change") == [("A", 10.0, 0.0), ("A", 30.0, 0.0), ("B", 7.0, 0.0)]


def test_many_copies_are_all_written_out(spark):
    repeated = spark.range(3_000).selectExpr("'1' id", "'E' chain_name", "0L date", "'A' token_name", "1d quantity", "1d value_usd")
    both = repeated.unionByName(facts(spark, position("1", "A", 9, 2, 2)))
    assert compare_periods(both, protocols(spark, "1"), "1970-01-01", "day", folded=False).count() == 3_000


def test_compare_periods_drops_single_rows_and_filters_chains(spark):
    data = facts(
        spark,
        position("1", "A", 0, 1, 1),
        position("1", "B", 0, 1, 1, "E-borrowed"),
        position("1", "B", 5, 2, 2, "E-borrowed"),
        position("1", "C", 0, 1, 1, None),
        position("1", "C", 5, 2, 2, None),
    )
    known = protocols(spark, "1")
    assert rows(compare_periods(data, known, "1970-01-01", "day")) == []
    for chains in ("only_borrowed", "all", "E-borrowed"):
        assert rows(compare_periods(data, known, "1970-01-01", "day", chains), "token_name") == [("B",)]


def test_unknown_granularity_is_an_error(spark):
    with pytest.raises(ValueError):
        compare_periods(facts(spark), protocols(spark, "1"), "1970-01-01", "daily")


@pytest.mark.parametrize("unique", [True, False])
def test_historical_changes_stay_within_the_period(spark, unique):
    data = facts(
        spark,
        position("1", "A", epoch_seconds("2024-01-01"), 1, 10),
        position("1", "A", epoch_seconds("2024-01-31"), 1, 15),
        position("1", "A", epoch_seconds("2024-02-05"), 1, 12),
    )
    result = historical_changes(data, protocols(spark, "1"), "month", "2024-01-01", unique=unique)
    assert rows(result, "period", "usd", "usd_change") == [
        (datetime(2024, 1, 1), 10.0, 5.0),
        (datetime(2024, 2, 1), 12.0, 0.0),
    ]


def test_unique_plan_agrees_with_the_general_one(spark):
    data = spark.range(4_000).selectExpr(
        "cast(id % 7 as string) id",
        "if(id % 3 = 0, 'E', 'F-borrowed') chain_name",
        "cast(id * 9001 as bigint) date",
        "concat('T', cast(id % 5 as string)) token_name",
        "cast(id % 11 as double) quantity",
        "cast(id % 13 as double) value_usd",
    )
    known = protocols(spark, *"0123456")
    for make in (
        lambda u: compare_periods(data, known, "1970-02-01", "month", "all", unique=u),
        lambda u: historical_changes(data, known, "week", "1970-02-01", unique=u),
        lambda u: period_snapshots(data, known, "1970-01-01", "1970-06-01", "month", "all", unique=u),
    ):
        assert rows(make(True)) == rows(make(False)) != []


def test_snapshots_equal_single_comparisons_beyond_day_28(spark):
    data = spark.range(900).selectExpr(
        "'1' id", "'E' chain_name", f"cast(id * {DAY // 2} as bigint) date", "'A' token_name",
        "cast(id as double) quantity", "cast(id * id as double) value_usd",
    )
    known = protocols(spark, "1")
    result = period_snapshots(data, known, "1970-01-31", "1970-04-30", "month")
    starts = [r.day for r in date_spine(spark, "1970-01-31", "1970-04-30", "month").collect()]
    expected = [(s, *r) for s in starts for r in rows(compare_periods(data, known, s, "month"), *CHANGE)]
    assert rows(result, "period", *CHANGE) == sorted(expected, key=repr)


def test_spine_clamps_to_month_ends(spark):
    days = [r.day for r in date_spine(spark, "2024-01-31", "2024-03-31", "month").orderBy("day").collect()]
    assert days == [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31)]
    assert shift(date(2024, 1, 31), "month") == date(2024, 2, 29)
    assert shift(date(2024, 2, 29), "year") == date(2025, 2, 28)
    assert first_days_of_years(2001, 2) == [date(2000, 1, 1), date(2001, 1, 1)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_buckets_are_utc_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        second = spark.range(1).selectExpr(f"{epoch_seconds('2024-02-29') + 3600}L date")
        got = second.select(*[bucket(g).alias(g) for g in ("day", "week", "month", "year")]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(got) == (datetime(2024, 2, 29), datetime(2024, 2, 26), datetime(2024, 2, 1), datetime(2024, 1, 1))


def test_category_null_stays_null(spark):
    mapping = lookup.category_map_frame(spark, {"Trading": ["Dexes"], "Other": ["Bridge", "Dexes"]})
    given = spark.createDataFrame([("1", None, "x"), ("2", "Dexes", "x"), ("3", "?", "x")], "id string, category string, type string")
    assert rows(lookup.category_to_type(given, mapping), "id", "type") == [("1", None), ("2", "Other"), ("3", "Unknown")]


def test_protocol_lookup_ignores_case_of_names_and_missing_identifiers(spark):
    known = protocols(spark, "1", "2")
    assert rows(lookup.protocol_info(known, ["p2", None]), "id") == [("2",)]
    assert rows(lookup.protocol_info(known, "1"), "id") == [("1",)]
    assert rows(lookup.protocol_info(known, [])) == []


def test_long_id_lists_use_a_join(spark):
    data = facts(spark, *THREE, position("9", "A", 0, 1, 1))
    many = [str(i) for i in range(2, 5_000)]
    assert rows(lookup.facts_of_protocols(data, many), "id") == [("9",)]


def test_duplicate_protocol_rows_weigh_alike_in_means(spark):
    data = facts(spark, position("1", "A", 0, 1, 10), position("1", "A", 1, 3, 30), position("1", "A", 2, 0, 99))
    categories = lookup.category_map_frame(spark, {"Trading": ["Dexes"]})
    result = aggregates.aggregated_positions(data, protocols(spark, "1", "1"), categories, "day")
    assert rows(result, "qty", "usd", "type") == [(2.0, 20.0, "Trading")]


def test_detect_duplicates_keeps_nulls_in_the_json(spark):
    data = facts(spark, *[("1", None, 0, "A", 1.0, 1.0)] * 2, THREE[1])
    expected = '{"id":"1","chain_name":null,"date":0,"token_name":"A","quantity":1.0,"value_usd":1.0}'
    assert rows(aggregates.detect_duplicates(data)) == [(expected, 2)]
    assert aggregates.remove_duplicates(data).count() == 2


def test_schema_of_record():
    schema = schema_of(Position)
    assert schema.simpleString() == (
        "struct<id:string,chain_name:string,date:bigint,token_name:string,quantity:double,value_usd:double>"
    )
    assert schema["id"].metadata["comment"] == "Protocol that holds the token"


def test_numbers_in_text(spark):
    texts = spark.createDataFrame([("1.5",), ("bad",), ("1d",), (None,), (" 2 ",)], "x string")
    assert [r[0] for r in texts.select(to_number("x")).collect()] == [1.5, None, None, None, 2.0]
