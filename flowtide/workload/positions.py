"""Queries over positions: sources, lookups, aggregations, changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtide.functions.calendar import bucket, date_spine
from flowtide.functions.predicates import chain_filter
from flowtide.operators import aggregates, changes, lookup
from flowtide.sources import readers
from flowtide.workload.adapters import with_ctes
from flowtide.workload.registry import query, r

_DAY = "cast(to_timestamp(date) at time zone 'UTC' as date)"


def _bucket_sql(granularity: str) -> str:
    return f"cast(date_trunc('{granularity}', {_DAY}) as timestamp)"


@query("table_scan", "select * from orders")
def _(t):
    return readers.read_parquet(t.spark, f"{t.folder}/orders.parquet")


@query("parquet_scan_with_schema", f"select s_suppkey, s_name, s_nationkey, {r('s_acctbal')} s_acctbal from supplier")
def _(t):
    path = f"{t.folder}/supplier.parquet"
    return readers.read_parquet(t.spark, path, schema=t.raw("supplier").schema)


@query("row_count", "select count(*) row_count from lineitem")
def _(t):
    return readers.row_count(t.raw("lineitem"))


@query("last_modified", "select count(*) row_count, true well_formed from lineitem")
def _(t):
    """The time itself belongs to the file, so its form is compared, beside the rows behind it."""
    form = F.col("last_modified").rlike(r"^20\d\d-\d\d-\d\d \d\d:\d\d:\d\d UTC$").alias("well_formed")
    modified = readers.last_modified(t.raw("lineitem")).select(form)
    return readers.row_count(t.raw("lineitem")).join(modified, how="left")


@query(
    "price_rows",
    f"select event_id, date_trunc('milliseconds', ts) as time, {r('value')} price from events",
)
def _(t):
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("double")
    responses = t.raw("events").select("event_id", F.array(F.array(millis, F.col("value"))).alias("prices"))
    rows = readers.price_rows(responses)
    return rows.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query(
    "facts_of_protocols",
    with_ctes(f"""select id, chain_name, date, token_name, {r('quantity')} quantity, {r('value_usd')} value_usd
                  from positions where id in ('1', '5', '7')"""),
)
def _(t):
    return lookup.facts_of_protocols(t.positions, ["1", "5", "7"])


@query(
    "protocol_info",
    with_ctes(f"""select id, name, slug, {r('tvl')} tvl, category, type, symbol, assetToken from protocols
                  where id in ('3', 'supplier#000000007') or lower(name) in ('3', 'supplier#000000007')"""),
)
def _(t):
    return lookup.protocol_info(t.protocols, ["3", None, "Supplier#000000007"]).drop("currentChainTvls")


for _mode, _predicate in {
    "exclude_borrowed": "chain_name not like '%borrowed%'",
    "only_borrowed": "chain_name like '%borrowed%'",
    "all": "true",
    "F": "chain_name = 'F'",
}.items():

    @query(
        f"chain_filter_{_mode.lower()}",
        with_ctes(f"select chain_name, count(*) row_count from positions where {_predicate} group by 1"),
    )
    def _(t, mode=_mode):
        return t.positions.where(chain_filter(mode)).groupBy("chain_name").agg(F.count("*").alias("row_count"))


@query("unique_token_names", with_ctes("select distinct token_name from positions"))
def _(t):
    return lookup.unique_token_names(t.positions)


@query(
    "tokens_by_chain",
    with_ctes("select distinct token_name, chain_name from positions where token_name is not null and token_name <> ''"),
)
def _(t):
    return lookup.tokens_by_chain(t.positions)


@query(
    "tokens_of_chains",
    with_ctes("select distinct token_name, chain_name from tagged_facts where token_name <> '' and chain_name in ('F', 'O')"),
)
def _(t):
    return lookup.tokens_by_chain(t.tagged_facts, ["F", "O"])


@query("protocol_slugs", with_ctes("select slug from protocols group by slug"))
def _(t):
    return lookup.protocol_slugs(t.protocols)


@query(
    "first_protocol_slugs",
    with_ctes("select slug from protocols group by slug order by max(tvl) desc nulls last, slug limit 10"),
)
def _(t):
    return lookup.first_protocol_slugs(t.protocols, 10)


for _unit in ("day", "week", "month", "year"):

    @query(
        f"time_bucket_{_unit}",
        with_ctes(f"select {_bucket_sql(_unit)} bucket, count(*) row_count from positions group by 1"),
    )
    def _(t, unit=_unit):
        return t.positions.groupBy(bucket(unit).alias("bucket")).agg(F.count("*").alias("row_count"))


@query(
    "category_to_type",
    with_ctes("""select id, category, case when category is not null then coalesce(broad, 'Unknown') end as type
                 from protocols left join category_map on detailed = category"""),
)
def _(t):
    return lookup.category_to_type(t.protocols.select("id", "category", "type"), t.category_map)


@query("token_frequency", with_ctes("select token_name, count(*) frequency from positions group by 1"))
def _(t):
    return aggregates.token_frequency(t.positions)


@query(
    "latest_dates",
    with_ctes("select id, chain_name, token_name, max(date) latest_date from positions group by all"),
)
def _(t):
    return aggregates.latest_dates(t.positions)


@query(
    "protocol_activity_counts",
    with_ctes(f"select {_bucket_sql('month')} period, id, count(*) entry_count from positions group by all"),
)
def _(t):
    return aggregates.protocol_activity_counts(t.positions)


@query(
    "day_entry_counts",
    with_ctes(f"select {_bucket_sql('day')} aggregated_date, count(*) entry_count from positions group by all"),
)
def _(t):
    return aggregates.day_entry_counts(t.positions)


@query(
    "token_distribution_sum",
    with_ctes(f"""
    select {_bucket_sql('week')} aggregated_date, c.id, p.name protocol_name, p.category, p.type, c.chain_name,
           {r('sum(quantity)')} total_quantity, {r('sum(value_usd)')} total_value_usd
    from positions c join protocols p on p.id = c.id
    where token_name = 'LARGE' and quantity > 0 and value_usd > 0 group by all"""),
)
def _(t):
    return aggregates.token_distribution_sum(t.positions, t.protocols, "LARGE", "week")


def _means_sql(granularity: str, where: str = "true") -> str:
    """Means per bucket, protocol, chain and token, as CTE text."""
    return f"""
    select {_bucket_sql(granularity)} aggregated_date, c.id, p.name protocol_name, p.category,
           case when p.category is not null then coalesce(m.broad, 'Unknown') end as type, c.chain_name, c.token_name,
           avg(quantity) qty, avg(value_usd) usd
    from positions c join protocols p on p.id = c.id left join category_map m on m.detailed = p.category
    where quantity > 0 and value_usd > 0 and {where} group by all"""


_MEANS = f"""select aggregated_date, id, protocol_name, category, type, chain_name, token_name,
                    {r('qty')} qty, {r('usd')} usd from means"""


@query("aggregated_positions", with_ctes(_MEANS, means=_means_sql("month")))
def _(t):
    return aggregates.aggregated_positions(t.positions, t.protocols, t.category_map, "month")


@query(
    "aggregated_positions_in_range",
    with_ctes(_MEANS, means=_means_sql("day", "date between epoch(date '1996-03-01') and epoch(date '1996-05-31')")),
)
def _(t):
    return aggregates.aggregated_positions(
        t.positions, t.protocols, t.category_map, "day", start_date="1996-03-01", end_date="1996-05-31"
    )


@query("token_distribution_mean", with_ctes(_MEANS, means=_means_sql("month", "token_name = 'PROMO'")))
def _(t):
    return aggregates.token_distribution_mean(t.positions, t.protocols, t.category_map, "PROMO", "month")


@query("protocol_data", with_ctes(_MEANS, means=_means_sql("year", "p.name = 'Supplier#000000004'")))
def _(t):
    return aggregates.protocol_data(t.positions, t.protocols, t.category_map, "Supplier#000000004", "year")


@query(
    "month_averages",
    with_ctes(f"""
    select id, chain_name, token_name, cast(date_trunc('month', {_DAY}) as date) year_month,
           {r('avg(quantity)')} avg_quantity, {r('avg(value_usd)')} avg_value_usd
    from positions where year({_DAY}) = 1997 and month({_DAY}) = 2 group by all"""),
)
def _(t):
    return aggregates.month_averages(t.positions, 1997, 2)


@query(
    "tvl_distribution_on_day",
    with_ctes(f"""
    select c.id, p.name, {r('sum(value_usd)')} total_usd_value from positions c join protocols p on p.id = c.id
    where {_DAY} = date '1998-01-01' group by all"""),
)
def _(t):
    return aggregates.tvl_distribution_on_day(t.positions, t.protocols, "1998-01-01")


# whole rows, those of chain O twice, so that groups of equal rows exist
_NAMES = "select * from positions union all select * from positions where chain_name = 'O'"


def _repeated(t):
    return t.positions.unionByName(t.positions.where("chain_name = 'O'"))


@query("duplicate_rows", with_ctes(f"select *, count(*) duplicate_count from ({_NAMES}) group by all having count(*) > 1"))
def _(t):
    return aggregates.duplicate_rows(_repeated(t))


@query(
    "detect_duplicates",
    with_ctes(f"""
    select concat('{{"id":"', id, '","chain_name":"', chain_name, '","date":', cast(date as varchar), ',"token_name":"',
                  token_name, '","quantity":', cast(quantity as double), ',"value_usd":', cast(value_usd as double), '}}')
           json_representation, count(*) duplicate_count
    from ({_NAMES}) group by 1 having count(*) > 1"""),
)
def _(t):
    return aggregates.detect_duplicates(_repeated(t))


@query("remove_duplicates", with_ctes(f"select distinct * from ({_NAMES})"))
def _(t):
    return aggregates.remove_duplicates(_repeated(t))


@query(
    "date_spine",
    """select cast(d as date) as day, count(l_orderkey) line_items
       from generate_series(timestamp '1996-01-15', timestamp '1999-01-15', interval 1 month) s(d)
       left join lineitem on cast(l_shipdate as date) = cast(d as date) group by 1""",
)
def _(t):
    spine = date_spine(t.spark, "1996-01-15", "1999-01-15", "month")
    shipped = t.raw("lineitem").select(F.to_date("l_shipdate").alias("day"), "l_orderkey")
    return spine.join(shipped, "day", "left").groupBy("day").agg(F.count("l_orderkey").alias("line_items"))


def spans_sql(source: str, where: str, period: str | None = None, chains: str = "chain_name not like '%borrowed%'") -> str:
    """Rows with the boundary dates and the row count of their key."""
    keys = "id, chain_name, token_name" + (", period" if period else "")
    rows = f"select *{', ' + period + ' period' if period else ''} from {source} where {where} and {chains}"
    return f"""
    select *, min(date) over k first_date, max(date) over k last_date, count(*) over k n
    from ({rows}) window k as (partition by {keys})"""


def changes_sql(period: bool = False, min_rows: int = 2) -> str:
    """First rows against last rows of ``spans``."""
    same = "f.id = l.id and f.chain_name = l.chain_name and f.token_name = l.token_name"
    return f"""
    select f.id, p.name protocol_name, p.category, p.type, f.chain_name, f.token_name, {'f.period,' if period else ''}
           f.first_date, f.last_date, f.quantity qty, f.value_usd usd,
           l.quantity - f.quantity qty_change, l.value_usd - f.value_usd usd_change
    from spans f join spans l on {same} {'and f.period = l.period' if period else ''} join protocols p on p.id = f.id
    where f.date = f.first_date and l.date = l.last_date and f.n >= {min_rows}"""


def changes_body(period: bool = False, first: str = "first_date") -> str:
    return f"""
    select id, protocol_name, category, type, chain_name, token_name, {'period,' if period else ''} first_date as {first},
           last_date, {r('qty')} qty, {r('usd')} usd, {r('qty_change')} qty_change, {r('usd_change')} usd_change
    from changes"""


YEAR_1996 = "date between epoch(date '1996-01-01') and epoch(date '1997-01-01')"
FROM_1996 = "date >= epoch(date '1996-01-01')"


@query("compare_periods", with_ctes(changes_body(), spans=spans_sql("facts", YEAR_1996), changes=changes_sql()))
def _(t):
    return changes.compare_periods(t.facts, t.protocols, "1996-01-01", "year", unique=True, folded=False)


@query(
    "compare_periods_fan_out",
    with_ctes(changes_body(), spans=spans_sql("positions", YEAR_1996), changes=changes_sql()),
)
def _(t):
    return changes.compare_periods(t.positions, t.protocols, "1996-01-01", "year", folded=False)


_FOLDED = "select *, count(*) copies from ({}) group by all"


@query(
    "compare_periods_folded",
    with_ctes(_FOLDED.format(changes_body()), spans=spans_sql("positions", YEAR_1996), changes=changes_sql()),
)
def _(t):
    return changes.compare_periods(t.positions, t.protocols, "1996-01-01", "year")


@query(
    "historical_changes_folded",
    with_ctes(
        _FOLDED.format(changes_body(True, "date")),
        spans=spans_sql("positions", FROM_1996, _bucket_sql("month"), "true"),
        changes=changes_sql(True, 1),
    ),
)
def _(t):
    return changes.historical_changes(t.positions, t.protocols, "month", "1996-01-01")


for _mode, _predicate in {"only_borrowed": "chain_name like '%borrowed%'", "all": "true", "O": "chain_name = 'O'"}.items():

    @query(
        f"compare_periods_{_mode.lower()}",
        with_ctes(changes_body(), spans=spans_sql("facts", YEAR_1996, chains=_predicate), changes=changes_sql()),
    )
    def _(t, mode=_mode):
        return changes.compare_periods(t.facts, t.protocols, "1996-01-01", "year", mode, unique=True, folded=False)


HISTORY = {"spans": spans_sql("facts", FROM_1996, _bucket_sql("month"), "true"), "changes": changes_sql(True, 1)}
YEARLY_HISTORY = {"spans": spans_sql("facts", FROM_1996, _bucket_sql("year"), "true"), "changes": changes_sql(True, 1)}


@query("historical_changes", with_ctes(changes_body(True, "date"), **HISTORY))
def _(t):
    return changes.historical_changes(t.facts, t.protocols, "month", "1996-01-01", unique=True, folded=False, ordered=True)


@query(
    "historical_changes_fan_out",
    with_ctes(
        changes_body(True, "date"),
        spans=spans_sql("positions", FROM_1996, _bucket_sql("year"), "true"),
        changes=changes_sql(True, 1),
    ),
)
def _(t):
    return changes.historical_changes(t.positions, t.protocols, "year", "1996-01-01", folded=False)


def _snapshot_sql(last: str, unit: str) -> dict[str, str]:
    windows = f"""
    select cast(d as date) period, epoch(d) lo, epoch(d + interval 1 {unit}) hi
    from generate_series(timestamp '1996-01-01', timestamp '{last}', interval 1 {unit}) s(d)"""
    rows = "(select f.*, period from facts f join windows on date between lo and hi)"
    spans = f"""
    select *, min(date) over k first_date, max(date) over k last_date, count(*) over k n
    from {rows} where chain_name not like '%borrowed%'
    window k as (partition by id, chain_name, token_name, period)"""
    return {"windows": windows, "spans": spans, "changes": changes_sql(True)}


@query("period_snapshots", with_ctes(changes_body(True), **_snapshot_sql("2000-01-01", "year")))
def _(t):
    return changes.period_snapshots(t.facts, t.protocols, "1996-01-01", "2000-01-01", "year", unique=True, folded=False)


@query("period_snapshots_month", with_ctes(changes_body(True), **_snapshot_sql("1997-12-01", "month")))
def _(t):
    return changes.period_snapshots(t.facts, t.protocols, "1996-01-01", "1997-12-01", "month", unique=True, folded=False)
