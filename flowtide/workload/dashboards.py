"""Queries behind the dashboards: sector flows, shares, pools, balance sheet."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtide.functions.calendar import first_days_of_years
from flowtide.operators import aggregates, balance, pools, sectors, shares
from flowtide.workload.adapters import with_ctes
from flowtide.workload.networks import EDGES_SQL, NODES_SQL, YEARS, yearly_edges, yearly_nodes
from flowtide.workload.positions import _means_sql
from flowtide.workload.registry import query, r

_TYPED = {
    **YEARS,
    "edges": EDGES_SQL.format(1000),
    "named": NODES_SQL.format(1000),
    "kept": "select * from named where type is null or type not in ('Privacy & Security', 'Unknown')",
    "typed": """
    select e.time, source, target, e.size, s.type source_type, d.type target_type
    from edges e left join kept s on s.id = source left join kept d on d.id = target""",
}
_GRIDS = {
    **_TYPED,
    "inflows": "select time, target_type as type, sum(size) flow from typed where target_type is not null group by all",
    "outflows": "select time, source_type as type, -sum(size) flow from typed where source_type is not null group by all",
    "stacked": """
    select t.time, k.type, coalesce(flow, 0) inflow, null outflow
    from (select distinct time from inflows) t cross join (select distinct type from inflows) k
         left join inflows f on f.time = t.time and f.type = k.type
    union all
    select t.time, k.type, null, coalesce(flow, 0)
    from (select distinct time from outflows) t cross join (select distinct type from outflows) k
         left join outflows f on f.time = t.time and f.type = k.type""",
    "rated": """
    select *, case when inflow is not null and count(*) over g = 2 and count(inflow) over g = 1 and count(outflow) over g = 1
                        and sum(outflow) over g <> 0 then abs(inflow / sum(outflow) over g) end ratio
    from stacked window g as (partition by time, type)""",
}


@query(
    "typed_edges",
    with_ctes(f"select time, source, target, {r('size')} size, source_type, target_type from typed", **_TYPED),
)
def _(t):
    return sectors.typed_edges(yearly_edges(t), yearly_nodes(t), folded=False)


@query(
    "typed_edges_in_slice",
    with_ctes(f"""select e.time, source, target, {r('e.size')} size, s.type source_type, d.type target_type
                  from edges e left join kept s on s.id = source and s.time = e.time
                  left join kept d on d.id = target and d.time = e.time""", **_TYPED),
)
def _(t):
    return sectors.typed_edges(yearly_edges(t), yearly_nodes(t), match_time=True, folded=False)


def _sector_flows(t):
    return sectors.sector_flows(sectors.typed_edges(yearly_edges(t), yearly_nodes(t), folded=True))


@query(
    "sector_flows",
    with_ctes(f"select time, type, {r('inflow')} inflow, {r('outflow')} outflow from stacked", **_GRIDS),
)
def _(t):
    return _sector_flows(t)


@query(
    "flow_ratio",
    with_ctes(f"select time, type, {r('inflow')} inflow, {r('outflow')} outflow, {r('ratio')} ratio from rated", **_GRIDS),
)
def _(t):
    return sectors.flow_ratio(_sector_flows(t))


@query(
    "incident_frame",
    with_ctes(f"""
    select strftime(time, '%Y-%m-%d') as time, type, {r('inflow')} inflow, {r('outflow')} outflow, {r('ratio')} ratio,
           {r('(coalesce(inflow, 0) + coalesce(outflow, 0)) / 1e6')} flow,
           case type when 'Asset Management' then 'Liquid Staking & Asset Management' else type end sector,
           cast(time as date) = date '1998-01-01' is_incident
    from rated""", **_GRIDS),
)
def _(t):
    return sectors.incident_frame(sectors.flow_ratio(_sector_flows(t)), "1998-01-01", unit=1e6)


_MONTHLY = _means_sql("month")


def _monthly(t):
    return aggregates.aggregated_positions(t.positions, t.protocols, t.category_map, "month", ordered=False)


@query(
    "global_series",
    with_ctes(f"select type, aggregated_date, {r('sum(usd)')} usd from means group by all", means=_MONTHLY),
)
def _(t):
    return shares.global_series(_monthly(t))


@query(
    "top_protocol_series",
    with_ctes(
        f"""select type, protocol_name, aggregated_date, {r('sum(usd)')} usd from means
            where protocol_name in (select protocol_name from means group by 1 order by avg(usd) desc, 1 limit 5)
            group by all""",
        means=_MONTHLY,
    ),
)
def _(t):
    return shares.top_protocol_series(_monthly(t), 5)


_SHARES = {
    "days": """
    select cast(year(to_timestamp(date) at time zone 'UTC') as varchar) as year, c.id, p.name, sum(value_usd) total
    from positions c join protocols p on p.id = c.id
    where cast(to_timestamp(date) at time zone 'UTC' as date)
          in (date '1996-01-01', date '1997-01-01', date '1998-01-01', date '1999-01-01', date '2000-01-01')
    group by all""",
    "shares": """
    select *, sum(total) over (partition by year order by total desc, id, name rows unbounded preceding)
                  / sum(total) over (partition by year) cumulative,
           total / sum(total) over (partition by year) individual,
           row_number() over (partition by year order by total desc, id, name) - 1 protocol_amount
    from days""",
}
_SHARE_COLUMNS = f"""id, name, {r('total')} total_usd_value, {r('cumulative')} cumulative_share,
    {r('individual')} individual_share, {r('cumulative * 100')} cumulative_share_percentage,
    {r('individual * 100')} individual_share_percentage, year, protocol_amount"""


def _top_shares(t):
    return shares.top_shares(t.positions, t.protocols, first_days_of_years(2000))


@query("top_shares", with_ctes(f"select {_SHARE_COLUMNS} from shares", **_SHARES))
def _(t):
    return _top_shares(t)


@query(
    "threshold_labels",
    with_ctes(
        f"""select {_SHARE_COLUMNS}, below is_below_threshold, count(*) filter (below) over (partition by year) below_threshold,
                   count(*) over (partition by year) total,
                   concat(year, ' (', count(*) filter (below) over (partition by year), '/',
                          count(*) over (partition by year), ')') legend_label
            from flagged""",
        **_SHARES,
        flagged="select *, cumulative * 100 < 90 below from shares",
    ),
)
def _(t):
    return shares.threshold_labels(_top_shares(t))


@query(
    "treemap",
    with_ctes(
        f"""select year, name, cast(2 - grouping(year) - grouping(name) as integer) as level, {r('sum(total)')} total_usd_value,
                   {r('sum(total * individual * 100) / sum(total)')} mean_share_percentage
            from shares where individual > 0 group by rollup (year, name)""",
        **_SHARES,
    ),
)
def _(t):
    return shares.treemap(_top_shares(t))


_POOL_DIGITS = 14
_POOLS = {
    "best": "select pool_id from pools group by 1 order by avg(tvl_usd) desc, pool_id limit 10",
    "weekly": """
    select cast(date_trunc('week', date) as timestamp) date,
           case when pool_id in (select pool_id from best) then concat(token0, '/', token1) else 'Other' end pool_category,
           avg(tvl_usd) tvl
    from pools group by all""",
    "band": "select quantile_cont(tvl, 0.25) q1, quantile_cont(tvl, 0.75) q3 from weekly",
    "shown": """
    select date, pool_category, tvl / 1e9 billions from weekly, band
    where tvl between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)""",
}


@query(
    "weekly_pool_tvl",
    with_ctes(f"select date, pool_category, {r('billions', _POOL_DIGITS)} tvl_usd_billions from shown", **_POOLS),
    _POOL_DIGITS,
)
def _(t):
    return pools.weekly_pool_tvl(t.pools)


@query(
    "rank_pool_categories",
    with_ctes(
        f"select pool_category, {r('avg(billions)', _POOL_DIGITS)} tvl_usd_billions from shown group by 1", **_POOLS
    ),
    _POOL_DIGITS,
)
def _(t):
    return pools.rank_pool_categories(pools.weekly_pool_tvl(t.pools, ordered=False))


_SHEET = {
    "dated": "select * replace (cast(to_timestamp(date) at time zone 'UTC' as date) as date) from bsheet",
    "peak": "select token, date from dated where type = 'asset' order by usd_value desc, token, date limit 15",
    "clean": """
    select type, liquidity, source, token, date date_str, coalesce(sum(usd_value), 0) usd_value, coalesce(sum(amount), 0) amount
    from dated
    where not (type = 'asset' and date in (select date from peak) and token in (select token from peak)) group by all""",
    "balances": """
    select coalesce(a.date_str, l.date_str) date_str, coalesce(a.token, l.token) token,
           coalesce(a.amount, 0) asset_amount, coalesce(a.usd_value, 0) asset_usd_value,
           coalesce(l.amount, 0) liability_amount, coalesce(l.usd_value, 0) liability_usd_value
    from (select * from clean where type = 'asset') a
    full join (select * from clean where type = 'liability') l on l.date_str = a.date_str and l.token = a.token""",
    "daily": """
    select date_str, coalesce(sum(usd_value) filter (type = 'asset'), 0) asset,
           coalesce(sum(usd_value) filter (type = 'liability'), 0) liability,
           coalesce(sum(usd_value) filter (type = 'equity'), 0) equity
    from clean group by 1""",
    "means": """
    select *, case when count(*) over w = 7 then avg(asset) over w end asset_ma,
           case when count(*) over w = 7 then avg(liability) over w end liability_ma,
           case when count(*) over w = 7 then avg(equity) over w end equity_ma
    from daily window w as (order by date_str rows 6 preceding)""",
}
_BALANCES = f"""date_str, token, {r('asset_amount')} asset_amount, {r('asset_usd_value')} asset_usd_value,
    {r('liability_amount')} liability_amount, {r('liability_usd_value')} liability_usd_value,
    {r('asset_usd_value - liability_usd_value')} usd_value_balance, {r('asset_amount - liability_amount')} amount_balance"""


def _clean(t):
    return balance.clean_balance_sheet(t.balance_sheet)


@query(
    "clean_balance_sheet",
    with_ctes(f"select type, liquidity, source, token, date_str, {r('usd_value')} usd_value, {r('amount')} amount from clean", **_SHEET),
)
def _(t):
    return _clean(t)


@query("token_balances", with_ctes(f"select {_BALANCES} from balances", **_SHEET))
def _(t):
    return balance.token_balances(_clean(t), folded=False)


@query("token_balances_folded", with_ctes(f"select *, count(*) copies from (select {_BALANCES} from balances) group by all", **_SHEET))
def _(t):
    return balance.token_balances(_clean(t))


@query(
    "balance_overview",
    with_ctes(
        f"""select date_str, {r('asset')} asset, {r('liability')} liability, {r('equity')} equity, {r('asset_ma')} asset_ma,
                   {r('liability_ma')} liability_ma, {r('equity_ma')} equity_ma,
                   {r('equity_ma + liability_ma')} "equity+liability" from means""",
        **_SHEET,
    ),
)
def _(t):
    return balance.balance_overview(_clean(t))


_MOVING = f"""
    select {_BALANCES}, {r('case when count(*) over w = 7 then avg(asset_usd_value - liability_usd_value) over w end')} moving_average
    from balances where {{}}
    window w as (partition by token order by date_str, asset_usd_value, liability_usd_value, asset_amount, liability_amount
                 rows 6 preceding)"""


@query("token_moving_average", with_ctes(_MOVING.format("token = 'T3'"), **_SHEET))
def _(t):
    return balance.token_moving_average(balance.token_balances(_clean(t), ordered=False), "T3")


@query("token_moving_averages", with_ctes(_MOVING.format("true"), **_SHEET))
def _(t):
    return balance.token_moving_average(balance.token_balances(_clean(t), ordered=False))


@query(
    "area_series",
    with_ctes(
        f"""select date_str, 'asset' series, {r('asset_ma')} as value from means union all
            select date_str, 'equity', {r('-(equity_ma + liability_ma)')} from means union all
            select date_str, 'liability', {r('-liability_ma')} from means""",
        **_SHEET,
    ),
)
def _(t):
    return balance.area_series(balance.balance_overview(_clean(t)))
