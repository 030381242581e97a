"""Queries over the token mapping and the value-flow networks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flowtide.functions.calendar import epoch_seconds
from flowtide.functions.predicates import epoch_range
from flowtide.operators import changes, community, flows, mapping, network, similarity, subgraph
from flowtide.session import ensure_checkpoints, shared_dir
from flowtide.sources.history import read_history, update_history, write_history
from flowtide.workload.adapters import with_ctes
from flowtide.workload.positions import FROM_1996, HISTORY, YEAR_1996, YEARLY_HISTORY, changes_sql, spans_sql
from flowtide.workload.registry import query, r

_REV_MAP = """
    select token, arg_min(id, k) id from (
        select token, id, row_number() over (order by total_tvls, id) k
        from (select assetToken token, id, total_tvls from protocols union all select symbol, id, total_tvls from protocols)
        where token is not null and token <> '-')
    group by token"""


def _mapping_sql(facts: str) -> dict[str, str]:
    return {
        "rev": _REV_MAP,
        "classes": f"""
    select token_name, case when any_value(rev.id) is not null then 'MAP' when token_name like '%LP%' then 'LP'
                            when token_name like '%UNKNOWN%' then 'UNKNOWN' when token_name like '%-%' then 'OTHER'
                            else 'PRIMARY' end as class,
           count(*) frequency, any_value(rev.id) owner_id
    from {facts} left join rev on token = token_name where token_name is not null group by token_name""",
        "primary_owner": """
    select token_name, id primary_id from primary_map join protocols on name = protocol_name
    qualify row_number() over (partition by token_name order by total_tvls desc, id) = 1""",
        "owners": """
    select token_name, class, frequency,
           coalesce(owner_id, case when class = 'PRIMARY' then coalesce(primary_id, token_name) else class end) mapped_id
    from classes left join primary_owner using (token_name)""",
        "info": """
    select id, name, coalesce(broad, 'Unknown') category
    from protocols left join category_map on detailed = protocols.category""",
    }


_RULES = _mapping_sql("positions")
_TAGGED = _mapping_sql("tagged_facts")


@query("total_tvls", with_ctes(f"select id, {r('total_tvls')} total_tvls from protocols"))
def _(t):
    return mapping.with_total_tvls(t.protocols).select("id", "total_tvls")


@query("reverse_map", with_ctes("select token, id from rev", **_RULES))
def _(t):
    return t.mapping.rev_map


def _tagged_classes(t):
    return mapping.token_classes(t.tagged_facts, t.mapping.rev_map)


@query("token_classes", with_ctes("select * from classes", **_TAGGED))
def _(t):
    return _tagged_classes(t)


@query("primary_tokens", with_ctes("select token_name, frequency from classes where class = 'PRIMARY'", **_TAGGED))
def _(t):
    return mapping.primary_tokens(_tagged_classes(t))


@query("primary_owners", with_ctes("select * from primary_owner", **_RULES))
def _(t):
    return mapping.primary_owners(t.primary_map, mapping.with_total_tvls(t.protocols))


@query("rule_token_map", with_ctes("select * from owners", **_TAGGED))
def _(t):
    owners = mapping.primary_owners(t.primary_map, mapping.with_total_tvls(t.protocols))
    return mapping.rule_token_map(_tagged_classes(t), owners)


@query("id_info", with_ctes("select * from info", **_RULES))
def _(t):
    return t.mapping.id_info


@query(
    "lookup_tokens",
    with_ctes("""select id, f.token_name, mapped_id token_id, count(*) row_count
                 from tagged_facts f left join owners on owners.token_name = f.token_name and class <> 'OTHER'
                 group by all""", **_TAGGED),
)
def _(t):
    owners = mapping.primary_owners(t.primary_map, mapping.with_total_tvls(t.protocols))
    token_map = mapping.rule_token_map(_tagged_classes(t), owners).where(F.col("class") != "OTHER")
    found = mapping.lookup_tokens(t.tagged_facts, token_map)
    return found.groupBy("id", "token_name", "token_id").agg(F.count("*").alias("row_count"))


# unit TF-IDF vectors of `docs(kind, doc, text)` and the best protocol of every token
_TERM_LIST = "unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'))"


def _similarity_sql(docs: str, ranks: str) -> dict[str, str]:
    return {
        "docs": docs,
        "ranks": ranks,
        "counts": f"select kind, doc, term, count(*) tf from (select kind, doc, {_TERM_LIST} term from docs) group by all",
        "idfs": """
    select term, ln((1.0 + (select count(*) from docs)) / (1.0 + count(*))) + 1 idf from counts group by term""",
        "raw": "select kind, doc, term, tf * idf w from counts join idfs using (term)",
        "vectors": "select kind, doc, term, w / sqrt(sum(w * w) over (partition by kind, doc)) w from raw",
        "scores": """
    select a.doc token_name, b.doc id, sum(a.w * b.w) score from vectors a join vectors b using (term)
    where a.kind = 'token' and b.kind = 'protocol' group by all""",
        "best": """
    select token_name, id, name, score from scores join ranks using (id)
    qualify row_number() over (partition by token_name order by round(score, 12) desc, total_tvls desc, id) = 1""",
    }


_SUPPLIER_DOCS = _similarity_sql(
    """select 'token' kind, token_name doc, token_name text from classes union all
       select 'protocol', id, concat_ws(' ', id, name, slug, cast(tvl as decimal(38, 2)), category, type, coalesce(symbol, ''),
                                         assetToken, concat('{''Ethereum'': ', id, ', ''Polygon'': ',
                                                            cast(round(tvl * 100) as bigint), '}'),
                                         cast(total_tvls as decimal(38, 2)))
       from protocols""",
    "select id, name, total_tvls from protocols",
)


def _best(threshold: float) -> str:
    return f"select token_name, id, name, {r('score')} score from best where score >= {threshold}"


@query("similarity_matches", with_ctes(_best(0.3), **_TAGGED, **_SUPPLIER_DOCS))
def _(t):
    tokens = _tagged_classes(t).select("token_name")
    ranked = mapping.with_total_tvls(t.protocols)
    return similarity.similarity_matches(tokens, ranked, 0.3)


@query(
    "overlay_matches",
    with_ctes(
        """select token_name, class, frequency, coalesce(case when score >= 0.3 then id end, mapped_id) mapped_id
           from owners left join best using (token_name)""",
        **_TAGGED,
        **_SUPPLIER_DOCS,
    ),
)
def _(t):
    return mapping.update_mapping(
        t.tagged_facts, t.protocols, t.category_map, t.primary_map, 0.3
    ).token_map


@query(
    "similarity_matches_documents",
    with_ctes(
        _best(0.4),
        **_similarity_sql(
            """select distinct 'token' kind, text doc, text from benchmark union all
               select 'protocol', cast(doc_id as varchar), text from documents""",
            "select cast(doc_id as varchar) id, source as name, cast(n_chars as double) total_tvls from documents",
        ),
    ),
)
def _(t):
    tokens = t.raw("benchmark").select(F.col("text").alias("token_name")).distinct()
    texts = t.raw("documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("name"),
        "text",
        F.col("n_chars").cast("double").alias("total_tvls"),
    )
    return similarity.similarity_matches(tokens, texts, 0.4, ["text"])


def network_sql(period: bool = False, owners: str = "owners") -> dict[str, str]:
    """Flows of ``changes`` and the nodes and links they make up."""
    p = "period, " if period else ""
    pair = f"{p}source, target"
    return {
        "flows": f"""
    select {p}case when usd_change < 0 then c.id else o.mapped_id end from_node,
           case when usd_change < 0 then o.mapped_id else c.id end to_node, chain_name,
           case when usd_change < 0 then qty end qty_from, case when usd_change >= 0 then qty end qty_to,
           case when usd_change < 0 then usd end usd_from, case when usd_change >= 0 then usd end usd_to,
           c.token_name, abs(qty_change) qty_flow, abs(usd_change) usd_flow
    from changes c left join {owners} o on o.token_name = c.token_name""",
        "ends": f"""
    select {p}from_node id, token_name, usd_from amount from flows union all
    select {p}to_node, token_name, usd_to from flows""",
        "held": f"select {p}id, token_name token, sum(amount) amount from ends where amount is not null group by all",
        "nodes": f"""
    select {p}id, case when id is null then 0 else coalesce(sum(amount), 0) end size from ends group by {p}id""",
        "ordered": f"""
    select {p}coalesce(from_node, '') < coalesce(to_node, '') forward, from_node, to_node, token_name token, usd_flow
    from flows""",
        "canonical": f"""
    select {p}case when forward then from_node else to_node end source,
           case when forward then to_node else from_node end target, token,
           coalesce(sum(case when forward then usd_flow else -usd_flow end), 0) amount
    from ordered group by all""",
        "net": f"select *, sum(amount) over (partition by {pair}) net from canonical",
        "carried": f"""
    select {p}case when net < 0 then target else source end source, case when net < 0 then source else target end target,
           token, case when net < 0 then -amount else amount end amount
    from net""",
        "links": f"select {pair}, abs(sum(amount)) size from carried group by {pair}",
    }


_YEAR = {"spans": spans_sql("facts", YEAR_1996), "changes": changes_sql(), **_RULES}
_YEAR_NETWORK = {**_YEAR, **network_sql()}
_OPEN = {**_YEAR, "open_owners": "select token token_name, id mapped_id from rev", **network_sql(owners="open_owners")}
_MONTHS = {**HISTORY, **_RULES, **network_sql(True)}
YEARS = {**YEARLY_HISTORY, **_RULES, **network_sql(True)}


def _year_flows(t):
    folded = changes.compare_periods(t.facts, t.protocols, "1996-01-01", "year", unique=True, folded=True)
    return flows.value_flows(folded, t.mapping.token_map)


def _open_flows(t):
    """Only symbols have owners, so other tokens flow from and to the unmapped node."""
    folded = changes.compare_periods(t.facts, t.protocols, "1996-01-01", "year", unique=True, folded=True)
    return flows.value_flows(
        folded, t.mapping.rev_map.select(F.col("token").alias("token_name"), F.col("id").alias("mapped_id"))
    )


def history(t, granularity: str = "month"):
    return network.historical_flows(t.facts, t.protocols, t.mapping.token_map, granularity, "1996-01-01", unique=True)


_FLOWS = f"""select from_node, to_node, chain_name, {r('qty_from')} qty_from, {r('qty_to')} qty_to, {r('usd_from')} usd_from,
                    {r('usd_to')} usd_to, token_name, {r('qty_flow')} qty_flow, {r('usd_flow')} usd_flow from flows"""


@query("value_flows", with_ctes(_FLOWS, **_OPEN))
def _(t):
    return _open_flows(t).drop("copies")


_HELD = f"select id, token, {r('amount')} amount from held"
_NODES = f"select id, {r('size')} size from nodes"
_LINKS = f"select source, target, {r('size')} size from links"
_CARRIED = f"select source, target, token, {r('amount')} amount from carried"


@query("network_node_ids", with_ctes("select id from nodes", **_OPEN))
def _(t):
    return network.node_ids(_open_flows(t))


@query("network_node_composition", with_ctes(_HELD, **_YEAR_NETWORK))
def _(t):
    return network.node_composition(_year_flows(t))


@query("network_nodes", with_ctes(_NODES, **_YEAR_NETWORK))
def _(t):
    return network.node_sizes(_year_flows(t))


@query("network_nodes_unmapped", with_ctes(_NODES, **_OPEN))
def _(t):
    return network.node_sizes(_open_flows(t))


@query(
    "canonical_links",
    with_ctes(f"select source, target, token, {r('amount')} amount from canonical", **_YEAR_NETWORK),
)
def _(t):
    return network.canonical_links(_year_flows(t))


@query("network_links", with_ctes(_LINKS, **_YEAR_NETWORK))
def _(t):
    return network.links(_year_flows(t))


@query("network_links_unmapped", with_ctes(_LINKS, **_OPEN))
def _(t):
    return network.links(_open_flows(t))


@query("network_link_composition", with_ctes(_CARRIED, **_YEAR_NETWORK))
def _(t):
    return network.link_composition(_year_flows(t))


@query("network_link_composition_unmapped", with_ctes(_CARRIED, **_OPEN))
def _(t):
    return network.link_composition(_open_flows(t))


@query(
    "network_links_fan_out",
    with_ctes(
        _LINKS, **{**_YEAR_NETWORK, "spans": spans_sql("positions", YEAR_1996)}
    ),
)
def _(t):
    folded = changes.compare_periods(t.positions, t.protocols, "1996-01-01", "year", folded=True)
    return network.links(flows.value_flows(folded, t.mapping.token_map))


@query(
    "network_document_nodes",
    with_ctes(f"""select n.id, {r('any_value(n.size)')} size, token, {r('sum(amount)')} amount
                  from nodes n left join held on held.id is not distinct from n.id group by n.id, token""", **_YEAR_NETWORK),
)
def _(t):
    nodes = network.network_nodes(_year_flows(t))
    return nodes.select("id", "size", F.explode_outer("composition").alias("e")).select("id", "size", "e.token", "e.amount")


@query(
    "network_document_links",
    with_ctes(f"""select source, target, {r('abs(sum(amount) over (partition by source, target))')} size, token,
                         {r('amount')} amount from carried""", **_YEAR_NETWORK),
)
def _(t):
    edges = network.network_links(_year_flows(t))
    return edges.select("source", "target", "size", F.explode("composition").alias("e")).select(
        "source", "target", "size", "e.token", "e.amount"
    )


# every entry of every node's and link's composition
DOCUMENT_SQL = f"""
    select {{0}} {{1}}, 'nodes' part, n.id, cast(null as varchar) source, cast(null as varchar) target,
           {r('n.size')} size, token, {r('amount')} amount
    from nodes n left join (select period, id, token, sum(amount) amount from held group by all) h
    on h.period = n.period and h.id is not distinct from n.id
    union all
    select {{0}}, 'links', null, source, target, {r('abs(sum(amount) over (partition by n.period, source, target))')}, token,
           {r('amount')} from carried n"""


def document_entries(document, period: str):
    """The JSON lines of a network document parsed again, one row per entry of a composition."""
    fields = "id string, source string, target string, size double, composition map<string,double>"
    parsed = document.select(period, "part", F.from_json("json", fields, {"mode": "FAILFAST"}).alias("j"))
    heads = parsed.where("part in ('nodes', 'links')").select(period, "part", "j.id", "j.source", "j.target", "j.size")
    part = F.when(F.col("part") == "node_tokens", "nodes").otherwise("links")
    chunks = parsed.where("part like '%_tokens'").select(
        F.col(period).alias("_p"), part.alias("_part"), *[F.col(f"j.{c}").alias(f"_{c}") for c in ("id", "source", "target")],
        F.explode("j.composition").alias("token", "amount"))
    same = (F.col(period) == F.col("_p")) & (F.col("part") == F.col("_part"))
    for c in ("id", "source", "target"):
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return heads.join(chunks, same, "left").select(period, "part", "id", "source", "target", "size", "token", "amount")


@query("network_document", with_ctes(DOCUMENT_SQL.format("n.period", "period"), **YEARS))
def _(t):
    return document_entries(network.network_document(history(t, "year")), "period")


@query("historical_network_nodes", with_ctes(f"select period, id, {r('size')} size from nodes", **_MONTHS))
def _(t):
    return network.node_sizes(history(t))


@query("historical_network_links", with_ctes(f"select period, source, target, {r('size')} size from links", **_MONTHS))
def _(t):
    return network.links(history(t))


@query("updated_history", with_ctes(f"select period, source, target, {r('size')} size from links", **_MONTHS))
def _(t):
    """Links of every month, stored without some facts of one month and brought up to date when those arrive."""
    path = f"{shared_dir(t.spark)}/flowtide-{uuid.uuid4().hex}/history"
    late = epoch_range(epoch_seconds("1997-03-10"), epoch_seconds("1997-04-01")) & F.col("id").like("%1")

    def build(facts):
        return network.links(network.historical_flows(facts, t.protocols, t.mapping.token_map, "month", "1996-01-01", unique=True))

    whole = build(t.facts.where(~late))
    write_history(whole, path)
    update_history(t.facts, t.facts.where(late), path, "month", build)
    return read_history(whole, path)


@query(
    "historical_network_link_composition",
    with_ctes(f"select period, source, target, token, {r('amount')} amount from carried", **_MONTHS),
)
def _(t):
    return network.link_composition(history(t))


EDGES_SQL = """
    select period as time, coalesce(s.name, source, 'None') source, coalesce(d.name, target, 'None') target, size
    from links left join info s on s.id = source left join info d on d.id = target where size > {}"""
NODES_SQL = """
    select period as time, coalesce(name, 'Unknown') id, size, coalesce(category, 'Unknown') as type
    from nodes left join info using (id) where size > {}"""


@query(
    "historical_edges",
    with_ctes(f"select time, source, target, {r('size')} size from edges", **_MONTHS, edges=EDGES_SQL.format(1000)),
)
def _(t):
    return network.historical_edges(history(t), t.mapping.id_info, 1000)


@query(
    "historical_nodes",
    with_ctes(f"select time, id, {r('size')} size, type from named", **_MONTHS, named=NODES_SQL.format(1000)),
)
def _(t):
    return network.historical_nodes(history(t), t.mapping.id_info, 1000)


_SNAPSHOT_SPANS = """
    select *, min(date) over k first_date, max(date) over k last_date, count(*) over k n
    from (select f.*, period from facts f join windows on date between lo and hi)
    where chain_name not like '%borrowed%' window k as (partition by id, chain_name, token_name, period)"""
_WINDOWS = """
    select cast(d as date) period, epoch(d) lo, epoch(d + interval 1 year) hi
    from generate_series(timestamp '1996-01-01', timestamp '2000-01-01', interval 1 year) s(d)"""


@query(
    "snapshot_links",
    with_ctes(
        f"select period, source, target, {r('size')} size from links",
        windows=_WINDOWS,
        spans=_SNAPSHOT_SPANS,
        changes=changes_sql(True),
        **_RULES,
        **network_sql(True),
    ),
)
def _(t):
    snapshots = changes.period_snapshots(
        t.facts, t.protocols, "1996-01-01", "2000-01-01", "year", unique=True, folded=True
    )
    return network.links(flows.value_flows(snapshots, t.mapping.token_map))


_TOP = {
    "named_nodes": "select coalesce(name, n.id) id, size from nodes n left join protocols p on p.id = n.id",
    "named_links": """
    select coalesce(s.name, source) source, coalesce(d.name, target) target, size
    from links left join protocols s on s.id = source left join protocols d on d.id = target""",
    "top": "select * from named_nodes order by size desc, id nulls last limit 20",
    "inside": """
    select * from named_links where source in (select id from top) and target in (select id from top)""",
}


def _scaled_sql(low: int, high: int) -> str:
    share = "(size - min(size) over ()) / (max(size) over () - min(size) over ())"
    return r(f"case when max(size) over () > min(size) over () then {share} * {high - low} + {low} else {low} end")


def _top(t):
    made = _year_flows(t)
    return subgraph.top_network(network.node_sizes(made), network.links(made), t.protocols, 20)


@query(
    "top_network_nodes",
    with_ctes(f"select id, {r('size')} size, {_scaled_sql(10, 30)} visual_size from top", **_YEAR_NETWORK, **_TOP),
)
def _(t):
    return _top(t).nodes


@query(
    "top_network_edges",
    with_ctes(
        f"select source, target, {r('size')} size, {_scaled_sql(1, 5)} visual_size from inside", **_YEAR_NETWORK, **_TOP
    ),
)
def _(t):
    return _top(t).edges


_YEARLY_EDGES = {**YEARS, "edges": EDGES_SQL.format(1000), "named": NODES_SQL.format(1000)}


def _yearly_flows(t):
    """Written once: edges and nodes of a query both follow from them."""
    if "yearly flows" not in t.made:
        ensure_checkpoints(t.spark)
        t.made["yearly flows"] = history(t, "year").checkpoint()
    return t.made["yearly flows"]


def yearly_edges(t):
    return network.historical_edges(_yearly_flows(t), t.mapping.id_info, 1000)


def yearly_nodes(t):
    return network.historical_nodes(_yearly_flows(t), t.mapping.id_info, 1000)


@query(
    "edge_weights",
    with_ctes(f"select time, source, target, {r('ln(1 + max(size))')} weight from edges group by 1, 2, 3", **_YEARLY_EDGES),
)
def _(t):
    return subgraph.edge_weights(yearly_edges(t))


_SLICE_NODES = """
    select time, source node from edges where source <> target union select time, target from edges where source <> target
    union select time, source from edges"""


@query(
    "communities",
    with_ctes(
        f"""select e.time, node, {r('max(size)')} size, true label_is_a_node
            from members e left join named n on n.time = e.time and n.id = e.node group by 1, 2""",
        **_YEARLY_EDGES,
        members=_SLICE_NODES,
    ),
)
def _(t):
    """Labels are free to differ; every node of a slice has one, and it is a node of that slice."""
    labels = community.label_propagation(subgraph.edge_weights(yearly_edges(t)))
    members = community.community_members(labels, yearly_nodes(t))
    known = labels.select("time", F.col("node").alias("community"), F.lit(True).alias("known"))
    joined = members.join(known, ["time", "community"], "left")
    return joined.select("time", "node", "size", F.coalesce("known", F.lit(False)).alias("label_is_a_node"))


@query(
    "community_quality",
    with_ctes("select distinct time, true no_worse_than_one_community from edges", **_YEARLY_EDGES),
)
def _(t):
    weights = subgraph.edge_weights(yearly_edges(t))
    quality = community.partition_quality(weights, community.label_propagation(weights))
    return quality.select("time", (F.col("modularity") > -1e-9).alias("no_worse_than_one_community"))


@query("updated_mapping", with_ctes("select * from owners", **YEARS))
def _(t):
    """Built anew, where the other queries read the saved one."""
    return mapping.update_mapping(t.positions, t.protocols, t.category_map, t.primary_map).token_map


_CLIQUES = {
    "whole": "select s_suppkey k, s_suppkey // 8 g, cast(s_suppkey // 96 as varchar) as time from supplier"
    " where s_suppkey // 8 in (select s_suppkey // 8 from supplier group by 1 having count(*) = 8)",
    "weights": """
    select a.time, cast(a.k as varchar) source, cast(b.k as varchar) target, a.g g, b.g h, 10.0 weight
    from whole a join whole b on a.g = b.g and a.k < b.k
    union all select a.time, cast(a.k as varchar), cast(b.k as varchar), a.g, b.g, 0.5
    from whole a join whole b on a.time = b.time and b.k = a.k + 8 where a.k % 8 = 0""",
    "totals": "select time, sum(weight) total, coalesce(sum(weight) filter (g = h), 0) inside from weights group by 1",
    "strengths": "select time, c, sum(weight) strength from (select time, g c, weight from weights union all select time, h, weight from weights) group by all",
}


def _clique_weights(t):
    """Suppliers in cliques of eight, twelve cliques a slice; light edges join the firsts of neighbouring cliques."""
    k = F.col("s_suppkey")
    nodes = t.raw("supplier").select(k.alias("k"), F.floor(k / 8).alias("g"), F.floor(k / 96).cast("string").alias("time"))
    nodes = nodes.join(nodes.groupBy("g").count().where("count = 8").select("g"), "g")

    def pairs(other, on, weight):
        both = nodes.alias("a").join(other.alias("b"), on)
        ends = [F.col(f"{side}.k").cast("string").alias(name) for side, name in (("a", "source"), ("b", "target"))]
        return both.select("a.time", *ends, F.lit(weight).alias("weight"))

    firsts = nodes.where("k % 8 = 0")
    inner = pairs(nodes, F.expr("a.g = b.g and a.k < b.k"), 10.0)
    return inner.unionByName(pairs(firsts, F.expr("a.time = b.time and b.k = a.k + 8"), 0.5))


@query(
    "clique_communities",
    with_ctes("select time, cast(k as varchar) node, min(cast(k as varchar)) over (partition by g) community from whole", **_CLIQUES),
)
def _(t):
    """Label propagation finds the planted cliques; each is named after its least node here."""
    labels = community.label_propagation(_clique_weights(t))
    least = labels.groupBy("time", "community").agg(F.min("node").alias("least"))
    return labels.join(least, ["time", "community"]).select("time", "node", F.col("least").alias("community"))


@query(
    "clique_quality",
    with_ctes(
        f"""select t.time, count(*) communities, {r('any_value(inside / total)')} coverage,
                   {r('any_value(inside / total) - sum((strength / (2 * total)) ** 2)')} modularity
            from totals t join strengths s on s.time = t.time group by t.time""",
        **_CLIQUES,
    ),
)
def _(t):
    weights = _clique_weights(t)
    return community.partition_quality(weights, community.label_propagation(weights))


# sectors stand in for communities here, so that SQL can follow
_COMMUNITIES = {
    **_YEARLY_EDGES,
    "best": """
    select time, type, row_number() over (partition by time order by sum(size) desc, type) community_rank
    from named group by 1, 2 qualify community_rank <= 2""",
    "members": """
    select time, type as community, community_rank, id node, size from named join best using (time, type)
    qualify row_number() over (partition by time, type order by size desc, id) <= 10""",
}


def _communities(t):
    members = yearly_nodes(t).select("time", F.col("type").alias("community"), F.col("id").alias("node"), "size")
    return subgraph.top_communities(members, yearly_edges(t), "1998-01-01", 2, 10)


@query(
    "top_community_nodes",
    with_ctes(f"""select time, community, community_rank, node, {r('size')} size, {r('sqrt(size) / 10000')} visual_size,
                         time = timestamp '1998-01-01' is_shock from members""", **_COMMUNITIES),
)
def _(t):
    return _communities(t).nodes


@query(
    "top_community_edges",
    with_ctes(f"""select e.time, s.community, e.source, e.target, {r('e.size')} size,
                         {r('sqrt(e.size) / 10000 * 2')} visual_weight
                  from edges e join members s on s.time = e.time and s.node = e.source
                  join members d on d.time = e.time and d.node = e.target and d.community = s.community""", **_COMMUNITIES),
)
def _(t):
    return _communities(t).edges


_RINGS = """
    select s_suppkey k, s_suppkey // 8 g from supplier where s_suppkey // 8 in (
        select s_suppkey // 8 from supplier group by 1 having count(*) = 8)"""


@query(
    "directed_communities",
    f"""with rings as ({_RINGS})
        select cast(g // 12 as varchar) as time, cast(k as varchar) node, min(cast(k as varchar)) over (partition by g) community
        from rings""",
)
def _(t):
    """Suppliers in directed rings of eight, twelve rings a slice; an edge leads from the first of a ring to the first of the next."""
    k = F.col("s_suppkey")
    nodes = t.raw("supplier").select(F.floor(k / 8).alias("g"), (k % 8).alias("i"), F.floor(k / 96).cast("string").alias("time"))
    full = nodes.groupBy("g").count().where("count = 8").select("g")
    nodes = nodes.join(full, "g")

    def name(g, i):
        return (g * 8 + i).cast("string")

    ring = nodes.withColumn("d", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        "time", name(F.col("g"), F.col("i")).alias("source"), name(F.col("g"), (F.col("i") + F.col("d")) % 8).alias("target"), F.lit(1.0).alias("weight"))
    firsts = nodes.where("i = 0").select("time", "g")
    after = firsts.select("time", F.col("g").alias("h")).join(firsts, "time").where("h = g + 1")
    bridge = after.select("time", name(F.col("g"), F.lit(0)).alias("source"), name(F.col("h"), F.lit(0)).alias("target"), F.lit(1.0).alias("weight"))
    return community.directed_communities(ring.unionByName(bridge))
