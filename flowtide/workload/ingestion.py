"""Queries that go through files: flattening, incremental loads, streams, writers.

What they write goes to a fresh folder under the shared scratch folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flowtide.functions.calendar import epoch_seconds
from flowtide.functions.predicates import epoch_range
from flowtide.operators import aggregates, network
from flowtide.schemas import FACTS, as_facts
from flowtide.session import shared_dir
from flowtide.sources import ingest, readers, rewrite, tables
from flowtide.streaming.ingest import FactSink, stream_landed_files
from flowtide.workload.adapters import with_ctes
from flowtide.workload.networks import (
    DOCUMENT_SQL,
    EDGES_SQL,
    NODES_SQL,
    YEARS,
    document_entries,
    history,
    yearly_edges,
    yearly_nodes,
)
from flowtide.workload.registry import query, r


def _scratch(t) -> str:
    return f"{shared_dir(t.spark)}/flowtide-{uuid.uuid4().hex}"


_FACTS = f"select id, chain_name, date, token_name, {r('quantity')} quantity, {r('value_usd')} value_usd"


@query(
    "normalise_headers",
    with_ctes(f"""select id, name, {r('tvl')} tvl, 'default' as type,
                         concat('{{"', category, '":', cast(cast(tvl as bigint) as varchar), '}}') chain_tvls,
                         concat('["', name, '","', slug, '"]') names
                  from protocols"""),
)
def _(t):
    tvl = F.map_from_arrays(F.array("category"), F.array(F.rint("tvl").cast("bigint")))
    headers = t.protocols.select(
        "id", "name", "tvl", "type", tvl.alias("chain_tvls"), F.array("name", "slug").alias("names")
    )
    return ingest.normalise_headers(headers)


_FLATTENED = f"""
    select id, chain_name, date, token_name,
           {r("case when token_name like 'P%' then 0 else quantity end")} quantity, {r('value_usd')} value_usd
    from facts where chain_name <> 'O' or date < (
        select max(date) from facts f where f.id = facts.id and f.chain_name = facts.chain_name)"""


def _documents(t, positions, group):
    """(group, id, value): documents of all chains, dates and tokens of an id; chain O lacks its last quantities, and no token in P has one.

    ``group`` depends on the id alone. Rows are dealt out by it once, before they are added up, and no step behind needs a shuffle.
    """
    keys = ["group", "id"]
    facts = t.unique(positions.withColumn("group", group).repartition("group"), "group")

    def entries(tokens):
        listed = F.collect_list(F.struct("date", tokens.alias("tokens")))
        return F.array_sort(listed, lambda a, b: F.signum(a["date"] - b["date"]).cast("int"))

    amounts = F.map_from_entries(F.collect_list(F.struct("token_name", "value_usd")))
    # quantities are written as texts, some of them no numbers
    text = F.when(F.col("token_name").startswith("P"), "n/a").otherwise(F.col("quantity").cast("string"))
    counts = F.map_from_entries(F.collect_list(F.struct(F.col("token_name"), text)))
    dates = facts.groupBy(*keys, "chain_name", "date").agg(amounts.alias("usd"), counts.alias("qty"))
    chains = dates.groupBy(*keys, "chain_name").agg(entries(F.col("usd")).alias("tokensInUsd"), entries(F.col("qty")).alias("tokens"))
    shorter = F.when(F.col("chain_name") == "O", F.slice("tokens", F.lit(1), F.size("tokens") - 1)).otherwise(F.col("tokens"))
    lists = F.struct("tokensInUsd", shorter.alias("tokens"))
    named = chains.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col("chain_name"), lists))).alias("chainTvls"))
    return named.select(*keys, F.to_json(F.struct("id", "chainTvls")).alias("value"))


@query("flatten_tvl", with_ctes(_FLATTENED))
def _(t):
    """Facts through files: one part of the ids as a document per file, the rest as JSON lines."""
    folder = _scratch(t)
    in_lines = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    _documents(t, t.positions.where(in_lines), F.col("id")).select("value").write.text(f"{folder}/lines")
    _documents(t, t.positions.where(~in_lines), F.col("id")).select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/files")
    both = readers.read_tvl_documents(t.spark, f"{folder}/lines").unionByName(readers.read_tvl_documents(t.spark, f"{folder}/files"))
    return ingest.flatten_tvl(both)


#: Positions whose documents are put together, at most about so many.
_CONCATENATED = 50_000


@query("concatenated_documents", with_ctes(_FLATTENED))
def _(t):
    """The same facts from texts that hold many documents each: side by side on one line, in one array, and with line ends inside."""
    folder = _scratch(t)
    texts = max(12, t.raw("lineitem").count() // _CONCATENATED)
    documents = _documents(t, t.positions, F.pmod(F.xxhash64("id"), F.lit(texts)))
    layout = F.pmod("group", F.lit(3))
    spread = F.when(layout == 2, F.regexp_replace("value", r"([{,])", "$1\n  ")).otherwise(F.col("value"))
    grouped = documents.groupBy("group").agg(F.collect_list(spread).alias("all"))
    joined = F.when(layout == 0, F.array_join("all", " ")).when(layout == 1, F.concat(F.lit("["), F.array_join("all", ","), F.lit("]")))
    joined = joined.otherwise(F.array_join("all", "\n"))
    grouped.select(joined.alias("value"), layout.alias("layout")).write.partitionBy("layout").text(folder)
    return ingest.flatten_tvl(readers.read_tvl_documents(t.spark, folder))


@query(
    "incremental_rows",
    with_ctes(
        f"""{_FACTS} from facts left join stored using (id, chain_name, token_name)
            where latest_date is null or date > latest_date""",
        stored="""select id, chain_name, token_name, max(date) latest_date from facts
                  where date < epoch(date '1998-01-01') and chain_name <> 'O' group by all""",
    ),
)
def _(t):
    stored = t.facts.where((F.col("date") < epoch_seconds("1998-01-01")) & (F.col("chain_name") != "O"))
    return ingest.incremental_rows(t.facts, aggregates.latest_dates(stored))


@query(
    "stream_landed_files",
    with_ctes(
        f"""{_FACTS} from landed l
            where date > coalesce((select max(e.date) from landed e where e.landing < l.landing and e.id = l.id
                                   and e.chain_name = l.chain_name and e.token_name = l.token_name), -1)""",
        landed="""
    select *, case when date >= epoch(date '1998-01-01') and date < epoch(date '1999-01-01') then 2 else 1 end landing
    from tagged_facts""",
    ),
)
def _(t):
    """Two landings, each picked up by a run of the stream; the rows of the second are mostly late for their key."""
    folder = _scratch(t)
    facts = as_facts(t.tagged_facts)
    sink = FactSink(t.spark, f"{folder}/sink", snapshot_every=1, buckets=8).create()
    late = epoch_range(epoch_seconds("1998-01-01"), epoch_seconds("1999-01-01"))
    for landing in (facts.where(~late), facts.where(late)):
        landing.write.mode("append").parquet(f"{folder}/landing")
        stream_landed_files(t.spark, f"{folder}/landing", sink, f"{folder}/checkpoint").awaitTermination()
    return sink.facts()


_UPSERTED = f"""select o_orderkey, o_custkey, o_orderstatus,
               {r("case when o_orderstatus = 'F' then o_totalprice + 1 else o_totalprice end")} o_totalprice,
               o_orderdate, o_orderpriority
        from orders"""


def _halves(t):
    """All orders: the target lacks every third F order, the source brings all of them with a new price."""
    orders = t.raw("orders")
    target = orders.where((F.col("o_orderstatus") != "F") | (F.col("o_orderkey") % 3 != 0))
    return target, orders.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query("upsert", _UPSERTED)
def _(t):
    return tables.upsert(*_halves(t), ["o_orderkey"])


@query("upserted_table", _UPSERTED)
def _(t):
    """The same through a stored table, which is read while it is replaced."""
    folder, name = _scratch(t), f"orders_{uuid.uuid4().hex}"
    target, source = _halves(t)
    tables.create_table(t.spark, name, data=target, cluster_by=["o_orderdate"], path=f"{folder}/table")
    rewrite.upsert_table(source, name, ["o_orderkey"])
    place = tables.table_location(t.spark, name)
    tables.drop_table(t.spark, name)
    return readers.read_parquet(t.spark, place)


@query("refreshed_table", with_ctes(f"select id, name, slug, {r('tvl')} tvl, category, type from protocols"))
def _(t):
    """A dimension that is replaced by a reduced copy of itself after it was stored doubled."""
    folder, name = _scratch(t), f"protocols_{uuid.uuid4().hex}"
    kept = t.protocols.select("id", "name", "slug", "tvl", "category", "type")
    tables.create_table(t.spark, name, data=kept.unionByName(kept), path=f"{folder}/table")
    tables.refresh_table(readers.read_table(t.spark, name).distinct(), name, folder)
    place = tables.table_location(t.spark, name)
    tables.drop_table(t.spark, name)
    return readers.read_parquet(t.spark, place)


@query(
    "refreshed_partitioned_table",
    with_ctes(f"{_FACTS} from facts where date >= epoch(date '1998-01-01') and chain_name <> 'O'"),
)
def _(t):
    """A table partitioned by chain that is replaced by part of itself: a chain goes, and the old dates of the others."""
    folder, name = _scratch(t), f"facts_{uuid.uuid4().hex}"
    tables.create_table(t.spark, name, data=as_facts(t.facts), partition_by=["chain_name"], cluster_by=["date"], path=f"{folder}/table")
    kept = readers.read_table(t.spark, name).where((F.col("date") >= epoch_seconds("1998-01-01")) & (F.col("chain_name") != "O"))
    tables.refresh_table(kept, name, folder)
    stored = readers.read_parquet(t.spark, tables.table_location(t.spark, name), schema=FACTS)
    tables.drop_table(t.spark, name)
    return stored


@query("upserted_partitioned_table", _UPSERTED)
def _(t):
    """The upsert into a table partitioned by status, whose F partition grows; read back through the table."""
    folder, name = _scratch(t), f"orders_{uuid.uuid4().hex}"
    target, source = _halves(t)
    tables.create_table(t.spark, name, data=target, partition_by=["o_orderstatus"], cluster_by=["o_orderkey"], path=f"{folder}/table")
    rewrite.upsert_table(source, name, ["o_orderkey"])
    place, schema = tables.table_location(t.spark, name), t.spark.table(name).schema
    tables.drop_table(t.spark, name)
    return readers.read_parquet(t.spark, place, schema=schema)


@query(
    "deduplicated_table",
    with_ctes(f"select distinct * from ({_FACTS} from facts where date < epoch(date '1998-01-01'))"),
)
def _(t):
    """A stored table without the repeats that a second append of some of its rows made; with a limit first, then all."""
    folder, name = _scratch(t), f"facts_{uuid.uuid4().hex}"
    early = as_facts(t.facts).where(F.col("date") < epoch_seconds("1998-01-01"))
    tables.create_table(t.spark, name, data=early, cluster_by=["date"], path=f"{folder}/table")
    tables.append_table(early.where("id like '%1'"), name)
    rewrite.remove_table_duplicates(t.spark, name, limit=10)
    rewrite.remove_table_duplicates(t.spark, name)
    place = tables.table_location(t.spark, name)
    tables.drop_table(t.spark, name)
    return readers.read_parquet(t.spark, place)


@query("clustered_append", with_ctes(f"{_FACTS} from facts"))
def _(t):
    """A table clustered from its schema on, filled by two appends."""
    folder, name = _scratch(t), f"facts_{uuid.uuid4().hex}"
    tables.create_table(t.spark, name, schema=FACTS, cluster_by=["date", "id"], path=f"{folder}/table")
    old = F.col("date") < epoch_seconds("1997-01-01")
    for part in (t.facts.where(old), t.facts.where(~old)):
        tables.append_table(part, name)
    tables.drop_table(t.spark, name)
    return readers.read_parquet(t.spark, f"{folder}/table", schema=FACTS)


@query("table_lifecycle", with_ctes(f"{_FACTS} from facts"))
def _(t):
    """Create from a schema, append one half, create from data and append the other half, read both back."""
    folder, name = _scratch(t), f"facts_{uuid.uuid4().hex}"
    old = F.col("date") < epoch_seconds("1999-01-01")
    tables.create_table(t.spark, name, schema=FACTS, path=f"{folder}/table")
    tables.append_table(t.facts.where(old), name)
    t.facts.where(~old).write.parquet(f"{folder}/landed")
    tables.append_parquet(t.spark, f"{folder}/landed", name)
    tables.drop_table(t.spark, name)
    return readers.read_parquet(t.spark, f"{folder}/table", schema=FACTS)


@query("clustered_table", with_ctes(f"{_FACTS} from facts"))
def _(t):
    folder, name = _scratch(t), f"facts_{uuid.uuid4().hex}"
    tables.create_table(t.spark, name, data=as_facts(t.facts), cluster_by=["date", "id"], path=f"{folder}/table")
    tables.drop_table(t.spark, name)
    return readers.read_parquet(t.spark, f"{folder}/table")


#: Positions of one of the files to be compacted, at most about so many.
_SMALL_FILE = 500_000


@query("compact_parquet", with_ctes(f"{_FACTS} from facts"))
def _(t):
    folder = _scratch(t)
    small = max(16, t.raw("lineitem").count() // _SMALL_FILE)
    as_facts(t.facts).repartition(small, "id", "date").write.parquet(f"{folder}/small")
    tables.compact_parquet(t.spark, [f"{folder}/small"], f"{folder}/combined", 2)
    return readers.read_parquet(t.spark, f"{folder}/combined")


@query(
    "latest_dates_csv",
    with_ctes("select id, chain_name, token_name, max(date) latest_date from positions group by all"),
)
def _(t):
    folder = _scratch(t)
    tables.write_latest_dates(t.positions, folder)
    schema = "id string, chain_name string, token_name string, latest_date bigint"
    return t.spark.read.schema(schema).option("header", True).csv(folder)


@query(
    "edges_csv",
    with_ctes(f"select epoch_ns(time) as time, source, target, {r('size')} size from edges", **YEARS, edges=EDGES_SQL.format(1000)),
)
def _(t):
    folder = _scratch(t)
    tables.write_csv(yearly_edges(t), folder)
    return readers.read_edges(t.spark, folder, nanoseconds=True)


@query(
    "nodes_csv",
    with_ctes(
        f"select epoch_ns(time) as time, id, {r('size')} size, type from named", **YEARS, named=NODES_SQL.format(1000)
    ),
)
def _(t):
    folder = _scratch(t)
    tables.write_csv(yearly_nodes(t), folder)
    return readers.read_nodes(t.spark, folder, nanoseconds=True)


@query("network_snapshots", with_ctes(DOCUMENT_SQL.format("strftime(n.period, '%Y-%m-%d')", "date"), **YEARS))
def _(t):
    """Every entry of every node and link, read back from the snapshot files."""
    folder = _scratch(t)
    tables.write_snapshots(network.network_document(history(t, "year")), folder)
    stored = t.spark.read.schema("part string, json string, date string").json(folder)
    return document_entries(stored, "date")


@query("saved_mapping", with_ctes("select * from owners", **YEARS))
def _(t):
    return tables.load_or_build_mapping(t.spark, _scratch(t), lambda: t.mapping).token_map
