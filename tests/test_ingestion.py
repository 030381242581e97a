import json
import os
from datetime import datetime, timezone
from urllib.parse import unquote

import pytest
from conftest import rows
from pyspark.sql import functions as F

from flowtide.functions.calendar import bucket
from flowtide.operators.aggregates import latest_dates
from flowtide.operators.lookup import category_map_frame
from flowtide.operators.mapping import Mapping
from flowtide.schemas import FACTS
from flowtide.sources import ingest, readers, rewrite, tables
from flowtide.sources.documents import document_bodies, document_texts
from flowtide.sources.history import read_history, update_history, write_history
from flowtide.streaming.ingest import FactSink, stream_landed_files


def facts(spark, *values):
    """Rows ``(token, date)`` of one protocol and chain."""
    return spark.createDataFrame([("7", "E", d, t, 1.0, 1.0) for t, d in values], FACTS)


def document(id, chains):
    return json.dumps({"id": id, "chainTvls": chains})


def test_flatten_pairs_by_position_and_cuts_the_longer_list(spark, tmp_path):
    usd = [{"date": 100, "tokens": {"A": 1.5, "B": 2}}, {"date": 200, "tokens": {"A": 3}}]
    chains = {"E": {"tokensInUsd": usd, "tokens": [{"date": 100, "tokens": {"A": 10}}]}, "F": {"tokensInUsd": usd}}
    (tmp_path / "7.json").write_text(document("7", chains))
    got = ingest.flatten_tvl(readers.read_tvl_documents(spark, str(tmp_path)))
    assert got.columns == FACTS.names
    assert rows(got) == [("7", "E", 100, "A", 10.0, 1.5), ("7", "E", 100, "B", 0.0, 2.0)]


def test_flatten_takes_the_last_of_repeated_keys_and_big_integers(spark, tmp_path):
    text = (
        '{"id": "7", "chainTvls": {"E": {"tokensInUsd": [{"date": 1, "tokens": {"A": 1, "A": 2}}], '
        '"tokens": [{"date": 1, "tokens": {"A": 3, "A": 123456789012345678901234567890}}]}}}'
    )
    (tmp_path / "7.json").write_text(text)
    got = ingest.flatten_tvl(readers.read_tvl_documents(spark, str(tmp_path)))
    assert rows(got, "value_usd", "quantity") == [(2.0, 123456789012345678901234567890.0)]


def test_documents_of_both_layouts_lose_nothing(spark, tmp_path):
    def entry(amount):
        return {"E": {"tokensInUsd": [{"date": 1, "tokens": {"A": amount}}], "tokens": [{"date": 1, "tokens": {"A": "x"}}]}}

    texts = [document(str(i), entry(a)) for i, a in enumerate((1, "12.5", None, "none"))]
    (tmp_path / "all.json").write_text("\n".join(texts) + "\n")
    got = ingest.flatten_tvl(readers.read_tvl_documents(spark, str(tmp_path / "all.json")))
    assert rows(got, "id", "value_usd", "quantity") == [("0", 1.0, 0.0), ("1", 12.5, 0.0), ("2", 0.0, 0.0), ("3", 0.0, 0.0)]
    (tmp_path / "pretty.json").write_text(json.dumps(json.loads(texts[1]), indent=2))
    assert readers.read_tvl_documents(spark, str(tmp_path / "pretty.json")).count() == 1
    (tmp_path / "bad.json").write_text('{"id": "1", "chainTvls": {')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_tvl_documents(spark, str(tmp_path / "bad.json")).collect()


TRICKY = [{"id": str(i), "s": t} for i, t in enumerate(['}{"', "a\\", '\\"}', "[{]", "x\ny", "", "é}日", '{"id": 1}{', "},{", "\\\\"])]


@pytest.mark.parametrize("blocks", ["1000000", "64"])
def test_documents_are_found_in_any_layout(spark, tmp_path, blocks):
    """Small blocks cut files into many slices, in strings and between documents; every layout gives all documents in order."""
    dumps = [json.dumps(d, ensure_ascii=False) for d in TRICKY]
    pretty = [json.dumps(d, indent=1) for d in TRICKY]
    layouts = {
        "side by side": "".join(dumps), "blanks": " ".join(dumps), "lines": "\n".join(dumps) + "\n", "array": json.dumps(TRICKY),
        "pretty": json.dumps(TRICKY, indent=2), "pretties": "\r\n\r\n".join(pretty), "two arrays": json.dumps(TRICKY[:4]) + "\n" + json.dumps(TRICKY[4:]),
        "commas": ",".join(dumps), "two on a line": "\n".join(a + " " + b for a, b in zip(dumps[::2], dumps[1::2], strict=True)),
    }
    for name, text in layouts.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "blank.json").write_text(" \n")
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, blocks)
    try:
        found = document_texts(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set(setting, before)
    got = {}
    for r in sorted(found, key=lambda r: r.place):
        got.setdefault(r.file, []).append(json.loads(r.text))
    assert sorted(unquote(f).rsplit("/", 1)[1] for f in got) == sorted(f"{n}.json" for n in layouts)
    assert all(v == TRICKY for v in got.values())


@pytest.mark.parametrize(
    "text", ['{"a": 1', '{"a": {"b": 1}', '{"a": 1} junk {"b": 2}', '{"a": 1}}', 'junk', '[{"a": 1}', '{"a": "x}', '{"a": 1} {"b"', '1 {"a": 1}', '{"a": 1}]']
)
def test_what_is_no_document_is_an_error(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        document_texts(spark, str(tmp_path)).collect()


def test_a_large_file_is_read_in_many_tasks(spark, tmp_path):
    with open(tmp_path / "one_line.json", "w") as file:
        file.write("[" + ",".join('{"id": "%d", "chainTvls": {}}' % i for i in range(60_000)) + "]")
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "200000")
    try:
        lines = spark.read.text(str(tmp_path), lineSep="}")
        assert lines.rdd.getNumPartitions() >= 8 and lines.agg({"value": "count"}).first()[0] > 100_000
        found = document_texts(spark, str(tmp_path))
        assert found.agg(F.count("*"), F.max("place"), F.countDistinct("text")).first()[:] == (60_000, 59_999, 60_000)
    finally:
        spark.conf.set(setting, before)


def test_whole_documents_are_not_shuffled(spark, tmp_path):
    """Only fragments of documents that cross the slices of a file meet other rows."""
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text("[" + ",".join(document(f"{name}{i}", {}) for i in range(500)) + "]")
    found = document_bodies(spark, str(tmp_path))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.agg(F.countDistinct("text"), F.countDistinct("file", "block", "at")).first()[:] == (1000, 1000)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1000")
    try:
        split = readers.read_tvl_documents(spark, str(tmp_path))
        assert sorted(r.id for r in split.collect()) == sorted(f"{n}{i}" for n in "ab" for i in range(500))
    finally:
        spark.conf.set(setting, before)


def test_documents_of_an_id_are_made_behind_one_shuffle(spark):
    """One text holds the ids of a group, and rows are dealt out once: no step adds up, sorts or joins them behind another shuffle."""
    from flowtide.workload.adapters import Tables
    from flowtide.workload.ingestion import _documents

    t = Tables(spark, "unused")
    positions = spark.range(1000).selectExpr("cast(id % 20 as string) id", "'E' chain_name", "cast(id % 7 as bigint) date", "concat('T', id % 3) token_name", "1.0D quantity", "2.0D value_usd")
    made = _documents(t, positions, F.pmod(F.xxhash64("id"), F.lit(4)))
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert made.count() == 20 and made.select("group").distinct().count() <= 4


def test_compacted_files_have_a_largest_size(spark, tmp_path):
    small, rows_in = f"{tmp_path}/small", 20_000
    spark.range(rows_in).selectExpr("id", "xxhash64(id) v").repartition(16).write.parquet(small)
    for largest, least, most in ((1 << 30, 2, 2), (20_000, 10, 100)):
        tables.compact_parquet(spark, [small], f"{tmp_path}/out", 2, largest)
        files = [f for f in os.listdir(tmp_path / "out") if f.endswith(".parquet")]
        assert least <= len(files) <= most and spark.read.parquet(f"{tmp_path}/out").distinct().count() == rows_in


def test_upsert_and_refresh_reach_the_table(spark, tmp_path):
    name, place = "upsert_under_test", str(tmp_path)
    tables.drop_table(spark, name)
    stored = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    tables.create_table(spark, name, data=stored, cluster_by=["id"], path=f"{place}/first")
    rewrite.upsert_table(spark.createDataFrame([(2, "c"), (3, "d")], "id int, name string"), name, ["id"])
    assert rows(spark.table(name)) == [(1, "a"), (2, "c"), (3, "d")]
    broken = spark.table(name).selectExpr("id", "if(id > 0, raise_error('no'), name) name")
    with pytest.raises(Exception, match="no"):
        tables.refresh_table(broken, name, place)
    assert rows(spark.table(name)) == [(1, "a"), (2, "c"), (3, "d")]
    assert tables.cluster_columns(spark, name) == ["id"]
    tables.drop_table(spark, name)


def files_of(spark, name):
    """File names of a table with the time they were written."""
    found = spark.table(name).select("_metadata.file_name", "_metadata.file_modification_time").distinct()
    return {r[0]: r[1] for r in found.collect()}


def test_refresh_of_a_partitioned_table(spark, tmp_path):
    name, place = "partitioned_under_test", str(tmp_path)
    tables.drop_table(spark, name)
    schema = "id int, v string, p string"
    tables.create_table(spark, name, data=spark.createDataFrame([(1, "a", "01"), (2, "b", "q")], schema), partition_by=["p"], cluster_by=["id"], path=f"{place}/first")
    tables.refresh_table(spark.createDataFrame([(3, "c", "r"), (4, "d", "01")], schema), name, place)
    assert rows(spark.table(name)) == [(3, "c", "r"), (4, "d", "01")]
    assert tables.partition_columns(spark, name) == ["p"] and tables.cluster_columns(spark, name) == ["id"]
    assert not (tmp_path / "first").exists()
    # computed from itself, with a partition more and one less; a failure leaves it
    more = spark.table(name).where("p <> 'r'").unionByName(spark.createDataFrame([(5, "e", "new/é")], schema))
    tables.refresh_table(more, name, place)
    broken = spark.table(name).selectExpr("id", "if(id > 0, raise_error('no'), v) v", "p")
    with pytest.raises(Exception, match="no"):
        tables.refresh_table(broken, name, place)
    assert rows(spark.table(name)) == [(4, "d", "01"), (5, "e", "new/é")]
    assert len([f for f in tmp_path.iterdir() if f.is_dir()]) == 1
    tables.append_table(spark.createDataFrame([(6, "f", "r")], schema), name)
    rewrite.upsert_table(spark.createDataFrame([(5, "E", "new/é"), (6, "F", "01"), (7, "G", "x")], schema), name, ["id"])
    assert rows(spark.table(name)) == [(4, "d", "01"), (5, "E", "new/é"), (6, "F", "01"), (7, "G", "x")]
    tables.drop_table(spark, name)


def test_upsert_of_one_key_rewrites_one_file(spark, tmp_path):
    name = "upsert_files_under_test"
    tables.drop_table(spark, name)
    data = spark.range(1000).selectExpr("id", "cast(id as string) v")
    tables.create_table(spark, name, data=data.where("id < 200"), cluster_by=["id"], path=str(tmp_path / "t"))
    for low in range(200, 1000, 200):
        tables.append_table(data.where(F.col("id").between(low, low + 199)), name)
    before = files_of(spark, name)
    assert len(before) >= 4
    rewrite.upsert_table(spark.createDataFrame([(500, "new")], "id bigint, v string"), name, ["id"])
    after = files_of(spark, name)
    kept = before.keys() & after.keys()
    assert len(before) - len(kept) == 1 and all(before[f] == after[f] for f in kept)
    assert rows(spark.table(name).where("id between 499 and 501")) == [(499, "499"), (500, "new"), (501, "501")]
    rewrite.upsert_table(spark.createDataFrame([(5000, "more"), (None, "null")], "id bigint, v string"), name, ["id"])
    assert after.keys() <= files_of(spark, name).keys() and spark.table(name).count() == 1002
    with pytest.raises(Exception, match="twice"):
        rewrite.upsert_table(spark.createDataFrame([(1, "a"), (1, "b")], "id bigint, v string"), name, ["id"])
    assert spark.table(name).count() == 1002 and not [f for f in (tmp_path / "t").iterdir() if f.name.startswith("_s")  and f.name != "_SUCCESS"]
    tables.drop_table(spark, name)


def test_a_replacement_that_was_cut_off_is_finished(spark, tmp_path, monkeypatch):
    name = "cut_off_under_test"
    tables.drop_table(spark, name)
    tables.create_table(spark, name, data=spark.range(10).selectExpr("id", "'old' v"), cluster_by=["id"], path=str(tmp_path / "t"))
    change = spark.createDataFrame([(3, "new")], "id bigint, v string")
    with monkeypatch.context() as patch:
        patch.setattr(rewrite, "finish_replacements", lambda *_: None)
        rewrite.upsert_table(change, name, ["id"])
    assert spark.table(name).where("v = 'new'").count() == 0
    rewrite.finish_replacements(spark, name)
    rewrite.finish_replacements(spark, name)
    assert spark.table(name).where("v = 'new'").count() == 1 and spark.table(name).count() == 10
    tables.drop_table(spark, name)


def test_duplicates_of_a_stored_table(spark, tmp_path):
    name = "duplicates_under_test"
    tables.drop_table(spark, name)
    schema = "id int, v string"
    first = spark.createDataFrame([(i, None if i % 5 == 0 else str(i)) for i in range(40)], schema)
    tables.create_table(spark, name, data=first, cluster_by=["id"], path=str(tmp_path / "t"))
    clean = files_of(spark, name)
    assert rewrite.remove_table_duplicates(spark, name) == 0 and files_of(spark, name) == clean
    tables.append_table(spark.createDataFrame([(5, None), (5, None), (7, "7"), (100, "x")], schema), name)
    assert rewrite.remove_table_duplicates(spark, name, limit=2) == 2 and spark.table(name).count() == 42
    assert rewrite.remove_table_duplicates(spark, name) == 1
    assert rows(spark.table(name)) == rows(first.union(spark.createDataFrame([(100, "x")], schema)))
    tables.drop_table(spark, name)


def test_headers(spark, tmp_path):
    (tmp_path / "h.json").write_text(json.dumps([{"id": "1", "type": "x", "chains": ["E"], "tvls": {"E": 1.0}, "logo": None}]))
    headers = spark.read.option("multiLine", True).json(str(tmp_path))
    row = ingest.normalise_headers(headers).first()
    assert (row.type, row.chains, row.tvls, row.logo) == ("default", '["E"]', '{"E":1.0}', None)


def test_incremental_rows(spark):
    latest = spark.createDataFrame([("7", "E", "A", 100)], "id string, chain_name string, token_name string, latest_date bigint")
    incoming = facts(spark, ("A", 100), ("A", 150), ("A", 200), ("B", 50), (None, 1))
    new = ingest.incremental_rows(incoming, latest)
    assert rows(new, "token_name", "date") == sorted([("A", 150), ("A", 200), ("B", 50), (None, 1)], key=repr)
    again = ingest.incremental_rows(incoming.dropna(), latest_dates(incoming))
    assert again.count() == 0


@pytest.mark.parametrize("snapshot_every", [1, 2, 20])
def test_stream_drops_late_rows_and_survives_restart_and_replay(spark, tmp_path, snapshot_every):
    sink = FactSink(spark, str(tmp_path / "sink"), snapshot_every).create()

    def run():
        stream_landed_files(spark, str(tmp_path / "landing"), sink, str(tmp_path / "checkpoint")).awaitTermination()
        return rows(sink.facts(), "token_name", "date")

    batches = [facts(spark, ("A", 100)), facts(spark, ("A", 150), ("B", 50)), facts(spark, ("A", 120))]
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
        run()
    expected = [("A", 100), ("A", 150), ("B", 50)]
    assert run() == expected
    # a batch that runs again, with its own earlier output in place, writes the same rows
    sink.write_batch(batches[1], 1)
    assert rows(sink.facts(), "token_name", "date") == expected
    assert rows(sink.latest_before(3), "token_name", "latest_date") == [("A", 150), ("B", 50)]


def test_stream_starts_from_existing_facts(spark, tmp_path):
    sink = FactSink(spark, str(tmp_path / "sink")).create(facts(spark, ("A", 100)))
    sink.write_batch(facts(spark, ("A", 90), ("A", 110)), 0)
    assert rows(sink.facts(), "date") == [(100,), (110,)]


def test_upsert(spark):
    schema = "id int, name string, value int"
    target = spark.createDataFrame([(7, "left alone", -1), (8, "replaced", 4), (9, "emptied", 6)], schema)
    source = spark.createDataFrame([(8, "new text", 5), (9, None, None), (12, "inserted", 0)], schema)
    expected = [(12, "inserted", 0), (7, "left alone", -1), (8, "new text", 5), (9, None, None)]
    assert rows(tables.upsert(target, source, ["id"])) == expected
    with pytest.raises(Exception, match="occurs twice"):
        tables.upsert(target, source.unionByName(source), ["id"]).collect()


def test_table_lifecycle(spark, tmp_path):
    name = "positions_under_test"
    tables.drop_table(spark, name)
    place = str(tmp_path / "table")
    tables.create_table(spark, name, schema=FACTS, path=place)
    tables.create_table(spark, name, schema=FACTS, path=place)
    tables.append_table(facts(spark, ("A", 1)).select(*reversed(FACTS.names)), name)
    assert rows(readers.read_table(spark, name)) == [("7", "E", 1, "A", 1.0, 1.0)]
    assert readers.read_table(spark, name, 0).count() == 0
    with pytest.raises(Exception, match="already exists"):
        tables.create_table(spark, name, data=facts(spark, ("A", 1)), path=place)
    assert tables.table_exists(spark, name)
    tables.drop_table(spark, name)
    assert not tables.table_exists(spark, name)
    with pytest.raises(ValueError):
        tables.create_table(spark, name)


def test_prices(spark):
    given = spark.createDataFrame([("[[1704067200000, 1.5], [1704153600000.0, 2]]",)], "prices string")
    got = readers.price_rows(given).selectExpr("unix_seconds(time) s", "price")
    assert rows(got) == [(1704067200, 1.5), (1704153600, 2.0)]


def test_mapping_is_rebuilt_only_when_missing(spark, tmp_path):
    made = []

    def build():
        made.append(1)
        frame = category_map_frame(spark, {"a": ["b"]})
        return Mapping(frame, frame, frame)

    for _ in range(2):
        assert rows(tables.load_or_build_mapping(spark, str(tmp_path / "map"), build).rev_map) == [("a", "b")]
    assert made == [1]


def test_a_saved_mapping_is_of_one_state(spark, tmp_path):
    """A save that fails between two tables leaves the old mapping; a new one may be computed from the one it follows."""
    place = str(tmp_path / "map")

    def of(value):
        return Mapping(*[spark.sql(f"select '{value}' x")] * 3)

    def states():
        return [rows(table)[0][0] for table in tables.load_mapping(spark, place)]

    with pytest.raises(FileNotFoundError):
        tables.load_mapping(spark, place)
    tables.save_mapping(of("a"), place)
    broken = spark.sql("select cast(raise_error('no') as string) x")
    with pytest.raises(Exception, match="no"):
        tables.save_mapping(Mapping(of("b").rev_map, broken, of("b").id_info), place)
    assert states() == ["a"] * 3 and len(list((tmp_path / "map").iterdir())) == 1
    half = tmp_path / "map" / "v0000000002-dead"  # a driver that died before its mark
    of("dead").rev_map.write.parquet(str(half / "rev_map"))
    assert states() == ["a"] * 3
    for _ in range(3):
        tables.save_mapping(Mapping(*[t.selectExpr("concat(x, 'a') x") for t in tables.load_mapping(spark, place)]), place)
    assert states() == ["aaaa"] * 3 and not half.exists()
    assert len(list((tmp_path / "map").iterdir())) == 2


def test_last_modified_is_the_newest_files_time(spark, tmp_path):
    place = tmp_path / "files"
    spark.range(10).repartition(3).write.parquet(str(place))
    for number, file in enumerate(sorted(place.glob("*.parquet"))):
        os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))
    newest = datetime.fromtimestamp(1_700_000_002, timezone.utc).strftime("%Y-%m-%d %H:%M:%S UTC")
    assert rows(readers.last_modified(spark.read.parquet(str(place)))) == [(newest,)]


def test_csv_round_trip_and_last_modified(spark, tmp_path):
    place = str(tmp_path / "edges")
    edges = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' time, 'a' source, 'b' target, 2.5d size")
    tables.write_csv(edges, place)
    assert rows(readers.read_edges(spark, place, nanoseconds=True)) == [(1704067200 * 10**9, "a", "b", 2.5)]
    assert readers.last_modified(readers.read_edges(spark, place)).first()[0].endswith("UTC")


def test_a_batch_reads_the_buckets_of_its_keys_alone(spark, tmp_path):
    many = facts(spark, *[(f"T{i}", 100) for i in range(3000)])
    sink = FactSink(spark, str(tmp_path / "sink"), 2).create(many)
    key = spark.createDataFrame([("7", "E", "T77")], "id string, chain_name string, token_name string")
    latest = sink.latest_before(0, key)
    assert rows(latest) == [("7", "E", "T77", 100)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:200] and "key_hash" in plan.split("PushedFilters")[1][:300]
    bucket = sink._hashed(key).first().bucket
    assert 0 < spark.read.parquet(str(tmp_path / "sink/snapshots/upto=-1")).where(F.col("bucket") == bucket).count() < 300
    for batch in range(12):
        sink.write_batch(facts(spark, ("T77", 100 + batch), ("new", batch)), batch)
    assert rows(sink.latest_before(12, key)) == [("7", "E", "T77", 111)]
    left = {f.name for f in (tmp_path / "sink" / "maxima").iterdir()}
    assert "batch_id=11" in left and "batch_id=3" not in left and len({f.name for f in (tmp_path / "sink" / "snapshots").iterdir()}) == 3
    # a replay of a recent batch still finds its mark
    sink.write_batch(facts(spark, ("T77", 111), ("new", 11)), 11)
    assert rows(sink.latest_before(12, key)) == [("7", "E", "T77", 111)]


def test_only_touched_periods_of_a_history_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "history")

    def build(rows_):
        return rows_.groupBy(bucket("month").alias("period"), "token_name").agg(F.max("date").alias("newest"))

    day = 86_400
    old = facts(spark, ("A", 10 * day), ("A", 40 * day), ("B", 41 * day), ("B", 70 * day))
    write_history(build(old), path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "history").rglob("*.parquet")}
    new = facts(spark, ("C", 45 * day), (None, 46 * day))
    assert update_history(old.union(new), new, path, "month", build) == ["1970-02-01"]
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "history").rglob("*.parquet")}
    gone = {f.parent.name for f in before.keys() - after.keys()}
    assert gone == {"period_day=1970-02-01"} and all(before[f] == after[f] for f in before.keys() & after.keys())
    assert rows(read_history(build(old), path)) == rows(build(old.union(new)))
    assert update_history(old, new.limit(0), path, "month", build) == []
