"""The pipeline and the registered queries, against their SQL or brute force."""

import sys
import zlib
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
from llm_docs import docs_of  # noqa: F401
import corpus_pipeline
from flowtide.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, oracle, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = oracle.execute(SQL[name])
    at = [[d[0] for d in result.description].index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in at)) for r in result.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == want


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_held_out_documents_follow_the_contract(spark):
    rows = QUERIES["op7_hyperdimensional_language"](spark, FOLDER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    hits = [truth[r.doc_id] == r.lang_pred for r in rows if r.held_out]
    assert sum(hits) > 0.95 * len(hits)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == first.columns, name
        docs = spark.createDataFrame(out.collect(), first.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    # decoding gives every text back
    assert last.where("not round_trip").count() == 0 and last.count() == docs.count() > 0


def test_pipeline_keeps_the_survivors_of_brute_force(spark):
    """Language and near-duplicate stages against a plain computation over all pairs."""
    from flowtide.llm.simhash import fingerprint

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.language(spark, docs, FOLDER)
    rows = sorted((r.doc_id, fingerprint((r.text or "").encode())) for r in kept.collect())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 3:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    want = {doc for i, (doc, _) in enumerate(rows) if find(i) == i}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, kept, FOLDER).collect()} == want


def test_pipeline_of_nothing(spark, docs_of):
    docs = docs_of((1, "x")).select("doc_id", "text", "lang", "source", "n_chars").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
