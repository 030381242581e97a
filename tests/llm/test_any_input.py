"""Names that clash, very long texts, and folders that are left: all operators over documents, and all stages."""

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))
from llm_docs import docs_of  # noqa: F401
import corpus_pipeline
from flowtide.llm import hyperlang, line_crf, poisson_mix, recompression, simhash, storage, unigram, weak_toxicity
from flowtide.session import shared_dir

FOLDER = "/root/testdata/sf0.001"
PROSE = " ".join(f"wort{i} ka to mi ru" for i in range(60))


def others(df):
    return [storage.quoted(c) for c in df.columns if c not in ("text", "n_chars")]


def kept_rows(df, columns):
    return sorted(repr(tuple(r)) for r in df.select(*columns).collect())


def test_other_columns_come_through_unchanged(spark, docs_of):
    docs = docs_of((1, PROSE), (2, PROSE + " and more"), (3, None), (4, ""), (None, "etwas anderes hier"))
    same = others(docs)
    model = hyperlang.train(docs)
    for made, ids in (
        (recompression.without_repeats(docs, 20), None), (simhash.keep_one_per_group(docs), 0), (hyperlang.accepted(docs, model, 0.0), 0),
        (poisson_mix.mix(docs, total=40), 0), (unigram.encoded(docs, unigram.load_model()), None),
    ):
        assert made.columns[: len(docs.columns)] == docs.columns
        found, want = kept_rows(made, same), kept_rows(docs, same)
        assert found == want if ids is None else set(found) <= set(want)
    for made in (
        recompression.removal_report(docs), simhash.simhash_groups(docs), hyperlang.identify(docs, model), unigram.token_report(docs, unigram.load_model()),
        line_crf.quality_report(docs, line_crf.Field(line_crf._bits(line_crf.np.array([1]))[0] * 1.0, line_crf.np.zeros((2, 2)))),
        weak_toxicity.score(docs, weak_toxicity.Model({}, line_crf.np.zeros(len(weak_toxicity.PATTERNS)), 0.0)),
    ):
        assert made.count() == docs.count()


def test_added_columns_get_free_names(spark, docs_of):
    docs = docs_of((1, "x"), (2, "y")).withColumns({"_rate": F.lit("r"), "_copy": F.lit("c"), "__copy": F.lit("d")})
    mixed = poisson_mix.mix(docs, total=50)
    assert mixed.columns == [*docs.columns, "___copy", "_order", "__rate"]
    assert mixed.where("_rate = 'r' and _copy = 'c' and __copy = 'd' and __rate > 0 and ___copy >= 0").count() == mixed.count() > 0


def test_stages_take_any_names(spark, docs_of):
    docs = docs_of(*[(i, f"{PROSE} eigen{i} " + " ".join(f"x{i}y{j}" for j in range(50))) for i in range(12)])
    for name, stage in corpus_pipeline.STAGES:
        docs = storage.stored(stage(spark, docs, FOLDER))
        assert docs.count() > 0, name


@pytest.fixture(scope="module")
def long_docs(docs_of):
    ideographs = "".join(chr(0x4E00 + (i * 7919) % 20_000) for i in range(1_700_000))
    unbroken = "abcdefghij" * 200_000
    lines = "\n".join(f"line {i} with words {i % 97}" for i in range(60_000))
    return docs_of((1, ideographs), (2, unbroken), (3, lines), (4, PROSE), (5, PROSE))


def test_very_long_texts(spark, long_docs):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 6)], "doc_id bigint, quality int, toxic int")
    model = hyperlang.train(long_docs)
    assert hyperlang.identify(long_docs, model).where("lang_pred = 'en'").count() == 5
    assert {r.doc_id: r.n_words for r in recompression.removal_report(long_docs).collect()}[3] == 5 * 60_000
    assert simhash.simhash_groups(long_docs).count() == 5
    assert line_crf.quality_report(long_docs, line_crf.train_field(long_docs, labels)).count() == 5
    assert weak_toxicity.score(long_docs, weak_toxicity.train(long_docs, labels)).count() == 5
    assert poisson_mix.mix(long_docs, total=5).where("text is null").count() == 0


def test_steps_leave_no_folders(spark, docs_of):
    """What is left is read by the result, and goes when Python ends."""
    docs = docs_of((1, PROSE), (2, PROSE + " and more"), (3, "other"))
    place = shared_dir(spark).removeprefix("file:")

    def folders():
        return {f for f in os.listdir(place) if f.startswith("flowtide-llm-")}

    before = folders()
    recompression.removal_report(docs).collect()
    assert len(folders() - before) == 1
    before = folders()
    simhash.simhash_groups(docs).collect()
    assert len(folders() - before) <= 6
    assert all(f"{shared_dir(spark)}/{f}" in storage._made for f in folders() - before)
    places = list(storage._made)
    storage.discard(places[-1:])
    assert places[-1].rsplit("/", 1)[1] not in folders()


def test_session_settings_come_back(spark, docs_of):
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    simhash.simhash_groups(docs_of((1, "a b c"), (2, "a b d")))
    assert spark.conf.get(name) == before
