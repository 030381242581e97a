"""The corpus pipeline: the stages in order, each over all documents that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowtide.llm import hyperlang, poisson_mix, unigram
from flowtide.llm.queries import held_out
from flowtide.llm.recompression import without_repeats
from flowtide.llm.simhash import keep_one_per_group
from flowtide.llm.storage import discard, quoted, stored

#: SQL can express neither the language model nor the connected components.
ORACLE_SQL = None

#: A text with enough letter triples that is this far from every learned language is not text.
MIN_LANGUAGE_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, and those with enough letters to tell that they are unlike every learned language.

    Null and empty texts have no letters. Equal rows are judged alike, an empty table gives an empty one; other columns, whatever
    their names, stay as they are.
    """
    return hyperlang.accepted(docs, hyperlang.train(docs, ~held_out()), MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash group stays: 3-word shingles, at most 3 differing bits.

    It is the one with the smallest doc_id; one without doc_id stays only if no other has one. Null and empty texts are one group. Of
    equal rows one stays, an empty table gives an empty one; other columns stay as they are.
    """
    return keep_one_per_group(docs, shingle=3, max_bits=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by repeated windows of 35 words are cut out of the text.

    A text of which nothing stays is empty, a null text stays null; ``n_chars`` follows the text. Equal rows are repeats of
    each other, an empty table gives an empty one; other columns stay as they are.
    """
    return without_repeats(docs, window=35)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn with replacement to weights that are the square roots of the sources' sizes.

    A null source is a source, a null doc_id an id; equal ids draw equal counts. Texts are not read, an empty table gives an empty
    one; all columns stay as they are.
    """
    return poisson_mix.mix(docs, seed="mix").select(*[quoted(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its pieces; ``round_trip`` says that decoding gives the text back.

    A null text has null pieces, an empty one none. Equal rows are encoded alike, an empty table gives an empty one. The new columns
    replace old ones of their names, all others stay.
    """
    return unigram.encoded(docs, unigram.load_model())


STAGES = [
    ("language id", language),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing sources", mixture),
    ("unigram tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    read: list[str] = []
    for _, stage in STAGES:
        written: list[str] = []
        docs = stored(stage(spark, docs, sf_dir), written)
        discard(read)
        read = written
    return docs
