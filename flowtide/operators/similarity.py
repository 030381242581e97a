"""Best TF-IDF cosine match of token names against protocol texts.

The full token × protocol score matrix is never formed. Pairs are generated by prefix filtering
(Bayardo, Ma and Srikant, "Scaling Up All Pairs Similarity Search", WWW 2007), which is exact: with unit vectors
and terms in one global order from rare to frequent, two documents with a cosine of at least t share a
term among those whose remaining suffix still has a norm of at least t. Frequent terms carry small
weights and sit at the end of that order, so the posting lists that would explode are not joined.
A pair's shared prefix terms also bound its score: up to the last of them the sum is known, and behind it the product of the remaining
norms is the most that can follow. Only pairs whose bound reaches t are scored in full.

A text's distinct terms are counted within its row, and documents' terms are not shuffled one by one: for the candidates only those of the
tokens and the most frequent ones of all are carried on behind the shuffle of the texts, and the others add to the norm at least what
they would if they were as frequent as the frequent ones. Such norms are too small and such weights too large, so bounds stay
bounds. Exact norms, for which all terms' frequencies count, are taken of the documents that are left.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.functions.text import joined_text, terms
from flowtide.plans.skew import skewed_join
from flowtide.session import ensure_checkpoints

# keeps pairs whose score equals the threshold up to rounding among the candidates
_SLACK = 1e-9
# rows and bytes up to which a counted table goes to every task; larger ones meet the documents' terms in shuffles
_SMALL_ROWS, _SMALL_BYTES = 200_000, 16 << 20
# so many of the most frequent terms at most have their exact weight in the bound of a document's norm
_FREQUENT = 20_000


def _spread(small: DataFrame, key: str) -> DataFrame:
    """``small``, which is checkpointed, marked for broadcast if it is measured to be small."""
    n, size = small.agg(F.count("*"), F.sum(F.octet_length(key))).first()
    return F.broadcast(small) if n <= _SMALL_ROWS and (size or 0) <= _SMALL_BYTES else small


def _census(documents: DataFrame) -> tuple[int, bool]:
    """The number of rows of ``(doc, text)``, and whether several have the same ``doc``."""
    named = F.when(F.col("doc").isNotNull(), F.col("count"))
    n, most = documents.groupBy("doc").count().agg(F.sum("count"), F.max(named)).first()
    return n or 0, (most or 0) > 1


def _counted(documents: DataFrame) -> DataFrame:
    """``doc, bag``: the distinct terms of each row's text with their counts, without a shuffle."""
    found = documents.select("doc", F.sort_array(terms(F.col("text"))).alias("_found"))
    at = lambda i: F.get("_found", i)
    starts = F.filter(F.sequence(F.lit(0), F.size("_found") - 1), lambda i: (i == 0) | (at(i) != at(i - 1)))
    found = found.withColumn("_starts", F.when(F.size("_found") > 0, starts))
    tf = lambda i, k: (F.coalesce(F.get("_starts", k + 1), F.size("_found")) - i).cast("bigint")
    return found.select("doc", F.transform("_starts", lambda i, k: F.struct(at(i).alias("term"), tf(i, k).alias("tf"))).alias("bag"))


def _exploded(bags: DataFrame, *columns: str) -> DataFrame:
    # the outer form, since Spark would find the terms twice to see beforehand whether there are any
    listed = bags.select("doc", *columns, F.explode_outer("bag").alias("_t"))
    return listed.select("doc", *columns, "_t.term", "_t.tf").where("term is not null")


def term_bags(documents: DataFrame, merge: bool) -> DataFrame:
    """``doc, bag`` of ``(doc, text)`` with a ``doc``; with ``merge`` texts of the same ``doc`` become one bag.

    Texts are dealt out, not their terms: a few large files still make many tasks, and the counts stay where they are.
    """
    bags = _counted(documents.where("doc is not null").repartition("doc"))
    if not merge:
        return bags
    together = _exploded(bags).groupBy("doc", "term").agg(F.sum("tf").alias("tf"))
    # one cell is the distinct terms of one document
    return together.groupBy("doc").agg(F.collect_list(F.struct("term", "tf")).alias("bag"))


def term_weights(documents: DataFrame, bags: DataFrame, token_terms: DataFrame, n: int) -> DataFrame:
    """``term, df, idf`` over tokens and protocols: ``ln((1 + n) / (1 + df)) + 1``.

    All rows without ``doc`` count as one document. Counts are added up map-side, so a task sends each of its terms once.
    """
    unnamed = _exploded(_counted(documents.where("doc is null").repartition("text")))
    listed = _exploded(bags).unionByName(unnamed).unionByName(token_terms).groupBy("term")
    df = F.count("doc") + F.max(F.col("doc").isNull().cast("int"))
    return listed.agg(df.alias("df")).withColumn("idf", F.log(F.lit(1.0 + n) / (F.lit(1.0) + F.col("df"))) + 1)


def frequent_from(weights: DataFrame, most: int = _FREQUENT) -> int:
    """The least document frequency that at most ``most`` terms reach, in steps of an eighth of an octave."""
    step = F.floor(F.log2("df") * 8).cast("int")
    counts = weights.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.max("df").alias("top"))
    found, least = 0, 1
    for r in sorted(counts.collect(), key=lambda r: -r.step):
        found += r.n
        if found > most:
            least = r.top + 1
            break
    return least


def _suffix(weight: str) -> Column:
    """The squared norm of the term and all more frequent ones of the same document."""
    behind = W.partitionBy("doc").orderBy("df", "term").rowsBetween(W.currentRow, W.unboundedFollowing)
    return F.sum(F.col(weight) * F.col(weight)).over(behind)


def token_vectors(token_terms: DataFrame, weights: DataFrame) -> DataFrame:
    """Unit TF-IDF vectors ``doc, term, weight, suffix`` of the tokens."""
    raw = skewed_join(token_terms, weights, ["term"], "inner").withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy("doc")))
    return raw.withColumn("weight", F.col("raw") / norm).select("doc", "term", "weight", _suffix("weight").alias("suffix"))


def bounded_vectors(bags: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """``id, term, df, raw, weight, norm`` of the terms that tokens have, with norms not above the documents' and weights not below.

    ``known`` has the weights of the terms ``in_tokens`` and of some others. Terms that it has not count for a norm as if
    their inverse frequency was ``least``, which none of theirs is below.
    """
    squares = F.aggregate("bag", F.lit(0.0), lambda s, t: s + (t.tf * t.tf).cast("double"))
    # a column of its own: beside the generator it would be computed for each term
    listed = _exploded(bags.withColumn("squares", squares), "squares")
    raw = skewed_join(listed, _spread(known, "term"), ["term"], "inner").withColumn("raw", F.col("tf") * F.col("idf"))
    # one group is the known terms of one text; sorted as for the suffix, so that one sort serves both
    whole = W.partitionBy("doc").orderBy("df", "term").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    unknown = F.min("squares").over(whole) - F.sum(F.col("tf") * F.col("tf")).over(whole)
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(whole) + unknown * F.lit(least * least))
    weighted = raw.withColumn("norm", norm).where("in_tokens").withColumn("weight", F.col("raw") / F.col("norm"))
    return weighted.select("doc", "term", "df", "raw", "weight", "norm")


def candidate_pairs(texts: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``token_name, id`` of all pairs of ``bounded_vectors`` and tokens that may score ``threshold``, by what their prefixes share."""
    in_prefix = F.col("suffix") >= threshold * threshold - _SLACK
    texts = texts.select("doc", "term", F.col("weight").alias("_weight"), _suffix("weight").alias("suffix")).where(in_prefix)
    texts = texts.select(F.col("doc").alias("id"), "term", "_weight", F.col("suffix").alias("_suffix"))
    prefixes = vectors.where(in_prefix).withColumnRenamed("doc", "token_name")
    left, right = F.col("weight"), F.col("_weight")
    # what the terms behind a shared one can add at most; behind the last shared one of both prefixes it is least
    rest = F.sqrt(F.greatest(F.col("suffix") - left * left, F.lit(0.0)) * F.greatest(F.col("_suffix") - right * right, F.lit(0.0)))
    met = skewed_join(texts, _spread(prefixes.checkpoint(), "token_name"), ["term"], "inner")
    return (
        met.groupBy("id", "token_name")
        .agg(F.sum(left * right).alias("_known"), F.min(rest).alias("_rest"))
        .where(F.col("_known") + F.col("_rest") >= threshold - _SLACK)
        .select("token_name", "id")
    )


def possible_products(texts: DataFrame, candidates: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``token_name, id, product`` of those candidates whose product over the document's bounded norm reaches ``threshold``."""
    pairs = texts.withColumnRenamed("doc", "id").join(candidates, "id")
    shared = pairs.join(_spread(vectors, "term").select(F.col("doc").alias("token_name"), "term", F.col("weight").alias("_weight")), ["token_name", "term"])
    products = shared.groupBy("id", "token_name").agg(F.sum(F.col("_weight") * F.col("raw")).alias("product"), F.min("norm").alias("norm"))
    return products.where(F.col("product") >= (threshold - _SLACK) * F.col("norm")).select("token_name", "id", "product")


def similarity_matches(
    tokens: DataFrame, protocols: DataFrame, threshold: float, text_columns: list[str] | None = None
) -> DataFrame:
    """``token_name, id, name, score`` of the best protocol of every token scoring at least ``threshold``.

    ``tokens`` holds distinct ``token_name``; ``protocols`` is unique on ``id`` and carries ``total_tvls``, which
    decides between equal scores (highest first, then the smaller id). Vectors are raw term counts times the inverse
    frequencies of ``term_weights`` over the L2 norm of the whole text.
    """
    if threshold <= 0:
        raise ValueError("threshold must be positive")
    ensure_checkpoints(tokens.sparkSession)
    token_docs = tokens.select(F.col("token_name").alias("doc"), F.col("token_name").alias("text"))
    protocol_docs = protocols.select(F.col("id").alias("doc"), joined_text(protocols.schema, text_columns).alias("text"))
    (n_tokens, merge_tokens), (n_protocols, merge) = _census(token_docs), _census(protocol_docs)
    n = n_tokens + n_protocols
    token_terms = _exploded(term_bags(token_docs, merge_tokens)).checkpoint()
    bags = term_bags(protocol_docs, merge)
    weights = term_weights(protocol_docs, bags, token_terms, n).checkpoint()
    cut = frequent_from(weights)
    vocabulary = token_terms.select("term", F.lit(True).alias("_in")).distinct()
    known = weights.join(vocabulary, "term", "left").withColumn("in_tokens", F.col("_in").isNotNull()).drop("_in")
    known = known.where(F.col("in_tokens") | (F.col("df") >= cut)).checkpoint()
    vectors = token_vectors(token_terms, known).checkpoint()
    # terms that are not known are in less than `cut` texts
    least = log((1.0 + n) / cut) + 1
    candidates = candidate_pairs(bounded_vectors(bags, known, least), vectors, threshold).checkpoint()

    def only(pairs: DataFrame) -> DataFrame:
        kept = _spread(pairs.select(F.col("id").alias("doc")).distinct().checkpoint(), "doc")
        return term_bags(protocol_docs.join(kept, "doc", "left_semi"), merge)

    products = possible_products(bounded_vectors(only(candidates), known, least), candidates, vectors, threshold).checkpoint()
    # few documents are left: only they are given their exact norms
    raw = skewed_join(_exploded(only(products)), weights, ["term"], "inner").withColumn("raw", F.col("tf") * F.col("idf"))
    norms = raw.groupBy(F.col("doc").alias("id")).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    scores = products.join(norms, "id").select("token_name", "id", (F.col("product") / F.col("norm")).alias("score")).where(F.col("score") >= threshold)
    ranked = scores.join(protocols.select("id", "name", "total_tvls"), "id")
    # rounding keeps equal scores equal whatever the order of summation
    order = F.struct(-F.round("score", 12), -F.col("total_tvls"), "id")
    best = ranked.groupBy("token_name").agg(F.min_by(F.struct("id", "name", "score"), order).alias("best"))
    return best.select("token_name", "best.id", "best.name", "best.score")
