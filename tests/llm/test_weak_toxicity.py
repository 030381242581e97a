import numpy as np
from pyspark.sql import functions as F

from llm_docs import docs_of  # noqa: F401
from flowtide.llm import weak_toxicity


def corpus(n, seed):
    """Toxic documents carry one of two stems with free endings, or a word of the general lexicon."""
    pick = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        body = [f"w{'abcdefghij'[j % 10]}{'klmnopqrst'[j // 10 % 10]}{'uvwxyz'[j % 6]}" for j in pick.integers(0, 600, 60)]
        toxic = i % 5 == 0
        if toxic:
            for at in pick.integers(0, 60, 2):
                body[at] = pick.choice(["grumpf", "zarkol"]) + "".join(pick.choice(list("aeiou"), 3)) if i % 2 else "Idiot!"
        rows.append((i, " ".join(body)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_learns_stems_and_scores_unseen_documents(spark, docs_of):
    rows, labels = corpus(400, 1)
    docs = docs_of(*rows, (900, None), (901, ""), (None, "you idiot"), (0, rows[0][1]))
    table = spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None)], "doc_id bigint, quality int, toxic int")
    model = weak_toxicity.train(docs, table, "doc_id < 300")
    found = weak_toxicity.score(docs, model).collect()
    assert len(found) == 404 and all(0 <= r.score <= 1 for r in found)
    truth = {i: t for i, _, t in labels}
    unseen = [(r.score >= 0.3, truth[r.doc_id] == 1) for r in found if r.doc_id is not None and 300 <= r.doc_id < 400]
    assert np.mean([a == b for a, b in unseen]) > 0.95
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[900] == by_id[901] < 0.3
    assert weak_toxicity.score(docs.limit(0), model).count() == 0


def test_rare_toxic_words_are_found_behind_many_frequent_ones(spark):
    letters = "abcdefghij"
    common = " ".join(f"q{a}{b}{c}{d}" for a in letters for b in letters for c in letters for d in letters)
    texts = [(f"{common} zu{letters[i]}u", 1) for i in range(8)] + [(f"zarkol me{letters[i]}e", 1) for i in range(3)]
    texts += [(f"{common} gu{letters[i]}u", 0) for i in range(10)]
    sample = spark.createDataFrame([*texts, ("zarkol", None)], "text string, toxic int")
    # 20,000 frequent words and beginnings alike in clean documents; zarkol and its beginnings are in three toxic ones
    frequent = " ".join(f"x{w}" for w in common.split())
    sample = sample.withColumn("text", F.when(F.col("text").contains("qaaaa"), F.concat("text", F.lit(" " + frequent))).otherwise(F.col("text")))
    found = {r.feature: (r.n, r.missed) for r in weak_toxicity._marking(sample, 0.1, 3).collect()}
    assert found == dict.fromkeys(["zarkol", "^zark", "^zarko", "^zarkol"], (3, 0))
    assert set(weak_toxicity._mine(sample, 0.1)) <= found.keys() and weak_toxicity._mine(sample, 0.1, min_support=4) == []


def test_without_labels_the_lexicon_votes(spark, docs_of):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = docs_of((1, "you pathetic moron, you idiot"), (2, "a fine day"))
    scores = {r.doc_id: r.score for r in weak_toxicity.score(docs, weak_toxicity.train(docs, none)).collect()}
    assert scores[1] > scores[2]


def test_copies_of_one_document_do_not_make_voters():
    copied = [[0, 1, 2, 3]] * 30
    # feature 0 also marks other documents; the words that only ride along are explained by it
    assert weak_toxicity._cover(copied + [[0], [0], [0]], 4)[0] == 0


def test_label_model_finds_accuracies_and_discounts_twins():
    pick = np.random.default_rng(0)
    truth = pick.random(4000) < 0.2
    fire = lambda p1, p0: (pick.random(4000) < np.where(truth, p1, p0)).astype(float)
    good = [fire(0.6, 0.02) for _ in range(5)]
    bad = fire(0.3, 0.3)
    votes = np.stack([*good, bad, bad, bad], 1)
    noisy = np.where(pick.random(4000) < 0.1, 1 - truth, truth).astype(float)
    posterior = weak_toxicity.fit_label_model(votes, noisy, 5)
    assert ((posterior > 0.5) == truth).mean() > 0.95


def test_label_model_equals_enumeration_of_a_few_voters():
    """With independent voters the posterior is Bayes' rule over the two labels."""
    pick = np.random.default_rng(2)
    truth = pick.random(4000) < 0.3
    rates = np.array([[0.02, 0.6], [0.03, 0.5], [0.01, 0.4], [0.05, 0.7]])
    votes = (pick.random((4000, 4)) < np.where(truth[:, None], rates[:, 1], rates[:, 0])).astype(np.float32)
    posterior = weak_toxicity.fit_label_model(votes, truth.astype(float), 4)
    for form in {tuple(v) for v in votes.astype(int).tolist()}:
        one = 0.3 * np.prod([r[1] if v else 1 - r[1] for v, r in zip(form, rates, strict=True)])
        none = 0.7 * np.prod([r[0] if v else 1 - r[0] for v, r in zip(form, rates, strict=True)])
        found = posterior[(votes == form).all(1)][0]
        assert abs(found - one / (one + none)) < 0.15


def test_many_useful_words_all_vote():
    assert len(weak_toxicity._cover([[i] for i in range(600) for _ in range(3)], 600)) == 600
