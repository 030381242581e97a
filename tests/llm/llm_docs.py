import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows, with columns whose names clash with those of results and of steps."""
    names = ("_a", "_b", "_t1", "_t2", "t1", "t2", "_ranges", "ranges", "_row", "_text", "_row_hash", "row_hash", "_u", "_k", "_part", "_source", "_quality",
             "_toxic", "_first", "_keep_id", "fingerprint", "root", "key", "span", "low", "high", "spans", "lang_pred", "a.b", "a`b", "node")

    def make(*rows):
        filled = [(*row, *("en", "s0")[len(row) - 2 :], 0, "score", 1.5)[:7] + names for row in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, rank double"
        schema += "".join(f", `{n.replace('`', '``')}` string" for n in names)
        return spark.createDataFrame(filled, schema)

    return make
