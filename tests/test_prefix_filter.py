"""Threshold join by the prefix filter: no pair lost at any threshold, few pairs looked at."""

import random

import pytest
from pyspark.sql import functions as F

from agentlake.operators import tfidf


def vectors(spark, n_docs=400, n_asked=30, seed=1):
    """Texts of a few very common words and some rare ones."""
    r = random.Random(seed)
    common, rare = [f"common{i}" for i in range(6)], [f"rare{i}" for i in range(300)]
    text = lambda: " ".join(r.sample(common, 5) + r.choices(rare, k=r.randint(4, 9)))
    docs = spark.createDataFrame([(i, text()) for i in range(n_docs)] + [(n_docs, ""), (n_docs + 1, None)], "id long, text string")
    asked = spark.createDataFrame([(i, text()) for i in range(n_asked)] + [(90, "unknown words"), (91, "common1 common2")], "query_id long, text string")
    idf = tfidf.fit(docs, "id", "text")
    return tfidf.transform(docs, "id", "text", idf), tfidf.transform(asked, "query_id", "text", idf)


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("threshold", [0.0, 0.01, 0.1, 0.25, 0.6, 1.0])
def test_both_sides_of_the_bound(spark, threshold):
    docs, asked = vectors(spark)
    for strict in (False, True):
        few, many = (tfidf.match(docs, asked, threshold, strict, max_postings=n) for n in (10**6, 1))
        assert [f.dataType for f in few.schema] == [f.dataType for f in many.schema]
        assert rows(few) == rows(many)


def test_few_candidates(spark):
    docs, asked = vectors(spark)
    flat = asked.select(F.col("id").alias("query_id"), F.explode("ws").alias("x")).select("query_id", "x.term", "x.w")
    words = docs.select("id", F.explode("ws.term").alias("term"))
    every = words.join(flat, "term").select("query_id", "id").distinct().count()
    found = tfidf.candidates(docs, flat, 0.3).count()
    print(found, every)
    assert 0 < found < every / 10
