"""One slice, one code or one gram that holds most rows; names shorter than a gram; the saved index of vectors."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from agentlake.operators import claims, neighbours, predicates
from agentlake.operators.scans import _cut_again, paged_lists, running


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def one_day(spark):
    """9 of 10 rows on one day of one item; days, items and numbers may be null."""
    rng = random.Random(3)
    data = [
        ("a" if k % 10 else rng.choice(["b", None, "c"]), 5 if k % 10 else rng.choice([None, 1, 4, 6, 9]), k if k % 501 else None, rng.randrange(9))
        for k in range(8000)
    ]
    return spark.createDataFrame(data, "item string, day int, id int, units int")


@pytest.mark.parametrize("first", ["asc", "desc", "asc_nulls_last"])
@pytest.mark.parametrize("keys", [["item"], []])
def test_one_slice_holds_nearly_all_rows(spark, one_day, keys, first):
    slices = -F.col("day") if first == "desc" else F.col("day")
    order = [getattr(F, first)("day"), F.desc("id"), "units", "item"]  # only equal rows tie
    kinds = {"total": F.col("units"), "place": F.lit(1).cast("long")}
    cut = running(one_day, keys, order, slices, kinds, hot_rows=200)
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = one_day.withColumns({"total": F.sum("units").over(w), "place": F.row_number().over(w).cast("long")})
    assert rows(cut) == rows(plain)


def test_pieces_of_a_hot_slice_are_even(spark, one_day):
    cut = one_day.withColumns({"__hot": F.lit(True), "__slice": F.col("day")})
    sizes = [r["count"] for r in _cut_again(cut, ["item"], ["day", "id"], 1000).filter("item = 'a'").groupBy("__part").count().collect()]
    assert len(sizes) > 20 and max(sizes) <= 2 * sum(sizes) / len(sizes) and max(sizes) < 1000


def test_pages_of_one_slice(spark, one_day):
    df = one_day.filter("item = 'a' AND id IS NOT NULL")
    out = [rows(paged_lists(df, ["item"], ["day", "id"], F.col("day"), F.col("id"), 300))]
    ids = sorted(r.id for r in df.collect())
    assert [list(r[3]) for r in sorted(out[0], key=lambda r: r[1])] == [ids[k : k + 300] for k in range(0, len(ids), 300)]


def test_one_code_with_all_claims(spark):
    rng = random.Random(8)
    data = [(k, k % 40 or None, rng.choice(["x"] * 20 + ["y", None]), rng.choice([None, 0, -5, rng.randrange(60_000), rng.randrange(200_000)])) for k in range(3000)]
    df = spark.createDataFrame(data, "claim_id long, patient_id long, code string, amount_cents long")
    out = [rows(claims.similar_claim_counts(df, hot_rows=n)) for n in (10_000_000, 100)]
    assert out[0] == out[1] and len(out[0]) == 3000
    by_id = {r[0]: r[1:] for r in out[0]}
    for k, p, c, a in data[:200]:
        others = [x for x in data if x[0] != k and c is not None and x[2] == c and a is not None and a > 0 and x[3] is not None]
        near = [x for x in others if abs(x[3] - a) < claims.NEAR_CENTS]
        same = sum(x[1] == p and p is not None for x in near)
        close = sum(x[1] == p and p is not None for x in others if claims.NEAR_CENTS <= abs(x[3] - a) < claims.CLOSE_CENTS)
        assert by_id[k] == (same, len(near) - same, close)


def test_substrings_of_skewed_profiles(spark):
    rng = random.Random(5)
    names = ["".join(rng.choice("aaaab ") for _ in range(rng.randrange(9))) for _ in range(400)] + ["Ärger AAA", None, "aaaaaaaaaaz"]
    prof = [(n, None if k % 17 == 0 else k // 2, None if k % 13 == 0 else f"v{k}") for k, n in enumerate(names)]
    asked = [None, "", "a", "AB", "zz", "aab", "aaaaaaz", "aaab", "är", "ä", " ", "aaaa", "baab", "qaaa"]
    df = spark.createDataFrame(list(enumerate(asked)), "id int, name string")
    profiles = spark.createDataFrame(prof, "full string, o int, type string")
    got = {r.id: r.type for r in predicates.match_substring(df, "name", profiles, "full", "o", "type", "none").collect()}
    for k, name in enumerate(asked):
        hits = [(o, v is not None, v or "") for n, o, v in prof if name and n is not None and o is not None and name.lower() in n.lower()]
        assert got[k] == (min(hits)[2] if hits and min(hits)[1] else "none"), name
    plan = predicates.match_substring(df, "name", profiles, "full", "o", "type", "none")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert predicates.match_substring(df, "name", profiles.limit(0), "full", "o", "type", "none").filter("type = 'none'").count() == len(asked)


def test_saved_index_reads_probed_folders(spark, tmp_path):
    rng = np.random.default_rng(4)
    vecs = [[float(x) for x in v] for v in rng.standard_normal((1500, 12))]
    vecs[3], vecs[4] = None, [0.0] * 12
    corpus = spark.createDataFrame(list(enumerate(vecs)), "id long, vec array<double>")
    path = str(tmp_path / "index")
    neighbours.write_index(corpus.filter("id < 900"), path, dim=12, bits=5, tables=8)
    neighbours.append_index(corpus.filter("id >= 900"), path)
    neighbours.append_index(corpus.filter("id >= 1400"), path)  # a repeated job
    asked = corpus.filter("id % 10 = 0").select(F.col("id").alias("query_id"), "vec")
    exact = {(r.query_id, r.id) for r in neighbours.nearest(corpus, asked, 5).collect()}
    found = {}
    for probes in (0, 2):
        out = neighbours.search_index(asked, path, k=5, probes=probes).collect()
        assert len({(r.query_id, r.id) for r in out}) == len(out) == 5 * 150
        found[probes] = len(exact & {(r.query_id, r.id) for r in out})
    assert found[2] > found[0] and found[2] >= 0.9 * len(exact)
    # one query: only its folders are read, a fraction of the index
    one = neighbours._probes("vec", 8, 5, 12, 7, 1)
    folders = [r[0] for r in asked.filter("query_id = 10").select(F.explode(one).alias("b")).select(neighbours._folder(F.col("b"), 3)).distinct().collect()]
    part = neighbours.index_rows(spark, path, folders)
    assert len(folders) <= 16 and "PartitionFilters: [folder" in part._jdf.queryExecution().executedPlan().toString()
    files = {r[0] for r in part.select(F.input_file_name()).distinct().collect()}
    assert all(int(f.split("folder=")[1].split("/")[0]) in folders for f in files)
    # fewer rows than asked for: exact answers
    few = neighbours.search_index(asked.filter("query_id = 10"), path, k=1499, probes=0)
    assert few.count() == 1499
