"""Manifest against a tree built whole, and its proofs against tampered rows."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from agentlake.llm import entries, merkle
from agentlake.plans.check import compare, connect


def test_query(spark, sf):
    name = "op12_merkle_manifest"
    ok, message, _ = compare(spark, connect(sf), sf, name, entries.QUERIES[name], entries.ORACLE[name])
    assert ok, message


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, fanout):
    """(root, siblings of each node's path)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in zip(paths, at):
            b = i - i % fanout
            p.append(("".join(nodes[b:i]), "".join(nodes[i + 1 : b + fanout])))
        nodes, at = [digest(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)], [i // fanout for i in at]
    return nodes[0], paths


def plain(rows, fanout):
    """rows: (key, group, value)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    subs = []
    for g in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        found = sorted(groups[g], key=lambda x: x[:3])
        subs.append((found, *climb([x[2] for x in found], fanout)))
    root, tops = climb([s[1] for s in subs], fanout)
    out = []
    for (found, sub, paths), top in zip(subs, tops):
        for (_, _, h, key), p in zip(found, paths):
            whole = p + top
            out.append((key, h, sub, root, [a for a, _ in whole], [b for _, b in whole]))
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout, height", [(2, 0), (2, 1), (3, 1), (8, 4), (2, 2)])
def test_whole_tree(spark, fanout, height):
    rows = [(i, "big", f"t{i}") for i in range(45)] + [(i * 7 % 50, None, None) for i in range(17)] + [(1, "é", "x"), (2, "z", "y"), (2, "z", "y"), (9, "", "")]
    rows += [(None, "z", "n"), (2, "z", "a"), (-5, "z", "m")] + [(i, f"g{i}", "same") for i in range(9)]
    df = spark.createDataFrame(rows, "id long, lang string, text string").repartition(5)
    out = merkle.manifest(df, ["id", "lang", "text"], "id", "lang", fanout=fanout, height=height)
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(rows, fanout)


def test_proofs_find_tampering(spark):
    rows = [(i, "ab"[i % 2], f"Text {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "id long, lang string, text string")
    other = F.when(F.col("id") == 7, merkle.leaf_hash([F.col("id"), F.col("lang"), F.lower("text")]))
    out = merkle.manifest(df, ["id", "lang", "text"], "id", "lang", {"other": other}, fanout=3, height=1)
    folded = merkle.fold(F.coalesce("other", "leaf"), F.col("left"), F.col("right"))
    assert [r.id for r in out.where(folded != F.col("root")).collect()] == [7]
    proof = out.select("id", merkle.proof_hash(F.col("left"), F.col("right")).alias("p")).where("id = 3").first().p
    (want,) = [r for r in plain(rows, 3) if r[0] == 3]
    assert proof == digest(*(a + b for a, b in zip(want[4], want[5])))


def test_odd_tables(spark):
    df = spark.createDataFrame([(5, "a", "x" * 300_000)], "id long, lang string, text string")
    (one,) = merkle.manifest(df, ["id", "text"], "id", "lang").collect()
    assert one.leaf == one.subroot == one.root == leaf((5, "x" * 300_000)) and one.left == one.right == []
    assert merkle.manifest(df.limit(0), ["id", "text"], "id", "lang").count() == 0
    names = ["tree", "block", "pos", "size", "k", "leaf", "root", "left", "right", "_m", "_at", "n", "_c0"]
    clash = df.select("id", "lang", "text", *[F.lit("?").alias(c) for c in names])
    assert merkle.manifest(clash, ["id", "text"], "id", "lang").first().root == one.root
    assert merkle.manifest(clash, ["id", "text"], "id", "tree", {"block": F.col("left")}).first()["block"] == "?"
    nulls = spark.createDataFrame([(None, None, None)] * 3, "id long, lang string, text string")
    assert sorted(map(str, merkle.manifest(nulls, ["id", "lang", "text"], "id", "lang", fanout=2).collect()))[0].count(digest("---")) >= 2
