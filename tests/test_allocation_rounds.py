"""Sites settled in rounds: equal to the loop, in few rounds, whatever is rejected."""

import random

import pytest

from agentlake.operators import allocation
from tests.test_scale_paths import loop_allocate


def check(spark, lines, stock, most, hot_lines):
    df = spark.createDataFrame(lines, "site long, seq long, item long, quantity long")
    st = spark.createDataFrame([(s, i, a) for (s, i), a in stock.items()], "site long, item long, amount long")
    rounds = []
    got = allocation.allocate(df, st, hot_lines=hot_lines, block=64, hot_rows=500, rounds=rounds)
    assert {(r["site"], r["seq"]): r["accepted"] for r in got.collect()} == loop_allocate(lines, stock)
    assert 0 < len(rounds) <= most


def test_rejections_cost_no_rounds(spark):
    # every second order is refused at its turn, by one unit only
    lines = [(0, seq, 0, 1 if seq % 2 else 5001 - seq // 2) for seq in range(3000)]
    want = loop_allocate(lines, {(0, 0): 5000})
    assert sum(not v for v in want.values()) > 1000
    check(spark, lines, {(0, 0): 5000}, most=4, hot_lines=100)


@pytest.mark.parametrize("seed, items", [(1, 1), (2, 3), (3, 40)])
def test_random_orders(spark, seed, items):
    r = random.Random(seed)
    lines = []
    for seq in range(1500):
        for item in r.sample(range(items), min(items, r.choice([1, 1, 2, 3]))):
            lines.append((seq % 3 // 2, seq, item, r.choice([0, 1, 2, 7, 30, 500])))
    stock = {(s, i): r.choice([0, 3, 50, 4000, 100_000]) for s in range(2) for i in range(items)}
    check(spark, lines, stock, most=-(-len(lines) // 150), hot_lines=150)


def test_an_order_larger_than_a_fold(spark):
    lines = [(0, seq, item, 1 + seq) for seq in range(12) for item in range(60)]
    check(spark, lines, {(0, i): 20 + i % 3 for i in range(60)}, most=12, hot_lines=50)


def test_halves_and_limits(spark):
    big = (1 << 62) + 5
    lines = [(0, 1, 0, big), (0, 2, 0, 3), (0, 3, 0, big - 4), (0, 4, 0, 1), (0, 5, 0, 1), (0, 6, 1, 0), (0, 7, 2, 1)]
    check(spark, lines, {(0, 0): big, (0, 1): 0}, most=7, hot_lines=1)
    check(spark, lines, {(0, 0): (1 << 63) - 1, (0, 1): 0}, most=7, hot_lines=1)


def test_short_folds_do_not_cut_keys_into_many_pieces(spark, monkeypatch):
    # 100 folds fit into either site; the range partitioner samples some 300 rows of each piece on the driver
    lines = [(seq % 2, seq, 0, 1 + seq * 7919 % 97) for seq in range(4000)]
    asked, cut = [], type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda self, n, *cols: asked.append(n) or cut(self, n, *cols))
    df = spark.createDataFrame(lines, "site long, seq long, item long, quantity long")
    stock = {(0, 0): 9000, (1, 0): 9001}
    st = spark.createDataFrame([(s, i, a) for (s, i), a in stock.items()], "site long, item long, amount long")
    got = allocation.allocate(df, st, hot_lines=20)
    assert {(r["site"], r["seq"]): r["accepted"] for r in got.collect()} == loop_allocate(lines, stock)
    assert all(n <= spark.sparkContext.defaultParallelism for n in asked)
