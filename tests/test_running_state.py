"""Running sums of a stream: replayed batches, snapshots, how much a reader touches; routes that need routes; late rows."""

import pytest
from pyspark.sql import functions as F

from agentlake.operators import models
from agentlake.streaming.balances import Balances


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_balances_against_a_plain_sum(spark, tmp_path):
    schema = spark.createDataFrame([], "item long, day string, units long").schema
    state = Balances(spark, f"{tmp_path}/s", schema, ["item", "day"], ["units"], every=3)
    state.open_with(spark.createDataFrame([(1, "a", 100), (None, None, 5)], schema))
    batches = [[(i % 4, "ab"[i % 2], n * 10 + i) for i in range(6)] + [(None, None, 1)] for n in range(11)]
    total = {(1, "a"): 100, (None, None): 5}
    read = []
    for n, batch in enumerate(batches):
        want = sorted(((*k, v) for k, v in total.items()), key=str)
        assert rows(state.before(n)) == want
        state.add(n, spark.createDataFrame(batch, schema))
        state.add(n, spark.createDataFrame(batch, schema))  # repeated after a failure
        assert rows(state.before(n)) == want
        if n:
            state.add(n - 1, spark.createDataFrame(batches[n - 1], schema)) if n % 3 else None
        for item, day, units in batch:
            total[item, day] = total.get((item, day), 0) + units
        read.append(len(state.before(n + 1).inputFiles()))
    assert rows(state.now()) == sorted(((*k, v) for k, v in total.items()), key=str)
    assert max(read[6:]) <= max(read[:6])  # what is read does not grow with the batches
    assert len(state._numbers("snapshot")) == 2 and len(state._numbers("delta")) < 6


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    schema = spark.createDataFrame([], "item long, units long").schema
    state = Balances(spark, f"{tmp_path}/s", schema, ["item"], ["units"], every=2)
    for n in range(4):
        state.add(n, spark.createDataFrame([(1, 1)], schema))
    (tmp_path / "s" / "snapshot" / "3" / "_SUCCESS").unlink()
    assert rows(state.now()) == [(1, 4)]
    assert rows(Balances(spark, f"{tmp_path}/none", schema, ["item"], ["units"]).now()) == []


def test_levels_of_needs():
    assert models._levels({"a": ["b"], "b": ["c", "x"], "d": ["x"]}) == [["b", "d"], ["a"]]
    assert models._levels({}) == []
    with pytest.raises(ValueError, match="circle"):
        models._levels({"a": ["b"], "b": ["a"]})


def test_a_step_is_embedded_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def embed(step):
        calls.add(1)
        return [float(step.startswith(c)) for c in "abc"]

    routes = spark.createDataFrame([(c, [float(c == d) for d in "abc"]) for c in "abc"], "route string, vec array<double>")
    plans = spark.createDataFrame([(1, "c one\nb two\na three"), (2, "a\na"), (3, "c"), (4, None)], "id long, plan string")
    model = lambda ps: [p.replace("\n", "/") for p in ps]
    out = models.run_steps(plans, "id", "plan", embed("step"), routes, model, {"c": ["b", "a"], "b": ["a"]})
    got = {r.id: [tuple(s) for s in r.steps] for r in out.collect()}
    assert got[1] == [("c", "c: c one/b: b two/a: a three/a: a three"), ("b", "b: b two/a: a three"), ("a", "a: a three")]
    assert got[2] == [("a", "a: a"), ("a", "a: a")] and got[3] == [("c", "c: c")] and set(got) == {1, 2, 3}
    assert calls.value == 6
