"""Evaluation of agent runs and of generated plans."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.functions.scalars import token_cost
from agentlake.functions.text import valid_json
from agentlake.operators.scans import latest, lookback

# fixed values: markers of the first and last snapshot of a run
ENTRY, TERMINATION = "__entry__", "__termination__"


def mean_of(*flags: Column) -> Column:
    ones = [F.coalesce(f.cast("double"), F.lit(0.0)) for f in flags]
    return reduce(lambda a, b: a + b, ones) / len(ones)


def final_response_score(judged: DataFrame) -> DataFrame:
    """Mean of task_completed, format_correct and instructions_followed."""
    return judged.withColumn("score", mean_of(F.col("task_completed"), F.col("format_correct"), F.col("instructions_followed")))


def last_tool_message(messages: DataFrame, run: str = "run_id", seq: str = "seq") -> DataFrame:
    """Last assistant message with tool calls of each run."""
    return latest(messages.filter((F.col("role") == "assistant") & (F.size("tool_calls") > 0)), [run], [F.col(seq)])


def single_step_scores(runs: DataFrame, messages: DataFrame) -> DataFrame:
    """Score of the last tool-calling message: tool choice counts twice, valid arguments once; no call gives 0.

    ``runs``: run_id, expected_tools array; ``messages``: run_id, seq, role, tool_calls array<struct<name, arguments>>.
    """
    last = last_tool_message(messages).select("run_id", "tool_calls")
    out = runs.join(last, "run_id", "left")
    called = F.col("tool_calls").isNotNull()
    right = F.coalesce(F.arrays_overlap(F.transform("tool_calls", lambda c: c["name"]), F.col("expected_tools")), F.lit(False))
    args = F.coalesce(F.forall("tool_calls", lambda c: valid_json(c["arguments"])), F.lit(False))
    return out.select(
        "run_id", called.alias("called"), right.alias("right_tool"), args.alias("valid_arguments"), mean_of(right, args, right).alias("score")
    )


def tools_used(messages: DataFrame) -> DataFrame:
    """Number of tool calls, distinct tool names and whether there is an answer, per run."""
    ai = F.col("role") == "assistant"
    # names are taken apart in their row, so a run's set holds each tool once, however many calls there are
    rows = messages.select(
        "run_id", (ai & (F.length(F.coalesce("content", F.lit(""))) > 0)).alias("answer"),
        F.posexplode_outer(F.when(ai, F.transform("tool_calls", lambda c: c["name"]))).alias("call", "name"),
    )
    return rows.groupBy("run_id").agg(
        F.count("call").alias("n_calls"),
        F.collect_set("name").alias("used"),
        F.coalesce(F.bool_or("answer"), F.lit(False)).alias("has_answer"),
    )


def trajectory_scores(runs: DataFrame, messages: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Score of whole runs: mean of (expected tool used within the step limit), (answer given), (expected tool used),
    (right tool chosen); latency per call; cost of the tokens. A run without snapshots fails with score 0.

    ``runs``: run_id, expected_tools, max_steps (nullable), started, ended (seconds), total_tokens.
    """
    steps = snapshots.groupBy("run_id").agg(
        F.count_if(~F.col("step_id").isin(ENTRY, TERMINATION)).alias("n_steps"), F.count("*").alias("n_snapshots")
    )
    wide = runs.join(steps, "run_id", "left").join(tools_used(messages), "run_id", "left")
    ran = F.col("n_snapshots").isNotNull()
    used = F.coalesce(F.size(F.array_intersect("used", "expected_tools")) > 0, F.lit(False))
    in_limit = F.col("max_steps").isNull() | (F.col("n_steps") <= F.col("max_steps"))
    answer = F.coalesce("has_answer", F.lit(False))
    seconds = F.coalesce(F.col("ended") - F.col("started"), F.lit(0.0))
    calls = F.coalesce("n_calls", F.lit(0))
    return wide.select(
        "run_id", ran.alias("ran"), F.coalesce("n_steps", F.lit(0)).alias("n_steps"), calls.alias("n_calls"),
        F.when(ran, mean_of(used & in_limit, answer, used, used)).otherwise(0.0).alias("score"),
        F.when(ran, seconds / F.greatest(calls, F.lit(1))).otherwise(0.0).alias("latency"),
        token_cost(F.coalesce("total_tokens", F.lit(0))).alias("cost"),
    )


def token_totals(messages: DataFrame, run: str = "run_id", tokens: str = "total_tokens") -> DataFrame:
    total = F.coalesce(F.sum(tokens), F.lit(0))
    return messages.groupBy(run).agg(total.alias("tokens"), token_cost(total).alias("cost"))


def step_transitions(steps: DataFrame, run: str, seq: str, step: str, slice_by: Column) -> DataFrame:
    """Every step with the step before it, entry and termination left out."""
    real = steps.filter(~F.col(step).isin(ENTRY, TERMINATION))
    return lookback(real, [run], [seq], slice_by, {"previous": ("lag", step, 1)}, 1, seq="step_no")


def run_durations(steps: DataFrame, run: str, step: str, at: str) -> DataFrame:
    return steps.groupBy(run).agg(
        F.count_if(~F.col(step).isin(ENTRY, TERMINATION)).alias("n_steps"), (F.max(at) - F.min(at)).alias("duration")
    )


def routing_quality(df: DataFrame, predicted: str, expected: str, urgent: str, special: str, keys: list[str]) -> DataFrame:
    """Totals, accuracy in percent and the pass rule: accuracy >= 80, two special cases, one urgent case."""
    out = df.groupBy(*keys).agg(
        F.count("*").alias("total"), F.count_if(F.col(predicted).eqNullSafe(F.col(expected))).alias("correct"),
        F.count_if(F.col(urgent)).alias("n_urgent"), F.count_if(F.col(special)).alias("n_special"),
    )
    accuracy = F.when(F.col("total") > 0, F.col("correct") * 100.0 / F.col("total")).otherwise(0.0)
    passed = (accuracy >= 80) & (F.col("n_special") >= 2) & (F.col("n_urgent") >= 1)
    return out.withColumns({"accuracy": accuracy, "passed": passed})


def run_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Apply named checks in one pass. A check is a message column, null where the row passes.

    Adds ``success``, ``failures`` (messages) and ``failed_checks`` (names).
    """
    both = F.array_compact(
        F.array(*[F.when(c.isNotNull(), F.struct(F.lit(n).alias("name"), c.cast("string").alias("message"))) for n, c in checks.items()])
    )
    return df.withColumn("__f", both).withColumns(
        {
            "success": F.size("__f") == 0,
            "failures": F.transform("__f", lambda x: x["message"]),
            "failed_checks": F.transform("__f", lambda x: x["name"]),
        }
    ).drop("__f")


def required_fields(df_schema, required: Mapping[str, str]) -> list[str]:
    """Messages for fields a schema lacks or has under another type."""
    have = {f.name: f.dataType.simpleString() for f in df_schema.fields}
    out = [f"missing field {n}" for n in required if n not in have]
    return out + [f"field {n} is {have[n]}, expected {t}" for n, t in required.items() if n in have and have[n] != t]


def missing_values(required: list[str]) -> Column:
    """Message naming the required fields that are null in the row, or null."""
    gone = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in required]))
    return F.when(F.size(gone) > 0, F.concat(F.lit("missing: "), F.array_join(gone, ", ")))
