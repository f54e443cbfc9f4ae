"""Model calls over rows. A model is any function ``list[str] -> list[str]``; one batch per call, errors per row."""

from __future__ import annotations

import inspect
import json
import typing
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agentlake.core import stable
from agentlake.functions.text import lines_of, outer_object, strip_fences
from agentlake.operators.neighbours import route
from agentlake.operators.predicates import fan_out

Model = Callable[[list[str]], list[str]]


def call_batch(model: Model, prompts: list[str]) -> tuple[list, list]:
    """(answers, errors). A failing batch is repeated row by row, so one bad row costs no other."""
    try:
        answers = list(model(prompts))
        if len(answers) != len(prompts):
            raise ValueError("the model returned another number of answers")
        return answers, [None] * len(prompts)
    except Exception as whole:
        if len(prompts) == 1:
            return [None], [f"{type(whole).__name__}: {whole}"]
    pairs = [call_batch(model, [p]) for p in prompts]
    return [a[0] for a, _ in pairs], [e[0] for _, e in pairs]


def answer_column(model: Model, prompt: Column) -> Column:
    """Struct (answer, error) from an Arrow-batched call; null prompts are not sent."""

    @F.pandas_udf("answer string, error string")
    def ask(s: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"answer": [None] * len(s), "error": [None] * len(s)}, dtype=object)
        sent = s.notna().to_numpy().nonzero()[0]
        if len(sent):
            out.loc[sent, "answer"], out.loc[sent, "error"] = call_batch(model, s.iloc[sent].tolist())
        return out

    return ask(prompt)


def prompt_of(text: Column, persona: str | None = None, knowledge: Column | str | None = None) -> Column:
    """Plain, persona, or persona and knowledge prompt."""
    parts = []
    if persona:
        parts.append(F.lit(f"You are {persona}."))
    if knowledge is not None:
        parts.append(F.concat(F.lit("Use only this knowledge: "), knowledge if isinstance(knowledge, Column) else F.lit(knowledge)))
    return F.concat_ws("\n", *parts, text)


def complete(df: DataFrame, prompt: str | Column, model: Model, out: str = "answer", error: str = "error") -> DataFrame:
    """One answer per row; rows the model failed on carry an error text and a null answer."""
    col = F.col(prompt) if isinstance(prompt, str) else prompt
    return df.withColumn("__a", answer_column(model, col)).select(*df.columns, F.col("__a.answer").alias(out), F.col("__a.error").alias(error))


def parse_structured(df: DataFrame, col: str, schema: T.StructType | str, out: str = "parsed", fallback: Column | None = None) -> DataFrame:
    """Model text to a struct: fences cut, outer object parsed, single quotes accepted in a second pass.

    Bad rows keep their text in ``<out>_error`` and take the fallback, null without one.
    """
    body = F.coalesce(F.nullif(outer_object(F.col(col)), F.lit("")), strip_fences(F.col(col)))
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*fields.fields, T.StructField("_bad", T.StringType())])
    read = lambda text, **o: F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", **o})
    good = lambda c: F.when(c.isNotNull() & c["_bad"].isNull(), F.struct(*[c[f.name].alias(f.name) for f in fields.fields]))
    steps = df.withColumn("__body", body).withColumn("__j", read(F.col("__body"), allowSingleQuotes="false"))
    steps = steps.withColumn("__s", F.when(F.col("__j._bad").isNotNull() | F.col("__j").isNull(), read(F.col("__body"), allowSingleQuotes="true")))
    value = F.coalesce(good(F.col("__j")), good(F.col("__s")))
    done = steps.withColumn("__v", value)
    return done.select(
        *df.columns, (F.coalesce("__v", fallback) if fallback is not None else F.col("__v")).alias(out),
        F.when(F.col("__v").isNull(), F.coalesce(F.col(col), F.lit(""))).alias(f"{out}_error"),
    )


def refine(
    df: DataFrame, prompt: str, worker: Model, judge: Callable[[list[str]], list[str]], threshold: float = 0.8, max_rounds: int = 10
) -> DataFrame:
    """Answer, judge, and try again with the judge's text until the score passes or the rounds are used up.

    ``judge`` gets ``prompt + answer`` texts and returns ``"score|evaluation"``. Only rows that failed go to the next
    round; each round is written once, so a lost executor repeats at most one round.
    Adds response, evaluation, iterations, passed, score.
    """
    pending, finished = df.withColumn("__p", F.col(prompt)), None
    for n in range(1, max_rounds + 1):
        asked = complete(pending, "__p", worker, "response", "__e1")
        text = F.concat(F.col(prompt), F.lit("\n---\n"), F.coalesce("response", F.lit("")))
        judged = complete(asked, text, judge, "__verdict", "__e2")
        score = F.coalesce(F.substring_index("__verdict", "|", 1).try_cast("double"), F.lit(0.0))
        evaluation = F.regexp_extract(F.coalesce("__verdict", "__e2", F.lit("")), r"(?s)^[^|]*\|(.*)$", 1)
        seen = stable(
            judged.select(*df.columns, "response", evaluation.alias("evaluation"), F.lit(n).cast("long").alias("iterations"),
                          (score >= threshold).alias("passed"), score.alias("score"))
        )
        over = seen if n == max_rounds else seen.filter("passed")
        finished = over if finished is None else finished.unionByName(over)
        failed = seen.filter("NOT passed")
        if n == max_rounds or failed.isEmpty():
            return finished
        again = F.concat(F.col(prompt), F.lit("\nEarlier answer: "), F.coalesce("response", F.lit("")), F.lit("\nImprove it: "), F.col("evaluation"))
        pending = failed.select(*df.columns, again.alias("__p"))
    return finished


def ask_experts(df: DataFrame, id_col: str, text: str, experts: Mapping[str, str], model: Model, summarizer: Model) -> DataFrame:
    """Every expert (name -> persona) answers every row, then one summary per row over all answers."""
    wide = fan_out(df.select(id_col, text), list(experts))
    persona = None
    for name, who in experts.items():
        persona = F.when(F.col("expert") == name, who) if persona is None else persona.when(F.col("expert") == name, who)
    asked = complete(wide, F.concat(F.lit("You are "), persona, F.lit(".\n"), F.col(text)), model)
    answers = asked.groupBy(id_col).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("expert", F.coalesce("answer", F.lit("")))))).alias("answers")
    )
    lines = F.transform(F.map_entries("answers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return complete(answers, F.concat(F.lit("Summarize:\n"), F.array_join(lines, "\n")), summarizer, "summary", "summary_error")


def chain(df: DataFrame, stages: Sequence[tuple[str, Callable[[], Column], Model]]) -> DataFrame:
    """Stages (output name, prompt builder, model); later prompts may use earlier outputs as columns."""
    for name, prompt, model in stages:
        df = complete(df, prompt(), model, name, f"{name}_error")
    return df


def _levels(needs: Mapping[str, Sequence[str]]) -> list[list[str]]:
    """The routes of ``needs`` in the order of their levels: each level needs earlier ones and routes without needs only."""
    out, left = [], dict(needs)
    while left:
        ready = sorted(r for r, wanted in left.items() if not any(w in left for w in wanted))
        if not ready:
            raise ValueError(f"routes need each other in a circle: {sorted(left)}")
        out.append(ready)
        for r in ready:
            del left[r]
    return out


def run_steps(
    plans: DataFrame, id_col: str, plan: str, embed: Column, routes: DataFrame, model: Model,
    needs: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Plan text to steps (its lines), each routed to the most similar route and answered; answers in order per plan.

    ``embed`` is the vector column of ``step``. A route listed in ``needs`` is asked when all routes it needs have answered,
    and its prompt carries their answers in the order of the steps. Routes are asked level by level, as many levels as the
    longest chain of needs has routes; a chain that returns to itself is refused.
    """
    needs = {r: list(w) for r, w in (needs or {}).items()}
    levels = _levels(needs)
    steps = plans.select(id_col, F.posexplode(lines_of(F.col(plan))).alias("step_no", "step"))
    sent = route(steps.withColumn("vec", embed), routes).drop("vec", "score")
    if needs:
        sent = stable(sent)  # embedded and routed once, whatever the number of levels
    own = F.concat_ws(": ", "route", "step")
    done = complete(sent.filter(F.col("route").isNull() | ~F.col("route").isin(list(needs))), own, model)
    for level in levels:
        done = stable(done)
        asked_by = {w: [r for r in level if w in needs[r]] for r in level for w in needs[r]}
        mine = sent.filter(F.col("route").isin(level)).withColumn("given", F.lit(None).cast("string"))
        if asked_by:
            asking = F.create_map(*[x for w, by in asked_by.items() for x in (F.lit(w), F.array(*map(F.lit, by)))])
            texts = F.transform(F.array_sort(F.collect_list(F.struct("step_no", "answer"))), lambda x: F.coalesce(x["answer"], F.lit("")))
            given = done.select(id_col, "step_no", "answer", F.explode(asking[F.col("route")]).alias("route"))
            given = given.groupBy(id_col, "route").agg(F.array_join(texts, "\n").alias("given"))
            mine = mine.drop("given").join(given, [id_col, "route"], "left").select(*sent.columns, "given")
        done = done.unionByName(complete(mine, F.concat_ws("\n", own, F.col("given")), model).drop("given"))
    return done.groupBy(id_col).agg(
        F.count("*").alias("n_steps"),
        F.transform(F.array_sort(F.collect_list(F.struct("step_no", "route", "answer"))), lambda x: F.struct(x["route"].alias("route"), x["answer"].alias("answer"))).alias("steps"),
    )


_TYPES = {str: T.StringType(), int: T.LongType(), float: T.DoubleType(), bool: T.BooleanType()}


def spark_type(hint) -> T.DataType:
    """Spark type of a Python hint: str, int, float, bool, list[x], dict[str, x], Optional[x]."""
    if hint in _TYPES:
        return _TYPES[hint]
    origin, args = typing.get_origin(hint), [a for a in typing.get_args(hint) if a is not type(None)]
    if hint is list or origin is list:
        return T.ArrayType(spark_type(args[0]) if args else T.StringType())
    if hint is dict or origin is dict:
        return T.MapType(T.StringType(), spark_type(args[1]) if len(args) > 1 else T.StringType())
    if args and origin is not None:
        return spark_type(args[0])
    return T.StringType()


class Tools:
    """Named Python functions with argument schemas from their signatures."""

    def __init__(self):
        self.functions: dict[str, Callable] = {}

    def add(self, fn: Callable, name: str | None = None) -> Callable:
        self.functions[name or fn.__name__] = fn
        return fn

    def schema(self, name: str) -> T.StructType:
        fn = self.functions[name]
        hints, params = typing.get_type_hints(fn), inspect.signature(fn).parameters
        optional = lambda p: params[p].default is not inspect.Parameter.empty or type(None) in typing.get_args(hints.get(p))
        return T.StructType([T.StructField(p, spark_type(hints.get(p, str)), optional(p)) for p in params])

    def describe(self) -> list[dict]:
        """Name, description, arguments and required arguments of each function."""
        return [
            {"name": n, "description": inspect.getdoc(f) or "", "arguments": {x.name: x.dataType.simpleString() for x in self.schema(n).fields},
             "required": [x.name for x in self.schema(n).fields if not x.nullable]}
            for n, f in self.functions.items()
        ]

    def register(self, spark: SparkSession) -> None:
        """Make every function callable from SQL, with the return type of its hint."""
        for name, fn in self.functions.items():
            kind = spark_type(typing.get_type_hints(fn).get("return", str))
            spark.udf.register(name, F.udf(fn, kind, useArrow=True))

    def dispatch(self, messages: DataFrame, calls: str = "tool_calls") -> DataFrame:
        """Run every tool call of the messages: result text, or an error for unknown names and bad arguments.

        One pass: calls are exploded and answered in Arrow batches by name.
        """
        table, known = dict(self.functions), {n: self.schema(n) for n in self.functions}
        required = {n: [f.name for f in s.fields if not f.nullable] for n, s in known.items()}

        def one(name, arguments):
            if name not in table:
                return None, f"unknown tool {name}"
            try:
                args = json.loads(arguments)
            except (TypeError, ValueError):
                return None, "arguments are not valid JSON"
            if not isinstance(args, dict) or any(r not in args for r in required[name]) or any(a not in known[name].names for a in args):
                return None, "arguments do not fit the tool"
            try:
                value = table[name](**args)
                return value if isinstance(value, str) else json.dumps(value), None
            except Exception as e:
                return None, f"{type(e).__name__}: {e}"

        @F.pandas_udf("result string, error string")
        def run(name: pd.Series, arguments: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([one(n, a) for n, a in zip(name, arguments)], columns=["result", "error"], dtype=object)

        rest = [c for c in messages.columns if c != calls]
        flat = messages.select(*rest, F.posexplode(calls).alias("call_no", "__c"))
        return flat.withColumn("__r", run("__c.name", "__c.arguments")).select(
            *rest, "call_no", F.col("__c.name").alias("tool"), "__r.result", "__r.error"
        )
