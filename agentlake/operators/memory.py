"""Session logs and long-term memory as append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.operators.neighbours import _merge, _tiles
from agentlake.operators.scans import first_k, latest, one_per_key

PROTECTED = "default"


def latest_per_session(log: DataFrame, session: str, seq: str) -> DataFrame:
    return latest(log, [session], [F.col(seq)])


def recent_context(log: DataFrame, session: str, seq: str, line: Column, n: int = 6) -> DataFrame:
    """The last ``n`` turns of each session as one text; at most ``n`` rows per session reach the grouping."""
    last = first_k(log.select(session, seq, line.alias("__line")), [session], [F.desc(seq)], n)
    lines = F.transform(F.array_sort(F.collect_list(F.struct(seq, "__line"))), lambda x: x["__line"])
    return last.groupBy(session).agg(F.count("*").alias("n_turns"), F.array_join(lines, "\n").alias("context"))


def sessions(log: DataFrame, session: str) -> DataFrame:
    return log.select(session).distinct()


def remove_sessions(log: DataFrame, gone: DataFrame, session: str) -> DataFrame:
    """The log without the listed sessions; the default session cannot be removed."""
    listed = gone.select(session).filter(F.col(session).cast("string") != PROTECTED).distinct()
    return log.join(listed, session, "left_anti")


def pop_last(log: DataFrame, session: str, seq: str) -> tuple[DataFrame, DataFrame]:
    """(popped rows, remaining log): the last row of each session is taken off."""
    last = log.groupBy(session).agg(F.max(seq).alias("__last"))
    both = log.join(last, session)
    at_end = F.col(seq) == F.col("__last")
    return both.filter(at_end).drop("__last"), both.filter(~at_end).drop("__last")


def namespaces(memory: DataFrame, owner: str = "owner") -> DataFrame:
    return memory.select(owner, "namespace").distinct()


def add_if_absent(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Set insert: rows of ``new`` whose key is not there yet, each key once, after the existing ones.

    Of several new rows with one key, ``scans.one_per_key`` takes one.
    """
    fresh = one_per_key(new.select(*existing.columns), keys).join(existing.select(*keys), keys, "left_anti").select(*existing.columns)
    return existing.unionByName(fresh)


def register(memory: DataFrame, fragments: DataFrame) -> DataFrame:
    """Append fragments; a missing namespace becomes ``default``."""
    return memory.unionByName(fragments.withColumn("namespace", F.coalesce("namespace", F.lit(PROTECTED))))


def save_memory(fragments: DataFrame, path: str, mode: str = "append") -> None:
    """Memory on storage, in folders by namespace, so a search reads only its namespace."""
    fragments.write.mode(mode).partitionBy("namespace").parquet(path)


def time_range(timestamp: str, after: int | None = None, before: int | None = None) -> Column:
    """Open interval; a bound is absent only when it is None."""
    cond = F.lit(True)
    if after is not None:
        cond = cond & (F.col(timestamp) > after)
    if before is not None:
        cond = cond & (F.col(timestamp) < before)
    return cond


def search_memory(
    memory: DataFrame, queries: DataFrame, namespace: str = PROTECTED, after: int | None = None, before: int | None = None,
    k: int = 3, metric: str = "l2",
) -> DataFrame:
    """Nearest fragments of the asking owner in one namespace and open time range, with distances.

    ``memory``: id, owner, namespace, timestamp, vec; ``queries``: query_id, owner, vec. Owners meet by an equi-join;
    an owner too big for one task is cut into blocks.
    """
    kept = memory.filter((F.col("namespace") == namespace) & time_range("timestamp", after, before))
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {memory.schema['id'].dataType.simpleString()}, score double"
    local = _tiles(kept.select("id", "vec", "owner"), queries.select("query_id", "vec", "owner"), k, metric, schema, "owner")
    return _merge(local, k, metric)


def question_answer_fragment(question: Column, answer: Column) -> Column:
    return F.concat(F.lit("Q: "), question, F.lit("\nA: "), answer)
