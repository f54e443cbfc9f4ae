"""Structured Streaming jobs: ledger balances, session memory, request handling.

Results are written as Parquet by micro-batch; a batch that is repeated after a failure overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from agentlake.operators import fulfil
from agentlake.operators.ledger import signed_cash, signed_units
from agentlake.streaming.balances import Balances


def write_by_batch(path: str, work: Callable[[DataFrame, int], DataFrame] | None = None, state: Balances | None = None):
    """A foreachBatch function: the (worked) rows of batch n replace the folder ``path/batch_id=n``, and are added to ``state``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = work(batch, batch_id) if work else batch
        folder = f"{path}/batch_id={batch_id}"
        out.write.mode("overwrite").parquet(folder)
        if state is not None:
            state.add(batch_id, batch.sparkSession.read.schema(out.schema).parquet(folder))

    return write


def _run(stream: DataFrame, checkpoint: str, mode: str, each):
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    q.awaitTermination()
    return q


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str, work=None, state: Balances | None = None):
    """Run a stream over all data there is, then stop."""
    return _run(stream, checkpoint, mode, write_by_batch(path, work, state))


def run_balances(stream: DataFrame, state: Balances, checkpoint: str):
    """Keep ``state`` current with a stream: a batch writes its own sums only, and no state store is needed."""
    return _run(stream, checkpoint, "append", lambda batch, batch_id: state.add(batch_id, batch))


def distinct_events(stream: DataFrame, id_col: str, event_time: str, delay: str) -> DataFrame:
    """Drop repeated deliveries of an id within the watermark, and rows that come later than the watermark allows."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([id_col])


def late_rows(q) -> int:
    """Rows that a finished stream dropped because they came after the watermark had passed them."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in q.recentProgress for s in p["stateOperators"])


def stock_stream(ledger: DataFrame) -> DataFrame:
    """Current stock per item; run in update mode, a batch emits the items it changed."""
    return ledger.filter(F.col("item").isNotNull()).groupBy("item").agg(F.sum(signed_units()).alias("stock"), F.count("*").alias("version"))


def cash_stream(ledger: DataFrame) -> DataFrame:
    """Current cash by transaction type; two small groups, summed on reading."""
    return ledger.groupBy("txn_type").agg(F.sum(signed_cash()).alias("cash"), F.count("*").alias("version"))


def current(written: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Last written row per key of an update-mode stream; ``version`` grows with every change."""
    rest = [c for c in written.columns if c not in keys]
    last = written.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("__r"))
    return last.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def session_stream(turns: DataFrame, n: int = 6, timeout_ms: int | None = None) -> DataFrame:
    """Per session: number of turns, last turn, and the text of the last ``n``. State holds ``n`` turns, not the session.

    ``turns``: session long, seq long, line string. With a timeout a silent session is forgotten.
    """

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        total, seqs, lines = state.get if state.exists else (0, [], [])
        kept = list(zip(seqs, lines))
        for pdf in batches:
            total += len(pdf)
            kept = sorted(kept + list(zip(pdf["seq"].tolist(), pdf["line"].tolist())))[-n:]
        state.update((total, [s for s, _ in kept], [x for _, x in kept]))
        if timeout_ms is not None:
            state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame(
            {"session": [key[0]], "n_turns": [total], "last_seq": [kept[-1][0]], "context": ["\n".join(x for _, x in kept)]}
        )

    return turns.groupBy("session").applyInPandasWithState(
        step, "session long, n_turns long, last_seq long, context string", "total long, seqs array<long>, lines array<string>", "update",
        GroupStateTimeout.NoTimeout if timeout_ms is None else GroupStateTimeout.ProcessingTimeTimeout,
    )


def request_handler(lines: DataFrame, catalog: DataFrame, inventory: DataFrame, ledger: Callable[[int], DataFrame]):
    """Work of a micro-batch of requests: quote against the ledger as it stands before the batch, emit its ledger rows.

    ``ledger(batch_id)`` gives the opening rows and those of earlier batches only, so a repeated batch sees the same.
    """

    def work(requests: DataFrame, batch_id: int) -> DataFrame:
        # quoting keeps the lines of the batch's requests only, and joins them once
        return fulfil.place_orders(lines, requests, catalog, inventory, ledger(batch_id))

    return work


def ledger_state(opening: DataFrame, path: str, every: int = 16) -> Balances:
    """The ledger as sums per item, kind and day: all that stock and cash as of a day need, and no longer than those."""
    state = Balances(opening.sparkSession, path, opening.schema, ["item", "txn_type", "txn_date"], ["units", "price"], every)
    state.open_with(opening)
    return state


def ledger_before(opening: DataFrame, path: str, schema) -> Callable[[int], DataFrame]:
    """Opening ledger plus the rows written by batches before the given one; for few batches, ``ledger_state`` for many."""
    spark = opening.sparkSession

    def at(batch_id: int) -> DataFrame:
        if batch_id == 0:
            return opening
        written = spark.read.schema(f"{schema}, batch_id long").parquet(path).filter(F.col("batch_id") < batch_id)
        return opening.unionByName(written.select(*opening.columns))

    return at
