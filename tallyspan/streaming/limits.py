"""Rate limiters over arriving calls.

The fixed-window limiter keeps state by service and window: what was admitted so far, and which calls,
so that a call delivered again in a later batch keeps its verdict and consumes nothing. At most ``qpm``
calls of a window are ever admitted, which bounds its state; a timer drops it once the watermark has
passed the window's end. A service without a name is one service. The calls of one window that
arrive in one micro-batch meet in one task, so bound the batch (``maxFilesPerTrigger``) as you would
for any stream; calls that need no state are spread.

The token bucket runs the batch limiter per micro-batch from the levels of the batch before. Verdicts and
levels are written under the batch's number: a batch that is run again reads the same levels and
replaces its own folders, so every call gets one verdict.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyspan.operators import limits
from tallyspan.storage import settle
from tallyspan.streaming.runs import keyed_state

#: Tasks that share calls which need no state.
SPREAD = 64
OWN = ["_qpm", "_tpm", "_limited", "_timed", "_at", "_ends", "_request", "_tokens",
       "_service", "_nameless", "_window", "_spread"]


class FixedWindow(StatefulProcessor):
    """Verdicts for the calls of one service and window; state: balance and admitted calls."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.balance = handle.getValueState("balance", "calls bigint, spent bigint")
        self.admitted = handle.getListState("admitted", "at bigint, request string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        calls = pd.concat(list(rows), ignore_index=True)
        calls.columns = self.columns + OWN  # names that are no Python names do not arrive
        order = calls.sort_values(["_at", "request_id"], na_position="first", kind="stable").index
        calls.loc[order, "_order"] = np.arange(len(calls))
        limited, timed = calls["_limited"].iloc[0], calls["_timed"].iloc[0]
        if not limited or not timed:
            yield self._verdict(calls, np.full(len(calls), not limited), "no_time")
        elif timerValues.getCurrentWatermarkInMs() >= calls["_ends"].iloc[0]:
            yield self._verdict(calls, np.zeros(len(calls), dtype=bool), "late")
        else:
            yield self._admit(calls)

    def _admit(self, calls: pd.DataFrame) -> pd.DataFrame:
        known = self.balance.exists()
        count, spent = self.balance.get() if known else (0, 0)
        before = set(map(tuple, self.admitted.get())) if known else set()
        qpm, tpm = int(calls["_qpm"].iloc[0]), int(calls["_tpm"].iloc[0])
        # A call delivered several times counts once, with the most tokens it was reported with.
        each = calls.groupby(["_at", "_request"], dropna=False, sort=False).agg(
            tokens=("_tokens", "max"), order=("_order", "min")).reset_index()
        each["_request"] = each["_request"].astype(object).where(each["_request"].notna(), None)
        names = list(zip(each["_at"].tolist(), each["_request"].tolist()))
        each["old"] = [name in before for name in names]
        new = each[~each["old"]].sort_values("order")
        tokens = new["tokens"].to_numpy()
        had = spent + np.cumsum(tokens) - tokens
        fits = (count + np.arange(len(new)) < qpm) & (had < tpm)
        taken = new.index[fits]
        if len(taken):
            self.balance.update((count + len(taken), int(spent + tokens[fits].sum())))
            self.admitted.appendList([names[k] for k in taken])
            spent += int(tokens[fits].sum())
        if not known and len(taken):
            self.handle.registerTimer(int(calls["_ends"].iloc[0]))
        each["fits"] = each["old"]
        each.loc[taken, "fits"] = True
        verdicts = dict(zip(names, each["fits"].tolist()))
        asked = zip(calls["_at"].tolist(), calls["_request"].astype(object).where(
            calls["_request"].notna(), None).tolist())
        return self._verdict(calls, np.array([verdicts[name] for name in asked]),
                             "tpm" if spent >= tpm else "qpm")

    def _verdict(self, calls: pd.DataFrame, admitted: np.ndarray, reason: str) -> pd.DataFrame:
        out = calls[self.columns].copy()
        out["admitted"] = admitted
        out["limit_status"] = np.where(admitted, 200, 429).astype("int32")
        out["limit_hit"] = np.where(admitted, None, reason)
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.balance.clear()
        self.admitted.clear()
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def _numbered_batches(
    source: DataFrame, path: str,
    step: Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]],
    available_now: bool,
) -> StreamingQuery:
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carried = None
        if batch_id > 0:
            carried = spark.read.parquet(f"{path}/balances/batch={batch_id - 1}")
        verdicts, balances = step(batch, carried)
        balances.write.mode("overwrite").parquet(f"{path}/balances/batch={batch_id}")
        verdicts.write.mode("overwrite").parquet(f"{path}/verdicts/batch={batch_id}")

    writer = source.writeStream.foreachBatch(run).option(
        "checkpointLocation", f"{path}/checkpoint"
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_rate_limit(
    source: DataFrame, path: str, limits_table: DataFrame, window: str = "1 minute",
    key: str = "provider", delay: str = "15 minutes", available_now: bool = True,
) -> StreamingQuery:
    """The fixed-window limiter online; verdicts appear under ``path/verdicts``.

    ``limits_table`` is (key, qpm, tpm), as for the batch limiter. Calls are ordered by (event_time,
    request_id) within a batch; those of a window that ended ``delay`` before the newest call of earlier
    batches are rejected as ``late``, calls of limited services without a time as ``no_time``.
    """
    spark = source.sparkSession
    limited = F.col("_qpm").isNotNull()
    timed = F.col("window_start").isNotNull()
    kept = limited & timed
    # The watermark is taken from a copy that goes no further: late calls get a verdict, too.
    seen = source.withColumn("_seen", F.col("event_time").cast("timestamp")).withWatermark("_seen", delay)
    calls = limits.limited_calls(seen.drop("_seen"), limits_table, window, key)
    columns = [c for c in calls.columns if c not in ("_qpm", "_tpm")]
    at = F.unix_micros(F.col("event_time").cast("timestamp"))
    length = limits.seconds_of(window) * 1000
    start = F.unix_micros(F.col("window_start").cast("timestamp"))
    # Keys hold no nulls: pandas takes two of them for different keys.
    own = [
        F.col("_qpm"), F.col("_tpm"), limited, timed, at, F.floor(start / 1000) + length,
        F.col("request_id").cast("string"), F.coalesce(F.col("total_tokens"), F.lit(0)).cast("bigint"),
        F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(key).isNull(),
        F.when(kept, start).otherwise(0),
        F.when(kept, 0).otherwise(1 + F.pmod(F.xxhash64("request_id"), F.lit(SPREAD))).cast("int"),
    ]
    ready = calls.select(*columns, *[c.alias(name) for c, name in zip(own, OWN)])
    kinds = {name: kind for name, kind in calls.dtypes}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    verdicts = ready.groupBy("_service", "_nameless", "_window", "_spread").transformWithStateInPandas(
        FixedWindow(columns), f"{schema}, admitted boolean, limit_status int, limit_hit string",
        "append", "eventTime",
    )

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/verdicts/batch={batch_id}")

    writer = verdicts.writeStream.foreachBatch(run).outputMode("append").option(
        "checkpointLocation", f"{path}/checkpoint"
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    with keyed_state(spark):
        return writer.start()


def stream_token_bucket(
    source: DataFrame, path: str, rate: int, burst: int, interval: str = "1 minute",
    key: str = "provider", available_now: bool = True, allowances: DataFrame | None = None,
) -> StreamingQuery:
    """The bursting limiter online; one level per service is carried on.

    ``allowances`` (key, rate, burst) replace both for the services they name, as in the batch form.
    """

    def step(batch: DataFrame, carried: DataFrame | None):
        levels = settle(
            limits.bucket_levels(batch, rate, burst, interval, key, carried, allowances), "levels"
        )
        verdicts = limits.grant(batch, levels, burst, interval, key, allowances)
        kept = levels.groupBy(key).agg(
            F.max("window_start").alias("window_start"),
            F.max_by("level", "window_start").alias("level"),
        )
        if carried is not None:
            # One row a service, the nameless one included: the later interval, and this batch's level if any.
            both = kept.withColumn("_now", F.lit(1)).unionByName(
                carried.select(key, "window_start", "level", F.lit(0).alias("_now")))
            kept = both.groupBy(key).agg(
                F.max("window_start").alias("window_start"), F.max_by("level", "_now").alias("level"))
        return verdicts, kept

    return _numbered_batches(source, path, step, available_now)
