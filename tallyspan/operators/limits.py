"""Rate limits and retries over logged calls.

A limiter only needs the first calls of each window, so that is all it orders: calls delivered
more than once are combined first, every map task then cuts each window to as many calls
as its limit admits, and one row per window goes back to all its calls. There is one way for
windows of every size; Spark splits the last join where a window is large.

``carried`` rows let a stream go on where a batch ended. Calls delivered repeatedly
(same service, time and request) share one verdict and consume once. Services without limits
are not limited. Calls of limited services that carry no time belong to no window: they are rejected, with
``no_time`` as the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.operators.ordered import first_n

ORDER = ["event_time", "request_id"]
# Intervals of one service that are folded in one expression.
BLOCK = 256


def _calls(log: DataFrame, window: str) -> DataFrame:
    """Calls with their window's start; null where the call has no time."""
    kind = dict(log.dtypes)["event_time"]
    # F.window leaves rows without a time out, so they get one for the while.
    known = F.coalesce("event_time", F.lit("1970-01-01").cast(kind))
    calls = log.withColumn("window_start", F.window(known, window)["start"].cast(kind))
    return calls.withColumn(
        "window_start", F.when(F.col("event_time").isNotNull(), F.col("window_start"))
    )


def _distinct(calls: DataFrame, group: list[str]) -> DataFrame:
    """One row per call of a window, however often it was delivered."""
    tokens = F.max(F.coalesce(F.col("total_tokens"), F.lit(0)).cast("bigint"))
    return (
        calls.filter("window_start is not null")
        .groupBy(*group, *ORDER).agg(tokens.alias("_tokens"))
    )


def _same(left: str, right: str, columns: list[str]) -> Column:
    """Equality of all columns, in which nulls are equal."""
    match = F.lit(True)
    for name in columns:
        match = match & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return match


def _beside(rows: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """Rows with the columns of the side's row of the same key, null where there is none."""
    added = [c for c in side.columns if c not in on]
    return rows.alias("l").join(side.alias("r"), _same("l", "r", on), "left").select(
        "l.*", *[f"r.{c}" for c in added]
    )


# -- fixed windows ------------------------------------------------------------


def same_limits(log: DataFrame, qpm: int, tpm: int, key: str = "provider") -> DataFrame:
    """The same limits for every service of a log."""
    return log.select(key).distinct().withColumns({"qpm": F.lit(qpm), "tpm": F.lit(tpm)})


def _limited(calls: DataFrame, limits: DataFrame, key: str) -> DataFrame:
    """Calls with ``_qpm`` and ``_tpm``; a service must have both to be limited.

    Of several rows of a service the lowest limits hold.
    """
    side = limits.filter("qpm is not null and tpm is not null").groupBy(key).agg(
        F.min(F.col("qpm").cast("bigint")).alias("_qpm"),
        F.min(F.col("tpm").cast("bigint")).alias("_tpm"),
    )
    return _beside(calls, side, [key])


def limited_calls(
    log: DataFrame, limits: DataFrame, window: str = "1 minute", key: str = "provider"
) -> DataFrame:
    """Calls with ``window_start``, and ``_qpm`` and ``_tpm`` where their service is limited."""
    return _limited(_calls(log, window), limits, key)


def window_balances(
    log: DataFrame, limits: DataFrame, window: str = "1 minute", key: str = "provider",
    carried: DataFrame | None = None,
) -> DataFrame:
    """Per limited service and window: calls and tokens admitted, and the last admitted call.

    ``limits`` are (key, qpm, tpm); ``carried`` holds earlier balances
    ``(key, window_start, calls, spent)``.
    """
    group = [key, "window_start"]
    limited = _limited(_distinct(_calls(log, window), group), limits, key)
    most = limits.agg(F.max("qpm")).first()[0] or 0  # one number; bounds what a task keeps
    leading = first_n(
        limited.filter("_qpm is not null"), group, [F.col(c) for c in ORDER], int(most)
    ).filter("_rank <= _qpm")
    if carried is None:
        zero = F.lit(0).cast("bigint")
        leading = leading.withColumns({"_calls": zero, "_spent": zero})
    else:
        earlier = carried.select(
            *group, F.col("calls").alias("_calls"), F.col("spent").alias("_spent")
        )
        leading = _beside(leading, earlier, group).fillna(0, ["_calls", "_spent"])
    before = Window.partitionBy(*group).orderBy("_rank").rowsBetween(
        Window.unboundedPreceding, -1)
    spent = F.col("_spent") + F.coalesce(F.sum("_tokens").over(before), F.lit(0))
    fits = (F.col("_calls") + F.col("_rank") <= F.col("_qpm")) & (F.col("_before") < F.col("_tpm"))
    return (
        leading.withColumn("_before", spent)
        .groupBy(*group)
        .agg(
            F.max(F.when(fits, F.struct(*ORDER))).alias("last_admitted"),
            (F.max("_calls") + F.count_if(fits)).alias("calls"),
            (F.max("_spent") + F.coalesce(F.sum(F.when(fits, F.col("_tokens"))), F.lit(0)))
            .alias("spent"),
        )
    )


def rate_limit_fixed(
    log: DataFrame, limits: DataFrame, window: str = "1 minute", key: str = "provider",
    carried: DataFrame | None = None,
) -> DataFrame:
    """Which calls a per-window limiter admits, and which ceiling stopped the rest.

    A call is admitted while fewer than ``qpm`` calls and fewer than ``tpm`` tokens of its service
    were admitted before it in its window; a rejected call consumes nothing, so the admitted
    calls are the first ones of the window. Ordered by (event_time, request_id); missing
    tokens count as 0.
    """
    balances = window_balances(log, limits, window, key, carried)
    return judge(log, balances, limits, window, key)


def judge(
    log: DataFrame, balances: DataFrame, limits: DataFrame, window: str, key: str,
    horizon: Column | None = None,
) -> DataFrame:
    """Every call with its verdict, given the balance of its window.

    Calls of windows that begin before ``horizon`` come too late to be counted: they are
    rejected as ``late``.
    """
    side = balances.select(
        key, "window_start", F.col("last_admitted").alias("_last"), F.col("spent").alias("_spent")
    )
    calls = _beside(_limited(_calls(log, window), limits, key), side, [key, "window_start"])
    late = F.lit(False) if horizon is None else F.coalesce(
        F.col("window_start") < horizon, F.lit(False))
    fits = F.coalesce(F.struct(*ORDER) <= F.col("_last"), F.lit(False)) & ~late
    admitted = F.col("_qpm").isNull() | (F.col("window_start").isNotNull() & fits)
    reason = (
        F.when(F.col("window_start").isNull(), "no_time")
        .when(late, "late")
        .when(F.col("_spent") >= F.col("_tpm"), "tpm")
        .otherwise("qpm")
    )
    return _with_verdict(calls, admitted).withColumn(
        "limit_hit", F.when(~F.col("admitted"), reason)
    ).drop("_qpm", "_tpm", "_last", "_spent")


def _with_verdict(calls: DataFrame, admitted: Column) -> DataFrame:
    return calls.withColumn("admitted", F.coalesce(admitted, F.lit(False))).withColumn(
        "limit_status", F.when(F.col("admitted"), 200).otherwise(429)
    )


# -- token bucket -------------------------------------------------------------


def _clamp() -> str:
    """One interval after the state ``s`` (add, low, high, at): refill, then take."""
    gain = "(_rate * greatest(0L, x.at - s.at) - x.wanted)"
    inside = f"least(greatest({{}} + {gain}, 0L), _burst - x.wanted)"
    return (
        f"named_struct('add', s.add + {gain}, 'low', {inside.format('s.low')},"
        f" 'high', {inside.format('s.high')}, 'at', greatest(s.at, x.at))"
    )


def _allowed(
    calls: DataFrame, rate: int, burst: int, allowances: DataFrame | None, key: str
) -> DataFrame:
    """Calls with ``_rate`` and ``_burst``: their service's own, else the ones for all."""
    plain = [F.lit(value).cast("bigint") for value in (rate, burst)]
    if allowances is None:
        return calls.withColumns({"_rate": plain[0], "_burst": plain[1]})
    side = allowances.groupBy(key).agg(
        *[F.greatest(F.min(F.col(name).cast("bigint")), F.when(F.min(name).isNotNull(), 0)).alias(f"_own_{name}")
          for name in ("rate", "burst")]
    )
    return _beside(calls, side, [key]).withColumns({
        "_rate": F.coalesce("_own_rate", plain[0]), "_burst": F.coalesce("_own_burst", plain[1]),
    }).drop("_own_rate", "_own_burst")


def bucket_levels(
    log: DataFrame, rate: int, burst: int, interval: str, key: str = "provider",
    carried: DataFrame | None = None, allowances: DataFrame | None = None,
) -> DataFrame:
    """Per service and interval: calls a token bucket grants, and the level it is left at.

    Every interval adds ``rate`` tokens, up to ``burst``; a call takes one. ``allowances`` are
    (key, rate, burst) of services that have their own: a null means the one for all, a negative one
    nothing, and of several rows of a service the lowest hold. Within an interval the
    level only falls, so its admitted calls are its first ones, and an interval turns a
    level x into ``least(greatest(x + refill - wanted, 0), burst - wanted)``. Such clamps make up
    another one, so blocks of ``BLOCK`` intervals are folded side by side; a service is then
    walked through block by block, of which it has one for every ``BLOCK`` intervals of time however
    many calls there were. ``carried`` holds ``(key, window_start, level)`` of the last
    interval seen; late calls take from what is left now and earn no refill.
    """
    group = [key, "window_start"]
    seconds = F.unix_timestamp(F.col("window_start").cast("timestamp"))
    length = seconds_of(interval)
    at = F.floor(seconds / length).cast("bigint")
    counted = _distinct(_calls(log, interval), group).groupBy(*group).agg(F.count("*").alias("calls"))
    demand = (
        _allowed(counted, rate, burst, allowances, key)
        .withColumns({"wanted": F.least("calls", "_burst"), "at": at}).drop("calls")
    )
    own = [F.max("_rate").alias("_rate"), F.max("_burst").alias("_burst")]
    if carried is None:
        demand = demand.withColumns({
            "_level": F.lit(None).cast("bigint"), "_since": F.lit(None).cast("bigint")
        })
    else:
        before = carried.select(key, F.col("level").alias("_level"), at.alias("_since"))
        demand = _beside(demand, before, [key])
    # Late intervals take place now.
    demand = demand.withColumn("now", F.greatest("at", "_since"))
    blocks = demand.withColumn("block", F.floor(F.col("at") / BLOCK)).groupBy(key, "block").agg(
        F.sort_array(F.collect_list(F.struct(
            "window_start", F.col("now").alias("at"), "wanted"))).alias("steps"),
        F.max("_level").alias("_level"), F.max("_since").alias("_since"), *own,
    )
    # A block from the level it finds after its first refill; the start takes everything.
    whole = "named_struct('add', 0L, 'low', 0L, 'high', _burst, 'at', steps[0].at)"
    folded = blocks.withColumn(
        "clamp", F.expr(f"aggregate(steps, {whole}, (s, x) -> {_clamp()})")
    )
    chain = folded.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(
            "block", F.col("steps")[0]["at"].alias("first"), F.col("clamp").alias("c")
        ))).alias("all"),
        F.max("_level").alias("_level"), F.max("_since").alias("_since"), *own,
    )
    found = "least(_burst, s.level + _rate * greatest(0L, x.first - s.at))"
    entered = chain.withColumn("entries", F.expr(
        "aggregate(all, named_struct("
        " 'level', coalesce(_level, _burst), 'at', coalesce(_since, all[0].first),"
        " 'out', cast(array() as array<struct<block:bigint,level:bigint>>)),"
        f" (s, x) -> named_struct('level', least(greatest({found} + x.c.add, x.c.low), x.c.high),"
        "   'at', x.c.at,"
        f"   'out', concat(s.out, array(named_struct('block', x.block, 'level', {found})))),"
        " s -> s.out)"
    )).select(key, F.explode("entries").alias("e")).select(
        key, F.col("e.block").alias("block"), F.col("e.level").alias("entry")
    )
    level = "least(_burst, s.level + _rate * greatest(0L, x.at - s.at))"
    walked = _beside(folded, entered, [key, "block"]).select(key, F.explode(F.expr(
        "aggregate(steps, named_struct('level', entry, 'at', steps[0].at, 'out',"
        " cast(array() as array<struct<window_start:" + dict(demand.dtypes)["window_start"]
        + ",granted:bigint,level:bigint>>)),"
        f" (s, x) -> named_struct('level', {level} - least(x.wanted, {level}), 'at',"
        "   greatest(s.at, x.at), 'out', concat(s.out, array(named_struct("
        f"   'window_start', x.window_start, 'granted', least(x.wanted, {level}),"
        f"   'level', {level} - least(x.wanted, {level}))))),"
        " s -> s.out)"
    )).alias("e"))
    return walked.select(key, "e.*")


def seconds_of(interval: str) -> int:
    number, unit = interval.split()
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    return int(number) * units[unit.rstrip("s")]


def grant(
    log: DataFrame, levels: DataFrame, burst: int, interval: str, key: str = "provider",
    allowances: DataFrame | None = None,
) -> DataFrame:
    """Every call with its verdict, given what its interval grants."""
    group = [key, "window_start"]
    if allowances is not None:  # one number; bounds what a task keeps
        burst = max(burst, allowances.agg(F.max(F.col("burst").cast("bigint"))).first()[0] or 0)
    granted = levels.select(*group, F.col("granted").alias("_granted"))
    leading = first_n(
        _distinct(_calls(log, interval), group), group, [F.col(c) for c in ORDER], burst
    )
    last = (
        _beside(leading, granted, group).filter("_rank <= _granted")
        .groupBy(*group).agg(F.max(F.struct(*ORDER)).alias("_last"))
    )
    calls = _beside(_calls(log, interval), last, group)
    fits = F.col("window_start").isNotNull() & (F.struct(*ORDER) <= F.col("_last"))
    return _with_verdict(calls, fits).drop("_last")


def token_bucket(
    log: DataFrame, rate: int, burst: int, interval: str = "1 minute", key: str = "provider",
    allowances: DataFrame | None = None,
) -> DataFrame:
    """Calls admitted by a limiter that allows a burst and then refills at ``rate``.

    ``allowances`` (key, rate, burst) replace both for the services they name.
    """
    levels = bucket_levels(log, rate, burst, interval, key, allowances=allowances)
    return grant(log, levels, burst, interval, key, allowances)


def final_attempt(attempts: DataFrame, first_backoff: int = 2) -> DataFrame:
    """Retries collapsed to the request: last attempt, how many, seconds slept between.

    Latency is the last attempt's own, so waiting is not billed as model time.
    """
    return (
        attempts.groupBy("request_id")
        .agg(
            F.count("*").alias("attempts"),
            F.max_by("status", "attempt").alias("status"),
            F.max_by("latency_s", "attempt").alias("latency_s"),
        )
        .select(
            "request_id", "attempts", "status", "latency_s",
            (F.lit(first_backoff) * (F.pow(F.lit(2), F.col("attempts") - 1) - 1))
            .cast("long")
            .alias("backoff_s"),
        )
    )
