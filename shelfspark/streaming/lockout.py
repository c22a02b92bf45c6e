"""Account lockout after repeated failures: a stateful stream and its batch form.

An attempt on a locked account is refused before anything is counted. A failure more than the reset time after the last
one starts a new count; the fifth failure locks. The count outlives the lock, so one more failure within the reset time
locks again at once. A success clears count and lock.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Failures that lock, minutes of a lock, minutes after which the count starts again.
MAX_ATTEMPTS, LOCK_MINUTES, RESET_MINUTES = 5, 15, 60

LOCKS = "user_id bigint, locked_at timestamp, locked_until timestamp, attempts int"
LOCK_EVENTS = "user_id bigint, event string, happened_at timestamp, locked_until timestamp, attempts int"
_STATE = "attempts int, last_failed bigint, locked_until bigint"
_NEVER = -(2**62)


@dataclass(frozen=True)
class Rules:
    max_attempts: int = MAX_ATTEMPTS
    lock_minutes: int = LOCK_MINUTES
    reset_minutes: int = RESET_MINUTES

    @property
    def pause_minutes(self) -> int:
        """After a pause this long nothing of the past counts any more."""
        return max(self.lock_minutes, self.reset_minutes)

    def step(self, state: tuple[int, int, int], at: int, failed: bool) -> tuple[tuple[int, int, int], int | None]:
        """One attempt at a time in microseconds: the new state, and the end of a lock that it starts."""
        attempts, last_failed, locked_until = state
        if at < locked_until:
            return state, None
        if not failed:
            return (0, _NEVER, _NEVER), None
        attempts = 1 if last_failed < at - self.reset_minutes * 60_000_000 else attempts + 1
        if attempts < self.max_attempts:
            return (attempts, at, locked_until), None
        until = at + self.lock_minutes * 60_000_000
        return (attempts, at, until), until


START = (0, _NEVER, _NEVER)


def _rows(found: list[tuple[int, int, int, int]]) -> pd.DataFrame:
    out = pd.DataFrame(found, columns=["user_id", "locked_at", "locked_until", "attempts"])
    for c in ("locked_at", "locked_until"):
        out[c] = pd.to_datetime(out[c].astype("int64"), unit="us")
    return out


def attempts(events: DataFrame, failure: str = "error", success: str = "signup") -> DataFrame:
    """The attempts among the events, as (user_id, ts, at, failed); ``at`` is the time in microseconds."""
    kind = F.col("event_type")
    return events.where(kind.isin(failure, success)).select(
        "user_id", "ts", F.unix_micros("ts").alias("at"), (kind == failure).alias("failed")
    )


def lock_stream(tries: DataFrame, rules: Rules = Rules(), delay: str = "1 hour") -> DataFrame:
    """Locks as they happen. State is three numbers per account and is dropped once nothing of it can count.

    A task sorts the attempts of one account within a micro-batch; bound a micro-batch by ``maxFilesPerTrigger``.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.get if state.exists else START
        found = []
        rows = pd.concat(list(batches)).sort_values(["at", "failed"])
        for at, failed in zip(rows["at"], rows["failed"]):
            now, until = rules.step(now, int(at), bool(failed))
            if until is not None:
                found.append((key[0], int(at), until, now[0]))
        state.update(now)
        drop_at = (int(rows["at"].iloc[-1]) // 1000) + rules.pause_minutes * 60_000 + 1
        state.setTimeoutTimestamp(max(drop_at, state.getCurrentWatermarkMs() + 1))
        yield _rows(found)

    return tries.withWatermark("ts", delay).groupBy("user_id").applyInPandasWithState(
        update, LOCKS, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


class LockEvents(StatefulProcessor):
    """State of one account: count, last failure and end of the lock, a timer for the unlock and one for forgetting.

    Attempts come sorted within a micro-batch. The unlock is told by the first attempt after it, or by its timer where no
    attempt comes; the state goes by a timer once nothing of it can count any more.
    """

    def __init__(self, rules: Rules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("account", T.StructType([
            T.StructField("attempts", T.IntegerType()), T.StructField("last_failed", T.LongType()),
            T.StructField("locked_until", T.LongType()), T.StructField("told", T.BooleanType()),
        ]))

    def _known(self) -> tuple[tuple[int, int, int], bool]:
        if not self.state.exists():
            return START, True
        *now, told = self.state.get()
        return tuple(now), bool(told)

    def _timers(self, unlock: int | None, forget: int) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(forget)
        if unlock is not None:
            self.handle.registerTimer(unlock)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, told = self._known()
        found, last = [], 0
        tries = pd.concat(list(rows)).sort_values(["at", "failed"])
        for at, failed in zip(tries["at"], tries["failed"]):
            last = int(at)
            if not told and last >= now[2]:
                found.append((key[0], "unlocked", now[2], now[2], now[0]))
                told = True
            now, until = self.rules.step(now, last, bool(failed))
            if until is not None:
                found.append((key[0], "locked", last, until, now[0]))
                told = False
        self.state.update((*now, told))
        # a timer that is due before the watermark would never fire, so it is set just behind it
        after = timerValues.getCurrentWatermarkInMs() + 1
        forget = max(last // 1000 + self.rules.pause_minutes * 60_000 + 1, after)
        self._timers(None if told else max(-(-now[2] // 1000), after), forget)
        yield _event_rows(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, told = self._known()
        found, due = [], expiredTimerInfo.getExpiryTimeInMs()
        if not told and due * 1000 >= now[2]:
            found.append((key[0], "unlocked", now[2], now[2], now[0]))
            told = True
            self.state.update((*now, told))
        # the timer that is firing is still listed
        if all(at <= due for at in self.handle.listTimers()):
            self.state.clear()
        yield _event_rows(found)

    def close(self) -> None:
        pass


def _event_rows(found: list[tuple[int, str, int, int, int]]) -> pd.DataFrame:
    out = pd.DataFrame(found, columns=["user_id", "event", "happened_at", "locked_until", "attempts"])
    for c in ("happened_at", "locked_until"):
        out[c] = pd.to_datetime(out[c].astype("int64"), unit="us")
    return out


def event_stream(tries: DataFrame, rules: Rules = Rules(), delay: str = "1 hour") -> DataFrame:
    """Locks and their ends as they happen: ``user_id``, ``event`` (locked, unlocked), ``happened_at``, ``locked_until``, ``attempts``.

    Needs the keyed state of ``jobs.keyed_state`` (timers live in it). A lock whose end no later attempt and no watermark
    has passed is still open and has no second row.
    """
    return tries.withWatermark("ts", delay).groupBy("user_id").transformWithStateInPandas(
        LockEvents(rules), LOCK_EVENTS, "Append", "EventTime"
    )


def event_batch(tries: DataFrame, rules: Rules = Rules(), delay_minutes: int = 60) -> DataFrame:
    """The rows of :func:`event_stream` for a finished log, from its locks.

    A lock has ended where a later attempt of the account, or the newest attempt of all less the delay, lies at or after
    its end.
    """
    found = lock_batch(tries, rules)
    newest = tries.agg(F.max("ts") - F.make_dt_interval(mins=F.lit(delay_minutes))).scalar()
    last = tries.groupBy(F.col("user_id").alias("_user")).agg(F.max("ts").alias("_last"))
    ended = found.join(last, F.col("user_id") == F.col("_user")).where((F.col("locked_until") <= F.col("_last")) | (F.col("locked_until") <= newest))
    ends = ended.select("user_id", F.lit("unlocked").alias("event"), F.col("locked_until").alias("happened_at"), "locked_until", "attempts")
    return found.select("user_id", F.lit("locked").alias("event"), F.col("locked_at").alias("happened_at"), "locked_until", "attempts").unionByName(ends)


def pieces(tries: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The attempts with the number ``island`` of their piece: no piece needs to know anything of another.

    An account is cut at pauses after which nothing counts, and behind a success that comes more than the lock time after
    the last failure: nothing can be locked then, and the success clears the count. Both show on summaries of fixed slots,
    so an account with a third of all attempts is cut without being put in order.
    """
    slots = F.col("at") / F.lit(rules.lock_minutes * 60_000_000)
    slotted = tries.withColumn("_slot", F.floor(slots).cast("bigint"))
    good = F.min(F.when(~F.col("failed"), F.col("at"))).alias("_good")
    bad = [F.min(F.when(F.col("failed"), F.col("at"))).alias("_bad"), F.max(F.when(F.col("failed"), F.col("at"))).alias("_last_bad")]
    summary = slotted.groupBy("user_id", "_slot").agg(F.min("at").alias("_lo"), F.max("at").alias("_hi"), good, *bad)
    w = Window.partitionBy("user_id").orderBy("_slot")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    pause = F.coalesce(F.col("_lo") - F.lag("_hi").over(w) > rules.pause_minutes * 60_000_000, F.lit(True))
    calm = F.coalesce(F.col("_good") - F.max("_last_bad").over(before) > rules.lock_minutes * 60_000_000, F.lit(True))
    first = F.coalesce(F.col("_good") <= F.col("_bad"), F.col("_good").isNotNull())
    cut = F.when(first & calm, F.col("_good"))
    numbered = summary.withColumn("_cut", cut).withColumn("_pause", pause)
    numbered = numbered.withColumn("_island", F.sum(F.col("_pause").cast("int") + F.col("_cut").isNotNull().cast("int")).over(w))
    placed = slotted.join(numbered.select("user_id", "_slot", "_cut", "_island"), ["user_id", "_slot"])
    # up to the cut a row belongs to the piece before it; of one moment a success comes first
    still = F.col("_cut").isNotNull() & ((F.col("at") < F.col("_cut")) | ((F.col("at") == F.col("_cut")) & ~F.col("failed")))
    return placed.withColumn("island", F.col("_island") - still.cast("int")).drop("_slot", "_cut", "_island")


def lock_batch(tries: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """All locks of a finished log.

    The pieces of the accounts are spread and sorted, and each task runs through its rows once with the state of one piece
    in hand, so no piece is ever held in memory.
    """
    cut = pieces(tries, rules)
    placed = cut.repartition("user_id", "island").sortWithinPartitions("user_id", "island", "at", "failed")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece, now = None, START
        for rows in batches:
            found = []
            for user, island, at, failed in zip(rows["user_id"], rows["island"], rows["at"], rows["failed"]):
                if (user, island) != piece:
                    piece, now = (user, island), START
                now, until = rules.step(now, int(at), bool(failed))
                if until is not None:
                    found.append((int(user), int(at), until, now[0]))
            yield _rows(found)

    return placed.select("user_id", "island", "at", "failed").mapInPandas(run, LOCKS)
