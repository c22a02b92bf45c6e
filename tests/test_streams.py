"""Ingest on keyed state: restarts, closed days, cost per batch. Lock events: timers, forgotten accounts."""

import datetime as dt
import json
import random
import shutil

import pytest
from pyspark.sql import functions as F

from shelfspark.streaming import jobs, lockout

COLUMNS = "date date, sku_id string, store_id string, units double, price double, promo_flag int"
D0 = dt.date(2024, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def put(spark, folder, rows):
    spark.createDataFrame([(day(d), sku, "S01", float(u), 1.0, 0) for d, sku, u in rows], COLUMNS).coalesce(1).write.mode("append").parquet(folder)


def run(spark, base, **options):
    stream = jobs.file_stream(spark, f"{base}/in", "*.parquet", spark.createDataFrame([], COLUMNS).schema, files_per_trigger=1)
    return jobs.ingest(stream, f"{base}/zone", f"{base}/state", **options)


def found(spark, base):
    return sorted(((r.date - D0).days, r.sku_id, r.units) for r in jobs.zone_rows(spark, f"{base}/zone").collect())


def test_a_restart_goes_on_where_it_ended(spark, tmp_path):
    base = str(tmp_path)
    put(spark, f"{base}/in", [(0, "A", 5), (0, "A", 4), (1, "A", 1)])
    run(spark, base)
    assert found(spark, base) == [(0, "A", 4.0), (1, "A", 1.0)]
    # a key known from the state only: the stored rows are not looked at for open days
    shutil.rmtree(f"{base}/zone/rows/part=open/batch=0")
    put(spark, f"{base}/in", [(0, "A", 1), (1, "B", 2), (2, "A", 3)])
    run(spark, base)
    assert found(spark, base) == [(1, "B", 2.0), (2, "A", 3.0)]
    assert run(spark, base) is not None
    assert found(spark, base) == [(1, "B", 2.0), (2, "A", 3.0)]


def test_closed_days_are_compared_with_the_stored_rows(spark, tmp_path):
    base = str(tmp_path)
    batches = [
        [(0, "A", 1), (5, "A", 1)],
        [(40, "A", 1), (41, "A", 1)],
        [(80, "A", 1)],
        # known and new keys of closed days, twice in a batch, and an open repeat
        [(0, "A", 9), (0, "B", 8), (0, "B", 7), (5, "A", 9), (80, "A", 9), (81, "A", 2)],
        [(0, "B", 6), (0, "C", 5), (81, "A", 1)],
    ]
    for rows in batches:
        put(spark, f"{base}/in", rows)
        run(spark, base, open_days=10)
    want = [(0, "A", 1.0), (0, "B", 7.0), (0, "C", 5.0), (5, "A", 1.0), (40, "A", 1.0), (41, "A", 1.0), (80, "A", 1.0), (81, "A", 2.0)]
    assert found(spark, base) == want
    profile = spark.read.parquet(f"{base}/zone/profile").agg(F.sum("rows").alias("rows"), F.sum("new_rows").alias("new")).first()
    assert (profile.rows, profile.new) == (sum(map(len, batches)), len(want))
    # the same files in one run of many micro-batches
    other = str(tmp_path / "again")
    shutil.copytree(f"{base}/in", f"{other}/in")
    run(spark, other, open_days=10)
    assert {(d, s) for d, s, _ in found(spark, other)} == {(d, s) for d, s, _ in want}


@pytest.mark.parametrize("n", [20])
def test_state_and_reading_stay_bounded(spark, tmp_path, n):
    """Twenty batches of ten days each: state holds the open days only, and no batch reads more than its own rows."""
    base = str(tmp_path)
    for b in range(n):
        put(spark, f"{base}/in", [(10 * b + d, sku, 1) for d in range(10) for sku in "ABCD"] + [(10 * b, "A", 2)])
    progress = run(spark, base, open_days=15)
    assert len(found(spark, base)) == n * 40
    states = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["numInputRows"]]
    assert len(states) == n and max(states) <= 40 + 40 + 16 * 4 and states[-1] < 2 * max(states[3:6])
    assert {p["numInputRows"] for p in progress if p["numInputRows"]} == {41}
    assert spark.read.parquet(f"{base}/zone/profile").agg(F.max("newest")).first()[0] == day(10 * n - 1)
    # nothing was old, so the second pass looked at no stored row
    assert spark.read.parquet(f"{base}/zone/profile").where("part = 'old'").agg(F.sum("new_rows")).first()[0] == 0


def test_settings_of_the_session_are_put_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with jobs.keyed_state(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name, None) == before


# ---- lock events ------------------------------------------------------------------------------------------------------

T0 = dt.datetime(2024, 1, 1)


def tries(spark, rows):
    df = spark.createDataFrame([(u, T0 + dt.timedelta(minutes=m), f) for u, m, f in rows], "user_id bigint, ts timestamp, failed boolean")
    return df.withColumn("at", F.unix_micros("ts")).select("user_id", "ts", "at", "failed")


def simulated(rows, delay=60):
    """Locks and ends, one account at a time: an end is told by a later attempt or by the last watermark."""
    out, mark = [], max(m for _, m, _ in rows) - delay
    for user in {u for u, _, _ in rows}:
        count, last, until, told = 0, None, -1, True
        for _, minute, failed in sorted(r for r in rows if r[0] == user):
            if not told and minute >= until:
                out.append((user, "unlocked", until, count))
                told = True
            if minute < until:
                continue
            if not failed:
                count, last, until = 0, None, -1
                continue
            count = count + 1 if last is not None and minute - last <= 60 else 1
            last = minute
            if count >= 5:
                until, told = minute + 15, False
                out.append((user, "locked", minute, count))
        if not told and until <= mark:
            out.append((user, "unlocked", until, count))
    return sorted(out)


def told(df):
    return sorted((r.user_id, r.event, round((r.happened_at - T0).total_seconds() / 60), r.attempts) for r in df.collect())


def test_lock_events_over_many_batches(spark, tmp_path):
    rng = random.Random(12)
    rows, clock = [], dict.fromkeys(range(5), 0)
    for _ in range(600):
        user = rng.randrange(5)
        clock[user] += rng.choice([1, 2, 5, 9, 20, 59, 61, 130])
        rows.append((user, clock[user], rng.random() < 0.85))
    # one account stops right after a lock, and time goes on
    rows += [(9, 10 + m, True) for m in range(5)]
    want = simulated(rows)
    assert sum(r[1] == "unlocked" for r in want) > 10 and (9, "unlocked", 29, 5) in want
    assert told(lockout.event_batch(tries(spark, rows))) == want
    ordered = sorted(rows, key=lambda r: r[1])
    for i in range(0, len(ordered), 202):
        tries(spark, ordered[i:i + 202]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.file_stream(spark, f"{tmp_path}/in", "*.parquet", tries(spark, rows[:1]).schema, files_per_trigger=1)
    with jobs.keyed_state(spark):
        assert told(jobs.drain(lockout.event_stream(stream), "lock-events-test")) == want


def test_state_of_quiet_accounts_goes(spark, tmp_path):
    """Accounts that stop are forgotten after the pause; a restart goes on with what was left."""
    folder = f"{tmp_path}/in"
    batches = [
        [(u, m, True) for u in range(1, 6) for m in range(5)],
        [(1, 8, True), (7, 30, True)],
        [(8, 600, True)],
        [(8, 1200, False)],
    ]
    states, events = [], []
    for rows in batches:
        tries(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        stream = jobs.file_stream(spark, folder, "*.parquet", tries(spark, rows).schema, files_per_trigger=1)
        with jobs.keyed_state(spark):
            query = (
                lockout.event_stream(stream).writeStream.format("parquet").option("path", f"{tmp_path}/rows")
                .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
            )
            query.awaitTermination()
        states.append(json.loads(query.lastProgress.json)["stateOperators"][0]["numRowsTotal"])
        events.append(spark.read.schema(lockout.LOCK_EVENTS).parquet(f"{tmp_path}/rows").count())
    assert events == [5, 5, 10, 10]
    # of five accounts, seven, then only the newest ones
    assert states[0] >= 5 and states[2] < states[0] and states[3] < states[0], states
    got = told(spark.read.schema(lockout.LOCK_EVENTS).parquet(f"{tmp_path}/rows"))
    assert got == sorted([(u, "locked", 4, 5) for u in range(1, 6)] + [(u, "unlocked", 19, 5) for u in range(1, 6)])
