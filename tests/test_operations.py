"""Runs, audit, telemetry, sources, sinks and streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfspark import schema
from shelfspark.operators import audit, lookups, runs, telemetry
from shelfspark.operators.columns import ColumnError
from shelfspark.sources import files, jdbc, sinks, store
from shelfspark.streaming import jobs, lockout, windows

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def predictions(spark):
    rows = [(r, s, dt.date(2024, 1, 1 + d), float(10 * r + d)) for r in (1, 2) for s in ("SKU001", "SKU002") for d in range(5)]
    return spark.createDataFrame(rows, "run_id bigint, sku_id string, date date, ensemble double")


def run_table(spark, *rows):
    return spark.createDataFrame(rows, "run_id bigint, status string, completed_at timestamp")


def test_latest_predictions(spark, predictions):
    log = run_table(spark, (1, "completed", T0), (2, "failed", T0 + dt.timedelta(days=1)), (3, "completed", None))
    out = runs.run_predictions(predictions, log, sku=" sku_1", horizon=2).collect()
    assert [(r.run_id, r.ensemble) for r in sorted(out, key=lambda r: r.date)] == [(1, 10.0), (1, 11.0)]
    none = run_table(spark, (1, "running", None))
    assert runs.run_predictions(predictions, none).count() == 0
    assert runs.run_predictions(predictions, none, all_without_run=True).count() == 20


def test_run_state(spark):
    log = spark.createDataFrame([(1, "running", T0), (1, "completed", T0 + dt.timedelta(hours=1)), (2, "running", T0)],
                                "run_id bigint, status string, at timestamp")
    assert {(r.run_id, r.status) for r in runs.run_state(log).collect()} == {(1, "completed"), (2, "running")}


def test_batch(predictions):
    found = runs.batch_forecast(predictions.where("run_id = 1"), ["sku-1", "SKU9"], 3)
    assert {r.sku_id for r in found.collect()} == {"SKU001"} and found.count() == 3
    assert [r.sku_id for r in runs.batch_not_found(predictions, ["sku-1", "SKU9"]).collect()] == ["SKU009"]
    for bad in ([], ["  "], [f"SKU{i}" for i in range(101)]):
        with pytest.raises(ValueError):
            runs.batch_forecast(predictions, bad)


def test_unique_and_retention(spark, predictions):
    assert runs.require_unique(predictions, ["run_id", "sku_id", "date"]) is predictions
    with pytest.raises(runs.DuplicateKeys):
        runs.require_unique(predictions, ["sku_id", "date"])
    log = spark.createDataFrame([(T0,), (T0 + dt.timedelta(days=10),), (None,)], "at timestamp")
    now = F.lit("2024-04-05").cast("timestamp")
    assert runs.retained(log, "at", now, 90).count() == 2
    row = runs.expired_counts({"log": (log, "at")}, now, 90).first()
    assert (row.deleted, row.kept) == (1, 2)


def test_dimension(spark):
    dim = spark.createDataFrame([("SKU001", "A", True)], "sku_id string, category string, is_active boolean")
    incoming = spark.createDataFrame([("sku_1",), ("sku_2",), ("SKU-2",), (None,)], "sku_id string")
    rows = {r.sku_id: (r.category, r.is_active) for r in runs.upsert_dim(dim, incoming).collect()}
    assert rows == {"SKU001": ("A", True), "SKU002": (None, True)}


def test_loads(spark, predictions):
    facts = spark.createDataFrame(
        [("sku_1", dt.date(2024, 1, 1), "S01", 2.0, 3.0, 0), ("SKU001", dt.date(2024, 1, 1), "S02", 4.0, 5.0, 1)],
        "sku_id string, date date, store_id string, units double, price double, promo_flag int",
    )
    row = runs.load_sales(facts).first()
    assert (row.sku_id, row.units, row.revenue, row.price, row.promo_flag) == ("SKU001", 6.0, 26.0, 4.0, 1)
    actual = runs.fill_actuals(predictions, facts.withColumn("sku_id", F.lit("SKU001")))
    assert actual.where("actual = 6.0").count() == 2 and actual.count() == 20


@pytest.fixture(scope="module")
def log(spark):
    rows = [(i, "login_failed" if i % 3 else "login", f"User{i % 2}@x", f"10.0.0.{i % 2}" if i != 5 else None,
             "critical" if i % 3 else "info", T0 + dt.timedelta(hours=i)) for i in range(30)]
    return spark.createDataFrame(
        rows, "id bigint, event_type string, user_email string, ip_address string, severity string, created_at timestamp")


def test_audit(log):
    now = audit.newest_time(log)
    page = audit.audit_filter(log, event_type="login", user_email="USER0", skip=1, limit=2).collect()
    assert [r.id for r in page] == [18, 12]
    stats = {(r.kind, r.name): r.n for r in audit.audit_stats(log, now, 24).collect()}
    assert stats["total", None] == 25 and stats["event_type", "login"] + stats["event_type", "login_failed"] == 25
    assert stats["suspicious_ip", "10.0.0.0"] >= 5
    assert not any(name is None for kind, name in stats if kind == "suspicious_ip")


def test_locked_accounts(spark):
    df = spark.createDataFrame([(1, T0 + dt.timedelta(seconds=61)), (2, T0), (3, None)], "user_id int, locked_until timestamp")
    out = lookups.locked_accounts(df, F.lit("2024-01-01").cast("timestamp")).collect()
    assert [(r.user_id, r.remaining_minutes) for r in out] == [(1, 2)]


def test_newest_observations_only(spark):
    df = spark.range(1500).select(F.lit("m").alias("name"), F.col("id"), F.col("id").cast("double").alias("duration"))
    row = telemetry.latency_quantiles(df, ["name"], [F.col("id").desc()], keep=1000).first()
    assert (row["count"], row.p50, row.p99) == (1000, 999.5, pytest.approx(1489.01))


# ---- files --------------------------------------------------------------------------------------------------------


def write_text(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def test_read_sales(spark, tmp_path):
    path = write_text(tmp_path, "s.csv", " Date,SKU_ID,Quantity,price,promo_flag\n2024-01-02,SKU1,5,1.5,true\nbad,SKU1,x,NaN,0\n")
    first, second = files.read_sales(spark, path).collect()
    assert (first.date, first.units, first.price, first.promo_flag) == (dt.date(2024, 1, 2), 5.0, 1.5, 1)
    assert (second.date, second.units, second.price, second.promo_flag) == (None, None, None, 0)
    assert {r.column_name: r.lost for r in files.rescued(files.read_raw(spark, path)).collect()} == {
        "date": 1, "units": 1, "price": 0, "promo_flag": 0}
    with pytest.raises(ValueError):
        files.read_sales(spark, str(tmp_path / "s.xlsx"))
    with pytest.raises(ColumnError):
        files.read_sales(spark, write_text(tmp_path, "t.csv", "date,units\n2024-01-01,1\n"))


def test_stage_upload(spark, tmp_path):
    zone = str(tmp_path / "zone")
    text = "date,sku_id,qty\n2024-01-01,SKU1,1\n2024-01-02,SKU1,2\n"
    a, new, profile = files.stage_upload(spark, write_text(tmp_path, "a.csv", text), zone)
    b, again, _ = files.stage_upload(spark, write_text(tmp_path, "b.csv", text), zone)
    c, other, _ = files.stage_upload(spark, write_text(tmp_path, "c.csv", text.replace(",2", ",3")), zone)
    assert (new, again, other) == (True, False, True) and a == b != c and len(a) == 64
    assert profile.first().asDict() | {"min_date": 0, "max_date": 0} == {
        "rows": 2, "columns": 3, "skus": 1, "stores": None, "min_date": 0, "max_date": 0, "units": 3.0, "missing_date": 0,
        "missing_units": 0, "missing_price": None,
    }
    # the same rows in another order and in two files
    (tmp_path / "split").mkdir()
    write_text(tmp_path / "split", "1.csv", "date,sku_id,qty\n2024-01-02,SKU1,2\n")
    write_text(tmp_path / "split", "2.csv", "date,sku_id,qty\n2024-01-01,SKU1,1\n")
    assert files.stage_upload(spark, str(tmp_path / "split"), zone)[:2] == (a, False)
    assert files.read_zone(spark, zone).count() == 4
    with pytest.raises(ColumnError):
        files.stage_upload(spark, write_text(tmp_path, "d.csv", "date,sku_id\n2024-01-01,SKU1\n"), zone)


def test_catalogue(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write_text(folder, "a.csv", "date,sku_id\n2024-01-01,SKU1\n2024-01-02,SKU1\n")
    write_text(folder, "empty.csv", "date,sku_id\n")
    write_text(folder, "a b+c.csv", "other,columns\n1,2\n")
    write_text(folder, "broken.csv.gz", "not an archive")
    rows = {r.name: r for r in files.dataset_catalogue(spark, str(folder)).collect()}
    assert rows["a.csv"].rows == 2 and rows["a.csv"].error is None and rows["a.csv"].size_bytes == 44
    assert rows["empty.csv"].rows == 0 and rows["empty.csv"].error is None
    assert rows["a b+c.csv"].rows == 1 and rows["broken.csv.gz"].rows is None and rows["broken.csv.gz"].error


def test_jdbc_options():
    got = jdbc.jdbc_options("sales", "shop", "u", "p", partition_column="date", bounds=("2024-01-01", "2025-01-01"))
    assert got["url"] == "jdbc:postgresql://localhost:5432/shop" and got["numPartitions"] == "64"
    for bad in ({"table": "a;b"}, {"database": "1x"}, {"port": 0}, {"partition_column": "date"}):
        with pytest.raises(ValueError):
            jdbc.jdbc_options(**({"table": "t", "database": "d", "user": "u", "password": "p"} | bad))


def test_export(spark, predictions, tmp_path):
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    path = sinks.export_table(predictions, str(tmp_path), "predictions", "csv", at)
    assert path.endswith("predictions_20240102_030405.csv")
    assert spark.read.option("header", True).csv(path).count() == 20
    for kind, fmt in (("users", "csv"), ("metrics", "xlsx")):
        with pytest.raises(ValueError):
            sinks.export_table(predictions, str(tmp_path), kind, fmt, at)


def test_run_write_is_repeatable(spark, predictions, tmp_path):
    path = str(tmp_path / "p")
    rows = runs.load_predictions(
        predictions.where("run_id = 1").withColumns({c: F.lit(1.0) for c in ("prophet", "xgb", "lgbm", "p_low", "p_high")}), 7)
    for _ in range(2):
        sinks.write_predictions(rows, path)
    sinks.write_predictions(rows.withColumn("run_id", F.lit(8).cast("bigint")), path)
    stored = files.read_artifact(spark, path, schema.PREDICTION)
    assert {r.run_id: r["count"] for r in stored.groupBy("run_id").count().collect()} == {7: 10, 8: 10}


def test_loads_read_their_rows_once(spark, predictions, tmp_path):
    """The forecast may be a long plan: it is worked out once for each load, not for every step of it."""
    path, dim, read = str(tmp_path / "p"), str(tmp_path / "dim"), spark.sparkContext.accumulator(0)
    spark.createDataFrame([("SKU001", True)], "sku_id string, is_active boolean").write.parquet(dim)

    def seen(value):
        read.add(1)
        return value

    rows = predictions.where("run_id = 1").withColumns({c: F.lit(1.0) for c in ("prophet", "xgb", "lgbm", "p_low", "p_high")})
    rows = rows.localCheckpoint().withColumn("sku_id", F.udf(seen, "string").asNondeterministic()("sku_id"))
    store.load_predictions(rows, 7, path, dim)
    assert read.value == 10
    assert files.read_artifact(spark, path, schema.PREDICTION).count() == 10
    assert {r.sku_id for r in spark.read.parquet(dim).collect()} == {"SKU001", "SKU002"}
    scores = spark.createDataFrame([("SKU001", 1.0, 2.0, 3.0, 4.0, "naive")],
                                   "sku_id string, mape_prophet double, mape_xgboost double, mape_ens double, mape_naive double, best_model string")
    store.load_metrics(scores.withColumn("sku_id", F.udf(seen, "string").asNondeterministic()("sku_id")), 7, str(tmp_path / "m"), dim)
    assert read.value == 11


# ---- streams ------------------------------------------------------------------------------------------------------


def minutes(spark, rows):
    """(user, minute, failed) as attempts."""
    df = spark.createDataFrame([(u, T0 + dt.timedelta(minutes=m), f) for u, m, f in rows], "user_id bigint, ts timestamp, failed boolean")
    return df.withColumn("at", F.unix_micros("ts")).select("user_id", "ts", "at", "failed")


def locks(df):
    return sorted((r.user_id, (r.locked_at - T0).total_seconds() / 60, r.attempts) for r in df.collect())


def test_lockout_rules(spark):
    burst = [(1, m, True) for m in range(5)]
    assert locks(lockout.lock_batch(minutes(spark, burst))) == [(1, 4.0, 5)]
    # refused while locked; the count outlives the lock, so one failure within the hour locks again
    assert locks(lockout.lock_batch(minutes(spark, burst + [(1, 10, True), (1, 30, True)]))) == [(1, 4.0, 5), (1, 30.0, 6)]
    # a success clears the count, but not while locked
    assert locks(lockout.lock_batch(minutes(spark, burst[:4] + [(1, 5, False), (1, 6, True)]))) == []
    assert locks(lockout.lock_batch(minutes(spark, burst + [(1, 6, False), (1, 25, True)]))) == [(1, 4.0, 5), (1, 25.0, 6)]
    # exactly an hour after the last failure still counts, later does not
    assert locks(lockout.lock_batch(minutes(spark, burst[:4] + [(1, 63, True)]))) == [(1, 63.0, 5)]
    assert locks(lockout.lock_batch(minutes(spark, burst[:4] + [(1, 64, True)]))) == []


def plain_lockout(rows):
    """Straight simulation of the rules, one account at a time."""
    out = []
    for user in sorted({u for u, _, _ in rows}):
        count, last, until = 0, None, -1
        for _, minute, failed in sorted(r for r in rows if r[0] == user):
            if minute < until:
                continue
            if not failed:
                count, last, until = 0, None, -1
                continue
            count = count + 1 if last is not None and minute - last <= 60 else 1
            last = minute
            if count >= 5:
                until = minute + 15
                out.append((user, float(minute), count))
    return sorted(out)


def test_lockout_batch_and_stream_match_a_simulation(spark, tmp_path):
    rng = random.Random(5)
    rows, clock = [], dict.fromkeys(range(6), 0)
    for _ in range(900):
        user = 0 if rng.random() < 0.34 else rng.randrange(6)
        clock[user] += rng.choice([1, 2, 5, 9, 20, 59, 61, 130])
        rows.append((user, clock[user], rng.random() < 0.85))
    expected = plain_lockout(rows)
    assert len(expected) > 20
    tries = minutes(spark, rows)
    assert locks(lockout.lock_batch(tries)) == expected
    # three files, in order of time, taken one per micro-batch
    folder = tmp_path / "tries"
    ordered = sorted(rows, key=lambda r: r[1])
    for i in range(3):
        minutes(spark, ordered[i * 300:(i + 1) * 300]).coalesce(1).write.mode("append").parquet(str(folder))
    stream = jobs.file_stream(spark, str(folder), "*.parquet", tries.schema, files_per_trigger=1)
    assert locks(jobs.drain(lockout.lock_stream(stream), "lockout-test")) == expected


def test_session_stream_equals_batch(spark, tmp_path):
    rows = [(u, m, True) for u in (1, 2) for m in (0, 59, 119, 180, 240, 301, 900)]
    events = minutes(spark, rows)
    events.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = jobs.file_stream(spark, str(tmp_path / "e"), "*.parquet", events.schema)
    key = lambda d: sorted((r.user_id, r.session_start, r.session_end, r.events) for r in d.collect())
    got = key(jobs.drain(windows.sessions(stream), "session-test"))
    assert got == key(windows.sessions_batch(events)) and len(got) > 2


def test_ingest_writes_rows_and_profile(spark, tmp_path):
    day = lambda m, d: dt.date(2024, m, d)
    columns = "date date, sku_id string, store_id string, units double"
    parts = [
        [(day(1, 1), "A", "S01", 1.0)] * 2 + [(day(3, 2), "A", "S01", None)],
        # a key that is there, a new one, and one from long ago
        [(day(1, 1), "A", "S01", 7.0), (day(1, 1), "B", "S01", 2.0), (dt.date(1999, 5, 5), "A", "S01", 3.0)],
    ]
    for rows in parts:
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), "*.parquet", spark.createDataFrame([], columns).schema, files_per_trigger=1)
    jobs.ingest(stream, str(tmp_path / "zone"), str(tmp_path / "state"))
    rows = spark.read.parquet(str(tmp_path / "zone/rows")).collect()
    assert sorted((str(r.date), r.sku_id, r.units) for r in rows) == [
        ("1999-05-05", "A", 3.0), ("2024-01-01", "A", 1.0), ("2024-01-01", "B", 2.0), ("2024-03-02", "A", None),
    ]
    profile = spark.read.parquet(str(tmp_path / "zone/profile")).agg(F.sum("rows"), F.sum("missing_units"), F.sum("new_rows")).first()
    assert tuple(profile) == (6, 1, 4)


def test_late_rows_are_counted_beside_the_output(spark, tmp_path):
    folder = str(tmp_path / "late")
    for rows in ([(1, 600, True), (2, 601, True)], [(1, 602, True)], [(1, 5, True), (2, 7, True), (1, 603, True)]):
        minutes(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.file_stream(spark, folder, "*.parquet", minutes(spark, [(1, 1, True)]).schema, files_per_trigger=1)
    rows, late = jobs.drained(windows.sessions(stream), "late-test")
    assert rows.count() == 0 and late.first().late_rows == 2


def test_a_hot_account_is_cut_into_pieces(spark):
    """One account with a third of the attempts and no pause: successes after a quiet quarter of an hour cut it."""
    rows = [(1, 20 * k + m, k % 3 != 2) for k in range(400) for m in ((0, 1, 2, 3, 4) if k % 3 == 0 else (0,))]
    rows += [(u, 7 * k, k % 4 != 0) for u in range(2, 8) for k in range(160)]
    tries = minutes(spark, rows)
    assert locks(lockout.lock_batch(tries)) == plain_lockout(rows)
    hot = lockout.pieces(tries).where("user_id = 1").groupBy("island").count()
    assert hot.count() > 50 and hot.agg(F.max("count")).first()[0] < 60


def test_runs_are_logged_from_start_to_end(spark, tmp_path):
    log = str(tmp_path / "log")
    at = lambda h: F.lit(f"2024-01-01 {h:02d}:00:00").cast("timestamp")
    ids = lambda *n: spark.createDataFrame([(i,) for i in n], "run_id long")
    store.start_runs(ids(1, 2, 3).withColumns({"at": at(1), "horizon": F.lit(14)}), log)
    store.complete_runs(ids(1).withColumns({"at": at(2), "records_count": F.lit(420)}), log)
    store.fail_runs(ids(2).withColumns({"at": at(1), "error_message": F.lit("no data")}), log)
    state = {r.run_id: r for r in runs.run_log(spark.read.parquet(log)).collect()}
    assert (state[1].status, state[1].records_count, state[1].horizon) == ("completed", 420, 14)
    assert (state[2].status, state[2].error_message) == ("failed", "no data")
    assert state[3].status == "running" and state[3].completed_at is None
    assert str(state[1].started_at) == "2024-01-01 01:00:00" and str(state[1].completed_at) == "2024-01-01 02:00:00"


def test_loads_replace_their_keys_and_add_skus(spark, tmp_path):
    path, dim = str(tmp_path / "history"), str(tmp_path / "dim")
    spark.createDataFrame([("SKU001", "a", True)], "sku_id string, name string, is_active boolean").write.parquet(dim)
    day = lambda d, u: (f"2024-{d}", "sku_2", "S01", u, 1.0, 0)
    build = lambda *r: spark.createDataFrame(list(r), "date string, sku_id string, store_id string, units double, price double, promo_flag int").withColumn("date", F.col("date").cast("date"))
    store.load_sales(build(day("01-01", 1.0), day("01-02", 2.0), day("02-01", 3.0)), path, dim)
    store.load_sales(build(day("01-02", 20.0), day("01-03", 30.0)), path, dim)
    assert {str(r.date): r.units for r in spark.read.parquet(path).collect()} == {
        "2024-01-01": 1.0, "2024-01-02": 20.0, "2024-01-03": 30.0, "2024-02-01": 3.0,
    }
    assert sorted(r.sku_id for r in spark.read.parquet(dim).collect()) == ["SKU001", "SKU002"]


def test_a_run_with_repeated_keys_is_not_written(spark, tmp_path):
    rows = spark.createDataFrame([(1, "SKU001", "2024-01-01")] * 2, "run_id long, sku_id string, date string")
    with pytest.raises(runs.DuplicateKeys):
        sinks.write_predictions(rows, str(tmp_path / "p"))
    assert not (tmp_path / "p").exists()


def test_retention_deletes_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = [("2024-01", "2024-01-01", "completed"), ("2024-01", "2024-01-02", "failed"), ("2024-02", "2024-02-01", "running"), ("2024-02", "2024-02-02", "completed"), ("2024-05", "2024-05-05", "completed")]
    spark.createDataFrame(rows, "month string, at string, status string").write.partitionBy("month").parquet(path)
    gone = runs.expired("at", F.lit("2024-06-01"), 90) & (F.col("status") != "running")
    assert store.expire(spark, path, "month", gone) == (3, 2)
    assert sorted(r.at for r in spark.read.parquet(path).collect()) == ["2024-02-01", "2024-05-05"]
    assert not (tmp_path / "runs" / "month=2024-01").exists()
    assert store.expire(spark, path, "month", gone) == (0, 2)
