"""Streaming jobs over small files: recovery, policies, shards, state and progress."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelstream.operators.serve import Policy
from modelstream.plans import replay
from modelstream.schemas import BAD_INPUT, NO_MODEL, ddl, linear_params
from modelstream.sources import sinks, tables
from modelstream.streaming import batches, keyed, statistics

UTF8 = "modèle-β"


class Feed:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        for side, schema in (("records", replay.RECORDS), ("models", replay.MODELS)):
            spark.createDataFrame([], schema).write.parquet(f"{folder}/{side}")

    def records(self, *rows):
        """(id, type, ts, x, duration)"""
        data = [(i, d, t, [x], took) for i, d, t, x, took in rows]
        self.spark.createDataFrame(data, replay.RECORDS).write.mode("append").parquet(f"{self.folder}/records")

    def models(self, *rows):
        """(name, type, ts, intercept); no intercept is a model that failed to build"""
        frame = self.spark.createDataFrame(list(rows), "name string, data_type string, ts long, v double")
        params = F.when(F.col("v").isNotNull(), linear_params(F.col("v"), [F.lit(1.0)]))
        frame = frame.select(
            "name", F.lit("d").alias("description"), "data_type", F.lit(2).alias("model_kind"), "ts",
            F.col("ts").alias("seq"), params.cast(ddl(replay.LINEAR)).alias("params"),
        )
        frame.write.mode("append").parquet(f"{self.folder}/models")

    def streams(self):
        return (
            tables.stream_files(self.spark, f"{self.folder}/records", replay.RECORDS),
            tables.stream_files(self.spark, f"{self.folder}/models", replay.MODELS),
        )


def run_keyed(spark, feed, policy=Policy(), processor=False, order="event_time", shards=3):
    records, models = feed.streams()
    rows = keyed.stream_rows(records, models, policy, shards)
    met = keyed.meet_models_with_stats(rows, order) if processor else keyed.meet_models(rows, order)
    served = keyed.score_met(met, 1, policy, ["linear"], ddl(replay.LINEAR))
    with replay.state_settings(spark):
        replay.finish(sinks.to_files(served, f"{feed.folder}/out", f"{feed.folder}/checkpoint"))
    return {r.record_id: (r.name, r.result) for r in spark.read.schema(replay.SERVED).parquet(f"{feed.folder}/out").collect()}


def run_arrivals(spark, feed, policy=Policy(), order="event_time"):
    records, models = feed.streams()
    both = records.select(F.struct("*").alias("r"), F.lit(None).alias("m")).unionByName(
        models.select(F.lit(None).alias("r"), F.struct("*").alias("m"))
    )
    registry = batches.Registry(spark, f"{feed.folder}/registry", replay.MODELS)

    def split(batch):
        return batch.filter("r IS NOT NULL").select("r.*"), batch.filter("m IS NOT NULL").select("m.*")

    replay.finish(
        batches.serve_arrivals(
            both, split, registry, lambda: [F.get("features", 0)], f"{feed.folder}/out", f"{feed.folder}/checkpoint",
            policy, order=order, keep=["record_id", "duration"], forms=["linear"],
        )
    )
    return {r.record_id: (r.name, r.result) for r in batches.read_results(spark, f"{feed.folder}/out", replay.SERVED).collect()}


JOBS = [run_keyed, run_arrivals, lambda *a, **k: run_keyed(*a, processor=True, **k)]


@pytest.mark.parametrize("job", JOBS)
@pytest.mark.parametrize("bad_input", ["drop", "mark"])
def test_records_without_a_type(spark, folder, job, bad_input):
    feed = Feed(spark, folder)
    feed.models(("m", "a", 1, 10.0), ("none", "", 1, 1.0), ("null", None, 1, 1.0))
    feed.records((1, "a", 5, 1.0, 0.0), (2, None, 5, 1.0, 0.0), (3, "", 5, 1.0, 0.0))
    marked = {2: (BAD_INPUT, 0.0), 3: (BAD_INPUT, 0.0)} if bad_input == "mark" else {}
    assert job(spark, feed, Policy(bad_input=bad_input)) == {1: ("m", 11.0), **marked}


@pytest.mark.parametrize("run", JOBS)
def test_models_outlive_a_restart(spark, folder, run):
    feed = Feed(spark, folder)
    feed.models((UTF8, "a", 1, 1.0), ("early", "a", 0, 9.0))
    feed.records((1, "a", 2, 1.0, 3.0), (2, "b", 2, 1.0, 1.0))
    assert run(spark, feed) == {1: (UTF8, 2.0)}
    feed.records((3, "a", 20, 2.0, 5.0), (4, "a", 8, 2.0, 1.0), (5, "a", 9, 0.0, 1.0))
    feed.models(("next", "a", 9, 10.0))
    assert run(spark, feed) == {1: (UTF8, 2.0), 3: ("next", 12.0), 4: (UTF8, 3.0), 5: ("next", 10.0)}


@pytest.mark.parametrize("run", JOBS[:2])
def test_bad_model_in_a_stream(spark, folder, run):
    for policy, second in ((Policy(), ("good", 2.0)), (Policy(on_bad_model="clear", no_model="mark"), (NO_MODEL, 0.0))):
        feed = Feed(spark, f"{folder}/{policy.on_bad_model}")
        feed.models(("good", "a", 1, 1.0))
        feed.records((1, "a", 2, 1.0, 1.0))
        run(spark, feed, policy)
        feed.models(("bad", "a", 3, None))
        feed.records((2, "a", 4, 1.0, 1.0))
        run(spark, feed, policy)
        feed.records((3, "a", 6, 1.0, 1.0))
        assert run(spark, feed, policy) == {1: ("good", 2.0), 2: second, 3: second}


@pytest.mark.parametrize("run", JOBS[:2])
def test_a_late_model_applies_from_its_arrival_on(spark, folder, run):
    feed = Feed(spark, folder)
    feed.models(("ten", "a", 10, 1.0))
    feed.records((1, "a", 11, 0.0, 1.0))
    run(spark, feed)
    feed.models(("late", "a", 5, 2.0))
    feed.records((2, "a", 12, 0.0, 1.0))
    run(spark, feed)
    feed.records((3, "a", 13, 0.0, 1.0))
    assert run(spark, feed) == {1: ("ten", 1.0), 2: ("late", 2.0), 3: ("late", 2.0)}


@pytest.mark.parametrize("run", JOBS[:2])
def test_models_first(spark, folder, run):
    feed = Feed(spark, folder)
    feed.records((1, "a", 2, 0.0, 1.0))
    feed.models(("later", "a", 5, 1.0), ("last", "a", 7, 2.0))
    assert run(spark, feed, order="models_first") == {1: ("last", 2.0)}


def test_state_can_be_read(spark, folder):
    feed = Feed(spark, folder)
    feed.models((UTF8, "a", 1, 1.0), ("b1", "b", 1, 1.0))
    feed.records(*[(i, "a", 2 + i, 0.0, float(i)) for i in range(20)])
    run_keyed(spark, feed, processor=True)
    feed.records(*[(i, "a", 2 + i, 0.0, float(i)) for i in range(20, 30)])
    run_keyed(spark, feed, processor=True)
    held = {r.data_type: (r.name, r.since) for r in keyed.read_models(spark, f"{folder}/checkpoint", processor=True).collect()}
    assert held == {"a": (UTF8, 1), "b": ("b1", 1)}
    rows = {r.data_type: (r.usage, r.duration, r["min"], r["max"]) for r in keyed.read_stats(spark, f"{folder}/checkpoint").collect()}
    assert rows == {"a": (30, 435.0, 0, 29), "b": (0, 0.0, None, None)}
    feed.models(("a2", "a", 100, 1.0))
    feed.records((99, "a", 101, 0.0, 7.0))
    run_keyed(spark, feed, processor=True)
    rows = {r.data_type: (r.name, r.usage, r["max"]) for r in keyed.read_stats(spark, f"{folder}/checkpoint").collect()}
    assert rows["a"] == ("a2", 1, 7)


def test_a_batch_that_runs_again_changes_nothing(spark, folder):
    feed = Feed(spark, folder)
    feed.models(("m", "a", 1, 1.0))
    feed.records((1, "a", 2, 1.0, 1.0))
    first = run_arrivals(spark, feed)
    registry = batches.Registry(spark, f"{folder}/registry", replay.MODELS)
    registry.update(spark.read.schema(replay.MODELS).parquet(f"{folder}/models"), 0)
    assert [r.name for r in registry.snapshot(spark).collect()] == ["m"]
    assert registry.snapshot(spark, 0).count() == 0
    compacted = registry.compact(spark, f"{folder}/compacted")
    assert [r.name for r in compacted.snapshot(spark).collect()] == ["m"]
    assert run_arrivals(spark, feed) == first


def test_running_statistics_and_progress(spark, folder):
    schema = replay.SERVED
    spark.createDataFrame([(1, 3.0, "m", "a", 1, 0.0, 0), (2, 5.0, "m", "a", 1, 0.0, 0)], schema).write.parquet(f"{folder}/in")
    listener = statistics.ProgressListener()
    spark.streams.addListener(listener)
    try:
        for more in ((3, 1.0, "m", "a", 1, 0.0, 0), (4, 8.0, "n", "a", 1, 0.0, 2)):
            stream = tables.stream_files(spark, f"{folder}/in", schema)
            replay.finish(statistics.write_running(stream, f"{folder}/stats", f"{folder}/checkpoint"))
            spark.createDataFrame([more], schema).write.mode("append").parquet(f"{folder}/in")
        stream = tables.stream_files(spark, f"{folder}/in", schema)
        replay.finish(statistics.write_running(stream, f"{folder}/stats", f"{folder}/checkpoint"))
        rows = {r.name: (r.usage, r.duration, r["min"], r["max"]) for r in statistics.read_running(spark, f"{folder}/stats").collect()}
        assert rows == {"m": (3, 9.0, 1, 5), "n": (1, 8.0, 8, 8)}
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert listener.progress(spark).agg(F.sum("input_rows")).first()[0] == 4
        listener.drain(spark, f"{folder}/progress")
        assert listener.progress(spark).count() == 0 and spark.read.parquet(f"{folder}/progress").count() > 0
    finally:
        spark.streams.removeListener(listener)


class Progress:
    """A progress event with one source."""

    def __init__(self, number):
        self.progress = self
        self.name, self.id, self.batchId, self.timestamp, self.durationMs = "q", "q", number, "now", {"addBatch": 1}
        self.sources, self.description, self.startOffset, self.endOffset = [self], "files", "0", "1"
        self.numInputRows, self.processedRowsPerSecond = 7, 1.5


def test_progress_does_not_pile_up_on_the_driver(spark, folder):
    to_table = statistics.ProgressListener(spark, f"{folder}/progress", most=10)
    unwritable = statistics.ProgressListener(spark, "nosuchfilesystem://x", most=10)
    kept = statistics.ProgressListener(most=10)
    for number in range(35):
        for listener in (to_table, unwritable, kept):
            listener.onQueryProgress(Progress(number))
            assert len(listener._rows) <= 10
    to_table.onQueryTerminated(None)
    rows = spark.read.parquet(f"{folder}/progress")
    assert sorted(r.batch_id for r in rows.collect()) == list(range(35)) and to_table.lost == 0
    assert [r.batch_id for r in kept.progress(spark).collect()] == list(range(25, 35)) and kept.lost == unwritable.lost == 25


def model_rows(spark, *rows):
    """(name, type, ts, intercept)"""
    frame = spark.createDataFrame(list(rows), "name string, data_type string, ts long, v double")
    params = F.when(F.col("v").isNotNull(), linear_params(F.col("v"), [F.lit(1.0)]))
    return frame.select(
        "name", F.lit("d").alias("description"), "data_type", F.lit(2).alias("model_kind"), "ts",
        F.col("ts").alias("seq"), params.cast(ddl(replay.LINEAR)).alias("params"),
    )


def in_force_after(updates, policy):
    """updates: (batch, name, type, ts, intercept), the last by (batch, ts) counts."""
    held = {}
    for batch, name, kind, ts, v in sorted(updates, key=lambda u: (u[0], u[3])):
        if v is not None or policy.on_bad_model == "clear":
            held[kind] = name
    return held


def test_registry_reads_as_much_at_the_hundredth_batch_as_at_the_twentieth(spark, folder):
    registry = batches.Registry(spark, f"{folder}/registry", replay.MODELS, every=8)
    updates, parts, files = [], [], []
    for number in range(100):
        # One type that changes all the time, one that changed once, late models, models that failed to build.
        rows = [(f"hot{number}", "hot", 1000 - number, float(number) if number % 7 else None)]
        rows += [("once", "once", 5, 1.0)] if number == 3 else []
        rows += [(f"w{number}", f"t{number % 5}", number, None if number % 3 == 0 else 1.0)]
        registry.update(model_rows(spark, *rows).coalesce(1), number)
        updates += [(number, *r) for r in rows]
        parts.append(len(registry.table.manifest().parts()))
        if number % 33 == 32 or number == 20:
            for policy in (Policy(), Policy(on_bad_model="clear")):
                for before in (None, number, number - 5):
                    known = [u for u in updates if before is None or u[0] < before]
                    found = {r.data_type: r.name for r in registry.snapshot(spark, before, policy).collect()}
                    assert found == in_force_after(known, policy)
            files.append(len(registry.table._read(spark, registry.table.manifest().parts()).inputFiles()))
    assert max(parts) <= 8 and max(files) <= 2 * 8
    # What lies in the folder is bounded too: the parts of two snapshots' time and those kept for late readers.
    assert len(registry.table._top.names()) < 70
    with pytest.raises(ValueError, match="no longer kept"):
        registry.snapshot(spark, 3)


@pytest.mark.parametrize("again", [6, 7, 8])
def test_a_registry_batch_that_runs_again_replaces_itself(spark, folder, again):
    """Before, at and after a batch that wrote a snapshot."""
    registry = batches.Registry(spark, f"{folder}/registry", replay.MODELS, every=4)
    for number in range(again):
        registry.update(model_rows(spark, (f"m{number}", "a", number, 1.0)), number)
    before = registry.snapshot(spark, again).collect()
    registry.update(model_rows(spark, ("first try", "a", again, 1.0), ("gone", "b", 1, 1.0)), again)
    assert registry.snapshot(spark, again).collect() == before
    registry.update(model_rows(spark, ("second try", "a", again, 1.0)), again)
    assert registry.snapshot(spark, again).collect() == before
    assert [(r.name, r.data_type) for r in registry.snapshot(spark).collect()] == [("second try", "a")]
    assert [r.name for r in registry.batch(spark, again).collect()] == ["second try"]
    # Another session's registry over the same folder sees the same.
    other = batches.Registry(spark, f"{folder}/registry", replay.MODELS, every=4)
    assert [r.name for r in other.snapshot(spark).collect()] == ["second try"]


def test_running_statistics_read_few_parts(spark, folder):
    table = statistics.SnapshotTable(spark, f"{folder}/stats", statistics.RUNNING, statistics.newest, 4)
    for number in range(15):
        table.update(spark.createDataFrame([("a", "m", 1, number, float(number), 0, number), ("b", f"n{number}", 1, 1, 1.0, 1, 1)], statistics.RUNNING), number)
    assert len(table.manifest().parts()) <= 4
    rows = {r.name: r.usage for r in statistics.read_running(spark, f"{folder}/stats").collect()}
    assert rows == {"m": 14, **{f"n{i}": 1 for i in range(15)}}


def frames_of(rows, size=1000):
    import pandas as pd

    columns = ["data_type", "shard", "ts", "seq", "is_record", "features", "duration", "name", "params"]
    for low in range(0, len(rows), size):
        yield pd.DataFrame(rows[low : low + size], columns=columns)


@pytest.mark.parametrize("order", ["event_time", "models_first"])
@pytest.mark.parametrize("limit", [0, 20_000, 1 << 30])
def test_meeting_equals_brute_force(order, limit):
    """Rows in any order, held in memory, in the scratch file, or in both."""
    import random

    rng = random.Random(limit)
    models = [(rng.randrange(500), i, f"m{i}") for i in range(40)]
    rows = [("a", 0, ts, seq, False, None, None, name, "{}") for ts, seq, name in models]
    rows += [("a", 0, rng.randrange(500), i, True, [float(i)], 1.0, None, None) for i in range(5000)]
    rng.shuffle(rows)
    current = ("old", -1, "{}")
    meeting = keyed.Meeting(frames_of(rows, 700), current, order, limit)
    found = {}
    for records, version in meeting.met():
        out = keyed._output(records, version, meeting.models)
        assert [f[0] for f in out["features"]] == list(out["record_id"].astype(float))
        found |= dict(zip(out["record_id"], out["name"]))
    last = max(models)[2]
    for _, _, ts, seq, is_record, *_ in rows:
        if is_record:
            best = max([m for m in models if m[0] <= ts], default=(0, 0, "old"))[2]
            assert found[seq] == (best if order == "event_time" else last)
    assert len(found) == 5000


def test_memory_of_a_key_does_not_grow_with_its_records():
    """A million records of one key in one batch, within a few times what is held."""
    import tracemalloc

    import pandas as pd

    def source(n, size=10_000):
        for low in range(0, n, size):
            yield pd.DataFrame(
                {
                    "data_type": "a", "shard": 0, "ts": range(low, low + size), "seq": range(low, low + size), "is_record": True,
                    "features": [[1.0, 2.0, 3.0]] * size, "duration": 1.0, "name": None, "params": None,
                }
            )
        yield pd.DataFrame([("a", 0, n // 2, 0, False, None, None, "m", "{}")], columns=["data_type", "shard", "ts", "seq", "is_record", "features", "duration", "name", "params"])

    def peak(n):
        tracemalloc.start()
        meeting = keyed.Meeting(source(n), None, "event_time", 4 << 20)
        met = sum(int((version == 1).sum()) for _, version in meeting.met())
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert met == n // 2
        return top

    assert peak(1_000_000) < 1.5 * peak(200_000) < 100 << 20


def test_continuous_trigger(spark, folder):
    stream = spark.readStream.format("rate").option("rowsPerSecond", 5).load().select("value")
    writer = stream.writeStream.format("noop").option("checkpointLocation", f"{folder}/c")
    query = sinks.start(writer, trigger="continuous")
    try:
        assert query.isActive
    finally:
        query.stop()


def test_text_sink(spark, folder):
    results = spark.createDataFrame([("m", "a", 10, 6.0)], "name string, data_type string, submission_ts long, result double")
    results.write.parquet(f"{folder}/in")
    schema = T.StructType(results.schema.fields)
    lines = sinks.result_lines(tables.stream_files(spark, f"{folder}/in", schema), F.lit(40))
    replay.finish(sinks.to_files(lines, f"{folder}/lines", f"{folder}/checkpoint", "text"))
    assert [r.value for r in spark.read.text(f"{folder}/lines").collect()] == ["Model served in 30 ms, with result 6.0 (model m, data type a)"]


def test_models_change_under_a_running_query(spark, folder):
    """A query that is never stopped, at the configured interval: it uses each model from its arrival on."""
    feed = Feed(spark, folder)
    records, _ = feed.streams()
    registry = batches.Registry(spark, f"{folder}/registry", replay.MODELS)
    writer = batches.serve_snapshot(
        records, registry, lambda: [F.get("features", 0)], f"{folder}/out", f"{folder}/checkpoint",
        Policy(no_model="mark"), keep=["record_id", "duration"], forms=["linear"],
    )

    def models(*rows):
        feed.models(*rows)
        stream = feed.streams()[1]
        replay.finish(batches.update_registry(stream, registry, f"{folder}/models-checkpoint"))

    query = sinks.start(writer)
    try:
        for i, change in enumerate([None, ("m1", "a", 1, 10.0), ("m2", "a", 2, 20.0), ("late", "a", 0, 30.0)]):
            if change:
                models(change)
            feed.records((i, "a", 100 + i, 1.0, 1.0))
            query.processAllAvailable()
        assert query.isActive and query.exception() is None
        first = query.id
    finally:
        query.stop()
    # The query is built anew, with other models, and goes on where it was.
    models(("m5", "a", 7, 50.0))
    feed.records((9, "a", 200, 1.0, 1.0))
    again = sinks.start(writer)
    try:
        again.processAllAvailable()
        assert again.id == first
    finally:
        again.stop()
    found = {r.record_id: (r.name, r.result) for r in batches.read_results(spark, f"{folder}/out", replay.SERVED).collect()}
    assert found == {0: (NO_MODEL, 0.0), 1: ("m1", 11.0), 2: ("m2", 21.0), 3: ("late", 31.0), 9: ("m5", 51.0)}


def test_state_after_each_batch(spark, folder):
    """History from the changes of the state; the state of a past batch is the same as its row of the history."""
    feed = Feed(spark, folder)
    steps = [
        ([("m1", "a", 1, 0.0), ("n1", "b", 1, 0.0)], [(1, "a", 2, 0.0, 3.0), (2, "a", 3, 0.0, 5.0), (3, "b", 3, 0.0, 1.5)]),
        ([], [(4, "a", 10, 0.0, 2.0), (5, "a", 11, 0.0, 0.5)]),
        ([("m2", "a", 20, 0.0)], [(6, "a", 21, 0.0, 4.0), (7, "b", 21, 0.0, 6.0)]),
    ]
    for models, records in steps:
        if models:
            feed.models(*models)
        feed.records(*records)
        run_keyed(spark, feed, processor=True)
    checkpoint = f"{folder}/checkpoint"
    columns = ["data_type", "name", "since", "usage", "duration"]
    found = keyed.read_history(spark, checkpoint).filter("usage > 0").select("batch_id", *columns)
    expected = [
        (0, "a", "m1", 1, 2, 8.0), (0, "b", "n1", 1, 1, 1.5),
        (1, "a", "m1", 1, 4, 10.5), (1, "b", "n1", 1, 1, 1.5),
        (2, "a", "m2", 20, 1, 4.0), (2, "b", "n1", 1, 2, 7.5),
    ]
    assert sorted(map(tuple, found.collect())) == expected
    for batch in range(3):
        then = keyed.read_stats(spark, checkpoint, batch).filter("usage > 0").select(*columns).collect()
        assert sorted(map(tuple, then)) == [r[1:] for r in expected if r[0] == batch]


def test_messages_with_models_of_one_time(spark, folder):
    """The whole way with many models at every time: each record meets the last of them to arrive, as in the SQL."""
    import duckdb

    from modelstream.plans.oracle import ORACLE

    k = F.when(F.col("i") % 2 == 0, F.lit(11) + F.col("i") % 8).otherwise(F.lit(1))
    minute = F.floor(F.col("i") / 100)
    events = spark.range(600).withColumnRenamed("id", "i").select(
        # Ids fall while the rows come in order.
        (F.lit(9999) - F.col("i")).alias("event_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + 60 * minute).cast("timestamp_ntz").alias("ts"),
        (F.col("i") % 3).alias("user_id"),
        F.when(F.col("i") % 2 == 0, "signup").otherwise("click").alias("event_type"),
        (F.col("i") / 4).alias("value"),
        F.format_string('{"k": %d}', k.cast("int")).alias("props"),
    )
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    expected = db.execute(ORACLE["stream_messages"]).fetchall()
    found = replay.stream_messages(spark, folder)
    assert found.columns == [d[0] for d in db.description]
    assert len(expected) == 300 and sorted(map(tuple, found.collect())) == sorted(expected)


def test_models_go_to_all_shards_as_blocks(spark):
    """Neither the shuffle nor Python handles models one by one for each shard."""
    models = spark.range(4000).select(
        F.format_string("m%d", "id").alias("name"), F.lit("d").alias("description"), F.lit("a").alias("data_type"),
        F.lit(2).alias("model_kind"), F.floor(F.col("id") / 4).alias("ts"), F.col("id").alias("seq"),
        linear_params(F.lit(1.0), [F.lit(1.0)]).alias("params"),
    )
    records = spark.range(4000).select(
        F.col("id").alias("record_id"), F.lit("a").alias("data_type"), F.col("id").alias("ts"), F.array(F.lit(1.0)).alias("features")
    )
    rows = keyed.stream_rows(records.coalesce(1), models.coalesce(1), shards=8).collect()
    assert len(rows) < 100 and {r.shard for r in rows} == set(range(8))
    import pandas as pd

    met = {}
    for shard in range(8):
        mine = pd.DataFrame([r.asDict() for r in rows if r.shard == shard])
        meeting = keyed.Meeting(iter([mine]), None, "event_time")
        # Of the four models of a time only the last can be in force.
        assert meeting.last == 1000 and meeting.newest[:2] == ("m3999", 999)
        for batch, version in meeting.met():
            out = keyed._output(batch, version, meeting.models)
            met |= dict(zip(out["record_id"], out["name"]))
    assert met == {i: f"m{4 * min(i, 999) + 3}" for i in range(4000)}


def test_memory_of_a_key_holds_one_model_for_each_time():
    """Four hundred thousand models at ten thousand times, as columns."""
    import pandas as pd
    import pyarrow as pa

    def source(n, size=20_000):
        for low in range(0, n, size):
            seq = range(low, low + size)
            yield pd.DataFrame(
                {
                    "data_type": "a", "shard": 0, "ts": [i % 10_000 for i in seq], "seq": seq, "is_record": False, "features": None,
                    "duration": None, "name": [f"m{i}" for i in seq], "params": "{}",
                }
            )

    before = pa.total_allocated_bytes()
    meeting = keyed.Meeting(source(400_000), ("old", -1, "{}"), "event_time")
    assert meeting.last == 10_000 and meeting.newest == ("m399999", 9999, "{}")
    assert pa.total_allocated_bytes() - before < 4 << 20
