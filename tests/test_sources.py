import pytest
from pyspark.sql import functions as F

from modelstream.config import ServingConfig
from modelstream.schemas import WINE_FIELDS
from modelstream.sources import sinks, tables


def test_delimited_text(spark, tmp_path):
    values = [7.4, 0.7, 0.0, 1.9, 0.076, 11.0, 34.0, 0.9978, 3.51, 0.56, 9.4]
    line = " ; ".join(str(v) for v in values) + ";5;more"
    (tmp_path / "wine.csv").write_text(line + "\n" + line.replace(" ", "") + "\n")
    for read in (tables.read_delimited, tables.read_delimited_lines):
        rows = read(spark, str(tmp_path / "wine.csv")).collect()
        assert len(rows) == 2
        assert all([r[c] for c in WINE_FIELDS] == values and r.data_type == "wine" for r in rows)


@pytest.mark.parametrize("body", ["1;x;3\n", "1;2\n"])
@pytest.mark.parametrize("read", [tables.read_delimited, tables.read_delimited_lines])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_numbers_fail(spark, tmp_path, body, read, ansi):
    (tmp_path / "bad.csv").write_text(body)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a number"):
            read(spark, str(tmp_path / "bad.csv"), ["a", "b", "c"]).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_replay_order(spark):
    rows = tables.replay_order(spark.createDataFrame([(1,), (3,), (2,)], "n int"), "n").collect()
    assert [r.n for r in rows] == [3, 2, 1]


def test_kafka_options():
    options = tables.kafka_options(ServingConfig(brokers="b:1"), "mdata")
    assert options == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "mdata",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def test_publish_keyed_unkeyed_and_batch(spark, folder):
    rows = spark.createDataFrame([("k1", "v1"), ("k2", "v2")], "k string, v string")
    sinks.publish(sinks.messages(rows, F.col("v"), F.col("k")), f"{folder}/t")
    sinks.publish(sinks.messages(rows, F.col("v")), f"{folder}/t")
    back = spark.read.parquet(f"{folder}/t")
    assert sorted(bytes(r.value) for r in back.collect()) == [b"v1", b"v1", b"v2", b"v2"]
    assert back.filter("key IS NULL").count() == 2


def test_result_lines(spark):
    results = spark.createDataFrame([("m", "wine", 10, 6.0)], "name string, data_type string, submission_ts long, result double")
    assert sinks.result_lines(results, F.lit(40)).first()[0] == "Model served in 30 ms, with result 6.0 (model m, data type wine)"
    sinks.discard(results)


def test_unknown_trigger(spark):
    with pytest.raises(ValueError):
        sinks.start(None, trigger="sometimes")


@pytest.mark.parametrize("limit", [500_000, 0])
def test_lines_are_numbered_as_read_in_sequence(spark, tmp_path, limit):
    """Files of many splits, of one, without a last line feed, with empty lines, and an empty file."""
    import random

    from modelstream.config import Limits

    rng, expected = random.Random(6), []
    for name, n, end in (("b.txt", 700, "\n"), ("a.txt", 300, ""), ("c.txt", 1, "\n"), ("d.txt", 0, "")):
        lines = ["x" * rng.choice([0, 3, 90]) + f" {name} {i}" for i in range(n)]
        (tmp_path / name).write_text("\n".join(lines) + end)
        expected += [(name, i + 1, line) for i, line in enumerate(lines)]
    expected.sort(key=lambda r: r[:2])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = tables.read_lines(spark, str(tmp_path), Limits(broadcast_rows=limit)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    rows.sort(key=lambda r: r.number)
    assert [(r.file.rsplit("/", 1)[1], r.line, r.value) for r in rows] == expected
    assert [r.number for r in rows] == list(range(1, len(expected) + 1))
    assert [r.from_end for r in rows] == list(range(len(expected), 0, -1))


def test_discard_runs_the_query(spark):
    from pyspark.sql import Observation

    seen = Observation("seen")
    sinks.discard(spark.range(17).observe(seen, F.count(F.lit(1)).alias("n")))
    assert seen.get["n"] == 17


def test_stamp(spark):
    import time

    from modelstream.functions.text import stamp

    low = int(time.time() * 1000)
    row = spark.range(1).select(stamp().alias("now"), stamp(F.lit(5)).alias("given")).first()
    assert low - 1000 <= row.now <= int(time.time() * 1000) + 1000 and row.given == 5


def test_shared_settings_are_the_names_existing_jobs_use():
    shared = ServingConfig()
    assert (shared.data_topic, shared.models_topic) == ("mdata", "models")
    assert (shared.data_group, shared.models_group) == ("wineRecordsGroup", "modelRecordsGroup")
    assert (shared.trigger, shared.continuous) == ("1 second", "5 seconds")
    with pytest.raises(AttributeError):
        shared.trigger = "2 seconds"
