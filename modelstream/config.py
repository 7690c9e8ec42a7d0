"""Shared settings, session defaults and the working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class ServingConfig:
    """Names and options every job of a deployment shares."""

    # Topic and consumer group names that existing producers and consumers use.
    data_topic: str = "mdata"
    models_topic: str = "models"
    data_group: str = "wineRecordsGroup"
    models_group: str = "modelRecordsGroup"

    brokers: str = "localhost:9092"
    trigger: str = "1 second"
    continuous: str = "5 seconds"
    # State partitions of a stateful query. A checkpoint keeps the number it began with, so choose it for the largest
    # cluster the query will ever run on.
    state_partitions: int = 8


@dataclass(frozen=True)
class Limits:
    """Bounds that decide between a broadcast and a shuffle.

    A side is broadcast only after its rows and bytes were counted and found within these bounds.
    """

    broadcast_rows: int = 500_000
    broadcast_bytes: int = 64 * 1024 * 1024
    # Model switches one record may be compared with inside its time cell in a broadcast as-of join.
    cell_candidates: int = 64
    # Rows of one key that one task sorts; a key with more rows is cut into ordered chunks.
    rows_per_chunk: int = 2_000_000
    # Pieces of a task's mean share that the rows of a heavy key are cut into in a salted join.
    pieces: int = 8


def session(app: str = "modelstream", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults the operators are planned for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for `purpose` under the cluster's shared checkpoint folder.

    The shared folder is the session's ``spark.checkpoint.dir``. Where neither the setting nor a checkpoint folder exists,
    a session on one machine makes and sets a temporary folder; on a cluster, where tasks share no local folder, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="modelstream-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session: they need not be started from the folder it lies in."""
    context = spark.sparkContext
    if getattr(context, "_modelstream_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="modelstream-"), "modelstream.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(home):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("modelstream", os.path.relpath(full, home)))
    context.addPyFile(path)
    context._modelstream_shipped = True
