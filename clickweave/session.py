"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PARTITIONS = "spark.sql.shuffle.partitions"
#: So many records of a stream get one more state partition, once there is one for each core.
RECORDS_PER_STATE = 500_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("clickweave")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    It lies under the cluster's `spark.checkpoint.dir`. Only a local-mode session, where driver and
    executors share one disk, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="clickweave-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def state_partitions(spark: SparkSession, n_records: int) -> int:
    """How many partitions the state of a stream of so many records needs, at most the session's shuffle partitions.

    Every partition has stores to load and commit in every batch, however little they hold, so there is one for each core, and
    more only for many records.
    """
    needed = max(spark.sparkContext.defaultParallelism, -(-n_records // RECORDS_PER_STATE))
    return min(int(spark.conf.get(PARTITIONS)), needed)


@contextmanager
def shuffled_into(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """Streams started inside have so many state partitions; restarted ones keep what their checkpoint has. None changes nothing."""
    before = spark.conf.get(PARTITIONS)
    if partitions is not None:
        spark.conf.set(PARTITIONS, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, before)
