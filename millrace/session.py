"""Session helpers: table access, shared-folder materialisation, partition sizing."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings news jobs papers startups "
    "entity_mapping_log canonical_entities feed_sources lang_labels mix_targets"
).split()


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Unset, a temporary one is chosen in local mode; on a
    cluster that would lie on one machine, so it is an error there."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def materialize(df: DataFrame, name: str = "t", by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives the loss of executors, and lets
    later plans scan only the columns and row groups (with ``by``, the partitions) they need. The folders are those of the
    session, which outlives every frame that reads them: they go with ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace-{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    return read.select(*df.columns) if by else read


def tidy(spark: SparkSession) -> None:
    """Collect the driver's garbage now, so that Spark deletes the shuffle files behind frames that were materialised and
    that nothing refers to any more, before the next large step adds its own."""
    for _ in range(2):  # what the first pass frees holds what the second one can
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: workers need not have it on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_millrace_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="millrace-")) / "millrace.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._millrace_shipped = True


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
