"""Session helpers: where shared scratch data goes and how wide to bucket."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tabwright", cores: str = "*", **conf) -> SparkSession:
    """A local session for tests and benches; on a cluster use the given one."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # call-site capture costs several driver round trips per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    There is no default: intermediate tables on one machine's disk would be out of the others' reach.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    named = named or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; every call gets its own."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def settle(df, label: str = "settled", file_rows: int = 0):
    """Cut lineage by writing to the shared folder and reading back.

    Used where several jobs read one expensive result: unlike a cached block, the
    written table survives the loss of the executor that made it. ``file_rows`` limits
    the rows of a file (0: no limit), for tables whose rows are long.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    limit = {"maxRecordsPerFile": file_rows} if file_rows else {}
    df.write.options(compression="zstd", **limit).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df, rows: int, share: int):
    """``df``, which has ``rows`` rows, dealt evenly to a task per ``share`` of them, but to two a core at most, for work that passes over it many times.

    Files are read by a task each however many rows they hold, and one task's rows then set the pace of every pass. A table of one share stays as it is.
    """
    tasks = min(-(-rows // share), 2 * df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(tasks) if tasks > 1 else df


BUCKET_ROWS = 500_000


def bucket_target(spark: SparkSession, rows: int = 0) -> int:
    """How many range buckets a global order over ``rows`` rows is cut into.

    Twice the shuffle width at least, and as many as keep a bucket near BUCKET_ROWS.
    """
    return max(8, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))
