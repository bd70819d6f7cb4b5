"""Session defaults and lineage cutting."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Rows that a part of an exchange made by ``dealt`` has on average.
ROWS_PER_PART = 250_000


def build_session(app_name: str = "creditloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect (UTC, AQE with skew splitting)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as named by ``spark.checkpoint.dir``.

    Only a local session, where one machine does everything, may go without the setting and
    gets a scratch folder; a cluster without a shared folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="creditloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative estimators checkpoint their own state in the shared folder."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from its files.

    Used between the rounds of iterative operators and before a stage that is read several
    times: a lost executor re-reads files instead of replaying the earlier rounds, later
    stages prune columns, and their joins are planned with the real size of the table.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stages/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, n_rows: int, *keys) -> DataFrame:
    """``df`` exchanged by ``keys``, in as many parts as ``n_rows`` rows need.

    For steps that widen or multiply their rows after an exchange, where its bytes say little
    about the memory of a task: the parts keep their size when the table grows.
    """
    return df.repartition(max(1, math.ceil(n_rows / ROWS_PER_PART)), *keys)


def dealt_if_counted(df: DataFrame, n_rows: int | None, columns, *keys) -> DataFrame:
    """The ``columns`` of ``df`` dealt by ``keys``; ``df`` as it is where its rows were not counted."""
    return df if n_rows is None else dealt(df.select(*columns), n_rows, *keys)
