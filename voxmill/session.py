"""Session settings and the shared work folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "voxmill", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution; partition counts are left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # Recording the Python call site of every column doubles the time to build large plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key: str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows that a query puts into one of the files it makes, and fewer with whole texts.
FILE_ROWS, TEXT_FILE_ROWS = 200_000, 25_000


def tasks_for(rows: int, rows_per_task: int) -> int:
    return max(1, math.ceil(rows / rows_per_task))


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session, as in tests, may go without it; it then gets its own scratch folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="voxmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df):
    """Materialise ``df`` reliably: later jobs read the stored rows instead of recomputing them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """As ``cut``, in a compressed table of which later jobs read only the columns they use."""
    path = new_path(df.sparkSession, name)
    # Parquet has no column without a type.
    untyped = [c for c, t in df.dtypes if t == "void"]
    typed = df.drop(*untyped)
    typed.write.parquet(path)
    back = df.sparkSession.read.schema(typed.schema).parquet(path)
    return back.withColumns({c: F.lit(None) for c in untyped}).select(*[f"`{c}`" for c in df.columns])
