"""Tables that are written once to the shared folder, so that later jobs neither repeat nor lose the work, and broadcasts by counted rows."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A table of at most so many rows of a few numbers may be broadcast (some tens of MB).
BROADCAST_ROWS = 500_000

#: So many rows of a few numbers and short texts are sorted or grouped by one task (some 100 MB for each sort).
TASK_ROWS = 1_000_000

_staged: dict[str, SparkSession] = {}
_local: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, a local one for a local session, and an error on a cluster."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local:
        _local.append("file://" + tempfile.mkdtemp(prefix="veinstone-"))
    return _local[0]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back. The write also counts the rows."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/veinstone-{name}-{uuid.uuid4().hex}"
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(path)
    if not _staged:
        atexit.register(lambda: _delete(list(_staged)))
    _staged[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at, out.staged_rows = path, counted.get["n"]
    return out


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over as many tasks as a shuffle has: for work that is long per row, on tables that are few splits of a file. Adaptive execution, which goes by bytes, does not join these tasks again."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def counted(df: DataFrame) -> int:
    """How many rows ``df`` has, or has at most where that was noted."""
    return df.staged_rows if "staged_rows" in vars(df) else df.count()


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by ``keys`` over so many tasks that each has about ``TASK_ROWS``, so that the memory of a task does not grow with the table; a join or grouping by ``keys`` keeps them.

    Where the session's number of shuffle partitions is enough for that, ``df`` is left to adaptive execution.
    """
    tasks = -(-rows // TASK_ROWS)
    return df.repartition(tasks, *keys) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def released(*tables: DataFrame) -> None:
    """Delete staged tables that no later job reads."""
    _delete([t.staged_at for t in tables])


def staged_now() -> set[str]:
    return set(_staged)


def released_since(before: set[str], *keep: DataFrame) -> None:
    """Delete what was staged since ``before``, but for the tables ``keep``: for steps whose result is written, so that nothing else of theirs is read again."""
    _delete(list(staged_now() - before - {t.staged_at for t in keep}))


def _delete(paths: list[str]) -> None:
    for path in paths:
        spark = _staged.pop(path)
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001  the session may have ended; the files are only scratch
            return


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, staged (or a projection of a staged table, which is counted), marked for broadcast when it has at most ``rows`` rows, of a few numbers each.

    Beyond that it is joined by shuffle, where adaptive execution splits skewed keys.
    """
    n = df.staged_rows if "staged_rows" in vars(df) else df.limit(rows + 1).count()
    return F.broadcast(df) if n <= rows else df


def renamed(df: DataFrame, **names: str) -> DataFrame:
    """A staged table with columns under other names: new=old."""
    out = df.select(*[F.col(old).alias(new) for new, old in names.items()])
    out.staged_rows = df.staged_rows
    return out
