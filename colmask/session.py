"""Where a job may put tables it has to write between two steps."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Rows of a file that later steps read. Spark deals files out by their bytes and takes each for at least 4 MB, 32 to a task: names
#: compress so well that a task would else read, and sort, as many rows as the table has.
ROWS_PER_FILE = 50_000

_LOCAL_FOLDERS: dict[str, str] = {}
_AREAS = threading.local()


def work_root(spark: SparkSession) -> str:
    """The application's folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver gets a temporary
    folder without that setting; on a cluster a folder of one machine would not be seen by the others.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="colmask-")
        root = _LOCAL_FOLDERS[app]
    return f"{root.rstrip('/')}/{app}"


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for what a job has to write; inside a ``work_area`` it goes when the area ends."""
    path = f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
    areas = getattr(_AREAS, "open", [])
    if areas:
        areas[-1].append(path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system layer."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def work_area(spark: SparkSession) -> Iterator[None]:
    """Delete the work folders made inside, in this thread, when the block ends.

    For steps that end in a write of their own. A frame that is handed out
    may still read its work folder and must not come from inside.
    """
    if not hasattr(_AREAS, "open"):
        _AREAS.open = []
    made: list[str] = []
    _AREAS.open.append(made)
    try:
        yield
    finally:
        _AREAS.open.remove(made)
        for path in made:
            drop_folder(spark, path)


def drop_work_folders(spark: SparkSession) -> None:
    """Delete all work folders of this application; for the end of a job, when no frame reads them any more."""
    drop_folder(spark, work_root(spark))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a work folder and read back.

    For results that several later steps need: they then read files, which
    outlive lost executors, and do not compute the result again. Files are short, so that a task reads a bounded number of rows.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
