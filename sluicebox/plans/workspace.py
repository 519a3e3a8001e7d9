"""Written tables between the passes of a run, in the shared folder the cluster names."""
from __future__ import annotations

import contextlib
import logging
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from sluicebox.session import SETTINGS

log = logging.getLogger(__name__)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="sluicebox-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


HUGE_METHOD, OPEN_FILES = "spark.sql.codegen.hugeMethodLimit", "spark.sql.maxConcurrentOutputFileWriters"


@contextlib.contextmanager
def writing(spark: SparkSession):
    """Settings of the session while a table is written.

    The JVM interprets methods above 8000 bytes, in which the rules of a dozen columns end up if all go into one; and rows
    are not sorted to go to one of two files.
    """
    before = {name: spark.conf.get(name) for name in (HUGE_METHOD, OPEN_FILES)}
    spark.conf.set(HUGE_METHOD, str(min(int(before[HUGE_METHOD]), int(SETTINGS[HUGE_METHOD]))))
    spark.conf.set(OPEN_FILES, "8")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Workspace:
    """Parquet tables of one run.  Later passes read only the columns they need from them.

    A lost executor costs a re-read, not the work before the written table.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/sluicebox-{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """The table written and read back; rows that differ in the column ``by`` go to files of their own."""
        path = f"{self.root}/{name}"
        with writing(self.spark):
            df.write.mode("overwrite").parquet(path, partitionBy=by)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Delete the run's tables; call it once its results are written elsewhere."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
