"""Helpers that several operators share."""

import os
import sysconfig
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.plans.staging import new_folder

#: Words are runs of anything but these six characters.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; only Spark's readers open its path."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Stores the rows as a table in the shared folder and reads them back.

    The plan above then starts from files that outlive lost executors. The
    files go when the application ends.
    """
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    df.write.parquet(folder)
    drop_at_end(spark, folder)
    return spark.read.schema(df.schema).parquet(folder)


def own_folder(spark: SparkSession, purpose: str) -> str:
    """A new, empty folder in the shared one, which goes with its files when the application ends."""
    folder = new_folder(spark, purpose)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    # what doesn't exist yet can't be marked
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    drop_at_end(spark, folder)
    return folder


def drop_at_end(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Words of a text; none for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


#: Rows that go to a Python worker at once, unless the session says otherwise. Spark's own default, 10,000, holds
#: too much text for small executors: the batch is kept outside the heap, and once more in Python.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Makes the session fit for Python work on texts: smaller batches, and the library on all workers."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    ship(spark)


def ship(spark: SparkSession) -> None:
    """Sends the library to Python workers that would not find it on the path they start with."""
    root = Path(__file__).resolve().parents[2]
    found = [os.getcwd(), sysconfig.get_paths()["purelib"], *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    application = spark.sparkContext.applicationId
    if application in _SHIPPED or root in (Path(p).resolve() for p in found if p):
        return
    bundle = os.path.join(tempfile.mkdtemp(prefix="wattframe-"), "wattframe.zip")
    with zipfile.ZipFile(bundle, "w") as out:
        for file in sorted((root / "wattframe").rglob("*.py")):
            out.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(bundle)
    _SHIPPED.add(application)
