"""Which files a load has taken: new input by a ledger, not by a clock.

A time limit misses a file that arrives late with an older time, and takes a file
again that was copied with a newer one. A ledger knows files by name and length, in
whatever folder and with whatever time they lie. Writers of exports give every file
a name of its own, as Spark does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from shelfscan import schemas


def listed_files(spark: SparkSession, path: str | Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """(file, length, modified, path) of the files below a path; none is opened.

    Listed when called: files that arrive later are not in the DataFrame, however often it is read.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    listed = reader.load(path if isinstance(path, str) else list(path))
    name = F.regexp_extract("path", "[^/]+$", 0).alias("file")
    return listed.select(name, "length", F.col("modificationTime").alias("modified"), "path")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """What was taken so far: (load, file, length)."""
    try:
        return spark.read.schema(schemas.LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.LEDGER)


def fresh_files(listed: DataFrame, taken: DataFrame, load: str) -> DataFrame:
    """The listed files that a load has not taken; of copies, the one with the first path."""
    known = taken.filter(F.col("load") == load).select("file", "length")
    fresh = listed.join(known, ["file", "length"], "left_anti")
    return fresh.groupBy("file", "length").agg(F.min(F.struct("path", "modified")).alias("x")).select("file", "length", "x.*")


def read_files(spark: SparkSession, files: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of files (by ``path``), and no others; an empty DataFrame where there are none.

    The paths go to the driver, where Spark lists what it reads anyway.
    """
    paths = [row.path for row in files.select("path").collect()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def note_taken(files: DataFrame, ledger: str, load: str) -> None:
    """Puts files into the ledger, once their rows are safe. Noting a file twice does no harm."""
    rows = files.select(F.lit(load).alias("load"), "file", "length")
    rows.coalesce(1).write.mode("append").parquet(ledger)
