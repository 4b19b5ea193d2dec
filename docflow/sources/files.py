"""Directory sources.

``binaryFile`` lists a directory on whatever file system its URI names
(``s3a://``, ``abfss://``, ``hdfs://``), so no global ``fs.defaultFS`` has to
be set. It reads the contents on the executors but leaves out zero-length
files and names that start with ``_`` or ``.``; ``file_manifest`` lists those
too, so nothing that is there goes unreported.
"""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docflow.session import hadoop_fs

MANIFEST = StructType([StructField("name", StringType()), StructField("path", StringType()),
                       StructField("length", LongType())])


def read_files(spark: SparkSession, path: str, *, glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    """One row per file with content: path, modificationTime, length, content.

    ``content`` is only read when a later step uses it; a projection to
    path/length lists files without opening them.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path)


def file_manifest(spark: SparkSession, path: str, *, glob: str | None = None,
                  recursive: bool = False) -> DataFrame:
    """Name, path and length of each file, empty and hidden ones included; contents are not read.

    The names come from one listing call of the file system on the driver (as
    Spark's own file index does), never from opening files.
    """
    fs, root = hadoop_fs(spark, path)
    rows = []
    it = fs.listFiles(root, recursive)
    while it.hasNext():
        status = it.next()
        name = status.getPath().getName()
        if glob is None or fnmatch.fnmatchcase(name, glob):
            rows.append((name, status.getPath().toString(), int(status.getLen())))
    return spark.createDataFrame(rows, MANIFEST)
