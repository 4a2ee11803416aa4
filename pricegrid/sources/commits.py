"""A log of numbered commit files: each is created whole, and never over another.

A commit is written under a name of its own and then takes the next number. On
a shared file system the rename that refuses an existing target decides who gets
it, on a local one a hard link, which fails alike; the loser reads what was
committed meanwhile and decides again. Readers see the commits up to the highest
number without a gap, and every commit in full.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

DIGITS = 20
TAKEN = ("FileAlreadyExistsException", "FileExistsException")


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path(self.path).getFileSystem(self.conf)

    def _path(self, name):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def _file(self, number):
        return f"{self.path}/{number:0{DIGITS}d}.json"

    def last(self) -> int:
        """The highest number committed, -1 without any."""
        if not self.fs.exists(self._path(self.path)):
            return -1
        names = (status.getPath().getName() for status in self.fs.listStatus(self._path(self.path)))
        return max((int(n[:DIGITS]) for n in names if n.endswith(".json") and n[:DIGITS].isdigit()), default=-1)

    def read(self, schema, upto=None):
        """The commits up to a number (the last by default) as a table with their `number`."""
        upto = self.last() if upto is None else upto
        if upto < 0:
            return self.spark.createDataFrame([], schema).withColumn("number", F.lit(None).cast("long"))
        found = self.spark.read.schema(schema).json(f"{self.path}/[0-9]*.json")
        name = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1).cast("long")
        return found.withColumn("number", name).where(F.col("number") <= upto)

    def commit(self, number, row: dict) -> bool:
        """Take this number for the row; False if another commit has it."""
        waiting = self._path(f"{self.path}/_waiting/{uuid.uuid4().hex}.json")
        out = self.fs.create(waiting, False)
        try:
            out.write(bytearray((json.dumps(row) + "\n").encode()))
        finally:
            out.close()
        try:
            self._take(waiting, self._path(self._file(number)))
            return True
        except (Py4JJavaError, CapturedException) as error:
            if not any(name in str(error) for name in TAKEN):
                raise
            return False
        finally:
            self.fs.delete(waiting, False)

    def _take(self, waiting, target):
        if self.fs.getUri().getScheme() == "file":
            local = lambda path: self.jvm.java.io.File(path.toUri().getPath()).toPath()
            self.jvm.java.nio.file.Files.createLink(local(target), local(waiting))
            return
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf)
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        # Without OVERWRITE an existing target is refused.
        context.rename(waiting, target, self.spark.sparkContext._gateway.new_array(rename, 0))
