"""A ledger of loads: which ranges of a feed have been landed, and in which folders.

A load writes its rows into a folder of its own first and is entered in the ledger after that.
Readers look at entered folders only, so what a failed run has left behind is never read, and a
rerun starts from the last entry. An entry is a small file under a name made of the feed and the
range's start. It is written aside and renamed into place, and a rename onto an existing name
fails: of two runs that load one range at the same time, one is entered.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = "feed string, first date, until date, label date, folder string"


@dataclass(frozen=True)
class Load:
    """Days first..until-1 of a feed, as landed in a folder. `label` is the last day that the
    folder's name states."""

    feed: str
    first: str
    until: str
    label: str
    folder: str


class Ledger:
    """Entries below a folder on a file system whose rename is atomic."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._root = self._hadoop.Path(self.path)
        self._fs = self._root.getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._root.toUri(), conf)
        self._options = spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)

    def entries(self, feed: str | None = None) -> DataFrame:
        """(feed, first, until, label, folder), a row per load."""
        if not self._fs.exists(self._root):
            found = self.spark.createDataFrame([], T._parse_datatype_string(ENTRY))
        else:
            found = self.spark.read.schema(ENTRY).option("pathGlobFilter", "*.json").json(self.path)
        return found if feed is None else found.where(F.col("feed") == feed)

    def high_water(self, feed: str) -> str | None:
        """The day from which the next load starts: the end of the newest range."""
        until = self.entries(feed).agg(F.max("until")).first()[0]
        return None if until is None else str(until)

    def enter(self, load: Load) -> bool:
        """Whether this load now stands in the ledger; false where another run was first."""
        aside = self._hadoop.Path(f"{self.path}/_{uuid.uuid4().hex}")
        target = self._hadoop.Path(f"{self.path}/{quote(load.feed, safe='')}@{load.first}.json")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps(asdict(load)).encode()))
        finally:
            out.close()
        try:
            self._context.rename(aside, target, self._options)
        except Py4JJavaError as error:
            if not error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise
            self._fs.delete(aside, False)
            return False
        return True

    def read(self, schema: T.StructType, feed: str | None = None) -> DataFrame:
        """The rows of all entered loads, with feed, first and label of the load they came by."""
        own = ["feed", "first", "label"]
        loads = self.entries(feed).select(*own, "folder").collect()
        if not loads:
            fields = [T.StructField(n, T.StringType() if n == "feed" else T.DateType()) for n in own]
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *fields]))
        # One scan over all entered folders; the id at the end of its folder's name tells a file's load.
        id_of = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).substr(F.lit(-32), F.lit(32))
        rows = self.spark.read.schema(schema).parquet(*[r.folder for r in loads]).withColumn("_load", id_of)
        known = self.entries(feed).select(F.col("folder").substr(F.lit(-32), F.lit(32)).alias("_load"), *own)
        return rows.join(known, "_load").drop("_load")
