"""Mart tables: partitioned Parquet whose partitions are replaced by staged ones (I1-I4 storage).

  <base>/data/<partition>=<value>/part-*.parquet   the rows
  <base>/table.json                                mark and columns
  <base>/_staged/                                  partitions about to take their places

A replacement is one Spark write, of the whole new content of the touched partitions into
``_staged``, and then one rename per partition. ``_staged/plan.json``, written when the
Spark job has committed, is the commit: a crash before it changes nothing, and after it the
next run of any writer finishes the renames before it does anything else. A load that is
run again merges the same keys into the same partitions, so rerunning is always safe.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import shuffles_freed

MARK_FLOOR = _dt.datetime(1900, 1, 1)  # the reference's default mark: 1900-01-01
GRAINS = ("day", "month", "year")
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder for a null partition value


def in_values(c: F.Column, values: list) -> F.Column:
    """Whether the column is one of ``values``, None standing for null."""
    known = c.isin([v for v in values if v is not None])
    return (known | c.isNull()) if None in values else known


class Folder:
    """A folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.fs = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.at(name))

    def folders(self, name: str) -> list[str]:
        found = self.fs.listStatus(self.at(name)) if self.exists(name) else []
        return [f.getPath().getName() for f in found if f.isDirectory() and not f.getPath().getName().startswith(("_", "."))]

    def move(self, name: str, to: str) -> None:
        """Take the place of ``to``, if it is there."""
        self.delete(to)
        self.fs.mkdirs(self.at(to).getParent())
        if not self.fs.rename(self.at(name), self.at(to)):
            raise OSError(f"cannot move {self.path}/{name}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)

    def read_json(self, name: str) -> dict | None:
        if not self.exists(name):
            return None
        stream = self.fs.open(self.at(name))
        return json.loads(bytes(stream.readAllBytes()))

    def write_json(self, name: str, value: dict) -> None:
        """Whole or not at all: written beside and renamed."""
        out = self.fs.create(self.at(f"{name}.new"), True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        self.move(f"{name}.new", name)


def publish_folder(df: DataFrame, path: str) -> DataFrame:
    """Write a whole (small) table beside the one that readers have, then take its place by a rename."""
    parent, _, name = path.rstrip("/").rpartition("/")
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").parquet(f"{parent}/_{name}_staged")
    Folder(df.sparkSession, parent).move(f"_{name}_staged", name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class MartTable:
    """A mart partitioned by a date column, or by the month or year of it.

    ``grain='day'`` is the layout for large data, where a daily load rewrites only the days
    it touches. 'month' and 'year' are for thin data, where one folder per day would mostly
    hold tiny files; their partition column is derived and hidden on read.
    """

    def __init__(self, spark: SparkSession, base: str, by: str = "date_key", grain: str = "day",
                 sort: tuple[str, ...] = ()):
        if grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}")
        self.spark, self.base, self.by, self.grain = spark, base.rstrip("/"), by, grain
        self.sort = sort  # columns that the files of a partition are sorted by
        self.folder = Folder(spark, self.base)
        info = self.info()
        if info:  # a table that exists keeps its own grain
            self.grain = info["grain"]
        self.partition_col = by if self.grain == "day" else f"{by}_{self.grain}"

    def info(self) -> dict | None:
        return self.folder.read_json("table.json")

    def exists(self) -> bool:
        return self.info() is not None

    def mark(self) -> _dt.datetime:
        mark = (self.info() or {}).get("mark")
        return _dt.datetime.fromisoformat(mark) if mark else MARK_FLOOR

    def schema(self) -> StructType:
        """The table's columns as readers see them."""
        return StructType.fromJson(self.info()["schema"])

    def read(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"table {self.base} has no data yet")
        return self._rows().select(*self.schema().fieldNames())

    def read_partitions(self, values: list, other: bool = False) -> DataFrame:
        """Rows of the given partitions only (pruned at the scan), or of all others; None is the null date's."""
        given = in_values(F.col(self.partition_col), values)
        rows = self._rows().where(~F.coalesce(given, F.lit(False)) if other else given)
        return rows.select(*self.schema().fieldNames())

    def _rows(self) -> DataFrame:
        fields = self.schema() if self.grain == "day" else StructType([*self.schema().fields]).add(self.partition_col, "date")
        return self.spark.read.schema(fields).parquet(f"{self.base}/data")

    def partition_value_py(self, d):
        """The partition value of a Python date."""
        if self.grain == "day" or d is None:
            return d
        return d.replace(day=1) if self.grain == "month" else d.replace(month=1, day=1)

    def _folder_of(self, value) -> str:
        return f"{self.partition_col}={NULL_PARTITION if value is None else value}"

    def stage(self, df: DataFrame) -> None:
        """Write ``df`` by partitions; AQE spreads a partition with many rows over many tasks and merges small ones."""
        if self.grain != "day":
            df = df.withColumn(self.partition_col, F.trunc(F.col(self.by), self.grain))
        df = df.hint("rebalance", self.partition_col)
        if self.sort:
            df = df.sortWithinPartitions(self.partition_col, *self.sort)
        with shuffles_freed(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").partitionBy(self.partition_col).parquet(f"{self.base}/_staged")

    def staged(self, schema: StructType) -> DataFrame:
        """The staged rows, of the given columns."""
        return self.spark.read.schema(schema).parquet(f"{self.base}/_staged")

    def replace(self, df: DataFrame, parts: list | None, mark) -> list:
        """``df`` becomes the whole content of the partitions ``parts``, or of the table; its columns
        become the table's. Returns those of ``parts`` that are left without rows."""
        self.stage(df)
        return self.commit(df.schema, parts, mark)

    def commit(self, schema: StructType, parts: list | None, mark) -> list:
        """What is staged takes its place, as ``replace`` says."""
        filled = self.folder.folders("_staged")
        names = self.folder.folders("data") if parts is None else [self._folder_of(v) for v in parts]
        self.folder.write_json("_staged/plan.json", {
            "filled": filled, "emptied": sorted(set(names) - set(filled)),
            "table": {"mark": mark.isoformat() if mark else None, "schema": schema.jsonValue(), "grain": self.grain}})
        self.recover()
        return [v for v in parts or [] if self._folder_of(v) not in filled]

    def recover(self) -> None:
        """Finish a replacement that was committed. What has taken its place is no longer staged, so
        doing it again goes on where it stopped."""
        plan = self.folder.read_json("_staged/plan.json")
        if plan is None:
            return
        self.folder.fs.mkdirs(self.folder.at("data"))
        for name in plan["filled"]:
            if self.folder.exists(f"_staged/{name}"):
                self.folder.move(f"_staged/{name}", f"data/{name}")
        for name in plan["emptied"]:
            self.folder.delete(f"data/{name}")
        self.folder.write_json("table.json", plan["table"])
        self.folder.delete("_staged")
