"""A stored table of posts, bucketed by URL, for lookups and skip-existing.

Rows are dealt by URL into buckets when they are written, and sorted there. A join by URL
then reads the stored side bucket by bucket: only the new rows are shuffled, however much
is stored. New rows are appended to the buckets; nothing that is stored is rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a new store. A bucket is read by one task, so take rows / this as its size.
BUCKETS = 64


class PostStore:
    """The table ``name`` with its files in the shared folder ``path``."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = BUCKETS):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets

    def open(self, schema: str) -> PostStore:
        """Register files that an earlier session stored; ``schema`` and buckets are those they were written with."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}) USING parquet CLUSTERED BY (url) SORTED BY (url) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return self

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, "url")

    def append(self, rows: DataFrame) -> None:
        """Store rows as they are, one file for each bucket that has any."""
        writer = self._dealt(rows).write.mode("append").format("parquet").bucketBy(self.buckets, "url").sortBy("url")
        writer.option("path", self.path).saveAsTable(self.name)

    def new_rows(self, rows: DataFrame) -> DataFrame:
        """A10: rows whose URL is not stored. A NULL URL counts as new."""
        if not self.exists():
            return rows
        return rows.join(self.table().select("url").hint("merge"), "url", "left_anti")

    def append_new(self, rows: DataFrame) -> None:
        """store the rows whose URL is not stored yet, of each URL one.

        Run again with the same rows it stores nothing, so a job that failed can be repeated.
        """
        others = [c for c in rows.columns if c != "url"]
        one = self.new_rows(rows).groupBy("url").agg(F.min(F.struct(*others)).alias("_row")).select("url", "_row.*")
        self.append(one.select(*rows.columns))

    def lookup(self, urls: DataFrame) -> DataFrame:
        """A5: the stored row of each URL; NULL columns where there is none."""
        return urls.join(self.table().hint("merge"), "url", "left")
