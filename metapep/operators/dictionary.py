"""A dictionary of strings that only grows: releases give new ids to new strings, and known ones keep theirs.

Every release is a folder of its own, bucketed and sorted by string.  The strings of a
new release are dealt out once, by the same buckets, and taken off against one release
after the other without any of them being shuffled; what is left is numbered, in byte
order, from above the largest id.  A release that is there already is not made again, so
a job that runs twice, or starts anew after it was lost, gives the same ids.
"""

from __future__ import annotations

import re
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import cut, exists, join_checked, listed
from .numbering import number_rows

#: Strings of the first release that a bucket holds, which a task sorts.
BUCKET_ROWS = 1 << 21


class Dictionary:
    """(id, text) by release under a folder.  buckets: least number of the first release, which has one for BUCKET_ROWS strings if that is more; all others have as many as the first."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self._name = f"dictionary_{md5(self.path.encode()).hexdigest()}"

    def _folder(self, release: int) -> str:
        return f"{self.path}/release={release}"

    def releases(self) -> list[int]:
        """The releases that were written whole."""
        found = [int(m[1]) for name in listed(self.spark, self.path) if (m := re.fullmatch(r"release=(\d+)", name))]
        return sorted(r for r in found if any(exists(self.spark, f"{self._folder(r)}/{x}/_SUCCESS") for x in listed(self.spark, self._folder(r))))

    def _bucket_number(self, release: int) -> int:
        return max(int(m[1]) for f in listed(self.spark, self._folder(release)) if (m := re.search(r"-b(\d+)$", f)))

    def _table(self, release: int) -> DataFrame:
        """A release as a bucketed table, which a new session does not know yet."""
        name = f"{self._name}_{release}"
        if not self.spark.catalog.tableExists(name):
            buckets = self._bucket_number(release)
            self.spark.sql(f"CREATE TABLE {name} (id BIGINT, text STRING) USING parquet CLUSTERED BY (text) SORTED BY (text) INTO {buckets} BUCKETS LOCATION '{self._folder(release)}/data-b{buckets}'")
        return self.spark.table(name)

    def read(self, release: int | None = None) -> DataFrame:
        """(id, text, release) up to a release."""
        own = [r for r in self.releases() if release is None or r <= release]
        if not own:
            return self.spark.createDataFrame([], "id long, text string, release int")
        tables = [self._table(r).select("id", "text", F.lit(r).alias("release")) for r in own]
        out = tables[0]
        for t in tables[1:]:
            out = out.union(t)
        return out

    def append(self, values: DataFrame, column: str, release: int) -> DataFrame:
        """(id, text) of the strings that this release brings, written; nulls are no strings.

        Releases come in order: one below a later release that is there is an error.
        A release that is there is returned as it is.
        """
        known = self.releases()
        if release in known:
            return self._table(release)
        if known and release < known[-1]:
            raise ValueError(f"release {release} is older than {known[-1]}")
        new = values.select(F.col(column).cast("string").alias("text")).filter("text is not null").distinct()
        above = 0
        for r in known:
            t = self._table(r)
            new = new.join(t.select("text").hint("merge"), "text", "left_anti")
            above = max(above, t.agg(F.max("id")).first()[0] or 0)
        numbered = number_rows(new, ["text"], "id", above + 1)
        buckets = self._bucket_number(known[0]) if known else max(self.buckets, -(-numbered.count() // BUCKET_ROWS))
        name, folder = f"{self._name}_{release}", f"{self._folder(release)}/data-b{buckets}"
        out = numbered.select("id", "text").repartition(buckets, "text").write.mode("overwrite").format("parquet")
        out.bucketBy(buckets, "text").sortBy("text").option("path", folder).saveAsTable(name)
        return self._table(release)

    def encode(self, rows: DataFrame, column: str, name: str = "id", release: int | None = None) -> DataFrame:
        """rows with the id of a string as a last column, null where the dictionary lacks it.

        Each string is looked up once, by bucket; a string that very many rows have is no skew.
        """
        found = rows.select(F.col(column).alias("_text")).filter("_text is not null").distinct()
        ids = []
        for r in [r for r in self.releases() if release is None or r <= release]:
            own = self._table(r).select(F.col("id").alias(f"_id{r}"), F.col("text").alias("_text"))
            found = found.join(own.hint("merge"), "_text", "left")
            ids.append(F.col(f"_id{r}"))
        found = cut(found.select("_text", (F.coalesce(*ids) if ids else F.lit(None).cast("long")).alias(name)).filter(F.col(name).isNotNull()))
        return join_checked(rows, found, rows[column] == found["_text"], "left").drop("_text")
