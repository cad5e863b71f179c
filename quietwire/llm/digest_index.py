"""Exact deduplication against a persistent index of digests.

The index is a Parquet table of one row per different text (SHA-256 of its UTF-8, the id that stays, the
load that brought it), bucketed and sorted by the digest. A load groups its rows by digest, drops by a
sort-merge anti-join what the index holds, and appends the rest bucket by bucket: the index itself is never
shuffled and never rewritten. Of equal texts within one load the row with the largest id stays; a text that an
earlier load brought stays there. Fed with the largest ids first, the largest of all ids stays.

Texts are equal when identical byte by byte; a null text counts as empty. Null ids come before all others, so
such a row stays only where no other has its text. Rows equal in id and text are one document more than
once: one of them stays. An empty table gives no rows and adds nothing. Columns besides ``doc_id`` and
``text`` are handed on as they are, whatever their names.

A load that failed may be run again under its name: what it had appended counts as its own.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quietwire.llm.common import prepare
from quietwire.operators.skew import hot_keys, salted_join
from quietwire.session import stage


def digest(text: Column) -> Column:
    """SHA-256 of the text's UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row, written once: the only pass over the texts."""
    return stage(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest(F.col("text")).alias("digest")), "digests")


class DigestIndex:
    """The index at ``path``, a folder that all executors share; made there if there is none.

    ``buckets`` only counts when the index is made; it is kept beside the entries.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        self.spark = prepare(spark)
        self.path = path.rstrip("/")
        self.buckets = self._layout(buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
        self.table = "digest_index_" + hashlib.md5(self.path.encode()).hexdigest()
        place = f"{self.path}/entries".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT, load STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        spark.catalog.refreshTable(self.table)

    def _layout(self, buckets: int) -> int:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/layout")
        if not place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            self.spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{self.path}/layout")
            return buckets
        return self.spark.read.parquet(f"{self.path}/layout").first()["buckets"]

    def entries(self) -> DataFrame:
        """(digest, keep_id, load), one row per different text."""
        return self.spark.table(self.table)

    def _groups(self, rows: DataFrame) -> DataFrame:
        """(digest, largest id, rows), laid out like the index. Written first: a join would else be moved below
        the grouping and meet all rows of a digest."""
        groups = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("rows"))
        return stage(groups, "digest-groups").repartition(self.buckets, "digest")

    def load(self, rows: DataFrame, name: str) -> None:
        """Appends the texts of ``rows`` (doc_id, digest) that the index does not hold yet."""
        fresh = self._groups(rows).join(self.entries().hint("merge"), "digest", "left_anti")
        fresh.select("digest", "keep_id", F.lit(name).alias("load")).write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def decide(self, rows: DataFrame, load: str | None = None) -> DataFrame:
        """(doc_id, digest, keep_id, group_size, kept), one row per row of ``rows`` (doc_id, digest), all loaded.

        ``group_size`` counts rows of ``rows``. Given a ``load``, what an earlier load brought is not kept.
        """
        groups = self._groups(rows).join(self.entries().hint("merge").withColumnRenamed("keep_id", "first_id"), "digest")
        own = F.lit(True) if load is None else F.col("load") == load
        # Most texts are alone and need no lookup.
        shared = groups.where((F.col("rows") > 1) | ~own | ~F.col("first_id").eqNullSafe(F.col("keep_id")))
        shared = stage(shared.select("digest", "first_id", "rows", own.alias("own")), "shared-digests")
        same = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("same"))
        hot = hot_keys(shared, ["digest"], "rows")
        met = salted_join(same, shared, ["digest"], hot, F.col("doc_id"), "left")
        alone = F.col("rows").isNull()
        keep = F.when(alone, F.col("doc_id")).otherwise(F.col("first_id"))
        stays = F.coalesce("own", F.lit(True)) & F.col("doc_id").eqNullSafe(keep)
        return met.select(
            "doc_id",
            "digest",
            keep.alias("keep_id"),
            F.coalesce("rows", "same").alias("group_size"),
            F.explode(F.transform(F.sequence(F.lit(1), F.col("same").cast("int")), lambda i: stays & (i == 1))).alias("kept"),
        )

    def dedup(self, docs: DataFrame, load: str) -> DataFrame:
        """The rows of ``docs`` that stay, with all their columns, as one load."""
        rows = digests(docs)
        self.load(rows, load)
        stay = self.decide(rows, load).where("kept").select(F.col("doc_id").alias("_1"), F.col("digest").alias("_2"))
        names = docs.columns
        # Columns go by number meanwhile, so that no name of the table can clash.
        inner = docs.toDF(*(f"c{i}" for i in range(len(names))))
        id_at, text_at = (f"c{names.index(c)}" for c in ("doc_id", "text"))
        inner = inner.withColumn("_digest", digest(F.col(text_at)))
        same = F.col(id_at).cast("bigint").eqNullSafe(F.col("_1")) & (F.col("_digest") == F.col("_2"))
        met = inner.join(stay.hint("shuffle_hash"), same, "left_semi")
        again = rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        again = stage(again.select(F.col("doc_id").alias("_1"), F.col("digest").alias("_2")), "repeated-rows")
        if not again.isEmpty():
            often = met.join(again.hint("shuffle_hash"), same, "left_semi").dropDuplicates([id_at, "_digest"])
            met = met.join(again.hint("shuffle_hash"), same, "left_anti").unionByName(often)
        return met.drop("_digest").toDF(*names)

    def compacted(self, path: str) -> DigestIndex:
        """A copy at ``path`` with one sorted file per bucket; for after many small loads."""
        copy = DigestIndex(self.spark, path, self.buckets)
        self.entries().repartition(self.buckets, "digest").write.insertInto(copy.table)
        self.spark.catalog.refreshTable(copy.table)
        return copy


def largest_first(rows: DataFrame, loads: int) -> list[DataFrame]:
    """``rows`` split by ranges of doc_id into so many loads, the largest ids first, null ids last."""
    least, most = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    if least is None:
        return [rows]
    bounds = sorted({least + (most - least + 1) * k // loads for k in range(1, loads)}, reverse=True)
    parts, above = [], F.lit(True)
    for bound in bounds:
        here = F.col("doc_id") >= bound
        parts.append(rows.where(above & here))
        above = ~here
    return [*parts, rows.where(F.col("doc_id").isNull() | above)]
