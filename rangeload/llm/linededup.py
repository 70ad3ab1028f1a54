"""Removal of lines that many documents share, with levelled sorted runs of line hashes.

The index is a set of runs: tables of line hashes, bucketed and sorted by hash, so that
joining a run needs no shuffle of it. A batch of documents is summarised once, anti-joined
with the runs by merging, and what no run has becomes a run of its own; what some run
has is kept apart as sightings. When a level holds ``fanout`` runs they are compacted
into one of the next level, so a batch meets few runs however many went before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeload.llm.common import settle, unpacked, whole, written

HASH = ["h1", "h2"]
_SPACE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends and with A-Z in small letters."""
    bare = F.btrim(line, F.lit(_SPACE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _hashed(key: Column) -> list[Column]:
    """A 128-bit hash as two longs with different starts."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


class LineRuns:
    """Levelled runs of (hash, documents, last document)."""

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None):
        """``buckets`` is the number of files of a run, and of tasks that merge one."""
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.count = 0
        self.levels: list[list[str]] = [[]]
        self.sightings: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        table = f"{self.name}_{self.count}"
        self.count += 1
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(table)
        return table

    def _drop(self, tables: Iterable[str]) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE {table}")

    def add(self, batch: DataFrame) -> None:
        """Merge a batch of one row per hash (``h1, h2, docs, last``) into the index."""
        batch = batch.repartition(self.buckets, *HASH)  # a file for each bucket, not one for each task and bucket
        if not any(self.levels):
            self.levels[0].append(self._write(batch))
            return
        met = self._write(batch)
        fresh = self.spark.table(met)
        for run in [run for level in self.levels for run in level]:
            fresh = fresh.join(self.spark.table(run).select(*HASH), HASH, "left_anti")
        own = self._write(fresh)
        self.sightings.append(self._write(self.spark.table(met).join(self.spark.table(own).select(*HASH), HASH, "left_anti")))
        self._drop([met])
        self.levels[0].append(own)
        self._compact()

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= self.fanout:
            runs = self.levels[level]
            merged = self._write(self._union(runs))  # runs share no hash
            self._drop(runs)
            self.levels[level] = []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(merged)
            level += 1
        if len(self.sightings) >= self.fanout:
            summed = self._write(self._seen())
            self._drop(self.sightings)
            self.sightings = [summed]

    def _union(self, tables: list[str]) -> DataFrame:
        rows = self.spark.table(tables[0])
        for table in tables[1:]:
            rows = rows.unionByName(self.spark.table(table))
        return rows

    def _seen(self) -> DataFrame:
        return self._union(self.sightings).groupBy(*HASH).agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))

    def frequent(self, least: int) -> DataFrame:
        """Hashes found in ``least`` documents or more, with the largest document, settled."""
        found = []
        seen = self._seen().select(*HASH, F.col("docs").alias("more"), F.col("last").alias("later")) if self.sightings else None
        for run in [run for level in self.levels for run in level]:
            rows = self.spark.table(run)
            if seen is not None:
                rows = rows.join(seen, HASH, "left").select(
                    *HASH, (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"), F.greatest("last", "later").alias("last")
                )
            found.append(rows.where(F.col("docs") >= least))
        rows = found[0]
        for more in found[1:]:
            rows = rows.unionByName(more)
        return settle(rows.select(*HASH, "last"))

    def clear(self) -> None:
        """Drop the tables of the index."""
        self._drop([run for level in self.levels for run in level] + self.sightings)
        self.levels, self.sightings = [[]], []


def long_lines(df: DataFrame, key: str, text: str, min_length: int) -> DataFrame:
    """A row (``doc, h1, h2``) for each long line key of each document; rows with one key are one document."""
    lines = F.array_distinct(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), line_key))
    keys = df.select(F.col(key).cast("long").alias("doc"), F.explode(lines).alias("line")).where(F.length("line") >= min_length)
    return keys.select("doc", *_hashed(F.col("line"))).distinct()


def summed(lines: DataFrame, *more: str) -> DataFrame:
    """One row per hash (and ``more``): in how many documents, and the largest of them."""
    return lines.groupBy(*more, *HASH).agg(F.count("*").alias("docs"), F.max("doc").alias("last"))


def line_batches(df: DataFrame, key: str, text: str, min_length: int, batches: int) -> list[DataFrame]:
    """Summaries of the documents of ``df`` in so many batches, by a hash of their key, from one pass over the texts.

    However the table is stored, the batches are about equal, and all rows with one key are in one of them.
    """
    lines = long_lines(df, key, text, min_length).withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches)))
    table = written(summed(lines, "batch"), "line-batches")
    return [table.where(F.col("batch") == i).select(*HASH, "docs", "last") for i in range(batches)]


def file_batches(df: DataFrame, batches: int) -> list[DataFrame]:
    """``df``, a scan of files, cut by files into at most ``batches`` parts; anything else as one part.

    The last part takes every row that no other does.
    """
    try:
        files = sorted(row[0] for row in df.select("_metadata.file_path").distinct().collect())
    except AnalysisException:
        return [df]
    groups = [files[i::batches] for i in range(min(batches, len(files)))]
    path = F.col("_metadata.file_path")
    parts = [df.where(path.isin(group)) for group in groups[:-1]]
    return [*parts, df.where(~path.isin([file for group in groups[:-1] for file in group])) if parts else df]


def drop_shared_lines(
    df: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = 40,
    min_docs: int = 5,
    batches: list[DataFrame] | int = 5,
    fanout: int = 4,
    bucket_hashes: int = 2_000_000,
) -> DataFrame:
    """``df`` with ``text`` lacking shared lines, and ``n_lines`` and ``n_dropped``.

    Texts are split at line feeds. A line whose key (see ``line_key``) has
    ``min_length`` characters or more and occurs in ``min_docs`` documents or more is dropped
    everywhere but in the document with the largest ``key`` that has it; what is left is
    joined by line feeds again. ``batches`` is how ``df`` comes in: parts that make it
    up, no key in two of them, or a number of parts to deal its documents to. Runs have buckets of about
    ``bucket_hashes`` at most. ``key`` is an integer.

    Texts are read once to fill the index and once to drop lines; only hashes, keys and
    positions of long lines are shuffled for the decision, and texts once to be
    rewritten. A null text counts as one empty line and becomes empty. Rows with one
    key, such as repeated rows, are one document; all of those with the
    largest key keep the line, and each loses lines of its own text only: rows are told
    apart by key and a hash of the text. Rows without a key are one document too, whose key is
    smaller than any other. An empty table gives an empty result;
    input columns named ``n_lines`` or ``n_dropped`` are replaced.
    """
    if isinstance(batches, int):
        summaries = line_batches(df, key, text, min_length, batches)
    else:
        summaries = [written(summed(long_lines(batch, key, text, min_length)), "line-batch") for batch in batches]
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = LineRuns(df.sparkSession, fanout, max(least, sum(s.count() for s in summaries) // bucket_hashes))
    try:
        for summary in summaries:
            runs.add(summary)
        shared = runs.frequent(min_docs)
    finally:
        runs.clear()
    columns = df.columns
    filled = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    row = [F.col(key).cast("long").alias("doc"), *[h.alias(name) for h, name in zip(_hashed(filled), ("t1", "t2"), strict=True)]]
    lines = df.select(*row, F.posexplode(F.split(filled, "\n")).alias("at", "line")).withColumn("line", line_key(F.col("line")))
    lines = lines.where(F.length("line") >= min_length).select("doc", "t1", "t2", "at", *_hashed(F.col("line")))
    lost = lines.join(shared, HASH).where(~F.col("doc").eqNullSafe(F.col("last")))
    lost = lost.groupBy(F.col("doc").alias("of"), F.col("t1").alias("o1"), F.col("t2").alias("o2")).agg(F.collect_set("at").alias("lost"))
    packed = df.select(whole(df).alias("row"), *row)
    same = F.col("doc").eqNullSafe(F.col("of")) & (F.col("t1") == F.col("o1")) & (F.col("t2") == F.col("o2"))
    joined = packed.join(lost, same, "left")
    split = F.split(F.coalesce(F.col(f"row.`{text}`"), F.lit("")), "\n")

    def without_lost(parts: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "lost")
        return F.array_join(F.transform(left, lambda at: parts[at]), "\n")

    kept = F.transform(F.array(split), without_lost)[0]  # an array of one, so that the text is split once
    result = joined.select(
        "row",
        F.when(F.col("lost").isNull(), F.coalesce(F.col(f"row.`{text}`"), F.lit(""))).otherwise(kept).alias(text),
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    return unpacked(result, "row", columns, text, "n_lines", "n_dropped")
