"""Helpers that several corpus operators share."""

from __future__ import annotations

import contextlib
import string
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeload.session import scratch_dir


def settle(df: DataFrame) -> DataFrame:
    """``df`` cut off from its lineage by a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or scratch_dir(spark, "checkpoint"))
    return df.checkpoint()


@contextlib.contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends, not when the driver next collects its garbage.

    For steps that settle what they go on with. A frame that is made inside and runs a second time shuffles again,
    so what is returned lazily is made outside.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared folder, read again."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % divisor


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the application, once, for those that cannot import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"  # the driver serves it from here
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in small letters and everything else as it is."""
    by_letter = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(by_letter)


def whole(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, out of the way of added names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(df: DataFrame, packed: str, columns: list[str], *added: str) -> DataFrame:
    """The columns packed by ``whole``, then ``added``; an added name replaces a packed one."""
    kept = [F.col(f"{packed}.`{c}`").alias(c) for c in columns if c not in added]
    return df.select(*kept, *added)
