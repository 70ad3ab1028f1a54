"""Load options: call arguments first, then the session configuration."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

# Option names as users of such loaders write them.
OPTION_NAMES = {
    "offset_column": "offsetColumn",
    "initial_offset": "initialOffset",
    "end_offset": "endOffset",
    "num_ranges": "loadNumPartitions",
    "include_deleted": "isQueryAll",
    "reader": "queryExecutorClassName",
    "max_records": "streamingMaxRecordsInPartition",
    "max_batches": "streamingMaxBatches",
    "poll_interval_ms": "streamingAdditionalWaitWhenIncrementalLoading",
    "load_available": "streamingLoadAvailableData",
    "query_name": "streamingQueryName",
}

CONF_PREFIX = "spark.rangeload."


@dataclass(frozen=True)
class LoadOptions:
    """Checked options of one load.

    ``max_records`` is the row cap of a range per step (a reader's rows that share an
    offset are taken at once) and sizes the ranges planned for new rows; ``max_batches`` caps the files of a native stream's
    micro-batch.
    """

    offset_column: str
    initial_offset: str | None = None
    end_offset: str | None = None
    num_ranges: int = 1
    include_deleted: bool = True
    reader: str | None = None
    max_records: int = 10_000
    max_batches: int = 1_000
    poll_interval_ms: int = 60_000
    load_available: bool = False
    query_name: str | None = None

    def __post_init__(self):
        for name in ("num_ranges", "max_records", "max_batches"):
            if getattr(self, name) < 1:
                raise ValueError(f"{OPTION_NAMES[name]}={getattr(self, name)}: less than 1")
        if self.poll_interval_ms < 0:
            raise ValueError(f"{OPTION_NAMES['poll_interval_ms']}={self.poll_interval_ms}: less than 0")

    @classmethod
    def from_conf(cls, spark: SparkSession, **given) -> LoadOptions:
        """Each option comes from the call, else the conf ``name``, else
        ``spark.rangeload.name``; names are compared without case."""
        known = {option.lower(): field for field, option in OPTION_NAMES.items()}
        known.update({field.lower(): field for field in OPTION_NAMES})
        values = {}
        for name, value in given.items():
            field = known.get(name.lower())
            if field is None:
                raise ValueError(f"Unknown option '{name}'; known: {sorted(OPTION_NAMES.values())}")
            values[field] = value
        conf = {name.lower(): value for name, value in spark.sparkContext.getConf().getAll()}
        conf |= {name.lower(): value for name, value in spark.conf.getAll.items()}
        for field, option in OPTION_NAMES.items():
            if field in values:
                continue
            for name in (option, CONF_PREFIX + option):
                value = conf.get(name.lower())
                if value is not None:
                    values[field] = value
                    break
        if "offset_column" not in values:
            raise ValueError("A load needs offsetColumn")
        types = {field.name: field.type for field in fields(cls)}
        return cls(**{name: _checked(name, types[name], value) for name, value in values.items()})


def _checked(field: str, kind: str, value):
    if kind == "int":
        try:
            return int(str(value))
        except ValueError:
            raise ValueError(f"{OPTION_NAMES[field]}={value}: no whole number") from None
    if kind == "bool":
        text = str(value).lower()
        if text not in ("true", "false"):
            raise ValueError(f"{OPTION_NAMES[field]}={value}: neither true nor false")
        return text == "true"
    return value
