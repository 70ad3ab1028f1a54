"""Incremental load of a table by offset ranges.

A load is a row of steps. Each step takes, from every open range, the rows up to
a cut that holds about ``max_records`` of them, writes these as one Spark job and
then saves where each range stands. Ranges that end are replaced by splitting
those that have not. When all are done the table can be polled for rows past the
largest offset seen.

The cuts come from a histogram made once when ranges are planned, and the files a
step has to open from the offsets each file was found to hold; files in which the offsets
are scattered are copied in their order first. So steps read little more than the rows they load. Only ranges, cuts, counts and names of files
reach the driver; cuts that were passed are forgotten.

Rows whose offset is null or NaN belong to no range. A load works on the files
that were there when its ranges were planned or it was started again: a row that
turns up later at or below the largest offset seen is not loaded.
"""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import asdict, replace
from time import sleep, time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeload.operators.filters import all_of, as_column
from rangeload.operators.ranges import RangeScan
from rangeload.operators.scan import check_columns
from rangeload.operators.stats import OffsetStats, offset_stats
from rangeload.options import LoadOptions
from rangeload.plans.bounds import (
    MOST_CONDITIONS,
    OffsetRange,
    hull,
    planned_ranges,
    predicate_over,
    recreate_ranges,
    split_range,
    with_index,
)
from rangeload.plans.files import FileOffsets
from rangeload.plans.histogram import Chunk, next_cut, plan_chunks, refine_chunks, still_open, tied_chunks, with_finer
from rangeload.plans.offsets import OffsetType
from rangeload.streaming.state import ConcurrentLoad, StateFiles

Reader = Callable[[SparkSession, Column | None], DataFrame]

# States of a load.
PROCESSING, WAITING, FINISHED, FAILED = "PROCESSING_DATA", "WAITING_DATA", "FINISHED", "FAILED"

# Fixed value: so many state documents are folded into one of what their steps did.
FOLDED = 100

# Fixed value: the column that tells the folders of steps apart.
STEP = "load_step"


def load_reader(name: str) -> Reader:
    """The function or class of the dotted ``name``."""
    module, _, attribute = name.rpartition(".")
    try:
        found = getattr(importlib.import_module(module), attribute)
    except (ImportError, AttributeError, ValueError):
        raise ValueError(f"Cannot load the reader '{name}'") from None
    if isinstance(found, type):
        found = found()
    if not callable(found):
        raise ValueError(f"The reader '{name}' cannot be called")
    return found


class IncrementalLoader:
    """Loads ``source`` into ``root`` step by step and picks up where it stopped.

    ``source`` is a DataFrame, a table name or Parquet path with a ``/`` (looked
    up again at every poll, so new files are seen), or ``reader(spark, range_predicate)``,
    which returns the rows of the table that meet the predicate (all of them for
    None) and may narrow the read in its own way. With None the reader is the one
    that ``options.reader`` names.

    ``where`` and ``columns`` narrow the load, and ``deleted`` is the condition that
    marks deleted rows, for ``options.include_deleted=False``. The offset column is always
    written, and hidden from :meth:`output` unless selected.

    Every row is loaded once: the next step continues behind a cut, and a step that failed is
    repeated as planned into the same folder. Of rows that share an offset and are more than the
    cap, a step takes some by their place (file and row number), if the source is a scan of Parquet files; a reader's
    rows are taken all at once. Files that most steps would have to open
    are first copied in offset order into the root, and the copy goes when it is loaded. A root belongs to one load: offset column, columns, filter
    and reader have to be the same when it is continued. One loader works on it at a
    time: a second one that steps or polls takes over, if it knows the latest state,
    and the first is refused from then on.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: DataFrame | str | Reader | None,
        root: str,
        options: LoadOptions,
        where: Column | str | None = None,
        columns: Sequence[str] | None = None,
        deleted: Column | str | None = None,
    ):
        if not options.include_deleted and deleted is None:
            raise ValueError("include_deleted=False needs the condition that marks deleted rows")
        self.spark = spark
        self.root = root.rstrip("/")
        self.options = options
        self.offset = options.offset_column
        self._source = load_reader(options.reader) if source is None and options.reader else source
        self._where = all_of([where, None if options.include_deleted else ~as_column(deleted)])
        self._documents = StateFiles(spark, self.root)
        self._files: FileOffsets | None = None
        self._looked_at_files = False
        self._known: dict[str, int] = {}
        self._scattered = False
        self._staged: tuple[str, FileOffsets] | None = None
        self._owner: int | None = None
        self._failed = False
        self._refresh()
        self.kind = OffsetType.of(self._table, self.offset)
        if columns is not None:
            check_columns(self._table, columns)
        self.columns = list(columns) if columns is not None else self._table.columns
        if STEP in {name.lower() for name in [*self.columns, self.offset]}:
            raise ValueError(f"A column cannot be named '{STEP}', which tells the steps of a load apart; rename it")
        self._check_definition()
        self._chunks: list[Chunk] | None = None
        self._state = self._restore() or self._begin()

    # -- what is loaded, and by whom ---------------------------------------

    def _check_definition(self) -> None:
        """Refuse to go on with a load that was begun as another."""
        definition = {
            "offset": self.offset.lower(),
            "type": self.kind.data_type.simpleString(),
            "columns": [name.lower() for name in self.columns],
            "where": str(self._where),
            "reader": self.options.reader,
        }
        begun = self._documents.read("load", 0)
        if begun is None:
            self._documents.write("load", 0, definition)
            return
        differing = [f"{name} {begun[name]} is now {value}" for name, value in definition.items() if begun[name] != value]
        if differing:
            raise ValueError(f"{self.root} holds another load: {'; '.join(differing)}")

    def _claim(self) -> None:
        """Become or stay the loader of this root."""
        documents, version = self._documents, self._state["version"]
        if documents.numbers("state")[-1] > version:
            raise ConcurrentLoad(f"another loader has gone on with {self.root}")
        if self._owner is None:
            owners = documents.numbers("owner")
            self._owner = owners[-1] + 1 if owners else 0
            documents.write("owner", self._owner, {"from_version": version})
        elif documents.exists(documents.path("owner", self._owner + 1)):
            raise ConcurrentLoad(f"another loader has taken over {self.root}")

    # -- source ------------------------------------------------------------

    def _refresh(self) -> None:
        if callable(self._source):
            self._table = self._source(self.spark, None)
        elif isinstance(self._source, DataFrame):
            self._table = self._source
        elif "/" in self._source:
            self._table = self.spark.read.parquet(self._source)
        else:
            self.spark.catalog.refreshTable(self._source)
            self._table = self.spark.table(self._source)

    def _rows(self, spans: list[OffsetRange]) -> DataFrame:
        """Rows of the load inside ``spans``."""
        predicate = F.expr(predicate_over(self.offset, spans, self.kind))
        if self._state["staged"] is not None:
            copy, files = self._staged_copy()
            return files.narrow(copy, spans).where(predicate)
        if callable(self._source):
            rows = self._source(self.spark, predicate)
        else:
            if not self._looked_at_files:
                # Started again: look only where ranges are open.
                left = hull(self._state["ranges"]).predicate(self.offset, self.kind)
                self._look_at_files(self._table.where(left))
            rows = self._table
            if self._files:
                self._scattered = len(self._files.overlapping(spans)) > 2 * len(spans)
                rows = self._files.narrow(rows, spans)
        return rows.where(all_of([predicate, self._where]))

    def _look_at_files(self, rows: DataFrame) -> OffsetStats:
        """One pass over the offsets of ``rows``, kept per file if there are files."""
        self._files, self._looked_at_files = None, True
        if not callable(self._source):
            path = f"{self.root}/files/{uuid.uuid4().hex}"
            self._files = FileOffsets.collect(rows, self.offset, path, self._where, self._known)
        return self._files.stats() if self._files else offset_stats(rows, self.offset, self._where)

    # -- a copy in offset order ------------------------------------------------

    def _staged_copy(self) -> tuple[DataFrame, FileOffsets]:
        """The staged copy, and the offsets of its files."""
        path = self._state["staged"]
        if self._staged is None or self._staged[0] != path:
            self._staged = (path, FileOffsets.written(self.spark, f"{path}/offsets", self.kind))
        rows = self.spark.read.schema(T.StructType(self._fields())).parquet(f"{path}/rows")
        return rows, self._staged[1]

    def _stage(self) -> str:
        """Write the rows of the open ranges anew in offset order; where they are.

        One shuffle by edges from a histogram. Each file then holds a narrow slice of the offsets, so
        all steps together open it about once.
        """
        state, path = self._state, f"{self.root}/staged/{self._state['version']:06d}-{self._owner:06d}"
        hidden = [] if self._selects_offset() else [self.offset]
        rows = self._rows(state["ranges"]).select(*self.columns, *hidden)
        whole = RangeScan(rows, self.offset, [hull(state["ranges"])])
        whole.ordered(range_id="__staged").drop("__staged").write.mode("overwrite").parquet(f"{path}/rows")
        FileOffsets.collect(self.spark.read.parquet(f"{path}/rows"), self.offset, f"{path}/offsets")
        return path

    def _opened_often(self) -> bool:
        """Whether the steps planned would open the files more than three times as often as if they were in order."""
        if not self._files or not self._chunks:
            return False
        opened, files = 0, self._files.count()
        by_range = [[c for c in self._chunks if r.lower <= c.cut <= r.upper] for r in self._state["ranges"]]
        for step in range(max(map(len, by_range))):
            due = [chunks[step] for chunks in by_range if step < len(chunks)]
            opened += min(files, sum(self._files.many_overlapping(c.first, c.cut) for c in due))
        return opened > 3 * files and opened > 3 * (files + len(self._chunks))

    # -- state ---------------------------------------------------------------

    def _begin(self) -> dict:
        given = [self.options.initial_offset, self.options.end_offset]
        low, high = (None if value is None else self.kind.parse(value) for value in given)
        table, column = self._table, F.col(self.offset)
        if low is not None:
            table = table.where(column >= self.kind.literal(low))
        if high is not None:
            table = table.where(column <= self.kind.literal(high))
        stats = self._look_at_files(table)
        if self._files and high is None:
            self._known = self._files.names()
        low = stats.first if low is None else low
        high = stats.last if high is None else high
        ranges = []
        if low is not None and high is not None:
            ranges = split_range(low, high, self.options.num_ranges, self.kind)
        state = {
            "version": -1,
            "step": 0,
            "ranges": ranges,
            "max_offset": high,
            "rows": 0,
            "planned_rows": stats.rows,
            "cuts": None,
            "finer": None,
            "staged": None,
            "owners": [],
            "without_offset": stats.without_offset,
            "initial_offset": self.kind.to_text(low),
            "left": stats.rows,
            "done": [],
            "begun_ms": int(time() * 1000),
            "started_ms": int(time() * 1000),
            "took_ms": 0,
        }
        return self._save(state)

    def _save(self, state: dict) -> dict:
        """Each save is a new document; none is ever replaced. After ``FOLDED`` of them, what the older ones
        tell of their steps is kept in one document, so few are listed at a restart, however many steps there were."""
        text = self.kind.to_text
        state = {**state, "version": state["version"] + 1}
        self._documents.write(
            "state",
            state["version"],
            {
                **state,
                "ranges": [{**asdict(r), "lower": text(r.lower), "upper": text(r.upper)} for r in state["ranges"]],
                "max_offset": text(state["max_offset"]),
                "owner": self._owner,
                "status": self._status(state),
            },
        )
        if (state["version"] + 1) % FOLDED == 0:
            self._fold(state["version"])
        return state

    def _fold(self, version: int) -> None:
        older = [n for n in self._documents.numbers("state") if n < version]
        steps = [self._documents.read("state", n) for n in older]
        told = [{name: s[name] for name in ("step", "rows", "done", "started_ms", "took_ms")} for s in steps if s["done"]]
        self._documents.write("history", version, {"steps": told}, replace=True)
        for n in older:
            self._documents.remove(self._documents.path("state", n))

    def _restore(self) -> dict | None:
        numbers = self._documents.numbers("state")
        if not numbers:
            return None
        state = self._documents.read("state", numbers[-1])
        state["ranges"] = [self._range(r) for r in state["ranges"]]
        state = {"staged": None, "owners": []} | state
        if state["max_offset"] is not None:
            state["max_offset"] = self.kind.parse(state["max_offset"])
        return state

    def _range(self, saved: dict) -> OffsetRange:
        ends = {name: self.kind.parse(saved[name]) for name in ("lower", "upper")}
        places = {name: tuple(saved[name]) for name in ("after", "until") if saved.get(name)}
        return OffsetRange(**{**saved, **ends, **places})

    def _status(self, state: dict) -> str:
        if state["ranges"]:
            return PROCESSING
        return FINISHED if self.options.load_available else WAITING

    # -- cuts ----------------------------------------------------------------

    def _planned_chunks(self) -> list[Chunk]:
        """Cuts for the open ranges, made once and kept in a file of their own."""
        state, cap = self._state, self.options.max_records
        if self._chunks is None and state["cuts"] is not None:
            self._chunks = with_finer(self._saved("cuts", state["cuts"]), self._saved("finer", state.get("finer")))
        if self._chunks is None:
            self._chunks = []
            if state["planned_rows"] > cap:
                self._chunks = plan_chunks(self._offsets, self.kind, state["ranges"], cap, state["planned_rows"])
                if self._opened_often():
                    state["staged"] = self._stage()
            state["cuts"], state["finer"] = self._keep("cuts", self._chunks), None
        self._chunks = still_open(self._chunks, state["ranges"])
        self._chunks, refined = refine_chunks(self._offsets, self.kind, self._chunks, state["ranges"], cap, self._ties)
        if refined:  # only what was cut since the planning is written again
            state["finer"] = self._keep("finer", [c for c in self._chunks if c.finer])
        return self._chunks

    def _saved(self, kind: str, number: int | None) -> list[Chunk]:
        saved = [] if number is None else self._documents.read(kind, number)["chunks"]
        parse = self.kind.parse
        ends = [{"first": parse(c["first"]), "cut": parse(c["cut"]), "place": tuple(c["place"]) if c.get("place") else None} for c in saved]
        return [Chunk(**{**c, **e}) for c, e in zip(saved, ends, strict=True)]

    def _keep(self, kind: str, chunks: list[Chunk]) -> int:
        # loaders that plan the same step at once keep cuts of their own; whose plan is written first decides
        text, number = self.kind.to_text, (self._state["step"] + 1) * 1_000_000 + self._owner
        kept = [{**asdict(c), "first": text(c.first), "cut": text(c.cut)} for c in chunks]
        self._documents.write(kind, number, {"chunks": kept}, replace=True)
        return number

    def _offsets(self, spans: list[OffsetRange]) -> DataFrame:
        return self._rows(spans).select(F.col(self.offset).alias("offset"))

    def _ties(self, span: OffsetRange, cap: int) -> list[Chunk] | None:
        """Chunks of rows that share an offset; a reader's rows have no place that a later read could go by."""
        if callable(self._source) and self._state["staged"] is None:
            return None
        return tied_chunks(self._rows([span]), span.lower, cap)

    def _next_pieces(self, number: int) -> list[OffsetRange]:
        """What the step loads of each range. Saved before any data is written,
        so a step that is run again loads exactly the same rows."""
        plan = self._documents.read("plan", number)
        if plan is not None:
            self._state |= {name: plan.get(name) for name in ("cuts", "finer", "staged")}
            return [self._range(r) for r in plan["pieces"]]
        chunks = self._planned_chunks()
        pieces = []
        for span in self._state["ranges"]:
            cut = next_cut(chunks, span)
            pieces.append(replace(span, done=True) if cut is None else replace(span, upper=cut[0], hi_op="<=", until=cut[1]))
        text = self.kind.to_text
        saved = [{**asdict(p), "lower": text(p.lower), "upper": text(p.upper)} for p in pieces]
        kept = {name: self._state.get(name) for name in ("cuts", "finer", "staged")}
        self._documents.write("plan", number, {"pieces": saved, **kept})
        return pieces

    # -- running -------------------------------------------------------------

    def step(self) -> int | None:
        """Load the next piece of every open range.

        Returns the number of rows, or None when no range is open.
        """
        if not self._state["ranges"]:
            return None
        with self._working():
            return self._step()

    @contextmanager
    def _working(self):
        """The load counts as failed until what begins here has ended well."""
        self._failed = True
        self._claim()
        yield
        self._failed = False

    def _step(self) -> int:
        state = self._state
        number, start = state["step"] + 1, time()
        pieces = self._next_pieces(number)
        path = self._data_path(number)
        hidden = [] if self._selects_offset() else [self.offset]
        rows = self._rows(pieces).select(*self.columns, *hidden)
        if self._scattered:  # a few rows from each of many files would be as many files again
            rows = rows.hint("rebalance")
        counted = self._write(rows, path, pieces)

        ranges, done = [], []
        for span, piece in zip(state["ranges"], pieces, strict=True):
            loaded, last = counted.get(piece.id, (0, None))
            left = replace(span, done=True) if piece.done else span.moved_to(piece.upper, after=piece.until)
            ranges.append(left)
            done.append(
                {
                    "range_id": span.id,
                    "lower": self.kind.to_text(span.lower),
                    "lo_op": span.lo_op,
                    "upper": self.kind.to_text(span.upper),
                    "hi_op": span.hi_op,
                    "cursor": self.kind.to_text(last),
                    "rows": loaded,
                    "done": piece.done,
                    "over_cap": loaded > self.options.max_records,
                }
            )
        loaded = sum(d["rows"] for d in done)
        owners = state["owners"]
        if not owners or owners[-1][1] != self._owner:
            owners = [*owners, [number, self._owner]]
        saved = {
            **state,
            "step": number,
            "owners": owners,
            "ranges": recreate_ranges(ranges, self.options.num_ranges, self.kind),
            "rows": state["rows"] + loaded,
            "left": state.get("left", loaded) - loaded,
            "done": done,
            "started_ms": int(start * 1000),
            "took_ms": int((time() - start) * 1000),
        }
        if not saved["ranges"]:
            saved["staged"] = None
        self._state = self._save(saved)
        if state["staged"] and not saved["staged"]:
            self._documents.remove(state["staged"])
        return loaded

    def _write(self, rows: DataFrame, path: str, pieces: list[OffsetRange]) -> dict[int, tuple]:
        """Write a step; rows and last offset per range.

        They are observed while the rows are written. Many ranges would be many expressions a row, so
        for these the offsets written are counted.
        """
        observed = None
        if len(pieces) <= MOST_CONDITIONS:
            metrics = []
            for i, piece in enumerate(pieces):
                inside = F.expr(replace(piece, after=None, until=None).predicate(self.offset, self.kind))
                last = F.max(F.when(inside, self.kind.collectable(self.offset)))
                metrics += [F.count_if(inside).alias(f"rows_{i}"), last.alias(f"last_{i}")]
            observed = Observation()
            rows = rows.observe(observed, *metrics)
        rows.write.mode("overwrite").parquet(path)
        return self._count(path, pieces, observed)

    def _count(self, path: str, pieces: list[OffsetRange], observed: Observation | None) -> dict[int, tuple]:
        """Rows and last offset per range, as observed, or else from the files the step wrote."""
        if observed is not None:
            found = observed.get
            return {p.id: (found[f"rows_{i}"], self.kind.collected(found[f"last_{i}"])) for i, p in enumerate(pieces)}
        written = self.spark.read.schema(T.StructType([T.StructField(self.offset, self.kind.data_type)])).parquet(path)
        counted = (
            with_index(written, "__piece", self.offset, [p.lower for p in pieces], self.kind)
            .groupBy(F.col("__piece").alias("at"))
            .agg(F.count(F.lit(1)).alias("rows"), F.max(self.offset).alias("last"))
            .select("at", "rows", self.kind.collectable("last").alias("last"))
            .collect()
        )
        return {pieces[r["at"]].id: (r["rows"], self.kind.collected(r["last"])) for r in counted}

    def load_available(self) -> int:
        """Run steps until no range is open; returns the rows loaded."""
        before = self._state["rows"]
        while self.step() is not None:
            pass
        return self._state["rows"] - before

    def poll(self) -> int:
        """Look for rows past the largest offset and plan ranges for them.

        Count and last offset come from one pass. Returns the number of new rows;
        with none, or while ranges are still open, nothing changes.
        """
        if self._state["ranges"]:
            return 0
        with self._working():
            return self._poll()

    def _poll(self) -> int:
        state = self._state
        self._refresh()
        after = state["max_offset"]
        column, start = F.col(self.offset), self.options.initial_offset
        rows = self._table
        if after is not None:
            rows = rows.where((column > self.kind.literal(after)) | column.isNull())
        elif start is not None:
            rows = rows.where((column >= self.kind.literal(self.kind.parse(start))) | column.isNull())
        looked_before = bool(self._known)
        new = self._look_at_files(rows)
        if self._files:
            self._known |= self._files.names()
        # known files were counted before; otherwise the whole table was counted anew
        without = state["without_offset"] + new.without_offset if looked_before and self._files else new.without_offset
        if not new.rows:
            if without != state["without_offset"]:
                self._state = self._save({**state, "without_offset": without, "done": []})
            return 0
        n = planned_ranges(new.rows, self.options.max_records, self.options.num_ranges, self.kind)
        if after is None:
            ranges = split_range(new.first, new.last, n, self.kind)
        else:
            ranges = split_range(after, new.last, n, self.kind, lo_op=">")
        self._chunks = None
        planned = {
            **state,
            "ranges": ranges,
            "max_offset": new.last,
            "planned_rows": new.rows,
            "left": new.rows,
            "without_offset": without,
            "cuts": None,
            "finer": None,
            "staged": None,
            "done": [],
        }
        self._state = self._save(planned)
        return new.rows

    def run(self, max_polls: int = 1) -> int:
        """Load what is there; unless ``load_available`` is set, then poll up to
        ``max_polls`` times, waiting after each poll that finds nothing."""
        before = self._state["rows"]
        self.load_available()
        if not self.options.load_available:
            for turn in range(max_polls):
                if self.poll():
                    self.load_available()
                elif turn < max_polls - 1:
                    sleep(self.options.poll_interval_ms / 1000)
        return self._state["rows"] - before

    # -- results -------------------------------------------------------------

    @property
    def ranges(self) -> list[OffsetRange]:
        """Ranges that are still open."""
        return list(self._state["ranges"])

    @property
    def max_offset(self):
        return self.kind.to_python(self._state["max_offset"])

    @property
    def status(self) -> str:
        return FAILED if self._failed else self._status(self._state)

    def _data_path(self, number: int) -> str:
        """Where a step is written: apart from what another loader writes for the same step."""
        return f"{self.root}/data/{STEP}={number:06d}-{self._owner:06d}"

    def _selects_offset(self) -> bool:
        return self.offset.lower() in {c.lower() for c in self.columns}

    def _fields(self) -> list[T.StructField]:
        """The columns that steps write."""
        types = {f.name.lower(): f for f in self._table.schema}
        names = self.columns if self._selects_offset() else [*self.columns, self.offset]
        return [T.StructField(n, types[n.lower()].dataType) for n in names]

    def output(self) -> DataFrame:
        """All rows of the steps that were completed."""
        fields, steps = self._fields(), self._state["step"]
        if not steps:
            return self.spark.createDataFrame([], T.StructType(fields)).select(*self.columns)
        written = T.StructType([*fields, T.StructField(STEP, T.StringType())])
        rows = self.spark.read.schema(written).parquet(f"{self.root}/data")
        return rows.where(self._completed()).select(*self.columns)

    def _completed(self) -> str:
        """Condition for the folders of completed steps, by whom each was completed."""
        state = self._state
        step, owner = (f"CAST(split({STEP}, '-')[{i}] AS INT)" for i in (0, 1))
        ends = [first - 1 for first, _ in state["owners"][1:]] + [state["step"]]
        by_owner = zip(state["owners"], ends, strict=True)
        return " OR ".join(f"({owner} = {of} AND {step} BETWEEN {first} AND {last})" for (first, of), last in by_owner)

    def progress(self) -> DataFrame:
        """One row per range and step: bounds, cursor, rows, and the step's time; whether
        more rows than the cap shared the offsets of a cut, and the sum of all rows so far."""
        piece = "range_id int, lower string, lo_op string, upper string, hi_op string, cursor string, rows bigint, done boolean, over_cap boolean"
        schema = f"step int, rows bigint, done array<struct<{piece}>>, started_ms bigint, took_ms bigint"
        steps = self.spark.read.schema(schema).json(f"{self.root}/state/*.json").where(F.size("done") > 0)
        if self._documents.numbers("history"):
            folded = self.spark.read.schema(f"steps array<struct<{schema}>>").json(f"{self.root}/history/*.json")
            steps = steps.union(folded.select(F.explode("steps").alias("s")).select("s.*")).dropDuplicates(["step"])
        each = steps.select("step", F.col("rows").alias("rows_so_far"), F.explode("done").alias("r"), "started_ms", "took_ms")
        return each.select(
            "step",
            "r.range_id",
            *[F.col(f"r.{name}").cast(self.kind.data_type).alias(name) for name in ("lower", "upper", "cursor")],
            "r.lo_op",
            "r.hi_op",
            "r.rows",
            "r.done",
            F.coalesce("r.over_cap", F.lit(False)).alias("over_cap"),
            "rows_so_far",
            F.timestamp_millis("started_ms").alias("started"),
            "took_ms",
        )

    def summary(self) -> DataFrame:
        """One row about the whole load."""
        state = self._state
        row = (
            self.options.query_name,
            self.offset,
            self.kind.to_text(state["max_offset"]),
            state["step"],
            state["rows"],
            state["without_offset"],
            len(state["ranges"]),
            self.status,
            state.get("initial_offset"),
            state.get("left", 0),
            state.get("begun_ms"),
            state["started_ms"],
            state["took_ms"],
        )
        made = self.spark.createDataFrame(
            [row],
            "query_name string, offset_column string, max_offset string, steps int, rows bigint, "
            "rows_without_offset bigint, open_ranges int, status string, initial_offset string, rows_left bigint, "
            "begun bigint, last_step bigint, last_took_ms bigint",
        )
        return made.withColumns({name: F.timestamp_millis(name) for name in ("begun", "last_step")})
