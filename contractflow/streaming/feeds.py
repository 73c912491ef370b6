"""Immutable files and change events as Structured Streaming queries.

Each micro-batch is checked as a whole before anything of it becomes visible: a failed rule
fails the query, and the next start retries the same batch. A commit records the batch it holds,
so a batch that is replayed after its commit is recognised and skipped.
"""

from __future__ import annotations

import datetime as dt
import json
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import END_AT, HELPER, RESCUED, START_AT, Contract, canonical_type
from ..errors import DataRejected, listed, require
from ..functions.rules import APPEND, EVENTS, compile_rules, expectations
from ..operators import history, quality
from ..operators.projection import business_rules, fails, literal, name, project, required_rules
from ..plans.terms import SourceTerms
from ..session import checkpoint
from ..sources.datasets import BATCH, BUCKET, CLOSED, GONE, OPEN, STAGED, Dataset, Part, Version
from ..sources.files import FILE, reader_options, rescue_parquet, stream_files
from ..sources.storage import Storage

FAIL, WARN = "fail", "warn"
BROADCAST_KEYS = 200_000
#: Sequence of a key's last event, stored with its open row; first new event of a key; last event applied before; start of a rebuild.
LAST, CUT, APPLIED, ANCHOR, LATE = (f"{HELPER}{n}" for n in ("last", "cut", "applied", "anchor", "late"))
CLOSED_FOLDERS = 16


@dataclass(frozen=True)
class AppendFlow:
    """Immutable files accumulated in one table. The table shows ``_rescued_data``, always NULL."""

    contract: Contract
    source: str
    target: str
    checkpoint: str
    fmt: str = "json"
    reader: Mapping | None = None
    expectations: Mapping[str, str] | None = None
    files_per_batch: int = 1000
    terms: SourceTerms | None = None
    freshness: tuple[str, float] | None = None
    unsupported: str = "error"

    standard = APPEND
    operation = None
    sequence_columns = ()

    def __post_init__(self):
        self._check_settings()

    def _check_settings(self):
        reader_options(self.fmt, self.reader, self.standard)
        require(
            self.fmt != "parquet" or not any(c.temporal for c in self.contract.columns),
            "Streamed Parquet with DATE or TIMESTAMP columns needs a per-file policy; deliver snapshots or text",
        )
        self.checks()
        if self.terms:
            self.terms.check(self.standard)
        if self.freshness:
            column = self.contract.by_source(self.freshness[0])
            hidden = column.output in {self.operation, *self.sequence_columns}
            require(column.temporal and not hidden, "Freshness needs a published DATE or TIMESTAMP column")

    def checks(self) -> list:
        return compile_rules(self.contract, self.standard, self.unsupported)

    @property
    def key_columns(self) -> list[str]:
        return []

    def rules(self) -> dict:
        """Every row rule with its outcome."""
        operation, sequence = self.operation, list(self.sequence_columns)
        rules = {"source_schema": (name(RESCUED).isNull(), FAIL)}
        if operation:
            rules["operation"] = (name(operation).isin("I", "U", "D"), FAIL)
        fixed = required_rules(self.contract, self.key_columns, sequence, operation)
        fixed.update(business_rules(self.expectations))
        rules.update({rule: (holds, FAIL) for rule, holds in fixed.items()})
        rules.update(expectations(self.checks(), self.key_columns, sequence, operation))
        return rules

    def rescued(self, spark: SparkSession, rows: DataFrame) -> DataFrame:
        """A batch of Parquet files, each read with its own schema; the stream itself only names them."""
        if FILE not in rows.columns:
            return rows
        paths = [r[0] for r in rows.select(FILE).distinct().collect()]  # at most files_per_batch
        return project(rescue_parquet(spark, paths, self.contract), self.contract, self.fmt)

    def watched(self, rows: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
        """The rows, counted against every rule by the job that writes them; and, once it has run, the failures of warnings.

        A failed rule raises there. What was written stays unseen then, since no commit names it.
        """
        rules, seen = self.rules(), Observation()
        counters = [F.count_if(fails(holds)).alias(f"c{i}") for i, (holds, _) in enumerate(rules.values())]

        def judge() -> dict[str, int]:
            found = seen.get
            failing = {rule: found[f"c{i}"] for i, rule in enumerate(rules) if found.get(f"c{i}")}
            failed = [f"{rule} ({n})" for rule, n in failing.items() if rules[rule][1] == FAIL]
            require(not failed, f"Row rules failed, the batch was not applied: {listed(failed)}", DataRejected)
            return failing

        return rows.observe(seen, *counters), judge

    def _rows(self, spark: SparkSession) -> DataFrame:
        options = reader_options(self.fmt, self.reader, self.standard)
        raw = stream_files(spark, self.source, self.contract, self.fmt, options, self.files_per_batch)
        return project(raw, self.contract, self.fmt, keep=[FILE] if FILE in raw.columns else [])

    def _stream(self, spark: SparkSession) -> str | None:
        """Identity that Spark gave the stream when its checkpoint was created."""
        storage = Storage(spark)
        if "metadata" not in storage.names(self.checkpoint):
            return None
        return json.loads(storage.read(f"{self.checkpoint}/metadata"))["id"]

    def apply(self, rows: DataFrame, batch_id: int) -> None:
        """Check and commit one micro-batch."""
        spark = rows.sparkSession
        target = Dataset(spark, self.target)
        version = target.version()
        if version:
            # Batch numbers of another checkpoint say nothing about what this target holds.
            same = version.info["stream"] == self._stream(spark)
            require(same, "The target belongs to another checkpoint; restore it, or load into an empty target")
            if version.info["batch"] >= batch_id:
                return
        rows, judge = self.watched(self.rescued(spark, rows))
        landed = self._land(target, rows, batch_id)
        info = {"warnings": judge(), "batch": batch_id, "stream": self._stream(spark)}
        self._commit(target, landed, rows.schema, batch_id, info)

    def _land(self, target: Dataset, rows: DataFrame, batch_id: int) -> Part:
        """Write a batch; it is read once, and rules are counted on the way."""
        return target.write_batch(rows, batch_id)

    def _commit(self, target: Dataset, landed: Part, schema: T.StructType, batch_id: int, info: dict) -> None:
        target.commit(target.version(), schema, [landed], info)

    def check_fresh(self, spark: SparkSession, now: dt.datetime | None = None) -> None:
        """Refuse when the current rows are too old, or there are none."""
        column, hours = self.freshness
        current = Dataset(spark, self.target).read()
        quality.require_fresh(current, self.contract.by_source(column).output, hours, now)

    def run(self, spark: SparkSession) -> None:
        """Process every file that has arrived and stop."""
        query = (
            self._rows(spark)
            .writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


@dataclass(frozen=True)
class ChangeFlow(AppendFlow):
    """Baseline plus full-row I/U/D events to an SCD2 history and a current table.

    Keys, sequence, operation and tracked columns are physical source names. Events may arrive in
    any order and arbitrarily late. Events later than all of their key's earlier ones follow its open row.
    Accepted events are staged, and for keys with a late event the history is rebuilt from the version
    that held at the batch's earliest event.
    """

    keys: Sequence[str] | None = None
    sequence: str | Sequence[str] = ()
    operation_column: str | None = None
    tracked: Sequence[str] | None = None
    buckets: int = 64
    block_rows: int | None = None

    standard = EVENTS

    def __post_init__(self):
        self._check_settings()
        contract, sequence = self.contract, self.sequence_columns
        require(self.key_columns, "Declare keys in the flow or the contract")
        require(sequence and self.operation_column, "A change feed needs a sequence and an operation column")
        require(not set(sequence) & set(self.key_columns), "A sequence column is not a key")
        require(not set(sequence) & set(self.tracked_columns or ()), "A sequence column is not tracked")
        others = {*self.key_columns, *sequence, *(self.tracked_columns or ())}
        require(self.operation not in others, "The operation column is not a key, sequence or tracked column")
        require(canonical_type(contract.by_output(self.operation).type) == "STRING", "The operation column is a STRING")
        for column in sequence:
            kind = canonical_type(contract.by_output(column).type)
            require(kind not in ("BOOLEAN", "BINARY"), "The sequence column has a sortable type")

    @property
    def key_columns(self) -> list[str]:
        return self.contract.keys if self.keys is None else self.contract.resolve(self.keys)

    @property
    def operation(self) -> str | None:
        return self.operation_column and self.contract.by_source(self.operation_column).output

    @property
    def sequence_columns(self) -> list[str]:
        given = [self.sequence] if isinstance(self.sequence, str) else list(self.sequence)
        return self.contract.resolve(given)

    @property
    def tracked_columns(self) -> list[str] | None:
        return None if self.tracked is None else self.contract.resolve(self.tracked)

    def _sequence(self):
        columns = [name(c) for c in self.sequence_columns]
        return columns[0] if len(columns) == 1 else F.struct(*columns)

    def _bucket(self):
        return F.pmod(F.xxhash64(*[name(k) for k in self.key_columns]), F.lit(self.buckets)).cast("int")

    def _land(self, target: Dataset, rows: DataFrame, batch_id: int) -> Part:
        return self._stage(target, rows.drop(RESCUED), f"staged/{BATCH}={batch_id}")

    def _commit(self, target: Dataset, landed: Part, schema: T.StructType, batch_id: int, info: dict) -> None:
        keys, schema = self.key_columns, T.StructType([f for f in schema.fields if f.name != RESCUED])
        previous = target.version()
        same = previous is None or previous.info["buckets"] == self.buckets
        require(same, "The number of buckets is fixed when a target is created")
        staging = [p for p in previous.parts if p.role == STAGED] if previous else []
        events = self._staged(target, [landed], schema)
        spans = events.groupBy(*keys, BUCKET).agg(F.min(self._sequence()).alias(CUT), F.max(self._sequence()).alias(LAST))
        spans = self._written_once(spans)
        touched = sorted(r[0] for r in spans.select(BUCKET).distinct().collect())
        if previous is None:
            rows, rewrite = self._heads_and_closed(events.drop(BUCKET), spans), set()
        else:
            rows, rewrite = self._advanced(target, previous, events.drop(BUCKET), spans, touched, [*staging, landed])
        replaced = {(role, b) for role in (OPEN, GONE) for b in touched} | {(CLOSED, b) for b in rewrite}
        stays = [p for p in previous.parts if p.role != STAGED and (p.role, p.bucket) not in replaced] if previous else []
        written = self._write(target, rows)
        target.commit(previous, rows.drop(LAST).schema, [*stays, *written, *staging, landed], {**info, "buckets": self.buckets})

    def _advanced(self, target: Dataset, previous, events: DataFrame, spans: DataFrame, touched: list[int], staging: list[Part]):
        """The rows that this batch writes, and the buckets whose closed rows are among them.

        Where all of a key's new events are later than its last applied one, they follow its open row, and nothing else of the
        key is read. Only for the other keys the staged log and the closed rows are looked up.
        """
        keys = self.key_columns
        heads = self._heads(target, previous, touched)
        known = self._with_keys(spans, heads.select(*keys, F.col(LAST).alias(APPLIED)), "left")
        known = self._written_once(known.withColumn(LATE, F.coalesce(F.col(CUT) <= F.col(APPLIED), F.lit(False))))
        on_time = known.where(~F.col(LATE)).select(*keys)
        # The open row stands for all earlier events of its key; its run began at its start.
        seeds = self._with_keys(heads.where(name(START_AT).isNotNull()), on_time, "left_semi")
        tail = self._as_events(seeds, events.schema).unionByName(self._with_keys(events, on_time, "left_semi"))
        late, anchors, rewrite = known.where(LATE).select(*keys, BUCKET, CUT), None, set()
        here = sorted(r[0] for r in late.select(BUCKET).distinct().collect())
        if here:
            anchors = self._anchors(target.frame(previous, target.parts(previous, OPEN, CLOSED, buckets=here)), late)
            tail = tail.unionByName(self._tail(self._staged(target, staging, events.schema), anchors, here))
            rewrite = self._reached(target, previous, anchors, here)
        rewrite |= self._crowded(target, previous, touched)
        latest = known.select(*keys, F.greatest(LAST, APPLIED).alias(LAST))
        rows = self._heads_and_closed(tail, latest)
        rows = rows.unionByName(self._with_keys(heads, known.select(*keys), "left_anti").select(*rows.columns))
        if rewrite:
            closed = target.frame(previous, target.parts(previous, CLOSED, buckets=rewrite))
            if anchors is not None:
                closed = self._with_keys(closed, anchors.drop(BUCKET), "left")
                closed = closed.where(F.col(ANCHOR).isNull() | (name(START_AT) < F.col(ANCHOR)))
            nothing = F.lit(None).cast(rows.schema[LAST].dataType)
            rows = rows.unionByName(closed.withColumn(LAST, nothing).select(*rows.columns))
        return rows, rewrite

    def _heads_and_closed(self, events: DataFrame, latest: DataFrame) -> DataFrame:
        """Versions made of events in order, and one row of nothing but its key for each key that ends deleted. What is open or
        deleted carries the sequence of the key's last event."""
        settings = {"operation": self.operation, "tracked": self.tracked_columns, "block_rows": self.block_rows}
        runs, published = history.event_runs(events, self.key_columns, self.sequence_columns, **settings)
        live, until = F.col("__cf_live"), F.col("__cf_until")
        runs = self._with_keys(runs.where(live | until.isNull()), latest.select(*self.key_columns, LAST), "left")
        shown = [name(c) if c in self.key_columns else F.when(live, name(c)).alias(c) for c in published]
        return runs.select(*shown, F.when(live, F.col("__cf_seq")).alias(START_AT), until.alias(END_AT), F.when(until.isNull(), F.col(LAST)).alias(LAST))

    def _heads(self, target: Dataset, previous, touched: list[int]) -> DataFrame:
        """One row per key that was ever seen in these buckets: its open row, or its key alone where it is deleted, with its last sequence."""
        schema = T.StructType([*previous.schema.fields, T.StructField(LAST, previous.schema[START_AT].dataType)])
        return target.frame(Version(previous.number, schema, previous.parts), target.parts(previous, OPEN, GONE, buckets=touched))

    def _as_events(self, opened: DataFrame, schema: T.StructType) -> DataFrame:
        """Open rows in the shape of the events that began their runs."""
        sequence, columns = self.sequence_columns, []
        for field in schema.fields:
            value = name(field.name) if field.name not in (*sequence, self.operation) else F.lit("U")
            if field.name in sequence:
                value = name(START_AT) if len(sequence) == 1 else name(START_AT)[field.name]
            columns.append(value.alias(field.name))
        return opened.select(*columns)

    def _history(self, events: DataFrame) -> DataFrame:
        return history.scd2_from_events(
            events,
            self.key_columns,
            self.sequence_columns,
            operation=self.operation,
            tracked=self.tracked_columns,
            block_rows=self.block_rows,
        )

    def _stage(self, target: Dataset, events: DataFrame, folder: str, by_range: bool = False) -> Part:
        """Keep accepted events privately; a retry overwrites its own folder. ``by_range`` cuts large buckets by sequence."""
        bucketed = events.withColumn(BUCKET, self._bucket())
        order = [BUCKET, *self.sequence_columns]
        # Ranging would run an observed batch twice, so it is for rows that are stored already.
        bucketed = bucketed.repartitionByRange(*order) if by_range else bucketed.hint("rebalance", BUCKET)
        # Sorted files let a later read skip the events before its earliest one.
        bucketed = bucketed.sortWithinPartitions(*order)
        bucketed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{target.root}/{folder}")
        return Part(STAGED, folder)

    def _staged(self, target: Dataset, parts: list[Part], schema: T.StructType) -> DataFrame:
        """Rows of staged folders, which are partitioned by batch and bucket below one base path."""
        columns = [T.StructField(f.name, f.dataType) for f in schema.fields]
        columns += [T.StructField(BATCH, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
        reader = target.spark.read.schema(T.StructType(columns)).option("basePath", f"{target.root}/staged")
        return reader.parquet(*[f"{target.root}/{p.path}" for p in parts]).drop(BATCH)

    def staged_events(self, spark: SparkSession) -> DataFrame:
        """Every accepted event, with its operation and sequence; not published."""
        target = Dataset(spark, self.target)
        version = target.version()
        return self._staged(target, target.parts(version, STAGED), self.contract.schema()).drop(BUCKET)

    def rebuild(self, spark: SparkSession) -> DataFrame:
        """History rebuilt from all accepted events, for comparison before promotion."""
        return self._history(self.staged_events(spark))

    def compact(self, spark: SparkSession):
        """Rewrite the staged events of many batches as one folder; history stays as it is."""
        target = Dataset(spark, self.target)
        version = target.version()
        part = self._stage(target, self.staged_events(spark), f"staged/{BATCH}=compacted-{version.number}", by_range=True)
        return target.commit(version, version.schema, [p for p in version.parts if p.role != STAGED] + [part], version.info)

    def _with_keys(self, frame: DataFrame, keyed: DataFrame, how: str) -> DataFrame:
        return frame.join(keyed, self.key_columns, how)

    def _anchors(self, stored: DataFrame, changed: DataFrame) -> DataFrame:
        """Where each changed key's history is rebuilt from: the start of the version that holds
        at its earliest new event, or that event itself."""
        cut, earliest = F.col(CUT), self._earliest(changed, CUT)
        candidates = stored.select(*self.key_columns, START_AT, END_AT)
        if earliest is not None:
            candidates = candidates.where(name(END_AT).isNull() | (name(END_AT) > earliest))
        holding = self._with_keys(candidates, changed.select(*self.key_columns, CUT), "inner").where(
            (name(START_AT) <= cut) & (name(END_AT).isNull() | (name(END_AT) > cut))
        )
        starts = holding.select(*self.key_columns, name(START_AT).alias("__cf_start"))
        anchored = self._with_keys(changed, starts, "left")
        anchored = anchored.select(*self.key_columns, BUCKET, F.coalesce("__cf_start", CUT).alias(ANCHOR))
        return self._written_once(anchored)

    def _written_once(self, keyed: DataFrame) -> DataFrame:
        """A per-key frame used in several joins, sent to every task only where it is small."""
        keyed = checkpoint(keyed)
        return F.broadcast(keyed) if keyed.count() <= BROADCAST_KEYS else keyed

    def _earliest(self, keyed: DataFrame, column: str):
        """Literal lower bound that files can be skipped by, where the sequence is one column."""
        if len(self.sequence_columns) > 1:
            return None
        return literal(keyed.agg(F.min(column)).first()[0], keyed.schema[column].dataType)

    def _tail(self, staged: DataFrame, anchors: DataFrame, touched: list[int]) -> DataFrame:
        here = staged.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        earliest = self._earliest(anchors, ANCHOR)
        if earliest is not None:
            here = here.where(self._sequence() >= earliest)
        joined = self._with_keys(here, anchors.drop(BUCKET), "inner")
        return joined.where(self._sequence() >= F.col(ANCHOR)).drop(ANCHOR)

    def _reached(self, target: Dataset, previous, anchors: DataFrame, here: list[int]) -> set[int]:
        """Buckets in whose closed rows a late event reaches."""
        closed = target.frame(previous, target.parts(previous, CLOSED, buckets=here))
        earliest = self._earliest(anchors, ANCHOR)
        if earliest is not None:
            closed = closed.where(name(START_AT) >= earliest)
        found = self._with_keys(closed.withColumn(BUCKET, self._bucket()), anchors.drop(BUCKET), "inner")
        return {r[0] for r in found.where(name(START_AT) >= F.col(ANCHOR)).select(BUCKET).distinct().collect()}

    def _crowded(self, target: Dataset, previous, touched: list[int]) -> set[int]:
        """Touched buckets in which many small closed folders have gathered."""
        counts = Counter(p.bucket for p in target.parts(previous, CLOSED, buckets=touched))
        return {bucket for bucket, n in counts.items() if n >= CLOSED_FOLDERS}

    def _write(self, target: Dataset, frame: DataFrame) -> list[Part]:
        """Write open rows, closed rows and deleted keys by bucket; returns the folders that hold rows."""
        role = F.when(name(END_AT).isNotNull(), CLOSED).when(name(START_AT).isNull(), GONE).otherwise(OPEN)
        return target.write_placed(frame, role, self._bucket())[1]


def from_landing(contract: Contract, upstream: Contract, **settings) -> AppendFlow:
    """An append-only flow over JSON or CSV files that another flow landed under the same contract."""
    require(contract.same_shape(upstream), "The landed contract differs from this flow's input contract")
    require(settings.get("fmt", "json") in ("json", "csv"), "Landed files are JSON or CSV")
    return AppendFlow(contract, **settings)
