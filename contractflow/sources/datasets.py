"""Datasets: immutable Parquet folders and one small commit file per version.

A version names the folders it consists of, so readers never see an unfinished or failed write.
History keeps open rows and closed rows in separate folders: closed rows are written once and
reading the current rows never touches them. One writer owns a dataset; a second one loses the
commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import END_AT, HELPER, START_AT
from ..errors import ContractError, DataRejected, require
from ..operators.projection import name
from .storage import CommitLog, Storage

OPEN, CLOSED, GONE, TABLE, STAGED = "open", "closed", "gone", "table", "staged"
#: Columns that place rows in folders; their names are reserved, so none of the data is lost to them.
BATCH, ROLE, BUCKET = f"{HELPER}batch", f"{HELPER}role", f"{HELPER}bucket"
MERGE_AT = 32


@dataclass(frozen=True)
class Part:
    """One folder of a version. ``through`` limits a batch-partitioned folder to that batch,
    ``level`` counts how often closed rows were merged."""

    role: str
    path: str
    bucket: int | None = None
    through: int | None = None
    level: int | None = None


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    parts: tuple[Part, ...]
    info: dict = field(default_factory=dict)


class Dataset:
    def __init__(self, spark: SparkSession, root: str, storage: Storage | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.storage = storage or Storage(spark)
        self.log = CommitLog(self.storage, f"{self.root}/commits")

    def version(self, number: int | None = None) -> Version | None:
        number = self.log.latest() if number is None else number
        if number is None:
            return None
        raw = self.log.load(number)
        return Version(
            number, T.StructType.fromJson(raw["schema"]), tuple(Part(**p) for p in raw["parts"]), raw["info"]
        )

    def commit(self, previous: Version | None, schema: T.StructType, parts: Iterable[Part], info: dict) -> Version:
        """Publish the version after ``previous``; the first of two writers wins."""
        number = previous.number + 1 if previous else 1
        stored = [{k: v for k, v in vars(p).items() if v is not None} for p in parts]
        body = {"version": number, "schema": json.loads(schema.json()), "parts": stored, "info": info}
        self.log.append(number, json.dumps(body, sort_keys=True).encode())
        return self.version(number)

    def written(self, folder: str) -> list[str]:
        """Names in a folder that was just written; commits only count on folders that storage sees."""
        found = self.storage.names(f"{self.root}/{folder}")
        require(found, f"The rows written to {self.root}/{folder} cannot be found there; nothing was committed")
        return found

    def new_folder(self) -> str:
        return f"data/{uuid.uuid4().hex}"

    def frame(self, version: Version, parts: Iterable[Part]) -> DataFrame:
        """Rows of some parts of a version."""
        whole, limited = [], []
        for part in parts:
            (whole if part.through is None else limited).append(part)
        frames = []
        reader = lambda: self.spark.read.schema(version.schema)
        if whole:
            frames.append(reader().parquet(*[f"{self.root}/{p.path}" for p in whole]))
        for part in limited:
            batches = T.StructType(version.schema.fields + [T.StructField(BATCH, T.LongType())])
            frame = self.spark.read.schema(batches).parquet(f"{self.root}/{part.path}")
            frames.append(frame.where(F.col(BATCH) <= part.through).drop(BATCH))
        if not frames:
            return self.spark.createDataFrame([], version.schema)
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    def parts(self, version: Version, *roles: str, buckets: Iterable[int] | None = None) -> list[Part]:
        wanted = None if buckets is None else set(buckets)
        return [p for p in version.parts if p.role in roles and (wanted is None or p.bucket in wanted)]

    def read(self, port: str = "current", number: int | None = None) -> DataFrame:
        """The ``current`` rows or the ``history`` of one committed version."""
        frame, _ = self.read_pinned(port, number)
        return frame

    def read_pinned(self, port: str = "current", number: int | None = None) -> tuple[DataFrame, int]:
        """Like read, together with the version that every later read of the frame uses."""
        require(port in ("current", "history"), "A dataset has a current and a history port")
        version = self.version(number)
        if version is None:
            raise ContractError("The dataset has no committed version")
        keeps_history = END_AT in version.schema.names
        if port == "history":
            require(keeps_history, "The dataset keeps no history")
            return self.frame(version, self.parts(version, OPEN, CLOSED)), version.number
        if keeps_history:
            return self.frame(version, self.parts(version, OPEN)).drop(START_AT, END_AT), version.number
        return self.frame(version, self.parts(version, TABLE)), version.number

    # --- writes: ``info`` is stored with the version, or computed from the rows just written ---

    def _info(self, info, schema: T.StructType, folder: str) -> dict:
        self.written(folder)
        if callable(info):
            info = info(self.spark.read.schema(schema).parquet(f"{self.root}/{folder}"))
        return dict(info or {})

    def replace_table(self, frame: DataFrame, info=None) -> Version:
        """A new version with these rows only."""
        previous, folder = self.version(), self.new_folder()
        frame.write.parquet(f"{self.root}/{folder}")
        info = self._info(info, frame.schema, folder)
        return self.commit(previous, frame.schema, [Part(TABLE, folder)], info)

    def add_to_table(self, frame: DataFrame, info=None) -> Version:
        """A new version with these rows in addition."""
        previous, folder = self.version(), self.new_folder()
        shape = lambda schema: [(f.name, f.dataType) for f in schema.fields]
        same = previous is None or shape(previous.schema) == shape(frame.schema)
        require(same, "The added rows have other columns or types than the stored ones", DataRejected)
        frame.write.parquet(f"{self.root}/{folder}")
        info = self._info(info, frame.schema, folder)
        kept = previous.parts if previous else ()
        return self.commit(previous, frame.schema, [*kept, Part(TABLE, folder)], info)

    def write_batch(self, frame: DataFrame, batch_id: int) -> Part:
        """Rows of one micro-batch, and the part that holds them with those of all batches before. They are seen once a commit
        names that part; a retry overwrites its own folder."""
        frame.write.mode("overwrite").parquet(f"{self.root}/appended/{BATCH}={batch_id}")
        self.written(f"appended/{BATCH}={batch_id}")
        return Part(TABLE, "appended", through=batch_id)

    def write_placed(self, frame: DataFrame, role: Column, bucket: Column) -> tuple[str, list[Part]]:
        """Write rows by role and bucket; the folder, and one part for each pair that has rows."""
        folder = self.new_folder()
        # The rebalance lets many tasks write a hot bucket.
        placed = frame.withColumns({ROLE: role, BUCKET: bucket}).hint("rebalance", ROLE, BUCKET)
        placed.write.partitionBy(ROLE, BUCKET).parquet(f"{self.root}/{folder}")
        inner = lambda where, column: [n for n in self.storage.names(f"{self.root}/{where}") if n.startswith(f"{column}=")]
        value = lambda entry: entry.split("=")[1]
        self.written(folder)
        return folder, [
            Part(value(kind), f"{folder}/{kind}/{place}", int(value(place)))
            for kind in inner(folder, ROLE)
            for place in inner(f"{folder}/{kind}", BUCKET)
        ]

    def replace_buckets(self, frame: DataFrame, bucket: Column, touched: Iterable[int] | None, info=None) -> Version:
        """A new version in which these rows stand for the table or open rows of the touched buckets (None: of all); closed rows are
        added to those that are stored, and all other folders stay."""
        previous, touched = self.version(), None if touched is None else set(touched)
        history = END_AT in frame.columns
        role = F.when(name(END_AT).isNull(), OPEN).otherwise(CLOSED) if history else F.lit(TABLE)
        folder, written = self.write_placed(frame, role, bucket)
        info = self._info(info, frame.schema, folder)
        live = OPEN if history else TABLE
        stays = [p for p in previous.parts if p.role == live and touched is not None and p.bucket not in touched] if previous else []
        return self.commit(previous, frame.schema, [*stays, *(self._merged(previous) if previous else []), *written], info)

    def advance_history(self, frame: DataFrame, info=None) -> Version:
        """Replace the open rows and add the newly closed ones; closed history stays in place."""
        previous, folder = self.version(), self.new_folder()
        marked = frame.withColumn(ROLE, F.when(name(END_AT).isNull(), OPEN).otherwise(CLOSED))
        marked.write.partitionBy(ROLE).parquet(f"{self.root}/{folder}")
        info = self._info(info, frame.schema, folder)
        kept = self._merged(previous) if previous else []
        added = [
            Part(n.split("=")[1], f"{folder}/{n}")
            for n in self.written(folder)
            if n.startswith(f"{ROLE}=")
        ]
        return self.commit(previous, frame.schema, [*kept, *added], info)

    def _merged(self, previous: Version) -> list[Part]:
        """Closed folders, where many of one level are rewritten as one of the next. A snapshot
        closes few rows in many tasks, and each row is rewritten only once per level."""
        closed, level = self.parts(previous, CLOSED), 0
        while True:
            same = [p for p in closed if (p.level or 0) == level]
            if len(same) < MERGE_AT:
                return closed
            folder, level = self.new_folder(), level + 1
            self.frame(previous, same).write.parquet(f"{self.root}/{folder}")
            closed = [p for p in closed if p not in same] + [Part(CLOSED, folder, level=level)]

    def compact_history(self) -> Version:
        """Rewrite many small closed folders as one; the rows are the same."""
        previous = self.version()
        folder = self.new_folder()
        self.frame(previous, self.parts(previous, CLOSED)).write.parquet(f"{self.root}/{folder}")
        kept = [p for p in previous.parts if p.role != CLOSED]
        return self.commit(previous, previous.schema, [*kept, Part(CLOSED, folder)], previous.info)


def result_store(spark: SparkSession, location: str | None):
    """A function that appends rule results to a dataset, or None without a location."""
    return None if location is None else (lambda rows: Dataset(spark, location).add_to_table(rows))


def read_dataset(spark: SparkSession, location: str, port: str = "current") -> DataFrame:
    """An input of a view: a dataset folder written by this engine, or a catalog table."""
    if "/" in location:
        return Dataset(spark, location).read(port)
    require(port == "current", "A catalog table has only a current port")
    return spark.table(location)
