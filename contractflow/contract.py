"""Data contracts: ordered, explicitly typed columns with their quality rules."""

from __future__ import annotations

import copy
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import types as T

from .errors import ContractError, require

START_AT = "__START_AT"
END_AT = "__END_AT"
RESCUED = "_rescued_data"

# Identifier form and the names reserved for history and rescue columns.
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
RESERVED = {START_AT.lower(), END_AT.lower(), RESCUED}
#: Every column that an operator or a stored folder adds for its own use begins so; a contract column may not.
HELPER = "__cf_"

# Contract type names and the Spark types they stand for.
SIMPLE_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "SMALLINT": T.ShortType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "BOOLEAN": T.BooleanType(),
    "BINARY": T.BinaryType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
}
TEMPORAL = ("DATE", "TIMESTAMP")
DECIMAL = re.compile(r"DECIMAL\((\d{1,2})(?:,(\d{1,2}))?\)")

# Source database type names that may be mapped to a contract type.
SOURCE_TYPES = {
    "string": "STRING",
    "varchar": "STRING",
    "nvarchar": "STRING",
    "bigint": "BIGINT",
    "int": "INT",
    "integer": "INT",
    "smallint": "SMALLINT",
    "boolean": "BOOLEAN",
    "bit": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "datetime2": "TIMESTAMP",
    "double": "DOUBLE",
    "binary": "BINARY",
}


def report_name(wanted: str, taken: Iterable[str]) -> str:
    """Name of a column that a report adds to columns of the data: as wanted, unless the data has one of that name."""
    return HELPER + wanted if wanted.lower() in {t.lower() for t in taken} else wanted


def canonical_type(text: str) -> str:
    name = str(text).upper().replace(" ", "")
    return "INT" if name == "INTEGER" else name


def spark_type(text: str) -> T.DataType:
    """The Spark type of a contract type; a contract TIMESTAMP has no time zone."""
    name = canonical_type(text)
    if name in SIMPLE_TYPES:
        return SIMPLE_TYPES[name]
    decimal = DECIMAL.fullmatch(name)
    require(decimal, f"Unsupported contract type {text}")
    precision, scale = int(decimal.group(1)), int(decimal.group(2) or 0)
    require(1 <= precision <= 38 and scale <= precision, f"Unsupported contract type {text}")
    return T.DecimalType(precision, scale)


def source_type(text: str) -> str:
    """Contract type of a source database type; anything unknown is refused."""
    found = SOURCE_TYPES.get(str(text).lower())
    require(found, "Unsupported source type; review the mapping before reading this table")
    return found


def is_numeric(text: str) -> bool:
    return isinstance(spark_type(text), T.NumericType)


@dataclass(frozen=True)
class Column:
    """One contract column: physical source name, published name and type."""

    name: str
    type: str
    target: str | None = None
    required: bool = False
    key: bool = False
    quality: tuple = ()

    @property
    def output(self) -> str:
        return self.target or self.name

    @property
    def temporal(self) -> bool:
        return canonical_type(self.type) in TEMPORAL

    def field(self, output: bool = True) -> T.StructField:
        meta = {"physicalName": self.name, "key": self.key}
        return T.StructField(self.output if output else self.name, spark_type(self.type), True, meta)


def _check_names(names: Iterable[str], side: str) -> None:
    seen = set()
    for name in names:
        usable = isinstance(name, str) and IDENTIFIER.fullmatch(name)
        require(
            usable and name.lower() not in RESERVED and not name.lower().startswith(HELPER) and name.lower() not in seen,
            f"Invalid, reserved or duplicate {side} column {name}",
        )
        seen.add(name.lower())


@dataclass(frozen=True)
class Contract:
    """A versioned table contract."""

    table: str
    columns: tuple[Column, ...]
    version: str | None = None
    quality: tuple = ()
    contract_quality: tuple = ()

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))
        _check_names([c.name for c in self.columns], "source")
        _check_names([c.output for c in self.columns], "output")
        for column in self.columns:
            spark_type(column.type)

    @classmethod
    def from_dict(cls, document: Mapping[str, Any]) -> "Contract":
        """Read a contract document with one table object (ODCS v3.1 layout)."""
        objects = document.get("schema") or []
        require(len(objects) == 1, "A contract describes exactly one table object")
        table = objects[0]
        columns = []
        for item in table.get("properties") or []:
            physical = item.get("physicalName") or item.get("name")
            columns.append(
                Column(
                    name=physical,
                    type=item.get("physicalType"),
                    target=item.get("name") if item.get("name") != physical else None,
                    required=item.get("required") is True,
                    key=item.get("primaryKey") is True,
                    quality=tuple(item.get("quality") or ()),
                )
            )
        version = document.get("version")
        return cls(
            table=str(table.get("name", "table")),
            columns=tuple(columns),
            version=version if isinstance(version, str) else None,
            quality=tuple(table.get("quality") or ()),
            contract_quality=tuple(document.get("quality") or ()),
        )

    @classmethod
    def from_yaml(cls, text: str) -> "Contract":
        try:
            import yaml
        except ImportError as error:  # pragma: no cover - yaml is optional
            raise ContractError("Reading YAML contracts needs the yaml package") from error
        return cls.from_dict(yaml.safe_load(text))

    @property
    def names(self) -> list[str]:
        return [c.output for c in self.columns]

    @property
    def keys(self) -> list[str]:
        return [c.output for c in self.columns if c.key]

    @property
    def required(self) -> list[str]:
        return [c.output for c in self.columns if c.required]

    def by_source(self, name: str) -> Column:
        for column in self.columns:
            if column.name == name:
                return column
        raise ContractError(f"Unknown physical source column {name}")

    def by_output(self, name: str) -> Column:
        for column in self.columns:
            if column.output == name:
                return column
        raise ContractError(f"Unknown contract column {name}")

    def resolve(self, names: Iterable[str] | None) -> list[str]:
        """Published names of settings that are given as physical source names."""
        return [self.by_source(name).output for name in names or ()]

    def read_schema(self, fmt: str) -> T.StructType:
        """Source-side schema. Text formats read temporal columns as text for the strict parse."""
        fields = []
        for column in self.columns:
            as_text = column.temporal and fmt != "parquet"
            fields.append(T.StructField(column.name, T.StringType() if as_text else spark_type(column.type)))
        return T.StructType(fields)

    def schema(self) -> T.StructType:
        return T.StructType([c.field() for c in self.columns])

    def history_schema(self, sequence_type: T.DataType | None = None, drop: Iterable[str] = ()) -> T.StructType:
        """History rows have no keys and two boundary columns of the sequence's type."""
        bound = sequence_type or T.LongType()
        fields = [
            T.StructField(c.output, spark_type(c.type), True, {"physicalName": c.output, "key": False})
            for c in self.columns
            if c.output not in set(drop)
        ]
        return T.StructType(fields + [T.StructField(START_AT, bound, False), T.StructField(END_AT, bound, True)])

    def published(self, drop: Iterable[str] = ()) -> "Contract":
        """The contract of the published table: source names are gone."""
        kept = [replace(c, name=c.output, target=None) for c in self.columns if c.output not in set(drop)]
        return replace(self, columns=tuple(kept))

    def same_shape(self, other: "Contract") -> bool:
        """Whether another contract has the same version, columns and types, in order."""
        shape = lambda c: [(x.name, x.output, canonical_type(x.type), x.required, x.key) for x in c.columns]
        return self.version == other.version and self.table == other.table and shape(self) == shape(other)


def published_document(document: Mapping[str, Any]) -> dict:
    """A contract document without physical names, as published to consumers."""
    value = copy.deepcopy(dict(document))
    for table in value.get("schema") or []:
        for item in table.get("properties") or []:
            item.pop("physicalName", None)
    return value
