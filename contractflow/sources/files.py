"""File sources with a declared schema. Nothing is inferred and nothing that does not fit is lost:
it is reported in ``_rescued_data``."""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import RESCUED, Contract
from ..errors import ContractError, DataRejected, require
from ..functions import temporal
from ..operators.projection import name

CORRUPT = "__cf_corrupt_record"
FILE = "__cf_source_file"
UNREADABLE = "(unreadable document)"
STREAM_FORMATS = ("json", "csv", "parquet")
FOLDER_FORMATS = ("csv", "json", "parquet", "xml", "avro", "text")


@contextlib.contextmanager
def without_values(message: str):
    """Replace engine errors, which may quote records, by a fixed message."""
    try:
        yield
    except (PySparkException, Py4JJavaError):
        raise DataRejected(message) from None


def below_root(root: str, path: str) -> str:
    """Join a relative path to its root; it may not leave the root."""
    require(
        path and not path.startswith("/") and not any(p in ("", ".", "..") for p in path.split("/")),
        "A relative path stays below its root",
    )
    return f"{root.rstrip('/')}/{path}"


def reader_options(fmt: str, reader: Mapping | None, standard: str) -> dict:
    """Reader settings that a standard accepts; unknown settings are refused, never ignored."""
    reader = dict(reader or {})
    require(fmt in STREAM_FORMATS, "Files are JSON, CSV or Parquet")
    if fmt == "csv":
        require(standard == "append", "CSV is accepted for append-only files")
        require(reader.pop("header", None) is True, "CSV needs a header")
        require(reader.pop("delimiter", None) == ",", "CSV is separated by commas")
        options = {"header": True, "sep": ",", "enforceSchema": False}
    else:
        options = {}
        if fmt == "json" and "multiLine" in reader:
            multi = reader.pop("multiLine")
            require(isinstance(multi, bool), "multiLine is true or false")
            options["multiLine"] = multi
    require(not reader, f"Unsupported reader settings: {', '.join(sorted(reader))}")
    return options


def read_snapshot(spark: SparkSession, path: str, contract: Contract, fmt: str, options: Mapping | None = None) -> DataFrame:
    """A complete snapshot in source columns; malformed records fail the first action."""
    require(fmt in ("json", "parquet"), "Snapshots are JSON or Parquet")
    reader = spark.read.format(fmt).schema(contract.read_schema(fmt)).option("mode", "FAILFAST")
    return reader.options(**(options or {})).load(path)


# --- rescued data ----------------------------------------------------------------------------


def rescue_json(text: DataFrame, contract: Contract, value: str = "value") -> DataFrame:
    """Parse one JSON object per row. Malformed records, wrong types and undeclared fields are
    kept as text in ``_rescued_data``."""
    schema = contract.read_schema("json")
    parsed = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    record = F.from_json(
        F.col(value), parsed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    ).alias("__cf_r")
    declared = F.array(*[F.lit(f.name) for f in schema.fields])
    extra = F.array_except(F.json_object_keys(value), declared)
    # A NULL key list means the record is not an object.
    misfit = F.col(f"__cf_r.{CORRUPT}").isNotNull() | F.coalesce(F.size(extra) > 0, F.lit(True))
    kept = [c for c in text.columns if c != value]
    # Blank lines are not records; an unreadable document (NULL) is one that must be reported.
    filled = text.where(F.coalesce(F.length(F.trim(value)) > 0, F.lit(True))).select("*", record)
    return filled.select(
        *[F.col(f"__cf_r.`{f.name}`").alias(f.name) for f in schema.fields],
        F.when(misfit, F.coalesce(value, F.lit(UNREADABLE))).alias(RESCUED),
        *kept,
    )


def rescue_csv(raw: DataFrame, contract: Contract) -> DataFrame:
    """Rows with too few or too many values, or values of a wrong type, are rescued."""
    kept = [c for c in raw.columns if c == FILE]
    return raw.select(
        *[name(f.name) for f in contract.read_schema("csv").fields], name(CORRUPT).alias(RESCUED), *kept
    )


def parquet_misfits(spark: SparkSession, paths: list[str], contract: Contract) -> list[str]:
    """Columns of these files that the contract does not declare with that type."""
    declared = {f.name: f.dataType for f in contract.read_schema("parquet").fields}
    try:
        merged = spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError):
        return ["(conflicting file schemas)"]
    return [f.name for f in merged.fields if declared.get(f.name) != f.dataType]


def footers(spark: SparkSession, paths: Iterable[str]) -> dict[str, list[str]]:
    """Files by the schema in their footer, as Parquet writes it. One footer is read per file, by the driver."""
    jvm, conf, groups = spark._jvm, spark._jsc.hadoopConfiguration(), {}
    for path in paths:
        try:
            footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(conf, jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)))
        except Py4JJavaError:
            raise DataRejected("A Parquet file has no readable footer") from None
        groups.setdefault(footer.getFileMetaData().getSchema().toString(), []).append(path)
    return groups


def rescue_parquet(spark: SparkSession, paths: Iterable[str], contract: Contract) -> DataFrame:
    """Parquet files of any schemas. Columns that the contract declares with the file's type are read as they are. Values of
    undeclared columns, and of declared ones with another type, are kept as a JSON object in ``_rescued_data``.

    The usual case, where all files together have the declared columns, is one scan. Otherwise files are grouped by their footers, and
    each group is read with its own schema, so that nothing is reinterpreted or refused because of other files.
    """
    paths, schema = list(paths), contract.read_schema("parquet")
    nothing = F.lit(None).cast("string").alias(RESCUED)
    if not paths or not parquet_misfits(spark, paths, contract):
        read = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
        return read.select(*[name(f.name) for f in schema.fields], nothing)
    declared, out = {f.name: f.dataType for f in schema.fields}, None
    for group in footers(spark, paths).values():
        shape = spark.read.parquet(group[0]).schema
        own = {f.name: f.dataType for f in shape.fields}
        extra = [c for c, kind in own.items() if declared.get(c) != kind]
        found = functools.reduce(lambda a, b: a | b, (name(c).isNotNull() for c in extra), F.lit(False))
        kept = F.when(found, F.to_json(F.struct(*[name(c) for c in extra]))).alias(RESCUED) if extra else nothing
        typed = [name(c) if own.get(c) == kind else F.lit(None).cast(kind).alias(c) for c, kind in declared.items()]
        part = spark.read.schema(shape).parquet(*group).select(*typed, kept)
        out = part if out is None else out.unionByName(part)
    return out


def _load(source, fmt: str, path: str, contract: Contract, options: Mapping, with_file: bool) -> DataFrame:
    options = dict(options)
    if fmt == "json":
        if options.pop("multiLine", False):
            loaded = source.format("json").option("multiLine", True).option("singleVariantColumn", "__cf_v").load(path)
            # A document is one record or an array of records.
            records = F.coalesce(F.col("__cf_v").try_cast("array<variant>"), F.array("__cf_v"))
            loaded = loaded.select(F.explode(records).alias("__cf_v"), *_file(with_file))
            loaded = loaded.select(F.to_json("__cf_v").alias("value"), *_file(with_file))
        else:
            loaded = source.format("text").load(path).select("value", *_file(with_file))
        return rescue_json(loaded, contract)
    schema = contract.read_schema(fmt)
    if fmt == "csv":
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
        loaded = source.format("csv").schema(schema).options(**options).option("mode", "PERMISSIVE")
        loaded = loaded.option("columnNameOfCorruptRecord", CORRUPT).load(path).select("*", *_file(with_file))
        return rescue_csv(loaded, contract)
    loaded = source.format("parquet").schema(schema).load(path).select("*", *_file(with_file))
    return loaded.withColumn(RESCUED, F.lit(None).cast("string"))


def _file(wanted: bool) -> list:
    return [F.col("_metadata.file_path").alias(FILE)] if wanted else []


def read_files(spark: SparkSession, path: str, contract: Contract, fmt: str, options: Mapping | None = None) -> DataFrame:
    """Source columns and ``_rescued_data`` of a batch of files."""
    if fmt == "parquet":
        found = spark.read.schema(contract.read_schema(fmt)).parquet(path).inputFiles()
        return rescue_parquet(spark, found, contract)
    return _load(spark.read, fmt, path, contract, options or {}, with_file=False)


def stream_files(
    spark: SparkSession,
    path: str,
    contract: Contract,
    fmt: str,
    options: Mapping | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """A stream that reads each immutable file once."""
    require(
        fmt != "parquet" or not any(c.temporal for c in contract.columns),
        "Streamed Parquet with DATE or TIMESTAMP columns needs a per-file policy; deliver snapshots or text",
    )
    source = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return _load(source, fmt, path, contract, options or {}, with_file=fmt == "parquet")


# --- folders ---------------------------------------------------------------------------------


def read_folder(spark: SparkSession, path: str, contract: Contract, fmt: str, row_tag: str | None = None) -> DataFrame:
    """Files of many formats read with the contract's types; undeclared fields are not read."""
    require(fmt in FOLDER_FORMATS, f"Unsupported folder format {fmt}")
    if fmt == "text":
        only = contract.columns
        require(len(only) == 1 and only[0].type.upper() == "STRING", "Text files have one STRING column")
        return spark.read.text(path).select(F.col("value").alias(only[0].output))
    reader = spark.read.format(fmt).schema(contract.read_schema(fmt))
    if fmt == "csv":
        reader = reader.options(header=True, sep=",", enforceSchema=False)
    if fmt == "xml":
        require(row_tag, "XML needs the row tag")
        reader = reader.option("rowTag", row_tag)
    if fmt in ("csv", "json", "xml"):
        reader = reader.option("mode", "FAILFAST")
    try:
        loaded = reader.load(path)
    except PySparkException as error:
        if fmt == "avro":
            raise ContractError("Reading Avro needs the spark-avro package in the session") from error
        raise
    columns = []
    for column in contract.columns:
        value = name(column.name)
        if column.temporal and fmt in ("csv", "json", "xml"):
            value = temporal.parse_or_fail(value, column.type)
        columns.append(value.alias(column.output))
    return loaded.select(*columns)
