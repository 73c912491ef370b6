"""Helpers that several operators share: Arrow batches of documents, hashed words, row counts."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint, shared_folder  # noqa: F401  (shared by the operators)

#: Code units of text that a Python task handles at a time; longer texts are handled one by one, whole.
CHUNK = 4_000_000
#: White space between words, as the contracts define it.
BLANKS = r"[\x20\x09-\x0D]+"
#: Bytes, about, that a Python worker may remember of words between batches.
WORD_BYTES = 48 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, path: str) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it back: smaller than a checkpoint, read by columns, and gone when it is discarded."""
    frame.write.option("parquet.enable.dictionary", "false").parquet(path)  # hashes and ids hardly repeat
    return frame.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of this run, on whatever filesystem it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def words_in(text: Column) -> Column:
    """Number of words of a text (null: none), without building them."""
    blank = "\x20\x09\x0a\x0b\x0c\x0d"
    spaced = F.translate(F.coalesce(text, F.lit("")), blank, " " * 6)
    squeezed = F.regexp_replace(F.trim(spaced), " +", " ")
    return F.when(squeezed == "", F.lit(0)).otherwise(F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "), F.lit(""))) + 1).cast("long")


class Memory(dict):
    """What a Python worker remembers between batches, emptied when it is about so many bytes. A worker serves tasks of many operators
    in turn: a task first empties the memories of the others.
    """

    every: list[Memory] = []

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.held = limit, 0
        Memory.every.append(self)

    def clear(self) -> None:
        super().clear()
        self.held = 0

    def grown(self, size: int) -> bool:
        """Count what is about to be added (with the dictionary's own cost); whether everything before had to go."""
        self.held += size + 120
        full = self.held > self.limit
        if full:
            self.clear()
        return full

    @classmethod
    def leave(cls, kept: str) -> None:
        for memory in cls.every:
            if type(memory).__name__ != kept:
                memory.clear()


def release() -> None:
    """Give back what a Python worker holds and no longer needs, lest idle workers keep it while other stages run."""
    Memory.leave("")
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def map_batches(frame: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema, memory: str = "", last: bool = False) -> DataFrame:
    """Apply ``work`` to the Arrow batches that have rows; it yields batches of the schema. ``memory`` names the kind of memory that it
    uses; with ``last``, a task gives its memory back at its end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Memory.leave(memory)
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)
        if last:
            release()

    return frame.mapInArrow(run, schema)


def chunks(texts: Iterable[str | None], limit: int = CHUNK) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts (null: empty) together no longer than the limit, with the first one's position."""
    held, first, total = [], 0, 0
    for i, text in enumerate(texts):
        text = text or ""
        if held and total + len(text) > limit:
            yield first, held
            held, first, total = [], i, 0
        held.append(text)
        total += len(text)
    if held:
        yield first, held


class Words(Memory):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        self.grown(len(word))
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the lower-cased words of a text, in order. Only A-Z are lower-cased; words end at ASCII white space."""
        parts = (text or "").encode().lower().split()
        return np.fromiter(map(self.__getitem__, parts), np.uint64, len(parts))


WORDS = Words(WORD_BYTES)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = mix(out + words[i : i + n]) + np.uint64(i + 1)
    return np.unique(out)


def fingerprint(values: np.ndarray) -> bytes:
    """Sixteen bytes that stand for a whole array."""
    return hashlib.blake2b(np.ascontiguousarray(values).tobytes(), digest_size=16).digest()


def squeeze(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def expand(packed: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(kind).ravel()


def rising(values: np.ndarray) -> np.ndarray:
    """Differences of sorted numbers, which squeeze better; ``np.cumsum`` undoes it."""
    return np.diff(values, prepend=values.dtype.type(0))


def spread(total: int, each: int) -> int:
    """How many parts of about ``each`` rows hold ``total`` rows."""
    return max(1, -(-total // each))
