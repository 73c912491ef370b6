"""Importance resampling towards a target distribution: hashed n-gram counts of both sides, weights, and draws without replacement.

Features fall into buckets by their CRC-32. The different features of a stretch of text are grouped by equal length into matrices of
bytes; each matrix is a column of checksums updated byte position by byte position, and the buckets are scattered back to the places
of the features. The logarithm of target over source frequency is a bucket's gain; a document's weight is its features' mean gain.
Gumbel noise on the weights makes the highest scores a draw without replacement, one that is fixed by the seed and the keys.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, map_batches

LONGEST = 1
BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
#: Bytes of text whose features are looked at together; longer texts are taken piece by piece.
PIECE = 1 << 20
LONG = 1 << 10
_CRC = 0xEDB88320
#: A-Z become a-z, all else below 128 but letters and digits a space; other bytes stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def crc_table() -> np.ndarray:
    """What one byte does to a checksum, for all 256 of them."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_CRC), table >> 1)
    return table


_TABLE = crc_table()


def crc32_all(features: list[bytes]) -> np.ndarray:
    """The CRC-32 of every feature: one matrix per length, updated column by column.

    Features of more than ``LONG`` bytes hardly share a length; a matrix of one row gains nothing, so each is read by itself.
    """
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    out = np.zeros(len(features), np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.concatenate(([0], np.nonzero(np.diff(lengths[order]))[0] + 1, [len(order)])) if len(order) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        rows = order[a:b]
        if lengths[rows[0]] > LONG:
            out[rows] = [zlib.crc32(features[i]) for i in rows]
            continue
        matrix = np.frombuffer(b"".join(map(features.__getitem__, rows.tolist())), np.uint8).reshape(len(rows), -1)
        state = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in matrix.T:
            state = _TABLE[(state ^ column) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
        out[rows] = ~state
    return out


def pieces(text: str | None, longest: int, limit: int = PIECE) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text, piece by piece, and how many of a piece's first words belong to the piece before (for runs that reach over)."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    held: list[bytes] = []
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + limit)
        end = len(raw) if end < 0 else end
        words = raw[at:end].split()
        yield held + words, len(held)
        held = (held + words)[-(longest - 1) :] if longest > 1 else []
        at = end


def features(words: list[bytes], before: int, longest: int) -> list[bytes]:
    """Runs of 1 to ``longest`` words that end behind the first ``before`` ones."""
    found = words[before:]
    for size in range(2, longest + 1):
        found = found + [b" ".join(words[i - size + 1 : i + 1]) for i in range(max(before, size - 1), len(words))]
    return found


def bucketed(texts: list[str | None], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For stretches of texts: the number of the text and the bucket of every feature; and the texts' words, as (text, words) rows."""

    def stretches() -> Iterator[list[tuple[int, list[bytes], int]]]:
        held: list[tuple[int, list[bytes], int]] = []
        total = 0
        for i, text in enumerate(texts):
            for words, before in pieces(text, longest):
                held.append((i, words, before))
                total += len(words)
                if total >= PIECE // 4:
                    yield held
                    held, total = [], 0
        if held:
            yield held

    for held in stretches():
        runs = [features(words, before, longest) for _, words, before in held]
        different = list(set(chain.from_iterable(runs)))
        place = dict(zip(different, (crc32_all(different) % np.uint32(buckets)).tolist(), strict=True))
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        found = np.fromiter(map(place.__getitem__, chain.from_iterable(runs)), np.int64, int(sizes.sum()))
        owner = np.fromiter((i for i, _, _ in held), np.int64, len(held))
        words = np.fromiter((len(words) - before for _, words, before in held), np.int64, len(held))
        yield np.repeat(owner, sizes), found, np.stack((owner, words), axis=1)


def bucket_counts(docs: DataFrame, text: str, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """How many features fall into each bucket: bucket, n. Each task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found, _ in bucketed(batch.column(0).to_pylist(), longest, buckets):
                counts += np.bincount(found, minlength=buckets)
        some = np.nonzero(counts)[0]
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    return docs.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Gains:
    """Gain of every bucket, in thousandths, floored."""

    values: tuple[int, ...]

    @classmethod
    def of(cls, source: np.ndarray, target: np.ndarray) -> Gains:
        s, t, buckets = int(source.sum()), int(target.sum()), len(source)
        ratio = lambda a, b: ((b + 1) * (s + buckets)) / ((a + 1) * (t + buckets))
        return cls(tuple(math.floor(1000 * math.log(ratio(int(a), int(b)))) for a, b in zip(source, target, strict=True)))


def learn(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> Gains:
    """Gains from all texts of both sides. One number per bucket reaches the driver, however large the tables are."""

    def counts(frame: DataFrame, column: str) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for row in bucket_counts(frame, column, longest, buckets).collect():
            out[row.bucket] = row.n
        return out

    return Gains.of(counts(docs, text), counts(target, target_text))


def noise(key: object, seed: int) -> int:
    """Gumbel noise in thousandths, from the seed and the key (null: the empty text)."""
    head = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((head + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gains: Gains, key: str = "doc_id", text: str = "text", longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """Every row's key, n_words, n_features, weight (floored mean gain; without features 0) and score (with noise)."""
    sent = docs.sparkSession.sparkContext.broadcast(np.array(gains.values, np.int64))  # one number per bucket

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        gain, rows = sent.value, batch.num_rows
        words, number, total = (np.zeros(rows, np.int64) for _ in range(3))
        for owner, found, sizes in bucketed(batch.column(1).to_pylist(), longest, len(gain)):
            number += np.bincount(owner, minlength=rows)
            np.add.at(words, sizes[:, 0], sizes[:, 1])
            cuts = np.concatenate(([0], np.nonzero(np.diff(owner))[0] + 1)) if len(owner) else np.zeros(0, np.int64)
            if len(cuts):
                np.add.at(total, owner[cuts], np.add.reduceat(gain[found], cuts))
        weight = np.where(number > 0, total // np.maximum(number, 1), 0)
        score = weight + np.fromiter((noise(k, seed) for k in batch.column(0).to_pylist()), np.int64, rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, number, weight, score))], names=[key, "n_words", "n_features", "weight", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return map_batches(docs.select(key, text), work, f"`{key}` {kind}, n_words long, n_features long, weight long, score long")


def ranked(scored: DataFrame, key: str, drawn: int) -> DataFrame:
    """The rows of the ``drawn`` highest scores with their ``rank`` (from 1), ties by smaller key, nulls last.

    Scores are whole thousandths in a fixed range, so a count per score is small; it gives the least score that is drawn, and
    only rows of at least that are ordered, over as many tasks as Spark's range partitioning makes. A running number
    cuts rows that are equal in everything, so that not even they meet in one task.
    """
    by_score = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    counts = scored.groupBy("score").agg(F.count(F.lit(1)).alias("_n")).withColumn("_upto", F.sum("_n").over(by_score))
    least = counts.where(F.col("_upto") >= drawn).agg(F.max("score")).first()[0]
    if not drawn or least is None:
        return scored.where("false").withColumn("rank", F.lit(None).cast("long"))
    order = [F.col("score").desc(), F.col(key).asc_nulls_last(), "n_features", "_row"]
    placed = scored.where(F.col("score") >= least).withColumn("_row", F.monotonically_increasing_id()).orderBy(*order)
    placed = checkpoint(placed.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per task
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_at") + 1
    return placed.join(F.broadcast(parts), "_part").select(*scored.columns, F.when(rank <= drawn, rank).alias("rank"), F.lit(least).alias("_least")).drop("_least")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS,
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """Every document's key, n_features, weight, score and rank in the draw (null: not drawn).

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred (rounded down) with the highest scores are drawn.
    A null or empty text has no features and weight 0, and is drawn only if ``least_words`` is 0. Repeated rows are documents of
    their own with equal scores and ranks in a row; a null key draws like an empty text and comes last among ties. Without target
    texts all gains follow from the source alone. An empty table gives no rows. Other columns are not read.
    """
    gains = learn(docs, target, text, target_text, longest, buckets)
    scored = checkpoint(weighed(docs, gains, key, text, longest, seed))
    able = F.col("n_words") >= least_words
    fit = scored.where(able)
    drawn = fit.count() * percent // 100
    found = ranked(fit, key, drawn)
    least = found.agg(F.min("score")).first()[0]
    below = ~able if least is None else ~able | (F.col("score") < least)
    rest = scored if least is None else scored.where(below)
    both = found.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))
    return both.select(key, "n_features", "weight", "score", "rank")


#: CRC-32 of a column of hexadecimal bytes, bit by bit, and the words of a text.
_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = rf"""
WITH steps AS (
    SELECT list(c ORDER BY b) AS step FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {_CRC}::BIGINT) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS b))
), source AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, {_SQL_WORDS} AS words FROM documents
), source_words AS MATERIALIZED (
    SELECT row, unnest(words) AS word FROM source
), target_words AS MATERIALIZED (
    SELECT unnest({_SQL_WORDS}) AS word FROM benchmark
), buckets AS MATERIALIZED (
    SELECT word, xor(list_reduce(list_prepend({0xFFFFFFFF}::BIGINT, list_transform(range(length(hex(encode(word))) // 2), lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::BIGINT, 2))::BIGINT)),
        lambda c, b: xor(step[(xor(c, b) & 255) + 1], c >> 8)), {0xFFFFFFFF}::BIGINT) % {BUCKETS} AS bucket
    FROM (SELECT word FROM source_words UNION SELECT word FROM target_words), steps
), s AS (
    SELECT bucket, count(*) AS n FROM source_words JOIN buckets USING (word) GROUP BY bucket
), t AS (
    SELECT bucket, count(*) AS n FROM target_words JOIN buckets USING (word) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM source_words) + {BUCKETS})) / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM target_words) + {BUCKETS}))))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket)
), sums AS (
    SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS total FROM source_words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY row
), scored AS (
    SELECT row, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
        floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
    FROM source LEFT JOIN sums USING (row)
), ranks AS (
    SELECT row, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS rank FROM scored WHERE n_words >= {LEAST_WORDS}
)
SELECT doc_id, n_features, weight, weight + noise AS score,
    CASE WHEN rank <= (SELECT count(*) FROM scored WHERE n_words >= {LEAST_WORDS}) * {PERCENT} // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranks USING (row)
"""
