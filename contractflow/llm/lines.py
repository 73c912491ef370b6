"""Fuzzy line deduplication: MinHash of character shingles, banding, exact Jaccard, union-find, one line per component.

Lines are compared lower-cased and with single spaces. Equal lines are one class, however short they are. A class of at least a
shingle has a MinHash signature of its character shingles; classes that agree in a band and whose sketches do not rule it out are
candidates, whose shingle sets are compared exactly. Of a component of similar lines, the first occurrence stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, chunks, discard, map_batches, mix, shared_folder, stored
from .components import components
from .keyed import GROUP_ELEMENTS, candidate_groups, crowd_links, nearby, placed, stars, verified

SIMILARITY = 80
#: Short enough that a changed character leaves 0.8 of a line of 39 characters.
SHINGLE = 4
#: Lines with fewer characters (code points, after normalising) are blank and always stay.
LEAST = 1
#: 34 bands of 8 rows: a pair of similarity 0.8 shares a band with probability 0.997 (simulated, for 5 to 300 shingles), one of 0.9 nearly always, one of
#: 0.15 in 1e-5 of cases.
BANDS = 34
ROWS = 8
VALUES = BANDS * ROWS
#: A value of a signature that no shingle has competed for.
EMPTY = np.uint32(0xFFFFFFFF)
#: Lines that are signed at a time: so many fit into the processor's caches.
LINES = 250
#: Of those with few shingles, so many.
THIN = 64
#: Band keys of at most so many classes give all pairs; those of more are crowds, whose members are compared by key. Sketches rule out either.
FEW = 8
SEED = 5
#: Columns of a class's sketch: one bit of each of the first values of its signature.
SKETCH = [f"sketch{i}" for i in range(VALUES // 64)]
#: Places of candidate lines, and documents that lose lines, that may be broadcast (some 100 bytes each); beyond, the joins shuffle.
BROADCAST_ROWS = 200_000
#: Links (two numbers each) that may be broadcast.
BROADCAST_LINKS = 1_000_000


def normal(line: str) -> str:
    """Lower-cased, with single spaces; a line shorter than a shingle is filled up to one, so it is like its equals only."""
    found = " ".join(line.lower().split())
    return found.ljust(SHINGLE) if found else found


def gram_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of lines joined by line ends, with each line's first and last-plus-one shingle."""
    points = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    begins = np.cumsum(lengths + 1) - lengths - 1
    base, width = 0x9E3779B97F4A7C15, 1
    with np.errstate(over="ignore"):
        while width < SHINGLE:  # from runs of w to runs of 2w
            points = points[:-width] * np.uint64(pow(base, width, 1 << 64)) + points[width:]
            width *= 2
        return mix(points), begins, begins + lengths - SHINGLE + 1


@cache
def draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each value of a signature: the values in the order in which it asks them (a row for each turn), each one's turn, a factor of its bit."""
    rng = np.random.default_rng(SEED)
    order = np.argsort(rng.random((VALUES, VALUES)), axis=1)
    turns = np.empty((VALUES, VALUES), np.uint16)
    np.put_along_axis(turns, order, np.broadcast_to(np.arange(VALUES, dtype=np.uint16), (VALUES, VALUES)), axis=1)
    return np.ascontiguousarray(order.T), np.ascontiguousarray(turns.T), rng.integers(0, 1 << 31, VALUES, np.uint32) * np.uint32(2) + np.uint32(1)


def filled(cells: np.ndarray, order: np.ndarray, turns: np.ndarray) -> None:
    """Give every empty value of a signature that of the first in its own order that is not empty; two lines agree there as often as elsewhere."""
    there = cells != EMPTY
    thin = np.nonzero(there.sum(axis=1) < VALUES // 4)[0]
    own = cells.copy()
    for some in (thin[i : i + THIN] for i in range(0, len(thin), THIN)):  # the few that are there, at once
        row, at = np.nonzero(there[some])
        first = np.minimum.reduceat(turns[at], np.searchsorted(row, np.arange(len(some))), axis=0)
        source = np.take_along_axis(own[some], order[first, np.arange(VALUES)], axis=1)
        cells[some] = np.where(there[some], own[some], source)
    flat, own, turn = cells.reshape(-1), own.reshape(-1), 0
    left = np.nonzero(flat == EMPTY)[0]
    value = left % VALUES
    while len(left):
        found = own[left - value + order[turn][value]]
        flat[left] = found
        still = found == EMPTY
        left, value, turn = left[still], value[still], turn + 1


def signatures(lines: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The band keys of normal lines, and sketches: a bit of each of the first values of the signature. Those filled up to a shingle have no keys.

    A shingle's hash is taken once: it says which value of the signature the shingle competes for, and the least one wins. Values for which
    no shingle competes are taken over from others.
    """
    long = [i for i, line in enumerate(lines) if line[-1] != " "]
    out, sketches = [b""] * len(lines), np.zeros((len(lines), len(SKETCH)), np.int64)
    order, turns, factors = draws()
    bits, low = 64 * len(SKETCH), np.uint64(0xFFFFFFFF)
    for some in (long[i : i + LINES] for i in range(0, len(long), LINES)):
        grams, begins, ends = gram_hashes([lines[i] for i in some])
        sizes = ends - begins
        grams = grams[np.arange(sizes.sum()) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes)]
        value = ((grams & low) * np.uint64(VALUES) >> np.uint64(32)).astype(np.int64)
        cells = np.full(len(some) * VALUES, EMPTY, np.uint32)
        np.minimum.at(cells, np.repeat(np.arange(len(some)) * VALUES, sizes) + value, np.minimum((grams >> np.uint64(32)).astype(np.uint32), EMPTY - np.uint32(1)))
        cells = cells.reshape(-1, VALUES)
        filled(cells, order, turns)
        drawn = (cells[:, :bits] * factors[:bits] >> np.uint32(31)).astype(np.uint8)
        sketches[some] = np.packbits(drawn, axis=1).view(np.int64)
        bands, keys = cells.reshape(-1, BANDS, ROWS), np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(some), BANDS))
        with np.errstate(over="ignore"):
            for i in range(ROWS):
                keys = mix(keys * np.uint64(31) + bands[:, :, i])
        for i, row in zip(some, (keys >> np.uint64(32)).astype(np.uint32), strict=True):  # sketches rule out what meets by the shortness
            out[i] = row.tobytes()
    return out, sketches


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of normalised lines."""
    grams, begins, ends = gram_hashes([t.decode() for t in texts])
    return [np.unique(grams[a:b]) for a, b in zip(begins, ends, strict=True)]


def links(percent: int):
    def linked(a: np.ndarray, b: np.ndarray) -> bool:
        shared = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
        return 100 * shared >= percent * (len(a) + len(b) - shared)

    apart = lambda sizes: (100 - percent) * sizes // (100 + percent)
    return linked, nearby(lambda sizes, size: apart(sizes + size), lambda most: apart(2 * most))


def signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Every line that is not blank: line (16-byte hash), key, mark (of the text), at (number of the line).

    The first row of a line in a stretch of documents has its times there, chars, keys (of its bands) and sketch (in several numbers); the
    others have none of them, and times 0.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for first, texts in chunks(batch.column(2).to_pylist()):
            found: dict[bytes, list] = {}
            row, at, hashes = [], [], []  # of the others
            for i, value in enumerate(texts, first):
                for n, line in full_lines(value):
                    known = found.get(digest := line_hash(line))
                    if known is None:
                        found[digest] = [i, n, 1, line]
                        continue
                    known[2] += 1
                    here, there = ((keys[x] is None, keys[x] or 0, marks[x], y) for x, y in ((i, n), known[:2]))
                    other = (i, n)
                    if here < there:
                        other, known[:2] = tuple(known[:2]), (i, n)
                    row.append(other[0])
                    at.append(other[1])
                    hashes.append(digest)
            some, rest = list(found.values()), len(row)
            keys_of, sketches = signatures([x[3] for x in some])
            rows = pa.array([x[0] for x in some] + row, pa.int64())
            columns = [pa.array([*found, *hashes], pa.binary()), batch.column(0).take(rows), batch.column(1).take(rows), pa.array([x[1] for x in some] + at, pa.int32())]
            columns += [pa.array([x[2] for x in some] + [0] * rest, pa.int64()), pa.array([len(x[3]) for x in some] + [0] * rest, pa.int32()), pa.array(keys_of + [b""] * rest, pa.binary())]
            columns += [pa.array(np.concatenate((c, np.zeros(rest, np.int64)))) for c in sketches.T]
            yield pa.RecordBatch.from_arrays(columns, names=["line", "key", "mark", "at", "times", "chars", "keys", *SKETCH])

    kind = docs.schema[key].dataType.simpleString()
    return map_batches(marked(docs, key, text), work, f"line binary, key {kind}, mark long, at int, times long, chars int, keys binary, " + ", ".join(f"{s} long" for s in SKETCH), last=True)


def marked(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), text)


def full_lines(text: str) -> Iterator[tuple[int, str]]:
    """Numbers and normal forms of the lines that are not blank."""
    for n, line in enumerate(text.split("\n")):
        if len(line := normal(line)) >= LEAST:
            yield n, line


def line_hash(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def line_texts(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """class, group, places, set (the normalised line) of wanted classes, from their first occurrences (key, mark, at)."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        asked = batch.column(1).to_pylist()
        found = []
        for value, numbers in zip(batch.column(0).to_pylist(), asked, strict=True):
            split = value.split("\n")
            found.append([normal(split[n]) for n in numbers])
        owner = pa.array(np.repeat(np.arange(len(found)), list(map(len, found))))
        at = pa.array([n for some in asked for n in some], pa.int32())
        texts = pa.array([line.encode("utf-8", "surrogatepass") for some in found for line in some], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(2).take(owner), batch.column(3).take(owner), at, texts], names=["key", "mark", "at", "set"])

    few = wanted.count() <= BROADCAST_ROWS
    small = F.broadcast if few else lambda frame: frame
    asked = checkpoint(wanted.groupBy("key", "mark").agg(F.sort_array(F.collect_set("at")).alias("asked")))
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("m"), text)
    same = F.col("k").eqNullSafe(F.col("key")) & (F.col("m") == F.col("mark"))
    kind = docs.schema[key].dataType.simpleString()
    found = map_batches(rows.join(small(asked), same).select(text, "asked", "key", "mark"), work, f"key {kind}, mark long, at int, set binary", last=True)
    known = wanted.select(F.col("key").alias("k"), F.col("mark").alias("m"), F.col("at").alias("a"), "class", "group", "places")
    same = F.col("k").eqNullSafe(F.col("key")) & (F.col("m") == F.col("mark")) & (F.col("a") == F.col("at"))
    return found.join(small(known), same).select("class", "group", "places", "set")


def candidates(shared: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect classes which share a band key (``shared``: the stars of their keys), but for pairs whose sketches differ too much.

    A bit differs with half the probability of its value, which is one less the similarity. A similar pair is ruled out only if so many
    bits differ that it is four standard deviations off (less than one pair in 1,000). Nearly all chance pairs are, so they do not tie groups together.
    """
    values, far = 64 * len(SKETCH), (100 - percent) / 200
    limit = int(values * far + 4 * (values * far * (1 - far)) ** 0.5)
    pairs = shared.where(~F.col("star")).select("a", "b")
    small = F.broadcast if pairs.count() <= BROADCAST_LINKS // 4 else lambda frame: frame
    sketch = lambda name, mark: sketches.select(F.col("class").alias(name), *[F.col(s).alias(mark + s) for s in SKETCH])
    both = sketch("b", "y").join(small(sketch("a", "x").join(small(pairs), "a")), "b")
    differ = sum((F.bit_count(F.col("x" + s).bitwiseXOR(F.col("y" + s))) for s in SKETCH), F.lit(0))
    crowds = shared.where("star").select(F.col("a").alias("key"), F.col("b").alias("class"))
    return both.where(differ <= limit).select("a", "b").unionByName(crowd_links(crowds, sketches, SKETCH, limit))


def similar_lines(docs: DataFrame, key: str, text: str, percent: int, elements: int, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All lines (line, key, mark, at), the different ones (class, line, first, times, chars), and node, root of the components of similar ones.

    What it stores is in the folder.
    """
    spark = docs.sparkSession
    lines = stored(signed(docs, key, text).withColumn("class", F.monotonically_increasing_id()), f"{folder}/signed")
    place = F.struct(F.col("key").isNull().alias("none"), "key", "mark", "at", "class")
    classes = lines.groupBy("line").agg(F.min(place).alias("first"), F.sum("times").alias("times"), F.max("chars").alias("chars"))
    classes = stored(classes.withColumn("class", F.col("first.class")), f"{folder}/classes")
    # A line that several stretches have was signed in each; one of them stands for all.
    first = lines.where("times > 0")
    again = checkpoint(first.select("class").join(classes.select("class"), "class", "left_anti"))
    small = F.broadcast if again.count() <= BROADCAST_LINKS else lambda frame: frame
    once = first.join(small(again), "class", "left_anti").select("class", "keys")
    shared = stored(stars(once, few=FEW, short=BANDS, crowds=True).distinct(), f"{folder}/shared")
    lines = stored(lines.select("line", "key", "mark", "at", "class", *SKETCH), f"{folder}/lines")
    discard(spark, f"{folder}/signed")  # nothing reads the keys any more
    groups = checkpoint(candidate_groups(candidates(shared, lines, percent)))
    small = F.broadcast if groups.count() <= BROADCAST_LINKS else lambda frame: frame
    wanted = placed(classes.join(small(groups), "class").select("class", "group", F.col("chars").alias("n"), "first.key", "first.mark", "first.at"), elements)
    return lines, classes, components(verified(line_texts(docs, wanted, key, text), *links(percent), shingle_sets))


def removals(docs: DataFrame, key: str, text: str, percent: int, elements: int, folder: str) -> DataFrame:
    """Lines to remove, by document: key, mark, gone (numbers of lines), kept_in (keys of the documents that keep such lines)."""
    lines, classes, found = similar_lines(docs, key, text, percent, elements, folder)
    found = checkpoint(found.unionByName(found.select(F.col("root").alias("node"), "root").distinct()))
    small = F.broadcast if found.count() <= BROADCAST_LINKS else lambda frame: frame
    # Most lines stand once and are like no other: only the rest is looked at further.
    rooted = classes.select("class", "line", "first", "times").join(small(found.withColumnRenamed("node", "class")), "class", "left")
    rooted = rooted.where(F.col("root").isNotNull() | (F.col("times") > 1)).withColumn("root", F.coalesce("root", "class"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("kept"))
    decided = checkpoint(rooted.select("line", "root").join(kept, "root").select("line", "kept"))
    gone = lines.select("line", "key", "mark", "at").join(decided, "line")
    here = F.col("key").eqNullSafe(F.col("kept.key")) & (F.col("mark") == F.col("kept.mark")) & (F.col("at") == F.col("kept.at"))
    return gone.where(~here).groupBy("key", "mark").agg(F.sort_array(F.collect_set("at")).alias("gone"), F.sort_array(F.collect_set("kept.key")).alias("kept_in"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = SIMILARITY, elements: int = GROUP_ELEMENTS) -> DataFrame:
    """All documents with one line of each component of similar lines left in ``text``, and ``n_lines``, ``n_removed``, ``kept_in``.

    All columns of the input stay. Lines are what line feeds separate; blank ones and a null text
    stay as they are. Equal lines of any length are copies. The line that stays is the first by key (nulls last), text mark and number, so reruns agree. Rows equal in
    key and text count as one document and keep the same lines. An empty table gives no rows. Similar means a Jaccard similarity of the
    character shingles of at least ``percent`` hundredths; a line shorter than a shingle is only like its equals.
    """
    folder = f"{shared_folder(docs.sparkSession).rstrip('/')}/lines-{uuid.uuid4().hex}"
    try:
        gone = checkpoint(removals(docs, key, text, percent, elements, folder))
    finally:
        discard(docs.sparkSession, folder)
    few = gone.count() <= BROADCAST_ROWS
    gone = gone.select(*[F.col(c).alias(f"__llm_{c}") for c in ("key", "mark", "gone", "kept_in")])
    same = F.col(key).eqNullSafe(F.col("__llm_key")) & (F.xxhash64(text) == F.col("__llm_mark"))
    joined, lines = docs.join(F.broadcast(gone) if few else gone, same, "left"), F.split(F.col(text), "\n")
    left = F.concat_ws("\n", F.filter(lines, lambda _, i: ~F.array_contains("__llm_gone", i)))
    new = F.when(F.col("__llm_gone").isNull(), F.col(text)).otherwise(left)
    counts = {"n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"), "n_removed": F.coalesce(F.size("__llm_gone"), F.lit(0)).cast("long"), "kept_in": F.col("__llm_kept_in")}
    names = [F.col(c) if c != text else new.alias(text) for c in docs.columns if c not in counts]
    return joined.select(*names, *[c.alias(n) for n, c in counts.items()])
