"""N-gram Jaccard join by parity sketches.

Words are XOR-hashed into sketches of 64-bit chunks: a shingle changes one chunk, so two documents whose sets differ in D
shingles differ in at most D chunks. Within a band of set sizes D is bounded by the least similarity; a sketch has more chunks
than that, so linked documents agree in some chunk (pigeonhole), and chunks are the join's keys. Documents that merely share a
common passage also agree in some chunk; parity sketches, which differ in no more bits than the sets in shingles, rule these pairs
out before groups are formed. Sets are then compared exactly. No link is lost; documents with equal sets are one class from the start.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS, checkpoint, discard, fingerprint, map_batches, mix, shared_folder, shingles, stored
from .components import components
from .keyed import GROUP_ELEMENTS, candidate_groups, crowd_links, folded, narrow, nearby, parity, placed, stars, verified

SIZE = 3
PERCENT = 90
#: Sizes of a band differ by this factor at most. Wide bands need few double entries, narrow ones fewer chunks.
BAND = 1.5
#: Salts that are tried for chunks without too many empty ones.
SALTS = 4
#: Bytes of a key that travel: enough that hardly any meet by their shortness, and sketches rule those out.
KEY_BYTES = 6
#: Keys of a part. A document has hundreds, so packets would be small with less.
KEYS_PER_PART = 500_000
#: Keys of at most so many classes give all pairs; those of more are crowds, whose members are compared by key. Sketches rule out either.
FEW = 8
#: Words of a parity sketch: a power of two, of at least a bit for each shingle within these bounds.
LEAST_WORDS, MOST_WORDS = 4, 2048
#: Pairs whose sketches are compared at a time.
PAIRS = 1000
#: Documents that a join may broadcast (some 100 bytes each); beyond, it shuffles.
BROADCAST_ROWS = 500_000


def apart(percent: int, sizes: int | np.ndarray) -> int | np.ndarray:
    """The largest symmetric difference of two linked sets, given the sum of their sizes."""
    return (100 - percent) * sizes // (100 + percent)


def chunk_count(least: float, allowed: int) -> int:
    """More chunks than differences, with room for those that are empty by chance in the band's smallest set: mean and two deviations."""
    chunks = allowed + 2
    for _ in range(8):
        empty = chunks * math.exp(-least / chunks)
        chunks = allowed + 2 + int(empty + 2 * math.sqrt(empty))
    return chunks


def bands(size: int, percent: int) -> list[tuple[int, int, int]]:
    """Bands (first size, differences allowed, chunks) in which a set of the size looks for partners.

    A pair is looked for in the larger set's band, so a set also enters every higher band that begins near enough.
    """
    first, out = 1, []
    while first * percent <= size * 100:
        after = max(first + 1, int(first * BAND))
        if size < after:
            allowed = apart(percent, 2 * (after - 1))
            if allowed:
                out.append((first, allowed, chunk_count(first * percent / 100, allowed)))
        first = after
    return out


def chunk_keys(found: np.ndarray, percent: int) -> np.ndarray:
    """The keys of a set: its chunks in each of its bands that are not empty.

    Linked sets agree in at least chunks - allowed chunks. If one of them has fewer empty chunks than that, they agree in one that is
    not empty. Else both have many, and both give keys of further chunks, with another salt; after the last salt, of
    the empty ones too. So equally empty chunks do not bring sets together, and no pair is lost.
    """
    out = []
    with np.errstate(over="ignore"):
        for first, allowed, chunks in bands(len(found), percent):
            for salt in range(SALTS):
                salted = mix(found + np.uint64(first * SALTS + salt) * np.uint64(0x9E3779B97F4A7C15))
                where = (salted % np.uint64(chunks)).astype(np.int64)
                order = np.argsort(where, kind="stable")
                begins = np.nonzero(np.diff(where[order], prepend=-1))[0]
                values = np.zeros(chunks, np.uint64)
                values[where[order][begins]] = np.bitwise_xor.reduceat(found[order], begins)
                keys = mix(values ^ mix(np.arange(chunks, dtype=np.uint64) + np.uint64((first * SALTS + salt) << 20)))
                empty = values == 0
                many = empty.sum() >= chunks - allowed
                out.append(keys if many and salt == SALTS - 1 else keys[~empty])
                if not many:
                    break
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def links(percent: int):
    """Whether two sorted sets are linked, and which pairs may be."""

    def linked(a: np.ndarray, b: np.ndarray) -> bool:
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * shared >= percent * (len(a) + len(b) - shared)

    near = nearby(lambda sizes, size: apart(percent, sizes + size), lambda most: apart(percent, 2 * most))
    return linked, near


def sketch(found: np.ndarray) -> bytes:
    """A set's parity sketch, the longer the larger the set is."""
    words = 1 << max(0, len(found) - 1).bit_length() >> 6
    return parity([found], min(MOST_WORDS, max(LEAST_WORDS, words))).tobytes()


def close(percent: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest differences of linked sets of the sizes a and b, and which pairs are not too far apart in size."""
    most = apart(percent, a + b)
    return most, np.abs(a - b) <= most


def near_sketches(percent: int) -> Callable:
    """A ``near`` for ``crowd_links``: sets (n and sketch) that may be linked. Sketches are compared at the shorter one's length."""

    def compare(columns: list[pa.ChunkedArray]) -> Callable:
        sizes, sketches = columns[0].to_numpy(), columns[1]

        def within(a: int, b: int) -> Callable:
            some = sketches.slice(a, b - a).to_pylist()
            own = np.fromiter(map(len, some), np.int64, len(some)) // 8
            order = np.argsort(-own, kind="stable")  # a length is that of the first ones
            row = np.empty(len(some), np.int64)
            row[order] = np.arange(len(some))
            some = [some[i] for i in order]
            laid = {w: folded(some[: int((own >= w).sum())], w) for w in np.unique(own).tolist()}

            def near(at: int, left: np.ndarray) -> np.ndarray:
                most, fine = close(percent, sizes[left], sizes[at])
                words = np.minimum(own[left - a], own[at - a])
                for w in np.unique(words[fine]).tolist():
                    of = np.nonzero(fine & (words == w))[0]
                    fine[of] = np.bitwise_count(laid[w][row[left[of] - a]] ^ laid[w][row[at - a]]).sum(axis=1, dtype=np.int64) <= most[of]
                return fine

            return near

        return within

    return compare


def near_pairs(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that may be linked. ``sketches``: class, n, sketch."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for begin in range(0, batch.num_rows, PAIRS):
            some = batch.slice(begin, PAIRS)
            most, fine = close(percent, some.column(2).to_numpy(), some.column(4).to_numpy())
            at = np.nonzero(fine)[0]
            left, right = ([x[i] for i in at] for x in (some.column(3).to_pylist(), some.column(5).to_pylist()))
            words = np.fromiter((min(len(x), len(y)) for x, y in zip(left, right, strict=True)), np.int64, len(at)) // 8
            for w in np.unique(words).tolist():
                of = np.nonzero(words == w)[0]
                differ = folded([left[i] for i in of], w) ^ folded([right[i] for i in of], w)
                fine[at[of]] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= most[at[of]]
            yield some.select(["a", "b"]).filter(pa.array(fine))

    side = lambda name, mark: sketches.select(F.col("class").alias(name), F.col("n").alias("n" + mark), F.col("sketch").alias("s" + mark))
    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "nx", "sx", "ny", "sy")
    return map_batches(both, work, "a long, b long")


def candidates(shared: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect classes which share a key (``shared``: the stars of their keys), but for pairs whose sketches differ too much.

    Classes that are linked stay connected: their sketches never differ too much. Those that merely share a passage do not tie groups together.
    """
    asked = checkpoint(shared.where(~F.col("star")).select(F.col("a").alias("class")).unionByName(shared.select(F.col("b").alias("class"))).distinct())
    small = F.broadcast if asked.count() <= BROADCAST_ROWS else lambda frame: frame
    some = checkpoint(sketches.join(small(asked), "class", "left_semi"))
    pairs = near_pairs(shared.where(~F.col("star")).select("a", "b"), some, percent)
    crowds = shared.where("star").select(F.col("a").alias("key"), F.col("b").alias("class"))
    return pairs.unionByName(crowd_links(crowds, some, ["n", "sketch"], near_sketches(percent)))


def described(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """Per document: key, mark (a hash of the text), n (set size), print (16 bytes that stand for the set), its keys and its sketch."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n, prints, keys, sketches = [], [], [], []
        for value in batch.column(2):
            found = shingles(WORDS.of(value.as_py()), size)
            n.append(len(found))
            prints.append(fingerprint(found))
            keys.append(narrow(chunk_keys(found, percent), KEY_BYTES))
            sketches.append(sketch(found))
        columns = [pa.array(n, pa.int64()), *(pa.array(x, pa.binary()) for x in (prints, keys, sketches))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["key", "mark", "n", "print", "keys", "sketch"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), text)
    return map_batches(rows, work, f"key {kind}, mark long, n long, print binary, keys binary, sketch binary", "Words", last=True)


def sets_of(docs: DataFrame, wanted: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """class, group, places, set of the wanted representatives (key, mark, class, group, places), from their texts."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [shingles(WORDS.of(v.as_py()), size).tobytes() for v in batch.column(3)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())], names=["class", "group", "places", "set"])

    few = wanted.agg(F.coalesce(F.sum(F.size("places")), F.lit(0)).alias("n")).first().n <= BROADCAST_ROWS
    asked = wanted.select(F.col("key").alias("k"), F.col("mark").alias("m"), "class", "group", "places")
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    same = (F.col("mark") == F.col("m")) & F.col("key").eqNullSafe(F.col("k"))
    chosen = rows.join(F.broadcast(asked) if few else asked, same).select("class", "group", "places", "text")
    kind = wanted.schema["places"].dataType.simpleString()
    return map_batches(chosen, work, f"class long, group long, places {kind}, set binary", "Words", last=True)


def grouped(docs: DataFrame, key: str, text: str, size: int, percent: int, elements: int = GROUP_ELEMENTS) -> DataFrame:
    """Per document: key, mark (a hash of the text), n (set size), component_id."""
    folder = f"{shared_folder(docs.sparkSession).rstrip('/')}/jaccard-{uuid.uuid4().hex}"
    try:
        return checkpoint(named(docs, key, text, size, percent, elements, folder))
    finally:
        discard(docs.sparkSession, folder)


def named(docs: DataFrame, key: str, text: str, size: int, percent: int, elements: int, folder: str) -> DataFrame:
    """What ``grouped`` returns, from tables in the folder."""
    rows = stored(described(docs, key, text, size, percent).withColumn("class", F.monotonically_increasing_id()), f"{folder}/described")
    least = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "mark", "class")).alias("rep")
    classes = rows.where("n > 0").groupBy("print").agg(least, F.first("n").alias("n"))
    classes = stored(classes.select("print", "rep.key", "rep.mark", "n", "rep.class"), f"{folder}/classes")
    # Of documents with equal sets, one stands for all.
    again = checkpoint(rows.where("n > 0").select("class").join(classes.select("class"), "class", "left_anti"))
    small = F.broadcast if again.count() <= BROADCAST_ROWS else lambda frame: frame
    once = rows.where("n > 0").join(small(again), "class", "left_anti").select("class", "keys")
    shared = stored(stars(once, KEYS_PER_PART, few=FEW, crowds=True, width=KEY_BYTES).distinct(), f"{folder}/shared")
    rows = stored(rows.drop("keys"), f"{folder}/rows")
    discard(docs.sparkSession, f"{folder}/described")  # nothing reads the keys any more
    groups = candidate_groups(candidates(shared, rows.select("class", "n", "sketch"), percent))
    wanted = placed(classes.join(groups, "class").drop("print"), elements)
    found = components(verified(sets_of(docs, wanted, key, text, size), *links(percent)))
    rooted = classes.select("class", "print", "key").join(found.withColumnRenamed("node", "class"), "class", "left")
    rooted = rooted.select("print", "key", F.coalesce("root", "class").alias("root"))
    least = rooted.groupBy("root").agg(F.min("key").alias("component_id"))
    ids = rooted.join(least, "root").select("print", "component_id")
    some = rows.where("n > 0").select("print", "key", "mark", "n").join(ids, "print").select("key", "mark", "n", "component_id")
    none = rows.where("n = 0").select("key", "mark", "n", F.col("key").alias("component_id"))
    return some.unionByName(none)


def join_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT, elements: int = GROUP_ELEMENTS) -> DataFrame:
    """Documents with their set size and component: key, n_shingles, component_id.

    Two documents link when 100 * |A and B| >= percent * |A or B| over their distinct word shingles; a component holds what
    links connect, and its id is the smallest key in it. A text without words (null, empty) has an empty set and is linked
    with nothing, so its component is its own key. Every input row gives a row, repeated and null keys too; a null key is never a
    component's id while another key is there. An empty table gives no rows. Only A-Z are lower-cased.
    """
    found = grouped(docs, key, text, size, percent, elements)
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents without those that are linked, by others or not, to one with a smaller key; columns stay as they are.

    Documents without words all stay, and so do those whose component has no key but null. Rows equal in key and text count as one.
    """
    found = grouped(docs, key, text, size, percent)
    goes = ~F.col("key").eqNullSafe(F.col("component_id"))
    told = found.groupBy("key", "mark").agg(F.max(goes).alias("goes"), F.count(F.lit(1)).alias("times")).where("goes or times > 1")
    told = checkpoint(told.select(F.col("key").alias("__llm_key"), F.col("mark").alias("__llm_mark"), "goes"))
    # Most documents stay and stand once: their texts need not move.
    few = F.broadcast if told.count() <= BROADCAST_ROWS else lambda frame: frame
    rows = docs.withColumn("__llm_text", F.xxhash64(text))
    same = F.col(key).eqNullSafe(F.col("__llm_key")) & (F.col("__llm_text") == F.col("__llm_mark"))
    once = rows.join(few(told.drop("goes")), same, "left_anti")
    again = rows.join(few(told.where(~F.col("goes")).drop("goes")), same, "left_semi").dropDuplicates([key, "__llm_text"])
    return once.unionByName(again).drop("__llm_text")
