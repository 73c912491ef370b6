"""Candidates that share a key: packed key exchange, stars of equal keys, and exact pairs within candidate groups.

Keys travel as packed arrays, one row per task batch and part, instead of a row each. Members of a key become a star, never
all pairs. The groups that stars connect hold every pair that shares a key; a group is verified in one task, or, if
its sets are too large for one, block by block. What is returned are enough true links to connect what is linked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, expand, map_batches, release, rising, spread, squeeze
from .components import components

KEYS_PER_PART = 250_000
#: Elements of sets that a task verifies at a time (8 bytes each); larger groups are cut into blocks of half as many.
GROUP_ELEMENTS = 2_000_000
#: Members of crowded keys whose sketches a task compares at a time.
CROWD = 4_000


def narrow(keys: np.ndarray, width: int) -> bytes:
    """The lower ``width`` bytes of 64-bit keys."""
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def widened(raw: bytes, width: int) -> np.ndarray:
    """The keys that ``narrow`` wrote, as 64-bit numbers."""
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view(np.uint64).ravel()


def stars(classes: DataFrame, keys_per_part: int = KEYS_PER_PART, few: int = 0, short: int = 0, crowds: bool = False, width: int = 8) -> DataFrame:
    """Edges (a, b) from the smallest class of every key to the others that have it. ``classes``: class long, keys binary (``width`` bytes each).

    With ``few``, keys of at most so many classes give all their pairs instead, and ``star`` says which edges are not such pairs: a
    pair may be left out again without harm to the others of its key. With ``short``, a class has none or so many keys of 32 bits each,
    which meet only at the same place. With ``crowds``, keys of more than ``few`` classes give no star but all their members: a is the key
    then, b a class.
    """
    width = 4 if short else width
    total = classes.agg(F.coalesce(F.sum(F.octet_length("keys")), F.lit(0)).alias("n")).first().n // width
    parts = spread(total, keys_per_part)

    def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw = batch.column(1).to_pylist()
        sizes = [len(k) // width for k in raw]
        keys = np.frombuffer(b"".join(raw), np.uint32).astype(np.uint64) if short else widened(b"".join(raw), width)
        if short:
            keys |= np.tile(np.arange(short, dtype=np.uint64) << np.uint64(32), len(raw))
        owner = np.repeat(batch.column(0).to_numpy(), sizes)
        order = np.argsort(keys)  # parts are ranges of keys: one sort, and smaller differences
        keys, owner = keys[order], owner[order]
        if short:
            part = ((keys >> np.uint64(8)) * np.uint64(parts) // np.uint64(short << 24)).astype(np.int64)
        else:
            part = ((keys >> np.uint64(8 * width - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(part, np.arange(parts + 1))
        found = np.nonzero(np.diff(cuts))[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array([squeeze(rising(keys[cuts[p] : cuts[p + 1]])) for p in found], pa.binary()), pa.array([squeeze(owner[cuts[p] : cuts[p + 1]]) for p in found], pa.binary())],
            names=["part", "keys", "owners"],
        )

    def meet(rows: pa.Table) -> pa.Table:
        keys = np.concatenate([np.cumsum(expand(k, np.uint64), dtype=np.uint64) for k in rows["keys"].to_pylist()])
        owners = np.concatenate([expand(o, np.int64) for o in rows["owners"].to_pylist()])
        order = np.argsort(keys)
        keys, owners = keys[order], owners[order]
        same = np.concatenate(([False], keys[1:] == keys[:-1], [False]))
        shared = same[1:] | same[:-1]  # most keys have one class
        keys, owners = keys[shared], owners[shared]
        order = np.lexsort((owners, keys))
        keys, owners = keys[order], owners[order]
        starts = np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)]
        least = owners[np.nonzero(starts)[0]][np.cumsum(starts) - 1]
        if not few:
            pairs = np.unique(np.stack((least, owners), axis=1)[least != owners], axis=0)
            return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
        number = np.cumsum(starts) - 1
        small = (np.bincount(number) <= few)[number]
        star = ~small if crowds else ~small & (least != owners)
        centre = keys.view(np.int64) if crowds else least
        found = [np.stack((centre[star], owners[star]), axis=1)]
        for i in range(1, few):
            at = np.nonzero(small[:-i] & (number[:-i] == number[i:]))[0]
            found.append(np.stack((owners[at], owners[at + i]), axis=1))
        some = [np.unique(f, axis=0) for f in (found[0], np.concatenate(found[1:]))]
        pairs = np.concatenate(some)
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(np.arange(len(pairs)) < len(some[0]))], names=["a", "b", "star"])

    def met(rows: pa.Table) -> pa.Table:
        found = meet(rows)
        release()
        return found

    rows = map_batches(classes.where(F.octet_length("keys") > 0).select("class", "keys"), pack, "part long, keys binary, owners binary", last=True)
    return rows.groupBy("part").applyInArrow(met, "a long, b long, star boolean" if few else "a long, b long")


def bits_apart(limit: int) -> Callable:
    """A ``near`` for ``crowd_links``: sketches (columns of numbers) that differ in at most ``limit`` bits."""

    def compare(columns: list[pa.ChunkedArray]) -> Callable:
        values = np.stack([c.to_numpy() for c in columns], axis=1).view(np.uint64)
        near = lambda at, left: np.bitwise_count(values[left] ^ values[at]).sum(axis=1, dtype=np.int64) <= limit
        return lambda a, b: near

    return compare


def crowd_links(members: DataFrame, sketches: DataFrame, columns: list[str], near: int | Callable, elements: int = CROWD) -> DataFrame:
    """Edges (a, b) that connect the classes of every key whose sketches are near, directly or through others.

    ``members``: key, class; ``sketches``: class and the sketch's ``columns``. ``near`` is the most bits in which sketches differ, or a function
    from the columns to one from a stretch of rows to one that says, of a row and an array of others there, which of these are near. A key's
    near pairs are walked along, so copies of copies cost one comparison each and give one edge each. Larger crowds than a task takes are
    compared block by block.
    """
    compare = near if callable(near) else bits_apart(near)

    def walk(rows: pa.Table) -> pa.Table:
        groups, classes, side = rows["group"].to_numpy(), rows["class"].to_numpy(), rows["side"].to_numpy()
        order = np.lexsort((classes, groups))
        groups, classes, side = groups[order], classes[order], side[order]
        within = compare([rows[c].take(pa.array(order)) for c in columns])
        cuts = np.concatenate(([0], np.nonzero(np.diff(groups))[0] + 1, [len(order)]))
        found = [np.zeros((0, 2), np.int64)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            left, alike = np.arange(a, b), within(a, b)  # not reached yet
            while len(left) > 1:
                reached, left = [left[0]], left[1:]
                while reached and len(left):
                    at = reached.pop()
                    close = alike(at, left)
                    if side[at]:
                        close &= side[left] != side[at]
                    if close.any():
                        hits, left = left[close], left[~close]
                        found.append(np.stack((np.full(len(hits), classes[at]), classes[hits]), axis=1))
                        reached.extend(hits.tolist())
        pairs = np.unique(np.concatenate(found), axis=0)
        release()
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    wanted = placed(members.select("class", F.col("key").alias("group"), F.lit(1).alias("n")), elements)
    rows = wanted.withColumn("place", F.explode("places")).select("class", "group", "place.bin", "place.i", "place.j", "place.side")
    return rows.join(sketches.select("class", *columns), "class").groupBy("bin", "i", "j").applyInArrow(walk, "a long, b long")


def candidate_groups(edges: DataFrame) -> DataFrame:
    """class, group: the candidate groups of at least two classes."""
    found = components(edges)
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return found.unionByName(roots).select(F.col("node").alias("class"), F.col("root").alias("group"))


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i


def linked_pairs(classes: np.ndarray, sets: list[np.ndarray], side: np.ndarray, linked: Callable, near: Callable) -> Iterator[tuple[int, int]]:
    """True links that connect what is linked, among pairs not both on side 1 or both on side 2 (side 0: all pairs).

    ``near(sets)`` returns a function from a position to the later positions that may be linked, nearest first;
    ``linked(a, b)`` decides exactly.
    """
    forest, later = Forest(len(sets)), near(sets)
    for i in range(len(sets)):
        for j in later(i):
            if side[i] and side[i] == side[j]:
                continue
            a, b = forest.root(i), forest.root(j)
            if a != b and linked(sets[i], sets[j]):
                forest.parent[max(a, b)] = min(a, b)
                yield int(classes[i]), int(classes[j])


def placed(wanted: DataFrame, elements: int = GROUP_ELEMENTS) -> DataFrame:
    """``wanted`` (class, group, n and other columns) with ``places``: the tasks that verify the class, written once.

    Small groups share tasks. A group with more elements than a task takes is cut into blocks by class, every pair of blocks has a
    task, and a class goes to those of its block. Nothing but numbers is read here; the sets follow later, once for each place.
    """
    weights = wanted.groupBy("group").agg(F.sum("n").alias("weight"))
    total = wanted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    small = F.col("weight") <= elements
    bins = F.pmod(F.xxhash64("group"), F.lit(spread(total, elements)))
    own = F.pmod(F.xxhash64("class"), F.ceil(F.col("weight") * 2 / elements)).cast("int")
    place = lambda bin, i, j, side: F.struct(bin.alias("bin"), i.alias("i"), j.alias("j"), side.alias("side"))
    zero = F.lit(0)
    others = F.transform(
        F.sequence(zero, F.ceil(F.col("weight") * 2 / elements).cast("int") - 1),
        lambda o: place(F.col("group"), F.least(own, o), F.greatest(own, o), F.when(own == o, 0).when(own < o, 1).otherwise(2)),
    )
    places = F.when(small, F.array(place(bins, zero, zero, zero))).otherwise(others)
    return checkpoint(wanted.join(weights, "group").withColumn("places", places).drop("weight"))


def verified(members: DataFrame, linked: Callable, near: Callable, load: Callable[[list[bytes]], list[np.ndarray]] | None = None) -> DataFrame:
    """Edges (a, b) of true links that connect what is linked within each group.

    ``members``: class, group, places, set (binary, which ``load`` turns into sorted 64-bit values; they themselves if there is none).
    A class may be given more than once. The sets are shuffled once.
    """

    def verify(rows: pa.Table) -> pa.Table:
        groups, classes = rows["group"].to_numpy(), rows["class"].to_numpy()
        order = np.lexsort((classes, groups))
        again = np.concatenate(([False], classes[order][1:] == classes[order][:-1]))
        order = order[~again]
        classes, groups, side, raw = classes[order], groups[order], rows["side"].to_numpy()[order], rows["set"]
        cuts = np.concatenate(([0], np.nonzero(np.diff(groups))[0] + 1, [len(order)]))
        found: list[tuple[int, int]] = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            some = [raw[int(p)].as_py() for p in order[a:b]]
            sets = load(some) if load else [np.frombuffer(x, np.uint64) for x in some]
            found += linked_pairs(classes[a:b], sets, side[a:b], linked, near)
        pairs = np.array(found, np.int64).reshape(-1, 2)
        release()
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    rows = members.withColumn("place", F.explode("places")).select("class", "group", "set", "place.bin", "place.i", "place.j", "place.side")
    return rows.groupBy("bin", "i", "j").applyInArrow(verify, "a long, b long")


def parity(sets: list[np.ndarray], words: int) -> np.ndarray:
    """Parity sketches of sets: every element flips one of 64 * words bits, so a pair's Hamming distance is at most its symmetric difference."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    values = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    bit = (values >> np.uint64(17)) % np.uint64(64 * words)
    at = np.repeat(np.arange(len(sets)) * (64 * words), sizes) + bit.astype(np.int64)
    odd = np.bincount(at, minlength=len(sets) * 64 * words).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(sets), -1), axis=1, bitorder="little").view(np.uint64)


def folded(sketches: list[bytes], words: int) -> np.ndarray:
    """Parity sketches of 2**k words each, as those of so many words (no more than the shortest has): halves are laid over each other."""
    sizes = np.fromiter(map(len, sketches), np.int64, len(sketches)) // 8
    out = np.zeros((len(sketches), words), np.uint64)
    for size in np.unique(sizes):
        at = np.nonzero(sizes == size)[0]
        rows = np.frombuffer(b"".join(sketches[i] for i in at), np.uint64).reshape(len(at), size)
        while (half := rows.shape[1] // 2) >= words:
            rows = rows[:, :half] ^ rows[:, half:]
        out[at] = rows
    return out


def nearby(limit: Callable[[np.ndarray, int], np.ndarray], most: Callable[[int], int]) -> Callable:
    """A ``near`` for ``linked_pairs``: pairs whose sketches differ in at most ``limit(sizes, size)`` bits; ``most(size)`` of the largest set sizes the sketches."""

    def near(sets: list[np.ndarray]) -> Callable[[int], list[int]]:
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        words = min(64, max(2, most(int(sizes.max())) // 8))
        if len(sets) * words > 4_000_000:
            words = 2
        sketches = parity(sets, words)

        def later(i: int) -> list[int]:
            gaps = np.bitwise_count(sketches[i + 1 :] ^ sketches[i]).sum(axis=1, dtype=np.int64)
            fine = np.nonzero(gaps <= limit(sizes[i + 1 :], sizes[i]))[0]
            return (fine[np.argsort(gaps[fine], kind="stable")] + i + 1).tolist()

        return later

    return near
