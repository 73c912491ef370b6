"""Balanced label propagation: linked documents move towards their neighbours' shard under capacity quotas.

Documents are linked through hubs (documents of one hub are linked), so a group of any size is a star, never all pairs.
Each round counts the members of a hub per shard, lets every linked document name the shard that most of its neighbours
are in, and admits movers from shard to shard as far as the quotas allow: as many as come the other way, and what is free.
At the end the documents that no link binds fill the shards up, so that row counts differ by one at most.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint
from .ordering import bucket_count, hex_bucket, running

SHARDS = 8
ROUNDS = 4
LAW = "rows"
#: By so much a shard may be overfull while documents move; the end evens it out.
SLACK = 0.1
#: Hubs that are too large to move; beyond so many, Spark chooses the join.
BROADCAST_ROWS = 10_000


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Narrow rows of the documents, written once: node (a number of the row), key, size, text_crc32, digest of the key, hub.

    Equal texts share a hub; null texts are one group of their own and have size 1 and the checksum of no bytes.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias("digest"),
        F.when(F.col(text).isNotNull(), F.md5(body)).otherwise(F.lit("null")).alias("hub"),
    )
    return checkpoint(rows.withColumn("node", F.monotonically_increasing_id()))


def _counts(prefix: str, shards: int) -> list:
    return [F.col(f"{prefix}{i}") for i in range(shards)]


def _best(counts: list, anchor):
    """The shard with the most neighbours; among equals, all nodes of one anchor choose the same, so that they meet."""
    shards = len(counts)
    turned = F.pmod(F.xxhash64(anchor), F.lit(shards))
    ranks = [c * shards + F.pmod(F.lit(i) + turned, F.lit(shards)) for i, c in enumerate(counts)]
    most = F.greatest(*ranks)
    return F.coalesce(*[F.when(r == most, F.lit(i)) for i, r in enumerate(ranks)])


def quotas(flows: dict[tuple[int, int], int], held: dict[int, int], capacity: list[int]) -> dict[tuple[int, int], float]:
    """The part of each flow between shards that is let through, so that no shard ends above its capacity."""
    let = {pair: min(n, flows.get(pair[::-1], 0)) for pair, n in flows.items()}
    free = {to: max(0, capacity[to] - held.get(to, 0)) for _, to in flows}
    for pair in sorted(flows, key=lambda p: (-flows[p], p)):
        more = min(free[pair[1]], flows[pair] - let[pair])
        let[pair] += more
        free[pair[1]] -= more
    return {pair: let[pair] / n for pair, n in flows.items()}


def choose(value, edges: list[int]):
    """The number of the stretch that a value falls into, where stretch i ends before edges[i]."""
    return reduce(lambda rest, i: F.when(value < edges[i], F.lit(i)).otherwise(rest), reversed(range(len(edges) - 1)), F.lit(len(edges) - 1))


def propagate(nodes: DataFrame, held: DataFrame, room: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Labels (node, digest, shard, anchor, members) of the linked nodes after some rounds.

    ``nodes``: node, digest; ``held``: node, hub, members (the hub's size); ``room``: what each shard can take. A node starts
    in a shard by its digest, in proportion to the room. ``anchor`` is the largest hub of a node and ``members`` its size.
    Only counts between shards (at most the square of their number) reach the driver.
    """
    shards, edges = len(room), list(accumulate(room))
    largest = held.groupBy("node").agg(F.max(F.struct("members", "hub")).alias("a"))
    first = choose(hex_bucket(F.col("digest"), max(1, edges[-1])), edges)
    start = nodes.join(largest, "node").select("node", "digest", first.cast("int").alias("shard"), F.col("a.hub").alias("anchor"), F.col("a.members").alias("members"))
    labels = checkpoint(start)
    for turn in range(rounds):
        placed = held.select("node", "hub").join(labels.select("node", "shard"), "node")
        per_hub = placed.groupBy("hub").agg(*[F.count(F.when(F.col("shard") == i, 1)).alias(f"h{i}") for i in range(shards)])
        seen = held.select("node", "hub").join(per_hub, "hub").groupBy("node").agg(*[F.sum(f"h{i}").alias(f"c{i}") for i in range(shards)])
        chance = F.pmod(F.xxhash64("anchor", F.lit(turn)), F.lit(1 << 20)) / float(1 << 20)  # a group moves as one
        wishes = checkpoint(labels.join(seen, "node").select(*labels.columns, _best(_counts("c", shards), F.col("anchor")).cast("int").alias("wish"), chance.alias("chance")))
        now = {r.shard: r.n for r in wishes.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        flows = {(r.shard, r.wish): r.n for r in wishes.where("wish <> shard").groupBy("shard", "wish").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not flows:
            break
        let = quotas(flows, now, [r + math.ceil(r * SLACK) for r in room])
        admitted = reduce(lambda rest, p: F.when((F.col("shard") == p[0]) & (F.col("wish") == p[1]), F.lit(let[p])).otherwise(rest), sorted(let), F.lit(0.0))
        moved = (F.col("wish") != F.col("shard")) & (F.col("chance") < admitted)
        labels = wishes.select("node", "digest", F.when(moved, F.col("wish")).otherwise(F.col("shard")).alias("shard"), "anchor", "members")
    return labels


def shard(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Place every node: node, shard, slot (gapless from 0); row counts differ by one at most.

    ``nodes``: node (unique), digest (hexadecimal, gives the start and the order); ``links``: node, hub. A hub of more than half a
    shard cannot move as one under the quotas: its nodes are laid out one after the other where room is left, over as few
    shards as that allows. An empty table gives no rows.
    """
    total = nodes.count()
    capacity = [total // shards + (i < total % shards) for i in range(shards)]
    sizes = links.groupBy("hub").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    large = F.col("members") > max(1, total // shards // 2)
    giants = checkpoint(sizes.where(large).select("hub"))
    small = F.broadcast if giants.count() <= BROADCAST_ROWS else lambda frame: frame
    held = checkpoint(links.join(small(giants), "hub", "left_anti").join(sizes.where(~large), "hub"))
    laid = links.join(small(giants), "hub").join(held.select("node"), "node", "left_anti").groupBy("node").agg(F.max("hub").alias("anchor"))
    # The nodes of giants come first; what they leave is the room of all others.
    taken = laid.count()
    room = [max(0, min(c, end - taken)) for c, end in zip(capacity, accumulate(capacity), strict=True)]
    labels = propagate(nodes, held, room, rounds)
    # Groups that the quotas have left apart are laid out anew, each in one stretch.
    spans = labels.groupBy("anchor").agg((F.min("shard") == F.max("shard")).alias("whole"))
    labels = checkpoint(labels.join(spans, "anchor"))
    buckets = bucket_count(total)
    each = max(1, total // buckets)
    large = F.col("members") > each
    parts = F.when(large, F.ceil(F.col("members") / each)).otherwise(1)
    first_bits = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    place = F.struct(
        F.length(F.bin("members")).alias("scale"),  # large groups last: they can be cut with the least loss
        hex_bucket(F.md5(F.col("anchor").cast("binary")), buckets).alias("part"),
        F.when(large, F.col("anchor")).alias("hub"),
        F.shiftright(first_bits * parts, 32).alias("piece"),
    )
    one = F.lit(1).cast("long")
    ranked = running(labels.where("whole").withColumn("_bucket", place), ["shard"], "_bucket", ["anchor", "digest", "node"], one, "slot")
    within = reduce(lambda rest, i: F.when(F.col("shard") == i, F.lit(room[i])).otherwise(rest), range(shards), F.lit(0))
    ranked = checkpoint(ranked.withColumn("keeps", F.col("slot") < within))
    kept = {r.shard: r.n for r in ranked.where("keeps").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    free = nodes.join(labels.select("node"), "node", "left_anti").join(laid, "node", "left").select("node", "digest", "anchor", F.when(F.col("anchor").isNull(), F.lit(2)).otherwise(F.lit(0)).alias("turn"))
    apart = labels.where("not whole").select("node", "digest", "anchor")
    left_over = ranked.where("not keeps").select("node", "digest", "anchor").unionByName(apart)
    rest = left_over.withColumn("turn", F.lit(1)).unionByName(free)
    place = F.struct("turn", "anchor", hex_bucket(F.col("digest"), buckets).alias("piece"))
    queue = running(rest.withColumns({"_bucket": place, "_all": F.lit(0)}), ["_all"], "_bucket", ["digest", "node"], one, "number")
    shard_of, slot_of, done = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for i in range(shards):
        open_ = capacity[i] - kept.get(i, 0)
        here = (F.col("number") >= done) & (F.col("number") < done + open_)
        shard_of = F.when(here, F.lit(i)).otherwise(shard_of)
        slot_of = F.when(here, F.col("number") - done + kept.get(i, 0)).otherwise(slot_of)
        done += open_
    filled = queue.select("node", shard_of.alias("shard"), slot_of.cast("long").alias("slot"))
    return ranked.where("keeps").select("node", "shard", "slot").unionByName(filled)


def shard_documents(rows: DataFrame, key: str = "doc_id", shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Shard the rows of ``measured``, documents with equal texts linked: key, size, text_crc32, law, shard, slot, grown_shard."""
    placed = shard(rows.select("node", "digest"), rows.select("node", "hub"), shards, rounds)
    columns = [F.col("key").alias(key), "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")]
    return rows.join(placed, "node").select(*columns)
