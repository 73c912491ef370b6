"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

The mix is a row of slots. Slot i stands at the point i * golden ratio (mod 1); the point falls into the stretch of one
source, whose length is its share of the target. A source's slots are ranked, and slot number r of a source holds the
r-th block of its shuffled words. A source that is taken more than once runs through its documents again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, checkpoint, words_in
from .ordering import bucket_count, hex_bucket, running

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 1024
#: Stretches of the unit interval that make the search for a point's source an equi-join.
CELLS = 4096
#: The golden ratio's fractional part as a 32-bit fraction; points repeat after 2**31 slots.
GOLDEN = 2654435769
CHUNK = 4096


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per source (``source``, ``source_size``): its number, weight and target words.

    The targets share ``share`` times all sizes by weight; none is above ``most`` times its source's size. With the level
    at which ``weight * level`` fills the total, a source is held back when its limit over its weight is below that level.
    The table has one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    numbered = sizes.withColumn("s", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("s") % len(weights) + 1).cast("int"))
    limited = numbered.withColumns({"weight": weight, "limit": F.col("source_size") * most})
    tight = Window.orderBy(F.col("limit") / F.col("weight"), "s")
    held = F.coalesce(F.sum("limit").over(tight.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    free = F.sum("weight").over(tight.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(share) - held) / free
    found = limited.withColumn("_level", level)
    # The level is that of the first source which it does not hold back; where all are held back, none.
    open_level = F.min(F.when(F.col("_level") * F.col("weight") <= F.col("limit"), F.struct(F.col("limit") / F.col("weight"), "s", "_level"))).over(everything)
    target = F.least(F.col("limit").cast("double"), F.coalesce(open_level["_level"] * F.col("weight"), F.col("limit").cast("double")))
    return found.withColumn("target", target).select("s", "source", "source_size", "target")


def slots(spark, plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """The schedule: ``slot``, its source ``s``, the slot's rank ``k`` among those of its source, and ``each``, the words of a block there.

    ``plan`` has s and tokens, the whole words that each source gives. Its cumulated tokens cut the unit interval; every
    source with tokens has a slot, at the end if no point fell on it.
    """
    to_date = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    total = plan.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first().t
    count = -(-total // block)
    scale = lambda c: F.floor(c / F.lit(float(max(1, total))) * F.lit(float(1 << 32))).cast("long")
    ends = plan.where("tokens > 0").withColumn("_end", F.sum("tokens").over(to_date))
    stretches = ends.select("s", "tokens", scale(F.col("_end") - F.col("tokens")).alias("lo"), scale(F.col("_end")).alias("hi"))
    cell = 1 << 32 - CELLS.bit_length() + 1
    of_cells = stretches.where("hi > lo").withColumn("cell", F.explode(F.sequence(F.expr(f"lo div {cell}"), F.expr(f"(hi - 1) div {cell}"))))
    point = F.col("slot") % (1 << 31) * F.lit(GOLDEN) % (1 << 32)
    points = spark.range(count).withColumnRenamed("id", "slot").withColumn("u", point).withColumn("cell", F.expr(f"u div {cell}"))
    placed = points.join(of_cells, "cell").where("u >= lo and u < hi").select("slot", "s")
    missed = stretches.join(placed.select("s").distinct(), "s", "left_anti").select((F.col("s") + F.lit(count)).alias("slot"), "s")
    chunk = F.expr(f"slot div {CHUNK}")
    ranked = running(placed.unionByName(missed).withColumn("_chunk", chunk), ["s"], "_chunk", ["slot"], F.lit(1).cast("long"), "k").drop("_chunk")
    each = ranked.groupBy("s").agg(F.count(F.lit(1)).alias("_n")).join(plan, "s").select("s", F.ceil(F.col("tokens") / F.col("_n")).alias("each"))
    return ranked.join(each, "s")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Narrow rows of the documents: key, mark (a hash of the text), source, size in words and the digest that shuffles them; written once."""
    chosen = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.col(source).cast("string").alias("source"), words_in(F.col(text)).alias("size"))
    return checkpoint(chosen.withColumn("_digest", F.md5(F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary"))))


def mix(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The placed documents and the mix of ``rows`` (see ``measured``).

    Documents: key, source, size, source_size, target, s, ``position`` (the words of its source before it, shuffled).
    Mix: ``slot``, s, k, key, position, ``lap``, ``first`` (word of the document at which the piece starts), ``words``.
    A null text has no words and is never taken; documents with one key are separate; an empty table gives no rows. Equal
    keys and sizes are interchangeable. The order depends on keys alone, so reruns agree.
    """
    spark = rows.sparkSession
    plan = checkpoint(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most).withColumn("tokens", F.floor("target").cast("long")))
    placed = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    placed = placed.withColumn("_bucket", hex_bucket(F.col("_digest"), bucket_count(rows.count())))
    placed = running(placed, ["s"], "_bucket", ["_digest", "key", "size"], F.col("size"), "position").drop("_bucket", "_digest")
    placed = checkpoint(placed)
    schedule = slots(spark, plan.select("s", "tokens"), block)
    widths = schedule.select("s", "each").distinct()
    laps = placed.where("size > 0").withColumn("lap", F.explode(F.array(*[F.lit(i).cast("long") for i in range(most)])))
    laps = laps.withColumn("_from", F.col("position") + F.col("lap") * F.col("source_size"))
    laps = laps.withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("tokens"))).where("_to > _from").join(widths, "s")
    pieces = laps.withColumn("k", F.explode(F.sequence(F.expr("_from div each"), F.expr("(_to - 1) div each"))))
    start = F.greatest(F.col("_from"), F.col("k") * F.col("each"))
    pieces = pieces.select("s", "k", "key", "position", "lap", (start - F.col("_from")).alias("first"), (F.least(F.col("_to"), (F.col("k") + 1) * F.col("each")) - start).alias("words"))
    return placed, pieces.join(schedule.select("slot", "s", "k"), ["s", "k"])


def taken(placed: DataFrame, mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: key, size, source_size, target and the words that the mix takes of it, repeats counted."""
    counts = mixed.groupBy("s", "position").agg(F.sum("words").alias("taken"))
    some = placed.where("size > 0").join(counts, ["s", "position"], "left")
    rows = some.unionByName(placed.where("size = 0").withColumn("taken", F.lit(None).cast("long")))
    return rows.select(F.col("key").alias(key), "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of the mix, with their columns: once for each time that the mix runs over them.

    Of a document that the mix takes in part, its first words stand in a row, with single spaces. Documents that it does not take
    are gone, and so are those without words.
    """
    placed, mixed = mix(measured(docs, key, text, source), **options)
    times = mixed.groupBy("s", "position", "lap").agg(F.sum("words").alias("words"))
    some = placed.where("size > 0").select("s", "position", "key", "mark", "source").join(times, ["s", "position"])
    takes = some.groupBy("key", "mark", "source").agg(F.sort_array(F.collect_list("words"), asc=False).alias("__llm_takes"))
    takes = takes.withColumnsRenamed({"key": "__llm_key", "mark": "__llm_mark", "source": "__llm_source"})
    rows = docs.withColumns({"__llm_text": F.xxhash64(text), "__llm_from": F.col(source).cast("string")})
    same = F.col(key).eqNullSafe(F.col("__llm_key")) & (F.col("__llm_text") == F.col("__llm_mark"))
    joined = rows.join(takes, same & F.col("__llm_from").eqNullSafe(F.col("__llm_source")))
    # Rows equal in key, text and source have all their takes in one list, so one of them stands for all.
    once = joined.dropDuplicates([key, "__llm_text", "__llm_from"]).withColumn("__llm_words", F.explode("__llm_takes"))
    words = F.filter(F.split(F.col(text), BLANKS), lambda w: w != "")
    cut = F.array_join(F.slice(words, F.lit(1), F.col("__llm_words").cast("int")), " ")
    return once.select(*[F.when(F.col("__llm_words") < words_in(F.col(text)), cut).otherwise(F.col(c)).alias(c) if c == text else F.col(c) for c in docs.columns])


SQL = """
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s FROM rows GROUP BY source
), limits AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][s % 3 + 1] AS weight, source_size * 2 AS most FROM sizes
), levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(most) OVER (ORDER BY most / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / sum(weight) OVER (ORDER BY most / weight, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM limits
), plan AS (
  SELECT s, source, source_size,
         least(most::DOUBLE, coalesce((SELECT level FROM levels WHERE level * weight <= most ORDER BY most / weight, s LIMIT 1) * weight, most::DOUBLE)) AS target
  FROM levels
), placed AS (
  SELECT r.doc_id, r.source, r.size, p.source_size, p.target,
         sum(r.size) OVER (PARTITION BY s ORDER BY digest, doc_id, size ROWS UNBOUNDED PRECEDING) - r.size AS position
  FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, source, size, source_size, target,
       (greatest(0, least(position + size, floor(target)) - position)
        + greatest(0, least(position + source_size + size, floor(target)) - position - source_size))::BIGINT AS taken
FROM placed
"""
