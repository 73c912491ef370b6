"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

P(w | h) = l2 * c(h w) / c(h) + l1 * c(w) / N + l0 / (V + 1), with weights l for each bucket of the context's frequency c(h). The
weights are learned by expectation-maximisation on counts of training documents that were left out of the estimates.

Texts become chunks of word numbers, which stay where they are; only distinct words and distinct pairs of words of a chunk
travel, sorted and packed, to the part that counts them, and the counts travel back in the same order. So no count,
vocabulary or table of pairs is ever in one place, and a frequent word is one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS, checkpoint, chunks, expand, map_batches, mix, rising, spread, squeeze

HELD_OUT = 10
#: Characters of a chunk, and characters of the corpus for each part that counts words or pairs.
CHUNK = 8_000_000
WORD_PART = 32_000_000
PAIR_PART = 8_000_000
SMOOTH = 0.1
#: The end of a text, counted as a token; no word is a space.
END = xxhash.xxh3_64_intdigest(b" ")
#: Context buckets by the binary logarithm of the frequency; bins of estimates per octave; rounds of expectation-maximisation.
BUCKETS = 40
BINS = 8
OCTAVES = 48
TURNS = 100
WIDTH = OCTAVES * BINS + 1
KEPT, LEFT_OUT, HELD = 2, 1, 0


def by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of keys by part and value, and the non-empty parts with their cuts in that order."""
    part = keys % np.uint64(parts)
    order = np.lexsort((keys, part))
    cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    return order, np.nonzero(np.diff(cuts))[0], cuts


PACKED = "kind int, key long, chunk long, ids binary, lengths binary, folds binary, known binary, left binary"


def chunked(docs: DataFrame, key: str, text: str, fold, parts: int) -> DataFrame:
    """Rows of two kinds, by ``key``: chunks of texts (word numbers, documents), and their distinct words with counts for each part."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        folds = batch.column(2).to_numpy().astype(np.uint8)
        for first, texts in chunks(batch.column(1).to_pylist(), CHUNK):
            arrays = []
            for t in texts:
                arrays += [WORDS.of(t), np.array([END], np.uint64)]
            lengths = np.fromiter((len(a) + 1 for a in arrays[::2]), np.int64, len(texts))
            words, number = np.unique(np.concatenate(arrays), return_inverse=True)
            order, some, cuts = by_part(words, parts)
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            ids, token_fold = place[number], np.repeat(folds[first : first + len(texts)], lengths)
            counts = [np.bincount(ids[token_fold == f], minlength=len(words)).astype(np.uint32) for f in (KEPT, LEFT_OUT)]
            words = words[order]
            chunk = work.chunk = getattr(work, "chunk", -1) + 1
            chunk += TaskContext.get().partitionId() << 32
            n = len(some)
            cut = lambda values: [squeeze(values[cuts[p] : cuts[p + 1]]) for p in some]
            rows = {
                "kind": [0] + [1] * n,
                "key": [chunk, *some.tolist()],
                "chunk": [chunk] * (n + 1),
                "ids": [squeeze(ids.astype(np.uint32)), *[squeeze(rising(words[cuts[p] : cuts[p + 1]])) for p in some]],
                "lengths": [squeeze(lengths), *[None] * n],
                "folds": [folds[first : first + len(texts)].tobytes(), *[None] * n],
                "known": [None, *cut(counts[0])],
                "left": [None, *cut(counts[1])],
            }
            keys = batch.column(0).slice(first, len(texts))
            listed = pa.ListArray.from_arrays(pa.array([0] + [len(texts)] * (n + 1), pa.int32()), keys)
            kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([*[pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], listed], names=[*rows, "keys"])

    kind = docs.schema[key].dataType.simpleString()
    return map_batches(docs.select(key, text, fold.alias("fold")), work, f"{PACKED}, keys array<{kind}>", "Words")


class Keys:
    """What a part has been asked: sorted keys of several chunks, and how often each stands in kept and left-out texts."""

    def __init__(self, rows: pa.Table):
        asked = [np.cumsum(expand(x, np.uint64), dtype=np.uint64) for x in rows["ids"].to_pylist()]
        keys, number = np.unique(np.concatenate(asked), return_inverse=True)
        self.size = len(keys)
        self.given = [np.concatenate([expand(x, np.uint32) for x in rows[name].to_pylist()]) for name in ("known", "left")]
        self.kept, left = (np.bincount(number, g, len(keys)).astype(np.uint32) for g in self.given)
        self.trained = self.kept + left
        self.number = number
        self.at = np.split(number, np.cumsum(list(map(len, asked)))[:-1])

    def answers(self, values: np.ndarray) -> pa.Array:
        """The values of the keys asked, chunk by chunk."""
        return pa.array([squeeze(values[i]) for i in self.at], pa.binary())


def first_only(value, rows: int) -> pa.Array:
    return pa.array([value] + [None] * (rows - 1))


def count_words(rows: DataFrame) -> DataFrame:
    """Per chunk and part, in the order of the words asked: counts (kept, all of training) and the words' rising numbers in the part.

    ``rows``: key (the part), chunk, ids (sorted hashes), known and left (counts in the chunk). The first answer of a part carries
    its training tokens and distinct words (all, and kept).
    """

    def count(rows: pa.Table) -> pa.Table:
        keys, n = Keys(rows), rows.num_rows
        totals = [int(x) for x in (keys.trained.sum(), (keys.trained > 0).sum(), keys.kept.sum(), (keys.kept > 0).sum())]
        numbers = pa.array([squeeze(rising(i.astype(np.uint64))) for i in keys.at], pa.binary())
        columns = [rows["chunk"], rows["key"], keys.answers(keys.kept), keys.answers(keys.trained), numbers, *[first_only(t, n) for t in totals]]
        return pa.table(columns, names=["chunk", "part", "kept", "trained", "number", "n", "v", "n_kept", "v_kept"])

    return rows.groupBy("key").applyInArrow(count, "chunk long, part long, kept binary, trained binary, number binary, n long, v long, n_kept long, v_kept long")


def count_pairs(rows: DataFrame, tokens: int) -> DataFrame:
    """Per chunk and part, the training counts of the pairs asked; the first answer of a part carries the part's evidence.

    ``rows`` has also, for the pairs that stand in left-out texts, the kept counts of their contexts and words. Evidence is how
    many left-out tokens have a context bucket and bins of a bigram and a unigram estimate (codes and n).
    """

    def count(rows: pa.Table) -> pa.Table:
        keys, n = Keys(rows), rows.num_rows
        left = keys.given[1] > 0
        contexts, words = (np.concatenate([expand(x, np.uint32) for x in rows[name].to_pylist()]).astype(np.float64) for name in ("contexts", "words"))
        pairs = keys.kept[keys.number[left]].astype(np.float64)
        code = (bucket(contexts) * WIDTH + binned(pairs / np.maximum(contexts, 1))) * WIDTH + binned(words / max(1, tokens))
        codes, at = np.unique(code, return_inverse=True)
        found = [{"code": int(c), "n": int(m)} for c, m in zip(codes, np.bincount(at, keys.given[1][left], len(codes)), strict=True)]
        evidence = pa.array([found] + [None] * (n - 1), pa.list_(pa.struct([("code", pa.int64()), ("n", pa.int64())])))
        return pa.table([rows["chunk"], rows["key"], keys.answers(keys.trained), evidence], names=["chunk", "part", "trained", "evidence"])

    return rows.groupBy("key").applyInArrow(count, "chunk long, part long, trained binary, evidence array<struct<code:long,n:long>>")


def gathered(answers: DataFrame, name: str, *columns: str) -> DataFrame:
    """Per chunk, the list ``name`` of its answers."""
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("part", *columns)).alias(name))


def joined(answers: list[dict], column: str) -> np.ndarray:
    return np.concatenate([expand(a[column], np.uint32) for a in sorted(answers, key=lambda a: a["part"])])


@dataclass
class Chunk:
    """A chunk's tokens: documents' lengths and folds, word numbers, and each token's context (the word before, or the end of a text)."""

    ids: np.ndarray
    before: np.ndarray
    lengths: np.ndarray
    folds: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Chunk:
        ids, lengths = expand(row["ids"], np.uint32).astype(np.int64), expand(row["lengths"], np.int64)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]  # a text begins after the end of the text before it
        before[0] = ids[-1]
        return cls(ids, before, lengths, np.frombuffer(row["folds"], np.uint8))

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of word numbers and each token's place among them."""
        return np.unique(self.before * width + self.ids, return_inverse=True)


def pair_keys(pairs: np.ndarray, words: list[dict], word_parts: int, width: int) -> np.ndarray:
    """Keys of pairs that are the same in all chunks: the words' numbers in the whole corpus, scrambled together."""
    words = sorted(words, key=lambda a: a["part"])
    whole = np.concatenate([np.cumsum(expand(a["number"], np.int64)) * word_parts + a["part"] for a in words]).astype(np.uint64)
    if int(whole.max()) >> 32:  # beyond 2**32 words two numbers do not fit into one: scrambled together
        return mix(mix(whole[pairs // width]) ^ whole[pairs % width])
    return whole[pairs // width] << np.uint64(32) | whole[pairs % width]


def ask_pairs(rows: DataFrame, word_parts: int, parts: int) -> DataFrame:
    """Distinct pairs of words of each chunk with their counts, for each part; contexts and words count those of left-out pairs."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            chunk, kept = Chunk.of(row), joined(row["words"], "kept")
            pairs, at = chunk.pairs(len(kept))
            keys = pair_keys(pairs, row["words"], word_parts, len(kept))
            order, some, cuts = by_part(keys, parts)
            token_fold = np.repeat(chunk.folds, chunk.lengths)
            known, left = (np.bincount(at[token_fold == f], minlength=len(pairs)).astype(np.uint32)[order] for f in (KEPT, LEFT_OUT))
            keys, pairs = keys[order], pairs[order]
            cut = lambda values: pa.array([squeeze(values[cuts[p] : cuts[p + 1]]) for p in some], pa.binary())
            only = lambda numbers: pa.array([squeeze(kept[numbers[cuts[p] : cuts[p + 1]][left[cuts[p] : cuts[p + 1]] > 0]]) for p in some], pa.binary())
            asked = pa.array([squeeze(rising(keys[cuts[p] : cuts[p + 1]])) for p in some], pa.binary())
            columns = [pa.array(some), pa.array([row["chunk"]] * len(some)), asked, cut(known), cut(left), only(pairs // len(kept)), only(pairs % len(kept))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "chunk", "ids", "known", "left", "contexts", "words"])

    return map_batches(rows, work, "key long, chunk long, ids binary, known binary, left binary, contexts binary, words binary")


def estimates(row: dict, word_parts: int, pair_parts: int) -> tuple[Chunk, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk with each token's training count, its context's, and the pair's."""
    chunk = Chunk.of(row)
    words = joined(row["words"], "trained").astype(np.float64)
    pairs, at = chunk.pairs(len(words))
    order, _, _ = by_part(pair_keys(pairs, row["words"], word_parts, len(words)), pair_parts)
    counts = np.empty(len(pairs))
    counts[order] = joined(row["pairs"], "trained")
    return chunk, words[chunk.ids], words[chunk.before], counts[at]


def bucket(frequency: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(frequency)[1], BUCKETS - 1)


def binned(p: np.ndarray) -> np.ndarray:
    """Bin of an estimate on a logarithmic scale; 0 is no estimate."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, 1 + np.clip(np.round(-np.log2(p) * BINS), 0, OCTAVES * BINS - 1), 0).astype(np.int64)


def of_bin(i: np.ndarray) -> np.ndarray:
    return np.where(i > 0, 2.0 ** (-(i - 1) / BINS), 0.0)


def weights(rows: list[tuple[int, int]], types: int) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) of every bucket, by expectation-maximisation on binned evidence."""
    found = np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
    by_bucket: dict[int, list] = {}
    for code, n in rows:
        by_bucket.setdefault(code // WIDTH // WIDTH, []).append((code // WIDTH % WIDTH, code % WIDTH, n))
    last = None
    for b in range(BUCKETS):
        if b in by_bucket:
            two, one, n = np.array(by_bucket[b]).T
            p = np.stack((of_bin(two), of_bin(one), np.full(len(n), 1 / (types + 1))))
            mixed = np.array([1 / 3, 1 / 3, 1 / 3] if b else [0, 0.5, 0.5])
            for _ in range(TURNS):
                share = mixed[:, None] * p
                mixed = (share / share.sum(axis=0) * n).sum(axis=1) / n.sum()
            found[b] = last = np.maximum(mixed, 1e-9) / np.maximum(mixed, 1e-9).sum()
        elif b and last is not None:
            found[b] = last  # a frequency that no left-out context has: as its nearest smaller one
        if b == 0:
            found[0, 0] = 0.0  # an unknown context has no bigrams to share its weight
            found[0] /= found[0].sum()
    return found


def scored(rows: DataFrame, kind: str, word_parts: int, pair_parts: int, tokens: int, types: int, mixture: np.ndarray) -> DataFrame:
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for r, row in enumerate(batch.drop_columns(["keys"]).to_pylist()):
            chunk, word, context, pair = estimates(row, word_parts, pair_parts)
            base = np.log10((word + SMOOTH) / (tokens + SMOOTH * (types + 1)))
            share = mixture[bucket(context)]
            p = share[:, 0] * pair / np.maximum(context, 1) + share[:, 1] * word / max(1, tokens) + share[:, 2] / (types + 1)
            starts = np.cumsum(chunk.lengths) - chunk.lengths
            total = lambda values: np.add.reduceat(values, starts)
            n = len(starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("keys")[r].values, pa.array(chunk.folds == HELD), pa.array(chunk.lengths), pa.array(total((word > 0).astype(np.int64))), pa.array([tokens] * n), pa.array(total(base)), pa.array(total(np.log10(p)))],
                names=["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    schema = f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return map_batches(rows, work, schema)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all texts: key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    Documents whose id's checksum is divisible by ``HELD_OUT`` teach nothing; a tenth of the others give the left-out counts that
    the weights are learned from, and count for the final estimates. A null or empty text is the end token alone; a null id
    counts as the empty id. Repeated rows are documents of their own. Without training tokens the uniform part alone scores;
    an empty table gives no rows.
    """
    size = docs.agg(F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("n")).first().n
    word_parts, pair_parts = spread(size, WORD_PART), spread(size, PAIR_PART)
    check = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    fold = F.when(check % HELD_OUT == 0, HELD).when(F.floor(check / HELD_OUT) % 10 == 0, LEFT_OUT).otherwise(KEPT)
    packed = checkpoint(chunked(docs, key, text, fold, word_parts))
    words = checkpoint(count_words(packed.where("kind = 1").select("key", "chunk", "ids", "known", "left")))
    told = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "n_kept", "v_kept")]).first()
    texts = packed.where("kind = 0").select("chunk", "ids", "lengths", "folds", "keys")
    asked = ask_pairs(texts.drop("keys").join(gathered(words, "words", "number", "kept"), "chunk"), word_parts, pair_parts)
    pairs = checkpoint(count_pairs(asked, told.n_kept))
    # At most buckets * bins * bins numbers reach the driver.
    found = pairs.select(F.explode("evidence").alias("e")).groupBy("e.code").agg(F.sum("e.n").alias("n")).collect()
    mixture = weights([(r.code, r.n) for r in found], told.v_kept)
    known = texts.join(gathered(words, "words", "number", "trained"), "chunk").join(gathered(pairs, "pairs", "trained"), "chunk")
    kind = docs.schema[key].dataType.simpleString()
    return scored(known, kind, word_parts, pair_parts, told.n, told.v, mixture).withColumnRenamed("key", key)
