"""Language identification with bitmask filters: one Bloom filter per language, sliced so that a look-up returns all languages.

Training counts character trigrams per language over all training texts. A trigram goes into a language's filter if it makes up
a given part of that language's trigrams, so a filter's fill is bounded however much text there is. The filters share
their cells: cell c holds one bit per language, and the languages of a trigram are the AND of the cells that its hashes
choose. A text's popcount per language, less the false positives expected from the filter's fill, decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_batches, mix

UNKNOWN = "und"
#: A trigram belongs to a language if at least this part of the language's trigrams are it.
LEAST = 5e-5
#: Cells of the filters and hashes of a trigram. A language has at most 1 / LEAST trigrams, so a filter is at most 2 % full.
CELLS = 1 << 21
HASHES = 2
HELD_OUT = 5
#: Code units of text whose trigrams are looked at together; each takes some 60 bytes for a while.
STRETCH = 500_000
#: Largest code point, and for each code point whether it is a letter.
_TOP = 0x110000
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(_TOP)), bool, _TOP))
    return _LETTER[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All trigrams of texts as exact numbers, the text each is from, and whether each text has a letter.

    Texts are lower-cased; everything but letters counts as a space, and runs of spaces as one. A trigram that
    is of no letter is left out, and none reaches over two texts.
    """
    lowered = [t.lower() for t in texts]
    lengths = np.fromiter((len(t) + 2 for t in lowered), np.int64, len(texts))
    points = np.frombuffer("".join(f" {t} " for t in lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    is_letter = letters()[points]
    has = np.bincount(text[is_letter], minlength=len(texts)) > 0
    first = np.concatenate(([True], text[1:] != text[:-1]))
    kept = is_letter | first | np.concatenate(([False], is_letter[:-1]))  # of a run of spaces, the first one
    points, text = np.where(is_letter, points, 32)[kept].astype(np.uint64), text[kept]
    grams = points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]
    inside = (text[2:] == text[:-2]) & (points[1:-1] != 32)
    return grams[inside], text[2:][inside], has


def counted(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """How often each trigram stands in the texts of each language: lang, gram, n."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = batch.column(1).to_pylist()
        by_lang: dict[str, list[str]] = {}
        for name, value in zip(names, batch.column(0).to_pylist(), strict=True):
            by_lang.setdefault(name, []).append(value)
        for name, texts in by_lang.items():
            for _, some in chunks(texts, STRETCH):
                grams, n = np.unique(trigrams(some)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    found = map_batches(docs.select(text, lang), work, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Filters:
    """Languages in order, their bits by cell (a row per word of 64 languages), and each filter's false positive rate."""

    names: tuple[str, ...]
    cells: np.ndarray
    false: np.ndarray

    def masks(self, grams: np.ndarray) -> list[np.ndarray]:
        """For each word of 64 languages, the mask of the languages that hold each trigram."""
        found = []
        for word in self.cells:
            mask = word[place(grams, 0)]
            for i in range(1, HASHES):
                mask = mask & word[place(grams, i)]
            found.append(mask)
        return found


def place(grams: np.ndarray, i: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(grams + np.uint64(i) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(CELLS - 1)).astype(np.int64)


def build(rows: list[tuple[str, int]]) -> Filters:
    """Filters from (language, trigram) rows."""
    names = tuple(sorted({name for name, _ in rows}))
    at = {name: i for i, name in enumerate(names)}
    cells = np.zeros(((len(names) + 63) // 64, CELLS), np.uint64)
    grams = np.array([g for _, g in rows], np.int64).view(np.uint64)
    which = np.array([at[name] for name, _ in rows], np.int64)
    for i in range(HASHES if len(rows) else 0):
        np.bitwise_or.at(cells, (which // 64, place(grams, i)), np.uint64(1) << (which % 64).astype(np.uint64))
    fill = np.array([np.count_nonzero(cells[i // 64] & np.uint64(1 << i % 64)) / CELLS for i in range(len(names))])
    return Filters(names, cells, fill**HASHES)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", least: float = LEAST) -> Filters:
    """Filters of all languages in ``lang``, from all rows with a text and a language.

    At most 1 / least trigrams of a language reach the driver; languages are as many as the labels.
    """
    counts = counted(docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()), text, lang)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(totals, "lang").where(F.col("n") >= F.col("total") * least).select("lang", "gram")
    return build([(r.lang, r.gram) for r in kept.collect()])


def predict(texts: list[str | None], filters: Filters) -> tuple[list[str], list[float]]:
    """Language and score of each text: the language with the largest corrected popcount, and that popcount's part of all trigrams."""
    said, scores = [], []
    for _, some in chunks(texts, STRETCH):
        grams, text, has = trigrams(some)
        total = np.bincount(text, minlength=len(some)).astype(np.float64)
        masks = filters.masks(grams)
        hits = np.zeros((len(filters.names), len(some)))
        for i in range(len(filters.names)):
            found = masks[i // 64] >> np.uint64(i % 64) & np.uint64(1) != 0
            counts = np.bincount(text[found], minlength=len(some))
            hits[i] = np.maximum(0, counts - filters.false[i] * total) / (1 - filters.false[i])
        if not len(filters.names):
            said += [UNKNOWN] * len(some)
            scores += [0.0] * len(some)
            continue
        best = hits.argmax(axis=0)
        reach = np.minimum(1.0, hits[best, np.arange(len(some))] / np.maximum(total, 1))
        said += [filters.names[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
        scores += np.where(has, reach, 0.0).tolist()
    return said, scores


def held_out(key: str = "doc_id", folds: int = HELD_OUT):
    """Whether a document is kept from learning: by the checksum of its id (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == 0


def identify(docs: DataFrame, filters: Filters, key: str = "doc_id", text: str = "text", carry: list[str] = ()) -> DataFrame:
    """Every row with ``lang_pred`` and ``score`` (0 to 1): key, the carried columns, lang_pred, score.

    A text that is null or has no letter is ``und`` with score 0; so is every text where nothing was learned. The score is the
    part of the text's trigrams that are known to the language. Only the text is an input of the prediction.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(filters)  # fixed size: CELLS words for each 64 languages
    names = [key, *carry]
    fields = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        said, scores = predict(batch.column(len(names)).to_pylist(), sent.value)
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(said), pa.array(scores)], names=[*names, "lang_pred", "score"])

    return map_batches(docs.select(*names, F.col(text).alias("_text")), work, f"{fields}, lang_pred string, score double")


def known_language(docs: DataFrame, filters: Filters, least: float, text: str = "text") -> DataFrame:
    """The rows whose text is of a learned language with at least this score, with their columns as they are; nothing else is kept."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)
    at = docs.columns.index(text)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        said, scores = predict(batch.column(at).to_pylist(), sent.value)
        yield batch.filter(pa.array([name != UNKNOWN and score >= least for name, score in zip(said, scores, strict=True)], pa.bool_()))

    return map_batches(docs, work, docs.schema)


def identify_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the documents that are not held out and predict all: key, held_out, lang_pred, score."""
    filters = learn(docs.where(~held_out(key)), text, lang)
    return identify(docs, filters, key, text).select(key, held_out(key).alias("held_out"), "lang_pred", "score")
