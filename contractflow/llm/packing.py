"""Packing token pieces into sequences of a fixed length: first-fit decreasing in randomised groups of documents.

A document's tokens are cut at the sequence length. Whole pieces fill sequences of their own; the rests of a group of
documents are packed by first-fit decreasing. A tournament tree over the bins' free room finds the first bin that fits.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK, Memory, chunks, map_batches, spread

LENGTH = 2048
END = 1
GROUP = 2048
TOKENIZER = "word_bpe_49k.json"
#: Bytes, about, of parts of texts that a worker remembers.
PART_BYTES = 128 << 20
SEED = 20
#: Sequences are numbered from group * ROOM; no group of documents can have more.
ROOM = 1 << 32


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


#: Characters for which the tokenizer's rules are these: lower-case, then cut into endings, letters, single digits, others.
#: (White space, printable ASCII and Latin-1 letters, which no normal form changes.)
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")


class Encoder(Memory):
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    The tokenizer's rules never look across ASCII white space, so a text's ids are those of its parts, one after the other. Plain
    characters are cut into pieces as the tokenizer does (keys are str); stretches with other characters, between white
    space, go through the whole tokenizer (keys are bytes). The ids of parts are remembered.
    """

    _loaded: dict[str, Encoder] = {}

    @classmethod
    def load(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer, pre_tokenizers

            cls._loaded[path] = made = cls(PART_BYTES)
            made.whole = Tokenizer.from_file(path)
            made.model = made.whole.model
            made.bare = Tokenizer(made.model)
            made.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            # Only the named tokenizer is known to follow the rules of _PIECES.
            made.cuts = os.path.basename(path) == TOKENIZER
        return cls._loaded[path]

    def plain(self, text: str) -> bool:
        return self.cuts and "<|" not in text and _PLAIN.fullmatch(text) is not None

    def parts(self, text: str) -> list:
        if self.plain(text):
            return _PIECES.findall(text.lower())
        found: list = []
        for stretch in text.encode().split():
            found += self.parts(one) if self.plain(one := stretch.decode()) else [stretch]
        return found

    def learn(self, parts: set) -> None:
        letters = [p for p in parts if isinstance(p, str)]
        others = [p for p in parts if not isinstance(p, str)]
        beyond = [p for p in letters if not p.isascii()]
        spell = self.model.tokenize  # for ASCII, the byte level is the text itself
        self.update((p, array("I", [t.id for t in spell(p)]).tobytes()) for p in letters if p.isascii())
        for tokenizer, keys, texts in ((self.bare, beyond, beyond), (self.whole, others, [p.decode() for p in others])):
            found = tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
            self.update((key, array("I", e.ids).tobytes()) for key, e in zip(keys, found, strict=True))

    def ids(self, texts: list[str]) -> list[bytes]:
        parts = [self.parts(text) for text in texts]
        every = set(chain.from_iterable(parts))
        new = every.difference(self)
        if self.grown(sum(map(len, new)) * 2 + 180 * len(new)):
            new = every
        self.learn(new)
        return [b"".join(map(self.__getitem__, some)) for some in parts]


class FirstFit:
    """Free room of bins in a tournament tree: each inner node holds the largest room below it."""

    def __init__(self, items: int, room: int):
        self.width = 1 << max(0, items - 1).bit_length()
        self.tree = [room] * (2 * self.width)
        self.used = 0

    def place(self, size: int) -> int:
        """The first bin that has room for so much; its room shrinks."""
        at, tree = 1, self.tree
        while at < self.width:
            at *= 2
            if tree[at] < size:
                at += 1
        found = at - self.width
        tree[at] -= size
        while at > 1:
            at //= 2
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
        self.used = max(self.used, found + 1)
        return found


def tokenized(docs: DataFrame, tokenizer: str, key: str, text: str, length: int, end: int, keep_ids: bool) -> DataFrame:
    """Per document: key, doc_tokens (with the end id), crcs (of its pieces), and the ids if they are kept."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoder, tail = Encoder.load(tokenizer), np.array([end], "<u4").tobytes()
        counts, crcs, kept = [], [], []
        for _, texts in chunks(batch.column(1).to_pylist(), CHUNK // 4):
            for ids in encoder.ids(texts):
                ids += tail
                counts.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[i : i + 4 * length]) for i in range(0, len(ids), 4 * length)])
                kept.append(ids if keep_ids else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(kept, pa.binary())],
            names=["key", "doc_tokens", "crcs", "ids"],
        )

    kind = docs.schema[key].dataType.simpleString()
    return map_batches(docs.select(key, text), work, f"key {kind}, doc_tokens long, crcs array<long>, ids binary", "Encoder")


def packed(group: int, counts: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one group's documents, given their token counts."""
    following = group * ROOM
    for d, count in enumerate(counts):
        for start in range(0, count - length + 1, length):
            yield d, start, length, following, 0
            following += 1
    rests = counts % length
    items = np.nonzero(rests)[0]
    order = items[np.argsort(-rests[items], kind="stable")]
    bins, filled = FirstFit(len(order), length), {}
    for d in order.tolist():
        size = int(rests[d])
        where = bins.place(size)
        offset = filled.get(where, 0)
        filled[where] = offset + size
        yield d, int(counts[d]) - size, size, following + where, offset


def pack(
    docs: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END, group: int = GROUP, keep_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with their place: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document ends with the ``end`` id, so a null or empty text is one piece of one token, and every row of the input
    (repeated and null keys too) has its own pieces; an empty table gives none. Pieces start at multiples of ``length``.
    Groups of about ``group`` documents are drawn by a hash of the row; each is packed by itself, so a group is all that a
    task holds. With ``keep_ids`` each piece carries its ids (little-endian unsigned 32 bits) in ``ids``. Equal rows share
    a group; their pieces are interchangeable.
    """
    tokenizer = tokenizer or default_tokenizer()
    groups = spread(docs.count(), group)
    rows = tokenized(docs, tokenizer, key, text, length, end, keep_ids)
    rows = rows.withColumn("_group", F.pmod(F.xxhash64(F.lit(SEED), "key", "doc_tokens", "crcs"), F.lit(groups)))
    kind = docs.schema[key].dataType.simpleString()

    def place(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("doc_tokens", "ascending")]).combine_chunks()
        counts, crcs = rows["doc_tokens"].to_numpy(), rows["crcs"].to_pylist()
        found = np.array(list(packed(rows["_group"][0].as_py(), counts, length)), np.int64).reshape(-1, 5)
        at, start, size, sequence, offset = found.T
        crc = np.fromiter((crcs[d][s // length] for d, s in zip(at, start, strict=True)), np.int64, len(at))
        columns = [rows["key"].take(pa.array(at)), start, size, crc, counts[at], sequence, offset]
        names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if keep_ids:
            ids = rows["ids"].to_pylist()
            columns.append(pa.array([ids[d][4 * s : 4 * (s + n)] for d, s, n in zip(at, start, size, strict=True)], pa.binary()))
            names.append("ids")
        return pa.table(columns, names=names)

    schema = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.groupBy("_group").applyInArrow(place, schema + ", ids binary" * keep_ids)
