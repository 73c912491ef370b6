"""Fill-in-middle texts over seekable compressed frames.

A text is stored as independent zstandard frames, each with the running counts of its units, code points and bytes. A cut is found
by its unit in those counts, so only the frames that hold a cut are decompressed and split; all others move to their new
place as they are. Digests and the way back stream the frames in order, one decompressed at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches

PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Marks before the prefix, the suffix and the middle. A text that has one of them stays plain.
MARKS = ("<P>", "<S>", "<M>")
SEED = 7
#: Of 100 texts, those that are transformed, and of 100 of these, those whose suffix comes first.
PERCENT = 100
SUFFIX_FIRST = 50
#: Bytes of text in a frame.
FRAME = 1 << 16
LEVEL = 1
FRAMES = "array<struct<units:long,chars:long,bytes:long,data:binary>>"
_FRAME_TYPE = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("data", pa.binary())]))


def line_ends(piece: bytes) -> int:
    return piece.count(b"\n")


def code_points(piece: bytes) -> int:
    return len(piece) if piece.isascii() else len(piece.decode("utf-8", "surrogatepass"))


#: What ends a unit of each kind of cut.
UNITS = {"line": line_ends, "char": code_points}


def after_unit(piece: bytes, number: int, unit: str) -> int:
    """The byte position behind the unit of this number (from 1) in a piece that has so many."""
    if number <= 0:
        return 0
    if unit == "char":
        return len(piece.decode("utf-8", "surrogatepass")[:number].encode("utf-8", "surrogatepass"))
    at = -1
    for _ in range(number):
        at = piece.index(b"\n", at + 1)
    return at + 1


@dataclass
class Frames:
    """Compressed frames in order; frame i ends after so many ended units, code points and bytes of the whole."""

    units: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    bytes: list[int] = field(default_factory=list)
    data: list[bytes] = field(default_factory=list)

    def put(self, units: int, chars: int, size: int, data: bytes) -> None:
        for counts, more in ((self.units, units), (self.chars, chars), (self.bytes, size)):
            counts.append((counts[-1] if counts else 0) + more)
        self.data.append(data)

    def add(self, piece: bytes, unit: str = "line") -> None:
        if piece:
            self.put(UNITS[unit](piece), code_points(piece), len(piece), zstandard.ZstdCompressor(level=LEVEL).compress(piece))

    @classmethod
    def of(cls, text: bytes, unit: str = "line", size: int = FRAME) -> Frames:
        found, at = cls(), 0
        while at < len(text):
            end = min(len(text), at + size)
            while end < len(text) and text[end] & 0xC0 == 0x80:
                end += 1  # no code point stands in two frames
            found.add(text[at:end], unit)
            at = end
        return found

    @classmethod
    def read(cls, rows: list[dict]) -> Frames:
        return cls(*([row[name] for row in rows] for name in ("units", "chars", "bytes", "data")))

    def rows(self) -> list[dict]:
        names = ("units", "chars", "bytes", "data")
        return [dict(zip(names, row, strict=True)) for row in zip(self.units, self.chars, self.bytes, self.data, strict=True)]

    @property
    def size(self) -> int:
        return self.bytes[-1] if self.bytes else 0

    def before(self, counts: list[int], i: int) -> int:
        return counts[i - 1] if i else 0

    def open(self, i: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.data[i], max_output_size=self.bytes[i] - self.before(self.bytes, i))

    def seek(self, number: int, unit: str) -> tuple[int, int]:
        """Bytes and code points before the end of the unit of this number; beyond the last unit end, those of the whole text."""
        if number <= 0:
            return 0, 0
        i = bisect_left(self.units, number)
        if i == len(self.units):
            return self.size, self.chars[-1] if self.chars else 0
        piece = self.open(i)
        at = after_unit(piece, number - self.before(self.units, i), unit)
        return self.before(self.bytes, i) + at, self.before(self.chars, i) + code_points(piece[:at])

    def stream(self, start: int = 0, end: int | None = None) -> Iterator[bytes]:
        """The bytes from start to end, frame by frame."""
        end = self.size if end is None else end
        i = bisect_right(self.bytes, start)
        while start < end and i < len(self.data):
            low = self.before(self.bytes, i)
            piece = self.open(i)[start - low : end - low]
            yield piece
            start += len(piece)
            i += 1

    def take(self, other: Frames, start: int, end: int, unit: str) -> None:
        """Append the bytes from start to end of other frames. Whole frames are not decompressed."""
        i = bisect_right(other.bytes, start)
        while start < end:
            low, high = other.before(other.bytes, i), other.bytes[i]
            if start == low and end >= high:
                self.put(other.units[i] - other.before(other.units, i), other.chars[i] - other.before(other.chars, i), high - low, other.data[i])
            else:
                self.add(other.open(i)[start - low : end - low], unit)
            start, i = high, i + 1

    def find(self, marks: Iterable[str]) -> dict[str, int]:
        """The first byte position of each mark that stands in the frames, also where it reaches over two."""
        wanted = {mark.encode(): mark for mark in marks}
        keep = max(map(len, wanted)) - 1
        found: dict[str, int] = {}
        tail, at = b"", 0
        for piece in self.stream():
            piece = tail + piece
            for raw, mark in wanted.items():
                if mark not in found and (where := piece.find(raw)) >= 0:
                    found[mark] = at + where
            tail = piece[len(piece) - keep :] if keep and len(piece) > keep else piece if keep else b""
            at += len(piece) - len(tail)
        return found

    def digest(self) -> str:
        return streamed(self.stream())


def streamed(pieces: Iterable[bytes]) -> str:
    state = hashlib.sha256()
    for piece in pieces:
        state.update(piece)
    return state.hexdigest()


@dataclass(frozen=True)
class Draw:
    """What is drawn for each text: its seed, the kind of units that are cut, and the parts of 100 that are transformed and put the suffix first."""

    seed: int = SEED
    unit: str = "line"
    percent: int = PERCENT
    suffix_first: int = SUFFIX_FIRST
    marks: tuple[str, str, str] = MARKS

    def numbers(self, key: object) -> tuple[int, ...]:
        digest = hashlib.sha256(f"{self.seed}:{'' if key is None else key}".encode()).hexdigest()
        return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


@dataclass(frozen=True)
class Made:
    units: int
    form: str
    prefix: int | None
    middle: int | None
    output: Frames


def unit_count(frames: Frames, unit: str) -> int:
    """Units of the whole text: a last line without a line end counts as well."""
    ended = frames.units[-1] if frames.units else 0
    return ended + (unit == "line" and frames.size > 0 and not frames.open(len(frames.data) - 1).endswith(b"\n"))


def transformed(key: object, text: Frames, draw: Draw) -> Made:
    """A stored text in its drawn form, with the code points of its prefix and middle."""
    count = unit_count(text, draw.unit)
    first, second, form, order = draw.numbers(key)
    if not text.size or form % 100 >= draw.percent or text.find(draw.marks):
        return Made(count, PLAIN, None, None, text)
    cuts = sorted((first % (count + 1), second % (count + 1)))
    (a, a_chars), (b, b_chars) = (text.seek(cut, draw.unit) for cut in cuts)
    pre, suf, mid = draw.marks
    parts = [(pre, 0, a), (suf, b, text.size), (mid, a, b)]
    suffix_first = order % 100 < draw.suffix_first
    if suffix_first:
        parts[:2] = parts[1::-1]
    output = Frames()
    for mark, start, end in parts:
        output.add(mark.encode(), draw.unit)
        output.take(text, start, end, draw.unit)
    return Made(count, SPM if suffix_first else PSM, a_chars, b_chars - a_chars, output)


def restored(output: Frames, form: str, marks: tuple[str, str, str] = MARKS) -> Iterator[bytes]:
    """The original text, in pieces, from an output and its form alone."""
    if form == PLAIN:
        return output.stream()
    at = output.find(marks)
    order = sorted(marks, key=at.__getitem__)
    ends = {mark: at[after] for mark, after in zip(order, order[1:], strict=False)}
    pre, suf, mid = marks
    spans = ((at[m] + len(m.encode()), ends.get(m, output.size)) for m in (pre, mid, suf))
    return (piece for start, end in spans for piece in output.stream(start, end))


def _key_type(docs: DataFrame, key: str) -> str:
    return f"`{key}` {docs.schema[key].dataType.simpleString()}"


def store(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "line", size: int = FRAME) -> DataFrame:
    """Every text as seekable frames: key, ``frames`` (units, chars and bytes up to the frame's end, data). Null is stored as empty: no frames.

    One row per input row, repeated and null keys included; other columns are not read. A table that is written to Parquet can be
    searched by its counts without reading ``frames.data``.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw = batch.column(1).cast(pa.binary())
        for i in range(len(raw)):  # one by one: a long text is not held together with the frames of others
            frames = Frames.of(raw[i].as_py() or b"", unit, size)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([frames.rows()], _FRAME_TYPE)], names=[key, "frames"])

    return map_batches(docs.select(key, text), gathered(work), f"{_key_type(docs, key)}, frames {FRAMES}")


def gathered(work, limit: int = 1 << 22):
    """Small batches of ``work`` joined to batches of about so many bytes."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        total = 0
        for one in work(batch):
            held.append(one)
            total += one.nbytes
            if total >= limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, total = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return run


def fill_in_middle(stored: DataFrame, key: str = "doc_id", draw: Draw = Draw()) -> DataFrame:
    """Stored texts in their drawn form: key, n (units), form, prefix_chars, middle_chars (null if plain), ``output`` (frames).

    The draw depends on the seed and the key only (a null key counts as the empty text), so reruns agree and repeated rows have one
    result. A text that is empty, has one of the marks or is not drawn stays plain. ``stored`` is as ``store`` makes it with the draw's unit.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = batch.column(0).to_pylist()
        for i, name in enumerate(keys):
            made = transformed(name, Frames.read(batch.column(1)[i].as_py() or []), draw)
            row = [[made.units], [made.form], [made.prefix], [made.middle]]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(v, k) for v, k in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), *columns, pa.array([made.output.rows()], _FRAME_TYPE)], names=[key, "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = f"{_key_type(stored, key)}, n long, form string, prefix_chars long, middle_chars long, output {FRAMES}"
    return map_batches(stored.select(key, "frames"), gathered(work), schema)


def digests(made: DataFrame, key: str = "doc_id", marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """The transformed rows with the digests of their output and of the text rebuilt from it, in place of the output."""
    names = [key, "n", "form", "prefix_chars", "middle_chars"]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        outputs, forms = batch.column(len(names)), batch.column(names.index("form")).to_pylist()
        out, back = [], []
        for i, form in enumerate(forms):
            frames = Frames.read(outputs[i].as_py() or [])
            out.append(frames.digest())
            back.append(streamed(restored(frames, form, marks)))
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(out), pa.array(back)], names=[*names, "output_sha256", "restored_sha256"])

    schema = f"{_key_type(made, key)}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return map_batches(made.select(*names, "output"), work, schema)


def text_of(frames: Column | str) -> Column:
    """The text of a column of frames (for looking at results and for writing them as plain text)."""

    @F.pandas_udf("string")
    def join(rows):  # noqa: ANN001, ANN202
        return rows.map(lambda frames: b"".join(Frames.read(list(frames)).stream()).decode("utf-8", "surrogatepass"))

    return join(frames)


def fill_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", draw: Draw = Draw(), size: int = FRAME) -> DataFrame:
    """Store, transform and digest all rows: one map over the texts, nothing is shuffled. An empty table gives no rows."""
    return digests(fill_in_middle(store(docs, key, text, draw.unit, size), key, draw), key, draw.marks)


#: The same results by lists of lines.
SQL = rf"""
WITH lines AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), numbers AS (
    SELECT *, len(units) AS n, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT FOR i IN [0, 1, 2, 3]] AS d FROM lines
), cuts AS (
    SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= {PERCENT} THEN 'plain'
            WHEN d[4] % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:], '') AS suf FROM cuts
), outputs AS (
    SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS output FROM parts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
    sha256(output) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN output
        WHEN 'psm' THEN substr(split_part(output, '<S>', 1), 4) || split_part(output, '<M>', 2) || split_part(split_part(output, '<S>', 2), '<M>', 1)
        ELSE split_part(split_part(output, '<P>', 2), '<M>', 1) || split_part(output, '<M>', 2) || substr(split_part(output, '<P>', 1), 4) END) AS restored_sha256
FROM outputs
"""
