"""Operators with a seeded draw: fill-in-middle texts and importance resampling, against plain versions."""

import hashlib
import math
import random
import re
import zlib

import pytest

from contractflow.llm import middles, resampling

LINES = ["", "\n", "\n\n", "a", "a\n", "é\nü😀\n\nx", "<P>a\nb", "a\n<S", "x<M>", "ab\n" * 500, "no line end " * 300, "😀" * 700, "中文\n字" * 200, "<P", None]


def plain_form(key, text, draw):
    """The contract's output, from a list of units."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if draw.unit == "line" else list(text)
    digest = hashlib.sha256(f"{draw.seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in draw.marks) or h[2] % 100 >= draw.percent:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = draw.marks
    if h[3] % 100 < draw.suffix_first:
        return len(units), "spm", len(pre), len(mid), s + suf + p + pre + m + mid
    return len(units), "psm", len(pre), len(mid), p + pre + s + suf + m + mid


@pytest.mark.parametrize("unit", ["line", "char"])
@pytest.mark.parametrize("size", [1, 7, 64, 1 << 16])
def test_forms_equal_those_of_unit_lists(unit, size):
    for draw in (middles.Draw(unit=unit), middles.Draw(seed=3, unit=unit, percent=60, suffix_first=20)):
        for key in (*range(12), None, "x"):
            for text in LINES:
                stored = middles.Frames.of((text or "").encode(), unit, size)
                made = middles.transformed(key, stored, draw)
                got = b"".join(made.output.stream()).decode()
                assert (made.units, made.form, made.prefix, made.middle, got) == plain_form(key, text, draw)
                assert b"".join(middles.restored(made.output, made.form, draw.marks)).decode() == (text or "")


def test_only_cut_frames_are_opened(monkeypatch):
    text = "".join(f"line {i}\n" for i in range(5000)).encode()
    stored, opened = middles.Frames.of(text, size=512), []
    keep = middles.Frames.open
    monkeypatch.setattr(middles.Frames, "open", lambda self, i: opened.append(i) or keep(self, i))
    output = middles.Frames()
    at = [stored.seek(number, "line")[0] for number in (1200, 3700)]
    for start, end in ((at[1], len(text)), (0, at[0]), (at[0], at[1])):
        output.take(stored, start, end, "line")
    assert len(set(opened)) == 2 and len(opened) <= 6
    assert b"".join(output.stream()) == text[at[1] :] + text[: at[0]] + text[at[0] : at[1]]
    assert text[: at[0]].count(b"\n") == 1200 and output.size == len(text) == output.bytes[-1]


def test_streams_begin_and_end_anywhere():
    text = "aé\n中😀b\n".encode() * 9
    for size in (1, 5, 50):
        stored = middles.Frames.of(text, size=size)
        for start in range(0, len(text), 3):
            for end in range(start, len(text) + 1, 4):
                assert b"".join(stored.stream(start, end)) == text[start:end]


def test_marks_over_frame_edges_are_found():
    for size in range(1, 9):
        assert middles.Frames.of(b"abc<S>de<M", size=size).find(middles.MARKS) == {"<S>": 3}


def test_middles_of_rows(odd, none, make, rows):
    assert middles.fill_documents(none).count() == 0
    docs = make([(i, t, "en", "a") for i, t in enumerate(LINES)] + [(None, "a\nb\n", None, None), (3, "a", "en", "a")])
    for frame in (odd, docs):
        wanted = []
        for r in frame.select("doc_id", "text").collect():
            n, form, a, b, out = plain_form(r.doc_id, r.text, middles.Draw())
            wanted.append((r.doc_id, n, form, a, b, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
        assert rows(middles.fill_documents(frame, size=3)) == sorted(wanted, key=repr)
    made = middles.fill_in_middle(middles.store(docs))
    texts = {r.doc_id: r.t for r in made.where("doc_id is not null").select("doc_id", middles.text_of("output").alias("t")).collect()}
    assert all(texts[i] == plain_form(i, t, middles.Draw())[4] for i, t in enumerate(LINES) if i != 3)


def test_checksums_of_features():
    draw = random.Random(5)
    words = [bytes(draw.randrange(256) for _ in range(draw.choice([1, 2, 3, 7, 7, 7, 40, 1024, 1025, 3000]))) for _ in range(400)]
    assert resampling.crc32_all(words).tolist() == [zlib.crc32(w) for w in words]
    assert resampling.crc32_all([]).tolist() == [] and resampling.crc32_all([b"a"]).tolist() == [zlib.crc32(b"a")]


def plain_features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def plain_draw(docs, target, longest=1, buckets=10_000, percent=10, least_words=20, seed=2024):
    """(key, n_features, weight, score, rank) of (key, text) rows; ranks of rows equal in score and key are given in any order."""
    at = lambda f: zlib.crc32(f.encode()) % buckets
    source, wanted = [0] * buckets, [0] * buckets
    for texts, counts in (([t for _, t in docs], source), (target, wanted)):
        for text in texts:
            for f in plain_features(text, longest)[1]:
                counts[at(f)] += 1
    s, t = sum(source), sum(wanted)
    gain = [math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets)))) for a, b in zip(source, wanted, strict=True)]
    out = []
    for key, text in docs:
        words, found = plain_features(text, longest)
        weight = sum(gain[at(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((len(words) >= least_words, key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    drawn = len(fit) * percent // 100
    return sorted(((*r[1:], i + 1 if i < drawn else None) for i, r in enumerate(fit)), key=repr), [(*r[1:], None) for r in out if not r[0]]


@pytest.mark.parametrize("longest, percent, least_words", [(1, 10, 20), (1, 50, 0), (3, 100, 5), (2, 0, 5)])
def test_draw_equals_a_plain_one(spark, sample, rows, longest, percent, least_words):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    got = rows(resampling.resample(sample, target, longest=longest, percent=percent, least_words=least_words))
    fit, rest = plain_draw(docs, [r.text for r in target.collect()], longest, 10_000, percent, least_words)
    assert got == sorted(fit + rest, key=repr)


def test_draw_of_odd_rows(spark, odd, none, make, rows):
    target = spark.createDataFrame([("one two x",), (None,), ("",)], "text string")
    assert resampling.resample(none, target).count() == 0
    nothing = spark.createDataFrame([], "text string")
    many = make([(7, "one two three " * 9, "en", "a")] * 40 + [(None, "one two " * 30, "en", "a")] * 30 + [(i, "x" * i + " one " * i, "en", "b") for i in range(40)])
    for frame in (odd, many):
        for aim in (target, nothing):
            docs = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
            fit, rest = plain_draw(docs, [r.text for r in aim.collect()], percent=30, least_words=3)
            assert rows(resampling.resample(frame, aim, percent=30, least_words=3)) == sorted(fit + rest, key=repr)


def test_long_texts_are_taken_piece_by_piece():
    text = " ".join(random.Random(1).choice(["ab", "É", "c1", "-", "Zz"]) for _ in range(900))
    for longest in (1, 2, 4):
        wanted = sorted(plain_features(text, longest)[1])
        found = [f.decode() for words, before in resampling.pieces(text, longest, 50) for f in resampling.features(words, before, longest)]
        assert sorted(found) == wanted
