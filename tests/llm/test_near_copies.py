"""Near copies of documents: what merely shares a passage is no candidate group, and no link is lost."""

import random

import brute_llm as brute
import numpy as np
import pyarrow as pa
import pytest
from contractflow.llm import jaccard, keyed

PASSAGE = "all rights reserved by the authors of this work and their heirs"


def words(draw, n):
    return [f"w{draw.randrange(10**9)}" for _ in range(n)]


def test_documents_that_share_a_passage_are_no_group(spark, make, monkeypatch):
    """Ninety unlike documents with one passage in common and one pair of near copies: nearly all were verified as one group."""
    draw = random.Random(3)
    texts = [" ".join([*words(draw, 40), PASSAGE, *words(draw, 40)]) for _ in range(90)]
    texts.append(texts[0] + " end")
    docs, asked = make([(i, t, "en", "a") for i, t in enumerate(texts)]), []
    monkeypatch.setattr(jaccard, "placed", lambda wanted, elements, place=jaccard.placed: asked.append(wanted.select("class", "group").collect()) or place(wanted, elements))
    found = {r.doc_id: r.component_id for r in jaccard.join_documents(docs, size=5, percent=80).collect()}
    assert found == {i: i % 90 for i in range(91)}
    assert len(asked[0]) == 2 and len({r.group for r in asked[0]}) == 1


@pytest.mark.parametrize("size, percent", [(5, 80), (3, 90)])
def test_crowds_of_copies_of_copies(spark, make, size, percent):
    """Sixty texts, each with a word changed since the one before, share keys with more than a few others and with passages elsewhere."""
    draw = random.Random(percent)
    rows = []
    for base in range(3):
        text = [*words(draw, 30 * 4**base), *PASSAGE.split()]
        for i in range(20):
            rows.append((100 * base + i, " ".join(text), "en", "a"))
            text[draw.randrange(len(text) - 12)] = f"v{i}"
    rows += [(1000 + i, " ".join([*words(draw, 30), PASSAGE]), "en", "a") for i in range(20)]
    docs = make(rows)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_documents(docs, size=size, percent=percent).collect())
    sets = [brute.shingles(t, size) for _, t, *_ in rows]
    root = brute.roots(len(rows), lambda i, j: brute.similar(sets[i], sets[j], percent))
    least = {}
    for r, k in zip(rows, root, strict=True):
        least.setdefault(k, r[0])  # rows come by key
    assert got == sorted((r[0], len(s), least[k]) for r, s, k in zip(rows, sets, root, strict=True))
    assert {r[2] for r in got if r[0] < 1000} != {r[0] for r in got if r[0] < 1000}


def test_sketches_rule_out_no_linked_pair():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        sets, linked = [], []
        for n in (1, 2, 9, 60, 250, 256, 257, 511, 600, 3000, 20000):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            lost = int(rng.integers(0, (100 - percent) * n // 100 + 1))
            sets += [a, a[lost:]]
            linked.append(jaccard.links(percent)[0](a, a[lost:]))
        assert all(linked)
        sizes, sketches = [len(x) for x in sets], [jaccard.sketch(x) for x in sets]
        near = jaccard.near_sketches(percent)([pa.chunked_array([pa.array(sizes)]), pa.chunked_array([pa.array(sketches)])])(0, len(sets))
        for i in range(0, len(sets), 2):
            found = near(i, np.arange(i + 1, len(sets)))
            assert found[0]
            assert not found[1:].any() or sizes[i] < 3  # an unlike set of like size is ruled out


def test_sketches_fold():
    rng = np.random.default_rng(6)
    found = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (3000, 40, 900)]
    longer = [keyed.parity([x], w).tobytes() for x, w in zip(found, (64, 4, 16), strict=True)]
    assert (keyed.folded(longer, 4) == keyed.parity(found, 4)).all()


def test_narrow_keys_meet(spark):
    keys = np.array([1 << 47, 5, (1 << 48) - 1], np.uint64)
    assert (keyed.widened(keyed.narrow(keys | np.uint64(3 << 60), 6), 6) == keys).all()
    frame = spark.createDataFrame([(i, keyed.narrow(np.append(keys, np.uint64(i << 40)), 6)) for i in range(5, 17)], "class long, keys binary").repartition(3)
    assert sorted(keyed.stars(frame, keys_per_part=7, width=6).distinct().collect()) == [(5, i) for i in range(6, 17)]


def test_one_of_each_keeps_columns_and_one_of_equal_rows(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text, "a"), (5, text, "b"), (7, text + " x", "c"), (9, "other words here", "d"), (9, "other words here", "d"), (11, None, "e"), (11, None, "e"), (None, text, "f"), (None, "alone stands this", "g"), (None, "alone stands this", "h")]
    left = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, n string"), size=5, percent=80)
    assert left.columns == ["doc_id", "text", "n"]
    got = sorted((str(r.doc_id), str(r.text), r.n) for r in left.collect())
    assert [g[:2] for g in got] == [("11", "None"), ("5", text), ("9", "other words here"), ("None", "alone stands this")]
    assert {g[2] for g in got} <= set("abdegh")
