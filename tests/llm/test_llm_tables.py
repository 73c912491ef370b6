"""Operators on whole tables: near copies, lines, mixing, shards, vectors, and the pipeline."""

import random
import zlib

import brute_llm as brute
import corpus_pipeline
import duckdb
import numpy as np
import pytest

from contractflow.llm import jaccard, keyed, languages, lines, mixing, neighbours, packing, queries, sharding, topk
from contractflow.llm.components import components
from suite.compare import connect, duck_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def copies(make):
    """Families of edited copies, some of them chained, and texts that share a passage only."""
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, passage = [], [draw.choice(vocabulary) for _ in range(12)]
    for family in range(12):
        words = [draw.choice(vocabulary) for _ in range(draw.choice([1, 2, 3, 8, 15, 40, 90, 200]))]
        for _ in range(draw.randrange(1, 14)):
            rows.append(list(words))
            if draw.random() < 0.7:
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
        rows.append([draw.choice(vocabulary) for _ in range(30)] + passage)
    draw.shuffle(rows)
    return make([(i, " ".join(w), "en", "a") for i, w in enumerate(rows)])


def components_of(docs, size, percent):
    rows = docs.select("doc_id", "text").collect()
    sets = [brute.shingles(r.text, size) for r in rows]
    root = brute.roots(len(rows), lambda i, j: brute.similar(sets[i], sets[j], percent))
    least = {}
    for r, k in zip(rows, root, strict=True):
        if r.doc_id is not None:
            least[k] = min(least.get(k, r.doc_id), r.doc_id)
    return sorted(((r.doc_id, len(s), least.get(k)) for r, s, k in zip(rows, sets, root, strict=True)), key=repr)


@pytest.mark.parametrize("size, percent, elements", [(3, 90, 2_000_000), (5, 80, 2_000_000), (3, 90, 150), (2, 60, 400)])
def test_components_equal_all_pairs(copies, rows, size, percent, elements):
    got = jaccard.join_documents(copies, size=size, percent=percent, elements=elements)
    assert rows(got) == components_of(copies, size, percent)


def test_components_of_odd_rows(odd, none, rows):
    assert rows(jaccard.join_documents(odd)) == components_of(odd, 3, 90)
    assert jaccard.join_documents(none).count() == 0
    left = jaccard.one_of_each(odd)
    assert left.columns == odd.columns and sorted(left.select("doc_id").collect(), key=repr) == [(12,), (13,), (5,), (7,), (8,), (None,)]


def test_no_linked_pair_lacks_a_common_key():
    rng = np.random.default_rng(1)
    for percent in (90, 80, 60):
        linked, near = jaccard.links(percent)
        for _ in range(300):
            a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 300))).astype(np.uint64))
            changed = int(rng.integers(0, jaccard.apart(percent, 2 * len(a)) + 1))
            gone = min(int(rng.integers(0, changed + 1)), len(a) - 1)
            b = np.unique(np.concatenate((rng.permutation(a)[gone:], rng.integers(0, 2**63, changed - gone).astype(np.uint64))))
            if linked(a, b) and not np.array_equal(a, b):
                assert np.isin(jaccard.chunk_keys(a, percent), jaccard.chunk_keys(b, percent)).any()
                assert near([a, b])(0) == [1]


def test_union_find(spark):
    draw = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(draw.randrange(100, 400), draw.randrange(100, 400)) for _ in range(200)] + [(500, 500)]
    edges += [(1000, 1000 + i) for i in range(1, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stars_of_a_hot_key(spark):
    rows = [(i, np.array([1, 10 + i], np.uint64).tobytes()) for i in range(50)] + [(99, b"")]
    frame = spark.createDataFrame(rows, "class long, keys binary").repartition(3)
    assert sorted(keyed.stars(frame, keys_per_part=7).collect()) == [(0, i) for i in range(1, 50)]


def deduplicated(docs):
    rows = sorted(docs.select("doc_id", "text").distinct().collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    seen = [(r.doc_id, r.text, n, lines.normal(line)) for r in rows if r.text is not None for n, line in enumerate(r.text.split("\n"))]
    seen = [x for x in seen if len(x[3]) >= lines.LEAST]
    sets = [{x[3][i : i + lines.SHINGLE] for i in range(len(x[3]) - lines.SHINGLE + 1)} for x in seen]
    root = brute.roots(len(seen), lambda i, j: brute.similar(sets[i], sets[j], lines.SIMILARITY))
    gone = {(k, t, n) for i, (k, t, n, _) in enumerate(seen) if root[i] != i}
    return {(r.doc_id, r.text): r.text if r.text is None else "\n".join(x for n, x in enumerate(r.text.split("\n")) if (r.doc_id, r.text, n) not in gone) for r in rows}


@pytest.mark.parametrize("elements", [2_000_000, 300])
def test_lines_equal_all_pairs(make, elements):
    draw = random.Random(8)
    pool = ["".join(draw.choice("abcdefghij ") for _ in range(draw.choice([10, 30, 60, 200]))) for _ in range(25)]

    def line():
        x = list(draw.choice(pool))
        for _ in range(draw.choice([0, 0, 0, 1, 2])):
            x[draw.randrange(len(x))] = draw.choice("xyz")
        return draw.choice([str, str.upper])("".join(x))

    docs = make([(i, "\n".join(line() for _ in range(draw.randrange(1, 6))), "en", "a") for i in range(60)] + [(70, None, None, None), (71, "", "en", "a"), (None, pool[-1] + "\n\nz", "en", "a")])
    wanted = deduplicated(docs)
    got = lines.dedup_lines(docs, elements=elements).collect()
    assert len(got) == docs.count() and {r.doc_id: r.text for r in got} == {k: t for (k, _), t in wanted.items()}
    lost = sum(len((t or "").split("\n")) - len((wanted[k, t] or "").split("\n")) for k, t in wanted if wanted[k, t] != "")
    assert sum(r.n_removed for r in got if r.text != "") == lost


def test_edited_lines_are_copies(make):
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.choice([3, 4, 5, 6]))) for _ in range(400)]
    rows, kept = [], []
    for length in range(40, 81):  # a character inside
        x = " ".join(draw.choice(words) for _ in range(20))[: length - 1] + "."
        rows += [x, x[: length // 2] + "#" + x[length // 2 + 1 :]]
        kept.append(x)
    for length in range(30, 81, 2):  # a number at the end
        x = " ".join(draw.choice(words) for _ in range(20))[: length - 4].strip() + " 12"
        rows += [x, x[:-1] + "7"]
        kept.append(x)
    for length in range(50, 81):  # a number inside
        x = " ".join(draw.choice(words) for _ in range(20))
        rows += [f"{x[: length // 2]} 17 {x[length // 2 : length]}", f"{x[: length // 2]} 23 {x[length // 2 : length]}"]
        kept.append(rows[-2])
    rows += [f"page {i} of this other line {word}" for i, word in enumerate(["holds", "quickly", "banana"])]
    kept += rows[-3:]
    got = lines.dedup_lines(make([(i, x, "en", "a") for i, x in enumerate(rows)])).collect()
    assert sorted(r.text for r in got if r.n_removed == 0) == sorted(kept)


def test_pairs_of_keys_that_few_share(spark):
    rows = [(i, np.array([1, 10 + i // 3], np.uint64).tobytes()) for i in range(12)]
    frame = spark.createDataFrame(rows, "class long, keys binary").repartition(3)
    pairs = [(i, j, False) for i in range(12) for j in range(i + 1, 12) if i // 3 == j // 3]
    assert sorted(keyed.stars(frame, 7, few=4).collect()) == sorted(pairs + [(0, i, True) for i in range(1, 12)])


def test_equal_lines_of_any_length_are_copies(make):
    short = ["z", "ab", "End.", "all rights reserved.", "nt onor. the of it."]
    docs = make([(1, "\n".join(short), "en", "a"), (2, "ALL  rights reserved.\n\nb\n AB", "en", "a"), (3, "\n".join([*short[::-1], " ", "abc", ""]), "en", "a")])
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()} == {1: "\n".join(short), 2: "\nb", 3: " \nabc\n"}


def test_lines_of_odd_rows(odd, none):
    got = lines.dedup_lines(odd)
    assert got.count() == odd.count() and lines.dedup_lines(none).count() == 0 and set(odd.columns) <= set(got.columns)
    text = {r.doc_id: r.text for r in got.collect()}
    assert text[5].startswith("one") and text[11] == "" and text[7] is None and text[13] == "1234 5678 !!"


def test_mix_equals_sql(spark, odd, none):
    con = connect(FOLDER)
    run = queries.QUERIES["op4_mixing"]
    assert spark_rows(run(spark, FOLDER)) == duck_rows(con, mixing.SQL)
    con = duckdb.connect()
    con.register("documents", odd.select("doc_id", "text", "source").toArrow())
    assert spark_rows(mixing.taken(*mixing.mix(mixing.measured(odd)))) == duck_rows(con, mixing.SQL)
    assert mixing.taken(*mixing.mix(mixing.measured(none))).count() == 0


def test_schedule_is_gapless_and_even(make):
    draw = random.Random(5)
    docs = make([(i, " ".join("w" for _ in range(draw.randrange(0, 400))), "en", draw.choice("aaaabc")) for i in range(300)])
    placed, mixed = mixing.mix(mixing.measured(docs), block=64)
    placed, mixed = placed.collect(), mixed.collect()
    target = {r.source: r.target for r in placed}
    number = {r.s: r.source for r in placed}
    got = {}
    for r in mixed:
        got[number[r.s]] = got.get(number[r.s], 0) + r.words
    assert got == {s: int(t) for s, t in target.items()}
    slots = {(r.slot, r.s) for r in mixed}
    assert len({s for s, _ in slots}) == len(slots)
    # In any stretch of the schedule, a source has about its share of the slots.
    order = [s for _, s in sorted(slots)]
    total = sum(target.values())
    for s, source in number.items():
        for end in range(40, len(order), 25):
            assert abs(order[:end].count(s) - end * target[source] / total) <= 5
    sizes = {r.key: r.size for r in placed}
    for r in mixing.taken(*mixing.mix(mixing.measured(docs), block=64)).collect():
        assert 0 <= r.taken <= 2 * sizes[r.doc_id]


def test_mixed_documents(odd, none, make):
    docs = make([(i, " ".join(f"w{j}" for j in range(50)), "en", "a" if i < 25 else None) for i in range(40)])
    wanted = {r.doc_id: r.taken for r in mixing.taken(*mixing.mix(mixing.measured(docs))).collect()}
    got = mixing.mixed_documents(docs).collect()
    taken = {}
    for r in got:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
    assert taken == {k: n for k, n in wanted.items() if n} and mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mixed_documents(none).count() == 0
    total = sum(len(r.text.split()) for r in mixing.mixed_documents(odd).collect())
    assert total == sum(r.taken for r in mixing.taken(*mixing.mix(mixing.measured(odd))).collect())


def test_sources_of_equal_documents_are_kept_apart(make):
    docs = make([(1, "a b c d e f", "en", "x"), (1, "a b c d e f", "en", "y"), (2, "g h", "en", "y"), (1, "a b c d e f", "en", None)])
    placed, mixed = mixing.mix(mixing.measured(docs))
    wanted = {}
    for r in mixing.taken(placed, mixed).collect():
        wanted[r.source] = wanted.get(r.source, 0) + r.taken
    got = {}
    for r in mixing.mixed_documents(docs).collect():
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    assert got == {s: n for s, n in wanted.items() if n}


def check_shards(rows, texts):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    counts = [len(by.get(i, [])) for i in range(8)]
    assert max(counts) - min(counts) <= 1 and all(sorted(s) == list(range(len(s))) for s in by.values())
    where = {}
    for r in rows:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    return where


def test_shards(sample, odd, none, make):
    docs = make([(i, "hot" if i % 3 == 0 else f"pair {i // 4}", "en", "a") for i in range(400)])
    texts = {r.doc_id: r.text for r in docs.collect()}
    where = check_shards(sharding.shard_documents(sharding.measured(docs), rounds=8).collect(), texts)
    assert len(where["hot"]) <= 4 and sum(len(s) > 1 for t, s in where.items() if t != "hot") <= 20
    for r in sharding.shard_documents(sharding.measured(sample)).collect():
        assert r.law == "rows" and r.grown_shard is None
    text = {r.doc_id: r.text for r in sample.select("doc_id", "text").collect()}
    found = sharding.shard_documents(sharding.measured(sample)).collect()
    check_shards(found, text)
    assert all(r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in found)
    assert sharding.shard_documents(sharding.measured(odd)).count() == odd.count()
    assert sharding.shard_documents(sharding.measured(none)).count() == 0


def test_quotas():
    let = sharding.quotas({(0, 1): 10, (1, 0): 4, (2, 0): 6}, {0: 10, 1: 10, 2: 10}, [12, 12, 12])
    assert let[1, 0] == 1.0 and let[0, 1] == 0.6 and let[2, 0] == pytest.approx(2 / 6)


def vectors(spark, n=900, seed=2, width=16):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=width)]) for i in range(n)]
    rows[3] = (3, rows[100][1])
    rows[5] = (5, rows[100][1])
    rows += [(None, rows[0][1]), (2000, None), (2001, []), (2002, [float("nan")] * width), (2003, [None] + [1.0] * (width - 1)), (2004, [1.0, 2.0]), (2100, [1.0, 3.0]), (2005, [0.0] * width), (7, rows[7][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS key", "2 AS score"), rows


def fine(rows):
    return [(k, np.array(v, np.float32).astype(float)) for k, v in rows if k is not None and v and None not in v and np.isfinite(np.array(v, float)).all()]


def test_top_k_is_exact(spark):
    frame, rows = vectors(spark)
    rows = [(k, np.floor(1024 * v).astype(int)) for k, v in fine(rows)]
    wanted = []
    for q, v in rows:
        if q % 100 == 0:
            best = sorted((-int(v @ w), k) for k, w in rows if k != q and len(w) == len(v))[:10]
            wanted += [(q, i + 1, k, -s) for i, (s, k) in enumerate(best)]
    for candidates in (8192, 100):
        assert sorted(map(tuple, topk.top_k(frame, candidates=candidates).collect())) == sorted(wanted)
    assert topk.top_k(frame.limit(0)).count() == 0


def test_top_k_of_components_of_any_size(spark):
    """Products beyond 62 bits are taken exactly; scores beyond a long count as the largest or smallest one."""
    draw, most = np.random.default_rng(8), 2**63 - 1
    vectors = draw.normal(size=(120, 5))
    vectors[::7] *= 1e9
    vectors[::11] *= 1e200
    vectors[5] = 0
    whole = [[int(x) for x in row] for row in topk.whole_numbers(vectors)]
    rows = [(100 * i if i < 8 else 1000 + i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    wanted = []
    for q, (own, _) in enumerate(rows):
        if own % 100 == 0:
            scores = [(max(-most - 1, min(most, sum(a * b for a, b in zip(whole[q], whole[i], strict=True)))), key) for i, (key, _) in enumerate(rows) if key != own]
            wanted += [(own, rank, key, score) for rank, (score, key) in enumerate(sorted(scores, key=lambda s: (-s[0], s[1]))[:10], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for candidates in (8192, 30):
        assert sorted(map(tuple, topk.top_k(frame, candidates=candidates).collect())) == sorted(wanted)


def test_nearest(spark):
    frame, rows = vectors(spark)
    rows = [(k, v) for k, v in fine(rows) if v.any()]
    found, right, total = {}, 0, 0
    for r in neighbours.nearest(frame, candidates=300).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q, v in rows:
        if q % 100 == 0:
            best = sorted((float(np.sqrt(((v - w) ** 2).sum())), k) for k, w in rows if k != q and len(w) == len(v))[:10]
            got = sorted(found.pop(q))
            assert [r for r, _, _ in got] == list(range(1, len(best) + 1))
            right, total = right + len({k for _, k, _ in got} & {k for _, k in best}), total + len(best)
            for _, k, score in got:
                assert any(score == pytest.approx(float(np.sqrt(((v - w) ** 2).sum()))) for j, w in rows if j == k)
    assert not found and right >= 0.9 * total and neighbours.nearest(frame.limit(0)).count() == 0


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(6)
    spread, tight = rng.normal(size=(700, 24)), rng.normal(size=(7, 24))[rng.integers(0, 7, 700)] + 0.05 * rng.normal(size=(700, 24))
    for vectors in (spread, tight, spread[:1], np.zeros((5, 24))):
        index = neighbours.MultiIndex(np.arange(len(vectors)), vectors, neighbours.learn(spread))
        for own, code in ((0, index.codes[0]), (-1, index.codes[-1] ^ np.uint16(5))):
            gaps = neighbours.distances(index.codes, code)
            gaps[index.ids == own] = 999
            for want in (0, 1, 10, 100, 10_000):
                rows, looked = index.nearest_codes(own, code, want)
                most = min(want, (gaps < 999).sum())
                radius = np.sort(gaps)[most - 1] if most else -1
                assert sorted(rows) == np.nonzero(gaps <= radius)[0].tolist() or not most
                assert len(rows) <= looked <= len(vectors)
    # On rows in tight groups only the buckets of the query's group are looked at.
    index = neighbours.MultiIndex(np.arange(700), tight, neighbours.learn(tight))
    assert index.nearest_codes(0, index.codes[0], 20)[1] < 350


def test_a_table_gives_the_rows_at_each_distance():
    column = np.random.default_rng(1).integers(0, 1 << 16, 3000).astype(np.uint16)
    for values in (column, column[:20], np.full(9, 65535, np.uint16)):
        table = neighbours.Table(values)
        for flipped in range(17):
            assert sorted(table.probe(np.uint16(0xF0F1), flipped)) == np.nonzero(np.bitwise_count(values ^ np.uint16(0xF0F1)) == flipped)[0].tolist()


def test_pipeline_equals_its_plain_version(spark, sample):
    kept = [r for r in sample.collect()]
    filters = languages.learn(sample.where(~languages.held_out()))
    said, scores = languages.predict([r.text for r in kept], filters)
    kept = [r for r, s, x in zip(kept, said, scores, strict=True) if s != "und" and x >= corpus_pipeline.LEAST_LANGUAGE]
    docs = spark.createDataFrame(kept, sample.schema)
    text = {k: t for (k, _), t in deduplicated(docs).items()}
    rows = sorted((r.doc_id, text[r.doc_id], r.source) for r in kept if text[r.doc_id].strip() or text[r.doc_id] == r.text)
    sets = [brute.shingles(t, corpus_pipeline.WORDS) for _, t, _ in rows]
    root = brute.roots(len(rows), lambda i, j: brute.similar(sets[i], sets[j], corpus_pipeline.PERCENT))
    rows = [r for i, r in enumerate(rows) if root[i] == i]
    third = spark.createDataFrame(rows, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.register("documents", third.toArrow())
    columns, mixed = duck_rows(con, mixing.SQL)
    taken = {int(r[columns.index("doc_id")]): int(r[columns.index("taken")]) for r in mixed}
    size = {k: len(brute.words(t)) for k, t, _ in rows}
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == packing.pack(sample).columns
    pieces = got.collect()
    starts = {}
    for p in pieces:
        starts[p.doc_id] = starts.get(p.doc_id, 0) + (p.start == 0)
    assert starts == {k: -(-n // size[k]) for k, n in taken.items() if n}


def test_every_stage_takes_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == odd.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, FOLDER)) == duck_rows(connect(FOLDER), queries.SQL[name])


@pytest.mark.parametrize("name", ["op4_mixing", "op8_sharding"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
