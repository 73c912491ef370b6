"""Fuzzy line deduplication: what shares a band key by chance stays apart, and what is similar meets."""

import random

import numpy as np
import pytest
from contractflow.llm import keyed, lines


def test_crowded_keys_name_their_members(spark):
    rows = [(i, np.array([1, 10 + i // 3], np.uint32).tobytes()) for i in range(12)]
    frame = spark.createDataFrame(rows, "class long, keys binary").repartition(3)
    pairs = [(i, j, False) for i in range(12) for j in range(i + 1, 12) if i // 3 == j // 3]
    got = keyed.stars(frame, 7, few=4, short=2, crowds=True).collect()
    assert sorted(got) == sorted(pairs + [(1, i, True) for i in range(12)])


@pytest.mark.parametrize("elements", [4_000, 8])
def test_a_crowd_is_tied_by_near_sketches_only(spark, elements):
    draw = random.Random(4)
    base = [[draw.getrandbits(63) for _ in range(4)] for _ in range(10)]
    rows = [(10 * g + i, *[x ^ (1 << i) for x in b]) for g, b in enumerate(base) for i in range(4)]  # 8 bits apart in a group, some 126 between groups
    chain = [draw.getrandbits(63), 0, 0, 0]
    rows += [(1000 + i, chain[0] ^ ((1 << 8 * i) - 1), 0, 0, 0) for i in range(6)]  # neighbours are 8 bits apart, the ends 40
    sketches = spark.createDataFrame(rows, "class long, s0 long, s1 long, s2 long, s3 long")
    members = spark.createDataFrame([(k, r[0]) for k in (5, 6) for r in rows], "key long, class long")
    edges = keyed.crowd_links(members, sketches, ["s0", "s1", "s2", "s3"], 10, elements).collect()
    assert all(abs(a - b) < 10 for a, b in edges)
    got = {r.node: r.root for r in keyed.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {c: (c // 10 * 10 if c < 1000 else 1000) for c, *_ in rows if c % 10}


def test_lines_that_share_a_key_by_chance_are_no_group(spark, make):
    """Twenty unlike lines with one band key in common: kept as a star, they were one candidate group."""
    draw = random.Random(6)
    rows = [(i, *[draw.getrandbits(63) for _ in lines.SKETCH]) for i in range(20)] + [(20, *[7] * len(lines.SKETCH)), (21, *[5] * len(lines.SKETCH))]
    sketches = spark.createDataFrame(rows, "class long, " + ", ".join(f"{s} long" for s in lines.SKETCH))
    keys = [(r[0], np.array([9, *[100 * b + r[0] for b in range(1, lines.BANDS)]], np.uint32).tobytes()) for r in rows]
    shared = keyed.stars(spark.createDataFrame(keys, "class long, keys binary"), few=lines.FEW, short=lines.BANDS, crowds=True)
    groups = keyed.candidate_groups(lines.candidates(shared, sketches, lines.SIMILARITY)).collect()
    assert sorted(groups) == [(20, 20), (21, 20)]


@pytest.mark.parametrize("common", [(8, 1, 1), (16, 2, 2), (80, 10, 10), (240, 30, 30)])
def test_signatures_meet_and_sketches_stay_near(common):
    """Of pairs of similarity 0.8, all but some 0.3 % share a band, and sketches rule out hardly any; lines alike in 0.2 rarely share one."""
    draw = random.Random(11)
    shared, a, b = common
    block = lambda n: "".join(chr(draw.randrange(0x4E00, 0x9FA5)) for _ in range(n + lines.SHINGLE - 1))  # noqa: E731  n shingles
    met = far = chance = 0
    trials = 1000
    for _ in range(trials // 100):
        pairs = []
        for _ in range(100):
            both = block(shared)
            pairs += [both + block(a)[:a], both + block(b)[:b]]
        sets = [{x[i : i + lines.SHINGLE] for i in range(len(x) - lines.SHINGLE + 1)} for x in pairs]
        keys, sketches = lines.signatures(pairs)
        bands = [np.frombuffer(k, np.uint32) for k in keys]
        for i in range(0, 200, 2):
            assert (len(sets[i] & sets[i + 1]), len(sets[i] | sets[i + 1])) == (shared, sum(common))
            met += (bands[i] == bands[i + 1]).any()
            far += np.bitwise_count(sketches[i].view(np.uint64) ^ sketches[i + 1].view(np.uint64)).sum() > 44
            chance += (bands[i] == bands[(i + 2) % 200]).any()
    assert met >= 0.99 * trials and far <= 0.005 * trials and not chance
