"""Licence detection against a plain version: every rule on every text, pairs of matches compared one by one."""

import random
import re

import duckdb
import pytest

from contractflow.llm import licences, signatures
from contractflow.llm.signatures import Rule, phrase
from suite.compare import duck_rows, spark_rows


def plain(text, known):
    """(n_words, [(rule, start, end, kept)]) of a text."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    joined = "".join(f" {w} " for w in words)
    found = []
    for i, rule in enumerate(known):
        if set(words).isdisjoint(rule.keywords):
            continue
        for m in re.finditer(licences.expression(rule), joined):
            start = joined[: m.start()].count(" ") // 2
            found.append((i, start, start + m[0].count(" ") // 2))
    kept = []
    for i, a, b in found:
        beats = lambda j, c, d: c <= a and d >= b and known[j].priority >= known[i].priority and ((c, d) != (a, b) or known[j].priority > known[i].priority or j < i)  # noqa: E731, B023
        kept.append((known[i].name, a, b, known[i].base or not any(beats(*o) for o in found)))
    return len(words), sorted(kept)


TEXTS = [
    "Released under the MIT License.", "under the mit license under the MIT\tlicense", "Apache License, Version 2.0 (the CC-BY-NC 4.0)", None, "", " .,;\n", "mit", "under the mİt license",
    "SPDX-License-Identifier: GPL-3.0-or-later", "licensed under the GNU Lesser General Public License version 2.1", "CC BY-NC-SA 4.0 cc by nc", "CCé by nc, éunder the mit license",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "under the mit licenses", "All rights reserved. " * 50,
    "https://creativecommons.org/licenses/by-nc/4.0/ and http://www.gnu.org/licenses/gpl-3.0.html",
]


def texts_of_pieces(n, seed):
    draw = random.Random(seed)
    parts = [t for t in TEXTS if t] + ["gnu", "license", "version 2", "or later", "under the", "by nc", "x", "Copyright (c) 2020", "é", "dual-licensed", "hereby"]
    return [" ".join(draw.choice(parts) for _ in range(draw.randrange(1, 12))) for _ in range(n)]


def test_rules_are_well_formed():
    known = signatures.rules()
    assert len(known) > 300 and len({r.name for r in known}) == len(known)
    for rule in known:
        assert re.compile(licences.expression(rule)) and rule.keywords and 0 < rule.confidence <= 1
        assert all(re.fullmatch("[a-z0-9]+", w) for w in rule.keywords)
    with pytest.raises(ValueError, match="overlap"):
        phrase("x", "a b a", "a")


def test_every_title_and_address_has_its_keyword():
    """A text that a rule matches has one of the rule's keywords: else the prefilter would lose it."""
    for rule in signatures.rules():
        simple = rule.expression
        for _ in range(6):  # take the first of alternatives and drop what is optional
            simple = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)(?!\?|\{)", r"\1", re.sub(r"\(\?:[^()]*\)(?:\?|\{0,\d+\}\??)", "", simple))
        simple = re.sub(r"\[sc\]", "s", re.sub(r"\[sz\]", "s", simple)).split("|")[0]
        simple = re.sub(r"\[\^ \]\+", "x", re.sub(r"\[1-4\]|\[0-9\]", "4", re.sub(r"\[0?1[123]?\]|\[12\]|\[05\]|\[01\]|\[123\]", "1", simple)))
        simple = re.sub(r"\(\?:([^()|]*)\)\{1,\d+\}", r"\1", simple).replace(" ?", " ").replace("?", "")
        words = "".join(f" {w} " for w in simple.split())
        if re.fullmatch(licences.expression(rule), words):
            assert not set(simple.split()).isdisjoint(rule.keywords), rule


def test_matches_equal_plain_ones(make, odd, none):
    known = signatures.rules()
    assert licences.detections(none).count() == 0 and licences.licences(licences.detections(none)).count() == 0
    texts = TEXTS + texts_of_pieces(60, 3)
    docs = make([(i, t, "en", "a") for i, t in enumerate(texts)] + [(3, TEXTS[0], None, None), (None, TEXTS[0], "en", "a")])
    got: dict = {}
    for r in licences.detections(docs).collect():
        got.setdefault((r.row, r.doc_id), [r.n_words, []])[1].extend([(r.rule, r.start, r.end, r.kept)] if r.rule else [])
    found = sorted(((k[1], v[0], sorted(v[1])) for k, v in got.items()), key=repr)
    wanted = sorted(((d.doc_id, *plain(d.text, known)) for d in docs.collect()), key=repr)
    assert found == [(k, n, m) for k, n, m in wanted]
    assert licences.licences(licences.detections(odd)).count() == odd.count()


def test_priority_and_containment_with_other_rules(make):
    known = (phrase("low", "a b", "b"), Rule("wide", "wide", "(?:x )?a b(?: c)?", ("b",), 1, 0.5), Rule("high", "high", "b c", ("c",), 2, 0.9), Rule("same", "same", "a b c", ("b",), 1, 0.7))
    texts = ["x a b c", "a b", "b c", "a b a b c b c", "x a b", "c"]
    docs = make([(i, t, "en", "a") for i, t in enumerate(texts)])
    rows: dict = {}
    for r in licences.detections(docs, known=known).where("rule is not null").collect():
        rows.setdefault(r.doc_id, []).append((r.rule, r.start, r.end, r.kept))
    for i, t in enumerate(texts):
        assert sorted(rows.get(i, [])) == plain(t, known)[1]
    assert rows[0] and ("high", 2, 4, True) in rows[0] and ("same", 1, 4, False) in rows[0]


def test_labels_equal_the_sql(make):
    texts = TEXTS + texts_of_pieces(80, 9)
    docs = make([(i, t, "en", "a") for i, t in enumerate(texts)])
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    assert spark_rows(licences.licences(licences.detections(docs))) == duck_rows(con, licences.SQL)


def test_no_python_workers(sample):
    plan = licences.licences(licences.detections(sample))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 2
