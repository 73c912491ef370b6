"""Operators on single texts: personal data, languages, packing, scores."""

import random
import zlib

import brute_llm as brute
import numpy as np
import pytest
from tokenizers import Tokenizer

from contractflow.llm import languages, packing, pii, scoring

ODD_TEXTS = [
    "a.b@c.de, x@@y.z @q.r a@b.c.d@e.f me@host", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 0000000000000 12345678901234567890",
    "+1 (269) 555-3296 +12 +1------- +49 (0)30 12345678 tel:+4930123456789012345", "+1+2 345678901",
    "GB82 WEST 1234 5698 7654 32 AND MORE, iban DE89370400440532013000", "ssn 078-05-1120 but not 078-05-1121-3",
    "é@x.de ü 😀 a_b%c+d@e-f.gh", "", None, "9" * 5000, "a" * 5000 + "@", "1." * 2000, "+1" + "(" * 3000,
]


def spans_of(text):
    return [(s["kind"], s["start"], s["end"]) for s in pii.find(text)]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_base_spans_equal_the_expressions(text):
    assert [s for s in spans_of(text) if s[0] in pii.BASE] == brute.base_spans(text)


def test_base_spans_of_random_texts():
    draw = random.Random(3)
    for _ in range(1500):
        text = "".join(draw.choice(["@", ".", "-", " ", "+", "a", "Z", "1", "42", "255", "(", "4111", "é", "_"]) for _ in range(40))
        assert [s for s in spans_of(text) if s[0] in pii.BASE] == brute.base_spans(text), text


def test_checksums_and_context_decide_on_further_kinds():
    assert ("iban", 0, 27) in spans_of("GB82 WEST 1234 5698 7654 32 AND")
    assert not any(s[0] == "iban" for s in spans_of("GB83 WEST 1234 5698 7654 32"))
    assert not any(s[0] == "ssn" for s in spans_of("part 078-05-1120"))
    assert ("ssn", 4, 15) in spans_of("SSN 078-05-1120")


def kinds_of(text):
    return {(s["kind"], text[s["start"] : s["end"]]): s["score"] for s in pii.find(text) if s["kind"] not in pii.BASE}


@pytest.mark.parametrize(
    "kind, value, context, wrong",
    [
        ("imei", "490154203237518", "IMEI of the device", "490154203237519"),
        ("routing", "021000021", "routing number", "021000022"),
        ("dni", "12345678Z", "DNI", "12345678A"),
        ("secret", "04dbebab91ab85687d33eeaaf9ac699e1188f962", 'token = "', "a" * 40),
        ("ssn", "078-05-1120", "ssn", "078-05-11200"),
    ],
)
def test_context_decides_where_a_checksum_is_weak(kind, value, context, wrong):
    assert (kind, value) in kinds_of(f"{context} {value}") and (kind, value) in kinds_of(f"{value}, {context}.")
    assert (kind, value) not in kinds_of(f"some text {value} and more") and (kind, value) not in kinds_of(f"{context}{' far' * 20} {value}")
    assert not any(k == kind for k, _ in kinds_of(f"{context} {wrong}"))


def test_strong_checksums_need_no_context():
    assert kinds_of("x 2 55 08 14 168 025 38 y") == {("nir", "2 55 08 14 168 025 38"): 0.8} and not kinds_of("x 2 55 08 14 168 025 39 y")
    assert kinds_of("iban DE89370400440532013000") == {("iban", "DE89370400440532013000"): 1.0} and list(kinds_of("x DE89370400440532013000").values()) == [0.8]


def test_ordinary_words_are_no_secrets():
    for text in ("the key Donaudampfschifffahrtsgesellschaft", "key 12345678901234567890", "token " + "ab1" * 10, "key https://example.org/a/long/path/to/something"):
        assert not any(k == "secret" for k, _ in kinds_of(text)), text


def test_secrets_of_the_given_documents_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = docs.where("text rlike '(?i)token = \"[0-9a-f]{40}\"'").select("doc_id").collect()
    found = pii.digests(pii.find_pii(docs))
    with_secrets = {r.doc_id for r in found.where("spans like '%secret:%'").collect()}
    assert with_secrets == {r.doc_id for r in planted} and found.where("(n_other > 0 or n_email + n_ip + n_card + n_phone > 0) <> (score > 0)").isEmpty()


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("BE68539007547034 BE71096123456769", ["BE68539007547034", "BE71096123456769"]),
        ("DE89 3704 0044 0532 0130 00 FR14 2004 1010 0505 0001 3M02 606", ["DE89 3704 0044 0532 0130 00", "FR14 2004 1010 0505 0001 3M02 606"]),
        ("AB12 GB82WEST12345698765432", ["GB82WEST12345698765432"]),
    ],
)
def test_ibans_beside_other_capitals(text, wanted):
    assert [text[a:b] for kind, a, b in spans_of(text) if kind == "iban"] == wanted


def test_pii_rows(odd, none, sample, rows):
    found = pii.digests(pii.find_pii(odd))
    assert found.count() == odd.count() and pii.digests(pii.find_pii(none)).count() == 0
    for doc, text in sample.select("doc_id", "text").collect():
        assert brute.digest(brute.base_spans(text))
    got = {r.doc_id: r for r in pii.digests(pii.find_pii(sample)).collect()}
    for doc, text in sample.select("doc_id", "text").collect():
        spans = brute.base_spans(text)
        assert got[doc].base_sha256 == brute.digest(spans)
        assert [got[doc][f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]


HARD = [
    "it's HE'LL d'd a1b22 ² ³x Ⅷ é́ é İstanbul ΣΑΣ <|endoftext|> x<|endoftext|>y  a b \x1cq\x1d 'S''s £5 ª µm",
    "naïve Œuvre 中文字 ​ Straße STRASSE ÿ ×÷ a×b _x_ don't!!! 😀😀", "", " ", "\x85a", "It's WE'LL a\tb\x0bc\x0c d é É ÿß",
]


def test_encoder_equals_the_tokenizer(sample):
    path = packing.default_tokenizer()
    whole, encoder = Tokenizer.from_file(path), packing.Encoder.load(path)
    texts = HARD + [r.text for r in sample.select("text").collect()]
    wanted = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert encoder.ids(texts) == wanted


def test_first_fit_decreasing():
    draw = random.Random(1)
    for _ in range(30):
        sizes = sorted((draw.randrange(1, 100) for _ in range(draw.randrange(1, 60))), reverse=True)
        bins, fit = [], packing.FirstFit(len(sizes), 100)
        for size in sizes:
            at = next((i for i, room in enumerate(bins) if room >= size), len(bins))
            bins += [100] * (at == len(bins))
            bins[at] -= size
            assert fit.place(size) == at


def check_pack(frame, docs, group=2048):
    pieces = packing.pack(docs, group=group, keep_ids=True).collect()
    whole = Tokenizer.from_file(packing.default_tokenizer())
    wanted = sorted((str(r.doc_id), np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for r in docs.select("doc_id", "text").collect())
    by_sequence: dict = {}
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for some in by_sequence.values():
        some.sort(key=lambda p: p.offset)
        assert [p.offset for p in some] == [sum(q.length for q in some[:i]) for i in range(len(some))] and sum(p.length for p in some) <= 2048
    total = sum(len(ids) // 4 for _, ids in wanted)
    assert sum(p.length for p in pieces) == total and sorted(str(p.doc_id) for p in pieces if p.start == 0) == [k for k, _ in wanted]
    return pieces, len(by_sequence), total, wanted


def test_packing(spark, odd, none, sample):
    assert packing.pack(none).count() == 0
    check_pack(spark, odd)
    pieces, sequences, total, wanted = check_pack(spark, sample)
    joined: dict = {}
    for p in sorted(pieces, key=lambda p: p.start):
        joined[str(p.doc_id)] = joined.get(str(p.doc_id), b"") + p.ids
    assert sorted(joined.items()) == wanted and sequences <= total / 2048 * 1.02 + 1
    assert check_pack(spark, sample, group=20)[2] == total


def test_scores(odd, none, sample):
    assert scoring.score(none).count() == 0 and scoring.score(odd).count() == odd.count()
    rows = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    wanted, got = brute.base_scores(rows), scoring.score(sample).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == wanted[r.doc_id][:3] and r.held_out == (brute.fold(r.doc_id) % 10 == 0)
        assert r.base_score == pytest.approx(wanted[r.doc_id][3], rel=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_are_those_of_the_mixture(make, monkeypatch):
    """Every count against a plain model, with several chunks and parts."""
    monkeypatch.setattr(scoring, "WORD_PART", 40)
    monkeypatch.setattr(scoring, "PAIR_PART", 30)
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choice("abcdefgh") for _ in range(draw.randrange(0, 30)))) for i in range(60)]
    docs = make([(i, t, "en", "a") for i, t in rows])
    seen = {}
    keep = scoring.weights
    monkeypatch.setattr(scoring, "weights", lambda *a: seen.setdefault("w", keep(*a)))
    got = {r.doc_id: r.score for r in scoring.score(docs).collect()}
    trained = [brute.words(t) + [" "] for k, t in rows if brute.fold(k) % 10]
    one, two = {}, {}
    for ws in trained:
        for a, b in zip([" ", *ws], ws, strict=False):
            one[b] = one.get(b, 0) + 1
            two[a, b] = two.get((a, b), 0) + 1
    n, v = sum(one.values()), len(one)
    for k, t in rows:
        ws, total = brute.words(t) + [" "], 0.0
        for a, b in zip([" ", *ws], ws, strict=False):
            w = seen["w"][scoring.bucket(np.array([float(one.get(a, 0))]))[0]]
            total += np.log10(w[0] * two.get((a, b), 0) / max(1, one.get(a, 0)) + w[1] * one.get(b, 0) / n + w[2] / (v + 1))
        assert got[k] == pytest.approx(total, rel=1e-9)


def test_numbers_survive_squeezing():
    for kind in (np.uint32, np.uint64):
        for values in (np.zeros(0, kind), np.array([0, 7, np.iinfo(kind).max], kind), np.arange(1000, dtype=kind)):
            assert (scoring.expand(scoring.squeeze(values), kind) == values).all()


def test_languages(odd, none, sample):
    got = {r.doc_id: r for r in languages.identify_documents(sample).collect()}
    said = sample.select("doc_id", "lang").collect()
    assert sum(got[r.doc_id].lang_pred == r.lang for r in said if got[r.doc_id].held_out) >= 0.95 * sum(got[r.doc_id].held_out for r in said)
    rows = languages.identify_documents(odd).collect()
    assert len(rows) == odd.count() and languages.identify_documents(none).count() == 0
    for text, und in [(None, True), ("", True), ("12 !!", True), ("ab", False)]:
        filters = languages.build([("en", int(g)) for g in languages.trigrams(["ab cd"])[0].view(np.int64)])
        said, scores = languages.predict([text], filters)
        assert (said == [languages.UNKNOWN]) == und and 0 <= scores[0] <= 1
    assert languages.predict(["ab"], languages.build([])) == ([languages.UNKNOWN], [0.0])


def plain_trigrams(text):
    """Trigrams of a text, letters lower-cased and everything else one space, that are not of spaces in the middle."""
    letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    joined = " " + " ".join(letters.split()) + " " if letters.strip() else " "
    return [joined[i : i + 3] for i in range(len(joined) - 2) if joined[i + 1] != " "]


def test_predictions_equal_those_of_exact_sets(sample):
    """Bloom filters against plain sets of each language's trigrams: the same languages, and scores as near as false positives allow."""
    rows = sample.select("doc_id", "text", "lang").collect()
    counts: dict = {}
    for r in rows:
        if r.text is not None and r.lang is not None and brute.fold(r.doc_id) % 5:
            for gram in plain_trigrams(r.text):
                of = counts.setdefault(r.lang, {})
                of[gram] = of.get(gram, 0) + 1
    sets = {lang: {g for g, n in of.items() if n >= sum(of.values()) * languages.LEAST} for lang, of in counts.items()}
    got, other = {r.doc_id: r for r in languages.identify_documents(sample).collect()}, 0
    for r in rows:
        grams = plain_trigrams(r.text or "")
        if not any(c.isalpha() for c in r.text or ""):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == (languages.UNKNOWN, 0)
            continue
        parts = {lang: sum(g in known for g in grams) / len(grams) for lang, known in sets.items()}
        assert got[r.doc_id].score == pytest.approx(max(parts.values()), abs=0.01)
        other += parts[got[r.doc_id].lang_pred] < max(parts.values()) - 0.005
    assert not other


def test_filters_return_all_languages_of_a_trigram():
    names = [f"l{i:03d}" for i in range(70)]
    grams = languages.trigrams(["abc def"])[0]
    filters = languages.build([(n, int(g)) for i, n in enumerate(names) if i % 2 for g in grams.view(np.int64)])
    masks = filters.masks(grams)
    assert len(filters.names) == 35 and all(int(m) == (1 << 35) - 1 for m in masks[0])


def test_only_the_text_decides(sample):
    filters = languages.learn(sample)
    a = languages.identify(sample, filters).collect()
    b = languages.identify(sample.selectExpr("doc_id", "text", "'zz' AS lang", "'q' AS source"), filters).collect()
    assert [(r.lang_pred, r.score) for r in a] == [(r.lang_pred, r.score) for r in b]
