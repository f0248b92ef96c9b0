"""Row-wise operators against plain Python on whole small tables and on tricky rows."""

import hashlib
import re
from collections import Counter

import pytest

from llm import licences, pii, quality
from llm.common import given
from tests.llm.conftest import tricky_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(small_folder, spark):
    return [(r.doc_id, r.text) for r in given(spark, small_folder, "documents").collect()] + [(r[0], r[1]) for r in tricky_rows()]


def measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(spark, small_folder, tricky, rows):
    for docs in (given(spark, small_folder, "documents"), tricky):
        judged = quality.judge_documents(docs).collect()
        want = sorted(((d.doc_id, *measures(d.text)) for d in docs.collect()), key=repr)
        assert sorted(((r.doc_id, *[r[m] for m in quality.MEASURES]) for r in judged), key=repr) == want
        for r in judged:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_rates_are_shrunk_and_bad_hosts_lose_documents(spark):
    measured = spark.createDataFrame(
        [(h, 40 if i < bad else 100, 500, 0, 0, 0) for h, n, bad in (("good", 400, 4), ("bad", 400, 399), ("tiny", 1, 1), (None, 5, 0)) for i in range(n)],
        "host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    hosts = {r.host: r.host_rate for r in quality.host_rates(measured, "host").collect()}
    assert set(hosts) == {"good", "bad", "tiny"}
    assert hosts["good"] < 0.05 < 0.95 < hosts["bad"] and hosts["bad"] < 399.5 / 400 and hosts["tiny"] < 1
    kept = {r.host: r.n for r in quality.verdict(measured, quality.host_rates(measured, "host"), "host").where("kept").groupBy("host").agg(
        {"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert kept == {"good": 396, None: 5}


def test_quality_filter_keeps_columns_and_clean_rows(tricky, nothing):
    kept = quality.keep_good(tricky)
    assert kept.columns == tricky.columns
    assert sorted(r.text for r in kept.collect()) == sorted(r.text for r in tricky.collect() if measures(r.text)[0] >= 50 and measures(
        r.text)[4] * 100 <= 50 * measures(r.text)[0])
    assert quality.keep_good(nothing).count() == 0 and quality.judge_documents(nothing).count() == 0


def plain_base(text):
    """The four patterns as plain regular expressions."""
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_base_spans_equal_plain_patterns(spark, small_folder, tricky):
    odd = ["1.2.3.4.5.6.7.8", "a@b.c@d.e", "@@a@b.c.", "x@y@z.w", "+1+2 345 678 901", "0000000000000", "4111-1111-1111-1111 1", "007.1.2.3 1.2.3.999", "é@b.c"]
    for _, text in texts(small_folder, spark) + [(0, t) for t in odd]:
        if text and len(text) < 20000:
            assert pii.base_spans(text) == plain_base(text), text[:80]


def test_personal_data_rows(tricky, nothing, spark, small_folder):
    for docs in (tricky, given(spark, small_folder, "documents")):
        found = pii.find_personal_data(docs).collect()
        assert len(found) == docs.count()
        by_id = {}
        for d in docs.collect():
            by_id.setdefault(d.doc_id, set()).add(d.text)
        for r in found:
            if len(by_id[r.doc_id]) == 1:
                text = next(iter(by_id[r.doc_id])) or ""
                base = plain_base(text)
                assert r.base_sha256 == hashlib.sha256(pii.spelled(base).encode()).hexdigest()
                assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
                told = r.spans.split(",") if r.spans else []
                assert set(pii.spelled(base).split(",") if base else []) <= set(told)
    assert pii.find_personal_data(nothing).count() == 0


def test_repeats_of_an_entity_take_its_label(spark):
    first = "call +1 (555) 123-4567 today "
    docs = spark.createDataFrame([(i, first + "words " * 40 + f"again (555) 123-4567 and room 12 of {i}") for i in range(60)], "doc_id long, text string")
    row = pii.find_personal_data(docs).where("doc_id = 7").first()
    at = (first + "words " * 40).__len__() + len("again ")
    assert f"phone:{at}:{at + len('(555) 123-4567')}" in row.spans.split(",")
    assert len(row.spans.split(",")) == 2  # the room stays


def test_message_passing_equals_enumeration():
    import itertools

    import numpy as np

    pick = np.random.default_rng(3)
    tokens = pii.Tokens("a1 b2 c3", [])
    tokens.skip = [(0, 2)]
    tokens.chain = [(0, 1)]  # a tree, where message passing is exact
    model = {"unary": pick.normal(size=(pii.SHAPES, 5)), "chain": np.zeros((5, 5)), "skip": np.zeros((5, 5))}
    for name in ("chain", "skip"):
        half = pick.normal(size=(5, 5))
        model[name] = half + half.T
    want = np.zeros((3, 5))
    for labels in itertools.product(range(5), repeat=3):
        score = sum(model["unary"][tokens.shape[i], x] for i, x in enumerate(labels))
        score += model["chain"][labels[0], labels[1]] + model["skip"][labels[0], labels[2]]
        for i, x in enumerate(labels):
            want[i, x] += np.exp(score)
    assert pii.marginals(tokens, model, passes=60) == pytest.approx(want / want.sum(axis=1, keepdims=True), abs=1e-6)


def test_masking_keeps_clean_texts(tricky, nothing):
    masked = pii.mask_personal_data(tricky)
    assert masked.columns == tricky.columns and masked.count() == tricky.count()
    before = {(r.doc_id, r.n_chars): r.text for r in tricky.collect()}
    for r in masked.collect():
        old = before[r.doc_id, r.n_chars]
        assert (r.text == old) == (not plain_base(old or "")) or len(old) > 20000
        assert "foo.bar@" not in (r.text or "") and "4111 1111" not in (r.text or "")
    assert pii.mask_personal_data(nothing).count() == 0


def plain_scan(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in licences.BASE_PHRASES.items():
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i:i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base_equals_brute_force(spark, small_folder, tricky, nothing):
    for docs in (given(spark, small_folder, "documents"), tricky):
        got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licences.scan_licences(docs).collect()), key=repr)
        assert got == sorted(((d.doc_id, *plain_scan(d.text)) for d in docs.collect()), key=repr)
    for r in licences.scan_licences(tricky).collect():
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    assert licences.scan_licences(nothing).count() == 0


@pytest.mark.parametrize(("text", "labels", "freedom"), [
    (" mit", {"mit"}, 0.95), (" (mit or gpl-2.0-only) and apache-2.0", {"mit", "gpl", "apache"}, 0.9),
    (" mit or gpl-2.0-only and apache-2.0", {"mit", "gpl", "apache"}, 0.95), (" gpl-2.0-only with classpath-exception-2.0", {"gpl"}, 0.4),
    (" (mit", None, None), (" and mit", None, None), (" nothing known", None, None), (" mit or", {"mit"}, 0.95), ("", None, None),
])
def test_expressions(text, labels, freedom):
    assert licences.evaluate(text) == (None if labels is None else (labels, freedom))


def test_overlapping_phrases_count():
    found = licences.scan(b"Apache License, MIT License; mit license general public license mit")
    assert (found["n_base"], found["first_word"], found["last_word"], found["base_labels"]) == (4, 0, 6, "apache,gpl,mit")
