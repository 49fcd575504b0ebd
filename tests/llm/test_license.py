import random

import pytest

from tablelab.llm import license as lic
from tests.llm import brute


def base_places(text):
    w = brute.alnum(text)
    found = []
    for phrase, label in lic.BASE.items():
        p = phrase.split()
        found += [(k, label) for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
    return w, found


def test_base_against_brute_force():
    rng = random.Random(2)
    vocab = ["mit", "license", "apache", "general", "public", "the", "MIT License", "Apache-License", "gnu", "ümit", "General  Public\nLicense"]
    for _ in range(400):
        text = " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 25)))
        w, found = base_places(text)
        n, n_base, first, last, labels, every, *_ = lic.scan_text(text)
        assert (n, n_base) == (len(w), len(found))
        assert (first, last) == (min((k for k, _ in found), default=None), max((k for k, _ in found), default=None))
        assert labels == sorted({x for _, x in found}) and set(labels) <= set(every)


def edited(rng, text, n):
    s = list(text)
    for _ in range(n):
        k = rng.randrange(1, len(s) - 1)
        rng.choice([lambda: s.insert(k, "q"), lambda: s.__delitem__(k), lambda: s.__setitem__(k, "z")])()
    return "".join(s)


@pytest.mark.parametrize("label", list(lic.NOTICES))
def test_notices_with_errors_are_found(label):
    rng = random.Random(label)
    for notice, errors in lic.NOTICES[label]:
        for _ in range(30):
            pad = [" ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 20))) for _ in range(2)]
            text = f"{pad[0]} {edited(rng, notice, rng.randint(0, errors))} {pad[1]}"
            spans = lic.scan_text(text)[7]
            assert any(s["label"] == label and s["errors"] <= errors for s in spans), text
            assert label in lic.scan_text(text)[5]


def test_pieces_make_up_the_notice():
    for items in lic.NOTICES.values():
        for notice, errors in items:
            parts = lic.pieces(notice, errors)
            assert "".join(p for _, p in parts) == notice and len(parts) == errors + 1
            assert all(notice[a : a + len(p)] == p and p for a, p in parts)


def test_span_is_in_words_and_copies_side_by_side():
    text = "one two Licensed under the Apache Licence, Version 2.0. Licensed under the Apache License, Version 2.0 end"
    spans = [s for s in lic.scan_text(text)[7] if s["label"] == "apache"]
    assert [(s["start"], s["end"]) for s in spans] == [(2, 10), (10, 18)] and spans[1]["errors"] == 0
    assert lic.scan_text("clean text without any of it")[5:] == ([], 0.0, [])


def test_no_match_within_longer_words():
    assert lic.scan_text("xall rights reservedx")[5] == []


def test_spark_edges(spark):
    rows = [(1, None, 0), (1, None, 0), (2, "", 0), (3, "The MIT License " * 3000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license int")
    got = sorted((r["doc_id"], r["license"]["n_words"], r["license"]["n_base"], r["license"]["first_word"], r["license"]["last_word"]) for r in lic.scan(df).collect())
    assert got == [(1, 0, 0, None, None), (1, 0, 0, None, None), (2, 0, 0, None, None), (3, 9000, 3000, 1, 8998)]
    assert lic.scan(df.limit(0)).count() == 0


@pytest.mark.parametrize("label", list(lic.NOTICES))
def test_edits_at_both_ends_are_found(label):
    rng = random.Random(label)
    for notice, errors in lic.NOTICES[label]:
        for k in range(120):
            copy, n = notice, rng.randint(1, errors)
            for _ in range(n):
                at = rng.choice([0, len(copy), rng.randrange(len(copy) + 1)])
                new = rng.choice([copy[:at] + "s" + copy[at:], copy[:at] + copy[at + 1 :], copy[: max(at - 1, 0)] + copy[at:]])
                copy = new if new == " ".join(new.split()) else copy
            pad = " ".join("w" * rng.randint(3, 9) for _ in range(k % 4))
            for text in (copy, f"{pad} {copy}", f"{copy} {pad}", f"{pad} {copy} {pad}"):
                spans = [s for s in lic.scan_text(text)[7] if s["label"] == label and s["errors"] <= n]
                assert spans, text


def test_longer_words_at_the_ends():
    for text, label in [("released under the mit licenses", "mit"), ("licensed under the gnu general public licenses", "gpl"),
                        ("creative commons attribution licenses", "cc by"), ("unreleased under the mit license", "mit")]:
        for whole in (text, f"one {text}, two"):
            first = int(whole != text)
            spans = [s for s in lic.scan_text(whole)[7] if s["label"] == label]
            assert [(s["start"], s["end"]) for s in spans] == [(first, first + len(text.split()))], whole
    assert lic.scan_text("released under the mit licensesxyz")[5] == []
