"""Operators that judge a text by itself (repetition, licenses, personal
data), against brute force over the contracts' patterns."""

from __future__ import annotations

import collections
import hashlib
import re
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emporium.llm import license_scan as L
from emporium.llm import personal_data as P
from emporium.llm import repetition as R

DOCS = "/root/testdata/sf0.001/documents.parquet"
ODD = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, " \n\t\v", None),
       (3, "word " * 60_000 + "\n" + "a\x00b é😀" * 9, "c")]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, kept string")


# ---------------------------------------------------------------- repetition
def brute_repetition(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {k + i for k in range(len(words) - 2) if grams[tuple(words[k:k + 3])] > 1 for i in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(inside), failed)


def brute_share(text, n):
    """Characters in n-grams seen before, by a set of windows."""
    words, seen, covered = re.findall(r"[^\x20\x09-\x0D]+", text), set(), set()
    for k in range(len(words) - n + 1):
        gram = tuple(words[k:k + n])
        if gram in seen:
            covered.update(range(k, k + n))
        seen.add(gram)
    chars = sum(map(len, words))
    return sum(len(words[i]) for i in covered) / chars if chars else 0.0


def test_repetition_on_documents(spark):
    docs = spark.read.parquet(DOCS)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in R.quality(docs).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute_repetition(texts[r.doc_id])
        for n in R.CHAR_LIMITS:
            assert r[f"dup_{n}gram_char_share"] == pytest.approx(brute_share(texts[r.doc_id], n))
        assert not (r.kept and r.base_failed)
    kept = R.keep_good(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é\n\t#", max_size=200))
def test_repetition_random(text):
    m = R.measures(text)
    assert tuple(m[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                "n_repeat_words", "base_failed")) == brute_repetition(text)
    for n in R.CHAR_LIMITS:
        assert m[f"dup_{n}gram_char_share"] == pytest.approx(brute_share(text, n))


def test_hash_collisions_do_not_count(monkeypatch):
    monkeypatch.setattr(R, "_STEP", R.np.uint64(0))  # a window's hash is its last word's
    text = "a b c x y c p q c a b c " * 3
    assert R.measures(text)["n_repeat_words"] == brute_repetition(text)[4]


# ---------------------------------------------------------------- licenses
def brute_phrases(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = [(k, label) for phrase, label in L.PHRASES.items()
              for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


def brute_templates(text):
    """Labels of all templates met by a line or two neighbouring lines."""
    lines = [set(w) for w in map(L.words_of, (text or "").split("\n")) if w]
    blocks = lines + [a | b for a, b in zip(lines, lines[1:])]
    return {label for t, label in L.TEMPLATES for b in blocks
            if len(b & set(L.words_of(t))) >= L.THRESHOLD * len(set(L.words_of(t)))}


NOTICES = [
    "x\nLicensed under the Apache License,\nVersion 2.0 and more\ny", "MIT License mit LICENSE",
    "Released under\n\nthe MIT License", "licensed under the license version 2.0",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0.", "cc BY\ncc-by CC.BY ccby", "gnu general public mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documents", "É license apache licensé"]


def test_licenses(spark):
    texts = dict(enumerate(NOTICES))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    docs = docs.union(spark.read.parquet(DOCS).selectExpr("doc_id + 100", "text"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = set()
    for r in L.scan_licenses(docs).collect():
        text = texts[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_phrases(text)
        want = set(filter(None, r.base_labels.split(","))) | brute_templates(text)
        assert r.labels == ",".join(sorted(want))
        assert (r.score > 0) == bool(want) and 0 <= r.score <= 1
        found |= want
    assert {"apache", "apache-2.0", "gpl-3.0", "mit", "mit-notice", "cc-by-nc-4.0"} <= found
    assert "gpl-2.0" not in found


def brute_windows(text):
    """label → best containment, over all windows of the words."""
    words, found = L.words_of(text), {}
    for t, label in L.TEMPLATES:
        own, size = set(L.words_of(t)), len(L.words_of(t)) + L.SLACK
        best = max(len(own & set(words[k:k + size])) for k in range(max(1, len(words) - size + 1)))
        if best >= L.THRESHOLD * len(own):
            found[label] = max(best / len(own), found.get(label, 0.0))
    return found


def check_windows(text, index):
    got, want = L.scan(text, index), brute_windows(text)
    assert set(filter(None, got["labels"].split(","))) == \
        set(filter(None, got["base_labels"].split(","))) | set(want)
    if not got["base_labels"]:
        assert got["score"] == max(want.values(), default=0.0)


MIT = L.TEMPLATES[2][0]


def test_wrapped_notices_and_long_lines():
    index = L.TemplateIndex({})
    for width in (1, 3, 8):  # words a line, as a comment
        words = MIT.split()
        text = "\n".join("# " + " ".join(words[k:k + width]) for k in range(0, len(words), width))
        for body in (text, "some code\n" * 50 + text + "\n" + "more code\n" * 50):
            assert L.scan(body, index)["labels"] == "mit-notice"
            check_windows(body, index)
    filler = " filler" * 300
    scattered = filler.join("released under the mit license".split())
    assert L.scan(scattered, index)["labels"] == ""  # one line, no notice in it
    assert L.scan("Released under the terms of the MIT License", index)["labels"] == "mit,mit-notice"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.sampled_from([t for t, _ in L.TEMPLATES] + [" ".join(t.split()[:-1]) for t, _ in L.TEMPLATES]),
    st.sampled_from(sorted({w for t, _ in L.TEMPLATES for w in t.split()})),
    st.sampled_from(["x", "x y z", "\n", "q " * 7])), max_size=40), st.integers(0, 9))
def test_license_windows_random(parts, seed):
    rarity = {w: (zlib.crc32(w) >> seed) % 5 for w in L._VOCABULARY}
    check_windows(" ".join(parts), L.TemplateIndex(rarity))


# ---------------------------------------------------------------- personal data
def brute_personal(text):
    def luhn(s):
        d = [int(c) for c in s if c.isdigit()][::-1]
        return sum(d[::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0

    def count(s):
        return sum(c.isdigit() for c in s)
    spans = {
        "email": [m.span() for m in re.finditer(
            r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
               if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
                 if 16 <= count(m[0]) <= 19 and luhn(m[0])],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 8 <= count(m[0]) <= 15]}
    return spans


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789012345 .-+()@aZ_%é\n", max_size=70))
def test_base_spans_random(text):
    found = P.find(text)
    assert {k: found[k] for k in P.BASE_KINDS} == brute_personal(text)


def test_personal_data_on_documents(spark):
    docs = spark.read.parquet(DOCS).union(spark.createDataFrame(
        [(9001, "a@b.c 4111 1111 1111 1111, +1 (555) 010-9999 10.0.0.1 é x@y.example",
          "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    n = 0
    for r in P.summary(docs).collect():
        want = brute_personal(texts[r.doc_id])
        base = ",".join(f"{k}:{a}:{b}" for k in P.BASE_KINDS for a, b in want[k])
        assert [r[f"n_{k}"] for k in P.BASE_KINDS] == [len(want[k]) for k in P.BASE_KINDS]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.spans.startswith(base)
        n += len(base)
    assert n
    values = {r.value for r in P.spans(docs).where("doc_id = 9001").collect()}
    assert {"a@b.c", "x@y.example", "10.0.0.1", "4111 1111 1111 1111"} <= values


@pytest.mark.parametrize("unit", ["http:///", "token", "token=", "http://a_", "ftp://", "ssn-", "account no ",
                                  "secret: . ", "acct.", "a@", "1.", "12 ", "+1("])
def test_a_megabyte_of_anchors_is_scanned_in_linear_time(unit):
    def seconds(size):
        start = time.process_time()
        P.find(unit * (size // len(unit)))
        return time.process_time() - start
    P.find(unit)
    # (a quadratic scan took a minute for a sixteenth of this)
    assert seconds(1 << 20) < 20


def test_values_behind_anchors_that_fail():
    assert P.find("http:///http://a.b/c, token token=" + "x" * 16) == dict.fromkeys(P.KINDS, []) | {
        "url": [(8, 20)], "secret": [(34, 50)]}


def test_added_kinds():
    def values(text):
        return {(k, text[a:b]) for k, own in P.find(text).items() for a, b in own}
    assert ("url", "https://a.example/x?y=1") in values('see "https://a.example/x?y=1".')
    assert ("account", "GB29NWBK60161331926819") in values("IBAN: GB29NWBK60161331926819.")
    assert ("secret", "0123456789abcdef0123") in values('token = "0123456789abcdef0123"')
    assert values("the token is lost, my account was closed, https:// and ftp") == set()


@pytest.mark.parametrize("text, value", [
    ("IBAN: DE89 3704 0044 0532 0130 00 and", "DE89 3704 0044 0532 0130 00"),
    ("IBAN DE89-3704-0044-0532-0130-00.", "DE89-3704-0044-0532-0130-00"),
    ("iban number is gb29 nwbk 6016 1331 9268 19", "gb29 nwbk 6016 1331 9268 19"),
    ("IBAN NO93 8601 1117 947, then", "NO93 8601 1117 947"),
    ("IBAN: MT84 MALT 0110 0001 2345 MTLC AST0 01S", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"),
    ("account GB29 NWBK 6016 1331 9268 19", "GB29 NWBK 6016 1331 9268 19"),
    ("account number: 12345678", "12345678"), ("Account no. 12345678", "12345678"),
    ("account no.12345678", "12345678"), ("Acct. No: 1234 5678 90 is mine", "1234 5678 90"),
    ("ACCOUNT NR 12-345678 on", "12-345678"), ("account # 12345678", "12345678"),
    ("account id is 12345678 2 times", "12345678"), ("passport no. X1234567", "X1234567"),
    ("Passport number is X1234567 12", "X1234567"), ("SSN is 123-45-6789", "123-45-6789"),
    ("ssn 123 45 6789 2024", "123 45 6789"), ("account " + "1234 " * 9, "1234 " * 7 + "1234")])
def test_written_forms_of_accounts(text, value):
    assert [text[a:b] for a, b in P.find(text)["account"]] == [value]


@pytest.mark.parametrize("text", [
    "IBAN: DE88 3704 0044 0532 0130 00", "IBAN GB29NWBK60161331926818", "the account is closed",
    "account no. is unknown, account number", "IBAN is IBAN", "account number is no id 123", "acct.",
    "account1 12345678", "iban"])
def test_no_account(text):
    assert P.find(text)["account"] == []


# ---------------------------------------------------------------- edges
def test_odd_rows(spark):
    rows = R.quality(odd(spark)).collect()
    assert len(rows) == len(ODD) and not any(r.kept for r in rows if r.doc_id != 3)
    assert [r.n_words for r in rows if r.doc_id in (1, 2, None)] == [0, 0, 0, 0]
    rows = L.scan_licenses(odd(spark)).collect()
    assert len(rows) == len(ODD)
    assert {(r.n_base, r.first_word, r.labels, r.score) for r in rows} == {(0, None, "", 0.0)}
    rows = P.summary(odd(spark)).collect()
    assert len(rows) == len(ODD) and {r.spans for r in rows} == {""}


def test_empty_tables(spark):
    none = odd(spark).where("false")
    for made in (R.quality(none), R.keep_good(none), L.scan_licenses(none), P.summary(none),
                 P.spans(none)):
        assert made.collect() == []
