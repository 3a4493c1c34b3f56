r"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, a plus or a dot
next to a digit, pairs of digits as in account numbers, address schemes and
the words that introduce an identifier.  From each anchor a small
deterministic parser walks left and right to the boundaries of the address or
number and validates it.

Kinds and their forms:

* ``email``  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``
* ``ip``     four dot-joined digit runs, each at most 255
* ``card``   digits with single spaces or hyphens between, 16 to 19 digits
  that pass the Luhn check
* ``phone``  ``\+[0-9][\x20().0-9-]+[0-9]`` with 8 to 15 digits
* ``url``    ``http://``, ``https://`` or ``ftp://`` and a host, to the next
  space, quote or bracket, without closing punctuation
* ``account``  an id of 6 to 34 letters, digits and hyphens with at least
  four digits behind ``ssn``, ``passport``, ``account`` or ``acct``; linking
  words (``LINKS``) may stand between.  Behind all but ``passport``, further
  groups of two or more capitals and digits, with a digit, that follow one
  space each belong to it (an SSN has nine digits at most).  Behind ``iban``,
  and first of all behind ``account`` and ``acct``, an IBAN: 15 to 34 letters
  and digits that pass mod 97, in groups joined by one space or hyphen
* ``secret`` a value of 16 or more characters assigned to ``token``,
  ``api_key``, ``apikey``, ``secret`` or ``password``

Each kind is found leftmost and without overlap; a form that fails its
validation is dropped and not tried again inside.  Spans are code points, the
end exclusive.

Defined results: a null or empty text has no spans.  Repeated rows are
answered one by one, an empty table gives no rows, other columns are not
read, very long texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "secret")

# The characters of each form
DIGITS = frozenset(string.digits)
ALNUM = frozenset(string.ascii_letters + string.digits)
HOST = frozenset(string.ascii_letters + string.digits + "-")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
PHONE = frozenset(" ().-" + string.digits)
SECRET = frozenset(string.ascii_letters + string.digits + "_-+/=.")
URL_END = frozenset(" \t\n\r\v\f\"'<>[]{}|\\^`")
SCHEMES = ("http://", "https://", "ftp://")
ACCOUNT_CUES = ("iban", "ssn", "passport", "account", "acct")
LINKS = ("number", "num", "no", "nr", "id", "is")  # behind a cue, "#" as a separator
SECRET_CUES = ("token", "api_key", "apikey", "secret", "password")


def _run(text: str, at: int, members: frozenset) -> int:
    """End of the run of ``members`` that starts at ``at``."""
    end = len(text)
    while at < end and text[at] in members:
        at += 1
    return at


def _run_back(text: str, at: int, members: frozenset, least: int) -> int:
    """Start of the run of ``members`` that ends before ``at``, not before ``least``."""
    while at > least and text[at - 1] in members:
        at -= 1
    return at


def luhn(digits: list[int]) -> bool:
    doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def iban(value: str) -> bool:
    """15 to 34 letters (of one case) and digits that pass mod 97."""
    if not (15 <= len(value) <= 34 and value[:2].isalpha() and value[2:4].isdigit()
            and value in (value.upper(), value.lower())):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


class Finder:
    """The automaton and the parsers.  A parser gets the text, the anchor and
    the end of what its kind has consumed; it returns the start and end of
    what it consumes, and whether that is a find."""

    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        anchors = {"@": ("email", 0)}
        for d in string.digits:
            anchors["+" + d] = ("phone", 0)
            anchors[d + "."] = ("ip", 0)
            for e in string.digits:
                for gap in ("", " ", "-"):
                    anchors[d + gap + e] = ("card", 0)
        for kind, cues in (("url", SCHEMES), ("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
            for cue in cues:
                for form in (cue, cue.upper(), cue.capitalize()):
                    anchors[form] = (kind, len(cue))
        for anchor, (kind, size) in anchors.items():
            self.automaton.add_word(anchor, (kind, len(anchor), size))
        self.automaton.make_automaton()
        self.parsers = {k: getattr(self, k) for k in KINDS}

    def find(self, text: str) -> dict[str, list[tuple[int, int]]]:
        """kind → spans in order."""
        found = {k: [] for k in KINDS}
        done = dict.fromkeys(KINDS, 0)
        for last, (kind, size, cue) in self.automaton.iter(text):
            anchor = last - size + 1
            if anchor < done[kind]:
                continue
            span = self.parsers[kind](text, anchor, done[kind], cue)
            if span is not None:
                start, end, valid = span
                done[kind] = end
                if valid:
                    found[kind].append((start, end))
        return found

    @staticmethod
    def email(text, at, least, _):
        start = _run_back(text, at, LOCAL, least)
        end = _run(text, at + 1, HOST)
        if start == at or end == at + 1:
            return None
        labels = 0
        while end + 1 < len(text) and text[end] == "." and text[end + 1] in HOST:
            end = _run(text, end + 1, HOST)
            labels += 1
        return (start, end, True) if labels else None

    @staticmethod
    def ip(text, at, least, _):
        start = _run_back(text, at, DIGITS, least)
        end, parts = _run(text, start, DIGITS), []
        parts.append(text[start:end])
        while len(parts) < 4:
            if not (end + 1 < len(text) and text[end] == "." and text[end + 1] in DIGITS):
                return None
            begin, end = end + 1, _run(text, end + 1, DIGITS)
            parts.append(text[begin:end])
        return start, end, all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in parts)

    @staticmethod
    def card(text, at, least, _):
        # the automaton reports the first pair of a chain first: `at` is its start,
        # unless an earlier chain was not consumed (none is left unconsumed)
        end, n = at + 1, len(text)
        while True:
            if end < n and text[end] in DIGITS:
                end += 1
            elif end + 1 < n and text[end] in " -" and text[end + 1] in DIGITS:
                end += 2
            else:
                break
        digits = [int(c) for c in text[at:end] if c in DIGITS]
        return at, end, 16 <= len(digits) <= 19 and luhn(digits)

    @staticmethod
    def phone(text, at, least, _):
        end = _run(text, at + 2, PHONE)
        while end > at + 3 and text[end - 1] not in DIGITS:
            end -= 1
        if end <= at + 3 or text[end - 1] not in DIGITS:
            return None
        return at, end, 8 <= sum(c in DIGITS for c in text[at:end]) <= 15

    @staticmethod
    def url(text, at, least, size):
        # (the host first: only a find, which is consumed, is walked to its end)
        host = _run(text, at + size, HOST)
        if host == at + size or text[host:host + 1] not in (".", ":", "/", ""):
            return None
        end = host
        while end < len(text) and text[end] not in URL_END:
            end += 1
        while text[end - 1] in ".,;:!?)":
            end -= 1
        return at, end, True

    @staticmethod
    def _value(text, at):
        """Start of the value behind a cue: separators, then a quote, are skipped."""
        limit = min(len(text), at + 8)
        while at < limit and text[at] in " \t:=#\"'":
            at += 1
        return at

    @classmethod
    def _linked_value(cls, text, at):
        """Start of the value behind a cue and any linking words."""
        start = cls._value(text, at)
        while True:
            end = _run(text, start, ALNUM)
            if text[start:end].lower() not in LINKS or text[end:end + 1] == "-":
                return start
            start = cls._value(text, end + (text[end:end + 1] == "."))

    @staticmethod
    def _iban_end(text, start):
        """End of the longest IBAN that starts at ``start``, or None."""
        end, value, found = start, "", None
        while True:
            stop = _run(text, end, ALNUM)
            value += text[end:stop]
            if stop == end or len(value) > 34:
                return found
            if iban(value):
                found = stop
            if text[stop:stop + 1] not in (" ", "-"):
                return found
            end = stop + 1

    @staticmethod
    def _joined_end(text, start, end, most_digits):
        """End of an id and of the groups of digits and capitals behind it."""
        size, digits = end - start, sum(c in DIGITS for c in text[start:end])
        while digits and text[end:end + 1] == " ":
            group = text[end + 1:_run(text, end + 1, HOST)].rstrip("-")
            own = sum(c in DIGITS for c in group)
            size, digits = size + len(group), digits + own
            if len(group) < 2 or not own or group != group.upper() or size > 34 or digits > most_digits:
                break
            end += 1 + len(group)
        return end

    @classmethod
    def account(cls, text, at, least, size):
        if at and text[at - 1].isalnum():
            return None
        cue, behind = text[at:at + size].lower(), at + size
        if cue == "acct" and text[behind:behind + 1] == ".":
            behind += 1
        start = cls._linked_value(text, behind)
        if start == at + size:
            return None
        if cue in ("iban", "account", "acct"):
            end = cls._iban_end(text, start)
            if end is not None:
                return start, end, True
            if cue == "iban":
                return None
        end = _run(text, start, HOST)
        while end > start and text[end - 1] == "-":
            end -= 1
        if cue != "passport":
            end = cls._joined_end(text, start, end, 9 if cue == "ssn" else 34)
        value = text[start:end].replace(" ", "")
        valid = 6 <= len(value) <= 34 and sum(c in DIGITS for c in value) >= 4
        return (start, end, True) if valid else None

    @classmethod
    def secret(cls, text, at, least, size):
        start = cls._value(text, at + size)
        if not any(c in "=:" for c in text[at + size:start]):
            return None
        end = _run(text, start, SECRET)
        while end > start and text[end - 1] == ".":
            end -= 1
        return (start, end, True) if end - start >= 16 else None


def listed(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by kind, then start, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


_FINDER: list[Finder] = []


def find(text: str | None) -> dict[str, list[tuple[int, int]]]:
    if not _FINDER:
        _FINDER.append(Finder())  # once per Python worker
    return _FINDER[0].find(text or "")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, kind, start, end, value)``: one row per find."""
    fields = "array<struct<kind:string,start:int,end:int,value:string>>"

    @F.pandas_udf(fields)
    def find_all(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"kind": k, "start": a, "end": b, "value": t[a:b]}
                              for k, own in find(t).items() for a, b in own] for t in batch],
                            dtype=object)

    return docs.select(docs[id_col].alias("doc_id"),
                       F.explode(find_all.asNondeterministic()(docs[text_col])).alias("s")) \
        .select("doc_id", "s.*")


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the number of finds of each base kind, the SHA-256 of the
    list of base spans, and the list of all spans, for every row of ``docs``."""
    counts = [f"n_{k}" for k in BASE_KINDS]

    @F.pandas_udf(", ".join(f"{c} long" for c in counts) + ", base_sha256 string, spans string")
    def personal_data(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                found = find(text)
                base = listed(found, BASE_KINDS)
                rows.append([*(len(found[k]) for k in BASE_KINDS),
                             hashlib.sha256(base.encode()).hexdigest(), listed(found, KINDS)])
            yield pd.DataFrame(rows, columns=[*counts, "base_sha256", "spans"])

    return docs.select(docs[id_col].alias("doc_id"),
                       personal_data.asNondeterministic()(docs[text_col]).alias("p")) \
        .select("doc_id", "p.*")
