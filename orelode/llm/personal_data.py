"""Personal data in texts: anchors found by one automaton, boundaries by small parsers around them.

An Aho-Corasick automaton reads a text once and reports its anchors: at-signs, schemes, digits that
stand together, and words that announce an identifier. A parser of the anchor's kind then walks from
there to both sides over the characters its kind may hold, and a check decides on what it found. Every
walk ends at a character its kind cannot hold or at the end of the kind's last find, so the time for a
text follows its length.

Four kinds are *base*: their spans are the leftmost non-overlapping matches of the patterns below, less
those that fail the check.

* ``email``: ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ``ip``: four runs of digits joined by dots, none above 255
* ``card``: digits with at most one blank or hyphen between two; 14 to 19 of them that pass Luhn
* ``phone``: ``\\+[0-9][ ().0-9-]+[0-9]`` with 10 to 15 digits

Three more are found by their cues: ``login`` (user and password in a URL, scheme to host), ``iban``
(the cue, then an account number whose check digits fit) and ``account`` (a cue such as "passport no",
then at least six characters of letters and digits, most of them digits).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds in the order in which spans of one start are listed; the first four are base.
KINDS = ("email", "ip", "card", "phone", "login", "iban", "account")
BASE = KINDS[:4]
SPANS = "array<struct<kind string, begin long, end long>>"

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LABEL = _DIGITS | _LETTERS | {"-"}
_LOCAL = _LABEL | frozenset("._%+")
_PHONE = _DIGITS | frozenset(" ().-")
_USER = _LOCAL | frozenset("~!$&'()*,;=:")
# Words that announce an identifier, in lower case.
_CUES = (
    "account", "acct", "customer id", "customer number", "driver's license", "driver's licence",
    "insurance number", "member id", "passport", "social security", "ssn", "tax id",
)
_LINKS = ("number", "nr", "no", "id", "is")
# Luhn's sums of a doubled digit.
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    """The automaton; each anchor's value is its kind and its length."""
    words = {"@": "email", "://": "login"}
    digits = sorted(_DIGITS)
    for a in digits:
        words[f"+{a}"] = "phone"
        for b in digits:
            words[f"{a}.{b}"] = "ip"
            words |= {f"{a}{gap}{b}": "card" for gap in ("", " ", "-")}
    for cue in (*_CUES, "iban"):
        kind = "iban" if cue == "iban" else "account"
        words |= {form: kind for form in (cue, cue.upper(), cue.title(), cue.capitalize())}
    automaton = ahocorasick.Automaton()
    for word, kind in words.items():
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def _back(text: str, at: int, least: int, allowed: frozenset) -> int:
    """Where the run of ``allowed`` characters that ends before ``at`` begins, not before ``least``."""
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def _run(text: str, at: int, allowed: frozenset) -> int:
    """Where the run of ``allowed`` characters from ``at`` on ends."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _host(text: str, at: int) -> int:
    """The end of two or more labels joined by dots, or ``at``."""
    end = _run(text, at, _LABEL)
    if end == at:
        return at
    dots = 0
    while end < len(text) and text[end] == "." and (after := _run(text, end + 1, _LABEL)) > end + 1:
        end, dots = after, dots + 1
    return end if dots else at


def _luhn(digits: list[str]) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(_DOUBLED[v] for v in values[1::2])) % 10 == 0


# Each parser takes the text, where its anchor begins and ends, and where the last walk of its kind
# ended. It returns the spans found and how far it has read: anchors before that are passed over.
Found = tuple[list[tuple[int, int]], int]


def _email(text: str, begin: int, end: int, least: int) -> Found:
    start, stop = _back(text, begin, least, _LOCAL), _host(text, end)
    return ([(start, stop)], stop) if start < begin and stop > end else ([], least)


def _ip(text: str, begin: int, end: int, least: int) -> Found:
    at = _back(text, begin + 1, least, _DIGITS)
    parts = []
    while True:
        stop = _run(text, at, _DIGITS)
        parts.append((at, stop))
        if not (stop + 1 < len(text) and text[stop] == "." and text[stop + 1] in _DIGITS):
            break
        at = stop + 1
    found = []
    for i in range(0, len(parts) - 3, 4):
        numbers = [text[a:b].lstrip("0") or "0" for a, b in parts[i : i + 4]]
        if all(len(x) <= 3 and int(x) <= 255 for x in numbers):
            found.append((parts[i][0], parts[i + 3][1]))
    return found, stop


def _card(text: str, begin: int, end: int, least: int) -> Found:
    start = begin
    while start > least:
        if text[start - 1] in _DIGITS:
            start -= 1
        elif text[start - 1] in " -" and start - 1 > least and text[start - 2] in _DIGITS:
            start -= 2
        else:
            break
    stop, n, digits = start, len(text), []
    while True:
        if stop < n and text[stop] in _DIGITS:
            digits.append(text[stop])
            stop += 1
        elif stop + 1 < n and text[stop] in " -" and text[stop + 1] in _DIGITS:
            stop += 1
        else:
            break
    return ([(start, stop)] if 14 <= len(digits) <= 19 and _luhn(digits) else []), stop


def _phone(text: str, begin: int, end: int, least: int) -> Found:
    stop = _run(text, end, _PHONE)
    while stop > end and text[stop - 1] not in _DIGITS:
        stop -= 1
    if stop < end + 2:
        return [], end
    digits = sum(c in _DIGITS for c in text[begin:stop])
    return ([(begin, stop)] if 10 <= digits <= 15 else []), stop


def _login(text: str, begin: int, end: int, least: int) -> Found:
    start, user = _back(text, begin, least, _LETTERS), _run(text, end, _USER)
    if start == begin or user >= len(text) or text[user] != "@" or ":" not in text[end:user]:
        return [], end
    stop = _host(text, user + 1)
    if stop == user + 1:
        stop = _run(text, user + 1, _LABEL)
    return ([(start, stop)], stop) if stop > user + 1 else ([], end)


def _value_at(text: str, at: int) -> int:
    """Past what stands between a cue and its value: blanks, signs and words such as "number"."""
    for _ in range(4):
        at = _run(text, at, frozenset(" .:#=\t-"))
        link = next((w for w in _LINKS if text[at : at + len(w)].lower() == w), None)
        after = at + len(link) if link else at
        if not link or (after < len(text) and text[after] in _LETTERS | _DIGITS):
            return at
        at = after
    return at


def _standing(text: str, begin: int, end: int) -> bool:
    """Whether the cue is a word of its own, not a piece of another."""
    return not (begin and text[begin - 1].isalnum()) and not (end < len(text) and text[end].isalpha())


def _iban(text: str, begin: int, end: int, least: int) -> Found:
    if not _standing(text, begin, end):
        return [], end
    at = _value_at(text, end)
    # The longest IBAN has 34 characters, printed in groups of four.
    signs, stops = [], []
    stop = at
    while stop < len(text) and len(signs) < 34:
        if text[stop] in _LETTERS or text[stop] in _DIGITS:
            signs.append(text[stop].upper())
            stops.append(stop + 1)
        elif text[stop] != " " or not signs or text[stop - 1] == " ":
            break
        stop += 1
    for n in range(len(signs), 14, -1):
        own, last = signs[:n], stops[n - 1]
        ended = last == len(text) or not text[last].isalnum()
        if ended and own[0] + own[1] <= "ZZ" and own[0].isalpha() and own[1].isalpha() and own[2] + own[3] in _PAIRS:
            if int("".join(str(int(c, 36)) for c in own[4:] + own[:4])) % 97 == 1:
                return [(at, last)], last
    return [], end


_PAIRS = frozenset(f"{n:02d}" for n in range(100))


def _account(text: str, begin: int, end: int, least: int) -> Found:
    if not _standing(text, begin, end):
        return [], end
    at = _value_at(text, end)
    stop = _run(text, at, _LABEL)
    while stop > at and text[stop - 1] == "-":
        stop -= 1
    digits = sum(c in _DIGITS for c in text[at:stop])
    good = stop - at >= 6 and 2 * digits > stop - at
    return ([(at, stop)], stop) if good else ([], end)


_PARSERS = {
    "email": _email, "ip": _ip, "card": _card, "phone": _phone,
    "login": _login, "iban": _iban, "account": _account,
}


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """``(kind, begin, end)`` in code points, end exclusive, by begin and then kind; NULL has none."""
    if not text:
        return []
    read = dict.fromkeys(KINDS, 0)
    found = []
    for last, (kind, size) in _anchors().iter(text):
        end = last + 1
        begin = end - size
        if begin < read[kind]:
            continue
        new, read[kind] = _PARSERS[kind](text, begin, end, read[kind])
        found += [(kind, a, b) for a, b in new]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def finder() -> Callable[[Column], Column]:
    """A function of a text column that gives its spans, as :data:`SPANS`.

    NULL, empty texts and texts without personal data give an empty array, never NULL. Each row is
    judged alone, so repeated rows give the same spans, and an empty table gives no rows. Spans of one
    kind never overlap; spans of different kinds may.
    """

    @F.pandas_udf(SPANS)
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [[{"kind": k, "begin": a, "end": b} for k, a, b in spans(t)] for t in texts], dtype=object
        )

    return find


def masked(text: Column, found: Column) -> Column:
    """``text`` with each stretch that spans cover replaced by its first span's kind in brackets.

    Overlapping and nested spans make one stretch. NULL stays NULL.
    """
    start = F.struct(
        F.lit("").alias("text"), F.lit(0).cast("long").alias("read")
    )

    def step(state, span):
        gap = F.substr(text, state["read"] + 1, span["begin"] - state["read"])
        put = F.concat(state["text"], gap, F.lit("["), span["kind"], F.lit("]"))
        return F.struct(
            F.when(span["begin"] >= state["read"], put).otherwise(state["text"]).alias("text"),
            F.greatest(state["read"], span["end"]).alias("read"),
        )

    rest = lambda state: F.concat(
        state["text"], F.substr(text, state["read"] + 1, F.greatest(F.length(text) - state["read"], F.lit(0)))
    )
    return F.when(text.isNotNull(), F.aggregate(found, start, step, rest))
