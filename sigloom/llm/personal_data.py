"""Personal data in texts, disguised or not, with the places where it stands in the source.

Patterns first look at the text as it is. Then transducers rewrite disguises: look-alike letters and digits, invisible
characters, digits spelled as words, and "at" and "dot" in place of the signs. Each rewriting keeps a map from its
output to its input, so what the patterns find in the rewritten text is reported where it stands in the source.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.llm.spans import SPANS

# What the plain patterns find.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters that look like ASCII ones, beyond those that Unicode's compatibility forms know.
LOOK_ALIKES = dict(zip("аАеЕоОрРсСхХуУіІѕЅјЈһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανМНВТК", "aAeEoOpPcCxXyYiIsSjJhdqwABEZHIKMNOPTYXoavMHBTK"))
INVISIBLE = dict.fromkeys("­​‌‍⁠﻿", "")
DIGIT_WORDS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

#: Ranges in which a character may be another form of an ASCII one: full width, mathematical, superscripts, digits.
_FORMS = "！-～\U0001d400-\U0001d7ff⁰-ₜ¹²³٠-٩۰-۹०-९①-⑨。．"
_ODD = re.compile(f"[{''.join(LOOK_ALIKES)}{''.join(INVISIBLE)}{_FORMS}]")
_DIGIT_WORD = "|".join(DIGIT_WORDS)
#: Seven spelled digits or more in a row, after "plus" or not.
_SPELLED = re.compile(rf"(?:\bplus[ -]+)?\b(?:{_DIGIT_WORD})(?:[ -]+(?:{_DIGIT_WORD}))" + r"{6,}\b", re.I)
_ONE_SPELLED = re.compile(rf"\bplus[ -]+|[ -]*\b(?:{_DIGIT_WORD})\b", re.I)
_NUMBER = rf"(?:\b(?:{_DIGIT_WORD})\b|[0-9]++)"
#: Spelled digits and digits with separators or "dot" between them, without and with commas, after "plus" or not.
_MIXED = [
    re.compile(rf"(?:\bplus\b[ {c}-]++)?{_NUMBER}(?:(?>[ {c}.()-]++(?:dot\b[ {c}.()-]++)?){_NUMBER})*+", re.I) for c in ("", ",")
]
#: What a mixed run with something to rewrite has somewhere, in lower case.
_MIXED_SIGN = re.compile(rf"(?:{_DIGIT_WORD})[ ,.()-]++(?:{_DIGIT_WORD}|dot|[0-9])|[0-9][ ,.()-]++(?:{_DIGIT_WORD}|dot)|plus[ ,-]++(?:{_DIGIT_WORD}|[0-9])")
_PIECE = re.compile(rf"plus[ ,-]+|{_DIGIT_WORD}|[0-9]+|[ ,.()-]+(?:dot[ ,.()-]+)?", re.I)
_BRACKETED = re.compile(r"[ ]{0,3}[\[({<][ ]{0,3}(at|dot)[ ]{0,3}[\])}>][ ]{0,3}", re.I)
#: Words in place of both signs, in the shape of an address.
_WORDED = re.compile(r"(?<=[A-Za-z0-9_%+-])( at )(?=[A-Za-z0-9-]+(?: dot |\.)[A-Za-z])|(?<=[A-Za-z0-9-])( dot )(?=[A-Za-z])")
_ADDRESS_WORDS = re.compile(r"[A-Za-z0-9._%+-] at [A-Za-z0-9-]+ dot [A-Za-z]|@[A-Za-z0-9-]+ dot [A-Za-z]|[A-Za-z0-9._%+-] at [A-Za-z0-9-]+\.[A-Za-z]{2,}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """By the signs in turn: before one stand the most characters allowed, after it a domain."""
    free, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        before = text[free:at]
        local = len(before) - len(before.rstrip(LOCAL))
        if domain and local:
            yield at - local, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", max(free, at + 1))


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _plain(text: str) -> list[tuple[str, int, int]]:
    """By kind, then place: leftmost matches without overlap per kind; what fails a further condition is dropped."""
    found = [("email", s, e) for s, e in _emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


class _Rewritten:
    """A text after replacements, and the way back. ``edits``: (start, end, replacement) in order, without overlap."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        out, self.at, self.source = [], [], []
        done = length = 0
        for start, end, put in [*edits, (len(text), len(text), "")]:
            if start > done:
                self.at.append(length)
                self.source.append((done, start, True))
                out.append(text[done:start])
                length += start - done
            if put:
                self.at.append(length)
                self.source.append((start, end, False))
                out.append(put)
                length += len(put)
            done = end
        self.text = "".join(out)

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The span of the input that a non-empty span of the output came from."""
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        s, _, plain = self.source[i]
        first = s + start - self.at[i] if plain else s
        s, e, plain = self.source[j]
        return first, s + end - self.at[j] if plain else e


def _letters(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _ODD.finditer(text):
        put = LOOK_ALIKES.get(m[0], INVISIBLE.get(m[0]))
        if put is None:
            form = unicodedata.normalize("NFKC", m[0])
            number = unicodedata.decimal(form, None) if len(form) == 1 else None
            put = str(number) if number is not None else "." if form == "。" else form
        if put.isascii():
            edits.append((m.start(), m.end(), put))
    return edits


def _spelled(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for run in _SPELLED.finditer(text):
        for m in _ONE_SPELLED.finditer(text, run.start(), run.end()):
            word = m[0].strip(" -").lower()
            edits.append((m.start(), m.end(), "+" if word == "plus" else DIGIT_WORDS[word]))
    return edits


def _mixed(text: str, runs: re.Pattern) -> list[tuple[int, int, str]]:
    """Digits and dots of the runs that can hold an identifier: 9 digits or 4 numbers. The patterns decide then."""
    edits = []
    if not _MIXED_SIGN.search(text.lower()):
        return edits
    for run in runs.finditer(text):
        pieces = [(m.start(), m.end(), m[0].lower()) for m in _PIECE.finditer(text, run.start(), run.end())]
        spelled = [p in DIGIT_WORDS for _, _, p in pieces]
        digits = sum(1 if w else sum(c.isdigit() for c in p) for w, (_, _, p) in zip(spelled, pieces))
        if digits < 9 and sum("." in p or "dot" in p for _, _, p in pieces) < 3:
            continue
        for k, (start, end, p) in enumerate(pieces):
            if spelled[k]:
                edits.append((start, end, DIGIT_WORDS[p]))
            elif p.startswith("plus"):
                edits.append((start, end, "+"))
            elif "dot" in p:
                edits.append((start, end, "."))
            elif not p[0].isdigit() and not p.strip(" ,-") and (spelled[k - 1] or spelled[k + 1]):
                edits.append((start, end, ""))
            elif "," in p:
                edits.append((start, end, p.replace(",", " ").replace("  ", " ")))
    return edits


def _signs(text: str) -> list[tuple[int, int, str]]:
    edits = [(m.start(), m.end(), "@" if m[1].lower() == "at" else ".") for m in _BRACKETED.finditer(text)]
    if _ADDRESS_WORDS.search(text):
        edits += [(m.start(), m.end(), "@" if m[1] else ".") for m in _WORDED.finditer(text)]
    edits.sort()
    kept, done = [], 0
    for edit in edits:
        if edit[0] >= done:
            kept.append(edit)
            done = edit[1]
    return kept


def find_spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) by kind as listed, then start. Disguised ones that touch a base span of the kind are left out."""
    text = text or ""
    base = _plain(text)
    spans = [(kind, s, e, True) for kind, s, e in base]
    taken = {kind: [(s, e) for k, s, e in base if k == kind] for kind in KINDS}
    # Runs of words alone first; then mixed runs, which may join what does not belong together.
    for spelled in (_spelled, *(partial(_mixed, runs=runs) for runs in _MIXED)):
        levels, now, edited = [], text, spelled is _spelled
        for transducer in (_letters, spelled, _signs):
            if edits := transducer(now):
                levels.append(_Rewritten(now, edits))
                now = levels[-1].text
                edited |= transducer is spelled
        if not levels or not edited:
            continue
        for kind, s, e in _plain(now):
            for level in reversed(levels):
                s, e = level.back(s, e)
            k = bisect_left(taken[kind], (e,))
            if not k or taken[kind][k - 1][1] <= s:
                taken[kind].insert(k, (s, e))
                spans.append((kind, s, e, False))
    return sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def personal_data(text: Column) -> Column:
    """All spans of a text, by kind, then start. Null and empty texts: none."""

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        keys = ("kind", "start", "end", "base")
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        return pa.array([[dict(zip(keys, x)) for x in find_spans(t.as_py())] for t in texts], type=kind)

    return spans(text)


def redact(text: str | None) -> str | None:
    """Each span, overlapping ones as one, replaced by the kind of its first in brackets."""
    if text is None:
        return None
    out, done = [], 0
    for kind, start, end, _ in sorted(find_spans(text), key=lambda x: (x[1], -x[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``, and ``n_chars``, where there is one, counted anew. Null texts stay null."""

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        return pa.array([redact(t.as_py()) for t in texts], type=pa.string())

    out = docs.withColumn("text", cleaned("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out
