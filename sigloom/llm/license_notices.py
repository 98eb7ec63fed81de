"""License notices in texts, written exactly or with a few edits, by exact pieces and bounded-error matching.

A text is lower-cased and cut into words. A notice that may hold up to ``edits`` character edits is split into one
piece more, so that at least one piece stands unchanged in any match. All pieces are found in one pass of an
Aho-Corasick automaton; around each hit a fuzzy regular expression verifies the notice within its bound of edits and
gives the span. Notices without edits are their own only piece and are verified word by word.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Notice:
    """A phrase of words, the license that it tells, the edits that it may hold, and whether it is a base phrase."""

    phrase: str
    label: str
    edits: int = 0
    base: bool = False


# The base phrases.
BASE_NOTICES = (
    Notice("cc by", "cc-by", base=True),
    Notice("general public license", "gpl", base=True),
    Notice("all rights reserved", "reserved", base=True),
)
#: Short notices that are looked for with edits, about one in eight characters.
FUZZY_NOTICES = tuple(
    Notice(phrase, label, len(phrase) // 8)
    for phrase, label in (
        ("gnu general public license", "gpl"),
        ("gnu lesser general public license", "lgpl"),
        ("gnu affero general public license", "agpl"),
        ("all rights reserved", "reserved"),
        ("licensed under the apache license version 2 0", "apache-2.0"),
        ("apache license version 2 0", "apache-2.0"),
        ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
        ("released under the mit license", "mit"),
        ("redistribution and use in source and binary forms", "bsd"),
        ("mozilla public license version 2 0", "mpl-2.0"),
        ("creative commons attribution", "cc-by"),
        ("creative commons attribution sharealike", "cc-by-sa"),
        ("creative commons attribution noncommercial", "cc-by-nc"),
        ("dedicated to the public domain", "public-domain"),
        ("this is free and unencumbered software released into the public domain", "unlicense"),
        ("eclipse public license", "epl"),
        ("used with permission of the copyright holder", "permission"),
    )
)
NOTICES = BASE_NOTICES + FUZZY_NOTICES

#: Words: ASCII letters and digits, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOTICE = "array<struct<label:string,first_word:int,last_word:int,start:int,end:int,edits:int,likeness:double,base:boolean>>"


def _pieces(notice: Notice) -> list[tuple[int, str]]:
    """(place in the phrase, piece): one more than the edits, nearly equal. Base phrases are bounded by word ends."""
    if not notice.edits:
        return [(0, f" {notice.phrase} ")]
    n, k = len(notice.phrase), notice.edits + 1
    cuts = [n * j // k for j in range(k + 1)]
    return [(a, notice.phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class Searcher:
    """The automaton and the expressions of a list of notices. One for each task."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES):
        self.notices, self.word = notices, re.compile(WORD)
        self.automaton, by_piece = ahocorasick.Automaton(), {}
        for k, notice in enumerate(notices):
            for at, piece in _pieces(notice):
                by_piece.setdefault(piece, []).append((k, at))
        for piece, uses in by_piece.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()
        # Whole words on both sides; the first match, with the fewest edits that it can have there.
        fuzzy = lambda n: regex.compile(rf"(?e)(?<= )(?:{regex.escape(n.phrase, literal_spaces=True)}){{e<={n.edits}}}(?= )")
        self.fuzzy = {k: fuzzy(n) for k, n in enumerate(notices) if n.edits}
        self.pairs = {k: Counter(zip(n.phrase, n.phrase[1:])) for k, n in enumerate(notices) if n.edits}

    def search(self, text: str | None) -> tuple[int, list[dict]]:
        """The number of words, and the notices by place, then label; see ``notices``."""
        # Bytes lower A-Z alone, and faster than characters do.
        lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        words = self.word.findall(lowered)
        if not words:
            return 0, []
        line = f" {' '.join(words)} "
        hits: dict[int, set[int]] = {}
        for end, (length, uses) in self.automaton.iter(line):
            for k, at in uses:
                hits.setdefault(k, set()).add(end - length + 1 - at)
        if not hits:
            return len(words), []
        places, starts, at = [m.span() for m in self.word.finditer(lowered)], [], 1
        for s, e in places:
            starts.append(at)
            at += e - s + 1
        found = set()
        for k, firsts in hits.items():
            notice = self.notices[k]
            spans = [(f + 1, f + 1 + len(notice.phrase), 0) for f in firsts] if not notice.edits else self._verified(k, sorted(firsts), line)
            found |= {(*span, k) for span in spans}
        return len(places), [self._row(x, starts, places) for x in sorted(found, key=lambda x: (x[0], x[1], self.notices[x[3]].label, x[3]))]

    def _verified(self, k: int, firsts: list[int], line: str) -> Iterator[tuple[int, int, int]]:
        """Matches around candidate starts. Windows that overlap are searched as one, so that none is found twice."""
        notice = self.notices[k]
        reach, windows = notice.edits + 1, []
        for first in firsts:
            a, b = max(0, first - reach), min(len(line), first + len(notice.phrase) + reach)
            if windows and a <= windows[-1][1]:
                windows[-1][1] = max(windows[-1][1], b)
            else:
                windows.append([a, b])
        # An edit spoils two pairs of neighbouring characters at most, so a window without the others needs no matching.
        least = len(notice.phrase) - 1 - 2 * notice.edits
        for a, b in windows:
            there = Counter(zip(line[a:b], line[a + 1 : b]))
            if sum(min(n, there[pair]) for pair, n in self.pairs[k].items()) < least:
                continue
            for m in self.fuzzy[k].finditer(line, a, b):
                s, e = m.span()
                while s < e and line[s] == " ":
                    s += 1
                while e > s and line[e - 1] == " ":
                    e -= 1
                if e > s:
                    yield s, e, sum(m.fuzzy_counts)

    def _row(self, found: tuple[int, int, int, int], starts: list[int], places: list[tuple[int, int]]) -> dict:
        s, e, edits, k = found
        notice = self.notices[k]
        first, last = bisect_right(starts, s) - 1, bisect_right(starts, e - 1) - 1
        return {
            "label": notice.label, "first_word": first, "last_word": last, "start": places[first][0], "end": places[last][1],
            "edits": edits, "likeness": 1.0 - edits / len(notice.phrase), "base": notice.base,
        }


def notices(text: Column, phrases: tuple[Notice, ...] = NOTICES) -> Column:
    """A struct ``n_words, found``: the number of words, and for each notice its label, the first and last word (from 0),
    the span in the source text (code points, end exclusive), its edits and its likeness to the phrase.

    Null and empty texts hold no words and no notices. A notice that stands several times comes each time.
    """

    @F.arrow_udf(f"struct<n_words:bigint,found:{NOTICE}>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        searcher = Searcher(phrases)
        ints, row = pa.int32(), ("label", "first_word", "last_word", "start", "end", "edits", "likeness", "base")
        kind = pa.list_(pa.struct(list(zip(row, (pa.string(), ints, ints, ints, ints, ints, pa.float64(), pa.bool_())))))
        for texts in batches:
            results = [searcher.search(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([n for n, _ in results], type=pa.int64()), pa.array([f for _, f in results], type=kind)], names=["n_words", "found"]
            )

    return search(text)
