"""Licence notices in whole texts: exact phrases and fuzzy short notices.

Words are runs of letters, digits and non-ASCII characters after lower-casing
A-Z.  Base phrases count where their words stand consecutively.  Notices are
searched with up to k edits: a notice is split into k + 1 seeds, one of which
must stand in the text unchanged if at most k edits do (pigeonhole), an
Aho-Corasick automaton finds all seeds in one pass, and the ``regex`` library
verifies a window around each hit with bounded errors and gives the span.  The
words that tell a licence from its neighbours must stand unchanged.  Of spans that
overlap, whatever their labels, the one with the fewest edits a character counts,
the longest first.

Cases: a null text is empty; repeated rows are scanned each; texts of any
length are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect
from dataclasses import dataclass

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from lakeops.llm._common import map_batches

# Fixed values of the contract: phrase -> label.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}


@dataclass(frozen=True)
class Notice:
    """A short notice in normal form (lower-case words, one space between);
    ``deciding`` words of it must stand unchanged."""
    label: str
    text: str
    edits: int
    deciding: tuple[str, ...] = ()


NOTICES = (
    Notice("agpl", "gnu affero general public license", 3, ("affero",)),
    Notice("apache", "licensed under the apache license version 2 0", 4, ("apache",)),
    Notice("apache", "spdx license identifier apache 2 0", 2, ("apache",)),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("bsd", "spdx license identifier bsd", 1, ("bsd",)),
    Notice("cc-by", "creative commons attribution", 2),
    Notice("cc-by-nc", "licensed under cc by nc", 2, ("nc",)),
    Notice("cc-by-nd", "licensed under cc by nd", 2, ("nd",)),
    Notice("cc-by-sa", "licensed under cc by sa", 2, ("sa",)),
    Notice("cc0", "cc0 1 0 universal", 1, ("cc0",)),
    Notice("epl", "eclipse public license", 1, ("eclipse",)),
    Notice("gpl", "gnu general public license", 2, ("gnu", "general")),
    Notice("gpl", "licensed under the gnu general public license version", 4, ("gnu", "general")),
    Notice("gpl", "spdx license identifier gpl", 1, ("gpl",)),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    Notice("lgpl", "gnu lesser general public license", 3, ("lesser",)),
    Notice("lgpl", "spdx license identifier lgpl", 1, ("lgpl",)),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("mit", "released under the mit license", 2, ("mit",)),
    Notice("mit", "spdx license identifier mit", 1, ("mit",)),
    Notice("mpl", "mozilla public license version 2 0", 3, ("mozilla",)),
    Notice("public-domain", "released into the public domain", 2),
    Notice("reserved", "all rights reserved", 1),
    Notice("unlicense", "this is free and unencumbered software", 3, ("unencumbered",)),
    Notice("zlib", "altered source versions must be plainly marked as such", 4),
)

SPAN = StructType([StructField("label", StringType()), StructField("first_word", LongType()),
                   StructField("last_word", LongType()), StructField("edits", IntegerType())])

#: byte -> itself in a word (A-Z lower-cased), else a space
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))
SPACES = re.compile(rb"  +")


def normal(text: str | None) -> bytes:
    """The words of a text, one space between."""
    return SPACES.sub(b" ", (text or "").encode("utf-8", "surrogatepass").translate(NORMAL)).strip()


def seeds(notice: Notice) -> list[tuple[int, str]]:
    """(offset, seed): the notice in ``edits`` + 1 parts of nearly equal length."""
    cuts = [round(len(notice.text) * i / (notice.edits + 1)) for i in range(notice.edits + 2)]
    return [(a, notice.text[a:b]) for a, b in zip(cuts, cuts[1:])]


def pattern(notice: Notice) -> regex.Pattern:
    """The notice with at most ``edits`` edits in each stretch between deciding words."""
    parts, loose = [], []

    def end_stretch():
        if loose:
            parts.append(rb"(?:" + re.escape("".join(loose).encode()) + rb"){e<=%d}" % notice.edits)
            loose.clear()

    for token in re.findall("[^ ]+| ", notice.text):
        if token in notice.deciding:
            end_stretch()
            parts.append(rb"(?<![^ ])" + re.escape(token.encode()) + rb"(?![^ ])")
        else:
            loose.append(token)
    end_stretch()
    return regex.compile(rb"(?<![^ ])" + b"".join(parts) + rb"(?![^ ])", regex.BESTMATCH)


class Scanner:
    def __init__(self, notices: tuple[Notice, ...] = NOTICES, phrases: dict[str, str] = PHRASES):
        self.notices = notices
        self.phrases = [(re.compile(rb"(?<![^ ])" + p.encode() + rb"(?![^ ])"), label)
                        for p, label in phrases.items()]
        self.plain = [re.compile(rb"(?<![^ ])" + re.escape(n.text.encode()) + rb"(?![^ ])") for n in notices]
        self.fuzzed = [pattern(n) for n in notices]
        found: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(notices):
            for offset, seed in seeds(n):
                found.setdefault(seed, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in found.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()

    def base(self, text: bytes) -> list[tuple[int, str]]:
        """(byte offset, label) of every place of a base phrase."""
        return [(m.start(), label) for p, label in self.phrases for m in p.finditer(text)]

    def search(self, text: bytes, i: int, start: int, end: int) -> tuple[int, int, int, int] | None:
        """The best match of notice ``i`` within a window."""
        m = self.plain[i].search(text, start, end)
        if m and text[m.end():m.end() + 1] in (b"", b" "):
            return m.start(), m.end(), i, 0
        m = self.fuzzed[i].search(text, start, end)
        edits = sum(m.fuzzy_counts) if m else 0
        return (m.start(), m.end(), i, edits) if m and edits <= self.notices[i].edits else None

    def fuzzy(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) of verified matches, none over another.

        A window holds every match of its seeds whole and joins its neighbour up to
        twice its own length only, so the work grows with the number of hits."""
        windows: dict[int, list[list[int]]] = {}
        for end, (size, uses) in self.automaton.iter(text.decode("latin-1")):
            for i, offset in uses:
                n = self.notices[i]
                a = max(0, end + 1 - size - offset - n.edits - 1)
                b = min(len(text), end + 1 - size - offset + len(n.text) + n.edits + 1)
                own = windows.setdefault(i, [])
                if (own and own[-1][0] <= a <= own[-1][1]
                        and b - own[-1][0] <= 2 * (len(n.text) + 2 * n.edits + 2)):
                    own[-1][1] = max(own[-1][1], b)
                else:
                    own.append([a, b])
        hits = set()
        for i, own in windows.items():
            least = len(self.notices[i].text) - self.notices[i].edits
            for window in own:
                todo = [tuple(window)]
                while todo:                                        # the best match, then before and after it
                    start, end = todo.pop()
                    h = self.search(text, i, start, end)
                    if h:
                        hits.add(h)
                        todo += [(x, y) for x, y in ((start, h[0] - 1), (h[1], end)) if y - x >= least]
        kept: list[tuple[int, int, int, int]] = []                 # by place; none overlap
        for h in sorted(hits, key=lambda h: (h[3] / len(self.notices[h[2]].text), h[0] - h[1], h)):
            at = bisect(kept, h)
            if (at == 0 or kept[at - 1][1] <= h[0]) and (at == len(kept) or h[1] <= kept[at][0]):
                kept.insert(at, h)
        return kept

    def scan(self, text: str | None) -> tuple:
        t = normal(text)
        n_words = t.count(b" ") + 1 if t else 0
        places, fuzzy = self.base(t), self.fuzzy(t)
        at = {}
        if places or fuzzy:
            wanted = list({s for s, _ in places} | {x for h in fuzzy for x in h[:2]})
            before = np.flatnonzero(np.frombuffer(t, np.uint8) == 32)
            at = dict(zip(wanted, np.searchsorted(before, wanted).tolist()))
        starts = [at[p] for p, _ in places]
        base = sorted({label for _, label in places})
        spans = [{"label": self.notices[i].label, "first_word": at[a], "last_word": at[b], "edits": e}
                 for a, b, i, e in fuzzy]
        score = 1.0 if base else max((1 - e / len(self.notices[i].text) for _, _, i, e in fuzzy), default=0.0)
        return (n_words, len(places), min(starts, default=None), max(starts, default=None), ",".join(base),
                ",".join(sorted({*base, *(s["label"] for s in spans)})), score, spans)


def license_scan(docs: DataFrame, text: str = "text", notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """One row a document: base counts, labels, ``score`` (1 with a base
    phrase, else 1 - edits / length of the best fuzzy match, else 0) and the
    ``spans`` of verified notices in words."""
    schema = StructType([docs.schema["doc_id"], StructField("n_words", LongType()), StructField("n_base", LongType()),
                         StructField("first_word", LongType()), StructField("last_word", LongType()),
                         StructField("base_labels", StringType()), StructField("labels", StringType()),
                         StructField("score", DoubleType()), StructField("spans", ArrayType(SPAN))])

    def make():
        scanner = Scanner(notices)

        def step(batch):
            rows = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            return [batch.column(0)] + [[r[i] for r in rows] for i in range(8)]
        return step

    return map_batches(docs.select("doc_id", text), make, schema)
