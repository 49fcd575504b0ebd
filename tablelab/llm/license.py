"""License notices by exact phrases and by fuzzy search.

The base phrases are looked for as words.  Short notices are also found with errors: a
notice allowed ``k`` errors is cut into ``k + 1`` pieces, of which any copy with at most
``k`` errors holds one unchanged (pigeonhole).  Pieces are sought exactly; around each
place found the ``regex`` library matches the whole notice with bounded errors, which
verifies the copy and gives its span.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.llm.common import ALNUM_LOWER, col, fresh

#: Phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: label: (notice, errors allowed).  Notices are words as the documents' words are made.
NOTICES = {
    "mit": [("released under the mit license", 3), ("permission is hereby granted free of charge to any person", 5)],
    "apache": [("licensed under the apache license version 2 0", 4)],
    "gpl": [("licensed under the gnu general public license", 4), ("gnu general public license version", 3)],
    "cc by nc": [("licensed under cc by nc 4 0", 1)],
    "cc by sa": [("licensed under cc by sa 4 0", 1)],
    "cc by": [("creative commons attribution license", 3)],
    "bsd": [("redistribution and use in source and binary forms", 4)],
    "mpl": [("subject to the terms of the mozilla public license", 4)],
    "all rights reserved": [("all rights reserved", 1)],
}
RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
    "score double, spans array<struct<label: string, start: int, end: int, errors: int>>"
)


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of about equal length that make up the notice, with their places."""
    n = errors + 1
    edges = [round(i * len(notice) / n) for i in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def compiled(notices: dict = NOTICES) -> list[tuple]:
    """(label, notice, errors, pieces, pattern) of each notice, between word edges; made once per task."""
    return [
        (label, notice, errors, pieces(notice, errors), regex.compile(f"(?b) (?:{regex.escape(notice)}){{e<={errors}}}(?= )"))
        for label, items in notices.items()
        for notice, errors in items
    ]


def find_fuzzy(text: str, patterns: list[tuple]) -> list[tuple[str, int, int, int]]:
    """``(label, start, end, errors)`` of all copies, best matches of non-overlapping places, in words' text.

    ``text``: words joined by one space.  Places are in its characters.  Copies are whole words:
    letters more or less at their ends are errors.
    """
    found, held = [], f" {text} "
    for label, notice, errors, parts, pattern in patterns:
        at = set()
        for offset, piece in parts:
            i = text.find(piece)
            while i >= 0:
                at.add(i - offset)
                i = text.find(piece, i + 1)
        end = -1
        for i in sorted(at):
            a, b = max(0, i - errors, end), min(len(text), i + len(notice) + 2 * errors)
            # A copy must be able to fit; each place is tried, as copies may lie side by side.
            # The blank before is matched, as ``regex`` takes no letter too many where a search starts.
            m = pattern.search(held, a, b + 2) if b - a >= len(notice) - errors else None
            if m:
                found.append((label, m.start(), m.end() - 1, sum(m.fuzzy_counts)))
                end = m.end() - 1
    return found


def words_before(text: str, places: Iterable[int]) -> dict[int, int]:
    """How many blanks precede each place of the text; one pass over it."""
    out, at, n = {}, 0, 0
    for p in sorted(set(places)):
        n += text.count(" ", at, p)
        at, out[p] = p, n
    return out


def scan_text(text: str | None, base: dict = BASE, patterns: list[tuple] | None = None) -> tuple:
    """The values of ``RESULT`` for a text; null is empty.  Spans are places in words, end exclusive."""
    words = ("" if text is None else text).encode("utf-8", "surrogatepass").translate(ALNUM_LOWER).split()
    joined = b" ".join(words).decode("utf-8", "surrogatepass")
    held = f" {joined} "
    places, labels = [], set()
    for phrase, label in base.items():
        i = held.find(f" {phrase} ")
        while i >= 0:
            places.append(i)
            labels.add(label)
            i = held.find(f" {phrase} ", i + 1)
    n_base, starts = len(places), words_before(held, places).values()
    found = find_fuzzy(joined, compiled() if patterns is None else patterns)
    number = words_before(joined, [p for _, a, b, _ in found for p in (a, b)])
    spans, score = [], 1.0 if labels else 0.0
    for label, a, b, errors in found:
        first = number[a] + (joined[a] == " ")
        last = number[b] + (joined[b - 1] != " ")
        spans.append({"label": label, "start": first, "end": max(last, first + 1), "errors": errors})
        score = max(score, 1.0 - errors / max(b - a, 1))
    every = sorted(labels | {s["label"] for s in spans})
    return (
        len(words), n_base, min(starts, default=None), max(starts, default=None), sorted(labels), every, score,
        sorted(spans, key=lambda s: (s["start"], s["label"])),
    )


def scan(docs: DataFrame, text_col: str = "text", result_col: str = "license", base: dict = BASE, notices: dict = NOTICES) -> DataFrame:
    """``docs`` with a struct of ``RESULT``; a column of that name is replaced.

    Words are runs of digits, letters (A-Z lower-cased) and everything beyond ASCII.
    ``score`` is 1 for a base phrase or an exact notice and falls with a notice's errors; 0
    if nothing is found.  Null and empty texts have no words; repeated rows are alike.
    """
    names = [x.split()[0] for x in "n_words n_base first_word last_word base_labels labels score spans".split()]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        patterns = compiled(notices)
        for texts in batches:
            rows = [scan_text(t, base, patterns) for t in texts]
            frame = pd.DataFrame(rows, columns=names)
            for c in ("first_word", "last_word"):
                frame[c] = pd.array(frame[c], dtype="Int64")
            yield frame

    docs = docs.drop(result_col)
    return docs.withColumn(fresh(docs, result_col)[0], F.pandas_udf(run, RESULT)(col(text_col)))


def joined_labels(labels: Column) -> Column:
    return F.array_join(labels, ",")
