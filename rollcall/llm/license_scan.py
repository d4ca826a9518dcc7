"""License scan: exact base phrases and fuzzy search for short notices.

A text becomes its lower-cased words joined by single spaces.  A notice that may hold k
errors is cut into k + 1 seeds; a text within k edits of it contains one of the seeds
unchanged, so exact seed search finds every candidate place.  Around each place the
``regex`` library matches the notice with at most k edits and reports span and errors.

Defined results: a null text is empty and has no words; texts of any length are searched
whole; overlapping places of a base phrase all count; equal rows give equal results.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import texts

# The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Short notices searched with errors, as lower-cased words.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "redistribution and use in source and binary forms": "bsd",
    "subject to the terms of the mozilla public license": "mpl-2",
}
#: Letters of a notice for each error that is allowed in it.
LETTERS_PER_ERROR = 12

_SPACES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SCHEMA = (
    "doc_id long, n_words long, base array<struct<label:string,word:long>>, "
    "found array<struct<label:string,word:long,start:long,end:long,errors:int,likeness:double>>"
)


def words(text: str | None) -> bytes:
    """The words of a text, lower-cased in A-Z, joined by spaces, with a space at either end."""
    return b" " + b" ".join((text or "").encode("utf-8", "replace").lower().translate(_SPACES).split()) + b" "


def allowed(notice: str) -> int:
    return max(1, len(notice) // LETTERS_PER_ERROR)


@lru_cache
def _searches(notices: tuple[tuple[str, str], ...]) -> list[tuple]:
    out = []
    for notice, label in notices:
        k, raw = allowed(notice), notice.encode()
        cuts = [i * len(raw) // (k + 1) for i in range(k + 2)]
        seeds = [(a, raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        out.append((label, len(raw), k, seeds, regex.compile(rb"(?b)(?:%s){e<=%d}" % (regex.escape(raw, literal_spaces=True), k))))
    return out


def word_at(data: bytes) -> Callable[[int], int]:
    """Number of the word that starts behind the space at an offset, from 0."""
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return lambda at: int(np.searchsorted(gaps, at, "right")) - 1


def base_places(data: bytes) -> list[tuple[str, int]]:
    places = []
    word = word_at(data)
    for phrase, label in BASE.items():
        wanted = b" %s " % phrase.encode()
        at = data.find(wanted)
        while at >= 0:
            places.append((label, word(at)))
            at = data.find(wanted, at + 1)
    return places


def fuzzy_places(data: bytes, notices: tuple[tuple[str, str], ...] = tuple(NOTICES.items())) -> list[tuple]:
    """(label, word, start, end, errors, likeness) of every fuzzy place."""
    found = []
    word = word_at(data)
    for label, length, k, seeds, pattern in _searches(notices):
        windows = set()
        for offset, seed in seeds:
            at = data.find(seed)
            while at >= 0:
                windows.add((max(0, at - offset - k), min(len(data), at - offset + length + k)))
                at = data.find(seed, at + 1)
        # each window by itself: it is as long as the notice, so the time follows the seeds found,
        # and the best match of one does not hide those before it
        places = {m.span(): sum(m.fuzzy_counts) for m in (pattern.search(data, a, b) for a, b in windows) if m}
        for (start, end), errors in places.items():
            found.append((label, max(0, word(start)), start, end, errors, 1 - errors / length))
    return _best(found)


def _best(found: list[tuple]) -> list[tuple]:
    """Where places overlap, only the likeliest: similar notices differ by a few letters."""
    kept: list[tuple] = []  # apart from each other and in order, so only neighbours can overlap
    for place in sorted(found, key=lambda x: (-x[5], x[2], x[0])):
        i = bisect(kept, place[2], key=lambda x: x[2])
        if (i == 0 or kept[i - 1][3] <= place[2]) and (i == len(kept) or place[3] <= kept[i][2]):
            kept.insert(i, place)
    return kept


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    base_keys, found_keys = ("label", "word"), ("label", "word", "start", "end", "errors", "likeness")
    for frame in frames:
        rows = []
        for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
            data = words(text)
            base = [dict(zip(base_keys, x, strict=True)) for x in base_places(data)]
            found = [dict(zip(found_keys, x, strict=True)) for x in fuzzy_places(data)]
            rows.append((doc_id, data.count(b" ") - 1 if len(data) > 2 else 0, base, found))
        yield pd.DataFrame(rows, columns=["doc_id", "n_words", "base", "found"])


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places and fuzzy places with their spans.

    Spans are byte offsets into the joined words.
    """
    return texts(docs).mapInPandas(_scan, SCHEMA)


def summary(found: DataFrame) -> DataFrame:
    """The digest of ``scan``: counts, first and last base place, labels and score."""
    word = F.transform("base", lambda x: x["word"])
    base = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    every = F.array_sort(F.array_distinct(F.concat(F.transform("base", lambda x: x["label"]), F.transform("found", lambda x: x["label"]))))
    likeness = F.array_max(F.transform("found", lambda x: x["likeness"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(word).alias("first_word"),
        F.array_max(word).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(likeness, F.lit(0.0))).alias("score"),
    )
