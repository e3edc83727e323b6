"""License scans: winnowed fingerprints pick candidates, banded alignment reports the spans."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

# Short notices of common licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without "
                    "modification, are permitted provided that the following conditions are met",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "all-rights-reserved": "All rights reserved.",
}
#: What tells a licence from its variants; each must be in the words that a notice is aligned with.
_VERSION = r"(?: [^\d ]+| \S+ or)? ?v?{}(?:\.0)?(?![.\d]*\d)"
MARKS = {
    "apache-2.0": (r"\bapache\b", r"\b(?:license|version|v)" + _VERSION.format(2)),
    "mit": (r"\bmit\b(?!-)",),
    "gpl-3.0": (r"\bgeneral\b", r"\b(?:license|version|v)" + _VERSION.format(3),
                r"^(?!.*\b(?:lesser|library|affero|lgpl|agpl)\b)"),
    "cc-by-nc-4.0": (r"\bby[- ]nc(?![- ](?:sa|nd)\b)" + _VERSION.format(4),),
    "cc-by-sa-4.0": (r"\bby[- ]sa(?![- ](?:nc|nd)\b)" + _VERSION.format(4),),
}
GRAM, WINDOW = 2, 2
_PUNCTUATION = b".,;:!?()[]\"'"
_TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word.strip(_PUNCTUATION))
        return h


def winnow(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes: the smallest word pair of every window, the last among equals."""
    n = len(words) - GRAM + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = (words[:n] * np.uint64(0x9E3779B97F4A7C15)) ^ words[1:n + 1]
    grams ^= grams >> np.uint64(31)
    picked = np.zeros(n, bool)
    if n < WINDOW:
        picked[int(np.argmin(grams))] = True
    else:
        right = grams[1:] <= grams[:-1]
        picked[np.flatnonzero(right) + 1] = True
        picked[np.flatnonzero(~right)] = True
    at = np.flatnonzero(picked)
    return at, grams[at]


def align(template: list[int], words: list[int], band: int,
          low: int = 0) -> tuple[int, int, int, int, int]:
    """Most template words matched in order where word minus template position is from ``low`` to
    ``low + 2 * band``; first and last word, first and last template position."""
    none = (0, -1, -1, -1, -1)
    best: dict[int, tuple[int, int, int, int, int]] = {}
    top = none
    for i, t in enumerate(template):
        now: dict[int, tuple[int, int, int, int, int]] = {}
        for j in range(max(0, i + low), min(len(words), i + low + 2 * band + 1)):
            corner = best.get(j - 1, none)
            options = [best.get(j, none), now.get(j - 1, none), corner]
            if words[j] == t:
                n, a, _, p, _ = corner
                options.append((n + 1, j if a < 0 else a, j, i if a < 0 else p, i))
            now[j] = max(options, key=lambda x: (x[0], x[1], -x[2]))
            top = max(top, now[j], key=lambda x: (x[0], x[1], -x[2]))
        best = now
    return top


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = 0.8,
         band: int = 3, marks: dict[str, tuple[str, ...]] = MARKS) -> DataFrame:
    """doc_id, template, coverage, start_char, end_char of every notice in every whole text.

    A notice cut at either end of the text counts by the words it has; one without the ``marks``
    of its template (another version, NC, SA, Lesser) is none of it. Null and empty texts have none; a notice that repeats is reported each time; ids pass
    through; an empty table gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        words = lambda x: [known[w] for w in x.lower().split()]
        bodies = {name: words(x.encode()) for name, x in templates.items()}
        index = defaultdict(list)
        for name, body in bodies.items():
            for at, h in zip(*winnow(np.array(body, np.uint64)), strict=True):
                index[int(h)].append((name, int(at)))
        keys = np.array(sorted(index), np.uint64)
        signs = {name: [re.compile(x) for x in marks.get(name, ())] for name in templates}

        def marked(name: str, data: bytes, spans: list[tuple[int, int]]) -> bool:
            said = b" ".join(data[x:y].lower().strip(_PUNCTUATION) for x, y in spans).decode()
            return all(x.search(said) for x in signs[name])

        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").to_pylist(), strict=True):
                data = (text or "").encode()
                own = np.array(words(data), np.uint64)
                at, grams = winnow(own)
                hit = np.flatnonzero(np.isin(grams, keys))
                starts: dict[tuple[str, int], list[int]] = {}  # hits of every diagonal
                for i in hit:
                    for name, p in index[int(grams[i])]:
                        starts.setdefault((name, int(at[i]) - p), []).append(int(at[i]))
                upto: dict[str, int] = {}
                spots = [m.span() for m in _TOKEN.finditer(data)] if starts else []
                for name, start in sorted(starts):
                    if starts[name, start][-1] < upto.get(name, 0):
                        continue
                    body, begin = bodies[name], max(upto.get(name, 0), start - band)
                    n, a, b, p, q = align(body, own[begin:max(0, start + len(body) + band)].tolist(),
                                          band, start - band - begin)
                    if n >= coverage * len(body) and marked(name, data, spots[
                            max(0, begin + a - p):begin + b + len(body) - q]):
                        upto[name] = begin + b + 1
                        first, last = spots[begin + a][0], spots[begin + b][1]
                        c = len(data[:first].decode())
                        out.append((doc_id, name, n / len(body), c,
                                    c + len(data[first:last].decode())))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out],
                                             schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("template", pa.string()), ("coverage", pa.float64()),
                        ("start_char", pa.int64()), ("end_char", pa.int64())])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, template string, coverage double, start_char long, end_char long")
