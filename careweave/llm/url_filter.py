"""URL rules in a sorted array of 64-bit digests, memory-mapped and probed by binary search."""

from __future__ import annotations

import os
import string
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F


def write_rules(rules: Iterable[tuple[str, str]], path: str) -> None:
    """(``host/path``, verdict) pairs as counts, path lengths, keys, ends, verdicts, texts.

    One rule with two verdicts blocks. The list is limited by the disk of one machine.
    """
    verdicts: dict[str, str] = {}
    for rule, verdict in rules:
        verdicts[rule] = "block" if "block" in (verdict, verdicts.get(rule)) else verdict
    rows = sorted((xxhash.xxh64_intdigest(r), r.encode(), v == "block") for r, v in verdicts.items())
    lengths = sorted({len(r[r.index("/"):]) if "/" in r else 0 for r in verdicts})
    with open(path, "wb") as file:
        file.write(np.array([len(rows), len(lengths)], np.uint64).tobytes())
        file.write(np.array(lengths, np.uint64).tobytes())
        file.write(np.array([x[0] for x in rows], np.uint64).tobytes())
        file.write(np.cumsum([0] + [len(x[1]) for x in rows]).astype(np.uint64).tobytes())
        file.write(np.array([x[2] for x in rows], np.uint8).tobytes())
        file.write(b"".join(x[1] for x in rows))


class RuleFile:
    """The mapped file; ``find`` gives the row of each text, or -1."""

    def __init__(self, path: str):
        n, k = (int(x) for x in np.fromfile(path, np.uint64, 2))
        at = 16

        def part(kind, size):
            nonlocal at
            if not size:
                return np.empty(0, kind)
            got = np.memmap(path, kind, "r", at, (size,))
            at += got.nbytes
            return got

        self.lengths = [int(x) for x in part(np.uint64, k)]
        self.keys, self.ends, self.block = part(np.uint64, n), part(np.uint64, n + 1), part(np.uint8, n)
        self.texts = part(np.uint8, int(self.ends[-1]) if n else 0)

    def text(self, row: int) -> bytes:
        return self.texts[int(self.ends[row]):int(self.ends[row + 1])].tobytes()

    def find(self, probes: list[bytes]) -> np.ndarray:
        keys = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
        spots = np.searchsorted(self.keys, keys)
        found = np.full(len(probes), -1)
        hit = np.flatnonzero((spots < len(self.keys))
                             & (self.keys[np.minimum(spots, len(self.keys) - 1)] == keys)) \
            if len(self.keys) else []
        for i in hit:  # the stored text decides among equal keys
            row = int(spots[i])
            while row < len(self.keys) and self.keys[row] == keys[i]:
                if self.text(row) == probes[i]:
                    found[i] = row
                    break
                row += 1
        return found


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every url; the longest fitting rule decides.

    A rule fits its host and all subdomains when the path starts with the rule's. No rule:
    ``default``. Null urls and urls without ``://`` have an empty host and path. Ids pass
    through; other columns are ignored; an empty table gives no rows. The rule file is shipped
    to the executors by ``addFile``.
    """
    name = f"rules-{uuid.uuid4().hex}"
    path = os.path.join(SparkFiles.getRootDirectory(), name)
    write_rules(rules, path)
    pages.sparkSession.sparkContext.addFile(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = RuleFile(SparkFiles.get(name))
        for batch in batches:
            probes, owner = [], []
            rows = list(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(),
                            strict=True))
            for i, (host, tail) in enumerate(rows):
                labels = host.split(".")
                for k in range(len(labels)):
                    suffix = ".".join(labels[k:])
                    for n in table.lengths:
                        if n <= len(tail):
                            probes.append((suffix + tail[:n]).encode())
                            owner.append(i)
            best = [-1] * len(rows)
            for i, row in zip(owner, table.find(probes), strict=True):
                if row >= 0 and (best[i] < 0 or len(table.text(row)) > len(table.text(best[i]))):
                    best[i] = int(row)
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("host"), batch.column("path"),
                pa.array([None if r < 0 else table.text(r).decode() for r in best], pa.string()),
                pa.array([default if r < 0 else "block" if table.block[r] else "allow"
                          for r in best], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id", F.translate(F.regexp_extract(url, parts, 1), string.ascii_uppercase,
                               string.ascii_lowercase).alias("host"),
        F.regexp_extract(url, parts, 2).alias("path")).mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string")
