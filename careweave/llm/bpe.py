"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks."""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
NO_RANK = 1 << 60
LONGEST_ROW, ROW_CELLS = 64, 1 << 20


def byte_letters() -> list[str]:
    """The visible letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Codec:
    """Vocabulary of one tokenizer file; remembers the ids of pieces of ``remembered`` letters."""

    def __init__(self, spec: str, remembered: int = 6_000_000):
        model = json.loads(spec)
        vocab = model["model"]["vocab"]
        letters = byte_letters()
        self.byte_ids = np.array([vocab[x] for x in letters])
        self.pairs = {}
        for rank, merge in enumerate(model["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocab[left], vocab[right]] = (rank, vocab[left + right])
        back = {x: b for b, x in enumerate(letters)}
        self.parts = {i: bytes(back[c] for c in token) for token, i in vocab.items()}
        self.special = {x["content"]: x["id"] for x in model["added_tokens"]}
        self.parts |= {i: x.encode() for x, i in self.special.items()}
        self.named = {str(i): x for i, x in self.parts.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") \
            if self.special else None
        self.known, self.held, self.remembered = {}, 0, remembered
        self.base = max(self.parts) + 2  # its last digit stands for no neighbour
        rows = sorted((a * self.base + b, rank, made) for (a, b), (rank, made) in self.pairs.items())
        self.keys, self.ranks, _ = (np.array(x, np.int64) for x in zip(*rows, strict=True)) \
            if rows else (np.array([-1]), np.array([0]), None)
        self.made = np.zeros(1 + max((r[1] for r in rows), default=0), np.int64)
        for _, rank, made in rows:
            self.made[rank] = made

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the root of the tree is the leftmost pair of the lowest rank."""
        ids = self.byte_ids[list(piece)].tolist()
        n, pairs = len(ids), self.pairs
        size = 1
        while size < n - 1:
            size *= 2
        none = (NO_RANK, n)
        tree = [none] * (2 * size)

        def ranked(i: int, j: int) -> tuple[int, int]:
            found = pairs.get((ids[i], ids[j]))
            return none if found is None else (found[0], i)

        for i in range(n - 1):
            tree[size + i] = ranked(i, i + 1)
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int, value: tuple[int, int]) -> None:
            k = size + i
            tree[k] = value
            while k > 1:
                k //= 2
                low = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == low:
                    break
                tree[k] = low

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while n > 1 and tree[1][0] != NO_RANK:
            i = tree[1][1]
            j = after[i]
            ids[i], ids[j] = pairs[ids[i], ids[j]][1], -1
            after[i] = k = after[j]
            if j < n - 1:
                put(j, none)
            if k < n:
                before[k] = i
                put(i, ranked(i, k))
            else:
                put(i, none)
            if before[i] >= 0:
                put(before[i], ranked(before[i], i))
        return [x for x in ids if x >= 0]

    def _ranked(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank and place of each pair in one number, the smaller the earlier it merges."""
        key = left * self.base + right
        spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[spot] == key, self.ranks[spot] * 256 + at, NO_RANK)

    def merge_rows(self, pieces: list[bytes], leaves: int) -> list[list[int]]:
        """``merge`` of many pieces of at most ``leaves`` + 1 bytes, a tree in each row.

        Every round takes the root of all trees that still have a pair, merges there, and renews
        the paths of the at most three leaves that this touches, one level at a time.
        """
        width, rows = leaves + 2, len(pieces)
        n = np.fromiter(map(len, pieces), np.int64, rows)
        spots = np.arange(width)
        raw = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in pieces), np.uint8)
        none = self.base - 1
        ids = np.where(spots < n[:, None], self.byte_ids[raw.reshape(rows, width)], none)
        tree = np.full((rows, 2 * leaves), NO_RANK)
        tree[:, leaves:] = self._ranked(ids[:, :leaves], ids[:, 1:leaves + 1], spots[:leaves])
        low = leaves
        while low > 1:
            tree[:, low // 2:low] = np.minimum(tree[:, low:2 * low:2], tree[:, low + 1:2 * low:2])
            low //= 2
        after = np.tile(spots + 1, (rows, 1))
        before = np.tile(spots - 1, (rows, 1))
        ids_, tree_, after_, before_ = (x.reshape(-1) for x in (ids, tree, after, before))
        live = np.arange(rows)
        while True:
            root = tree[live, 1]
            open_ = root < NO_RANK
            live, root = live[open_], root[open_]
            if not len(live):
                break
            i, row, top = root % 256, live * width, live * (2 * leaves)
            j = after_[row + i]
            k, h = after_[row + j], before_[row + i]
            ids_[row + i] = made = self.made[root // 256]
            ids_[row + j] = -1
            after_[row + i] = k
            before_[row + k] = i
            tree_[top + leaves + np.minimum(j, leaves - 1)] = NO_RANK
            tree_[top + leaves + i] = self._ranked(made, ids_[row + k], i)
            has = np.flatnonzero(h >= 0)
            hh = h[has]
            tree_[top[has] + leaves + hh] = self._ranked(ids_[row[has] + hh], made[has], hh)
            tops = np.concatenate([top, top, top[has]])
            path = np.concatenate([np.minimum(j, leaves - 1), i, hh]) + leaves
            while path[0] > 1:
                path = path // 2
                spot = tops + 2 * path
                tree_[tops + path] = np.minimum(tree_[spot], tree_[spot + 1])
        kept = (ids >= 0) & (ids != none)
        flat, ends = ids[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, pieces: set[str]) -> None:
        """Ids of new pieces; those of equal tree size together."""
        groups = defaultdict(list)
        for piece in pieces:
            self.held += len(piece)
            if piece in self.special:
                self.known[piece] = str(self.special[piece])
                continue
            data = piece.encode()
            leaves = 1 << max(0, len(data) - 2).bit_length()
            if leaves > LONGEST_ROW:
                self.known[piece] = ",".join(map(str, self.merge(data)))
            else:
                groups[leaves].append((piece, data))
        for leaves, group in groups.items():
            step = ROW_CELLS // leaves
            for at in range(0, len(group), step):
                some = group[at:at + step]
                for (piece, _), ids in zip(some, self.merge_rows([x for _, x in some], leaves),
                                           strict=True):
                    self.known[piece] = ",".join(map(str, ids))

    def pieces(self, text: str) -> list[str]:
        found = []
        for part in self.split.split(text) if self.split else [text]:
            if part in self.special:
                found.append(part)
            else:
                found += PATTERN.findall(part)
        return found

    def encode_texts(self, texts: list[str]) -> list[str]:
        """Ids of each text, joined by commas."""
        if self.held > self.remembered:
            self.known.clear()
            self.held = 0
        split = [self.pieces(x) for x in texts]
        self.learn(set().union(*split).difference(self.known))
        return [",".join(map(self.known.__getitem__, x)) for x in split]

    def encode(self, text: str) -> list[int]:
        joined = self.encode_texts([text])[0]
        return [int(x) for x in joined.split(",")] if joined else []

    def decode_joined(self, ids: str) -> str:
        return b"".join(map(self.named.__getitem__, ids.split(",") if ids else ())) \
            .decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        return self.decode_joined(",".join(map(str, ids)))


def _slices(texts: list[str], letters: int = 1_000_000) -> Iterator[list[str]]:
    """Whole texts in order, so many letters at a time; a longer text is a slice of its own."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text) > letters:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def _columns(spec: str, answer: Callable[[Codec, list[str]], list[list]], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec)
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, answer(codec, texts))], names=names)
    return run


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text.

    ``path`` is a tokenizer file on the driver; its text travels with the task. Null counts as
    empty (no tokens); ids pass through, null or repeated; other columns are ignored; an empty
    table gives no rows. Special strings inside a text become their id.
    """
    with open(path, encoding="utf-8") as file:
        spec = file.read()

    def answer(codec: Codec, texts: list[str]) -> list[list]:
        counts, ids_sha, texts_sha = [], [], []
        for some in _slices(texts):
            for ids in codec.encode_texts(some):
                counts.append(ids.count(",") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                texts_sha.append(hashlib.sha256(codec.decode_joined(ids).encode()).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                pa.array(texts_sha, pa.string())]

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return docs.select("doc_id", "text").mapInArrow(
        _columns(spec, answer, names),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
