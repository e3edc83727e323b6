"""Near-duplicates against brute force: large groups, repeated and null ids, empty tables."""

import random

import pytest

from careweave.llm import minhash

DOCS = "doc_id long, text string, digest string, g long, odd string"


def shingles(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts, percent):
    """Row -> smallest row that it is linked with."""
    sets, low = [shingles(x) for x in texts], list(range(len(texts)))

    def root(i):
        while low[i] != i:
            low[i] = low[low[i]]
            i = low[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            same = len(a & sets[j])
            if a and sets[j] and 100 * same >= percent * (len(a) + len(sets[j]) - same):
                x, y = root(i), root(j)
                low[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


def edited(rng, words, changed):
    out = list(words)
    for i in rng.sample(range(len(words)), changed):
        out[i] = f"c{rng.randrange(10**9)}"
    return " ".join(out)


def corpus(seed):
    """A large group around one text, some of it linked through others only, small groups, copies."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10**6)}" for _ in range(200)]
    texts = [edited(rng, base, rng.choice([0, 1, 2, 3, 4, 5, 6, 8])) for _ in range(160)]
    chain = list(base)
    for _ in range(25):  # each link near the one before, the ends far apart
        chain = edited(rng, chain, 3).split()
        texts.append(" ".join(chain))
    for k in range(30):
        other = [f"{k}o{rng.randrange(10**6)}" for _ in range(rng.choice([3, 5, 40, 300]))]
        texts += [" ".join(other)] + [edited(rng, other, min(len(other), rng.choice([0, 1, 3, 7]))) for _ in range(3)]
    texts += [None, "", "  \n", "One two", "one TWO", "x " * 500, texts[0].upper()]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("percent, bands, rows", [(85, 36, 7), (80, 42, 6)])
def test_equals_brute_force(spark, percent, bands, rows):
    texts = corpus(percent)
    docs = spark.createDataFrame([(i, t, "clash", 7, "clash") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, percent, bands, rows).collect()}
    want = brute(texts, percent)
    assert got == {i: (len(shingles(t)), want[i]) for i, t in enumerate(texts)}


def test_repeated_and_null_ids_keep_their_links(spark):
    rng = random.Random(1)
    a, b, c = ([f"{x}{i}" for i in range(200)] for x in "abc")
    rows = [(1, " ".join(a)), (2, edited(rng, a, 1)), (1, " ".join(b)), (3, edited(rng, b, 1)),
            (None, " ".join(c)), (None, edited(rng, c, 1)), (9, edited(rng, c, 1)), (None, "all alone here"), (1, " ".join(a))]
    docs = spark.createDataFrame([(*r, "", 0, "") for r in rows], DOCS)
    got = sorted(((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (1, 1), (3, 1), (None, 9), (None, 9), (9, 9), (None, None), (1, 1)], key=str)


def test_whole_parity_never_exceeds_the_difference():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (1, 30, 500, 5000):
        common, x, y = (rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) for k in (n, n // 5, n // 7))
        a, b = (minhash.parity((np.union1d(common, z) >> np.uint64(53)).astype(np.int64), minhash.SET_BITS) for z in (x, y))
        apart = sum(bin(int(v) & (2**64 - 1)).count("1") for v in a ^ b)
        assert apart <= len(np.setxor1d(np.union1d(common, x), np.union1d(common, y)))


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
