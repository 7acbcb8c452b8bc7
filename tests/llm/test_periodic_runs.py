"""Operator 12 against a plain version that tries every period at every word."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from postlens.llm import periodic_runs as op


def plain_runs(words, shortest=24):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            block = words[i:i + q]
            if j - i + q >= max(shortest, 3 * q) and all(block != block[d:] + block[:d] for d in range(1, q) if q % d == 0):
                out.append((i, j - i + q, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain(doc_id, text, alter=True, shortest=24):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if alter and doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words, shortest)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    s, m, q = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), s, m, q, 1000 * m // q if found else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(left.encode()).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def described(spark, df, alter=op.planted, shortest=24):
    got, _ = op.periodic_runs(spark, df, shortest, alter)
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=str)


def repetitive(rng, n):
    """Words of a small alphabet with repeated blocks of many periods, one inside the other, broken here and there."""
    words = []
    while len(words) < n:
        block = [rng.choice("abcdefgh") for _ in range(rng.choice([1, 1, 2, 3, 5, 7, 8, 9, 16, 17, 31, 40]))]
        if rng.random() < 0.3:
            block = block * rng.randrange(2, 5) + [rng.choice("xyz")]
        words += (block * rng.randrange(1, 40))[: rng.randrange(1, 200)]
    return " ".join(words[:n])


def texts(seed, count, most):
    rng = random.Random(seed)
    return [(i, repetitive(rng, rng.randrange(0, most))) for i in range(count)]


def test_all_cases(spark, docs, rows):
    assert described(spark, docs) == sorted((plain(i, t) for i, t in rows), key=str)


@pytest.mark.parametrize("alter", [op.planted, op.unaltered])
def test_repetitive_texts(spark, alter):
    rows = texts(5, 120, 700)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert described(spark, df, alter) == sorted((plain(i, t, alter is op.planted) for i, t in rows), key=str)


@pytest.mark.parametrize("tile", [128, 512])
def test_fragments_of_tiles_are_stitched(spark, monkeypatch, tile):
    monkeypatch.setattr(op, "TILE", tile)
    monkeypatch.setattr(op, "LONG_TEXT", 200)
    rows = texts(6, 30, 1500) + [(100, "a " * 3000), (101, "a b " * 1500), (102, "c " + "a b " * 777 + "a a"), (103, None), (104, "")]
    rows += [(105, " ".join(str(i % 611) for i in range(2500))), (106, " ".join(str(i % 611) for i in range(2500))), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert described(spark, df) == sorted((plain(i, t) for i, t in rows), key=str)


def test_runs_and_longer_shortest(spark):
    rows = [(1, "x " + "a b c " * 20 + "y"), (2, "a b c " * 20)]
    _, runs = op.periodic_runs(spark, spark.createDataFrame(rows, "doc_id long, text string"), 48)
    assert sorted((r.start, r.length, r.period) for r in runs.collect()) == [(0, 60, 3), (1, 60, 3)]
    _, runs = op.periodic_runs(spark, spark.createDataFrame(rows, "doc_id long, text string"), 61)
    assert runs.count() == 0
    with pytest.raises(ValueError):
        op.periodic_runs(spark, spark.createDataFrame(rows, "doc_id long, text string"), 23)


def test_empty(spark, empty):
    assert described(spark, empty) == []


def test_tiles_cover_and_overlap():
    for n in (1, 24, 65_536, 65_537, 100_000, 1_500_000):
        for low, high, size in op._octaves(n):
            cut = [(a, b) for a, b, p, _ in op.tiles(n) if p == low]
            assert cut[0][0] == 0 and cut[-1][1] == n and (len(cut) == 1 or size >= 8 * high)
            assert all(b > c + size // 2 - 1 and a < c for (a, b), (c, _) in zip(cut, cut[1:]))
        assert [p for p, _, _ in op._octaves(n)][:1] == ([1] if n >= 3 else [])
