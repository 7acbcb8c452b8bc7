"""Operator 13 against a plain parse, one element at a time, and against plain neighbours."""

import hashlib
import random

import numpy as np
import pytest

from postlens.llm import fingerprints as op
from postlens.llm.common import Powers

WORDS = [f"{a}{b}{c}" for a in ("ba", "re", "to", "li") for b in ("nu", "mes", "ka", "dro", "") for c in ("s", "ta", "ren", "i", "ly")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def plain_labels(symbols, rounds):
    labels = list(symbols)
    for _ in range(rounds):
        out = []
        for i, x in enumerate(labels):
            place = 0
            while i and (x >> place & 1) == (labels[i - 1] >> place & 1):
                place += 1
            out.append(2 * place + (x >> place & 1))
        labels = out
    return labels


def plain_names(text, level=op.LEVEL):
    """The tree of the text's phrases as nested tuples; equal phrases are equal tuples."""
    names, symbols, codes, i = set(), list(text), {}, 0
    while len(symbols) > 1 or i == 0:
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        # the coins are tossed over the operator's own names of the symbols, which it hashes from the same tree
        labels = plain_labels([s if i == 0 else codes[s] for s, _ in runs], 3 if i == 0 else 4)
        phrases = []
        for j, (s, n) in enumerate(runs):
            top = 0 < j < len(runs) - 1 and labels[j - 1] < labels[j] > labels[j + 1]
            if j == 0 or top:
                phrases.append(())
            phrases[-1] += ((s, n),)
        assert all(len(p) <= 13 for p in phrases) and all(len(p) > 1 for p in phrases[1:])
        new = {}
        for p in phrases:
            elements = np.array([s if i == 0 else codes[s] for s, _ in p], np.uint64)
            lengths = np.array([n for _, n in p], np.uint64)
            powers = Powers()
            sums = powers.running(op.mix(elements ^ op.mix(lengths)))
            new[p] = int(op.mix(powers.ranges(sums, np.array([0]), np.array([len(p)])))[0])
        codes, symbols, i = new, phrases, i + 1
        if i >= level or len(symbols) == 1:
            names |= {codes[p] for p in symbols}
    return names


def names_of(texts, level=op.LEVEL):
    raw = [t.encode() if isinstance(t, str) else t for t in texts]
    got, owner = op.phrase_names(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), Powers(), level)
    return [set(got[owner == i].tolist()) for i in range(len(texts))]


def test_names_equal_plain_parse():
    texts = ["", "a", "aa", "ab", "aaaa" * 40, "abab" * 30, prose(1, 60), "äöü ß 字字字 " * 20, "x", prose(2, 200), "aab" * 99]
    assert names_of(texts) == [plain_names(t.encode()) if t else set() for t in texts]


def test_equal_substrings_share_their_interior():
    shared = prose(7, 600)
    for level in (1, 2, 3, 4):
        inside = names_of([shared], level)[0]
        for before, after in (("", prose(8, 50)), (prose(9, 31), ""), ("q" * 77 + prose(10, 300), prose(11, 5))):
            other = names_of([before + shared + after], level)[0]
            # some few names at either end on each level
            assert len(inside - other) <= 12 * (9 - level)


def test_likeness_estimates_share_of_names():
    a, b = prose(20, 3000), prose(21, 3000)
    words = a.split()
    for part in (0.0, 0.25, 0.5, 0.9, 1.0):
        cut = int(part * len(words))
        mixed = " ".join(words[:cut] + b.split()[cut:])
        x, y = names_of([a, mixed])
        true = 2 * len(x & y) / (len(x) + len(y))
        got = op.likeness(*op.fingerprints([a.encode(), mixed.encode()], Powers()))
        assert abs(got - true) < 0.2 and abs(true - part) < 0.1
    assert op.likeness(b"", b"") == 1.0 and op.likeness(b"", op.fingerprints([b"a"], Powers())[0]) == 0.0


def plain_rows(rows):
    """Rows with ids, each with the next by descending id."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        t, u = t or "", u or ""
        half = len(t) // 2
        e = t[:len(t) - half] + u[:half]
        f, g, h = op.fingerprints([t.encode(), e.encode(), u.encode()], Powers())
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), f.hex(), g.hex(), op.likeness(f, g), op.likeness(f, h)))
    return sorted(out)


def judged(spark, df):
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    return [tuple(r[n] for n in names) for r in op.document_fingerprints(spark, df).collect()]


@pytest.mark.parametrize("chunk", [1 << 20, 500])
def test_neighbours(spark, monkeypatch, chunk):
    monkeypatch.setattr(op, "CHUNK", chunk)
    rng = random.Random(4)
    rows = [(i, prose(i, rng.randrange(0, 120))) for i in rng.sample(range(-500, 500), 300)] + [(1000, None), (1001, ""), (1002, "ß" * 9)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, part string, hash string").repartition(7)
    assert sorted(judged(spark, df)) == plain_rows(rows)


def test_single_row_is_its_own_next(spark):
    assert judged(spark, spark.createDataFrame([(5, "abcde")], "doc_id long, text string")) == plain_rows([(5, "abcde")])


def test_repeats_nulls_and_empty(spark, docs, rows, empty):
    got = judged(spark, docs)
    assert len(got) == len(rows) and judged(spark, empty) == []
    assert sorted((r[0] is None, r[0] or 0, r[1]) for r in got) == sorted((i is None, i or 0, len(t or "")) for i, t in rows)
    of = dict(zip([t for _, t in rows], op.fingerprints([(t or "").encode() for _, t in rows], Powers())))
    assert sorted(r[3] for r in got) == sorted(of[t].hex() for _, t in rows)
    assert all(0 <= x <= 1 for r in got for x in r[5:])
    many = spark.createDataFrame([(1, "same text of one id")] * 500, "doc_id long, text string").repartition(5)
    assert {r[6] for r in judged(spark, many)} == {1.0}
