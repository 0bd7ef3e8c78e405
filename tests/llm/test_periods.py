"""Periodic runs against a search of all periods."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from abacist.llm import periods, queries

DOCS = "doc_id long, text string"


def brute(words):
    """All runs, and the words that stay."""
    best = {}
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            if end > at and length >= max(6, 4 * period):
                best.setdefault((at, length), period)  # rising periods, so the smallest stays
            at = end + 1
    runs = sorted((start, length, period) for (start, length), period in best.items())
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    kind = rng.randrange(4)
    if kind == 0:
        return rng.choices("ab", k=rng.randrange(0, 60))
    if kind == 1:
        return rng.choices("abcdefgh", k=rng.randrange(0, 200))
    words = []
    while len(words) < rng.randrange(20, 400):
        block = rng.choices("abcé", k=rng.randrange(1, 40 if kind == 2 else 90))
        words += block * rng.randrange(1, 9) + block[: rng.randrange(len(block))]
        words += rng.choices("abcdefgh", k=rng.randrange(3))
    return words


def test_periodic_runs(spark):
    rng = random.Random(5)
    told = {i: random_words(rng) for i in range(400)}
    rows = [(i, rng.choice([" ", "\n", "\t \x0b"]).join(words)) for i, words in told.items()]
    found = periods.periodic_runs(spark.createDataFrame(rows, DOCS).withColumn("runs", F.lit(0)))
    assert found.columns == ["doc_id", "n_words", "runs", "text"]
    found = {r.doc_id: r for r in found.collect()}
    several = 0
    for i, words in told.items():
        runs, text = brute(words)
        assert found[i].n_words == len(words)
        assert [tuple(r) for r in found[i].runs] == runs
        assert found[i].text == text
        several += len(runs) > 1
    assert several > 50


def test_long_text(spark):
    rng = random.Random(6)
    block = [f"w{n}" for n in rng.choices(range(5000), k=9000)]
    words = ["x"] * 30000 + block * 5 + block[:100] + [f"v{n}" for n in rng.choices(range(9), k=40000)] + ["a", "b", "c"] * 20000
    (row,) = periods.periodic_runs(spark.createDataFrame([(1, " ".join(words))], DOCS)).collect()
    runs = [tuple(r) for r in row.runs]
    assert {(0, 30000, 1), (30000, 45100, 9000), (len(words) - 60000, 60000, 3)} <= set(runs)
    numbers = np.unique(words, return_inverse=True)[1]
    for period in range(1, 40):  # short periods by another way; the long one is planted
        same = np.flatnonzero(np.diff(np.concatenate(([0], (numbers[:-period] == numbers[period:]).view(np.int8), [0]))))
        stretches = [(int(a), int(b - a + period)) for a, b in zip(same[::2], same[1::2])]
        long = {s for s in stretches if s[1] >= max(6, 4 * period)}
        assert {(s, n) for s, n, q in runs if q == period} <= long
        assert long <= {(s, n) for s, n, q in runs if period % q == 0}


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "b b b b b b b"), (5, "a a a a a a"), (5, "a a a a a a"), (5, "a a a a a"), (6, "é é é é " * 4)]
    found = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.text) for r in periods.periodic_runs(spark.createDataFrame(rows, DOCS)).collect())
    six = (5, 6, [(0, 6, 1)], "a")
    assert found == [(0, 7, [(0, 7, 1)], "b"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 1, [], "one"), (5, 5, [], "a a a a a"), six, six, (6, 8, [(0, 8, 1)], "é é")]
    assert periods.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0


def repeated(doc_id, words):
    checksum = zlib.crc32(str(doc_id).encode())
    group, n = checksum // 10, len(words)
    if checksum % 10 or not n:
        return words
    a = group % n
    p = 1 + (n - a) // (3 + group % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark, sf_dir):
    found = queries.op13_periodic_runs(spark, sf_dir)
    types = dict(found.dtypes)
    assert [types[c] for c in ("n_runs", "start", "length", "period", "exponent_milli")] == ["bigint"] * 5
    found = {r.doc_id: r for r in found.collect()}
    rows = queries.table(spark, sf_dir, "documents").collect()
    assert len(found) == len(rows)
    checked = 0
    for doc in rows:
        words = repeated(doc.doc_id, [w.decode() for w in (doc.text or "").encode().split()])
        if len(words) > 1500:
            continue
        runs, text = brute(words)
        row = found[doc.doc_id]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)) and row.collapsed_sha256 == sha(text)
        checked += len(runs) > 0
    assert checked > 5
