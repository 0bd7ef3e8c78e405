"""Dedup operators against brute force, with nulls, ties, repeats and empty tables."""

import random
import re

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from abacist.llm import chunks, components, lines, simhash, spans, suffixes

DOCS = "doc_id long, text string"


def corpus(seed: int, count: int = 60) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 8))) for _ in range(60)]
    sentences = [" ".join(rng.choices(words, k=rng.randrange(3, 12))).capitalize() + rng.choice(".!?") for _ in range(40)]
    passages = ["\n".join(rng.choices(sentences, k=6)) for _ in range(4)]
    found = []
    for i in range(count):
        parts = [rng.choice(rng.choices(sentences, k=3) + passages) for _ in range(rng.randrange(0, 6))]
        parts += ["x" * rng.randrange(80, 260)] if rng.random() < 0.2 else []
        parts += ["ab" * rng.randrange(40, 160)] if rng.random() < 0.2 else []
        found.append((i * 3 - 50, rng.choice([" ", "\n", "\n\n"]).join(parts)))
    return found


def frame(spark, rows, parts=3):
    rows = list(rows)
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def brute_strings(docs):
    seen, found = set(), {}
    for doc, text in sorted(docs):
        data = text.encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            window = data[at : at + 100]
            if window in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(window)
        found[doc] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(b for b, g in zip(data, gone) if not g))
    return found


@pytest.mark.parametrize("segments,copies", [(2048, 1 << 14), (2, 1 << 14), (2048, 2), (2, 2)])
def test_repeated_strings(spark, segments, copies):
    docs = corpus(7)
    found = suffixes.without_repeated_strings(frame(spark, docs, 8), hot_segments=segments, hot_copies=copies).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found} == brute_strings(docs)
    assert sum(r.n_removed for r in found) > 1000


def test_segments_of_equal_digest_are_compared(monkeypatch):
    ids, texts = zip(*corpus(7))
    chunk = chunks.Chunk(chunks.pack(pa.array(ids), pa.array(texts)))
    whole = suffixes._segments

    def weak(*args):
        anchor, digest, *rest = whole(*args)
        return anchor, digest % 2, *rest

    monkeypatch.setattr(suffixes, "_segments", weak)
    found = suffixes.Segments(chunk)
    by_bytes = {}
    for at, (start, windows) in enumerate(zip(found.start.tolist(), found.windows.tolist())):
        first = by_bytes.setdefault((found.anchor[at], chunk.data[start : start + windows + 99].tobytes()), at)
        assert found.firsts[found.number[at]] == first
    pairs = {(a, d) for a, d in zip(found.anchor.tolist(), found.digest.tolist())}
    assert len(found.firsts) == len(by_bytes) > len(pairs)


def test_repeated_strings_of_a_very_long_text(spark):
    text = " ".join(map(str, range(1_300_000)))
    cut = 64 * suffixes.BLOCK_BYTES  # longer texts are hashed in stretches
    assert len(text) > cut + 1000
    across, before = text[cut - 400 : cut + 400], text[5000:5150]
    rows = [(1, text + "|" + across + "|"), (2, "#" + before + "#" + across[300:500] + "#")]
    found = {r.doc_id: (r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.without_repeated_strings(frame(spark, rows)).collect()}
    assert found == {1: (800, 1, (text + "||").encode()), 2: (350, 2, b"###")}


def test_chunks_do_not_depend_on_the_order_of_rows(spark):
    rows = [(i % 40 or None, f"text {i % 70}" * 50) for i in range(400)] + [(3, None), (3, ""), (None, None)]
    bodies = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        table = spark.createDataFrame(rows, DOCS).coalesce(1)
        bodies.append(sorted((r.chunk, bytes(r.body)) for r in chunks.packed(table, chunk_bytes=10_000).collect()))
    assert bodies[0] == bodies[1] and len(bodies[0]) > 5


def test_repeated_strings_odd_rows(spark):
    text = "".join(map(str, range(100)))
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, text), (4, "short")]
    table = frame(spark, rows).withColumns({"chunk": F.lit(1), "kept": F.lit("x"), "id": F.lit(None)})
    found = sorted((r.doc_id or 99, r.n_bytes, r.n_removed) for r in suffixes.without_repeated_strings(table).collect())
    size = len(text)
    assert found == [(1, 0, 0), (2, 0, 0), (3, size, 0), (3, size, size), (4, 5, 0), (99, size, size)]
    assert suffixes.without_repeated_strings(table.limit(0)).count() == 0


def brute_spans(docs, span, words):
    seen, found = set(), {}
    for doc, text in sorted(docs):
        parts = spans.sentences(text.encode())
        assert b"".join(parts) == text.encode()
        keys, gone = [p.strip() for p in parts], set()
        for at in range(len(keys)):
            end = at + span
            while end <= len(keys) and sum(len(p.split()) for p in keys[at:end]) < words:
                end += 1
            if end > len(keys):
                continue
            key = tuple(keys[at:end])
            if key in seen:
                gone |= set(range(at, end))
            seen.add(key)
        found[doc] = (len(parts), len(gone), b"".join(p for i, p in enumerate(parts) if i not in gone).decode())
    return found


@pytest.mark.parametrize("span,words", [(3, 0), (2, 25), (1, 12)])
def test_repeated_spans(spark, span, words):
    docs = corpus(3)
    found = spans.without_repeated_spans(frame(spark, docs), span, words).collect()
    assert {r.doc_id: (r.n_sentences, r.n_removed, r.text) for r in found} == brute_spans(docs, span, words)
    assert sum(r.n_removed for r in found) > 50


def test_sentences():
    assert spans.sentences(b"A v1.2 is. B?! C\nD") == [b"A v1.2 is. ", b"B?! ", b"C\n", b"D"]
    assert spans.sentences(b"") == []


def test_repeated_spans_odd_rows(spark):
    text = "One is. Two is. Three is."
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, text)]
    table = frame(spark, rows).withColumn("bucket", F.lit("x"))
    found = sorted((r.doc_id or 99, r.n_sentences, r.n_removed, r.text) for r in spans.without_repeated_spans(table, 3, 6).collect())
    assert found == [(1, 0, 0, ""), (2, 0, 0, ""), (3, 3, 0, text), (3, 3, 3, ""), (99, 3, 3, "")]
    assert spans.without_repeated_spans(table.limit(0)).count() == 0


def brute_lines(docs, window):
    seen, found = set(), {}
    for doc, text in sorted(docs):
        parts = text.split("\n")
        filled = [i for i, line in enumerate(parts) if line.strip(" ")]
        gone = set()
        for at in range(len(filled) - window + 1):
            key = tuple(parts[i].strip(" ") for i in filled[at : at + window])
            if key in seen:
                gone |= set(filled[at : at + window])
            seen.add(key)
        found[doc] = (len(parts), len(gone), "\n".join(p for i, p in enumerate(parts) if i not in gone))
    return found


@pytest.mark.parametrize("window", [2, 3])
def test_repeated_lines(spark, window):
    docs = corpus(11)
    found = lines.without_repeated_lines(frame(spark, docs), window).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in found} == brute_lines(docs, window)
    assert sum(r.n_removed for r in found) > 50


def brute_lines_and_words(docs, window, words):
    seen, found = set(), {}
    for doc, text in sorted(docs):
        parts = text.split("\n")
        filled = [i for i, line in enumerate(parts) if line.strip(" ")]
        gone = set()
        for at in range(len(filled)):
            for size in range(1, min(window, len(filled) - at) + 1):
                key = tuple(parts[i].strip(" ") for i in filled[at : at + size])
                if size < window and sum(len(line.split()) for line in key) < words:
                    continue
                if key in seen:
                    gone |= set(filled[at : at + size])
                seen.add(key)
        found[doc] = (len(parts), len(gone), "\n".join(p for i, p in enumerate(parts) if i not in gone))
    return found


@pytest.mark.parametrize("window,words", [(3, 25), (3, 12), (4, 14), (2, 8)])
def test_repeated_lines_of_many_words(spark, window, words):
    docs = corpus(11)
    found = lines.without_repeated_lines(frame(spark, docs), window, words=words).collect()
    wanted = brute_lines_and_words(docs, window, words)
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in found} == wanted
    assert sum(n for _, n, _ in wanted.values()) >= sum(n for _, n, _ in brute_lines(docs, window).values())


def test_one_long_line(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"a\n{long}\nb"), (2, f"c\n {long}\nd"), (3, f"{long}\nshort\nc"), (4, f"{long}\nshort\ne"), (5, "short\nc")]
    result = lines.without_repeated_lines(frame(spark, rows), words=lines.WORDS)
    found = {r.doc_id: (r.text, r.n_removed) for r in result.collect()}
    assert found == {1: (rows[0][1], 0), 2: ("c\nd", 1), 3: ("short\nc", 1), 4: ("e", 2), 5: ("short\nc", 0)}
    staged = corpus_pipeline.drop_repeated_lines(spark, frame(spark, rows).withColumn("n_chars", F.lit(0).cast("long")), "")
    assert {r.doc_id: (r.text, r.n_chars) for r in staged.collect()} == {i: (text, len(text)) for i, (text, _) in found.items()}
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_lines_odd_rows(spark):
    text = "a\n b\n\nc"
    rows = [(1, None), (2, ""), (3, text), (3, text), (4, "x\na\nb\nc\ny"), (None, text)]
    extra = {"_starts": F.lit(5), "n_removed": F.lit("old"), "selected": F.lit(1), "_row": F.lit(2)}
    result = lines.without_repeated_lines(frame(spark, rows).withColumns(extra))
    found = sorted((r.doc_id or 99, r.text, r.n_lines, r.n_removed, r._starts, r.selected) for r in result.collect() if r.doc_id != 1)
    rest = [(3, text, 4, 0), (3, text, 4, 0), (4, "x\ny", 5, 3), (99, "", 4, 3)]
    assert found == [(2, "", 1, 0, 5, 1), *[(*r, 5, 1) for r in rest]]
    assert result.where("doc_id = 1").first().text is None
    assert lines.without_repeated_lines(frame(spark, rows).limit(0)).count() == 0
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ("", None, "one", "One two", "a b c d", "É b\x0bc D\x00 e " * 40):
        assert simhash.fingerprint(None if text is None else text.encode()) % 2**64 == brute_fingerprint(text)


@pytest.mark.parametrize("full", [64, 1])
def test_links_by_blocks(spark, monkeypatch, full):
    monkeypatch.setattr(simhash, "FULL", full)
    rng = random.Random(2)
    values = {rng.getrandbits(64) for _ in range(40)}
    for value in list(values)[:8]:
        for _ in range(12):
            value ^= 1 << rng.randrange(64)
            values.add(value)
            values.add(value ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash._links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"))
    found = {r.node: r.component for r in components.components(links, "a", "b").collect()}
    root = {v: v for v in signed}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in signed:
        for b in signed:
            if a != b and ((a ^ b) % 2**64).bit_count() <= 2:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    linked = {v for v in signed if any(v != w and ((v ^ w) % 2**64).bit_count() <= 2 for w in signed)}
    assert found == {v: top(v) for v in linked}


def test_near_groups_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(5, long), (4, long + " w"), (4, long + " w"), (7, None), (6, " "), (None, long), (9, "else what is it")]
    table = frame(spark, rows).withColumns({"fingerprint": F.lit("x"), "component_id": F.lit(0), "first": F.lit(1)})
    found = sorted((r.doc_id or 99, r.component_id) for r in simhash.near_groups(table).collect())
    assert found == [(4, 4), (4, 4), (5, 4), (6, 6), (7, 6), (9, 9), (99, 4)]
    assert simhash.near_groups(table.limit(0)).count() == 0
    kept = simhash.without_near_copies(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id or 99 for r in kept.collect()) == [4, 6, 9, 99]


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(300, 400)] + [(7, 7), (7, None), (None, 8)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(chain + star, "a long, b long"), "a", "b").collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(300, 400)]}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
