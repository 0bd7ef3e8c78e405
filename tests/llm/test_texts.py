"""Chat formatting, contamination, pseudonyms, coding and toxicity."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from abacist.llm import bpe, chat, decontamination, pseudonyms, queries, toxicity

DOCS = "doc_id long, text string"
TURNS = "conv_id long, turn long, role string, text string"


def native(frame):
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    return "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


MARKS = [r"\### Assistant: </turn> ok", "</turn>", "</turn>\n### user: x", "\\", r"\t\h\b\c", "### ", "a: b", "é\U0001f600", "", "</turn></turn>\n"]


def test_chat_round_trip(spark):
    rng = random.Random(4)
    told, rows = defaultdict(list), []
    for conv in range(60):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "assistant", "a: b", "x\n### y", ""])
            text = "".join(rng.choices([*MARKS, "word ", "\n"], k=rng.randrange(0, 5)))
            told[conv].append((role, text))
            rows.append((conv, turn, role or None, text or None))
    rng.shuffle(rows)
    written = chat.formatted_conversations(spark.createDataFrame(rows, TURNS).withColumn("t", F.lit(1)))
    read = written.select("*", chat.parsed(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    assert native(read)
    found = {r.conv_id: r for r in read.collect()}
    for conv, turns in told.items():
        assert [(t.role, t.text) for t in found[conv].turns] == turns
        assert found[conv].loss == "".join(text for role, text in turns if role == "assistant")
        pieces = re.split("</turn>\n?", found[conv].formatted.split("\n", 1)[1])
        masked = "".join(pieces[s.turn][s.start : s.start + s.length] for s in found[conv].loss_spans)
        if found[conv].formatted.startswith(chat.PLAIN):
            assert masked == found[conv].loss and "###" not in masked
    kinds = {r.formatted.split("\n")[0] for r in found.values()}
    assert kinds == {"#plain", "#escaped"}


def test_chat_odd_rows(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (None, 1, "user", "x"), (None, None, None, None)]
    found = chat.formatted_conversations(spark.createDataFrame(rows, TURNS)).select("conv_id", chat.parsed(F.col("formatted")).alias("t"))
    turns = {r.conv_id: [(t.role, t.text) for t in r.t] for r in found.collect()}
    assert turns == {1: [("user", "a"), ("user", "a"), ("assistant", "b")], None: [("", ""), ("user", "x")]}
    assert chat.formatted_conversations(spark.createDataFrame([], TURNS)).count() == 0


def brute_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = brute_words(text)
        for at in range(max(1, len(words) - 12) if words else 0):
            windows[tuple(words[at : at + 13])].add(item)
    found = []
    for doc, text in docs:
        words, hit, named = brute_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(words) - size + 1):
                if (items_of := windows.get(tuple(words[at : at + size]))) is not None:
                    hit |= set(range(at, at + size))
                    named |= items_of
        found.append((doc, len(words), sorted(hit), sorted(named - {None}), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("block", [1 << 17, 40])
def test_contamination(spark, block):
    rng = random.Random(5)
    words = ["Ab", "cd", "é1", "fg", "hé", "x9", "ij", "kl", "mn", "op"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 4, 7, 13, 20, 30])))) for i in range(3, 20)]
    items += [(21, None), (22, ""), (23, "..."), (None, "zz yy"), (19, "qq rr"), (19, "qq rr")]
    docs = []
    for i in range(80):
        parts = [rng.choice([rng.choice(items)[1] or "", " ".join(rng.choices(words, k=rng.randrange(1, 60)))]) for _ in range(rng.randrange(1, 6))]
        docs.append((i, rng.choice([", ", " ", "\n"]).join(parts)))
    docs += [(1000, None), (1001, ""), (5, docs[5][1]), (None, "zz, YY")]
    table = spark.createDataFrame(docs, DOCS).repartition(3).withColumns({"item_id": F.lit(1), "hits": F.lit(2)})
    result = decontamination.contamination(table, spark.createDataFrame(items, "item_id long, text string"), block_windows=block)
    found = sorted(((r.doc_id, r.n_words, sorted(r.hits), sorted(r["items"]), r.contaminated) for r in result.collect()), key=repr)
    assert found == brute_contamination(docs, items)
    assert sum(r[4] for r in found) > 10


def test_windows_that_many_items_share(spark):
    shared = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    items = [(i, shared) for i in range(3000)] + [(5000, "ab cd"), (None, shared)]
    docs = [(1, shared + " x"), (1, shared + " x"), (2, "y " + shared.upper() + " ab, cd"), (3, "ab x cd"), (4, "")]
    table = spark.createDataFrame(docs, DOCS).repartition(3)
    result = decontamination.contamination(table, spark.createDataFrame(items, "item_id long, text string"), block_windows=1)
    found = sorted((r.doc_id, len(r.hits), r["items"] == sorted(r["items"]), len(r["items"])) for r in result.collect())
    assert found == [(1, 14, True, 3000), (1, 14, True, 3000), (2, 16, True, 3001), (3, 0, True, 0), (4, 0, True, 0)]


def test_contamination_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    assert [r.contaminated for r in decontamination.contamination(docs, items.limit(0)).collect()] == [False]
    assert decontamination.without_contaminated(docs, items).count() == 0


def test_pseudonyms(spark):
    texts = [
        "call +1 (784) 555-8120, 784-555-8120; again +1 (784) 555-8120.",
        "card 4111 1111 1111 1111 or 4111-1111-1111-1111 not 4111111111111112",
        "ip 12.197.240.125!! v1.2.3 300.1.1.1",
        "born 1980-02-29, 2/29/1980, 29.2.1980; not 1981-02-29",
        "ssn 123-45-6789 not 000-12-1234",
        "a.b99@mail7.example.com and A.b99@mail7.example.com",
        None, "", "nothing 123", "x" * 200_000,
    ]
    table = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumns({"_new": F.lit(1), "n_found": F.lit("old")})
    result = pseudonyms.pseudonymised(table, "key")
    assert native(result)
    rows = {r.doc_id: r for r in result.collect()}
    assert [rows[i].n_replaced for i in range(10)] == [3, 2, 1, 3, 1, 2, 0, 0, 0, 0]
    assert [rows[i].n_found for i in (1, 2, 3, 4)] == [3, 2, 4, 2]
    assert all(rows[i].text == texts[i] for i in (6, 7, 8, 9)) and rows[0]._new == 1
    phones = re.findall(r"\(?([2-9]\d\d)\)?[ -]([2-9]\d\d)-(\d{4})", rows[0].text)
    assert len(phones) == 3 and len(set(phones)) == 1 and phones[0] != ("784", "555", "8120")
    cards = re.findall(r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}", rows[1].text)
    digits = {re.sub(r"\D", "", c) for c in cards}
    assert len(digits) == 1 and digits != {"4111111111111111"}
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits.pop()))]
    assert sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    assert re.fullmatch(r"ip (\d+\.){3}\d+!! v1\.2\.3 300\.1\.1\.1", rows[2].text)
    first, us, german = re.match(r"born (\S+), (\S+), (\S+);", rows[3].text).groups()
    day = date.fromisoformat(first)
    assert us == f"{day.month}/{day.day:02d}/{day.year}" and german == f"{day.day:02d}.{day.month}.{day.year}"
    assert re.fullmatch(r"[a-z]\.[a-z]\d\d@mail7.example.com and [A-Z]\.[a-z]\d\d@mail7.example.com", rows[5].text)
    assert pseudonyms.pseudonymised(table.limit(0), "key").count() == 0


LONG = {
    "mail labels": "x@" + "a." * 500_000 + "b",
    "mail names": "a.b" * 330_000 + "@c.de",
    "dotted numbers": "1." * 500_000,
    "addresses": "10.0.0.1 " * 100_000,
    "dates": "2020-02-02-" * 90_000,
    "digits": "4" * 1_000_000,
    "cards": "4111 1111 1111 1111 " * 4_000,
    "single digits": "4 " * 30_000,
    "phones": "+1 (784) 555-8120" * 50_000,
}


@pytest.mark.parametrize("kind", LONG)
def test_pseudonyms_of_long_texts(spark, kind):
    table = spark.createDataFrame([(1, LONG[kind] + " a.b99@mail7.example.com")], DOCS)
    (row,) = pseudonyms.pseudonymised(table, "key").collect()
    assert kind == "addresses" or len(row.text) == len(LONG[kind]) + 24
    assert row.n_replaced > 0 and not row.text.endswith("a.b99@mail7.example.com")
    if kind == "cards":
        assert row.n_replaced > 4000 * 0.9 and "4111 1111 1111 1111" not in row.text
    if kind in ("addresses", "phones"):
        assert row.n_found > 40_000


def draw(kind, number, value):
    return int(hashlib.sha256(f"key|{kind}|{number}|{value}".encode()).hexdigest()[:15], 16)


def feistel(kind, left, right, sizes):
    for n in range(8):
        if n % 2 == 0:
            left = (left + draw(kind, n, right)) % sizes[0]
        else:
            right = (right + draw(kind, n, left)) % sizes[1]
    return left, right


def feistel_text(kind, text):
    def turned(part, other, n):
        digest = hashlib.sha256(f"key|{kind}|{n}|{other}".encode()).hexdigest()
        new = ""
        for i, c in enumerate(part):
            by = int(digest[i % 32 * 2 : i % 32 * 2 + 2], 16)
            for first, size in (("a", 26), ("A", 26), ("0", 10)):
                if ord(first) <= ord(c) < ord(first) + size:
                    c = chr((ord(c) - ord(first) + by) % size + ord(first))
                    break
            new += c
        return new

    left, right = text[: len(text) // 2], text[len(text) // 2 :]
    for n in range(8):
        if n % 2 == 0:
            left = turned(left, right, n)
        else:
            right = turned(right, left, n)
    return left + right


def plain_pseudonym(kind, text):
    if kind == "email":
        local, at, rest = text.partition("@")
        return feistel_text(kind, local) + at + rest
    if kind == "address":
        a, b, c, d = map(int, text.split("."))
        left, right = feistel(kind, a * 256 + b, c * 256 + d, (65536, 65536))
        return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"
    if kind == "card":
        new = feistel_text(kind, text[:-1])
        worths = [int(c) * (2 if i % 2 == 0 else 1) for i, c in enumerate(reversed(new))]
        return new + str(-sum(w - 9 if w > 9 else w for w in worths) % 10)
    if kind == "date":
        number = (date.fromisoformat(text) - date(1600, 1, 1)).days
        left, right = feistel(kind, number // 773, number % 773, (378, 773))
        return (date(1600, 1, 1) + timedelta(days=left * 773 + right)).isoformat()
    if kind == "social":
        area, group, serial = map(int, text.split("-"))
        left, right = feistel(kind, area - (2 if area > 666 else 1), (group - 1) * 9999 + serial - 1, (898, 99 * 9999))
        return f"{left + (2 if left >= 665 else 1):03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d}"
    area, exchange, line = map(int, text.split("-"))
    value = ((area - 200) * 800 + exchange - 200) * 10000 + line
    left, right = feistel("phone", value // 80000, value % 80000, (80000, 80000))
    new = left * 80000 + right
    return f"{new // 8000000 + 200:03d}-{new % 8000000 // 10000 + 200:03d}-{new % 10000:04d}"


def test_pseudonyms_by_plain_python(spark):
    rng = random.Random(12)

    def value(kind):
        pick = rng.randrange
        return {
            "email": lambda: "".join(rng.choices("abcXYZ019._-", k=pick(1, 20))) + "@mail.example.com",
            "address": lambda: ".".join(str(pick(256)) for _ in range(4)),
            "card": lambda: (lambda p: p + str(-sum(w - 9 if w > 9 else w for w in (int(c) * (2 if i % 2 == 0 else 1) for i, c in enumerate(reversed(p)))) % 10))("".join(rng.choices("0123456789", k=pick(12, 19)))),
            "date": lambda: (date(1600, 1, 1) + timedelta(days=pick(292194))).isoformat(),
            "social": lambda: f"{rng.choice([1, 665, 667, 899, 123]):03d}-{pick(1, 100):02d}-{pick(1, 10000):04d}",
            "phone": lambda: f"{pick(200, 1000)}-{pick(200, 1000)}-{pick(10000):04d}",
        }[kind]()

    values = [(kind, value(kind)) for kind in ("email", "address", "card", "date", "social", "phone") for _ in range(40)]
    table = spark.createDataFrame([(i, f"see {v} !") for i, (_, v) in enumerate(values)], DOCS)
    found = {r.doc_id: r.text for r in pseudonyms.pseudonymised(table, "key").collect()}
    for i, (kind, v) in enumerate(values):
        assert found[i] == f"see {plain_pseudonym(kind, v)} !", (kind, v)


def test_pseudonyms_of_any_area_code(spark):
    numbers = ["0175557713", "1325551352", "7840555812", "0000000000", "1999999999", "9991999999", "2000000000", "7845558120", "9999999999"]
    texts = [f"+1 ({n[:3]}) {n[3:6]}-{n[6:]}, ({n[:3]}) {n[3:6]}-{n[6:]} or +1 {n[:3]}-{n[3:6]}-{n[6:]}." for n in numbers]
    texts += ["017-555-7713 and 1 132 555 1352 are not marked", "784-555-8120 and +1 784.555.8120"]
    found = {r.doc_id: r for r in pseudonyms.pseudonymised(spark.createDataFrame(list(enumerate(texts)), DOCS), "key").collect()}
    new = {}
    for i, number in enumerate(numbers):
        told = re.fullmatch(r"\+1 \((\d{3})\) (\d{3})-(\d{4}), \((\d{3})\) (\d{3})-(\d{4}) or \+1 (\d{3})-(\d{3})-(\d{4})\.", found[i].text).groups()
        assert (found[i].n_found, found[i].n_replaced) == (3, 3) and told[:3] == told[3:6] == told[6:]
        new[number] = "".join(told[:3])
        assert new[number] != number
        assert (min(new[number][0], new[number][3]) >= "2") == (min(number[0], number[3]) >= "2")
    assert len(set(new.values())) == len(numbers)
    assert found[len(numbers)].n_found == 0
    plain = new["7845558120"]
    assert found[len(numbers) + 1].text == f"{plain[:3]}-{plain[3:6]}-{plain[6:]} and +1 {plain[:3]}.{plain[3:6]}.{plain[6:]}"


def test_cards_beside_other_numbers(spark):
    card, other = "4111 1111 1111 1111", "5500-0000-0000-0004"
    texts = [
        f"{card} 123", "4111111111111111 12/27", "pay 2 4111111111111111", f"1234567 {card} 123 456", f"{card} {other}",
        f"{card} 784-555-8120", "5 2024-01-02 2024-01-03 2024-01-04", "4111 1111 1111 1112 x", card, "1 " * 3_000 + card, None,
    ]
    result = pseudonyms.pseudonymised(spark.createDataFrame(list(enumerate(texts)), DOCS), "key")
    assert native(result)
    found = {r.doc_id: r for r in result.collect()}
    new = found[8].text
    assert re.fullmatch(r"(\d{4} ){3}\d{4}", new) and new != card
    joined = new.replace(" ", "")
    assert [found[i].text for i in range(3)] == [f"{new} 123", f"{joined} 12/27", f"pay 2 {joined}"]
    assert found[3].text == f"1234567 {new} 123 456"
    assert found[4].text.startswith(f"{new} ") and other not in found[4].text and found[4].n_replaced == 2
    assert found[5].text.startswith(f"{new} ") and "784-555-8120" not in found[5].text and found[5].n_replaced == 2
    assert found[6].text.startswith("5 ") and "2024" not in found[6].text and found[6].n_replaced == 3
    assert (found[7].text, found[7].n_found, found[7].n_replaced) == (texts[7], 1, 0)
    assert card not in found[9].text and len(found[9].text) == len(texts[9])
    assert found[10].text is None and [found[i].n_found for i in (0, 1, 2, 3, 8, 10)] == [1, 1, 1, 1, 1, 0]


def test_permutations_are_one_to_one(spark):
    pairs = spark.range(12 * 7).select((F.col("id") / 7).cast("long").alias("l"), (F.col("id") % 7).alias("r"))
    found = pairs.select(pseudonyms.permuted("k", "t", F.col("l"), F.col("r"), (12, 7)).alias("p")).collect()
    assert {(r.p.left, r.p.right) for r in found} == {(i, j) for i in range(12) for j in range(7)}
    texts = [(f"{a}{b}-{c}",) for a in "abcxyz" for b in "0189" for c in "AMZ"]
    every = spark.createDataFrame(texts, "t string").select(pseudonyms.permuted_text("k", "t", F.col("t")).alias("p")).collect()
    assert len({r.p for r in every}) == len(texts)
    assert all(re.fullmatch("[a-z][0-9]-[A-Z]", r.p) for r in every)


def test_coding(spark):
    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    rng = random.Random(6)
    parts = ["Hello", "wörld's", "İ", "<|endoftext|>", "́b", "é", " ", "123", "!!!", "日本語", "\x85", " x", "it'll", "\x00"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "\n", "\t "]) for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    rows = [*enumerate(texts), (5, texts[5]), (None, "a b"), (70, None), (71, "y" * 5000)]
    table = spark.createDataFrame(rows, DOCS).repartition(3).withColumn("ids", F.lit("x"))
    result = bpe.encoded_and_decoded(table, path).collect()
    found = sorted(((r.doc_id, list(r["ids"]), r.text) for r in result), key=repr)
    wanted = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        wanted.append((doc, ids, tokenizer.decode(ids, skip_special_tokens=False)))
    assert found == sorted(wanted, key=repr)
    apart = bpe.decoded(bpe.encoded(table, path), path).collect()
    assert sorted(((r.doc_id, list(r["ids"]), r.text) for r in apart), key=repr) == found
    assert bpe.encoded(table.limit(0), path).count() == 0
    null = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decoded(null, path).orderBy("doc_id").collect()] == [None, ""]


def labelled(seed, count):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    bad = ["rotten", "rottenly", "vile"]
    rows = []
    for i in range(count):
        sentences = [rng.choices(words, k=rng.randrange(4, 12)) for _ in range(rng.randrange(1, 12))]
        toxic = rng.random() < 0.2
        if toxic:
            rng.choice(sentences).insert(0, rng.choice(bad))
        rows.append((i, ". ".join(" ".join(s) for s in sentences) + ".", int(toxic)))
    return rows


def test_toxicity_learns_from_documents_and_locates_sentences(spark):
    rows = labelled(1, 1500)
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS).repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.learned(docs, labels)
    scores = toxicity.scored(docs, model)
    found = {r.doc_id: r for r in scores.select("*", toxicity.held_out().alias("held_out")).collect()}
    unseen = [r for r in rows if found[r[0]].held_out]
    assert 200 < len(unseen) < 400
    assert sum((found[i].score >= 0.5) == bool(y) for i, _, y in unseen) >= 0.97 * len(unseen)
    for doc, text, toxic in unseen:
        for place in found[doc].offending:
            assert toxic and re.search("rotten|vile", text.split(".")[place.sentence])
    kept = toxicity.without_toxic(docs.withColumn("score", F.lit(1)), labels)
    assert kept.columns == ["doc_id", "text", "score"]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.score < 0.5}


def plain_parts(text):
    """Per sentence, the numbers of all its words and of their beginnings."""
    found = []
    for sentence in re.split(r"[.!?\n]", text.lower()):
        parts = []
        for word in re.findall(r"[0-9a-z]+", sentence):
            parts += [f"|{word}", *(f"{n}|{word[:n]}" for n in (3, 4, 5, 6, 7) if len(word) > n)]
        if parts:
            found.append([zlib.crc32(part.encode()) % (1 << 20) for part in parts])
    return found


def plain_score(sentence, weights, bias):
    return 1 / (1 + math.exp(-sum(weights.get(f, 0.0) for f in sentence) - bias))


def plain_fit(documents):
    """Noisy-or over sentences, fitted to document labels one document and sentence at a time."""
    documents = [(plain_parts(text), label) for text, label in documents]
    held_by = defaultdict(int)
    for parts, _ in documents:
        for feature in {f for sentence in parts for f in sentence}:
            held_by[feature] += 1
    weights = {f: 0.0 for f, n in held_by.items() if n >= toxicity.RARE}
    moved, bias, bias_moved = dict.fromkeys(weights, 1e-8), toxicity.PRIOR, 1e-8
    for _ in range(toxicity.ROUNDS):
        slopes, total = dict.fromkeys(weights, 0.0), 0.0
        for parts, label in documents:
            scores = [plain_score(sentence, weights, bias) for sentence in parts]
            harmless = math.prod(1 - p for p in scores)
            for sentence, p in zip(parts, scores):
                slope = p * (-harmless / (1 - harmless) if label else 1.0) / len(documents)
                total += slope
                for f in sentence:
                    if f in slopes:
                        slopes[f] += slope
        for f, slope in slopes.items():
            moved[f] += slope**2
            rate = toxicity.RATE / math.sqrt(moved[f])
            weight = weights[f] - rate * slope
            weights[f] = math.copysign(max(abs(weight) - rate * toxicity.SPARSITY, 0.0), weight)
        bias_moved += total**2
        bias -= toxicity.RATE * total / math.sqrt(bias_moved)
    return weights, bias


def test_toxicity_against_plain_python(spark):
    rows = labelled(5, 260)
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS).repartition(3)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    weights, bias = plain_fit([(text, y) for i, text, y in rows if zlib.crc32(str(i).encode()) % 5])
    model = toxicity.learned(docs, labels)
    assert model.bias == pytest.approx(bias, abs=1e-4)
    for row in toxicity.scored(docs, model).collect():
        scores = [plain_score(sentence, weights, bias) for sentence in plain_parts(rows[row.doc_id][1])]
        assert row.score == pytest.approx(1 - math.prod(1 - p for p in scores), abs=1e-4)
        assert [o.sentence for o in row.offending] == [i for i, p in enumerate(scores) if p >= 0.5]
        assert [o.score for o in row.offending] == pytest.approx([p for p in scores if p >= 0.5], abs=1e-4)


def test_toxicity_odd_rows(spark):
    model = toxicity.fitted([(b"", 1), (b"x", 0)])
    table = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a. b!"), (3, "...")], DOCS).withColumn("score", F.lit("x"))
    found = sorted((r.doc_id or 99, r.score < 0.01, r.offending) for r in toxicity.scored(table, model).collect())
    assert found == [(1, True, []), (2, True, []), (2, True, []), (3, True, []), (99, True, [])]
    empty = table.limit(0)
    assert toxicity.scored(empty, model).count() == 0
    assert toxicity.training_sample(empty, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0
    assert toxicity.without_toxic(table, spark.createDataFrame([], "doc_id long, toxic int")).count() == 5


def test_pipeline_stages(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    kept, names = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, kept, sf_dir)
        assert result.columns == names
        kept = spark.createDataFrame(result.collect(), docs.schema)
    ids = {r.doc_id for r in kept.collect()}
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(found) == ids and 0 < len(ids) < docs.count()
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    for row in kept.limit(30).collect():
        assert found[row.doc_id]["ids"] == tokenizer.encode(row.text, add_special_tokens=False).ids
        assert found[row.doc_id].n_tokens == len(found[row.doc_id]["ids"])


def test_pipeline_of_odd_documents(spark, sf_dir):
    schema = queries.table(spark, sf_dir, "documents").schema
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "ü" * 30_000, None, None, 1)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        count = docs.count()
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
        assert docs.count() == min(count, 3)
