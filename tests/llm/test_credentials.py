"""Secret spans against plain searches, the query also against its SQL."""

import random
import re

import pytest
from pyspark.sql import functions as F

import check
from abacist.llm import credentials, queries

DOCS = "doc_id long, text string"

BASE = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}
LEAST = {"access": 20, "hex": 24}


def brute(text):
    """Base spans by the plain patterns, and weak ones by comparing all pairs."""
    base = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text):
            if len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= LEAST[kind]:
                base.append((m.start(), credentials.KINDS.index(kind), m.end()))
    weak = []
    for kind in credentials.KINDS[3:]:
        for m in re.finditer(credentials.PATTERNS[kind], text):
            if m[1] is not None:
                ok = len(m[1]) >= credentials.LEAST_VALUE[kind]
            else:
                ok = kind == "endpoint" or all(re.search(c, m[0]) for c in ("[a-z]", "[A-Z]", "[0-9]"))
            if ok and not any(b < m.end() and m.start() < e for b, _, e in base):
                weak.append((m.start(), credentials.KINDS.index(kind), m.end()))
    scope = lambda s: text[: s[0]].count("\n\n")

    def near(s, kinds):
        others = [o for o in base + weak if credentials.KINDS[o[1]] in kinds and scope(o) == scope(s)]
        return any(o[0] <= s[2] + 300 and s[0] <= o[2] + 300 for o in others)

    linked = []
    for s in weak:
        kind = credentials.KINDS[s[1]]
        secret = kind == "secret" or near(s, ("assign", "hex", "secret"))
        if secret and (kind == "identifier" or near(s, ("access", "identifier"))):
            linked.append(s)
    return sorted(base), sorted(base + linked)


PARTS = [
    "token = \"abc123def\"", "Password: x", "api_key='k/9+zz=='", "API-KEY=abcdefgh", "secret=token: abcdefghi", "toKen=1234567", "ſecret=abcdefgh", "AKIA" + "B" * 12, "AKIA" + "Z9" * 9,
    "0" * 24, "f00d" * 7, "0123456789abcdef0123456", "user: jo", "username = \"anna\"", "LOGIN=bob", "client_id: 77-x", "pass: hunter22", "pwd=abc", "bearer: a.b.c.d",
    "A1b2" * 8, "a1b2" * 8, "https://x.example/y?z=1", "host=db.example", "url: 'http://a.b'", "\n\n", "\n", "\n\n\n", "é😀", "lorem ipsum " * 20, "lorem " * 70, "x" * 500, " ", " ", " ", ",",
]


def test_secret_spans(spark):
    rng = random.Random(8)
    told = {i: " ".join(rng.choices(PARTS, k=rng.randrange(0, 30))) for i in range(500)}
    told |= {1000 + i: "".join(rng.choices(PARTS, k=rng.randrange(200, 600))) for i in range(10)}  # over many tiles
    found = credentials.secret_spans(spark.createDataFrame(list(told.items()), DOCS).withColumn("base", F.lit(1)))
    weak = 0
    for row in found.collect():
        base, spans = brute(told.pop(row.doc_id))
        assert [tuple(s) for s in row.base] == base
        assert [tuple(s) for s in row.spans] == spans
        weak += len(spans) - len(base)
    assert not told and weak > 500


def test_odd_texts(spark):
    both = "user: anna pass: hunter22"
    rows = [(1, None), (2, ""), (None, both), (3, both), (3, both), (3, "pass: hunter22"), (4, "user: anna" + " " * 301 + "pass: hunter22"), (5, "user: anna" + " " * 300 + "pass: hunter22")]
    rows += [(6, "user: anna\n\npass: hunter22"), (7, "https://a.b user: anna"), (8, "https://a.b user: anna token=abcdef"), (9, "pass: " + "q" * 200000 + " user: anna")]
    found = credentials.secret_spans(spark.createDataFrame(rows, DOCS)).select("doc_id", credentials.told("spans").alias("s"))
    found = sorted((r.doc_id or 0, r.s) for r in found.collect())
    two = "identifier:0:10,secret:11:25"
    assert found == [
        (0, two), (1, ""), (2, ""), (3, ""), (3, two), (3, two), (4, ""), (5, "identifier:0:10,secret:310:324"), (6, ""), (7, ""),
        (8, "endpoint:0:11,identifier:12:22,assign:23:35"), (9, "secret:0:200006,identifier:200007:200017"),
    ]
    assert credentials.secret_spans(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("made", [False, True])
def test_query_equals_sql(spark, sf_dir, tmp_path, made):
    folder = sf_dir
    if made:
        rng = random.Random(9)
        rows = [(i, " ".join(rng.choices(PARTS, k=rng.randrange(0, 30)))) for i in range(300)] + [(999, None)]
        spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
        import duckdb

        duck = duckdb.connect()
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        folder = str(tmp_path)
    else:
        duck = check.connect(sf_dir)
    result, wanted = queries.op12_secret_scan(spark, folder), duck.sql(queries.CHECKS["op12_secret_scan"])
    assert check.compare(result.toPandas(), wanted.df()) is None
    assert check.compare_types(result, wanted) is None
