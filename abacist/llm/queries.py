"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.llm import bpe, chat, credentials, decontamination, embeddings, lines, periods, pseudonyms, simhash, spans, suffixes, toxicity, whitening

TOKENIZER_FILE = "word_bpe_49k.json"

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if check is not None:
            CHECKS[function.__name__] = check
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(TOKENIZER_FILE))


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


@query(
    r"""
    WITH texts AS (
      SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
    ), blocks AS (
      SELECT doc_id, a, substr(digits, 2 * a + 1, 2 * 299) AS part
      FROM (SELECT *, unnest(range(0, length(digits) // 2 - 99, 200)) AS a FROM texts)
    ), windows AS (
      SELECT doc_id, a + i AS s, md5_number(substr(part, 2 * i + 1, 200)) AS k
      FROM (SELECT *, unnest(range(length(part) // 2 - 99)) AS i FROM blocks)
    ), firsts AS (
      SELECT k, min(struct_pack(d := doc_id, s := s)) AS f FROM windows GROUP BY k HAVING count(*) > 1
    ), later AS (
      SELECT doc_id, s FROM windows JOIN firsts USING (k) WHERE struct_pack(d := doc_id, s := s) <> f
    ), marked AS (
      SELECT *, coalesce(s - lag(s) OVER w > 100, true)::INT AS new FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY s)
    ), numbered AS (
      SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM marked
    ), runs AS (
      SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM numbered GROUP BY doc_id, span
    ), gaps AS (
      SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs
    ), kept AS (
      SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
        string_agg(substr(digits, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
      FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
    )
    SELECT doc_id, length(digits) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
      coalesce(n_spans, 0) AS n_spans,
      sha256(unhex(coalesce(head, '') || substr(digits, 2 * coalesce(last, 0) + 1))) AS kept_sha256
    FROM texts LEFT JOIN kept USING (doc_id)
    """
)
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.without_repeated_strings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    r"""
    WITH cut AS (
      SELECT doc_id, list_filter(string_split(
        regexp_replace(coalesce(text, ''), '([.!?]+\s+|\n\s*)', '\1' || chr(1), 'g'), chr(1)), lambda p: p <> '') AS parts
      FROM documents
    ), placed AS (
      SELECT doc_id, i, parts[i] AS part, trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
      FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM cut)
    ), said AS (
      SELECT *, sum(len(regexp_extract_all(part, '[^ \t-\r]+'))) OVER (PARTITION BY doc_id ORDER BY i) AS total,
        len(regexp_extract_all(part, '[^ \t-\r]+')) AS own
      FROM placed
    ), starts AS (
      SELECT doc_id, i, CAST((total - own + 25) * 1048576 AS BIGINT) AS target FROM said
    ), ends AS (
      SELECT doc_id, i, CAST(total * 1048576 + i AS BIGINT) AS reached FROM said
    ), spans AS (
      SELECT s.doc_id, s.i AS a, greatest(e.i, s.i + 1) AS b
      FROM starts s ASOF JOIN ends e ON s.doc_id = e.doc_id AND s.target <= e.reached
    ), keyed AS (
      SELECT s.doc_id, a, b, string_agg(k, chr(1) ORDER BY p.i) AS key
      FROM spans s JOIN placed p ON p.doc_id = s.doc_id AND p.i BETWEEN a AND b
      JOIN cut ON cut.doc_id = s.doc_id AND b <= len(parts) GROUP BY s.doc_id, a, b
    ), ranked AS (
      SELECT doc_id, a, b, row_number() OVER (PARTITION BY key ORDER BY doc_id, a) AS n FROM keyed
    ), gone AS (
      SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM ranked WHERE n > 1
    ), kept AS (
      SELECT p.doc_id, count(*) AS n_sentences, count(g.i) AS n_removed,
        coalesce(string_agg(part, '' ORDER BY p.i) FILTER (WHERE g.i IS NULL), '') AS text
      FROM placed p LEFT JOIN gone g USING (doc_id, i) GROUP BY p.doc_id
    )
    SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_removed, 0) AS n_removed, coalesce(text, '') AS text
    FROM cut LEFT JOIN kept USING (doc_id)
    """
)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.without_repeated_spans(table(spark, sf_dir, "documents"))


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query()
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encoded_and_decoded(table(spark, sf_dir, "documents"), tokenizer_path())
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


CONVERSATION_WITH_MARKS = r"\### Assistant: </turn> ok"


@query(
    r"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
      UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ), told AS (
      SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS trained,
        sum(length(role) + length(text) + 14) + 7 AS plain_chars,
        sum(length(role) + length(text) + 14
          + (length(role || chr(0) || text) - length(replace(role || chr(0) || text, '\', '')))
          - (length(role || chr(0) || text) - length(replace(role || chr(0) || text, '###', ''))) // 3
          - 5 * ((length(role || chr(0) || text) - length(replace(role || chr(0) || text, '</turn>', ''))) // 7)) + 9 AS escaped_chars,
        bool_or(regexp_matches(text, '###|</turn>') OR regexp_matches(role, ': |###|</turn>')) AS escape
      FROM turns GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(trained) AS loss_chars,
      sha256(trained) AS loss_sha256, CAST(if(escape, escaped_chars, plain_chars) AS BIGINT) AS formatted_chars
    FROM told
    """
)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(CONVERSATION_WITH_MARKS).alias("text"))
    written = chat.formatted_conversations(turns.union(more.select(*[F.col(name).cast(kind) for name, kind in turns.dtypes])))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = written.select(
        "conv_id",
        chat.parsed(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("trained"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query(
    r"""
    WITH texts AS (
      SELECT true AS item, item_id AS id, text FROM benchmark UNION ALL SELECT false, doc_id, text FROM documents
    ), worded AS (
      SELECT item, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
      FROM texts
    ), item_windows AS (
      SELECT DISTINCT id AS item_id, least(len(w), 13) AS size, w[i : i + least(len(w), 13) - 1] AS k
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM worded WHERE item AND len(w) > 0)
    ), sizes AS (
      SELECT DISTINCT size FROM item_windows
    ), doc_windows AS (
      SELECT id AS doc_id, i, size, w[i : i + size - 1] AS k
      FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM worded, sizes WHERE NOT item)
    ), found AS (
      SELECT doc_id, i, d.size, item_id FROM doc_windows d JOIN item_windows USING (k)
    ), hit AS (
      SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id
    ), named AS (
      SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
      FROM found GROUP BY doc_id
    )
    SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
    FROM worded LEFT JOIN hit ON id = hit.doc_id LEFT JOIN named ON id = named.doc_id WHERE NOT item
    """
)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        "contaminated",
    )


@query(
    r"""
    WITH placed AS (
      SELECT doc_id, i, parts[i] AS line
      FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
    ), filled AS (
      SELECT doc_id, i, trim(line, ' ') AS k, len(regexp_extract_all(line, '[^ \t-\r]+')) AS said,
        row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j
      FROM placed WHERE trim(line, ' ') <> ''
    ), ahead AS (
      SELECT doc_id, j, k AS k1, lead(k, 1) OVER w AS k2, lead(k, 2) OVER w AS k3, said, said + lead(said, 1) OVER w AS said2
      FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY j)
    ), runs AS (
      SELECT doc_id, j, [k1] AS k FROM ahead WHERE said >= 25
      UNION ALL SELECT doc_id, j, [k1, k2] FROM ahead WHERE said2 >= 25
      UNION ALL SELECT doc_id, j, [k1, k2, k3] FROM ahead WHERE k3 IS NOT NULL
    ), ranked AS (
      SELECT doc_id, j, len(k) AS size, row_number() OVER (PARTITION BY k ORDER BY doc_id, j) AS n FROM runs
    ), gone AS (
      SELECT doc_id, i FROM filled JOIN (SELECT DISTINCT doc_id, j + unnest(range(size)) AS j FROM ranked WHERE n > 1) USING (doc_id, j)
    ), kept AS (
      SELECT p.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY p.i) FILTER (WHERE g.i IS NULL), '') AS text
      FROM placed p LEFT JOIN gone g USING (doc_id, i) GROUP BY p.doc_id
    )
    SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, kept.text
    FROM documents d LEFT JOIN kept USING (doc_id)
    """
)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.without_repeated_lines(table(spark, sf_dir, "documents"), words=lines.WORDS)
    return found.select("doc_id", "n_lines", "n_removed", "text")


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learned(documents, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    found = toxicity.scored(documents, model)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    offending = F.array_join(F.transform("offending", lambda s: s["sentence"].cast("string")), ",").alias("offending")
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted, offending)


@query()
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


PSEUDONYM_KEY = "example key, to be replaced"


@query()
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymised(documents, PSEUDONYM_KEY).select("doc_id", "n_found", "n_replaced", "text")


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def with_repeats(documents: DataFrame) -> DataFrame:
    """``doc_id, text``: every tenth document, by the checksum of its id, repeats a part of itself to its end."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    group = F.floor(checksum / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(w: Column, a: Column, p: Column) -> Column:
        places = F.sequence(F.lit(0).cast("long"), F.size(w) - 1)
        return F.array_join(F.transform(places, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    def placed(w: Column) -> Column:
        return lines.bound(group % F.size(w), lambda a: repeated(w, a, 1 + F.floor((F.size(w) - a) / (3 + group % 8))))

    chosen = (checksum % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return documents.select("doc_id", F.when(chosen, lines.bound(words, placed)).otherwise(F.col("text")).alias("text"))


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = periods.longest("runs")
    told = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.call_function("div", 1000 * best["length"], best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def _placed(number: int, kind: str, condition: str) -> str:
    """SQL: places of a pattern's matches, from the pieces that marks around them leave."""
    pattern = credentials.PATTERNS[kind].replace("'", "''")
    return rf"""
      SELECT doc_id, {number} AS k, '{kind}' AS kind, s, s + n AS e, scope FROM (
        SELECT doc_id, place, strpos(piece, chr(2)) - 1 AS n, substr(piece, 1, strpos(piece, chr(2)) - 1) AS m, '{pattern}' AS p,
          sum(length(piece) - 1) OVER (PARTITION BY doc_id ORDER BY place) - length(piece) + 2 AS s,
          len(string_split(substr(text, 1, CAST(s AS BIGINT)), chr(10) || chr(10))) - 1 AS scope
        FROM (SELECT doc_id, text, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS place
              FROM (SELECT *, string_split(regexp_replace(text, '{pattern}', chr(1) || '\0' || chr(2), 'g'), chr(1)) AS pieces FROM texts))
      ) WHERE place > 1 AND ({condition})"""


def _near(kinds: str) -> str:
    return f"""EXISTS (SELECT 1 FROM parts o WHERE o.doc_id = w.doc_id AND o.scope = w.scope AND o.kind IN ({kinds})
        AND o.s <= w.e + {credentials.REACH} AND w.s <= o.e + {credentials.REACH})"""


@query(
    rf"""
    WITH texts AS (
      SELECT doc_id, replace(replace(coalesce(text, ''), chr(1), chr(3)), chr(2), chr(3)) AS text FROM documents
    ), base AS MATERIALIZED (
      {_placed(0, "assign", "length(regexp_extract(m, p, 1)) >= 6")}
      UNION ALL {_placed(1, "access", "n >= 20")}
      UNION ALL {_placed(2, "hex", "n >= 24")}
    ), weak AS MATERIALIZED (
      SELECT * FROM (
        {_placed(3, "identifier", "length(regexp_extract(m, p, 1)) >= 3")}
        UNION ALL {_placed(4, "secret", "if(regexp_matches(m, '[:=]'), length(regexp_extract(m, p, 1)) >= 6, regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]'))")}
        UNION ALL {_placed(5, "endpoint", "length(regexp_extract(m, p, 1)) >= 4 OR regexp_matches(m, '^[Hh][Tt][Tt][Pp]')")}
      ) w WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.s < w.e AND w.s < b.e)
    ), parts AS MATERIALIZED (
      SELECT * FROM base UNION ALL SELECT * FROM weak
    ), linked AS (
      SELECT * FROM weak w
      WHERE (kind = 'secret' OR {_near("'assign', 'hex', 'secret'")}) AND (kind = 'identifier' OR {_near("'access', 'identifier'")})
    ), told AS (
      SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM (SELECT * FROM base UNION ALL SELECT * FROM linked) GROUP BY doc_id
    ), counted AS (
      SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
      FROM base GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
      sha256(coalesce(counted.spans, '')) AS base_sha256, coalesce(told.spans, '') AS spans
    FROM documents d LEFT JOIN counted USING (doc_id) LEFT JOIN told USING (doc_id)
    """
)
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        number = credentials.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(credentials.told("base"), 256).alias("base_sha256"),
        credentials.told("spans").alias("spans"),
    )
