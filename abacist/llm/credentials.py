"""Secrets in texts, and weak parts of credentials where complementary parts meet.

Some spans are reported wherever they stand. Others - a user name, a pass phrase,
an address - say little alone. They are parts of a credential if parts that
complement them lie near, in the same scope: blocks of text between empty lines.
Parts of all documents are dealt out by scope and tile of text, each to the tiles
that its neighbourhood reaches into, and every tile is swept in order of place:
the nearest part of the other kind before and after a part decides, so that no
pairs are listed, however many parts a text holds.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abacist.session import shared_folder

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
"""Reported anywhere are the first three; the others only where their complements are."""

REACH = 300
"""Code points between parts of one credential at most."""

TILE = 4096
"""Code points of a tile; more than twice the reach, so that most parts lie in one or two."""

IDENTIFIERS, SECRETS = (KINDS.index("access"), KINDS.index("identifier")), (KINDS.index("assign"), KINDS.index("hex"), KINDS.index("secret"))


def either_case(words: str) -> str:
    """A pattern for these words in capital or small letters of ASCII."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
VALUE = "[A-Za-z0-9+/_.=-]+"

# What the spans look like. Group 1 is a value that a name goes before.
PATTERNS = {
    "assign": f"(?:{either_case('password|passwd|secret|token|api_?key')}){GIVEN}({VALUE})",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
    "identifier": f"(?:{either_case('user_?name|user|login|client_?id|account_?id|account|key_?id')}){GIVEN}([A-Za-z0-9+/_.@-]+)",
    "secret": f"(?:{either_case('passphrase|passcode|pass|pwd|auth|bearer|private_?key|signature')}){GIVEN}({VALUE})|[A-Za-z0-9+/_-]{{32,}}",
    "endpoint": f"(?:{either_case('hostname|host|server|endpoint|url')}){GIVEN}([A-Za-z0-9._:/-]+)|{either_case('https?')}://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+",
}
LEAST_VALUE = {"assign": 6, "identifier": 3, "secret": 6, "endpoint": 4}
LEAST_LENGTH = {"access": 20, "hex": 24}

# A text without any of these has no span of the kind.
HINTS = {
    "assign": ("passw", "secret", "token", "api"),
    "access": ("akia",),
    "identifier": ("user", "login", "client", "account", "key"),
    "endpoint": ("host", "server", "endpoint", "url", "http"),
}

_COMPILED = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
_COMPILED["hex"] = re.compile(f"[0-9a-f]{{{LEAST_LENGTH['hex']},}}")  # the same runs, without a match for each short one

SPAN = "struct<start:bigint,kind:int,end:bigint>"
SCANNED = f"doc_id long, text_key long, base array<{SPAN}>, parts array<struct<start:bigint,kind:int,end:bigint,scope:bigint>>"


def _valid(kind: str, match: re.Match) -> bool:
    value = match[1] if match.re.groups else None
    if value is not None:
        return len(value) >= LEAST_VALUE[kind]
    if kind == "secret":
        return all(re.search(some, match[0]) for some in ("[a-z]", "[A-Z]", "[0-9]"))
    return len(match[0]) >= LEAST_LENGTH.get(kind, 0)


def spans_of(kind: str, text: str, lowered: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of the valid matches, leftmost and apart."""
    if kind in HINTS and not any(hint in lowered for hint in HINTS[kind]):
        return []
    number = KINDS.index(kind)
    return [(m.start(), number, m.end()) for m in _COMPILED[kind].finditer(text) if _valid(kind, m)]


def _apart(weak: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that overlap no base span."""
    merged: list[list[int]] = []
    for start, _, end in base:
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    begins = [begin for begin, _ in merged]
    found = []
    for start, kind, end in weak:
        at = bisect_right(begins, end - 1) - 1
        if at < 0 or merged[at][1] <= start:
            found.append((start, kind, end))
    return found


def scanned_text(text: str) -> tuple[list[tuple], list[tuple]]:
    """Base spans, and all parts with their scopes if weak ones and complements of them are there."""
    lowered = text.lower()
    base = sorted(span for kind in KINDS[:3] for span in spans_of(kind, text, lowered))
    weak = _apart(sorted(span for kind in KINDS[3:] for span in spans_of(kind, text, lowered)), base)
    parts = sorted(base + weak)
    kinds = {kind for _, kind, _ in parts}
    if not weak or not kinds.intersection(IDENTIFIERS) or not kinds.intersection(SECRETS):
        return base, []
    breaks = [m.end() for m in re.finditer("\n\n", text)]
    return base, [(start, kind, end, bisect_right(breaks, start)) for start, kind, end in parts]


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base_kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    part_kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("scope", pa.int64())]))
    for batch in batches:
        found = [scanned_text(text.as_py() or "") for text in batch.column(2)]
        base = pa.array([[dict(zip(("start", "kind", "end"), s)) for s in spans] for spans, _ in found], base_kind)
        parts = pa.array([[dict(zip(("start", "kind", "end", "scope"), s)) for s in spans] for _, spans in found], part_kind)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), base, parts], ["doc_id", "text_key", "base", "parts"])


def _linked(parts: DataFrame) -> DataFrame:
    """Weak parts that have complements near: rows of ``doc_id, text_key, start, kind, end``."""
    tiles = F.sequence(F.floor((F.col("start") - REACH) / TILE), F.floor((F.col("end") + REACH) / TILE))
    dealt = parts.select("*", F.explode(tiles).alias("tile"))
    order = W.partitionBy("doc_id", "text_key", "scope", "tile").orderBy("start", "kind", "end")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(1, W.unboundedFollowing)

    def near(kinds: tuple[int, ...]) -> Column:
        member = F.col("kind").isin(*kinds)
        reached = F.max(F.when(member, F.col("end"))).over(before) >= F.col("start") - REACH
        begun = F.min(F.when(member, F.col("start"))).over(after) <= F.col("end") + REACH
        return F.coalesce(reached, F.lit(False)) | F.coalesce(begun, F.lit(False))

    swept = dealt.select("*", near(IDENTIFIERS).alias("identified"), near(SECRETS).alias("opened"))
    weak = F.col("kind") >= 3
    identified = F.col("identified") | (F.col("kind") == KINDS.index("identifier"))
    opened = F.col("opened") | (F.col("kind") == KINDS.index("secret"))
    return swept.where(weak & identified & opened).select("doc_id", "text_key", "start", "kind", "end").distinct()


def secret_spans(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, base, spans`` of every row: spans reported anywhere, and those with the weak ones.

    A span has start, kind (a number of :data:`KINDS`) and end in code points, the
    end excluded; spans are in order of start, then kind, and those of one kind do
    not overlap. Weak parts that overlap a base span are part of it and not
    reported. Of the others, an identifier needs a secret near (an assigned one, a
    run of hex digits or a weak one), a secret an identifier (an access key or a
    weak one), and an endpoint both: in the same scope, with at most 300 code
    points between. A null or empty text has no spans. Rows that share an id, or
    have none, are judged each by its own text. Other columns are left behind; an
    empty table gives none.
    """
    id_, text = F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    path = shared_folder(documents.sparkSession, "credentials")
    documents.select(id_, F.xxhash64(text).alias("text_key"), text).mapInArrow(_scan, SCANNED).write.parquet(path)
    scanned = documents.sparkSession.read.schema(SCANNED).parquet(path)
    parts = scanned.where(F.size("parts") > 0).dropDuplicates(["doc_id", "text_key"])
    linked = _linked(parts.select("doc_id", "text_key", F.inline("parts")))
    linked = linked.groupBy(F.col("doc_id").alias("linked_id"), F.col("text_key").alias("linked_key")).agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("linked")
    )
    same = F.col("doc_id").eqNullSafe(F.col("linked_id")) & (F.col("text_key") == F.col("linked_key"))
    joined = scanned.select("doc_id", "text_key", "base").join(linked, same, "left")
    more = F.coalesce("linked", F.array().cast(f"array<{SPAN}>"))
    return joined.select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def kind_name(kind: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)


def told(spans: Column | str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    each = F.transform(spans, lambda s: F.concat_ws(":", kind_name(s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")
