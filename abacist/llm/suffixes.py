"""Removal of long repeated byte strings (suffix-array dedup).

Every 100-byte window has one anchor: the smallest hash of its 32-byte strings.
Windows of one document that share an anchor form a segment of at most 168
bytes, and equal windows always have equal anchors, so anchors deal segments out
to shards. A chunk sends each of its different segments once, and only those whose
anchor stands more than once. Equal segments count once in a chunk and in a shard,
compared byte by byte: all windows of a later one are repeated. The suffix array
(induced sorting) of a shard's different segments and its common prefixes show
which of their windows are equal.
Two kinds of anchor are too common for one shard. If very many chunks have it, a
segment of the same 104 hashed bits as an earlier one is taken as equal and not
sent. If very many different segments have it, as at the edges of a very common
passage, they are dealt out further by a hash of the whole window; each such
window is then compared by 128 hashed bits, so that no shard gathers them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from abacist.llm import chunks as C
from abacist.llm.suffix_array import common_prefixes, suffix_array

LENGTH = 100
"""Bytes of a repeated string."""

ANCHOR = 32
"""Bytes of an anchor."""

HOT_SEGMENTS = 1 << 11
"""Different segments of one anchor beyond which its windows are dealt out one by one."""

HOT_COPIES = 1 << 14
"""Segments of one anchor, each once per chunk, beyond which equal ones are told by their digests."""

BLOCK_BYTES = 1 << 17
"""Bytes hashed at a time; keeps working arrays in the cache."""

ALONE, LATER, SHARED, HOT = range(4)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE_BITS = np.uint64(24)
_PLACE_MASK = np.uint64((1 << 24) - 1)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * _MIX
    mixed += right * _MIX2
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(29)
    return mixed


class Segments:
    """Segments of a chunk, in order of document and place."""

    def __init__(self, chunk: C.Chunk) -> None:
        parts = list(_blocks(chunk))
        columns = list(zip(*parts)) or [[np.zeros(0, np.int64)]] * 6
        joined = [np.concatenate(c) for c in columns]
        self.anchor, self.digest, self.row, self.start, self.windows, self.offset = joined
        clash = np.zeros(len(self.anchor), np.int64)
        while True:
            self.firsts, self.number = C.first_places(self.anchor, self.digest, clash)
            later = np.flatnonzero(self.firsts[self.number] != np.arange(len(self.number)))
            other = later[~self._equal(chunk.data, later, self.firsts[self.number[later]])]
            if not len(other):
                break
            clash[other] += 1  # equal digests of different bytes

    def _equal(self, data: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether pairs of segments have the same bytes."""
        equal = self.windows[left] == self.windows[right]
        compared = np.flatnonzero(equal)
        for at in range(0, len(compared), 1 << 13):
            part = compared[at : at + (1 << 13)]
            size = self.windows[left[part]] + LENGTH - 1
            same = data[ranges(self.start[left[part]], size)] == data[ranges(self.start[right[part]], size)]
            equal[part] = np.logical_and.reduceat(same, np.cumsum(size) - size)
        return equal


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of 32 and of 64 bytes from every place, as far as they fit."""
    held = data.astype(np.uint64)
    for size in (1, 2, 4):  # eight bytes as they are
        held = held[:-size] | (held[size:] << np.uint64(8 * size))
    for size in (8, 16, 32):
        held = _joined(held[:-size], held[size:])
        if size * 2 == ANCHOR:
            short = held
    return short, held


def _blocks(chunk: C.Chunk) -> Iterator[tuple[np.ndarray, ...]]:
    first = 0
    while first < len(chunk):
        last = max(first + 1, int(np.searchsorted(chunk.offsets, chunk.offsets[first] + BLOCK_BYTES, "right")) - 1)
        for start, end in _stretches(int(chunk.offsets[first]), int(chunk.offsets[last])):
            yield _segments(chunk, first, last, start, end)
        first = last


def _stretches(start: int, end: int) -> Iterator[tuple[int, int]]:
    """A long document in parts that overlap by a window less one byte."""
    while end - start > 64 * BLOCK_BYTES:
        yield start, start + 64 * BLOCK_BYTES
        start += 64 * BLOCK_BYTES - LENGTH + 1
    yield start, end


def _segments(chunk: C.Chunk, first: int, last: int, start: int, end: int) -> tuple[np.ndarray, ...]:
    data = chunk.data[start:end]
    if len(data) < LENGTH:
        return tuple(np.zeros(0, k) for k in (np.int64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    short, long = _hashes(data)
    keyed = (short & ~_PLACE_MASK) | np.arange(len(short), dtype=np.uint64)
    span, size = LENGTH - ANCHOR + 1, 1
    while size * 2 <= span:
        keyed = np.minimum(keyed[:-size], keyed[size:])
        size *= 2
    keyed = np.minimum(keyed[: len(keyed) - (span - size)], keyed[span - size :])
    offsets = chunk.offsets[first : last + 1] - start
    windows = np.zeros(len(keyed) + 1, bool)  # True where a window fits its document
    lows = np.clip(offsets[:-1], 0, len(keyed))
    highs = np.clip(np.maximum(offsets[1:] - LENGTH + 1, lows), 0, len(keyed))
    edge = np.zeros(len(keyed) + 1, np.int32)
    np.add.at(edge, lows, 1)
    np.add.at(edge, highs, -1)
    windows = np.cumsum(edge)[:-1] > 0
    starts_row = np.zeros(len(keyed) + 1, bool)
    starts_row[lows] = True
    new = windows.copy()
    new[1:] &= (keyed[1:] != keyed[:-1]) | ~windows[:-1] | starts_row[1:-1]
    begins = np.flatnonzero(new)
    marks = np.flatnonzero(new | ~windows)
    following = np.append(marks, len(keyed))[np.searchsorted(marks, begins, "right")]
    counts = following - begins
    ends = following - 1 + LENGTH
    middle = np.minimum(begins + 64, ends - 64)
    digest = _joined(_joined(long[begins], long[ends - 64]), _joined(long[middle], counts.astype(np.uint64)))
    rows = np.searchsorted(chunk.offsets, begins + start, "right") - 1
    anchors = (keyed[begins] >> _PLACE_BITS).astype(np.int64)
    offsets = (keyed[begins] & _PLACE_MASK).astype(np.int64) - begins  # of the anchor in its segment
    return anchors, digest, rows, begins + start, counts, offsets


def _asked(buckets: int):
    def ask(chunk: C.Chunk) -> Iterator[tuple[int, bytes]]:
        found = Segments(chunk)
        anchor, digest, rank = found.anchor[found.firsts], found.digest[found.firsts], chunk.ranks[found.row[found.firsts]]
        for bucket, places in C.by_bucket(anchor % buckets):
            low = anchor[places]
            yield bucket, C.pieces(
                (low & 0xFFFFFFFF).astype(np.uint32).tobytes(), (low >> 32).astype(np.uint8).tobytes(),
                digest[places].tobytes(), C.deltas(rank[places]),
            )

    return ask


def _judge(hot_segments: int, hot_copies: int):
    def judge(names: list[int], bodies: list[bytes], bucket: int) -> Iterator[tuple[int, int, bytes]]:
        columns = []
        for body in bodies:
            low, high, digest, rank = C.split_pieces(body)
            digest = np.frombuffer(digest, np.uint64)
            low = np.frombuffer(low, np.uint32).astype(np.int64) + (np.frombuffer(high, np.uint8).astype(np.int64) << 32)
            columns.append((low, digest, C.from_deltas(rank, len(digest))))
        anchor, digest, rank = (np.concatenate(c) for c in zip(*columns))
        order = np.lexsort((rank, digest, anchor))  # stable: of equal ranks the earlier chunk
        new_anchor = np.ones(len(order), bool)
        new_anchor[1:] = anchor[order][1:] != anchor[order][:-1]
        new = new_anchor.copy()
        new[1:] |= digest[order][1:] != digest[order][:-1]
        begins, group = np.flatnonzero(new_anchor), np.cumsum(new_anchor) - 1
        different = np.add.reduceat(new.astype(np.int64), begins)[group]
        copies = np.diff(np.append(begins, len(order)))[group]
        compared = (different <= hot_segments) & (copies <= hot_copies)
        code = np.select(
            [copies == 1, compared, ~new, different == 1, different <= hot_segments],
            [ALONE, SHARED, LATER, ALONE, SHARED],
            HOT,
        )
        codes = np.empty(len(order), np.uint8)
        codes[order] = code
        cuts = np.cumsum([len(c[1]) for c in columns])[:-1]
        for name, part in zip(names, np.split(codes, cuts)):
            yield name, bucket, pa.compress(part.tobytes(), "zstd", asbytes=True)

    return judge


SHARD, WINDOWS, DONE = range(3)
_SORTED = "kind int, key long, chunk long, body binary"


def _dealt(buckets: int):
    """What is known of a chunk's windows, and what its shards have to find out."""

    def use(name: int, chunk: C.Chunk, answers: dict[int, list[bytes]]) -> pa.Table:
        found = Segments(chunk)
        anchor = found.anchor[found.firsts]
        codes = np.zeros(len(anchor), np.uint8)
        for bucket, places in C.by_bucket(anchor % buckets):
            codes[places] = np.frombuffer(pa.decompress(answers[bucket][0], len(places), "zstd", asbytes=True), np.uint8)
        first = np.zeros(len(found.anchor), bool)
        first[found.firsts] = True
        repeated = ~first | (codes == LATER)[found.number]
        rows: list[tuple[int, int, int, bytes]] = [(DONE, name, name, _runs(found.start[repeated], found.windows[repeated]))]
        shared = found.firsts[codes == SHARED]
        for bucket, places in C.by_bucket(found.anchor[shared] % buckets):
            mine = shared[places]
            start, windows = found.start[mine], found.windows[mine]
            size = windows + LENGTH - 1
            text = chunk.data[ranges(start, size)]
            rows.append((SHARD, bucket, name, C.pieces(
                pa.compress(text.tobytes(), "zstd", asbytes=True), size.astype(np.int32).tobytes(),
                C.deltas(chunk.ranks[found.row[mine]]), C.deltas(start), found.offset[mine].astype(np.uint8).tobytes(),
            )))
        hot = found.firsts[codes == HOT]
        if len(hot):
            rows += _windows(name, chunk, ranges(found.start[hot], found.windows[hot]), np.repeat(found.row[hot], found.windows[hot]), buckets)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["kind", "key", "chunk", "body"])

    return use


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of all ranges, one range after the other."""
    if not len(starts):
        return np.zeros(0, np.int64)
    begins = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - begins, sizes)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> bytes:
    """Ranges of window starts, merged."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], (starts + sizes)[order]
    new = np.ones(len(starts), bool)
    reach = np.maximum.accumulate(ends) if len(ends) else ends
    new[1:] = starts[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1) if len(starts) else np.zeros(0, np.int64)
    return C.pieces(C.deltas(starts[new]), C.deltas(reach[last] - starts[new]), np.int64(new.sum()).tobytes())


def _from_runs(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    starts, sizes, count = C.split_pieces(body)
    count = int(np.frombuffer(count, np.int64)[0])
    return C.from_deltas(starts, count), C.from_deltas(sizes, count)


def _windows(name: int, chunk: C.Chunk, starts: np.ndarray, rows: np.ndarray, buckets: int) -> Iterable[tuple[int, int, int, bytes]]:
    high, low = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), 1 << 16):
        held = chunk.data[starts[at : at + (1 << 16), None] + np.arange(LENGTH)]
        digests = b"".join(hashlib.blake2b(window.tobytes(), digest_size=16).digest() for window in held)
        both = np.frombuffer(digests, np.uint64).reshape(-1, 2)
        high[at : at + len(both)], low[at : at + len(both)] = both[:, 0], both[:, 1]
    ranks = chunk.ranks[rows]
    for bucket, places in C.by_bucket((high % np.uint64(buckets)).astype(np.int64)):
        body = C.pieces(high[places].tobytes(), low[places].tobytes(), C.deltas(ranks[places]), C.deltas(starts[places]))
        yield WINDOWS, bucket, name, body


def _sorted_shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Repeated windows per chunk."""
    table = table.sort_by("chunk")
    names, bodies = table.column("chunk").to_pylist(), table.column("body").to_pylist()
    kind = key[0].as_py()
    if kind == DONE:
        found = list(zip(names, bodies))
    else:
        found = list((_by_suffixes if kind == SHARD else _by_digests)(names, bodies))
    return pa.Table.from_batches([C.rows([(name, kind, body) for name, body in found])])


def _repeated(names: list[int], group: np.ndarray, rank: np.ndarray, owner: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """All but the first window of each group."""
    order = np.lexsort((start, owner, rank, group))
    later = np.zeros(len(order), bool)
    later[1:] = group[order][1:] == group[order][:-1]
    later = order[later]
    for at, places in C.by_bucket(owner[later]):
        mine = np.sort(start[later[places]])
        yield names[at], _runs(mine, np.ones(len(mine), np.int64))


def _comparable(data: np.ndarray, begins: np.ndarray, size: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of each segment that another segment can have: first one, and how many.

    A window holds its anchor and at least 32 bytes right before or right after
    it, so these 64 bytes have to occur in two segments.
    """
    half = ANCHOR * 2
    twice = []
    for place, fits in ((offset - ANCHOR, offset >= ANCHOR), (offset, offset + half <= size)):
        held = np.zeros((len(size), half // 8), np.uint64)
        at = (begins + place)[fits]
        held[fits] = data[at[:, None] + np.arange(half)].view(np.uint64)
        digest = held[:, 0]
        for column in held.T[1:]:
            digest = _joined(digest, column)
        _, number, count = np.unique(digest[fits], return_inverse=True, return_counts=True)
        several = np.zeros(len(size), bool)
        several[fits] = count[number] > 1
        twice.append(several)
    before, after = twice
    first = np.where(before, 0, np.maximum(0, offset - ANCHOR + 1))
    last = np.where(after, size - LENGTH, np.minimum(size - LENGTH, offset + half - LENGTH - 1))
    return first, np.maximum(last - first + 1, 0)


def _equal_to_earlier(data: np.ndarray, begins: np.ndarray, size: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Segments with the bytes of one before them in order."""
    raw, seen, later = data.tobytes(), set(), []
    for at, begin, end in zip(order.tolist(), begins[order].tolist(), (begins + size)[order].tolist()):
        segment = raw[begin:end]
        if segment in seen:
            later.append(at)
        else:
            seen.add(segment)
    return np.array(later, np.int64)


def _by_suffixes(names: list[int], bodies: list[bytes]) -> Iterator[tuple[int, bytes]]:
    columns = []
    for at, body in enumerate(bodies):
        text, size, rank, start, offset = C.split_pieces(body)
        size = np.frombuffer(size, np.int32).astype(np.int64)
        data = np.frombuffer(pa.decompress(text, int(size.sum()), "zstd", asbytes=True), np.uint8)
        offset = np.frombuffer(offset, np.uint8).astype(np.int64)
        columns.append((data, size, C.from_deltas(rank, len(size)), C.from_deltas(start, len(size)), offset, np.full(len(size), at)))
    data, size, rank, start, offset, owner = (np.concatenate(c) for c in zip(*columns))
    begins = np.cumsum(size) - size
    later = _equal_to_earlier(data, begins, size, np.lexsort((start, owner, rank)))
    for at, places in C.by_bucket(owner[later]):
        mine = later[places]
        yield names[at], _runs(start[mine], size[mine] - LENGTH + 1)
    kept = np.ones(len(size), bool)
    kept[later] = False
    begins, size, rank, start, offset, owner = (x[kept] for x in (begins, size, rank, start, offset, owner))
    first, windows = _comparable(data, begins, size, offset)
    some = windows > 0
    begins, start, rank, owner = (begins + first)[some], (start + first)[some], rank[some], owner[some]
    size = windows[some] + LENGTH - 1
    if not len(size):
        return
    places = np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)  # a 1 ends each segment
    text = np.ones(len(places) + len(size) + 1, np.int16)
    text[places] = data[ranges(begins, size)].astype(np.int16) + 2
    text[-1] = 0
    order = suffix_array(text, 258)
    shared = common_prefixes(text, order, LENGTH)
    begins = np.cumsum(size + 1) - size - 1
    segment = np.searchsorted(begins, order, "right") - 1
    fits = order + LENGTH <= begins[segment] + size[segment]
    group = np.cumsum(shared[order] < LENGTH)
    order, segment, group = order[fits], segment[fits], group[fits]
    yield from _repeated(names, group, rank[segment], owner[segment], start[segment] + order - begins[segment])


def _by_digests(names: list[int], bodies: list[bytes]) -> Iterator[tuple[int, bytes]]:
    columns = []
    for at, body in enumerate(bodies):
        high, low, rank, start = C.split_pieces(body)
        high, low = np.frombuffer(high, np.uint64), np.frombuffer(low, np.uint64)
        columns.append((high, low, C.from_deltas(rank, len(high)), C.from_deltas(start, len(high)), np.full(len(high), at)))
    high, low, rank, start, owner = (np.concatenate(c) for c in zip(*columns))
    _, group = C.first_places(high, low)
    yield from _repeated(names, group, rank, owner, start)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _kept(name: int, chunk: C.Chunk, found: dict[int, list[bytes]]) -> pa.Table:
    edge = np.zeros(len(chunk.data) + 1, np.int32)
    for bodies in found.values():
        for body in bodies:
            starts, sizes = _from_runs(body)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + sizes + LENGTH - 1, -1)
    removed = np.cumsum(edge)[:-1] > 0
    kept, counts, spans = [], [], []
    for start, end in zip(chunk.offsets[:-1], chunk.offsets[1:]):
        gone = removed[start:end]
        kept.append(chunk.data[start:end][~gone].tobytes())
        counts.append(int(gone.sum()))
        spans.append(int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum()))
    lengths = pa.array(chunk.lengths, pa.int64())
    return pa.table(
        [chunk.ids, lengths, pa.array(counts, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
    )


def without_repeated_strings(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", hot_segments: int = HOT_SEGMENTS, hot_copies: int = HOT_COPIES
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary) of every row.

    A byte goes if a 100-byte string that covers it also starts earlier: in a
    document of smaller id, or further ahead in the same one. Null texts count as
    empty, null ids come last, and rows that share an id count as separate
    documents, by partition and then by text; of equal rows one stays. Texts below
    100 bytes stay whole. Other columns are ignored; an empty table gives none.
    ``kept`` may cut a character in two, as strings are judged by byte.
    """
    buckets = C.bucket_count(documents, text_column)
    chunks = C.packed(documents, id_column, text_column)
    answers = C.judged(C.asked(chunks, _asked(buckets)), _judge(hot_segments, hot_copies))
    dealt = C.answered(chunks, answers, _dealt(buckets), _SORTED)
    found = dealt.groupBy("kind", "key").applyInArrow(_sorted_shard, C.ANSWER_SCHEMA)
    return C.answered(chunks, found, _kept, RESULT)
