"""Where documents share windows: what substring dedup and suffix-array dedup stand on.

A window is ``length`` symbols in a row (bytes, or words) of one document; it is *earlier* elsewhere if
the same window also starts in a document with a smaller doc_id.  Windows with equal content must meet
in one task without pairing documents.  So each window is dealt by its *minimizer*: the least hash of
the ``gram``-symbol strings inside it, which depends on nothing but its content.  Neighbouring windows
share a minimizer; a maximal stretch of them is a *phrase*, cut at ``length`` windows.

1. ``_phrases``: every task cuts its documents into phrases and merges equal ones, told by their bytes (of a
   phrase that several documents of the task hold, those with larger ids have it earlier elsewhere, and only the
   least document's is sent).  Tables of packed numbers, one row per bucket, are shuffled.
2. ``_meet``: a bucket sorts its phrases by minimizer.  With ``merge``, equal phrases are merged again and only
   distinct phrases under one minimizer go on; without, all whose minimizer several documents have.
3. ``_texts`` fetches the bytes of phrases that go on, dealt by minimizer again, and a matcher
   (suffix array or automata) says which of their windows are earlier elsewhere.
4. ``resolved``: a document gets all its spans, of both kinds, and a function makes its result.

In steps 3 and 4 a group of documents streams past its packed numbers; no task holds its texts together.
With ``merge``, step 2 tells equal phrases by 144 bits (48 of the minimizer, 96 of the content) and not by their
bytes, which are not there; everything else compares bytes or words.
Rows are identified by (doc_id, crc32 of the text), so rows that repeat a doc_id keep their own spans;
they never remove each other.  Rows without doc_id neither lose nor take anything.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, frugal, materialized, shuffle_partitions
from .tokens import SPACE, byte_table, powers, prefix_hashes, ragged, span_hashes

#: Phrases that a task gathers before it sends them.
GATHERED = 500_000
#: Bytes of phrases that a task gathers before it deals them to the matchers.
DEALT_BYTES = 16_000_000
GOLD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Kind:
    unit: str  # "bytes" or "words"
    length: int
    gram: int
    merge: bool


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of the words in joined texts that end at ``ends``, and words per text."""
    visible = ~SPACE[data]
    first, last = visible.copy(), visible.copy()
    first[1:] &= ~visible[:-1]
    last[:-1] &= ~visible[1:]
    edge = ends[(ends > 0) & (ends < len(data))]
    first[edge] = visible[edge]
    last[edge - 1] = visible[edge - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, stops, np.diff(np.searchsorted(starts, ends), prepend=0)


@dataclass
class Symbols:
    """The symbols of joined texts: values of 64 bits, how many each text has, and their bytes.

    Symbol i has the bytes from ``edges[i]`` to ``edges[i + 1]`` of ``body``, for words with one blank after each.
    """

    values: np.ndarray
    counts: np.ndarray
    body: np.ndarray
    edges: np.ndarray


def symbols(raw: list[bytes], unit: str) -> Symbols:
    if unit == "bytes":
        data = np.frombuffer(b"".join(raw), np.uint8)
        return Symbols(byte_table()[data], np.array([len(x) for x in raw], np.int64), data, np.arange(len(data) + 1))
    data = np.frombuffer(b"".join([x + b" " for x in raw]), np.uint8)
    starts, stops, counts = words_of(data, np.cumsum([len(x) + 1 for x in raw]))
    values = span_hashes(prefix_hashes(data), starts, stops)
    keep = ~SPACE[data]
    keep[stops] = True  # a blank stands there
    body = data[keep]
    body[SPACE[body]] = 32
    return Symbols(values, counts, body, np.concatenate([[0], np.cumsum(stops - starts + 1)]))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` elements in a row."""
    span, out = 1, x
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def _span_values(values: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Polynomials of the values in each span, the same wherever the span stands."""
    up, down = powers(len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=prefix[1:])
    return (prefix[stop] - prefix[first]) * down[first]


def phrases(values: np.ndarray, counts: np.ndarray, kind: Kind) -> tuple[np.ndarray, ...]:
    """Document, first window, windows, minimizer, content hash and second content hash of each phrase of joined texts."""
    n, k, size = len(values), kind.gram, kind.length
    none = np.zeros(0, np.int64)
    if n < size:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(np.uint32)
    up, down = powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=prefix[1:])
    grams = mix((prefix[k:] - prefix[:-k]) * down[: n + 1 - k])
    least = sliding_min(grams, size - k + 1)
    starts = np.cumsum(counts) - counts
    valid = np.zeros(n - size + 2, np.int8)  # windows inside one document
    room = counts >= size
    np.add.at(valid, starts[room], 1)
    np.add.at(valid, (starts + counts - size + 1)[room], -1)
    inside = np.cumsum(valid)[:-1] > 0
    new = inside.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    new[starts[room]] = True
    first = np.flatnonzero(new)
    over = np.zeros(len(inside) + 1, np.int64)
    np.cumsum(inside, out=over[1:])
    length = over[np.append(first[1:], len(inside))] - over[first]
    parts = -(-length // size)  # stretches of one minimizer are cut at size windows
    if len(parts) and parts.max() > 1:
        index = ragged(np.zeros(len(parts), np.int64), parts)
        first, length = np.repeat(first, parts) + index * size, np.minimum(np.repeat(length, parts) - index * size, size)
    stop = first + length + size - 1
    content = mix((prefix[stop] - prefix[first]) * down[first] + (length.astype(np.uint64) * GOLD))
    check = np.zeros(len(first), np.uint32)
    if kind.merge:
        check = (mix(_span_values(mix(values ^ GOLD), first, stop)) >> np.uint64(32)).astype(np.uint32)
    doc = np.searchsorted(starts, first, "right") - 1
    return doc, first - starts[doc], length, least[first], content, check


def equal_bytes(body: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` bytes (one at least) at a and at b are the same, some spans at a time."""
    out = np.zeros(len(a), bool)
    volume, start = np.cumsum(size), 0
    while start < len(a):
        stop = max(start + 1, int(np.searchsorted(volume, (volume[start - 1] if start else 0) + 4_000_000)))
        n = size[start:stop]
        same = body[ragged(a[start:stop], n)] == body[ragged(b[start:stop], n)]
        out[start:stop] = np.logical_and.reduceat(same, np.cumsum(n) - n)
        start = stop
    return out


# Packed tables: columns of numbers, each as its own compressed plane.


def pack(*columns: np.ndarray) -> bytes:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    planes = [squeeze(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes()) if len(c) else b"" for c in columns]
    head = np.array([len(columns[0]), *[len(x) for x in planes]], "<i8").tobytes()
    return head + b"".join(planes)


def unpack(blob: bytes, types: tuple[str, ...]) -> list[np.ndarray]:
    head = np.frombuffer(blob, "<i8", len(types) + 1)
    n, at, out = int(head[0]), 8 * (len(types) + 1), []
    expand = zstandard.ZstdDecompressor().decompress
    for kind, size in zip(types, head[1:].tolist()):
        plane = expand(blob[at : at + size]) if n else b""
        width = np.dtype(kind).itemsize
        out.append(np.frombuffer(plane, np.uint8).reshape(width, n).T.copy().view(kind).reshape(n) if n else np.zeros(0, kind))
        at += size
    return out


def _short(h: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def pack_entries(doc_id, crc, first, length, least=None, content=None, check=None) -> bytes:
    """Entries sorted by document: documents once, places as differences, 48 bits of the minimizer."""
    new = np.ones(len(doc_id), bool)
    new[1:] = (doc_id[1:] != doc_id[:-1]) | (crc[1:] != crc[:-1])
    at = np.flatnonzero(new)
    head = pack(np.diff(doc_id[at], prepend=np.int64(0)).astype("<i8"), crc[at].astype("<u4"), np.diff(np.append(at, len(doc_id))).astype("<u4"))
    step = np.diff(first.astype(np.int64), prepend=np.int64(0))
    step[at] = first[at]
    body = pack(step.astype("<u4"), length.astype("<u2"), (np.zeros(len(doc_id), "<u4") if check is None else check))
    hashes = b"" if least is None else _short(least, 6) + _short(content, 8)
    return np.array([len(head), len(body), len(doc_id)], "<i8").tobytes() + head + body + hashes


def unpack_entries(blob: bytes) -> list[np.ndarray]:
    """doc_id, crc, first window, windows and, where they are there, minimizer, content and check."""
    a, b, n = np.frombuffer(blob, "<i8", 3).tolist()
    steps, crcs, runs = unpack(blob[24 : 24 + a], ("<i8", "<u4", "<u4"))
    step, length, check = unpack(blob[24 + a : 24 + a + b], ("<u4", "<u2", "<u4"))
    doc, crc = np.repeat(np.cumsum(steps), runs), np.repeat(crcs, runs)
    total = np.cumsum(step.astype(np.int64))
    at = np.cumsum(runs.astype(np.int64)) - runs
    before = total[at] - step[at]
    out = [doc, crc, total - np.repeat(before, runs), length.astype(np.int64)]
    at = 24 + a + b
    if len(blob) == at:
        return out
    least = np.zeros((n, 8), np.uint8)
    least[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, at).reshape(n, 6)
    return [*out, least.view("<u8").reshape(n), np.frombuffer(blob, "<u8", n, at + 6 * n), check]


#: A prime and a factor that spread doc_ids over groups of documents.
PRIME, FACTOR = 1_000_003, 7919


def home_of(doc: np.ndarray, n: int) -> np.ndarray:
    """The group of documents that a doc_id belongs to; ``home_column`` is the same in Spark."""
    return (doc.astype(np.int64) % PRIME) * FACTOR % PRIME % n


def home_column(n: int) -> Column:
    spread = F.pmod(F.col("doc_id"), F.lit(PRIME)) * FACTOR % PRIME % n
    return F.coalesce(spread, F.pmod(F.xxhash64("text"), F.lit(n))).cast("int")


def _batch(names: list[str], types: list[pa.DataType], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _packed(homes: list[int], kind: int, blobs: list[bytes]) -> pa.RecordBatch:
    return _batch(["home", "kind", "blob"], [pa.int32(), pa.int32(), pa.binary()], [homes, [kind] * len(blobs), blobs])


def _dealt(doc, crc, first, length, homes: int, kind: int) -> pa.RecordBatch:
    """Spans as packed rows, one for each home of their documents."""
    home = home_of(doc, homes)
    order = np.lexsort((first, crc, doc, home))
    doc, crc, first, length, home = doc[order], crc[order], first[order], length[order], home[order]
    at = np.searchsorted(home, np.arange(homes + 1))
    used = np.flatnonzero(np.diff(at)).tolist()
    return _packed(used, kind, [pack_entries(doc[a:b], crc[a:b], first[a:b], length[a:b]) for a, b in ((at[i], at[i + 1]) for i in used)])


REMOVED, WANTED, SENT = 0, 1, 2
PACKED = "home int, kind int, blob binary"


def bucket_of(least: np.ndarray, buckets: int) -> np.ndarray:
    return ((least >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def _phrases(kind: Kind, buckets: int) -> Callable:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        bodies: list[np.ndarray] = []

        def send() -> Iterator[pa.RecordBatch]:
            doc, crc, first, length, least, content, check, start, size = (np.concatenate(x) for x in zip(*held))
            body = np.concatenate(bodies)
            held.clear(), bodies.clear()
            order = np.lexsort((doc, content, least))
            same = (least[order][1:] == least[order][:-1]) & (content[order][1:] == content[order][:-1])
            lead = order[np.maximum.accumulate(np.where(np.append(True, ~same), np.arange(len(order)), 0))]
            later = (doc[order] > doc[lead]) & (size[order] == size[lead])
            gone, lead = order[later], lead[later]
            gone = gone[equal_bytes(body, start[gone], start[lead], size[gone])]
            del body
            if len(gone):
                yield _dealt(doc[gone], crc[gone], first[gone], length[gone], buckets, REMOVED)
            keep = np.ones(len(doc), bool)
            keep[gone] = False
            bucket = bucket_of(least, buckets)
            order = np.lexsort((first, crc, doc, bucket))
            order = order[keep[order]]
            at = np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(at))
            for some in np.array_split(used, max(1, len(order) // 400_000)):
                yield _packed(some.tolist(), SENT, [pack_entries(*(x[o] for x in (doc, crc, first, length, least, content, check))) for o in (order[at[i] : at[i + 1]] for i in some)])

        for batch in batches(rows, 2_000_000):
            ids = batch.column("doc_id").to_pylist()
            raw = [(x or "").encode() for x in batch.column("text").to_pylist()]
            raw = [x for x, i in zip(raw, ids) if i is not None]
            own = np.array([i for i in ids if i is not None], np.int64)
            if not raw:
                continue
            crcs = np.array([zlib.crc32(x) for x in raw], np.uint32)
            these = symbols(raw, kind.unit)
            at, first, length, least, content, check = phrases(these.values, these.counts, kind)
            if len(at):
                place = (np.cumsum(these.counts) - these.counts)[at] + first
                start, stop = these.edges[place], these.edges[place + length + kind.length - 1]
                held.append([own[at], crcs[at], first, length, least, content, check, start + sum(map(len, bodies)), stop - start])
                bodies.append(these.body)
            if sum(len(x[0]) for x in held) >= GATHERED:
                yield from send()
        if held:
            yield from send()

    return frugal(run)


def _meet(kind: Kind, homes: int) -> Callable:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for batch in rows:
            kinds, blobs = batch.column("kind").to_pylist(), batch.column("blob")
            for i, k in enumerate(kinds):
                if k == SENT:
                    got.append(unpack_entries(blobs[i].as_py()))
            passed = np.flatnonzero(np.array(kinds) != SENT)
            if len(passed):
                yield batch.take(pa.array(passed))
        if not got:
            return
        doc, crc, first, length, least, content, check = (np.concatenate(x) for x in zip(*got))
        got.clear()
        order = np.lexsort((doc, content, least))
        doc, crc, first, length, least, content, check = (x[order] for x in (doc, crc, first, length, least, content, check))
        new = np.append(True, least[1:] != least[:-1])
        group = np.cumsum(new) - 1
        if kind.merge:
            head = new | np.append(True, content[1:] != content[:-1])
            lead = np.maximum.accumulate(np.where(head, np.arange(len(doc)), 0))
            other = check != check[lead]
            gone = (doc > doc[lead]) & ~other & (length == length[lead])
            wanted = ~gone & (np.bincount(group, head | other)[group] > 1)
        else:
            gone = np.zeros(len(doc), bool)
            low, high = np.minimum.reduceat(doc, np.flatnonzero(new)), np.maximum.reduceat(doc, np.flatnonzero(new))
            wanted = (low < high)[group]
        for which, code in ((gone, REMOVED), (wanted, WANTED)):
            at = np.flatnonzero(which)
            for a in range(0, len(at), 1_000_000):
                part = at[a : a + 1_000_000]
                yield _dealt(doc[part], crc[part], first[part], length[part], homes, code)

    return frugal(run)


Spans = dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]


def _spans(blobs: list[bytes]) -> Spans:
    """First windows and windows of each document (doc_id, crc) in packed rows."""
    got = [unpack_entries(x)[:4] for x in blobs]
    if not got:
        return {}
    doc, crc, first, length = (np.concatenate(x) for x in zip(*got))
    order = np.lexsort((first, crc, doc))
    doc, crc, first, length = doc[order], crc[order], first[order], length[order]
    at = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (crc[1:] != crc[:-1])))
    return {(int(doc[a]), int(crc[a])): (first[a:b], length[a:b]) for a, b in zip(at.tolist(), [*at[1:].tolist(), len(doc)])}


def _meeting(docs: DataFrame, packed: DataFrame, n: int) -> DataFrame:
    """A partition for each home: its packed rows (blob) first, then its documents."""
    names = [c for c in docs.columns if c != "home"]
    first = packed.select("home", "blob", *[F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in names])
    both = first.unionByName(docs.withColumn("blob", F.lit(None).cast("binary")))
    # rows with a blob sort before rows without one
    return both.withColumn("later", F.col("blob").isNull()).repartitionById(n, "home").sortWithinPartitions("later")


def streamed(act: Callable[[Iterator[pa.RecordBatch], Spans], Iterator[pa.RecordBatch]]) -> Callable:
    """act(batches of documents, spans of this home) over the rows of ``_meeting``."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[bytes] = []

        def documents() -> Iterator[pa.RecordBatch]:
            for batch in rows:
                later = np.asarray(batch.column("later").cast(pa.uint8()))
                cut = int(np.searchsorted(later, 1))
                blobs.extend(batch.column("blob").slice(0, cut).to_pylist())
                if cut < batch.num_rows:
                    yield batch.slice(cut)

        found = documents()
        head = next(found, None)  # all packed rows have been read by then
        if head is None:
            return
        spans = _spans(blobs)
        blobs.clear()
        yield from act(batches(itertools.chain([head], found), 4_000_000), spans)

    return frugal(run)


def _texts(kind: Kind, buckets: int) -> Callable:
    """Of a home's documents, the bytes of the phrases that its packed rows want."""

    def act(docs: Iterator[pa.RecordBatch], wanted: Spans) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        done = set()

        def deal() -> pa.RecordBatch:
            doc, crc, first, length, least, size = (np.concatenate([x[i] for x in out]) for i in range(6))
            body = np.concatenate([x[6] for x in out])
            out.clear()
            at = np.cumsum(size) - size
            bucket = bucket_of(least, buckets)
            order = np.lexsort((least, bucket))
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            names, blobs = np.flatnonzero(np.diff(cut)).tolist(), []
            for i in names:
                o = order[cut[i] : cut[i + 1]]
                table = pack(doc[o], crc[o], first[o].astype("<u4"), length[o].astype("<u2"), least[o], size[o].astype("<u4"))
                blobs.append(np.array([len(table)], "<i8").tobytes() + table + zstandard.ZstdCompressor(level=1).compress(body[ragged(at[o], size[o])].tobytes()))
            return _batch(["bucket", "blob"], [pa.int32(), pa.binary()], [names, blobs])

        for batch in docs:
            for d, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                raw = (text or "").encode()
                key = (d, zlib.crc32(raw))
                if key not in wanted or key in done:
                    continue
                done.add(key)
                first, length = wanted[key]
                these = symbols([raw], kind.unit)
                n = len(these.values)
                grams = mix(_span_values(these.values, np.arange(n + 1 - kind.gram), np.arange(kind.gram, n + 1)))
                least = np.minimum.reduceat(np.append(grams, np.uint64(0)), np.ravel(np.column_stack([first, first + kind.length - kind.gram + 1])))[::2]
                start, stop = these.edges[first], these.edges[first + length + kind.length - 1]
                out.append((np.full(len(first), d, np.int64), np.full(len(first), key[1], np.uint32), first, length, least, stop - start, these.body[ragged(start, stop - start)]))
            if sum(len(x[6]) for x in out) >= DEALT_BYTES:
                yield deal()
        if out:
            yield deal()

    return streamed(act)


#: Gets documents' ids, windows, bytes and numbers of bytes of phrases (all under whole minimizers) and the length of a
#: window, and says which windows are earlier elsewhere: their phrases and places in these.
Matcher = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]]


def _matched(kind: Kind, match: Matcher, homes: int, most: int) -> Callable:
    """Runs a matcher over the phrases of a bucket, some minimizers (about ``most`` bytes) at a time."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, bodies = [], []
        for batch in rows:
            for blob in batch.column("blob").to_pylist():
                n = int(np.frombuffer(blob, "<i8", 1)[0])
                got.append(unpack(blob[8 : 8 + n], ("<i8", "<u4", "<u4", "<u2", "<u8", "<u4")))
                bodies.append(zstandard.ZstdDecompressor().decompress(blob[8 + n :]))
        if not got:
            return
        doc, crc, first, length, least, size = (np.concatenate(x) for x in zip(*got))
        length, size = length.astype(np.int64), size.astype(np.int64)
        body = np.frombuffer(b"".join(bodies), np.uint8)
        got.clear(), bodies.clear()
        at = np.cumsum(size) - size
        order = np.argsort(least, kind="stable")
        edges = np.flatnonzero(np.append(True, least[order][1:] != least[order][:-1]))
        volume = np.cumsum(size[order])
        start = 0
        while start < len(order):  # whole minimizers
            stop = int(np.searchsorted(volume, (volume[start - 1] if start else 0) + most))
            later = np.searchsorted(edges, max(stop, start + 1))
            stop = int(edges[later]) if later < len(edges) else len(order)
            o = order[start:stop]
            phrase, place = match(doc[o], length[o], body[ragged(at[o], size[o])], size[o], kind.length)
            if len(phrase):
                p = o[phrase]
                yield _dealt(doc[p], crc[p], first[p].astype(np.int64) + place, np.ones(len(p), np.int64), homes, REMOVED)
            start = stop

    return frugal(run)


def covered(starts: np.ndarray, windows: np.ndarray, length: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the maximal runs of symbols under windows that start in the given spans."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, starts + windows + length - 1, -1)
    under = np.cumsum(delta) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], under]).astype(np.int8)))
    return edge[::2], edge[1::2]


def resolved(docs: DataFrame, kind: Kind, match: Matcher, most: int, finish: Callable, schema: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """finish(batch of docs, spans by (doc_id, crc)) for all docs (doc_id, text and ``extra``).

    finish gets Arrow batches of documents and, for those that have any, the first windows and counts
    of windows that are earlier elsewhere, and returns an Arrow batch of ``schema``.
    """
    n = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *extra)
    sent = rows.select("doc_id", "text").mapInArrow(_phrases(kind, n), PACKED)
    met = materialized(sent.repartitionById(n, "home").mapInArrow(_meet(kind, n), PACKED), "met")
    homed = rows.withColumn("home", home_column(n))
    texts = _meeting(homed.select("home", "doc_id", "text").where("doc_id IS NOT NULL"), met.where(F.col("kind") == WANTED), n).mapInArrow(_texts(kind, n), "bucket int, blob binary")
    found = texts.repartitionById(n, "bucket").mapInArrow(_matched(kind, match, n, most), PACKED)
    removed = met.where(F.col("kind") == REMOVED).unionAll(found)

    def act(own: Iterator[pa.RecordBatch], spans: Spans) -> Iterator[pa.RecordBatch]:
        for batch in own:
            yield finish(batch.drop_columns(["home", "blob", "later"]), spans)

    return _meeting(homed, removed, n).mapInArrow(streamed(act), schema)
