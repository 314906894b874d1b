"""Removes repeated substrings by sorting sampled suffixes.

Every byte of a document goes that lies in a string of ``SPAN`` bytes which also
starts in a document with a smaller doc_id.

1. *Sampled suffixes.* Each window of ``SPAN`` bytes names one anchor: the
   ``GRAM`` bytes inside it with the smallest hash, the leftmost on ties. Equal
   windows name equal anchors at equal places, so only suffixes that start at
   anchors (about every 20th) need sorting. Neighbouring windows with one anchor
   travel together as one piece: the text they cover, 50 to 88 bytes.
2. *Splitters.* The leading ``GRAM`` bytes of sampled anchor suffixes give splitters, so
   that buckets hold about ``BUCKET`` bytes of pieces; a frequent lead of 8 bytes is split by
   the bytes that follow. Equal leading bytes fall into one bucket, therefore no run of equal
   suffixes crosses a boundary.
3. *Sorting.* A bucket sorts its pieces by multikey sort, eight bytes at a time,
   from the anchor on: only runs that still tie are sorted by the next eight.
   Pieces that are equal as a whole are settled by their smallest doc_id; where
   different pieces share an anchor, their windows are sorted and compared.
4. Covered stretches go back to their documents, which are cut and hashed.

Tasks sort and settle their own pieces before the shuffle, chunk by chunk, so of a passage that
many documents share one copy leaves each chunk for its bucket, whatever its share of the rows;
what is settled goes straight to its documents and passes no bucket.
Pieces and texts travel in compressed blocks. Comparisons are of bytes, never of hashes.

Defined cases: a null text is empty; texts under ``SPAN`` bytes lose nothing; rows
with equal doc_ids never remove anything from each other; a null doc_id is larger
than every other and never smaller than another null; an empty table gives an
empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtally.llm.common import materialise, number_rows, ship

SPAN = 50
GRAM = 12
PLACE_BITS = 32  # beside the leading bits of a hash; the same for chunks of all sizes, so that all name the same anchors
CHUNK = 4 << 20  # bytes of text handled at once
BUCKET = 16 << 20  # bytes of pieces in a bucket
WINDOWS = 1 << 20  # windows compared at once
SPREAD = 3.7  # bytes of pieces for a byte of text, about
TEXTS = 16 << 20  # bytes of text in a bucket of documents
LEVEL = 5  # of compression
MOST_PARTS = 50_000  # partitions of the bucket shuffle
SAMPLE = 4 << 20  # bytes of text at least that give the splitters
LAST = (1 << 63) - 1  # stands for a null doc_id
WORDS = (0, 8, 16, 24, 32, 40, SPAN - 8)  # eight-byte words that cover a window


# ------------------------------------------------------------ pieces of a chunk


def _word_at(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as big-endian numbers; ``buf`` ends with 8 spare bytes."""
    return np.ndarray((len(buf) - 8,), ">u8", buf.tobytes(), strides=(1,))


def pieces(buf: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor) of each piece.

    ``valid``: whether a window may start there; ``buf`` has SPAN spare bytes or more at its end.
    """
    n = len(valid)
    w = _word_at(buf)
    m = n + SPAN - GRAM
    h = w[:m] * np.uint64(0x9E3779B97F4A7C15) + w[GRAM - 8:m + GRAM - 8] * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    if m >> PLACE_BITS:
        raise ValueError(f"a chunk of {m} bytes has places beyond {PLACE_BITS} bits; lower CHUNK")
    low = np.uint64((1 << PLACE_BITS) - 1)
    h = (h & ~low) | np.arange(m, dtype=np.uint64)  # ties go to the left
    width, have = SPAN - GRAM + 1, 1
    while have < width:  # minimum over ``width`` places by doubling
        step = min(have, width - have)
        h = np.minimum(h[:-step], h[step:])
        have += step
    anchor = (h[:n] & low).astype(np.int64)
    at = np.flatnonzero(valid)
    if not len(at):
        return at, at, at
    new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(anchor[at]) != 0)))
    first = np.flatnonzero(new)
    return at[first], np.diff(np.concatenate((first, [len(at)]))), anchor[at[first]]


def sort_runs(columns: Iterator[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey sort: (order, whether a row starts a new run of equal rows).

    ``columns``: functions from row numbers to one word each; after the first
    word only the runs that still tie are looked at.
    """
    order, new = np.arange(n), np.zeros(n, bool)
    if n:
        new[0] = True
    for word in columns:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        run, value = np.cumsum(new)[at], word(order[at])
        by = np.lexsort((value, run))
        order[at], value = order[at][by], value[by]
        new[at[1:]] |= (value[1:] != value[:-1]) | (run[1:] != run[:-1])
    return order, new


def _least(order: np.ndarray, new: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each row the smallest doc of its run."""
    starts = np.flatnonzero(new)
    out = np.empty(len(order), np.int64)
    if len(starts):
        out[order] = np.repeat(np.minimum.reduceat(doc[order], starts), np.diff(np.concatenate((starts, [len(order)]))))
    return out


def _piece_words(w: np.ndarray, start: np.ndarray, count: np.ndarray, anchor: np.ndarray):
    """Words that tell pieces apart, leading ones from the anchor on (always inside the piece's first window)."""
    yield lambda k: w[anchor[k]]
    yield lambda k: (count[k] * 64 + anchor[k] - start[k]).astype(np.uint64)
    for d in WORDS:
        yield lambda k, d=d: w[start[k] + d]
    for d in WORDS:
        yield lambda k, d=d: w[start[k] + count[k] - 1 + d]


# ------------------------------------------------------------ blocks


def _steps(a: np.ndarray) -> np.ndarray:
    """Differences: small numbers, where a column ascends."""
    return np.diff(a.astype("<i8"), prepend=0)


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a) for a in arrays], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=LEVEL).compress(head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unpack(block: bytes, kinds: str) -> list[np.ndarray]:
    """The arrays of a block; 64-bit columns are summed up again."""
    raw = zstandard.ZstdDecompressor().decompress(block)
    types = kinds.split()
    at, out = 8 * len(types), []
    for n, t in zip(np.frombuffer(raw, "<i8", len(types)).tolist(), types):
        column = np.frombuffer(raw, t, n, at)
        out.append(np.cumsum(column) if t == "<i8" else column)
        at += n * np.dtype(t).itemsize
    return out


# A block: pieces (doc_id, anchor's offset, windows, bytes), where they stand
# (piece, document's key, place), and stretches already settled (key, place, windows);
# either the one or the other.
BLOCK = "<i8 u1 u1 u1 <i8 <i8 <i8 <i8 <i8 u1"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Lists of (doc_id, key, place in the text, bytes) of about CHUNK bytes; long texts in overlapping parts."""
    part: list = []
    have = 0
    for b in batches:
        for doc, key, text in zip(b.column("doc_id").to_pylist(), b.column("key").to_pylist(), b.column("text")):
            raw = text.as_buffer()
            if raw is None or raw.size < SPAN:
                continue
            for at in range(0, raw.size - SPAN + 1, CHUNK):
                part.append((LAST if doc is None else doc, key, at, raw[at:at + CHUNK + SPAN - 1].to_pybytes()))
                have += len(part[-1][3])
                if have >= CHUNK:
                    yield part
                    part, have = [], 0
    if part:
        yield part


def _laid_out(part: list[tuple[int, int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, where windows may start, first byte of each text, number of the text at each piece start is by search)."""
    sizes = np.array([len(p[3]) for p in part], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    buf = np.frombuffer(b"".join([*(p[3] for p in part), bytes(SPAN + 8)]), np.uint8)
    valid = np.ones(begins[-1], bool)
    for k in range(1, SPAN):
        valid[begins[1:] - k] = False  # every text here has SPAN bytes at least
    return buf, valid, begins[:-1], sizes


def _leads(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The GRAM bytes from each place on, in an order that is theirs (bytes 0 at the end do not tell leads apart)."""
    return np.ndarray((len(buf) - GRAM,), f"S{GRAM}", buf.tobytes(), strides=(1,))[at]


def _dealt(key: np.ndarray, place: np.ndarray, into: int) -> Iterator[tuple[int, np.ndarray, slice]]:
    """(bucket of documents, order, slice of it) of stretches, by key and place inside."""
    to = key % into
    by = np.lexsort((place, key, to))
    edges = np.flatnonzero(np.concatenate(([True], np.diff(to[by]) != 0, [True]))) if len(by) else np.zeros(1, int)
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(to[by[a]]), by, slice(a, b)


def chunk_blocks(part: list[tuple[int, int, int, bytes]], splitters: np.ndarray, into: int = 1) -> list[tuple[int, bytes]]:
    """(bucket, block) of one chunk, with its own pieces settled.

    Settled stretches are for the documents: their blocks have bucket -1 - (key mod ``into``).
    """
    buf, valid, begins, _ = _laid_out(part)
    start, count, anchor = pieces(buf, valid)
    w = _word_at(buf)
    owner = np.searchsorted(begins, start, "right") - 1
    doc = np.array([p[0] for p in part], np.int64)[owner]
    key = np.array([p[1] for p in part], np.int64)[owner]
    place = np.array([p[2] for p in part], np.int64)[owner] + start - begins[owner]
    order, new = sort_runs(_piece_words(w, start, count, anchor), len(start))
    settled = doc > _least(order, new, doc)
    run = np.empty(len(order), np.int64)
    run[order] = np.cumsum(new) - 1
    live = np.flatnonzero(~settled)
    speaks = np.empty(len(order), np.int64)  # of each run the first piece that is still open
    speaks[run[live][::-1]] = live[::-1]
    out, none = [], np.zeros(0, np.int64)
    bucket = np.searchsorted(splitters if len(splitters) else np.zeros(0, f"S{GRAM}"), _leads(buf, anchor[live]), "right")
    by = np.argsort(bucket, kind="stable")  # in a bucket by document and place, which packs well
    edges = np.flatnonzero(np.concatenate(([True], np.diff(bucket[by]) != 0, [True]))) if len(by) else []
    for a, b in zip(edges[:-1], edges[1:]):
        mine = live[by[a:b]]
        first = speaks[run[mine]]
        u = mine[first == mine]  # one piece of each run
        size = count[u] + SPAN - 1
        from_ = np.repeat(start[u] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        out.append((int(bucket[by[a]]), _pack(
            _steps(doc[u]), (anchor[u] - start[u]).astype(np.uint8), count[u].astype(np.uint8), buf[from_],
            _steps(np.searchsorted(u, first)), _steps(key[mine]), _steps(place[mine]), none, none, none.astype(np.uint8))))
    done = np.flatnonzero(settled)
    for to, a, b in _dealt(key[done], place[done], into):
        mine = done[a[b]]
        out.append((-1 - to, _pack(none, *[none.astype(np.uint8)] * 3, none, none, none, _steps(key[mine]), _steps(place[mine]), count[mine].astype(np.uint8))))
    return out


# ------------------------------------------------------------ a bucket


def settle(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, place, windows) of every covered stretch that a bucket finds."""
    got = [_unpack(b, BLOCK) for b in blocks]
    doc, lead, count, data = (np.concatenate([g[k] for g in got]) for k in range(4))
    lead, count = lead.astype(np.int64), count.astype(np.int64)
    shift = np.cumsum([0, *(len(g[0]) for g in got)])
    piece = np.concatenate([g[4] + s for g, s in zip(got, shift)])
    key, place = np.concatenate([g[5] for g in got]), np.concatenate([g[6] for g in got])
    found = [[np.concatenate([g[k] for g in got])] for k in (7, 8, 9)]
    del got
    buf = np.concatenate((data, np.zeros(SPAN + 8, np.uint8)))
    w = _word_at(buf)
    size = count + SPAN - 1
    start = np.cumsum(size) - size
    anchor = start + lead
    by_piece = np.argsort(piece, kind="stable")
    first = np.searchsorted(piece[by_piece], np.arange(len(doc) + 1))

    def cover(rows: np.ndarray, skip: np.ndarray, windows: np.ndarray) -> None:
        """All places of pieces ``rows``: from the ``skip``-th window on, ``windows`` of them."""
        n = first[rows + 1] - first[rows]
        at = by_piece[np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        for into, what in zip(found, (key[at], place[at] + np.repeat(skip, n), np.repeat(windows, n).astype(np.uint8))):
            into.append(what)

    # pieces that are equal as a whole
    order, new = sort_runs(_piece_words(w, start, count, anchor), len(doc))
    late = doc > _least(order, new, doc)
    cover(np.flatnonzero(late), np.zeros(late.sum(), np.int64), count[late])
    # of what is left one piece for each run; where several share an anchor their windows are compared
    run = np.empty(len(doc), np.int64)
    run[order] = np.cumsum(new) - 1
    live = np.flatnonzero(~late)
    order, new = sort_runs(iter((lambda k: w[anchor[live[k]]], lambda k: w[anchor[live[k]] + GRAM - 8])), len(live))
    several = ~new
    several[:-1] |= ~new[1:]
    rows, group = live[order[several]], np.cumsum(new)[several]
    ends = np.cumsum(count[rows])  # windows so far; anchors are taken together in parts of about WINDOWS
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + WINDOWS)))
        to = int(np.searchsorted(group, group[to - 1], "right"))
        part, n = rows[at:to], count[rows[at:to]]
        which = np.repeat(np.arange(len(part)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        begin = start[part][which] + step
        # equal windows have their anchor at the same distance
        near = group[at:to][which] * 64 + anchor[part][which] - begin
        by, fresh = sort_runs((lambda k, d=d: near[k] if d is None else w[begin[k] + d] for d in (None, *WORDS)), len(begin))
        mine = doc[part][which]
        hit = np.flatnonzero(mine > _least(by, fresh, mine))
        if len(hit):
            cut_at = np.concatenate(([True], (np.diff(hit) != 1) | (np.diff(which[hit]) != 0)))
            first_hit = hit[cut_at]
            cover(part[which[first_hit]], step[first_hit], np.diff(np.concatenate((np.flatnonzero(cut_at), [len(hit)]))))
        at = to
    return tuple(np.concatenate(f) for f in found)


# ------------------------------------------------------------ a document


def cut(raw: bytes, place: np.ndarray, windows: np.ndarray) -> tuple[int, int, str]:
    """(bytes removed, stretches removed, SHA-256 of what is left)."""
    if not len(place):
        return 0, 0, hashlib.sha256(raw).hexdigest()
    by = np.argsort(place, kind="stable")
    a, z = place[by], place[by] + windows[by].astype(np.int64) + SPAN - 1
    reach = np.maximum.accumulate(z)
    new = np.concatenate(([True], a[1:] > reach[:-1]))
    begins = a[new]
    ends = reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(a) - 1]))]
    left, at = hashlib.sha256(), 0
    for b, e in zip(begins.tolist(), ends.tolist()):
        left.update(raw[at:b])
        at = e
    left.update(raw[at:])
    return int((ends - begins).sum()), len(begins), left.hexdigest()


# ------------------------------------------------------------ the operator


# Documents on their way to their bucket: doc_id, whether it is known, key, bytes.
TEXT = "<i8 u1 <i8 <i8 u1"


def _packer(into: int):
    """Deals rows to ``into`` buckets by key, as compressed blocks."""
    def blocks(held: list) -> pa.RecordBatch:
        key = np.array([h[1] for h in held], np.int64)
        size = np.array([len(h[2]) for h in held], np.int64)
        to = key % into
        by = np.lexsort((key, to))
        edges = np.flatnonzero(np.concatenate(([True], np.diff(to[by]) != 0, [True])))
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            k = by[a:b]
            raw = np.frombuffer(b"".join(held[x][2] for x in k), np.uint8)
            out.append(_pack(_steps(np.array([held[x][0] or 0 for x in k], np.int64)), np.array([held[x][0] is not None for x in k], np.uint8),
                             _steps(key[k]), _steps(size[k]), raw))
        return pa.RecordBatch.from_arrays([pa.array(to[by[edges[:-1]]], pa.int64()), pa.array(out, pa.binary())], ["dealt", "block"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, have = [], 0
        for b in batches:
            for doc, key, text in zip(b.column("doc_id").to_pylist(), b.column("key").to_pylist(), b.column("text")):
                held.append((doc, key, text.as_buffer().to_pybytes()))
                have += len(held[-1][2])
                if have >= 4 * CHUNK:
                    yield blocks(held)
                    held, have = [], 0
        if held:
            yield blocks(held)

    return task


def _cutter(names: list[str]):
    def task(docs: pa.Table, blocks: pa.Table) -> pa.Table:
        got = [_unpack(b, "<i8 <i8 u1") for b in blocks.column("block").to_pylist()]
        key, place, windows = (np.concatenate([g[k] for g in got]) if got else np.zeros(0, np.int64) for k in range(3))
        by = np.argsort(key, kind="stable")
        key, place, windows = key[by], place[by], windows[by]
        out = []
        for block in docs.column("block"):
            doc, known, keys, sizes, data = _unpack(block.as_py(), TEXT)
            data, at = data.tobytes(), 0
            low, high = np.searchsorted(key, keys, "left").tolist(), np.searchsorted(key, keys, "right").tolist()
            for k, size in enumerate(sizes.tolist()):
                a, b = low[k], high[k]
                out.append((int(doc[k]) if known[k] else None, size, *cut(data[at:at + size], place[a:b], windows[a:b])))
                at += size
        cols = list(zip(*out)) if out else [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return task


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # rows are known by their doc_id; where one is null or repeated, by a hash of id and text (equal rows are cut alike)
    unclear = rows.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL")
    rows = rows.withColumn("key", F.col("doc_id") if unclear.isEmpty() else F.xxhash64("doc_id", "text"))
    buckets = max(1, math.ceil(total * SPREAD / BUCKET))
    splitters = spark.sparkContext.broadcast(_splitters(rows, total, buckets))
    into = max(1, math.ceil(total / TEXTS))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _chunks(batches):
            blocks = chunk_blocks(part, splitters.value, into)
            yield pa.RecordBatch.from_arrays([pa.array([b[0] for b in blocks], pa.int64()), pa.array([b[1] for b in blocks], pa.binary())], ["bucket", "block"])

    def sort(group: pd.DataFrame) -> pd.DataFrame:
        key, place, windows = settle(group["block"].tolist())
        return pd.DataFrame([(to, _pack(_steps(key[by[at]]), _steps(place[by[at]]), windows[by[at]])) for to, by, at in _dealt(key, place, into)],
                            columns=["dealt", "block"])

    made = rows.mapInArrow(make, "bucket long, block binary")
    # as many partitions as buckets, so that few buckets share a task at any size of the input
    parts = min(MOST_PARTS, max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    settled = made.repartition(parts, "bucket").groupBy("bucket").applyInPandas(sort, "dealt long, block binary")
    dealt = rows.mapInArrow(_packer(into), "dealt long, block binary")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return dealt.groupBy("dealt").cogroup(settled.groupBy("dealt")).applyInArrow(
        _cutter(names), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _splitters(rows: DataFrame, total: int, buckets: int) -> np.ndarray:
    """Ascending leads between the buckets, from a sample of the documents."""
    if buckets == 1:
        return np.zeros(0, f"S{GRAM}")
    every = max(1, int(total // max(SAMPLE, buckets * 4096)))

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _chunks(batches):
            buf, valid, _, _ = _laid_out(part)
            _, _, anchor = pieces(buf, valid)
            yield pa.RecordBatch.from_arrays([pa.array(_leads(buf, anchor).tolist(), pa.binary())], ["lead"])

    sample = rows.filter(F.pmod("key", F.lit(every)) == 0).mapInArrow(leads, "lead binary")
    # leads are sorted and counted by the tasks; the driver gets one a bucket
    placed = materialise(number_rows(sample, [], ["lead"], "at"))
    n = placed.count()
    step = F.floor(F.col("at") * buckets / max(1, n))
    edges = placed.filter((F.col("at") > 0) & (step > F.floor((F.col("at") - 1) * buckets / max(1, n)))).select("lead").distinct().collect()
    return np.sort(np.array([bytes(r.lead) for r in edges], f"S{GRAM}"))
