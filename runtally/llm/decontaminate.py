"""Benchmark decontamination with one Aho-Corasick automaton.

Words are runs of ASCII letters (A-Z lowered), digits and non-ASCII characters.
Every benchmark text gives windows of ``WINDOW`` consecutive words (a shorter
text is one window). All windows, as word sequences between spaces, make one
automaton; every document is normalised, scanned once, and each occurrence found
is mapped back to words and to character offsets of the original text.

The automaton is the only thing sent to the tasks. Its size is bounded: the
benchmark is dealt into slices of about ``SLICE`` bytes of text at most (read off
a sum before anything is sent), each slice has its own automaton and scans the
documents, and the finds are united per document. A benchmark of usual size is
one slice, so texts are read once and nothing is shuffled.

Defined cases: null and empty texts have no words, no hits and no items; items
without words match nothing; equal windows of several items count for each item;
a repeated item_id counts once; a null item_id is an item of its own, the last one in
``items``, beside one with an empty id; repeated rows are judged each; an empty table
gives an empty result, an empty benchmark no hits; only ``doc_id``/``item_id``
and ``text`` are read.
"""

from __future__ import annotations

import functools
import math
import pickle
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtally.llm.common import materialise, ship

WINDOW = 10
SLICE = 16 << 20
OUT = "row long, doc_id long, n_words long, hits array<int>, starts array<int>, ends array<int>, items array<string>"
# Bytes that belong to a word, lowered; every other byte is a space. One byte stays one byte.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def windows(text: str | None, width: int) -> set[bytes]:
    words = (text or "").encode().translate(FOLD).split()
    if not words:
        return set()
    return {b" " + b" ".join(words[k:k + width]) + b" " for k in range(max(1, len(words) - width + 1))}


def build(items: list[tuple[str, str | None]], width: int) -> ahocorasick.Automaton:
    """Windows -> (characters, words, item ids)."""
    owners: dict[bytes, set[str | None]] = {}
    for item, text in items:
        for w in windows(text, width):
            owners.setdefault(w, set()).add(item)
    a = ahocorasick.Automaton()
    for w, ids in owners.items():
        a.add_word(w.decode("latin-1"), (len(w), w.count(b" ") - 1, tuple(ids)))
    if owners:
        a.make_automaton()
    return a


def scan(text: str | None, a: ahocorasick.Automaton) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, set[str]]:
    """(words, hit words, their first and last+1 character in the original, items found)."""
    none = np.zeros(0, np.int32)
    raw = (text or "").encode()
    folded = raw.translate(FOLD)
    words = folded.split()
    if not words or not len(a):
        return len(words), none, none, none, set()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found = list(a.iter(line))
    if not found:
        return len(words), none, none, none, set()
    spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(spaces, [end for end, _ in found])  # the space that closes a window comes after its last word
    first = last - [n for _, (_, n, _) in found]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last, -1)
    hit = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    # word k of the folded text starts where a word byte follows a space; bytes to characters by counting lead bytes
    inner = np.frombuffer(folded, np.uint8) != 32
    step = np.diff(np.concatenate(([0], inner.astype(np.int8), [0])))
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    starts, ends = chars[np.flatnonzero(step == 1)[hit]], chars[np.flatnonzero(step == -1)[hit]]
    return len(words), hit, starts, ends, {i for _, (_, _, ids) in found for i in ids}


@functools.lru_cache(maxsize=2)
def _load(packed: bytes) -> ahocorasick.Automaton:
    return build(*pickle.loads(packed))


def _slices(benchmark: DataFrame) -> tuple[int, Iterator[list[tuple[str | None, str | None]]]]:
    """(number of slices, the slices one after the other) of about ``SLICE`` bytes at most; one that fits is a single slice.

    The driver holds the texts of one slice at a time.
    """
    b = materialise(benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).distinct())
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 64
    total = b.agg(F.sum(size)).first()[0] or 0
    if total <= SLICE:
        return 1, iter([[(r.item, r.text) for r in b.collect()]])
    # dealt by hash into slices of half of ``SLICE`` on average, so none is far over it
    count = math.ceil(2 * total / SLICE)
    b = materialise(b.withColumn("slice", F.pmod(F.xxhash64("item", "text"), F.lit(count))))
    return count, ([(r.item, r.text) for r in b.filter(F.col("slice") == n).collect()] for n in range(count))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, hits, starts, ends, items.

    ``hits``: numbers of the hit words; ``starts``/``ends``: where they stand in
    the original text, in characters; ``items``: ids, sorted as strings.
    """
    rows = docs.select(F.lit(0).cast("long").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ship(docs.sparkSession)
    count, slices = _slices(benchmark)
    if count > 1:  # finds of several scans meet by row
        rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()))
    sc = docs.sparkSession.sparkContext
    scans = [rows.mapInArrow(_scanner(sc.broadcast(pickle.dumps((s, width)))), OUT) for s in slices]
    out = functools.reduce(DataFrame.unionByName, scans)
    if count == 1:
        return out.drop("row")
    pairs = F.arrays_zip("hits", "starts", "ends")
    united = out.groupBy("row", "doc_id", "n_words").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(pairs)))).alias("p"),  # one row a slice at most
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return united.select("doc_id", "n_words", F.col("p.hits").alias("hits"), F.col("p.starts").alias("starts"), F.col("p.ends").alias("ends"), "items")


def clean_rows(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns; nothing is joined."""
    ship(docs.sparkSession)
    for s in _slices(benchmark)[1]:
        docs = docs.mapInArrow(_sieve(docs.sparkSession.sparkContext.broadcast(pickle.dumps((s, width)))), docs.schema)
    return docs


def _sieve(packed):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _load(packed.value)
        for b in batches:
            yield b.filter(pa.array([not len(scan(t.as_py(), a)[1]) for t in b.column("text").cast(pa.string())], pa.bool_()))

    return task


def _scanner(packed):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _load(packed.value)
        for b in batches:
            got = [scan(t.as_py(), a) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([
                b.column("row"), b.column("doc_id"), pa.array([g[0] for g in got], pa.int64()),
                *(pa.array([g[k] for g in got], pa.list_(pa.int32())) for k in (1, 2, 3)),
                pa.array([sorted(g[4], key=lambda i: (i is None, i or "")) for g in got], pa.list_(pa.string()))],
                ["row", "doc_id", "n_words", "hits", "starts", "ends", "items"])

    return task


def decontaminate_sql(docs: str = "documents", benchmark: str = "benchmark", width: int = WINDOW) -> str:
    """The counts of ``decontaminate`` as DuckDB SQL: windows of every size that occurs in the benchmark are joined."""
    def words(text: str) -> str:
        low = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words('text')} AS w FROM {docs}),
b AS (SELECT DISTINCT item_id, {words('text')} AS w FROM {benchmark}),
i AS (SELECT item_id, w, least(len(w), {width}) AS size FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, size, array_to_string(w[k:k + size - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM i)),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (SELECT rid, size, k, array_to_string(w[k:k + size - 1], ' ') AS gram
    FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT rid, k, size, item_id FROM dw JOIN iw USING (size, gram)),
n AS (SELECT rid, count(DISTINCT word) AS n_hit FROM (SELECT rid, unnest(range(k, k + size)) AS word FROM hit) GROUP BY rid),
f AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN f USING (rid)"""
