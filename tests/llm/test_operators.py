"""Operators of runtally.llm against DuckDB twins and brute-force versions."""

import hashlib
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from oracle_compare import compare, duck
from pyspark.sql import functions as F

from runtally.llm import (
    decontaminate, exact_dedup, kd_shards, ordinal_quality, queries, quote_threads, simhash_vptree, source_mix,
    suffix_dedup, token_files, url_templates,
)

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same_rows(got, want):
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def documents(spark, sf_dir):
    return queries.table(spark, sf_dir, "documents")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_duckdb(spark, sf_dir, name):
    ok, why = compare(spark, duck(sf_dir), name, queries.QUERIES[name], queries.SQL[name], sf_dir)
    assert ok, why


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_number_is_registered_and_runs(spark, sf_dir, name):
    assert queries.QUERIES[name](spark, sf_dir).count() > 0


def test_each_number_once():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES]
    assert len(numbers) == len(set(numbers)) and set(numbers) >= set(range(1, 11))


# ------------------------------------------------------------------ 1


def test_urls_odd_cases(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.COM/en/1?x#y"), (5, "https://www.example.com/en/2"), (6, "x://com"),
            (7, "http://net/es/"), (8, "http://evilexample.com/en/"), (8, "http://evilexample.com/en/"), (None, "http://a.net/" + "s/" * 5000)]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' AS host", "1 AS n", "2 AS blocked")
    got = [(r.page_id, r.host, r.rule, r.verdict) for r in url_templates.judge_urls(df, queries.URL_RULES).collect()]
    same_rows(got, [(1, "", None, "allow"), (2, "", None, "allow"), (3, "", None, "allow"), (4, "a.example.com", "example.com/en/", "block"),
                    (5, "www.example.com", "www.example.com/en/", "allow"), (6, "com", None, "allow"), (7, "net", "net/es/", "block"),
                    (8, "evilexample.com", "com/", "allow"), (8, "evilexample.com", "com/", "allow"), (None, "a.net", None, "allow")])
    assert url_templates.judge_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_templates_learn_from_rules(spark):
    """Item pages of one host: ruled ones are blocked, so their template is, and pages that share it follow."""
    ruled = [(k, f"http://shop.x/p/item{k}/buy") for k in range(40)]
    rules = [("block", "shop.x/p/item1"), ("block", "shop.x/p/item2"), ("block", "shop.x/p/item3")]
    names = [(100 + k, f"http://blog.y/{w}/read") for k, w in enumerate("one two three four five six seven eight nine ten".split())]
    df = spark.createDataFrame(ruled + names, "page_id long, url string")
    got = {r.page_id: r for r in url_templates.judge_urls(df, rules).collect()}
    assert got[5].rule is None and got[5].verdict == "block" and got[5].template == "/p/*/buy"
    assert got[100].template == "/*/read" and got[100].verdict == "allow"


WORDS = [a + b for a in "ba ko ri mu se ta lo ni".split() for b in "dan fel gor him jus kel lat mop".split()]


@pytest.mark.parametrize("level", [2, 4, 6, 9])
def test_varying_segments_become_one_template_at_any_level(spark, level):
    stem = "/".join(["x", "y", "z", "u", "v", "w", "q", "r"][:level - 1])
    rows = [(k, f"http://h.org/{stem}/{w}/end") for k, w in enumerate(WORDS)]
    rules = [("block", f"h.org/{stem}/{w}/") for w in WORDS[:20]]
    got = url_templates.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    assert {(r.template, r.verdict) for r in got} == {(f"/{stem}/*/end", "block")}


def test_two_varying_levels_and_deep_single_paths(spark):
    rows = [(k, f"http://h.org/a/{w}/{w[::-1]}x") for k, w in enumerate(WORDS)] + [(999, "http://h.org/" + "s/" * 3000)]
    got = url_templates.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), []).collect()
    assert {r.template for r in got if r.page_id != 999} == {"/a/*/*"}


def test_merging_at_deep_levels_follows_the_twin(spark):
    """Siblings that are too few to generalise pool by their share of blocked pages, at levels the old tree did not have."""
    rows = [(100 * k + n, f"http://h.org/a/b/c/d/{w}/t{'uvw'[n % 3]}") for k, w in enumerate(["one", "two", "six", "ten"]) for n in range(12)]
    rules = [("block", "h.org/a/b/c/d/one/"), ("block", "h.org/a/b/c/d/two/"), ("allow", "h.org/a/b/c/d/six/")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = url_templates.judge_urls(df, rules)
    con = duckdb.connect()
    pages = df.toPandas()  # noqa: F841
    want = con.execute(url_templates.judge_urls_sql(rules)).fetchall()
    same_rows([tuple(r) for r in got.collect()], want)
    assert {r.template for r in got.collect()} == {"/a/b/c/d/+5/+5", "/a/b/c/d/six/+0", "/a/b/c/d/ten/+-1"}


# ------------------------------------------------------------------ 2


def brute_groups(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((d, len(t or "")))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        out += [(d, keep, len(members), d == keep, hashlib.sha256(norm.encode()).hexdigest()) for d, _ in members]
    return out


@pytest.mark.parametrize("share", [0, 1, 2])
def test_exact_dedup_odd_cases(odd_docs, no_docs, share):
    stored = F.lit(share == 2) if share != 1 else F.pmod(F.xxhash64("doc_id", "source"), F.lit(2)) == 0
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in exact_dedup.exact_dedup(odd_docs, stored).collect()]
    same_rows(got, brute_groups(pairs(odd_docs)))
    assert exact_dedup.exact_dedup(no_docs, stored).count() == 0


def test_byte_check_parts_texts_under_one_digest(odd_docs):
    weak = lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 3), 16, "0"))
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(odd_docs, F.col("doc_id") % 2 == 0, weak).collect()
           if r.doc_id is not None]
    want = [r[:4] for r in brute_groups(pairs(odd_docs)) if r[0] is not None]
    same_rows(got, want)


def test_ids_at_the_ends_of_a_long(spark):
    rows = [(-(1 << 63), "a"), ((1 << 63) - 1, "a"), (0, "a "), (None, "a"), (-(1 << 63), "b"), (5, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in exact_dedup.exact_dedup(df, F.col("doc_id") > 0).collect()]
    same_rows(got, brute_groups(rows))


def brute_batch(batch, stored):
    members, out = {}, []
    for side, part in enumerate((batch, *stored)):
        for d, t in part:
            members.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((d, len(t or "")))
    for d, t in batch:
        same = members[re.sub(r"[\x20\x09-\x0D]", "", t or "")]
        keep = min(same, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        out.append((d, keep, len(same), d == keep))
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_batch_against_stored_snapshots(spark, odd_docs, no_docs, tmp_path, weak):
    digest = (lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 5), 16, "0"))) if weak else exact_dedup.sha256
    first = odd_docs.filter("doc_id % 3 = 0 OR doc_id IS NULL")
    second = odd_docs.filter("doc_id % 2 = 0").select((F.col("doc_id") + 100).alias("doc_id"), F.concat("text", F.lit("  ")).alias("text"))
    folders = [f"file://{tmp_path}/{n}" for n in ("one", "two", "none")]
    for part, folder in zip((first, second, no_docs), folders):
        exact_dedup.write_snapshot(part, folder, digest)
    for n in (0, 1, 3):
        got = [tuple(r)[:4] for r in exact_dedup.dedup_batch(odd_docs, folders[:n], digest).select("doc_id", "keep_id", "group_size", "kept").collect()]
        same_rows(got, brute_batch(pairs(odd_docs), [pairs(first), pairs(second), []][:n]))
    assert exact_dedup.dedup_batch(no_docs, folders, digest).count() == 0


def test_only_shared_texts_are_grouped(spark, sf_dir):
    """The byte check reads texts through a join with the shared digests; no text without one reaches an exchange."""
    docs = documents(spark, sf_dir)
    shared = spark.createDataFrame([(b"x" * 32,)], "digest binary")
    plan = exact_dedup._texts(docs, exact_dedup.sha256, shared).groupBy("digest", "bytes").count()._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[-1]
    assert plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin") and plan.count("Exchange hashpartitioning") == 1


def test_fuse_filter_has_no_false_negatives_and_few_positives():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 100, 20_000):
        keys = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        f = exact_dedup.build_filter(keys)
        assert exact_dedup.might_contain(keys, *f).all()
        other = rng.integers(0, 2**63, 20_000).astype(np.uint64)
        if n > 2:
            assert exact_dedup.might_contain(other, *f).mean() < 0.01
            assert n < 1000 or len(f[3]) < 1.5 * n


# ------------------------------------------------------------------ 3


def test_mix_odd_cases(odd_docs, no_docs):
    got = source_mix.mix(odd_docs).collect()
    odd_docs.select("doc_id", "text", "source").toPandas().pipe(lambda p: p)
    pdf = odd_docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("documents", pdf)
    want = con.execute(f"SELECT doc_id, source, size, source_size, target, taken FROM ({source_mix.mix_sql()})").fetchall()
    same_rows([(r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in got],
              [(d, s, z, q, round(t, 6), k) for d, s, z, q, t, k in want])
    assert all(r.taken <= 2 * r.size for r in got) and source_mix.mix(no_docs).count() == 0
    rows = source_mix.mixed_rows(odd_docs)
    assert rows.columns == odd_docs.columns


def test_mix_comes_near_targets(spark, sf_dir):
    rows = source_mix.mix(documents(spark, sf_dir)).collect()
    by = {}
    for r in rows:
        by.setdefault((r.source, r.target), []).append(r)
    for (_, target), own in by.items():
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own)
    total = sum(r.size for r in rows)
    assert abs(sum(t for _, t in by) - 1.5 * total) < 1e-6 * total


# ------------------------------------------------------------------ 4


def test_classifier_separates_held_out_documents(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(300)]
    docs, labels = [], []
    for d in range(1500):
        text = " ".join(rng.choice(words, rng.integers(5, 80)))
        kind = d % 10
        if kind == 0:
            text += " idiot scum"
        elif kind == 1:
            text = text.upper().replace(" ", "!! ")
        docs.append((d, text))
        if d < 1000:
            labels.append((d, int(kind != 1), int(kind == 0)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = ordinal_quality.train(docs, labels)
    got = [r for r in ordinal_quality.score(docs, model).collect() if r.doc_id >= 1000]
    assert model.thresholds[0] < model.thresholds[1]
    assert np.mean([r.kept == (r.doc_id % 10 > 1) for r in got]) > 0.98
    assert np.mean([r.p_clean < 0.5 for r in got if r.doc_id % 10 == 0]) > 0.95
    assert all(abs(r.expected_grade - r.p_clean - r.p_good) < 1e-9 and r.p_good <= r.p_clean for r in got)


def test_classifier_odd_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 0), (None, 1, 1), (99, 1, 1), (7, 1, 1), (7, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = ordinal_quality.train(odd_docs, labels)
    assert ordinal_quality.score(odd_docs, model).count() == odd_docs.count()
    assert ordinal_quality.kept_rows(odd_docs, model).columns == odd_docs.columns
    assert ordinal_quality.score(no_docs, model).count() == 0
    assert ordinal_quality.train(odd_docs, labels.limit(0)) is None
    assert ordinal_quality.score(odd_docs, None).filter("kept").count() == odd_docs.count()


# ------------------------------------------------------------------ 5


def test_shards_are_near_equal_whole_and_gapless(spark, sf_dir):
    rows = queries.QUERIES["op5_kd_shards"](spark, sf_dir).collect()
    texts = dict(pairs(documents(spark, sf_dir)))
    by = {}
    for r in rows:
        b = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 1, zlib.crc32(b), "bytes", None)
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(8)) and len(rows) == len(texts)
    sizes = [sum(r.size for r in s) for s in by.values()]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in by.values())


def test_shards_odd_cases(odd_docs, no_docs, spark):
    assert kd_shards.kd_shards(odd_docs, shards=8).count() == odd_docs.count()
    assert kd_shards.kd_shards(no_docs, shards=8).count() == 0
    out = kd_shards.sharded_rows(odd_docs, target_bytes=20_000)
    assert out.columns == [*odd_docs.columns, "shard"] and out.count() == odd_docs.count()
    hot = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'one text', concat('text ', id)) AS text")
    sizes = [r["b"] for r in kd_shards.kd_shards(hot, shards=8).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.15 * min(sizes)


# ------------------------------------------------------------------ 6


def brute_simhash(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(w[k:k + width]) for k in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, reach):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= reach:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {}
    for k, r in enumerate(root):
        if ids[k] is not None:
            least[r] = min(least.get(r, ids[k]), ids[k])
    return [least.get(r) for r in root]


@pytest.mark.parametrize("leaf", [4, simhash_vptree.LEAF])
def test_simhash_groups(odd_docs, no_docs, leaf):
    rows = pairs(odd_docs)
    fps = [brute_simhash(t, 3) for _, t in rows]
    want = zip([d for d, _ in rows], fps, brute_components(fps, [d for d, _ in rows], 2))
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash_vptree.simhash_groups(odd_docs, 3, 2, leaf).collect()]
    same_rows(got, want)
    assert simhash_vptree.simhash_groups(no_docs, 3, 2).count() == 0


def test_tree_loses_no_pair(spark):
    """Random fingerprints with planted neighbours, leaves far smaller than the table: both cutting forms."""
    rng = np.random.default_rng(7)
    base = rng.integers(-2**63, 2**63 - 1, 600)
    near = base[:200] ^ (1 << rng.integers(0, 63, 200)) ^ (1 << rng.integers(0, 63, 200))
    chain = near[:50] ^ (1 << rng.integers(0, 63, 50))
    fps = np.unique(np.concatenate((base, near, chain)))
    df = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    close = np.bitwise_count(fps.view(np.uint64)[:, None] ^ fps.view(np.uint64)) <= 2
    want = {(int(fps[i]), int(fps[j])) for i, j in zip(*np.nonzero(close)) if i < j}
    for leaf, sample in ((40, simhash_vptree.SAMPLE), (4, 64)):
        old, simhash_vptree.SAMPLE = simhash_vptree.SAMPLE, sample
        try:
            held = {}
            for r in simhash_vptree._leaves(df, 2, leaf).collect():
                held.setdefault(r.node, set()).add(r.fp)
        finally:
            simhash_vptree.SAMPLE = old
        assert len(held) > 3
        assert all(any(a in h and b in h for h in held.values()) for a, b in want)


# ------------------------------------------------------------------ 7


def brute_cut(rows):
    first, out = {}, []
    for d, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            s = b[k:k + 50]
            first[s] = min(first.get(s, suffix_dedup.LAST), suffix_dedup.LAST if d is None else d)
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < (suffix_dedup.LAST if d is None else d):
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("chunk,bucket", [(suffix_dedup.CHUNK, suffix_dedup.BUCKET), (300, 4000)])
def test_suffix_dedup(spark, sf_dir, odd_docs, no_docs, chunk, bucket, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    for df in (odd_docs, documents(spark, sf_dir).limit(150)):
        rows = pairs(df)
        fixed = spark.createDataFrame(rows, "doc_id long, text string")
        same_rows([tuple(r) for r in suffix_dedup.suffix_dedup(fixed).collect()], brute_cut(rows))
    assert suffix_dedup.suffix_dedup(no_docs).count() == 0


def test_pieces_in_small_chunks(monkeypatch):
    """Texts longer than a chunk, settled without Spark."""
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 101, rng.integers(1, 5))) for _ in range(12)]
    texts = [(d, b" ".join(words[k] for k in rng.integers(0, 12, 200)).decode()) for d in range(6)]
    texts += [(6, texts[0][1][100:400] + texts[3][1][20:90]), (7, "a" * 700), (8, "b" + "a" * 700)]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 150)
    import pyarrow as pa
    batch = pa.record_batch([pa.array([d for d, _ in texts]), pa.array([d for d, _ in texts]), pa.array([t for _, t in texts])],
                            names=["doc_id", "key", "text"])
    blocks = [b for part in suffix_dedup._chunks([batch]) for _, b in suffix_dedup.chunk_blocks(part, np.zeros(0, np.uint64))]
    key, place, windows = suffix_dedup.settle(blocks)
    got = [(d, len(t), *suffix_dedup.cut(t.encode(), place[key == d], windows[key == d])) for d, t in texts]
    same_rows(got, brute_cut(texts))


def test_places_of_large_chunks(monkeypatch):
    """Chunks far over 16 MB: every anchor lies in its piece's first window, and equal texts name equal anchors."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", 32 << 20)
    rng = np.random.default_rng(6)
    one = bytes(rng.integers(97, 123, 10 << 20, np.uint8))
    part = [(1, 1, 0, one), (2, 2, 0, one)]
    buf, valid, begins, sizes = suffix_dedup._laid_out(part)
    assert len(buf) > 1 << 24
    start, count, anchor = suffix_dedup.pieces(buf, valid)
    assert ((anchor >= start) & (anchor <= start + suffix_dedup.SPAN - suffix_dedup.GRAM)).all()
    n = np.searchsorted(start, begins[1])
    assert (start[:n] + begins[1] == start[n:]).all() and (anchor[:n] + begins[1] == anchor[n:]).all()
    key, place, windows = suffix_dedup.settle([b for _, b in suffix_dedup.chunk_blocks(part, np.zeros(0, "S12"))])
    for d, removed in ((1, 0), (2, len(one))):
        assert suffix_dedup.cut(one, place[key == d], windows[key == d])[0] == removed


def test_chunks_beyond_the_place_bits_are_refused(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PLACE_BITS", 10)
    buf, valid, _, _ = suffix_dedup._laid_out([(1, 1, 0, b"x" * 2000)])
    with pytest.raises(ValueError, match="lower CHUNK"):
        suffix_dedup.pieces(buf, valid)


def test_a_passage_in_many_rows_leaves_few_bytes_for_its_bucket():
    """A third of the rows hold one passage: their open pieces are those of one document a chunk, what is settled goes to the documents."""
    rng = np.random.default_rng(7)
    own = lambda n: bytes(rng.integers(97, 123, n, np.uint8)).decode()
    passage = own(600)
    texts = [own(400) + (passage if k % 3 == 0 else own(600)) for k in range(3000)]
    splitters = np.sort(np.array([own(12).encode() for _ in range(15)], "S12"))
    part = [(k, k, 0, t.encode()) for k, t in enumerate(texts)]
    sizes, settled = {}, 0
    for bucket, block in suffix_dedup.chunk_blocks(part, splitters, 8):
        if bucket < 0:
            settled += len(suffix_dedup._unpack(block, suffix_dedup.BLOCK)[7])
        else:
            sizes[bucket] = sizes.get(bucket, 0) + len(suffix_dedup._unpack(block, suffix_dedup.BLOCK)[6])
    every = sum(sizes.values()) / len(sizes)
    assert settled > 1000 * 15 and max(sizes.values()) < 4 * every  # the passage's 1000 copies add no rows to a bucket
    assert len({b for b, _ in suffix_dedup.chunk_blocks(part, splitters, 8) if b < 0}) == 8


def test_a_frequent_lead_of_eight_bytes_is_split_by_what_follows():
    rng = np.random.default_rng(9)
    splitters = np.array([b"aaaaaaaa" + c.encode() * 4 for c in "cgkosw"], "S12")
    leads = np.array([b"aaaaaaaa" + bytes(rng.integers(97, 123, 4, np.uint8)) for _ in range(1000)], "S12")
    assert len(set(np.searchsorted(splitters, leads, "right").tolist())) == 7


# ------------------------------------------------------------------ 8


def brute_hits(rows, items, width=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    owners = {}
    for i, t in items:
        w = word.findall((t or "").translate(LOW))
        for k in range(max(1, len(w) - width + 1)) if w else ():
            owners.setdefault(tuple(w[k:k + width]), set()).add(str(i))
    out = []
    for d, t in rows:
        text = (t or "").translate(LOW)
        w, at = word.findall(text), [m.span() for m in word.finditer(text)]
        hit, found = set(), set()
        for n in {len(o) for o in owners}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in owners:
                    hit |= set(range(k, k + n))
                    found |= owners[tuple(w[k:k + n])]
        hit = sorted(hit)
        out.append((d, len(w), hit, [at[k][0] for k in hit], [at[k][1] for k in hit], sorted(found)))
    return out


@pytest.mark.parametrize("slice_bytes", [decontaminate.SLICE, 200])
def test_decontaminate(spark, sf_dir, odd_docs, no_docs, slice_bytes, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", slice_bytes)
    items = [(1, "Beta GAMMA delta"), (2, "eta theta iota kappa lambda mu nu xi omicron pi rho sigma"), (3, None), (4, "..."), (2, "word"), (5, "word")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1))
    got = decontaminate.decontaminate(odd_docs, bench)
    want = brute_hits(pairs(odd_docs), items)
    same_rows([(r.doc_id, r.n_words, r.hits, r.starts, r.ends, r.items) for r in got.collect()], want)
    clean = decontaminate.clean_rows(odd_docs, bench)
    assert clean.columns == odd_docs.columns and clean.count() == sum(not w[2] for w in want)
    assert decontaminate.decontaminate(no_docs, bench).count() == 0
    assert decontaminate.decontaminate(odd_docs, bench.limit(0)).filter(F.size("hits") > 0).count() == 0


# ------------------------------------------------------------------ 9


def test_token_files_round_trip(odd_docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(queries.TOKENIZER)
    t = Tokenizer.from_file(path)
    manifest = token_files.write_tokens(odd_docs, path)
    got = token_files.read_tokens(manifest).collect()
    rows = sorted(pairs(odd_docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at, want = 0, []
    for d, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    same_rows([tuple(r) for r in got], want)
    first = manifest.orderBy("part").first()
    assert token_files.document_ids(first.file + ".ids", first.width, 0, 1).tolist() == t.encode(rows[0][1] or "").ids[:1]
    assert token_files.read_tokens(token_files.write_tokens(no_docs, path)).count() == 0


def test_encoder_equals_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(queries.TOKENIZER)
    t, e = Tokenizer.from_file(path), token_files.Encoder(path)
    rng = np.random.default_rng(2)
    letters = ["a", "B", "é", "ß", "中", "😀", " ", "  ", "\n", "\t", "\r\n", "'s", "'LL", "1", "²", "!", ".", "<|endoftext|>", "<|", "\xa0", "\u2003",
               "\x1c", "\x85", "\u200b", "\u0301", "_", "\x00", "\x0b", "Ⅷ", "\u3000"]
    for n in range(3000):
        text = "".join(rng.choice(letters, n % 40))
        assert np.frombuffer(e.encode(text), e.dtype).tolist() == t.encode(text, add_special_tokens=False).ids, ascii(text)


def test_added_tokens_of_any_spelling(tmp_path):
    """A file whose added tokens do not look special: texts that hold one are encoded as the library does."""
    import public_tokenizers
    from tokenizers import AddedToken, Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    t.add_tokens([AddedToken("[SEP]", single_word=True), AddedToken(" the end", lstrip=True), "zq"])
    path = str(tmp_path / "added.json")
    t.save(path)
    e = token_files.Encoder(path)
    for text in ("a[SEP]b", "a [SEP] b [SEP]", "this is the end of it", "zqzq azqb", "[SEP", "plain text, the  end"):
        assert np.frombuffer(e.encode(text), e.dtype).tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_token_memory_is_bounded_and_left_after_the_task(odd_docs, monkeypatch):
    import public_tokenizers
    path = public_tokenizers.path(queries.TOKENIZER)
    monkeypatch.setattr(token_files, "REMEMBER", 5)
    e = token_files.Encoder(path)
    for text in ("one two three four", "five six seven", "eight"):
        e.encode(text)
    assert len(e.known) <= 5
    import pyarrow as pa

    token_files.encoder.cache_clear()
    folder = odd_docs.sparkSession.sparkContext.getCheckpointDir() or "/tmp"
    rows = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["one two"]})
    monkeypatch.setattr(token_files, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 0})())}))
    monkeypatch.setattr(token_files, "IDLE", 0.2)
    list(token_files._writer(path, folder, 0)(iter([rows])))
    assert token_files.encoder(path).known
    list(token_files._writer(path, folder, 0)(iter([rows])))  # a task that begins soon finds it, and puts off the end
    time.sleep(1)
    assert not token_files.encoder(path).known


def test_files_of_a_given_folder_are_read_from_there(odd_docs, tmp_path):
    import public_tokenizers
    path = public_tokenizers.path(queries.TOKENIZER)
    here = token_files.read_tokens(token_files.write_tokens(odd_docs, path, folder=f"file://{tmp_path}/tokens"))
    same_rows([tuple(r) for r in here.collect()], [tuple(r) for r in token_files.read_tokens(token_files.write_tokens(odd_docs, path)).collect()])
    assert any(p.suffix == ".ids" for p in (tmp_path / "tokens").iterdir())


def test_null_and_empty_item_ids_are_two_items(spark):
    words = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(None, words), ("", words), ("b", words[4:]), (None, words)], "item_id string, text string")
    docs = spark.createDataFrame([(1, "x " + words), (2, "nothing")], "doc_id long, text string")
    got = {r.doc_id: r["items"] for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {1: ["", "b", None], 2: []}
    con = duckdb.connect()
    documents, benchmark = docs.toPandas(), bench.toPandas()  # noqa: F841
    assert con.execute(f"SELECT doc_id, n_items FROM ({decontaminate.decontaminate_sql()}) ORDER BY doc_id").fetchall() == [(1, 3), (2, 0)]


def test_one_node_that_no_cut_separates_is_met_in_block_pairs(spark):
    """All fingerprints within two bits of each other's neighbours: no radius divides them, every pair shares a node."""
    fps = [0, *(1 << k for k in range(60))]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for leaf in (4, 7):
        nodes = {}
        for r in simhash_vptree._leaves(df, 2, leaf).collect():
            nodes.setdefault(r.node, set()).add(r.fp)
        assert max(map(len, nodes.values())) < len(fps)
        met = {(a, b) for members in nodes.values() for a in members for b in members}
        assert all((a, b) in met for a in fps for b in fps if bin(a ^ b).count("1") <= 2)


def test_operators_ship_their_code_themselves(spark):
    """Frames that no helper of the library made work too."""
    df = spark.createDataFrame([(1, "some words here and there"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([("a", "some words here and there")], "item_id string, text string")
    env, kept = spark.sparkContext.environment, spark.sparkContext.environment.pop("PYTHONPATH", None)
    try:
        for run in (lambda: exact_dedup.exact_dedup(df, F.col("doc_id") == 1), lambda: simhash_vptree.simhash_groups(df, 3, 2),
                    lambda: decontaminate.decontaminate(df, bench), lambda: decontaminate.clean_rows(df, bench)):
            env.pop("PYTHONPATH", None)
            run()
            assert env.get("PYTHONPATH")
    finally:
        if kept is not None:
            env["PYTHONPATH"] = kept


def test_old_shard_column_makes_way(odd_docs):
    out = kd_shards.sharded_rows(odd_docs.selectExpr("doc_id", "text", "'old' AS shard", "source AS `a.b`"), shards=4)
    assert out.columns == ["doc_id", "text", "a.b", "shard"] and {r.shard for r in out.collect()} <= set(range(4))


# ----------------------------------------------------------------- 10


def test_quotes_link_to_originals_and_go(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nIs it stable?"), (1, 1, "user", "Unrelated question"),
        (1, 2, "assistant", "Ann wrote:\n> Is it  STABLE?\nYes, it is."), (1, 3, "user", "> > Is it stable?\n> Yes, it is.\nThanks"),
        (1, 4, "user", "> never said\nHm"), (1, 5, "user", "> Hm"), (2, 0, "user", "> Is it stable?"), (None, None, None, None),
        (2, 1, None, ""), (2, 1, None, ""), (3, 0, "user", "> " * 20000 + "deep\nx"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS tree", "2 AS position")
    got = {(r.conv_id, r.turn, r.position): r for r in quote_threads.reply_order(df).collect()}
    assert len(got) == len(rows)
    order = [r.turn for k, r in sorted(got.items(), key=lambda x: str(x[0])) if r.conv_id == 1]
    by = {r.turn: r for r in got.values() if r.conv_id == 1}
    assert [t for _, t in sorted((r.position, r.turn) for r in by.values())] == [0, 2, 3, 1, 4, 5] and len(order) == 6
    assert (by[2].parent_turn, by[3].parent_turn, by[4].parent_turn, by[5].parent_turn) == (0, 2, None, 4)
    assert (by[2].text, by[3].text, by[5].text) == ("Yes, it is.", "Thanks", "")
    assert by[3].tree == 0 and by[3].quoted_lines == 2
    assert by[2].chat == "<|assistant|>\nYes, it is.\n<|end|>\n"
    assert quote_threads.reply_order(df.limit(0)).count() == 0
    # the twin, where roles of tied rows agree
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    want = con.execute(quote_threads.reply_order_sql()).fetchdf()
    names = quote_threads.reply_order(df).columns
    assert sorted(want.columns) == sorted(names)
    plain = lambda v: None if v is None or v != v else int(v) if isinstance(v, (float, np.integer)) else v
    same_rows([tuple(r[c] for c in names) for r in got.values()], [tuple(plain(r[c]) for c in names) for r in want.to_dict("records")])
