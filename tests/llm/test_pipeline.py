"""The pipeline's stages against what their operators say, on the driver tables and on odd rows."""

from collections import Counter

import corpus_pipeline as P
from pyspark.sql import functions as F

from runtally.llm import ordinal_quality, source_mix
from runtally.llm.common import table
from runtally.llm.queries import SHARDS
from test_operators import brute_components, brute_hits, brute_simhash, pairs


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources", "sharding"]


def test_stages_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    one = P.quality(spark, docs, sf_dir)
    assert one.columns == docs.columns
    model = ordinal_quality.train(docs, table(spark, sf_dir, "labels"))
    p = ordinal_quality.tails_of([t for _, t in pairs(docs)], model)
    kept = [d for (d, _), k in zip(pairs(docs), ordinal_quality.stays(p[:, 0], p[:, 1])) if k]
    assert sorted(kept) == sorted(r.doc_id for r in one.collect())

    two = P.near_duplicates(spark, one, sf_dir)
    rows = pairs(one)
    least = brute_components([brute_simhash(t, 3) for _, t in rows], [d for d, _ in rows], 2)
    assert two.columns == docs.columns and sorted(r.doc_id for r in two.collect()) == sorted(set(least))

    three = P.benchmarks(spark, two, sf_dir)
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    clean = [d for d, _, hit, *_ in brute_hits(pairs(two), items) if not hit]
    assert three.columns == docs.columns and sorted(r.doc_id for r in three.collect()) == sorted(clean)

    four = P.mix(spark, three, sf_dir)
    times = Counter(r.doc_id for r in four.collect())
    assert four.columns == docs.columns
    for r in source_mix.mix(three).collect():
        assert times[r.doc_id] * r.size == r.taken

    five = P.shards(spark, four, sf_dir)
    assert five.columns == [*docs.columns, "shard"]
    assert Counter(r.doc_id for r in five.collect()) == times
    assert {r.shard for r in five.collect()} <= set(range(SHARDS))


def test_run_equals_its_stages(spark, sf_dir):
    out = P.run(spark, sf_dir)
    assert out.count() > 0 and out.columns[-1] == "shard"


def test_odd_rows_pass_every_stage(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in P.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.columns[:len(docs.columns)] == docs.columns
            assert out.select(F.count(F.lit(1))).first()[0] >= 0


def test_one_row_of_each_near_duplicate_group_stays(spark, sf_dir, odd_docs):
    docs = odd_docs.filter("doc_id IS NULL OR doc_id <> 11").unionByName(odd_docs.filter("doc_id = 11"))
    docs = docs.unionByName(docs.filter("doc_id = 9").selectExpr("doc_id", "'quite another text of id nine' AS text", *docs.columns[2:]))
    out = P.near_duplicates(spark, docs, sf_dir)
    assert out.columns == docs.columns
    # numbers by (doc_id, null last; text) name the rows
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.text is not None, r.text or "") for r in docs.collect()))
    least = brute_components([brute_simhash(r[3], 3) for r in rows], list(range(len(rows))), 2)
    want = Counter((rows[k][1] or None, rows[k][3]) for k in set(least))
    assert Counter((r.doc_id, r.text or "") for r in out.collect()) == want
    assert max(want.values()) == 1 and sum(1 for d, _ in want if d == 9) == 2


def test_mix_sends_thresholds_to_the_rows(spark, sf_dir, monkeypatch):
    """Whole documents are not shuffled by source; with many sources they are dealt over parts of each."""
    docs = table(spark, sf_dir, "documents")
    plan = source_mix.mixed_rows(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    few = sorted(r.doc_id for r in source_mix.mixed_rows(docs).select("doc_id").collect())
    monkeypatch.setattr(source_mix, "SENT_SOURCES", 0)
    assert sorted(r.doc_id for r in source_mix.mixed_rows(docs).select("doc_id").collect()) == few
