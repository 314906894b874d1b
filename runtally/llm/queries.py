"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtally.llm import (
    decontaminate, exact_dedup, fill_middle, html_extract, kd_shards, ordinal_quality, quote_threads, simhash_vptree, source_mix,
    suffix_dedup, token_files, url_templates, whitening,
)
from runtally.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The rules of op1, as given.
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
]
SHARDS = 8
SIMHASH_WIDTH = 3
SIMHASH_BITS = 2
TOKENIZER = "byte_bpe_50k.json"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


@register("op1_url_templates", url_templates.judge_urls_sql(URL_RULES))
def op1(spark, sf):
    return url_templates.judge_urls(table(spark, sf, "pages"), URL_RULES)


@register("op2_exact_dedup", """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256,
    coalesce(length(text), 0) AS n FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size,
    doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept, text_sha256 FROM t""")
def op2(spark, sf):
    # half of the table, by id hash, plays the stored snapshot, the other half the new batch
    stored = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    out = exact_dedup.exact_dedup(table(spark, sf, "documents"), stored)
    return out.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


@register("op3_source_mix", f"SELECT doc_id, size, source_size, target, taken FROM ({source_mix.mix_sql()})")
def op3(spark, sf):
    return source_mix.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op4_ordinal_quality")
def op4(spark, sf):
    docs = table(spark, sf, "documents")
    return ordinal_quality.score(docs, ordinal_quality.train(docs, table(spark, sf, "labels")))


@register("op5_kd_shards")
def op5(spark, sf):
    out = kd_shards.kd_shards(table(spark, sf, "documents"), shards=SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op6_simhash_vptree")
def op6(spark, sf):
    out = simhash_vptree.simhash_groups(table(spark, sf, "documents"), SIMHASH_WIDTH, SIMHASH_BITS)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op7_suffix_dedup")
def op7(spark, sf):
    return suffix_dedup.suffix_dedup(table(spark, sf, "documents"))


@register("op8_decontaminate", decontaminate.decontaminate_sql())
def op8(spark, sf):
    out = decontaminate.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    n_hit = F.size("hits").cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@register("op9_token_files")
def op9(spark, sf):
    import public_tokenizers

    manifest = token_files.write_tokens(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))
    return token_files.read_tokens(manifest)


@register("op10_quote_threads", quote_threads.reply_order_sql())
def op10(spark, sf):
    return quote_threads.reply_order(table(spark, sf, "conversations"))


@register("op11_html_main_text")
def op11(spark, sf):
    pages = table(spark, sf, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


@register("op12_fill_middle", fill_middle.fill_in_middle_sql())
def op12(spark, sf):
    out = fill_middle.fill_in_middle(table(spark, sf, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@register("op13_whitening")
def op13(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))
