"""Fill-in-middle against a plain loop over units."""

import hashlib
import re

from pyspark.sql import functions as F

from runtally.llm import fill_middle, queries


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(units), sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    spm = h4 % 100 < 20
    return doc_id, n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def check(df):
    out = fill_middle.fill_in_middle(df)
    got = [tuple(r) for r in out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()]
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert sorted(got, key=repr) == sorted((brute(*r) for r in rows), key=repr)
    back = [(r.doc_id, r.back) for r in out.select("doc_id", fill_middle.restore(F.col("output"), F.col("form")).alias("back")).collect()]
    assert sorted(back, key=repr) == sorted(((d, t or "") for d, t in rows), key=repr)


def test_odd_documents(odd_docs, no_docs):
    check(odd_docs)
    assert fill_middle.fill_in_middle(no_docs).count() == 0


def test_sentinels_groups_and_code_points(spark):
    texts = ["<P>x", "a<S>", "<M>", "<P", "P>", "<<P", "$1 \\2 ${3}", "\\E\\Q{2}+", "\U0001f600a\U0001f600 b", "line\r\nline x\x00y", "<S", "<P><S><M>", "a<", "<"]
    check(spark.createDataFrame([(k, t) for k in range(100, 160) for t in texts], "doc_id long, text string"))


def test_very_long_texts_need_no_stack(spark):
    rows = [(1, "ab, " * 400_000), (2, "x" * 2_000_000), (3, "é" * 1_000_000), (6, " " * 1_000_000)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_stays_in_the_jvm_without_exchange(spark, sf_dir):
    plan = queries.QUERIES["op12_fill_middle"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
