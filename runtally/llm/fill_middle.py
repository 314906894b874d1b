"""Fill-in-middle transformation by a counted-quantifier regular expression.

A text is a run of units (``UNIT``: a word of ASCII letters, or any other code point).
``regexp_count`` gives their number n; two cuts a <= b are hashed from doc_id; the row's
own pattern

    \\A (unit{a} possessive) (unit{b-a} possessive) (the rest) \\z

captures prefix, middle and suffix, and one ``regexp_replace`` with that pattern puts them
in the order of the row's form. Possessive groups are matched in a loop and keep no way
back, so a text of any length needs neither stack nor memory per unit. Everything is a
column expression: no shuffle, no Python; a lost task is simply run again.

Forms: ``plain`` (the text as it is: it is empty, holds a sentinel, or its hash says so),
``psm`` (<P>prefix<S>suffix<M>middle) and ``spm`` (<S>suffix<P>prefix<M>middle). As texts
with sentinels stay plain, and no sentinel overlaps itself or another, the sentinels in an
output are found without doubt; ``restore`` reads the text back from output and form alone.

Defined cases: a null text is an empty one; a null doc_id is hashed as no digits; repeated
rows give equal rows; a document whose cuts are equal, 0 or n has empty parts; an empty
table gives an empty result; only ``doc_id`` and ``text`` are read, other columns of any name
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = "[A-Za-z]++|[^A-Za-z]"
PLAIN_PERCENT = 10  # of the documents stay plain
SPM_PERCENT = 20  # of the others start with their suffix


def _draw(digest: Column, k: int) -> Column:
    """The k-th 8-digit group (from 0) of a hex digest as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _captures(first: Column, second: Column) -> Column:
    """Pattern whose groups 1 to 3 are the first units, the second units and the rest of a text."""
    return F.concat(F.lit(f"(?s)\\A((?:{UNIT}){{"), first.cast("string"), F.lit(f"}}+)((?:{UNIT}){{"), second.cast("string"), F.lit("}+)(.*+)\\z"))


def fill_in_middle(docs: DataFrame, seed: str = "1") -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars (null if plain), output."""
    text, a, b = F.col("text"), F.col("a"), F.col("b")
    d = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.select("doc_id", "text", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"),
                 F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256).alias("digest"))
    cuts = [F.pmod(_draw(F.col("digest"), k), F.col("n") + 1) for k in (0, 1)]
    marked = F.lit(False)
    for s in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(s))
    plain = (text == "") | marked | (_draw(F.col("digest"), 2) % 100 >= 100 - PLAIN_PERCENT)
    form = F.when(plain, "plain").when(_draw(F.col("digest"), 3) % 100 < SPM_PERCENT, "spm").otherwise("psm")
    d = d.select("doc_id", "text", "n", F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"), form.alias("form"))
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    d = d.select("doc_id", "n", "form", F.when(F.col("form") == "plain", text).otherwise(
        F.regexp_replace(text, _captures(a, b - a), order)).alias("output"))
    at = {s: F.locate(s, F.col("output")) for s in (PREFIX, SUFFIX, MIDDLE)}
    ends = F.when(F.col("form") == "psm", at[SUFFIX]).otherwise(at[MIDDLE])  # the sentinel after the prefix
    parted = F.col("form") != "plain"
    return d.select("doc_id", "n", "form", F.when(parted, ends - at[PREFIX] - len(PREFIX)).cast("long").alias("prefix_chars"),
                    F.when(parted, F.length("output") - at[MIDDLE] - len(MIDDLE) + 1).cast("long").alias("middle_chars"), "output")


def restore(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form alone."""
    def read(first: str, second: str, order: str) -> Column:
        return F.regexp_replace(output, F.lit(f"(?s)\\A{first}(.*?){second}(.*?){MIDDLE}(.*+)\\z"), F.lit(order))

    return F.when(form == "psm", read(PREFIX, SUFFIX, "$1$3$2")).when(form == "spm", read(SUFFIX, PREFIX, "$2$3$1")).otherwise(output)


def fill_in_middle_sql() -> str:
    """DuckDB twin of the digest query: lists of units in place of patterns."""
    draws = ", ".join(f"('0x' || substr(digest, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
u AS (SELECT doc_id, text, units, len(units)::BIGINT AS n, {draws} FROM t),
v AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
w AS (SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
    array_to_string(units[b + 1:n], '') AS s FROM v)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
        ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
    sha256(text) AS restored_sha256 FROM w"""
