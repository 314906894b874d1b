"""URL filter by a path-template tree (DataFrame functions only).

Every URL becomes a path in a tree per host, one level a segment, however deep.
The tree is learned from the pages themselves:

1. *Generalise.* A segment that holds a digit is a wildcard. Then, level by
   level from the top, a node whose children are nearly all different (at least
   ``MIN_FANOUT`` of them, under ``REPEATS`` pages each) gets one wildcard child.
   Levels end where no node has ``MIN_FANOUT`` different paths below it any more.
2. *Merge.* Level by level from the bottom, siblings that agree in every other
   segment and whose share of blocked pages falls into the same fifth are pooled,
   unless a sibling lies over ``Z`` standard errors off its pool. Siblings
   without labelled pages only pool with each other: no evidence is borrowed.
   Levels at which no two paths of a host part are left out.
3. *Reject.* A template is blocked if it has ``MIN_LABELLED`` labelled pages and
   its smoothed purity (blocked + 1) / (labelled + 2) reaches ``PURITY``.

Labels are the verdicts of the given rules; a rule always decides its own pages.

Only counts per (host, lexical template) are shuffled for learning, combined
before the shuffle, and each level's table is kept, as every level reads the one
before twice; pages meet their template in one join that Spark may split
where a host is hot. A level costs one small job, so the driver loops over as many
levels as the paths of a host share.

Defined cases: a null url, or one without ``://``, has an empty host and path and
is allowed unless its template is rejected; repeated rows each get a verdict; an
empty table gives an empty result; only ``page_id`` and ``url`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtally.llm.common import ascii_lower, materialise

MIN_FANOUT = 8
REPEATS = 2
Z = 2.0
MIN_LABELLED = 5
PURITY = 0.8
WILD = "*"
SQL_LEVELS = 10  # levels that the DuckDB twin spells out; the tree has no such bound


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (between ``://`` and the next ``/ ? #``, A-Z lowered) and path."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(host), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _parsed(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    parts = F.transform(F.filter(F.split("path", "/"), lambda x: x != ""),
                        lambda x: F.when(x.rlike("[0-9]"), F.lit(WILD)).otherwise(x))
    return p.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), parts.alias("lexical"))


def _before(k: int) -> Column:
    """The segments above level ``k`` (from 1)."""
    return F.slice("seg", 1, k - 1)


def _with_segment(k: int, value: Column) -> Column:
    """The segments with another one at level ``k``."""
    return F.concat(_before(k), F.array(value), F.slice("seg", F.lit(k + 1), F.greatest(F.size("seg") - k, F.lit(0))))


def _generalise(t: DataFrame) -> DataFrame:
    k = 1
    while True:
        here = F.get("seg", F.lit(k - 1))
        deep = t.filter(F.size("seg") >= k).select("host", _before(k).alias("above"), here.alias("child"), "n")
        nodes = deep.groupBy("host", "above").count().filter(F.col("count") >= MIN_FANOUT)
        if nodes.isEmpty():
            return t
        children = deep.filter(F.col("child") != WILD).groupBy("host", "above", "child").agg(F.sum("n").alias("m"))
        wide = (children.groupBy("host", "above").agg(F.count(F.lit(1)).alias("d"), F.sum("m").alias("m"))
                .filter((F.col("d") >= MIN_FANOUT) & (F.col("m") < REPEATS * F.col("d")))
                .select("host", "above", F.lit(True).alias("wide")))
        # a path that ends above this level has no node here
        t = t.withColumn("above", F.when(F.size("seg") >= k, _before(k)))
        t = materialise(t.join(wide, ["host", "above"], "left").withColumn(
            "seg", F.when(F.col("wide"), _with_segment(k, F.lit(WILD))).otherwise(F.col("seg"))).drop("wide", "above"))
        k += 1


def _parting_levels(t: DataFrame) -> list[int]:
    """Levels, deepest first, at which paths of one host and length part that agree above."""
    above = F.transform(F.sequence(F.lit(1), F.size("seg")), lambda k: F.xxhash64(F.slice("seg", F.lit(1), k - 1)))
    each = t.filter(F.size("seg") > 0).select("host", F.size("seg").alias("long"), F.posexplode(F.arrays_zip(above.alias("above"), F.col("seg"))).alias("at", "x"))
    each = each.select("host", "long", "at", "x.above", "x.seg").filter(F.col("seg") != WILD)
    parted = each.groupBy("host", "long", "at", "above").agg(F.min("seg").alias("a"), F.max("seg").alias("b")).filter("a <> b")
    return sorted((r.at + 1 for r in parted.select("at").distinct().collect()), reverse=True)


def _merge(t: DataFrame) -> DataFrame:
    for k in _parting_levels(t):
        here = F.get("seg", F.lit(k - 1))
        share = F.col("blocked") / F.col("labelled")
        nodes = (t.filter((F.size("seg") >= k) & (here != WILD)).groupBy("host", "seg")
                 .agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
                 .withColumn("fifth", F.when(F.col("labelled") > 0, F.floor(5 * share)).otherwise(F.lit(-1)))
                 .withColumn("others", _with_segment(k, F.lit(""))))
        pools = (nodes.groupBy("host", "others", "fifth")
                 .agg(F.sum("labelled").alias("pl"), F.sum("blocked").alias("pb"), F.count(F.lit(1)).alias("members"))
                 .filter("members > 1"))
        mean = F.col("pb") / F.col("pl")
        near = (F.col("labelled") == 0) | (
            F.abs(share - mean) <= Z * F.sqrt(F.greatest(mean * (1 - mean), F.lit(0.01)) / F.col("labelled")))
        joined = nodes.join(pools, ["host", "others", "fifth"]).filter(near).select(
            "host", "seg", F.concat(F.lit("+"), F.col("fifth").cast("string")).alias("pooled"))
        t = materialise(t.join(joined, ["host", "seg"], "left").withColumn(
            "seg", F.when(F.col("pooled").isNotNull(), _with_segment(k, F.col("pooled"))).otherwise(F.col("seg"))).drop("pooled"))
    return t


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, labelled, purity.

    ``rules``: (allow or block, ``host/path-prefix``) pairs, few and given by the
    caller; a rule also fits all subdomains of its host, the longest one wins.
    """
    p = _parsed(pages, rules)
    counts = p.groupBy("host", "lexical").agg(
        F.count(F.lit(1)).alias("n"), F.count("ruled").alias("labelled"),
        F.coalesce(F.sum((F.col("ruled") == "block").cast("long")), F.lit(0)).alias("blocked"))
    t = materialise(counts).withColumn("seg", F.col("lexical"))
    t = _merge(_generalise(t))
    scored = t.groupBy("host", "seg").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    scored = scored.select("host", "seg", "labelled", ((F.col("blocked") + 1.0) / (F.col("labelled") + 2.0)).alias("purity"))
    named = t.drop("n", "labelled", "blocked").join(scored, ["host", "seg"]).select(
        "host", "lexical", "labelled", "purity", F.concat(F.lit("/"), F.array_join("seg", "/")).alias("template"))
    rejected = (F.col("labelled") >= MIN_LABELLED) & (F.col("purity") >= PURITY)
    learned = F.when(rejected, F.lit("block")).otherwise(F.lit("allow"))
    return p.join(named, ["host", "lexical"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "template", "labelled", "purity")


def judge_urls_sql(rules: list[tuple[str, str]], table: str = "pages") -> str:
    """The same result as DuckDB SQL, for paths of at most ``SQL_LEVELS`` segments."""
    rule, verdict = "NULL", "NULL"
    for action, text in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = text.partition("/")
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')"
        rule, verdict = f"CASE WHEN {fits} THEN '{text}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{action}' ELSE {verdict} END"
    ctes = [f"""a AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM {table})""",
            f"""b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM a)""",
            f"""c AS (SELECT *, {rule} AS rule, {verdict} AS ruled, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''),
                lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{WILD}' ELSE x END) AS lexical FROM b)""",
            """t0 AS MATERIALIZED (SELECT host, lexical, count(*) AS n, count(ruled) AS labelled, coalesce(sum((ruled = 'block')::INT), 0) AS blocked,
                lexical AS seg FROM c GROUP BY host, lexical)"""]
    last = "t0"
    changed = lambda k, value: f"list_concat(t.seg[1:{k - 1}], [{value}], t.seg[{k + 1}:])"
    for k in range(1, SQL_LEVELS + 1):
        ctes += [f"w{k} AS MATERIALIZED (SELECT host, above FROM (SELECT host, seg[1:{k - 1}] AS above, seg[{k}] AS child, sum(n) AS m FROM {last} "
                 f"WHERE len(seg) >= {k} AND seg[{k}] <> '{WILD}' GROUP BY ALL) GROUP BY host, above "
                 f"HAVING count(*) >= {MIN_FANOUT} AND sum(m) < {REPEATS} * count(*))",
                 f"""g{k} AS MATERIALIZED (SELECT t.* REPLACE (CASE WHEN w.host IS NOT NULL THEN {changed(k, f"'{WILD}'")} ELSE t.seg END AS seg) """
                 f"FROM {last} t LEFT JOIN w{k} w ON t.host = w.host AND len(t.seg) >= {k} AND t.seg[1:{k - 1}] = w.above)"]
        last = f"g{k}"
    for k in range(SQL_LEVELS, 0, -1):
        ctes += [f"n{k} AS MATERIALIZED (SELECT *, CASE WHEN labelled > 0 THEN floor(5 * (blocked / labelled))::BIGINT ELSE -1 END AS fifth, "
                 f"""{changed(k, "''")} AS others FROM (SELECT host, seg, sum(labelled) AS labelled, sum(blocked) AS blocked FROM {last} """
                 f"WHERE len(seg) >= {k} AND seg[{k}] <> '{WILD}' GROUP BY host, seg) t)",
                 f"q{k} AS MATERIALIZED (SELECT host, others, fifth, sum(labelled) AS pl, sum(blocked) AS pb FROM n{k} GROUP BY host, others, fifth HAVING count(*) > 1)",
                 f"j{k} AS MATERIALIZED (SELECT x.host, x.seg, '+' || x.fifth::VARCHAR AS pooled FROM n{k} x JOIN q{k} q ON x.host = q.host AND x.others = q.others "
                 f"AND x.fifth = q.fifth WHERE labelled = 0 OR abs(blocked / labelled - pb / pl) <= {Z} * sqrt(greatest((pb / pl) * (1 - pb / pl), 0.01) / labelled))",
                 f"m{k} AS MATERIALIZED (SELECT t.* REPLACE (CASE WHEN j.pooled IS NOT NULL THEN {changed(k, 'j.pooled')} ELSE t.seg END AS seg) "
                 f"FROM {last} t LEFT JOIN j{k} j ON t.host = j.host AND t.seg = j.seg)"]
        last = f"m{k}"
    ctes += [f"scored AS (SELECT host, seg, sum(labelled)::BIGINT AS labelled, (sum(blocked) + 1.0::DOUBLE) / (sum(labelled) + 2.0::DOUBLE) AS purity FROM {last} GROUP BY host, seg)",
             f"named AS (SELECT t.host, t.lexical, s.labelled, s.purity, '/' || array_to_string(t.seg, '/') AS template FROM {last} t "
             "JOIN scored s ON t.host = s.host AND t.seg = s.seg)"]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT p.page_id, p.host, p.path, p.rule, coalesce(p.ruled, CASE WHEN m.labelled >= {MIN_LABELLED} AND m.purity >= {PURITY} THEN 'block' ELSE 'allow' END) AS verdict,
       m.template, m.labelled, m.purity FROM c p LEFT JOIN named m ON p.host = m.host AND p.lexical = m.lexical"""
