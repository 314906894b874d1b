"""Chat formatting by quotation linking.

Messages (conv_id, turn, role, text) are parsed line by line: leading ``>`` marks
give the quote level, what follows is the line. Neighbouring lines of one level make a
passage (level 0: the message's own). Passages are normalised (lower case, white space and
quote marks collapsed) and hashed: those of ``WORDS`` words or more by every run of
``WORDS`` words, so a quote that is wrapped anew, cut short or joined meets its original;
shorter ones as a whole and line by line. Quoted hashes are joined to own ones of the same
conversation, each to the nearest earlier message that wrote it. The message that a reply
quotes most (level 1 first, then deeper levels; later messages win ties) is its parent.
Replies hang on their parents, everything else on the conversation's main line.

Conversations are returned in reply order: messages of one reply tree stand
together, trees by their first message, and inside a tree a message follows what
it answers. Quotes, and the line that introduces them, are taken out of the text;
``chat`` holds the message between role marks.

Only conversations that hold a quote are hashed. The nearest earlier writer of a hash comes
from one pass over both sides in order, cut into segments of about equal size, so a line that
is written and quoted a million times makes neither pairs nor a task of its own. Roots come
from pointer doubling; places from counts per task, so a conversation may hold any share
of the rows.

Defined cases: a null text is empty; a message of quotes alone gets an empty
text; quotes without an original link to nothing; a quote of a later or the same
message links to nothing; equal (conv_id, turn) rows are kept, linked alike and
ordered by text; null conv_ids form one conversation, null turns stand first and
link to nothing; an empty table gives an empty result; only the four columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtally.llm.common import materialise, number_rows
from runtally.operators.segmented import fill_down_segmented

WORDS = 8  # of the runs by which long passages are known
MARKS = r"^[ \t]*>[> \t]*"
INTRODUCES = r"(?i)(?:wrote|writes|schrieb|escribió|a écrit)[ \t]*:[ \t]*$"


def _lines(text: Column) -> Column:
    """Array of (level, line) from the text."""
    def parse(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        return F.struct(F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), F.regexp_replace(line, MARKS, "").alias("line"))
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), parse)


def _own_text(lines: Column) -> Column:
    """The text without quotes and without lines that introduce one."""
    def stays(x: Column, k: Column) -> Column:
        after = F.coalesce(F.get(lines, k + 1)["level"], F.lit(0))
        return (x["level"] == 0) & ~((after > 0) & x["line"].rlike(INTRODUCES))
    own = F.filter(lines, stays)
    return F.trim(F.array_join(F.transform(own, lambda x: x["line"]), "\n"))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\s>]+", " "))


def _passages(lines: Column) -> Column:
    """Array of (level, lines) of the runs of one level; ``lines`` without blank ones."""
    last = F.size(lines) - 1
    starts = F.filter(F.when(last >= 0, F.sequence(F.lit(0), last)),
                      lambda k: (k == 0) | (F.get(lines, k)["level"] != F.get(lines, k - 1)["level"]))

    def run(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(starts, k + 1), F.size(lines))
        return F.struct(F.get(lines, start)["level"].alias("level"),
                        F.transform(F.slice(lines, start + 1, end - start), lambda x: _normal(x["line"])).alias("lines"))
    return F.transform(starts, run)


def _hashes(lines: Column, words: Column) -> Column:
    """What a passage is known by: its word runs, or if it is short itself and its lines."""
    whole = F.array_join(words, " ")
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - WORDS + 1), lambda k: F.xxhash64(F.array_join(F.slice(words, k, WORDS), " "), F.lit("run")))
    short = F.array_append(F.transform(lines, lambda x: F.xxhash64(x)), F.xxhash64(whole))
    return F.array_distinct(F.when(F.size(words) >= WORDS, runs).otherwise(short))


def link(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, quoted_lines) of the messages that quote an earlier one; ``quoted_lines`` counts hashes that met."""
    parsed = messages.select("conv_id", "turn", F.filter(_lines(F.col("text")), lambda x: x["line"].rlike(r"\S")).alias("lines"))
    quoting = parsed.filter(F.exists("lines", lambda x: x["level"] > 0)).select(F.col("conv_id").alias("q")).distinct()
    parsed = parsed.join(quoting, parsed["conv_id"].eqNullSafe(quoting["q"]), "left_semi")
    parts = parsed.select("conv_id", "turn", F.explode(_passages(F.col("lines"))).alias("x")).select("conv_id", "turn", "x.level", "x.lines")
    parts = parts.withColumn("words", F.filter(F.split(F.array_join("lines", " "), " "), lambda w: w != ""))
    # an own line may be quoted alone, so own passages of any length are known by their lines too
    own_lines = F.transform("lines", lambda x: F.xxhash64(x))
    known = F.when(F.col("level") == 0, F.array_union(_hashes(F.col("lines"), F.col("words")), own_lines)).otherwise(_hashes(F.col("lines"), F.col("words")))
    parts = parts.select("conv_id", "turn", "level", F.explode(known).alias("hash")).filter("turn IS NOT NULL")
    # one row for each side of a hash in a message; quotes stand before the message's own text, which they cannot mean
    sides = parts.groupBy("conv_id", "hash", "turn", (F.col("level") == 0).cast("int").alias("own")).agg(F.min("level").alias("level"))
    sides = sides.withColumn("source", F.when(F.col("own") == 1, F.col("turn")))
    near = fill_down_segmented(sides, ["conv_id", "hash"], ["turn", "own"], ["source"]).filter("own = 0 AND source IS NOT NULL")
    votes = near.groupBy("conv_id", "turn", "source").agg(
        F.sum((F.col("level") == 1).cast("long")).alias("direct"), F.count(F.lit(1)).alias("all"))
    return votes.groupBy("conv_id", "turn").agg(
        F.max_by("source", F.struct("direct", "all", "source")).alias("parent_turn"),
        F.sum("all").alias("quoted_lines"))


def roots(links: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, quoted_lines, top): the topmost message above each reply."""
    at = materialise(links.withColumn("top", F.col("parent_turn")))
    while True:
        up = at.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("top").alias("higher"))
        on = at["conv_id"].eqNullSafe(F.col("c")) & (at["top"] == F.col("t"))
        moved = materialise(at.join(up, on, "left").drop("c", "t"))
        at = moved.withColumn("top", F.coalesce("higher", "top")).drop("higher")
        if moved.filter(F.col("higher").isNotNull()).isEmpty():
            return at


def reply_order(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, position, turn, role, parent_turn, tree, quoted_lines, text, chat."""
    m = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text"))
    found = roots(link(m))
    f = found.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "parent_turn", "quoted_lines", "top")
    linked = m.join(f, m["conv_id"].eqNullSafe(F.col("c")) & (m["turn"] == F.col("t")), "left")
    linked = linked.withColumn("lines", _lines(F.col("text")))
    own = _own_text(F.col("lines"))
    linked = linked.select("conv_id", "turn", "role", "parent_turn", F.coalesce("top", "turn").alias("tree"),
                           F.coalesce("quoted_lines", F.lit(0)).alias("quoted_lines"), own.alias("text"))
    placed = number_rows(linked, ["conv_id"], ["tree", "turn", "text"], "position")
    mark = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n"))
    return placed.select("conv_id", "position", "turn", "role", "parent_turn", "tree", "quoted_lines", "text", mark.alias("chat"))


def reply_order_sql(table: str = "conversations") -> str:
    """The same result as DuckDB SQL: texts instead of their hashes, roots by recursion."""
    return f"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS rid, conv_id, turn::BIGINT AS turn, role,
    regexp_split_to_array(coalesce(text, ''), '\r?\n') AS raw FROM {table}),
u AS (SELECT rid, conv_id, turn, unnest(raw) AS line, unnest(range(len(raw))) AS k FROM m),
l AS (SELECT rid, conv_id, turn, k, regexp_replace(line, '{MARKS}', '') AS line,
    length(regexp_replace(regexp_extract(line, '{MARKS}'), '[^>]', '', 'g')) AS level FROM u),
p AS (SELECT rid, conv_id, turn, k, level, trim(regexp_replace(lower(line), '[ \t\n\x0B\f\r>]+', ' ', 'g'), ' ') AS norm
    FROM l WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]')),
e AS (SELECT *, coalesce(level <> lag(level) OVER (PARTITION BY rid ORDER BY k), false)::INT AS edge FROM p),
g AS (SELECT *, sum(edge) OVER (PARTITION BY rid ORDER BY k ROWS UNBOUNDED PRECEDING) AS run FROM e),
a AS (SELECT rid, conv_id, turn, level, run, list(norm ORDER BY k) AS lines,
    list_filter(string_split(string_agg(norm, ' ' ORDER BY k), ' '), lambda w: w <> '') AS words FROM g GROUP BY rid, conv_id, turn, level, run),
h AS (SELECT conv_id, turn, level, 'run ' || array_to_string(words[k:k + {WORDS} - 1], ' ') AS unit
        FROM (SELECT *, unnest(range(1, len(words) - {WORDS} + 2)) AS k FROM a WHERE len(words) >= {WORDS})
    UNION ALL SELECT conv_id, turn, level, 'text ' || array_to_string(words, ' ') FROM a WHERE len(words) < {WORDS}
    UNION ALL SELECT conv_id, turn, level, 'text ' || unnest(lines) FROM a WHERE len(words) < {WORDS} OR level = 0),
own AS (SELECT DISTINCT conv_id, unit, turn AS source FROM h WHERE level = 0),
quoted AS (SELECT conv_id, turn, unit, min(level) AS level FROM h WHERE level > 0 GROUP BY conv_id, turn, unit),
near AS (SELECT q.conv_id, q.turn, q.unit, level, max(source) AS source FROM quoted q JOIN own o
    ON q.conv_id IS NOT DISTINCT FROM o.conv_id AND q.unit = o.unit WHERE source < q.turn GROUP BY ALL),
votes AS (SELECT conv_id, turn, source, count(*) FILTER (WHERE level = 1) AS direct, count(*) AS n FROM near GROUP BY ALL),
links AS (SELECT conv_id, turn, source AS parent_turn, sum(n) OVER (PARTITION BY conv_id, turn)::BIGINT AS quoted_lines FROM votes
    QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY direct DESC, n DESC, source DESC) = 1),
climb AS (SELECT conv_id, turn, parent_turn AS top FROM links
    UNION ALL SELECT c.conv_id, c.turn, l.parent_turn FROM climb c JOIN links l ON c.conv_id IS NOT DISTINCT FROM l.conv_id AND c.top = l.turn),
tops AS (SELECT conv_id, turn, min(top) AS top FROM climb GROUP BY conv_id, turn),
stays AS (SELECT *, level = 0 AND NOT (coalesce(lead(level) OVER (PARTITION BY rid ORDER BY k), 0) > 0
    AND regexp_matches(line, '{INTRODUCES}')) AS stay FROM l),
texts AS (SELECT rid, trim(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE stay), ''), ' ') AS text FROM stays GROUP BY rid),
r AS (SELECT m.conv_id, m.turn, role, parent_turn, coalesce(top, m.turn) AS tree, coalesce(quoted_lines, 0)::BIGINT AS quoted_lines, text
    FROM m JOIN texts USING (rid)
    LEFT JOIN links ON m.conv_id IS NOT DISTINCT FROM links.conv_id AND m.turn = links.turn
    LEFT JOIN tops ON m.conv_id IS NOT DISTINCT FROM tops.conv_id AND m.turn = tops.turn)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY tree NULLS FIRST, turn NULLS FIRST, text) - 1 AS position, turn, role,
    parent_turn, tree, quoted_lines, text,
    '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS chat FROM r"""
