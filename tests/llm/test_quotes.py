"""Quotes that are wrapped anew, repeated or nested, against the DuckDB twin and a plain loop."""

import random

import duckdb
import numpy as np
import pytest

from runtally.llm import quote_threads

SCHEMA = "conv_id long, turn long, role string, text string"
LONG = ("The shipment left the harbour on Monday with forty crates of lamp oil, and the clerk has counted them twice before the gate "
        "was closed for the night by the two guards")


def wrap(text, width, mark="> "):
    words, out = text.split(), [""]
    for w in words:
        if len(out[-1]) + len(w) > width:
            out.append("")
        out[-1] = f"{out[-1]} {w}".strip()
    return "\n".join(mark + x for x in out)


def linked(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = quote_threads.reply_order(df)
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    want = con.execute(quote_threads.reply_order_sql()).fetchdf()
    plain = lambda v: None if v is None or v != v else int(v) if isinstance(v, (float, np.integer)) else v
    names = got.columns
    have = sorted((tuple(r) for r in got.collect()), key=str)
    assert have == sorted((tuple(plain(r[c]) for c in names) for r in want.to_dict("records")), key=str)
    return {(r.conv_id, r.turn): r for r in got.collect()}


@pytest.mark.parametrize("width", [30, 55, 400])
def test_rewrapped_quotes_link(spark, width):
    rows = [(1, 0, "user", f"Hello all.\n{LONG}\nBest"), (1, 1, "user", "Something else that nobody has asked for in this long thread of ours."),
            (1, 2, "assistant", "Ann wrote:\n" + wrap(LONG, width) + "\nAre you sure?"),
            (1, 3, "user", wrap(LONG, width, "> > ") + "\n> Are you sure?\nQuite sure."),
            (1, 4, "user", wrap(" ".join(LONG.split()[5:20]), width) + "\nOnly a part of it.")]
    got = linked(spark, rows)
    assert [got[1, k].parent_turn for k in range(5)] == [None, None, 0, 2, 0]
    assert got[1, 2].text == "Are you sure?" and got[1, 3].text == "Quite sure." and got[1, 3].tree == 0


def test_short_lines_go_to_the_nearest_earlier_message(spark):
    rows = [(1, 0, "user", "Yes"), (1, 1, "user", "No"), (1, 2, "user", "yes"), (1, 3, "user", "> Yes\nWhy?"), (1, 4, "user", "Yes"),
            (1, 5, "user", "> yes\n> no\nWhich?"), (1, 6, "user", "> never said\nHm"), (2, 0, "user", "> Yes\nFirst here"), (None, 0, "user", "Yes"),
            (None, 1, "user", "> yes\nok"), (1, None, "user", "> Yes"), (3, 5, "user", "a b\nc d"), (3, 6, "user", "> a b c d\ntwo lines as one")]
    got = linked(spark, rows)
    assert (got[1, 3].parent_turn, got[1, 5].parent_turn, got[1, 6].parent_turn, got[2, 0].parent_turn) == (2, 4, None, None)
    assert got[None, 1].parent_turn == 0 and got[1, None].parent_turn is None and got[3, 6].parent_turn == 5


def test_random_threads_match_the_twin(spark):
    rng = random.Random(5)
    words = "oak elm fir ash bay yew box tea rue hop".split()
    rows, said = [], {}
    for conv in range(12):
        said[conv] = []
        for turn in range(10):
            parts = []
            for _ in range(rng.randint(1, 3)):
                if said[conv] and rng.random() < 0.5:
                    quoted = rng.choice(said[conv])
                    parts.append(wrap(quoted, rng.choice((15, 40)), rng.choice(("> ", ">", ">> "))))
                else:
                    own = " ".join(rng.choices(words, k=rng.choice((2, 3, 12, 20))))
                    said[conv].append(own)
                    parts.append(wrap(own, rng.choice((25, 200)), ""))
            rows.append((conv, turn, "user", "\n".join(parts)))
    got = linked(spark, rows)
    assert sum(r.parent_turn is not None for r in got.values()) > 30


def test_a_line_quoted_very_often_makes_no_pairs(spark):
    """3000 messages that all say and quote one line: each quote goes to the message before."""
    rows = [(1, k, "user", "ok" if k == 0 else "> ok\nok") for k in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = quote_threads.link(df)
    assert found.filter("parent_turn = turn - 1 AND quoted_lines = 1").count() == 2999
