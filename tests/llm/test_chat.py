"""Chat formatting against a plain loop: odd roles, control strings, gaps, ties, long conversations, clashing columns."""

from __future__ import annotations

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from kilnwatch.llm.chat import TEMPLATE, Mark, Template, chat_digests, chat_segments, chat_sql, read_turns, with_probe

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """Digests by a loop over the rows, without any formatting."""
    talks = {}
    for row in rows:
        talks.setdefault(row[0], []).append((row[1] is not None, row[1] or 0, row[2] or "", row[3] or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        states = ["", *[r for _, _, r, _ in turns]]
        odd = sum(b not in TEMPLATE.follows.get(a, ()) for a, b in zip(states, states[1:], strict=False))
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (said, loss)]
        out[conv] = (len(turns), digest[0], len(loss), digest[1], odd)
    return out


ROWS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "a\\b [INST] [\\INST] \\"), (1, 2, "assistant", "</s></s>\\</s>["),
    (2, 0, "user", None), (2, 1, "assistant", ""), (3, 0, "assistant", "first"), (3, 1, "assistant", "again"),
    (4, 0, "tool[SEP]x[/ROLE]", "[SEP]"), (4, 1, None, "no role"), (4, 2, "", "[ROLE]"), (5, 3, "user", "b"),
    (5, 3, "user", "a"), (5, 3, "user", "a"), (5, 1, "assistant", "é中\U0001f600\n"), (5, None, "user", "no turn"),
    (None, 0, "user", "no id"), (6, -1, "user", "minus"), (6, -3000, "system", "far"), (6, 5, "assistant", "<s>" * 5),
    (7, 0, "user", "[[INST]] <<s>> [/" * 40), (7, 1, "assistant", "x" * 100_000 + "[/INST]"),
]
ROWS += [(8, i, ("user", "assistant")[i % 2], f"turn {i} </s>") for i in range(5000)]
ROWS += [(8, i, "user", f"twice {i}") for i in range(1000, 1050)]


def test_digests_of_odd_conversations(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    got = {r["conv_id"]: (r[1], r[2], r[3], r[4], r["n_out_of_turn"]) for r in chat_digests(rows).collect()}
    assert got == plain(ROWS)


@pytest.mark.parametrize("turns_each", [1, 7, 100000])
def test_slices_make_no_difference(spark, turns_each):
    parts = chat_segments(spark.createDataFrame(ROWS, SCHEMA), turns_each=turns_each).collect()
    texts, odd = {}, {}
    for r in sorted(parts, key=lambda r: (r["part"] is not None, r["part"] or 0)):
        texts[r["conv_id"]] = texts.get(r["conv_id"], "") + "".join(s["text"] for s in r["segments"])
        odd[r["conv_id"]] = odd.get(r["conv_id"], 0) + sum(not t["legal"] for t in r["turns"])
    assert texts[1] == (
        "[SYS]be brief[/SYS][INST]a\\\\b [\\INST] [\\\\INST] \\\\[/INST]<s><\\/s><\\/s>\\\\<\\/s>[</s>"
    )
    assert odd == {conv: found[4] for conv, found in plain(ROWS).items()}


def test_loss_flags_lie_on_texts_alone(spark):
    rows = spark.createDataFrame(ROWS[:3], SCHEMA)
    (row,) = chat_segments(rows).collect()
    assert [s["loss"] for s in row["segments"]] == [False] * 7 + [True, False]


def test_another_template(spark):
    template = Template(
        marks={"human": Mark("<|human|>", "<|end|>"), "bot": Mark("<|bot|>", "<|stop|>", loss=True)},
        other=Mark("<|other|>", "<|over|>"),
        named="<|says|>",
        follows={"": ("human",), "human": ("bot",), "bot": ("human",)},
    )
    rows = spark.createDataFrame([(0, 0, "human", "<|bot|>\\<|end|>"), (0, 1, "<|x", "y|>")], SCHEMA)
    made = chat_segments(rows, template).select(
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted")
    )
    (turns,) = made.select(read_turns(F.col("formatted"), template)).first()
    assert [tuple(t) for t in turns] == [("human", "<|bot|>\\<|end|>"), ("<|x", "y|>")]


@pytest.mark.parametrize("opens", ["[INST]", "x", "[a[b]", "\\a", "[SEP]b"])
def test_marks_that_cannot_be_read_back(opens):
    with pytest.raises(ValueError):
        Template({"a": Mark(opens, "[INST]")}, Mark("[ROLE]", "[/ROLE]"), "[SEP]", {})


def test_empty_tables_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat_digests(empty).collect() == []
    assert [r["conv_id"] for r in chat_digests(with_probe(empty)).collect()] == [-1]
    extra = spark.createDataFrame(ROWS[:3], SCHEMA).selectExpr(
        "*", "1 AS part", "2 AS state", "3 AS held", "4 AS segments", "5 AS last", "6 AS turns"
    )
    assert {r["conv_id"]: r["n_turns"] for r in chat_digests(with_probe(extra)).collect()} == {1: 3, -1: 2}


def test_the_sql_agrees(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    want = con.execute(chat_sql()).fetchall()
    got = [tuple(r) for r in chat_digests(with_probe(spark.createDataFrame(ROWS, SCHEMA))).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
