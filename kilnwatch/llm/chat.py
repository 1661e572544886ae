"""Chat formatting: conversations as marked text with loss flags, by a state machine over roles (no Python on rows).

A ``Template`` declares the marks around each role's text, which texts carry loss, and which roles may follow which.
The last role is the machine's state; a turn whose role may not follow it is counted as out of turn, keeps its place in
the text, and sets the state anew. Texts (and names of undeclared roles) have their control strings broken by a
backslash after the first character, and backslashes doubled, so that no mark can be read inside a text and every text
can be had back.

A conversation is worked on in slices of ``SLICE`` consecutive turn numbers, so that none is gathered whole; only the
last role of a slice goes to the next one, as a row of its own. ``chat_digests`` alone joins a conversation's slices,
because its contract hashes whole conversations: each must fit a string of Spark (2 GB).

Rows are put in the order of turn, then role, then text; repeated rows stay. A null turn comes first, a null role or
text is empty, and a null conv_id is a conversation of its own. No rows give no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SLICE = 1024
ESCAPE = "\\"


@dataclass(frozen=True)
class Mark:
    """What stands before and after a text, and whether the text is learnt."""

    opens: str
    closes: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``other`` marks roles without a mark of their own, whose name ``named`` parts from the text.

    ``follows`` gives the roles that may come after each state; the empty state is the beginning.
    """

    marks: Mapping[str, Mark]
    other: Mark
    named: str
    follows: Mapping[str, tuple[str, ...]]

    def controls(self) -> list[str]:
        marks = [*self.marks.values(), self.other]
        return sorted({self.named, *(m.opens for m in marks), *(m.closes for m in marks)})

    def __post_init__(self):
        controls = self.controls()
        if len(controls) != 2 * len(self.marks) + 3:
            raise ValueError("marks must differ")
        firsts = {c[:1] for c in controls}
        if any(len(c) < 2 or ESCAPE in c or firsts & set(c[1:]) for c in controls):
            raise ValueError("a mark has two characters or more, and the first ones stand nowhere else in marks")
        if any(a != b and b.startswith(a) for a in controls for b in controls):
            raise ValueError("no mark begins another")


TEMPLATE = Template(
    marks={
        "system": Mark("[SYS]", "[/SYS]"),
        "user": Mark("[INST]", "[/INST]"),
        "assistant": Mark("<s>", "</s>", loss=True),
    },
    other=Mark("[ROLE]", "[/ROLE]"),
    named="[SEP]",
    follows={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
)


def escaped(text: Column, template: Template = TEMPLATE) -> Column:
    """``text`` without any control string of the template."""
    controls = template.controls()
    firsts = "".join(sorted({re.escape(c[0]) for c in controls}))
    rests = "|".join(re.escape(c[1:]) for c in controls)
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, f"[{firsts}](?={rests})", "$0" + ESCAPE * 2)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _by_role(role: Column, template: Template, pick: Callable[[Mark], object]) -> Column:
    """``pick(mark)`` of the role's mark."""
    chosen = F.lit(pick(template.other))
    for name, mark in template.marks.items():
        chosen = F.when(role == name, F.lit(pick(mark))).otherwise(chosen)
    return chosen


def _legal(state: Column, role: Column, template: Template) -> Column:
    pairs = [(state == s) & role.isin(*roles) for s, roles in template.follows.items() if roles]
    return reduce(Column.__or__, pairs, F.lit(False))


def chat_segments(conversations: DataFrame, template: Template = TEMPLATE, turns_each: int = SLICE) -> DataFrame:
    """Rows of ``conv_id``, ``part``, ``turns`` (role and whether it may stand there) and ``segments`` (text, loss).

    ``part`` numbers the slices of a conversation upwards; their segments joined in that order are its formatted text.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    # A quotient is cut towards zero, which keeps the order of the turns.
    part = F.expr(f"turn div {int(turns_each)}").alias("part")
    last = conversations.groupBy("conv_id", part).agg(F.max(F.struct("turn", role))["role"].alias("last"))
    order = Window.partitionBy("conv_id").orderBy("part")
    carried = last.select("conv_id", "part", F.lag("last").over(order).alias("state")).where("state IS NOT NULL")
    rows = conversations.select("conv_id", part, F.struct("turn", role, text).alias("turn"))
    sliced = (
        rows.unionByName(carried, allowMissingColumns=True)
        .groupBy("conv_id", "part")
        .agg(
            F.sort_array(F.collect_list("turn")).alias("held"),
            F.coalesce(F.max("state"), F.lit("")).alias("state"),
        )
    )

    def turn(t: Column, i: Column) -> Column:
        before = F.when(i == 0, F.col("state")).otherwise(F.get(F.col("held"), i - 1)["role"])
        return F.struct(t["role"].alias("role"), _legal(before, t["role"], template).alias("legal"))

    def segments(t: Column) -> Column:
        role = t["role"]
        name = F.when(role.isin(*template.marks), "").otherwise(
            F.concat(escaped(role, template), F.lit(template.named))
        )
        parts = [
            (F.concat(_by_role(role, template, lambda m: m.opens), name), F.lit(False)),
            (escaped(t["text"], template), _by_role(role, template, lambda m: m.loss)),
            (_by_role(role, template, lambda m: m.closes), F.lit(False)),
        ]
        return F.array(*[F.struct(p.alias("text"), loss.alias("loss")) for p, loss in parts])

    return sliced.select(
        "conv_id",
        "part",
        F.transform("held", turn).alias("turns"),
        F.flatten(F.transform("held", segments)).alias("segments"),
    )


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns of a formatted text, as an array of role and text."""
    closes = "|".join(re.escape(m.closes) for m in [*template.marks.values(), template.other])

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(template.other.opens) + 1))
        parts = F.split(body, re.escape(template.named), 2)
        found = F.struct(unescaped(parts[0]).alias("role"), unescaped(parts[1]).alias("text"))
        for name, mark in template.marks.items():
            text = unescaped(F.substr(piece, F.lit(len(mark.opens) + 1)))
            known = F.struct(F.lit(name).alias("role"), text.alias("text"))
            found = F.when(F.startswith(piece, F.lit(mark.opens)), known).otherwise(found)
        return found

    pieces = F.split(formatted, closes, -1)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def chat_digests(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Digests of each conversation, read back from its formatted text and its loss flags.

    ``n_out_of_turn`` counts the turns whose role may not follow the one before.
    """
    made = chat_segments(conversations, template).select(
        "conv_id",
        "part",
        F.size(F.filter("turns", lambda t: ~t["legal"])).cast("long").alias("odd"),
        _joined(F.transform("segments", lambda s: s["text"])).alias("formatted"),
        _joined(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"]))).alias("loss"),
    )

    def said(turn: Column) -> Column:
        return F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))

    read = made.withColumn("turns", read_turns(F.col("formatted"), template)).select(
        "conv_id",
        "odd",
        F.size("turns").cast("long").alias("n"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.struct("part", "loss").alias("loss"),
        F.struct("part", _joined(F.transform("turns", said)).alias("said")).alias("said"),
    )

    def digest(column: str) -> Column:
        parts = F.sort_array(F.collect_list(column))
        return F.sha2(_joined(F.transform(parts, lambda p: p[column])), 256)

    return read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        digest("said").alias("turns_sha256"),
        F.sum("loss_chars").alias("loss_chars"),
        digest("loss").alias("loss_sha256"),
        F.sum("formatted_chars").alias("formatted_chars"),
        F.sum("odd").alias("n_out_of_turn"),
    )


#: The contract's conversation whose texts hold control strings.
PROBE_ID, PROBE_ROLES, PROBE_TEXT = -1, ("user", "assistant"), "</s>[INST] ok [/INST]"


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and the contract's own one."""
    spark = conversations.sparkSession
    roles = F.array(*map(F.lit, PROBE_ROLES))
    probe = spark.range(len(PROBE_ROLES)).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.get(roles, F.col("id").cast("int")).alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def chat_sql(template: Template = TEMPLATE) -> str:
    """DuckDB SQL for ``chat_digests`` of the conversations and the probe."""

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def broken(column: str) -> str:
        made = f"replace({column}, {text(ESCAPE)}, {text(ESCAPE * 2)})"
        for control in template.controls():
            made = f"replace({made}, {text(control)}, {text(control[0] + ESCAPE + control[1:])})"
        return made

    def outer(mark: Mark) -> str:
        return str(len(mark.opens) + len(mark.closes))

    names = ", ".join(map(text, template.marks))
    marks = " ".join(f"WHEN {text(name)} THEN {outer(mark)}" for name, mark in template.marks.items())
    learnt = ", ".join(text(name) for name, mark in template.marks.items() if mark.loss)
    pairs = ", ".join(f"({text(s)}, {text(r)})" for s, roles in template.follows.items() for r in roles)
    probe = ", ".join(f"({PROBE_ID}, {i}, {text(r)}, {text(PROBE_TEXT)})" for i, r in enumerate(PROBE_ROLES))
    return f"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES {probe})
        ), numbered AS (
            SELECT *, row_number() OVER w AS place, lag(role, 1, '') OVER w AS state FROM said
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
            sum(CASE WHEN role IN ({learnt}) THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(CASE WHEN role IN ({learnt}) THEN text END, '' ORDER BY place), '')) AS loss_sha256,
            sum(length({broken("text")}) + CASE role {marks} ELSE {outer(template.other)} END
                + CASE WHEN role IN ({names}) THEN 0 ELSE length({broken("role")}) + {len(template.named)} END
            )::BIGINT AS formatted_chars,
            sum(CASE WHEN (state, role) IN ({pairs}) THEN 0 ELSE 1 END)::BIGINT AS n_out_of_turn
        FROM numbered GROUP BY conv_id
    """
