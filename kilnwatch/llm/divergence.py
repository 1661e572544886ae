"""Source divergence audit: how far the words of each source stray from its language and from the other sources.

Count-cell ranking. Terms are counted in pieces of text and summed by language, source and term; a language keeps the
terms of at least ``LEAST_DOCS`` of its documents. What is scored then are not terms but cells: the terms of a group
that share both of two counts share their score, so it is worked out once for each cell and weighted by the cell's
terms. For the ranking of terms, cells of one score are merged, their running multiplicity tells which scores reach
the ranks asked for, and only the terms of those cells are listed, in the order of their UTF-8 bytes.

For a pair of sources, terms that one of them lacks need no rows: the pair's cells of both counts come from the terms
that both have, and the scores of the others follow from each source's own cells.

The result holds all pairs of sources of a language, as asked for; the work on pairs is the number of pairs of sources
that share a term, summed over the kept terms, and is combined in each task before it is shuffled.

A null text, lang or source is empty. Documents without terms still make their group. A language without kept terms
has pairs of value 0. Every row counts as a document, repeated ids and rows included. No documents give no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilnwatch.llm.hashing import Words, separators_of
from kilnwatch.llm.tables import as_bytes, pieces, written

LEAST_DOCS = 10
RANKS = 10
SCALE = 1_000_000_000
#: The bytes between terms.
APART = separators_of((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
#: Bytes of text counted at once, and counts of a task that are merged, and passed on where half of them remain.
SLICE = 4 << 20
HELD = 1 << 20

COUNTED = "lang string, source string, term string, n bigint, docs bigint"


class Counts:
    """Occurrences and documents of each term of each group in the texts of a task; terms and groups have numbers."""

    def __init__(self):
        self.terms: dict[bytes, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, texts: list[bytes], groups: list[tuple[str, str]]) -> None:
        words = Words([text.lower() for text in texts], APART)
        if not len(words.hashes):
            return
        numbers, places = words.identities()
        # Words of a document, then documents of a group.
        spread = len(places)
        owner = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
        pairs, times = np.unique(owner * spread + numbers, return_counts=True)
        named = np.array([self.terms.setdefault(words.word(at), len(self.terms)) for at in places.tolist()])
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in groups])
        keys = (group[pairs // spread] << 32) | named[pairs % spread]
        self.parts.append(_summed(keys, times, np.ones(len(keys), np.int64)))
        self.size += len(self.parts[-1][0])
        if self.size > HELD:
            self._merge()

    def _merge(self) -> None:
        if len(self.parts) > 1:
            self.parts = [_summed(*(np.concatenate(side) for side in zip(*self.parts, strict=True)))]
        self.size = len(self.parts[0][0])

    def full(self) -> bool:
        return self.size > HELD // 2 or len(self.terms) > HELD

    def taken(self) -> pa.RecordBatch:
        """The counts so far, which leave."""
        self._merge()
        keys, times, docs = self.parts[0]
        langs, sources = (pa.array(side, pa.string()) for side in zip(*self.groups, strict=True))
        group, term = pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF)
        terms = pa.array(list(self.terms), pa.binary()).cast(pa.string())
        columns = [langs.take(group), sources.take(group), terms.take(term), pa.array(times), pa.array(docs)]
        self.__init__()
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def _summed(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each key once, with the sums of its columns."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], *(np.add.reduceat(column[order], starts) for column in columns)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each term and group of a partition, or several where they are many."""
    held = Counts()
    for batch in batches:
        for piece in pieces(batch, "text", SLICE):
            groups = zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), strict=True)
            held.add(as_bytes(piece, "text"), list(groups))
            if held.full():
                yield held.taken()
    if held.size:
        yield held.taken()


def kept_terms(documents: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang``, ``term``, ``total`` and ``counts``, the sources that have the term with its number of occurrences."""
    texts = _groups_of(documents, "text")
    terms = texts.mapInArrow(_counted, COUNTED).groupBy("lang", "source", "term")
    by_source = terms.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (
        by_source.groupBy("lang", "term")
        .agg(
            F.sum("n").alias("total"),
            F.sum("docs").alias("docs"),
            F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts"),
        )
        .where(F.col("docs") >= least_docs)
        .drop("docs")
    )


def _groups_of(documents: DataFrame, *more: str) -> DataFrame:
    return documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", *more)])


def _smoothed(count: str, total: str, kinds: str) -> str:
    """``p`` of a count; the products need more than 64 bits."""
    top = f"(CAST({count} AS DECIMAL(20,0)) + 2) * {SCALE}L"
    return f"1L + {top} div (CAST({total} AS DECIMAL(20,0)) + CAST({kinds} AS DECIMAL(20,0)) * 2)"


def _gap(p: str, q: str) -> str:
    """``f``; its products stay below 2**63, as neither ``p`` nor ``q`` passes 10**9 + 1."""
    return f"(({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q}))"


def _pairs(terms: DataFrame, shares: DataFrame, groups: DataFrame) -> DataFrame:
    """The summed score of every two sources of a language, both ways.

    Terms that both sources have are scored by their cells. Of all other terms one source or both have none: their
    scores follow from each source's own cells, and from what the common terms would give without one count or both.
    """
    first = terms.select("lang", "counts", F.posexplode("counts").alias("at", "one"))
    later = F.expr("slice(counts, at + 2, greatest(size(counts) - at - 1, 0))")
    two = first.select("lang", "one", F.explode(later).alias("two"))
    cells = two.groupBy(
        "lang",
        F.col("one.source").alias("s"),
        F.col("two.source").alias("t"),
        F.col("one.n").alias("a"),
        F.col("two.n").alias("b"),
    ).agg(F.count("*").alias("m"))
    left = groups.select("lang", F.col("source").alias("s"), F.col("none").alias("s_none"), "kinds")
    right = groups.select("lang", F.col("source").alias("t"), F.col("none").alias("t_none"))
    pairs = left.join(right, "lang").where("s < t")
    ones = shares.select("lang", F.col("source").alias("s"), F.col("n").alias("a"), F.col("p").alias("s_p"), F.col("m"))
    others = shares.select("lang", F.col("source").alias("t"), F.col("n").alias("b"), F.col("p").alias("t_p"), F.col("m"))
    neither, one, other = _gap("s_none", "t_none"), _gap("s_p", "t_none"), _gap("s_none", "t_p")
    common = (
        cells.join(ones.drop("m"), ["lang", "s", "a"])
        .join(others.drop("m"), ["lang", "t", "b"])
        .join(pairs, ["lang", "s", "t"])
        .selectExpr("lang", "s", "t", f"m * ({_gap('s_p', 't_p')} - {one} - {other} + {neither}) AS value")
    )
    parts = [
        pairs.selectExpr("lang", "s", "t", f"kinds * ({neither}) AS value"),
        pairs.join(ones, ["lang", "s"]).selectExpr("lang", "s", "t", f"m * ({one} - {neither}) AS value"),
        pairs.join(others, ["lang", "t"]).selectExpr("lang", "s", "t", f"m * ({other} - {neither}) AS value"),
    ]
    for part in parts:
        common = common.unionByName(part)
    found = common.groupBy("lang", "s", "t").agg(F.sum("value").alias("value"))
    ways = F.array(
        F.struct(F.col("s").alias("source"), F.col("t").alias("item")),
        F.struct(F.col("t").alias("source"), F.col("s").alias("item")),
    )
    both = found.select("lang", "value", F.inline(ways))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return both.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))


def _leading_terms(each: DataFrame, shares: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    """The terms that a source uses most beyond its language's share, to ``ranks``."""
    keys = ["lang", "source", "n", "lang_n"]
    cells = each.groupBy(*keys).agg(F.count("*").alias("m"))
    scored = (
        cells.join(shares.drop("m"), ["lang", "source", "n"])
        .join(groups.select("lang", "source", "lang_total", "kinds"), ["lang", "source"])
        .selectExpr(*keys, "m", "p", f"{_smoothed('lang_n', 'lang_total', 'kinds')} AS q")
        .where("p > q")
        .selectExpr(*keys, "m", f"{_gap('p', 'q')} AS value")
    )
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    merged = scored.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    leading = merged.withColumn("place", F.row_number().over(best)).where(F.col("place") <= ranks)
    before = F.coalesce(F.sum("m").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    needed = leading.withColumn("before", before).where(F.col("before") < ranks).select("lang", "source", "value")
    chosen = scored.join(needed, ["lang", "source", "value"]).select(*keys, "value")
    terms = each.join(chosen, keys).select("lang", "source", F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return (
        terms.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= ranks)
        .withColumn("part", F.lit("term"))
    )


def divergence(documents: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """``lang, source, part, item, value, rank``: the audit's ranked pairs of sources and leading terms."""
    terms = written(kept_terms(documents, least_docs), "kept-terms")
    each = terms.select("lang", "term", F.col("total").alias("lang_n"), F.explode("counts").alias("c")).select(
        "lang", "term", "lang_n", "c.source", "c.n"
    )
    sums = each.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("kinds"))
    known = _groups_of(documents).distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    filled = known.na.fill(0)
    # Without kept terms there is nothing to share out.
    none = F.expr(f"CASE WHEN kinds > 0 THEN {_smoothed('0', 'total', 'kinds')} ELSE 1 END")
    groups = written(filled.withColumn("none", none), "divergence-groups")
    cells = each.groupBy("lang", "source", "n").agg(F.count("*").alias("m")).join(groups, ["lang", "source"])
    share = F.expr(_smoothed("n", "total", "kinds"))
    shares = written(cells.select("lang", "source", "n", "m", share.alias("p")), "divergence-shares")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = _pairs(terms, shares, groups).select(columns)
    return pairs.unionByName(_leading_terms(each, shares, groups, ranks).select(columns))


def divergence_sql(least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> str:
    """DuckDB SQL for ``divergence`` of the documents, term by term."""
    capitals, small = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    return rf"""
        WITH docs AS (
            SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                coalesce(source, '') AS source
            FROM documents
        ), words AS (
            SELECT doc, lang, source,
                unnest(regexp_extract_all(translate(text, '{capitals}', '{small}'),
                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM docs
        ), kept AS (
            SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= {least_docs}
        ), langs AS (
            SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS kinds FROM kept GROUP BY lang
        ), groups AS (
            SELECT DISTINCT lang, source FROM docs
        ), counts AS (
            SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0) AS n
            FROM groups g JOIN kept k USING (lang)
            LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL) c USING (lang, source, term)
        ), shares AS (
            SELECT c.*, 1 + ({SCALE} * (n + 2)::HUGEINT) // (sum(n) OVER (PARTITION BY lang, source) + 2 * kinds) AS p,
                1 + ({SCALE} * (lang_n + 2)::HUGEINT) // (total + 2 * kinds) AS q
            FROM counts c JOIN langs USING (lang)
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item,
                coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY ALL
        ), terms AS (
            SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
            FROM shares WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', item, value FROM terms
        )
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
        FROM ranked
        QUALIFY part = 'pair' OR rank <= {ranks}
    """
