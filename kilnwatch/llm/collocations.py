"""Phrase collocation mining: frequent phrases of two to five words and how strongly their parts hold together.

Rabin-Karp fingerprints. Prefix polynomials over the hashes of a text's words give the fingerprint of every n-gram as a
difference of two prefixes; n-grams do not cross the marks that part pieces. Each task counts fingerprints and keeps a
pointer to one occurrence, 32 bits of a text's hash and the number of a word. Fingerprints are shuffled in packed
arrays, by ranges of their values; the counts of each range are summed, and the least pointer is kept. It goes level by
level: an n-gram can be frequent only if both its (n-1)-grams are, so a level counts just those whose parts pass a
filter of the frequent fingerprints below. The filter is a bit table of fixed size (``FILTER_BITS``, 16 MB), which is
what may be broadcast; the fuller it is, the more candidates pass, and no frequent phrase is ever lost.

Fingerprints that collide are told apart by a second fingerprint, over word hashes of their own, which is a part of the
key; two phrases would have to agree in 96 bits to be counted as one. Frequent phrases alone are materialised: texts
that pointers lead to are read once more, and a phrase is taken from a text only if the words there give both its
fingerprints. The fingerprint of no words stands for all words of its language, and is read in the same way. From then
on phrases are compared as texts.

A null text is empty, a null lang is ``und``. Repeated rows count each time. Texts without words, and no documents,
give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilnwatch.llm.hashing import CHUNK, Words, _position_powers, mix, separators_of
from kilnwatch.llm.tables import as_bytes, pieces, written

LONGEST = 5
LEAST = 100
#: A phrase goes if a longer one that holds it has this share of its occurrences, in percent.
COVERED = 100
TOP = 2000
FILTER_BITS = 27
#: Bytes of text worked on at once.
SLICE = 4 << 20
#: Different fingerprints that a task holds before it passes its counts on.
HELD = 1 << 20
#: Ranges of fingerprints for each partition of a shuffle.
RANGES = 8

PIECE_ENDS = separators_of((10, 13), *((ord(c), ord(c)) for c in ".,;:!?"))
BETWEEN = PIECE_ENDS | separators_of((9, 9), (32, 32))


@cache
def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Slice:
    """The words of several texts, with the piece and the language's seed of each word."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.langs = langs
        self.words = Words([text.lower() for text in texts], BETWEEN)
        ends = np.cumsum(PIECE_ENDS[np.frombuffer(self.words.data, np.uint8)], dtype=np.int64)
        # Texts are joined by a mark that ends pieces.
        self.piece = ends[self.words.starts]
        sizes = np.diff(self.words.bounds)
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        self.own_seeds = np.array([_seed(lang) for lang in langs], np.uint64)
        self.seeds = self.own_seeds[self.owner]
        self.others = self.words.other_hashes()

    def whole(self, length: int) -> np.ndarray:
        """Which words begin an n-gram within their piece."""
        count = max(0, len(self.piece) - length + 1)
        return self.piece[:count] == self.piece[length - 1 : length - 1 + count]

    def fingerprints(self, length: int, check: bool = False) -> np.ndarray:
        """The fingerprint of the n-gram at each word, by language, or the second one; those across pieces mean nothing."""
        forward, back = _position_powers()
        hashes = self.others if check else self.words.hashes
        count = max(0, len(hashes) - length + 1)
        out = np.empty(count, np.uint64)
        step = CHUNK - LONGEST
        for at in range(0, count, step):
            part = hashes[at : at + step + length - 1]
            prefix = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * forward[: len(part)], out=prefix[1:])
            here = len(part) - length + 1
            out[at : at + here] = (prefix[length:] - prefix[:here]) * back[:here]
        return mix(out + self.seeds[:count] + np.uint64(length))

    def of_nothing(self, check: bool = False) -> np.ndarray:
        """The fingerprint of no words in each text's language."""
        return mix(self.own_seeds + np.uint64((LONGEST + 1) * check))

    def phrase(self, at: int, length: int) -> str:
        return b" ".join([self.words.word(word) for word in range(at, at + length)]).decode()


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
    ).withColumn("key", F.shiftrightunsigned(F.xxhash64("lang", "text"), 32))


class Filter:
    """A bit table that holds all fingerprints it was made of, and some others."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def holds(self, prints: np.ndarray) -> np.ndarray:
        found = np.ones(len(prints), bool)
        mask = np.uint64((1 << FILTER_BITS) - 1)
        for shift in (0, FILTER_BITS):
            places = (prints >> np.uint64(shift)) & mask
            bits = self.table[(places >> np.uint64(6)).astype(np.int64)]
            found &= (bits >> (places & np.uint64(63))) & np.uint64(1) == 1
        return found


def filter_of(frequent: DataFrame) -> Filter:
    """The filter of a table's ``print``; tasks set the bits, at most ``2**FILTER_BITS / 64`` words reach the driver."""
    mask = (1 << FILTER_BITS) - 1
    places = F.explode(
        F.array(*[F.shiftrightunsigned("print", s).bitwiseAND(F.lit(mask)) for s in (0, FILTER_BITS)])
    )
    words = (
        frequent.select(places.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(place & 63 AS INT)))").alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return Filter(table)


#: Fingerprint, second fingerprint, count, key of a text, number of a word.
ENTRY = [np.uint64, np.uint32, np.int64, np.uint32, np.uint32]
PACKED = "bucket int, entries binary"
FREQUENT = "print bigint, check bigint, n bigint, key bigint, at bigint, length int"
#: The range of the fingerprints of no words.
NOTHING = -1


def _packed(columns: list[np.ndarray]) -> bytes:
    return b"".join(c.astype(kind).tobytes() for c, kind in zip(columns, ENTRY, strict=True))


def _unpacked(entries: bytes) -> list[np.ndarray]:
    count = len(entries) // sum(np.dtype(kind).itemsize for kind in ENTRY)
    out, at = [], 0
    for kind in ENTRY:
        out.append(np.frombuffer(entries, kind, count, at))
        at += out[-1].nbytes
    return out


def _summed(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Equal fingerprints once, in their order, with the sum of their counts and the least pointer."""
    prints, checks, counts, keys, words = columns
    order = np.argsort(prints, kind="stable")
    again = np.flatnonzero(prints[order][1:] == prints[order][:-1])
    if len(again) and (checks[order][again] != checks[order][again + 1]).any():
        order = np.lexsort((checks, prints))
    prints, checks = prints[order], checks[order]
    change = (prints[1:] != prints[:-1]) | (checks[1:] != checks[:-1])
    starts = np.flatnonzero(np.concatenate([[True], change])) if len(prints) else np.empty(0, np.int64)
    if not len(starts):
        return columns
    pointers = (keys[order].astype(np.uint64) << np.uint64(32)) | words[order].astype(np.uint64)
    pointers = np.minimum.reduceat(pointers, starts)
    sums = np.add.reduceat(counts[order], starts)
    halves = (pointers >> np.uint64(32)).astype(np.uint32), (pointers & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [prints[starts], checks[starts], sums, *halves]


class Counted:
    """Counts that are summed whenever many have gathered."""

    def __init__(self):
        self.parts: list[list[np.ndarray]] = []
        self.size = 0

    def add(self, columns: list[np.ndarray]) -> None:
        if len(columns[0]):
            self.parts.append(columns)
            self.size += len(columns[0])

    def sum(self) -> list[np.ndarray]:
        summed = _summed([np.concatenate(side) for side in zip(*self.parts, strict=True)])
        self.parts, self.size = [summed], len(summed[0])
        return summed


def _of_slice(piece: pa.RecordBatch, length: int, below: Filter | None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The counted n-grams of a slice whose parts pass, and the words of its texts under the fingerprints of none."""
    held = Slice(as_bytes(piece, "text"), piece.column("lang").to_pylist())
    keys, bounds = piece.column("key").to_numpy(), held.words.bounds
    kept = held.whole(length)
    if below is not None:
        known = below.holds(held.fingerprints(length - 1))
        kept &= known[: len(kept)] & known[1 : 1 + len(kept)]
    places = np.flatnonzero(kept)
    owner = held.owner[places]
    prints, checks = (held.fingerprints(length, check)[places] for check in (False, True))
    grams = [prints, checks >> np.uint64(32), np.ones(len(places), np.int64), keys[owner], places - bounds[owner]]
    prints, checks = (held.of_nothing(check) for check in (False, True))
    totals = [prints, checks >> np.uint64(32), np.diff(bounds), keys, np.zeros(len(keys), np.int64)]
    return tuple(_summed([c.astype(kind) for c, kind in zip(t, ENTRY, strict=True)]) for t in (grams, totals))


def _level(documents: DataFrame, length: int, below, least: int) -> DataFrame:
    """The frequent fingerprints of n-grams; ``below`` is the broadcast filter of shorter ones.

    The first level also has those of no words, which count the words of each language, however few.
    """
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = RANGES * parts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, totals = Counted(), Counted()

        def out(columns: list[np.ndarray]) -> pa.RecordBatch:
            bucket = ((columns[0] >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype(np.int64)
            edges = np.searchsorted(bucket, np.arange(ranges + 1))
            full = np.flatnonzero(edges[1:] > edges[:-1])
            entries = [_packed([c[edges[k] : edges[k + 1]] for c in columns]) for k in full.tolist()]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(entries)], names=["bucket", "entries"])

        for batch in batches:
            for piece in pieces(batch, "text", SLICE):
                found, words = _of_slice(piece, length, None if below is None else below.value)
                grams.add(found)
                if length == 1:
                    totals.add(words)
                    totals.sum()
                if grams.size > HELD and len(grams.sum()[0]) > HELD // 2:
                    yield out(grams.parts[0])
                    grams = Counted()
        if grams.size:
            yield out(grams.sum())
        if totals.size:
            entries = [_packed([c[k : k + 1] for c in totals.sum()]) for k in range(totals.size)]
            buckets = pa.array([NOTHING] * len(entries), pa.int32())
            yield pa.RecordBatch.from_arrays([buckets, pa.array(entries)], names=["bucket", "entries"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = Counted(), None

        def out() -> pa.RecordBatch:
            columns = held.sum()
            kept = columns[2] >= (least if current != NOTHING else 0)
            arrays = [pa.array(c[kept].astype(np.int64) if k else c[kept].view(np.int64)) for k, c in enumerate(columns)]
            size = pa.array(np.full(int(kept.sum()), length if current != NOTHING else 0, np.int32))
            return pa.RecordBatch.from_arrays([*arrays, size], names=["print", "check", "n", "key", "at", "length"])

        for batch in batches:
            for bucket, entries in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if bucket != current and held.size:
                    yield out()
                    held = Counted()
                current = bucket
                held.add(_unpacked(entries.as_buffer()))
                if held.size > 4 * HELD:
                    held.sum()
        if held.size:
            yield out()

    dealt = documents.mapInArrow(count, PACKED).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(add_up, FREQUENT)


def _materialised(documents: DataFrame, frequent: DataFrame, keys) -> DataFrame:
    """``lang``, ``phrase``, ``n`` of the frequent fingerprints, each read where its pointer leads and hashed again there."""

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = keys.value.holds(batch.column("key").to_numpy().view(np.uint64))
            yield batch.filter(pa.array(found))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                held = Slice([row["text"].encode()], [row["lang"]])
                wanted: dict[int, list[dict]] = {}
                for pointer in row["pointers"]:
                    wanted.setdefault(pointer["length"], []).append(pointer)
                for length, pointers in wanted.items():
                    prints, checks = (
                        held.fingerprints(length, check) if length else held.of_nothing(check) for check in (False, True)
                    )
                    prints, checks = prints.view(np.int64), (checks >> np.uint64(32)).view(np.int64)
                    for p in pointers:
                        at = p["at"]
                        if at < len(prints) and prints[at] == p["print"] and checks[at] == p["check"]:
                            rows.append((row["lang"], held.phrase(at, length), p["n"]))
            if rows:
                columns = zip(*rows, strict=True)
                kinds = (pa.string(), pa.string(), pa.int64())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "phrase", "n"])

    # Another text of one key gives other fingerprints, so it may come along.
    texts = documents.mapInArrow(reached, documents.schema).dropDuplicates(["lang", "text"])
    pointers = frequent.groupBy("key").agg(
        F.collect_list(F.struct("print", "check", "n", "at", "length")).alias("pointers")
    )
    return texts.join(pointers, "key").mapInArrow(read, "lang string, phrase string, n bigint")


def _counted(documents: DataFrame, least: int, longest: int) -> DataFrame:
    """``lang``, ``phrase``, ``n``: the frequent phrases of up to ``longest`` words, and all words as the empty one."""
    context = documents.sparkSession.sparkContext
    every = below = None
    for length in range(1, longest + 1):
        level = written(_level(documents, length, below, least), f"level-{length}")
        if below is not None:
            below.unpersist()
        every = level if every is None else every.unionByName(level)
        below = context.broadcast(filter_of(level if length < longest else every.select(F.col("key").alias("print"))))
    phrases = written(_materialised(documents, every, below), "phrases")
    below.unpersist()
    return phrases


def collocations(documents: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language by their weakest cut."""
    counts = _counted(_texts(documents), least, LONGEST)
    known = counts.where("phrase <> ''")
    totals = counts.where("phrase = ''").select("lang", F.col("n").alias("total"))
    words = F.split("phrase", " ")
    cuts = (
        known.withColumn("words", words)
        .where(F.size("words") > 1)
        .select("lang", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
        .select(
            "lang", "phrase", "a", "k", F.size("words").alias("size"),
            F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
            F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("tail"),
        )
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    product = "1000 * CAST(a AS DECIMAL(19,0)) * CAST(total AS DECIMAL(19,0))"
    score = F.expr(f"{product} div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .join(totals, "lang")
        .groupBy("lang", "phrase", "a", F.col("total").alias("n"))
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )
    # Any longer phrase that holds one reaches it through phrases of one word less each, none of them rarer.
    within = cuts.where("k = 1").select("lang", F.col("tail").alias("phrase"), "a").unionByName(
        cuts.where("k = size - 1").select("lang", F.col("head").alias("phrase"), "a")
    )
    longer = within.where("contains(phrase, ' ')").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    held = F.coalesce(F.col("longer"), F.lit(0)).cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * covered
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (
        scored.join(longer, ["lang", "phrase"], "left")
        .where(~held)
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def collocations_sql(least: int = LEAST, covered: int = COVERED, top: int = TOP) -> str:
    """DuckDB SQL for ``collocations`` of the documents."""
    capitals, small = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    return rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                unnest(regexp_split_to_array(translate(text, '{capitals}', '{small}'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), spoken AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
        ), grams AS (
            SELECT lang, size, words, unnest(range(1, len(words) - size + 2)) AS first
            FROM spoken, range(1, {LONGEST + 1}) s(size)
        ), counts AS (
            SELECT lang, size, words[first : first + size - 1] AS words, count(*)::HUGEINT AS f FROM grams
            GROUP BY ALL HAVING count(*) >= {least}
        ), totals AS (
            SELECT lang, sum(len(words))::HUGEINT AS n FROM spoken GROUP BY lang
        ), cuts AS (
            SELECT *, unnest(range(1, size)) AS k FROM counts WHERE size > 1
        ), scored AS (
            SELECT c.lang, c.words, c.size, c.f AS a, t.n, k, x.f AS l, y.f AS r, (1000 * c.f * t.n) // (x.f * y.f) AS score
            FROM cuts c JOIN totals t USING (lang)
            JOIN counts x ON x.lang = c.lang AND x.words = c.words[1 : k]
            JOIN counts y ON y.lang = c.lang AND y.words = c.words[k + 1 :]
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.words ORDER BY score, k) = 1
        ), held AS (
            SELECT lang, words[i : i + n - 1] AS words, max(f) AS f
            FROM (SELECT *, unnest(range(1, size - n + 2)) AS i FROM
                (SELECT *, unnest(range(2, size)) AS n FROM counts WHERE size > 2))
            GROUP BY ALL
        ), kept AS (
            SELECT s.*, array_to_string(s.words, ' ') AS phrase FROM scored s LEFT JOIN held h USING (lang, words)
            WHERE h.f IS NULL OR 100 * h.f < {covered} * a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
            a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM kept QUALIFY rank <= {top}
    """
