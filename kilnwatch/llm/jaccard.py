"""N-gram Jaccard join by chosen paths (operator 6).

Each text is a set of shingles of five words; texts of fewer words are one shingle. Texts with equal sets are
represented by one of them. A set is embedded as ``LANES`` MinHash coordinates. Each of ``RUNS`` independent runs
starts with all sets in one bucket and splits it on sampled coordinates, the tokens that similar sets share: a
coordinate is taken with probability 1 / (0.8 LANES), by a hash of the path that led to the bucket, so that all its
sets choose alike. Buckets of at most ``LEAF`` sets are compared by brute force; larger ones are split again, with
``AGAIN`` times the coordinates, so that two similar sets do not part more and more often the deeper the split. A
bucket of at most ``HELD`` sets is split to its end inside one task, larger ones by a shuffle for each level. Two sets
at similarity 0.8 meet in a run with probability 0.63 after one split and 0.55 after ``DEPTH``; ``RUNS`` is the number
of runs that misses less than ``MISSED`` of them at any depth. Splitting a large bucket of sets that mostly resemble
each other would only multiply them, so such a bucket, told by the mean agreement of ``VOTES`` one-bit coordinates, is
split no further. These buckets, and those still large after ``DEPTH`` splits, form crowds, the components they are
linked to; all pairs of a crowd are compared once, as pairs of blocks.

What buckets yield are trees of similar sets, whose components hold all links. Inside a component the exact Jaccard
similarity of all pairs is computed once, as products of incidence matrices; components beyond ``BLOCK`` sets or
``BLOCK_SHINGLES`` shingles are dealt out as pairs of blocks. Pairs are counted, not written. The work inside one
component is quadratic in its different sets; this is what exact numbers of links cost.

Defined results: texts without words, null ones included, have no links and are classes of their own; a row with a null
id has no class and no links; repeated rows link each other like other copies; ids that repeat with different texts
give a row for each; an empty table gives an empty result; extra columns are ignored. The class is the least id it
holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnwatch.llm.components import components
from kilnwatch.llm.hashing import STEP, WHITE, Words, mix
from kilnwatch.llm.tables import _arrow_schema, as_bytes, map_texts, pieces, whole_groups, written

SHINGLE = 5
SIMILARITY = 0.8
LANES = 64
MISSED = 1e-6
DEPTH = 4
#: Coordinates taken in a further split, as a multiple of those in the first.
AGAIN = 2
LEAF = 256
#: Sets of a bucket that one task holds.
HELD = 16384
#: One-bit coordinates that tell how alike the sets of a large bucket are, and the mean similarity to split no further.
VOTES = 16
DENSE = 0.5
#: Estimated similarity from which two sets are candidates: 4.5 standard errors of 64 coordinates below 0.8.
CANDIDATE = 0.575
BLOCK = 2048
BLOCK_SHINGLES = 4 << 20


def survival(agreeing: int) -> float:
    """Least chance that two sets with so many equal coordinates share a bucket after 1 to DEPTH splits of a run."""
    below = 1.0
    for depth in reversed(range(DEPTH)):
        taken = (AGAIN if depth else 1) / (SIMILARITY * LANES)
        below = 1 - (1 - taken * below) ** agreeing
    return below


def missed(runs: int) -> float:
    """Share of the pairs at SIMILARITY that do not meet in so many runs; their equal coordinates vary."""
    return sum(
        math.comb(LANES, n) * SIMILARITY**n * (1 - SIMILARITY) ** (LANES - n) * (1 - survival(n)) ** runs
        for n in range(LANES + 1)
    )


RUNS = next(runs for runs in range(1, 1000) if missed(runs) < MISSED)

SIGNED = "doc_id bigint, text_key bigint, k1 bigint, k2 bigint, n bigint, votes int, lanes binary"
PATHS = "rep bigint, path bigint, run int"


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and the bounds of the texts."""
    words = Words(texts, WHITE)
    hashes, inside = words.sequences(SHINGLE)
    places = np.flatnonzero(inside)
    owner = np.searchsorted(words.bounds, places, side="right") - 1
    values = hashes[places]
    # Short texts: one shingle of all their words.
    sizes = np.diff(words.bounds)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    extra = []
    for text in short.tolist():
        own = words.hashes[words.bounds[text] : words.bounds[text + 1]]
        placed = mix(own + np.arange(len(own), dtype=np.uint64))
        extra.append(int(mix(np.bitwise_xor.reduce(placed, keepdims=True))[0]))
    owner = np.concatenate([owner, short])
    values = np.concatenate([values, np.array(extra, np.uint64)])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    owner, values = owner[fresh], values[fresh]
    return values, np.searchsorted(owner, np.arange(len(texts) + 1))


def keys(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over the set of each text that has one, equal for equal sets."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    return tuple(np.add.reduceat(mix(v), starts).view(np.int64) for v in (values + np.uint64(1), values ^ STEP))


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The upper halves of the least values of LANES functions, a row for each nonempty set."""
    rng = np.random.default_rng(7)
    factors = rng.integers(0, 1 << 63, LANES, np.uint64) * np.uint64(2) + np.uint64(1)
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), LANES), np.uint32)
    if len(starts):
        for lane, factor in enumerate(factors):
            out[:, lane] = np.minimum.reduceat(values * factor, starts) >> np.uint64(32)
    return out


def votes(lanes: np.ndarray) -> np.ndarray:
    """The lowest bits of the first VOTES coordinates of each set, as a number."""
    bits = (lanes[:, :VOTES] & np.uint32(1)).astype(np.int32)
    return bits @ (1 << np.arange(VOTES, dtype=np.int32))


def _text_key() -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64("text", F.length("text")).alias("text_key")


def signed(docs: DataFrame) -> DataFrame:
    """Two keys that equal sets share, the size of the set and its coordinates; empty sets are left out."""

    def work(batch, texts):
        values, bounds = shingle_sets(texts)
        sizes = np.diff(bounds)
        full = np.flatnonzero(sizes)
        if not len(full):
            return None
        k1, k2 = keys(values, bounds)
        lanes = signatures(values, bounds)
        return {
            "doc_id": batch.column("doc_id").take(pa.array(full)),
            "text_key": batch.column("text_key").take(pa.array(full)),
            "k1": k1,
            "k2": k2,
            "n": sizes[full],
            "votes": votes(lanes),
            "lanes": [row.tobytes() for row in lanes],
        }

    texts = docs.where("doc_id IS NOT NULL").select("doc_id", "text", _text_key())
    return map_texts(texts, "text", SIGNED, work)


def chosen(paths: np.ndarray, times: int) -> np.ndarray:
    """Which coordinates a bucket splits on, by its path: a row of LANES for each path."""
    lanes = np.arange(LANES, dtype=np.uint64)
    drawn = mix(mix(paths)[:, None] ^ (lanes + np.uint64(1)) * STEP) >> np.uint64(11)
    return drawn < np.uint64((1 << 53) * times / (SIMILARITY * LANES))


def children(reps: np.ndarray, paths: np.ndarray, runs: np.ndarray, lanes: np.ndarray, times: int):
    """The buckets that sets go to from theirs."""
    row, lane = np.nonzero(chosen(paths, times))
    below = mix(mix(paths[row] + np.uint64(1)) ^ mix((lane.astype(np.uint64) << np.uint64(32)) | lanes[row, lane]))
    return reps[row], below, runs[row]


def _lanes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, LANES)


def _split(rows: DataFrame, first: bool) -> DataFrame:
    """rep, path, run of the next level; at first each set starts at the root of every run."""
    schema = _arrow_schema(rows.sparkSession, PATHS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps = batch.column("rep").to_numpy()
            lanes = _lanes(batch.column("lanes"))
            if first:
                count = len(reps)
                runs = np.repeat(np.arange(RUNS, dtype=np.int32), count)
                paths = mix(runs.astype(np.uint64) + np.uint64(101))
                reps, lanes = np.tile(reps, RUNS), np.tile(lanes, (RUNS, 1))
            else:
                paths = batch.column("path").to_numpy().view(np.uint64)
                runs = batch.column("run").to_numpy()
            for at in range(0, len(reps), 1 << 15):
                part = slice(at, at + (1 << 15))
                rep, path, number = children(
                    reps[part], paths[part], runs[part], lanes[part], 1 if first else AGAIN
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep), pa.array(path.view(np.int64)), pa.array(number, pa.int32())], schema=schema
                )

    return rows.mapInArrow(run, PATHS)


def dense_paths(large: DataFrame, sets: DataFrame) -> DataFrame:
    """The paths of the buckets whose sets mostly resemble each other.

    Two sets agree in a bit with probability (1 + similarity) / 2, and a bucket's share of agreeing pairs follows from
    its sums of bits alone.
    """
    count = F.count("*").cast("double")
    shares = [F.sum(F.shiftright("votes", bit).bitwiseAND(F.lit(1))) / count for bit in range(VOTES)]
    agreeing = reduce(Column.__add__, [share * share + (1 - share) * (1 - share) for share in shares]) / VOTES
    voted = large.select("path", "rep").join(sets.select("rep", "votes"), "rep")
    return voted.groupBy("path").agg((agreeing * 2 - 1).alias("similarity")).where(F.col("similarity") >= DENSE).select("path")


def _mean_similarity(lanes: np.ndarray) -> float:
    """The same of sets at hand."""
    shares = ((votes(lanes)[:, None] >> np.arange(VOTES)) & 1).mean(axis=0)
    return float((shares**2 + (1 - shares) ** 2).mean() * 2 - 1)


def leaves(sets: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """rep, leaf and depth: the buckets that a task works on; and u, v: stars of the large buckets not split further."""
    level = written(_split(sets.select("rep", "lanes"), True), "paths")
    found = stars = None
    for depth in range(1, DEPTH + 1):
        sizes = level.groupBy("path").agg(F.count("*").alias("count"), F.min("rep").alias("first")).where("count > 1")
        sized = level.join(sizes, "path")
        small = F.col("count") <= LEAF
        large = written(sized.where(~small).select("rep", "path", "run", "first", "count"), "large")
        named = F.lit(depth).alias("depth")
        parts = [sized.where(small).select("rep", F.col("path").alias("leaf"), named)]
        if not large.isEmpty():
            whole = written(dense_paths(large, sets) if depth < DEPTH else large.select("path").distinct(), "dense")
            star = large.join(whole, "path", "left_semi").select(F.col("rep").alias("u"), F.col("first").alias("v"))
            star = written(star.distinct(), "stars")
            stars = star if stars is None else stars.union(star)
            rest = large.join(whole, "path", "left_anti")
            held = F.col("count") <= HELD
            parts.append(rest.where(held).select("rep", F.col("path").alias("leaf"), named))
            large = rest.where(~held)
        for part in parts:
            found = part if found is None else found.union(part)
        if large.isEmpty():
            break
        level = written(_split(large.join(sets.select("rep", "lanes"), "rep"), False), "paths")
    return found, stars


def forest(similar: np.ndarray) -> list[tuple[int, int]]:
    """Links from each row to the first row of its component, for a symmetric matrix of similar pairs."""
    count = len(similar)
    unseen = np.ones(count, bool)
    out = []
    for root in range(count):
        if not unseen[root]:
            continue
        unseen[root] = False
        front = np.array([root])
        while len(front):
            reached = np.flatnonzero(similar[front].any(axis=0) & unseen)
            unseen[reached] = False
            out += [(root, int(row)) for row in reached]
            front = reached
    return out


def _alike(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which pairs of sets have an estimated similarity of CANDIDATE, from their coordinates."""
    # Half of each coordinate tells nearly as much, and is compared twice as fast.
    own, other = own.astype(np.uint16), other.astype(np.uint16)
    equal = np.zeros((len(own), len(other)), np.uint8)
    for lane in range(LANES):
        equal += own[:, lane, None] == other[None, :, lane]
    return equal >= CANDIDATE * LANES


def bucket_links(lanes: np.ndarray, path: np.uint64, depth: int, leaf: int, deepest: int) -> list[tuple[int, int]]:
    """Trees of the candidates of a bucket, which is split to its end."""
    count = len(lanes)
    if count <= leaf:
        return forest(_alike(lanes, lanes)) if count > 1 else []
    if depth >= deepest or _mean_similarity(lanes) >= DENSE:
        return _by_blocks(lanes)
    out = []
    for lane in np.flatnonzero(chosen(np.array([path]), AGAIN)[0]).tolist():
        order = np.argsort(lanes[:, lane], kind="stable")
        values = lanes[order, lane]
        starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        names = mix(mix(np.array([path]) + np.uint64(1)) ^ mix((np.uint64(lane) << np.uint64(32)) | values[starts]))
        for name, rows in zip(names, np.split(order, starts[1:]), strict=True):
            if len(rows) > 1:
                out += [(int(rows[a]), int(rows[b])) for a, b in bucket_links(lanes[rows], name, depth + 1, leaf, deepest)]
    return out


def _by_blocks(lanes: np.ndarray) -> list[tuple[int, int]]:
    """Trees of the candidates among all pairs, a pair of blocks at a time."""
    out = []
    starts = range(0, len(lanes), 1024)
    for i in starts:
        for j in starts:
            if j < i:
                continue
            own = lanes[i : i + 1024]
            if i == j:
                out += [(i + a, i + b) for a, b in forest(_alike(own, own))]
                continue
            alike = _alike(own, lanes[j : j + 1024])
            both = np.zeros((sum(alike.shape),) * 2, bool)
            both[: len(own), len(own) :] = alike
            both[len(own) :, : len(own)] = alike.T
            place = np.concatenate([np.arange(i, i + len(own)), np.arange(j, j + alike.shape[1])])
            out += [(int(place[a]), int(place[b])) for a, b in forest(both)]
    return out


def crowd_links(sets: DataFrame, stars: DataFrame) -> DataFrame:
    """u, v: trees of the candidates inside the components of large buckets; every pair of a crowd is compared."""
    crowds = components(stars, "crowds").withColumnRenamed("node", "rep")
    sizes = crowds.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rows = (
        crowds.join(sizes, "component")
        .join(sets.select("rep", "lanes"), "rep")
        .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select(
            "component", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "rep",
            "lanes",
        )
    )
    schema = _arrow_schema(sets.sparkSession, "u bigint, v bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in whole_groups(batches, ["component", "i", "j"], 1024):
            for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                group = table.slice(first, last - first)
                reps, blocks = group.column("rep").to_numpy(), group.column("block").to_numpy()
                lanes = _lanes(group.column("lanes"))
                i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
                own, other = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
                alike = _alike(lanes[own], lanes[other])
                if i != j:
                    both = np.zeros((len(own) + len(other),) * 2, bool)
                    both[: len(own), len(own) :] = alike
                    both[len(own) :, : len(own)] = alike.T
                    alike, own = both, np.concatenate([own, other])
                if trees := forest(alike):
                    u, v = np.array(trees).T
                    yield pa.RecordBatch.from_arrays([pa.array(reps[own[u]]), pa.array(reps[own[v]])], schema=schema)

    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = rows.repartition(parts, "component", "i", "j").sortWithinPartitions("component", "i", "j", "rep")
    return grouped.mapInArrow(run, "u bigint, v bigint")


def candidate_links(sets: DataFrame) -> DataFrame:
    """u, v: trees of the sets whose estimated similarity reaches CANDIDATE, from all leaves and crowds."""
    small, stars = leaves(sets)
    rows = small.join(sets.select("rep", "lanes"), "rep")
    schema = _arrow_schema(sets.sparkSession, "u bigint, v bigint")
    most, deepest = LEAF, DEPTH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in whole_groups(batches, ["leaf"]):
            reps, paths, depths = (table.column(c).to_numpy() for c in ("rep", "leaf", "depth"))
            lanes = _lanes(table.column("lanes"))
            pairs: list[tuple[int, int]] = []
            for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if last - first == 2:
                    if np.count_nonzero(lanes[first] == lanes[first + 1]) >= CANDIDATE * LANES:
                        pairs.append((first, first + 1))
                    continue
                path = paths[first].view(np.uint64)
                trees = bucket_links(lanes[first:last], path, int(depths[first]), most, deepest)
                pairs += [(first + a, first + b) for a, b in trees]
            if pairs:
                u, v = np.array(pairs).T
                yield pa.RecordBatch.from_arrays([pa.array(reps[u]), pa.array(reps[v])], schema=schema)

    dealt = rows.select("leaf", "depth", "rep", "lanes").repartition("leaf")
    compared = dealt.sortWithinPartitions("leaf", "rep")
    links = compared.mapInArrow(run, "u bigint, v bigint")
    return (links if stars is None else links.union(crowd_links(sets, stars))).distinct()


def intersections(values: np.ndarray, bounds: np.ndarray, own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``own`` with other sets ``other``; of a set with itself it is not told."""
    sizes = np.diff(bounds)
    names, columns = np.unique(values, return_inverse=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    shared = np.bincount(columns, minlength=len(names)) > 1
    numbers = np.cumsum(shared) - 1
    kept = shared[columns]
    row, columns = row[kept], numbers[columns[kept]]
    order = np.argsort(columns, kind="stable")
    row, columns = row[order], columns[order]
    out = np.zeros((len(own), len(other)), np.float32)
    place_own, place_other = (np.full(len(sizes), -1) for _ in range(2))
    place_own[own], place_other[other] = np.arange(len(own)), np.arange(len(other))
    width = max(64, (1 << 23) // max(1, len(own) + len(other)))
    for first in range(0, int(shared.sum()), width):
        at = slice(*np.searchsorted(columns, [first, first + width]))
        r, c = row[at], columns[at] - first
        sides = []
        for place, count in ((place_own, len(own)), (place_other, len(other))):
            side = np.zeros((count, width), np.float32)
            mine = place[r] >= 0
            side[place[r[mine]], c[mine]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _weighted(similar: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each row the sum of the weights it is similar to, a part of the rows at a time."""
    parts = [similar[row : row + 256] @ weights for row in range(0, len(similar), 256)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


VERIFIED = "rep bigint, linked bigint, u bigint, v bigint"


def _verify(rows: DataFrame) -> DataFrame:
    """Weighted numbers of links (rep, linked) and trees of the true links (u, v), from groups of sets.

    A group is a component's block i with itself, or blocks i and j with each other.
    """
    schema = _arrow_schema(rows.sparkSession, VERIFIED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for table, edges in whole_groups(batches, ["component", "i", "j"], 1024):
            out: list[tuple] = []
            for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                group = table.slice(first, last - first)
                values, bounds = shingle_sets([opener.decompress(text) for text in group.column("packed").to_pylist()])
                reps, weights, blocks = (group.column(c).to_numpy() for c in ("rep", "copies", "block"))
                i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
                own, other = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
                sizes = np.diff(bounds)
                shared = intersections(values, bounds, own, other)
                similar = np.empty(shared.shape, bool)
                for row in range(0, len(own), 256):
                    # Counts are integers, exact in floating point; 5 shared >= 4 united is a similarity of 0.8.
                    part = shared[row : row + 256].astype(np.float64)
                    both_sizes = sizes[own[row : row + 256], None] + sizes[None, other]
                    similar[row : row + 256] = 9 * part >= 4 * both_sizes
                if i == j:
                    np.fill_diagonal(similar, False)
                    counts = _weighted(similar, weights[other])
                    trees = [(reps[own[a]], reps[own[b]]) for a, b in forest(similar)]
                    out += [(int(reps[own[k]]), int(n), None, None) for k, n in enumerate(counts) if n]
                else:
                    counts, back = _weighted(similar, weights[other]), _weighted(similar.T, weights[own])
                    out += [(int(reps[own[k]]), int(n), None, None) for k, n in enumerate(counts) if n]
                    out += [(int(reps[other[k]]), int(n), None, None) for k, n in enumerate(back) if n]
                    both = np.zeros((len(own) + len(other),) * 2, bool)
                    both[: len(own), len(own) :] = similar
                    both[len(own) :, : len(own)] = similar.T
                    named = np.concatenate([reps[own], reps[other]])
                    trees = [(named[a], named[b]) for a, b in forest(both)]
                out += [(None, None, int(u), int(v)) for u, v in trees]
            if out:
                columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return rows.mapInArrow(run, VERIFIED)


def packed(docs: DataFrame) -> DataFrame:
    """A text of each id and key, under zstandard, which makes the shuffle of texts a third as large."""
    names = "doc_id bigint, text_key bigint, packed binary"
    schema = _arrow_schema(docs.sparkSession, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = pa.array([packer.compress(text) for text in as_bytes(piece, "text")], pa.binary())
                columns = [piece.column(c) for c in ("doc_id", "text_key")]
                yield pa.RecordBatch.from_arrays([*columns, texts], schema=schema)

    texts = docs.where("doc_id IS NOT NULL").select("doc_id", "text", _text_key())
    return texts.mapInArrow(run, names).groupBy("doc_id", "text_key").agg(F.first("packed").alias("packed"))


def _classified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The signed rows; and of each set its keys, a number of its class, the class's least id and the links of a row."""
    sets = written(signed(docs), "signed")
    own = F.min(F.struct("doc_id", "text_key"))
    grouped = sets.groupBy("k1", "k2").agg(
        own["doc_id"].alias("least"), own["text_key"].alias("text_key"), F.count("*").alias("copies"),
        F.first("n").alias("n"), F.first("votes").alias("votes"), F.first("lanes").alias("lanes"),
    )
    # Ids may hold several texts, so sets are numbered by themselves.
    reps = written(grouped.withColumn("rep", F.monotonically_increasing_id()), "sets")
    near = components(candidate_links(reps), "candidates")
    members = written(
        near.join(reps.select("rep", "least", "text_key", "copies", "n"), F.col("node") == F.col("rep")).select(
            "rep", "least", "text_key", "component", "copies", "n"
        ),
        "members",
    )
    sizes = members.groupBy("component").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("blocks")
    )
    dealt = members.join(sizes, "component").select(
        "rep", F.col("least").alias("doc_id"), "text_key", "component", "copies", "blocks",
        F.pmod(F.xxhash64("rep"), "blocks").alias("block"),
    )
    dealt = (
        # Members grow with the corpus: a plan that broadcasts them while they are few would not last.
        dealt.hint("merge").join(packed(docs), ["doc_id", "text_key"])
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select(
            "component", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
            "rep", "copies", "block", "packed",
        )
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = dealt.repartition(parts, "component", "i", "j").sortWithinPartitions("component", "i", "j", "rep")
    checked = written(_verify(grouped), "verified")
    linked = checked.where("rep IS NOT NULL").groupBy("rep").agg(F.sum("linked").alias("linked"))
    classes = components(checked.where("u IS NOT NULL").select("u", "v"), "classes")
    numbered = (
        reps.select("k1", "k2", "rep", "least", "copies")
        .join(linked, "rep", "left")
        .join(classes.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "k1", "k2", "least", F.coalesce("component", "rep").alias("class"),
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        )
    )
    firsts = numbered.groupBy("class").agg(F.min("least").alias("class_id"))
    return sets, numbered.join(firsts, "class").select("k1", "k2", "class", "class_id", "n_links")


def _alone(docs: DataFrame) -> DataFrame:
    """Rows without words or without an id."""
    return docs.where(F.col("doc_id").isNull() | ~F.coalesce("text", F.lit("")).rlike(r"[^ \t\n\x0B\f\r]"))


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and n_links of each document: links reach a Jaccard similarity of at least 0.8."""
    sets, known = _classified(docs)
    found = sets.select("doc_id", "k1", "k2").join(known, ["k1", "k2"]).select("doc_id", "class_id", "n_links")
    alone = _alone(docs).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"))
    return found.union(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns; rows without words or without an id stay.

    It is a row of the class's least id; where several rows of the class have it, the one of the least set and then
    the least in the order of the columns.
    """
    sets, known = _classified(docs)
    names = docs.columns
    key, place = (_unused(name, names) for name in ("row_key", "row_place"))
    members = known.join(sets.select("doc_id", "text_key", "k1", "k2"), ["k1", "k2"]).where("doc_id = class_id")
    least = members.groupBy("class").agg(F.min(F.struct("k1", "k2")).alias("set"))
    own = members.join(least, "class").where(F.struct("k1", "k2") == F.col("set"))
    kept = written(own.select("class", "doc_id", "text_key").distinct(), "kept")
    chosen = _one_text_each(docs, kept).select(F.struct("doc_id", "text_key").alias(key))
    # Texts are moved once: repeated rows of a text meet where the join has put them.
    order = Window.partitionBy(key).orderBy(*(c for c in names if c != "doc_id"))
    rows = docs.where("doc_id IS NOT NULL").withColumn(key, F.struct("doc_id", _text_key()))
    single = rows.join(chosen, key, "left_semi").withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return single.select(*names).union(_alone(docs))


def _one_text_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """doc_id and text_key of one text of each class; texts are read only where an id has several of one set."""
    texts = kept.groupBy("class").agg(F.count("*").alias("texts"), F.min(F.struct("doc_id", "text_key")).alias("own"))
    counted = written(texts, "kept-texts")
    single = counted.where("texts = 1").select("own.*")
    many = written(kept.join(counted.where("texts > 1").select("class"), "class"), "kept-many")
    if many.isEmpty():
        return single
    told = docs.select("doc_id", "text", _text_key()).join(many, ["doc_id", "text_key"])
    first = told.groupBy("class").agg(F.min(F.struct("text", "doc_id", "text_key")).alias("own"))
    return single.union(first.select("own.doc_id", "own.text_key"))


def _unused(name: str, names: list[str]) -> str:
    """``name`` with as many underscores as no column's name has."""
    taken = {n.lower() for n in names}
    while name in taken:
        name += "_"
    return name
