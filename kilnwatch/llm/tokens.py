"""Byte-level BPE encoding and decoding (operator 4).

Pre-tokens are found without a regular expression. Each code point gets a class; each class is a function on the states
of a small automaton, and a prefix scan composes these functions (composition is associative, so the scan doubles its
span in each pass and stops when all composed functions are constant). The state before a code point and its class say
whether a pre-token starts there. Slices between starts go through merges by rank, whose results are cached.

Defined results: a null text is empty and has no tokens; a null id is passed on; repeated rows are encoded one by one;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kilnwatch.llm.tables import map_texts

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
TOKENS_SCHEMA = "doc_id bigint, n_tokens bigint, ids array<int>, ends array<int>"
#: Pre-tokens in one of the two generations of a worker's cache, and the longest one kept.
CACHED = 1 << 17
CACHED_CHARS = 64

#: Stands between texts; it cannot occur in one.
BREAK = 0xD800
#: White space of the pattern: Unicode's White_Space property, fixed values.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Letters and numbers of Unicode 16, which the pattern's engine knows and Python's tables may not yet; fixed values.
NEWER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEWER_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]

# Classes of code points. A white space that another one follows, or the text's end, is INNER; the last one before
# other text is LAST or, for U+0020, BLANK. S1 and S2 start a contraction of two or three characters.
SEP, LETTER, DIGIT, OTHER, INNER, LAST, BLANK, S1, S2 = range(9)
# States: what the code point before was. IN1 and IN2 say how many letters of a contraction are still to come.
START, IN_LETTERS, IN_DIGITS, IN_OTHER, IN_SPACE, AFTER_BLANK, IN1, IN2, DONE = range(9)


def _moves() -> tuple[np.ndarray, np.ndarray]:
    """For each class: the state after it, and whether a pre-token starts at it, by the state before."""
    after = np.zeros((9, 9), np.uint8)
    starts = np.zeros((9, 9), bool)
    for cls, state, same in (
        (LETTER, IN_LETTERS, {IN_LETTERS, AFTER_BLANK, IN1, IN2}),
        (DIGIT, IN_DIGITS, {IN_DIGITS, AFTER_BLANK}),
        (OTHER, IN_OTHER, {IN_OTHER, AFTER_BLANK}),
        (INNER, IN_SPACE, {IN_SPACE}),
        (LAST, START, set()),
        (BLANK, AFTER_BLANK, set()),
    ):
        after[cls] = state
        starts[cls] = [before not in same for before in range(9)]
    after[SEP] = START
    starts[SEP] = True
    after[LETTER, IN1] = DONE
    after[LETTER, IN2] = IN1
    # An apostrophe opens a contraction only where a pre-token starts.
    for cls, state in ((S1, IN1), (S2, IN2)):
        starts[cls] = starts[OTHER]
        after[cls] = np.where(starts[OTHER], state, IN_OTHER)
    return after, starts


AFTER, STARTS = _moves()


@cache
def _monoid() -> tuple[np.ndarray, np.ndarray]:
    """All functions the classes generate (row: state after, by state before) and their composition table."""
    functions = [tuple(row) for row in AFTER]
    known = {f: n for n, f in enumerate(dict.fromkeys(functions))}
    queue = list(known)
    for f in queue:
        for g in [tuple(row) for row in AFTER]:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    rows = np.array(list(known), np.uint8)
    size = len(rows)
    compose = np.empty((size, size), np.uint8)
    for a, f in enumerate(rows):
        for b, g in enumerate(rows):
            compose[a, b] = known[tuple(g[f])]
    return rows, compose


@cache
def _first_ids() -> np.ndarray:
    """The function of each class as a number of the monoid."""
    rows, _ = _monoid()
    known = {tuple(row): n for n, row in enumerate(rows)}
    return np.array([known[tuple(row)] for row in AFTER], np.uint8)


@cache
def _classes() -> np.ndarray:
    """Class of each code point; white space is INNER here."""
    found = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            found[point] = LETTER
        elif kind == "N":
            found[point] = DIGIT
    for ranges, kind in ((NEWER_LETTERS, LETTER), (NEWER_NUMBERS, DIGIT)):
        for first, last in ranges:
            found[first : last + 1] = kind
    found[WHITE] = INNER
    found[BREAK] = SEP
    return found


def classify(points: np.ndarray) -> np.ndarray:
    """Classes of a run of texts, each followed by BREAK."""
    classes = _classes()[points]
    white = np.flatnonzero(classes == INNER)
    following = classes[np.minimum(white + 1, len(points) - 1)]
    last = white[(following != INNER) & (following != SEP)]
    classes[last] = np.where(points[last] == 32, BLANK, LAST)
    quote = np.flatnonzero(points == 39)
    if len(quote):
        one = points[np.minimum(quote + 1, len(points) - 1)]
        two = points[np.minimum(quote + 2, len(points) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (
            ((one == ord("r")) & (two == ord("e")))
            | ((one == ord("v")) & (two == ord("e")))
            | ((one == ord("l")) & (two == ord("l")))
        )
        classes[quote[short]] = S1
        classes[quote[long]] = S2
    return classes


def states_before(classes: np.ndarray) -> np.ndarray:
    """The automaton's state before each code point, by a scan over composed functions."""
    rows, compose = _monoid()
    constant = (rows == rows[:, :1]).all(axis=1)
    scan = _first_ids()[classes]
    span = 1
    while span < len(scan):
        # Only what is not constant yet depends on what stands further left.
        open_ends = np.flatnonzero(~constant[scan])
        open_ends = open_ends[open_ends >= span]
        if not len(open_ends):
            break
        scan[open_ends] = compose[scan[open_ends - span], scan[open_ends]]
        span *= 2
    before = np.empty(len(scan), np.uint8)
    before[:1] = START
    before[1:] = rows[scan[:-1], START]
    return before


def boundaries(points: np.ndarray) -> np.ndarray:
    """Positions where pre-tokens start; BREAK counts as one."""
    classes = classify(points)
    return np.flatnonzero(STARTS[classes, states_before(classes)])


@cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged first, the leftmost among equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 512:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks)
    costs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while costs:
        least = min(costs)
        if least == none:
            break
        at = costs.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del costs[at]
        if at < len(costs):
            costs[at] = ranks.get(parts[at] + parts[at + 1], none)
        if at:
            costs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
    return [ranks[part] for part in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for long pre-tokens, with a heap over a linked list."""
    import heapq

    size = len(piece)
    end = list(range(1, size + 1))  # end of the part that starts here; 0 once it is merged away
    prev = list(range(-1, size - 1))
    heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, at, stop = heapq.heappop(heap)
        middle = end[at]
        if not middle or middle >= size or end[middle] != stop:
            continue
        end[at], end[middle] = stop, 0
        if stop < size:
            prev[stop] = at
            if (r := ranks.get(piece[at : end[stop]])) is not None:
                heapq.heappush(heap, (r, at, end[stop]))
        if (left := prev[at]) >= 0 and (r := ranks.get(piece[left:stop])) is not None:
            heapq.heappush(heap, (r, left, stop))
    ids, at = [], 0
    while at < size:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


class _Merged(dict):
    """Ids of the pre-tokens met lately, of bounded size: what an old generation is asked for moves to the new one."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.old: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece) or tuple(merge(piece.encode(), self.ranks))
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


@cache
def _merged(path: str) -> _Merged:
    return _Merged(load_ranks(path))


@cache
def _pieces_of(path: str) -> list[bytes]:
    ranks = load_ranks(path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def encode(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array, and the end of each text's ids."""
    if not texts:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    joined = chr(BREAK).join(texts) + chr(BREAK)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = boundaries(points)
    known = _merged(path)
    cuts = starts.tolist()
    stops = np.flatnonzero(points[starts] == BREAK)
    known_get = known.__getitem__
    ids: list[int] = []
    ends = np.empty(len(texts), np.int64)
    first = 0
    for text, stop in enumerate(stops.tolist()):
        spans = map(slice, cuts[first:stop], cuts[first + 1 : stop + 1])
        ids.extend(chain.from_iterable(map(known_get, map(joined.__getitem__, spans))))
        ends[text] = len(ids)
        first = stop + 1
    return np.array(ids, np.uint32), ends


def decode(ids: np.ndarray, path: str) -> tuple[bytes, np.ndarray]:
    """The bytes of the ids, and where each id's bytes end."""
    parts = list(map(_pieces_of(path).__getitem__, ids.tolist()))
    return b"".join(parts), np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))


def encoded(docs: DataFrame, ranks: str) -> DataFrame:
    """Ids of each document, and the byte offset in the text where each id ends.

    The ids are decoded again; a document whose bytes do not come back fails the job.
    """

    def work(batch, texts):
        ids, ends = encode([text.decode() for text in texts], ranks)
        decoded, stops = decode(ids, ranks)
        if decoded != b"".join(texts):
            raise ValueError("decoded tokens differ from the text")
        counts = np.diff(ends, prepend=0)
        before = np.concatenate([[0], np.cumsum([len(text) for text in texts])])[:-1]
        bounds = pa.array(np.concatenate([[0], ends]), pa.int32())
        return {
            "doc_id": batch.column(0),
            "n_tokens": counts,
            "ids": pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int32))),
            "ends": pa.ListArray.from_arrays(bounds, pa.array((stops - np.repeat(before, counts)).astype(np.int32))),
        }

    return map_texts(docs.select("doc_id", "text"), "text", TOKENS_SCHEMA, work)


def token_digests(docs: DataFrame, ranks: str) -> DataFrame:
    """Number and hash of each document's ids, and the hash of what they decode to."""

    def work(batch, texts):
        ids, ends = encode([text.decode() for text in texts], ranks)
        table = _pieces_of(ranks).__getitem__
        listed = ids.tolist()
        rows: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        first = 0
        for end in ends.tolist():
            rows["n_tokens"].append(end - first)
            rows["ids_sha256"].append(hashlib.sha256(ids[first:end].astype("<u4")).hexdigest())
            decoded = b"".join(map(table, listed[first:end]))
            rows["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
            first = end
        return {"doc_id": batch.column(0)} | rows

    return map_texts(docs.select("doc_id", "text"), "text", SCHEMA, work)
