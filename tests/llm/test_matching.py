"""License scan, decontamination and Jaccard join against plain comparison of all pairs."""

from __future__ import annotations

import pickle
import random
import re
from collections import Counter

import numpy as np
import pytest
from samples import prose, texts

from kilnwatch.llm import components, decontaminate, jaccard, license


def shingles(words, size=5):
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def plain_classes(rows):
    """Class and number of links of each row with an id, by comparing all pairs."""
    sets = []
    for key, text in rows:
        words = (text or "").encode().split()
        sets.append(shingles(words) or ({tuple(words)} if words else set()))
    ids = [key for key, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if ids[a] is None or ids[b] is None or not sets[a] or not sets[b]:
                continue
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for x, key in enumerate(ids):
        if key is not None:
            least[root(x)] = min(key, least.get(root(x), key))
    return Counter((key, None if key is None else least[root(x)], links[x]) for x, key in enumerate(ids))


def unique_ids(rows):
    """The rows whose id stands for one text."""
    by_id = {}
    for key, text in rows:
        by_id.setdefault(key, set()).add(text)
    return [(key, text) for key, text in rows if key is None or len(by_id[key]) == 1]


def near_copies(seed, groups=12, size=7):
    rng = random.Random(seed)
    rows, key = [], 0
    for _ in range(groups):
        base = prose(rng, rng.choice([30, 80, 200])).split(" ")
        for _ in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = prose(rng, 1)
            rows.append((key, " ".join(copy)))
            key += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes(documents, seed):
    rows = unique_ids(texts()) + [(1000 + k, t) for k, t in near_copies(seed)]
    found = Counter(map(tuple, jaccard.jaccard_classes(documents(rows)).collect()))
    assert found == plain_classes(rows)


@pytest.mark.parametrize("held", [6, 1 << 14])
def test_large_groups_are_split_and_dealt_as_blocks(documents, monkeypatch, held):
    monkeypatch.setattr(jaccard, "LEAF", 8)
    monkeypatch.setattr(jaccard, "HELD", held)
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    rows = near_copies(4, groups=3, size=40)
    found = Counter(map(tuple, jaccard.jaccard_classes(documents(rows)).collect()))
    assert found == plain_classes(rows)


@pytest.mark.parametrize("held", [6, 1 << 14])
def test_pairs_inside_large_buckets_meet(documents, monkeypatch, held):
    monkeypatch.setattr(jaccard, "LEAF", 4)
    monkeypatch.setattr(jaccard, "HELD", held)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(12)
    template, rows = prose(rng, 70), []
    for number in range(60):
        body = f"{template} {prose(rng, 50)}"
        rows += [(2 * number, body), (2 * number + 1, f"{body} {prose(rng, 12)}")]
    want = plain_classes(rows)
    assert sorted(want) == [(key, key // 2 * 2, 1) for key in range(120)]
    assert Counter(map(tuple, jaccard.jaccard_classes(documents(rows)).collect())) == want


def test_a_bucket_is_split_to_its_end():
    """Of a bucket of pairs, each pair meets about as often as the survival over all splits says; dense ones always."""
    rng = np.random.default_rng(8)
    lanes = rng.integers(0, 1 << 32, (1200, jaccard.LANES), np.uint32)
    lanes[1::2] = np.where(rng.random((600, jaccard.LANES)) < 0.8, lanes[::2], lanes[1::2])
    met = set()
    runs = 8
    for run in range(runs):
        path = np.uint64(run * 77 + 5)
        pairs = jaccard.bucket_links(lanes, path, 1, 16, jaccard.DEPTH)
        assert all(a // 2 == b // 2 for a, b in pairs)
        met |= {a // 2 for a, _ in pairs}
    agreeing = (lanes[::2] == lanes[1::2]).sum(axis=1)
    expected = sum(1 - (1 - jaccard.survival(int(n))) ** runs for n in agreeing if n >= jaccard.CANDIDATE * jaccard.LANES)
    assert len(met) >= 0.97 * expected
    same = np.where(rng.random((3000, jaccard.LANES)) < 0.9, lanes[0], rng.integers(0, 1 << 32, (3000, jaccard.LANES), np.uint32))
    links = jaccard.bucket_links(same, np.uint64(3), 1, 16, jaccard.DEPTH)
    reached = {0}
    for a, b in sorted(links):
        reached |= {a, b}
    assert len(reached) == 3000


def test_clashing_columns_of_one_of_each(documents):
    rows = near_copies(7)
    plain = documents(rows)
    names = ("row_key", "row_class", "row_place", "set_k1", "k1", "class", "class_id", "text_key", "Row_Key_")
    extra = plain.selectExpr("*", *[f"doc_id AS {n}" for n in names])
    kept = jaccard.one_of_each(extra)
    assert kept.columns == extra.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in jaccard.one_of_each(plain).collect())
    assert sorted(map(tuple, jaccard.jaccard_classes(extra).collect())) == sorted(map(tuple, jaccard.jaccard_classes(plain).collect()))


def test_runs_cover_all_splits():
    # A pair at 0.8 in buckets that are split DEPTH times, drawn from the chosen coordinates themselves.
    rng = np.random.default_rng(3)
    met = 0
    for trial in range(2000):
        equal = rng.random(jaccard.LANES) < jaccard.SIMILARITY
        paths = rng.integers(0, 1 << 63, 1, np.uint64)
        for depth in range(jaccard.DEPTH):
            _, lane = np.nonzero(jaccard.chosen(paths, jaccard.AGAIN if depth else 1) & equal)
            paths = rng.integers(0, 1 << 63, len(lane), np.uint64)
        met += len(paths) > 0
    assert (1 - met / 2000 - 0.04) ** jaccard.RUNS < jaccard.MISSED and jaccard.missed(jaccard.RUNS) < jaccard.MISSED


def test_repeated_ids_join_their_classes(documents):
    a, b = prose(random.Random(1), 50), prose(random.Random(2), 50)
    rows = [(1, a), (1, b), (2, a), (3, b), (4, "alone " + prose(random.Random(3), 40))]
    found = {r["doc_id"]: r["class_id"] for r in jaccard.jaccard_classes(documents(rows)).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4}


def test_one_of_each_stays(documents):
    rows = [*near_copies(6), (None, "no id"), (None, "no id"), (900, None)]
    kept = Counter(r["doc_id"] for r in jaccard.one_of_each(documents(rows)).collect())
    classes = plain_classes(rows)
    assert kept == Counter({None: 2, **{key: 1 for key, least, _ in classes if key is not None and key == least}})
    assert jaccard.jaccard_classes(documents([])).collect() == []


def test_rows_of_repeated_ids_are_judged_by_text(documents):
    rng = random.Random(21)
    x, y, z = (prose(rng, 50) for _ in range(3))
    rows = [(1, x), (3, x), (3, y), (5, z), (5, z), (6, z), (5, f"{z} "), (5, None), (5, None)]
    found = Counter(map(tuple, jaccard.jaccard_classes(documents(rows)).collect()))
    assert found == plain_classes(rows)
    kept = Counter((r["doc_id"], r["text"]) for r in jaccard.one_of_each(documents(rows)).collect())
    assert kept == Counter([(1, x), (3, y), (5, z), (5, None), (5, None)])


def test_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 50, rng.integers(1, 30)).astype(np.uint64)) for _ in range(9)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    found = jaccard.intersections(np.concatenate(sets), bounds, np.arange(9), np.array([2, 5]))
    for a in range(9):
        for place, b in enumerate((2, 5)):
            assert a == b or found[a, place] == len(np.intersect1d(sets[a], sets[b]))


def test_components(spark):
    rng = random.Random(8)
    chain = [(i, i + 1) for i in range(100, 160)]
    links = chain + [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in links:
        parent[max(root(u), root(v))] = min(root(u), root(v))
    found = components.components(spark.createDataFrame(links, "u bigint, v bigint"))
    want = {x: root(x) for x in parent if any(x in link and link[0] != link[1] for link in links)}
    assert {r["node"]: r["component"] for r in found.collect()} == want


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_leaks(spark, documents, monkeypatch):
    rng = random.Random(3)
    items = [(i, prose(rng, rng.choice([7, 12, 30, 64, 130]))) for i in range(40)] + [(50, None), (51, "too short"), (None, prose(rng, 20))]
    docs = texts()
    for number in range(40):
        words = items[number][1].split(" ")
        for cut in (0, 2, len(words) // 2):
            noise = prose(rng, rng.choice([0, 50, 900]))
            docs.append((200 + 3 * number + cut % 3, noise + " ".join(words[cut:]).upper() + " " + noise))
    docs.append((400, "Quoted: «" + items[3][1].strip() + "»!"))

    def plain(text):
        return re.findall(r"[0-9a-z_\x80-\U0010ffff]+", decontaminate.PUNCTUATION.sub(" ", (text or "").lower()))

    want, clean = Counter(), Counter()
    for key, text in docs:
        own, leaking = shingles(plain(text)), False
        for item, body in items:
            wanted = shingles(plain(body))
            if wanted and len(own & wanted) >= 0.8 * len(wanted):
                want[key, item, len(wanted), len(own & wanted)] += 1
                leaking = True
        clean[key, text] += not leaking
    assert len(want) > 50
    for block in (decontaminate.BLOCK_BYTES, 2000):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        table = benchmark(spark, items)
        assert Counter(tuple(r)[:4] for r in decontaminate.leaks(documents(docs), table).collect()) == want
        kept = Counter((r["doc_id"], r["text"]) for r in decontaminate.decontaminated(documents(docs), table).collect())
        assert kept == +clean
    assert decontaminate.leaks(documents([]), table).collect() == []
    assert decontaminate.leaks(documents(docs), table.limit(0)).collect() == []


def test_licenses(documents):
    rng = random.Random(4)
    rows = texts()
    for number, (_, body) in enumerate(license.TEMPLATES.items()):
        before, after = prose(rng, rng.choice([0, 3, 40, 700])), prose(rng, rng.choice([0, 5, 90]))
        rows.append((100 + number, f"{before} {body.upper()} {after}"))
        words = body.split(" ")
        rows.append((200 + number, f"{before} {' '.join(words[: len(words) * 9 // 10])} {after}"))
        rows.append((300 + number, f"{before} {' '.join(words[: len(words) // 2])} {after}"))

    def plain(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    want = set()
    for key, text in rows:
        words = plain(text)
        for name, body in license.TEMPLATES.items():
            wanted = shingles(plain(body))
            if not wanted:
                continue
            least = 1 << (len(wanted).bit_length() - 1)
            for start in range(0, max(1, len(words)), 2 * least):
                if len(shingles(words[start : start + 4 * least + 4]) & wanted) >= 0.8 * len(wanted):
                    want.add((key, name))
    found = [(r["doc_id"], r["template"]) for r in license.licenses(documents(rows)).collect()]
    assert set(found) == want and len(found) == len(want) >= len(license.TEMPLATES)
    assert license.licenses(documents([])).collect() == []
    assert license.licenses(documents(rows), {}).collect() == []


def test_an_index_of_items_has_the_size_it_is_told():
    """What the driver builds and tasks hold is arrays and texts, not objects for each shingle."""
    rng = random.Random(9)
    items = [(k, prose(rng, 12)) for k in range(20_000)]
    told = decontaminate.index_bytes(len(items), sum(len(text.encode()) for _, text in items))
    index = decontaminate.ItemIndex(items)
    assert len(pickle.dumps(index)) <= told and told < decontaminate.BLOCK_BYTES
    found = decontaminate.found_in(index, [f"{items[7][1]} and {items[19_000][1]}".encode(), b"nothing of it"])
    assert {item for doc, item, size, count in found if size == count} >= {7, 19_000} and {f[0] for f in found} == {0}


def test_a_long_text_full_of_notices(documents):
    """Windows carry their own words only, so that the work follows the length of the text."""
    body = license.TEMPLATES["MIT"] + " " + prose(random.Random(4), 40) + " "
    rows = [(1, body * 150), (2, body)]
    found = {(r["doc_id"], r["template"], r["containment"], r["word"]) for r in license.licenses(documents(rows)).collect()}
    assert {(1, "MIT", 1.0, 0), (2, "MIT", 1.0, 0)} <= found
