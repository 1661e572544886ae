"""Quality rules, tokens, secrets, pages and archives on small cases."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import prose, texts

from kilnwatch.llm import html, quality, secret_scan, tokens, warc
from kilnwatch.llm.queries import RANKS

PATH = public_tokenizers.path(RANKS)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokens.load_ranks(PATH), special_tokens={}
    )


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sdtmrevlS  \n\t\r1²!?.,-éßñ中́😀  \u0085"), max_size=16), max_size=4))
def test_tokens_of_awkward_texts(cases):
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokens.load_ranks(PATH), special_tokens={}
    )
    ids, ends = tokens.encode(cases, PATH)
    first = 0
    for text, end in zip(cases, ends.tolist(), strict=True):
        assert ids[first:end].tolist() == known.encode_ordinary(text)
        assert tokens.decode(ids[first:end], PATH)[0] == text.encode()
        first = end


def test_tokens_of_long_runs(reference):
    for text in ("a" * 3000, "!?" * 2000, "xyz " * 10 + " " * 5000, "ab" * 1500):
        assert tokens.encode([text], PATH)[0].tolist() == reference.encode_ordinary(text)


def test_every_code_point_in_three_contexts(reference):
    points = [chr(p) for p in range(0x110000) if not 0xD800 <= p <= 0xDFFF]
    for before, after in (("", "'s "), ("a1", "1a "), (" ", ". ")):
        texts = [
            "".join(f"{before}{c}{after}" for c in points[at : at + 4096]) for at in range(0, len(points), 4096)
        ]
        ids, ends = tokens.encode(texts, PATH)
        found = np.split(ids, ends[:-1])
        for k, want in enumerate(reference.encode_ordinary_batch(texts)):
            assert found[k].tolist() == want, hex(k * 4096)


def test_token_queries(documents, reference):
    rows = texts()
    found = Counter(map(tuple, tokens.token_digests(documents(rows), PATH).collect()))
    want = Counter()
    for key, text in rows:
        ids = reference.encode_ordinary(text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want[key, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert found == want
    for row in tokens.encoded(documents(rows), PATH).collect():
        assert len(row["ids"]) == len(row["ends"]) == row["n_tokens"] and row["ends"] == sorted(row["ends"])
    assert tokens.token_digests(documents([]), PATH).collect() == []


def base_counts(text):
    words = text.encode().split()
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if line.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(inside), len(words) < 20 or 100 * len(inside) > 30 * len(words),
    )


def test_quality_base_rules(documents):
    rows = [*texts(), (40, "a b c d e f g h " * 9), (41, "# * $ | <x>\nline\nline\n \nline"), (42, "p q r s t u v w " * 2 + prose(random.Random(1), 99))]
    found = Counter((r[0], *r[1:7]) for r in quality.quality(documents(rows)).collect())
    assert found == Counter((key, *base_counts(text or "")) for key, text in rows)
    assert quality.quality(documents([])).collect() == []


def test_quality_bands(documents):
    rng = random.Random(3)
    noise = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=40)) for _ in range(60))
    few = " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(600))
    plain = prose(rng, 700)
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(documents([(1, noise), (2, few), (3, plain)])).collect()}
    assert kept == {1: False, 2: False, 3: True}
    assert [r["doc_id"] for r in quality.good(documents([(1, noise), (2, few), (3, plain), (4, None)])).collect()] == [3]
    packer = zstandard.ZstdCompressor(level=3)
    assert quality.judge(b"", packer)[quality.KEPT] is False


@pytest.mark.parametrize("size", [60 << 10, 128 << 10, 512 << 10, 3 << 20])
def test_long_clean_texts_stay(size):
    # Ratios of joined clean texts, as measured; and a text that repeats its half.
    measured = {60 << 10: 0.39, 128 << 10: 0.383, 512 << 10: 0.363, 3 << 20: 0.361}[size]
    low, high = quality.band(size)
    assert 0.21 < low <= measured - quality.MARGIN and measured < high


def test_forest_on_held_out_findings(documents):
    forest = secret_scan.fit(documents(texts()))
    rows = secret_scan.generated_rows(forest.language, 2000, seed=77)
    scores = forest.scores([row[:-1] for row in rows])
    right = sum((s >= secret_scan.THRESHOLD) == bool(row[-1]) for s, row in zip(scores, rows, strict=True))
    assert right >= 0.97 * len(rows)


@pytest.mark.parametrize(
    ("text", "name", "assigned"),
    [
        ("API_TOKEN=4d44c7a1b2e3f4a5b6c7", "API_TOKEN=", True),
        ("run password=hunter2hunter2", "run password=", True),
        ("MY_PRODUCTION_CLIENT_SECRET=zX81kk20QpLm77ab", "MY_PRODUCTION_CLIENT_SECRET=", True),
        ("key=4d44c7a1b2e3f4a5b6c7", "key=", False),
        ("some_long_setting_name=b3BlbnNlc2FtZTEyMzQ1Ng==", "some_long_setting_name=", False),
    ],
)
def test_value_of_unspaced_assignment(text, name, assigned):
    found = secret_scan.candidates(text)
    assert (found[-1].start, found[-1].value, found[-1].assigned) == (len(name), text[len(name) :], assigned)
    for a, b in zip(found, found[1:], strict=False):
        assert a.start + len(a.value) <= b.start


def test_runs_beside_assignments_stay():
    key = "9f8e7d6c5b4a39281706"
    text = f"{key} token={key} {key}/password=hunter2 ab=cd=ef=gh=ij=kl"
    places = [(c.start, c.value) for c in secret_scan.candidates(text)]
    first = len(key) + 7
    second = first + len(key) + 1
    after = second + len(key) + 10
    assert places == [(0, key), (first, key), (second, key), (after, "hunter2"), (after + 8, "ab=cd=ef=gh=ij=kl")]


def test_language_covers_all_documents(documents, monkeypatch):
    monkeypatch.setattr(secret_scan, "SAMPLE_DOCS", 2)
    monkeypatch.setattr(secret_scan, "COUNTED", 5)
    rows = [*((key, f"Common WORDS number w{key:03d} qz") for key in range(60)), (None, "zyxzyx zyxzyx"), (3, None)]
    language = secret_scan.fit(documents([*rows, (70, "rarely " * 3)])).language
    words = Counter("common words number".split() * 60 + ["zyxzyx"] * 2 + ["rarely"] * 3)
    assert words.keys() <= language.words
    pairs = Counter(a + b for word, n in words.items() for a, b in zip(word, word[1:], strict=False) for _ in range(n))
    firsts = Counter(pair[0] for pair in pairs.elements())
    assert language.bits == {pair: -math.log2(n / firsts[pair[0]]) for pair, n in pairs.items()}


def test_bare_keys_get_no_label():
    language = secret_scan.Language({}, frozenset())

    def told(text):
        (found,) = secret_scan.candidates(text)
        return secret_scan.label(found, secret_scan.features(text, found, "src0", language))

    key = "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e"
    assert [told(t) for t in (key, f"token={key}", f"commit {key}", "token=your_token_here")] == [None, 1.0, 0.0, 0.0]


def test_secrets_found_and_replaced(documents):
    key = "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e"
    rows = [
        (1, f'before token = "{key}" after'), (2, "plain words with 4111111111111111 and a.b.58@mail5.example.com only"),
        (3, None), (4, ""), (5, f'é password: "{key[:24]}x"\ntoken = "{key}"'), (1, f'before token = "{key}" after'),
    ]
    found = secret_scan.secrets(documents(rows)).collect()
    assert Counter(r["doc_id"] for r in found) == {1: 2, 5: 2}
    assert all(rows[0][1][r["start"] : r["start"] + r["length"]] == key for r in found if r["doc_id"] == 1)
    clean = Counter((r["doc_id"], r["text"], r["n_chars"]) for r in secret_scan.redacted(documents(rows)).collect())
    mark = secret_scan.MARK
    first = f'before token = "{mark}" after'
    fifth = f'é password: "{mark}"\ntoken = "{mark}"'
    assert clean == Counter([(1, first, len(first))] * 2 + [(5, fifth, len(fifth)), (2, rows[1][1], len(rows[1][1])), (3, None, None), (4, "", 0)])
    assert secret_scan.secrets(documents([])).collect() == []


PAGES = [
    ("", ""),
    ("only text", "only text"),
    ("<html><body>hi <b>there</b> you.</body></html>", "hi there you."),
    (
        '<head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=x>Menu'
        "</a></ul></nav><div class='ad'>Buy!</div><article><h1>A  title</h1><p><b>One&nbsp;&amp; two,\n three.<br><p>Next"
        " block.</p><form>Mail <input></form><section id=comments><p>I disagree, loudly.</p></section></article>"
        "<aside>Side</aside><footer>&copy; X</footer>",
        "A title\nOne & two, three.\nNext block.",
    ),
    (
        "<div id=top><a href=1>Home</a> <a href=2>News</a></div><div class=text><p>A long paragraph of text, with several"
        " marks; it goes on, and on. And ends.</p><p>Another one follows here, as long as that.</p></div><div><a href=3>"
        "More</a></div>",
        "A long paragraph of text, with several marks; it goes on, and on. And ends.\nAnother one follows here, as long"
        " as that.",
    ),
    ("<p>unclosed <i>tags<p>and a < b &lt; c", "unclosed tags\nand a < b < c"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_main_text_query(spark, documents):
    rows = [(i, None if i == 3 else f"http://x/{i}", page) for i, (page, _) in enumerate(PAGES)] + [(99, "u", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in html.main_texts(pages).collect()}
    assert found == {i: (u, PAGES[i][1] if h is not None else "", len(PAGES[i][1]) if h is not None else 0) for i, u, h in rows}
    assert html.main_texts(pages.limit(0)).collect() == []


def test_archives_round_trip(spark, documents, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "SHARD_BYTES", 4000)
    long, short = "<p>" + "long page ß " * 20, "short"
    rng = random.Random(2)
    rows = [(i, f"http://x/{i}", rng.choice([long, short, prose(rng, 80), None])) for i in range(60)]
    rows += [(-3, "http://x/a b\n", long), (None, None, long), (70, None, prose(rng, 900)), (-3, "http://x/again", long)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    folders = [f"file://{tmp_path}/{n}" for n in "ab"]
    manifests = [warc.write_archives(pages, folder, 700) for folder in folders]
    names = [sorted(map(tuple, m.collect())) for m in manifests]
    # The same bytes whatever the order of the input, and several shards and files.
    assert names[0] == names[1] and len({n[0] for n in names[0]}) > 2 and max(n[1][13:18] for n in names[0]) > "00000"
    found = Counter(map(tuple, warc.read_archives(manifests[0], folders[0]).collect()))
    want = Counter()
    for page_id, _, page in rows:
        data = (page or "").encode()
        same = [i for i, _, p in rows if p == page and i is not None]
        revisit = len(data) >= 100 and page_id is not None and page_id > min(same)
        want[page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", min(same) if revisit else None] += 1
    assert found == want
    assert not list(tmp_path.glob("*/_temporary*"))
    assert warc.archived(pages.limit(0)).collect() == []


def test_shards_follow_bytes_not_ids(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 20000)
    ids = [*range(200), 1 << 60, -(1 << 61), *[None] * 100]
    rows = [(key, "u", f"{place} " * 300) for place, key in enumerate(ids)]
    payloads = warc.with_payloads(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    shard, count, wide = warc.shard_of(payloads)
    assert wide == 20000
    held = payloads.select("page_id", "size", shard.alias("shard")).collect()
    bytes_of: Counter[int] = Counter()
    for r in held:
        bytes_of[r["shard"]] += r["size"] + 512
    assert set(bytes_of) <= set(range(count)) and count <= sum(bytes_of.values()) // 20000 + 2
    known = sorted((r["page_id"], r["shard"]) for r in held if r["page_id"] is not None)
    assert [s for _, s in known] == sorted(s for _, s in known)
    assert max(bytes_of[s] for _, s in known) <= 20000 + 2000
    assert len({r["shard"] for r in held if r["page_id"] is None}) > 2
    assert not {s for _, s in known} & {r["shard"] for r in held if r["page_id"] is None}


def test_files_roll_inside_shards_of_production_size(spark, documents, tmp_path):
    """With the parameters as they are, and with shards widened by a bound on their number."""
    rng = random.Random(5)
    page = "".join(f"<p>{prose(rng, 30)}</p>" for _ in range(10))
    rows = spark.range(9000, numPartitions=8).selectExpr("id AS page_id", "'u' AS url", "concat(id, sha2(string(id), 512), '" + page.replace("'", "") + "', sha2(string(id + 1), 512), sha2(string(id + 2), 512), sha2(string(id + 3), 512)) AS html")
    made = warc.write_archives(rows, f"file://{tmp_path}/rolls").collect()
    files = Counter(r["shard"] for r in made)
    assert sum(r["records"] for r in made) == 9000
    assert len(files) >= 1 and max(files.values()) > 2
    assert all(r["bytes"] <= warc.SHARD_BYTES // warc.ROLLS for r in made)


def test_the_number_of_shards_is_bounded(spark, documents, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 1000)
    monkeypatch.setattr(warc, "MOST_SHARDS", 7)
    pages = spark.range(500).selectExpr("id AS page_id", "'u' AS url", "repeat('x', 300) AS html")
    payloads = warc.with_payloads(pages)
    shard, count, wide = warc.shard_of(payloads)
    assert 1 < count <= 8 and wide > 1000
    assert payloads.select(shard.alias("s")).distinct().count() == count


def test_damaged_archives_are_refused():
    record = warc.page_record(1, "http://x", b"body", hashlib.sha256(b"body").hexdigest(), None)
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record.replace(b"body", b"bodz"))
