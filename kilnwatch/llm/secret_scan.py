"""Secret scans: a random forest that removes false findings (operator 7).

Wide patterns propose candidates in the whole text: values after an assignment to a name such as ``token`` or
``password``, and long runs of letters, digits and symbols that are no plain word. A forest then decides by length,
character transitions, dictionary coverage, the document's path and the neighbouring words.

Character transitions and the dictionary are counted over all documents. The forest is fitted on labelled findings:
``GENERATED`` made-up ones whose kind is known (keys and passwords against checksums, identifiers, placeholders, file
names), and at most ``SAMPLE_ROWS`` candidates of at most ``SAMPLE_DOCS`` documents, those whose ids hash lowest. Of
these, values assigned to a name of a secret count as secrets and placeholders or values after a harmless word alone as
none; bare values tell nothing and get no label. Everything else sees all documents.

Defined results: null and empty texts have no findings; a null path counts as unknown; repeated rows give equal rows;
an empty table gives an empty result (the forest is then fitted on made-up findings alone); extra columns are ignored by
the scan and kept by redaction.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatch.llm.tables import _arrow_schema, as_bytes, map_texts, pieces, written
from kilnwatch.session import shared_folder

SAMPLE_DOCS = 1000
#: Labelled candidates of the sample that come to the driver.
SAMPLE_ROWS = 20000
#: Words of the dictionary, and different words that a task counts before it hands them on.
USUAL_WORDS = 4000
COUNTED = 1 << 17
GENERATED = 6000
TREES = 24
DEPTH = 8
#: Share of the trees' votes from which a candidate is a secret.
THRESHOLD = 0.5
MARK = "[SECRET]"
SCHEMA = "doc_id bigint, start bigint, length bigint, score double, value_sha256 string"

NAMES = (
    r"(?:token|secret|passw(?:or)?d|passwd|pwd|passphrase|api[_\-]?key|access[_\-]?key|private[_\-]?key|secret[_\-]?key"
    r"|client[_\-]?secret|auth|credentials?|bearer|apikey)"
)
ASSIGNED = re.compile(rf"{NAMES}[\"']?\s*(?::=|[:=]|=>)\s*[\"'`]?([^\s\"'`,;|]{{6,}})", re.I)
RUN = re.compile(r"[A-Za-z0-9][A-Za-z0-9_+/=~\-]{14,}")
#: What a run is cut to where it holds '=' between others: the name before it is not part of the value.
PART = re.compile(
    r"[A-Za-z0-9](?:[A-Za-z0-9_+/~\-]{14,}(?:={1,2}(?![A-Za-z0-9_+/=~\-]))?"
    r"|[A-Za-z0-9_+/~\-]{12,13}==(?![A-Za-z0-9_+/=~\-])|[A-Za-z0-9_+/~\-]{13}=(?![A-Za-z0-9_+/=~\-]))"
)
SECRET_WORDS = frozenset(
    "token secret password passwd pwd passphrase key apikey auth credential credentials bearer private access".split()
)
HARMLESS_WORDS = frozenset(
    "commit sha sha1 sha256 md5 hash checksum digest uuid guid id revision example sample dummy placeholder test mock"
    " version build etag integrity file image url".split()
)
HARMLESS_PATHS = re.compile(r"(?:^|[/_.\-])(?:tests?|examples?|samples?|docs?|fixtures?|mocks?|demo)(?:[/_.\-]|$)", re.I)
SECRET_PATHS = re.compile(r"\.(?:env|ya?ml|ini|cfg|conf|properties|tfvars|pem|json|toml)$|credential|secret", re.I)
WORD = re.compile(r"[A-Za-z0-9]+")
LETTERS = re.compile(r"[a-z]{3,}")
FEATURES = [
    "length", "entropy", "transition_bits", "class_changes", "digits", "upper", "symbols", "hex", "coverage",
    "placeholder", "secret_words", "harmless_words", "assigned", "quoted", "harmless_path", "secret_path",
]


@dataclass
class Language:
    """Bits of each character transition, and the words of the dictionary."""

    bits: dict[str, float]
    words: frozenset[str]

    @classmethod
    def of(cls, docs: DataFrame) -> Language:
        """Counted over all texts; at most ``USUAL_WORDS`` words and all pairs of letters come to the driver."""
        counted = written(word_counts(docs).groupBy("term").agg(F.sum("n").alias("n")), "language")
        pairs = dict(counted.where(F.length("term") == 2).collect())
        usual = counted.where(F.length("term") > 2).orderBy(F.desc("n"), "term").limit(USUAL_WORDS).collect()
        firsts: Counter[str] = Counter()
        for pair, count in pairs.items():
            firsts[pair[0]] += count
        bits = {pair: -math.log2(count / firsts[pair[0]]) for pair, count in pairs.items()}
        return cls(bits, frozenset([word for word, _ in usual] + [*SECRET_WORDS, *HARMLESS_WORDS]))

    def transition_bits(self, value: str) -> float:
        """Mean bits of the transitions of a value; those never met count as 10."""
        low = value.lower()
        if len(low) < 2:
            return 10.0
        return sum(self.bits.get(a + b, 10.0) for a, b in zip(low, low[1:], strict=False)) / (len(low) - 1)

    def coverage(self, value: str) -> float:
        """Share of the value's characters inside words of the dictionary, longest words first."""
        low = value.lower()
        at = covered = 0
        while at < len(low) - 2:
            for size in range(min(16, len(low) - at), 2, -1):
                if low[at : at + size] in self.words:
                    covered += size
                    at += size
                    break
            else:
                at += 1
        return covered / max(1, len(low))


def word_counts(docs: DataFrame) -> DataFrame:
    """term and n: words, and pairs of letters within them, with the times that tasks have met them."""
    schema = _arrow_schema(docs.sparkSession, "term string, n bigint")

    def counted(words: Counter[str]) -> pa.RecordBatch:
        pairs: Counter[str] = Counter()
        for word, count in words.items():
            for a, b in zip(word, word[1:], strict=False):
                pairs[a + b] += count
        terms = [*words.items(), *pairs.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*terms, strict=True), schema, strict=True)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        for batch in batches:
            for piece in pieces(batch, "text"):
                for text in as_bytes(piece, "text"):
                    words.update(LETTERS.findall(text.decode().lower()))
                if len(words) > COUNTED:
                    yield counted(words)
                    words.clear()
        if words:
            yield counted(words)

    return docs.select("text").mapInArrow(run, "term string, n bigint")


@dataclass(slots=True)
class Candidate:
    start: int
    value: str
    assigned: bool


def _runs(text: str, start: int, end: int) -> Iterator[Candidate]:
    """Runs between two places; of ``name=value`` the parts that are long enough alone, else the whole."""
    for m in RUN.finditer(text, start, end):
        parts = list(PART.finditer(text, m.start(), m.end())) if "=" in m[0] else []
        for part in parts or [m]:
            value = part[0].rstrip("-_/")
            # A plain word, in one case or with a capital first letter, is none.
            if not value.isalpha() or not (value[1:].islower() or value.isupper()):
                yield Candidate(part.start(), value, False)


def candidates(text: str) -> list[Candidate]:
    """Values that may be secrets, in order and without overlaps: assigned values, and runs in the text between them."""
    out: list[Candidate] = []
    at = 0
    for m in ASSIGNED.finditer(text) if "=" in text or ":" in text else ():
        if value := m[1].rstrip(".)]}>"):
            out += _runs(text, at, m.start())
            out.append(Candidate(m.start(1), value, True))
            at = m.start(1) + len(value)
    out += _runs(text, at, len(text))
    return out


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(text: str, c: Candidate, path: str | None, language: Language) -> list[float]:
    value, size = c.value, len(c.value)
    counts = Counter(value)
    entropy = -sum(n / size * math.log2(n / size) for n in counts.values())
    kinds = [_kind(x) for x in value]
    before = text[max(0, c.start - 48) : c.start]
    near = {w.lower() for w in WORD.findall(before)[-4:]}
    near |= {w.lower() for w in WORD.findall(text[c.start + size : c.start + size + 24])[:2]}
    low = value.lower()
    placeholder = (
        len(counts) <= 3
        or any(w in low for w in ("example", "changeme", "placeholder", "your", "dummy", "xxxx", "1234567", "abcdef"))
        or value[:1] in "<${%"
    )
    tail = before.rstrip("\"'` ")
    return [
        float(size),
        entropy,
        language.transition_bits(value),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / size,
        kinds.count(2) / size,
        kinds.count(1) / size,
        kinds.count(3) / size,
        float(all(x in string.hexdigits for x in value)),
        language.coverage(value),
        float(placeholder),
        float(len(near & SECRET_WORDS)),
        float(len(near & HARMLESS_WORDS)),
        float(c.assigned or tail.endswith(("=", ":", "=>"))),
        float(before.endswith(('"', "'", "`"))),
        float(bool(path and HARMLESS_PATHS.search(path))),
        float(bool(path and SECRET_PATHS.search(path))),
    ]


def generated_findings(count: int, seed: int = 11) -> list[tuple[str, str, str, float]]:
    """Made-up findings: text, value, path and whether it is a secret."""
    rng = random.Random(seed)
    hexes, mixed = "0123456789abcdef", string.ascii_letters + string.digits
    usual = "user name value file data config report summary section letter window garden river market".split()

    def some(alphabet: str, size: int) -> str:
        return "".join(rng.choices(alphabet, k=size))

    out = []
    for _ in range(count):
        secret = rng.random() < 0.5
        word = "_".join(rng.choices(usual, k=2))
        if secret:
            value = rng.choice(
                [
                    lambda: some(hexes, rng.choice([32, 40, 40, 64])),
                    lambda: some(hexes.upper(), rng.choice([32, 40])),
                    lambda: some(mixed, rng.randint(16, 48)),
                    lambda: some(mixed + "+/", 40),
                    lambda: "AKIA" + some(string.ascii_uppercase + string.digits, 16),
                    lambda: "ghp_" + some(mixed, 36),
                    lambda: "sk-" + some(mixed, 40),
                    lambda: some(mixed + "!#%&*", rng.randint(9, 16)),
                ]
            )()
            name = rng.choice("token secret password api_key access_key auth client_secret key".split())
            template = rng.choice(['{n} = "{v}"', "{n}: {v}", "{n}={v}", "{n.upper}='{v}'", 'my {n} = "{v}"', "{n} {v}"])
            path = rng.choice(["src0", "app/settings.yml", ".env", "lib/client.py", "src7", ""])
        else:
            value, name = rng.choice(
                [
                    lambda: (some(hexes, 40), rng.choice(["commit", "revision", "sha1", "checksum"])),
                    lambda: (some(hexes, 32), rng.choice(["md5", "etag", "hash"])),
                    lambda: ("-".join(some(hexes, n) for n in (8, 4, 4, 4, 12)), rng.choice(["id", "uuid", "guid"])),
                    lambda: (some(string.digits, rng.randint(15, 20)), rng.choice(usual)),
                    lambda: ("/".join(rng.choices(usual, k=4)) + "2", "file"),
                    lambda: ("".join(w.title() for w in rng.choices(usual, k=4)), rng.choice(usual)),
                    lambda: (word + "_" + word + some(string.digits, 1), rng.choice(usual)),
                    lambda: (rng.choice(["changeme", "your_token_here", "xxxxxxxxxxxx", "EXAMPLEKEY123456", "${TOKEN}"]),
                             rng.choice(["token", "password", "secret"])),
                    lambda: (rng.choice(usual), rng.choice(["password", "key", "token"])),
                ]
            )()
            template = rng.choice(['{n} = "{v}"', "{n}: {v}", "{n} {v}", "the {n} {v}"])
            path = rng.choice(["src0", "docs/guide.md", "tests/test_client.py", "lib/client.py", "src7", ""])
        before, after = " ".join(rng.choices(usual, k=3)), " ".join(rng.choices(usual, k=2))
        named = template.replace("{n.upper}", name.upper()).replace("{n}", name)
        out.append((f"{before} {named.replace('{v}', value)} {after}", value, path, float(secret)))
    return out


def generated_rows(language: Language, count: int, seed: int = 11) -> list[list[float]]:
    """Features and label of what is proposed in made-up findings: the same candidates as in any text."""
    rows = []
    for text, value, path, secret in generated_findings(count, seed):
        start = text.index(value)
        for c in candidates(text):
            held = c.start < start + len(value) and start < c.start + len(c.value)
            rows.append([*features(text, c, path, language), secret if held else 0.0])
    return rows


@dataclass
class Forest:
    """Trees as arrays: feature of each node (-1: leaf), threshold, children, probability of a secret."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    language: Language

    def scores(self, rows: list[list[float]]) -> np.ndarray:
        values = np.array(rows, float).reshape(-1, len(FEATURES))
        total = np.zeros(len(values))
        every = np.arange(len(values))
        for feature, limit, left, right, chance in self.trees:
            node = np.zeros(len(values), np.int64)
            while True:
                split = feature[node]
                inner = split >= 0
                if not inner.any():
                    break
                goes_left = values[every, np.maximum(split, 0)] <= limit[node]
                node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
            total += chance[node]
        return total / len(self.trees)

    def findings(self, text: str, path: str | None) -> list[tuple[Candidate, float]]:
        found = candidates(text)
        if not found:
            return []
        scores = self.scores([features(text, c, path, self.language) for c in found])
        return [(c, float(s)) for c, s in zip(found, scores, strict=True) if s >= THRESHOLD]


def label(c: Candidate, row: list[float]) -> float | None:
    """What a candidate in a document and its features tell of it; None: nothing."""
    told = dict(zip(FEATURES, row, strict=True))
    if told["placeholder"]:
        return 0.0
    if told["harmless_words"] and not told["secret_words"]:
        return 0.0
    return 1.0 if c.assigned else None


def labelled(docs: DataFrame, language: Language) -> list[list[float]]:
    """Features and label of candidates in a bounded sample of documents."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    chosen = [r[0] for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).collect()]
    if not chosen:
        return []
    known = docs.sparkSession.sparkContext.broadcast(language)

    def work(batch, texts):
        out: dict[str, list] = {"doc_id": [], "start": [], "row": []}
        for doc, path, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), texts, strict=True):
            decoded = text.decode()
            for c in candidates(decoded):
                row = features(decoded, c, path, known.value)
                told = label(c, row)
                if told is not None:
                    out["doc_id"].append(doc)
                    out["start"].append(c.start)
                    out["row"].append([*row, told])
        return out

    sample = docs.where(F.col("doc_id").isin(chosen)).select("doc_id", "text", "source")
    # Repeated rows do not widen the sample.
    rows = map_texts(sample, "text", "doc_id bigint, start bigint, row array<double>", work).distinct()
    first = rows.orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start", "row").limit(SAMPLE_ROWS)
    return [list(r["row"]) for r in first.collect()]


def fit(docs: DataFrame) -> Forest:
    """The forest, from made-up findings and labelled ones of a bounded sample; its language from all documents."""
    language = Language.of(docs)
    rows = generated_rows(language, GENERATED) + labelled(docs, language)
    return Forest(_trees(docs.sparkSession, rows), language)


def _trees(spark: SparkSession, rows: list[list[float]]) -> list[tuple]:
    table = spark.createDataFrame(rows, [*FEATURES, "label"]).coalesce(1)
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table).select("features", "label")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=3, featureSubsetStrategy="onethird", seed=5
    )
    model = forest.fit(table)
    path = shared_folder(spark, "secret-forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees = []
    for tree in range(TREES):
        own = sorted((n for n in nodes if n["treeID"] == tree), key=lambda n: n["id"])
        trees.append(
            (
                np.array([n["split"]["featureIndex"] if n["leftChild"] >= 0 else -1 for n in own]),
                np.array([n["split"]["leftCategoriesOrThreshold"][0] if n["leftChild"] >= 0 else 0.0 for n in own]),
                np.array([n["leftChild"] for n in own]),
                np.array([n["rightChild"] for n in own]),
                np.array([n["impurityStats"][1] / sum(n["impurityStats"]) for n in own]),
            )
        )
    return trees


def secrets(docs: DataFrame) -> DataFrame:
    """One row per secret: document, place in code points, score and hash of the value."""
    forest = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def work(batch, texts):
        out: dict[str, list] = {"doc_id": [], "start": [], "length": [], "score": [], "value_sha256": []}
        for doc, path, text in zip(
            batch.column(0).to_pylist(), batch.column(2).to_pylist(), texts, strict=True
        ):
            for c, score in forest.value.findings(text.decode(), path):
                out["doc_id"].append(doc)
                out["start"].append(c.start)
                out["length"].append(len(c.value))
                out["score"].append(round(score, 6))
                out["value_sha256"].append(hashlib.sha256(c.value.encode()).hexdigest())
        return out

    return map_texts(docs.select("doc_id", "text", "source"), "text", SCHEMA, work)


def redact(text: str, found: list[tuple[Candidate, float]]) -> str:
    parts, at = [], 0
    for c, _ in found:
        parts += [text[at : c.start], MARK]
        at = c.start + len(c.value)
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with ``MARK`` in the place of each secret; other texts and columns stay as they are."""
    forest = docs.sparkSession.sparkContext.broadcast(fit(docs))
    names = docs.columns
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = piece.column(place).to_pylist()
                paths = piece.column("source").to_pylist()
                lengths = piece.column("n_chars").to_pylist()
                for row, (raw, path) in enumerate(zip(as_bytes(piece, "text"), paths, strict=True)):
                    text = raw.decode()
                    if found := forest.value.findings(text, path):
                        texts[row] = redact(text, found)
                        lengths[row] = len(texts[row])
                columns = {
                    "text": pa.array(texts, piece.schema.field("text").type),
                    "n_chars": pa.array(lengths, piece.schema.field("n_chars").type),
                }
                yield pa.RecordBatch.from_arrays(
                    [columns.get(name, piece.column(name)) for name in names], schema=piece.schema
                )

    return docs.mapInArrow(run, docs.schema)
