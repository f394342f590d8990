"""Operator 3: secret scan with a random forest against false positives.

A pattern finds candidates (whole runs of 16 or more key-like characters, key
blocks, and values of any length given to a credential's name by a sign, a tag,
a flag, a call or a URL); a forest decides from the candidate's length, its
character transitions, how much of it a dictionary covers, the kind of the
document's path and the neighbouring words.  The forest
is Spark ML's, trained on the fixed labelled findings of ``secret_examples.py``,
so the verdict on a document does not depend on what other documents hold, and
kept for the process.  Its trees are read out once, as arrays, and applied where
the texts are scanned, so a scan is one pass without a shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, ship, written
from .secret_examples import examples
from .word_tokens import vocabulary_path

MAX_LABELLED = 3000
TREES, DEPTH, SEED = 30, 8, 7
REDACTED = b"[SECRET]"
THRESHOLD = 0.5
WINDOW = 48

# A block with a heading, a web token or another key of dotted parts as one run, or a run of key-like characters, however long, with its padding.
CANDIDATE = re.compile(rb"""-----BEGIN [A-Z ]{0,30}-----[A-Za-z0-9+/=\s]++(?=-----END)|eyJ[A-Za-z0-9_\-]+(?:\.[A-Za-z0-9_\-]+)+|SG\.[A-Za-z0-9_\-]{16,}\.[A-Za-z0-9_\-]{16,}"""
                       rb"""|[A-Za-z0-9+/_\-]{16,}(?:={1,2}(?!["']?[A-Za-z0-9+/=_\-]))?""")
# What follows a name that a value is assigned to.
_NAMED = re.compile(rb"""=["']?[A-Za-z0-9+/_\-]""")
# Where a value may begin, and a value without quotes.
_SITE = re.compile(rb"(?:=>|:=|[=:>]|[Bb]earer(?=[ \t])|BEARER(?=[ \t])|(?<=\s)--?[A-Za-z][A-Za-z\-]*(?=[ \t]))[ \t]*")
_BARE = re.compile(rb"""[^\s"'`<>,;&)}\]]+""")
# The password of a URL's user.
_USERINFO = re.compile(rb"""://[^\s/:@"'<>]*:([^\s/@"'<>]+)@""")
_USER = re.compile(rb"""://[^\s/:@"'<>]*:$""")
SHORTEST = 4
_LEFT_WORDS = re.compile(rb"[a-z]+")
_NAME = rb"(?:token|secret|passw(?:or)?d|pass[_-]?phrase|mnemonic|pwd|(?:api|access|account|private|signing|encryption|shared)[_-]?key|credential|auth)"
# The text before a value: a name and a sign, a bearer, a tag, a command's flag, an argument of a call.
_ASSIGNED = re.compile(
    _NAME + rb"""[a-z0-9_\-]*["']?\s*(?::|=|=>|:=)\s*["']?(?:(?:bearer|basic)\s+)?$|\bbearer\s+["']?$"""
    rb"|<[a-z0-9_:\-]*" + _NAME + rb"[a-z0-9_\-]*>\s*$"
    rb"|(?:^|\s)--?[a-z\-]*" + _NAME + rb"""[a-z\-]*[ \t]+["']?$"""
    rb"""|\b(?:mysql(?:dump|admin)?|sshpass|htpasswd|login|psql|ldapsearch|redis-cli)\b[^\n]*\s-[pwa][ \t]+["']?$"""
    rb"|(?:" + _NAME + rb"""|login|connect|client|session)[a-z0-9_]*\((?:\s*["'][^"'\n]*["']\s*,|\s*[a-z_.]+\s*,){0,3}\s*["']$""")
_PHRASE = re.compile(rb"""(?:pass[_-]?phrase|mnemonic|seed[_-](?:phrase|words))[a-z0-9_\-]*["']?\s*(?::|=|=>|:=)\s*$""")
_CREDENTIAL_WORDS = frozenset([b"token", b"secret", b"password", b"passwd", b"pwd", b"key", b"apikey", b"credential", b"auth", b"bearer"])
_HARMLESS_WORDS = frozenset([b"example", b"sample", b"dummy", b"test", b"placeholder", b"sha", b"checksum", b"digest", b"commit", b"uuid"])
_HARMLESS_PATHS = re.compile(r"(?:^|[/._\-])(?:tests?|testing|examples?|samples?|mocks?|fixtures?|docs?|spec|demo|tutorials?)(?:[/._\-]|$)")
_SECRET_PATHS = re.compile(r"(?:^|[/._\-])(?:env|config|conf|settings|secrets?|credentials?|deploy|prod|production|vault|netrc|npmrc|pgpass|htpasswd|pem)(?:[/._\-]|$)")
_PREFIXED = re.compile(rb"(?:AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|sk-|[prs]k_live_|xox[abprs]-|AIza|eyJ|npm_|hf_|SG\.|-----BEGIN [A-Z ]*PRIVATE)")
_PUBLIC = re.compile(rb"AAAA(?:B3NzaC1|C3NzaC1|E2VjZHNh)|-----BEGIN (?![A-Z ]*PRIVATE)")
_PLACEHOLDER = re.compile(rb"example|sample|dummy|placeholder|change.?me|your|enter|required|redacted|xxxx|\*\*\*|^[<$%{\[]|^(?:password|passwd|secret|token|none|null|true|false)$")
FEATURES = ("length", "transitions", "entropy", "digits", "capitals", "hex", "dictionary", "path", "credential_word", "harmless_word",
            "assigned", "quoted", "prefixed", "public", "placeholder", "spaced")


def path_kind(path: str) -> float:
    """-1: tests, examples or documentation; 1: settings or credentials; 0: any other path, or none."""
    low = path.lower()
    return -1.0 if _HARMLESS_PATHS.search(low) else float(bool(_SECRET_PATHS.search(low)))


def load_words(path: str) -> frozenset[bytes]:
    """Dictionary words of four letters or more: whole words of a public vocabulary."""
    import json

    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    end = "</w>"
    return frozenset(w[: -len(end)].encode() for w in vocabulary if w.endswith(end) and w[: -len(end)].isascii() and w[: -len(end)].isalpha() and len(w) >= 8)


_dictionaries: dict[str, frozenset[bytes]] = {}


def _words(path: str) -> frozenset[bytes]:
    if path not in _dictionaries:
        _dictionaries[path] = load_words(path)
    return _dictionaries[path]


def coverage(candidate: bytes, words: frozenset[bytes]) -> float:
    """Share of the characters in dictionary words, longest first from the left."""
    low, at, covered = candidate.lower(), 0, 0
    while at < len(low) - 3:
        for size in range(min(12, len(low) - at), 3, -1):
            if low[at : at + size] in words:
                covered += size
                at += size
                break
        else:
            at += 1
    return covered / len(low)


_KIND = np.zeros(256, np.uint8)
_KIND[48:58], _KIND[97:123], _KIND[65:91] = 1, 2, 3


def features(text: bytes, lo: int, hi: int, path: str, words: frozenset[bytes]) -> list[float]:
    """The measures of one candidate, in the order of ``FEATURES``."""
    candidate = text[lo:hi]
    raw = np.frombuffer(candidate, np.uint8)
    kind = _KIND[raw]
    counts = np.bincount(raw)
    share = counts[counts > 0] / len(raw)
    before = text[max(0, lo - WINDOW) : lo].lower()
    near = set(_LEFT_WORDS.findall(before)) | set(_LEFT_WORDS.findall(text[hi : hi + WINDOW].lower()))
    hexed = all(c in b"0123456789abcdefABCDEF" for c in candidate)
    quote = text[lo - 1 : lo] if lo else b""
    return [float(len(raw)), float(np.count_nonzero(kind[1:] != kind[:-1]) / max(1, len(raw) - 1)), float(-(share * np.log2(share)).sum()),
            float((kind == 1).mean()), float((kind == 3).mean()), float(hexed), coverage(candidate, words),
            path_kind(path), float(bool(near & _CREDENTIAL_WORDS)), float(bool(near & _HARMLESS_WORDS)),
            float(bool(_ASSIGNED.search(before) or text[hi : hi + 1] == b"@" and _USER.search(before))),
            float(quote in (b'"', b"'") and text[hi : hi + 1] == quote), float(bool(_PREFIXED.match(candidate))),
            float(bool(_PUBLIC.match(candidate))), float(bool(_PLACEHOLDER.search(candidate.lower()))), float(b" " in candidate)]


def _assigned_values(text: bytes):
    """(begin, end) of every whole value given to a credential's name: what its quotes hold, else up to a delimiter; passwords of URLs."""
    for m in _USERINFO.finditer(text):
        if m.end(1) - m.start(1) >= SHORTEST:
            yield m.span(1)
    for m in _SITE.finditer(text):
        lo = m.end()
        before = text[max(0, lo - WINDOW) : lo].lower()
        if not _ASSIGNED.search(before) and not _PHRASE.search(before):
            continue
        quote = text[lo : lo + 1]
        if quote in (b'"', b"'"):
            lo += 1
            hi = text.find(quote, lo)
            value = text[lo : max(lo, hi)]
            if hi < 0 or value.strip() != value or len(value.split(None, 1)) != 1 and (b"\n" in value or not _PHRASE.search(before)):
                continue
        else:
            value = _BARE.match(text, lo)
            if not value:
                continue
            hi = lo + len(value.group().rstrip(b".:!?"))
            if text[lo:hi].lower() in (b"bearer", b"basic"):  # the value follows
                continue
        if hi - lo >= SHORTEST:
            yield lo, hi


def candidates(text: bytes) -> list[tuple[int, int]]:
    """(begin, end) of all candidates, in order and apart: long runs, and values of any length assigned to a credential's name."""
    spans: list[tuple[int, int]] = []
    runs = (m.span() for m in CANDIDATE.finditer(text) if not _NAMED.match(text, m.end()))
    for lo, hi in sorted([*runs, *_assigned_values(text)]):
        if spans and lo < spans[-1][1]:
            spans[-1] = (spans[-1][0], max(hi, spans[-1][1]))
        else:
            spans.append((lo, hi))
    return spans


def _scan_rows(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    ship(docs.sparkSession)
    path = docs[path_col].cast("string") if path_col else F.lit("")
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), F.coalesce(path, F.lit("")).alias("path"))


def findings(docs: DataFrame, dictionary: str, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(doc_id, begin, end, finding, features) of every candidate; begin and end in UTF-8 bytes."""
    def run(batches):
        words = _words(dictionary)
        for batch in batches:
            rows = []
            for key, text, path in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()):
                text = text.as_py() or b""
                for lo, hi in candidates(text):
                    rows.append((key, lo, hi, text[lo:hi].decode("utf-8", "surrogatepass"), features(text, lo, hi, path, words)))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64())))],
                                      names=["doc_id", "begin", "end", "finding", "features"])

    return _scan_rows(docs, id_col, text_col, path_col).mapInArrow(run, "doc_id long, begin long, end long, finding string, features array<double>")


def label_by_rule(found: DataFrame) -> DataFrame:
    """Findings with ``label`` where a rule is sure, the others left out.

    Real: assigned to a credential's name, in quotes, high entropy, no
    dictionary word.  False: neither assigned nor near a credential word, and
    all letters, all digits or covered by the dictionary.
    """
    at = {name: F.get("features", F.lit(i)) for i, name in enumerate(FEATURES)}
    real = (at["assigned"] == 1) & (at["quoted"] == 1) & (at["entropy"] >= 3) & (at["dictionary"] < 0.3) & (at["harmless_word"] == 0)
    false = (at["assigned"] == 0) & (at["credential_word"] == 0) & ((at["digits"] == 0) | (at["digits"] == 1) | (at["dictionary"] > 0.5))
    return found.withColumn("label", F.when(real, 1.0).when(false, 0.0)).where("label IS NOT NULL")


def bounded_sample(labelled: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """At most ``most`` findings of each label: those with the smallest hash."""
    mark = F.xxhash64("finding", "doc_id", "begin")
    parts = [labelled.where(F.col("label") == label).orderBy(mark, "doc_id", "begin").limit(most) for label in (0.0, 1.0)]
    return parts[0].unionAll(parts[1])


class Forest:
    """Decision trees as arrays: feature, threshold, children, probability of the leaf."""

    def __init__(self, trees: list[tuple[list[int], list[float], list[int], list[int], list[float]]]):
        self.trees = [tuple(map(np.array, t)) for t in trees]

    def probability(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(rows), np.int64)
            while (inner := feature[at] >= 0).any():
                node = at[inner]
                goes = rows[np.flatnonzero(inner), feature[node]] <= threshold[node]
                at[inner] = np.where(goes, left[node], right[node])
            total += value[at]
        return total / max(1, len(self.trees))


def train_forest(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Forest:
    """Random forest on (features, label 0 or 1) rows; without both labels nothing is a secret."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    rows = labelled.select(array_to_vector("features").alias("features"), "label")
    if labelled.select(F.count_distinct("label")).first()[0] < 2:
        return Forest([([-1], [0.0], [0], [0], [0.0])])
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="0.5", featuresCol="features", labelCol="label").fit(rows)

    def read(tree) -> tuple:
        out: tuple = ([], [], [], [], [])

        def visit(node) -> int:
            me = len(out[0])
            for column, blank in zip(out, (-1, 0.0, me, me, 0.0)):
                column.append(blank)
            if node.getClass().getSimpleName() == "InternalNode":
                out[0][me], out[1][me] = node.split().featureIndex(), node.split().threshold()
                out[2][me], out[3][me] = visit(node.leftChild()), visit(node.rightChild())
            else:
                stats = list(node.impurityStats().stats())
                out[4][me] = stats[1] / (sum(stats) or 1)
            return me

        visit(tree._java_obj.rootNode())
        return out

    return Forest([read(t) for t in model.trees])


def scan(docs: DataFrame, forest: Forest, dictionary: str, id_col: str = "doc_id", text_col: str = "text",
         path_col: str | None = "source") -> DataFrame:
    """(doc_id, begin, end, finding, probability, is_secret) of every candidate.

    Null text: none.  Null ids and repeated rows: judged like any row.  Null
    path: empty.  Empty table: no rows.  Other columns are not read.
    """
    found = findings(docs, dictionary, id_col, text_col, path_col)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(4).values.to_numpy().reshape(-1, len(FEATURES))
            p = forest.probability(rows)
            yield pa.record_batch([*batch.columns[:4], pa.array(p), pa.array(p > THRESHOLD)],
                                  names=["doc_id", "begin", "end", "finding", "probability", "is_secret"])

    return found.mapInArrow(run, "doc_id long, begin long, end long, finding string, probability double, is_secret boolean")


def redact(docs: DataFrame, forest: Forest, dictionary: str, id_col: str = "doc_id", text_col: str = "text",
           path_col: str | None = "source") -> DataFrame:
    """``docs`` with every secret of the text column replaced; all columns and rows stay."""
    schema, at = docs.schema, docs.columns.index(text_col)
    where = docs.columns.index(path_col) if path_col else -1
    ship(docs.sparkSession)

    def run(batches):
        words = _words(dictionary)
        for batch in batches:
            texts, column = [], batch.column(at)
            for i, text in enumerate(column.cast(pa.binary())):
                raw = text.as_py()
                spans = candidates(raw or b"")
                if spans:
                    path = str(batch.column(where)[i].as_py() or "") if where >= 0 else ""
                    p = forest.probability(np.array([features(raw, lo, hi, path, words) for lo, hi in spans]))
                    for (lo, hi), own in reversed(list(zip(spans, p))):
                        if own > THRESHOLD:
                            raw = raw[:lo] + REDACTED + raw[hi:]
                texts.append(None if raw is None else raw.decode("utf-8", "surrogatepass"))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, column.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)


def example_findings(dictionary: str, without: frozenset[str] = frozenset()) -> list[tuple[list[float], float]]:
    """(features, label) of the fixed examples but for the forms of ``without``; what an example does not hold as a candidate needs no label."""
    words, rows = _words(dictionary), []
    for form, path, text, secret in examples():
        if form in without:
            continue
        value = text.find(secret) if secret else -1
        for lo, hi in candidates(text):
            rows.append((features(text, lo, hi, path, words), float(lo <= value < hi)))
    return rows


_forests: dict[str, Forest] = {}


def fitted(spark: SparkSession, dictionary: str) -> Forest:
    """The forest of the fixed examples, fitted once for a dictionary."""
    if dictionary not in _forests:
        rows = spark.createDataFrame(example_findings(dictionary), "features array<double>, label double").coalesce(1)
        _forests[dictionary] = train_forest(rows)
    return _forests[dictionary]


def fit_without(spark: SparkSession, dictionary: str, forms: frozenset[str]) -> Forest:
    """A forest that never saw the ``forms``: to measure it on them."""
    return train_forest(spark.createDataFrame(example_findings(dictionary, forms), "features array<double>, label double").coalesce(1))


def fit_on_corpus(docs: DataFrame, dictionary: str, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> Forest:
    """A forest from the fixed examples and the findings of ``docs`` that the rule labels for sure (at most ``MAX_LABELLED`` of each label)."""
    labelled = bounded_sample(label_by_rule(findings(docs, dictionary, id_col, text_col, path_col)))
    fixed = docs.sparkSession.createDataFrame(example_findings(dictionary), "features array<double>, label double")
    return train_forest(written(labelled.select("features", "label").unionAll(fixed), "labelled"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, dictionary = documents(spark, sf_dir), vocabulary_path()
    return scan(docs, fitted(spark, dictionary), dictionary)
