"""Secret scans with a random forest that removes false findings.

Candidates are strings that could be credentials: long runs of key-like
characters with digits, long runs of capitals, and values assigned to a name.  A
random forest then tells real findings from look-alikes (identifiers, numbers,
words, placeholders) by

* the candidate's length and entropy,
* character transitions: how often its letters' class changes, and how likely
  its character pairs are in ordinary words of the corpus,
* dictionary coverage: the share of its letters inside the corpus's common words,
* the path (or source) it stands in, and
* the words beside it: whether they name a secret, and an assignment sign.

The forest is Spark ML's and is trained on labelled findings: a table of
candidates with their context and a label.  Where no such table is at hand,
``provider_findings`` labels candidates whose whole form is one that a provider
documents as its credentials', and look-alikes that documented forms exclude.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import cut_lineage, in_workers

SAMPLE = 4000        # findings of each label used for training
DICTIONARY = 5000    # most common words of the corpus used as dictionary
CONTEXT = 40         # characters kept on either side
#: Words beside a candidate that name a secret.
NAMES = ("password", "passwd", "pwd", "secret", "token", "api", "apikey", "key", "credential", "auth",
         "access", "private", "bearer")
#: Words in a path that speak against a real secret.
SAMPLE_PATHS = ("test", "tests", "example", "examples", "sample", "samples", "doc", "docs", "fixture", "mock")
#: Documented forms of credentials (fixed values).
PROVIDER_FORMS = {
    "cloud_access_key": r"(?:AKIA|ASIA)[A-Z2-7]{16}",
    "source_host_token": r"gh[pousr]_[A-Za-z0-9]{36}",
    "chat_token": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "payment_key": r"sk_live_[A-Za-z0-9]{24,}",
    "web_token": r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
    "hex_value": r"(?:[0-9a-f]{18}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})",
}
_SPOT = re.compile(r"[0-9:=]|[A-Z]{16}")
_SPACE = re.compile(r"\s")
_WORD = re.compile(r"\S+")
CANDIDATE = (r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z0-9_+/=.-]{0,80}[0-9])[A-Za-z0-9_+/-][A-Za-z0-9_+/.-]{10,}=*"
             r"|(?<![A-Za-z0-9_])[A-Z0-9]{16,}(?![A-Za-z0-9_])"
             r"|(?<=[:=]\s?[\"']?)[A-Za-z0-9_+/.@#%^&*!-]{8,}")


def spots(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of a text where a candidate can be: the words that hold a
    digit, an assignment sign or a long run of capitals, and the words after a
    sign up to one that ends in none.  All other words are passed over at scanning speed."""
    done, n = 0, len(text)
    while m := _SPOT.search(text, done):
        a = m.start()
        while a > done and not text[a - 1].isspace():
            a -= 1
        end = _SPACE.search(text, m.end())
        b = end.start() if end else n
        while text[b - 1] in ":=\"'" and (word := _WORD.search(text, b)):
            b = word.end()       # the word after a sign may end in one itself
        yield a, b
        done = b


def candidate_rows(id_type: str):
    """(id, path, text) -> a row per candidate of a whole text."""
    find = regex.compile(CANDIDATE).finditer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, paths, starts, found, before, after = [], [], [], [], [], []
            for i, p, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                t = t.as_py() or ""
                for m in (m for a, b in spots(t) for m in find(t, a, b)):
                    value = m[0]
                    name, sign, rest = value.partition("=")
                    at = m.start()
                    if sign and rest.strip("=") and name.isalpha():      # name=value
                        value, at = rest, at + len(name) + 1
                    ids.append(i)
                    paths.append(p)
                    starts.append(at)
                    found.append(value)
                    before.append(t[max(0, at - CONTEXT):at])
                    after.append(t[at + len(value):at + len(value) + CONTEXT])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(0).type), pa.array(paths, pa.string()), pa.array(starts, pa.int64()),
                 *(pa.array(x, pa.string()) for x in (found, before, after))],
                names=["id", "path", "start", "candidate", "before", "after"])
    return run


def candidates(docs: DataFrame, id_col: str = "doc_id", path_col: str = "source",
               text_col: str = "text") -> DataFrame:
    """``(id, path, start, candidate, before, after)`` of every candidate;
    ``start`` counts code points."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"),
                       F.col(text_col).cast("string").alias("text"))
    return in_workers(rows).mapInArrow(candidate_rows(kind), f"id {kind}, path string, start bigint, "
                                       "candidate string, before string, after string")


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[tuple[str, int]]:
    """The ``size`` words of 3 to 20 letters that stand in most documents,
    counted over the whole corpus."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"\s+"))
    return [(r["w"], r["n"]) for r in docs.select(F.explode(words).alias("w"))
            .where(F.col("w").rlike(r"^\p{L}{3,20}$")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "w").limit(size).collect()]


class Featurizer:
    """Numbers that describe a candidate in its context."""

    def __init__(self, words: list[tuple[str, int]]):
        self.words = {w for w, _ in words}
        pairs: Counter = Counter()
        for w, n in words:
            for a, b in zip(f"^{w}", f"{w}$"):
                pairs[a, b] += n
        firsts: Counter = Counter()
        for (a, _), n in pairs.items():
            firsts[a] += n
        self.likely = {(a, b): math.log((n + 1) / (firsts[a] + 64)) for (a, b), n in pairs.items()}

    def __call__(self, path: str | None, candidate: str, before: str, after: str) -> list[float]:
        n = len(candidate)
        kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in candidate]
        changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
        low = f"^{candidate.lower()}$"
        pair = sum(self.likely.get(x, -9.0) for x in zip(low, low[1:])) / (n + 1)
        covered = bytearray(n)
        lower = candidate.lower()
        for i in range(n):
            for size in range(min(12, n - i), 2, -1):
                if lower[i:i + size] in self.words:
                    covered[i:i + size] = b"\1" * size
                    break
        counts = Counter(candidate)
        entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
        beside = regex.findall(r"[a-z]+", before.lower())[-2:] + regex.findall(r"[a-z]+", after.lower())[:1]
        steps = set(regex.findall(r"[a-z]+", (path or "").lower()))
        return [float(n), entropy, changes / n, pair, sum(covered) / n,
                kinds.count("d") / n, kinds.count("u") / n, kinds.count("s") / n,
                float(any(w in NAMES for w in beside)), float(bool(regex.search(r"[:=]\s?[\"']?$", before))),
                float(bool(steps & set(SAMPLE_PATHS))), len(counts) / n]


def with_features(found: DataFrame, words: list[tuple[str, int]]) -> DataFrame:
    """``found`` (path, candidate, before, after and more) with ``features``."""
    schema = T.StructType([*found.drop("features").schema.fields, T.StructField("features", T.ArrayType(T.DoubleType()))])
    columns = [found.columns.index(c) for c in ("path", "candidate", "before", "after")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        describe = Featurizer(words)
        for batch in batches:
            rows = [describe(*r) for r in zip(*(batch.column(c).to_pylist() for c in columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.list_(pa.float64()))],
                                             names=[*batch.schema.names, "features"])
    return in_workers(found.drop("features")).mapInArrow(run, schema)


def provider_findings(found: DataFrame) -> DataFrame:
    """Candidates with ``label``: 1.0 for a provider's documented form (hex
    values only beside a secret's name), 0.0 for what no provider issues
    (numbers, addresses, words, placeholders); other candidates are left out."""
    value = F.col("candidate")
    forms = "|".join(v for k, v in PROVIDER_FORMS.items() if k != "hex_value")
    named = F.lower("before").rlike(r"(password|passwd|pwd|secret|token|key|credential)\s?[:=]\s?[\"']?$")
    real = value.rlike(f"^(?:{forms})$") | (named & value.rlike(f"^(?:{PROVIDER_FORMS['hex_value']})$"))
    fake = (value.rlike(r"^[0-9.,:/_+-]+$") | value.rlike(r"(?i)example|placeholder|xxxx|1234567|changeme|your[_-]")
            | ~value.rlike("[0-9]|^[A-Z]{16,}$"))
    placeholder = value.rlike(r"(?i)example|placeholder|xxxx|1234567|changeme")
    return (found.withColumn("label", F.when(real & ~placeholder, 1.0).when(fake & ~real, 0.0))
            .where("label IS NOT NULL"))


def train(findings: DataFrame, words: list[tuple[str, int]], sample: int = SAMPLE, trees: int = 40, depth: int = 8,
          seed: int = 11):
    """A forest fitted on at most ``sample`` findings of each label, chosen by
    hash, or None if a label is missing."""
    keys = [F.xxhash64("candidate", "before", "after"), "candidate", "before", "after"]
    some = [findings.where(F.col("label") == v).select("path", "candidate", "before", "after", "label").distinct()
            .orderBy(*keys).limit(sample) for v in (0.0, 1.0)]
    rows = cut_lineage(with_features(some[0].unionAll(some[1]), words))
    if rows.select("label").distinct().count() < 2:
        return None
    spark = findings.sparkSession
    # bounded by ``sample``: sorted, so that the forest is the same however the rows were dealt
    chosen = sorted((r["label"], r["features"]) for r in rows.select("label", "features").collect())
    table = spark.createDataFrame([(y, Vectors.dense(x)) for y, x in chosen], ["label", "features"])
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt")
    return forest.fit(table.coalesce(1))


def secrets(docs: DataFrame, id_col: str = "doc_id", path_col: str = "source", text_col: str = "text",
            findings: DataFrame | None = None, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """``(id, path, start, candidate, before, after, probability, is_secret)``
    of every candidate in every whole text.

    ``findings`` (path, candidate, before, after, label) trains the forest;
    without it the corpus's own provider forms do.  If it lacks one of the
    labels nothing is called a secret (probability 0).  NULL and empty texts
    have no candidates; NULL ids and paths are kept; repeated rows give their
    findings again; an empty table gives an empty result; other columns are
    not read.
    """
    found = cut_lineage(candidates(docs, id_col, path_col, text_col))
    words = dictionary(docs, text_col)
    model = train(provider_findings(found) if findings is None else findings, words, sample)
    if model is None:
        return found.select("*", F.lit(0.0).alias("probability"), F.lit(False).alias("is_secret"))
    described = with_features(found, words).withColumn("features", array_to_vector("features"))
    scored = model.transform(described)
    return scored.select(*found.columns, vector_to_array("probability")[1].alias("probability")).withColumn(
        "is_secret", F.col("probability") >= threshold)
