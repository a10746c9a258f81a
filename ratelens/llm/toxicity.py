"""Toxicity: a support vector machine on a subsequence string kernel.

A text is read sentence by sentence, a sentence word by word.  The kernel of
two words sums, over all three-letter subsequences both hold, gaps included,
DECAY to the power of the letters spanned in either word, and is normalised to
1 for equal words.  A letter put into an insult, a letter left out, or another
ending leaves most of its subsequences, so the kernel stays high.  Separators
inside a word are dropped, look-alike digits and signs become letters, and
letters written apart count as one word.

Training follows multiple-instance learning on words: a toxic document's
label belongs to its worst words, a clean document's label to all its words.
(Sentences only bound the words written apart; a phrase of ordinary words is
not an insult to this model.)  The kernel is approximated by Nyström landmarks (insult-like and plain words
of the training sentences), and a linear support vector machine is fitted in
that space; hard clean words and better witnesses are added in rounds.  A
document's score is that of its worst word, on a logistic curve that is THRESHOLD
where the training documents are separated best.

As the machine is linear in the landmarks, its decision on a word is a
weighted sum over the word's own subsequences: the landmarks' weights are
added up once in a table (CODES^3 numbers, sent to the tasks), and scoring a
word looks up its subsequences.  The model is fitted on a bounded sample of
labelled documents (SAMPLE of each class, by hash of the id) in one task; every
text is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import in_workers

DECAY = 0.75
CODES = 44            # letter classes, and a word's start and end
PART = 14             # longer words are read through windows of this length
LANDMARKS = 256
SAMPLE = 1500         # labelled documents of each class used for fitting
ROUNDS = 4
# words of the training documents that a round fits on, at most: insult-like
# ones by frequency (the first DISGUISED also disguised), any clean ones, and
# the clean ones that the round before got most wrong
WITNESSES, DISGUISED, PLAIN, HARD = 4000, 300, 2500, 1500
THRESHOLD = 0.3
COST = 5.0
COLUMNS = 64          # landmarks whose table is held at a time
MEMO = 1 << 19        # words remembered by a Python worker

LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t",
                           "@": "a", "$": "s", "!": "i", "|": "l"})
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
#: three or more letters written apart
APART = re.compile(r"(?<!\S)\w(?:[ \t]\w){2,}(?!\S)")


def clean(token: str) -> str:
    """The letters of a lower-case token; look-alikes count inside a word."""
    if token.isalpha():
        return token
    core = token.strip(".,;:!?\"'()[]{}<>…-–—*#%&$")
    if any(c.isalpha() for c in core):
        core = core.translate(LOOKALIKE)
    return "".join(c for c in core if c.isalpha())


def tokens(text: str | None) -> set[str]:
    """The distinct lower-case tokens of a text, and words written apart."""
    text = (text or "").lower()
    found = set(text.split())
    for run in APART.findall(text):
        found.add("".join(run.split()))
    return found


def sentences(text: str | None) -> list[str]:
    return [s for s in SENTENCE.split(text or "") if s.strip()]


def codes(word: str) -> list[int]:
    """Letter classes of a word between its start mark ^ and end mark $."""
    return [42 if c == "^" else 43 if c == "$" else o - 96 if 97 <= (o := ord(c)) <= 122
            else 27 + o % 15 for c in word]


@lru_cache(maxsize=64)
def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Index triples of a word of this length, and each one's weight."""
    picks = np.array(list(combinations(range(length), 3)), np.int64).reshape(-1, 3)
    return picks, (DECAY ** (picks[:, 2] - picks[:, 0] + 1)).astype(np.float64)


def _flat(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words of one length as codes) -> each one's subsequence numbers."""
    picks, weight = _triples(words.shape[1])
    return (words[:, picks[:, 0]] * CODES + words[:, picks[:, 1]]) * CODES + words[:, picks[:, 2]], weight


def _norms(words: np.ndarray) -> np.ndarray:
    """Square root of each word's kernel with itself, by the usual recursion
    over prefixes: D sums over earlier letters with the decay of the gap."""
    n, length = words.shape
    same = (words[:, :, None] == words[:, None, :]).astype(np.float64)
    gaps = np.subtract.outer(np.arange(length), np.arange(length))
    d = np.where(gaps > 0, DECAY ** np.maximum(gaps, 0), 0.0)   # strictly earlier letters
    reach = same * DECAY ** 2
    for _ in range(2):
        right = (reach.reshape(-1, length) @ d.T).reshape(n, length, length)
        both = (right.transpose(0, 2, 1).reshape(-1, length) @ d.T).reshape(n, length, length)
        reach = same * both.transpose(0, 2, 1)
    return np.sqrt(reach.sum(axis=(1, 2)))


def parts(word: str) -> list[str]:
    """A word with its marks, or the overlapping windows of a very long one."""
    word = f"^{word}$"
    if len(word) <= PART:
        return [word]
    step = PART // 2
    return [word[i:i + PART] for i in range(0, len(word) - step, step)]


def kernel_sums(words: list[str], table: np.ndarray) -> np.ndarray:
    """For each word the weighted sum of ``table`` (one or more columns) over
    its subsequences, divided by the word's norm; 0 for words without any."""
    out = np.zeros((len(words), table.shape[1]))
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) >= 3:
            by_length.setdefault(len(w), []).append(i)
    for length, where in by_length.items():
        step = max(1, 2_000_000 // (len(_triples(length)[0]) * table.shape[1]))
        for a in range(0, len(where), step):
            part = where[a:a + step]
            coded = np.array([codes(words[i]) for i in part], np.int64)
            flat, weight = _flat(coded)
            norm = _norms(coded)
            out[part] = np.einsum("ntm,t->nm", table[flat], weight) / norm[:, None]
    return out


def _landmark_table(landmarks: list[str]) -> np.ndarray:
    """One column per landmark: the weights of its subsequences, normalised."""
    table = np.zeros((CODES ** 3, len(landmarks)), np.float32)
    for j, word in enumerate(landmarks):
        flat, weight = _flat(np.array([codes(word)], np.int64))
        np.add.at(table[:, j], flat[0], weight)
        table[:, j] /= np.linalg.norm(table[:, j])
    return table


def _kernels(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernels of words with landmarks; the table of a few landmarks is held at
    a time."""
    return np.hstack([kernel_sums(words, _landmark_table(landmarks[a:a + COLUMNS]))
                      for a in range(0, len(landmarks), COLUMNS)])


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float) -> np.ndarray:
    """Primal linear SVM with squared hinge loss, by Newton steps; the last
    coefficient is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(12):
        active = y * (x @ w) < 1
        xa, ca = x[active], cost * weight[active]
        new = np.linalg.solve(ridge + (xa * ca[:, None]).T @ xa, (xa * ca[:, None]).T @ y[active])
        if np.abs(new - w).max() < 1e-5:
            return new
        w = new
    return w


def _platt(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the logistic curve from raw scores to probabilities."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([raw, np.ones(len(raw))])
    w = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-3 * (w - [1.0, 0.0]))
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def _cut(raw: np.ndarray, y: np.ndarray) -> float:
    """Where to cut: of the cuts whose F1 (calling all above it toxic) is
    within a hundredth of the best, the middle of the widest gap."""
    order = np.argsort(-raw, kind="stable")
    r, hits = raw[order], np.cumsum(y[order] > 0)
    f1 = 2 * hits / (np.arange(1, len(r) + 1) + (y > 0).sum())
    gap = np.append(r[:-1] - r[1:], 1.0)
    k = int(np.argmax(np.where(f1 >= f1[gap > 0].max() - 0.01, gap, -1.0)))
    return float(r[k] - gap[k] / 2)


@dataclass
class Model:
    """``table`` holds the machine's weight of every subsequence."""
    table: np.ndarray
    intercept: float
    slope: float
    shift: float

    def raw(self, words: list[str]) -> np.ndarray:
        """The machine's decision on each (cleaned) word."""
        if len(words) > 20_000:
            return np.concatenate([self.raw(words[a:a + 20_000]) for a in range(0, len(words), 20_000)])
        split = [parts(w) for w in words]
        flat = [p for ps in split for p in ps]
        sums = kernel_sums(flat, self.table)[:, 0] + self.intercept
        ends = np.cumsum([len(ps) for ps in split])
        return np.maximum.reduceat(sums, np.concatenate(([0], ends[:-1]))) if split else np.zeros(0)

    def raw_part(self, part: str) -> float:
        """The machine's decision on one window of a word."""
        return float(kernel_sums([part], self.table)[0, 0]) + self.intercept

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -35, 35)))


def _witnesses_by_grams(toxic: list[set[str]], plain: list[set[str]], least: float = 3.0) -> list[list[str]]:
    """For each toxic document its words with a letter group that is far more
    frequent in toxic documents than in clean ones (perhaps none)."""
    def grams(word):
        marked = f"^{word}$"
        return {marked[i:i + n] for n in (4, 5) for i in range(len(marked) - n + 1)}

    def per_document(bags, of):
        """How many bags hold each group; a bag's groups are held at a time."""
        counts: Counter = Counter()
        for bag in bags:
            counts.update(set().union(*map(of, bag)))
        return counts

    bad = Counter({g: n for g, n in per_document(toxic, grams).items() if n >= least})
    good = per_document(plain, lambda w: grams(w) & bad.keys())
    share = len(toxic) / max(1, len(plain))
    value = {g: (n - good[g] * share) / np.sqrt(good[g] * share + 1) for g, n in bad.items()}
    best = {w: max((value[g] for g in grams(w) if g in value), default=0.0) for w in set().union(*toxic)}
    out = []
    for d in toxic:
        scored = [(best[w], w) for w in sorted(d)]
        bar = max([least, *(v / 4 for v, _ in scored)])
        out.append([w for v, w in scored if v >= bar])
    return out if any(out) else [sorted(d) for d in toxic]


def _disguised(word: str, rng: np.random.Generator) -> list[str]:
    """A word with a letter put in, and with a letter doubled: what the
    machine shall tolerate is part of its training."""
    if len(word) < 5:
        return []
    i, j = rng.integers(1, len(word), 2)
    other = chr(97 + int(rng.integers(26)))
    return [word[:i] + other + word[i:], word[:j] + word[j - 1] + word[j:]]


def fit(rows: list[tuple[str, int]], seed: int = 7) -> Model | None:
    """Fit on (text, label) rows; None if a class is missing."""
    rng = np.random.default_rng(seed)
    bags: dict[int, list[set[str]]] = {0: [], 1: []}
    known: dict[str, str] = {}     # equal words are one object
    for text, label in rows:
        bags[label].append({known.setdefault(c, c) for s in sentences(text) for t in tokens(s) if len(c := clean(t)) >= 3})
    del known
    toxic, plain = [b for b in bags[1] if b], bags[0]
    if not toxic or not any(plain):
        return None
    uses = Counter(w for d in plain for w in d)
    clean_words = sorted(uses)
    pool = [clean_words[i] for i in rng.permutation(len(clean_words))]
    often_used = [w for w in pool if uses[w] > 1] or pool
    toxic_words = sorted(set().union(*toxic))
    first = _witnesses_by_grams(toxic, plain)
    witnesses = first
    hard: list[str] = []
    model = None
    for _ in range(ROUNDS):
        # a word that clean documents use as often doesn't make a document toxic
        counts = Counter(w for ws in witnesses for w in ws)
        share = len(toxic) / len(plain)
        counts = {w: n for w, n in counts.items()
                  if n - uses[w] * share >= 2.5 * np.sqrt(uses[w] * share)} or dict(counts)
        bad = sorted(counts, key=lambda w: (-counts[w], w))[:WITNESSES]
        taken = set(bad)
        good = [w for w in dict.fromkeys(hard + pool[:PLAIN]) if w not in taken]
        if not good:  # every clean word is also a witness: both classes train on them
            good = pool[:PLAIN]
        bad += [v for w in bad[:DISGUISED] if w in counts for v in _disguised(w, rng)]
        # of a long word the window that the machine so far finds worst
        x_bad = [max(parts(w), key=lambda p: model.raw_part(p)) if model and len(w) + 2 > PART else parts(w)[0] for w in bad]
        x_good, n_good = zip(*((p, uses[w]) for w in good for p in parts(w)))
        # landmarks: frequent and other witnesses, the hardest clean words, and any
        often = list(dict.fromkeys(x_bad))
        often = often[:LANDMARKS // 4] + [often[i] for i in rng.permutation(len(often)) if i >= LANDMARKS // 4]
        marks = dict.fromkeys(often[:LANDMARKS // 2])
        marks |= dict.fromkeys(p for p in x_good[:LANDMARKS // 4] if p not in marks)
        rest = [p for p in reversed(x_good) if p not in marks]
        marks = list(marks) + list(dict.fromkeys(rest))[:LANDMARKS - len(marks)]
        values, vectors = np.linalg.eigh(_kernels(marks, marks))
        keep = values > 1e-5 * values[-1]
        whiten = vectors[:, keep] / np.sqrt(values[keep])     # Nyström features
        x = _kernels([*x_bad, *x_good], marks) @ whiten
        y = np.concatenate((np.ones(len(x_bad)), -np.ones(len(x_good))))
        weight = np.concatenate(([counts.get(w, 1) for w in bad], n_good)).astype(np.float64)
        weight[:len(x_bad)] *= 3
        w = _svm(x, y, weight, COST)
        share_of = (whiten @ w[:-1]).astype(np.float32)
        table = sum(_landmark_table(marks[a:a + COLUMNS]) @ share_of[a:a + COLUMNS] for a in range(0, len(marks), COLUMNS))
        model = Model(table[:, None], float(w[-1]), 1.0, 0.0)
        # the clean documents' worst words, and the toxic documents' witnesses again
        scores = model.raw(often_used)
        loss = np.maximum(scores + 1, 0) * np.fromiter((uses[w] for w in often_used), float, len(often_used))
        hard = [often_used[i] for i in np.argsort(-loss, kind="stable")[:HARD]]
        value = dict(zip(toxic_words, model.raw(toxic_words).tolist()))
        witnesses = []
        for bag, before in zip(toxic, first):
            best = max(value[w] for w in bag)
            witnesses.append([w for w in sorted(bag) if value[w] >= 0 and (w in before or value[w] >= best - 0.2)])
    by_word = dict(zip(pool, model.raw(pool)))
    lowest = float(model.intercept)
    raw = [max((by_word[w] for w in d), default=lowest) for d in plain]
    raw += [max(value[w] for w in d) for d in toxic]
    raw, y = np.array(raw), np.array([-1] * len(plain) + [1] * len(toxic))
    model.slope, _ = _platt(raw, y)
    # the decision that separates the training documents best scores THRESHOLD
    model.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - model.slope * _cut(raw, y))
    return model


class Scorer:
    """Scores whole texts, remembering words already seen."""

    def __init__(self, model: Model):
        self.model = model
        self.memo: dict[str, float] = {}

    def raw(self, texts: list[str | None]) -> np.ndarray:
        """Each text's highest decision; the intercept for texts without words."""
        memo = self.memo
        found = [tokens(t) for t in texts]
        if len(memo) > MEMO:
            memo.clear()
        new = list(set().union(*found) - memo.keys()) if found else []
        for a in range(0, len(new), 100_000):
            block = new[a:a + 100_000]
            memo.update(zip(block, self.model.raw([clean(t) for t in block]).tolist()))
        low = self.model.intercept
        return np.array([max(map(memo.__getitem__, f), default=low) for f in found])


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` labelled documents of each class, by a hash of their
    id, as ``(id, label, text)``; the held-out quarter is never used."""
    known = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"))
             .where("__label IN (0, 1)").where(~held_out(F.col("__id"))).distinct())
    chosen = None
    for label in (0, 1):
        # chosen among the labels alone: no text is moved but the chosen ones
        some = (known.where(F.col("__label") == label)
                .orderBy(F.xxhash64("__id"), "__id").limit(sample))
        chosen = some if chosen is None else chosen.unionAll(some)
    return (docs.select(F.col(id_col).alias("__doc"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
            .join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))   # 2 * sample rows at most
            .select(F.col("__doc").cast("string").alias("id"), F.col("__label").cast("int").alias("label"),
                    F.col("__text").alias("text")))


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all training rows, one row; none without a model."""
    rows = [r for b in batches for r in zip(*(b[c].to_pylist() for c in ("id", "label", "text")))]
    rows.sort(key=lambda r: (len(r[0]), *r))
    model = fit([(text, label) for _, label, text in rows])
    if model is not None:
        yield pa.record_batch({"weights": pa.array([model.table.astype(np.float64).tobytes()], pa.binary()),
                               **{k: pa.array([getattr(model, k)], pa.float64()) for k in ("intercept", "slope", "shift")}})


def fitted(rows: DataFrame) -> Model | None:
    """``fit`` in one task over a bounded number of rows (``training_rows``), so
    that the driver gets the model alone: CODES^3 numbers."""
    found = (in_workers(rows).repartition(1)
             .mapInArrow(_fit_rows, "weights binary, intercept double, slope double, shift double").collect())
    if not found:
        return None
    m = found[0]
    return Model(np.frombuffer(bytes(m.weights), np.float64)[:, None], m.intercept, m.slope, m.shift)


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids kept for measuring."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def score(docs: DataFrame, model: Model | None, text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``: the probability that a text is toxic.

    NULL and empty texts, and texts without words of three letters, get the
    score of the machine's intercept.  Without a model (no labelled rows of
    both classes) every score is 0.  A column named ``score_col`` is replaced.
    """
    docs = docs.drop(score_col)
    if model is None:
        return docs.withColumn(score_col, F.lit(0.0))
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                raw = scorer.raw(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(model.probability(raw), pa.float64())],
                    names=[*part.schema.names, score_col])

    return in_workers(docs).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """``(id_col, held_out, score, predicted)`` for every row of ``docs``.

    The model is fitted here, on labelled rows that are not held out; rows
    with a NULL id are scored and not held out; repeated rows get the same
    score; an empty table gives an empty result.  Only ids and texts are read.
    """
    model = fitted(training_rows(docs, labels, id_col, text_col, label_col, sample))
    scored = score(docs.select(F.col(id_col), F.col(text_col)), model, text_col, "score")
    return scored.select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Rows of ``docs`` that score under ``threshold``; columns stay as they are."""
    model = fitted(training_rows(docs, labels, id_col, text_col, label_col, sample))
    return (score(docs, model, text_col, "__toxicity").where(F.col("__toxicity") < threshold)
            .drop("__toxicity"))
