import random
import zlib

import numpy as np

from ratelens.llm import toxicity


def slow_kernel(a, b, decay=toxicity.DECAY):
    """The gap-weighted kernel by listing all three-letter subsequences."""
    from itertools import combinations
    x, y = toxicity.codes(a), toxicity.codes(b)
    return sum(decay ** (i[2] - i[0] + 1) * decay ** (j[2] - j[0] + 1)
               for i in combinations(range(len(x)), 3) for j in combinations(range(len(y)), 3)
               if [x[k] for k in i] == [y[k] for k in j])


def test_kernel_against_all_subsequences():
    words = ["^idiot$", "^idxiot$", "^aaa$", "^banana$", "^né$", "abcabc"]
    table = toxicity._landmark_table(words)
    got = toxicity.kernel_sums(words, table)
    want = [[slow_kernel(a, b) / np.sqrt(slow_kernel(a, a) * slow_kernel(b, b)) for b in words] for a in words]
    assert np.allclose(got, want)
    assert np.allclose(np.diag(got), 1)


def corpus(seed, n, share=0.2):
    rng = random.Random(seed)
    parts = ["the", "on", "er", "ing", "tion", "ly", "an", "re", "st", "ou"]
    bad = ["moron", "lowerix", "stupid", "clown"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
        toxic = rng.random() < share
        if toxic:
            for _ in range(3):
                w = rng.choice(bad)
                if rng.random() < 0.3:
                    k = rng.randrange(1, len(w))
                    w = w[:k] + rng.choice("xqz-") + w[k:]
                words[rng.randrange(60)] = w
        rows.append((i, ". ".join(" ".join(words[k:k + 10]) for k in range(0, 60, 10)), int(toxic)))
    return rows


def test_held_out_accuracy_and_disguised_insults(spark):
    rows = corpus(1, 900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == 900
    for i, _, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i].score <= 1 and got[i].predicted == (got[i].score >= 0.3)
    held = [(r[2], got[r[0]].predicted) for r in rows if got[r[0]].held_out]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    model = toxicity.fit([(t, y) for _, t, y in rows])
    for word in ("moron", "m-o-r-o-n", "morxon", "m o r o n", "M0RON!", "lowerix"):
        assert model.probability(toxicity.Scorer(model).raw([f"the {word} ing"]))[0] >= 0.3, word
    assert model.probability(toxicity.Scorer(model).raw(["the tioning stou"]))[0] < 0.3


def test_edges(spark):
    rows = corpus(2, 300)
    labels = spark.createDataFrame([(r[0], r[2], 1) for r in rows] + [(5, None, 1), (None, 1, 1)],
                                   "doc_id bigint, toxic int, score int")
    extra = [(1000, None), (1001, ""), (1002, "moron " + "the " * 100_000), (1003, "x" * 50_000),
             (None, "you moron"), (1004, "moron"), (1004, "moron")]
    docs = spark.createDataFrame([(*r[:2], "s") for r in rows] + [(*e, "s") for e in extra],
                                 "doc_id bigint, text string, score string")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 307 and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1000][0].score == by[1001][0].score < 0.3
    assert by[1002][0].predicted == by[None][0].predicted == 1 and not by[None][0].held_out
    assert len(by[1004]) == 2 and by[1004][0] == by[1004][1]
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}
    # no labelled rows of both classes: nothing is called toxic
    nothing = toxicity.toxicity(docs, labels.where("toxic = 0")).collect()
    assert {r.score for r in nothing} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_training_rows_take_1500_documents_a_class(spark):
    docs = spark.range(8000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS toxic")
    rows = [(r.text, r.label) for r in toxicity.training_rows(docs, labels).collect()]
    assert [sum(label == v for _, label in rows) for v in (0, 1)] == [1500, 1500]


def test_fit_without_clean_words_left_or_without_a_class(spark):
    model = toxicity.fit([("the cat", 1), ("the cat", 0)])
    assert 0 <= model.probability(model.raw(["the"]))[0] <= 1
    assert toxicity.fit([("the cat", 1)]) is None and toxicity.fit([]) is None
    rows = spark.createDataFrame([("1", 1, "moron long insultinglyoverlongword"), ("2", 0, "fine words")],
                                 "id string, label int, text string")
    here, there = toxicity.fit([("moron long insultinglyoverlongword", 1), ("fine words", 0)]), toxicity.fitted(rows)
    assert np.allclose(here.table, there.table, atol=1e-5)
    assert np.allclose((here.slope, here.shift), (there.slope, there.shift), atol=1e-4)
    assert toxicity.fitted(rows.where("label = 1")) is None and toxicity.fitted(rows.limit(0)) is None
