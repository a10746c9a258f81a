import corpus_pipeline as P
from ratelens.llm import bpe, lines, simhash, toxicity, winnow
from ratelens.llm.queries import tokenizer


def test_stages_follow_their_operators(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "SimHash near-dedup",
                                        "benchmark decontamination", "byte-level BPE"]
    now = docs
    for _, stage in P.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == docs.columns
    # the same decisions, one after another, on the driver
    rejected = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    left = docs.where(~docs.doc_id.isin([-1, *rejected]))
    left = lines.drop_boilerplate(left)
    groups = simhash.near_duplicates(left).where("doc_id = component_id").select("doc_id")
    left = left.join(groups, "doc_id", "left_semi")
    clean = winnow.contamination(left, items).where("NOT contaminated").select("doc_id")
    left = left.join(clean, "doc_id", "left_semi")
    want = bpe.digests(bpe.round_trip(left.select("doc_id", "text"), *tokenizer())).collect()
    assert sorted(P.run(spark, folder).collect()) == sorted(want)
    assert now.where("length(text) <> n_chars").count() == docs.join(
        now.select("doc_id"), "doc_id", "left_semi").where("length(text) <> n_chars").count()
