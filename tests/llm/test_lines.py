from collections import Counter, defaultdict

from ratelens.llm import lines

BLANK = " \t\n\r\f\v"


def brute(rows, ratio, least):
    pages = defaultdict(set)
    for _, host, text in rows:
        pages[host].add(text or "")
    common = {}
    for host, texts in pages.items():
        count = Counter(k for t in texts for k in {s.strip(BLANK) for s in t.split("\n")} if k)
        common[host] = {k for k, n in count.items() if n > ratio * len(texts) and n >= least}
    out = []
    for doc, host, text in rows:
        parts = (text or "").split("\n")
        kept = [s for s in parts if s.strip(BLANK) not in common[host]]
        if text is not None and any(s.strip(BLANK) for s in kept):
            text = "\n".join(kept)
        out.append((str(doc), host, text))
    return sorted(out, key=str)


def result(df):
    return sorted(((str(r.doc_id), r.source, r.text) for r in df.collect()), key=str)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.source, r.text) for r in docs.collect()], 0.02, 3)
    got = lines.drop_boilerplate(docs)
    assert got.columns == docs.columns
    assert result(got) == want
    assert want != result(docs)


def test_edges(spark):
    foot = "All rights  reserved"
    rows = [(i, "a", f"text {i}\n {foot}\r\nend {i}") for i in range(6)]
    rows += [(10, "a", foot), (11, "a", None), (12, "a", ""), (13, None, f"x\n{foot}"), (14, None, f"y\n{foot}"),
             (15, None, f"z\n{foot}"), (16, "b", f"once\n{foot}"), (16, "b", f"once\n{foot}"), (17, "b", "\n \n"),
             (None, "a", f"no id\n{foot}"), (18, "a", (foot + "\n") * 20_000 + "tail")]
    rows += [(20 + i, "c", "same copy\nsecond line") for i in range(9)]   # copies count once
    docs = spark.createDataFrame([(d, h, t, "k", 1) for d, h, t in rows],
                                 "doc_id bigint, source string, text string, key string, pages int")
    got = lines.drop_boilerplate(docs, ratio=0.3)
    assert got.columns == docs.columns
    assert result(got) == brute(rows, 0.3, 3)
    assert ("10", "a", foot) in result(got) and ("20", "c", "same copy\nsecond line") in result(got)
    assert lines.drop_boilerplate(docs.limit(0)).collect() == []


def test_lines_on_a_few_pages_of_a_small_site_go(spark):
    rows = [(i, "h", f"Site menu\nown text {i}" + ("\nOur newsletter" if i < 3 else "\nOther pages" if i < 12 else ""))
            for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = {r.doc_id: r.text for r in lines.drop_boilerplate(docs).collect()}
    assert got == {i: f"own text {i}" for i in range(100)}
    assert result(lines.drop_boilerplate(docs)) == brute(rows, 0.02, 3)
