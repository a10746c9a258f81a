import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from ratelens.llm import bpe

FILE = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def both():
    path = public_tokenizers.path(FILE)
    ranks = bpe.read_ranks(path)
    return (bpe.ByteBPE(ranks, public_tokenizers.PATTERN),
            tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))


def test_any_bytes_and_texts_like_the_library(both):
    own, library = both
    rng = random.Random(1)
    words = [t for t in own.ranks if len(t) > 2]
    for _ in range(1500):
        piece = b"".join(rng.choice(words)[:rng.randrange(1, 9)] for _ in range(rng.randrange(1, 7)))
        assert own.encode_piece(piece) == library._encode_single_piece(piece)
    for _ in range(500):
        piece = bytes(rng.randrange(256) for _ in range(rng.randrange(1, 30)))
        assert own.encode_piece(piece) == library._encode_single_piece(piece)
    for text in ("", " ", "a" * 5000, " " * 3000 + "x", "\n\n \t", "naïve Ünïcödé 漢字 🙂 don't",
                 "<|endoftext|>", "ab" * 4000, "\x00​﻿"):
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_long_pieces_take_linear_steps(both):
    own, library = both
    import time
    took = []
    for n in (20_000, 80_000):
        rng = random.Random(n)
        piece = "".join(rng.choice("abcdefgh") for _ in range(n)).encode()
        start = time.perf_counter()
        ids = own.encode_piece(piece)
        took.append(time.perf_counter() - start)
        assert own.decode(ids) == piece
    assert took[1] < 12 * took[0] + 0.5


def test_query_against_library_and_edge_cases(spark, both):
    library = both[1]
    path = public_tokenizers.path(FILE)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "Tie"), (-3, "Tie"), (None, "word " * 100_000)],
                                  "doc_id bigint, text string")
    both_tables = docs.unionByName(extra)
    want = []
    for r in both_tables.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((str(r.doc_id), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = bpe.digests(bpe.round_trip(both_tables, path, public_tokenizers.PATTERN)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_other_columns_and_empty_table(spark):
    path = public_tokenizers.path(FILE)
    docs = spark.createDataFrame([(1, "a b", "old", 5)], "doc_id bigint, text string, ids string, batch int")
    coded = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    row = coded.first()
    assert row.batch == 5 and bytes(row.decoded) == b"a b" and isinstance(row.ids, list)
    assert bpe.round_trip(docs.limit(0), path, public_tokenizers.PATTERN).collect() == []
