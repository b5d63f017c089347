"""Operators 1 and 3 against the libraries themselves."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from priceloom.llm import bpe, common

JSON, RANKS, PATTERN = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    ranges = [(32, 127), (9, 33), (0xA0, 0x250), (0x2000, 0x2100), (0x300, 0xD7FF), (0x1F300, 0x1F700), (32, 33), (0x61, 0x7B), (0x27, 0x28)]
    odd = ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(80))) for _ in range(150)]
    return [(i, t) for i, t in enumerate([None, "", "a<|endoftext|>b <|endoftext|>", "x" * 5000, " " * 3000 + "a" + "՘ " * 900, "word " * 2000, "\U0001f600 é" * 700, "it's we'll", *odd])]


@pytest.fixture(scope="module")
def docs(spark, texts):
    # Extra columns clash with names that the operators make; one row is repeated.
    rows = [(i, t, 7, "x") for i, t in [*texts, texts[5]]]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string").repartition(3)


def test_whole_tokens_are_proven():
    whole = bpe.whole_tokens(JSON, PATTERN)
    assert len(whole) > 45_000
    lib = Tokenizer.from_file(JSON)
    for s in random.Random(1).sample(sorted(whole), 500):
        assert len(lib.encode(s, add_special_tokens=False).ids) == 1


def test_counts(docs, texts):
    lib = Tokenizer.from_file(JSON)
    got = bpe.count_tokens(docs, JSON, PATTERN).collect()
    assert len(got) == len(texts) + 1
    by = {r.doc_id: r for r in got}
    for i, t in texts:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert tuple(by[i]) == (i, len((t or "").encode()), n, n > 1024)


@pytest.mark.parametrize(("chunk", "overlap"), [(300, 40), (700, 64), (32_768, 512)])
def test_encode_and_decode(docs, texts, chunk, overlap):
    lib = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    got = bpe.digest_documents(docs, RANKS, PATTERN, chunk, overlap).collect()
    assert len(got) == len(texts) + 1
    by = {r.doc_id: r for r in got}
    for i, t in texts:
        ids = lib.encode_ordinary(t or "")
        want = (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        assert tuple(by[i]) == want


def test_ids_round_trip(docs, texts):
    encoded = bpe.encode_documents(docs, RANKS, PATTERN, 700, 64)
    back = {r.doc_id: r for r in bpe.decode_documents(encoded, RANKS).collect()}
    for i, t in texts:
        assert bpe.decode(bytes(back[i].ids), RANKS) == (t or "").encode()
        assert back[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.count_tokens(none, JSON, PATTERN).collect() == []
    assert bpe.digest_documents(none, RANKS, PATTERN).collect() == []


def test_repeated_long_rows_count_each(spark):
    docs = spark.createDataFrame([(1, "ab " * 400)] * 3, "doc_id long, text string")
    assert bpe.digest_documents(docs, RANKS, PATTERN, 200, 32).count() == 3


def test_very_long_texts_at_the_real_chunk(spark):
    """Texts of many chunks, not ASCII, with pre-tokens across chunk borders and one longer than a chunk; repeated and null ids."""
    rng = random.Random(7)
    words = ["h\u00e9llo", "\u65e5\u672c\u8a9e", "don't", "\U0001f600\U0001f601", "123456", "   ", "\n\n", "na\u00efve", "\u0436\u0448\u0438", "x"]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    texts = [(1, long), (1, long), (1, long[1:]), (None, long[2:]), (None, long[2:]), (2, "a" * 40_000 + long[:40_000]), (3, "\u65e5" * 70_000), (4, None)]
    lib = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    want = []
    for i, t in texts:
        ids = lib.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert sorted(map(str, map(tuple, bpe.digest_documents(docs, RANKS, PATTERN).collect()))) == sorted(map(str, want))


def most_workers(df) -> int:
    """Python maps that a task of the plan runs at once: the longest chain between exchanges."""
    def chain(node) -> tuple[int, int]:
        below = [chain(node.children().apply(i)) for i in range(node.children().size())]
        here, most = max((b[0] for b in below), default=0), max((b[1] for b in below), default=0)
        here = 0 if "Exchange" in node.nodeName() else here + ("MapInArrow" in node.nodeName())
        return here, max(here, most)

    return chain(df._jdf.queryExecution().executedPlan().executedPlan())[1]


def test_round_trip_is_one_worker_a_task(spark, docs, texts):
    out = bpe.round_trip_documents(docs, RANKS, PATTERN, 700, 64)
    chained = bpe.decode_documents(bpe.encode_documents(docs, RANKS, PATTERN, 700, 64), RANKS)
    assert most_workers(chained) == 2  # before it is run: then stages stand for their plans
    assert most_workers(out) == 1
    assert out.dtypes == chained.dtypes
    assert sorted(map(str, out.collect())) == sorted(map(str, chained.collect()))
    assert len(texts) + 1 == out.count()
    assert bpe.round_trip_documents(docs.limit(0), RANKS, PATTERN).collect() == []


def test_pipeline_tokens_are_one_worker_a_task(spark, docs):
    pipeline = pytest.importorskip("corpus_pipeline")
    assert most_workers(pipeline.tokenize(spark, docs, None)) == 1


def test_workers_remember_for_one_operator():
    b = pa.record_batch({"x": [1]})
    bpe.decode(b"", RANKS)
    common.powers(common.BASE, 10)
    assert list(common.slices([b], remember=True)) == [b] and bpe._loaded and not common._powers
    common.PrimeHash(np.zeros(10, np.uint8))
    assert list(common.slices([b])) == [b] and not bpe._loaded and not common._residues
