"""The corpus pipeline, each stage judged on its own input."""

import hashlib

import public_tokenizers
import pytest

pipeline = pytest.importorskip("corpus_pipeline")
from priceloom.llm import bpe  # noqa: E402
from tests.llm.test_near import brute as near_brute  # noqa: E402
from tests.llm.test_repeats import brute as repeat_brute  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        docs = pipeline.materialize(stage(spark, docs, sf_dir), f"test-{name}")
        out.append(docs)
    return out


def test_stages(steps):
    docs = steps[0]
    for d in steps[1:-1]:
        assert d.columns == docs.columns and d.dtypes == docs.dtypes
    rows = [{r.doc_id: r.text for r in d.select("doc_id", "text").collect()} for d in steps[:4]]
    assert len(rows[1]) >= 0.98 * len(rows[0])
    near = near_brute(list(rows[1].items()), 5, 80)
    assert set(rows[2]) == {i for i, (_, _, kept) in near.items() if kept}
    cut = repeat_brute(list(rows[2].items()), 200, True)
    for i, (n, gone, _, sha) in cut.items():
        if n > gone and i in rows[3] and "�" not in rows[3][i] and gone == 0:
            assert hashlib.sha256(rows[3][i].encode()).hexdigest() == sha
    assert set(rows[3]) == {i for i, (n, gone, _, _) in cut.items() if n > gone}


def test_tokens_decode_to_the_mix(steps):
    mixed = sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in steps[4].collect())
    out = steps[5].collect()
    assert sorted(r.decoded_sha256 for r in out) == mixed
    ranks = public_tokenizers.path(pipeline.RANKS)
    assert all(r.n_tokens == len(r.ids) // 4 and hashlib.sha256(bpe.decode(bytes(r.ids), ranks)).hexdigest() == r.decoded_sha256 for r in out)
