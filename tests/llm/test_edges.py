"""Odd tables through every stage of the pipeline, and where intermediate tables lie."""

import hashlib

import pytest
from pyspark.sql import functions as F

from priceloom.llm import common
from tests.llm.test_repeats import brute_rows

pipeline = pytest.importorskip("corpus_pipeline")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, target string, size int, shards string, `order_key` long"
WORDS = {"en": "the cat and dog sat on a mat by river house green tree walks slowly home again", "fr": "le chat et chien sur un tapis vert arbre maison riviere lentement encore chez nous"}


def rows():
    import random

    rng = random.Random(11)
    text = lambda lang, n: " ".join(rng.choice(WORDS[lang].split()) + str(rng.randrange(900)) for _ in range(n))
    shared = text("en", 60)
    out = [(i, text("en" if i % 2 else "fr", rng.randrange(5, 90)), "en" if i % 2 else "fr", f"s{i % 3}") for i in range(60)]
    out += [(100 + i, text("en", 30) + " " + shared + " " + text("en", 30), "en", None) for i in range(3)]
    out += [(200, out[0][1], "fr", "s0"), (3, out[3][1], "en", "s0"), (3, out[3][1], "en", "s0"), (None, out[4][1], None, "s1"), (None, text("fr", 40), "fr", "s1"), (None, None, None, None), (300, "", "en", "s2"), (301, " \t ", None, ""), (302, "12 34", "en", "s2")]
    out += [(400, "\u00e9t\u00e9 " * 400 + text("fr", 20_000), "fr", "s1")]
    return [(*r, len(r[1] or ""), f"t{k}", k, "x", -k) for k, r in enumerate(out)]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('odd')}"
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    docs, out = spark.read.parquet(f"{root}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        out.append(docs)
        docs = common.materialize(stage(spark, docs, root), f"odd-{name}")
    return [d.collect() for d in (*out, docs)], [d.columns for d in out]


def test_columns_and_rows_stay_whole(steps):
    found, columns = steps
    assert all(c == columns[0] for c in columns)
    own = {r.target: tuple(r) for r in found[0]}
    for stage in found[1:5]:
        for r in stage:
            was = own[r.target]
            assert (r.doc_id, *tuple(r)[2:]) == (was[0], *was[2:])
    kept = found[1]
    assert {r.target for r in kept} >= {t for t, r in own.items() if r[1] and len(r[1].split()) > 4} and not [r for r in kept if not r.text or not any(c.isalpha() for c in r.text)]


def test_near_keeps_one_of_each_group(steps):
    found, _ = steps
    texts = [r.text for r in found[2]]
    assert len(texts) == len(set(texts)) and set(texts) == {r.text for r in found[1]}
    assert [r.doc_id for r in found[2] if r.text == rows()[0][1]] == [0]


def test_cut_texts_are_those_of_brute_force(steps):
    """Also where something was cut, and for rows without an id; a later copy goes, the first stays."""
    found, _ = steps
    before = sorted(found[2], key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert sum(r.doc_id is None for r in before) <= 2
    want = sorted(b.decode("utf-8", "ignore") for _, b in brute_rows([(r.doc_id, r.text) for r in before], 200, True) if b)
    got = sorted(r.text for r in found[3])
    if sum(r.doc_id is None for r in before) < 2:
        assert got == want
    assert len(got) == len(want) and sum(map(len, got)) == sum(map(len, want)) and got != sorted(r.text for r in found[2])


def test_mix_and_tokens(steps):
    found, _ = steps
    texts = {r.target: r.text for r in found[3]}
    assert all(texts[r.target].startswith(r.text) for r in found[4])
    assert sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in found[4]) == sorted(r.decoded_sha256 for r in found[5])


def test_empty_table(spark, tmp_path):
    root = f"file://{tmp_path}"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{root}/documents.parquet")
    assert pipeline.run(spark, root).collect() == []


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    class Far:
        class sparkContext:  # noqa: N801
            master = "spark://far:7077"

        class conf:  # noqa: N801
            get = staticmethod(lambda name, default: default)

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_dir(Far)
    path = common.new_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/")) and spark.sparkContext.applicationId in path
    assert spark.range(3).agg(F.count(F.lit(1)).alias("n")).first().n == 3
