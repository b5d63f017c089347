"""Operator 4 against brute force."""

import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest

from priceloom.llm import minhash
from priceloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
    up = {i: i for i in sets}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                up[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus():
    rng = random.Random(2)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(3000)]
    rows = [(-1, None), (-2, ""), (-3, " \t\x0b"), (-4, "one"), (-5, "ONE"), (-6, "two words"), (-7, "Two\x0bwords "), (-8, "É x"), (-9, "é x")]
    base = [rng.choice(vocab) for _ in range(200)]
    for i in range(90):  # a group whose members are linked only in part
        w = list(base)
        for _ in range(rng.randrange(1, 10)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    for i in range(90, 150):
        rows.append((i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 60)))))
    rows += [(200 + i, rows[60][1].upper()) for i in range(20)]
    chain = [rng.choice(vocab) for _ in range(120)]
    for i in range(12):  # a chain: only neighbours are similar
        chain = [*chain[6:], *(rng.choice(vocab) for _ in range(6))]
        rows.append((300 + i, " ".join(chain)))
    return rows


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_components(spark, width, percent):
    rows = corpus()
    docs = spark.createDataFrame([(*r, True, "x") for r in rows], "doc_id long, text string, kept boolean, node string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in minhash.near_duplicates(docs, width, percent).collect()}
    assert got == brute(rows, width, percent)


def test_blocks_find_what_leaders_leave(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LEADERS", 1)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert got == brute(rows, 3, 85)


def test_blocks_of_sets_find_what_leaders_leave(spark, monkeypatch):
    for name, value in (("LEADERS", 1), ("BLOCK", 5), ("SET_BLOCK", 3), ("SET_ITEMS", 400), ("SCRAMBLE", (0x7F,))):
        monkeypatch.setattr(minhash, name, value)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert got == brute(rows, 3, 85)


def test_words_do_not_depend_on_sections(monkeypatch):
    """Very long texts are hashed in sections; a word longer than a section stays whole."""
    rng = random.Random(6)
    texts = ["", None, " " * 500, "x" * 700 + " y", "Long " + "z" * 900]
    texts += [" ".join("".join(rng.choice("abAB\u00e9") for _ in range(rng.randrange(1, 90))) + rng.choice(["", "\t", "  \n"]) for _ in range(rng.randrange(80))) for _ in range(40)]
    column = pa.array(texts)
    whole = minhash.shingle_sets(column, 3)
    for section in (7, 64, 500):
        monkeypatch.setattr(minhash, "SECTION", section)
        got = minhash.shingle_sets(column, 3)
        assert (got[0] == whole[0]).all() and (got[1] == whole[1]).all()
    h, doc = minhash.word_hashes(column)
    words = [(i, w) for i, t in enumerate(texts) for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
    assert doc.tolist() == [i for i, _ in words]
    assert len(set(zip(h.tolist(), [w for _, w in words], strict=True))) == len({w for _, w in words}) == len(set(h.tolist()))


def test_structured_words_differ():
    bits = [bin(i).count("1") & 1 for i in range(4096)]
    one, other = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    h, _ = minhash.word_hashes(pa.array([one, other]))
    assert h[0] != h[1]


def test_sketch_estimates():
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.concatenate([a[:900], rng.integers(0, 1 << 63, 100).astype(np.uint64)])
    s, d = np.concatenate([a, b, a[:1]]), np.concatenate([np.zeros(1000, int), np.ones(1000, int), [2]])
    k = minhash.sketches(s, d, 4, 128)
    assert (k[:3] != np.iinfo(np.uint64).max).all() and (k[3] == 0).all()
    assert abs((k[0] == k[1]).mean() - 900 / 1100) < 0.15


def test_empty_and_repeated(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(none).collect() == []
    docs = spark.createDataFrame([(1, "a b c d e f")] * 3 + [(2, "A b c d e f"), (None, "a b c d e f"), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 2, 1, True)] * 3 + [(2, 2, 1, False), (None, 2, None, True), (None, 0, None, True)], key=str)
    assert minhash.drop_near_duplicates(docs).count() == 5


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    a, b, c = "a b c d e f", "u v w x y z", "q r s t u v"
    rows = [(1, a), (1, a), (5, a.upper()), (5, b), (6, b), (7, c), (7, c), (None, a), (None, "n o id h e r"), (None, "n o id h e r"), (None, " "), (None, " "), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    stay = [r for r in rows if r not in ((5, a.upper()), (6, b))]
    assert sorted(map(tuple, minhash.drop_near_duplicates(docs).collect()), key=str) == sorted(stay, key=str)
    one = [(1, a), (5, b), (7, c), (None, "n o id h e r"), (None, " "), (None, " "), (None, None)]
    got = minhash.drop_near_duplicates(docs, one_row=True)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=str) == sorted(one, key=str)


def test_long_paths(spark):
    edges = spark.range(0, 400).selectExpr("(id * 7919) % 401 AS a", "((id + 1) * 7919) % 401 AS b")
    got = components(edges).collect()
    nodes = defaultdict(set)
    for r in got:
        nodes[r.component].add(r.node)
    assert {k: len(v) for k, v in nodes.items()} == {0: 401}
