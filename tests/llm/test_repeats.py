"""Operator 8 against brute force."""

import hashlib
import random

import numpy as np
import pytest

from priceloom.llm import suffix


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(60) for _ in range(6)]
    rows = [(1, None), (2, ""), (3, "a" * 700), (4, "ab" * 200 + "é" * 150), (5, "x" * 79), (6, "x" * 79), (7, "q" + "é" * 60 + "r"), (8, "p" + "é" * 60 + "s")]
    for i in range(10, 60):
        parts = [text(rng.randrange(0, 60)) for _ in range(3)]
        rows.append((i, parts[0] + rng.choice(shared) + parts[1] + (rng.choice(shared) if rng.random() < 0.5 else "") + parts[2]))
    rows += [(70 + i, rows[20][1]) for i in range(5)]
    rows.append((90, rows[21][1][:150] + "#" + rows[21][1][30:170]))
    return rows


def brute(rows, length, first):
    count, out = {}, {}
    raw = {i: (t or "").encode() for i, t in sorted(rows)}
    for b in raw.values():
        for p in range(len(b) - length + 1):
            count[b[p : p + length]] = count.get(b[p : p + length], 0) + 1
    seen = set()
    for i, b in raw.items():
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if (w in seen) if first else count[w] > 1:
                gone[p : p + length] = True
            seen.add(w)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("classes", [4096, 2])
def test_removal(spark, monkeypatch, keep, classes):
    monkeypatch.setattr(suffix, "CLASSES", classes)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id int, spans string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in suffix.remove_repeats(docs, 80, keep, digest=True).collect()}
    assert got == brute(rows, 80, keep == "first")
    back = suffix.remove_repeats(docs, 80, keep)
    assert back.columns == docs.columns
    texts = {r.doc_id: r.text for r in back.collect()}
    assert texts[1] is None and texts[2] == "" and len(texts) == len(rows)


def test_short_sections(spark, monkeypatch):
    monkeypatch.setattr(suffix, "SECTION", 300)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: tuple(r)[1:] for r in suffix.remove_repeats(docs, 80, "none", digest=True).collect()}
    assert got == brute(rows, 80, False)


def test_ranks_follow_suffix_order():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    r = suffix.suffix_ranks(data, 12)
    raw = data.tobytes()
    for i, j in rng.integers(0, 2980, (2000, 2)):
        a, b = raw[i : i + 12], raw[j : j + 12]
        assert (r[i] < r[j]) == (a < b) and (r[i] == r[j]) == (a == b)


def test_ranks_without_packing(monkeypatch):
    data = np.random.default_rng(2).integers(97, 100, 500).astype(np.uint8)
    want = suffix.suffix_ranks(data, 9)
    pairs = suffix._ranks(np.full(4, 1 << 62, np.uint64), np.array([3, 1, 3, 2], np.uint64), 40)
    assert pairs.tolist() == [2, 0, 2, 1] and want.max() < 500


def test_sliding_min():
    x = np.random.default_rng(0).integers(0, 1000, 997)
    for w in (1, 7, 137, 997):
        assert (suffix.sliding_min(x, w) == [x[i : i + w].min() for i in range(len(x) - w + 1)]).all()


def test_empty_nulls_and_repeated_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.remove_repeats(none, 50).collect() == []
    t = "".join(chr(97 + i * 7 % 26) for i in range(60))
    docs = spark.createDataFrame([(1, t), (1, t), (None, t + "z"), (None, None)], "doc_id long, text string")
    got = sorted(map(str, suffix.remove_repeats(docs, 50, "none", digest=True).select("doc_id", "n_bytes", "n_removed").collect()))
    assert got == sorted(["Row(doc_id=1, n_bytes=60, n_removed=60)"] * 2 + ["Row(doc_id=None, n_bytes=61, n_removed=60)", "Row(doc_id=None, n_bytes=0, n_removed=0)"])


def brute_rows(rows, length, first):
    """As :func:`brute` for rows (id, text) that may repeat ids and texts: a list of (id, kept bytes), rows in the operator's order."""
    raw = [(t or "").encode() for _, t in rows]
    count, seen, out = {}, set(), []
    for b in raw:
        for p in range(len(b) - length + 1):
            count[b[p : p + length]] = count.get(b[p : p + length], 0) + 1
    for (i, _), b in zip(rows, raw, strict=True):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if (w in seen) if first else count[w] > 1:
                gone[p : p + length] = True
            seen.add(w)
        out.append((i, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("keep", ["first", "none"])
@pytest.mark.parametrize("parts", [1, 5])
def test_repeated_rows_and_null_ids(spark, keep, parts):
    """One of the rows that repeat an id and a text is the first copy, with or without an id; nothing is lost."""
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    t, u, v = text(400), text(300), text(350)
    rows = [(None, v), (None, v), (1, t), (1, t), (1, t), (2, u + t[40:330] + text(50)), (3, v[100:] + text(80)), (4, "short"), (4, "short"), (5, None), (5, None), (6, u)]
    docs = spark.createDataFrame([(*r, k % 2) for k, r in enumerate(rows)], "doc_id long, text string, spans int").repartition(parts)
    want = sorted((-1 if i is None else i, b) for i, b in brute_rows(rows, 100, keep == "first"))
    got = sorted((-1 if r.doc_id is None else r.doc_id, (r.text or "").encode()) for r in suffix.remove_repeats(docs, 100, keep).collect())
    assert got == want
    if keep == "first":
        assert {t.encode(), v.encode()} <= {b for _, b in got}
    digests = sorted((-1 if r.doc_id is None else r.doc_id, r.kept_sha256) for r in suffix.remove_repeats(docs, 100, keep, digest=True).collect())
    assert digests == sorted((i, hashlib.sha256(b).hexdigest()) for i, b in want)


def test_digests_tell_structured_strings_apart(spark):
    """Thue-Morse strings and their complements collide under polynomial hashes modulo powers of two, whatever the base."""
    bits = np.array([bin(i).count("1") & 1 for i in range(2048)])
    one, other = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    rows = [(1, "x" * 70 + one), (2, "x" * 70 + other)]
    got = {r.doc_id: tuple(r)[1:] for r in suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 1500, "none", digest=True).collect()}
    assert got == brute(rows, 1500, False)


def test_longest_previous_factors():
    rng = np.random.default_rng(3)
    for alphabet in (1, 2, 4):
        raw = bytes(rng.integers(97, 97 + alphabet, 300).astype(np.uint8))
        order = sorted(range(len(raw)), key=lambda i: raw[i:])
        common = lambda a, b: next((k for k in range(len(raw)) if max(a, b) + k >= len(raw) or raw[a + k] != raw[b + k]), len(raw))  # noqa: E731, B023
        lcp = [0] + [common(a, b) for a, b in zip(order, order[1:])]
        factor, source = suffix.longest_previous(order, lcp)
        for k, p in enumerate(order):
            assert factor[k] == max((common(p, q) for q in range(p)), default=0)
            assert (source[k] == -1) == (factor[k] == 0)
            if factor[k]:
                assert order[source[k]] < p and common(p, order[source[k]]) == factor[k]


def test_window_factors():
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.integers(97, 99, 600), rng.integers(97, 99, 60)] * 2).astype(np.uint8)
    at = np.sort(rng.choice(len(data) - 40, 500, replace=False))
    factor, source, _ = suffix.window_factors(data, at, 40)
    raw = data.tobytes()
    common = lambda a, b: next((k for k in range(40) if raw[a + k] != raw[b + k]), 40)
    for k in range(len(at)):
        best = max((common(at[k], at[j]) for j in range(k)), default=0)
        assert factor[k] == best
        if best:
            assert source[k] < k and common(at[k], at[source[k]]) == best
