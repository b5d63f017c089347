"""Operators 6 and 7: held-out accuracy and exact round trips."""

import base64
import gzip
import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from priceloom.llm import language, queries, warc


def test_held_out_accuracy(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op6_language(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()
    out = [r for r in docs if got[r.doc_id].held_out]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in docs)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in out) / len(out) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_edges(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr"), (None, "de"), ("x", None)] * 3, "text string, lang string")
    model = language.fit(train)
    assert model.langs == ["en", "fr"]
    rows = [(1, None), (2, ""), (3, "123 !! Ⅷ"), (4, "the dog"), (5, "LE CHIEN"), (6, "thecat"), (None, "the"), (4, "the dog"), (7, "the " * 50_000), (8, "日本")]
    docs = spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "doc_id long, text string, lang_pred string, score double")
    got = [(r.doc_id, r.lang_pred) for r in language.predict(docs, model).collect()]
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "fr"), (6, "en"), (None, "en"), (4, "en"), (7, "en"), (8, got[-1][1])]
    empty = language.fit(train.filter("lang = 'xx'"))
    assert {r.lang_pred for r in language.predict(docs, empty).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).collect() == []


def test_copies_count_once_in_training(spark, monkeypatch):
    """A language of mostly copies gets rows, and no group of copies swamps the counts."""
    rows = [(f"zz{k} aa aa", "cc") for k in range(8) for _ in range(200)] + [(f"tt{k} bb bb", "dd") for k in range(500)]
    counted = []

    def count(df, fn, schema):
        out = df.select("text", "lang").collect()
        counted.extend(map(tuple, out))
        return real(df, fn, schema)

    from pyspark.sql.classic.dataframe import DataFrame

    real = DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", count)
    train = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    model = language.fit(train, docs_per_lang=100)
    assert len(counted) == len(set(counted))
    assert sum(lang == "cc" for _, lang in counted) == 8 and 60 <= sum(lang == "dd" for _, lang in counted) <= 140
    assert set(model.words) >= {"aa", "bb"}


def brute_language(train, texts):
    """The scoring from its definition: word counts, backoff to n-grams of 4 to 1 letters, floor 0.5, tempered posterior."""
    import math
    from collections import Counter, defaultdict

    words = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    grams = lambda w, n: [(w if n == 1 else f"<{w}>")[i : i + n] for i in range(max(1, len(w if n == 1 else f"<{w}>") - n + 1))]
    counts, langs = defaultdict(Counter), sorted({g for _, g in train})
    for text, lang in set(train):
        for w in words(text):
            counts[0, lang][w] += 1
            for n in range(1, 5):
                counts[n, lang].update(grams(w, n))
    seen = {n: set().union(*(counts[n, g] for g in langs)) for n in range(5)}
    log = lambda n, g, x: math.log((counts[n, g][x] + 0.5) / (sum(counts[n, g].values()) + 0.5 * len(seen[n]) + 1))

    def word(w):
        if w in seen[0]:
            return [log(0, g, w) for g in langs]
        for n in range(4, 0, -1):
            if known := [x for x in grams(w, n) if x in seen[n]]:
                return [sum(log(n, g, x) for x in known) / len(known) for g in langs]
        return [0.0] * len(langs)

    out = []
    for text in texts:
        w = words(text or "")
        if not any(c.isalpha() for x in w for c in x):
            out.append(("und", 0.0))
            continue
        total = [math.log(sum(g == lang for _, g in set(train)) / len(set(train))) + sum(word(x)[i] for x in w) for i, lang in enumerate(langs)]
        best = max(range(len(langs)), key=lambda i: (total[i], -i))
        out.append((langs[best], 1 / sum(math.exp((t - total[best]) / math.sqrt(len(w))) for t in total)))
    return out


def test_scores_of_brute_force(spark):
    rng = random.Random(3)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 12)))
    letters = {"aa": "abcde", "bb": "bcdef", "cc": "\u00e9\u00e8abx", "dd": "\u0436\u0448\u0438"}
    train = [(make(x), lang) for lang, x in letters.items() for _ in range(25)]
    train += [("only text of a language", "ee")] * 300 + [train[0]] * 40
    texts = [make("abcdef\u00e9x") for _ in range(60)] + [make(x) for x in letters.values() for _ in range(10)] + ["only text of a language", "text of", None, "", "12 _", "\u65e5\u672c", "a1b_c", "e\u0301 x\u0308y"]
    model = language.fit(spark.createDataFrame(train, "text string, lang string").repartition(3))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = [(r.lang_pred, r.score) for r in language.predict(docs, model).orderBy("doc_id").collect()]
    for (lang, score), (pred, value) in zip(brute_language(train, texts), got, strict=True):
        assert lang == pred and value == pytest.approx(score, abs=1e-9)
    assert {"ee", "dd"} <= {lang for lang, _ in got}


def test_tables_find_rows(monkeypatch):
    """Also where hashes are equal."""
    cells = pa.table({"gram": ["a", "b", "b", "\u00e9\u00e9", "zz", "yy"], "at": pa.array([0, 0, 1, 1, 0, 1], pa.int32()), "n": pa.array([1, 2, 3, 4, 5, 6], pa.int64())})
    grams = ["zz", "x", "b", "a", "", "b", "\u00e9\u00e9", "yy", "yyy"]
    table = language._table(cells, 2)
    want = [table.at[g] for g in grams]
    assert table.find(grams).tolist() == want and table.find([]).tolist() == [] and want.count(-1) == 3
    monkeypatch.setattr(language, "hash", lambda g: len(g), raising=False)
    assert language._table(cells, 2).find(grams).tolist() == want
    assert language._table(cells.slice(0, 0), 2).find(grams).tolist() == [-1] * len(grams)


def test_equal_languages_and_hot_texts(spark):
    """Ties go to the name that sorts first; a language of one text, repeated, is learned whatever the sample's size."""
    same = [("alpha beta", "zz"), ("alpha beta", "yy")]
    model = language.fit(spark.createDataFrame(same, "text string, lang string"))
    assert [r.lang_pred for r in language.predict(spark.createDataFrame([("beta",), ("new",)], "text string"), model).collect()] == ["yy", "yy"]
    rows = [("guten tag welt", "de")] * 2000 + [(f"word{k} the cat", "en") for k in range(50)]
    for n in (10, 100, 500):
        model = language.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3), docs_per_lang=n)
        got = language.predict(spark.createDataFrame([("guten tag",), ("the cat",)], "text string"), model).collect()
        assert [r.lang_pred for r in got] == ["de", "en"]


@pytest.fixture
def pages(spark):
    rows = [(1, "http://a", "x"), (2, None, "x"), (3, "http://c", None), (4, "http://d\r\nWARC-Type: evil", ""), (5, "http://é", "é" * 9000), (6, "u", "é" * 9000), (6, "u", "z\r\n\r\nWARC/1.0"), (None, "n", "x"), (7, "u", "\r\n\r\n" * 3)]
    return rows, spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string").repartition(3)


def test_round_trip(spark, pages, tmp_path):
    rows, df = pages
    path = str(tmp_path / "w")
    warc.write_pages(df, path)
    got = warc.read_records(spark, path).filter("record_type IN ('response', 'revisit')").collect()
    assert len(got) == len(rows)
    last = {}
    for i, _, t in rows:
        last[t or ""] = max(last.get(t or "", -1), -1 if i is None else i)
    want = sorted((str(i), len((t or "").encode()), base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode(), "response" if i == last[t or ""] else "revisit", None if i == last[t or ""] else f"urn:page:{last[t or '']}", (t or "").encode() if i == last[t or ""] else None) for i, _, t in [(("null" if a is None else a), b, c) for a, b, c in rows])
    have = sorted((r.record_id.removeprefix("urn:page:"), r.payload_length, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got)
    assert [tuple(map(str, x)) for x in have] == [tuple(map(str, x)) for x in want]
    bare = warc.read_records(spark, path, payload=False)
    assert bare.filter("payload IS NOT NULL").count() == 0 and bare.count() == len(got) + bare.filter("record_type = 'warcinfo'").count()
    # The archive is plain WARC to any gzip reader.
    file = next(p for p in (tmp_path / "w").iterdir() if p.name.endswith(".warc.gz"))
    assert gzip.decompress(file.read_bytes()).startswith(b"WARC/1.0\r\n")


def test_filters_are_pushed(spark, pages, tmp_path):
    _, df = pages
    path = str(tmp_path / "w")
    warc.write_pages(df, path)
    q = warc.read_records(spark, path).filter((F.col("record_type") == "response") & (F.col("record_id") == "urn:page:5"))
    assert " Filter" not in q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == 0 or bytes(q.first().payload) == ("é" * 9000).encode()


def test_foreign_archives(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nhello"
    one = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
    two = one.replace(b"x:1", b"x:2")
    (tmp_path / "plain.warc").write_bytes(one + two)
    (tmp_path / "members.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    got = warc.read_records(spark, str(tmp_path)).collect()
    assert sorted((r.record_id, bytes(r.payload), r.payload_length) for r in got) == sorted([("urn:x:1", b"hello", 5), ("urn:x:2", b"hello", 5)] * 2)


def test_small_payloads_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    kinds = {r.record_id: r.record_type for r in warc.page_records(df, least=3).collect()}
    assert kinds == {"urn:page:1": "response", "urn:page:2": "response", "urn:page:3": "revisit", "urn:page:4": "response"}
    warc.write_pages(df.limit(0), str(tmp_path / "none"))
    assert warc.read_records(spark, str(tmp_path / "none")).collect() == []


def page_figures(rows):
    last = {}
    for i, _, t in rows:
        last[t or ""] = max(last.get(t or "", -1), -1 if i is None else i)
    out = []
    for i, _, t in rows:
        raw, top = (t or "").encode(), last[t or ""]
        kind = "response" if (-1 if i is None else i) == top else "revisit"
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, None if kind == "response" else top))
    return out


@pytest.mark.parametrize("hot", [0, 1, 100])
def test_pages_are_read_back(spark, pages, tmp_path, monkeypatch, hot):
    """The query's columns come from the bodies; groups of equal payloads give the same whether they are broadcast or joined."""
    monkeypatch.setattr(warc, "HOT_GROUPS", hot)
    rows, df = pages
    path = str(tmp_path / "w")
    warc.write_pages(df, path)
    assert sorted(map(str, map(tuple, warc.read_pages(spark, path).collect()))) == sorted(map(str, page_figures(rows)))


def test_a_broken_body_shows(spark, pages, tmp_path):
    rows, df = pages
    path = tmp_path / "w"
    warc.write_pages(df, str(path))
    for file in list(path.iterdir()):
        if file.name.endswith(".warc.gz"):
            plain = gzip.decompress(file.read_bytes()).replace("é".encode() * 9000, b"e" * 18000)
            (path / file.name.removesuffix(".gz")).write_bytes(plain)
            file.unlink()
    (path / warc.MANIFEST).unlink()
    got = {(r.page_id, r.payload_bytes, r.payload_digest) for r in warc.read_pages(spark, str(path)).collect()}
    of = base64.b32encode(hashlib.sha1(b"e" * 18000).digest()).decode()
    assert (6, 18000, of) in got and (5, None, None) in got
