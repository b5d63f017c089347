"""Language identification: known words first, backing off to ever shorter character n-grams for unseen words."""

from __future__ import annotations

import math
import re
from collections import Counter as Tally
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import batch, slices, texts_of
from priceloom.session import ship_code

#: Runs of letters (and letter-like numbers, which carry no weight of their own).
_WORDS = re.compile(r"[^\W\d_]+").findall
LONGEST = 4
#: Count of what a language has not shown.
FLOOR = 0.5


def _grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between its marks ``<`` and ``>``; n = 1 leaves the marks out."""
    w = word if n == 1 else f"<{word}>"
    return [w[i : i + n] for i in range(max(1, len(w) - n + 1))]


class _Rows(dict):
    """gram -> row, -1 for one that is not known."""

    def __missing__(self, gram: str) -> int:
        return -1


class Table:
    """Log frequencies of grams by language, as a sparse table: only (gram, language) pairs that were seen are kept, all others have their language's floor.

    ``grams`` are distinct; those of row i have cells ``start[i]`` to ``start[i + 1]`` of ``lang`` and ``log``.  What finds them is made where it is first used,
    so neither the driver nor the broadcast holds it: a dictionary, or for many at once sorted hashes, which take a tenth of its memory.
    """

    def __init__(self, floor: np.ndarray, grams: pa.Array, start: np.ndarray, lang: np.ndarray, log: np.ndarray):
        self.floor, self.grams, self.start, self.lang, self.log = floor, grams, start, lang, log
        self._at: _Rows | None = None
        self._sorted: tuple[np.ndarray, np.ndarray] | None = None

    @property
    def at(self) -> _Rows:
        if self._at is None:
            self._at = _Rows(zip(self.grams.to_pylist(), range(len(self.grams))))
        return self._at

    def __getstate__(self):
        return self.__dict__ | {"_at": None, "_sorted": None}

    def find(self, grams: list[str]) -> np.ndarray:
        """The row of each gram, -1 for one that is not known.  Hashes of equal value are looked at one after the other, and the texts decide."""
        if self._sorted is None:
            own = np.fromiter(map(hash, self.grams.to_pylist()), np.int64, len(self.grams))
            order = np.argsort(own, kind="stable")
            self._sorted = own[order], order.astype(np.int32)
        hashes, rows = self._sorted
        wanted = np.fromiter(map(hash, grams), np.int64, len(grams))
        out, texts = np.full(len(grams), -1, np.int64), pa.array(grams, pa.string())
        at, left = np.searchsorted(hashes, wanted), np.arange(len(grams))
        while len(left := left[at[left] < len(hashes)]) and len(left := left[hashes[at[left]] == wanted[left]]):
            row = rows[at[left]]
            same = pc.equal(self.grams.take(pa.array(row)), texts.take(pa.array(left))).to_numpy(zero_copy_only=False)
            out[left[same]] = row[same]
            left = left[~same]
            at[left] += 1
        return out

    def add(self, total: np.ndarray, doc: np.ndarray, row: np.ndarray, weight: np.ndarray) -> None:
        """Add ``weight`` times the log frequencies of ``row`` to the languages' sums of ``doc``: floors for all, and for seen cells what they are above."""
        docs, langs = total.shape
        total += np.bincount(doc, weights=weight, minlength=docs)[:, None] * self.floor
        n = self.start[row + 1] - self.start[row]
        of = np.repeat(np.arange(len(row)), n)
        cell = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + self.start[row][of]
        above = weight[of] * (self.log[cell] - self.floor[self.lang[cell]])
        total += np.bincount(doc[of] * langs + self.lang[cell], weights=above, minlength=docs * langs).reshape(docs, langs)


def _table(cells: pa.Table, langs: int) -> Table:
    """The table of cells (gram, at, n), one for each gram and language."""
    cells = cells.sort_by([("gram", "ascending"), ("at", "ascending")])
    grams, at, n = cells["gram"].combine_chunks(), cells["at"].to_numpy(), cells["n"].to_numpy().astype(float)
    first = np.ones(len(at), bool)
    if len(at):
        first[1:] = pc.not_equal(grams[1:], grams[:-1]).to_numpy(zero_copy_only=False)
    start = np.append(np.flatnonzero(first), len(at))
    below = np.bincount(at, weights=n, minlength=langs) + FLOOR * (len(start) - 1) + 1
    return Table(np.log(FLOOR / below), grams.take(pa.array(start[:-1])), start, at.astype(np.int32), np.log((n + FLOOR) / below[at]))


@dataclass
class Model:
    """Log frequencies by language: of words, and of character n-grams for n from 1 to LONGEST; its size is bounded by the sample of :func:`fit`."""

    langs: list[str]
    prior: np.ndarray
    tables: list[Table]

    @property
    def words(self) -> dict[str, int]:
        return self.tables[0].at

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text.  A word scores its log frequency in each language: its own if known, else the mean over its known n-grams of the
        longest length that has any.  Words are counted per text; known ones are scored at once, for all texts, from the sparse tables."""
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        keys, counts, docs, sizes = [], [], [], []
        for i, text in enumerate(texts if self.langs else ()):
            words = _WORDS(text.lower())
            if words and any(map(_has_letter, words)):
                tally = Tally(words)
                keys += tally
                counts += tally.values()
                docs.append(i)
                sizes.append((len(tally), len(words)))
        if not docs:
            return names, scores
        size = np.array(sizes)
        doc, count = np.repeat(np.arange(len(docs)), size[:, 0]), np.array(counts, float)
        total = np.tile(self.prior, (len(docs), 1))
        row = self.tables[0].find(keys)
        known = row >= 0
        self.tables[0].add(total, doc[known], row[known], count[known])
        rest = np.flatnonzero(~known)
        for n, (at, rows, share) in enumerate(self._backed_off([keys[i] for i in rest.tolist()]), 1):
            if len(at):
                self.tables[n].add(total, doc[rest[at]], rows, count[rest[at]] * share)
        best = total.argmax(1)  # the first of equals in the order of the languages' names
        top = total[np.arange(len(docs)), best]
        value = 1 / np.exp((total - top[:, None]) / np.sqrt(size[:, 1])[:, None]).sum(1)
        for i, lang in zip(docs, best.tolist(), strict=True):
            names[i] = self.langs[lang]
        scores[docs] = value
        return names, scores

    def _backed_off(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For n from 1 to LONGEST: (place in ``words``, row, share) of the known n-grams of the words of which n is the longest length with any."""
        found: list[tuple[list, list, list]] = [([], [], []) for _ in range(LONGEST)]
        met: dict[str, tuple[int, list[int]]] = {}
        for i, w in enumerate(words):
            if w not in met:
                met[w] = (0, [])
                for n in range(LONGEST, 0, -1):
                    if known := [k for k in map(self.tables[n].at.__getitem__, _grams(w, n)) if k >= 0]:
                        met[w] = (n, known)
                        break
            n, known = met[w]
            if n:
                at, rows, share = found[n - 1]
                at += [i] * len(known)
                rows += known
                share += [1 / len(known)] * len(known)
        return [(np.array(a, np.int64), np.array(r, np.int64), np.array(s, float)) for a, r, s in found]


def _has_letter(word: str) -> bool:
    return any(map(str.isalpha, word))


def held_out(id_col: Column) -> Column:
    """Fold by CRC of the id's text: remainder 1 of 3 is held out (a null id is not)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(labelled: DataFrame, docs_per_lang: int = 4000, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from rows with a text and a language.

    The one bound: about ``docs_per_lang`` distinct texts of each language are read, all of them where there are no more (drawn by a hash of the text, so reruns
    agree and order does not matter; copies of a text count once, in the languages' prior too).  Nothing that the sample shows is dropped, so the model that is broadcast is as large as the
    distinct words and n-grams of the sample.  Counting is distributed; counts of the sample's grams reach the driver.
    """
    ship_code(labelled.sparkSession)
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("hash", F.xxhash64("text"))
    texts = rows.select("lang", "hash").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    found = sorted(texts.collect(), key=lambda r: r["lang"])
    langs = [r["lang"] for r in found]
    if not langs:
        return Model([], np.zeros(0), [])
    share = F.element_at(F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(1.0, docs_per_lang / r["texts"]))]), F.col("lang"))
    sample = rows.filter(F.pmod("hash", F.lit(1 << 30)) < share * (1 << 30)).groupBy("lang", "hash").agg(F.min("text").alias("text")).select("text", "lang")
    counts = sample.mapInArrow(_count, "lang string, kind int, gram string, n long").groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n"))
    # Columns of Arrow buffers: some 40 bytes a cell, where Python objects would be several hundred.
    counted = counts.select("lang", "kind", "gram", "n").toArrow()
    counted = counted.append_column("at", pc.index_in(counted["lang"], value_set=pa.array(langs))).drop_columns("lang")
    tables = [_table(counted.filter(pc.equal(counted["kind"], kind)), len(langs)) for kind in range(LONGEST + 1)]
    n = np.array([r["texts"] for r in found], float)
    return Model(langs, np.log(n / n.sum()), tables)


_COUNTED = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("gram", pa.string()), ("n", pa.int64())])


def _count(batches):
    for b in slices(batches):
        by_lang: dict[str, Tally] = {}
        for t, lang in zip(texts_of(b.column(0)), b.column(1).to_pylist(), strict=True):
            by_lang.setdefault(lang, Tally()).update(_WORDS(t.lower()))
        for lang, words in by_lang.items():
            for kind in range(LONGEST + 1):
                tally = words if kind == 0 else Tally()
                if kind:
                    for w, n in words.items():
                        for g in _grams(w, kind):
                            tally[g] += n
                if tally:
                    yield batch(_COUNTED, [lang] * len(tally), [kind] * len(tally), list(tally), list(tally.values()))


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_to: str = "lang_pred", score_to: str = "score") -> DataFrame:
    """``docs`` with the predicted language (``und`` where a text is null, empty or without letters) and a score from 0 to 1.

    Whole texts count; a word is a run of letters, so a combining mark or a digit ends one.  Ties go to the language whose name sorts first.  A map over rows: no shuffle; the model, bounded by the parameters of :func:`fit`, is broadcast.  The columns
    ``lang_to`` and ``score_to`` replace such columns of ``docs``.
    """
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model, schema = shared.value, None
        for b in slices(batches, 1 << 20):
            at = b.schema.get_field_index(text_col)
            schema = schema or pa.schema([*b.schema, (lang_to, pa.string()), (score_to, pa.float64())])
            yield batch(schema, *b.columns, *model.predict(texts_of(b.column(at))))

    docs = docs.drop(lang_to, score_to)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{lang_to}` string, `{score_to}` double")
