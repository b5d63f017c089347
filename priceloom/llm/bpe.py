"""Byte-level BPE: pre-tokens, token counts by the whole-token shortcut, and chunked encoding and decoding.

Vocabulary files are given by path and never copied.  Pre-tokens come from the public pattern of the vocabulary; its character classes
are the Unicode properties L, N and White_Space.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import unicodedata
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from tokenizers import pre_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.llm.common import batch, remembered, slices, texts_of
from priceloom.session import ship_code

#: Distinct pre-tokens that a worker remembers at once; beyond it the memory starts anew, so it is bounded and results stay the same.
MEMORY = 120_000
_loaded: dict = {}
remembered.append(_loaded)
#: Columns after the id, by what is asked for.
_COLUMNS = {
    "ids": [("ids", pa.binary())],
    "digests": [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())],
    "both": [("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded_sha256", pa.string())],
}
_TYPES = {pa.binary(): "binary", pa.int64(): "long", pa.string(): "string"}


def _latin_class(prop: str) -> str:
    """The members of a Unicode property below U+0100, escaped for a character set."""
    return "".join(f"\\x{c:02x}" for c in range(256) if regex.match(rf"\p{{{prop}}}", chr(c)))


def _splitters(pattern: str) -> tuple:
    if pattern not in _loaded:
        letter, number, space = map(_latin_class, ("L", "N", "White_Space"))
        own = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]").replace(r"\S", f"[^{space}]").replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]").replace(r"\s", f"[{space}]")
        _loaded[pattern] = re.compile(own).findall, regex.compile(pattern).findall
    return _loaded[pattern]


def split(text: str, pattern: str) -> list[str]:
    """Pre-tokens: matches of ``pattern``.  Texts inside Latin-1 take the same pattern with its classes written out, which runs twice as fast."""
    latin, full = _splitters(pattern)
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return full(text)
    return latin(text)


def library_split(text: str, pattern: str) -> list[str]:
    """As :func:`split`, as the tokenizers library splits: its Unicode tables are older, so texts with code points that Unicode 15.1 leaves
    unassigned go to the library's own pre-tokeniser."""
    if "odd" not in _loaded:
        odd = "".join(chr(c) if unicodedata.category(chr(c)) == "Cn" else " " for c in [*range(0x100, 0xD800), *range(0xE000, 0x110000)])
        _loaded["odd"] = re.compile("[" + "".join(f"\\U{ord(a):08x}-\\U{ord(b):08x}" for a, b in _contiguous(odd)) + "]").search
        _loaded["pre"] = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    latin, full = _splitters(pattern)
    try:
        text.encode("latin-1")  # all assigned
        return latin(text)
    except UnicodeEncodeError:
        if not _loaded["odd"](text):
            return full(text)
    return [text[a:b] for _, (a, b) in _loaded["pre"].pre_tokenize_str(text)]


def _contiguous(chars: str):
    first = last = None
    for c in chars:
        if c == " ":
            continue
        if last is not None and ord(c) == ord(last) + 1:
            last = c
            continue
        if first is not None:
            yield first, last
        first = last = c
    if first is not None:
        yield first, last


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    """The merges of a rank file; kept in each worker."""
    if path not in _loaded:
        _loaded[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})
    return _loaded[path]


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: printable Latin-1 stands for itself, the rest follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter(dict):
    """Pre-token -> number of tokens.  It starts with the proven whole tokens; others are merged when first met."""

    def __init__(self, whole, merge):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.merge = whole, merge

    def __missing__(self, piece: str) -> int:
        if len(self) > MEMORY + len(self.whole):
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        n = self[piece] = self.merge(piece)
        return n


def whole_tokens(path: str, pattern: str) -> set[str]:
    """The vocabulary strings proven to encode alone as one token: valid UTF-8, one pre-token, and their own merges end in one id."""
    merge = merger(path)
    out = set()
    for token in _vocabulary(path):
        try:
            s = token.decode()
        except UnicodeDecodeError:
            continue
        if library_split(s, pattern) == [s] and len(merge(token)) == 1:
            out.add(s)
    return out


def _json(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _vocabulary(path: str) -> dict[bytes, int]:
    letters = byte_letters()
    return {bytes(letters[c] for c in token): i for token, i in _json(path)["model"]["vocab"].items() if all(c in letters for c in token)}


def special_strings(path: str) -> list[str]:
    return [t["content"] for t in _json(path)["added_tokens"]]


def merger(path: str):
    """bytes of one pre-token -> ids, by the merge list of a tokenizer .json.

    A merge's order is the rank of what it makes, so the list is turned into ranks (bytes of the merged token -> position) for the same merge
    loop; the single bytes come first.
    """
    if ("merge", path) not in _loaded:
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        ranks = {bytes([b]): b for b in range(256)}
        for i, m in enumerate(_json(path)["model"]["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            ranks.setdefault(raw(left) + raw(right), 256 + i)
        own = tiktoken.Encoding("merges", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        _loaded["merge", path] = own._core_bpe.encode_single_piece
    return _loaded["merge", path]


def _counter(vocabulary: str, whole: frozenset) -> tuple[Counter, re.Pattern | None]:
    """A worker's counter and the pattern of the special strings; kept from task to task."""
    key = ("count", vocabulary)
    if key not in _loaded:
        merge = merger(vocabulary)
        special = special_strings(vocabulary)
        cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        _loaded[key] = (Counter(whole, lambda piece: len(merge(piece.encode()))), cut)
    return _loaded[key]


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``).

    ``vocabulary`` is a byte-level tokenizer .json.  The vocabulary strings that provably encode alone as one token are counted directly when
    they occur as a pre-token; only other pre-tokens are merged.  The proof is made once, on the driver, before any text is read; workers get its outcome, which
    is as large as the vocabulary.  Special strings in a text are one token each and split it, which is the
    library's default.  Null text counts as empty: 0 bytes, 0 tokens; an empty table gives no rows.  A map over rows: no shuffle; repeated rows are counted each;
    other columns are not read.  A text is held as a whole, with its pre-tokens: some ten times its size in a worker.
    """
    ship_code(docs.sparkSession)
    if ("whole", vocabulary, pattern) not in _loaded:
        _loaded["whole", vocabulary, pattern] = frozenset(whole_tokens(vocabulary, pattern))
    whole = docs.sparkSession.sparkContext.broadcast(_loaded["whole", vocabulary, pattern])
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        counts, cut = _counter(vocabulary, whole.value)
        get = counts.__getitem__
        schema = None
        for b in slices(batches, remember=True):
            schema = schema or pa.schema([pa.field("id", b.schema.field(0).type), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
            n_bytes, n_tokens = [], []
            for t in texts_of(b.column(1)):
                n_bytes.append(len(t.encode()))
                if cut and cut.search(t):
                    parts = cut.split(t)
                    n_tokens.append(len(parts) - 1 + sum(sum(map(get, library_split(p, pattern))) for p in parts))
                else:
                    n_tokens.append(sum(map(get, library_split(t, pattern))))
            yield batch(schema, b.column(0), n_bytes, n_tokens, [n > limit for n in n_tokens])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)


class Ids(dict):
    """Pre-token -> its ids as little-endian 32-bit integers."""

    def __init__(self, merge):
        super().__init__()
        self.merge = merge

    def __missing__(self, piece: str) -> bytes:
        if len(self) > MEMORY:
            self.clear()
        out = self[piece] = np.array(self.merge(piece.encode()), "<u4").tobytes()
        return out


def _bytes_of(path: str) -> list[bytes]:
    if ("bytes", path) not in _loaded:
        ranks = load_ranks(path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            table[i] = token
        _loaded["bytes", path] = table
    return _loaded["bytes", path]


def decode(ids: bytes, path: str) -> bytes:
    """The raw bytes of packed ids, concatenated."""
    return b"".join(map(_bytes_of(path).__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _pieces(ranks: str, pattern: str):
    if ("ids", ranks) not in _loaded:
        _loaded["ids", ranks] = Ids(encoder(ranks, pattern)._core_bpe.encode_single_piece)
    return _loaded["ids", ranks].__getitem__


def encode(text: str, ranks: str, pattern: str) -> bytes:
    return b"".join(map(_pieces(ranks, pattern), split(text, pattern)))


def chunk_spans(n: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Spans of ``chunk`` characters, each lengthened by ``overlap`` to the right, so that neighbours share a zone."""
    return [(a, min(n, a + chunk + overlap)) for a in range(0, max(1, n), chunk)]


def resynchronise(left: np.ndarray, right: np.ndarray) -> int | None:
    """The first pre-token start that both neighbours see; from a common start on, both split alike.

    ``left``: starts of the left chunk but for its last two pre-tokens, which its cut end may have changed.  ``right``: those of the right
    chunk after its first two, which its cut start may have changed.
    """
    both = np.intersect1d(left, right, assume_unique=True)
    return int(both[0]) if len(both) else None


def encode_documents(docs: DataFrame, ranks: str, pattern: str, chunk: int = 32_768, overlap: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ids (binary, little-endian unsigned 32-bit); pre-tokens are matches of ``pattern``, each merged by itself.

    A text of more than ``chunk`` characters is cut into overlapping chunks that become rows of their own, pre-tokenised and merged in
    parallel; :func:`stitch` joins them where the pre-token starts of neighbours meet.  Where they don't meet inside the overlap (one
    pre-token as long as it), the two chunks' text is pre-tokenised again as one, so the result is exact for any text.
    Null text counts as empty: no ids; an empty table gives no rows; rows that repeat an id and a text are a row each.  Other columns are not read.
    """
    return _stitched(_encoded(docs, ranks, pattern, chunk, overlap, id_col, text_col), ranks, pattern, id_col, "ids")


def digest_documents(docs: DataFrame, ranks: str, pattern: str, chunk: int = 32_768, overlap: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`encode_documents`, then decoded: id, n_tokens, ids_sha256, decoded_sha256; nothing but digests leaves the workers."""
    return _stitched(_encoded(docs, ranks, pattern, chunk, overlap, id_col, text_col), ranks, pattern, id_col, "digests")


def round_trip_documents(docs: DataFrame, ranks: str, pattern: str, chunk: int = 32_768, overlap: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`decode_documents` of :func:`encode_documents`, decoded in the worker that encoded: id, n_tokens, ids, decoded_sha256.

    A chain of the two is two workers for each task, which stay with their executor as long as it runs Python.
    """
    return _stitched(_encoded(docs, ranks, pattern, chunk, overlap, id_col, text_col), ranks, pattern, id_col, "both")


def _encoded(docs: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, str]:
    ship_code(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    long = F.coalesce(F.length("text") > chunk, F.lit(False))

    def cut(batches):
        """The chunks of each text, in one pass; a slice's size is bounded, so chunks stream out."""
        schema = None
        for b in slices(batches, 1 << 20, remember=True):
            schema = schema or pa.schema([b.schema.field(0), ("row", pa.string()), ("part", pa.int32()), ("text", pa.string())])
            for i in range(b.num_rows):
                one, text, made = b.column(0).slice(i, 1), b.column(2)[i].as_py(), b.column(1)[i].as_py()
                spans = chunk_spans(len(text), chunk, overlap)
                for k in range(0, len(spans), 32):
                    some = spans[k : k + 32]
                    yield batch(schema, pa.concat_arrays([one] * len(some)), [made] * len(some), range(k, k + len(some)), [text[a:z] for a, z in some])

    # Rows that repeat an id and a text are told by the text's digest; their chunks are counted, partly before the shuffle, and encoded once.
    made = rows.filter(long).select("id", F.md5(F.col("text").cast("binary")).alias("row"), "text").mapInArrow(cut, f"id {id_type}, row string, part int, text string")
    parts = made.groupBy("id", "row", "part").agg(F.count(F.lit(1)).alias("times"), F.any_value("text").alias("text"))
    return rows.filter(~long), parts.select("id", "row", "times", "part", "text"), id_type, chunk


def _stitched(encoded, ranks: str, pattern: str, id_col: str, what: str) -> DataFrame:
    short, parts, id_type, chunk = encoded
    extra = _COLUMNS[what]
    fields = ", ".join(f"{name} {_TYPES[kind]}" for name, kind in extra)

    def whole(batches):
        get, schema = _pieces(ranks, pattern), None
        for b in slices(batches, remember=True):
            schema = schema or pa.schema([pa.field("id", b.schema.field(0).type), *extra])
            ids = [b"".join(map(get, split(t, pattern))) for t in texts_of(b.column(1))]
            decoded = [] if what == "ids" else [hashlib.sha256(decode(i, ranks)).hexdigest() for i in ids]
            own = {"ids": ids, "n_tokens": [len(i) // 4 for i in ids], "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids] if what == "digests" else [], "decoded_sha256": decoded}
            yield batch(schema, b.column(0), *(own[name] for name, _ in extra))

    def part(batches):
        get, schema = _pieces(ranks, pattern), None
        for b in slices(batches, remember=True):
            schema = schema or pa.schema([*(b.schema.field(i) for i in range(5)), ("ids", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary())])
            ids, starts, ends = [], [], []
            for p, t in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                pieces = split(t, pattern)
                coded = list(map(get, pieces))
                at = np.fromiter(accumulate(map(len, pieces), initial=0), np.int64, len(pieces) + 1)[:-1] + p * chunk
                ids.append(b"".join(coded))
                starts.append(at.astype("<i8").tobytes())
                ends.append(np.fromiter(accumulate(map(len, coded), initial=0), np.int64, len(coded) + 1).astype("<i8").tobytes())
            yield batch(schema, *(b.column(i) for i in range(5)), ids, starts, ends)

    def stitch(batches):
        """Chunks arrive sorted by document and part; ids stream out piece by piece, so a task holds two chunks (and, for ids, one document)."""
        schema, open_key, doc = None, None, None
        for b in slices(batches, 4 << 20, remember=True):
            schema = schema or pa.schema([pa.field("id", b.schema.field(0).type), *extra])
            done = []
            for r in b.to_pylist():
                if (key := (r["id"], r["row"], r["times"])) != open_key:
                    if doc:
                        done += [(open_key[0], *doc.close())] * open_key[2]
                    open_key, doc = key, _Stitch(ranks, pattern, chunk, what)
                doc.add(r)
            if done:
                yield batch(schema, *zip(*done, strict=True))
        if doc:
            done = [(open_key[0], *doc.close())] * open_key[2]
            yield batch(schema, *zip(*done, strict=True))

    coded = parts.select("id", "row", "times", "part", "text").mapInArrow(part, f"id {id_type}, row string, times long, part int, text string, ids binary, starts binary, ends binary")
    coded = coded.repartition(F.col("id"), F.col("row")).sortWithinPartitions("id", "row", "times", "part")
    out = short.mapInArrow(whole, f"id {id_type}, {fields}").unionByName(coded.mapInArrow(stitch, f"id {id_type}, {fields}"))
    return out.withColumnRenamed("id", id_col)


class _Stitch:
    """Joins a document's chunks in order."""

    def __init__(self, ranks: str, pattern: str, chunk: int, what: str):
        self.ranks, self.pattern, self.chunk, self.what = ranks, pattern, chunk, what
        self.n, self.ids_sha, self.raw_sha, self.all, self.held = 0, hashlib.sha256(), hashlib.sha256(), [], None

    def _out(self, ids: bytes) -> None:
        self.n += len(ids) // 4
        if self.what == "digests":
            self.ids_sha.update(ids)
        else:
            self.all.append(ids)
        if self.what != "ids":
            self.raw_sha.update(decode(ids, self.ranks))

    def add(self, r: dict) -> None:
        new = [r["text"], r["part"] * self.chunk, r["ids"], np.frombuffer(r["starts"], "<i8"), np.frombuffer(r["ends"], "<i8"), True]
        if self.held is None:
            self.held = new
            return
        text, begin, ids, starts, ends, _ = self.held
        at = resynchronise(starts[:-2], new[3][2:])
        if at is None:
            # No common start in the zone: one text, split again from the held chunk's first pre-token, which is a true start.
            joined = text[: new[1] - begin] + new[0]
            pieces = split(joined, self.pattern)
            coded = list(map(_pieces(self.ranks, self.pattern), pieces))
            starts = np.fromiter(accumulate(map(len, pieces), initial=begin), np.int64, len(pieces) + 1)[:-1]
            self.held = [joined, begin, b"".join(coded), starts, np.fromiter(accumulate(map(len, coded), initial=0), np.int64, len(coded) + 1), True]
            return
        i, j = int(np.searchsorted(starts, at)), int(np.searchsorted(new[3], at))
        self._out(ids[: ends[i]])
        base = new[4][j]
        self.held = [new[0][at - new[1] :], at, new[2][base:], new[3][j:], new[4][j:] - base, True]

    def close(self) -> tuple:
        if self.held:
            self._out(self.held[2])
        own = {"ids": b"".join(self.all), "n_tokens": self.n, "ids_sha256": self.ids_sha.hexdigest(), "decoded_sha256": self.raw_sha.hexdigest()}
        return tuple(own[name] for name, _ in _COLUMNS[self.what])


def decode_documents(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, n_tokens, ids, decoded_sha256 of packed ids: the raw bytes of the ids, concatenated, and their digest."""
    ship_code(encoded.sparkSession)
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        schema = None
        for b in slices(batches, remember=True):
            schema = schema or pa.schema([pa.field("id", b.schema.field(0).type), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded_sha256", pa.string())])
            ids = [i or b"" for i in b.column(1).to_pylist()]
            yield batch(schema, b.column(0), [len(i) // 4 for i in ids], ids, [hashlib.sha256(decode(i, ranks)).hexdigest() for i in ids])

    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {id_type}, n_tokens long, ids binary, decoded_sha256 string").withColumnRenamed("id", id_col)
