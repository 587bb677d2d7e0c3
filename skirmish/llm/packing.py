"""Sequence packing: shortest-pack-first over the length histogram.

Every document is tokenised once; its ids (with the end id) are cut into pieces of the sequence length and one
remainder, so that a piece is known by (document, start). The histogram of piece lengths has at most `seq_len` rows
whatever the size of the corpus; the driver packs the histogram, not the documents: lengths go longest first into the
emptiest open pack, and only counts of packing patterns are kept. Each pattern's place for a length covers a range of
ranks, and a document finds its sequence by its rank among the pieces of its length.

Null text is the empty text (it still has the end id). Repeated rows and null ids are packed like any other row; rows
that agree in id, start, length and checksum are interchangeable. Extra columns of the input are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
import string
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skirmish.llm.common import cut, prepare

SEQ_LEN = 4096
END_ID = 2
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _byte_symbols() -> dict[int, str]:
    """The printable stand-ins that byte-level BPE vocabularies use for bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: The vocabulary's own pre-tokenizer, for lower-case ASCII.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ a-z0-9]+")
#: Letters that are composed already and have a lower case of one letter: all below U+0250 but one.
_COMPOSED = re.compile("[^\u0130\u0250-\U0010ffff]+")


class CachedTokenizer:
    """Token ids of whole texts, equal to the tokenizer's own, through a bounded cache of blank-separated chunks.

    The vocabulary's pre-tokenizer never joins what a blank separates, so a text's ids are those of its chunks in
    turn. A chunk of letters with punctuation behind it is the letters' ids and then the punctuation's. The cache has two
    generations of at most `limit` chunks: a full one becomes the old one, and what is asked for again comes back from it, so
    that frequent chunks stay."""

    def __init__(self, path: str, limit: int = 300_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.packed = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.limit = limit
        self.old: dict[str, bytes] = {}
        stand_in = _byte_symbols()
        outer = self

        class Symbols(dict):
            """For each letter the stand-ins of its bytes."""

            def __missing__(self, code: int) -> str:
                out = self[code] = "".join(map(stand_in.__getitem__, chr(code).encode()))
                return out

        class Cache(dict):
            def __missing__(self, chunk: str) -> bytes:
                out = outer.old.get(chunk)
                if out is None:
                    out = outer.ascii_chunk(chunk) if chunk.isascii() and len(chunk) <= 64 else outer.chunk(chunk)
                if len(self) >= outer.limit:
                    outer.old = dict(self)
                    self.clear()
                self[chunk] = out
                return out

        self.symbols, self.cache = Symbols(), Cache()

    def read(self, letters: str) -> bytes:
        """Ids of one pre-tokenised part, packed as little-endian unsigned 32-bit numbers."""
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(letters)])

    def letters(self, word: str) -> str | None:
        """The word as the model reads it, if normalisation leaves letters alone: a letter may come apart into a letter and
        a mark, and marks form chunks with punctuation."""
        if not word.isalpha():
            return None
        if word.isascii():
            return word.lower()
        norm = word.lower() if _COMPOSED.fullmatch(word) else self.tokenizer.normalizer.normalize_str(word)
        return norm.translate(self.symbols) if norm.isalpha() else None

    def word(self, word: str) -> bytes:
        """Ids of any chunk."""
        if read := self.letters(word):
            return self.read(read)
        return b"".join([self.packed[i] for i in self.tokenizer.encode(word, add_special_tokens=False).ids])

    def ascii_chunk(self, chunk: str) -> bytes:
        """The same for ASCII, where letters, digits and all else are plain to see; capitals share an entry, and so do
        the letters and the punctuation of a chunk."""
        low = chunk.lower()
        if low.isalpha():
            return self.cache[low] if low != chunk else self.read(low)
        core = low.rstrip(string.punctuation)
        if core.isalpha():
            return self.cache[core] + self.cache[low[len(core) :]]
        if "<|" in chunk or not chunk.isprintable():  # perhaps a special token, or bytes with stand-ins
            return self.word(chunk)
        return b"".join(map(self.read, _PARTS.findall(low)))

    def chunk(self, chunk: str) -> bytes:
        if len(chunk) > 64:
            return self.word(chunk)
        core = chunk.rstrip(string.punctuation)
        if read := self.letters(core):
            return self.read(read) + self.cache[chunk[len(core) :]] if core != chunk else self.read(read)
        return self.word(chunk)

    def ids(self, text: str | None) -> bytes:
        chunks = (text or "").replace("\n", " ").replace("\t", " ").split(" ")
        return b"".join(map(self.cache.__getitem__, chunks))


_tokenizers: dict[str, CachedTokenizer] = {}


def cached_tokenizer(path: str) -> CachedTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = CachedTokenizer(path)
    return _tokenizers[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: PIECE_SCHEMA, and the ids themselves as `ids array<long>` if asked for."""
    prepare(docs.sparkSession)
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")] + [("ids", pa.list_(pa.int64()))] * with_ids)
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = cached_tokenizer(tokenizer_path)
        for batch in batches:
            rows: list[list] = [[] for _ in schema]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                packed = tokenizer.ids(text.as_py()) + end
                n = len(packed) // 4
                for start in range(0, n, seq_len):
                    piece = packed[4 * start : 4 * (start + seq_len)]
                    made = [doc, start, len(piece) // 4, zlib.crc32(piece), n]
                    for column, value in zip(rows, made + [np.frombuffer(piece, "<u4").tolist()] * with_ids, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pieces, PIECE_SCHEMA + ", ids array<long>" * with_ids)


@dataclass
class Pattern:
    """A way to fill a sequence, and how many sequences are filled so: items are (length, copies)."""

    total: int
    count: int
    items: list[tuple[int, int]] = field(default_factory=list)


def pack_histogram(histogram: dict[int, int], seq_len: int = SEQ_LEN) -> list[Pattern]:
    """Shortest-pack-first: lengths longest first, each into the emptiest pack; where even that has no room, new packs
    take as many copies as fit. Works on counts, so its time doesn't depend on the number of pieces."""
    heap: list[tuple[int, int, Pattern]] = []
    serial, done = 0, []

    def push(p: Pattern) -> None:
        nonlocal serial
        serial += 1
        if p.count and p.total < seq_len:
            heapq.heappush(heap, (p.total, serial, p))
        elif p.count:
            done.append(p)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not heap or heap[0][0] + length > seq_len:
                fit = seq_len // length
                push(Pattern(fit * length, left // fit, [(length, fit)]))
                if left % fit:
                    push(Pattern(left % fit * length, 1, [(length, left % fit)]))
                break
            _, _, p = heapq.heappop(heap)
            if left < p.count:
                push(Pattern(p.total, p.count - left, p.items))
                push(Pattern(p.total + length, left, [*p.items, (length, 1)]))
                break
            above = heap[0][0] if heap else seq_len
            copies = max(1, min(left // p.count, (seq_len - p.total) // length, (above - p.total) // length))
            push(Pattern(p.total + copies * length, p.count, [*p.items, (length, copies)]))
            left -= copies * p.count
    return done + [p for _, _, p in sorted(heap, key=lambda x: x[:2])]


def places(patterns: list[Pattern]) -> np.ndarray:
    """One row for each place of a length in a pattern: length, first rank, packs, first sequence, offset; sorted."""
    rows, ranks, sequence = [], {}, 0
    for p in patterns:
        offset = 0
        for length, copies in p.items:
            first = ranks.get(length, 0)
            rows.append((length, first, p.count, sequence, offset))
            ranks[length] = first + copies * p.count
            offset += copies * length
        sequence += p.count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(pieces: DataFrame, salts: int) -> DataFrame:
    """rank: 0, 1, ... among the pieces of a length. Ranks are given within (length, salt), so that a frequent length
    spreads over `salts` sorts, and shifted by the counts of the salts before."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = salted.groupBy("length", "salt").count().select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    return salted.withColumn("rank", F.row_number().over(within) - 1).join(shift, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("shift")).drop("salt", "shift")


def pack(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces with sequence_id and offset. The tokenised pieces are written once to the shared folder; all that follows
    reads that table. What the driver collects is the histogram of lengths: at most seq_len rows."""
    spark = docs.sparkSession
    pieces = cut(token_pieces(docs, tokenizer_path, seq_len, end_id, with_ids))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    lengths = np.array(sorted(histogram), np.int64)
    # Numbered through over all lengths in turn, ranks are one sorted column whatever the sequence length.
    base = np.r_[0, np.cumsum([histogram[n] for n in lengths.tolist()])][:-1].astype(np.int64)
    table = spark.sparkContext.broadcast((lengths, base, places(pack_histogram(histogram, seq_len))))
    salts = max(32, sum(histogram.values()) // 1_000_000)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        lengths, base, t = table.value
        of = lambda n: base[np.searchsorted(lengths, n)]
        rank = rank.to_numpy()
        row = t[np.searchsorted(of(t[:, 0]) + t[:, 1], of(length.to_numpy()) + rank, "right") - 1]
        copy, pack_no = np.divmod(rank - row[:, 1], row[:, 2])
        return pd.DataFrame({"sequence_id": row[:, 3] + pack_no, "offset": row[:, 4] + copy * row[:, 0]})

    def placed(c: str) -> Column:
        return F.col(f"place.{c}").alias(c)

    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    out = ranked(pieces, salts).withColumn("place", place("length", "rank"))
    return out.select(*keep, placed("sequence_id"), placed("offset"), *["ids"] * with_ids)
