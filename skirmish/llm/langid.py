"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter holds every language's frequent character n-grams at once: each slot is a mask with one bit
for each language, and the AND of an n-gram's slots is the set of languages that contain it. A text's n-grams give, for
each language, a population count; the share that false positives alone would give is taken off, by the fill of that
language's slice, and the largest corrected count decides.

Learning reads a bounded sample: at most `sample_docs` documents of each language, by a hash of the id, and at most
`max_languages` languages, the most frequent ones; masks take as many words as there are languages. Its n-grams are
ranked by the number of documents that have them and the first `profile` of each language are kept; those of a single
document count only where a language has few. Prediction reads whole texts.

Text that is null or has no letter is `und` with score 0. A text of letters of which no n-gram is known gets the most
frequent language and score 0. Ties go to the more frequent language, then by name. Repeated rows get equal answers.
Rows with a null id or language are never learned from. With nothing to learn from, every answer is `und`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skirmish.llm.common import crc_mod5, prepare

SIZES = (3, 4)  # characters in an n-gram
HASHES = 3
MAX_LANGUAGES, WORD = 8192, 64
#: A language with fewer documents keeps the n-grams that only one of them has.
FEW_DOCS = 50
#: Code points handled at once; longer texts go piece by piece.
PIECE = 1 << 20


@cache
def _letters() -> np.ndarray:
    """For each code point of the basic plane its lower-case form, 0 for what is no letter."""
    return np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in range(1 << 16)], np.uint32)


def _codes(joined: str) -> np.ndarray:
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if joined.isascii():
        return _letters()[points]
    return np.where(points < 1 << 16, _letters()[points & 0xFFFF], points)


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, 64-bit hash) of every n-gram of every text. Runs of non-letters are one blank; each text, and each
    piece of a long text, has a blank at both ends."""
    pieces = [(i, t[at : at + PIECE]) for i, t in enumerate(texts) for at in range(0, max(1, len(t)), PIECE)]
    at = 0
    while at < len(pieces):
        to, size = at, 0
        while to < len(pieces) and (to == at or size + len(pieces[to][1]) <= PIECE):
            size += len(pieces[to][1])
            to += 1
        part, at = pieces[at:to], to
        codes = _codes("".join(f" {t} " for _, t in part))
        where = np.repeat(np.arange(len(part), dtype=np.int32), [len(t) + 2 for _, t in part])
        keep = np.empty(len(codes), bool)
        keep[:1] = True
        np.logical_or(codes[1:] != 0, codes[:-1] != 0, out=keep[1:])
        keep[1:] |= where[1:] != where[:-1]
        codes, where = codes[keep].astype(np.uint64), where[keep]
        numbers = np.array([i for i, _ in part], np.int32)
        h = codes
        for n in range(2, max(SIZES) + 1):
            h = h[:-1] * np.uint64(0x100000001B3) + codes[n - 1 :]
            if n in SIZES:
                first = where[: len(h)]
                inside = first == where[n - 1 :]
                mixed = (h[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(32)
                yield numbers[first[inside]], mixed * np.uint64(0xD6E8FEB86659FD93)


@dataclass
class LanguageFilter:
    """slots: a mask of languages for each slot; the n-th language has bit n. Languages beyond a machine word have slots
    of their own in `more`."""

    languages: list[str]
    slots: np.ndarray
    more: LanguageFilter | None = None

    @classmethod
    def build(cls, profiles: dict[str, np.ndarray], order: list[str]) -> LanguageFilter:
        """profiles: n-gram hashes of each language. 32 slots for each n-gram of the largest profile."""
        own, rest = order[:WORD], order[WORD:]
        kind = next(t for t, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64)) if bits >= len(own))
        bits = max(10, int(np.ceil(np.log2(32 * max([1, *[len(profiles[x]) for x in own]])))))
        slots = np.zeros(1 << bits, kind)
        for i, lang in enumerate(own):
            for at in cls._slots_of(profiles[lang], bits):
                slots[at] |= kind(1 << i)
        return cls(order, slots, cls.build(profiles, rest) if rest else None)

    @staticmethod
    def _slots_of(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
        step = (64 - bits) // (HASHES - 1)
        return [((hashes >> np.uint64(64 - bits - step * j)) & np.uint64((1 << bits) - 1)).astype(np.intp) for j in range(HASHES)]

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """The set of languages (of the first word) that contain each n-gram."""
        first, *others = self._slots_of(hashes, int(np.log2(len(self.slots))))
        out = self.slots[first]
        for at in others:
            out &= self.slots[at]
        return out

    @cached_property
    def false(self) -> np.ndarray:
        """For each language of the first word how often a strange n-gram seems to be in it."""
        return np.array([(self.slots & self.slots.dtype.type(1 << i) != 0).mean() for i in range(min(WORD, len(self.languages)))]) ** HASHES

    def _words(self) -> Iterator[LanguageFilter]:
        yield self
        if self.more:
            yield from self.more._words()

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of n-grams of each text, and of those that each language contains, corrected for false positives."""
        words = list(self._words())
        total, hits = np.zeros(len(texts), np.int64), [np.zeros((len(texts), 8 * w.slots.itemsize), np.int64) for w in words]
        bit_table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
        for number, hashes in ngrams(texts):
            total += np.bincount(number, minlength=len(texts))
            for word, hit in zip(words, hits, strict=True):
                known = word.masks(hashes)
                for b in range(word.slots.itemsize):
                    byte = (known >> (8 * b)).astype(np.uint8) if word.slots.itemsize > 1 else known
                    table = np.bincount(number.astype(np.int64) * 256 + byte, minlength=256 * len(texts)).reshape(-1, 256)
                    hit[:, 8 * b : 8 * b + 8] += table @ bit_table
        false = np.concatenate([w.false for w in words])
        found = np.concatenate([h[:, : len(w.false)] for h, w in zip(hits, words, strict=True)], 1)
        return total, np.maximum(0, (found - total[:, None] * false) / (1 - false))

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language of each text, and the share of its count in the two largest; 0 where none counts."""
        if not texts or not self.languages:
            return np.zeros(len(texts), np.int64), np.zeros(len(texts))
        _, counts = self.counts(texts)
        best = counts.argmax(1)
        top = counts[np.arange(len(texts)), best]
        counts[np.arange(len(texts)), best] = 0
        return best, np.divide(top, top + counts.max(1), out=np.zeros(len(texts)), where=top > 0)


def learn(docs: DataFrame, learnable: Column, sample_docs: int = 2000, profile: int = 6000, max_languages: int = MAX_LANGUAGES) -> LanguageFilter:
    """docs: text, lang, doc_id. At most max_languages x `profile` n-grams reach the driver."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).where(learnable & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()}
    if not sizes:
        return LanguageFilter([], np.zeros(1024, np.uint8))
    ticket = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30))
    # First by chance, a quarter more than needed; then exactly.
    chances = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int((1 << 30) * min(1, 1.25 * sample_docs / n)))])
    below = F.coalesce(F.element_at(chances, F.col("lang")), F.lit(0))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("ticket", "doc_id"))
    picked = rows.withColumn("ticket", ticket).where(F.col("ticket") < below)
    picked = picked.withColumn("rank", rank).where(F.col("rank") <= sample_docs).select("lang", "text")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                pairs = [np.zeros((0, 2), np.uint64)]
                for number, h in ngrams([t for t, x in zip(texts, langs, strict=True) if x == lang]):
                    order = np.lexsort((number, h))
                    both = np.stack([h[order], number[order].astype(np.uint64)], 1)
                    pairs.append(both[np.r_[True, (both[1:] != both[:-1]).any(1)]] if len(both) else both)
                grams, n = np.unique(np.concatenate(pairs)[:, 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    totals = picked.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).where((F.col("n") > 1) | F.col("lang").isin([x for x, n in sizes.items() if n < FEW_DOCS]))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = totals.withColumn("place", place).where(F.col("place") <= profile).select("lang", "gram").toArrow()
    by_lang: dict[str, list[int]] = {lang: [] for lang in sizes}
    for lang, gram in zip(kept["lang"].to_pylist(), kept["gram"].to_pylist(), strict=True):
        by_lang[lang].append(gram)
    return LanguageFilter.build({k: np.array(v, np.int64).view(np.uint64) for k, v in by_lang.items()}, list(sizes))


def has_letter(text: str | Column = "text") -> Column:
    return F.coalesce((F.col(text) if isinstance(text, str) else text).rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """doc_id, lang_pred, score for each row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            best, score = known.predict([t or "" for t in batch.column(1).to_pylist()])
            speaks = np.array(batch.column(2).to_pylist(), bool) & bool(known.languages)
            names = [known.languages[i] if s else "und" for i, s in zip(best, speaks, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(np.where(speaks, score, 0.0))], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), has_letter("text").alias("has_letter"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")


def digest(docs: DataFrame) -> DataFrame:
    """Learn from documents outside the held-out fifth, and answer for all."""
    out = identify(docs, learn(docs, crc_mod5() != 0))
    return out.select("doc_id", (crc_mod5() == 0).alias("held_out"), "lang_pred", "score")
