"""Benchmark decontamination by the q-gram lemma.

Texts are compared in a plain form: lower case, with every run of what is neither letter nor digit as one blank. A region
of w characters of a benchmark item that a document repeats with at most e edits shares at least w + 1 - q (e + 1) of its
q-grams with it, all on diagonals (document position less item position) that differ by at most e. Shared q-grams
are therefore counted in diagonal bands of twice that width which overlap by half; where a band has a window of w item
characters with enough of them, the region is aligned within the band and kept if its edits fit the budget.

Items shorter than w are one region whole, with a budget in proportion; items of fewer than `min_chars` plain characters
say too little and match nothing. Null text has no characters. Repeated rows of documents match alike; repeated
rows of the benchmark are one item, and a null item_id is an item like any other. Extra columns are kept by clean() and
ignored by matches(). An empty benchmark or table gives no matches.

Items often share text: instructions, answer choices, the same passage under many questions. Windows of equal text are
therefore one, held by the first item that has it; consecutive windows that the same items share form a passage, and
passages are what documents are compared with. A match names the passage's first item and how many items share it, and
shared() lists them, so that a document and an instruction in 8,000 items are one row and not 8,000. A passage is left
out for a document that an earlier match has tied to all of its items already: every pair of a document and an item that
a comparison of all windows would find follows from the matches and shared(), and no other pair does.

The benchmark goes to the executors slice by slice, each of at most `slice_chars` characters and one whole item, so
that what is broadcast is bounded; the documents are read once for each slice. Long texts go in pieces of plain characters
that overlap by more than a region can span. Lists of a frequent q-gram are read in blocks of passages, and within a passage that
repeats itself in overlapping tiles of passage and document, as far as no match has settled the passage.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property, partial
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.common import columns_of, cut, prepare

Q, WINDOW, EDITS, MIN_CHARS = 10, 100, 6, 24
#: Characters of benchmark text broadcast at once.
SLICE_CHARS = 4 << 20
#: Code points of documents handled at once.
PIECE = 1 << 20
#: Places of q-grams in items looked at at once.
PLACES = 1 << 19
#: More regions than this of one text are sifted together before they are aligned one by one.
FEW = 64
#: Items that make a passage a common one.
COMMON = 64
#: Failed alignments of one text that are remembered at once.
FAILURES = 1 << 16
FAR = np.uint32(0xFFFFFFFF)  # beyond the text
MATCH = "doc_id long, item_id long, passage long, n_items long, start long, end long, edits long, item_start long, item_chars long"
SHARED = "passage long, item_id long"


@cache
def _plain_points() -> np.ndarray:
    return np.array([ord(chr(c).lower()[0]) if chr(c).isalnum() else 0 for c in range(sys.maxunicode + 1)], np.uint32)


def _points(text: str) -> np.ndarray:
    return _plain_points()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def plain_pieces(text: str, piece: int = PIECE, overlap: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Plain characters, with a blank at both ends of the text, and where in the text each stands. A piece begins with
    the last `overlap` plain characters of the one before."""
    codes, where = np.zeros(1, np.uint32), np.zeros(1, np.int64)
    for at in range(0, max(1, len(text)), piece):
        points = _points(text[at : at + piece])
        keep = np.flatnonzero((points != 0) | (np.r_[codes[-1:], points[:-1]] != 0)) if len(points) else np.zeros(0, np.int64)
        codes, where = np.concatenate([codes, points[keep]]), np.concatenate([where, at + keep])
        last = at + piece >= len(text)
        if last and codes[-1]:
            codes, where = np.append(codes, np.uint32(0)), np.append(where, len(text) - 1)
        if last or len(codes) > 2 * overlap:
            yield codes, where
            codes, where = codes[max(0, len(codes) - overlap) :], where[max(0, len(where) - overlap) :]


def plain(text: str) -> np.ndarray:
    return next(plain_pieces(text, max(1, len(text))))[0]


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 32-bit hash of each q-gram, doubling the length as far as it goes; equal hashes of unequal q-grams only
    make candidates that alignment rejects."""
    factor = 0x01000193
    out, size, base, width = None, 0, codes, 1
    while True:
        if q & width:
            # Behind the `size` characters already hashed come `width` more.
            out = base if out is None else out[: len(codes) - size - width + 1] * np.uint32(pow(factor, width, 1 << 32)) + base[size:]
            size += width
        if size == q:
            return out * np.uint32(0x9E3779B1)
        base = base[:-width] * np.uint32(pow(factor, width, 1 << 32)) + base[width:]
        width *= 2


def windows(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each window of so many characters."""
    with np.errstate(over="ignore"):
        base = (codes.astype(np.uint64) + np.uint64(0x51ED270B)) * np.uint64(0x9E3779B97F4A7C15)
        base ^= base >> np.uint64(29)
        factor, out, size, step = 0xD6E8FEB86659FD93, None, 0, 1
        while True:
            if width & step:
                out = base if out is None else out[: len(codes) - size - step + 1] * np.uint64(pow(factor, step, 1 << 64)) + base[size:]
                size += step
            if size == width:
                return (out ^ (out >> np.uint64(31))) + np.uint64(width)
            base = base[:-step] * np.uint64(pow(factor, step, 1 << 64)) + base[step:]
            step *= 2


@dataclass
class Index:
    """Different q-grams of all passages, sorted, and where the (passage, position) list of each begins; for each passage
    its region, budget and least count."""

    items: list[np.ndarray]
    gram: np.ndarray
    begin: np.ndarray
    item: np.ndarray
    at: np.ndarray
    maybe: np.ndarray
    window: np.ndarray
    edits: np.ndarray
    least: np.ndarray
    q: int

    @classmethod
    def build(cls, items: list[np.ndarray], q: int, window: int, edits: int) -> Index:
        each = [grams(c, q) for c in items]
        gram = np.concatenate([np.zeros(0, np.uint32), *each])
        item = np.repeat(np.arange(len(items)), [len(g) for g in each])
        at = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in each]])
        order = np.argsort(gram, kind="stable")
        bits = min(28, max(12, int(np.ceil(np.log2(16 * max(1, len(gram)))))))
        maybe = np.zeros(1 << bits, bool)
        maybe[gram >> np.uint32(32 - bits)] = True
        w = np.minimum(window, np.array([len(c) for c in items], np.int64))
        e = np.minimum(edits, np.minimum(w * edits // window, (w + 1) // q - 1)).clip(0)
        different, begin = np.unique(gram[order], return_index=True)
        return cls(items, different, np.r_[begin, len(gram)], item[order], at[order], maybe, w, e, w + 1 - q * (e + 1), q)

    @cached_property
    def _order(self) -> np.ndarray:
        """(q-gram, passage) of every place as one sorted number."""
        return np.repeat(np.arange(len(self.gram)), np.diff(self.begin)) * len(self.items) + self.item

    def _places(self, where: np.ndarray, spot: np.ndarray, limit: int, done: Callable[[], np.ndarray | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For the q-grams numbered spot, which stand at `where` in the document: (where, place in their lists), block by block
        of passages; a block has about `limit` places at most. Passages that are done() by then are left out."""
        todo = [(0, len(self.items), self.begin[spot], self.begin[spot + 1])]
        while todo:
            first, last, lo, hi = todo.pop()
            n = hi - lo
            total = int(n.sum())
            if total > limit and last - first > 1:
                middle = (first + last) // 2
                cut = np.clip(np.searchsorted(self._order, spot * len(self.items) + middle), lo, hi)
                todo += [(middle, last, cut, hi), (first, middle, lo, cut)]
            elif total > limit:
                some = np.flatnonzero(n)
                yield from self._tiles(first, where[some], lo[some], hi[some], limit, done)
            elif total:
                yield np.repeat(where, n), np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(total)

    def _tiles(self, item: int, where: np.ndarray, lo: np.ndarray, hi: np.ndarray, limit: int, done: Callable[[], np.ndarray | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for one passage with many places, as a repetitive one has: in tiles of document and passage that overlap
        by more than a region spans, so that every region lies in one. A region has its least count of q-grams at different
        places of the document, too; places without so many around them are left out first."""
        w, e, least = int(self.window[item]), int(self.edits[item]), int(self.least[item])
        wide = w + 2 * e + 2
        ahead = np.searchsorted(where, where + wide) - np.arange(len(where))  # places from here on
        behind = np.zeros(len(where) + 1, np.int64)
        starts = np.flatnonzero(ahead >= least)
        np.add.at(behind, starts, 1)
        np.add.at(behind, starts + ahead[starts], -1)
        keep = behind[:-1].cumsum() > 0
        where, lo, hi = where[keep], lo[keep], hi[keep]
        length = len(self.items[item])
        across = min(length, max(4 * wide, limit // (4 * wide)))
        for a in range(0, max(1, length - wide), max(1, across - wide)):
            left, right = self._within(lo, hi, a), self._within(lo, hi, a + across)
            n = np.cumsum(right - left)
            at = 0
            while at < len(where):
                upto = int(np.searchsorted(n, (n[at - 1] if at else 0) + limit, "right"))
                upto = min(len(where), max(upto, int(np.searchsorted(where, where[at] + 2 * wide))))
                gone = done()
                if gone is not None and gone[item]:
                    return
                m = right[at:upto] - left[at:upto]
                yield np.repeat(where[at:upto], m), np.repeat(left[at:upto] - np.r_[0, np.cumsum(m)[:-1]], m) + np.arange(int(m.sum()))
                if upto == len(where):
                    break
                at = max(at + 1, int(np.searchsorted(where, where[upto] - wide)))

    def _within(self, lo: np.ndarray, hi: np.ndarray, position: int) -> np.ndarray:
        """For lists of places in one passage, the first in each that stands at the position or behind it."""
        out = np.empty(len(lo), np.int64)
        different, back = np.unique(lo, return_inverse=True)
        ends = np.zeros(len(different), np.int64)
        ends[back] = hi
        spots = np.array([x + np.searchsorted(self.at[x:y], position) for x, y in zip(different.tolist(), ends.tolist(), strict=True)], np.int64)
        out[:] = spots[back]
        return out

    def regions(self, codes: np.ndarray, done: Callable[[], np.ndarray | None] = lambda: None, limit: int | None = None) -> Iterator[tuple[int, int, int, int]]:
        """(passage, band, first and last start of a window of the passage) of every region that meets the bound; passages
        that done() marks, asked again before each block, are left out."""
        if len(codes) < self.q or not len(self.gram):
            return
        g = grams(codes, self.q)
        where = np.flatnonzero(self.maybe[g >> np.uint32(32 - int(np.log2(len(self.maybe))))])
        spot = np.minimum(np.searchsorted(self.gram, g[where]), len(self.gram) - 1)
        known = self.gram[spot] == g[where]
        where, spot = where[known], spot[known]
        if not len(where):
            return
        for there, post in self._places(where, spot, limit or PLACES, done):
            gone = done()
            if gone is not None:
                free = ~gone[self.item[post]]
                there, post = there[free], post[free]
            found = self._regions(there, self.item[post], self.at[post])
            yield from found if len(found) <= FEW else self._possible(codes, found)

    def _regions(self, where: np.ndarray, item: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        band = (where - at) // (self.edits[item] + 1)
        item, at, band = np.r_[item, item], np.r_[at, at], np.r_[band, band - 1]
        # Few passages reach their least count at all.
        often = np.bincount(item, minlength=len(self.items)) >= 2 * self.least
        item, at, band = (x[often[item]] for x in (item, at, band))
        order = np.lexsort((at, band, item))
        item, at, band = item[order], at[order], band[order]
        # One count for each q-gram of the passage, however often the band has it.
        single = np.r_[True, (item[1:] != item[:-1]) | (band[1:] != band[:-1]) | (at[1:] != at[:-1])][: len(item)]
        item, at, band = item[single], at[single], band[single]
        last = np.arange(len(item)) + self.least[item] - 1
        ok = last < len(item)
        first, last = np.flatnonzero(ok), last[ok]
        ok = (item[first] == item[last]) & (band[first] == band[last]) & (at[last] - at[first] <= self.window[item[first]] - self.q)
        first, last = first[ok], last[ok]
        low = np.maximum(0, at[last] + self.q - self.window[item[first]])
        high = np.minimum(at[first], np.array([len(self.items[i]) for i in item[first]], np.int64) - self.window[item[first]])
        found: dict[tuple[int, int], list[int]] = {}
        for i, b, x, y in zip(item[first].tolist(), band[first].tolist(), low.tolist(), high.tolist(), strict=True):
            span = found.setdefault((i, b), [x, y])
            span[0], span[1] = min(span[0], x), max(span[1], y)
        return [(i, b, x, y) for (i, b), (x, y) in found.items() if x <= y]

    @cached_property
    def _texts(self) -> tuple[np.ndarray, np.ndarray]:
        """All passages in a row, and where each begins."""
        return np.concatenate(self.items), np.cumsum([0, *map(len, self.items)])

    def _possible(self, codes: np.ndarray, found: list[tuple[int, int, int, int]], rows: int = 8192) -> list[tuple[int, int, int, int]]:
        """Those of many regions that may align: of none of their windows do the two halves, each aligned by itself from
        any diagonal of the band, need more edits than there are. All windows go side by side."""
        text, begin = self._texts
        all_ = np.array(found, np.int64)
        pad = int(self.window.max() + 2 * self.edits.max() + 4)
        padded = np.concatenate([np.full(pad, FAR), codes, np.full(pad, FAR)])
        keep = np.zeros(len(all_), bool)
        kinds = np.stack([self.window[all_[:, 0]], self.edits[all_[:, 0]]], 1)
        for w, e in np.unique(kinds, axis=0).tolist():
            own = np.flatnonzero((kinds == [w, e]).all(1))
            size = all_[own, 3] - all_[own, 2] + 1
            ends = np.cumsum(size)
            for at in range(0, int(ends[-1]), rows):
                number = np.arange(at, min(at + rows, int(ends[-1])))
                region = np.searchsorted(ends, number, "right")
                item, band, first, _ = all_[own[region]].T
                start = first + number - (ends - size)[region]
                base = (start + band * (e + 1) + pad)[:, None] + np.arange(2 * (e + 1))
                spent = np.zeros(len(number), np.int16)
                for half in (range(w // 2, w), range(w // 2)):
                    left = np.flatnonzero(spent <= e)
                    spent[left] += self._least(padded, base[left], text, begin[item[left]] + start[left], half, e)
                keep[own[region[spent <= e]]] = True
        return [r for r, k in zip(found, keep.tolist(), strict=True) if k]

    @staticmethod
    def _least(padded: np.ndarray, base: np.ndarray, text: np.ndarray, start: np.ndarray, half: range, most: int) -> np.ndarray:
        """Least edits of part of each window, from any diagonal to any; above `most` not exact."""
        out, live = np.zeros(len(base), np.int16), np.arange(len(base))
        cost, steps = np.zeros(base.shape, np.int16), np.arange(base.shape[1], dtype=np.int16)
        for n, i in enumerate(half, 1):
            there = padded[np.clip(base[live] + i, 0, len(padded) - 1)]
            match = cost + (there != text[start[live] + i][:, None])
            match[:, :-1] = np.minimum(match[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(match - steps, 1) + steps
            if n % 8 == 0 or n == len(half):
                out[live] = cost.min(1)
                some = out[live] <= most
                live, cost = live[some], cost[some]
        return out

    def said(self, codes: np.ndarray, item: int, band: int, first: int, last: int) -> bytes:
        """A digest of all that align() looks at, but for where in the text it stands."""
        w, e = int(self.window[item]), int(self.edits[item])
        low, high = first + band * (e + 1), last + w + (band + 2) * (e + 1)
        ends = np.array([item, first, last, min(low, 0), min(0, len(codes) - high)], np.int64)
        return xxhash.xxh3_128_digest(ends.tobytes() + codes[max(0, low) : high].tobytes())

    def align(self, codes: np.ndarray, item: int, band: int, first: int, last: int) -> tuple[int, int, int, int] | None:
        """(edits, document start, document end, start in the passage) of a window of it that fits its edits within the band.

        Alignments of substitutions alone are counted first, on every diagonal; then, if none fits, all windows are
        aligned side by side."""
        w, e = int(self.window[item]), int(self.edits[item])
        starts = np.arange(first, last + 1)
        offset = band * (e + 1) + np.arange(2 * (e + 1))
        padded = np.concatenate([np.full(w + 2 * e + 4, FAR), codes, np.full(w + 2 * e + 4, FAR)])
        base = starts[:, None] + offset[None, :] + w + 2 * e + 4
        span = self.items[item][first : last + w]
        apart = np.cumsum(padded[np.clip(base[0][:, None] + np.arange(len(span)), 0, len(padded) - 1)] != span, 1)
        apart = np.concatenate([np.zeros((len(offset), 1), np.int64), apart], 1)
        direct = apart[:, w:] - apart[:, : apart.shape[1] - w]
        c, r = np.unravel_index(direct.argmin(), direct.shape)
        if direct[c, r] <= e:
            from_ = int(starts[r] + offset[c])
            return int(direct[c, r]), max(0, from_), min(len(codes), from_ + w), int(starts[r])
        steps = np.arange(2 * (e + 1))
        cost, begin = np.zeros(base.shape, np.int64), base.copy()
        for i in range(w):
            there = padded[np.clip(base + i, 0, len(padded) - 1)]
            match = cost + (there != self.items[item][starts + i][:, None])
            skip = np.concatenate([cost[:, 1:] + 1, np.full((len(starts), 1), w)], 1)
            begin = np.where(skip < match, np.concatenate([begin[:, 1:], begin[:, -1:]], 1), begin)
            cost = np.minimum(match, skip)
            # A character of the document too many moves one diagonal up for one edit.
            run = cost - steps
            least = np.minimum.accumulate(run, 1)
            source = np.maximum.accumulate(np.where(run == least, steps, 0), 1)
            begin, cost = np.take_along_axis(begin, source, 1), least + steps
        r, c = np.unravel_index(cost.argmin(), cost.shape)
        if cost[r, c] > e:
            return None
        pad = w + 2 * e + 4
        to = min(len(codes), int(base[r, c]) + w - pad)
        return int(cost[r, c]), max(0, int(begin[r, c]) - pad), max(1, to), int(starts[r])


class Passages:
    """The passages of a benchmark slice: those that many items share, those that several do, and those of one item."""

    def __init__(self, rows: list[tuple[int | None, str]], q: int, window: int, edits: int, min_chars: int) -> None:
        held = [(i, c) for i, t in rows if len(c := plain(t)) - 2 >= max(q, min_chars)]
        self.ids = [i for i, _ in held]
        texts = [c for _, c in held]
        width = [min(window, len(c)) for c in texts]
        each = [windows(c, w) for c, w in zip(texts, width, strict=True)]
        n = np.array([len(h) for h in each], np.int64)
        h, item = np.concatenate([np.zeros(0, np.uint64), *each]), np.repeat(np.arange(len(texts)), n)
        order = np.argsort(h, kind="stable")  # of equal windows the first item's comes first
        h, item = h[order], item[order]
        new = np.r_[True, h[1:] != h[:-1]][: len(h)]
        group, lead = np.cumsum(new) - 1, np.flatnonzero(new)
        once = new | np.r_[True, item[1:] != item[:-1]][: len(h)]  # an item may hold a window twice
        with np.errstate(over="ignore"):
            mixed = (item.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            # The sum of its items' marks tells which items share a window.
            sums = np.add.reduceat(np.where(once, mixed, np.uint64(0)), lead) if len(lead) else mixed
        ends = np.r_[lead[1:], len(h)]
        # Leading windows in the order of items and positions; a run that the same items share is a passage.
        place = order[lead]
        back = np.argsort(place)
        place, lead, ends, sums = place[back], lead[back], ends[back], sums[back]
        owner = np.searchsorted(np.cumsum(n), place, "right")
        fresh = np.r_[True, (np.diff(place) != 1) | (owner[1:] != owner[:-1]) | (sums[1:] != sums[:-1])][: len(place)]
        first = np.flatnonzero(fresh)
        last = np.r_[first[1:], len(place)][: len(first)] - 1
        start = place - (np.cumsum(n) - n)[owner] if len(place) else place
        passages = []
        for f, t in zip(first.tolist(), last.tolist(), strict=True):
            i = int(owner[f])
            members = item[lead[f] : ends[f]][once[lead[f] : ends[f]]]
            name = int((h[lead[f]] ^ np.uint64(t - f)).view(np.int64))
            passages.append((i, int(start[f]), members.astype(np.int32), name, texts[i][start[f] : start[t] + width[i]]))
        # Keys of equal size stay in the order of items.
        passages.sort(key=lambda p: -len(p[2]))
        # By number of items, as what many share ties up most of what others would be asked for.
        cuts = [0, sum(len(p[2]) >= COMMON for p in passages), sum(len(p[2]) > 1 for p in passages), len(passages)]
        parts = [passages[a:b] for a, b in pairwise(cuts)]
        self.indexes = [Index.build([p[-1] for p in part], q, window, edits) for part in parts]
        self.parts = [[p[:-1] for p in part] for part in parts]
        self.members = [np.concatenate([np.zeros(0, np.int32), *[p[2] for p in part]]) for part in parts]
        self.begin = [np.cumsum([0, *[len(p[2]) for p in part]])[:-1] for part in parts]
        self.overlap = 2 * (window + edits + q)

    def matches(self, text: str, piece: int = PIECE) -> list[tuple[int | None, int, int, int, int, int, int, int]]:
        """(item id, passage, number of items, start, end, edits, item start, characters) of each passage of which the text
        repeats a region, the first found; positions in code points. A passage whose items are all known stays out."""
        out: list[tuple] = []
        known: np.ndarray | None = None
        asked: dict[int, tuple[int, np.ndarray]] = {}
        failed: set[tuple[int, bytes]] = set()  # a text that repeats itself asks the same again and again

        def done(k: int) -> np.ndarray | None:
            """Which passages of a part have all their items known; found anew after a match only."""
            if known is None or not self.parts[k]:
                return None
            if k not in asked or asked[k][0] != len(out):
                asked[k] = len(out), np.logical_and.reduceat(known[self.members[k]], self.begin[k])
            return asked[k][1]

        for codes, where in plain_pieces(text, piece, self.overlap):
            for k, (part, index) in enumerate(zip(self.parts, self.indexes, strict=True)):
                for no, band, first, last in index.regions(codes, partial(done, k)):
                    item, at, members, name = part[no]
                    if known is not None and known[members].all():
                        continue
                    said = index.said(codes, no, band, first, last)
                    if (k, said) in failed or not (found := index.align(codes, no, band, first, last)):
                        if len(failed) >= FAILURES:
                            failed.clear()
                        failed.add((k, said))
                        continue
                    if known is None:
                        known = np.zeros(len(self.ids), bool)
                    known[members] = True
                    edits, start, end, spot = found
                    out.append((self.ids[item], name, len(members), int(where[start]), int(where[end - 1]) + 1, edits, at + spot, int(index.window[no])))
        return out

    def shared(self) -> Iterator[tuple[int, int | None]]:
        """(passage, item id) of all passages of several items."""
        for _, _, members, name in chain(*self.parts[:-1]):
            yield from ((name, self.ids[m]) for m in members.tolist())


def slices(benchmark: DataFrame, slice_chars: int) -> list[DataFrame]:
    """The benchmark without repeated rows, in parts of about slice_chars characters dealt by a hash of the text."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // slice_chars)
    return [items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i) for i in range(n)]


def _passages(benchmark: DataFrame, q: int, window: int, edits: int, min_chars: int, slice_chars: int) -> Iterator[Passages]:
    for part in slices(benchmark, slice_chars):
        held = part.toArrow()
        rows = zip(held["item_id"].to_pylist(), held["text"].to_pylist(), strict=True)
        yield Passages(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])), q, window, edits, min_chars)


def matches(docs: DataFrame, benchmark: DataFrame, q: int = Q, window: int = WINDOW, edits: int = EDITS, min_chars: int = MIN_CHARS, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """A row for each document and passage of which it repeats a region: MATCH. item_id is the first item that has the
    passage (its number tells equal texts), n_items the number of those that share it; item_start lies in that first item."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    out = spark.createDataFrame([], MATCH)
    for passages in _passages(benchmark, q, window, edits, min_chars, slice_chars):
        if not passages.ids:
            continue
        # The driver keeps no slice once it is sent.
        sent = spark.sparkContext.broadcast(passages)

        def find(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = sent.value
            for batch in batches:
                made = [(doc, *found) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for found in known.matches(text)]
                columns = list(zip(*made, strict=True)) if made else [[]] * 9
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in MATCH.split(", ")])

        out = out.unionAll(rows.mapInArrow(find, MATCH))
    return out


def shared(benchmark: DataFrame, q: int = Q, window: int = WINDOW, edits: int = EDITS, min_chars: int = MIN_CHARS, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """SHARED: the items of each passage that several have, by the passage's number in the matches. Written slice by
    slice, as the driver holds one slice at a time."""
    spark = benchmark.sparkSession
    out = spark.createDataFrame([], SHARED)
    for passages in _passages(benchmark, q, window, edits, min_chars, slice_chars):
        out = out.unionAll(cut(spark.createDataFrame(pd.DataFrame(passages.shared(), columns=["passage", "item_id"], dtype=object), SHARED)))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, **parameters: int) -> DataFrame:
    """The rows of docs that repeat no region of the benchmark. Rows without an id are matched by their text alone."""
    found = cut(matches(docs.where("doc_id is not null"), benchmark, **parameters).select("doc_id").distinct())
    named = docs.where("doc_id is not null").join(found, "doc_id", "left_anti").select(*columns_of(docs))
    # All columns travel as one, so that none can clash with the text's hash.
    unnamed = docs.where("doc_id is null").select(F.struct(*columns_of(docs)).alias("row"), "text").select("row", F.xxhash64("text").alias("hash"), "text")
    bad = matches(unnamed.select(F.col("hash").alias("doc_id"), "text"), benchmark, **parameters).select(F.col("doc_id").alias("hash")).distinct()
    return named.unionAll(unnamed.join(bad, "hash", "left_anti").select("row.*"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id and where: in the document by code points, in the item by plain characters."""
    return matches(docs, benchmark).select("doc_id", "item_id", "passage", "n_items", "start", "end", "edits", "item_start", "item_chars")
