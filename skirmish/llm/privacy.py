"""Personal data: wide generators propose overlapping spans, boosted trees judge them, calibrated thresholds select.

Base spans follow fixed rules (email, ip, card, phone; leftmost, non-overlapping per kind, matches that fail their test are
dropped) and always stay. Generators propose many more: runs of numbers in every grouping of a few neighbours, with other
parts between the digits than the rules allow, numbers without a plus sign, addresses written with (at) and [dot]. Each
candidate has features of its format and of its context. Trees, trained here by gradient boosting on histograms,
learn what base spans look like to features that don't show the sign that made them base ones (the plus, the @, the kind of
parts): candidates of a kind that look the same are the ones to add.

Labels are the rules' own: base spans are positive, everything else that was proposed counts as negative, so estimates of
precision are low rather than high. Training is bounded: `per_label` candidates of each kind and label at most, drawn by a
hash of id and place, of which every fourth is left out; half of them give the odds of context words, the other half trains
the trees. A kind's threshold is then set on all candidates of the corpus that weren't trained on: the lowest score from
which on the share of base spans is at least `least_precision`; a kind with fewer than `least_of_kind` base spans among them adds
nothing. What the rules' own patterns match but their tests reject (a failed check digit) is never added. Of overlapping
selected candidates the best score stays (ties: the longer, the earlier, the kind as listed), none overlaps a base span.

A text is scanned whole, in time that grows with its length whatever it holds; what is written down are its candidates, some 60
bytes each, with no text. Null text is the empty text and has no spans. Repeated rows have equal results, a null doc_id keeps
its row, extra columns are ignored, an empty table gives no rows. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.common import cut, prepare

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
PER_LABEL, LEAST_PRECISION, LEAST_OF_KIND = 4000, 0.95, 50
ROUNDS, DEPTH, RATE, L2 = 60, 4, 0.2, 1.0
#: Tokens of a run of numbers that a candidate takes at most.
NEIGHBOURS = 4
WORD_BITS, BINS = 12, 1000
BASE, REJECTED, PROPOSED = 1, 0, -1
FORMAT = ["digits", "letters", "parts", "groups", "first", "last", "longest", "shortest", "signs", "brackets", "blanks", "dots", "dashes", "different", "repeats", "lead", "check", "small", "before", "after", "digits_before", "digits_after"]
RECORD = np.dtype([("kind", "u1"), ("label", "i1"), ("start", "<i8"), ("end", "<i8"), ("format", "u1", len(FORMAT)), ("words", "<u2", 5)])

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-][A-Za-z0-9.-]*")
_DOTTED = re.compile(r"[0-9][0-9.]{6,}")
_SPACED = re.compile(r"[0-9][0-9\x20-]{13,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBERS = re.compile(r"\(?[0-9][0-9\x20()./_-]{5,}[0-9]")
_AT = re.compile(r"\x20?[\[({]\x20?at\x20?[\])}]\x20?", re.I)
_DOT = re.compile(r"\x20?[\[({]\x20?(?:dot|\.)\x20?[\])}]\x20?", re.I)
_HOST = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({]\x20?(?:dot|\.)\x20?[\])}]\x20?)[A-Za-z0-9-]{1,63}){1,8}", re.I)
_PARTED_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\x20?[\[({]?\x20?(?:dot|\.)\x20?[\])}]?\x20?[0-9]{1,3}){3}(?![0-9])", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_ANY = re.compile(r"[0-9@]|[\[({]\x20?[aA][tT]\x20?[\])}]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """For every @, the run before it and the labels behind it; each character is looked at once for either."""
    last, p = 0, text.find("@")
    while p >= 0:
        start = p
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < p and (run := _DOMAIN.match(text, p + 1)):
            labels = run[0].split("..", 1)[0].rstrip(".")
            if "." in labels:
                last = p + 1 + len(labels)
                yield start, last
        p = text.find("@", max(p + 1, last))


def _quads(text: str) -> Iterator[tuple[int, int, bool]]:
    """Four numbers each from left to right in every run of dotted numbers, and whether all are at most 255."""
    for run in _DOTTED.finditer(text):
        at = run.start()
        for dotted in run[0].split(".."):
            parts = dotted.strip(".").split(".")
            here = at + len(dotted) - len(dotted.lstrip("."))
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                end = here + sum(map(len, four)) + 3
                yield here, end, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four)
                here = end + 1
            at += len(dotted) + 2


def _cards(text: str) -> Iterator[tuple[int, int, bool]]:
    """Digits with at most one blank or dash between any two, 14 to 19 of them, and whether the check digit is right."""
    for run in _SPACED.finditer(text):
        at = run.start()
        edges = [(at, at), *((m.start() + at, m.end() + at) for m in re.finditer(r"[\x20-]{2,}", run[0])), (run.end(), run.end())]
        for (_, begin), (end, _) in zip(edges, edges[1:], strict=False):
            while end > begin and text[end - 1] in "\x20-":
                end -= 1
            if 14 <= end - begin <= 37 and 14 <= len(digits := digits_of(text[begin:end])) <= 19:
                yield begin, end, luhn(digits)


def base_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, whether it passes) of what the rules' patterns match; of addresses all that match pass, and
    matches of other lengths than a card's or phone's are left out."""
    yield from ((EMAIL, a, b, True) for a, b in _emails(text))
    yield from ((IP, *q) for q in _quads(text))
    yield from ((CARD, *c) for c in _cards(text))
    for m in _PHONE.finditer(text):
        n = sum(map(m[0].count, "0123456789"))
        yield PHONE, m.start(), m.end(), 10 <= n <= 15


def _wide(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of everything that might be personal data beside the base spans; overlapping."""
    for run in _NUMBERS.finditer(text):
        tokens = [(m.start() + run.start(), m.end() + run.start(), sum(map(m[0].count, "0123456789"))) for m in re.finditer(r"[^\x20]+", run[0])]
        for i, (begin, _, _) in enumerate(tokens):
            n = 0
            for _, end, more in tokens[i : i + NEIGHBOURS]:
                n += more
                if n > 19:
                    break
                a, b = begin, end
                while a < b and text[a] in "./_-)":
                    a += 1
                while b > a and text[b - 1] in "./_-(":
                    b -= 1
                if 7 <= n <= 15:
                    yield PHONE, a, b
                if 12 <= n:
                    yield CARD, a, b
    for m in _AT.finditer(text):
        start = m.start()
        while start > 0 and m.start() - start < 64 and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start() and (host := _HOST.match(text, m.end())):
            yield EMAIL, start, host.end()
    if _DOT.search(text):
        for m in _PARTED_IP.finditer(text):
            if _DOT.search(m[0]):
                yield IP, m.start(), m.end()


def _side(text: str, at: int) -> int:
    """The class of the character at a place."""
    if not 0 <= at < len(text):
        return 0
    c = text[at]
    return 1 if c == "\n" else 2 if c.isspace() else 3 if c.isalpha() else 4 if c.isdigit() else 5 if c in "([{<\"'" else 6


def _hashed(word: str) -> int:
    return 1 + xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass")) % ((1 << WORD_BITS) - 1)


def features(text: str, kind: int, start: int, end: int) -> tuple[list[int], list[int]]:
    """(format features, hashes of three words before and two behind). The plus, the @ and the signs between parts
    that make a base span are written alike for all candidates of the kind."""
    core = text[start : min(end, start + 400)].lstrip("+")
    if kind == EMAIL:
        core = _DOT.sub(".", _AT.sub("@", core, count=1))
    elif kind == IP:
        core = re.sub(r"[^0-9]+", ".", core)
    groups = [len(g) for g in re.findall(r"[0-9]+|[^\W\d_]+", core)] or [0]
    digits = digits_of(core)
    signs = [c for c in core if not c.isalnum()]
    longest, run = 1, 1
    for a, b in zip(digits, digits[1:], strict=False):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    before, after = text[max(0, start - 64) : start], text[end : end + 64]
    numbers = [int(g) for g in re.findall(r"[0-9]+", core[:60])] if kind == IP else []
    out = [
        len(digits), sum(map(str.isalpha, core)), len(signs), len(groups), groups[0], groups[-1], max(groups), min(groups), len(set(signs)) if kind != CARD else 0,
        "(" in core, core.count(" ") if kind != CARD else 0, core.count(".") if kind != CARD else 0, core.count("-") if kind != CARD else 0,
        len(set(digits)), longest, ord(digits[0]) - 47 if digits else 0,
        kind == CARD and luhn(digits), kind == IP and all(n <= 255 for n in numbers),
        _side(text, start - 1 - (start > 0 and text[start - 1] == "+")), _side(text, end), sum(map(str.isdigit, before[-24:])), sum(map(str.isdigit, after[:24])),
    ]
    words = [*map(_hashed, _WORD.findall(before)[-3:]), 0, 0, 0][:3] + [*map(_hashed, _WORD.findall(after)[:2]), 0, 0][:2]
    return [min(255, int(v)) for v in out], words


def candidates(text: str) -> np.ndarray:
    """RECORDs of one text, by start and kind. Proposals that touch a base span are left out."""
    if not _ANY.search(text):
        return np.zeros(0, RECORD)
    matched = list(base_matches(text))
    kept = sorted((a, b) for _, a, b, ok in matched if ok)
    # Base spans of several kinds may overlap; the furthest end so far is what a later one must lie behind.
    starts, reach, far = [a for a, _ in kept], [], 0
    for _, b in kept:
        far = max(far, b)
        reach.append(far)
    rejected = {(k, a, b) for k, a, b, ok in matched if not ok}
    found = [(k, a, b, BASE if ok else REJECTED) for k, a, b, ok in matched]
    seen = set()
    for k, a, b in _wide(text):
        i = bisect_left(starts, b)  # base spans that begin before its end
        if (k, a, b) in rejected or (k, a, b) in seen or (i and reach[i - 1] > a):
            continue
        seen.add((k, a, b))
        found.append((k, a, b, PROPOSED))
    found.sort(key=lambda f: (f[1], f[0], f[2]))
    out = np.zeros(len(found), RECORD)
    for r, (k, a, b, label) in enumerate(found):
        out[r] = (k, label, a, b, *features(text, k, a, b))
    return out


# ---- boosted trees


@dataclass
class Trees:
    """Gradient boosting of log loss over bytes: every tree is complete, a node's left side holds values up to its cut."""

    prior: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.prior), np.arange(len(x))
        for feature, edge, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > edge[node])
            out += leaf[node - len(feature)]
        return out

    @classmethod
    def train(cls, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE, l2: float = L2) -> Trees:
        n, f = x.shape
        share = min(max(y.mean(), 1e-6), 1 - 1e-6)
        out = cls(float(np.log(share / (1 - share))))
        logit, inner = np.full(n, out.prior), (1 << depth) - 1
        spots = np.arange(f) * 256 + x
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-logit))
            g, h = p - y, p * (1 - p)
            feature, edge, node = np.zeros(inner, np.int64), np.full(inner, 255, np.int64), np.zeros(n, np.int64)
            for level in range(depth):
                first = (1 << level) - 1
                place = ((node - first)[:, None] * (f * 256) + spots).ravel()
                sums = [np.bincount(place, np.repeat(v, f), (1 << level) * f * 256).reshape(-1, f, 256) for v in (g, h)]
                left_g, left_h = (s.cumsum(2) for s in sums)
                all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
                gain = left_g**2 / (left_h + l2) + (all_g - left_g) ** 2 / (all_h - left_h + l2) - all_g**2 / (all_h + l2)
                gain[(left_h < 1e-3) | (all_h - left_h < 1e-3)] = 0
                best = gain.reshape(len(gain), -1).argmax(1)
                good = gain.reshape(len(gain), -1)[np.arange(len(gain)), best] > 1e-9
                feature[first : first + len(gain)] = np.where(good, best // 256, 0)
                edge[first : first + len(gain)] = np.where(good, best % 256, 255)
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > edge[node])
            spot = node - inner
            leaf = -rate * np.bincount(spot, g, inner + 1) / (np.bincount(spot, h, inner + 1) + l2)
            logit += leaf[spot]
            out.feature.append(feature)
            out.cut.append(edge)
            out.leaf.append(leaf)
        return out


@dataclass
class Model:
    """Of fixed size: a table of word odds and trees a kind, and a threshold for kinds that may add spans."""

    odds: np.ndarray  # (kinds, words before and behind, hashes)
    trees: dict[int, Trees]
    thresholds: dict[int, float]

    def inputs(self, records: np.ndarray) -> np.ndarray:
        """Format features and the words' odds as bytes."""
        words, kind = records["words"].astype(np.int64), records["kind"].astype(np.int64)
        odds = self.odds[kind[:, None], (np.arange(5) >= 3).astype(int), words]
        odds = np.stack([odds[:, :3].sum(1), odds[:, 3:].sum(1)], 1)
        return np.concatenate([records["format"], np.clip(np.rint(128 + 16 * odds), 0, 255).astype(np.uint8)], 1)

    def scores(self, records: np.ndarray) -> np.ndarray:
        out = np.zeros(len(records))
        for kind, trees in self.trees.items():
            own = records["kind"] == kind
            out[own] = 1 / (1 + np.exp(-trees.logits(self.inputs(records[own]))))
        return out

    def select(self, records: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Base spans of a text and the proposals chosen, by start and kind."""
        base, limit = records["label"] == BASE, np.full(len(KINDS), np.inf)
        for kind, threshold in self.thresholds.items():
            limit[kind] = threshold
        wanted = np.flatnonzero((records["label"] == PROPOSED) & (scores >= limit[records["kind"]]))
        if not len(wanted):
            return records[base]
        rank = np.lexsort((records["kind"][wanted], records["start"][wanted], records["start"][wanted] - records["end"][wanted], -scores[wanted]))
        starts, ends, taken = [], [], []
        for r in wanted[rank].tolist():
            a, b = int(records["start"][r]), int(records["end"][r])
            i = bisect_left(starts, a)
            if (i and ends[i - 1] > a) or (i < len(starts) and starts[i] < b):
                continue
            starts.insert(i, a)
            ends.insert(i, b)
            taken.append(r)
        return records[np.sort(np.r_[np.flatnonzero(base), np.array(taken, np.int64)])]


def _tickets(doc_id: np.ndarray, records: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for each candidate that depends on the id and the place."""
    with np.errstate(over="ignore"):
        x = records["start"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (doc_id * np.uint64(4) + records["kind"].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and its candidates as bytes, written down: the texts are read once."""
    prepare(docs.sparkSession)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [candidates(t.as_py() or "").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.binary())], ["doc_id", "found"])

    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(find, "doc_id long, found binary"))


def _held(batch: pa.RecordBatch) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """The ids of a batch of scan(), all its candidates in a row, and where each id's end."""
    found = [v.as_buffer() for v in batch.column(1)]
    ends = np.cumsum([len(v) // RECORD.itemsize for v in found], dtype=np.int64)
    return batch.column(0).to_pylist(), np.frombuffer(b"".join(found), RECORD), ends


def _each(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates, and the tickets, of each batch that has any."""
    for batch in batches:
        ids, records, ends = _held(batch)
        if len(records):
            numbers = np.array([(i or 0) & 0xFFFFFFFFFFFFFFFF for i in ids], np.uint64)
            yield records, _tickets(np.repeat(numbers, np.diff(ends, prepend=0)), records)


def _trained(records: np.ndarray, tickets: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Which candidates are for training: by the rate of their kind and label, three in four of them."""
    return (tickets < rates[records["kind"], (records["label"] == BASE).astype(int)]) & (tickets * 2**40 % 4 >= 1)


def learn(sample: np.ndarray, half: np.ndarray) -> Model:
    """Word odds from one half of the sample, trees from the other."""
    y = sample["label"] == BASE
    odds = np.zeros((len(KINDS), 2, 1 << WORD_BITS))
    for kind in range(len(KINDS)):
        own = (sample["kind"] == kind) & half
        for side, columns in enumerate((slice(0, 3), slice(3, 5))):
            with_, without = (np.bincount(sample["words"][own & c][:, columns].ravel(), minlength=1 << WORD_BITS) for c in (y, ~y))
            odds[kind, side] = np.log((with_ + 0.5) / (with_.sum() + 0.5 * len(with_))) - np.log((without + 0.5) / (without.sum() + 0.5 * len(with_)))
    odds[:, :, 0] = 0
    model = Model(odds, {}, {})
    for kind in range(len(KINDS)):
        own = (sample["kind"] == kind) & ~half
        if 0 < y[own].sum() < own.sum():
            model.trees[kind] = Trees.train(model.inputs(sample[own]), y[own].astype(float))
    return model


def calibrated(base: np.ndarray, others: np.ndarray, least_precision: float) -> float | None:
    """The lowest score of a base span, from counts by bins of it, from which on they are the share least_precision."""
    above, beside = base[::-1].cumsum()[::-1], others[::-1].cumsum()[::-1]
    good = np.flatnonzero((base > 0) & (above >= least_precision * (above + beside)))
    return None if not len(good) else float(good[0] / BINS)


def fit(found: DataFrame, per_label: int = PER_LABEL, least_precision: float = LEAST_PRECISION, least_of_kind: int = LEAST_OF_KIND) -> Model:
    """From scan(): sizes, a bounded sample, and histograms of scores reach the driver."""

    def sizes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(KINDS), 2), np.int64)
        for records, _ in _each(batches):
            np.add.at(n, (records["kind"], (records["label"] == BASE).astype(int)), 1)
        kind, label = np.indices(n.shape).reshape(2, -1)
        yield pa.RecordBatch.from_pydict({"kind": kind, "label": label, "n": n.ravel()})

    n = np.zeros((len(KINDS), 2))
    for r in found.mapInArrow(sizes, "kind long, label long, n long").groupBy("kind", "label").agg(F.sum("n").alias("n")).collect():
        n[r["kind"], r["label"]] = r["n"]
    rates = np.minimum(1, per_label / np.maximum(n, 1))

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for records, tickets in _each(batches):
            own = _trained(records, tickets, rates)
            if own.any():
                yield pa.RecordBatch.from_pydict({"records": pa.array([records[own].tobytes()], pa.binary()), "half": pa.array([(tickets[own] * 2**44 % 2 < 1).tobytes()], pa.binary())})

    drawn = sorted(map(tuple, found.mapInArrow(draw, "records binary, half binary").toLocalIterator()))
    sample = np.frombuffer(b"".join(bytes(r) for r, _ in drawn), RECORD)
    model = learn(sample, np.frombuffer(b"".join(bytes(h) for _, h in drawn), bool))
    if not model.trees:
        return model
    spark = found.sparkSession
    sent = spark.sparkContext.broadcast(model)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(KINDS), 2, BINS + 1), np.int64)
        for records, tickets in _each(batches):
            records = records[~_trained(records, tickets, rates)]
            if len(records):
                np.add.at(seen, (records["kind"], (records["label"] == BASE).astype(int), (sent.value.scores(records) * BINS).astype(int)), 1)
        kind, label, place = np.nonzero(seen)
        yield pa.RecordBatch.from_pydict({"kind": kind, "label": label, "bin": place, "n": seen[kind, label, place]})

    counts = np.zeros((len(KINDS), 2, BINS + 1), np.int64)
    for r in found.mapInArrow(count, "kind long, label long, bin long, n long").groupBy("kind", "label", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r["kind"], r["label"], r["bin"]] = r["n"]
    for kind in model.trees:
        if counts[kind, 1].sum() >= least_of_kind and (threshold := calibrated(counts[kind, 1], counts[kind, 0], least_precision)) is not None:
            model.thresholds[kind] = threshold
    return model


def _said(records: np.ndarray) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in zip(records["kind"].tolist(), records["start"].tolist(), records["end"].tolist(), strict=True))


def find(docs: DataFrame, **parameters: float) -> DataFrame:
    """A row for each row of docs: numbers of base spans, their digest, all spans, and how many the model added."""
    found = scan(docs)
    sent = docs.sparkSession.sparkContext.broadcast(fit(found, **parameters))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids, all_records, ends = _held(batch)
            scores, begin = sent.value.scores(all_records), 0
            for doc_id, end in zip(ids, ends.tolist(), strict=True):
                spans, begin = sent.value.select(all_records[begin:end], scores[begin:end]), end
                base = spans[spans["label"] == BASE]
                n = np.bincount(base["kind"], minlength=len(KINDS)).tolist()
                rows.append((doc_id, *n, sha256(_said(base).encode()).hexdigest(), _said(spans), len(spans) - len(base)))
            names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return found.mapInArrow(judge, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long")


def redacted(text: str, spans: np.ndarray) -> str:
    """The text with each span as its kind in brackets; of overlapping base spans the first one's kind covers all."""
    out, at, end = [], 0, 0
    for kind, a, b in zip(spans["kind"].tolist(), spans["start"].tolist(), spans["end"].tolist(), strict=True):
        if a >= end:
            out += [text[at:a], f"[{KINDS[kind]}]"]
        end = at = max(end, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the text without the spans that the model selects; null text stays null. Rows stay where they are."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def without(text: str) -> str:
        records = candidates(text)
        return redacted(text, sent.value.select(records, sent.value.scores(records))) if len(records) else text

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t and without(t) for t in (v.as_py() for v in batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rewrite, "doc_id long, text string")
