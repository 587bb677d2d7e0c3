"""Fill-in-middle transformation by an Aho-Corasick event scan.

One automaton holds the ASCII characters that change a text's class of units (a line break; blanks) and the sentinels. It
passes over a text once and yields events: where such a character or a sentinel stands. What lies between two
events needs no look, as its number of units follows from its length: none or one in a line or a word, as many as code points
where units are characters. The events' running counts of units are all that is kept of a text, and a boundary's place is a rank
lookup in them: the event up to which so many units are complete, and from there by arithmetic.

Units are lines (`[^\\n]*\\n|[^\\n]+`), words (runs of blanks, or of others) or code points, matched left to right; they
cover the text. Two boundaries, drawn from a hash of a seed and the id, cut a text into prefix, middle and suffix at unit
boundaries. Form `psm` is `<P>`prefix`<S>`suffix`<M>`middle, `spm` is `<S>`suffix`<P>`prefix`<M>`middle, `plain` the
text as it is: if it is empty, holds a sentinel, or is not drawn for the transformation. restore() turns an output and its form
back into the text: no sentinel can arise across a seam, as a sentinel has its only `<` in front.

Null text is the empty text; a null doc_id is hashed as no digits. Repeated rows have equal results, texts of
any length are scanned whole, one at a time, and extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.common import prepare

#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
#: The characters at which the class of units changes.
CHANGES = {"line": "\n", "word": "\x20\x09\x0a\x0b\x0c\x0d", "char": ""}
DIGEST = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
TEXTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Units:
    """The units of one text: ends of the stretches that events part, and how many units are complete at each."""

    def __init__(self, kind: str, events: np.ndarray, length: int) -> None:
        self.kind, self.length = kind, length
        if kind == "line":  # a break completes the line that it ends; what follows the last one is a line too
            self.ends = events + 1 if not length or (len(events) and events[-1] == length - 1) else np.append(events + 1, length)
            self.done = np.arange(1, len(self.ends) + 1)
        elif kind == "word":  # a gap and a run of events are one unit each
            edge = np.flatnonzero(np.diff(events) > 1)
            runs = np.stack([events[np.r_[0, edge + 1]], events[np.r_[edge, len(events) - 1]] + 1], 1).ravel() if len(events) else events
            ends = np.append(runs, length)
            self.ends = ends[np.diff(ends, prepend=0) > 0]
            self.done = np.arange(1, len(self.ends) + 1)
        else:  # a gap has as many units as code points
            self.ends = self.done = np.array([length] if length else [], np.int64)

    def __len__(self) -> int:
        return int(self.done[-1]) if len(self.done) else 0

    def place(self, rank: int) -> int:
        """Where the first `rank` units end."""
        if not rank:
            return 0
        at = int(np.searchsorted(self.done, rank))
        # Only a gap of single code points has units to spare behind the one asked for.
        return int(self.ends[at]) - (int(self.done[at]) - rank)


class Scanner:
    def __init__(self, kind: str) -> None:
        self.kind = kind
        self.automaton = ahocorasick.Automaton()
        for c in CHANGES[kind]:
            self.automaton.add_word(c, True)
        for mark in SENTINELS:
            self.automaton.add_word(mark, False)
        self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[Units, bool]:
        """(units, whether the text holds a sentinel)"""
        at, marked = [], False
        for end, change in self.automaton.iter(text):
            if change:
                at.append(end)
            else:
                marked = True
        return Units(self.kind, np.array(at, np.int64), len(text)), marked


@dataclass(frozen=True)
class Infilling:
    """unit: line, word or char; of 100 texts `rate` are transformed, and of 100 such `spm_rate` with the suffix first."""

    unit: str = "line"
    seed: int = 7
    rate: int = 100
    spm_rate: int = 50

    def arrange(self, scanner: Scanner, doc_id: int | None, text: str) -> tuple[int, str, int | None, int | None, str]:
        """(units, form, code points of the prefix, of the middle, output)"""
        units, marked = scanner.scan(text)
        n = len(units)
        drawn = sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h = [int(drawn[i : i + 8], 16) for i in range(0, 32, 8)]
        if not text or marked or h[2] % 100 >= self.rate:
            return n, "plain", None, None, text
        a, b = sorted((units.place(h[0] % (n + 1)), units.place(h[1] % (n + 1))))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h[3] % 100 < self.spm_rate:
            return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that an output was made from."""
    if form == "plain":
        return output
    second = SUFFIX if form == "psm" else PREFIX
    seam = output.index(second)
    middle = output.index(MIDDLE, seam)
    one, two, three = output[len(PREFIX) : seam], output[seam + len(second) : middle], output[middle + len(MIDDLE) :]
    return one + three + two if form == "psm" else two + three + one


def _rows(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _mapped(docs: DataFrame, how: Infilling, schema: str, tail) -> DataFrame:
    """For each row its id, units, form and lengths, and what `tail` makes of (output, form)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(how.unit)
        for batch in batches:
            made = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, form, before, middle, output = how.arrange(scanner, doc_id, text.as_py())
                made.append((doc_id, n, form, before, middle, *tail(output, form)))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = list(zip(*made, strict=True)) or [()] * len(schema.split(", "))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], [c.split()[0] for c in schema.split(", ")])

    return _rows(docs).mapInArrow(run, schema)


def transform(docs: DataFrame, how: Infilling = Infilling()) -> DataFrame:
    """TEXTS: each row's output; rows stay where they are."""
    return _mapped(docs, how, TEXTS, lambda output, form: (output,))


def digest(docs: DataFrame, how: Infilling = Infilling()) -> DataFrame:
    """DIGEST: hashes of the output and of the text rebuilt from it."""
    sha = lambda text: sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    return _mapped(docs, how, DIGEST, lambda output, form: (sha(output), sha(restore(output, form))))
