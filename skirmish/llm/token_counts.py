"""Token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes, where a word's last byte is a symbol of its own. Where no edge fits, the state's failure link leads to
the state that remains after the longest matching tokens have been popped off its left end, and carries the number of
tokens popped. A word is thus read once, byte by byte, and its number of greedy longest-match pieces is the sum of the
counts on the way; no piece is built. (Song et al., "Fast WordPiece Tokenization", 2021.)

Words are runs of anything but ASCII white space, with A-Z lower-cased, in UTF-8; any vocabulary serves that knows each
byte alone and at a word's end, as byte-level ones do. Counts of words seen lately are kept in a bounded cache. Null
text is the empty text, with no words and no tokens. Repeated rows and null ids keep a row each; extra columns are
ignored.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.common import prepare
from skirmish.llm.packing import _byte_symbols

LAST = 256  # added to a word's last byte
WORD_END = "</w>"


def vocabulary(path: str) -> set[tuple[int, ...]]:
    """Tokens of a byte-level vocabulary with word ends, as byte values; the last is raised in those that end a word."""
    byte_of = {s: b for b, s in _byte_symbols().items()}
    with open(path) as f:
        names = json.load(f)["model"]["vocab"]
    out = set()
    for name in names:
        core = name.removesuffix(WORD_END)
        if core and all(c in byte_of for c in core):
            *first, last = (byte_of[c] for c in core)
            out.add((*first, last + LAST * (core != name)))
    return out


class LongestMatch:
    """goto maps state * 512 + symbol to a state; fail and popped belong to the failure link of each state."""

    def __init__(self, tokens: set[tuple[int, ...]]) -> None:
        missing = [b for b in range(256) if (b,) not in tokens or (b + LAST,) not in tokens]
        if missing:
            raise ValueError(f"the vocabulary lacks bytes {missing[:5]}")
        self.goto: dict[int, int] = {}
        parents, symbols, final, children = [0], [0], [False], deque()
        for token in sorted(tokens, key=len):
            state = 0
            for symbol in token:
                key = state * 512 + symbol
                if key not in self.goto:
                    self.goto[key] = len(parents)
                    parents.append(state)
                    symbols.append(symbol)
                    final.append(False)
                state = self.goto[key]
            final[state] = True
        self.fail, self.popped = [-1] * len(parents), [0] * len(parents)
        order: dict[int, list[int]] = {}
        for state in range(1, len(parents)):
            order.setdefault(parents[state], []).append(state)
        children.extend(order.get(0, ()))
        while children:  # by depth, so that the links of shorter states are there
            state = children.popleft()
            children.extend(order.get(state, ()))
            if final[state]:
                self.fail[state], self.popped[state] = 0, 1
                continue
            back, count = self.fail[parents[state]], self.popped[parents[state]]
            while back >= 0 and (back * 512 + symbols[state]) not in self.goto:
                count += self.popped[back]
                back = self.fail[back]
            if back >= 0:
                self.fail[state], self.popped[state] = self.goto[back * 512 + symbols[state]], count

    def count(self, word: bytes) -> int:
        """Number of greedy longest-match tokens of a word of at least one byte."""
        goto, fail, popped = self.goto, self.fail, self.popped
        state = total = 0
        for symbol in (*word[:-1], word[-1] + LAST):
            while (step := goto.get(state * 512 + symbol)) is None:
                total += popped[state]
                state = fail[state]
            state = step
        while state:  # what is left after the last byte
            total += popped[state]
            state = fail[state]
        return total


_automata: dict[str, tuple[LongestMatch, dict[bytes, int]]] = {}


def automaton(path: str) -> LongestMatch:
    return LongestMatch(vocabulary(path))


def count_tokens(docs: DataFrame, vocabulary_path: str, cache_limit: int = 400_000) -> DataFrame:
    """doc_id, n_words, n_tokens for each row."""
    prepare(docs.sparkSession)

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary_path not in _automata:
            machine = automaton(vocabulary_path)

            class Cache(dict):
                def __missing__(self, word: bytes) -> int:
                    if len(self) >= cache_limit:
                        self.clear()
                    out = machine.count(word)
                    if len(word) <= 64:
                        self[word] = out
                    return out

            _automata[vocabulary_path] = machine, Cache()
        known = _automata[vocabulary_path][1]
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                split = (text or b"").lower().split()
                words.append(len(split))
                tokens.append(sum(map(known.__getitem__, split)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(counts, "doc_id long, n_words long, n_tokens long")
