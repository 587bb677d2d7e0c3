import random

import public_tokenizers
from helpers import clashing, empty, odd_documents

from skirmish.llm.token_counts import LAST, LongestMatch, count_tokens, vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENS = vocabulary(PATH)


def greedy(word, tokens):
    symbols, at, n = (*word[:-1], word[-1] + LAST), 0, 0
    while at < len(symbols):
        at = max(to for to in range(at + 1, min(len(symbols), at + 64) + 1) if symbols[at:to] in tokens)
        n += 1
    return n


def test_automaton_is_greedy():
    machine, rng = LongestMatch(TOKENS), random.Random(3)
    names = [bytes(x % 256 for x in t) for t in rng.sample(sorted(TOKENS), 2000)]
    for i in range(3000):
        word = b"".join(rng.sample(names, 3))[: rng.randint(1, 40)] if i % 2 else bytes(rng.randrange(256) for _ in range(9))
        assert machine.count(word) == greedy(word, TOKENS), word


def test_documents(spark):
    rows = odd_documents()
    words = [(r[0], (r[1] or "").encode().lower().split()) for r in rows]
    want = sorted(((d, len(w), sum(greedy(x, TOKENS) for x in w)) for d, w in words), key=repr)
    assert sorted(map(tuple, count_tokens(clashing(spark, rows), PATH, cache_limit=20).collect()), key=repr) == want
    assert count_tokens(empty(spark), PATH).count() == 0
