"""Language-model scoring by deleted interpolation.

P(w | v) mixes three maximum-likelihood estimates: the pair's c(vw) / c(v), the word's c(w) / N and the uniform
1 / (V + 1). The mixture weights belong to the bucket of the context's frequency c(v), by powers of two, and are learned
by expectation-maximisation on held-out counts: a tenth of the training documents is counted apart, and what the other
nine tenths say of its tokens is what the weights are fitted to. Scores then use the counts of all training documents.

The model is as large as the corpus and is never broadcast or collected. Documents form blocks of a few MB of text, and a
few blocks a batch. Each block's different words and pairs, as sorted 64-bit hashes with counts, go to shards by hash
range, one row for a batch and a shard; each shard adds them up over the corpus and answers every batch with the totals
of what its blocks asked for, in the blocks' own order. Batches meet their answers again and score themselves. So the
exchange has a row for each batch and shard; both grow with the square root of the input as far as memory goes, and beyond that
shards are reached in two steps. A word or pair in a third of all documents is one
key for each block, so no shard is hot. Shards follow from the bytes of all texts, summed in a pass of their own. Only the weights (32 buckets x 3) and the histogram they are fitted to (bounded by its bins)
reach the driver.

Tokens: A-Z lower-cased, runs of anything but ASCII white space, then one end. Null text is the empty text: one end.
Repeated rows are documents of their own and count each time. A null id counts as the empty id text, remainder 0, a
training document. With no training documents N and V are 0. Extra columns are ignored.

Blocks are found again by their place in the input, so the input must read the same each time, as tables in files do;
keys are checked by sum, and a changed block is an error, never a wrong score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.common import cut, prepare

BLOCK_BYTES = 4 << 20
#: Blocks to a batch, at least.
BATCH = 4
#: Input bytes to a shard, about a million and a half keys, at least; and the least number of shards.
SHARD_BYTES, LEAST_SHARDS = 8 << 20, 64
#: Beyond LEAST_SHARDS shards both sizes grow with the square root of the input, up to so many times: so rows of the exchange,
#: batches x shards, grow as the input does, as far as tasks hold about 50 MB of text.
GROWTH = 3
#: More shards than this are reached in two steps.
DIRECT = 512
RETAINED, HELD, TEST = 0, 1, 2
END = xxhash.xxh64_intdigest(b"\n", 3)  # no word has white space; as a context it means a text's beginning
BUCKETS = 32
BLOCK_SCHEMA = "batch long, block int, row long, doc_id long, part int, text binary, before binary, last boolean"


def with_parts(docs: DataFrame) -> DataFrame:
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    part = F.when(crc % 5 == 1, TEST).when(F.floor(crc / 5) % 10 == 0, HELD).otherwise(RETAINED)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.cast("int").alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def pieces(text: bytes, size: int) -> Iterator[tuple[bytes, bytes, bool]]:
    """(piece, word before it, whether it is the last): long texts are parted at white space."""
    at, before = 0, b""
    while len(text) - at > size:
        spot = max(text.rfind(c, at, at + size) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
        if spot <= at:  # one word longer than a block
            found = [p for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f") if (p := text.find(c, at + size)) >= 0]
            if not found:
                break
            spot = min(found)
        piece = text[at:spot]
        yield piece, before, False
        words = piece.rsplit(None, 1)
        before = words[-1] if words else before
        at = spot
    yield text[at:], before, True


def sizes_for(total: int, shard_bytes: int = SHARD_BYTES) -> tuple[int, int]:
    """(shards, blocks to a batch) for so many bytes of text."""
    growth = min(GROWTH, max(1.0, (total / (LEAST_SHARDS * shard_bytes)) ** 0.5))
    return max(LEAST_SHARDS, ceil(total / (shard_bytes * growth))), round(BATCH * growth)


def assigned(block_bytes: int, batch_blocks: int = BATCH):
    """From batches of with_parts() to batches of BLOCK_SCHEMA. Held-out parts have blocks of their own (odd batches),
    whether the others are read or not."""

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, row = TaskContext.get().partitionId(), 0
        number, size = [0, 0], [0, 0]
        for batch in batches:
            made: list[tuple] = []
            for doc, part, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kind = int(part == HELD)
                for piece, before, last in pieces(text, block_bytes):
                    made.append((2 * ((partition << 24) + number[kind] // batch_blocks) + kind, number[kind] % batch_blocks, (partition << 40) + row, doc, part, piece, before, last))
                    size[kind] += len(piece)
                    if size[kind] >= block_bytes:
                        number[kind], size[kind] = number[kind] + 1, 0
                row += 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.bool_())
            columns = list(zip(*made, strict=True)) if made else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [x.split()[0] for x in BLOCK_SCHEMA.split(", ")])

    return assign


def in_blocks(docs: DataFrame, block_bytes: int, batch_blocks: int = BATCH) -> DataFrame:
    return docs.mapInArrow(assigned(block_bytes, batch_blocks), BLOCK_SCHEMA)


class Block:
    """Tokens of a block's pieces in a row, with the places of their words and pairs among the block's sorted keys."""

    def __init__(self, texts: list[bytes], before: list[bytes], last: list[bool], part: np.ndarray) -> None:
        digest = xxhash.xxh64_intdigest
        tokens, sizes = [], []
        for text, ends in zip(texts, last, strict=True):
            words = text.lower().split()
            own = np.fromiter(map(digest, words), np.uint64, len(words))
            tokens.append(np.append(own, np.uint64(END)) if ends else own)
            sizes.append(len(tokens[-1]))
        self.sizes = np.array(sizes, np.int64)
        token = np.concatenate([np.zeros(0, np.uint64), *tokens])
        first = np.array([digest(b.lower()) if b else END for b in before], np.uint64)
        n = len(token)
        words, at = np.unique(np.concatenate([token, first, [np.uint64(END)]]), return_inverse=True)
        self.token_at, first_at = at[:n], at[n:-1]
        self.context_at = np.empty(n, np.int64)
        self.context_at[1:] = self.token_at[:-1]
        begin = np.cumsum(self.sizes) - self.sizes
        some = self.sizes > 0
        self.context_at[begin[some]] = first_at[some]
        mixed = (words * np.uint64(0x9E3779B97F4A7C15)) ^ (words >> np.uint64(29))
        pair = (mixed[self.context_at] * np.uint64(0xBF58476D1CE4E5B9) + mixed[self.token_at]) * np.uint64(0x94D049BB133111EB)
        pair = (pair ^ (pair >> np.uint64(31))) & ~np.uint64(1)  # the low bit tells words from pairs
        pairs, self.pair_at = np.unique(pair, return_inverse=True)
        word_keys = mixed | np.uint64(1)
        learned = np.repeat(part != TEST, self.sizes)
        counts = np.r_[np.bincount(self.token_at[learned], minlength=len(words)), np.bincount(self.pair_at[learned], minlength=len(pairs))]
        keys = np.concatenate([word_keys, pairs])
        order = np.argsort(keys, kind="stable")
        self.keys, self.counts = keys[order], counts[order]
        self.place = np.empty(len(keys), np.int64)  # of each word, then each pair, among the sorted keys
        self.place[order] = np.arange(len(keys))
        self.n_words = len(words)

    @classmethod
    def of(cls, table: pa.Table) -> Block:
        return cls(table["text"].to_pylist(), table["before"].to_pylist(), table["last"].to_pylist(), table["part"].to_numpy())

    def cuts(self, shards: int) -> np.ndarray:
        """Where the keys of each shard begin: shards are equal ranges of the hash."""
        edges = np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)
        return np.r_[0, np.searchsorted(self.keys, edges), len(self.keys)]

    def looked_up(self, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """c(w), c(v), c(vw) of each token, from totals in the order of the keys."""
        word, pair = totals[self.place[: self.n_words]], totals[self.place[self.n_words :]]
        return word[self.token_at], word[self.context_at], pair[self.pair_at]


def pack(numbers: np.ndarray) -> bytes:
    """Counts, mostly tiny, as bytes; those of 255 and more follow in full."""
    large = numbers >= 255
    return zlib.compress(np.where(large, 255, numbers).astype(np.uint8).tobytes() + numbers[large].astype(np.int64).tobytes(), 1)


def unpack(data: bytes, n: int) -> np.ndarray:
    raw = zlib.decompress(data)
    out = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, np.int64, -1, n) if len(raw) > n else 0
    return out


def _each_block(batches: Iterable[pa.RecordBatch], batch_blocks: int) -> Iterator[tuple[int, int, Block]]:
    """(batch, block, the block) from rows in input order, where the two kinds of blocks take turns."""
    open_: dict[int, list[pa.Table]] = {}
    number: dict[int, int] = {}

    def closed(kind: int) -> tuple[int, int, Block]:
        table = pa.concat_tables(open_.pop(kind))
        return number[kind] // batch_blocks, number[kind] % batch_blocks, Block.of(table)

    for rows in batches:
        table = pa.Table.from_batches([rows])
        block = table["batch"].to_numpy() * batch_blocks + table["block"].to_numpy()
        for b in pd.unique(block).tolist():
            kind = b // batch_blocks & 1
            if kind in open_ and number[kind] != b:
                yield closed(kind)
            number[kind] = b
            open_.setdefault(kind, []).append(table.filter(pa.array(block == b)))
    for kind in list(open_):
        yield closed(kind)


def answers(docs: DataFrame, shards: int, block_bytes: int, batch_blocks: int = BATCH, direct: int = DIRECT, batches: int = 1) -> DataFrame:
    """ANSWER: for each batch and shard the corpus counts of the keys of its blocks, one after the other; and for batch -1
    a shard's sums. Not yet written down. More than `direct` shards are asked in two steps, by groups of shards, from
    about so many batches in all."""
    if shards > direct:
        groups = ceil(shards**0.5)
        return answers_in_two_steps(asked_of(docs, groups, block_bytes, batch_blocks), groups, ceil(shards / groups), max(1, ceil(batches / groups)))
    return asked_of(docs, shards, block_bytes, batch_blocks).groupBy("shard").applyInPandas(_add_up, ANSWER)


def asked_of(docs: DataFrame, shards: int, block_bytes: int, batch_blocks: int) -> DataFrame:
    """ASKED: the keys of each batch's blocks, with their counts, for each shard that they fall to."""

    assign = assigned(block_bytes, batch_blocks)

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(batch: int, blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            made = []
            for s in range(shards):
                spans = [slice(cuts[s], cuts[s + 1]) for _, _, cuts in blocks]
                sizes = [x.stop - x.start for x in spans]
                if any(sizes):
                    keys = np.concatenate([k[x] for (k, _, _), x in zip(blocks, spans, strict=True)])
                    counts = np.concatenate([c[x] for (_, c, _), x in zip(blocks, spans, strict=True)])
                    made.append((batch, s, sizes, keys.tobytes(), pack(counts)))
            types = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], ["batch", "shard", "sizes", "keys", "counts"])

        open_: dict[int, tuple[int, list]] = {}
        for batch, _, block in _each_block(assign(batches), batch_blocks):
            kind = batch & 1
            if kind in open_ and open_[kind][0] != batch:
                yield sent(*open_.pop(kind))
            open_.setdefault(kind, (batch, []))[1].append((block.keys, block.counts, block.cuts(shards)))
        for left in open_.values():
            yield sent(*left)

    return docs.mapInArrow(ask, ASKED)


ASKED = "batch long, shard int, sizes array<long>, keys binary, counts binary"
ANSWER = "batch long, shard int, sizes array<long>, checks array<long>, total binary, retained binary, sum_n long, sum_v long, kept_n long, kept_v long"


def _totals(keys: np.ndarray, counts: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[int, int, int, int]]:
    """(count of each key, the same over retained documents, the shard's sums)"""
    different, at = np.unique(keys, return_inverse=True)
    total = np.bincount(at, counts, len(different)).astype(np.int64)
    retained = np.bincount(at, np.where(held, 0, counts), len(different)).astype(np.int64)
    word = (different & np.uint64(1)) == 1
    return total[at], retained[at], (total[word].sum(), (total[word] > 0).sum(), retained[word].sum(), (retained[word] > 0).sum())


def _asked(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all keys of some rows, their counts, how many each row has)"""
    sizes = np.array([len(k) // 8 for k in pdf["keys"]])
    keys = np.concatenate([np.frombuffer(k, np.uint64) for k in pdf["keys"]])
    return keys, np.concatenate([unpack(c, n) for c, n in zip(pdf["counts"], sizes, strict=True)]), sizes


def _add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    keys, counts, sizes = _asked(pdf)
    total, retained, sums = _totals(keys, counts, np.repeat(pdf["batch"].to_numpy() & 1 == 1, sizes))
    made, cuts = [], np.r_[0, np.cumsum(sizes)]
    for i, (batch, each) in enumerate(zip(pdf["batch"].tolist(), pdf["sizes"], strict=True)):
        own = slice(cuts[i], cuts[i + 1])
        ends = cuts[i] + np.cumsum(each)
        checks = [_check(keys[e - n : e]) for e, n in zip(ends.tolist(), list(each), strict=True)]
        made.append((batch, list(each), checks, pack(total[own]), pack(retained[own]) if batch & 1 else None, 0, 0, 0, 0))
    made.append((-1, [], [], None, None, *sums))
    out = pd.DataFrame(made, columns=["batch", "sizes", "checks", "total", "retained", "sum_n", "sum_v", "kept_n", "kept_v"])
    out.insert(1, "shard", pdf["shard"].iloc[0])
    return out


def answers_in_two_steps(asked: DataFrame, groups: int, shards_of_group: int, sets: int) -> DataFrame:
    """ANSWER to rows that were asked of `groups` ranges of the hash, each of so many shards. Batches form `sets`, and for each set and
    group a task deals what its batches ask to the group's shards, a row for each; answers come back the same way. So no
    step has a row for every batch and shard."""
    edges = [((g * shards_of_group + s) << 64) // (groups * shards_of_group) for g in range(groups) for s in range(shards_of_group)]
    set_of = F.pmod(F.xxhash64("batch"), F.lit(sets)).cast("int")

    def route(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["shard"].iloc[0])
        keys, counts, sizes = _asked(pdf)
        inner = np.array(edges[group * shards_of_group + 1 : (group + 1) * shards_of_group], np.uint64)
        blocks = np.concatenate([np.array(list(n), np.int64) for n in pdf["sizes"]])
        begin = np.cumsum(blocks) - blocks
        # Of each block, in turn, where the keys of each shard begin and end.
        cuts = np.stack([b + np.r_[0, np.searchsorted(keys[b : b + n], inner), n] for b, n in zip(begin.tolist(), blocks.tolist(), strict=True)])
        made = []
        for s in range(shards_of_group):
            at = np.concatenate([np.arange(x, y) for x, y in zip(cuts[:, s].tolist(), cuts[:, s + 1].tolist(), strict=True)])
            made.append((pdf["set"].iloc[0], group * shards_of_group + s, pdf["batch"].tolist(), [len(n) for n in pdf["sizes"]], (cuts[:, s + 1] - cuts[:, s]).tolist(), keys[at].tobytes(), pack(counts[at])))
        return pd.DataFrame(made, columns=["set", "shard", "batches", "blocks", "sizes", "keys", "counts"])

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, counts, sizes = _asked(pdf)
        held = np.concatenate([np.repeat(np.repeat(np.array(list(b), np.int64) & 1 == 1, list(k)), list(n)) for b, k, n in zip(pdf["batches"], pdf["blocks"], pdf["sizes"], strict=True)])
        total, retained, sums = _totals(keys, counts, held)
        ends = np.cumsum(sizes)
        made = []
        for (part, batches, blocks, each), end, n in zip(pdf[["set", "batches", "blocks", "sizes"]].itertuples(index=False), ends.tolist(), sizes.tolist(), strict=True):
            spots = end - n + np.cumsum(list(each))
            checks = [_check(keys[e - m : e]) for e, m in zip(spots.tolist(), list(each), strict=True)]
            made.append((part, list(batches), list(blocks), list(each), checks, pack(total[end - n : end]), pack(retained[end - n : end]), 0, 0, 0, 0))
        made.append((-1, [], [], [], [], None, None, *sums))
        out = pd.DataFrame(made, columns=["set", "batches", "blocks", "sizes", "checks", "total", "retained", "sum_n", "sum_v", "kept_n", "kept_v"])
        out.insert(1, "shard", pdf["shard"].iloc[0])
        return out

    def back(pdf: pd.DataFrame) -> pd.DataFrame:
        columns = ["batch", "shard", "sizes", "checks", "total", "retained", "sum_n", "sum_v", "kept_n", "kept_v"]
        if pdf["set"].iloc[0] < 0:  # sums, a row each
            return pdf.assign(batch=-1)[columns]
        pdf = pdf.sort_values("shard")
        batches, blocks = list(pdf["batches"].iloc[0]), list(pdf["blocks"].iloc[0])
        sizes = np.array([list(n) for n in pdf["sizes"]], np.int64)  # a row a shard, a column a block
        checks = np.array([list(c) for c in pdf["checks"]], np.int64).view(np.uint64).sum(0, dtype=np.uint64).view(np.int64)
        values = {c: [unpack(d, int(n.sum())) for d, n in zip(pdf[c], sizes, strict=True)] for c in ("total", "retained")}
        ends, made, first = np.cumsum(sizes, 1), [], 0
        for batch, k in zip(batches, blocks, strict=True):
            own = range(first, first + k)
            joined = {c: np.concatenate([v[s][ends[s, i] - sizes[s, i] : ends[s, i]] for i in own for s in range(len(sizes))]) for c, v in values.items()}
            made.append((batch, int(pdf["group"].iloc[0]), sizes[:, first : first + k].sum(0).tolist(), checks[first : first + k].tolist(), pack(joined["total"]), pack(joined["retained"]) if batch & 1 else None, 0, 0, 0, 0))
            first += k
        return pd.DataFrame(made, columns=columns)

    dealt = asked.withColumn("set", set_of).groupBy("set", "shard").applyInPandas(route, "set int, shard int, batches array<long>, blocks array<int>, sizes array<long>, keys binary, counts binary")
    told = dealt.groupBy("shard").applyInPandas(add_up, "set int, shard int, batches array<long>, blocks array<int>, sizes array<long>, checks array<long>, total binary, retained binary, sum_n long, sum_v long, kept_n long, kept_v long")
    return told.withColumn("group", F.floor(F.col("shard") / shards_of_group).cast("int")).groupBy("set", "group").applyInPandas(back, ANSWER)


def _check(keys: np.ndarray) -> int:
    return int(keys.sum(dtype=np.uint64).view(np.int64))


def met(batch: pa.Table, answer: pa.Table, column: str) -> Iterator[tuple[pa.Table, Block, np.ndarray]]:
    """(rows, block, answers in the order of the block's keys) for each block of a batch; raises where the answers
    belong to other keys."""
    answer = answer.sort_by("shard")
    sizes = np.array(answer["sizes"].to_pylist(), np.int64).reshape(len(answer), -1)
    checks = np.array(answer["checks"].to_pylist(), np.int64).reshape(len(answer), -1)
    held = [unpack(d, int(n.sum())) for d, n in zip(answer[column].to_pylist(), sizes, strict=True)]
    numbers = np.unique(batch["block"].to_numpy())
    begin = np.cumsum(sizes, 1) - sizes
    for i, number in enumerate(numbers.tolist()):
        rows = batch.filter(pa.array(batch["block"].to_numpy() == number))
        block = Block.of(rows)
        if sizes.shape[1] != len(numbers) or sizes[:, i].sum() != len(block.keys):
            raise RuntimeError(CHANGED)
        ends = np.cumsum(sizes[:, i]).tolist()
        if [_check(block.keys[e - n : e]) for e, n in zip(ends, sizes[:, i].tolist(), strict=True)] != checks[:, i].tolist():
            raise RuntimeError(CHANGED)
        yield rows, block, np.concatenate([h[b : b + n] for h, b, n in zip(held, begin[:, i].tolist(), sizes[:, i].tolist(), strict=True)])


CHANGED = "the input has changed between two reads; write it to a table first"


def bucket_of(context: np.ndarray) -> np.ndarray:
    return np.where(context > 0, np.minimum(1 + np.log2(np.maximum(context, 1)).astype(np.int64), BUCKETS - 1), 0)


def estimates(word: np.ndarray, context: np.ndarray, pair: np.ndarray, n: int, v: int) -> tuple[np.ndarray, np.ndarray]:
    """The pair's and the word's estimate, in units of the uniform one."""
    return pair / np.maximum(context, 1) * (v + 1), word / max(n, 1) * (v + 1)


#: Quarters of octaves; NONE stands for an estimate of zero.
STEPS, NONE = 4, -10_000


def histogram(x2: np.ndarray, x1: np.ndarray, bucket: np.ndarray) -> pd.DataFrame:
    bins = [np.where(x > 0, np.rint(STEPS * np.log2(np.maximum(x, 1e-300))), NONE).astype(np.int64) for x in (x2, x1)]
    rows, n = np.unique(np.stack([bucket, *bins], 1), axis=0, return_counts=True)
    return pd.DataFrame({"bucket": rows[:, 0], "two": rows[:, 1], "one": rows[:, 2], "n": n})


def fit_weights(held: pd.DataFrame, rounds: int = 60, prior: float = 20.0, floor: float = 1e-4) -> np.ndarray:
    """(BUCKETS, 3) weights of pair, word and uniform estimate. Every bucket leans on the weights of all buckets
    together by `prior` tokens; an unseen context has no pair estimate."""
    x = np.stack([np.where(held[c] == NONE, 0, 2.0 ** (held[c] / STEPS)) for c in ("two", "one")] + [np.ones(len(held))], 1)
    n, bucket = held["n"].to_numpy(float), held["bucket"].to_numpy()
    pooled = np.array([0.5, 0.4, 0.1])
    for _ in range(rounds if n.sum() else 0):
        share = pooled * x
        pooled = np.maximum((share / share.sum(1, keepdims=True) * n[:, None]).sum(0) / n.sum(), floor)
        pooled /= pooled.sum()
    weights = np.tile(pooled, (BUCKETS, 1))
    for _ in range(rounds):
        share = weights[bucket] * x
        share *= (n / share.sum(1))[:, None]
        sums = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], 1) + prior * pooled
        weights = np.maximum(sums / sums.sum(1, keepdims=True), floor)
        weights[0, 0] = 0
        weights /= weights.sum(1, keepdims=True)
    return weights


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, shards: int | None = None, direct: int = DIRECT) -> DataFrame:
    """doc_id, part, n_tokens, n_known, train_tokens, base_score, score for each row of docs."""
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    rows = with_parts(docs)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    derived, batch_blocks = sizes_for(total, shard_bytes)
    known = cut(answers(rows, shards or derived, block_bytes, batch_blocks, direct, ceil(total / (block_bytes * batch_blocks))))
    sums = known.where("batch = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("sum_n", "sum_v", "kept_n", "kept_v")]).first()
    n, v, kept_n, kept_v = (int(x) for x in sums)
    reply = known.where("batch >= 0").select("batch", "shard", "sizes", "checks", "total", "retained")

    def observe(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        for _, block, found in met(left, right, "retained"):
            word, context, pair = block.looked_up(found)
            made.append(histogram(*estimates(word, context, pair, kept_n, kept_v), bucket_of(context)))
        return pa.Table.from_pandas(pd.concat(made), preserve_index=False)

    held_blocks = in_blocks(rows.where(F.col("part") == HELD), block_bytes, batch_blocks)
    held = held_blocks.groupBy("batch").cogroup(reply.where("batch % 2 = 1").groupBy("batch")).applyInArrow(observe, "bucket long, two long, one long, n long")
    weights = spark.sparkContext.broadcast(fit_weights(held.groupBy("bucket", "two", "one").agg(F.sum("n").alias("n")).toPandas()))

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        for rows, block, found in met(left, right, "total"):
            word, context, pair = block.looked_up(found)
            x2, x1 = estimates(word, context, pair, n, v)
            mix = weights.value[bucket_of(context)]
            model = np.log10((mix[:, 0] * x2 + mix[:, 1] * x1 + mix[:, 2]) / (v + 1))
            base = np.log10((word + 0.5) / (n + 0.5 * (v + 1)))
            owner = np.repeat(np.arange(len(block.sizes)), block.sizes)
            summed = lambda x: np.bincount(owner, x, len(block.sizes))  # noqa: B023, E731
            made.append(pa.table({"row": rows["row"], "doc_id": rows["doc_id"], "part": rows["part"], "n_tokens": block.sizes, "n_known": summed(word > 0).astype(np.int64), "base_score": summed(base), "score": summed(model)}))
        return pa.concat_tables(made)

    pieces_ = in_blocks(rows, block_bytes, batch_blocks).groupBy("batch").cogroup(reply.groupBy("batch")).applyInArrow(judge, "row long, doc_id long, part int, n_tokens long, n_known long, base_score double, score double")
    # A text longer than a block has several pieces.
    whole = pieces_.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("part").alias("part"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return whole.select("doc_id", "part", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def digest(docs: DataFrame) -> DataFrame:
    return score(docs).select("doc_id", (F.col("part") == TEST).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
