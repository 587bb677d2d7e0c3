"""A convolutional text classifier over hashed word embeddings, trained in numpy, with thresholds by language.

A word is the sum of two embeddings, one hashed from the whole word and one from its first bytes, so that words never
seen share what their stem says. Filters of widths 1, 2 and 3 slide over the text; each keeps its largest response
anywhere in the text, and a logistic unit weighs those. Only that largest place learns, so training is sparse.

Training is bounded: at most `per_class` labelled documents of each label and `sample_words` words in all, whole documents
in the order of a hash of the id; every fourth of them is left out. All texts are then scored once, and all labelled
documents that weren't trained on set, for each language that the text itself looks like (a language-bitmask filter, see
langid), the threshold of the best F1: a histogram of their scores by language and label is what the driver sees. Scores
are moved so that this threshold is 0.5: score = sigmoid(logit - threshold of the language).

Scoring reads whole texts. Labels, lang, source and doc_id are never inputs of a score. Null and empty texts have no
words, respond with zero everywhere and get the score that follows. Labels that are null are not learned from; where a
document has several, the largest counts. With no labels of one kind the score is the share of the other, constant.
Repeated rows get equal scores; extra columns of docs are kept by without_toxic() and ignored by scores().
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.llm import langid, line_dedup
from skirmish.llm.common import columns_of, crc_mod5, cut, prepare, text_hash

WORD_BITS, STEM_BITS, STEM_BYTES = 16, 16, 6
DIM, FILTERS, WIDTHS = 16, 8, (1, 2, 3)
PER_CLASS, EPOCHS, LEAST_STEPS, CHUNK = 4000, 8, 250, 1 << 16
#: Bytes of a filter of rejected texts that may be sent to every executor.
FILTER_BYTES = 64 << 20
#: Words of all training documents together.
SAMPLE_WORDS = 8_000_000
#: Scores are counted in bins of this many to a unit of the logit, and end at LIMIT.
BINS, LIMIT = 64, 60.0
#: Punctuation and controls of ASCII part words; letters, digits and all other bytes make them.
_BLANKS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


class WordIds(dict):
    """word -> both hashed ids in one number; forgets all when it is full."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        stem = word[:STEM_BYTES]
        out = (xxhash.xxh64_intdigest(word, 1) & ((1 << WORD_BITS) - 1)) << STEM_BITS | (xxhash.xxh64_intdigest(stem, 2) & ((1 << STEM_BITS) - 1))
        if len(word) <= 64:
            self[word] = out
        return out


_word_ids = WordIds()


def word_ids(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "replace").lower().translate(_BLANKS).split()
    return np.fromiter(map(_word_ids.__getitem__, words), np.uint32, len(words))


@dataclass
class ConvNet:
    words: np.ndarray
    stems: np.ndarray
    filters: dict[int, np.ndarray]  # width: (width * DIM, FILTERS)
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    @classmethod
    def fresh(cls, seed: int) -> ConvNet:
        rng = np.random.default_rng(seed)
        grow = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        n = FILTERS * len(WIDTHS)
        return cls(grow(1 << WORD_BITS, DIM, scale=0.1), grow(1 << STEM_BITS, DIM, scale=0.1), {w: grow(w * DIM, FILTERS, scale=1 / np.sqrt(w * DIM)) for w in WIDTHS}, np.zeros(n, np.float32), grow(n, scale=0.3), 0.0)

    def embed(self, ids: np.ndarray) -> np.ndarray:
        return self.words[ids >> STEM_BITS] + self.stems[ids & ((1 << STEM_BITS) - 1)]

    def responses(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """For each width, (places, FILTERS): what each filter says at each place; texts shorter than a width are
        followed by zeros."""
        for w in WIDTHS:
            rows = max(1, len(x) - w + 1)
            padded = x if len(x) >= w else np.concatenate([x, np.zeros((w - len(x), DIM), np.float32)])
            yield sum(padded[j : j + rows] @ self.filters[w][j * DIM : (j + 1) * DIM] for j in range(w))

    def pooled(self, ids: np.ndarray) -> np.ndarray:
        """Largest response of each filter over the whole text, in chunks that overlap by the widest filter."""
        best = np.full(FILTERS * len(WIDTHS), -np.inf, np.float32)
        for at in range(0, max(1, len(ids)), CHUNK):
            part = ids[at : at + CHUNK + max(WIDTHS) - 1]
            if at and len(part) < max(WIDTHS):
                break
            best = np.maximum(best, np.concatenate([r.max(0) for r in self.responses(self.embed(part))]))
        return np.maximum(best + self.bias, 0)

    def logits(self, texts: Iterable[np.ndarray]) -> np.ndarray:
        return np.array([self.pooled(ids) @ self.weights + self.offset for ids in texts], np.float64)


class Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.step, self.state = rate, 0, {}

    def update(self, name: str, value: np.ndarray, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        """With rows, grad is for those rows of value only."""
        if name not in self.state:
            self.state[name] = np.zeros_like(value), np.zeros_like(value)
        m, v = self.state[name]
        at = slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * grad
        v[at] = 0.999 * v[at] + 0.001 * grad * grad
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        value[at] -= scale * m[at] / (np.sqrt(v[at]) + 1e-8)


def loss_and_gradients(net: ConvNet, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, drop: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Mean weighted log loss of a batch under a dropout mask, its gradients by the dense parameters, and by embeddings:
    word ids and a gradient row for each. Only the place of a filter's largest response learns."""
    n_pool = FILTERS * len(WIDTHS)
    pooled, places, inputs = np.zeros((len(texts), n_pool), np.float32), np.zeros((len(texts), n_pool), np.int64), []
    for r, ids in enumerate(texts):
        x = net.embed(ids)
        inputs.append(x)
        for f, said in enumerate(net.responses(x)):
            places[r, f * FILTERS : (f + 1) * FILTERS] = where = said.argmax(0)
            pooled[r, f * FILTERS : (f + 1) * FILTERS] = said[where, np.arange(FILTERS)]
    active = np.maximum(pooled + net.bias, 0)
    z = (active * drop) @ net.weights + net.offset
    loss = float((weight * (np.logaddexp(0, z) - labels * z)).mean())
    g = ((1 / (1 + np.exp(-z)) - labels) * weight / len(texts)).astype(np.float32)
    g_pool = g[:, None] * net.weights * drop * (active > 0)
    ids_hit, grads = [np.zeros(0, np.uint32)], [np.zeros((0, DIM), np.float32)]
    g_filters = {w: np.zeros_like(net.filters[w]) for w in WIDTHS}
    for r, (ids, x) in enumerate(zip(texts, inputs, strict=True)):
        for f, w in enumerate(WIDTHS):
            span = slice(f * FILTERS, (f + 1) * FILTERS)
            for j in range(w):
                spot = places[r, span] + j
                ok = spot < len(ids)
                spot, gp = spot[ok], g_pool[r, span][ok]
                rows = slice(j * DIM, (j + 1) * DIM)
                g_filters[w][rows][:, ok] += x[spot].T * gp
                ids_hit.append(ids[spot])
                grads.append((net.filters[w][rows][:, ok] * gp).T)
    dense = {"weights": (active * drop).T @ g, "offset": np.array(g.sum()), "bias": g_pool.sum(0)} | {f"filter{w}": g for w, g in g_filters.items()}
    return loss, dense, np.concatenate(ids_hit), np.concatenate(grads)


def train(texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 32, seed: int = 5) -> ConvNet:
    """At least `epochs` passes, and on few texts as many as make LEAST_STEPS steps."""
    net, adam, rng = ConvNet.fresh(seed), Adam(0.004), np.random.default_rng(seed)
    epochs = max(epochs, -(-LEAST_STEPS * batch // len(texts)))
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            adam.step += 1
            drop = (rng.random((len(chosen), FILTERS * len(WIDTHS))) > 0.2).astype(np.float32) / np.float32(0.8)
            _, dense, hit, grad = loss_and_gradients(net, [texts[i] for i in chosen], labels[chosen], weight[chosen], drop)
            adam.update("weights", net.weights, dense["weights"])
            net.offset -= 0.05 * float(dense["offset"])
            adam.update("bias", net.bias, dense["bias"])
            for w in WIDTHS:
                adam.update(f"filter{w}", net.filters[w], dense[f"filter{w}"])
            for name, table, rows in (("words", net.words, hit >> STEM_BITS), ("stems", net.stems, hit & ((1 << STEM_BITS) - 1))):
                unique, back = np.unique(rows, return_inverse=True)
                summed = np.zeros((len(unique), DIM), np.float32)
                np.add.at(summed, back, grad)
                adam.update(name, table, summed, unique)
    return net


def best_threshold(logits: np.ndarray, toxic: np.ndarray, clean: np.ndarray, most: float = 1.0) -> float:
    """The logit of the best F1, from numbers of toxic and clean rows at each different logit; halfway between those that
    it parts. No more than the share `most` of all rows is above it: few labels would else let it reject nearly everything."""
    order = np.argsort(-logits)
    hit, wrong = np.cumsum(toxic[order]), np.cumsum(clean[order])
    f1 = 2 * hit / (hit + wrong + hit[-1])
    f1[hit + wrong > max(1.0, most * (hit[-1] + wrong[-1]))] = -1
    at = int(f1.argmax())
    return float((logits[order[at]] + logits[order[min(at + 1, len(order) - 1)]]) / 2)


def thresholds(histogram: pd.DataFrame, least_of_language: int = 40) -> dict[int, float]:
    """From lang, toxic, bin, n: the threshold over all under -1, and one of each language with enough rows of both kinds.
    Over all no more than 1.5 times the toxic share is above it, in a language no more than 3 times its own."""

    def best(rows: pd.DataFrame, times: float) -> float:
        table = rows.pivot_table(index="bin", columns="toxic", values="n", aggfunc="sum", fill_value=0).reindex(columns=[0, 1], fill_value=0)
        toxic, clean = table[1].to_numpy(float), table[0].to_numpy(float)
        return best_threshold(table.index.to_numpy() / BINS, toxic, clean, times * toxic.sum() / (toxic.sum() + clean.sum()))

    out = {-1: best(histogram, 1.5)}
    for lang, own in histogram[histogram["lang"] >= 0].groupby("lang"):
        if min(own.loc[own["toxic"] == k, "n"].sum() for k in (0, 1)) >= least_of_language:
            out[int(lang)] = best(own, 3.0)
    return out


def _labelled(labels: DataFrame, learnable: Column) -> DataFrame:
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    return known.where(learnable & F.col("toxic").isin(0, 1))


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, per_class: int = PER_CLASS, sample_words: int = SAMPLE_WORDS) -> tuple[ConvNet | float, DataFrame | None]:
    """(the network, or a constant where there are labels of one kind or none; the ids it was trained on). What reaches the driver are word ids: sample_words of them at most."""
    prepare(docs.sparkSession)
    known = _labelled(labels, learnable)
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return float(bool(sizes.get(1))), None
    ticket = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 30))
    below = F.when(F.col("toxic") == 1, int((1 << 30) * min(1, per_class / sizes[1]))).otherwise(int((1 << 30) * min(1, per_class / sizes[0])))
    chosen = known.where((ticket < below) & (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) != 0))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")  # at most about 2 x per_class ids

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [word_ids(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.int32()), pa.array([len(i) for i in held], pa.int64()), pa.array([i.tobytes() for i in held], pa.binary())], ["doc_id", "toxic", "n", "ids"])

    # An id is one document here, however many rows it has: of its texts the shortest.
    shortest = rows.mapInArrow(encode, "doc_id long, toxic int, n long, ids binary").groupBy("doc_id").agg(F.min(F.struct("n", "ids", "toxic")).alias("r"))
    encoded = cut(shortest.select("doc_id", "r.*").withColumn("ticket", ticket))
    # Whole documents in the order of their tickets, as long as words are left; one that doesn't fit is passed over.
    taken, left = [], sample_words
    for r in encoded.select("doc_id", "n").orderBy("ticket", "doc_id").collect():
        if r["n"] <= left:
            taken, left = [*taken, r["doc_id"]], left - r["n"]
    spark = docs.sparkSession
    fits = encoded if len(taken) == encoded.count() else encoded.join(F.broadcast(spark.createDataFrame([(i,) for i in set(taken)], "doc_id long")), "doc_id", "left_semi")
    sample = fits.toArrow().to_pandas().sort_values("doc_id", kind="stable")
    ids, toxic = [np.frombuffer(b, np.uint32) for b in sample["ids"]], sample["toxic"].to_numpy()
    if not 0 < toxic.sum() < len(toxic):
        return sizes[1] / (sizes[0] + sizes[1]), None
    trained = F.broadcast(spark.createDataFrame([(i,) for i in set(sample["doc_id"].tolist())], "trained long"))
    return train(ids, toxic), trained


def scorer(net: ConvNet | float, languages: langid.LanguageFilter):
    """A function from texts to (number of the language that each looks like, -1 for none, and logit)."""

    def score(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        lang, share = languages.predict([t or "" for t in texts])
        return np.where(share > 0, lang, -1).astype(np.int32), np.clip(net.logits(map(word_ids, texts)), -LIMIT, LIMIT)

    return score


@dataclass
class Model:
    """What fit() learns, of a fixed size. With labels of one kind or none there is no network, only a constant."""

    network: object  # broadcast (ConvNet, LanguageFilter)
    constant: float | None
    thresholds: dict[int, float]

    def logits(self, docs: DataFrame) -> DataFrame:
        """doc_id, t1, t2 (a hash of the text), lang, logit for each row; texts are read once."""
        prepare(docs.sparkSession)
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_hash(), F.col("text").cast("string").alias("text"))
        if self.constant is not None:
            return rows.select("doc_id", "t1", "t2", F.lit(-1).alias("lang"), F.lit(0.0).alias("logit"))
        network = self.network

        def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rate = scorer(*network.value)
            for batch in batches:
                lang, logit = rate(batch.column(3).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(lang), pa.array(logit)], ["doc_id", "t1", "t2", "lang", "logit"])

        return rows.mapInArrow(score, "doc_id long, t1 long, t2 long, lang int, logit double")

    def score(self) -> Column:
        """The score of a row of logits()."""
        if self.constant is not None:
            return F.lit(self.constant)
        moved = F.lit(self.thresholds[-1])
        for lang, threshold in sorted(self.thresholds.items()):
            moved = F.when(F.col("lang") == lang, threshold).otherwise(moved)
        return 1 / (1 + F.exp(moved - F.col("logit")))


def fit(docs: DataFrame, labels: DataFrame, learnable: Column) -> tuple[Model, DataFrame]:
    """(model, the logits of docs, written down). Networks learn from a bounded sample, thresholds from all labelled
    documents that it leaves."""
    languages = langid.learn(docs, learnable)
    net, trained = learn(docs, labels, learnable)
    spark = docs.sparkSession
    if isinstance(net, float):
        model = Model(None, net, {})
        return model, model.logits(docs)
    model = Model(spark.sparkContext.broadcast((net, languages)), None, {-1: 0.0})
    points = cut(model.logits(docs))

    def counted(known: DataFrame) -> pd.DataFrame:
        binned = points.join(known, "doc_id").groupBy("lang", "toxic", F.rint(F.col("logit") * BINS).cast("int").alias("bin"))
        return binned.agg(F.count("*").alias("n")).toPandas()

    known = _labelled(labels, learnable)
    histogram = counted(known.join(trained, known.doc_id == trained.trained, "left_anti"))
    if set(histogram["toxic"]) != {0, 1}:  # too few labels for both
        histogram = counted(known)
    model.thresholds = thresholds(histogram)
    return model, points


def scores(points: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted for each row of logits()."""
    scored = points.withColumn("score", model.score())
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, points: DataFrame, model: Model, broadcast_rows: int = 500_000, filter_bytes: int = FILTER_BYTES, exceptions: int = 100_000) -> DataFrame:
    """The rows of docs that the model does not reject, unchanged. A score is that of a text, so the rejected are known by
    their texts' hashes. Up to broadcast_rows of these go to the rows; beyond that a cuckoo filter of them does, and with it the few
    kept texts that it takes for rejected ones, found in the points beforehand: no text moves. Where either is too large to
    send, rows are joined."""
    prepare(docs.sparkSession)
    keys = [F.col("t1").alias("hi"), F.col("t2").alias("lo")]
    rejected = model.score() >= 0.5
    bad = cut(points.where(rejected).select(*keys).distinct())
    rows = docs.select(F.struct(*columns_of(docs)).alias("row"), *text_hash())
    n = bad.count()
    if n <= broadcast_rows:
        return rows.join(F.broadcast(bad.toDF("t1", "t2")), ["t1", "t2"], "left_anti").select("row.*")
    shards = -(-n // 500_000)
    filters = line_dedup.small_filters(cut(line_dedup.build_filters(bad, shards)), filter_bytes)
    if filters is not None:
        sent = docs.sparkSession.sparkContext.broadcast(filters)

        @F.pandas_udf("boolean")
        def listed(hi: pd.Series, lo: pd.Series) -> pd.Series:
            return pd.Series(line_dedup.hits(sent.value, shards, hi.to_numpy().view(np.uint64), lo.to_numpy().view(np.uint64)))

        kept = cut(points.where(~rejected).select("t1", "t2").where(listed("t1", "t2")).distinct())
        if kept.count() <= exceptions:
            known = rows.withColumn("listed", listed("t1", "t2")).join(F.broadcast(kept.withColumn("kept", F.lit(True))), ["t1", "t2"], "left")
            return known.where(~F.col("listed") | F.col("kept")).select("row.*")
    return rows.join(bad.toDF("t1", "t2"), ["t1", "t2"], "left_anti").select("row.*")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model, points = fit(docs, labels, crc_mod5() != 0)
    return scores(points, model).select("doc_id", (crc_mod5() == 0).alias("held_out"), "score", "predicted")
