"""Line de-duplication that can be undone: sharded cuckoo filters over exact reference counts.

A line's key is its text without blanks at both ends and with A-Z lower-cased, as a 128-bit hash. The reference table
has one row for each key and document holding it; counted up, it is exact. Over the keys that enough documents hold,
each shard keeps a cuckoo filter, which unlike a Bloom filter can forget: inserting documents adds the keys that reach
the limit, deleting documents removes those that fall below it. Filters only rule lines out; every hit is settled
by the exact counts, which are sent along where they fit and joined to the hits where they don't.

Null or empty text is one empty line. Documents are told apart by doc_id; repeated rows of an id are one document that
holds its lines once, and each row is cut alike. A null id holds no references, and its repeated lines go. Columns
beside doc_id and text pass through unchanged, whatever their names but those of the results, which are replaced. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skirmish.llm.common import columns_of, cut, prepare, scratch_dir

MIN_CHARS, MIN_DOCS = 20, 3
#: Bytes of exact rows (24 for each repeated key) and of filters that may be sent to every executor.
BROADCAST_BYTES = 64 << 20
FILTER_BYTES = 128 << 20
#: References that meet one copy of a shard's filter, where filters aren't sent.
PART_ROWS = 2_000_000
#: Documents for each shard of a store.
DOCS_A_SHARD = 500_000
KEY = ["hi", "lo"]


class CuckooFilter:
    """Buckets of four 16-bit fingerprints, two places for each key; works on arrays of 128-bit keys.

    Fingerprints that find no room after many moves are kept in a stash, so that no inserted key is ever denied."""

    SLOTS, MOVES = 4, 64

    def __init__(self, keys: int) -> None:
        self.mask = (1 << max(1, int(np.ceil(np.log2(max(1, keys) / self.SLOTS / 0.85))))) - 1
        self.table = np.zeros((self.mask + 1, self.SLOTS), np.uint16)
        self.stash: list[tuple[int, int]] = []

    def _first(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark = (hi >> np.uint64(48)).astype(np.uint16)
        return np.maximum(mark, 1), (lo & np.uint64(self.mask)).astype(np.int64)

    def _other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ ((mark.astype(np.int64) * 0x5BD1E995) & self.mask)

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> None:
        rng = np.random.default_rng(7)
        for mark, bucket in zip(*(x.tolist() for x in self._first(hi, lo)), strict=True):
            for _ in range(self.MOVES):
                row = self.table[bucket]
                free = np.flatnonzero(row == 0)
                if not len(free):
                    second = int(self._other(np.array([mark], np.uint16), np.array([bucket]))[0])
                    row, free = self.table[second], np.flatnonzero(self.table[second] == 0)
                    if not len(free):
                        slot = int(rng.integers(self.SLOTS))
                        mark, row[slot] = int(row[slot]), mark
                        bucket = int(self._other(np.array([mark], np.uint16), np.array([second]))[0])
                        continue
                row[free[0]] = mark
                break
            else:
                self.stash.append((mark, bucket))

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        mark, bucket = self._first(hi, lo)
        second = self._other(mark, bucket)
        hit = (self.table[bucket] == mark[:, None]).any(1) | (self.table[second] == mark[:, None]).any(1)
        for m, b in self.stash:
            hit |= (mark == m) & ((bucket == b) | (second == b))
        return hit

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Keys must have been inserted before."""
        mark, bucket = self._first(hi, lo)
        for m, places in zip(mark.tolist(), zip(bucket.tolist(), self._other(mark, bucket).tolist(), strict=True), strict=True):
            for b in places:
                if (m, b) in self.stash:
                    self.stash.remove((m, b))
                    break
                if len(at := np.flatnonzero(self.table[b] == m)):
                    self.table[b, at[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        stash = np.array(self.stash, np.int64).reshape(-1, 2)
        return np.array([self.mask, len(stash)], np.int64).tobytes() + stash.tobytes() + self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        out = cls(1)
        out.mask, n = (int(x) for x in np.frombuffer(data, np.int64, 2))
        out.stash = [tuple(x) for x in np.frombuffer(data, np.int64, 2 * n, 16).reshape(-1, 2).tolist()]
        out.table = np.frombuffer(data, np.uint16, -1, 16 + 16 * n).reshape(-1, cls.SLOTS).copy()
        return out


def line_keys(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes | None]]:
    """Index of each line and its 16-byte key, None for keys that are too short to count."""
    for i, line in enumerate(text.lower().split(b"\n")):
        key = line.strip()
        # A code point has one byte that doesn't continue another, so few bytes settle it without decoding.
        long = len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars)
        yield i, xxhash.xxh3_128_digest(key) if long else None


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """hi, lo, doc_id: a row for each key and document holding it; may repeat where a document's rows repeat."""
    prepare(docs.sparkSession)

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                own = {k for _, k in line_keys(text.as_py() or b"", min_chars) if k}
                ids += [doc] * len(own)
                held += own
            both = np.frombuffer(b"".join(held), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(ids, pa.int64())], ["hi", "lo", "doc_id"])

    kept = docs.where(F.col("doc_id").isNotNull() & (F.length("text") >= min_chars))
    return kept.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(keys, "hi long, lo long, doc_id long")


def reference_counts(refs: DataFrame) -> DataFrame:
    """n_docs and the largest document of each key; both steps combine before they shuffle."""
    return refs.groupBy(*KEY, "doc_id").agg(F.lit(1).alias("one")).groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))


def _halves(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return pdf["hi"].to_numpy(np.int64).view(np.uint64), pdf["lo"].to_numpy(np.int64).view(np.uint64)


def shard_of(shards: int) -> Column:
    return F.pmod(F.shiftrightunsigned("hi", 8), F.lit(shards)).cast("int")


def build_filters(keys: DataFrame, shards: int, room: int = 1) -> DataFrame:
    """shard, filter: a cuckoo filter over each shard's keys, with room for `room` times as many."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter(room * len(pdf))
        made.insert(*_halves(pdf))
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "filter": [made.to_bytes()]})

    return keys.select(shard_of(shards).alias("shard"), *KEY).groupBy("shard").applyInPandas(build, "shard int, filter binary")


def small_filters(filters: DataFrame, limit: int) -> dict[int, CuckooFilter] | None:
    """The shards' filters, if all together fit the limit."""
    if (filters.agg(F.sum(F.length("filter"))).first()[0] or 0) > limit:
        return None
    return {r["shard"]: CuckooFilter.from_bytes(bytes(r["filter"])) for r in filters.collect()}


def hits(filters: dict[int, CuckooFilter], shards: int, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Which keys some filter admits."""
    out, shard = np.zeros(len(hi), bool), (hi >> np.uint64(8)).view(np.int64) % shards
    for s, f in filters.items():
        at = np.flatnonzero(shard == s)
        out[at] = f.contains(hi[at], lo[at])
    return out


_RESULT = "n_lines long, n_dropped long, kept_text string, kept_sha256 string"


class Exact:
    """Repeated keys in sorted arrays, with the document that keeps each."""

    def __init__(self, rows: pa.Table) -> None:
        order = np.argsort(rows["hi"].to_numpy().view(np.uint64))
        self.hi, self.lo = (rows[c].to_numpy().view(np.uint64)[order] for c in KEY)
        self.last = rows["last_doc"].to_numpy()[order]

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where it has none."""
        at, out = np.searchsorted(self.hi, hi), np.full(len(hi), -1)
        left = np.arange(len(hi))
        while len(left):  # a second round only where two keys share a half
            left = left[at[left] < len(self.hi)]
            left = left[self.hi[at[left]] == hi[left]]
            good = self.lo[at[left]] == lo[left]
            out[left[good]] = at[left[good]]
            left = left[~good]
            at[left] += 1
        return out


def _result(text: bytes, gone: Iterable[bool], want_text: bool) -> tuple[int, int, str | None, str]:
    lines = text.split(b"\n")
    kept = [x for x, g in zip(lines, gone, strict=True) if not g]
    joined = text if len(kept) == len(lines) else b"\n".join(kept)
    return len(lines), len(lines) - len(kept), joined.decode() if want_text else None, hashlib.sha256(joined).hexdigest()


def _drop_by_broadcast(docs: DataFrame, repeated: DataFrame, filters: DataFrame, shards: int, min_chars: int, want_text: bool) -> DataFrame:
    """The exact rows fit everywhere: texts stay where they are. Lines pass their shard's filter, then the exact rows."""
    known = small_filters(filters, 1 << 62)  # smaller than the exact rows
    table = docs.sparkSession.sparkContext.broadcast((known, Exact(repeated.select(*KEY, "last_doc").toArrow())))
    types = (pa.int64(), pa.int64(), pa.string(), pa.string())
    names = [c.split()[0] for c in _RESULT.split(", ")]

    def dedup(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, exact = table.value
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            texts = [t or b"" for t in batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()]
            keys = [[k for _, k in line_keys(t, min_chars)] for t in texts]
            flat = [k for own in keys for k in own]
            long = np.flatnonzero([k is not None for k in flat])
            both = np.frombuffer(b"".join(flat[i] for i in long), np.uint64).reshape(-1, 2)
            maybe = np.flatnonzero(hits(known, shards, both[:, 0], both[:, 1]))
            place = exact.find(both[maybe, 0], both[maybe, 1])
            gone, sizes = np.zeros(len(flat), bool), list(map(len, keys))
            held, at = place >= 0, long[maybe]
            owner = np.repeat(np.arange(len(ids)), sizes)[at[held]]
            own_id = np.array([0 if i is None else i for i in ids], np.int64)[owner]
            gone[at[held]] = (exact.last[place[held]] != own_id) | np.array([i is None for i in ids], bool)[owner]
            ends = np.cumsum(sizes).tolist()
            made = [_result(t, gone[e - n : e].tolist(), want_text) for t, e, n in zip(texts, ends, sizes, strict=True)]
            new = [pa.array(c, t) for c, t in zip(zip(*made, strict=True) if made else [[]] * 4, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *names])

    # Other columns travel as one, whatever their names.
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    columns = dict(zip(docs.columns, columns_of(docs), strict=True))
    packed = docs.select("doc_id", "text", *([F.struct(*[columns[c] for c in others]).alias("others")] if others else []))
    made = packed.mapInArrow(dedup, StructType([*packed.schema.fields, *StructType.fromDDL(_RESULT).fields]))
    return made.select(*[(F.col("others")[c] if c in others else F.col(c)).alias(c) for c in docs.columns], *names)


def _admitted(keys: DataFrame, filters: DataFrame, shards: int, limit: int, *more: str) -> DataFrame:
    """Rows of keys (hi, lo and the named columns) that the filters admit, in one pass over them. Filters within the limit
    are sent to the rows, so that nothing but hits is shuffled; beyond it rows are dealt to their shard's filter, where a
    shard with many rows, such as that of a key which a third of all documents hold, has many parts with a filter each."""
    rows = keys.select(*KEY, *more)
    known = small_filters(filters, limit)
    if known is not None:
        sent = keys.sparkSession.sparkContext.broadcast(known)

        def sift(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hi, lo = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
                yield batch.filter(pa.array(hits(sent.value, shards, hi, lo)))

        return rows.mapInArrow(sift, rows.schema)
    dealt = rows.withColumn("shard", shard_of(shards))
    parts = dealt.groupBy("shard").agg(F.count("*").alias("n"))  # a row a shard
    parts = parts.select("shard", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts"))
    # By all columns, as a key's rows must part too.
    dealt = dealt.join(F.broadcast(parts), "shard").withColumn("part", F.pmod(F.xxhash64(*KEY, *more), F.col("parts")).cast("int"))
    each = filters.join(parts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "filter")

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.select([*KEY, *more])
        if not len(right) or not len(left):
            return rows.slice(0, 0)
        cuckoo = CuckooFilter.from_bytes(right["filter"][0].as_py())
        return rows.filter(pa.array(cuckoo.contains(*(rows[c].to_numpy().view(np.uint64) for c in KEY))))

    return dealt.drop("parts").groupBy("shard", "part").cogroup(each.groupBy("shard", "part")).applyInArrow(probe, rows.schema)


def _drop_by_join(docs: DataFrame, refs: DataFrame, repeated: DataFrame, filters: DataFrame, shards: int, min_chars: int, want_text: bool, filter_bytes: int, shard_keys: int) -> DataFrame:
    """Repeated keys of any number: references that the filters admit are joined to the exact rows and become each
    document's list of lines to drop. The documents that have one are known by a filter again; only their texts move.
    A list is no longer than its document; a key that a third of all documents hold is split by adaptive execution."""
    spark = docs.sparkSession
    gone = _admitted(refs, filters, shards, filter_bytes, "doc_id").join(repeated.select(*KEY, "last_doc"), KEY).where("doc_id <> last_doc")
    lists = cut(gone.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("gone")))
    id_keys = [F.xxhash64("doc_id").alias("hi"), F.xxhash64(F.lit(1), "doc_id").alias("lo")]
    id_shards = max(1, -(-lists.count() // shard_keys))
    whole = docs.select(F.struct(*columns_of(docs)).alias("whole"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = whole.where("doc_id is not null")
    listing = small_filters(cut(build_filters(lists.select(*id_keys), id_shards)), filter_bytes)
    if listing is not None:
        sent = spark.sparkContext.broadcast(listing)

        @F.pandas_udf("boolean")
        def listed(hi: pd.Series, lo: pd.Series) -> pd.Series:
            return pd.Series(hits(sent.value, id_shards, hi.to_numpy().view(np.uint64), lo.to_numpy().view(np.uint64)))

        may = listed(*id_keys)
        some, rest = named.where(may), named.where(~may)
    else:  # so many documents lose lines that their filter doesn't fit: all move
        some, rest = named, named.limit(0)

    @F.pandas_udf(_RESULT)
    def keep(text: pd.Series, gone: pd.Series) -> pd.DataFrame:
        made = []
        for t, g in zip(text, gone, strict=True):
            t, drops = (t or "").encode(), {np.array([x["hi"], x["lo"]], np.int64).tobytes() for x in g} if g is not None else set()
            made.append(_result(t, [k in drops for _, k in line_keys(t, min_chars)], want_text))
        return pd.DataFrame(made, columns=["n_lines", "n_dropped", "kept_text", "kept_sha256"])

    # Rows without an id have no references of their own: all their repeated lines go.
    unnamed = cut(whole.where("doc_id is null").withColumn("no", F.monotonically_increasing_id()))
    own = _admitted(references(unnamed.select(F.col("no").alias("doc_id"), "text"), min_chars), filters, shards, filter_bytes, "doc_id")
    own = own.join(repeated.select(*KEY), KEY).groupBy(F.col("doc_id").alias("no")).agg(F.collect_set(F.struct(*KEY)).alias("gone"))
    none = F.lit(None).cast(lists.schema["gone"].dataType).alias("gone")
    both = some.join(lists, "doc_id", "left").select("whole", "text", "gone").unionAll(rest.select("whole", "text", none)).unionAll(unnamed.join(own, "no", "left").select("whole", "text", "gone"))
    return both.select("whole", keep("text", "gone").alias("kept")).select("whole.*", "kept.*")


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, want_text: bool = True, broadcast_bytes: int = BROADCAST_BYTES, shard_keys: int = 500_000, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """docs with n_lines, n_dropped, kept_text (if wanted), kept_sha256; columns of docs by these names are replaced.

    The reference table is counted in full, and filters stand before the exact rows at every size."""
    docs = docs.drop(*[c.split()[0] for c in _RESULT.split(", ")])
    refs = cut(references(docs, min_chars))
    repeated = cut(reference_counts(refs).where(F.col("n_docs") >= min_docs))
    n = repeated.count()
    shards = max(1, -(-n // shard_keys))
    filters = cut(build_filters(repeated, shards))
    if 24 * n <= broadcast_bytes:
        return _drop_by_broadcast(docs, repeated, filters, shards, min_chars, want_text)
    return _drop_by_join(docs, refs, repeated, filters, shards, min_chars, want_text, filter_bytes, shard_keys)


def store_shards(n_docs: int) -> int:
    """Shards of a store that is to hold so many documents."""
    return max(8, -(-n_docs // DOCS_A_SHARD))


class LineStore:
    """The incremental form, kept under a path that outlives the application: logs of references by key, of references by
    document and of counts, each in shards, and a filter for each shard.

    insert() and delete() read and write what they touch: the documents' references, and in the shards of their keys (folders,
    which prune the scan) the rows of these keys alone, picked out before anything is grouped; filters of shards in which a
    key crosses the limit. Inserting an id that the store holds replaces the document. Newer rows of a log hold over
    older ones; `merge_after` parts of one size make one of the next, so a row is rewritten as often as the logarithm of the
    log. A step, of which a replacement is one, is in force once its manifest stands: an update that dies or fails leaves the
    former state, here and for open(), and can be run again. One update runs at a time. vacuum() deletes files that the last
    step doesn't need. Without a path the store lies in the scratch folder and goes with the application. Deleting what was
    inserted restores counts, filters' answers and the result of apply()."""

    LOGS = {
        "refs": "hi long, lo long, doc_id long, sign int",
        "docs": "hi long, lo long, doc_id long, sign int",
        "counts": "hi long, lo long, n_docs long, last_doc long",
        "filters": "filter binary",
    }

    def __init__(self, spark: SparkSession, path: str | None = None, shards: int = 8, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, merge_after: int = 8) -> None:
        self.spark, self.path = spark, (path or f"{scratch_dir(spark)}/line-store-{uuid.uuid4().hex}").rstrip("/")
        if self._steps():
            raise ValueError(f"{self.path} holds a store; use open()")
        self.shards, self.min_chars, self.min_docs, self.merge_after = shards, min_chars, min_docs, max(2, merge_after)
        self._step, self._parts = 0, {log: [] for log in self.LOGS}  # of each log [part, level], oldest first
        self._commit()
        if not path:
            files, at = self._files(self.path)
            files.deleteOnExit(at)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineStore:
        """The store at a path, as its last whole step left it."""
        out = cls.__new__(cls)
        out.spark, out.path = spark, path.rstrip("/")
        steps = out._steps()
        if not steps:
            raise FileNotFoundError(f"no store at {path}")
        said = json.loads(spark.read.text(f"{out.path}/steps/{max(steps)}.json", wholetext=True).first()[0])
        out.shards, out.min_chars, out.min_docs, out.merge_after = (said[c] for c in ("shards", "min_chars", "min_docs", "merge_after"))
        out._step, out._parts = said["step"], said["parts"]
        return out

    def _files(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _steps(self) -> list[int]:
        files, at = self._files(f"{self.path}/steps")
        names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
        return [int(n[:-5]) for n in names if re.fullmatch(r"[0-9]+\.json", n)]

    def _commit(self) -> None:
        said = {"step": self._step, "shards": self.shards, "min_chars": self.min_chars, "min_docs": self.min_docs, "merge_after": self.merge_after, "parts": self._parts}
        files, at = self._files(f"{self.path}/steps/.{self._step}")
        out = files.create(at, True)
        out.write(bytearray(json.dumps(said).encode()))
        out.close()
        _, to = self._files(f"{self.path}/steps/{self._step}.json")
        if not files.rename(at, to):
            raise RuntimeError(f"{to.toString()} can't be written: is another update running?")

    @contextmanager
    def _whole_step(self) -> Iterator[None]:
        """What is written inside comes into force together, or not at all."""
        held = {log: list(parts) for log, parts in self._parts.items()}
        try:
            yield
            self._merge()
            if self._parts != held:
                self._commit()
        except BaseException:
            self._parts = held
            raise

    def _write(self, log: str, rows: DataFrame) -> None:
        """A new part of a log; rows have a shard."""
        self._step += 1
        rows.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(f"{self.path}/{log}/part={self._step}")
        self._parts[log].append([self._step, 0])

    def _log(self, log: str, shards: list[int] | None = None, parts: list[list[int]] | None = None) -> DataFrame:
        """The rows of a log with their shard and part, of some shards only where these are given."""
        schema = f"{self.LOGS[log]}, shard int, part long"
        held = [p for p, _ in (self._parts[log] if parts is None else parts)]
        paths = [f"{self.path}/{log}/part={p}" for p in held]
        if not paths:
            return self.spark.createDataFrame([], schema)
        out = self.spark.read.schema(schema).option("basePath", f"{self.path}/{log}").parquet(*paths)
        return out if shards is None else out.where(F.col("shard").isin(shards))

    def _merge(self) -> None:
        """Parts of one size at a log's end become one of the next."""
        for log, parts in self._parts.items():
            while len(old := self._last_of_a_size(parts)) >= self.merge_after:
                rows = self._log(log, parts=old)
                if log in ("refs", "docs"):
                    rows = rows.groupBy(*KEY, "doc_id", "shard").agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0")
                elif log == "counts":
                    rows = self._newest(rows).where("n_docs > 0" if len(old) == len(parts) else "true")
                else:
                    rows = rows.groupBy("shard").agg(F.max_by("filter", "part").alias("filter"))
                self._write(log, rows)
                parts[-len(old) - 1 :] = [[self._step, old[0][1] + 1]]

    def _last_of_a_size(self, parts: list[list[int]]) -> list[list[int]]:
        n = next((i for i, (_, level) in enumerate(reversed(parts)) if level != parts[-1][1]), len(parts))
        return parts[len(parts) - n :]

    def vacuum(self) -> None:
        """Delete parts that were merged or never came into force, and older manifests. Frames read from the store before
        may need them."""
        for log, parts in self._parts.items():
            files, at = self._files(f"{self.path}/{log}")
            for f in files.listStatus(at) if files.exists(at) else []:
                if f.getPath().getName() not in {f"part={p}" for p, _ in parts}:
                    files.delete(f.getPath(), True)
        for step in sorted(self._steps())[:-1]:
            files, at = self._files(f"{self.path}/steps/{step}.json")
            files.delete(at, False)

    def _live(self, refs: DataFrame) -> DataFrame:
        return refs.groupBy(*KEY, "doc_id").agg(F.sum("sign").alias("n")).where("n > 0").select(*KEY, "doc_id")

    def _newest(self, counts: DataFrame) -> DataFrame:
        newest = F.max(F.struct("part", "n_docs", "last_doc")).alias("c")
        return counts.groupBy(*KEY, "shard").agg(newest).select(*KEY, "shard", "c.n_docs", "c.last_doc")

    def touched_counts(self, keys: DataFrame, shards: list[int]) -> DataFrame:
        """The counts of some keys, read from their shards and picked out before they are grouped."""
        return self._newest(self._log("counts", shards).join(keys.select(*KEY), KEY, "left_semi"))

    def touched_documents(self, doc_ids: DataFrame) -> DataFrame:
        """References of some documents (doc_id, distinct), read from their shards and picked out before they are grouped."""
        hit = doc_ids.select(self._doc_shard().alias("shard")).distinct().collect()  # at most the shards
        return self._live(self._log("docs", [r["shard"] for r in hit]).join(doc_ids, "doc_id", "left_semi"))

    def _doc_shard(self) -> Column:
        return F.pmod(F.xxhash64("doc_id"), F.lit(self.shards)).cast("int")

    def counts(self) -> DataFrame:
        """hi, lo, n_docs, last_doc of every key that a document holds."""
        return self._newest(self._log("counts")).where("n_docs > 0").drop("shard")

    def repeated(self) -> DataFrame:
        return self.counts().where(F.col("n_docs") >= self.min_docs)

    def filters(self) -> DataFrame:
        """shard, filter: the newest of each shard."""
        return self._log("filters").groupBy("shard").agg(F.max_by("filter", "part").alias("filter"))

    def _update(self, delta: DataFrame, sign: int) -> None:
        """delta: distinct references that come or go."""
        delta = cut(delta.select(*KEY, "doc_id", F.lit(sign).cast("int").alias("sign"), shard_of(self.shards).alias("shard")))
        touched = cut(delta.groupBy(*KEY, "shard").agg(F.count("*").alias("n"), F.max("doc_id").alias("top")))
        hit = [r["shard"] for r in touched.select("shard").distinct().collect()]  # at most the shards
        if not hit:
            return
        old = self.touched_counts(touched, hit).drop("shard")
        known = cut(touched.join(old, KEY, "left"))
        self._write("refs", delta)
        self._write("docs", delta.withColumn("shard", self._doc_shard()))
        old_n = F.coalesce("n_docs", F.lit(0))
        if sign > 0:
            last = F.greatest("last_doc", "top")
        else:  # the largest holder is sought anew only where it may have gone
            seek = known.where("last_doc <= top").select(*KEY)
            live = self._live(self._log("refs", hit).join(seek, KEY, "left_semi")).groupBy(*KEY).agg(F.max("doc_id").alias("next"))
            known = known.join(live, KEY, "left")
            last = F.when(F.col("last_doc") <= F.col("top"), F.col("next")).otherwise(F.col("last_doc"))
        new = cut(known.select(*KEY, "shard", old_n.alias("was"), (old_n + sign * F.col("n")).alias("n_docs"), last.alias("last_doc")))
        crossed = cut(new.where((F.col("was") >= self.min_docs) != (F.col("n_docs") >= self.min_docs)).select("shard", *KEY))
        changed = [r["shard"] for r in crossed.select("shard").distinct().collect()]
        self._write("counts", new.select(*KEY, "shard", "n_docs", "last_doc"))
        if changed:
            self._refilter(crossed, changed, sign)

    def _refilter(self, crossed: DataFrame, changed: list[int], sign: int) -> None:
        before = self._log("filters", changed).groupBy("shard").agg(F.max_by("filter", "part").alias("filter"))

        def update(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            cuckoo = CuckooFilter.from_bytes(bytes(left["filter"].iloc[0])) if len(left) else CuckooFilter(2 * len(right))
            (cuckoo.insert if sign > 0 else cuckoo.delete)(*_halves(right))
            full = len(cuckoo.stash) > 0.01 * cuckoo.table.size + 8
            return pd.DataFrame({"shard": [key[0]], "filter": [None if full else cuckoo.to_bytes()]})

        made = cut(before.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(update, "shard int, filter binary"))
        # Those that are full are built anew, with room for as many again.
        full = [r["shard"] for r in made.where("filter is null").select("shard").collect()]
        if full:
            own = self._newest(self._log("counts", full)).where(F.col("n_docs") >= self.min_docs)
            made = made.where("filter is not null").unionAll(build_filters(own, self.shards, 2))
        self._write("filters", made)

    def insert(self, docs: DataFrame) -> None:
        """Documents come in. Of an id that the store holds the former document goes first; rows of one id are one document."""
        refs = cut(references(docs, self.min_chars).distinct())
        ids = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        with self._whole_step():
            self._update(self.touched_documents(ids), -1)
            self._update(refs, 1)

    def delete(self, doc_ids: DataFrame) -> None:
        """Forget the documents; ids that the store doesn't know change nothing."""
        with self._whole_step():
            self._update(self.touched_documents(doc_ids.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()), -1)

    def apply(self, docs: DataFrame, want_text: bool = True, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """docs cut as dedup() cuts them, by what the store holds: a repeated line stays in the largest document of the
        store that has it."""
        docs = docs.drop(*[c.split()[0] for c in _RESULT.split(", ")])
        repeated = cut(self.repeated())
        if 24 * repeated.count() <= broadcast_bytes:
            return _drop_by_broadcast(docs, repeated, self.filters(), self.shards, self.min_chars, want_text)
        return _drop_by_join(docs, references(docs, self.min_chars), repeated, self.filters(), self.shards, self.min_chars, want_text, FILTER_BYTES, 500_000)
