import hashlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import clashing, empty, odd_documents, prose

from skirmish.llm import line_dedup
from skirmish.llm.line_dedup import CuckooFilter, Exact, LineStore, dedup

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows):
    held = defaultdict(set)
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20 and doc is not None:
                held[key(line)].add(doc)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < 3 or max(held[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=repr)


@pytest.mark.parametrize(("broadcast_bytes", "filter_bytes"), [(64 << 20, 64 << 20), (0, 64 << 20), (0, 1)])
def test_brute_force_every_way(spark, broadcast_bytes, filter_bytes):
    rows = odd_documents()
    assert any(r[2] for r in brute(rows))
    docs = clashing(spark, rows).selectExpr("*", "1 AS gone", "2 AS whole", "3 AS hi", "4 AS kept", "5 AS kept_sha256")
    out = dedup(docs, broadcast_bytes=broadcast_bytes, filter_bytes=filter_bytes, shard_keys=1)
    made = ["n_lines", "n_dropped", "kept_text", "kept_sha256"]
    assert result(out) == brute(rows) and out.columns == [c for c in docs.columns if c not in made] + made
    assert {r[0] for r in out.select("whole").collect()} == {2}


def test_exact_rows_with_equal_halves():
    import pyarrow as pa

    exact = Exact(pa.table({"hi": [5, 5, 5, -1, 9], "lo": [1, 2, 3, 4, 5], "last_doc": [10, 11, 12, 13, 14]}))
    find = exact.find(np.array([5, 5, 5, 2**64 - 1, 9, 9, 0], np.uint64), np.array([3, 1, 7, 4, 5, 6, 0], np.uint64))
    assert [exact.last[i] if i >= 0 else None for i in find] == [12, 10, None, 13, 14, None, None]


def test_kept_text(spark):
    rows = [(i, f"A line that all three of them hold \t\nown {i}") for i in range(3)]
    got = {r["doc_id"]: r["kept_text"] for r in dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: "own 0", 1: "own 1", 2: rows[2][1]}


def test_tables_against_sql(spark, duck):
    from skirmish.llm.queries import ORACLE_SQL, QUERIES

    want = sorted(map(tuple, duck.sql("SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM (" + ORACLE_SQL["op4_line_dedup"] + ")").fetchall()), key=repr)
    assert result(QUERIES["op4_line_dedup"](spark, "/root/testdata/sf0.001")) == want


def test_empty(spark):
    assert dedup(empty(spark)).count() == 0


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**64, (20_000, 2), np.uint64)
    inside, outside = keys[:8000], keys[8000:]
    f = CuckooFilter(8000)
    f.insert(inside[:, 0], inside[:, 1])
    assert f.contains(inside[:, 0], inside[:, 1]).all()
    assert f.contains(outside[:, 0], outside[:, 1]).mean() < 0.002
    again = CuckooFilter.from_bytes(f.to_bytes())
    again.delete(inside[:4000, 0], inside[:4000, 1])
    assert again.contains(inside[4000:, 0], inside[4000:, 1]).all()
    assert again.contains(inside[:4000, 0], inside[:4000, 1]).mean() < 0.002
    tiny = CuckooFilter(1)
    tiny.insert(inside[:40, 0], inside[:40, 1])
    assert tiny.contains(inside[:40, 0], inside[:40, 1]).all(), "what finds no room is stashed"


def test_store_is_reversible(spark):
    lines = [f"a line of text that is number {i:04d}" for i in range(40)]
    docs = [(d, "\n".join(lines[d : d + 12])) for d in range(20)]
    df = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    store = LineStore(spark, shards=2, merge_after=2)

    def state():
        return sorted(map(tuple, store.counts().collect())), sorted(map(tuple, store.repeated().select("hi", "lo").collect())), result(store.apply(df(docs))), result(store.apply(df(docs), broadcast_bytes=0))

    def holds(inside):  # as if only these had ever been inserted
        counts, _, cut_, joined = state()
        assert cut_ == joined
        assert [r for r in cut_ if r[0] in inside] == brute([docs[d] for d in sorted(inside)])
        want = sorted(map(tuple, line_dedup.reference_counts(line_dedup.references(df([docs[d] for d in inside]))).collect()))
        assert counts == want

    store.insert(df(docs[:12]))
    before = state()
    holds(set(range(12)))
    store.insert(df(docs[12:]))
    holds(set(range(20)))
    assert len(state()[1]) > len(before[1])
    store.delete(df(docs[12:]).select("doc_id"))
    assert state() == before
    store.delete(df([(11, ""), (3, ""), (777, "")]).select("doc_id"))
    holds(set(range(12)) - {3, 11})
    store.insert(df([docs[3], docs[11]]))
    assert state() == before
    filters = {r["shard"]: CuckooFilter.from_bytes(bytes(r["filter"])) for r in store.filters().collect()}
    repeated = store.counts().withColumn("shard", line_dedup.shard_of(2)).toPandas()
    for shard, f in filters.items():
        own = repeated[repeated["shard"] == shard]
        got = f.contains(own["hi"].to_numpy().view(np.uint64), own["lo"].to_numpy().view(np.uint64))
        assert got[own["n_docs"].to_numpy() >= 3].all() and got[own["n_docs"].to_numpy() < 3].sum() <= 1


def test_store_touches_what_changes(spark):
    df = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    store = LineStore(spark, shards=64)
    store.insert(df([(d, "\n".join(f"line {i:04d} of a common text" for i in range(300))) for d in range(4)]))
    blobs = lambda: {r["shard"]: bytes(r["filter"]) for r in store.filters().collect()}
    rows = lambda log, n=1: store._log(log, parts=store._parts[log][-n:]).count()
    filters, parts = blobs(), {log: list(p) for log, p in store._parts.items()}
    store.insert(df([(9, "line 0007 of a common text\none that is new to the store"), (10, "too short")]))
    assert all(store._parts[log][:-1] == parts[log] and rows(log) == 2 for log in ("refs", "docs", "counts"))
    assert blobs() == filters and store._parts["filters"] == parts["filters"]
    store.insert(df([(11, "one that is new to the store"), (12, "one that is new to the store")]))
    assert rows("filters") == 1 and sum(blobs()[s] != b for s, b in filters.items()) <= 1 and store.repeated().count() == 301


def test_store_reads_what_it_touches(spark):
    """Scans of an update are pruned to the shards at hand, and rows are picked out before they are grouped."""
    df = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    store = LineStore(spark, shards=32)
    store.insert(df([(d, "\n".join(f"line {i:04d} of a common text" for i in range(200))) for d in range(3)]))
    keys = line_dedup.references(df([(9, "line 0007 of a common text")])).withColumn("shard", line_dedup.shard_of(32))
    hit = [r["shard"] for r in keys.select("shard").collect()]
    for made, n in ((store.touched_counts(keys, hit), 1), (store.touched_documents(df([(1, "")]).select("doc_id")), 200)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Aggregate") < plan.index("LeftSemi") < plan.index("Relation") and plan.count("Aggregate") == 1
        scan = made._jdf.queryExecution().executedPlan().toString()
        assert "shard#" in scan.split("PartitionFilters: [")[1].split("]")[0]
        assert made.count() == n
        assert len(made.inputFiles()) < 200  # files of all 32 shards at most; pruned when read


def test_store_replaces_and_is_reopened(spark, tmp_path):
    """An id inserted again replaces its document; another application finds the store by its path; a step that died counts
    for nothing."""
    df = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    lines = [f"a line of text that is number {i:04d}" for i in range(9)]
    path = f"file://{tmp_path}/store"
    store = LineStore(spark, path, shards=4, merge_after=3)
    store.insert(df([(1, lines[0]), (2, lines[0])]))
    store.insert(df([(1, f"{lines[0]}\n{lines[1]}"), (1, lines[2])]))
    assert sorted((r["n_docs"], r["last_doc"]) for r in store.counts().collect()) == [(1, 1), (1, 1), (2, 2)] and store.repeated().count() == 0
    docs = [(d, "\n".join(lines[d % 4 : d % 4 + 4])) for d in range(1, 9)]
    store.insert(df(docs[:5]))
    again = LineStore.open(spark, path)
    assert (again.shards, again.merge_after) == (4, 3)
    again._write("counts", again._log("counts"))  # an update that dies before its manifest
    again = LineStore.open(spark, path)
    again.insert(df(docs[3:]))
    again.delete(df([(2, ""), (6, "")]).select("doc_id"))
    left = [d for d in docs if d[0] not in (2, 6)]
    assert result(again.apply(df(left))) == brute(left) == result(dedup(df(left)))
    assert max(len(p) for p in again._parts.values()) <= 6
    with pytest.raises(ValueError, match="open"):
        LineStore(spark, path)
    with pytest.raises(FileNotFoundError):
        LineStore.open(spark, f"{path}-not")


def test_store_step_that_fails_can_be_run_again(spark, tmp_path, monkeypatch):
    """A replacement is one step: where a write of it fails, the store is as before, here and when opened, and takes it anew.
    Parts of one size are merged however many a step writes, so none is left behind between larger ones."""
    df = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    lines = [f"a line of text that is number {i:04d}" for i in range(9)]
    path = f"file://{tmp_path}/store"
    store = LineStore(spark, path, shards=2, merge_after=2)
    store.insert(df([(d, lines[0]) for d in range(4)]))
    said = lambda s: sorted(map(tuple, s.counts().collect()))
    before, write = said(store), LineStore._write
    new = df([(1, f"{lines[1]}\n{lines[2]}"), (2, lines[1]), (5, lines[1])])
    for dies_at in (2, 6):
        writes = []

        def fails(self, log, rows, writes=writes, dies_at=dies_at):
            writes.append(log)
            write(self, log, rows)
            if len(writes) == dies_at:
                raise OSError("lost")

        monkeypatch.setattr(LineStore, "_write", fails)
        with pytest.raises(OSError, match="lost"):
            store.insert(new)
        monkeypatch.undo()
        assert said(store) == before == said(LineStore.open(spark, path))
    store.insert(new)
    for parts in store._parts.values():
        levels = [level for _, level in parts]
        assert levels == sorted(set(levels), reverse=True)
    docs = [(0, lines[0]), (1, f"{lines[1]}\n{lines[2]}"), (2, lines[1]), (3, lines[0]), (5, lines[1])]
    assert result(store.apply(df(docs))) == brute(docs)
    store.vacuum()
    assert [f.name for f in (tmp_path / "store" / "steps").glob("*.json")] == [f"{store._step}.json"]
    assert {f.name for f in (tmp_path / "store" / "counts").glob("part=*")} == {f"part={p}" for p, _ in store._parts["counts"]}
    assert result(LineStore.open(spark, path).apply(df(docs))) == brute(docs)


def test_takedowns_against_sql(spark, duck):
    from skirmish.llm.queries import ORACLE_SQL, QUERIES

    want = sorted(map(tuple, duck.sql("SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM (" + ORACLE_SQL["line_store_takedowns"] + ")").fetchall()), key=repr)
    assert result(QUERIES["line_store_takedowns"](spark, "/root/testdata/sf0.001")) == want


def test_references_meet_their_filter_in_parts(spark, monkeypatch):
    """Filters that aren't sent: references are dealt to their shard, a shard's in several parts, and all hits come."""
    monkeypatch.setattr(line_dedup, "PART_ROWS", 40)
    common = "the line that a third of all documents hold"
    docs = [(d, f"{common}\n{prose(d, 9)}\nshared by three of them {d // 3:05d}") for d in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    refs = line_dedup.references(df)
    repeated = line_dedup.reference_counts(refs).where("n_docs >= 3")
    filters = line_dedup.build_filters(repeated, 3)
    sent, dealt = (sorted(map(tuple, line_dedup._admitted(refs, filters, 3, limit, "doc_id").collect())) for limit in (1 << 20, 0))
    assert sent == dealt and len(sent) >= 600
    plan = line_dedup._admitted(refs, filters, 3, 0, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroups") == 1
    assert result(dedup(df, broadcast_bytes=0, filter_bytes=0, shard_keys=50)) == result(dedup(df)) == brute(docs)
