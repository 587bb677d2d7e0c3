import hashlib
import re

from helpers import DOCS, clashing, empty, odd_documents

from skirmish.llm.credentials import digest, scan

BASE = [
    ("assign", re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 1, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]


def base_spans(text):
    found = [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for i, (kind, p, g, least) in enumerate(BASE) for m in p.finditer(text or "") if len(m[g]) >= least]
    return [s for *_, s in sorted(found)], [sum(i == k for _, i, _ in found) for k in range(3)]


HEX, KEY, BARE = "0123456789abcdef" * 2, "AKIA" + "Q7" * 10, "Zx9Qw8Er7Ty6Ui5Op4As3"
CASES = [f"é😀 Password = \"{HEX}\" then {KEY}", "token:short token=exactly6 TOKEN: '' secret='a.b/c=d+e'", f"{KEY}{KEY} AKIA AKIAAKIA", f"api_key={HEX}\napikey : x1y2z3", f"seen {BARE} here", f"password={BARE}", HEX[:23], "ſecret=abcdefg toKen=abcdefg", f"a {HEX}{HEX}g{HEX}", None, ""]


def test_base_spans_are_brute_force(spark):
    rows = [(i, t, None, f"s{i}", 0) for i, t in enumerate(CASES)] + [(100 + i, *r[1:]) for i, r in enumerate(odd_documents())]
    got = {r["doc_id"]: r for r in digest(clashing(spark, rows)).collect()}
    assert len(got) == len(rows)
    for doc, text, *_ in rows:
        spans, counts = base_spans(text)
        r = got[doc]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts, text
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), text
        assert [s for s in r["spans"].split(",") if s and not s.startswith("bare")] == spans
    at = CASES[4].index(BARE)
    assert got[4]["spans"] == f"bare:{at}:{at + len(BARE)}"


def test_ownership_parts_examples_from_live_ones(spark):
    rows = [(i, f"password={HEX}", None, f"s{i}", 0) for i in range(6)] + [(9, "password=9f8e7d6c5b4a39281", None, "s1", 0), (10, "password=changeme", None, "s1", 0)]
    rows += [(20 + i, f"x {BARE} y", None, f"s{i}", 0) for i in range(5)]
    _, spans = scan(spark.createDataFrame(rows, DOCS))
    got = {(r["doc_id"], r["kind_name"]): (r["verdict"], r["n_owners"], r["n_seen"]) for r in spans.collect()}
    assert got[0, "assign"] == ("example", 6, 12) and got[9, "assign"][0] == "live" and got[10, "assign"][0] == "weak"
    assert not any(kind == "bare" for _, kind in got), "a bare token with five owners is no credential"


def test_repositories_and_empty_owners_count(spark):
    """One owner's value in many repositories is live; of two owners it is an example. Null, '' and a name are three."""
    own = [(i, f"password={HEX}", f"repo{i}", "ann") for i in range(12)]
    two = [(50 + i, f"token={HEX[::-1]}", f"repo{i}", "ann" if i else "bob") for i in range(12)]
    few = [(80 + i, f"secret=q{HEX}7", repo, owner) for i, (repo, owner) in enumerate([(None, None), ("", ""), ("a", "a"), (None, None), ("", "")])]
    df = spark.createDataFrame(own + two + few, "doc_id long, text string, repo string, owner string")
    _, spans = scan(df, "repo", "owner")
    got = {r["doc_id"]: (r["verdict"], r["n_repos"], r["n_owners"], r["n_seen"]) for r in spans.where("kind_name = 'assign'").collect()}
    assert got[0][:3] == ("live", 12, 1) and got[50][:3] == ("example", 12, 2) and got[80] == ("live", 3, 3, 5)
    assert {r[0] for d, r in got.items() if d >= 50 and d < 80} == {"example"}


def test_planted_owners_against_sql(spark):
    """Copied and owner-specific values in the documents, by the query's SQL."""
    import duckdb

    from skirmish.llm.queries import ORACLE_SQL

    texts = [f"password={HEX} x", f"see {BARE} end", f"token = '{KEY}'", "api_key: short12 secret=zzzzzz", f"{HEX} {BARE}{BARE}", None, "", BARE]
    rows = [(i, texts[i % len(texts)], None, [None, "", "a", "b", "c"][(i // 8) % (1 + i % 5)], 0) for i in range(160)] + [(500, f"mine {BARE[::-1]} only", None, "c", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    got = digest(docs)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['op3_secrets']})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert {r["n_example"] for r in got.collect()} >= {0, 1} and any("bare" in r["spans"] for r in got.collect())


def test_repeated_rows_and_nulls(spark):
    rows = [(1, f"token={HEX}", None, None, 0)] * 3 + [(None, f"token={HEX}", None, None, 0)]
    got = digest(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 4 and len({tuple(r)[1:] for r in got}) == 1 and got[0]["n_assign"] == got[0]["n_hex"] == 1


def test_empty(spark):
    assert digest(empty(spark)).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = digest(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
