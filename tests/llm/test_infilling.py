import re
from hashlib import sha256

import pytest
from helpers import DOCS, clashing, empty, odd_documents
from hypothesis import given
from hypothesis import strategies as st

from skirmish.llm.infilling import Infilling, Scanner, digest, restore, transform

PATTERNS = {"line": r"[^\n]*\n|[^\n]+", "word": r"[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+", "char": r"(?s:.)"}


def brute(doc_id, text, how=Infilling()):
    """(units, form, prefix, middle, output), by splitting the text."""
    units = re.findall(PATTERNS[how.unit], text or "")
    drawn = sha256(f"{how.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(drawn[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= how.rate:
        return len(units), "plain", None, None, text or ""
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < how.spm_rate
    return len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


HARD = ["<", "<P", "a<P>b", "<<S>", "x\n<M", "\n", "\n\n", "a\n", "a\nb", "\r\nz\r", " a", "a ", "  ", "é 😀\n<S", "<P\n>", "a<M>"]


@pytest.mark.parametrize("how", [Infilling(), Infilling("word", 3, 70, 20), Infilling("char", 11, 100, 50)])
def test_is_brute_force(spark, how):
    rows = odd_documents() + [(1000 + i, t, None, None, 0) for i, t in enumerate(HARD * 3)]
    got = transform(clashing(spark, rows).repartition(3), how).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *brute(i, t, how))) for i, t, *_ in rows)
    texts = {(r["doc_id"], r["output"]): restore(r["output"], r["form"]) for r in got}
    assert all(texts[i, brute(i, t, how)[-1]] == (t or "") for i, t, *_ in rows)


@given(st.integers(), st.text(alphabet="<PSM>\n a\té\U0001f600", max_size=40), st.sampled_from(sorted(PATTERNS)))
def test_any_text_comes_back(doc_id, text, unit):
    how = Infilling(unit)
    made = how.arrange(Scanner(unit), doc_id, text)
    assert made == brute(doc_id, text, how) and restore(made[-1], made[1]) == text


def test_long_text_of_many_breaks():
    text = "ab\n" * 300_000 + "<" * 1000
    made = Infilling().arrange(Scanner("line"), 5, text)
    assert made == brute(5, text) and restore(made[-1], made[1]) == text


def test_digest_against_sql(spark):
    import duckdb

    from skirmish.llm.queries import ORACLE_SQL

    rows = odd_documents() + [(1000 + i, t, None, None, 0) for i, t in enumerate(HARD)]
    docs = spark.createDataFrame(rows, DOCS)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    got = digest(docs)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['op11_infilling']})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert all(r["restored_sha256"] == sha256((t or "").encode()).hexdigest() for r in got.collect() for i, t, *_ in rows if i == r["doc_id"] and [x for x, *_ in rows].count(i) == 1)


def test_empty(spark):
    assert digest(empty(spark)).count() == transform(empty(spark)).count() == 0
