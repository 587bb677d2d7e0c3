"""Small document tables with the odd cases: nulls, empty and long texts, ties, repeats, clashing columns."""

import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the quick brown fox jumps over a lazy dog while seven silver ships sail past quiet northern harbours under pale morning light".split()


def mod5(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def prose(seed, n):
    x, out = seed * 7919 + 1, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


def odd_documents():
    shared = "This very line stands in several documents of the table."
    texts = [None, "", " \n\t ", "word", prose(1, 60), prose(1, 60), prose(1, 60).upper(), f"{shared}\n{prose(2, 30)}", f"  {shared.upper()}\n{prose(3, 30)}\n{shared}", f"{prose(4, 30)}\n{shared}\t", "Été à Łódź, 東京 😀 naïve\n" * 3, prose(5, 9000), "x" * 5000, "a\x1cb\x85c d", "l'été isn't <|endoftext|> o'clock"]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[7], (None, texts[7], "en", "s1", None), (None, None, None, None, None), (99, texts[4], "fr", "s2", 1)]


def clashing(spark, rows):
    """The documents with more columns, named as the operators' own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS)
    names = ["row_no", "key", "no", "block", "row", "part", "rank", "length", "score", "kept_text", "n_lines", "stays", "n", "fp", "start", "item_id", "rest", "lang_pred", "salt"]
    return df.withColumns({n: F.lit(i) for i, n in enumerate(names)})


def empty(spark):
    return spark.createDataFrame([], DOCS)
