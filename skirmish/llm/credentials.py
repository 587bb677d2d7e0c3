"""Secret scans with corpus-wide ownership frequency, in DataFrame functions alone.

Candidates are found in every whole text; the hash of each candidate's value is then counted over distinct
repositories and owners. A value that many owners hold, or many repositories of more than one owner, is a copied example;
one that few hold and that looks random is a live credential, in however many repositories of its owner. The frequencies also bring in spans that no pattern names: bare random-looking tokens, if they belong
to few owners and lie outside the base spans.

Null text is the empty text. A null repository or owner counts as one of its own, apart
from an empty one. Repeated rows each keep their own
result; rows are told apart by a row number that is written down once. Columns beside the four named ones are ignored.
Positions are in code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skirmish.llm.common import cut

#: kind: pattern, group of the value, least length of the value, in the order that breaks ties between equal starts.
#: Where a match is a run of one class, the least length is in the pattern: a shorter run matches nowhere within itself.
KINDS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "bare": (r"[A-Za-z0-9+_-]{20,}", 0, 20),
}
BASE = ("assign", "access", "hex")
ORDER = {kind: i for i, kind in enumerate(KINDS)}


def _sections(kind: str, text: Column) -> Column:
    """Matches of a kind with the length of what lies between each and the one before."""
    pattern = KINDS[kind][0]
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.transform(F.arrays_zip(gaps.alias("gap"), matches.alias("match")), lambda x: F.struct(F.lit(ORDER[kind]).alias("kind"), x["gap"].alias("gap"), x["match"].alias("match")))
    return F.when(text.rlike(pattern), zipped).otherwise(F.array().cast("array<struct<kind:int,gap:int,match:string>>"))


def candidates(docs: DataFrame, repo: str = "source", owner: str = "source") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every row with a row number; every candidate with its position and value.

    The texts are read once; what is written holds ids and matches only."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = F.concat(*[_sections(kind, text) for kind in KINDS])
    rows = cut(docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long"), F.col(repo).cast("string").alias("repo"), F.col(owner).cast("string").alias("owner"), found.alias("found")))
    each = rows.where(F.size("found") > 0).select("row_no", "doc_id", "repo", "owner", F.posexplode("found").alias("at", "hit")).select("row_no", "doc_id", "repo", "owner", "at", "hit.*")
    line = Window.partitionBy("row_no", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.length(F.coalesce("match", F.lit("")))).over(line.rowsBetween(Window.unboundedPreceding, 0))
    value = F.when(F.col("kind") == ORDER["assign"], F.regexp_extract("match", KINDS["assign"][0], 2)).otherwise(F.col("match"))
    least = F.element_at(F.lit([n for _, _, n in KINDS.values()]), F.col("kind") + 1)
    spans = each.withColumn("end", end.cast("long")).where("match is not null").withColumn("value", value).where(F.length("value") >= least)
    return rows, spans.withColumn("start", F.col("end") - F.length("match")).select("row_no", "doc_id", "repo", "owner", "kind", "start", "end", "value")


def looks_random(value: Column) -> Column:
    """Letters and digits mixed, at least three digits and eight different characters."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return (digits >= 3) & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 8)


def ownership(spans: DataFrame) -> DataFrame:
    """How many repositories and owners hold each value. The first grouping leaves one row for each holder and value,
    summed before the shuffle, so that a value in a third of all rows is as small as any other."""
    holder = spans.groupBy(F.sha2("value", 256).alias("value_hash"), F.struct("repo").alias("repo"), F.struct("owner").alias("owner")).agg(F.count("*").alias("n"))
    return holder.groupBy("value_hash").agg(F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"), F.sum("n").alias("n_seen"))


def scan(docs: DataFrame, repo: str = "source", owner: str = "source", example_owners: int = 4, example_repos: int = 10, bare_owners: int = 2) -> tuple[DataFrame, DataFrame]:
    """(rows, spans), where each span carries its ownership and a verdict: `example` from `example_owners` owners on, or
    from `example_repos` repositories on if they aren't one owner's, else `live` if it looks random, else `weak`. Bare tokens stay only if they look random, have at most `bare_owners`
    owners and overlap no base span of their row."""
    rows, spans = candidates(docs, repo, owner)
    # Of the bare tokens, those that can't be credentials go before anything is counted.
    spans = spans.where((F.col("kind") != ORDER["bare"]) | looks_random(F.col("value")))
    earlier = Window.partitionBy("row_no").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("row_no").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("kind") != ORDER["bare"]
    covered = (F.coalesce(F.max(F.when(base, F.col("end"))).over(earlier), F.lit(-1)) > F.col("start")) | (F.coalesce(F.min(F.when(base, F.col("start"))).over(later), F.lit(2**40)) < F.col("end"))
    spans = cut(spans.withColumn("covered", covered).where(base | ~F.col("covered")).drop("covered").withColumn("value_hash", F.sha2("value", 256)))
    known = spans.join(ownership(spans), "value_hash", "left")
    copied = (F.col("n_owners") >= example_owners) | ((F.col("n_repos") >= example_repos) & (F.col("n_owners") > 1))
    verdict = F.when(copied, "example").when(looks_random(F.col("value")), "live").otherwise("weak")
    name = F.element_at(F.lit(list(KINDS)), F.col("kind") + 1)
    return rows, known.where(base | (F.col("n_owners") <= bare_owners)).withColumn("verdict", verdict).withColumn("kind_name", name)


def digest(docs: DataFrame, repo: str = "source", owner: str = "source") -> DataFrame:
    """One row for each row of docs: numbers of base spans, the digest of base spans, all spans, verdicts."""
    rows, spans = scan(docs, repo, owner)
    base = F.col("kind") != ORDER["bare"]
    item = F.struct("start", "kind", F.concat_ws(":", "kind_name", "start", "end").alias("said"))

    def joined(which: Column) -> Column:
        return F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.when(which, item))), lambda x: x["said"]))

    def number(which: Column) -> Column:
        return F.count_if(which)

    held = spans.groupBy("row_no").agg(
        *[number(F.col("kind") == ORDER[k]).alias(f"n_{k}") for k in KINDS],
        joined(base).alias("base"), joined(F.lit(True)).alias("spans"),
        *[number(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "example", "weak")],
    )
    counts = [f"n_{k}" for k in (*KINDS, "live", "example", "weak")]
    shape = rows.select("row_no", "doc_id", (F.size("found") > 0).alias("has"))
    with_spans = shape.where("has").join(held, "row_no", "left")
    without = shape.where("not has").select("*", *[F.lit(0).cast("long").alias(c) for c in counts], F.lit("").alias("base"), F.lit("").alias("spans"))
    out = with_spans.select("row_no", "doc_id", "has", *counts, "base", "spans").unionByName(without)
    return out.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
