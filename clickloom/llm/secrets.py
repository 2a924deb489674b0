"""Secret scans with corpus-wide ownership, in DataFrame and SQL functions only.

Candidates are found by pattern in whole texts. Their values are hashed and counted over
the corpus by distinct repositories and distinct owners: a value that several owners have,
or one owner in many repositories, is a copied example; another value of one owner that
looks random is live-looking. Patterns of
well-known shapes always count; a plain long token counts only if it is live-looking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.joins import lookup
from clickloom.session import stage, with_row_id

# The base patterns and the least length of what they find.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "token")
ASSIGN_LEAST = 12

#: A run of token characters that is no part of a longer one.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+"
EXAMPLE_OWNERS = 2  # a value of so many owners is an example
EXAMPLE_REPOSITORIES = 20  # and one of so many repositories, even of one owner
DISTINCT_CHARS = 8  # a live-looking value has at least so many different characters

_SPAN = "array<struct<start:int,end:int,value:string>>"


def spans(text: str, pattern: str) -> Column:
    """All leftmost non-overlapping matches of `pattern`: start, end (code points), match.

    The pieces between matches and the matches themselves give the places, so texts are
    scanned whole and only by built-in functions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(
        found, F.slice(gaps, F.lit(1), F.size(found)),
        lambda hit, gap: F.struct(hit.alias("hit"), F.length(gap).alias("gap")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + pair["gap"]
        end = begin + F.length(pair["hit"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["hit"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pairs, start, step, lambda state: state["spans"])


def candidates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", owner: str = "source") -> DataFrame:
    """Per document: `_row`, `doc_id`, owner, and `found`, its candidates of every kind."""
    rows = with_row_id(docs.select(
        F.col(id_col).alias("doc_id"), F.col(owner).cast("string").alias("_owner"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"),
    ))
    scanned = rows.select(
        "_row", "doc_id", "_owner",
        *(spans("_text", p).alias(k) for k, p in zip(KINDS, (ASSIGN, ACCESS, HEX, TOKEN), strict=True)),
    )

    def value(kind: str, hit: Column) -> Column:
        return F.regexp_extract(hit, ASSIGN, 2) if kind == "assign" else hit

    def kept(kind: str, v: Column) -> Column:
        if kind == "assign":
            return F.length(v) >= ASSIGN_LEAST
        if kind == "token":
            return v.rlike("[a-z]") & v.rlike("[A-Z]") & v.rlike("[0-9]")
        return F.lit(True)

    def listed(order: int, kind: str) -> Column:
        made = F.transform(kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("kind"), s["end"].alias("end"),
            value(kind, s["value"]).alias("value"),
        ))
        return F.filter(made, lambda s: kept(kind, s["value"]))

    lists = [listed(order, kind) for order, kind in enumerate(KINDS)]
    return scanned.select("_row", "doc_id", "_owner", F.concat(*lists).alias("found"))


def ownership(found: DataFrame) -> DataFrame:
    """`_hash`, `owners`, `repositories`: distinct counts over the whole corpus.

    Repeats collapse before they are counted, level by level, so a value that a third of
    all rows hold leaves every task once per owner and repository.
    """
    return (
        found.groupBy("_hash", "_owner", "_repository").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("_hash", "_owner").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("_hash").agg(
            F.count(F.lit(1)).alias("owners"), F.sum("_n").alias("repositories")
        )
    )


def scan_secrets(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", owner: str = "source",
    repository: str | None = None,
) -> DataFrame:
    """One row per document: `_row`, `doc_id`, `findings` sorted by start, then kind.

    A finding has start, end (code points, end exclusive), kind, owners, repositories and
    verdict: `example`, `live` or `plain` (one owner, but not random-looking). Without a
    repository column a document is a repository. A null owner is one unknown owner. Null
    and empty texts have no findings; repeated rows are documents of their own, yet count
    once for ownership. An empty table gives an empty result.
    """
    with_repo = docs if repository is None else docs.withColumn(id_col, F.col(repository))
    rows = stage(candidates(docs, text, id_col, owner), "candidates")
    hits = rows.where(F.size("found") > 0)
    if repository is not None:
        repos = with_row_id(with_repo.select(F.col(id_col).alias("_repository")))
        hits = hits.join(repos, "_row")
    else:
        hits = hits.withColumn("_repository", F.col("doc_id"))
    flat = hits.select("_row", "_owner", "_repository", F.explode("found").alias("f")).select(
        "_row", "_owner", "_repository", "f.start", "f.kind", "f.end",
        F.sha2(F.col("f.value").cast("binary"), 256).alias("_hash"),
        F.size(F.array_distinct(F.split("f.value", ""))).alias("_distinct"),
    )
    judged = lookup(flat, ownership(flat), "_hash").select(
        "_row",
        F.struct(
            "start", "kind", "end", "owners", "repositories",
            F.when(
                (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES), "example"
            ).when(F.col("_distinct") >= DISTINCT_CHARS, "live").otherwise("plain").alias("verdict"),
        ).alias("f"),
    )
    listed = judged.groupBy("_row").agg(F.array_sort(F.collect_list("f")).alias("findings"))
    return rows.select("_row", "doc_id").join(listed, "_row", "left")


def span_text(findings: Column, wanted) -> Column:
    """`kind:start:end`, comma-joined, of the findings that `wanted` accepts."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.filter(findings, wanted),
            lambda f: F.concat_ws(":", F.element_at(names, f["kind"] + 1), f["start"], f["end"]),
        ), ",",
    )
