"""Secret scans: candidate spans, and how many owners and repositories share each value.

Spans come from one regular expression per kind. A value that turns up with many owners is a widely
copied example, and so is one in very many repositories of one owner; one that belongs to one or a few
owners, in some repositories, looks live. Values are compared by hash and
counted per (value, owner, repository) first, so a value that everyone copies stays small.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import small
from feedlake.scale import materialise


class Kind(NamedTuple):
    name: str
    pattern: str
    least: int  # characters the value must have
    group: int = 0  # of the pattern: the value
    hints: tuple[str, ...] = ()  # lower-case strings, one of which any match holds


BASE = (
    Kind(
        "assign",
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        6,
        1,
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    Kind("access", "AKIA[A-Z0-9]+", 20, 0, ("akia",)),
    Kind("hex", "[0-9a-f]{24,}", 24),
)
EXTRA = (
    Kind("github", r"gh[pousr]_[A-Za-z0-9]{30,}", 34, 0, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Kind("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15, 0, ("xox",)),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 30, 0, ("eyj",)),
    Kind("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*", 27, 0, ("private key",)),
)
MAX_OWNERS, MAX_REPOSITORIES = 2, 10
_STEP = 256




def _possible(kind: Kind) -> Column:
    """A cheap test that every text with a match passes."""
    if not kind.hints:
        return F.col("text").rlike(kind.pattern)
    hit = F.lit(False)
    for hint in kind.hints:
        hit = hit | F.col("lowered").contains(hint)
    return hit


def _spans(texts: DataFrame, kind: Kind, rank: int) -> DataFrame:
    """Adds an array column named after the kind: (start, rank, end, kind, value) of its matches.

    Starts are the lengths of what lies before a match, summed in steps so that a text with very many
    matches stays cheap.
    """
    names = texts.columns
    texts = texts.withColumn("found", F.when(_possible(kind), F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    some = F.size("found") > 0
    nothing = F.array().cast("array<string>")
    texts = texts.withColumns(
        {
            "pieces": F.when(some, F.split("text", kind.pattern)).otherwise(nothing),
            "values": F.col("found") if kind.group == 0 else F.when(some, F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(kind.group))).otherwise(nothing),
        }
    )
    texts = texts.withColumn("steps", F.expr("transform(found, (m, i) -> length(pieces[i]) + length(m))"))
    texts = texts.withColumn(
        "sums",
        F.expr(f"transform(sequence(0, size(steps) div {_STEP}), b -> aggregate(slice(steps, b * {_STEP} + 1, {_STEP}), 0, (a, x) -> a + x))"),
    )
    texts = texts.withColumn(
        "ends",
        F.expr(
            f"transform(steps, (own, i) -> aggregate(slice(sums, 1, i div {_STEP}), 0, (a, x) -> a + x) + "
            f"aggregate(slice(steps, cast(i div {_STEP} as int) * {_STEP} + 1, i % {_STEP} + 1), 0, (a, x) -> a + x))"
        ),
    )
    return texts.select(
        *names,
        F.expr(
            f"filter(transform(found, (m, i) -> named_struct('start', ends[i] - length(m), 'rank', {rank}, 'end', ends[i], "
            f"'kind', '{kind.name}', 'value', values[i])), x -> length(x.value) >= {kind.least})"
        ).alias(kind.name),
    )


def _scanned(docs: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """(…, base, extra): the spans of the base kinds and of the others; ``docs`` has a column text."""
    texts = docs.withColumns({"text": F.coalesce("text", F.lit("")), "lowered": F.lower("text")})
    for rank, kind in enumerate((*BASE, *kinds)):
        texts = _spans(texts, kind, rank)
    kind = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
    joined = lambda some: F.concat(F.array().cast(kind), *(F.col(k.name) for k in some))
    return texts.select(*docs.columns, *(F.size(k.name).cast("long").alias(f"n_{k.name}") for k in BASE), joined(BASE).alias("base"), joined(kinds).alias("extra"))


def written(spans: str) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _judged(scan: DataFrame, max_owners: int, max_repositories: int) -> DataFrame:
    """(row, start, rank, end, kind, live) of all candidates, by how many owners and repositories have the value."""
    found = scan.select("row", "owner", "repository", F.inline(F.concat("base", "extra"))).withColumn("hash", F.sha2("value", 256))
    copies = found.groupBy("hash", "owner", "repository").agg(F.count("*").alias("times"))
    owners = copies.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("times").alias("times"))
    values = owners.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories"))
    few = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    live = values.select("hash", few.alias("live"), "n_owners", "n_repositories")
    return found.drop("value", "owner", "repository").join(live, "hash")


def _scan(docs: DataFrame, id_col: str, text_col: str, owner: Column, repository: Column, kinds: tuple[Kind, ...]) -> DataFrame:
    docs = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
    )
    docs = docs.withColumns({"t1": F.xxhash64("doc_id", "text"), "t2": F.xxhash64("text", F.lit(1), "doc_id")})
    return materialise(_scanned(docs, kinds).drop("text"))


def _told(scan: DataFrame, max_owners: int, max_repositories: int) -> DataFrame:
    """Per row of the scan that has candidates: live extra spans and counts."""
    found = _judged(scan, max_owners, max_repositories)
    extra = F.col("live") & (F.col("rank") >= len(BASE))
    return found.groupBy("row").agg(
        F.collect_list(F.when(extra, F.struct("start", "rank", "end", "kind", F.lit("").alias("value")))).alias("added"),
        F.count_if(F.col("live")).alias("n_live"),
        F.count_if(~F.col("live")).alias("n_example"),
        F.max("n_owners").alias("most_owners"),
    )


def secret_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
    kinds: tuple[Kind, ...] = EXTRA,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per input row: (doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example).

    Base spans are always listed; spans of ``kinds`` are added where at most ``max_owners`` owners have
    the value, in at most ``max_repositories`` repositories together. ``n_live`` and ``n_example`` count all candidates, base ones too, by that measure.
    ``owner`` and ``repository`` default to the columns ``source`` and ``source/lang`` where they
    exist; null ones are one nameless owner. A null text is empty and has no spans. Repeated rows are
    reported alike; copies with one owner count as one. Starts and ends are code points.
    """
    scan = _scan(docs, id_col, text_col, *_whose(docs, owner, repository), kinds)
    told = _told(scan, max_owners, max_repositories)
    spans = F.concat("base", F.coalesce("added", F.filter("base", lambda s: F.lit(False))))
    zero = F.lit(0).cast("long")
    return (
        scan.join(told, "row", "left")
        .withColumn("all", spans)
        .select(
            "doc_id",
            *(f"n_{k.name}" for k in BASE),
            F.sha2(written("base"), 256).alias("base_sha256"),
            written("all").alias("spans"),
            F.coalesce("n_live", zero).alias("n_live"),
            F.coalesce("n_example", zero).alias("n_example"),
        )
    )


def _whose(docs: DataFrame, owner: Column | None, repository: Column | None) -> tuple[Column, Column]:
    parts = [F.col(c) for c in ("source", "lang") if c in docs.columns]
    owner = owner if owner is not None else parts[0] if "source" in docs.columns else F.lit("")
    return owner, repository if repository is not None else F.concat_ws("/", *parts) if parts else F.lit("")


def masked(
    docs: DataFrame,
    mask: str = "[secret]",
    id_col: str = "doc_id",
    text_col: str = "text",
    kinds: tuple[Kind, ...] = EXTRA,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """``docs`` with every base span and every live span of ``kinds`` in the text replaced by ``mask``.

    All columns stay, ``n_chars`` (if there) follows the new text; rows without spans are untouched,
    null texts stay null.
    """
    scan = _scan(docs, id_col, text_col, *_whose(docs, None, None), kinds)
    spans = scan.where("size(base) > 0 or size(extra) > 0").join(_told(scan, max_owners, max_repositories), "row")
    spans = spans.select("t1", "t2", F.sort_array(F.concat("base", "added")).alias("spans")).where("size(spans) > 0")
    merged = F.expr(
        "aggregate(spans, cast(array() as array<struct<start:int,end:int>>), (out, s) -> "
        "if(size(out) > 0 and s.start <= element_at(out, -1).end, "
        "concat(slice(out, 1, size(out) - 1), array(named_struct('start', element_at(out, -1).start, 'end', greatest(element_at(out, -1).end, s.end)))), "
        "concat(out, array(named_struct('start', s.start, 'end', s.end)))))"
    )
    spans = materialise(spans.select("t1", "t2", merged.alias("spans")).dropDuplicates(["t1", "t2"]))
    names = docs.columns
    text = f"row.`{text_col}`"
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.xxhash64(id_col, text_col).alias("t1"), F.xxhash64(text_col, F.lit(1), id_col).alias("t2"))
    rows = rows.join(small(spans), ["t1", "t2"], "left")
    clean = F.expr(
        f"if(spans is null, {text}, concat(array_join(transform(spans, (s, i) -> concat(substring({text}, "
        f"if(i = 0, 0, spans[i - 1].end) + 1, s.start - if(i = 0, 0, spans[i - 1].end)), '{mask}')), ''), "
        f"substring({text}, element_at(spans, -1).end + 1)))"
    )
    out = rows.select("row", clean.alias("clean"))
    new = {text_col: F.col("clean")} | ({"n_chars": F.when(F.col("clean").eqNullSafe(F.col(text)), F.col("row.n_chars")).otherwise(F.length("clean"))} if "n_chars" in names else {})
    return out.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in names))
