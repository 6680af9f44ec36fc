"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duoscope.llm.common import stored

# What counts as a candidate, in the order of kinds.
KINDS = ("assign", "access", "hex", "token")
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LENGTH = 12
# Whole runs of these lengths are the same spans as whole runs filtered by length.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9_-]{20,}"

#: A value held by at most so many owners is theirs; a more common one is an example.
MAX_OWNERS = 2
#: A value in so many of an owner's repositories, and in more than half of them, is an example as well.
MIN_REPOS = 3
SALTS = 16
#: Matches that are walked through at once.
BLOCK = 64
SPANS = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _walk(pairs: Column, kind: int, value_of, keep) -> Column:
    """End of a block of gaps and matches, and its kept spans, as if the block began at 0."""
    none = F.array().cast(SPANS)

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["g"]
        end = start + F.length(p["m"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value_of(p["m"]).alias("value"))
        return F.struct(end.alias("at"), F.when(keep(p["m"]), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(pairs, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans")), step)


def _gaps_and_matches(text: Column, pattern: str, kind: int, value_of, keep) -> Column:
    """Spans of all matches: each starts where the gaps and matches before it end.

    Splitting and extracting find the same leftmost, non-overlapping matches, so
    gaps and matches alternate. Lengths are code points. They are walked through in blocks, whose ends are then
    summed, as a list that grows match by match would be copied at each.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spans(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g")))
        blocks = _let(pairs, lambda ps: F.transform(
            F.sequence(F.lit(0), F.size(ps) - 1, F.lit(BLOCK)), lambda i: _walk(F.slice(ps, i + 1, F.lit(BLOCK)), kind, value_of, keep)
        ))

        def placed(bs: Column) -> Column:
            starts = F.aggregate(
                bs, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("all")),
                lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
            )["all"]
            return F.flatten(F.zip_with(bs, starts, lambda b, at: F.transform(b["spans"], lambda x: F.struct(
                (x["start"] + at).alias("start"), x["kind"].alias("kind"), (x["end"] + at).alias("end"), x["value"].alias("value")
            ))))

        return _let(blocks, placed)

    return _let(matches, lambda found: F.when(F.size(found) > 0, spans(found)).otherwise(F.array().cast(SPANS)))


def _value(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 2)


def base_spans(text: Column) -> Column:
    """The fixed rules' spans by start, then kind."""
    assign = _gaps_and_matches(text, ASSIGN, 0, _value, lambda m: F.length(_value(m)) >= ASSIGN_LENGTH)
    access = _gaps_and_matches(text, ACCESS, 1, lambda m: m, lambda m: F.lit(True))
    hexes = _gaps_and_matches(text, HEX, 2, lambda m: m, lambda m: F.lit(True))
    return F.array_sort(F.concat(assign, access, hexes))


def token_spans(text: Column) -> Column:
    """Free-standing long tokens that mix digits, small and capital letters."""
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")
    return _gaps_and_matches(text, TOKEN, 3, lambda m: m, mixed)


def labelled(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def ownership(candidates: DataFrame, repos: DataFrame, max_owners: int = MAX_OWNERS, min_repos: int = MIN_REPOS) -> DataFrame:
    """Per value hash: rows, distinct repositories and owners, and whether it is an example.

    Input: ``value_hash, repo, owner`` of candidates, and all distinct ``owner, repo``. A value is an example if more than ``max_owners``
    owners hold it, or if an owner has copied it widely: into ``min_repos`` of their repositories at least, and more than half of them.
    Candidates are combined by (hash, owner, repository) and then by (hash, owner) before they meet by hash, so a value
    copied into a third of all documents arrives as one row per owner.
    """
    by_repo = candidates.groupBy("value_hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_repo.groupBy("value_hash", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repos"))
    sizes = repos.groupBy(F.col("owner").alias("_owner")).agg(F.count(F.lit(1)).alias("_all"))
    # Only values in several repositories of an owner can be copied widely there.
    wide = by_owner.filter(F.col("repos") >= min_repos).join(sizes, F.col("owner").eqNullSafe(F.col("_owner")))
    copied = wide.filter(2 * F.col("repos") > F.col("_all")).select("value_hash", "owner", F.lit(True).alias("_wide"))
    marked = by_owner.select("value_hash", "n", "repos", F.lit(False).alias("_wide")).union(
        copied.select("value_hash", F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), "_wide")
    )
    return marked.groupBy("value_hash").agg(
        F.sum("n").alias("n_rows"), F.sum("repos").alias("n_repos"), F.count_if(~F.col("_wide")).alias("n_owners"), F.bool_or("_wide").alias("_wide"),
    ).withColumn("is_example", (F.col("n_owners") > max_owners) | F.col("_wide")).drop("_wide")


def scan_secrets(
    docs: DataFrame, text: str = "text", repo: Column | None = None, owner: Column | None = None,
    key: str = "doc_id", max_owners: int = MAX_OWNERS, min_repos: int = MIN_REPOS,
) -> DataFrame:
    """One row per document: ``key``, base spans, all spans, and how its values are owned.

    Candidates are the base spans and free-standing tokens. A token that few owners hold in the whole corpus, and none of them
    widely (see :func:`ownership`), looks live and is added as a
    span of kind ``token`` unless it overlaps a base span; a more widely copied one is taken
    for an example and is not. Base spans are never removed, but those with a
    widely copied value count in ``n_examples``, the rest in ``n_live``; ``examples`` lists the former with ``start, kind, n_owners, n_repos``.

    ``repo`` and ``owner`` default to the source. Null texts count as empty; null
    owners are one owner, null repositories one repository. Rows that share key and text get the same result each. Other
    columns, whatever their names, are not read. An empty table gives no rows.
    """
    owner = F.col("source") if owner is None else owner
    repo = owner if repo is None else repo
    body = F.coalesce(F.col(text), F.lit(""))
    found = stored(
        docs.select(
            F.col(key).alias("_key"), F.xxhash64(body).alias("_text"), owner.alias("owner"), repo.alias("repo"),
            base_spans(body).alias("base"), token_spans(body).alias("tokens"),
        ),
        "secrets",
    )
    every = found.select("_key", "_text", "owner", "repo", F.explode(F.concat("base", "tokens")).alias("span"))
    # A token overlaps a base span if one before it ends behind its start, or the next one starts before its end.
    is_base = F.col("span.kind") < 3
    ahead = W.partitionBy("_key", "_text").orderBy("span.start", "span.kind").rowsBetween(W.unboundedPreceding, -1)
    behind = W.partitionBy("_key", "_text").orderBy(F.desc("span.start"), F.desc("span.kind")).rowsBetween(W.unboundedPreceding, -1)
    apart = every.withColumn("_reach", F.max(F.when(is_base, F.col("span.end"))).over(ahead)).withColumn(
        "_next", F.min(F.when(is_base, F.col("span.start"))).over(behind)
    ).filter(is_base | ((F.coalesce("_reach", F.lit(0)) <= F.col("span.start")) & (F.coalesce("_next", F.col("span.end")) >= F.col("span.end"))))
    each = stored(apart.select("_key", "_text", "owner", "repo", "span", F.sha2(F.col("span.value").cast("binary"), 256).alias("value_hash")), "secrets")
    # Only examples are joined: a value is in that table once, whatever its number of rows.
    # Their copies over the salts let a hot value's rows spread over as many tasks.
    examples = ownership(each, found.select("owner", "repo").distinct(), max_owners, min_repos).filter("is_example").select(
        "value_hash", "n_owners", "n_repos", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    judged = (
        each.withColumn("salt", F.pmod(F.xxhash64("_key", "_text"), F.lit(SALTS)).cast("int"))
        .join(examples, ["value_hash", "salt"], "left")
        .withColumn("_live", F.col("n_owners").isNull())
    )
    known = F.struct(F.col("span.start").alias("start"), F.col("span.kind").alias("kind"), "n_owners", "n_repos")
    # Repeated rows have each span more than once.
    per_doc = judged.groupBy("_key", "_text").agg(
        F.collect_set(F.when(F.col("_live") & ~is_base, F.col("span"))).alias("added"),
        F.array_sort(F.collect_set(F.when(~F.col("_live"), known))).alias("examples"),
        F.count_distinct(F.when(F.col("_live"), F.struct("span.start", "span.kind"))).alias("n_live"),
    )
    per_doc = per_doc.withColumnsRenamed({"_key": "_key2", "_text": "_text2"})
    same = F.col("_key").eqNullSafe(F.col("_key2")) & (F.col("_text") == F.col("_text2"))
    return found.join(per_doc, same, "left").select(
        F.col("_key").alias(key), "base",
        F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(SPANS)))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce(F.size("examples"), F.lit(0)).cast("bigint").alias("n_examples"),
        F.coalesce("examples", F.array().cast("array<struct<start:bigint,kind:int,n_owners:bigint,n_repos:bigint>>")).alias("examples"),
    )


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in all documents; sources are the owners, their languages the repositories."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    found = scan_secrets(docs, owner=F.col("source"), repo=F.concat_ws("/", "source", "lang"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(labelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        labelled(F.col("spans")).alias("spans"),
        "n_live", "n_examples",
    )
