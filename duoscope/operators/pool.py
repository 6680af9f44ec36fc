"""Project pools: needs, availability, allocation to people, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duoscope.functions.checks import safe_url
from duoscope.operators.ordered import row_numbers, running_sum


def needs(counts: DataFrame, key: str, per_project: int = 3, buffer: float = 1.2) -> DataFrame:
    """Projects needed per key: tasks over tasks per project, rounded up, with a buffer, rounded up; biggest first."""
    projects = F.ceil(F.sum("count") / per_project)
    return counts.groupBy(key).agg(F.ceil(projects * buffer).cast("bigint").alias("needed")).orderBy(F.desc("needed"), key)


def used_projects(deliveries: Sequence[DataFrame]) -> DataFrame:
    """Distinct projects over all deliveries."""
    out = deliveries[0].select("repo")
    for d in deliveries[1:]:
        out = out.union(d.select("repo"))
    return out.distinct()


def available(pool: DataFrame, used: DataFrame) -> DataFrame:
    """Pool entries whose project no delivery has used."""
    return pool.join(used, "repo", "left_anti")


def merge_pool(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old entries first, then new ones in order of arrival; of equal projects of a key the first stays."""
    both = old.select("key", "repo", "pos", F.lit(0).alias("src")).union(new.select("key", "repo", "pos", F.lit(1)))
    first = both.groupBy("key", "repo").agg(F.min(F.struct("src", "pos")).alias("f"))
    merged = first.select("key", "repo", "f.src", "f.pos")
    return row_numbers(merged, ["key"], ["src", "pos", "repo"], "pos_new").select("key", "repo", "src", F.col("pos_new").alias("pos"))


def still_in_pool(assigned: DataFrame, pool: DataFrame) -> DataFrame:
    """Assignments whose project is still in the pool of its key."""
    return assigned.join(pool.select("key", "repo"), ["key", "repo"], "left_semi")


def allocate(pool: DataFrame, wanted: DataFrame) -> DataFrame:
    """People take projects of each key in pool order, one after the other, as many as each needs.

    ``pool`` has ``key, repo, pos``, ``wanted`` has ``key, person, need``. A person's turn is an interval of places in the
    pool. Instead of a range join, both sides are laid out in one order of places: each project looks back for the
    interval that covers it, so keys with very many projects are split like any ordered operator.
    """
    ranked = row_numbers(pool, ["key"], ["pos", "repo"], "rank")
    spans = running_sum(wanted, ["key"], ["person"], "need", "before").filter("need > 0")
    # A person's interval starts at before + 1; it sorts ahead of the project at the same place.
    starts = spans.select("key", (F.col("before") + 1).alias("rank"), F.lit(0).alias("side"), F.lit(None).cast("bigint").alias("repo"),
                          F.struct("person", (F.col("before") + F.col("need")).alias("upto")).alias("turn"))
    items = ranked.select("key", "rank", F.lit(1).alias("side"), "repo", F.lit(None).cast(starts.schema["turn"].dataType).alias("turn"))
    from duoscope.operators.ordered import last_seen

    seen = last_seen(starts.unionByName(items), ["key"], ["rank", "side"], "turn", "taker")
    return seen.filter((F.col("side") == 1) & (F.col("taker.upto") >= F.col("rank"))).select("key", "repo", "rank", F.col("taker.person").alias("person"))


def round_robin(pool: DataFrame, people: int) -> DataFrame:
    """The i-th project of a key goes to person ``i % people + 1``."""
    ranked = row_numbers(pool, ["key"], ["pos", "repo"], "rank")
    return ranked.select("key", "repo", "rank", ((F.col("rank") - 1) % people + 1).alias("person"))


def pool_status(assigned: DataFrame, used: DataFrame) -> DataFrame:
    """Per person: entries, distinct used projects, entries left, percent used."""
    marked = assigned.join(used.withColumn("is_used", F.lit(True)), "repo", "left")
    per = marked.groupBy("person").agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct(F.when(F.col("is_used"), F.col("repo"))).alias("used"),
    )
    return per.withColumn("remaining", F.col("total") - F.col("used")).withColumn(
        "used_pct", F.round(F.col("used") * 100.0 / F.col("total"), 1)
    )


def person_status(assigned: DataFrame, used: DataFrame) -> DataFrame:
    """Per person and key: entries, distinct used projects, entries left."""
    marked = assigned.join(used.withColumn("is_used", F.lit(True)), "repo", "left")
    per = marked.groupBy("person", "key").agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct(F.when(F.col("is_used"), F.col("repo"))).alias("used"),
    )
    return per.withColumn("remaining", F.col("total") - F.col("used"))


def people_below_target(assigned: DataFrame, targets: DataFrame, people: DataFrame) -> DataFrame:
    """Per key with a target the people who have fewer projects: ``key, target, n_people``.

    ``targets`` has ``key, target``, ``people`` has ``person``, both without repeats. People at the target are counted and taken from all,
    so nobody's absence needs a row.
    """
    have = assigned.groupBy("key", "person").agg(F.count(F.lit(1)).alias("n"))
    enough = have.join(targets, "key").join(people, "person", "left_semi").filter("n >= target").groupBy("key").agg(F.count(F.lit(1)).alias("enough"))
    total = people.agg(F.count(F.lit(1)).alias("people"))
    below = targets.join(enough, "key", "left").join(F.broadcast(total)).select(  # one row
        "key", "target", (F.col("people") - F.coalesce("enough", F.lit(0))).alias("n_people")
    )
    return below.filter("n_people > 0 AND target > 0")


def shortfall(need: DataFrame, pool: DataFrame, key: str = "key") -> DataFrame:
    """Keys that have fewer projects than needed."""
    found = pool.groupBy(key).agg(F.count(F.lit(1)).alias("found"))
    joined = need.join(found, key, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return joined.filter("found < needed").withColumn("missing", F.col("needed") - F.col("found"))


def first_available(pool: DataFrame, used: DataFrame) -> DataFrame:
    """The first unused project of every key."""
    best = available(pool, used).groupBy("key").agg(F.min(F.struct("pos", "repo")).alias("b"))
    return best.select("key", "b.repo")


def top_candidates(pool: DataFrame, score: str, k: int) -> DataFrame:
    """The ``k`` best entries of each key; of equal scores the earlier place."""
    ranked = row_numbers(pool, ["key"], [F.col(score).desc(), F.col("pos"), F.col("repo")], "rank")
    return ranked.filter(F.col("rank") <= k)


def expand_slots(seeds: DataFrame, slots: DataFrame, n: int) -> DataFrame:
    """Each seed slot, then the first slot of every other task type of its domain and language, at most ``n``; padded with the seed.

    Per (domain, language) only the first slot of each type is kept, so a seed meets one row per type.
    """
    firsts = slots.groupBy("domain", "language", "task_type").agg(F.min("slot").alias("slot"))
    types = firsts.groupBy("domain", "language").agg(F.array_sort(F.collect_list(F.struct("slot", "task_type"))).alias("types"))
    others = F.filter("types", lambda t: t["task_type"] != F.col("task_type"))
    head = F.array(F.struct("slot", "task_type"))
    row = F.concat(head, F.slice(others, 1, n - 1), F.array_repeat(F.struct("slot", "task_type"), n))
    return seeds.join(types, ["domain", "language"], "left").select(
        F.col("slot").alias("seed"), F.posexplode(F.slice(F.when(F.col("types").isNull(), F.array_repeat(F.struct("slot", "task_type"), n)).otherwise(row), 1, n)).alias("k", "s")
    ).select("seed", "k", "s.slot", "s.task_type")


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) fixed by key and seed: the same in every run and on every cluster."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**13)


def match_ideas(ideas: DataFrame, slots: DataFrame, batch: str = "batch", kind: str = "task_type") -> DataFrame:
    """The k-th idea of a type goes to the batch's k-th slot of that type; what is left fills the left slots in order.

    ``ideas`` has ``idea``, ``slots`` has ``slot``, both unique numbers that give the order.
    """
    by_kind_i = row_numbers(ideas, [batch, kind], ["idea"], "k")
    by_kind_s = row_numbers(slots, [batch, kind], ["slot"], "k")
    matched = by_kind_s.join(by_kind_i, [batch, kind, "k"]).select(batch, "slot", "idea")
    left_i = row_numbers(ideas.join(matched, [batch, "idea"], "left_anti"), [batch], ["idea"], "k")
    left_s = row_numbers(slots.join(matched, [batch, "slot"], "left_anti"), [batch], ["slot"], "k")
    rest = left_s.join(left_i.select(batch, "k", "idea"), [batch, "k"]).select(batch, "slot", "idea")
    return matched.union(rest)


def eligible(
    candidates: DataFrame, excluded: DataFrame, stars: tuple[int, int], key: str = "repo", largest: int | None = None
) -> DataFrame:
    """Candidates with stars in range (both ends) that are not excluded.

    Where the columns are there, forks and archived projects, those larger than ``largest`` (column ``size``) and those whose ``clone_url`` is not
    safe are left out as well; a null fork or archived mark counts as no.
    """
    good = F.col("stars").between(*stars)
    for mark in ("fork", "archived"):
        if mark in candidates.columns:
            good = good & ~F.coalesce(F.col(mark), F.lit(False))
    if largest is not None and "size" in candidates.columns:
        good = good & (F.coalesce("size", F.lit(0)) <= largest)
    if "clone_url" in candidates.columns:
        good = good & safe_url(F.col("clone_url"))
    return candidates.filter(good).join(excluded.select(key), key, "left_anti")


def weighted_sample(rows: DataFrame, key: str, weight: str, k: int, seed: int) -> DataFrame:
    """``k`` rows drawn without replacement with chances by weight (exponential keys; all rows when fewer)."""
    draw = -F.ln(uniform(F.col(key), seed)) / F.col(weight)
    return rows.filter(F.col(weight) > 0).withColumn("draw", draw).orderBy("draw", key).limit(k)


def stratified_sample(
    rows: DataFrame, strata: Sequence[str], key: str, weight: str, k: int, seed: int, wanted: Column | None = None, excluded: DataFrame | None = None,
) -> DataFrame:
    """``k`` rows of each stratum drawn without replacement with chances by weight; all of a stratum that has fewer.

    ``wanted`` is a filter, ``excluded`` rows by ``key`` that take no part. Every row gets an exponential draw fixed by key and seed; the smallest of a
    stratum win. Each task keeps its own ``k`` best of a stratum, so neither a stratum nor the table is sorted as a whole.
    """
    own = rows if wanted is None else rows.filter(wanted)
    if excluded is not None:
        own = own.join(excluded.select(key), key, "left_anti")
    draw = -F.ln(uniform(F.col(key), seed)) / F.col(weight)
    order = W.partitionBy(*strata).orderBy("draw", key)
    drawn = own.filter(F.col(weight) > 0).withColumn("draw", draw).withColumn("rank", F.row_number().over(order))
    return drawn.filter(F.col("rank") <= k)


def slot_batches(slots: DataFrame, k: int, n: int, seed: int, strata: Sequence[str] = ("domain",), **options) -> DataFrame:
    """``k`` slots drawn per stratum, each expanded to ``n`` slots of different task types: ``seed, k, slot, task_type``."""
    drawn = stratified_sample(slots, strata, "slot", "weight", k, seed, **options)
    return expand_slots(drawn.select("slot", "task_type", "domain", "language"), slots, n)


def next_id(sources: Sequence[DataFrame], prefix: str = "CT-") -> DataFrame:
    """One row: the id after the largest number in use, four digits at least."""
    out = sources[0].select("id")
    for s in sources[1:]:
        out = out.union(s.select("id"))
    number = F.coalesce(F.max(F.regexp_extract("id", rf"^{prefix}(\d+)$", 1).try_cast("bigint")), F.lit(0)) + 1
    return out.agg(F.concat(F.lit(prefix), F.lpad(number.cast("string"), F.greatest(F.lit(4), F.length(number.cast("string"))), F.lit("0"))).alias("next_id"))
