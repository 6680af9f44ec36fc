"""Free-form answers to rows: salvage of JSON answers, and validation of scored rubrics against their template."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.functions.checks import valid_criterion_name
from duoscope.functions.text import bound, has_score_tiers, is_kind, without_meta
from duoscope.settings import ARMS, LIMITS, Arms, Limits

# What an idea must name, and the least number of follow-ups of each arm.
IDEA_KEYS = ("task_title", "task_description")
LEAST_FOLLOWUPS = (2, 3)

# Fixed value: what the text of a JSON value can begin with.
JSON_STARTS = tuple('{["-0123456789tfn')


def _strict(body: Column) -> Column:
    """The VARIANT of a stripped text that is one JSON value; the parser by itself passes over what follows the value.

    Only texts that can be JSON by their first character are parsed: a failed parse costs far more than a short one.
    """
    parts = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))), "$", "array<variant>")
    return F.when(F.left(body, F.lit(1)).isin(*JSON_STARTS), bound(parts, lambda p: F.when(F.size(p) == 1, F.get(p, F.lit(0)))))


def _between(body: Column, opening: str, closing: str) -> Column:
    """Text from the first opening mark to the last closing one, found without backtracking."""
    places = F.struct(F.instr(body, opening).alias("first"), (F.length(body) - F.instr(F.reverse(body), closing) + 1).alias("last"))
    return bound(places, lambda at: F.when(
        (at["first"] > 0) & (at["last"] > at["first"]), F.substring(body, at["first"], at["last"] - at["first"] + 1)))


def _salvaged(raw: Column, *marks: str) -> Column:
    """The VARIANT of an answer: the whole without meta lines, else the first part between a pair of marks that is JSON."""
    return bound(without_meta(raw), lambda body: F.coalesce(_strict(body), *[bound(_between(body, *m), _strict) for m in marks]))


def answer_json(raw: Column, as_list: bool = False) -> Column:
    """The VARIANT of an answer: the whole without meta lines, else from the first brace (or bracket) to the last."""
    return _salvaged(raw, "[]" if as_list else "{}")


def _entries(v: Column) -> Column:
    """Keys and values of an object; null for other kinds."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def _has(entries: Column, *keys: str) -> Column:
    out = entries.isNotNull()
    for k in keys:
        out = out & F.coalesce(F.map_contains_key(entries, k), F.lit(False))
    return out


def _first(checks: Sequence[tuple[str, Column]]) -> Column:
    out = None
    for name, failed in checks:
        out = F.when(failed, name) if out is None else out.when(failed, name)
    return out


def salvaged_ideas(answers: DataFrame, raw: str = "raw", keys: Sequence[str] = IDEA_KEYS) -> DataFrame:
    """Add ``ideas`` (the valid entries of an answer that is one idea or a list of them) and ``error``.

    An idea is an object with all ``keys``. An answer without any is rejected: ``unreadable``, ``wrong_kind``
    or ``no_idea``. Null answers are unreadable; every answer stays a row.
    """

    def facts(v: Column) -> Column:
        each = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(is_kind(v, "OBJECT"), F.array(v)))
        ideas = lambda e: F.filter(e, lambda x: bound(_entries(x), lambda m: _has(m, *keys)))

        def judged(found: Column) -> Column:
            error = _first([("unreadable", v.isNull()), ("wrong_kind", found.isNull()), ("no_idea", F.size(found) == 0)])
            return F.struct(error.alias("error"), F.when(F.size(found) > 0, found).alias("ideas"))

        return bound(bound(each, ideas), judged)

    out = answers.withColumn("_s", bound(_salvaged(F.col(raw), "{}", "[]"), facts))
    return out.withColumns({c: F.col(f"_s.{c}") for c in ("error", "ideas")}).drop("_s")


def idea_rows(salvaged: DataFrame, key: str) -> DataFrame:
    """One row per idea: ``key, n`` (place in the answer, from 1), ``title, description``."""
    # A filter, or a bare column to unfold, would move below the parsing and parse each answer once more.
    ideas = F.when(F.col("error").isNull(), F.col("ideas"))
    rows = salvaged.select(key, F.posexplode(ideas).alias("n", "v"))
    get = lambda k: F.try_variant_get("v", f"$.{k}", "string")
    return rows.select(key, (F.col("n") + 1).alias("n"), get(IDEA_KEYS[0]).alias("title"), get(IDEA_KEYS[1]).alias("description"))


def salvaged_tasks(answers: DataFrame, raw: str = "raw", arms: Arms = ARMS, least: Sequence[int] = LEAST_FOLLOWUPS) -> DataFrame:
    """Add ``prompt``, both arms' follow-ups (lists of texts), ``is_legacy`` and ``error`` to answers that specify a task.

    A specification has ``prompt``, or in the older form one prompt per arm, of which the first arm's is taken; and lists of follow-ups of
    the least lengths. ``error`` is the first of ``unreadable``, ``not_an_object``, ``no_prompt``, ``keys_missing``,
    ``followups_not_a_list``, ``too_few_followups``; then the other columns are null. Every answer stays a row.
    """
    names = [arms.baseline_provider, arms.candidate_provider]
    follow = [f"followups_{n}" for n in names]

    def judged(v: Column, entries: Column, lists: Sequence[Column]) -> Column:
        new, old = _has(entries, "prompt"), _has(entries, f"prompt_{names[0]}")
        error = _first([
            ("unreadable", v.isNull()), ("not_an_object", entries.isNull()), ("no_prompt", ~(new | old)),
            ("keys_missing", ~_has(entries, *follow) | (~new & ~_has(entries, f"prompt_{names[1]}"))),
            ("followups_not_a_list", lists[0].isNull() | lists[1].isNull()),
            ("too_few_followups", (F.size(lists[0]) < least[0]) | (F.size(lists[1]) < least[1])),
        ])
        prompt = F.when(new, F.try_variant_get(v, "$.prompt", "string")).otherwise(F.try_variant_get(v, f"$.prompt_{names[0]}", "string"))
        texts = [F.transform(x, lambda e: F.try_variant_get(e, "$", "string")) for x in lists]
        return bound(error, lambda e: F.struct(
            e.alias("error"), F.when(e.isNull(), prompt).alias("prompt"), F.when(e.isNull(), texts[0]).alias(f"{arms.baseline}_followups"),
            F.when(e.isNull(), texts[1]).alias(f"{arms.candidate}_followups"), F.when(e.isNull(), ~new).alias("is_legacy"),
        ))

    def facts(v: Column) -> Column:
        lists = F.struct(*[F.try_variant_get(v, f"$.{f}", "array<variant>").alias(f"_{i}") for i, f in enumerate(follow)])
        return bound(_entries(v), lambda entries: bound(lists, lambda x: judged(v, entries, [x["_0"], x["_1"]])))

    columns = ["error", "prompt", f"{arms.baseline}_followups", f"{arms.candidate}_followups", "is_legacy"]
    out = answers.withColumn("_s", bound(answer_json(F.col(raw)), facts))
    return out.withColumns({c: F.col("_s")[c] for c in columns}).drop("_s")


def with_template(rows: DataFrame, template: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the description and weight of the template's criterion of their name, where there is one (``from_template``).

    ``template`` has ``keys, name, description, weight``; of a name it has twice the last in order of description counts.
    """
    known = template.groupBy(*keys, "name").agg(F.max(F.struct("description", "weight")).alias("_t"))
    joined = rows.join(known, [*keys, "name"], "left")
    there = F.col("_t").isNotNull()
    return joined.withColumns({
        "description": F.when(there, F.col("_t.description")).otherwise(F.coalesce("description", F.lit(""))),
        "weight": F.when(there, F.col("_t.weight")).otherwise(F.coalesce("weight", F.lit(1.0))), "from_template": there,
    }).drop("_t")


def answer_verdicts(
    rows: DataFrame, keys: Sequence[str], template: DataFrame | None = None, template_keys: Sequence[str] | None = None,
    own_descriptions: bool = False, limits: Limits = LIMITS,
) -> DataFrame:
    """One row per scored answer: ``keys, n_rows, error, at_pos``; ``error`` is null for a valid one.

    ``rows`` are the criteria of an answer, numbered by ``pos`` from 1: ``name, score`` (as it was written), ``rationale, description, weight``. Checked
    are the number of rows; then row by row name, repetition, score (whole, 1 to 5; an absent one is 0) and
    rationale, and with ``own_descriptions`` the five tiers in descriptions that no template row replaces; at last whether the names are
    just the template's, for answers that have one. The first failing check counts.

    One aggregation; of an answer's rows only those within the limit are looked at together.
    """
    most = limits.max_criteria
    have = with_template(rows, template, template_keys or keys) if template is not None else rows.withColumn("from_template", F.lit(False))
    text = F.coalesce(F.col("score").cast("string"), F.lit("0"))
    score = F.coalesce(F.when(text.rlike(r"\A[+-]?\d{1,9}\z"), text.cast("int")), F.lit(0))
    tiers = F.lit(own_descriptions) & ~F.col("from_template") & ~has_score_tiers(F.coalesce("description", F.lit("")))
    row_error = F.coalesce(
        F.when(~F.coalesce(valid_criterion_name(F.col("name")), F.lit(False)), F.struct(F.lit(0).alias("rank"), F.lit("invalid_name").alias("error"))),
        F.when(~text.rlike(r"\A[+-]?\d+\z"), F.struct(F.lit(2).alias("rank"), F.lit("score_not_whole").alias("error"))),
        F.when(~score.between(1, 5), F.struct(F.lit(3).alias("rank"), F.lit("score_out_of_range").alias("error"))),
        F.when(F.coalesce("rationale", F.lit("")) == "", F.struct(F.lit(4).alias("rank"), F.lit("no_rationale").alias("error"))),
        F.when(tiers, F.struct(F.lit(5).alias("rank"), F.lit("no_tiers").alias("error"))),
    )
    pos = F.col("pos").cast("bigint")
    facts = have.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.when(row_error.isNotNull(), F.struct(pos.alias("pos"), row_error["rank"].alias("rank"), row_error["error"].alias("error")))).alias("_bad"),
        F.array_sort(F.collect_list(F.when(pos <= most, F.struct(pos.alias("pos"), F.col("name").alias("name"))))).alias("_names"),
        F.count_if("from_template").alias("_known"),
    )
    again = F.filter("_names", lambda x: F.exists("_names", lambda y: (y["name"] == x["name"]) & (y["pos"] < x["pos"])))
    first_again = F.when(F.size(again) > 0, F.struct(F.get(again, F.lit(0))["pos"].alias("pos"), F.lit(1).alias("rank"), F.lit("repeated_name").alias("error")))
    facts = facts.withColumn("_first", F.least("_bad", first_again))
    wrong = ~F.col("n_rows").between(limits.min_criteria, most)
    differ = F.lit(False)
    if template is not None:
        sizes = template.groupBy(*(template_keys or keys)).agg(F.count_distinct("name").alias("_size"))
        facts = facts.join(sizes, list(template_keys or keys), "left")
        # Names are distinct by now, so equal numbers mean equal sets.
        differ = F.col("_size").isNotNull() & ((F.col("_known") != F.col("n_rows")) | (F.col("_size") != F.col("n_rows")))
    error = F.when(wrong, "wrong_count").when(F.col("_first").isNotNull(), F.col("_first.error")).when(differ, "names_differ")
    at = F.when(~wrong, F.col("_first.pos"))
    return facts.select(*keys, "n_rows", error.alias("error"), at.alias("at_pos"))


def accepted_rows(rows: DataFrame, verdicts: DataFrame, keys: Sequence[str], template: DataFrame | None = None, template_keys: Sequence[str] | None = None) -> DataFrame:
    """The criteria of valid answers as rubric rows: fixed type and points, descriptions and weights of the template."""
    good = rows.join(verdicts.filter("error IS NULL").select(*keys), list(keys), "left_semi")
    have = with_template(good, template, template_keys or keys) if template is not None else good.withColumns(
        {"description": F.coalesce("description", F.lit("")), "weight": F.coalesce("weight", F.lit(1.0))}
    )
    return have.select(
        *keys, "pos", "name", "description", F.lit("likert").alias("type"), F.lit(5).alias("points"), "weight",
        F.col("score").cast("int").alias("score"), "rationale",
    )
