"""Queries on rubrics, pairs and task records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope import constants as C
from duoscope.functions import names, text
from duoscope.operators import filters, pairs, rubrics, rules
from duoscope.operators.ordered import row_numbers
from duoscope.plans import fixtures as X
from duoscope.settings import ARMS


def verdicts(spark, d) -> DataFrame:
    return rubrics.rubric_verdict(rubrics.rubric_facts(X.criteria(spark, d).drop("description")), check_names=True)


def rubric_verdicts(spark, d):
    return verdicts(spark, d).select("task_id", "arm", "n_criteria", "reason", "at_pos", "passrate")


def pass_rates(spark, d):
    return rubrics.pass_rates(X.criteria(spark, d)).withColumn("passrate", F.round("passrate", 6))


def rubric_listing(spark, d):
    return rubrics.any_issue(verdicts(spark, d))


def invalid_names(spark, d):
    return rubrics.invalid_names(X.criteria(spark, d)).select("task_id", "arm", "pos", "name")


def repeated_names(spark, d):
    return rubrics.repeated_names(X.criteria(spark, d))


def expected_names(spark, d):
    rows = X.criteria(spark, d)
    sizes = rows.groupBy("task_id", "arm").agg(F.count(F.lit(1)).cast("int").alias("n"))
    expected = sizes.select("task_id", "arm", F.explode(F.transform(F.sequence(F.lit(1), "n"), lambda i: F.concat(F.lit("dim_"), i))).alias("name"))
    return rubrics.names_match(rows, expected)


def contradictions(spark, d):
    found = rubrics.contradictions(X.criteria(spark, d), negative=["F ", "5-"], positive=["1-URGENT", "O "])
    return found.select("task_id", "arm", "pos", F.array_join("words", "|").alias("words"))


def task_arms(spark, d):
    return pairs.with_arms(X.tasks(spark, d).select("pair_id", "task_type"))


def records(spark, d) -> DataFrame:
    paired = pairs.pair_arms(verdicts(spark, d), ["passrate"])
    return pairs.rule_columns(pairs.with_verdict(paired))


def pair_verdicts(spark, d):
    return records(spark, d).drop("violations")


def full_records(spark, d) -> DataFrame:
    """Records with the dimensions of their task."""
    rows = records(spark, d).withColumn("pair_id", F.expr("task_id div 1000"))
    return rows.join(X.tasks(spark, d), "pair_id", "left").drop("pair_id")


def violation_counts(spark, d):
    return pairs.violation_rows(records(spark, d)).groupBy("rule").agg(F.count(F.lit(1)).alias("n_tasks"))


def filtered_records(spark, d):
    rows = full_records(spark, d)
    wanted = filters.condition(rows, "domain", "=", "ASIA") & (
        filters.condition(rows, "candidate_passrate", ">=", 0.6) | filters.condition(rows, "threshold_ok", "=", "true")
    ) & filters.condition(rows, "task_type", "!=", True)
    return rows.filter(wanted).select("task_id", "task_type", "domain", "candidate_passrate", "threshold_ok")


def selected_tasks(spark, d):
    return filters.select_tasks(X.tasks(spark, d), [7, 3, 10**12], key="pair_id")


def known_tasks(spark, d):
    rows = X.tasks(spark, d).withColumn("origin", F.lit("configured"))
    manifest = rows.filter("pair_id % 3 = 0").withColumn("origin", F.lit("manifest"))
    return filters.known_tasks(manifest, rows, key="pair_id").groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.sum("pair_id").alias("ids"))


def passrate_distribution(spark, d):
    out = pairs.distribution(verdicts(spark, d), ["arm"])
    return out.select("arm", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "median", "std")], "count")


def mean_flags(spark, d):
    return pairs.mean_flags(pairs.distribution(verdicts(spark, d), ["arm"]).select("arm", "mean"))


def paired_difference(spark, d):
    out = pairs.paired_difference(records(spark, d))
    return out.select(*[F.round(c, 6).alias(c) for c in ("mean", "median", "std")], "count", "positive", "negative", "tie")


def group_stats(spark, d):
    return rules.group_stats(full_records(spark, d), ["task_type", "domain", "language"])


def batch_summary(spark, d):
    return rules.batch_summary(records(spark, d))


def complete_criteria(spark, d) -> DataFrame:
    """Rows of rubrics that have a verdict without a reason."""
    good = verdicts(spark, d).filter("reason IS NULL").select("task_id", "arm")
    return X.criteria(spark, d).join(good, ["task_id", "arm"], "left_semi")


def criterion_differences(spark, d):
    return pairs.criterion_differences(pairs.pair_criteria(complete_criteria(spark, d)))


def criterion_agreement(spark, d):
    return pairs.criterion_agreement(pairs.pair_criteria(complete_criteria(spark, d)))


def submission_ids(spark, d):
    numbered = row_numbers(X.tasks(spark, d), ["task_type"], ["pair_id"], "seq")
    return numbered.select("pair_id", names.submission_id(F.lit("p1"), F.lit("20260607"), F.col("task_type"), F.col("seq")).alias("submission_id"))


def published(spark, d) -> DataFrame:
    """Published rows: some pass rates are shifted, some are no numbers, some rows are absent."""
    r = records(spark, d)
    text = F.when(F.col("task_id") % 7 == 0, F.round(F.col("candidate_passrate") + 0.001, 4).cast("string")).when(
        F.col("task_id") % 11 == 0, "n/a"
    ).otherwise(F.col("candidate_passrate").cast("string"))
    return r.filter("task_id % 13 <> 0").select("task_id", text.alias("published"), F.when(F.col("task_id") % 5 == 0, "odd").otherwise("core").alias("label"))


def reconciliation(spark, d):
    return rules.reconcile(records(spark, d).select("task_id", "candidate_passrate"), published(spark, d), "candidate_passrate")


def label_issues(spark, d):
    vocabulary = spark.createDataFrame([("core",)], "label string")
    return rules.unknown_labels(published(spark, d), vocabulary, "label")


def issues(spark, d):
    r = records(spark, d)
    rows = rules.all_issues([
        rules.reconcile(r.select("task_id", "candidate_passrate"), published(spark, d), "candidate_passrate").select("task_id", "rule"),
        rules.unknown_labels(published(spark, d), spark.createDataFrame([("core",)], "label string"), "label").select("task_id", F.lit("unknown_label")),
        pairs.violation_rows(r), pairs.criterion_differences(pairs.pair_criteria(complete_criteria(spark, d))).select("task_id", "rule"),
    ])
    return rows.groupBy("rule").agg(F.count(F.lit(1)).alias("n_issues"), F.count_distinct("task_id").alias("n_tasks"))


def finalize_status(spark, d):
    reasons = pairs.pair_arms(verdicts(spark, d), ["reason"])
    return rules.finalize(records(spark, d), reasons).select("task_id", "status")


def task_context(spark, d):
    """Dimensions of customers from their own row where the balance is positive, else from their nation."""
    base = X.table(spark, d, "customer").select(F.col("c_custkey").alias("task_id"), "c_acctbal", "c_mktsegment", "c_nationkey")
    own = base.select("task_id", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise(" ").alias("kind"), F.lit(None).cast("string").alias("place"))
    nation = base.filter("task_id % 3 = 0").join(X.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "task_id", F.lit("").alias("kind"), F.col("n_name").alias("place"))
    out = rules.with_context(base, [own, nation], ["kind", "place"])
    return out.withColumn("defaulted", F.array_join("defaulted", ","))


def score_modes(spark, d):
    """Rubrics as score slots: complete ones are scored, every third has own descriptions, small tasks have no session."""
    t = F.col("task_id") % 1000 + F.expr("task_id div 1000")
    facts = verdicts(spark, d).select(
        "task_id", "arm", (t % 4 != 0).alias("has_template"), F.col("reason").isNull().alias("template_scored"),
        (t % 3 == 0).alias("has_custom_descriptions"), F.when(t % 5 != 0, "done").alias("session_status"), (t % 7 == 0).alias("forced"),
    )
    return rules.score_mode(facts).select("task_id", "arm", "mode", "skip")


def rescore_outcomes(spark, d):
    return records(spark, d).agg(F.count_if("threshold_ok").alias("n_passed"), F.count_if(~F.col("threshold_ok")).alias("n_failed"))


def pattern_labels(spark, d):
    """Texts with a marked section at their end, labelled by the first known word in it."""
    raw = F.concat(F.lit("```toml\na = 1\n```"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("\nbad pattern: "), F.col("lang"))).otherwise(""))
    body = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("# head\n"), F.substring_index(raw, "```", -1), F.lit(" stop"))).otherwise(F.substring_index(raw, "```", -1))
    label = text.bad_pattern_label(body, ("en", "de", "fr"), ("bad pattern",), ("es",))
    return X.table(spark, d, "documents").select("doc_id", label.alias("label"))


_RECORD_COLS = ("task_id, baseline_passrate, candidate_passrate, relative_gain, threshold_ok, export_ok, baseline_over_limit, "
                "candidate_under_limit, candidate_not_better, gain_too_small")
_FULL = X.PAIRS + ", " + X.TASKS + ", records_full AS (SELECT r.*, task_type, domain, language FROM records r LEFT JOIN tasks ON pair_id = task_id // 1000)"
_RULES = """rules AS (
  SELECT task_id, unnest(list_filter([
    CASE WHEN baseline_over_limit THEN 'baseline_over_limit' END, CASE WHEN candidate_under_limit THEN 'candidate_under_limit' END,
    CASE WHEN candidate_not_better THEN 'candidate_not_better' END, CASE WHEN gain_too_small THEN 'gain_too_small' END], lambda x: x IS NOT NULL)) AS rule
  FROM records)"""
_PAIRED = """, good AS (SELECT task_id, arm FROM rated WHERE reason IS NULL),
named AS (
  SELECT c.task_id, name, bool_or(arm = 'baseline') AS in_b, bool_or(arm = 'candidate') AS in_c,
    arg_max(coalesce(score, -8), pos) FILTER (arm = 'baseline') AS sb, arg_max(coalesce(score, -8), pos) FILTER (arm = 'candidate') AS sc,
    arg_max(description, pos) FILTER (arm = 'baseline') AS db, arg_max(description, pos) FILTER (arm = 'candidate') AS dc
  FROM criteria c JOIN good USING (task_id, arm) GROUP BY 1, 2
), paired AS (
  SELECT * FROM named WHERE task_id IN (SELECT task_id FROM good GROUP BY 1 HAVING count(DISTINCT arm) > 1)
), differences AS (
  SELECT task_id, name, CASE WHEN NOT in_c THEN 'only_in_baseline' WHEN NOT in_b THEN 'only_in_candidate' WHEN db <> dc THEN 'description_differs' END AS rule
  FROM paired WHERE NOT in_c OR NOT in_b OR db <> dc
)"""
_PUBLISHED = """, published AS (
  SELECT task_id, CASE WHEN task_id % 7 = 0 THEN round(candidate_passrate + 0.001, 4)::VARCHAR WHEN task_id % 11 = 0 THEN 'n/a'
      ELSE candidate_passrate::VARCHAR END AS published, CASE WHEN task_id % 5 = 0 THEN 'odd' ELSE 'core' END AS label
  FROM records WHERE task_id % 13 <> 0
), reconciled AS (
  SELECT r.task_id, CASE WHEN p.task_id IS NULL THEN 'not_published' WHEN published IS NULL AND candidate_passrate IS NULL THEN NULL
      WHEN published IS NULL THEN 'passrate_missing' WHEN try_cast(published AS DOUBLE) IS NULL THEN 'passrate_unreadable'
      WHEN candidate_passrate IS NULL THEN 'passrate_not_computed'
      WHEN abs(try_cast(published AS DOUBLE) - candidate_passrate) > 1e-4 THEN 'passrate_differs' END AS rule
  FROM records r LEFT JOIN published p USING (task_id)
), mismatches AS (SELECT * FROM reconciled WHERE rule IS NOT NULL)"""

QUERIES = {
    "task_context": (task_context, """SELECT c_custkey AS task_id, CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE 'unknown' END AS kind, CASE WHEN c_custkey % 3 = 0 THEN n_name ELSE 'unknown' END AS place,
        concat_ws(',', CASE WHEN NOT c_acctbal > 0 THEN 'kind' END, CASE WHEN c_custkey % 3 <> 0 THEN 'place' END) AS defaulted FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "score_modes": (score_modes, f"""WITH {X.VERDICTS}, s AS (SELECT *, task_id % 1000 + task_id // 1000 AS t FROM rated) SELECT task_id, arm,
        CASE WHEN t % 4 <> 0 AND t % 3 = 0 THEN 'custom' WHEN t % 4 <> 0 THEN 'fixed' ELSE 'free' END AS mode,
        CASE WHEN t % 5 = 0 THEN 'no_session' WHEN reason IS NULL AND t % 7 <> 0 THEN 'already_scored' END AS skip FROM s"""),
    "rescore_outcomes": (rescore_outcomes, f"WITH {X.PAIRS} SELECT count(*) FILTER (threshold_ok) AS n_passed, count(*) FILTER (NOT threshold_ok) AS n_failed FROM records"),
    "pattern_labels": (pattern_labels, "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CASE lang WHEN 'es' THEN '' ELSE lang END ELSE '' END AS label FROM documents"),
    "pass_rates": (pass_rates, f"WITH {X.CRITERIA} SELECT task_id, arm, count(*) AS n_criteria, round(sum(coalesce(score, 0) * weight) / sum(points * weight), 6) AS passrate FROM criteria GROUP BY 1, 2"),
    "rubric_verdicts": (rubric_verdicts, f"WITH {X.VERDICTS} SELECT * FROM rated"),
    "rubric_listing": (rubric_listing, f"WITH {X.VERDICTS} SELECT coalesce(bool_or(reason IS NOT NULL), false) AS has_issue, count(reason) AS n_issues FROM rated"),
    "invalid_names": (invalid_names, f"WITH {X.CRITERIA} SELECT task_id, arm, pos, name FROM criteria WHERE NOT regexp_matches(name, '^[a-z][a-z0-9]*(_[a-z0-9]+)*$')"),
    "repeated_names": (repeated_names, f"WITH {X.CRITERIA} SELECT task_id, arm, bool_or(uses > 1) AS has_repeats, count(*) FILTER (uses > 1) AS n_repeated_names FROM (SELECT task_id, arm, name, count(*) AS uses FROM criteria GROUP BY 1, 2, 3) GROUP BY 1, 2"),
    "expected_names": (expected_names, f"WITH {X.CRITERIA} SELECT task_id, arm, list_sort(list(DISTINCT name)) = list_sort(list_transform(range(1, count(*) + 1), lambda i: 'dim_' || i)) AS names_match FROM criteria GROUP BY 1, 2"),
    "contradictions": (contradictions, f"""WITH {X.CRITERIA}, hits AS (SELECT task_id, arm, pos, CASE
        WHEN score >= 4 THEN list_filter(['F ', '5-'], lambda w: contains(rationale, w)) WHEN score <= 2 THEN list_filter(['1-URGENT', 'O '], lambda w: contains(rationale, w)) END AS w FROM criteria)
        SELECT task_id, arm, pos, array_to_string(w, '|') AS words FROM hits WHERE len(w) > 0"""),
    "task_arms": (task_arms, f"WITH {X.TASKS} SELECT pair_id, task_type, arm FROM tasks, (VALUES ('baseline'), ('candidate')) a(arm)"),
    "pair_verdicts": (pair_verdicts, f"WITH {X.PAIRS} SELECT {_RECORD_COLS} FROM records"),
    "violation_counts": (violation_counts, f"WITH {X.PAIRS}, {_RULES} SELECT rule, count(*) AS n_tasks FROM rules GROUP BY 1"),
    "filtered_records": (filtered_records, f"WITH {_FULL} SELECT task_id, task_type, domain, candidate_passrate, threshold_ok FROM records_full WHERE domain = 'ASIA' AND (candidate_passrate >= 0.6 OR threshold_ok)"),
    "selected_tasks": (selected_tasks, f"WITH {X.TASKS} SELECT w.id AS pair_id, task_type, domain, language, requested::INT AS requested, pair_id IS NOT NULL AS known FROM (VALUES (7, 0), (3, 1), (1000000000000, 2)) w(id, requested) LEFT JOIN tasks ON pair_id = w.id"),
    "known_tasks": (known_tasks, f"WITH {X.TASKS} SELECT CASE WHEN pair_id % 3 = 0 THEN 'manifest' ELSE 'configured' END AS origin, count(*) AS n, sum(pair_id)::BIGINT AS ids FROM tasks GROUP BY 1"),
    "passrate_distribution": (passrate_distribution, f"WITH {X.VERDICTS} SELECT arm, round(min(passrate), 6) AS min, round(max(passrate), 6) AS max, round(avg(passrate), 6) AS mean, round(median(passrate), 6) AS median, round(coalesce(stddev_samp(passrate), 0), 6) AS std, count(*) AS count FROM rated WHERE passrate IS NOT NULL GROUP BY 1"),
    "mean_flags": (mean_flags, f"""WITH {X.VERDICTS}, m AS (SELECT avg(passrate) FILTER (arm = 'baseline') AS b, avg(passrate) FILTER (arm = 'candidate') AS c FROM rated)
        SELECT coalesce(b >= 0.7, false) AS baseline_high, coalesce(c <= 0.7, false) AS candidate_low, coalesce((c - b) / b >= 0.25, false) AS gain_ok FROM m"""),
    "paired_difference": (paired_difference, f"""WITH {X.PAIRS}, u AS (SELECT round(candidate_passrate * 10000)::BIGINT - round(baseline_passrate * 10000)::BIGINT AS d FROM records)
        SELECT round(avg(d) / 10000, 6) AS mean, round(median(d) / 10000, 6) AS median, round(coalesce(stddev_samp(d) / 10000, 0), 6) AS std, count(*) AS count,
        count(*) FILTER (d > 0) AS positive, count(*) FILTER (d < 0) AS negative, count(*) FILTER (d = 0) AS tie FROM u WHERE d IS NOT NULL HAVING count(*) > 0"""),
    "group_stats": (group_stats, f"""WITH {_FULL}, g AS (SELECT CASE WHEN grouping(task_type) = 0 THEN 'task_type' WHEN grouping(domain) = 0 THEN 'domain' ELSE 'language' END AS field,
          coalesce(CASE WHEN grouping(task_type) = 0 THEN task_type WHEN grouping(domain) = 0 THEN domain ELSE language END, '') AS value, count(*) AS n_tasks,
          (2 * sum(round(baseline_passrate * 10000)::BIGINT)::BIGINT + count(baseline_passrate)) // (2 * count(baseline_passrate)) / 10000.0::DOUBLE AS bm, (2 * sum(round(candidate_passrate * 10000)::BIGINT)::BIGINT + count(candidate_passrate)) // (2 * count(candidate_passrate)) / 10000.0::DOUBLE AS cm, min(candidate_passrate) AS cmin, max(candidate_passrate) AS cmax, count(*) FILTER (threshold_ok) AS n_ok
        FROM records_full GROUP BY GROUPING SETS ((task_type), (domain), (language)))
        SELECT field, value, n_tasks, bm AS baseline_mean, cm AS candidate_mean, cmin AS candidate_min, cmax AS candidate_max, n_ok AS n_threshold_ok FROM g"""),
    "batch_summary": (batch_summary, f"""WITH {X.PAIRS} SELECT count(*) AS n_tasks, count(*) FILTER (export_ok) AS n_passed, count(*) FILTER (threshold_ok) AS n_threshold_ok,
        min(baseline_passrate) AS baseline_min, max(baseline_passrate) AS baseline_max, (2 * sum(round(baseline_passrate * 10000)::BIGINT)::BIGINT + count(baseline_passrate)) // (2 * count(baseline_passrate)) / 10000.0::DOUBLE AS baseline_mean, count(baseline_passrate) AS baseline_count,
        min(candidate_passrate) AS candidate_min, max(candidate_passrate) AS candidate_max, (2 * sum(round(candidate_passrate * 10000)::BIGINT)::BIGINT + count(candidate_passrate)) // (2 * count(candidate_passrate)) / 10000.0::DOUBLE AS candidate_mean, count(candidate_passrate) AS candidate_count FROM records"""),
    "criterion_differences": (criterion_differences, f"WITH {X.VERDICTS}{_PAIRED} SELECT * FROM differences"),
    "criterion_agreement": (criterion_agreement, f"""WITH {X.VERDICTS}{_PAIRED} SELECT task_id, count(*) FILTER (in_b AND in_c) AS n_shared, count(*) FILTER (NOT in_c) AS n_only_baseline,
        count(*) FILTER (NOT in_b) AS n_only_candidate, count(*) FILTER (in_b AND in_c AND db <> dc) AS n_descriptions_differ,
        count(*) FILTER (in_b AND in_c AND sb = sc AND sb > -8) AS n_equal_scores,
        count(*) FILTER (in_b AND in_c) > 0 AND count(*) FILTER (in_b AND in_c AND sb = sc AND sb > -8) = 0 AS no_equal_score FROM paired GROUP BY 1"""),
    "submission_ids": (submission_ids, f"WITH {X.TASKS} SELECT pair_id, 'p1-607-' || task_type || '-' || lpad(seq::VARCHAR, greatest(2, length(seq::VARCHAR))::INT, '0') AS submission_id FROM (SELECT *, row_number() OVER (PARTITION BY task_type ORDER BY pair_id) AS seq FROM tasks)"),
    "reconciliation": (reconciliation, f"WITH {X.PAIRS}{_PUBLISHED} SELECT task_id, rule FROM mismatches"),
    "label_issues": (label_issues, f"WITH {X.PAIRS}{_PUBLISHED} SELECT task_id, label FROM published WHERE label = 'odd'"),
    "issues": (issues, f"""WITH {X.PAIRS}{_PUBLISHED}{_PAIRED}, {_RULES}, every AS (SELECT task_id, rule FROM mismatches UNION ALL SELECT task_id, 'unknown_label' FROM published WHERE label = 'odd'
        UNION ALL SELECT * FROM rules UNION ALL SELECT task_id, rule FROM differences) SELECT rule, count(*) AS n_issues, count(DISTINCT task_id) AS n_tasks FROM every GROUP BY 1"""),
    "finalize_status": (finalize_status, f"""WITH {X.PAIRS}, r AS (SELECT task_id, max(reason) FILTER (arm = 'baseline') AS rb, max(reason) FILTER (arm = 'candidate') AS rc, count(*) AS arms FROM rated GROUP BY 1)
        SELECT task_id, CASE WHEN rb IN ('missing', 'unscored', 'incomplete') OR rc IN ('missing', 'unscored', 'incomplete') THEN 'failed' WHEN NOT threshold_ok THEN 'partial' ELSE 'done' END AS status
        FROM records JOIN r USING (task_id)"""),
}
