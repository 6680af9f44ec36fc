"""The given tables in the shapes of the operators, as DataFrames and as SQL.

Rubric rows come from ``orders``: a customer's orders in blocks of ten make one
rubric each, so every order belongs to exactly one. Ledger writes come from
``events``, sessions from ``conversations``, pools from ``part`` and ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 10
PEOPLE = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rubric rows, some of them with an absent score, no rationale, a bad or a repeated name."""
    key = F.col("o_orderkey")
    k = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    orders = table(spark, sf_dir, "orders").withColumn("k", k).withColumn("pos", F.col("k") % BLOCK + 1)
    name = F.when(key % 101 == 0, F.concat(F.lit("Dim "), F.col("pos"))).when(key % 71 == 0, "dim_1").otherwise(F.concat(F.lit("dim_"), F.col("pos")))
    return orders.select(
        F.expr(f"o_custkey div 2 * 1000 + k div {BLOCK}").alias("task_id"),
        F.when(F.col("o_custkey") % 2 == 0, "baseline").otherwise("candidate").alias("arm"),
        "pos",
        F.when(key % 97 != 0, F.left("o_orderpriority", F.lit(1)).cast("int")).alias("score"),
        F.lit(5).alias("points"),
        F.when(F.col("o_orderstatus") == "P", 2.0).otherwise(1.0).alias("weight"),
        F.lit("likert").alias("type"),
        name.alias("name"),
        F.col("o_orderpriority").alias("description"),
        F.when(key % 89 == 0, "").otherwise(F.concat_ws(" ", "o_orderstatus", "o_orderpriority")).alias("rationale"),
    )


CRITERIA = f"""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS k FROM orders
), criteria AS (
  SELECT (o_custkey // 2) * 1000 + k // {BLOCK} AS task_id,
    CASE WHEN o_custkey % 2 = 0 THEN 'baseline' ELSE 'candidate' END AS arm,
    k % {BLOCK} + 1 AS pos,
    CASE WHEN o_orderkey % 97 <> 0 THEN CAST(left(o_orderpriority, 1) AS INT) END AS score,
    5 AS points, CASE WHEN o_orderstatus = 'P' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, 'likert' AS type,
    CASE WHEN o_orderkey % 101 = 0 THEN 'Dim ' || (k % {BLOCK} + 1) WHEN o_orderkey % 71 = 0 THEN 'dim_1'
      ELSE 'dim_' || (k % {BLOCK} + 1) END AS name,
    o_orderpriority AS description,
    CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE o_orderstatus || ' ' || o_orderpriority END AS rationale
  FROM numbered
)"""

VERDICTS = CRITERIA + """, filled AS (
  SELECT * REPLACE (coalesce(score, 0) AS score) FROM criteria
), facts AS (
  SELECT task_id, arm, count(*) AS n_criteria,
    bool_and(score = 0 AND rationale = '') AS is_unscored,
    bool_and(score BETWEEN 1 AND 5 AND points = 5 AND type = 'likert' AND rationale <> '') AS rows_complete,
    min(CASE WHEN NOT score BETWEEN 1 AND 5 THEN pos END) AS bad_score_pos,
    min(CASE WHEN rationale = '' THEN pos END) AS no_rationale_pos,
    bool_and(regexp_matches(name, '^[a-z][a-z0-9]*(_[a-z0-9]+)*$')) AS names_valid,
    sum(score * weight) / sum(points * weight) AS raw
  FROM filled GROUP BY 1, 2
), verdicts AS (
  SELECT *, CASE WHEN is_unscored THEN 'unscored' WHEN n_criteria NOT BETWEEN 7 AND 10 THEN 'wrong_count'
      WHEN bad_score_pos IS NOT NULL THEN 'score_out_of_range' WHEN no_rationale_pos IS NOT NULL THEN 'no_rationale'
      WHEN NOT rows_complete THEN 'incomplete' WHEN NOT names_valid THEN 'invalid_name' END AS reason
  FROM facts
), rated AS (
  SELECT task_id, arm, n_criteria, reason,
    CASE reason WHEN 'score_out_of_range' THEN bad_score_pos WHEN 'no_rationale' THEN no_rationale_pos END AS at_pos,
    CASE WHEN reason IS NULL THEN round(raw, 4) END AS passrate
  FROM verdicts
)"""

PAIRS = VERDICTS + """, pairs AS (
  SELECT task_id, max(CASE WHEN arm = 'baseline' THEN passrate END) AS b, max(CASE WHEN arm = 'candidate' THEN passrate END) AS c
  FROM rated GROUP BY 1
), judged AS (
  SELECT *, coalesce(b >= 0.7, false) AS over, coalesce(c <= 0.7, false) AS under, coalesce(c <= b, false) AS worse,
    coalesce(CASE WHEN b > 0 THEN (c - b) / b <= 0.25 WHEN b IS NOT NULL THEN c < 0.25 END, false) AS small
  FROM pairs
), records AS (
  SELECT j.task_id, b AS baseline_passrate, c AS candidate_passrate,
    CASE WHEN b > 0 THEN round((c - b) / b, 4) END AS relative_gain,
    over AS baseline_over_limit, under AS candidate_under_limit, worse AS candidate_not_better, small AS gain_too_small,
    NOT (over OR under OR worse OR small) AND b IS NOT NULL AND c IS NOT NULL AS threshold_ok,
    NOT (over OR under OR worse OR small) AND (b IS NOT NULL OR c IS NOT NULL) AS export_ok
  FROM judged j
)"""

TASKS = """
tasks AS (
  SELECT c_custkey // 2 AS pair_id, arg_min(c_mktsegment, c_custkey) AS task_type, arg_min(r_name, c_custkey) AS domain, arg_min(n_name, c_custkey) AS language
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
)"""


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task dimensions: segment, region and nation of the first of each pair of customers."""
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    first = table(spark, sf_dir, "customer").groupBy(F.expr("c_custkey div 2").alias("pair_id")).agg(
        F.min(F.struct("c_custkey", "c_mktsegment", "c_nationkey")).alias("c")
    )
    return first.join(nation, F.col("c.c_nationkey") == F.col("n_nationkey")).select(
        "pair_id", F.col("c.c_mktsegment").alias("task_type"), F.col("r_name").alias("domain"), F.col("n_name").alias("language")
    )


# Stage of each event type.
EVENT_STAGES = {"view": "prepare", "click": "run", "signup": "collect", "purchase": "score", "error": "finalize"}


def ledger_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended ledger writes: some merge only (no status), some delete the cell."""
    k = F.get_json_object("props", "$.k").cast("int")
    stage = F.create_map(*[F.lit(x) for kv in EVENT_STAGES.items() for x in kv])[F.col("event_type")]
    has_arm = F.col("event_type").isin("click", "signup", "purchase")
    arm = F.when(has_arm, F.when(F.col("event_id") % 2 == 0, "baseline").otherwise("candidate"))
    status = F.when(k % 7 == 0, "failed").when(k % 7 == 1, "partial").when(k % 7 == 2, "running").when(k % 31 == 3, "permanently_failed").when(k % 7 != 3, "done")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("task_id"), stage.alias("stage"), arm.alias("arm"), F.col("event_id").alias("seq"),
        status.alias("status"), F.when(k % 3 == 0, k % 4).alias("retry_count"), F.when(k % 2 == 0, F.col("value")).alias("duration_s"),
        (k % 19 == 0).alias("deleted"),
    )


STATE = """
writes AS (
  SELECT user_id AS task_id,
    CASE event_type WHEN 'view' THEN 'prepare' WHEN 'click' THEN 'run' WHEN 'signup' THEN 'collect' WHEN 'purchase' THEN 'score' WHEN 'error' THEN 'finalize' END AS stage,
    CASE WHEN event_type IN ('click', 'signup', 'purchase') THEN CASE WHEN event_id % 2 = 0 THEN 'baseline' ELSE 'candidate' END END AS arm,
    event_id AS seq, CAST(json_extract(props, '$.k') AS INT) AS k, value
  FROM events
), coded AS (
  SELECT *, CASE WHEN k % 7 = 0 THEN 'failed' WHEN k % 7 = 1 THEN 'partial' WHEN k % 7 = 2 THEN 'running'
      WHEN k % 31 = 3 THEN 'permanently_failed' WHEN k % 7 <> 3 THEN 'done' END AS status,
    CASE WHEN k % 3 = 0 THEN k % 4 END AS retry_count, CASE WHEN k % 2 = 0 THEN value END AS duration_s, k % 19 = 0 AS deleted
  FROM writes
), since AS (
  SELECT *, coalesce(max(seq) FILTER (deleted) OVER cell, -1) AS gone,
    coalesce(max(seq) FILTER (status IS NOT NULL AND NOT deleted) OVER cell, -1) AS put
  FROM coded WINDOW cell AS (PARTITION BY task_id, stage, arm)
), state AS (
  SELECT task_id, stage, arm, arg_max(status, seq) FILTER (status IS NOT NULL) AS status,
    arg_max(retry_count, seq) FILTER (retry_count IS NOT NULL) AS retry_count,
    arg_max(duration_s, seq) FILTER (duration_s IS NOT NULL AND seq >= put) AS duration_s, max(seq) AS seq
  FROM since WHERE NOT deleted AND seq > gone GROUP BY 1, 2, 3
)"""

CELLS = STATE + """, stages(stage, stage_rank, armed) AS (
  VALUES ('prepare', 0, false), ('run', 1, true), ('collect', 2, true), ('score', 3, true), ('finalize', 4, false)
), should AS (
  SELECT task_id, stage, stage_rank, a.arm FROM (SELECT DISTINCT user_id AS task_id FROM events), stages
  JOIN (VALUES ('baseline', true), ('candidate', true), (NULL, false)) a(arm, armed) USING (armed)
), cells AS (
  SELECT s.*, t.status, t.retry_count, t.duration_s,
    CASE WHEN status IN ('done', 'partial', 'failed') THEN status ELSE 'pending' END AS class
  FROM should s LEFT JOIN state t ON s.task_id = t.task_id AND s.stage = t.stage AND s.arm IS NOT DISTINCT FROM t.arm
)"""


def session_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session events: a conversation is a session, a turn a line; models and ids are made from the keys."""
    conv = F.col("conv_id")
    model = F.when(conv % 11 == 0, "").when(conv % 2 == 0, "Qwen-plus").when(conv % 7 == 0, "Anthropic-x").otherwise("claude-3")
    return table(spark, sf_dir, "conversations").select(
        conv.alias("session"), F.col("turn").alias("line_no"), F.col("role").alias("type"),
        F.when(conv % 13 != 0, F.concat(F.lit("s"), conv)).alias("session_id"), model.alias("model"),
        F.concat(F.lit("t"), F.lpad(F.col("turn").cast("string"), 6, "0")).alias("timestamp"), "text",
    )


LINES = """
lines AS (
  SELECT conv_id AS session, turn AS line_no, role AS type, CASE WHEN conv_id % 13 <> 0 THEN 's' || conv_id END AS session_id,
    CASE WHEN conv_id % 11 = 0 THEN '' WHEN conv_id % 2 = 0 THEN 'Qwen-plus' WHEN conv_id % 7 = 0 THEN 'Anthropic-x' ELSE 'claude-3' END AS model,
    't' || lpad(turn::VARCHAR, 6, '0') AS timestamp, text
  FROM conversations
), facts AS (
  SELECT session, count(*) AS line_count, count(*) FILTER (type = 'user') AS user_turns, min(session_id) AS session_id,
    coalesce(list_sort(list(DISTINCT model) FILTER (type = 'assistant' AND model <> '')), []) AS models,
    arg_min(timestamp, line_no) FILTER (type = 'user') AS first_user_at, arg_max(timestamp, line_no) AS last_at,
    arg_min(text, line_no) FILTER (type = 'user' AND text <> '') AS first_user_query
  FROM lines GROUP BY 1
)"""


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects by key (brand) in order of their number."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("key"), F.col("p_partkey").alias("repo"), F.col("p_partkey").alias("pos"), F.col("p_size").alias("stars"),
        F.col("p_type").alias("kind"), F.col("p_retailprice").alias("price"),
    )


def used(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects that two deliveries used."""
    items = table(spark, sf_dir, "lineitem")
    one = items.filter("l_returnflag = 'R' AND l_quantity >= 48").select(F.col("l_partkey").alias("repo"))
    two = items.filter("l_linestatus = 'F' AND l_discount >= 0.1 AND l_quantity >= 45").select(F.col("l_partkey").alias("repo"))
    from duoscope.operators.pool import used_projects

    return used_projects([one, two])


POOL = """
pool AS (SELECT p_brand AS key, p_partkey AS repo, p_partkey AS pos, p_size AS stars, p_type AS kind, p_retailprice AS price FROM part),
used AS (
  SELECT l_partkey AS repo FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 48
  UNION SELECT l_partkey FROM lineitem WHERE l_linestatus = 'F' AND l_discount >= 0.1 AND l_quantity >= 45
)"""
