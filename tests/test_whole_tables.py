"""Queries that take whole tables leave no part and no write out."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_all_parts_are_expanded_and_merged(spark):
    parts = {r[0] for r in spark.read.parquet(f"{SF}/part.parquet").select("p_partkey").collect()}
    expanded = entry.queries()["slot_expansion_all"](spark, SF).collect()
    assert {r["seed"] for r in expanded} == parts and len(expanded) == 4 * len(parts)
    merged = entry.queries()["merged_pool_all"](spark, SF).collect()
    assert sorted(r["repo"] for r in merged) == sorted(parts)
