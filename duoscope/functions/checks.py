"""Boolean expressions: formats, identities, thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from duoscope import constants as C
from duoscope.settings import THRESHOLDS, Thresholds

# Accepted formats.
CRITERION_NAME = r"^[a-z][a-z0-9]*(_[a-z0-9]+)*$"
TASK_ID = r"^CT-\d{4}$"
DATE = r"^\d{8}$"
URL_SCHEMES = ("https", "http", "git")


def valid_criterion_name(name: Column) -> Column:
    return F.coalesce(name.rlike(CRITERION_NAME), F.lit(False))


def valid_task_id(task_id: Column, pattern: str = TASK_ID) -> Column:
    return F.coalesce(task_id.rlike(pattern), F.lit(False))


def valid_date(date: Column) -> Column:
    return F.coalesce(date.rlike(DATE), F.lit(False))


def safe_path_component(value: Column, reserved: Sequence[str] = C.RESERVED_NAMES) -> Column:
    """False for traversal characters and reserved device names; empty is allowed."""
    traversal = (
        F.contains(value, F.lit(".."))
        | F.contains(value, F.lit("/"))
        | F.contains(value, F.lit("\\"))
        | F.contains(value, F.lit("\0"))
    )
    stem = F.upper(F.substring_index(value, ".", 1))
    return (value == "") | ~(traversal | stem.isin(*reserved))


def safe_url(url: Column, schemes: Sequence[str] = URL_SCHEMES) -> Column:
    """True for an allowed scheme with a host; what the host looks like is not judged."""
    scheme = F.lower(F.regexp_extract(url, r"\A([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.regexp_extract(url, r"\A[^:/]*://([^/?#]*)", 1)
    return F.coalesce(scheme.isin(*schemes) & (host != ""), F.lit(False))


def mentions(models: Column, words: Sequence[str]) -> Column:
    """True when any model name holds any of the words, ignoring case."""
    return F.exists(
        models,
        lambda m: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.lower(m), w)),
    )


def detected_provider(models: Column, keywords=C.PROVIDER_KEYWORDS) -> Column:
    """First provider, in priority order, that a model name points to."""
    chain = None
    for provider, words in keywords:
        hit = mentions(models, words)
        chain = F.when(hit, provider) if chain is None else chain.when(hit, provider)
    return chain.otherwise("unknown")


def expected_provider(arm: Column, providers: Mapping[str, str]) -> Column:
    chain = None
    for name, provider in providers.items():
        chain = F.when(arm == name, provider) if chain is None else chain.when(arm == name, provider)
    return chain


def identity_matches(
    models: Column, provider: Column, keywords: Mapping[str, Sequence[str]] = C.IDENTITY_KEYWORDS
) -> Column:
    """True when the models name the expected provider; other providers always match, no models never do."""
    chain = F.when(models.isNull() | (F.size(models) == 0), False)
    for name, words in keywords.items():
        chain = chain.when(provider == name, mentions(models, words))
    return chain.otherwise(F.lit(True))


def relative_gain(baseline: Column, candidate: Column) -> Column:
    """(candidate - baseline) / baseline; NULL when the baseline is 0 or absent."""
    return F.when(baseline > 0, (candidate - baseline) / baseline)


def rule_flags(baseline: Column, candidate: Column, t: Thresholds = THRESHOLDS) -> dict[str, Column]:
    """One boolean per acceptance rule; a rule whose arms are absent is False."""
    gain = F.when(baseline > 0, (candidate - baseline) / baseline <= t.gain_min).otherwise(
        candidate < t.gain_min
    )
    rules = {
        "baseline_over_limit": baseline >= t.baseline_max,
        "candidate_under_limit": candidate <= t.candidate_min,
        "candidate_not_better": candidate <= baseline,
        "gain_too_small": F.when(baseline.isNotNull(), gain),
    }
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}


def violations(baseline: Column, candidate: Column, t: Thresholds = THRESHOLDS) -> Column:
    """Array of the acceptance rules that a pair of pass rates breaks."""
    flags = rule_flags(baseline, candidate, t)
    return F.array_compact(F.array(*[F.when(flag, name) for name, flag in flags.items()]))
