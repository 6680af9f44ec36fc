"""Text expressions: message text, truncation, cleaning of free-form output."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from duoscope import constants as C

# Marks of cut text.
MIDDLE_CUT = "\n\n[... truncated ...]\n\n"
SUMMARY_CUT = "\n\n[... 轨迹中段省略 ...]\n\n"

# Fixed value: start of the meta lines some tools put before their output.
META_PREFIX = r"\[__claude_meta:"

# Fixed value: marker of one score tier inside a description.
TIER = r"(?U)(?<!\d)([1-5])\s*分\s*[：:]"


#: Characters that count as white space at the ends of a text.
BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(text: Column) -> Column:
    """Remove white space, line breaks included, from both ends, in one pass over each end."""
    return F.btrim(text, F.lit(BLANKS))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, however often ``use`` names it and wherever a filter on the result is moved."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def is_kind(variant: Column, kind: str) -> Column:
    """True when a VARIANT holds an ``OBJECT``, ``ARRAY`` or ``STRING``."""
    if kind == "ARRAY":
        return F.coalesce(F.try_variant_get(variant, "$", "array<variant>").isNotNull(), F.lit(False))
    if kind == "OBJECT":
        return F.coalesce(F.try_variant_get(variant, "$", "map<string,variant>").isNotNull(), F.lit(False))
    return F.coalesce(F.schema_of_variant(variant).startswith(kind), F.lit(False))


def user_text(content: Column) -> Column:
    """Plain text of a message content that is a string or a list of blocks."""
    blocks = F.try_variant_get(content, "$", "array<variant>")

    def block_text(block: Column) -> Column:
        is_text = F.try_variant_get(block, "$.type", "string") == "text"
        text = F.coalesce(F.try_variant_get(block, "$.text", "string"), F.lit(""))
        return F.when(is_kind(block, "OBJECT"), F.when(is_text, text)).when(
            is_kind(block, "STRING"), F.try_variant_get(block, "$", "string")
        )

    joined = F.array_join(F.filter(F.transform(blocks, block_text), lambda t: t.isNotNull()), "\n")
    return (
        F.when(blocks.isNotNull(), joined)
        .when(is_kind(content, "STRING"), F.try_variant_get(content, "$", "string"))
        .otherwise(F.lit(""))
    )


def head_tail(text: Column, budget: int, head_share: float = 0.3, marker: str = MIDDLE_CUT) -> Column:
    """Keep the start and the end of a text that is longer than ``budget``."""
    head = int(budget * head_share)
    cut = F.concat(
        F.left(text, F.lit(head)), F.lit(marker), F.right(text, F.lit(budget - head))
    )
    return F.when(F.length(text) > budget, cut).otherwise(text)


# Fixed value: code fence around an answer.
FENCE = "```"


def without_meta(raw: Column) -> Column:
    """A stripped answer without the meta lines at its start, which go in one possessive match."""
    # The prefix is a pattern; at the start of a text it is the literal below.
    literal = META_PREFIX.replace("\\", "")
    return bound(strip(raw), lambda t: F.when(F.startswith(t, F.lit(literal)), F.regexp_replace(t, rf"\A(?>(?:{META_PREFIX}[^\n]*+\n\s*+)++)", "")).otherwise(t))


def _unfenced(body: Column) -> Column:
    """What follows the first line of a text, without a fence at its end."""
    at_end = bound(strip(body), lambda t: F.when(F.right(t, F.lit(3)) == FENCE, strip(F.left(t, F.length(t) - 3))).otherwise(body))

    def rest(text: Column) -> Column:
        return bound(F.instr(text, "\n"), lambda at: F.when(at > 0, F.substring(text, at + 1, F.length(text))).otherwise(F.lit("")))

    return bound(at_end, rest)


def _fenced_block(body: Column) -> Column:
    """Content of the first closed fence that has no language or ``toml``; null when there is none."""

    def content(inner: Column) -> Column:
        return bound(F.substring_index(inner, "\n", 1), lambda line: F.when(
            F.contains(inner, F.lit("\n")) & strip(line).isin("", "toml"), strip(F.substring(inner, F.length(line) + 2, F.length(inner)))))

    return bound(F.split(body, FENCE, 3), lambda parts: F.when(F.size(parts) == 3, bound(F.get(parts, F.lit(1)), content)))


def clean_output(raw: Column) -> Column:
    """Drop meta lines, leading headings and code fences around an answer.

    Leading lines go in one possessive match each, which needs no stack however
    many there are. Each step is evaluated once per text, and only on texts that have
    what it drops.
    """
    headless = bound(without_meta(raw), lambda t: F.when(F.startswith(t, F.lit("# ")), F.regexp_replace(t, r"\A(?>(?:# [^\n]*+\n\s*+)++)", "")).otherwise(t))
    return bound(headless, lambda body: F.when(F.startswith(body, F.lit(FENCE)), _unfenced(body)).when(
        F.contains(body, F.lit(FENCE)), F.coalesce(_fenced_block(body), body)).otherwise(body))


def _marked(body: Column, markers: Sequence[str], use: Callable[[Column], Column]) -> Column:
    """First that is not null of ``use(place)``, over the places of the markers in a text, in any case; 0 is nowhere."""
    return bound(F.lower(body), lambda low: F.coalesce(*[bound(F.instr(low, m.lower()), use) for m in markers]))


def toml_section(raw: Column, markers: Sequence[str] = C.BAD_PATTERN_MARKERS) -> Column:
    """The rubric part of an answer, without the trailing pattern section."""

    def without_section(body: Column) -> Column:
        return F.coalesce(_marked(body, markers, lambda at: F.when(at > 1, strip(F.left(body, at - 1)))), body)

    def without_preface(body: Column) -> Column:
        def rest(start: Column) -> Column:
            return F.when((start > 0) & ~strip(body).startswith("[["), F.substring(body, start, F.length(body))).otherwise(body)

        return bound(F.instr(body, "[[criterion]]"), rest)

    return bound(bound(clean_output(raw), without_section), without_preface)


def bad_pattern_label(
    raw: Column,
    patterns: Sequence[str] = tuple(C.BAD_PATTERNS),
    markers: Sequence[str] = C.BAD_PATTERN_MARKERS,
    none_words: Sequence[str] = C.BAD_PATTERN_NONE,
    none_within: int = 120,
) -> Column:
    """First known pattern named after the marker, or an empty string.

    A "none" word counts only in the section's first ``none_within`` characters (the rule
    of the label format); patterns are looked for in the whole section.
    """

    def section(body: Column) -> Column:
        return _marked(body, markers, lambda at: F.when(at > 0, F.substring(body, at, F.length(body))))

    def label(part: Column) -> Column:
        none_said = bound(F.left(part, F.lit(none_within)), lambda head: F.exists(F.array(*[F.lit(w) for w in none_words]), lambda w: F.contains(head, w)))
        return F.when(part.isNull() | none_said, F.lit("")).otherwise(F.coalesce(*[F.when(F.contains(part, F.lit(p)), F.lit(p)) for p in patterns], F.lit("")))

    return bound(bound(clean_output(raw), section), label)


def has_score_tiers(description: Column) -> Column:
    """True when tiers 1 to 5 are all marked and each has at least 5 characters."""
    tiers = F.array_distinct(F.regexp_extract_all(description, F.lit(TIER), F.lit(1)))
    parts = F.split(description, TIER)
    bodies = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    long_enough = F.forall(
        bodies, lambda b: F.length(F.regexp_replace(strip(b), r"[。.，,]+\z", "")) >= 5
    )
    return F.coalesce((F.size(tiers) == 5) & long_enough, F.lit(False))


def keyword_hits(text: Column, words: Sequence[str]) -> Column:
    """The given words that occur in the text, in the given order."""
    return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))


def contradiction_hits(
    score: Column,
    rationale: Column,
    negative: Sequence[str] = C.NEGATIVE_WORDS,
    positive: Sequence[str] = C.POSITIVE_WORDS,
) -> Column:
    """Words in the rationale that speak against the score (empty when none)."""
    return (
        F.when(score >= 4, keyword_hits(rationale, negative))
        .when(score <= 2, keyword_hits(rationale, positive))
        .otherwise(F.array().cast("array<string>"))
    )
