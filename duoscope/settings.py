"""Parameters shared by operators and reports."""

from __future__ import annotations

from dataclasses import dataclass

from duoscope import constants as C


@dataclass(frozen=True)
class Arms:
    """Names of the two arms as they appear in the ``arm`` column."""

    baseline: str = "baseline"
    candidate: str = "candidate"
    baseline_provider: str = "qwen"
    candidate_provider: str = "claude"

    @property
    def names(self) -> tuple[str, str]:
        return (self.baseline, self.candidate)

    @property
    def providers(self) -> dict[str, str]:
        return {self.baseline: self.baseline_provider, self.candidate: self.candidate_provider}


@dataclass(frozen=True)
class Thresholds:
    """Acceptance rule for one pair of pass rates."""

    baseline_max: float = C.BASELINE_MAX
    candidate_min: float = C.CANDIDATE_MIN
    gain_min: float = C.GAIN_MIN


@dataclass(frozen=True)
class Limits:
    """Bounds on rubrics and sessions."""

    min_criteria: int = C.MIN_CRITERIA
    max_criteria: int = C.MAX_CRITERIA
    min_lines: int = C.MIN_LINES
    min_salvage_lines: int = C.MIN_SALVAGE_LINES
    min_turns: int = C.MIN_TURNS
    max_turns: int = C.MAX_TURNS


ARMS = Arms()
THRESHOLDS = Thresholds()
LIMITS = Limits()
