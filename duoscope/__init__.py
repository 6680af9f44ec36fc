"""duoscope: paired-session analytics as Spark DataFrame operators."""

from duoscope.session import build_session
from duoscope.settings import Arms, Limits, Thresholds

__all__ = ["Arms", "Limits", "Thresholds", "build_session"]
