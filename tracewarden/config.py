"""Run configuration, validated on the driver before any Spark job starts."""

from __future__ import annotations

import datetime as _dt
import math
from dataclasses import dataclass, field

# Severity names in rising order and the risk labels.
SEVERITIES = ("WARNING", "SUSPICIOUS", "CRITICAL")
RISK_LABELS = ("CLEAN", "LOW RISK", "MODERATE RISK", "HIGH RISK", "COMPROMISED")

# Words that mark a line as an error line.
ERROR_WORDS = (
    "alert",
    "critical",
    "denied",
    "error",
    "exception",
    "fail",
    "failed",
    "failure",
    "fatal",
    "panic",
    "traceback",
)

# how year-less stamps pass a New Year: only the first January line moves on, or all lines after it
ROLLOVERS = ("reference", "sticky")


@dataclass(frozen=True)
class ScanConfig:
    """Parameters of one integrity scan.

    ``block_lines`` is the scale knob, not a semantic one: ordered operators work on
    ``(source, block)`` groups of that many lines and stitch neighbouring blocks, so the
    largest group a task ever sees is bounded however large a single source is.
    """

    threshold_seconds: float = 300.0
    context_lines: int = 2
    min_severity: str = "WARNING"
    custom_format: str | None = None
    reference_year: int = field(default_factory=lambda: _dt.datetime.now().year)
    rollover: str = "reference"
    error_words: tuple[str, ...] = ERROR_WORDS
    block_lines: int = 200_000
    chain_chunk_lines: int = 5_000_000
    segment_lines: int = 200_000

    def __post_init__(self) -> None:
        if not 0 < self.threshold_seconds < math.inf:
            raise ValueError("threshold_seconds must be finite and greater than 0")
        if self.context_lines < 0:
            raise ValueError("context_lines must be 0 or greater")
        if self.min_severity not in SEVERITIES:
            raise ValueError(f"min_severity must be one of {', '.join(SEVERITIES)}")
        if not 1 <= self.reference_year <= 9999:
            raise ValueError("reference_year must be between 1 and 9999")
        if self.rollover not in ROLLOVERS:
            raise ValueError(f"rollover must be one of {', '.join(ROLLOVERS)}")
        if not self.error_words:
            raise ValueError("error_words must not be empty")
        for name in ("block_lines", "chain_chunk_lines", "segment_lines"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if self.custom_format:
            from tracewarden.functions.custom_format import compile_format

            compile_format(self.custom_format)  # raises ValueError on a bad format

    @property
    def effective_threshold(self) -> float:
        """The threshold that rows are compared with; never below a millisecond."""
        return max(0.001, float(self.threshold_seconds))
