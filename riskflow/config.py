"""One frozen configuration object for every rule, window and sink name.

The defaults are the reference application's fixed values; every operator
takes a ``FraudConfig`` so a caller can change a threshold without touching
code.  Nothing in here depends on the data size.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


# Fixed values (must equal the reference application for identical results).
# Path 1 rules, first match wins:   amount > 5000 -> HIGH_AMOUNT 0.9;
#                                   is_fraud = true -> LABELED_FRAUD 0.8;
#                                   otherwise NORMAL 0.1.
# Path 2 window: 2 minutes, slide 30 seconds, watermark delay 2 minutes,
#                velocity = window_amount / 2 (per minute of window).
# Path 2 reason, first match:       velocity > 2500 -> HIGH_VELOCITY;
#                                   window_count > 3 -> RAPID_TRANSACTIONS;
#                                   avg_amount > 3000 -> HIGH_AVERAGE;
#                                   otherwise PATTERN_DETECTED.
# Path 2 score, first match:        velocity > 5000 -> 0.95;
#                                   velocity > 2500 or window_count > 5 -> 0.85;
#                                   velocity > 1000 or window_count > 3
#                                     or avg_amount > 3000 -> 0.70;
#                                   otherwise 0.1.
# Flag threshold (both paths):      rule_score > 0.5.
# Topics: raw "transactions-raw", flags "flagged-transactions",
#         explained "explained-transactions", dead letters "flagged-dlq".
# Registry subject: "transactions-raw-value".  Wire header: 1 magic byte 0x00
# followed by a 4-byte big-endian schema id.
# Explainer: batch size 10, 3 attempts, exponential wait 2..10 seconds.
# Triggers: 5 seconds for flag queries, 10 seconds for the debug query.


@dataclass(frozen=True)
class FraudConfig:
    high_amount: float = 5000.0
    high_amount_score: float = 0.9
    labeled_fraud_score: float = 0.8
    normal_score: float = 0.1

    window_duration: str = "2 minutes"
    slide_duration: str = "30 seconds"
    watermark_delay: str = "2 minutes"

    velocity_high: float = 2500.0
    velocity_very_high: float = 5000.0
    velocity_medium: float = 1000.0
    count_rapid: int = 3
    count_very_rapid: int = 5
    avg_high: float = 3000.0
    windowed_scores: tuple = (0.95, 0.85, 0.70, 0.1)

    flag_threshold: float = 0.5

    raw_topic: str = "transactions-raw"
    flagged_topic: str = "flagged-transactions"
    explained_topic: str = "explained-transactions"
    dlq_topic: str = "flagged-dlq"
    registry_subject: str = "transactions-raw-value"

    flag_trigger: str = "5 seconds"

    explain_batch_size: int = 10
    explain_attempts: int = 3
    explain_wait_min: float = 2.0
    explain_wait_max: float = 10.0

    def with_(self, **changes) -> "FraudConfig":
        return replace(self, **changes)

    @property
    def window_minutes(self) -> float:
        """Velocity is amount per minute: window_amount / window length in
        minutes, derived from ``window_duration`` (2 for the default)."""
        n, unit = self.window_duration.split()
        scale = {"second": 1 / 60, "minute": 1.0, "hour": 60.0, "day": 1440.0}[unit.lower().rstrip("s")]
        return float(n) * scale


DEFAULT = FraudConfig()
