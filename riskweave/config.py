"""Typed controls: thresholds, risk countries and the rule list."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, replace
from pathlib import Path

OPERATORS = ("ge",)


class ControlError(ValueError):
    """A control document that cannot be turned into a plan."""


@dataclass(frozen=True)
class Rule:
    rule_id: str
    rule_name: str
    feature: str
    threshold: float
    score: int
    severity: str = "MEDIUM"
    explanation: str = ""
    operator: str = "ge"

    def __post_init__(self):
        if self.operator not in OPERATORS:
            raise ControlError(f"unsupported operator {self.operator!r} in rule {self.rule_id}")
        if "|" in self.rule_name:
            raise ControlError(f"rule name may not contain a bar: {self.rule_name!r}")


# The default rule list (ids, names, thresholds, scores).
DEFAULT_RULES = (
    Rule("R01", "HIGH_AMOUNT_DEVIATION", "amount_ratio", 4, 30, "HIGH",
         "Amount is at least four times the expected amount."),
    Rule("R02", "HIGH_RISK_GEOGRAPHY", "high_risk_geo", 1, 20, "MEDIUM",
         "Destination is a configured risk country."),
    Rule("R03", "UNUSUAL_TIME", "night", 1, 10, "LOW",
         "Payment was made before 05:00 UTC."),
    Rule("R04", "VELOCITY_SPIKE", "velocity_1h", 4, 30, "HIGH",
         "Four or more earlier payments within the velocity window."),
    Rule("R05", "NEW_COUNTERPARTY", "new_counterparty_high_value", 1, 20, "MEDIUM",
         "First payment to this counterparty, at least twice the expected amount."),
    Rule("R06", "WATCHLIST_SIMILARITY", "screening_score", 88, 50, "HIGH",
         "Counterparty name resembles a listed entity."),
    Rule("R07", "REPEATED_THRESHOLD_ADJACENT", "adjacent_prior_24h", 2, 25, "MEDIUM",
         "Two or more earlier payments just below the reporting amount."),
)


@dataclass(frozen=True)
class Controls:
    version: str = "synthetic-rules-1.0"
    screening_version: str = "synthetic-screen-1.0"
    model_version: str = "synthetic-risk-1.0"
    screening_threshold: float = 88
    risk_threshold: int = 40
    high_risk_countries: tuple[str, ...] = ("XZ", "QZ")
    velocity_seconds: int = 3_600
    adjacent_seconds: int = 86_400
    adjacent_low: float = 9_500
    adjacent_high: float = 10_000
    rules: tuple[Rule, ...] = field(default=DEFAULT_RULES)

    def __post_init__(self):
        if not 0 <= self.screening_threshold <= 100:
            raise ControlError("screening threshold must lie in 0..100")
        ids = [r.rule_id for r in self.rules]
        if len(set(ids)) != len(ids):
            raise ControlError("rule ids must be unique")

    def with_(self, **changes) -> Controls:
        return replace(self, **changes)


def controls_from_dict(document: dict) -> Controls:
    """Controls from a parsed JSON document; keys it leaves out keep their defaults."""
    known = dict(document)
    rules = tuple(Rule(**r) for r in known.pop("rules", ()))
    if "high_risk_countries" in known:
        known["high_risk_countries"] = tuple(known["high_risk_countries"])
    return Controls(**known, **({"rules": rules} if rules else {}))


def load_controls(path: str | Path) -> Controls:
    return controls_from_dict(json.loads(Path(path).read_text(encoding="utf-8")))


def controls_digest(controls: Controls) -> str:
    return hashlib.sha256(json.dumps(asdict(controls), sort_keys=True).encode()).hexdigest()


def run_key(rows: int, seed: int, controls: Controls) -> str:
    """Key that isolates the case state of one run configuration from another's.

    Fixed value: the layout of the hashed text and the 12 digits kept.
    """
    text = f"features-v2:{rows}:{seed}:{json.dumps(asdict(controls), sort_keys=True)}"
    return hashlib.sha256(text.encode()).hexdigest()[:12]
