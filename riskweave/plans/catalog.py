"""All registered queries."""

from __future__ import annotations

from riskweave.plans import analysis, basics, learning, reporting, risk, storage, streams, workflow  # noqa: F401
from riskweave.plans.registry import REGISTRY, Query


def catalog() -> dict[str, Query]:
    return dict(REGISTRY)
