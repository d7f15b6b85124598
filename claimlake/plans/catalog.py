"""All registered plans: importing the plan modules fills the registry."""

from __future__ import annotations

from claimlake.plans import bronze_plans, gold_plans, journey_plans, log_plans, mapping_plans, quality_plans, silver_plans  # noqa: F401
from claimlake.plans import extra_plans, gold_rule_plans, runner_plans, stream_plans  # noqa: F401,E402
from claimlake.plans.registry import ORACLES, PLANS


def queries():
    return dict(PLANS)


def oracle_sql():
    return {k: v for k, v in ORACLES.items() if k in PLANS}
