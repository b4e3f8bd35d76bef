"""Contracts of the layers that the jobs write."""

from __future__ import annotations

from tallyloom.sources.layouts import Contract

DEAL_KEY = {"year_month": "int", "reporting_regulator_code": "string", "deal_id": "string"}
# --- fixed values: what the end of a name says about its type -------------------------
NAME_RULES = (
    (r"_flag$", "string"),
    (r"_amt(_|$)", "double"),
    (r"_gbp$", "double"),
    (r"_(code|desc|type)$", "string"),
    (r"_rk$", "int"),
)
# Counterparties outgrow the range of the other keys.
WIDE_KEYS = {"counterparty_rk": "bigint", "provider_counterparty_rk": "bigint"}


def _contract(layer: str, unique: bool, **columns: str) -> Contract:
    """Every layer has the deal key, never null, which tells rows apart where ``unique``."""
    return Contract(layer, DEAL_KEY | columns, NAME_RULES, tuple(DEAL_KEY), tuple(DEAL_KEY) if unique else (), WIDE_KEYS)


CONTRACTS = {
    "staged": _contract("staged", True, adjust_flag="string", flow_type="string", sys_code="string"),
    "sub_exposures": _contract("sub_exposures", False, mitigant_id="bigint", adjust_flag="string"),
    "deals": _contract("deals", True, adjust_flag="string", flow_type="string", rwa_approach_code="string"),
    "mart": _contract("mart", False, adjust_flag="string", flow_type="string", rwa_approach_code="string", mitigant_id="bigint"),
}
