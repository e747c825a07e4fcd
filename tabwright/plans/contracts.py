"""Contracts of the derived customer frame, as plain declarations."""

from __future__ import annotations

from tabwright.sources.contract import Contract


def _f(kind: str, policy: str, leaky: bool = False, **more) -> dict:
    return {"type": kind, "missing_policy": policy, "leaky": leaky, **more}


CHURN = Contract.from_dict(
    {
        "features": {
            "customer_id": _f("integer", "forbidden"),
            "location": _f("categorical", "impute_mode"),
            "segment": _f("categorical", "forbidden"),
            "acctbal": _f("float", "impute_zero"),
            "n_orders": _f("integer", "impute_zero"),
            "avg_total": _f("float", "impute_median"),
            "tenure_days": _f("integer", "impute_median"),
            "days_since_last": _f("integer", "impute_median"),
            "n_urgent": _f("integer", "impute_zero"),
            "post_orders": _f("integer", "allow", True),
            "first_post_date": _f("datetime", "allow", True),
        },
        "target": {"churn": _f("float", "forbidden", range=[0.0, 1.0])},
        "constraints": {
            "max_missing_percentage": 0.3,
            "min_unique_values": 2,
            "max_correlation_threshold": 0.95,
        },
        "feature_engineering": {
            "interaction_features": ["n_orders * avg_total", "n_urgent * acctbal", "tenure_days * n_orders"],
        },
    }
)

# A contract the frame breaks on purpose, to exercise every check.
STRICT = Contract.from_dict(
    {
        "features": {
            "customer_id": _f("integer", "forbidden"),
            "location": _f("integer", "allow"),
            "segment": _f("categorical", "forbidden", categories=["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]),
            "acctbal": _f("float", "impute_zero", range=[0.0, 9000.0]),
            "n_orders": _f("integer", "forbidden", range=[0, 1000]),
            "avg_total": _f("float", "forbidden"),
            "post_orders": _f("integer", "allow", True),
        },
        "target": {"churn": _f("float", "forbidden", range=[0.0, 1.0])},
    }
)
