"""The applicant mart: one row per applicant with all roll-ups joined."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lendlens.operators.clean import derive
from lendlens.operators.rollup import build_mart, payment_features, rollup_numeric, status_rollup
from lendlens.session import materialize
from lendlens.sources.tables import nan_to_null

KEY = "SK_ID_CURR"
TARGET = "TARGET"


def credit_history(bureau: DataFrame, balance: DataFrame | None = None, key: str = KEY) -> DataFrame:
    """Credit lines joined with their monthly statuses, rolled up per applicant."""
    if balance is not None:
        bureau = bureau.join(status_rollup(balance, "SK_ID_BUREAU"), "SK_ID_BUREAU", "left")
    return rollup_numeric(bureau, key, "BUREAU", exclude=("SK_ID_BUREAU",))


def applicant_mart(sources: dict[str, DataFrame], key: str = KEY, stored: bool = False) -> DataFrame:
    """Every source but the application is optional; an absent one leaves no columns behind. With ``stored``
    each roll-up is written before the join, so that only one history at a time has its shuffles on disk."""
    sources = {name: nan_to_null(df) for name, df in sources.items()}
    sides = []
    if "bureau" in sources:
        sides.append(credit_history(sources["bureau"], sources.get("bureau_balance"), key))
    for name, prefix in (
        ("previous_application", "PREV"),
        ("credit_card_balance", "CC"),
        ("pos_cash_balance", "POS"),
    ):
        if name in sources:
            sides.append(rollup_numeric(sources[name], key, prefix, exclude=("SK_ID_PREV",)))
    if "installments_payments" in sources:
        payments = payment_features(sources["installments_payments"])
        sides.append(rollup_numeric(payments, key, "INST", exclude=("SK_ID_PREV",)))
    if stored:
        sides = [materialize(side, "side") for side in sides]
        # small sides are broadcast: the applicants still spread over the cores
        sources["application"] = sources["application"].repartition(key)
    return build_mart(derive(sources["application"]), sides, key)
