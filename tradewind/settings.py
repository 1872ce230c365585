"""Run parameters shared by the dataset builders."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

CUSTOMER = "customer_num"
PRODUCT = "srp_2_desc"
PAIR = [CUSTOMER, PRODUCT]
INVOICE = [CUSTOMER, PRODUCT, "dtl_invoice_num"]


@dataclass(frozen=True)
class Settings:
    """What the analyst chooses for one run."""

    cutoff: dt.date = dt.date(1999, 12, 31)
    near_sale_days: int = 365
    max_days: int = 5000
    tolerance_days: int = 90


DEFAULTS = Settings()
