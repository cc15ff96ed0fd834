"""The declared checks of staged trips and of the monthly mart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripflow.operators.quality import (
    ERROR,
    WARN,
    Check,
    accepted_values,
    not_null,
    relationships,
    unique,
)
from tripflow.schemas import GREEN, PAYMENT_DESCRIPTIONS, YELLOW


# A green trip must end in a zone of the table; for a yellow one it is a warning.
DROPOFF_SEVERITY = {GREEN.service: ERROR, YELLOW.service: WARN}


def service_checks(zones: DataFrame) -> list[Check]:
    """Checks of services staged together: a key is unique only within its service."""
    return [
        unique("service_type", "tripid", severity=WARN),
        not_null("tripid", severity=WARN),
        relationships("pickup_locationid", zones, "locationid", severity=WARN),
        *(
            relationships(
                "dropoff_locationid", zones, "locationid", severity, ("service_type", service)
            )
            for service, severity in DROPOFF_SEVERITY.items()
        ),
        accepted_values("payment_type", list(PAYMENT_DESCRIPTIONS), severity=WARN),
    ]


def mart_checks() -> list[Check]:
    return [not_null("revenue_monthly_total_amount", severity=ERROR)]
