"""Orders with their provider, requester and milestone dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import canonical
from ..operators.contracts import enforce, not_null
from ..operators.lookup import (
    DEFAULT_POLICY,
    Lookup,
    SkewPolicy,
    attach,
    is_small,
    keep_related,
    lookup,
    lookups,
)
from ..operators.reduce import latest_per_name

# Names of the dated steps of an order.
STEPS = {
    "approval_date": "approval date",
    "review_date": "review date",
    "submission_date": "submission date",
    "completion_date": "completion date",
}

REPORT_COLUMNS = (
    "id", "provider_id", "provider_name", "request_id", "user_email", "client_id",
    "organization_id", "obligations", "state", "declined", "order_cancelled", "request_cancelled",
    "last_computed_status", "uuid", "created_at", "updated_at", "approval_date", "review_date",
    "submission_date", "completion_date", "booster",
)


def step_dates(timepoints: DataFrame, timepoint_key: str = "order_id") -> DataFrame:
    """The four step dates per order: the last timepoint of each name.

    With `timepoint_key="id"` a timepoint is matched by its own id instead of its order, so an order
    gets at most one date.
    """
    return latest_per_name(timepoints, timepoint_key, "name", "date", STEPS)


def order_report(
    orders: DataFrame,
    providers: DataFrame,
    requests: DataFrame,
    users: DataFrame,
    timepoints: DataFrame,
    timepoint_key: str = "order_id",
    contract: str = "fail",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One row per order; organization and user come from the request of the order.

    When requests and users are small, both are broadcast onto the orders. Otherwise they are joined
    first, on the few columns needed, and looked up for both at once.
    """
    if timepoint_key == "id":
        timepoints = keep_related(timepoints, orders, {"order_id": "id"}, policy=policy)
    steps = step_dates(timepoints, timepoint_key).withColumnRenamed(timepoint_key, "_order")
    emails = users.select(F.col("id").alias("_user"), F.col("email").alias("user_email"))
    asked = requests.select(
        F.col("id").alias("_request"),
        F.col("organization_id").alias("_organization"),
        F.col("user_id").alias("_asker"),
    )
    names = providers.select(F.col("id").alias("_provider"), F.col("name").alias("provider_name"))

    rows = attach(orders, steps, "id", "_order")
    by_request, by_asker = {"request_id": "_request"}, {"_asker": "_user"}
    if is_small(asked, policy) and is_small(emails, policy):
        foreign = [Lookup(asked, by_request), Lookup(emails, by_asker)]
    else:
        asked = lookup(asked, emails, by_asker, spread_by=("_request",), policy=policy)
        foreign = [Lookup(asked, by_request)]
    foreign.append(Lookup(names, {"provider_id": "_provider"}))
    rows = lookups(rows, foreign, orders, policy=policy)
    computed = {
        "organization_id": F.col("_organization"),
        "obligations": canonical(F.col("obligations")),
        **{step: F.to_date(step) for step in STEPS},
    }
    columns = [computed.get(c, F.col(c)).alias(c) for c in REPORT_COLUMNS]
    return enforce(rows, not_null("request_id", "booster"), columns, contract, label="order")
