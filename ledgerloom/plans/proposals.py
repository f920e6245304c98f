"""Active proposals with their currency, tax, turn-around time and provider."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money, purchasing
from ..functions.text import flag_text, joined
from ..operators.contracts import Rule, enforce, not_null
from ..operators.lookup import DEFAULT_POLICY, SkewPolicy, attach, lookup
from ..operators.reduce import Satellite, gather
from .purchase_orders import PROPOSAL_OWNER, RETAIL_TAX

# Fixed value: totals of proposals created after this moment include tax.
TAXED_SINCE = "2018-06-01 00:00:00"

REPORT_COLUMNS = (
    "id", "active", "proposal_type", "exclude", "justifications", "user_full_name", "provider_id",
    "provider_name", "created_at", "created_on", "updated_at", "subtotal_price", "total_price",
    "tax", "total_price_no_tax", "currency_name", "conversion_rate", "total_price_usd",
    "total_price_with_tax_usd", "min_turnaround_time", "max_turnaround_time", "display_units",
    "tax_category", "order_id", "type_", "obsoleted", "state", "ware_id", "user_id", "uuid",
    "description", "commission_rate", "status",
)


def proposal_report(
    proposals: DataFrame,
    currencies: DataFrame,
    turn_around_times: DataFrame,
    taxes: DataFrame,
    providers: DataFrame,
    contract: str = "fail",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One row per active proposal of an order."""
    wanted = proposals.where(F.col("active") & F.col("order_id").isNotNull())
    own = gather(
        "_proposal",
        Satellite(
            "currency", currencies.where(F.col("exchangable_type") == PROPOSAL_OWNER),
            "exchangable_id", ["conversion_rate", "currency"],
        ),
        Satellite(
            "time", turn_around_times.where(F.col("turnaroundable_type") == PROPOSAL_OWNER),
            "turnaroundable_id", ["min", "max", "display_units"],
        ),
        Satellite(
            "tax", taxes.where(
                (F.col("taxable_type") == PROPOSAL_OWNER) & (F.col("type_") == RETAIL_TAX)
            ),
            "taxable_id", ["amount"],
        ),
    )
    names = providers.select(F.col("id").alias("_provider"), F.col("name").alias("provider_name"))
    rows = attach(wanted, own, "id", "_proposal")
    rows = lookup(rows, names, {"provider_id": "_provider"}, policy=policy, key_source=wanted)

    no_currency, no_time = F.col("currency_id").isNull(), F.col("time_id").isNull()
    rows = rows.withColumns(
        {
            "rate": money.rate_or_one(F.col("currency_id"), F.col("currency_conversion_rate")),
            "total": money.as_double(F.col("total_price")),
            "own_tax": money.as_double(F.col("tax_amount")),
        }
    ).withColumn(
        "untaxed",
        money.untaxed_after(F.col("total"), F.col("own_tax"), F.col("created_at"), TAXED_SINCE),
    )
    computed = {
        "active": flag_text(F.col("active")),
        "exclude": flag_text(F.col("exclude")),
        "justifications": joined(F.col("justifications")),
        "created_on": F.to_date("created_at"),
        "subtotal_price": money.as_double(F.col("subtotal_price")),
        "total_price": F.col("total"),
        "tax": F.col("own_tax"),
        "total_price_no_tax": F.col("untaxed"),
        "currency_name": F.when(no_currency, F.lit("USD")).otherwise(F.col("currency_currency")),
        "conversion_rate": F.col("rate"),
        "total_price_usd": money.ieee_div(F.col("untaxed"), F.col("rate")),
        "total_price_with_tax_usd": money.ieee_div(F.col("total"), F.col("rate")),
        "min_turnaround_time": F.when(no_time, F.lit(0)).otherwise(F.col("time_min")),
        "max_turnaround_time": F.when(no_time, F.lit(0)).otherwise(F.col("time_max")),
        "display_units": F.when(no_time, F.lit("None")).otherwise(F.col("time_display_units")),
        "obsoleted": flag_text(F.col("obsoleted")),
        "commission_rate": money.as_double(F.col("commission_rate")),
    }
    rules = [
        Rule("currency without rate", no_currency | F.col("currency_conversion_rate").isNotNull()),
        Rule("currency without code", no_currency | F.col("currency_currency").isNotNull()),
        *not_null("justifications", "uuid"),
    ]
    columns = [computed.get(c, F.col(c)).alias(c) for c in REPORT_COLUMNS]
    return enforce(rows, rules, columns, contract, label="proposal")


def adjusted_turn_around(turn_around_times: DataFrame) -> DataFrame:
    """Turn-around bounds in their display units."""
    units = F.col("display_units")
    return turn_around_times.select(
        "id",
        purchasing.turn_around_units(F.col("min"), units).alias("adjusted_min"),
        purchasing.turn_around_units(F.col("max"), units).alias("adjusted_max"),
    )
