"""Invoices with signed prices, derived tax and USD totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money
from ..functions.text import flag_text
from ..operators.contracts import Rule, enforce, not_null
from ..operators.lookup import attach
from ..operators.reduce import Satellite, gather

# Fixed value: type name of the source database.
INVOICE_OWNER = "Pg::Invoice"

REPORT_COLUMNS = (
    "id", "invoice_number", "issued_at", "purchase_order_id", "created_at", "created_on",
    "subtotal_price", "total_price", "discount_amount", "tax", "currency_name", "conversion_rate",
    "document_type", "total_price_usd", "provider_id", "order_id", "shipping_cost", "cancelled",
    "uuid", "approved_for_payment", "discount",
)


def invoice_report(
    invoices: DataFrame, currencies: DataFrame, shippings: DataFrame, contract: str = "fail"
) -> DataFrame:
    """One row per invoice; documents other than standard ones count negative."""
    own = gather(
        "_invoice",
        Satellite(
            "currency", currencies.where(F.col("exchangable_type") == INVOICE_OWNER),
            "exchangable_id", ["conversion_rate", "currency"], pick="first",
        ),
        Satellite(
            "shipping", shippings.where(F.col("shipable_type") == INVOICE_OWNER),
            "shipable_id", ["cost"], pick="first",
        ),
    )
    kind = F.col("document_type")
    rows = (
        attach(invoices, own, "id", "_invoice")
        .withColumns(
            {
                "subtotal": money.signed_by_document(F.col("subtotal_price"), kind),
                "total": money.signed_by_document(F.col("total_price"), kind),
                "off": money.as_double(F.col("discount_amount")),
                "rate": F.coalesce(money.as_double(F.col("currency_conversion_rate")), F.lit(1.0)),
            }
        )
        .withColumn("shipped", money.follow_sign(F.col("shipping_cost"), F.col("total")))
    )
    computed = {
        "created_on": F.to_date("created_at"),
        "subtotal_price": F.col("subtotal"),
        "total_price": F.col("total"),
        "discount_amount": F.col("off"),
        "tax": F.col("total") - F.col("subtotal") - F.col("shipped") + F.col("off"),
        "currency_name": F.coalesce(F.col("currency_currency"), F.lit("USD")),
        "conversion_rate": F.col("rate"),
        "total_price_usd": money.positive(money.ieee_div(F.col("total"), F.col("rate"))),
        "shipping_cost": F.col("shipped"),
        "cancelled": flag_text(F.col("cancelled")),
    }
    rules = [
        Rule("no currency row", F.col("currency_id").isNotNull()),
        Rule("no shipping row", F.col("shipping_id").isNotNull()),
        *not_null("uuid"),
    ]
    columns = [computed.get(c, F.col(c)).alias(c) for c in REPORT_COLUMNS]
    return enforce(rows, rules, columns, contract, label="invoice")
