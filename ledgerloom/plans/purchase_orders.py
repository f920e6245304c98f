"""Purchase-order report, its retail totals and the bare status columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money, purchasing
from ..functions.text import flag_text, joined
from ..operators.contracts import Rule, enforce, not_null
from ..operators.lookup import DEFAULT_POLICY, Lookup, SkewPolicy, attach, lookups
from ..operators.reduce import Satellite, gather

# Type names of the source database.
CUSTOMER_TYPES = ("Pg::CustomerPurchaseOrder", "Pg::PurchaseOrder")
PARTNER_TYPE = "Pg::ProviderPurchaseOrder"
ORDER_OWNERS = ("Pg::PurchaseOrderBase", "Pg::PurchaseOrderBaseInit")
PROPOSAL_OWNER = "Pg::ProposalBase"
RETAIL_TAX = "Pg::RetailTax"
NEW_REQUEST = "new_request"

REPORT_COLUMNS = (
    "id", "ad_po_number", "po_number", "po_created_at", "po_submission_date", "status",
    "created_at", "proposal_id", "total_price", "subtotal_price", "provider_id", "provider_name",
    "supplier_id", "justifications", "currency", "conversion_rate", "total_price_usd",
    "subtotal_price_usd", "tax_amount", "tax_percent", "tax_amount_usd", "shipping_cost",
    "shipping_cost_usd", "commission_rate", "order_id", "provider_shipping_address_id",
    "customer_shipping_address_id", "cpo_id", "uuid", "rejected", "obsoleted", "type_",
    "supplier_updated", "updated_at", "user_id", "payment_terms", "request_id",
)


def status_of_row():
    """Status ladder over the columns of a purchase order."""
    return purchasing.po_status(
        F.col("obsoleted"), F.col("version_number"), F.col("referenced_po_id"),
        F.col("completed"), F.col("rejected"), F.col("po_number"),
    )


def with_status(purchase_orders: DataFrame) -> DataFrame:
    """Status and the three flags behind it, for every purchase order."""
    return purchase_orders.select(
        "id",
        status_of_row().alias("status"),
        purchasing.is_amended(F.col("version_number"), F.col("referenced_po_id")).alias("updated"),
        purchasing.is_requisition(F.col("po_number")).alias("purchase_requisition"),
        (~purchasing.is_requisition(F.col("po_number"))).alias("purchase_order"),
    )


def partner_satellite(purchase_orders: DataFrame) -> Satellite:
    partners = purchase_orders.where(F.col("type_") == PARTNER_TYPE)
    return Satellite("partner", partners, "cpo_id", ["ad_po_number"])


def partner_number():
    """The partner's number replaces the own one whenever a partner row exists, even a null one."""
    return F.when(F.col("partner_id").isNotNull(), F.col("partner_ad_po_number")).otherwise(
        F.col("ad_po_number")
    )


def partner_numbers(purchase_orders: DataFrame) -> DataFrame:
    """Customer purchase orders with the number of their partner order."""
    customer = purchase_orders.where(F.col("type_").isin(*CUSTOMER_TYPES))
    found = attach(customer, gather("_po", partner_satellite(purchase_orders)), "id", "_po")
    return found.select("id", partner_number().alias("ad_po_number"))


def _owned(frame: DataFrame, owner_column: str, owners: tuple[str, ...]) -> DataFrame:
    return frame.where(F.col(owner_column).isin(*owners))


def purchase_order_report(
    purchase_orders: DataFrame,
    currencies: DataFrame,
    shippings: DataFrame,
    taxes: DataFrame,
    providers: DataFrame,
    action_items: DataFrame,
    contract: str = "fail",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One row per numbered customer purchase order, with prices, tax and shipping in USD.

    Children keyed by the order's own id are gathered with one shuffle and attached on a unique key.
    The three foreign keys (proposal, provider, order) may be hot and go through `lookups`.
    """
    customer = purchase_orders.where(
        F.col("type_").isin(*CUSTOMER_TYPES)
        & F.col("po_number").isNotNull()
        & F.col("po_created_at").isNotNull()
    )
    retail = taxes.where(F.col("type_") == RETAIL_TAX)
    own = gather(
        "_po",
        partner_satellite(purchase_orders),
        Satellite(
            "currency", _owned(currencies, "exchangable_type", ORDER_OWNERS), "exchangable_id",
            ["conversion_rate", "currency"],
        ),
        Satellite(
            "shipping", _owned(shippings, "shipable_type", ORDER_OWNERS), "shipable_id",
            ["cost"], pick="first",
        ),
        Satellite(
            "tax", _owned(retail, "taxable_type", ORDER_OWNERS), "taxable_id",
            ["amount", "percent_rate"],
        ),
    )
    proposal = gather(
        "_proposal",
        Satellite(
            "proposal_tax", _owned(retail, "taxable_type", (PROPOSAL_OWNER,)), "taxable_id",
            ["amount"],
        ),
        Satellite(
            "proposal_shipping", _owned(shippings, "shipable_type", (PROPOSAL_OWNER,)),
            "shipable_id", ["cost"],
        ),
    )
    requested = action_items.where(F.col("action_performed") == NEW_REQUEST)
    supplier = gather(
        "_order", Satellite("supplier", requested, "order_id", ["provider_id"], pick="first")
    )
    names = providers.select(F.col("id").alias("_provider"), F.col("name").alias("provider_name"))

    rows = attach(customer, own, "id", "_po")
    foreign = [
        Lookup(proposal, {"proposal_id": "_proposal"}),
        Lookup(supplier, {"order_id": "_order"}),
        Lookup(names, {"provider_id": "_provider"}),
    ]
    rows = lookups(rows, foreign, customer, policy=policy)

    rows = rows.withColumns(
        {
            "rate": money.rate_or_one(F.col("currency_id"), F.col("currency_conversion_rate")),
            "total": money.as_double(F.col("total_price")),
            "subtotal": money.as_double(F.col("subtotal_price")),
            "shipping": money.nonzero_or(F.col("shipping_cost"), F.col("proposal_shipping_cost")),
            "tax": money.nonzero_or(F.col("tax_amount"), F.col("proposal_tax_amount")),
            "percent": F.coalesce(money.as_double(F.col("tax_percent_rate")), F.lit(0.0)),
        }
    )
    rate = F.col("rate")
    computed = {
        "ad_po_number": partner_number(),
        "po_submission_date": F.to_date("po_created_at"),
        "status": status_of_row(),
        "total_price": F.col("total"),
        "subtotal_price": F.col("subtotal"),
        "supplier_id": F.col("supplier_provider_id"),
        "justifications": joined(F.col("justifications")),
        "currency": F.col("currency_currency"),
        "conversion_rate": rate,
        "total_price_usd": money.ieee_div(F.col("total"), rate),
        "subtotal_price_usd": money.ieee_div(F.col("subtotal"), rate),
        "tax_amount": F.col("tax"),
        "tax_percent": F.col("percent"),
        "tax_amount_usd": money.tax_in_base(
            F.col("tax"), F.col("shipping"), F.col("percent"), rate
        ),
        "shipping_cost": F.col("shipping"),
        "shipping_cost_usd": money.ieee_div(F.col("shipping"), rate),
        "commission_rate": money.percent(F.col("commission_rate")),
        "rejected": flag_text(F.col("rejected")),
        "obsoleted": flag_text(F.col("obsoleted")),
    }
    no_currency = F.col("currency_id").isNull()
    rules = [
        Rule("no shipping row", F.col("shipping_id").isNotNull()),
        Rule("currency without rate", no_currency | F.col("currency_conversion_rate").isNotNull()),
        Rule("currency without code", no_currency | F.col("currency_currency").isNotNull()),
        *not_null("uuid", "rejected", "obsoleted"),
    ]
    columns = [computed.get(c, F.col(c)).alias(c) for c in REPORT_COLUMNS]
    return enforce(rows, rules, columns, contract, label="purchase order")


# Retail totals are exact decimals: prices of up to 12 and percentages of up to 9 decimals, products and
# sums of 21. A value with more decimals, or a sum that does not fit, raises; none is rounded.
PRICE = "decimal(24,12)"
PERCENT = "decimal(13,9)"
TOTAL = "decimal(36,21)"


def _exact(value: Column, kind: str) -> Column:
    """The value as a decimal of that kind; raises where this would change it."""
    cut = F.raise_error(F.concat(F.lit(f"not a {kind}: "), value.cast("string"))).cast(kind)
    return F.when(value.isNull() | (value.cast(kind) == value), value.cast(kind)).otherwise(cut)


def retail_totals(
    purchase_orders: DataFrame,
    milestones: DataFrame,
    shippings: DataFrame,
    currencies: DataFrame,
) -> DataFrame:
    """Subtotal, tax, total and converted total of each purchase order from its milestones.

    An order without milestones has zero sums. A missing shipping row counts as no cost and a
    missing or null rate as 1.
    """
    price, percent = _exact(F.col("total_price"), PRICE), _exact(F.col("tax_rate"), PERCENT)
    sums = (
        _owned(milestones, "itemizable_type", ORDER_OWNERS)
        .where(F.col("itemizable_id").isNotNull())
        .groupBy(F.col("itemizable_id").alias("_milestone_po"))
        .agg(F.sum(price).alias("_price"), F.sum(price * percent).alias("_price_percent"))
    )
    sides = gather(
        "_po",
        Satellite(
            "shipping", _owned(shippings, "shipable_type", ORDER_OWNERS), "shipable_id",
            ["cost"], pick="first",
        ),
        Satellite(
            "currency", _owned(currencies, "exchangable_type", ORDER_OWNERS), "exchangable_id",
            ["conversion_rate"],
        ),
    )
    rows = attach(purchase_orders.select("id"), sums, "id", "_milestone_po")
    rows = attach(rows, sides, "id", "_po")
    zero = F.lit(0)
    subtotal = F.coalesce(F.col("_price"), zero).cast(TOTAL)
    # A percentage moves the point by two places: 19 decimals become 21.
    tax = _exact(F.coalesce(F.col("_price_percent"), zero), "decimal(33,19)")
    tax = (tax * F.lit("0.01").cast("decimal(2,2)")).cast(TOTAL)
    cost = _exact(F.coalesce(F.col("shipping_cost"), zero), PRICE).cast(TOTAL)
    rows = rows.select(
        "id",
        subtotal.alias("retail_subtotal_price"),
        tax.alias("retail_tax_amount"),
        (subtotal + tax + cost).alias("retail_total_price"),
        F.coalesce(F.col("currency_conversion_rate"), F.lit(1)).cast("double").alias("_rate"),
    )
    total = F.col("retail_total_price")
    return rows.select(
        "id",
        "retail_subtotal_price",
        "retail_tax_amount",
        "retail_total_price",
        money.ieee_div(total.cast("double"), F.col("_rate")).alias("retail_total_price_usd"),
    )
