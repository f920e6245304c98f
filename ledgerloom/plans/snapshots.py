"""Row-local snapshots, each declared by its output columns and the expressions that differ.

Column pruning follows from the output list: a scan reads only what a snapshot names.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext
from ..functions.money import as_double
from ..functions.text import (
    address_line,
    checklist_score,
    flag_text,
    full_name,
    item_or_empty,
    joined,
    or_date,
    or_timestamp,
)
from ..operators.contracts import Rule, enforce, not_null
from ..operators.lookup import DEFAULT_POLICY, SkewPolicy, lookup
from ..operators.project import select_list

# Fixed values of the outputs: placeholders for missing dates, the reference types, the weights of
# a provider's set-up steps and the members taken from a user reference.
NO_TIMESTAMP = "0001-01-01 00:00:00"
NO_DATE = "0001-01-01"
REFERENCE_DATE = "2020-11-26 00:00:00"
USER_REFERENCE = "Pg::UserRef"
SETUP_WEIGHTS = {
    "Create Account": 20,
    "Update Company Profile": 20,
    "Add Addresses": 20,
    "Add Certifications": 20,
    "Add Accounting Details": 20,
}
USER_REFERENCE_MEMBERS = (
    "location", "email", "company", "last_name", "first_name", "organization_name",
)


@dataclass(frozen=True)
class Snapshot:
    table: str
    columns: Sequence[str]
    expressions: Callable[[], Mapping[str, Column]] = dict
    where: Callable[[], Column] | None = None
    rules: Callable[[], Sequence[Rule]] = list


def _doubles(*columns: str) -> dict[str, Column]:
    return {c: as_double(F.col(c)) for c in columns}


def _json(*columns: str) -> dict[str, Column]:
    return {c: jsontext.canonical(F.col(c)) for c in columns}


def _milestone_expressions() -> dict[str, Column]:
    stamps = ("created_at", "updated_at", "cancelled_at", "shipped_at")
    return {
        "_type": F.col("type_"),
        **_doubles("quantity", "tax_rate", "unit_price", "total_price"),
        **_json("classifications"),
        **{c: or_timestamp(F.col(c), NO_TIMESTAMP) for c in stamps},
        "estimated_date": or_date(F.col("estimated_date"), NO_DATE),
    }


def _user_reference_expressions() -> dict[str, Column]:
    fields = jsontext.parsed(F.col("fields"))
    return {
        **{c: or_timestamp(F.col(c), REFERENCE_DATE) for c in ("created_at", "updated_at")},
        **{c: jsontext.member_bare(fields, c, F.col("fields")) for c in USER_REFERENCE_MEMBERS},
    }


def _provider_reference_expressions() -> dict[str, Column]:
    fields = jsontext.parsed(F.col("fields"))
    return {
        **{c: jsontext.member_text(fields, c, F.col("fields")) for c in ("name", "slug", "contract_status")},
        "score": jsontext.first_number(fields, "score"),
    }


SNAPSHOTS: dict[str, Snapshot] = {
    "addresses": Snapshot(
        "addresses",
        (
            "id", "type_", "organization_name", "site_name", "attention", "person_name", "street",
            "street2", "city", "state", "zipcode", "country", "created_at", "addressable_id",
            "addressable_type", "legal_entity_id",
        ),
    ),
    "currencies": Snapshot(
        "currencies",
        (
            "id", "exchangable_id", "exchangable_type", "currency", "conversion_rate",
            "conversion_set_at", "conversion_history", "created_at", "updated_at",
        ),
        lambda: {**_doubles("conversion_rate"), **_json("conversion_history")},
        rules=lambda: not_null("conversion_rate"),
    ),
    "inventories": Snapshot(
        "inventories",
        (
            "id", "inventory_group_id", "data", "created_at", "updated_at", "uuid",
            "product_name", "product_url", "provider_id",
        ),
        lambda: _json("data"),
    ),
    "inventory_groups": Snapshot(
        "inventory_groups",
        (
            "id", "index", "metadata", "shipping_cost", "created_at", "updated_at", "uuid",
            "deleted_at",
        ),
        lambda: {**_doubles("shipping_cost"), **_json("metadata")},
        rules=lambda: not_null("uuid"),
    ),
    "milestones": Snapshot(
        "milestones",
        (
            "id", "itemizable_id", "itemizable_type", "_type", "name", "quantity", "state",
            "tax_rate", "currency", "unit_of_measure", "classifications", "line_number",
            "comments", "created_at", "updated_at", "unit_price", "total_price", "status",
            "provider_id", "cancelled_at", "shipped_at", "estimated_date",
        ),
        _milestone_expressions,
    ),
    "notes": Snapshot(
        "notes",
        (
            "id", "title", "body", "status", "request_id", "ware_id", "uuid", "user_id",
            "invoice_id", "purchase_order_id", "proposal_id", "created_at", "updated_at",
        ),
    ),
    "organizations": Snapshot(
        "organizations",
        (
            "id", "name", "uuid", "created_at", "updated_at", "parent_id", "domain", "webstore",
            "archived_at",
        ),
        lambda: {"webstore": flag_text(F.col("webstore"))},
        rules=lambda: not_null("uuid"),
    ),
    "providers": Snapshot(
        "providers",
        (
            "id", "name", "slug", "uuid", "created_at", "certifications", "percent_completeness",
            "score", "tier", "contact_emails", "sales_email", "phone_number", "ads_advertiser_id",
            "website", "number_of_employees", "type_of_company",
        ),
        lambda: {
            "certifications": joined(F.col("certifications")),
            "percent_completeness": checklist_score(F.col("setup"), SETUP_WEIGHTS),
            "contact_emails": joined(F.col("contact_emails")),
        },
        rules=lambda: not_null("contact_emails", "uuid"),
    ),
    "refs_providers": Snapshot(
        "refs",
        (
            "id", "type_", "reference_of_type", "reference_to_type", "reference_to_id",
            "reference_of_id", "created_at", "updated_at", "name", "slug", "score",
            "contract_status",
        ),
        _provider_reference_expressions,
    ),
    "refs_users": Snapshot(
        "refs",
        (
            "id", "type_", "reference_of_type", "reference_to_id", "reference_of_id",
            "created_at", "updated_at", *USER_REFERENCE_MEMBERS,
        ),
        _user_reference_expressions,
        where=lambda: F.col("type_") == USER_REFERENCE,
        rules=lambda: not_null("fields"),
    ),
    "requests": Snapshot(
        "requests",
        (
            "id", "name", "quantity", "request_type", "reason_for_cancelling", "filter1",
            "filter2", "filter3", "closed", "cancelled", "on_hold", "status", "exclude",
            "ordered_at", "user_id", "ware_id", "organization_id", "uuid", "created_at",
            "updated_at", "description",
        ),
        lambda: {f"filter{i + 1}": item_or_empty(F.col("filters"), i) for i in range(3)},
    ),
    "shippings": Snapshot(
        "shippings",
        (
            "id", "shipable_id", "shipable_type", "cost", "free_shipping", "currency", "notes",
            "created_at", "updated_at",
        ),
        lambda: {**_doubles("cost"), "free_shipping": flag_text(F.col("free_shipping"))},
    ),
    "taxes": Snapshot(
        "taxes",
        (
            "id", "taxable_id", "taxable_type", "amount", "category", "currency", "description",
            "locale", "notes", "percent_rate", "created_at", "updated_at", "type_",
        ),
        lambda: _doubles("amount", "percent_rate"),
    ),
    "users": Snapshot(
        "users",
        (
            "id", "shipping_address_id", "billing_address_id", "active", "company", "email",
            "full_name", "sso_attributes", "user_sso_email", "last_request_at", "last_sign_in_at",
            "created_at", "user_agreement_signed_at", "expired_at", "uuid",
        ),
        lambda: {
            "active": flag_text(F.col("active")),
            "full_name": full_name(F.col("first_name"), F.col("last_name")),
            "sso_attributes": jsontext.canonical(F.col("sso_attributes")),
            "user_sso_email": jsontext.member_quoted(
                jsontext.parsed(F.col("sso_attributes")), "email", F.col("sso_attributes")
            ),
        },
        rules=lambda: not_null("sso_attributes", "uuid"),
    ),
    "wares": Snapshot(
        "wares",
        ("id", "name", "created_at", "updated_at", "slug", "description", "ware_type"),
    ),
    "wpcs": Snapshot(
        "wpcs",
        (
            "id", "ware_id", "provider_id", "required", "created_at", "updated_at",
            "organization_id", "auto_assigned", "booster",
        ),
        lambda: _doubles("booster"),
    ),
}


def snapshot(name: str, table: DataFrame, contract: str = "fail") -> DataFrame:
    """The snapshot of a source table."""
    spec = SNAPSHOTS[name]
    rows = table if spec.where is None else table.where(spec.where())
    columns = select_list(spec.columns, spec.expressions())
    rules = spec.rules()
    if not rules and contract in ("fail", "valid"):
        return rows.select(*columns)
    return enforce(rows, rules, columns, contract, label=name)


def address_lines(addresses: DataFrame) -> DataFrame:
    """The one-line form of each address."""
    parts = [F.col(c) for c in ("street", "street2", "city", "state", "zipcode", "country")]
    return addresses.select("id", address_line(*parts).alias("address"))


def grouped_inventories(
    inventories: DataFrame, inventory_groups: DataFrame, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Inventory items with the position and shipping cost of their group."""
    groups = inventory_groups.select(
        F.col("id").alias("_group"),
        F.col("index").alias("group_index"),
        as_double(F.col("shipping_cost")).alias("group_shipping_cost"),
    )
    items = inventories.select("id", "inventory_group_id", "product_name", "provider_id")
    return lookup(items, groups, {"inventory_group_id": "_group"}, policy=policy)
