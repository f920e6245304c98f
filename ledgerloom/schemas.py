"""Source tables with fixed schemas. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Table and column names of the source database. JSON columns are held as text, UUIDs
# as 36-character text and prices as DECIMAL(38,18). `type_` is the column `type` of the database.
TABLES: dict[str, str] = {
    "action_items": """
        id BIGINT NOT NULL, action_performed STRING, completed_at TIMESTAMP_NTZ, proposal_id INT,
        purchase_order_id INT, provider_id STRING, uuid STRING, created_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ, order_id INT, request_id INT, note_id INT, invoice_id INT,
        request_name STRING, organization_id INT, type_ STRING, ads_ad_id INT""",
    "addresses": """
        id INT NOT NULL, type_ STRING, organization_name STRING, site_name STRING, attention STRING,
        person_name STRING, care_of STRING, notes STRING, total STRING, currency STRING,
        address_id STRING, street STRING, street2 STRING, city STRING, state STRING, zipcode STRING,
        country STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, name STRING,
        site_type STRING, text STRING, addressable_id INT, addressable_type STRING,
        legal_entity_id INT""",
    "currencies": """
        id INT NOT NULL, exchangable_id INT, exchangable_type STRING, currency STRING,
        conversion_rate DECIMAL(38,18), conversion_set_at TIMESTAMP_NTZ, conversion_history STRING,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "embedded_dynamic_forms": """
        id INT NOT NULL, name STRING, version_number INT, slug STRING, key STRING, schema STRING,
        options STRING, data STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "events": """
        id BIGINT NOT NULL, event STRING, email STRING, username STRING, application STRING,
        duration DOUBLE, remote_addr STRING, host STRING, action STRING, controller STRING,
        session_id STRING, computer_id STRING, query STRING, raw_post STRING,
        categories ARRAY<STRING>, source ARRAY<STRING>, providers STRING, uuid STRING NOT NULL,
        datetime TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ,
        api_version STRING, organization_id INT""",
    "inventories": """
        id BIGINT NOT NULL, inventory_group_id INT, data STRING, created_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ, uuid STRING, product_name STRING, product_url STRING,
        provider_id INT""",
    "inventory_groups": """
        id INT NOT NULL, index INT NOT NULL, metadata STRING, shipping_cost DECIMAL(38,18) NOT NULL,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, uuid STRING, deleted_at TIMESTAMP_NTZ""",
    "invoices": """
        id INT NOT NULL, invoice_number STRING, cancelled BOOLEAN NOT NULL, issued_at TIMESTAMP_NTZ,
        document_type STRING NOT NULL, commission_rate DECIMAL(38,18), purchase_order_id INT,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, uuid STRING,
        subtotal_price DECIMAL(38,18) NOT NULL, total_price DECIMAL(38,18) NOT NULL,
        discount_amount DECIMAL(38,18) NOT NULL, provider_id INT, order_id INT,
        approved_for_payment BOOLEAN, discount STRING""",
    "milestones": """
        id INT NOT NULL, itemizable_id INT, itemizable_type STRING,
        unit_price DECIMAL(38,18) NOT NULL, total_price DECIMAL(38,18) NOT NULL,
        type_ STRING NOT NULL, name STRING, quantity DECIMAL(38,18) NOT NULL, state STRING NOT NULL,
        tax_rate DECIMAL(38,18) NOT NULL, currency STRING, unit_of_measure STRING,
        classifications STRING NOT NULL, line_number INT, comments STRING,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, status STRING, provider_id INT,
        cancelled_at TIMESTAMP_NTZ, shipped_at TIMESTAMP_NTZ, estimated_date TIMESTAMP_NTZ""",
    "notes": """
        id BIGINT NOT NULL, title STRING, body STRING, status STRING, request_id INT,
        uuid STRING NOT NULL, ware_id STRING, user_id INT, invoice_id INT, purchase_order_id INT,
        proposal_id INT, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "orders": """
        id INT NOT NULL, provider_id INT, request_id INT, client_id INT, organization_id INT,
        obligations STRING, state STRING NOT NULL, declined BOOLEAN NOT NULL,
        on_hold BOOLEAN NOT NULL, order_cancelled BOOLEAN NOT NULL,
        request_cancelled BOOLEAN NOT NULL, last_computed_status STRING, uuid STRING NOT NULL,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, booster DOUBLE""",
    "organizations": """
        id INT NOT NULL, name STRING, uuid STRING, created_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ, parent_id INT, domain STRING, webstore BOOLEAN NOT NULL,
        archived_at TIMESTAMP_NTZ""",
    "proposals": """
        id INT NOT NULL, active BOOLEAN NOT NULL, description STRING NOT NULL,
        obsoleted BOOLEAN NOT NULL, proposal_type STRING, state STRING, exclude BOOLEAN NOT NULL,
        justifications ARRAY<STRING>, commission_rate DECIMAL(38,18), user_full_name STRING,
        user_id INT, uuid STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ,
        subtotal_price DECIMAL(38,18) NOT NULL, total_price DECIMAL(38,18) NOT NULL,
        provider_id INT, tax_category STRING, order_id INT, type_ STRING, ware_id INT,
        status STRING""",
    "providers": """
        id INT NOT NULL, name STRING, slug STRING, uuid STRING, created_at TIMESTAMP_NTZ,
        certifications ARRAY<STRING> NOT NULL, setup ARRAY<STRING> NOT NULL, score DOUBLE NOT NULL,
        tier INT, contact_emails ARRAY<STRING>, sales_email STRING, phone_number STRING,
        ads_advertiser_id INT, website STRING, number_of_employees STRING,
        type_of_company STRING""",
    "purchase_orders": """
        id INT NOT NULL, version_number INT NOT NULL, referenced_po_id INT, ad_po_number STRING,
        payment_terms INT, po_number STRING, po_created_at TIMESTAMP_NTZ, accepted BOOLEAN,
        rejected BOOLEAN, obsoleted BOOLEAN, completed BOOLEAN,
        justifications ARRAY<STRING> NOT NULL, commission_rate DECIMAL(38,18),
        provider_shipping_address_id INT, customer_shipping_address_id INT, cpo_id INT,
        proposal_id INT, created_at TIMESTAMP_NTZ, uuid STRING,
        total_price DECIMAL(38,18) NOT NULL, subtotal_price DECIMAL(38,18) NOT NULL,
        provider_id INT, order_id INT, type_ STRING, supplier_updated BOOLEAN,
        updated_at TIMESTAMP_NTZ, user_id INT, request_id INT""",
    "ratings": """
        id INT NOT NULL, value INT NOT NULL, ware_id STRING, spam BOOLEAN NOT NULL, provider_id INT,
        created_at TIMESTAMP_NTZ, ware_pg_id INT, request_id INT, order_id INT, comment STRING,
        organization_id INT, user_id INT""",
    "refs": """
        id BIGINT NOT NULL, type_ STRING, fields STRING, reference_of_type STRING,
        reference_to_type STRING, reference_of_id INT, reference_to_id INT, uuid STRING NOT NULL,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "requests": """
        id INT NOT NULL, name STRING, description STRING, quantity INT NOT NULL,
        request_type STRING, reason_for_cancelling STRING, filters ARRAY<STRING>,
        closed BOOLEAN NOT NULL, cancelled BOOLEAN NOT NULL, on_hold BOOLEAN NOT NULL,
        status STRING, exclude BOOLEAN NOT NULL, ordered_at TIMESTAMP_NTZ, user_id INT,
        ware_id INT, organization_id INT, uuid STRING NOT NULL, created_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ""",
    "shippings": """
        id INT NOT NULL, shipable_id INT, shipable_type STRING, cost DECIMAL(38,18) NOT NULL,
        free_shipping BOOLEAN NOT NULL, currency STRING, notes STRING, created_at TIMESTAMP_NTZ,
        updated_at TIMESTAMP_NTZ""",
    "taxes": """
        id INT NOT NULL, taxable_id INT, taxable_type STRING, amount DECIMAL(38,18) NOT NULL,
        category STRING, currency STRING, description STRING, locale STRING, notes STRING,
        percent_rate DECIMAL(38,18) NOT NULL, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ,
        type_ STRING""",
    "timepoints": """
        id INT NOT NULL, name STRING, date TIMESTAMP_NTZ, slug STRING, order_id INT,
        uuid STRING NOT NULL, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "turn_around_times": """
        id INT NOT NULL, turnaroundable_id INT, turnaroundable_type STRING, min BIGINT, max BIGINT,
        display_units STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "users": """
        id INT NOT NULL, shipping_address_id INT, billing_address_id INT, active BOOLEAN NOT NULL,
        company STRING, email STRING, first_name STRING, last_name STRING,
        last_request_at TIMESTAMP_NTZ, last_sign_in_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ,
        sso_attributes STRING, user_agreement_signed_at TIMESTAMP_NTZ, expired_at TIMESTAMP_NTZ,
        uuid STRING""",
    "wares": """
        id INT NOT NULL, name STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ,
        slug STRING, description STRING, ware_type STRING""",
    "wpcs": """
        id BIGINT NOT NULL, ware_id INT, provider_id INT, required BOOLEAN,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, organization_id INT,
        auto_assigned BOOLEAN NOT NULL, booster DOUBLE NOT NULL""",
    "clicks": """
        id STRING NOT NULL, data STRING, file_name STRING, last_modified_date TIMESTAMP_NTZ,
        year INT NOT NULL""",
}

# Boost scores as the warehouse holds them: everything arrives as text-like columns and is cast.
BOOST_SCORES = """
    id BIGINT, organization_id INT, ware_id INT, provider_id INT, updated_booster DOUBLE,
    update STRING"""


def table_schema(name: str) -> StructType:
    """The declared schema of a source table."""
    return StructType.fromDDL(TABLES[name])
