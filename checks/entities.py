"""Source entities derived from the driver's tables, as SQL that runs unchanged in Spark and DuckDB.

Every view reads its whole base tables. Attribute values decide which rows have children, flags or
nulls. `{table}` stands for a base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Row ids of the second and third owner of a child table start here, so that ids stay unique.
SECOND, THIRD = 10_000_000_000_000, 20_000_000_000_000

_PO_OWNER = """case when {key} % 2 = 0 then 'Pg::PurchaseOrderBase'
    else 'Pg::PurchaseOrderBaseInit' end"""

# Members of a click that hold a number or a text of the event: name, and what is added to or cut from its id.
CLICK_INTS = (
    "SiteId", "ZoneId", "BrandId", "AdTypeId", "RateType", "ChannelId", "NetworkId", "CampaignId",
    "ClickCount", "CreativeId", "PriorityId", "DecisionIdx", "ServedByPid", "CreativePassId",
    "FirstChannelId",
)
CLICK_TEXTS = ("Location", "DecisionId", "ServedByAsg", "ImpressionId", "PlacementName", "Url")
_MORE = "".join(
    [f",\"{m}\":' || cast(event_id % {7 + i} as string) || '" for i, m in enumerate(CLICK_INTS)]
    + [f",\"{m}\":\"{m} ' || cast(event_id % {50 + i} as string) || '\"" for i, m in enumerate(CLICK_TEXTS)]
) + ","

VIEWS: dict[str, str] = {
    "purchase_orders": """
        select o_orderkey as id,
               1 + o_orderkey % 3 as version_number,
               case when o_orderkey % 2 = 0 then o_orderkey + 1 end as referenced_po_id,
               case when o_orderkey % 5 = 0 then null
                    else 'AD-' || cast(o_orderkey as string) end as ad_po_number,
               30 + o_orderkey % 3 * 15 as payment_terms,
               case when o_orderkey % 11 = 0 then null
                    else 'PO-' || cast(o_orderkey as string) end as po_number,
               o_orderdate as po_created_at,
               o_orderstatus = 'O' as accepted,
               o_orderstatus = 'P' as rejected,
               o_orderpriority = '5-LOW' as obsoleted,
               o_orderstatus = 'F' as completed,
               split(o_orderpriority, '-') as justifications,
               case when o_orderkey % 9 = 0 then null
                    else cast(o_orderkey % 20 as decimal(9,4)) end as commission_rate,
               o_custkey as provider_shipping_address_id,
               o_custkey + 1 as customer_shipping_address_id,
               case when o_orderkey % 4 = 2
                    then cast(floor(o_orderkey / 8) as bigint) * 8 end as cpo_id,
               o_custkey as proposal_id,
               o_orderdate as created_at,
               'po-' || cast(o_orderkey as string) as uuid,
               cast(o_totalprice as decimal(18,4)) as total_price,
               cast(o_totalprice as decimal(18,4)) - cast(o_orderkey % 7 as decimal(18,4))
                   as subtotal_price,
               o_orderkey % 120 as provider_id,
               cast(floor(o_orderkey / 2) as bigint) as order_id,
               case o_orderkey % 4 when 0 then 'Pg::CustomerPurchaseOrder'
                    when 2 then 'Pg::ProviderPurchaseOrder' else 'Pg::PurchaseOrder' end as type_,
               o_orderkey % 3 = 0 as supplier_updated,
               o_orderdate as updated_at,
               o_custkey as user_id,
               o_custkey as request_id
        from {orders}""",
    "milestones": f"""
        select l_orderkey * 10 + l_linenumber as id,
               l_orderkey as itemizable_id,
               {_PO_OWNER.format(key="l_orderkey")} as itemizable_type,
               'Pg::Milestone' as type_,
               l_returnflag as name,
               cast(l_quantity as decimal(18,4)) as quantity,
               l_linestatus as state,
               cast(l_tax * 100 as decimal(9,4)) as tax_rate,
               'USD' as currency,
               cast(null as string) as unit_of_measure,
               '{{{{"line": ' || cast(l_linenumber as string) || '}}}}' as classifications,
               l_linenumber as line_number,
               cast(null as string) as comments,
               l_shipdate as created_at,
               case when l_returnflag = 'R' then l_shipdate end as updated_at,
               cast(l_extendedprice as decimal(18,4)) as unit_price,
               cast(l_extendedprice as decimal(18,4)) as total_price,
               l_linestatus as status,
               l_suppkey as provider_id,
               case when l_returnflag = 'A' then l_shipdate end as cancelled_at,
               case when l_linestatus = 'F' then l_shipdate end as shipped_at,
               case when l_linestatus = 'O' then l_shipdate end as estimated_date
        from {{lineitem}}""",
    "shippings": f"""
        select l_orderkey * 10 + l_linenumber as id, l_orderkey as shipable_id,
               {_PO_OWNER.format(key="l_orderkey")} as shipable_type,
               cast(min(l_discount) * 100 as decimal(9,4)) as cost,
               min(l_discount) = 0 as free_shipping, 'USD' as currency,
               cast(null as string) as notes, min(l_shipdate) as created_at,
               max(l_shipdate) as updated_at
        from {{lineitem}} group by l_orderkey, l_linenumber
        union all
        select {SECOND} + c_custkey, c_custkey, 'Pg::ProposalBase',
               cast(c_nationkey as decimal(9,4)), c_nationkey = 0, 'USD', c_mktsegment,
               cast(null as timestamp), cast(null as timestamp)
        from {{customer}}
        union all
        select {THIRD} + o_orderkey, o_orderkey, 'Pg::Invoice',
               cast(o_custkey % 50 as decimal(9,4)), o_custkey % 50 = 0, 'EUR', o_orderpriority,
               o_orderdate, o_orderdate
        from {{orders}} where o_orderpriority <> '3-MEDIUM'""",
    "taxes": f"""
        select l_orderkey * 10 + l_linenumber as id, l_orderkey as taxable_id,
               {_PO_OWNER.format(key="l_orderkey")} as taxable_type,
               cast(cast(min(l_extendedprice) as decimal(18,2))
                    * cast(min(l_tax) as decimal(4,2)) as decimal(18,4)) as amount,
               'sales' as category, 'USD' as currency, cast(null as string) as description,
               'us' as locale, cast(null as string) as notes,
               cast(min(l_tax) * 100 as decimal(9,4)) as percent_rate,
               min(l_shipdate) as created_at, max(l_shipdate) as updated_at,
               case when l_returnflag = 'R' then 'Pg::RetailTax' else 'Pg::OtherTax' end as type_
        from {{lineitem}} where l_returnflag <> 'N'
        group by l_orderkey, l_linenumber, l_returnflag
        union all
        select {SECOND} + c_custkey, c_custkey, 'Pg::ProposalBase',
               cast(c_nationkey % 7 as decimal(18,4)), 'sales', 'USD', c_mktsegment, 'us', null,
               cast(c_nationkey as decimal(9,4)), cast(null as timestamp),
               cast(null as timestamp), 'Pg::RetailTax'
        from {{customer}} where c_mktsegment <> 'BUILDING'""",
    "currencies": f"""
        select o_orderkey as id, o_orderkey as exchangable_id,
               {_PO_OWNER.format(key="o_orderkey")} as exchangable_type,
               'C' || cast(c_nationkey as string) as currency,
               cast(1 + c_nationkey / 10.0 as decimal(9,4)) as conversion_rate,
               o_orderdate as conversion_set_at,
               '{{{{"rate": ' || cast(c_nationkey as string) || '}}}}' as conversion_history,
               o_orderdate as created_at, o_orderdate as updated_at
        from {{orders}} join {{customer}} on o_custkey = c_custkey where o_orderstatus <> 'O'
        union all
        select {SECOND} + o_orderkey, o_orderkey, 'Pg::PurchaseOrderBase', 'EUR',
               cast(2 as decimal(9,4)), o_orderdate, null, o_orderdate, o_orderdate
        from {{orders}} where o_orderpriority = '2-HIGH'
        union all
        select {THIRD} + o_orderkey, o_orderkey, 'Pg::Invoice',
               case when c_mktsegment <> 'HOUSEHOLD' then 'C' || cast(c_nationkey as string) end,
               case when c_mktsegment <> 'MACHINERY'
                    then cast(1 + c_nationkey / 10.0 as decimal(9,4)) end,
               o_orderdate, null, o_orderdate, o_orderdate
        from {{orders}} join {{customer}} on o_custkey = c_custkey
        union all
        select {SECOND + THIRD} + c_custkey, c_custkey, 'Pg::ProposalBase',
               'C' || cast(c_nationkey as string),
               cast(1 + c_nationkey / 10.0 as decimal(9,4)), cast(null as timestamp), null,
               cast(null as timestamp), cast(null as timestamp)
        from {{customer}} where c_acctbal > 0""",
    "turn_around_times": """
        select c_custkey as id, c_custkey as turnaroundable_id,
               'Pg::ProposalBase' as turnaroundable_type,
               case when c_nationkey = 3 then null else c_custkey * 3600 end as min,
               c_custkey * 7200 + 1 as max,
               case c_nationkey % 4 when 0 then 'hours' when 1 then 'weeks' when 2 then 'months'
                    end as display_units,
               cast(null as timestamp) as created_at, cast(null as timestamp) as updated_at
        from {customer} where c_mktsegment <> 'FURNITURE'""",
    "proposals": """
        select c_custkey as id,
               c_mktsegment <> 'MACHINERY' as active,
               c_name as description,
               c_nationkey = 1 as obsoleted,
               'standard' as proposal_type,
               cast(null as string) as state,
               c_nationkey = 2 as exclude,
               split(c_mktsegment || ' ' || c_name, '#') as justifications,
               cast(c_nationkey as decimal(9,4)) as commission_rate,
               c_name as user_full_name,
               c_custkey as user_id,
               'pr-' || cast(c_custkey as string) as uuid,
               coalesce(seen.first_ts, bought.first_date) as created_at,
               seen.first_ts as updated_at,
               cast(c_acctbal as decimal(18,4)) - cast(1 as decimal(18,4)) as subtotal_price,
               cast(c_acctbal as decimal(18,4)) as total_price,
               c_custkey % 120 as provider_id,
               cast(null as string) as tax_category,
               bought.first_order as order_id,
               'Pg::Proposal' as type_,
               c_custkey as ware_id,
               'open' as status
        from {customer}
        left join (select user_id, min(ts) as first_ts from {events} group by user_id) seen
               on seen.user_id = c_custkey
        left join (select o_custkey, min(o_orderdate) as first_date, min(o_orderkey) as first_order
                   from {orders} group by o_custkey) bought on bought.o_custkey = c_custkey""",
    "orders": """
        select o_orderkey as id,
               o_orderkey % 120 as provider_id,
               o_custkey as request_id,
               o_custkey as client_id,
               o_orderkey as organization_id,
               '{{"due": ' || cast(o_custkey as string) || '}}' as obligations,
               o_orderstatus as state,
               o_orderstatus = 'P' as declined,
               false as on_hold,
               o_orderpriority = '5-LOW' as order_cancelled,
               o_orderpriority = '4-NOT SPECIFIED' as request_cancelled,
               o_orderpriority as last_computed_status,
               'or-' || cast(o_orderkey as string) as uuid,
               o_orderdate as created_at,
               o_orderdate as updated_at,
               cast(o_totalprice as double) as booster
        from {orders}""",
    "requests": """
        select p_partkey as id, p_name as name, p_type as description, p_size as quantity,
               p_brand as request_type, cast(null as string) as reason_for_cancelling,
               split(p_name, ' ') as filters, p_size > 25 as closed, p_size = 1 as cancelled,
               p_size = 2 as on_hold, p_type as status, p_size = 3 as exclude,
               cast(null as timestamp) as ordered_at, p_partkey % 1700 as user_id,
               p_partkey as ware_id, p_size as organization_id,
               'rq-' || cast(p_partkey as string) as uuid, cast(null as timestamp) as created_at,
               cast(null as timestamp) as updated_at
        from {part}""",
    "users": """
        select c_custkey as id, c_custkey as shipping_address_id, c_custkey as billing_address_id,
               c_acctbal > 0 as active, c_mktsegment as company,
               case when c_mktsegment <> 'HOUSEHOLD' then c_name || '@example.org' end as email,
               case when c_custkey % 3 <> 0 then c_mktsegment end as first_name,
               case when c_custkey % 4 <> 0 then c_name end as last_name,
               cast(null as timestamp) as last_request_at, cast(null as timestamp) as last_sign_in_at,
               cast(null as timestamp) as created_at,
               case when c_nationkey = 4 then '{{"team": 1}}'
                    else '{{"email": "' || c_name || '@sso.example.org"}}' end as sso_attributes,
               cast(null as timestamp) as user_agreement_signed_at,
               cast(null as timestamp) as expired_at,
               'us-' || cast(c_custkey as string) as uuid
        from {customer}""",
    "timepoints": """
        select l_orderkey * 10 + l_linenumber as id,
               case l_linenumber % 5 when 1 then 'approval date' when 2 then 'review date'
                    when 3 then 'submission date' when 4 then 'completion date'
                    else 'other date' end as name,
               max(l_shipdate) as date, cast(null as string) as slug, l_orderkey as order_id,
               'tp-' || cast(l_orderkey * 10 + l_linenumber as string) as uuid,
               cast(null as timestamp) as created_at, cast(null as timestamp) as updated_at
        from {lineitem} group by l_orderkey, l_linenumber""",
    "invoices": """
        select o_orderkey as id, 'INV-' || cast(o_orderkey as string) as invoice_number,
               o_orderpriority = '5-LOW' as cancelled, o_orderdate as issued_at,
               case when o_orderstatus = 'P' then 'credit' else 'standard' end as document_type,
               cast(null as decimal(9,4)) as commission_rate, o_orderkey as purchase_order_id,
               o_orderdate as created_at, o_orderdate as updated_at,
               'in-' || cast(o_orderkey as string) as uuid,
               cast(o_totalprice as decimal(18,4)) - cast(o_custkey % 50 as decimal(18,4))
                   as subtotal_price,
               cast(o_totalprice as decimal(18,4)) as total_price,
               cast(o_orderkey % 13 as decimal(18,4)) as discount_amount,
               o_orderkey % 120 as provider_id, o_orderkey as order_id,
               case when o_orderstatus = 'O' then null else o_orderstatus = 'F' end
                   as approved_for_payment,
               cast(null as string) as discount
        from {orders}""",
    "ratings": """
        select o_orderkey as id, 1 + o_orderkey % 5 as value, cast(o_custkey as string) as ware_id,
               o_orderpriority = '1-URGENT' as spam, o_orderkey % 120 as provider_id,
               o_orderdate as created_at, o_custkey as ware_pg_id, o_custkey as request_id,
               o_orderkey as order_id, o_orderpriority as comment, o_custkey as organization_id,
               o_custkey as user_id
        from {orders}""",
    "providers": """
        select s_suppkey as id, s_name as name, lower(s_name) as slug,
               'pv-' || cast(s_suppkey as string) as uuid, cast(null as timestamp) as created_at,
               split(s_name || ';certified', ';') as certifications,
               split(case s_nationkey % 4
                     when 0 then 'Create Account;Add Addresses;other'
                     when 1 then 'Add Addresses, Create Account;Add Certifications'
                     when 2 then 'Create Account;Create Account;Update Company Profile;'
                     else 'add addresses; Add Accounting Details' end, ';') as setup,
               s_acctbal as score, s_nationkey as tier,
               split(s_name || '@example.org', ';') as contact_emails,
               s_name || '@example.org' as sales_email, cast(null as string) as phone_number,
               s_nationkey as ads_advertiser_id, cast(null as string) as website,
               '1-10' as number_of_employees, 'lab' as type_of_company
        from {supplier}""",
    "action_items": """
        select o_orderkey as id,
               case when o_orderstatus = 'F' then 'new_request' else 'reply' end as action_performed,
               o_custkey as proposal_id, o_orderkey as purchase_order_id,
               case when o_orderpriority <> '1-URGENT'
                    then 'S' || cast(o_custkey as string) end as provider_id,
               cast(floor(o_orderkey / 3) as bigint) as order_id
        from {orders}""",
    "refs": """
        select event_id as id,
               case when event_type in ('view', 'signup') then 'Pg::UserRef'
                    else 'Pg::ProviderRef' end as type_,
               case event_type
                    when 'view' then '{{"location": "L' || cast(user_id as string)
                        || '", "email": "e' || cast(event_id as string)
                        || '@example.org", "company": null, "last_name": "Last"}}'
                    when 'signup' then '{{"first_name": "First", "organization_name": "Org '
                        || cast(user_id as string) || '", "email": 7}}'
                    when 'click' then '{{"name": "N' || cast(user_id as string)
                        || '", "slug": "s", "score": ' || cast(user_id as string) || '}}'
                    when 'error' then '{{"name": null, "score": [' || cast(user_id as string)
                        || ', 1], "contract_status": "active"}}'
                    else '{{"score": null}}' end as fields,
               'User' as reference_of_type, 'Org' as reference_to_type,
               user_id as reference_of_id, user_id + 1 as reference_to_id,
               'rf-' || cast(event_id as string) as uuid,
               case when event_type = 'view' then null else ts end as created_at, ts as updated_at
        from {events}""",
    "events": """
        select event_id as id,
               case when event_type <> 'error' then event_type end as event,
               case when event_type = 'purchase' then 'u' || cast(user_id as string) || '-'
                    || cast(event_id as string) || '@example.org' end as email,
               cast(null as string) as username, 'shop' as application, value as duration,
               cast(null as string) as remote_addr, 'host' as host, event_type as action,
               cast(null as string) as controller,
               case when event_type <> 'signup' then cast(user_id as string) end as session_id,
               cast(null as string) as computer_id, cast(null as string) as query,
               cast(null as string) as raw_post, split('cat;' || event_type, ';') as categories,
               case when event_type <> 'view' then split('web;' || event_type, ';') end as source,
               props as providers, 'ev-' || cast(event_id as string) as uuid, ts as datetime,
               ts as created_at, ts as updated_at, cast(null as string) as api_version,
               user_id as organization_id
        from {events}""",
    "embedded_dynamic_forms": """
        select event_id as id, event_type as name, user_id as version_number, 'form' as slug,
               cast(null as string) as key, '{{"v": 1}}' as schema, cast(null as string) as options,
               props as data, ts as created_at, ts as updated_at
        from {events}""",
    "clicks": """
        select '"' || cast(event_id as string) || '"' as id,
               '{{"Id":"' || cast(event_id as string) || '","Meta:schema":"click","BurnIn":'
               || case when event_type = 'view' then 'true' else 'false' end
               || ',"Device":' || case when event_type = 'view' then 'null'
                                       else '"phone ' || cast(event_id % 4 as string) || '"' end
               || ',"PassId":' || cast(user_id as string) || '@MORE@'
               || '"IsNoTrack":"' || case event_id % 3 when 0 then 'on' when 1 then 'off' else 'true' end
               || '","DataCenter":' || case when event_id % 2 = 0 then '"OFF"' else 'false' end
               || ',"ImpressionCreatedOn":' || cast(1600000000000 + event_id * 7007 as string)
               || ',"CreatedOn":"/Date(' || cast(1700000000000 + event_id * 1001 as string)
               || ')/","EventCreatedOn":' || cast(1700000000000 + event_id * 1001 as string)
               || ',"Keywords":"' || event_type || '","TimeZoneId":"UTC","Price":"0.5","User":'
               || '{{"Key":"u' || cast(user_id as string) || '","IsNew":false,"Type":'
               || cast(user_id % 3 as string) || '}}}}' as data,
               event_type || '.gz' as file_name, ts as last_modified_date,
               cast(extract(year from ts) as int) as year
        from {events}""".replace("@MORE@", _MORE),
    "session_clicks": """
        select '"' || cast(user_id as string) || '"' as id,
               '{{"Id":"' || cast(user_id as string) || '","n":' || cast(event_id as string)
               || '}}' as data,
               event_type || '.gz' as file_name, ts as last_modified_date,
               cast(extract(year from ts) as int) as year
        from {events}""",
    "wpcs": """
        select o_orderkey as id, o_custkey as ware_id, o_orderkey % 100 as provider_id,
               o_orderstatus = 'F' as required, o_orderdate as created_at,
               o_orderdate as updated_at, o_orderkey % 7 as organization_id,
               o_orderstatus = 'O' as auto_assigned, 1.0 * (o_orderkey % 9) as booster
        from {orders}""",
    "boost_scores": """
        select min(o_orderkey) as id, o_orderkey % 7 as organization_id, o_custkey as ware_id,
               o_orderkey % 100 as provider_id,
               cast(max(o_orderkey) % 900 as double) / 100 as updated_booster,
               case when min(o_orderstatus) = 'F' then 'true' else 'false' end as update
        from {orders} group by o_custkey, o_orderkey % 7, o_orderkey % 100""",
    "addresses": """
        select c_custkey as id, 'Pg::Address' as type_, c_name as organization_name,
               cast(null as string) as site_name, cast(null as string) as attention,
               c_name as person_name, cast(null as string) as care_of,
               cast(null as string) as notes, cast(null as string) as total, 'USD' as currency,
               cast(null as string) as address_id,
               case when c_nationkey % 5 = 0 then null when c_nationkey % 5 = 1 then ''
                    else 'Street ' || cast(c_custkey as string) end as street,
               case when c_nationkey % 3 = 1 then 'Floor ' || cast(c_nationkey as string) end
                   as street2,
               case when c_nationkey % 5 > 1 then 'City' end as city,
               cast(null as string) as state,
               case when c_nationkey % 5 > 2 then '0' || cast(c_nationkey as string) end as zipcode,
               case when c_nationkey % 5 > 3 then 'US' end as country,
               cast(null as timestamp) as created_at, cast(null as timestamp) as updated_at,
               c_custkey as addressable_id, 'Pg::Customer' as addressable_type,
               c_custkey as legal_entity_id
        from {customer}""",
    "inventories": """
        select event_id as id, user_id as inventory_group_id, props as data, ts as created_at,
               ts as updated_at, 'iv-' || cast(event_id as string) as uuid,
               event_type as product_name, 'http://example.org/' || event_type as product_url,
               user_id as provider_id
        from {events}""",
    "inventory_groups": """
        select s_suppkey as id, s_nationkey as index,
               '{{"tier": ' || cast(s_nationkey as string) || '}}' as metadata,
               cast(s_acctbal as decimal(18,4)) as shipping_cost, cast(null as timestamp) as created_at,
               cast(null as timestamp) as updated_at, 'ig-' || cast(s_suppkey as string) as uuid,
               cast(null as timestamp) as deleted_at
        from {supplier}""",
    "organizations": """
        select c_custkey as id, c_name as name,
               'og-' || cast(c_custkey as string) as uuid, cast(null as timestamp) as created_at,
               cast(null as timestamp) as updated_at,
               case when c_custkey > 0 then c_nationkey end as parent_id,
               lower(c_mktsegment) || '.example.org' as domain, c_acctbal > 0 as webstore,
               cast(null as timestamp) as archived_at
        from {customer}""",
    "wares": """
        select p_partkey as id, p_name as name, cast(null as timestamp) as created_at,
               cast(null as timestamp) as updated_at, lower(p_brand) as slug,
               p_brand as description, p_type as ware_type
        from {part}""",
    "notes": """
        select doc_id as id, source as title, text as body, lang as status, n_chars as request_id,
               'nt-' || cast(doc_id as string) as uuid, cast(n_chars as string) as ware_id,
               doc_id as user_id, cast(null as bigint) as invoice_id,
               cast(null as bigint) as purchase_order_id, cast(null as bigint) as proposal_id,
               cast(null as timestamp) as created_at, cast(null as timestamp) as updated_at
        from {documents}""",
}


# Schemas by path, so that a table's footer is read for its schema once and not for every query.
_SCHEMAS: dict[str, StructType] = {}


class Entities:
    """Entity frames over the Parquet tables of a folder, built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def base(self, table: str) -> DataFrame:
        path = f"{self.folder}/{table}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def __getitem__(self, entity: str) -> DataFrame:
        text = VIEWS[entity].replace("as timestamp)", "as timestamp_ntz)")
        used = {t: self.base(t) for t in BASE_TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    def frames(self, *entities: str) -> list[DataFrame]:
        return [self[e] for e in entities]


def duckdb_view(entity: str) -> str:
    """The same view for DuckDB, where base tables are plain names."""
    return VIEWS[entity].format(**{t: t for t in BASE_TABLES})
