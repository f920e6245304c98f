"""Expected results of the registered queries, as SQL for DuckDB over the same base tables.

The SQL is written from the rules, not from the plans: ranked rows instead of keyed aggregates,
correlated unnesting instead of array functions.
"""

from __future__ import annotations

from ledgerloom.plans.snapshots import SNAPSHOTS

from .entities import BASE_TABLES, CLICK_INTS, CLICK_TEXTS, duckdb_view

_FIXED_TODAY, _FIXED_WEEKS_TODAY = "date '2024-01-20'", "date '2024-01-30'"


def _with(entities: tuple[str, ...], body: str, *more: str) -> str:
    """The body over the named entities, each as a CTE with the prefix e_."""
    parts = [f"e_{name} as ({duckdb_view(name)})" for name in entities]
    return "with " + ",\n".join([*parts, *more]) + "\n" + body


def _ranked(name: str, source: str, key: str, where: str, order: str) -> str:
    """A CTE with the chosen child row per key."""
    return f"""{name} as (
        select * from (
            select *, row_number() over (partition by {key} order by id {order}) as rn
            from {source} where {key} is not null and {where}) ranked
        where rn = 1)"""


_PO_OWNED = "in ('Pg::PurchaseOrderBase', 'Pg::PurchaseOrderBaseInit')"
_STATUS = """case when po.obsoleted then 'Obsoleted'
         when po.version_number > 1 and po.referenced_po_id is not null then 'Amended'
         when po.completed then 'Completed'
         when po.rejected then 'Rejected'
         when po.po_number is null then 'Awaiting PO'
         else 'Work in Progress' end"""

_PO_ENTITIES = ("purchase_orders", "currencies", "shippings", "taxes", "providers", "action_items")
_PO_CHILDREN = (
    _ranked("ppo", "e_purchase_orders", "cpo_id", "type_ = 'Pg::ProviderPurchaseOrder'", "desc"),
    _ranked("cur", "e_currencies", "exchangable_id", f"exchangable_type {_PO_OWNED}", "desc"),
    _ranked("ship", "e_shippings", "shipable_id", f"shipable_type {_PO_OWNED}", "asc"),
    _ranked(
        "tax", "e_taxes", "taxable_id", f"taxable_type {_PO_OWNED} and type_ = 'Pg::RetailTax'",
        "desc",
    ),
    _ranked(
        "ptax", "e_taxes", "taxable_id",
        "taxable_type = 'Pg::ProposalBase' and type_ = 'Pg::RetailTax'", "desc",
    ),
    _ranked("pship", "e_shippings", "shipable_id", "shipable_type = 'Pg::ProposalBase'", "desc"),
    _ranked("act", "e_action_items", "order_id", "action_performed = 'new_request'", "asc"),
    """joined as (
        select po.*,
               case when ppo.id is null then po.ad_po_number else ppo.ad_po_number end as left_number,
               cur.id as cur_id, cur.currency as cur_code,
               case when cur.id is null then 1.0::double
                    else cur.conversion_rate::double end as rate,
               ship.id as ship_id,
               case when ship.cost <> 0 then ship.cost::double
                    else coalesce(pship.cost::double, 0) end as ship_cost,
               case when tax.amount <> 0 then tax.amount::double
                    else coalesce(ptax.amount::double, 0) end as tax_value,
               coalesce(tax.percent_rate::double, 0) as tax_pct,
               act.provider_id as supplier, pv.name as provider_name
        from e_purchase_orders po
        left join ppo on ppo.cpo_id = po.id
        left join cur on cur.exchangable_id = po.id
        left join ship on ship.shipable_id = po.id
        left join tax on tax.taxable_id = po.id
        left join ptax on ptax.taxable_id = po.proposal_id
        left join pship on pship.shipable_id = po.proposal_id
        left join act on act.order_id = po.order_id
        left join e_providers pv on pv.id = po.provider_id
        where po.type_ in ('Pg::CustomerPurchaseOrder', 'Pg::PurchaseOrder')
          and po.po_number is not null and po.po_created_at is not null)""",
)

ORACLES: dict[str, str] = {}

ORACLES["po_status"] = _with(
    ("purchase_orders",),
    f"""select id, {_STATUS} as status,
               po.version_number > 1 and po.referenced_po_id is not null as updated,
               po.po_number is null as purchase_requisition,
               po.po_number is not null as purchase_order
        from e_purchase_orders po""",
)

ORACLES["po_left_partner_number"] = _with(
    ("purchase_orders",),
    """select po.id, case when ppo.id is null then po.ad_po_number else ppo.ad_po_number end
                  as ad_po_number
       from e_purchase_orders po left join ppo on ppo.cpo_id = po.id
       where po.type_ in ('Pg::CustomerPurchaseOrder', 'Pg::PurchaseOrder')""",
    _PO_CHILDREN[0],
)

ORACLES["po_report"] = _with(
    _PO_ENTITIES,
    f"""select po.id, po.left_number as ad_po_number, po.po_number, po.po_created_at,
               po.po_created_at::date as po_submission_date, {_STATUS} as status, po.created_at,
               po.proposal_id, po.total_price::double as total_price,
               po.subtotal_price::double as subtotal_price, po.provider_id, po.provider_name,
               po.supplier as supplier_id,
               array_to_string(po.justifications, ', ') as justifications, po.cur_code as currency,
               po.rate as conversion_rate, po.total_price::double / po.rate as total_price_usd,
               po.subtotal_price::double / po.rate as subtotal_price_usd,
               po.tax_value as tax_amount, po.tax_pct as tax_percent,
               (po.tax_value + po.ship_cost * po.tax_pct / 100) / po.rate as tax_amount_usd,
               po.ship_cost as shipping_cost, po.ship_cost / po.rate as shipping_cost_usd,
               coalesce(po.commission_rate::double, 0) / 100 as commission_rate, po.order_id,
               po.provider_shipping_address_id, po.customer_shipping_address_id, po.cpo_id, po.uuid,
               po.rejected::varchar as rejected, po.obsoleted::varchar as obsoleted, po.type_,
               po.supplier_updated, po.updated_at, po.user_id, po.payment_terms, po.request_id
        from joined po where po.ship_id is not null""",
    *_PO_CHILDREN,
)

ORACLES["contract_rejects"] = _with(
    _PO_ENTITIES,
    """select id, 'no shipping row' as reasons from joined where ship_id is null""",
    *_PO_CHILDREN,
)

ORACLES["po_retail_totals"] = _with(
    ("purchase_orders", "milestones", "shippings", "currencies"),
    """select po.id,
              round(coalesce(m.price, 0)::double, 8) as retail_subtotal_price,
              round(coalesce(m.tax, 0)::double, 8) as retail_tax_amount,
              round((coalesce(m.price, 0) + coalesce(m.tax, 0) + coalesce(ship.cost, 0))::double, 8)
                  as retail_total_price,
              round((coalesce(m.price, 0) + coalesce(m.tax, 0) + coalesce(ship.cost, 0))::double
                    / coalesce(cur.conversion_rate, 1)::double, 8) as retail_total_price_usd
       from e_purchase_orders po
       left join (select itemizable_id, sum(total_price) as price,
                         sum(total_price * tax_rate * 0.01) as tax
                  from e_milestones group by itemizable_id) m on m.itemizable_id = po.id
       left join ship on ship.shipable_id = po.id
       left join cur on cur.exchangable_id = po.id""",
    _PO_CHILDREN[1],
    _PO_CHILDREN[2],
)

ORACLES["proposal_report"] = _with(
    ("proposals", "currencies", "turn_around_times", "taxes", "providers"),
    """, values_of as (
        select p.*, cur.id as cur_id, cur.currency as cur_code, tat.id as tat_id,
               tat.min as tat_min, tat.max as tat_max, tat.display_units as tat_units,
               tax.amount::double as tax_value, pv.name as provider_name,
               case when cur.id is null then 1.0::double
                    else cur.conversion_rate::double end as rate,
               case when p.created_at > timestamp '2018-06-01 00:00:00'
                    then p.total_price::double - coalesce(tax.amount::double, 0)
                    else p.total_price::double end as untaxed
        from e_proposals p
        left join cur on cur.exchangable_id = p.id
        left join tat on tat.turnaroundable_id = p.id
        left join tax on tax.taxable_id = p.id
        left join e_providers pv on pv.id = p.provider_id
        where p.active and p.order_id is not null)
       select id, active::varchar as active, proposal_type, exclude::varchar as exclude,
              array_to_string(justifications, ', ') as justifications, user_full_name, provider_id,
              provider_name, created_at, created_at::date as created_on, updated_at,
              subtotal_price::double as subtotal_price, total_price::double as total_price,
              tax_value as tax, untaxed as total_price_no_tax,
              case when cur_id is null then 'USD' else cur_code end as currency_name,
              rate as conversion_rate, untaxed / rate as total_price_usd,
              total_price::double / rate as total_price_with_tax_usd,
              case when tat_id is null then 0 else tat_min end as min_turnaround_time,
              case when tat_id is null then 0 else tat_max end as max_turnaround_time,
              case when tat_id is null then 'None' else tat_units end as display_units,
              tax_category, order_id, type_, obsoleted::varchar as obsoleted, state, ware_id,
              user_id, uuid, description, commission_rate::double as commission_rate, status
       from values_of""",
    _ranked("cur", "e_currencies", "exchangable_id", "exchangable_type = 'Pg::ProposalBase'", "desc"),
    _ranked(
        "tat", "e_turn_around_times", "turnaroundable_id",
        "turnaroundable_type = 'Pg::ProposalBase'", "desc",
    ),
    _PO_CHILDREN[4].replace("ptax as", "tax as"),
)

ORACLES["tat_adjusted"] = _with(
    ("turn_around_times",),
    """select id, min // unit as adjusted_min, max // unit as adjusted_max
       from (select *, case display_units when 'hours' then 3600 when 'weeks' then 604800
                            when 'months' then 2592000 else 86400 end as unit
             from e_turn_around_times)""",
)

_STEP_NAMES = ("approval", "review", "submission", "completion")
_STEP_CTES = tuple(
    _ranked(f"{s}_tp", "e_timepoints", "order_id", f"name = '{s} date'", "desc") for s in _STEP_NAMES
)
_ORDER_ENTITIES = ("orders", "providers", "requests", "users", "timepoints")
_ORDER_SELECT = """select o.id, o.provider_id, pv.name as provider_name, o.request_id,
              u.email as user_email, o.client_id, r.organization_id,
              json(o.obligations)::varchar as obligations, o.state, o.declined, o.order_cancelled,
              o.request_cancelled, o.last_computed_status, o.uuid, o.created_at, o.updated_at,
              {dates}, o.booster
       from e_orders o
       left join e_providers pv on pv.id = o.provider_id
       left join e_requests r on r.id = o.request_id
       left join e_users u on u.id = r.user_id """

ORACLES["order_report"] = _with(
    _ORDER_ENTITIES,
    _ORDER_SELECT.format(dates=", ".join(f"{s}_tp.date::date as {s}_date" for s in _STEP_NAMES))
    + " ".join(f"left join {s}_tp on {s}_tp.order_id = o.id" for s in _STEP_NAMES),
    *_STEP_CTES,
)

ORACLES["order_report_by_timepoint_id"] = _with(
    _ORDER_ENTITIES,
    _ORDER_SELECT.format(
        dates=", ".join(
            f"case when t.name = '{s} date' then t.date::date end as {s}_date" for s in _STEP_NAMES
        )
    )
    + """left join (select * from e_timepoints where order_id in (select id from e_orders)) t
         on t.id = o.id""",
)

ORACLES["order_timepoint_pivot"] = _with(
    ("timepoints",),
    "select k.order_id, "
    + ", ".join(f"{s}_tp.date as {s}_date" for s in _STEP_NAMES)
    + " from (select distinct order_id from e_timepoints where name <> 'other date') k "
    + " ".join(f"left join {s}_tp on {s}_tp.order_id = k.order_id" for s in _STEP_NAMES),
    *_STEP_CTES,
)

_INVOICE_CHILDREN = (
    _ranked("cur", "e_currencies", "exchangable_id", "exchangable_type = 'Pg::Invoice'", "asc"),
    _ranked("ship", "e_shippings", "shipable_id", "shipable_type = 'Pg::Invoice'", "asc"),
)
ORACLES["invoice_report"] = _with(
    ("invoices", "currencies", "shippings"),
    """, signed as (
        select i.*, case when document_type = 'standard' then 1 else -1 end as sign,
               coalesce(cur.conversion_rate::double, 1.0) as rate,
               coalesce(cur.currency, 'USD') as code, ship.cost::double as cost
        from e_invoices i
        join cur on cur.exchangable_id = i.id
        join ship on ship.shipable_id = i.id),
       priced as (
        select *, sign * subtotal_price::double as sub, sign * total_price::double as tot,
               case when sign * total_price::double < 0 then -cost else cost end as shipped
        from signed)
       select id, invoice_number, issued_at, purchase_order_id, created_at,
              created_at::date as created_on, sub as subtotal_price, tot as total_price,
              discount_amount::double as discount_amount,
              tot - sub - shipped + discount_amount::double as tax, code as currency_name,
              rate as conversion_rate, document_type, abs(tot / rate) as total_price_usd,
              provider_id, order_id, shipped as shipping_cost, cancelled::varchar as cancelled, uuid,
              approved_for_payment, discount
       from priced""",
    *_INVOICE_CHILDREN,
)
ORACLES["invoice_rejects"] = _with(
    ("invoices", "currencies", "shippings"),
    """select i.id, 'no shipping row' as reasons from e_invoices i
       where not exists (select 1 from ship where ship.shipable_id = i.id)""",
    *_INVOICE_CHILDREN,
)

ORACLES["rating_report"] = _with(
    ("ratings", "providers"),
    """select r.id, r.value, r.ware_id, r.spam::varchar as spam, r.provider_id,
              p.name as provider_name, r.created_at, r.created_at::date as created_on, r.request_id,
              r.order_id, r.comment, r.organization_id, r.user_id
       from e_ratings r left join e_providers p on p.id = r.provider_id where not r.spam""",
)


def _snapshot_sql(name: str, /, **expressions: str) -> str:
    """Plain columns of a snapshot, with the given expressions for the others."""
    spec = SNAPSHOTS[name]
    chosen = ", ".join(f"{expressions.get(c, 't.' + c)} as {c}" for c in spec.columns)
    where = " where t.type_ = 'Pg::UserRef'" if name == "refs_users" else ""
    return _with((spec.table,), f"select {chosen} from e_{spec.table} t{where}")


def _double(*columns: str) -> dict[str, str]:
    return {c: f"t.{c}::double" for c in columns}


def _text(*columns: str) -> dict[str, str]:
    return {c: f"t.{c}::varchar" for c in columns}


def _json(*columns: str) -> dict[str, str]:
    return {c: f"json(t.{c})::varchar" for c in columns}


ORACLES["provider_completeness"] = _snapshot_sql(
    "providers",
    certifications="array_to_string(t.certifications, ', ')",
    contact_emails="array_to_string(t.contact_emails, ', ')",
    percent_completeness="""20 * (
        select count(*)::int from unnest(string_split(array_to_string(t.setup, ', '), ',')) as s(item)
        where ltrim(s.item) in ('Create Account', 'Update Company Profile', 'Add Addresses',
                                'Add Certifications', 'Add Accounting Details'))""",
)
ORACLES["request_filters"] = _snapshot_sql(
    "requests", **{f"filter{i}": f"coalesce(t.filters[{i}], '')" for i in (1, 2, 3)}
)
ORACLES["user_full_name"] = _with(
    ("users",),
    """select id, case when first_name is null then last_name when last_name is null then first_name
              else first_name || ' ' || last_name end as full_name from e_users""",
)
ORACLES["address_line"] = _with(
    ("addresses",),
    """select id, nullif(concat_ws(' ', street, street2, city, state, zipcode, country), '') as address
       from e_addresses""",
)
_REF_TEXT = "replace(json_extract(t.fields, '$.{k}')::varchar, '\"', '')"
ORACLES["refs_json_fields"] = _snapshot_sql(
    "refs_users",
    created_at="coalesce(t.created_at, timestamp '2020-11-26 00:00:00')",
    updated_at="coalesce(t.updated_at, timestamp '2020-11-26 00:00:00')",
    **{
        k: f"coalesce({_REF_TEXT.format(k=k)}, '')"
        for k in ("location", "email", "company", "last_name", "first_name", "organization_name")
    },
)
ORACLES["refs_provider_score"] = _snapshot_sql(
    "refs_providers",
    score="""coalesce(json_extract_string(t.fields, '$.score[0]'),
                      case when json_type(t.fields, '$.score') in ('UBIGINT', 'BIGINT', 'DOUBLE')
                           then json_extract_string(t.fields, '$.score') end)::double""",
    **{k: f"json_extract(t.fields, '$.{k}')::varchar" for k in ("name", "slug", "contract_status")},
)
_FIRST_MOMENT = "timestamp '0001-01-01 00:00:00'"
ORACLES["milestone_placeholders"] = _snapshot_sql(
    "milestones",
    _type="t.type_",
    estimated_date="coalesce(t.estimated_date::date, date '0001-01-01')::varchar",
    **{
        c: f"coalesce(t.{c}, {_FIRST_MOMENT})::varchar"
        for c in ("created_at", "updated_at", "cancelled_at", "shipped_at")
    },
    **_double("quantity", "tax_rate", "unit_price", "total_price"),
    **_json("classifications"),
)
ORACLES["snapshot_pruned"] = _snapshot_sql("addresses")
ORACLES["snapshot_currencies"] = _with(
    ("currencies",),
    """select id, exchangable_id, exchangable_type, currency,
              conversion_rate::double as conversion_rate, conversion_set_at,
              json(conversion_history)::varchar as conversion_history, created_at, updated_at
       from e_currencies where conversion_rate is not null""",
)
ORACLES["snapshot_inventories"] = _snapshot_sql("inventories", **_json("data"))
ORACLES["snapshot_inventory_groups"] = _snapshot_sql(
    "inventory_groups", **_double("shipping_cost"), **_json("metadata")
)
ORACLES["snapshot_notes"] = _snapshot_sql("notes")
ORACLES["snapshot_organizations"] = _snapshot_sql("organizations", **_text("webstore"))
ORACLES["snapshot_shippings"] = _snapshot_sql("shippings", **_double("cost"), **_text("free_shipping"))
ORACLES["snapshot_taxes"] = _snapshot_sql("taxes", **_double("amount", "percent_rate"))
ORACLES["snapshot_users"] = _snapshot_sql(
    "users",
    **_text("active"),
    **_json("sso_attributes"),
    full_name="""case when t.first_name is null then t.last_name
                      when t.last_name is null then t.first_name
                      else t.first_name || ' ' || t.last_name end""",
    user_sso_email="coalesce(json_extract(t.sso_attributes, '$.email')::varchar, 'null')",
)
ORACLES["snapshot_wares"] = _snapshot_sql("wares")
ORACLES["snapshot_wpcs"] = _snapshot_sql("wpcs", **_double("booster"))
ORACLES["inventories_grouped"] = _with(
    ("inventories", "inventory_groups"),
    """select i.id, i.inventory_group_id, i.product_name, i.provider_id, g.index as group_index,
              g.shipping_cost::double as group_shipping_cost
       from e_inventories i left join e_inventory_groups g on g.id = i.inventory_group_id""",
)
ORACLES["snapshot_registered"] = ORACLES["snapshot_wares"]

# Events and forms.
_MODULE = "cast(ceil(extract(day from {d}) / 7.0) as int)"
_LABEL = (
    "extract(year from created_at)::varchar || '-' || extract(month from created_at)::varchar"
    " || '-' || " + _MODULE.format(d="created_at") + "::varchar"
)
_EVENT_FIELDS = """id, event, email, username, {application} as application, duration, remote_addr,
    host, action, controller, session_id, computer_id, query, raw_post,
    coalesce(array_to_string(source, ', '), '') as categories,
    coalesce(array_to_string(source, ', '), '') as source,
    json(providers)::varchar as providers, uuid, datetime, created_at, updated_at"""
_PLAIN_EVENT = _EVENT_FIELDS.format(application="application")

ORACLES["events_month_week"] = _with(
    ("events",), f"select {_PLAIN_EVENT}, {_LABEL} as dt from e_events where event is not null"
)
# Modules 2 and 3 of January 2024: days 8 to 21.
_JANUARY_SPAN = "created_at >= timestamp '2024-01-08' and created_at < timestamp '2024-01-22'"
ORACLES["events_month_week_windowed"] = ORACLES["events_month_week"] + f" and {_JANUARY_SPAN}"

_FORM_FIELDS = f"""id, name, version_number, slug, key, json(schema)::varchar as schema,
    json(options)::varchar as options, json(data)::varchar as data, created_at, updated_at,
    {_LABEL} as dt"""
ORACLES["forms_month_week"] = _with(
    ("embedded_dynamic_forms",), f"select {_FORM_FIELDS} from e_embedded_dynamic_forms"
)
ORACLES["forms_windowed"] = ORACLES["forms_month_week"] + f" where {_JANUARY_SPAN}"

_WEEKLY = """weekly as (
    select *, date_trunc('week', created_at)::date as monday,
           case when session_id is not null then
               first_value(email ignore nulls) over (
                   partition by date_trunc('week', created_at), session_id order by id
                   rows between unbounded preceding and unbounded following) end as full_email
    from e_events where event is not null)"""
_WEEK_PARTS = """extract(year from monday)::int as dt_year,
    extract(month from monday)::int as dt_month, extract(day from monday)::int as dt_start_week"""
ORACLES["events_session_email"] = _with(
    ("events",),
    f"""select {_EVENT_FIELDS.format(application="''")}, organization_id, full_email, {_WEEK_PARTS}
        from weekly where monday between date '2023-12-18' and date '2024-01-29'""",
    _WEEKLY,
)
ORACLES["events_iso_week_counts"] = _with(
    ("events",),
    f"""select {_WEEK_PARTS}, count(*) as events, count(full_email) as with_email
        from weekly group by monday""",
    _WEEKLY,
)

_LABEL_LIST = "(values ('2024-1-2'), ('2024-1-3')) as w(label)"
ORACLES["run_manifest"] = _with(
    ("events",),
    f"""select 'dt=' || w.label as window_start, count(e.id) as rows
        from {_LABEL_LIST}
        left join (select id, {_LABEL} as dt from e_events where event is not null) e
               on e.dt = w.label
        group by w.label""",
)
ORACLES["partition_refresh"] = _with(
    ("events",), f"select id, {_LABEL} as dt from e_events where event is not null"
)
ORACLES["week_partition_refresh"] = _with(
    ("events",),
    f"""select 'dt_year=' || extract(year from m) || '/dt_month=' || extract(month from m)
               || '/dt_start_week=' || extract(day from m) as window_start,
               count(weekly.id) as rows
        from (select unnest(generate_series(
                  date_trunc('week', {_FIXED_WEEKS_TODAY} - 37)::timestamp,
                  {_FIXED_WEEKS_TODAY}::timestamp, interval 7 day))::date as m)
        left join weekly on weekly.monday = m group by m""",
    _WEEKLY,
)

# Clicks.
_FLAG = (
    "case lower(json_extract_string(data, '$.{0}')) when 'on' then true when 'off' then false"
    " else json_extract_string(data, '$.{0}')::boolean end"
)
ORACLES["clicks_flatten"] = _with(
    ("clicks",),
    "select "
    + ", ".join(
        [
            "json_extract_string(data, '$.Id') as id",
            "json_extract_string(data, '$.\"Meta:schema\"') as metaschema",
            "json_extract_string(data, '$.BurnIn')::boolean as burnin",
            "json_extract_string(data, '$.Device') as device",
            "json_extract_string(data, '$.PassId')::int as passid",
            "make_timestamp(regexp_extract(data, 'Date\\(([0-9]+)', 1)::bigint * 1000) as created_on",
            "make_timestamp(json_extract_string(data, '$.EventCreatedOn')::bigint * 1000)"
            " as eventcreatedon",
            "make_timestamp(json_extract_string(data, '$.ImpressionCreatedOn')::bigint * 1000)"
            " as impressioncreatedon",
            "json_extract_string(data, '$.Keywords') as keywords",
            "json_extract_string(data, '$.TimeZoneId') as timezoneid",
            "json_extract_string(data, '$.Price') as price",
            "json_extract_string(data, '$.User.Key') as user_key",
            "json_extract_string(data, '$.User.IsNew')::boolean as user_is_new",
            "json_extract_string(data, '$.User.Type')::int as user_type",
            *(f"{_FLAG.format(m)} as {m.lower()}" for m in ("IsNoTrack", "DataCenter")),
            *(f"json_extract_string(data, '$.{m}') as {m.lower()}" for m in CLICK_TEXTS),
            *(f"json_extract_string(data, '$.{m}')::int as {m.lower()}" for m in CLICK_INTS),
            "file_name",
            "last_modified_date",
            "year",
        ]
    )
    + " from e_clicks",
)
_FIRST_CLICKS = """first_rows as (
    select * from (select *, row_number() over (
                       partition by id, year order by last_modified_date, file_name, data) as rn
                   from e_session_clicks) ranked
    where rn = 1)"""
_CLICK_FIELDS = "id, data, file_name, last_modified_date, year"
ORACLES["clicks_dedupe"] = _with(
    ("session_clicks",), f"select {_CLICK_FIELDS} from first_rows", _FIRST_CLICKS
)
ORACLES["clicks_inserted_twice"] = ORACLES["clicks_dedupe"]
ORACLES["clicks_inserted_bucketed"] = ORACLES["clicks_dedupe"]
ORACLES["clicks_new_only"] = _with(
    ("clicks", "session_clicks"),
    f"""select {_CLICK_FIELDS} from (
            select *, row_number() over (
                       partition by id, year order by last_modified_date, file_name, data) as rn
            from (select * from e_clicks union all select * from e_session_clicks) b) f
        where rn = 1 and not exists (
            select 1 from e_clicks s
            where s.file_name = 'purchase.gz' and s.id = f.id and s.year = f.year)""",
)
ORACLES["clicks_high_water_mark"] = "select max(ts) as last_date from events"
ORACLES["clicks_high_water_marks"] = """
    select k.kind as table_name, max(ts) as last_date
    from (values ('view'), ('signup'), ('purchase'), ('click'), ('impression')) as k(kind)
    left join events on event_type = k.kind group by k.kind"""
ORACLES["clicks_from_objects"] = _with(("clicks",), "select id, data from e_clicks")
ORACLES["stream_clicks_available_now"] = """
    select id, '{"Id":' || id || '}' as data, file_name, ts as last_modified_date,
           extract(year from ts)::int as year
    from (select '"' || user_id::varchar || '"' as id, event_type || '.gz' as file_name, ts,
                 row_number() over (partition by user_id, extract(year from ts)
                                    order by ts, event_type) as rn
          from events) ranked
    where rn = 1"""

ORACLES["booster_writeback"] = _with(
    ("wpcs", "boost_scores"),
    """select w.id, w.ware_id, w.provider_id, w.required, w.created_at, w.updated_at,
              w.organization_id, w.auto_assigned,
              coalesce(s.updated_booster::decimal(3,2)::double, w.booster::double) as booster
       from e_wpcs w
       left join (select * from e_boost_scores where update = 'true') s
              using (ware_id, organization_id, provider_id)""",
)

# Reductions, paging and semi joins.
ORACLES["page_keyset"] = _with(
    ("wares",), "select * from e_wares where id > 99 order by id limit 100"
)
ORACLES["page_offset"] = _with(
    ("wares",), "select * from e_wares order by id limit 100 offset 100"
)
ORACLES["semi_reduced_children"] = _with(
    ("currencies", "proposals"),
    """select * replace (conversion_rate::double as conversion_rate)
       from e_currencies where exchangable_type = 'Pg::ProposalBase'
       and exchangable_id in (select id from e_proposals where active)""",
)
for _name, _order in (("last_wins", "desc"), ("first_wins", "asc")):
    ORACLES[_name] = _with(
        ("shippings",),
        "select * exclude (rn) replace (cost::double as cost) from chosen",
        _ranked("chosen", "e_shippings", "shipable_id", f"shipable_type {_PO_OWNED}", _order),
    )

# Calendar. Every rule is spelled out on the days that have an order.
_DAYS = """days as (
    select day, extract(year from day)::int as y, extract(month from day)::int as m,
           extract(day from day)::int as d, last_day(day) as month_end,
           cast(ceil(extract(day from day) / 7.0) as int) as week,
           (extract(year from day) % 4 = 0 and extract(year from day) % 100 <> 0)
               or extract(year from day) % 400 = 0 as leap
    from (select distinct o_orderdate::date as day from orders))"""
ORACLES["month_week_calendar"] = f"""with {_DAYS}
    select day, day + 1 as next_day, day - 1 as previous_day, month_end + 1 as next_month,
           make_date(y, m, 1) - 1 as previous_month, make_date(y, m, 1) as month_start, month_end,
           week as module, leap as is_leap,
           case when d > 7 then {_MODULE.format(d="(day - 7)")}
                else {_MODULE.format(d="(make_date(y, m, 1) - 2)")} end as earlier_module,
           make_date(y, m, week * 7 - 6) as module_first_day,
           least(make_date(y, m, 1) + week * 7 - 1, month_end) as module_last_day,
           day - (isodow(day)::int - 1) as week_start,
           y::varchar || '-' || m::varchar || '-' || week::varchar as label
    from days"""
ORACLES["refresh_windows"] = f"""with {_DAYS},
    years as (select day, y as year from days
              union all select day, y - 1 from days where m = 1 and d < 8),
    months as (select day, m as month from days
               union all select day, case when m = 1 then 12 else m - 1 end from days where d < 8),
    weeks as (select day, week from days
              union all select day, case when d >= 8 then week - 1 when m = 3 and leap then 5
                                         else 4 end from days),
    grid as (select day, year, month, week, last_day(make_date(year, month, 1)) as month_end
             from years join months using (day) join weeks using (day))
    select day, year, month, week, make_date(year, month, week * 7 - 6) as first_day,
           least(make_date(year, month, 1) + week * 7 - 1, month_end) as last_day
    from grid where week * 7 - 6 <= extract(day from month_end)"""
ORACLES["refresh_windows_contiguous"] = f"""with {_DAYS},
    marks as (select day, day as mark from days
              union all select day, make_date(y, m, week * 7 - 6) - 1 from days),
    parts as (select day, extract(year from mark)::int as year, extract(month from mark)::int as month,
                     cast(ceil(extract(day from mark) / 7.0) as int) as week,
                     last_day(mark) as month_end from marks)
    select day, year, month, week, make_date(year, month, week * 7 - 6) as first_day,
           least(make_date(year, month, 1) + week * 7 - 1, month_end) as last_day
    from parts"""
ORACLES["refresh_weeks"] = f"""with {_DAYS}
    select day, unnest(generate_series(
               ((day - 37) - (isodow(day - 37)::int - 1))::timestamp, day::timestamp,
               interval 7 day))::date as monday
    from days"""

# Write-back by name, counts, listings and streams.
ORACLES["booster_published"] = ORACLES["booster_writeback"]
ORACLES["footer_row_counts"] = " union all ".join(
    f"select '{t}' as table_name, count(*) as rows from {t}" for t in BASE_TABLES
)
ORACLES["listing_by_prefix"] = ORACLES["footer_row_counts"]
ORACLES["stream_distinct_keys"] = _with(
    ("session_clicks",), "select distinct id, year from e_session_clicks"
)
ORACLES["stream_clicks_bucketed"] = ORACLES["clicks_dedupe"]
ORACLES["stream_clicks_flatten"] = ORACLES["clicks_flatten"]
ORACLES["booster_files"] = ORACLES["booster_writeback"]
ORACLES["clicks_from_ledger"] = _with(
    ("session_clicks",),
    """select distinct id, true as this_year from e_session_clicks
       where file_name in ('view.gz', 'signup.gz', 'purchase.gz', 'click.gz', 'impression.gz')""",
)
ORACLES["stream_click_objects"] = ORACLES["clicks_from_ledger"]
ORACLES["declared_names"] = _with(
    ("purchase_orders",), "select id, type_, po_number, provider_id from e_purchase_orders"
)
ORACLES["page_all"] = _with(
    ("wares",),
    """select id, name, page, count(*) over (partition by page) as page_rows
       from (select id, name, (row_number() over (order by id) - 1) // 100 as page from e_wares)""",
)


# Contracts: rows that lack a column where their id is a multiple of a number, and why they are rejected.
def _lacks(column: str, number: int, reason: str | None = None, table: str = "t") -> str:
    return f"case when {table}.id % {number} = 0 or {table}.{column} is null then '{reason or f'{column} is null'}' end"


_CURRENCY_RULES = f"""case when cur.id is not null then {_lacks("conversion_rate", 5, "currency without rate", "cur")} end,
           case when cur.id is not null then {_lacks("currency", 7, "currency without code", "cur")} end"""


def _rejects(cases: str, source: str) -> str:
    return f"select * from (select t.id, concat_ws('; ', {cases}) as reasons from {source}) r where reasons <> ''"


ORACLES["broken_purchase_orders"] = _with(
    ("purchase_orders", "currencies", "shippings"),
    _rejects(
        f"""case when ship.id is null then 'no shipping row' end, {_CURRENCY_RULES},
           {_lacks("uuid", 11)}, {_lacks("rejected", 13)}, {_lacks("obsoleted", 17)}""",
        """e_purchase_orders t left join cur on cur.exchangable_id = t.id
           left join ship on ship.shipable_id = t.id
           where t.type_ in ('Pg::CustomerPurchaseOrder', 'Pg::PurchaseOrder')
             and t.po_number is not null and t.po_created_at is not null""",
    ),
    _PO_CHILDREN[1],
    _PO_CHILDREN[2],
)
ORACLES["broken_proposals"] = _with(
    ("proposals", "currencies"),
    _rejects(
        f"""{_CURRENCY_RULES}, {_lacks("justifications", 11)}, {_lacks("uuid", 13)}""",
        """e_proposals t left join cur on cur.exchangable_id = t.id
           where t.active and t.order_id is not null""",
    ),
    _ranked("cur", "e_currencies", "exchangable_id", "exchangable_type = 'Pg::ProposalBase'", "desc"),
)
ORACLES["broken_orders"] = _with(
    ("orders",), _rejects(f"""{_lacks("request_id", 3)}, {_lacks("booster", 5)}""", "e_orders t")
)
ORACLES["broken_invoices"] = _with(
    ("invoices", "currencies", "shippings"),
    _rejects(
        f"""case when cur.id is null then 'no currency row' end,
           case when ship.id is null then 'no shipping row' end, {_lacks("uuid", 11)}""",
        """e_invoices t left join (select * from cur where exchangable_id % 6 <> 0) cur on cur.exchangable_id = t.id
           left join ship on ship.shipable_id = t.id""",
    ),
    *_INVOICE_CHILDREN,
)
ORACLES["po_retail_exact"] = _with(
    ("purchase_orders", "milestones", "shippings"),
    """select po.id, coalesce(m.price, 0)::decimal(36, 21)::varchar as retail_subtotal_price,
              coalesce(m.tax, 0)::decimal(36, 21)::varchar as retail_tax_amount,
              (coalesce(m.price, 0)::decimal(36, 21) + coalesce(m.tax, 0)::decimal(36, 21)
               + coalesce(ship.cost, 0)::decimal(36, 21))::decimal(36, 21)::varchar as retail_total_price
       from e_purchase_orders po
       left join (select itemizable_id, sum(total_price) as price,
                         sum(total_price * tax_rate * 0.01) as tax
                  from e_milestones group by itemizable_id) m on m.itemizable_id = po.id
       left join ship on ship.shipable_id = po.id""",
    _PO_CHILDREN[2],
)
ORACLES["events_email_incremental"] = ORACLES["events_session_email"]
