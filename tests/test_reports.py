"""Reports over hand-made rows, with expected values worked out by hand."""

import math
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException

from ledgerloom.operators.lookup import SkewPolicy
from ledgerloom.plans import invoices, orders, proposals, purchase_orders
from ledgerloom.plans.ratings import rating_report

PO = "Pg::PurchaseOrderBase"
PROPOSAL = "Pg::ProposalBase"
DAY = datetime(2024, 5, 1, 10, 30)


def po(id, **more):
    row = dict(
        id=id, type_="Pg::PurchaseOrder", po_number=f"N{id}", po_created_at=DAY, uuid=f"u{id}",
        rejected=False, obsoleted=False, version_number=1, total_price=10, subtotal_price=8,
    )
    return row | more


def shipping(id, owner, cost, kind=PO):
    return dict(id=id, shipable_id=owner, shipable_type=kind, cost=cost)


def tax(id, owner, amount, percent=0, kind=PO, type_="Pg::RetailTax"):
    return dict(
        id=id, taxable_id=owner, taxable_type=kind, amount=amount, percent_rate=percent, type_=type_
    )


def currency(id, owner, rate, code="EUR", kind=PO):
    return dict(
        id=id, exchangable_id=owner, exchangable_type=kind, conversion_rate=rate, currency=code
    )


@pytest.fixture
def po_report(table):
    def report(pos, ships=(), taxes=(), currencies=(), providers=(), actions=(), contract="valid"):
        frame = purchase_orders.purchase_order_report(
            table("purchase_orders", *pos),
            table("currencies", *currencies),
            table("shippings", *ships),
            table("taxes", *taxes),
            table("providers", *providers),
            table("action_items", *actions),
            contract=contract,
        )
        if contract == "valid":
            assert tuple(frame.columns) == purchase_orders.REPORT_COLUMNS
            assert len(frame.columns) == 37
        return {r.id: r for r in frame.collect()}

    return report


def test_partner_number_overrides_even_when_null(po_report):
    got = po_report(
        [
            po(1, ad_po_number="A"),
            po(2, ad_po_number="B"),
            po(3, ad_po_number="C"),
            po(11, type_="Pg::ProviderPurchaseOrder", cpo_id=1, ad_po_number=None),
            po(12, type_="Pg::ProviderPurchaseOrder", cpo_id=2, ad_po_number="X"),
            po(13, type_="Pg::ProviderPurchaseOrder", cpo_id=2, ad_po_number="Y"),
        ],
        [shipping(i, i, 1) for i in (1, 2, 3)],
    )
    assert {i: r.ad_po_number for i, r in got.items()} == {1: None, 2: "Y", 3: "C"}


def test_only_numbered_customer_orders(po_report):
    got = po_report(
        [
            po(1), po(2, po_number=None), po(3, po_created_at=None), po(4, type_="Pg::Other"),
            po(5, type_="Pg::CustomerPurchaseOrder"),
        ],
        [shipping(i, i, 1) for i in range(1, 6)],
    )
    assert set(got) == {1, 5}
    assert got[1].po_submission_date == date(2024, 5, 1) and got[1].rejected == "false"


def test_shipping_and_tax_fallbacks(po_report):
    got = po_report(
        [po(1, proposal_id=50), po(2), po(3, proposal_id=50), po(4, proposal_id=50)],
        [
            shipping(1, 1, 0), shipping(2, 2, 0), shipping(3, 3, 5), shipping(4, 4, 0),
            shipping(90, 50, 7, PROPOSAL),
        ],
        [
            tax(1, 1, 0, 4), tax(3, 3, 9, 5), tax(60, 50, 3, 8, PROPOSAL),
            tax(61, 2, 100, 50, type_="Pg::OtherTax"),
        ],
        [currency(3, 3, 2)],
    )
    assert {i: r.shipping_cost for i, r in got.items()} == {1: 7.0, 2: 0.0, 3: 5.0, 4: 7.0}
    assert {i: r.tax_amount for i, r in got.items()} == {1: 3.0, 2: 0.0, 3: 9.0, 4: 3.0}
    # The percentage comes from the own tax row only.
    assert {i: r.tax_percent for i, r in got.items()} == {1: 4.0, 2: 0.0, 3: 5.0, 4: 0.0}
    assert got[3].tax_amount_usd == (9 + 5 * 5 / 100) / 2 and got[3].shipping_cost_usd == 2.5


def test_children_are_chosen_by_id(po_report):
    got = po_report(
        [po(1, order_id=5, provider_id=8)],
        [shipping(2, 1, 4), shipping(1, 1, 3)],
        [tax(7, 1, 70), tax(6, 1, 60)],
        [currency(1, 1, 2, "A"), currency(2, 1, 4, "B", "Pg::PurchaseOrderBaseInit")],
        [dict(id=8, name="Lab")],
        [
            dict(id=3, order_id=5, action_performed="new_request", provider_id="S3"),
            dict(id=2, order_id=5, action_performed="new_request", provider_id=None),
            dict(id=1, order_id=5, action_performed="reply", provider_id="S1"),
        ],
    )[1]
    assert (got.shipping_cost, got.tax_amount, got.currency, got.conversion_rate) == (3, 70, "B", 4)
    assert got.provider_name == "Lab" and got.supplier_id is None and got.total_price_usd == 2.5


def test_rates(po_report):
    got = po_report(
        [po(1), po(2), po(3, total_price=0)],
        [shipping(i, i, 1) for i in (1, 2, 3)],
        currencies=[currency(2, 2, 0), currency(3, 3, 0)],
    )
    assert (got[1].conversion_rate, got[1].currency) == (1.0, None)
    assert got[2].total_price_usd == math.inf and math.isnan(got[3].total_price_usd)


def test_commission_and_justifications(po_report):
    got = po_report(
        [po(1, commission_rate=5, justifications=["a", "b"]), po(2)],
        [shipping(1, 1, 1), shipping(2, 2, 1)],
    )
    assert (got[1].commission_rate, got[1].justifications) == (0.05, "a, b")
    assert (got[2].commission_rate, got[2].justifications) == (0.0, "")


def test_null_key_does_not_match_a_child_of_id_zero(po_report):
    """A null foreign key matches nothing here, not even a row whose key is 0."""
    got = po_report(
        [po(1, proposal_id=None)], [shipping(1, 1, 0), shipping(2, 0, 9, PROPOSAL)],
        [tax(3, 0, 4, kind=PROPOSAL)],
    )
    assert (got[1].shipping_cost, got[1].tax_amount) == (0.0, 0.0)


def test_purchase_order_contract(po_report):
    pos = [po(1), po(2, uuid=None), po(3), po(4, obsoleted=None)]
    ships = [shipping(i, i, 1) for i in (2, 3, 4)]
    rates = [currency(3, 3, None, None)]
    assert set(po_report(pos, ships, currencies=rates)) == set()
    rejects = po_report(pos, ships, currencies=rates, contract="rejects")
    assert {i: r.reasons for i, r in rejects.items()} == {
        1: "no shipping row", 2: "uuid is null",
        3: "currency without rate; currency without code", 4: "obsoleted is null",
    }
    with pytest.raises(PySparkException, match="contract of purchase order"):
        po_report(pos, ships, contract="fail")


def test_retail_totals(table):
    totals = purchase_orders.retail_totals(
        table("purchase_orders", po(1), po(2), po(3)),
        table(
            "milestones",
            dict(id=1, itemizable_id=1, itemizable_type=PO, total_price=100, tax_rate=10),
            dict(id=2, itemizable_id=1, itemizable_type=PO, total_price="0.10", tax_rate="12.5"),
            dict(id=3, itemizable_id=1, itemizable_type="Pg::Other", total_price=9, tax_rate=9),
        ),
        table("shippings", shipping(1, 1, 20), shipping(2, 2, 5)),
        table("currencies", currency(1, 1, 2), currency(2, 2, None)),
    )
    got = {r.id: [float(v) for v in r[1:]] for r in totals.collect()}
    assert got[1] == [100.10, 10.0125, 130.1125, 65.05625]
    assert got[2] == [0.0, 0.0, 5.0, 5.0]
    assert got[3] == [0.0, 0.0, 0.0, 0.0]


def proposal(id, **more):
    row = dict(
        id=id, active=True, order_id=1, justifications=["j"], uuid="u", total_price=10,
        subtotal_price=9, created_at=datetime(2018, 6, 1),
    )
    return row | more


@pytest.fixture
def proposal_report(table):
    def report(rows, currencies=(), times=(), taxes=(), providers=(), contract="fail"):
        frame = proposals.proposal_report(
            table("proposals", *rows),
            table("currencies", *currencies),
            table("turn_around_times", *times),
            table("taxes", *taxes),
            table("providers", *providers),
            contract=contract,
        )
        return {r.id: r for r in frame.collect()}

    return report


def test_proposal_tax_date(proposal_report):
    rows = [
        proposal(1), proposal(2, created_at=datetime(2018, 6, 1, 0, 0, 1)),
        proposal(3, created_at=None), proposal(4, created_at=datetime(2020, 1, 1)),
        proposal(5, active=False), proposal(6, order_id=None),
    ]
    got = proposal_report(rows, taxes=[tax(i, i, 2, kind=PROPOSAL) for i in (1, 2, 3)])
    assert {i: r.total_price_no_tax for i, r in got.items()} == {1: 10, 2: 8, 3: 10, 4: 10}
    assert got[4].tax is None and got[1].tax == 2.0 and got[1].active == "true"
    assert len(got[1]) == 33


def test_proposal_defaults(proposal_report):
    times = [
        dict(id=1, turnaroundable_id=2, turnaroundable_type=PROPOSAL, min=None, max=9),
        dict(id=2, turnaroundable_id=1, turnaroundable_type="Pg::Other", min=1, max=1),
    ]
    got = proposal_report(
        [proposal(1), proposal(2)], [currency(1, 2, 4, "GBP", PROPOSAL)], times
    )
    one, two = got[1], got[2]
    assert (one.currency_name, one.conversion_rate) == ("USD", 1.0)
    assert (one.min_turnaround_time, one.max_turnaround_time, one.display_units) == (0, 0, "None")
    assert (two.currency_name, two.conversion_rate, two.total_price_usd) == ("GBP", 4.0, 2.5)
    assert (two.min_turnaround_time, two.max_turnaround_time, two.display_units) == (None, 9, None)


def test_proposal_contract(proposal_report):
    rows = [proposal(1, justifications=None), proposal(2), proposal(3, uuid=None)]
    broken = [currency(1, 2, None, None, PROPOSAL)]
    got = proposal_report(rows, broken, contract="rejects")
    assert {i: r.reasons for i, r in got.items()} == {
        1: "justifications is null", 2: "currency without rate; currency without code",
        3: "uuid is null",
    }


def order(id, **more):
    return dict(id=id, request_id=1, booster=1.0, state="open", uuid="u") | more


def test_order_report(table):
    inputs = [
        table(
            "orders",
            order(1, provider_id=4, obligations='{"b": 1, "a": [1, 2]}', organization_id=99),
            order(2, request_id=2),
            order(7, request_id=3),
        ),
        table("providers", dict(id=4, name="Lab")),
        table(
            "requests", dict(id=1, organization_id=5, user_id=6), dict(id=2, user_id=None),
        ),
        table("users", dict(id=6, email="x@example.org"), dict(id=0, email="zero@example.org")),
        table(
            "timepoints",
            dict(id=10, name="approval date", date=DAY, order_id=1),
            dict(id=11, name="approval date", date=datetime(2024, 6, 1), order_id=1),
            dict(id=12, name="review date", date=None, order_id=1),
            dict(id=2, name="completion date", date=DAY, order_id=1),
            dict(id=7, name="review date", date=DAY, order_id=555),
        ),
    ]
    got = {r.id: r for r in orders.order_report(*inputs).collect()}
    one = got[1]
    assert tuple(one.asDict()) == orders.REPORT_COLUMNS
    assert (one.provider_name, one.organization_id, one.user_email) == ("Lab", 5, "x@example.org")
    assert one.obligations == '{"a":[1,2],"b":1}'
    assert (one.approval_date, one.review_date, one.completion_date) == (
        date(2024, 6, 1), None, date(2024, 5, 1),
    )
    assert (got[2].user_email, got[2].organization_id, got[7].user_email) == (None, None, None)

    by_id = {r.id: r for r in orders.order_report(*inputs, timepoint_key="id").collect()}
    assert by_id[1].approval_date is None and by_id[2].completion_date == date(2024, 5, 1)
    # Timepoint 7 belongs to an order that does not exist.
    assert by_id[7].review_date is None

    salted = orders.order_report(*inputs, policy=SkewPolicy(-1, 1))
    assert {r.id: r for r in salted.collect()} == got


def test_order_contract(table):
    empty = [table("providers"), table("requests"), table("users"), table("timepoints")]
    rows = table("orders", order(1, request_id=None), order(2, booster=None), order(3))
    rejects = orders.order_report(rows, *empty, contract="rejects").collect()
    assert {r.id: r.reasons for r in rejects} == {1: "request_id is null", 2: "booster is null"}


def invoice(id, **more):
    return dict(id=id, document_type="standard", uuid="u", total_price=120, subtotal_price=100) | more


def test_invoice_report(table):
    kind = "Pg::Invoice"
    frame = invoices.invoice_report(
        table("invoices", invoice(1, document_type="credit"), invoice(2, discount_amount=3)),
        table(
            "currencies", currency(1, 1, 2, None, kind), currency(3, 2, None, "GBP", kind),
            currency(4, 2, 8, "XXX", kind),
        ),
        table(
            "shippings", shipping(1, 1, 5, kind), shipping(3, 2, 4, kind), shipping(2, 2, 3, kind),
            shipping(0, 2, 99, PO),
        ),
    )
    got = {r.id: r for r in frame.collect()}
    credit, plain = got[1], got[2]
    assert tuple(credit.asDict()) == invoices.REPORT_COLUMNS
    assert (credit.subtotal_price, credit.total_price, credit.shipping_cost) == (-100, -120, -5)
    assert (credit.tax, credit.total_price_usd, credit.currency_name) == (-15, 60, "USD")
    assert (plain.shipping_cost, plain.tax, plain.conversion_rate) == (3, 20, 1.0)
    assert (plain.currency_name, plain.cancelled) == ("GBP", "false")


def test_invoice_contract(table):
    kind = "Pg::Invoice"
    inputs = [
        table("invoices", invoice(1), invoice(2), invoice(3, uuid=None)),
        table("currencies", currency(1, 1, 2, "A", kind), currency(3, 3, 2, "A", kind)),
        table("shippings", shipping(2, 2, 5, kind), shipping(3, 3, 5, kind)),
    ]
    rejects = invoices.invoice_report(*inputs, contract="rejects").collect()
    assert {r.id: r.reasons for r in rejects} == {
        1: "no shipping row", 2: "no currency row", 3: "uuid is null",
    }
    with pytest.raises(PySparkException, match="contract of invoice"):
        invoices.invoice_report(*inputs).collect()


def test_rating_report(table):
    frame = rating_report(
        table(
            "ratings", dict(id=1, value=5, provider_id=2, created_at=DAY), dict(id=2, spam=True),
            dict(id=3, provider_id=None),
        ),
        table("providers", dict(id=2, name="Lab")),
    )
    got = {r.id: r for r in frame.collect()}
    assert set(got) == {1, 3} and got[3].provider_name is None
    assert (got[1].provider_name, got[1].spam, got[1].created_on) == ("Lab", "false", date(2024, 5, 1))


def test_reports_keep_one_row_per_parent(table, spark):
    """Left joins never multiply parents, however many children a key has."""
    parents = [po(i, proposal_id=1, order_id=1, provider_id=1) for i in range(20)]
    ships = [shipping(100 * i + j, i, j) for i in range(20) for j in range(5)]
    frame = purchase_orders.purchase_order_report(
        table("purchase_orders", *parents),
        table("currencies", *[currency(j, 3, 2) for j in range(9)]),
        table("shippings", *ships, *[shipping(9000 + j, 1, 1, PROPOSAL) for j in range(9)]),
        table("taxes", *[tax(j, 3, 2) for j in range(9)]),
        table("providers", dict(id=1, name="Lab")),
        table("action_items", *[dict(id=j, order_id=1, action_performed="new_request") for j in range(9)]),
        policy=SkewPolicy(-1, 5),
    )
    assert sorted(r.id for r in frame.collect()) == list(range(20))
