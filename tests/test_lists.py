"""Keys, update columns and measures as the survey of the source system
lists them, typed here once: the DuckDB statements take theirs from the
specifications, so a wrong list would pass on both sides."""

from tallyhouse.operators import daily as D
from tallyhouse.operators import monthly as M
from tallyhouse.schemas import SPECS

UPDATES = {
    "customers": "customerName contactLastName contactFirstName phone addressLine1 addressLine2 city state postalCode country "
                 "salesRepEmployeeNumber creditLimit",
    "employees": "lastName firstName extension email officeCode reportsTo jobTitle",
    "offices": "city phone addressLine1 addressLine2 state country postalCode territory",
    "productlines": "textDescription",
    "products": "productName productLine productScale productVendor productDescription quantityInStock buyPrice MSRP",
    "orders": "orderDate requiredDate shippedDate status comments cancelledDate",  # not customerNumber
    "orderdetails": "quantityOrdered priceEach orderLineNumber",
    "payments": "paymentDate amount",
}
INSERT_KEYS = {"customers": "customerNumber", "employees": "employeeNumber", "offices": "officeCode", "productlines": "productLine",
               "products": "productCode", "orders": "orderNumber", "orderdetails": "orderNumber productCode", "payments": "checkNumber"}


def test_update_columns_and_keys():
    assert {t: set(s.update_cols) for t, s in SPECS.items()} == {t: set(c.split()) for t, c in UPDATES.items()}
    assert {t: s.insert_keys for t, s in SPECS.items()} == {t: tuple(k.split()) for t, k in INSERT_KEYS.items()}
    assert {t: s.update_keys for t, s in SPECS.items()} == {
        t: ("customerNumber", "checkNumber") if t == "payments" else tuple(k.split()) for t, k in INSERT_KEYS.items()}


def test_measures():
    assert set(D.CUSTOMER_OUTER_SUM) == set("cancelled_order_amount shipped_order_amount payment_amount order_mrp_amount".split())
    assert set(D.CUSTOMER_ADDITIVE) == set("order_count order_cost_amount cancelled_order_count shipped_order_count "
                                           "products_ordered_qty products_items_qty".split())
    assert set(M.CUSTOMER_ROLLUP.sums) == set(
        "order_count order_cost_amount cancelled_order_count cancelled_order_amount shipped_order_count shipped_order_amount "
        "payment_amount products_ordered_qty products_items_qty order_mrp_amount".split())
    assert set(M.CUSTOMER_ROLLUP.flags) == set("order_apd cancelled_order_apd shipped_order_apd payment_apd new_customer_apd "
                                               "new_customer_paid_apd".split())
    assert set(M.PRODUCT_ROLLUP.sums) == set("product_cost_amount product_mrp_amount cancelled_product_qty cancelled_cost_amount "
                                             "cancelled_mrp_amount".split())
    assert set(M.PRODUCT_ROLLUP.flags) == {"customer_apd", "cancelled_order_apd"}
