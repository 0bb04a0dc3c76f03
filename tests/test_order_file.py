"""Reports over a small order file, with totals worked out by hand."""

from retail import plain

from tillcube.plans.order_file import build_reports, read_orders

ORDERS = """order_id,order_date,customer_name,product_name,category,quantity,unit_price,country
7,2022-11-30,Åsa,Kettle,Kitchen,3,41.50,Norway
8,2022-12-31,Bartoš,Lamp,Lighting,1,220.25,Chile
9,2023-01-01,Åsa,Kettle,Kitchen,-1,41.50,Norway
10,2023-02-14,"Núñez, Eva",Sofa,Living,2,1310.00,Chile
11,2023-02-14,Wei,Lamp,Lighting,6,199.99,
12,2023-07-02,Wei,Shelf,Living,5,200.00,Kenya
13,2023-07-03,Bartoš,Shelf,Living,4,205.00,Kenya
"""
BY_PRODUCT = [("Sofa", 2620.0), ("Shelf", 1820.0), ("Lamp", 1420.19), ("Kettle", 83.0)]


def test_reports(spark, folder):
    path = f"{folder}/orders.csv"
    with open(path, "w", encoding="utf-8") as file:
        file.write(ORDERS)
    orders = read_orders(spark, path)
    assert orders.where("order_id = 10").first().customer_name == "Núñez, Eva"
    reports = build_reports(orders)
    assert [tuple(map(float, row)) for row in reports["total_sales"].collect()] == [(5943.19,)]
    # The order without a country belongs to none; the return lowers its country's total.
    assert [(r.country, float(r.total_value)) for r in reports["sales_by_country"].collect()] == [
        ("Chile", 2840.25),
        ("Kenya", 1820.0),
        ("Norway", 83.0),
    ]
    assert [(r.product_name, float(r.total_value)) for r in reports["sales_by_product"].collect()] == BY_PRODUCT
    assert plain(reports["sales_by_country_year"]) == [
        ("Chile", 2022, 220.25),
        ("Chile", 2023, 2620.0),
        ("Kenya", 2023, 1820.0),
        ("Norway", 2022, 124.5),
        ("Norway", 2023, -41.5),
    ]
    assert plain(reports["sales_by_year"]) == [(2022, 344.75), (2023, 5598.44)]
    high = reports["high_value_sales"]
    # An order of exactly 1000 is not above it.
    assert sorted(row.order_id for row in high.collect()) == [10, 11]
    assert high.columns[-4:] == ["total_value", "year", "month", "day"]
    counts = reports["high_value_count_by_country"]
    assert [tuple(row) for row in counts.collect()] == [("Chile", 1)]
