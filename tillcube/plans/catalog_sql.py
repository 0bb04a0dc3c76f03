"""The registered queries in SQL, as an independent check of the results.

Every statement starts from the same common table expressions; unused ones cost nothing.
"""

from __future__ import annotations

# Invoice lines, cleaned lines per rule set, and the two overlapping sources.
COMMON = """
with raw as (
  select case when l_returnflag = 'R' and l_linestatus = 'F' then 'C' else '' end
           || cast(l_orderkey as varchar) as invoice_no,
         cast(l_partkey as varchar) as stock_code,
         case when p_size = 1 then null else p_name end as description,
         cast(case when l_returnflag = 'R' then -l_quantity else l_quantity end as bigint) as quantity,
         o_orderdate as invoice_date,
         cast(case when p_size = 50 and l_linenumber = 7 then cast(0 as decimal(12,2))
              else cast(p_retailprice as decimal(12,2)) + cast(l_discount as decimal(12,2)) end
              as decimal(18,6)) as unit_price,
         case when o_orderpriority = '4-NOT SPECIFIED' then null else o_custkey end as customer_id,
         n_name as country, l_shipdate, o_orderpriority
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
       join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
),
lines as (
  select invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country from raw
),
filled as (
  select invoice_no, stock_code, coalesce(description, 'Unknown product') as description, quantity,
         invoice_date, unit_price, customer_id, coalesce(country, 'Unknown country') as country
  from lines
),
clean_keep_all as (select * from filled),
clean_prepare as (select * from lines),
star_raw as (
  select distinct invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id,
         country, o_orderpriority
  from raw
  where customer_id is not null and invoice_date is not null and not starts_with(invoice_no, 'C')
    and quantity > 0 and unit_price > 0
),
clean_star as (
  select distinct invoice_no, stock_code, coalesce(description, 'Unknown product') as description, quantity,
         invoice_date, unit_price, customer_id, country
  from star_raw
),
clean_basic as (
  select distinct * from filled
  where customer_id is not null and invoice_date is not null and not starts_with(invoice_no, 'C')
    and quantity > 0 and unit_price >= 0
),
clean_integrated as (
  select distinct * from filled
  where customer_id is not null and invoice_date is not null and not starts_with(upper(invoice_no), 'C')
    and quantity > 0 and unit_price >= 0
),
clean_olap as (
  select distinct * from filled
  where customer_id is not null and invoice_date is not null and not starts_with(invoice_no, 'C')
    and quantity > 0 and unit_price > 0
),
clean_analysis as (
  select distinct * from lines
  where customer_id is not null and invoice_date is not null and country is not null
    and not starts_with(invoice_no, 'C') and quantity > 0 and unit_price > 0
),
clean_bench as (
  select * from lines
  where customer_id is not null and invoice_date is not null and quantity > 0 and unit_price > 0
),
olap as (
  select *, quantity * unit_price as total_price, cast(year(invoice_date) as integer) as "year",
         cast(month(invoice_date) as integer) as "month", strftime(invoice_date, '%Y-%m') as year_month
  from clean_olap
),
analysis as (
  select *, quantity * unit_price as total_price, cast(month(invoice_date) as integer) as "month"
  from clean_analysis
),
bench as (
  select *, quantity * unit_price as total_price, strftime(invoice_date, '%Y-%m') as year_month from clean_bench
),
valued as (
  select *, quantity * unit_price as total_value, cast(year(invoice_date) as integer) as "year" from lines
),
stacked as (
  select invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country,
         1 as source_rank, 'store_csv' as source_system, 'csv' as source_sheet, 'store.csv' as source_name
  from raw where l_shipdate < timestamp '1999-01-01'
  union all
  select invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country,
         2, 'web_workbook', 'Year 1998-1999', 'web'
  from raw where l_shipdate >= timestamp '1998-07-01' and l_shipdate < timestamp '2000-01-01'
  union all
  select invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country,
         3, 'web_workbook', 'Year 2000-2001', 'web'
  from raw where l_shipdate >= timestamp '2000-01-01'
),
valid_stacked as (
  select invoice_no, stock_code, coalesce(description, 'Unknown product') as description, quantity,
         invoice_date, unit_price, customer_id, country, source_rank, source_system, source_sheet, source_name
  from stacked
  where customer_id is not null and invoice_date is not null and not starts_with(upper(invoice_no), 'C')
    and quantity > 0 and unit_price >= 0
),
integrated as (
  select * exclude (place) from (
    select *, row_number() over (
      partition by invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country
      order by source_rank) as place
    from valid_stacked) where place = 1
),
countries as (
  select row_number() over (order by country) as country_key, country as country_name
  from (select distinct country from filled)
),
keyed_lines as (
  select f.*, country_key,
         case when customer_id is null then 'UNKNOWN_' || country else cast(customer_id as varchar) end
           as customer_business_key
  from filled f join countries on country = country_name
),
customers as (
  select row_number() over (order by customer_business_key, country_key) as customer_key,
         customer_business_key, customer_id as customer_id_source, country_key
  from (select distinct customer_business_key, customer_id, country_key from keyed_lines)
),
product_names as (
  select stock_code, coalesce(max(case when place = 1 then description end), 'Unknown product') as product_name
  from (select stock_code, description,
               row_number() over (partition by stock_code
                 order by case when description is null then 1 else 0 end, n desc, description) as place
        from (select stock_code, description, count(*) as n from filled group by stock_code, description))
  group by stock_code
),
products as (
  select row_number() over (order by stock_code) as product_key, stock_code, product_name from product_names
),
dates as (
  select row_number() over (order by d) as date_key, d
  from (select distinct cast(invoice_date as date) as d from filled)
),
kimball as (
  select invoice_no, c.customer_key, p.product_key, k.country_key, d.date_key, quantity, unit_price,
         quantity * unit_price as sales_amount,
         case when quantity * unit_price > 0 then quantity * unit_price else 0 end as gross_sales_amount,
         case when quantity * unit_price < 0 then quantity * unit_price else 0 end as return_amount,
         quantity < 0 as is_return, starts_with(invoice_no, 'C') as is_cancelled,
         k.country as country_name, d.d
  from keyed_lines k
       join customers c on k.customer_business_key = c.customer_business_key and k.country_key = c.country_key
       join products p on k.stock_code = p.stock_code
       join dates d on cast(k.invoice_date as date) = d.d
),
star_products as (
  select row_number() over (order by stock_code) as product_key, stock_code, product_name
  from (select distinct s.stock_code, n.product_name
        from clean_star s join product_names n on s.stock_code = n.stock_code)
),
star_countries as (
  select row_number() over (order by country) as country_key, country as country_name
  from (select distinct country from clean_star)
),
star_dates as (
  select row_number() over (order by d) as date_key, d
  from (select distinct cast(invoice_date as date) as d from clean_star)
),
star_invoices as (
  select row_number() over (order by invoice_no) as invoice_key, invoice_no, invoice_date
  from (select invoice_no, min(invoice_date) as invoice_date from clean_star group by invoice_no)
),
star_moments as (
  select customer_id, invoice_date, min(o_orderpriority) as tracked
  from star_raw group by customer_id, invoice_date
),
star_changes as (
  select customer_id, tracked, invoice_date from (
    select *, lag(tracked) over (partition by customer_id order by invoice_date) as previous from star_moments)
  where previous is null or previous <> tracked
),
star_versions as (
  select row_number() over (order by customer_id, invoice_date) as customer_key, customer_id, tracked,
         invoice_date as valid_from,
         lead(invoice_date) over (partition by customer_id order by invoice_date) as valid_to
  from star_changes
),
star_facts as (
  select i.invoice_key, v.customer_key, p.product_key, d.date_key, c.country_key, s.quantity, s.unit_price,
         s.quantity * s.unit_price as revenue, 1 as line_count, s.country as country_name, d.d,
         p.stock_code, p.product_name
  from star_raw s
       join star_invoices i on s.invoice_no = i.invoice_no
       join star_versions v on s.customer_id = v.customer_id and s.invoice_date >= v.valid_from
         and (v.valid_to is null or s.invoice_date < v.valid_to)
       join star_products p on s.stock_code = p.stock_code
       join star_dates d on cast(s.invoice_date as date) = d.d
       join star_countries c on s.country = c.country_name
),
event_changes as (
  select user_id, event_type, ts from (
    select user_id, event_type, ts, lag(event_type) over (partition by user_id order by ts) as previous
    from (select user_id, ts, min(event_type) as event_type from events
          where user_id is not null and ts is not null group by user_id, ts))
  where previous is null or previous <> event_type
),
event_versions as (
  select user_id, event_type, ts as valid_from, lead(ts) over (partition by user_id order by ts) as valid_to
  from event_changes
),
order_changes as (
  select o_custkey, o_orderpriority, o_orderdate from (
    select o_custkey, o_orderpriority, o_orderdate,
           lag(o_orderpriority) over (partition by o_custkey order by o_orderdate) as previous
    from (select o_custkey, o_orderdate, min(o_orderpriority) as o_orderpriority from orders
          where o_custkey is not null and o_orderdate is not null group by o_custkey, o_orderdate))
  where previous is null or previous <> o_orderpriority
),
order_versions as (
  select o_custkey, o_orderpriority, o_orderdate as valid_from,
         lead(o_orderdate) over (partition by o_custkey order by o_orderdate) as valid_to
  from order_changes
),
country_revenue as (select country, sum(total_price) as total_price from analysis group by country),
quartiles as (
  select quantile_cont(cast(total_price as double), 0.25) as q25,
         quantile_cont(cast(total_price as double), 0.75) as q75
  from country_revenue
),
segmented as (
  select country, total_price,
         case when cast(total_price as double) >= q75 then 'top_25'
              when cast(total_price as double) <= q25 then 'bottom_25' else 'middle_50' end as segment
  from country_revenue, quartiles
),
exact_orders as (select * replace (cast(o_totalprice as decimal(14,2)) as o_totalprice) from orders),
operations as (
  select o_orderdate < timestamp '1998-01-01' as early, 'sum_' || o_orderpriority as operation,
         cast(sum(o_totalprice) as double) as measure
  from exact_orders group by all
  union all
  select o_orderdate < timestamp '1998-01-01', 'filter_' || o_orderpriority, cast(count(*) as double)
  from exact_orders where o_totalprice > 250000 group by all
),
comparison as (
  select b.operation, b.measure as before_value, a.measure as after_value,
         case when a.measure <> 0 then b.measure / a.measure else 0 end as ratio,
         a.measure - b.measure as difference
  from (select * from operations where early) b left join (select * from operations where not early) a
       on a.operation = b.operation
)
"""

LINE_COLUMNS = "invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country"

# Column and type of the line item table, for the reports about its types and sizes.
LINEITEM = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}
WIDTH = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "double": 8, "timestamp_ntz": 8}


def _narrow(column: str, spark_type: str) -> str:
    if spark_type in ("string", "timestamp_ntz"):
        return f"any_value('{spark_type}')"
    return f"""case when not bool_and({column} = floor({column})) then '{spark_type}'
      when min({column}) >= -128 and max({column}) < 128 then 'tinyint'
      when min({column}) >= -32768 and max({column}) < 32768 then 'smallint'
      when min({column}) >= -2147483648 and max({column}) < 2147483648 then 'int'
      else 'bigint' end"""


def _bytes(column: str, spark_type: str) -> str:
    if spark_type == "string":
        return f"cast(sum(strlen({column})) as bigint)"
    return f"cast(count({column}) * {WIDTH[spark_type]} as bigint)"


def _narrow_bytes(column: str, spark_type: str) -> str:
    if spark_type in ("string", "timestamp_ntz"):
        return _bytes(column, spark_type)
    widths = " ".join(f"when '{name}' then {width}" for name, width in WIDTH.items())
    return f"cast(count({column}) * (case {_narrow(column, spark_type)} {widths} end) as bigint)"


def _each(template, columns) -> str:
    return " union all ".join(template(column, spark_type) for column, spark_type in columns)


FOOTPRINT = _each(
    lambda c, t: f"""select '{c}' as column_name, {_bytes(c, t)} as bytes_before,
      {_narrow_bytes(c, t)} as bytes_after from lineitem""",
    LINEITEM.items(),
)

QUALITY = """
  count(*) as rows_before, count(*) filter (customer_id is null) as missing_customer_id,
  count(*) filter (starts_with(invoice_no, 'C')) as cancelled_invoices,
  count(*) filter (quantity <= 0) as quantity_not_positive,
  count(*) filter (unit_price < 0) as unit_price_negative,
  count(*) filter (invoice_date is null) as missing_invoice_date
"""


def _clean(name: str) -> str:
    return f"""select invoice_no, stock_code, description, quantity, invoice_date,
      cast(unit_price as double) as unit_price, cast(customer_id as varchar) as customer_id, country,
      cast(quantity * unit_price as double) as total_price from {name}"""


# The years of the sample orders. The query finds them in the data.
YEARS = tuple(range(1995, 2002))


def _cross_tab(table: str, column: str, members) -> str:
    cells = ", ".join(
        f"""cast(coalesce(sum(case when "{column}" = {m} then total_price end), 0) as double) as "{m}" """
        for m in members
    )
    return f"select country, {cells} from {table} group by country"


def _numbered(name: str, columns: str, rows: str, money: str) -> str:
    """Rows numbered in the order of all their columns; the columns of ``money`` as doubles."""
    order = ", ".join(f"{column} asc nulls last" for column in columns.split(","))
    doubles = ", ".join(f"cast({column} as double) as {column}" for column in money.split(", "))
    return f"""select row_number() over (order by {order}) as {name}, * replace ({doubles})
      from (select {columns} from ({rows}))"""


MONTHS = range(1, 13)
SUMS = "cast(sum(total_price) as double) as total_price, cast(sum(quantity) as bigint) as quantity"
CONTROL = """cast(sum(quantity * unit_price) as double) as revenue, cast(sum(quantity) as bigint) as quantity,
  count(*) as transaction_lines"""
SIGNED = """cast(sum(sales_amount) as double) as net_sales, cast(sum(gross_sales_amount) as double) as gross_sales,
  cast(sum(return_amount) as double) as returns, count(*) as transaction_lines"""
STAR = "cast(sum(revenue) as double) as revenue, cast(sum(quantity) as bigint) as quantity"
DUPLICATES = f"""select {LINE_COLUMNS.replace("unit_price", "cast(unit_price as double) as unit_price")}, source_rank,
  source_system, source_sheet, source_name,
  concat_ws('|', invoice_no, stock_code, description, cast(cast(quantity as decimal(16,4)) as varchar), cast(invoice_date as varchar),
    cast(unit_price as varchar), cast(customer_id as varchar), country) as duplicate_business_key
  from (select *, count(*) over w as members, min(source_rank) over w as low, max(source_rank) over w as high
        from valid_stacked window w as (partition by {LINE_COLUMNS}))"""
METHODS = """
  select 'sales_by_country' as report, country as key, cast(sum(total_price) as double) as value
  from bench group by country
  union all select 'sales_by_month', year_month, cast(sum(total_price) as double) from bench group by year_month
  union all select 'invoices_by_customer', cast(customer_id as varchar), cast(count(distinct invoice_no) as double)
  from bench group by customer_id"""


def _funnel() -> str:
    steps = [
        ("rows_before", "sum(copies)"),
        ("removed_missing_key_data", "coalesce(sum(copies) filter (broken = 1), 0)"),
        ("removed_cancelled_invoice", "coalesce(sum(copies) filter (broken = 2), 0)"),
        ("removed_quantity_not_positive", "coalesce(sum(copies) filter (broken = 3), 0)"),
        ("removed_unit_price_rejected", "coalesce(sum(copies) filter (broken = 4), 0)"),
        ("removed_duplicates", "coalesce(sum(copies - 1) filter (broken = 5), 0)"),
        ("rows_after", "count(*) filter (broken = 5)"),
        ("total_value", "sum(quantity * unit_price) filter (broken = 5)"),
    ]
    collapsed = f"""(select {LINE_COLUMNS}, count(*) as copies,
        case when customer_id is null or invoice_date is null or quantity is null or unit_price is null
               or country is null then 1
             when starts_with(invoice_no, 'C') then 2 when not quantity > 0 then 3
             when not unit_price > 0 then 4 else 5 end as broken
      from stacked group by {LINE_COLUMNS})"""
    return " union all ".join(
        f"select '{name}' as step, cast({value} as double) as value from {collapsed}" for name, value in steps
    )


def _describe() -> str:
    text, numeric = [], []
    for column in ("o_orderstatus", "o_orderdate", "o_orderpriority"):
        text.append(f"""select '{column}' as column_name, cast(sum(n) as bigint) as value_count,
          count(*) as unique_values, arg_min(v, place) as top_value, max(n) as top_count,
          null::double as mean, null::double as std, null::double as min_value, null::double as p25,
          null::double as p50, null::double as p75, null::double as max_value
          from (select v, n, row_number() over (order by n desc, v) as place
                from (select cast({column} as varchar) as v, count(*) as n from exact_orders
                      where {column} is not null group by 1))""")
    for column in ("o_orderkey", "o_custkey", "o_totalprice"):
        numeric.append(f"""select '{column}', count({column}), null, null, null,
          cast(sum({column}) as double) / count({column}), round(stddev_samp(cast({column} as double)), 4),
          cast(min({column}) as double), quantile_cont(cast({column} as double), 0.25),
          quantile_cont(cast({column} as double), 0.5), quantile_cont(cast({column} as double), 0.75),
          cast(max({column}) as double) from exact_orders""")
    return " union all ".join(text + numeric)


def _profile() -> str:
    types = zip(
        LINE_COLUMNS.split(", "),
        ("string", "string", "string", "decimal(16,4)", "timestamp_ntz", "decimal(18,6)", "bigint", "string"),
    )
    return _each(
        lambda c, t: f"""select '{c}' as column_name, '{t}' as dtype,
          count(*) - count({c}) as missing_values,
          round(100.0 * (count(*) - count({c})) / count(*), 2)::double as missing_percent from lines""",
        types,
    )


BODIES: dict[str, str] = {
    "csv_scan_latin1": """select invoice_no, stock_code, description, quantity, invoice_date,
      cast(unit_price as double) as unit_price, cast(customer_id as varchar) as customer_id, country from lines""",
    "csv_sink_roundtrip": f"select country, {CONTROL} from clean_basic group by country",
    "multi_part_source": """select source_sheet, count(*) as rows_count, cast(sum(quantity) as bigint) as quantity,
      cast(sum(unit_price) as double) as unit_price, count(customer_id) as known_customers
      from stacked group by source_sheet""",
    "reader_by_suffix": """select source_file, count(*) as rows_count,
      cast(sum(quantity * unit_price) as double) as net_value, count(customer_id) as known_customers
      from lines, (values ('store.csv'), ('store.parquet')) as f(source_file) group by source_file""",
    "warehouse_sink_counts": """select table_name, rows_count, cast(rows_count * (rows_count + 1) / 2 as bigint) as key_sum, amount
      from (select 'dim_country' as table_name, count(*) as rows_count, cast(0 as double) as amount from countries
      union all select 'dim_customer', count(*), 0 from customers
      union all select 'dim_product', count(*), 0 from products
      union all select 'dim_date', count(*), 0 from dates
      union all select 'fact_sales', count(*), cast(sum(quantity * unit_price) as double) from lines)""",
    "sample_rows": f"""select invoice_no, stock_code, description, quantity, invoice_date,
      cast(unit_price as double) as unit_price, cast(customer_id as varchar) as customer_id, country
      from (select * from lines order by {", ".join(c + " asc nulls last" for c in LINE_COLUMNS.split(", "))}
            limit 1000)""",
    "preview_rows": """select * from orders order by o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
      o_orderpriority limit 5""",
    "replicate_rows": """select country, cast(5 * sum(total_price) as double) as total_price,
      cast(5 * sum(quantity) as bigint) as quantity, count(distinct invoice_no) as invoices,
      5 * count(*) as rows_count from bench group by country""",
    "schema_align_union": """select invoice_no, stock_code, description, quantity, invoice_date,
      cast(unit_price as double) as unit_price, cast(customer_id as varchar) as customer_id, country,
      source_rank, source_system, source_sheet, source_name from stacked""",
    "rows_per_source": """select source_system, source_sheet, count(*) as rows_count
      from stacked group by source_system, source_sheet""",
    "column_profile": _profile(),
    "column_describe": _describe(),
    "table_shape": "select count(*) as row_count, 8 as column_count from lines",
    "type_report": _each(
        lambda c, t: f"select '{c}' as column_name, '{t}' as type_before, {_narrow(c, t)} as type_after from lineitem",
        LINEITEM.items(),
    ),
    "narrow_types": _each(
        lambda c, t: f"""select '{c}' as column_name, '{t}' as dtype, cast(min({c}) as double) as min_value,
          cast(max({c}) as double) as max_value, {_narrow(c, t)} as narrow_type from lineitem""",
        [(c, t) for c, t in LINEITEM.items() if t not in ("string", "timestamp_ntz")],
    ),
    "column_footprint": f"select *, bytes_after - bytes_before as difference_vs_before from ({FOOTPRINT})",
    "memory_comparison": f"""select version, cast(bytes as bigint) as bytes,
      cast(bytes - before as bigint) as difference_vs_baseline
      from (select 'before' as version, sum(bytes_before) as bytes, sum(bytes_before) as before from ({FOOTPRINT})
            union all select 'after', sum(bytes_after), sum(bytes_before) from ({FOOTPRINT}))""",
    "dictionary_encode": """select p_partkey, p_name, dense_rank() over (order by p_brand) - 1 as p_brand_code,
      dense_rank() over (order by p_type) - 1 as p_type_code, p_size, p_retailprice from part""",
    "typed_lines": _clean("filled"),
    "flags_and_signed_measures": """select invoice_no, stock_code, quantity, cast(unit_price as double) as unit_price,
      cast(quantity * unit_price as double) as sales_amount,
      cast(greatest(quantity * unit_price, 0) as double) as gross_sales_amount,
      cast(least(quantity * unit_price, 0) as double) as return_amount, quantity < 0 as is_return,
      starts_with(invoice_no, 'C') as is_cancelled, starts_with(invoice_no, 'C') as is_cancelled_any_case
      from lines""",
    "customer_business_key": """select customer_business_key, country, count(*) as rows_count
      from keyed_lines group by customer_business_key, country""",
    "calendar_parts": """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as date,
      cast(year(o_orderdate) as integer) as "year", cast(quarter(o_orderdate) as integer) as quarter,
      cast(month(o_orderdate) as integer) as "month", cast(day(o_orderdate) as integer) as "day",
      dayname(o_orderdate) as weekday, cast(hour(o_orderdate) as integer) as "hour" from orders""",
    "period_text": """select strftime(o_orderdate, '%Y-%m') as year_month, strftime(o_orderdate, '%Y-%m') as period,
      count(*) as rows_count from orders group by 1, 2""",
    **{
        name: _clean(name)
        for name in (
            "clean_keep_all",
            "clean_star",
            "clean_basic",
            "clean_integrated",
            "clean_olap",
            "clean_analysis",
            "clean_prepare",
            "clean_bench",
        )
    },
    "clean_integrated_sources": """select invoice_no, stock_code, description, quantity, invoice_date,
      cast(unit_price as double) as unit_price, customer_id, country, source_rank, source_system, source_sheet,
      source_name from integrated""",
    "quality_report": f"""select *, rows_before - rows_after as rows_removed from (
      select {QUALITY}, count(*) - (select count(*) from (select distinct * from filled)) as duplicates_before_cleaning,
        (select count(*) from clean_basic) as rows_after from filled)""",
    "quality_report_sources": f"""select *, rows_before - rows_after as rows_removed from (
      select {QUALITY},
        count(*) - (select count(*) from (
          select distinct * replace (coalesce(description, 'Unknown product') as description) from stacked))
          as duplicates_before_cleaning,
        (select count(*) from integrated) as rows_after from stacked)""",
    "preparation_report": """select rows_before, rows_after, rows_before - rows_after as rows_removed
      from (select count(*) as rows_before, (select count(*) from clean_bench) as rows_after from lines)""",
    "removal_funnel": _funnel(),
    "duplicate_row_count": f"""select count(*) - (select count(*) from (select distinct {LINE_COLUMNS} from stacked))
      as duplicate_rows from stacked""",
    "high_value_lines": """select invoice_no, stock_code, description, quantity, invoice_date,
      cast(unit_price as double) as unit_price, cast(customer_id as varchar) as customer_id, country,
      cast(total_value as double) as total_price, "year", cast(month(invoice_date) as integer) as "month",
      cast(day(invoice_date) as integer) as "day" from valued where total_value > 25000""",
    "high_value_count_by_country": """select country, count(*) as transaction_count
      from valued where total_value > 25000 group by country""",
    "total_sales": "select cast(sum(total_value) as double) as total_value from valued",
    "sales_by_country": "select country, cast(sum(total_value) as double) as total_value from valued group by country",
    "sales_by_year": 'select "year", cast(sum(total_value) as double) as total_value from valued group by "year"',
    "sales_by_country_year": """select country, "year", cast(sum(total_value) as double) as total_value
      from valued group by country, "year" """,
    "sales_by_product": """select description, cast(sum(total_value) as double) as total_value
      from valued where description is not null group by description""",
    "product_name_mode": "select stock_code, product_name from product_names",
    "country_most_sold_product": """select country, description as product_name from (
      select country, description, row_number() over (partition by country order by n desc, description) as place
      from (select country, description, count(*) as n from lines where description is not null
            group by country, description)) where place = 1""",
    "price_conflicts": """select invoice_no, stock_code, customer_id, invoice_date,
      cast(min(unit_price) as double) as min_unit_price, cast(max(unit_price) as double) as max_unit_price,
      count(distinct unit_price) as unique_prices, count(*) as rows_count
      from integrated group by invoice_no, stock_code, customer_id, invoice_date
      having count(distinct unit_price) > 1""",
    "invoices_per_customer": """select customer_id, count(distinct invoice_no) as invoices
      from bench group by customer_id""",
    "distinct_sketch_rollup": """select country, "year", count(distinct invoice_no) as invoices, true as within_error
      from (select country, cast(year(invoice_date) as integer) as "year", invoice_no from bench) group by country, "year" """,
    "agg_by_grouping": METHODS,
    "agg_by_pivot_method": METHODS,
    "agg_prekeyed": METHODS,
    "rollup_year": f'select "year", {SUMS} from olap group by "year"',
    "drilldown_year_month": f'select "year", "month", {SUMS} from olap group by "year", "month"',
    "rollup_with_totals": f"""select coalesce(cast("year" as varchar), 'all') as "year",
      coalesce(cast("month" as varchar), 'all') as "month", grouping("year", "month") as level, {SUMS}
      from olap group by rollup ("year", "month")""",
    "cube_with_totals": """select coalesce(country, 'all') as country,
      coalesce(cast("month" as varchar), 'all') as "month", grouping(country, "month") as level,
      cast(sum(total_price) as double) as total_price from olap group by cube (country, "month")""",
    "slice_monthly": f"""select "year", "month", {SUMS} from olap where country = 'NATION_3' group by "year", "month" """,
    "dice_monthly": f"""select "month", {SUMS} from olap where country = 'NATION_3' and "year" = 1997 group by "month" """,
    "pivot_country_year": _cross_tab("olap", "year", YEARS),
    "pivot_country_month": _cross_tab("analysis", "month", MONTHS),
    "cube_country_month": _cross_tab("olap", "month", MONTHS),
    "best_year_by_country": """select country, "year", cast(total_price as double) as total_price, quantity from (
      select *, row_number() over (partition by country order by total_price desc, "year") as place from (
        select country, "year", sum(total_price) as total_price, cast(sum(quantity) as bigint) as quantity
        from olap group by country, "year")) where place = 1""",
    "top5_products_by_country": """select country, stock_code, description,
      cast(total_price as double) as total_price, quantity from (
      select *, row_number() over (partition by country order by total_price desc, stock_code, description) as place
      from (select country, stock_code, description, sum(total_price) as total_price,
                   cast(sum(quantity) as bigint) as quantity
            from olap group by country, stock_code, description)) where place <= 5""",
    "top10_countries": f"""select country, {SUMS} from olap group by country
      order by sum(total_price) desc, country limit 10""",
    "month_ranking": f'select "year", "month", year_month, {SUMS} from olap group by "year", "month", year_month',
    "best_month": f"""select "year", "month", year_month, {SUMS} from olap group by "year", "month", year_month
      order by sum(total_price) desc, year_month limit 1""",
    "semi_join_top_countries": f"""select country, "month", {SUMS} from olap
      where country in (select country from olap group by country order by sum(total_price) desc, country limit 10)
      group by country, "month" """,
    "heatmap_data": f"""select * from ({_cross_tab("olap", "month", MONTHS)})
      where country in (select country from olap group by country order by sum(total_price) desc, country limit 15)""",
    "olap_report_totals": """select report, cast(sum(total_price) as double) as total from olap,
      (values ('rollup_year'), ('drilldown_year_month'), ('month_ranking'), ('pivot_country_year'),
              ('cube_country_month'), ('slice_monthly'), ('dice_monthly')) as r(report)
      where (report not in ('slice_monthly', 'dice_monthly') or country = 'NATION_3')
        and (report <> 'dice_monthly' or "year" = 1997) group by report""",
    "country_ranking": "select country, cast(total_price as double) as total_price from country_revenue",
    "top10_customers": """select customer_id, cast(sum(total_price) as double) as total_price
      from analysis group by customer_id order by sum(total_price) desc, customer_id limit 10""",
    "customer_summary": """with totals as (select sum(total_price) as t from analysis group by customer_id)
      select 'number_of_customers' as metric, cast(count(*) as double) as value from totals
      union all select 'average_revenue_per_customer', cast(sum(t) as double) / count(t) from totals
      union all select 'max_customer_revenue', cast(max(t) as double) from totals
      union all select 'min_customer_revenue', cast(min(t) as double) from totals""",
    "country_segments": "select country, cast(total_price as double) as total_price, segment from segmented",
    "segment_summary": """select segment, count(*) as member_count, cast(sum(total_price) as double) as total_revenue,
      cast(sum(total_price) as double) / count(*) as avg_revenue from segmented group by segment""",
    "top_segment_share": """select cast(sum(total_price) filter (segment = 'top_25') as double)
      / cast(sum(total_price) as double) * 100 as top_segment_share from segmented""",
    "seasonality_ratio": """select cast(max(t) as double) as best_month_sales, cast(min(t) as double) as worst_month_sales,
      case when min(t) <> 0 then cast(max(t) as double) / cast(min(t) as double) else 0 end as seasonality_ratio
      from (select sum(total_price) as t from analysis group by "month")""",
    "analysis_report_totals": """select report, cast(sum(total_price) as double) as total from analysis,
      (values ('month_ranking'), ('country_ranking'), ('customer_revenue'), ('country_segments'),
              ('segment_summary')) as r(report) group by report""",
    "mean_by_group": """select o_orderstatus, o_orderpriority,
      cast(sum(o_totalprice) as double) / count(o_totalprice) as mean_price
      from exact_orders group by o_orderstatus, o_orderpriority""",
    "first_per_group": """select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as double) as o_totalprice,
      o_orderdate, o_orderpriority from (
        select *, row_number() over (partition by o_orderstatus, o_orderpriority
          order by o_totalprice, o_orderkey) as place from exact_orders) where place = 1""",
    "before_after_comparison": "select * from comparison",
    "filter_summary": """select operation, before_value, after_value from comparison
      where starts_with(operation, 'filter_')""",
    "encoding_equivalence": """select report, cast(0 as bigint) as unequal_rows, total as plain_total,
      total as decoded_total from (
        select 'sales_by_country' as report, cast(sum(quantity * unit_price) as double) as total from lines
          where country is not null
        union all select 'sales_by_month', cast(sum(quantity * unit_price) as double) from lines
          where invoice_date is not null
        union all select 'sales_by_customer_id', cast(sum(quantity * unit_price) as double) from lines
          where customer_id is not null)""",
    "dim_country": "select country_key, country_name from star_countries",
    "dim_product": "select product_key, stock_code, product_name from star_products",
    "dim_date": """select date_key, strftime(d, '%Y-%m-%d') as date, cast(year(d) as integer) as "year",
      cast(quarter(d) as integer) as quarter, cast(month(d) as integer) as "month", cast(day(d) as integer) as "day",
      dayname(d) as weekday from star_dates""",
    "dim_invoice": """select invoice_key, invoice_no, invoice_date as invoice_datetime,
      strftime(invoice_date, '%Y-%m-%d') as invoice_date, cast(hour(invoice_date) as integer) as invoice_hour
      from star_invoices""",
    "lookup_product_key": """select invoice_no, l.stock_code, product_key, quantity,
      cast(unit_price as double) as unit_price
      from lines l left join products p on l.stock_code = p.stock_code""",
    "fact_row_ids": f"""select row_number() over (order by {", ".join(LINEITEM)}) as line_id, {", ".join(LINEITEM)}
      from lineitem""",
    "fact_row_ids_unordered": """select count(*) as rows_count, cast(1 as bigint) as lowest_id, count(*) as highest_id,
      count(*) as distinct_ids from lineitem""",
    "scd2_history": """select user_id, event_type, valid_from, valid_to, valid_to is null as current_flag
      from event_versions""",
    "scd2_interval_join": """select event_id, e.user_id, e.event_type, e.ts, valid_from,
      case when valid_from is null then null else valid_to is null end as current_flag
      from events e left join event_versions v on e.user_id = v.user_id and e.event_type = v.event_type
        and e.ts >= v.valid_from and (v.valid_to is null or e.ts < v.valid_to)""",
    "scd2_history_ties": """select o_custkey, o_orderpriority, valid_from, valid_to, valid_to is null as current_flag
      from order_versions""",
    "scd2_key_time_join": """select o_orderkey, o.o_custkey, o_orderdate, v.o_orderpriority, valid_from
      from orders o left join order_versions v on o.o_custkey = v.o_custkey and o_orderdate >= valid_from
        and (valid_to is null or o_orderdate < valid_to)""",
    "nf3_country": "select country_key as country_id, country_name from countries",
    "nf3_customer": """select customer_key, customer_business_key,
      cast(customer_id_source as varchar) as customer_id_source, country_key as country_id from customers""",
    "nf3_product": "select product_key, stock_code, product_name as description from products",
    "nf3_invoice": """select invoice_no, invoice_date, c.customer_key, h.country_key as country_id, is_cancelled
      from (select * from (
              select invoice_no, invoice_date, customer_business_key, country_key,
                     starts_with(invoice_no, 'C') as is_cancelled,
                     row_number() over (partition by invoice_no
                       order by invoice_date, customer_business_key, country) as place
              from keyed_lines) where place = 1) h
        join customers c on h.customer_business_key = c.customer_business_key and h.country_key = c.country_key""",
    "nf3_invoice_line": _numbered(
        "invoice_line_id", "invoice_no, product_key, quantity, unit_price, is_return",
        """select invoice_no, product_key, quantity, unit_price, quantity < 0 as is_return
      from lines l join products p on l.stock_code = p.stock_code""", "unit_price"),
    "kimball_fact": _numbered(
        "sales_fact_id", """invoice_no, customer_key, product_key, country_key, date_key, quantity, unit_price,
      sales_amount, gross_sales_amount, return_amount, is_return, is_cancelled""", "select * from kimball",
        "unit_price, sales_amount, gross_sales_amount, return_amount"),
    "net_gross_returns_by_country": f"select country_name, {SIGNED} from kimball group by country_name",
    "net_gross_returns_monthly": f"""select cast(year(d) as integer) as "year", cast(month(d) as integer) as "month",
      {SIGNED}, strftime(d, '%Y-%m') as period from kimball group by 1, 2, strftime(d, '%Y-%m')""",
    "star_fact": _numbered(
        "sales_key", """invoice_key, customer_key, product_key, date_key, country_key, quantity, unit_price, revenue,
      line_count""", "select * from star_facts", "unit_price, revenue"),
    "star_customer_versions": """select row_number() over (order by customer_id) as customer_key, customer_id,
      country_key, country as country_name, valid_from, cast(null as timestamp) as valid_to, true as current_flag
      from (select customer_id, country, min(invoice_date) as valid_from from clean_star group by customer_id, country)
        join star_countries on country = star_countries.country_name""",
    "star_sales_by_country": f"select country_name, {STAR}, count(*) as lines from star_facts group by country_name",
    "star_sales_trend": f"""select cast(year(d) as integer) as "year", cast(month(d) as integer) as "month", {STAR},
      count(*) as lines from star_facts group by 1, 2""",
    "star_sales_by_product": f"select stock_code, product_name, {STAR} from star_facts group by stock_code, product_name",
    "etl_basic_fact": """select invoice_no, stock_code, customer_id, invoice_date,
      cast(year(invoice_date) as integer) as "year", cast(month(invoice_date) as integer) as "month",
      cast(day(invoice_date) as integer) as "day", quantity, cast(unit_price as double) as unit_price,
      cast(quantity * unit_price as double) as revenue, 1 as line_count from clean_basic""",
    "etl_control_by_month": f"""select cast(year(invoice_date) as integer) as "year",
      cast(month(invoice_date) as integer) as "month", {CONTROL} from clean_basic group by 1, 2""",
    "etl_control_by_country": f"select country, {CONTROL} from clean_basic group by country",
    "duplicate_members": f"{DUPLICATES} where members > 1",
    "cross_source_duplicates": f"{DUPLICATES} where low <> high",
    "integrate_sources": _numbered(
        "fact_sales_id", """invoice_no, stock_code, customer_id, invoice_date, "year", "month", "day", quantity,
      unit_price, revenue, line_count, country, source_system, source_sheet, source_name""",
        """select invoice_no, stock_code, customer_id, invoice_date, cast(year(invoice_date) as integer) as "year",
      cast(month(invoice_date) as integer) as "month", cast(day(invoice_date) as integer) as "day", quantity,
      unit_price, quantity * unit_price as revenue, 1 as line_count, country, source_system, source_sheet,
      source_name from integrated""", "unit_price, revenue"),
    "integrated_rows_per_source": """select source_system, source_sheet, count(*) as rows_count
      from integrated group by source_system, source_sheet""",
}


def _statement(body: str) -> str:
    body = body.strip()
    if body.startswith("with "):
        return f"{COMMON.rstrip()},\n{body[5:]}"
    return f"{COMMON}{body}"


ORACLE_SQL: dict[str, str] = {name: _statement(body) for name, body in BODIES.items()}
