"""Expected results as DuckDB SQL over the given tables.

The oracle never builds or parses JSON: it joins order heads to the flat line
table, counts distinct orders with DISTINCT, and computes percentages with
whole-number arithmetic. Agreement therefore says something about the nested
path, the marker counts and the decimal ratios of the Spark side.
"""

from __future__ import annotations

from checks.queries import CATEGORY, CHANNEL, NAME_TERM, SEARCH_TERM, SKU_TERM
from checks.raw_sql import RAW_CUSTOMERS, RAW_LINES, RAW_ORDER_HEADS, RAW_PRODUCTS

AS_OF = "date '2026-12-31'"


def pct(part: str, whole: str, digits: int) -> str:
    """part / whole * 100, rounded half away from zero, from exact whole numbers."""
    n = f"cast(cast({part} as decimal(30,4)) * 10000 as hugeint)"
    d = f"cast(cast({whole} as decimal(30,4)) * 10000 as hugeint)"
    scale = 10**digits
    return (
        f"case when {whole} <> 0 then sign({n}) * sign({d}) * "
        f"((abs({n}) * {200 * scale} + abs({d})) // (2 * abs({d}))) / cast({scale} as double) end"
    )


def pct_or_zero(part: str, whole: str, digits: int) -> str:
    return f"cast(case when {whole} > 0 then {pct(part, whole, digits)} else 0 end as double)"


def dbl(*names: str) -> str:
    return ", ".join(f"cast({n} as double) as {n}" for n in names)


def big(*names: str) -> str:
    return ", ".join(f"cast({n} as bigint) as {n}" for n in names)


# Building blocks in dependency order: name -> (needs, text).
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_customers": ((), RAW_CUSTOMERS),
    "raw_products": ((), RAW_PRODUCTS),
    "raw_heads": ((), RAW_ORDER_HEADS),
    "raw_lines": ((), RAW_LINES),
    "cust": (
        ("raw_customers",),
        """
        select customer_id, trim(full_name) as full_name, trim(email) as raw_email,
               case when ok then lower(trim(email)) end as email, ok as is_valid_email, trim(city) as city,
               cast(signup_date as date) as signup_date, lower(trim(segment)) as customer_segment,
               trim(phone) as phone_number, upper(trim(gender)) as gender, _source_file, _loaded_at
        from (select distinct on (customer_id) *,
                     regexp_matches(trim(email), '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}$', 'i') as ok
              from raw_customers order by customer_id, _loaded_at desc)
        """,
    ),
    "prod": (
        ("raw_products",),
        """
        select product_id, trim(sku) as sku, trim(product_name) as product_name, trim(category) as category,
               cast(price as decimal(18,4)) as price_idr, cast(cost as decimal(18,4)) as cost_idr,
               case when cast(stock_qty as int) > 0 then cast(stock_qty as int) else 0 end as stock_qty,
               cast(stock_qty as int) as raw_stock_qty, cast(weight_gram as int) as weight_gram,
               cast(is_active as boolean) as is_active,
               cast(price as decimal(18,4)) > 0 and cast(cost as decimal(18,4)) > 0 as is_valid_pricing, _loaded_at
        from raw_products
        """,
    ),
    "ord": (
        ("raw_heads",),
        """
        select order_id, customer_id, cast(order_date as timestamptz) at time zone 'UTC' as ordered_at,
               cast(cast(order_date as timestamptz) at time zone 'UTC' as date) as order_date,
               case when status is null then 'unknown' else lower(trim(status)) end as order_status,
               status is not null as is_status_present, lower(payment_method) as payment_method, channel,
               total_amount as total_amount_idr, o_orderkey, _loaded_at, status, order_date as order_date_text
        from raw_heads h
        where _loaded_at = (select max(_loaded_at) from raw_heads v where v.order_id = h.order_id)
        """,
    ),
    "items": (
        ("ord", "prod", "cust", "raw_lines"),
        """
        select *, case when priced > 0 then priced else cast(0 as decimal(18,4)) end as gross_revenue_idr,
               case when priced > 0 then priced else cast(0 as decimal(18,4)) end - cogs_idr as gross_profit_idr,
               md5(order_id || '-' || cast(item_index as varchar)) as order_item_id
        from (
          select *, cast((unit_price_idr - discount_idr) * qty as decimal(18,4)) as priced,
                 cast(unit_cost * qty as decimal(18,4)) as cogs_idr
          from (
            select o.order_id, o.customer_id, o.ordered_at, o.order_date, o.order_status, o.payment_method, o.channel,
                   l.product_id, p.product_name, p.category, l.qty as raw_qty, l.unit_price, l.discount,
                   case when l.qty >= 1 then l.qty else 1 end as qty,
                   cast(coalesce(l.unit_price, p.price_idr, 0) as decimal(18,4)) as unit_price_idr,
                   cast(coalesce(l.discount, 0) as decimal(18,4)) as discount_idr,
                   cast(coalesce(p.cost_idr, 0) as decimal(18,4)) as unit_cost,
                   o.customer_id in (select customer_id from cust) as is_registered_customer,
                   row_number() over (partition by o.order_id order by l.product_id nulls last, l.qty nulls first,
                                      l.unit_price nulls first, l.discount nulls first) as item_index
            from raw_lines l join ord o on o.o_orderkey = l.l_orderkey left join prod p on p.product_id = l.product_id
          )
        )
        """,
    ),
    "metrics": (
        ("items",),
        """
        select customer_id, count(distinct order_id) as total_orders,
               count(distinct order_id) filter (order_status = 'completed') as total_completed_orders,
               min(order_date) as first_order_date, max(order_date) as last_order_date,
               sum(gross_revenue_idr) as lifetime_gross_spend_idr,
               coalesce(sum(gross_revenue_idr) filter (order_status = 'completed'), 0) as lifetime_net_spend_idr,
               coalesce(sum(gross_profit_idr) filter (order_status = 'completed'), 0) as lifetime_gross_profit_idr
        from items group by customer_id
        """,
    ),
    "d_cust": (
        ("cust", "metrics"),
        """
        select c.customer_id, full_name, email, is_valid_email, city, signup_date, customer_segment, phone_number,
               gender, true as is_registered_in_crm,
               coalesce(total_orders, 0) as total_orders, coalesce(total_completed_orders, 0) as total_completed_orders,
               first_order_date, last_order_date,
               coalesce(lifetime_gross_spend_idr, 0) as lifetime_gross_spend_idr,
               coalesce(lifetime_net_spend_idr, 0) as lifetime_net_spend_idr,
               coalesce(lifetime_gross_profit_idr, 0) as lifetime_gross_profit_idr,
               case when coalesce(lifetime_net_spend_idr, 0) <= 0 then 'No Purchases'
                    when lifetime_net_spend_idr < 5e6 then 'Bronze' when lifetime_net_spend_idr < 2e7 then 'Silver'
                    when lifetime_net_spend_idr < 5e7 then 'Gold' else 'Platinum' end as customer_tier
        from cust c left join metrics m on m.customer_id = c.customer_id
        union all
        select 'UNKNOWN', 'Guest / Unregistered Customer', null, false, 'Unknown', date '2020-01-01', 'guest', null,
               'UNKNOWN', false, 0, 0, null, null, 0, 0, 0, 'Guest / Unregistered'
        """,
    ),
    "sold": (
        ("items",),
        """
        select product_id, count(distinct order_id) as total_orders, sum(qty) as total_units_sold,
               sum(gross_revenue_idr) as total_revenue_generated_idr, sum(gross_profit_idr) as total_profit_generated_idr
        from items where order_status = 'completed' group by product_id
        """,
    ),
    "d_prod": (
        ("prod", "sold"),
        f"""
        select p.product_id, sku, product_name, category, price_idr, cost_idr, price_idr - cost_idr as unit_margin_idr,
               {pct('(price_idr - cost_idr)', 'price_idr', 2)} as margin_percentage,
               stock_qty, weight_gram, is_active, is_valid_pricing,
               coalesce(total_orders, 0) as total_completed_orders, coalesce(total_units_sold, 0) as total_units_sold,
               coalesce(total_revenue_generated_idr, 0) as total_revenue_generated_idr,
               coalesce(total_profit_generated_idr, 0) as total_profit_generated_idr,
               case when stock_qty >= 20 then 'Healthy' when stock_qty = 0 then 'Out of Stock' else 'Low Stock' end
                 as stock_status
        from prod p left join sold s on s.product_id = p.product_id
        """,
    ),
    "fact": (
        ("items",),
        f"""
        select order_item_id, order_id, case when is_registered_customer then customer_id else 'UNKNOWN' end as customer_id,
               customer_id as raw_customer_id, is_registered_customer, product_id, ordered_at, order_date, order_status,
               payment_method, channel, qty, unit_price_idr, discount_idr, gross_revenue_idr, cogs_idr, gross_profit_idr,
               {pct('gross_profit_idr', 'gross_revenue_idr', 2)} as profit_margin_percentage, category
        from items
        """,
    ),
    "daily": (
        ("items",),
        f"""
        select *, md5(cast(order_date as varchar) || '-' || coalesce(category, 'None') || '-' || payment_method || '-' || channel)
                    as daily_sales_id,
               {pct('net_profit_idr', 'net_revenue_idr', 2)} as net_profit_margin_percentage
        from (
          select order_date, category, payment_method, channel, count(distinct order_id) as total_orders,
                 count(distinct order_id) filter (order_status = 'completed') as completed_orders,
                 count(distinct order_id) filter (order_status = 'cancelled') as cancelled_orders,
                 sum(qty) as total_units_sold, sum(gross_revenue_idr) as gross_revenue_idr,
                 sum(discount_idr * qty) as total_discount_idr, sum(cogs_idr) as total_cogs_idr,
                 sum(gross_profit_idr) as gross_profit_idr,
                 coalesce(sum(gross_revenue_idr) filter (order_status = 'completed'), 0) as net_revenue_idr,
                 coalesce(sum(gross_profit_idr) filter (order_status = 'completed'), 0) as net_profit_idr
          from items group by all
        )
        """,
    ),
    "totals": (
        ("daily",),
        """
        select sum(gross_revenue_idr) as total_gross_revenue, sum(net_revenue_idr) as total_net_revenue,
               sum(gross_profit_idr) as total_gross_profit, sum(net_profit_idr) as total_net_profit,
               sum(total_orders) as total_orders, sum(completed_orders) as total_completed_orders,
               sum(total_units_sold) as total_units_sold
        from daily
        """,
    ),
    "guests": (
        ("items",),
        "select sum(gross_revenue_idr) as revenue from items where not is_registered_customer",
    ),
}

ORACLE: dict[str, str] = {}


def expect(name: str, select: str, *needs: str) -> None:
    wanted: list[str] = []

    def visit(block: str) -> None:
        for below in BLOCKS[block][0]:
            visit(below)
        if block not in wanted:
            wanted.append(block)

    for need in needs:
        visit(need)
    heads = ",\n".join(f"{b} as materialized ({BLOCKS[b][1]})" for b in wanted)
    ORACLE[name] = (f"with {heads}\n" if heads else "") + select


# ---------------------------------------------------------------- sources and sinks

NEWEST = "timestamp '2026-12-01 00:00:00'"
LANDED = f"_loaded_at = {NEWEST}"
# Eight hexadecimal digits of a checksum of each line, added up.
CHECKSUM = "cast(coalesce(checksum, 0) as bigint) as items_checksum"
COUNTED_LINES = """(
    select l_orderkey, count(*) as n, sum(cast('0x' || substr(md5(concat_ws('|', coalesce(product_id, ''),
        coalesce(cast(qty as varchar), ''), coalesce(cast(cast(unit_price as decimal(18,4)) as varchar), ''),
        coalesce(cast(discount as varchar), ''), '')), 1, 8) as bigint)) as checksum
    from raw_lines group by 1)"""
expect(
    "ingest_customers_csv",
    f"""select customer_id, full_name, email, city, signup_date, segment, phone, gender, _source_file, _loaded_at
        from raw_customers where {LANDED}""",
    "raw_customers",
)
expect(
    "ingest_products_csv",
    """select product_id, sku, product_name, category, price, cost, stock_qty, weight_gram, is_active, _source_file,
              _loaded_at from raw_products""",
    "raw_products",
)
expect(
    "ingest_orders_json",
    f"""select order_id, customer_id, order_date, status, payment_method, channel, {dbl('total_amount')},
               cast(coalesce(n, 0) as int) as n_items, {CHECKSUM}, _source_system, {NEWEST} as _loaded_at
        from raw_heads left join {COUNTED_LINES} on l_orderkey = o_orderkey""",
    "raw_heads", "raw_lines",
)
expect(
    "raw_provenance",
    f"""select 'customers' as raw_table, _source_file as origin, {NEWEST} as _loaded_at, count(*) as n_rows
          from raw_customers where {LANDED} group by all
        union all select 'products', _source_file, {NEWEST}, count(*) from raw_products group by all
        union all select 'orders', _source_system, {NEWEST}, count(*) from raw_heads group by all""",
    "raw_customers", "raw_products", "raw_heads",
)
expect(
    "raw_full_refresh",
    f"""select 'raw.customers' as target, count(*) as n_rows from raw_customers where {LANDED}
        union all select 'raw.products', count(*) from raw_products
        union all select 'raw.orders', count(*) from raw_heads""",
    "raw_customers", "raw_products", "raw_heads",
)
expect(
    "ingest_ragged_rows",
    f"""select customer_id, full_name, email, city, signup_date, segment,
               case when n % 7 <> 0 then phone end as phone, case when n % 7 <> 0 then gender end as gender,
               case when n % 7 = 0 then 'short' when n % 11 = 0 then 'long' end as _row_shape
        from (select *, cast(substr(customer_id, 5) as bigint) as n from raw_customers where {LANDED})""",
    "raw_customers",
)
expect(
    "landing_empty_newest",
    """select 'customers' as dataset, 'customers_20261202.csv' as export_name, false as is_valid
       union all select 'products', max(_source_file), count(*) > 0 from raw_products""",
    "raw_products",
)
expect(
    "run_retention",
    """select run_id, count(*) as n_rows, run_id = 'run-5' as is_current
       from daily, (values ('run-4'), ('run-5')) runs(run_id) group by run_id""",
    "daily",
)
for key, extra in (("landing_latest_file", ""), ("landing_file_validity", ", count(*) > 0 as is_valid")):
    expect(
        key,
        f"""select 'customers' as dataset, max(_source_file) as export_name{extra} from raw_customers
            union all select 'products', max(_source_file){extra} from raw_products""",
        "raw_customers", "raw_products",
    )

DAILY = f"""select daily_sales_id, order_date, category, payment_method, channel,
    {big('total_orders', 'completed_orders', 'cancelled_orders', 'total_units_sold')},
    {dbl('gross_revenue_idr', 'total_discount_idr', 'total_cogs_idr', 'gross_profit_idr', 'net_revenue_idr',
         'net_profit_idr', 'net_profit_margin_percentage')} from daily"""
expect("mart_roundtrip", DAILY, "daily")
expect(
    "export_marts_json",
    """select 'daily_sales' as section, count(*) as records, cast(sum(gross_revenue_idr) as double) as revenue from daily
       union all select 'products', count(*), cast(sum(total_revenue_generated_idr) as double) from d_prod
       union all select 'customer_tiers', count(distinct (customer_tier, is_registered_in_crm)),
                        cast(sum(lifetime_gross_spend_idr) as double) from d_cust
       union all select 'kimball_audit', count(distinct is_registered_customer), cast(sum(gross_revenue_idr) as double) from items
       union all select 'summary', 1, cast(sum(gross_revenue_idr) as double) from items
       union all select 'generated', 1, null union all select 'run_metadata', 1, null""",
    "daily", "d_prod", "d_cust", "items",
)

# ---------------------------------------------------------------- staging pieces

expect("dedup_latest_customers", "select customer_id, '  ' || full_name || ' ' as full_name, _source_file, _loaded_at from cust", "cust")
expect("dedup_latest_products", "select product_id, sku, _source_file, _loaded_at from raw_products", "raw_products")
expect("dedup_latest_orders", "select order_id, customer_id, status, order_date_text as order_date, _loaded_at from ord", "ord")
expect(
    "hygiene_strings",
    """select customer_id, _source_file, trim(full_name) as full_name, lower(trim(segment)) as customer_segment,
              upper(trim(gender)) as gender, cast(length(trim(full_name)) as int) as name_length from raw_customers""",
    "raw_customers",
)
expect(
    "email_validation",
    r"""select customer_id, _source_file, raw_email, ok as is_valid_email, case when ok then lower(raw_email) end as email
        from (select *, trim(email) as raw_email,
                     regexp_matches(trim(email), '^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$', 'i') as ok from raw_customers)""",
    "raw_customers",
)
expect("stock_clamp", "select product_id, raw_stock_qty, stock_qty from prod", "prod")
expect(
    "typed_casts",
    f"select product_id, {dbl('price_idr', 'cost_idr')}, weight_gram, is_active, raw_stock_qty from prod", "prod",
)
expect("order_dates", "select order_id, ordered_at, order_date from ord", "ord")
expect(
    "hygiene_flags",
    """select flag, value, count(*) as n_rows from (
         select 'valid_email' as flag, is_valid_email as value from cust
         union all select 'valid_pricing', is_valid_pricing from prod
         union all select 'status_present', is_status_present from ord
         union all select 'registered_customer', is_registered_customer from items) group by all""",
    "cust", "prod", "ord", "items",
)

# ---------------------------------------------------------------- models

expect(
    "stg_customers",
    """select customer_id, full_name, raw_email, email, is_valid_email, city, signup_date, customer_segment,
              phone_number, gender, _loaded_at from cust""",
    "cust",
)
expect(
    "stg_products",
    f"""select product_id, sku, product_name, category, {dbl('price_idr', 'cost_idr')}, stock_qty, raw_stock_qty,
               weight_gram, is_active, is_valid_pricing, _loaded_at from prod""",
    "prod",
)
expect(
    "stg_orders",
    f"""select order_id, customer_id, ordered_at, order_date, order_status, is_status_present, payment_method, channel,
               {dbl('total_amount_idr')}, cast(coalesce(n, 0) as int) as n_items, {CHECKSUM}, _loaded_at
        from ord left join {COUNTED_LINES} on l_orderkey = o_orderkey""",
    "ord", "raw_lines",
)
expect(
    "unnest_order_items",
    f"""select order_id, order_status, product_id, cast(raw_qty as double) as qty, {dbl('unit_price', 'discount')},
               cast(null as double) as subtotal from items""",
    "items",
)
expect(
    "line_index",
    "select order_id, cast(item_index as int) as item_index, product_id, cast(raw_qty as double) as qty from items",
    "items",
)
MONEY5 = dbl("unit_price_idr", "discount_idr", "gross_revenue_idr", "cogs_idr", "gross_profit_idr")
expect(
    "int_order_items",
    f"""select order_item_id, order_id, customer_id, ordered_at, order_date, order_status, payment_method, channel,
               product_id, product_name, category, qty, {MONEY5} from items""",
    "items",
)
expect(
    "line_metrics",
    f"select order_id, cast(item_index as int) as line_no, product_id, qty, {MONEY5} from items", "items",
)
expect(
    "surrogate_keys",
    """select 'line' as kind, order_item_id as surrogate_key from items
       union all select 'day', daily_sales_id from daily""",
    "items", "daily",
)
LIFETIME = dbl("lifetime_gross_spend_idr", "lifetime_net_spend_idr", "lifetime_gross_profit_idr")
ORDERS2 = big("total_orders", "total_completed_orders")
expect(
    "int_customer_metrics",
    f"select customer_id, {ORDERS2}, first_order_date, last_order_date, {LIFETIME} from metrics", "metrics",
)
expect(
    "product_sales_metrics",
    f"""select product_id, {big('total_orders', 'total_units_sold')},
               {dbl('total_revenue_generated_idr', 'total_profit_generated_idr')} from sold""",
    "sold",
)
expect(
    "dim_customers",
    f"""select customer_id, full_name, email, is_valid_email, city, signup_date, customer_segment, phone_number, gender,
               is_registered_in_crm, {ORDERS2}, first_order_date, last_order_date, {LIFETIME}, customer_tier from d_cust""",
    "d_cust",
)
expect("customer_tiering", f"select customer_id, {dbl('lifetime_net_spend_idr')}, customer_tier from d_cust", "d_cust")
PRODUCT_AMOUNTS = dbl(
    "price_idr", "cost_idr", "unit_margin_idr", "margin_percentage", "total_revenue_generated_idr",
    "total_profit_generated_idr",
)
PRODUCT_COUNTS = big("total_completed_orders", "total_units_sold")
expect(
    "dim_products",
    f"""select product_id, sku, product_name, category, stock_qty, weight_gram, is_active, is_valid_pricing,
               {PRODUCT_COUNTS}, {PRODUCT_AMOUNTS}, stock_status from d_prod""",
    "d_prod",
)
expect("stock_status", "select product_id, stock_qty, stock_status from d_prod", "d_prod")
expect(
    "fact_order_items",
    f"""select order_item_id, order_id, customer_id, raw_customer_id, is_registered_customer, product_id, ordered_at,
               order_date, order_status, payment_method, channel, qty, {MONEY5}, {dbl('profit_margin_percentage')} from fact""",
    "fact",
)
expect(
    "safe_margin",
    f"""select order_item_id, {dbl('gross_revenue_idr', 'gross_profit_idr', 'profit_margin_percentage')},
               cast({pct('discount_idr', 'unit_price_idr', 1)} as double) as discount_percentage from fact""",
    "fact",
)
expect("fct_daily_sales", DAILY, "daily")

# ---------------------------------------------------------------- joins and aggregates

expect(
    "orphan_customers",
    "select customer_id, count(*) as n_items from items where not is_registered_customer group by 1", "items",
)
expect("distinct_orders", "select product_id, count(distinct order_id) as total_orders from items group by 1", "items")
expect(
    "conditional_distinct",
    """select category, count(distinct order_id) as total_orders,
              count(distinct case when order_status = 'completed' then order_id end) as completed_orders,
              count(distinct case when order_status = 'cancelled' then order_id end) as cancelled_orders
       from items group by 1""",
    "items",
)
expect(
    "conditional_sums",
    """select payment_method, channel, cast(sum(qty) as bigint) as units,
              cast(sum(gross_revenue_idr) as double) as gross_revenue_idr,
              cast(sum(discount_idr * qty) as double) as total_discount_idr,
              cast(sum(case when order_status = 'completed' then gross_revenue_idr else 0 end) as double) as net_revenue_idr,
              cast(sum(case when order_status = 'completed' then gross_profit_idr else 0 end) as double) as net_profit_idr,
              count(*) filter (order_status = 'completed') as completed_lines
       from items group by 1, 2""",
    "items",
)

# ---------------------------------------------------------------- reports

expect(
    "report_daily_sales",
    f"""select cast(order_date as varchar) as order_date, category, payment_method, channel,
               {big('total_orders', 'completed_orders', 'cancelled_orders', 'total_units_sold')},
               {dbl('gross_revenue_idr', 'net_revenue_idr', 'total_cogs_idr', 'gross_profit_idr', 'net_profit_idr',
                    'net_profit_margin_percentage')} from daily""",
    "daily",
)
RANKED = f"""select product_id, sku, product_name, category, stock_qty, is_active, {PRODUCT_COUNTS}, {PRODUCT_AMOUNTS},
                    stock_status from d_prod"""
for key, column in (
    ("product_ranking", "total_revenue_generated_idr"),
    ("product_ranking_by_margin", "margin_percentage"),
    ("product_ranking_by_units", "total_units_sold"),
):
    expect(key, f"{RANKED} order by {column} desc nulls last, product_id", "d_prod")
expect(
    "inventory_search",
    f"""{RANKED} where category = '{CATEGORY}' and (product_name ilike '%{SEARCH_TERM}%'
        or category ilike '%{SEARCH_TERM}%' or sku ilike '%{SEARCH_TERM}%')
        order by total_units_sold desc nulls last, product_id""",
    "d_prod",
)
for key, term in (("inventory_search_by_name", NAME_TERM), ("inventory_search_by_sku", SKU_TERM)):
    expect(
        key,
        f"""{RANKED} where product_name ilike '%{term}%' or category ilike '%{term}%' or sku ilike '%{term}%'
            order by total_revenue_generated_idr desc nulls last, product_id""",
        "d_prod",
    )
expect(
    "tier_summary",
    """select customer_tier, is_registered_in_crm, count(*) as customer_count,
              cast(sum(lifetime_gross_spend_idr) as double) as total_gross_spend,
              cast(sum(lifetime_net_spend_idr) as double) as total_net_spend from d_cust group by 1, 2""",
    "d_cust",
)
expect(
    "tier_share",
    f"""select customer_tier, n as customer_count, {pct_or_zero('n', 't', 1)} as percentage
        from (select customer_tier, count(*) as n, cast(sum(count(*)) over () as bigint) as t from d_cust group by 1)""",
    "d_cust",
)
expect(
    "guest_audit",
    f"""select is_registered_customer, n as total_items, cast(r as double) as total_revenue, cast(p as double) as total_profit,
               {pct_or_zero('r', 't', 2)} as percentage
        from (select is_registered_customer, count(*) as n, sum(gross_revenue_idr) as r, sum(gross_profit_idr) as p,
                     sum(sum(gross_revenue_idr)) over () as t from items group by 1)""",
    "items",
)
expect(
    "pipeline_summary",
    """select (select count(*) from d_cust) as total_customers, (select count(*) from d_prod) as total_products,
              (select count(*) from items) as total_order_items,
              cast(round(sum(gross_revenue_idr)) as bigint) as total_gross_revenue,
              cast(round(sum(net_profit_idr)) as bigint) as total_net_profit from daily""",
    "d_cust", "d_prod", "items", "daily",
)
expect(
    "filter_values",
    """select distinct 'category' as filter, category as value from daily
       union all select distinct 'channel', channel from daily""",
    "daily",
)
TOTALS = f"""{dbl('total_gross_revenue', 'total_net_revenue', 'total_gross_profit', 'total_net_profit')},
    {big('total_orders', 'total_completed_orders', 'total_units_sold')},
    {pct_or_zero('total_net_profit', 'total_net_revenue', 2)} as overall_net_margin_percentage"""
HEADCOUNTS = """(select count(*) from cust) as registered_customers_count,
    (select count(*) from prod where is_active) as active_products_count"""
expect(
    "kpi_summary",
    f"""select {TOTALS}, cast((select revenue from guests) as double) as preserved_guest_revenue, {HEADCOUNTS} from totals""",
    "totals", "guests", "cust", "prod",
)
PICK = f"category = '{CATEGORY}' and channel = '{CHANNEL}'"
PRORATA = f"""cast(round(cast((select revenue from guests) as double)
    * (cast((select sum(gross_revenue_idr) from items where {PICK}) as double)
       / cast((select sum(gross_revenue_idr) from items) as double))) as bigint) as preserved_guest_revenue"""
expect(
    "kpi_filtered",
    f"""select {TOTALS}, {PRORATA}, {HEADCOUNTS} from (
          select sum(gross_revenue_idr) as total_gross_revenue, sum(net_revenue_idr) as total_net_revenue,
                 sum(gross_profit_idr) as total_gross_profit, sum(net_profit_idr) as total_net_profit,
                 sum(total_orders) as total_orders, sum(completed_orders) as total_completed_orders,
                 sum(total_units_sold) as total_units_sold from daily where {PICK})""",
    "daily", "guests", "cust", "prod", "items",
)
expect("guest_revenue_prorata", f"select {PRORATA}", "guests", "items")
expect(
    "guest_revenue_exact",
    f"""select cast(sum(gross_revenue_idr) as double) as preserved_guest_revenue from items
        where not is_registered_customer and {PICK}""",
    "items",
)
expect(
    "kpi_exact_orders",
    """select count(distinct order_id) as total_orders,
              count(distinct order_id) filter (order_status = 'completed') as completed_orders,
              count(distinct order_id) filter (order_status = 'cancelled') as cancelled_orders from items""",
    "items",
)
expect(
    "fulfillment_rate",
    f"""select {ORDERS2}, {pct_or_zero('total_completed_orders', 'total_orders', 1)} as fulfillment_rate from totals""",
    "totals",
)
for key, where in (("daily_trend", ""), ("daily_trend_of_channel", f"where channel = '{CHANNEL}'")):
    expect(
        key,
        f"""select order_date, cast(sum(gross_revenue_idr) as double) as gross_revenue,
                   cast(sum(net_profit_idr) as double) as net_profit, cast(sum(total_orders) as bigint) as orders
            from daily {where} group by 1""",
        "daily",
    )
SHARE = f"""cast(r as double) as revenue, cast(o as bigint) as orders, {pct_or_zero('r', 't', 1)} as percentage"""


def shares_by(column: str) -> str:
    return f"""(select {column}, sum(gross_revenue_idr) as r, sum(total_orders) as o,
                       sum(sum(gross_revenue_idr)) over () as t from daily group by 1)"""


expect(
    "channel_share",
    f"""select channel, {SHARE}, case channel when 'mobile_app' then 'Mobile App' when 'marketplace' then 'Marketplace'
               when 'website' then 'Website' else channel end as label from {shares_by('channel')}""",
    "daily",
)
expect("category_share", f"select category, {SHARE} from {shares_by('category')}", "daily")
expect(
    "revenue_reconciliation",
    """select cast(sum(gross_revenue_idr) as double) as fact_revenue,
              cast(sum(gross_revenue_idr) filter (is_registered_customer) as double) as registered_revenue,
              cast(sum(gross_revenue_idr) filter (not is_registered_customer) as double) as guest_revenue,
              cast(sum(gross_revenue_idr) as double) as line_revenue, true as is_reconciled from items""",
    "items",
)

# ---------------------------------------------------------------- data tests


def failures(*rows: tuple[str, str, str]) -> str:
    return "\nunion all ".join(
        f"select '{check}' as \"check\", '{target}' as target, cast(({count}) as bigint) as failures"
        for check, target, count in rows
    )


def zero(check: str, *targets: str) -> list[tuple[str, str, str]]:
    return [(check, t, "0") for t in targets]


def rows_where(table: str, condition: str) -> str:
    return f"select count(*) from {table} where {condition}"


def repeated(table: str, key: str) -> str:
    return f"select count(*) from (select {key} from {table} group by 1 having count(*) > 1)"


NOT_NULL_MARTS = [
    ("not_null", "dim_customers.customer_id", rows_where("d_cust", "customer_id is null")),
    ("not_null", "dim_products.product_id", rows_where("d_prod", "product_id is null")),
    ("not_null", "dim_products.price_idr", rows_where("d_prod", "price_idr is null")),
    *[
        ("not_null", f"fact_order_items.{c}", rows_where("fact", f"{c} is null"))
        for c in ("order_item_id", "order_id", "customer_id", "product_id", "qty")
    ],
    *[("not_null", f"fct_daily_sales.{c}", rows_where("daily", f"{c} is null")) for c in ("daily_sales_id", "order_date")],
]
UNIQUE_MARTS = [
    ("unique", "dim_customers.customer_id", repeated("d_cust", "customer_id")),
    ("unique", "dim_products.product_id", repeated("d_prod", "product_id")),
    ("unique", "fact_order_items.order_item_id", repeated("fact", "order_item_id")),
    ("unique", "fct_daily_sales.daily_sales_id", repeated("daily", "daily_sales_id")),
]
PARENT_MARTS = [
    ("relationships", "fact_order_items.customer_id",
     rows_where("fact", "not exists (select 1 from d_cust d where d.customer_id = fact.customer_id)")),
    ("relationships", "fact_order_items.product_id",
     rows_where("fact", "not exists (select 1 from d_prod d where d.product_id = fact.product_id)")),
]
REVENUE_MART = ("no_negative_revenue", "fact_order_items.gross_revenue_idr",
                rows_where("fact", "gross_revenue_idr < 0 or cogs_idr < 0"))
DATES_MART = ("valid_order_dates", "fact_order_items.order_date",
              rows_where("fact", f"order_date not between date '2020-01-01' and {AS_OF} + 1"))
STOCK_MART = ("no_negative_stock", "dim_products.stock_qty", rows_where("d_prod", "stock_qty < 0"))
MARTS = ("d_cust", "d_prod", "fact", "daily")

expect(
    "dq_not_null",
    failures(
        ("not_null", "raw.orders.status", rows_where("raw_heads", "status is null")),
        ("not_null", "raw.orders.order_id", rows_where("raw_heads", "order_id is null")),
        ("not_null", "raw.items.qty", rows_where("raw_lines", "qty is null")),
        ("not_null", "raw.items.unit_price", rows_where("raw_lines", "unit_price is null")),
        ("not_null", "raw.items.discount", rows_where("raw_lines", "discount is null")),
        *NOT_NULL_MARTS,
    ),
    "raw_heads", "raw_lines", *MARTS,
)
expect(
    "dq_unique",
    failures(
        ("unique", "raw.customers.customer_id", repeated("raw_customers", "customer_id")),
        ("unique", "raw.products.product_id", repeated("raw_products", "product_id")),
        ("unique", "raw.orders.order_id", repeated("raw_heads", "order_id")),
        *UNIQUE_MARTS,
    ),
    "raw_customers", "raw_products", "raw_heads", *MARTS,
)
expect(
    "dq_relationships",
    failures(
        ("relationships", "raw.orders.customer_id",
         rows_where("raw_heads", "customer_id not in (select customer_id from raw_customers)")),
        *PARENT_MARTS,
    ),
    "raw_heads", "raw_customers", *MARTS,
)
expect(
    "dq_negative_revenue",
    failures(
        ("no_negative_revenue", "raw.items.gross_revenue_idr",
         rows_where("raw_lines", "(unit_price - discount) * qty < 0 or qty < 0")),
        REVENUE_MART,
    ),
    "raw_lines", "fact",
)
expect(
    "dq_order_dates",
    failures(
        ("valid_order_dates", "orders.order_date",
         rows_where("orders", f"cast(o_orderdate as date) not between date '2020-01-01' and {AS_OF} + 1")),
        DATES_MART,
    ),
    "fact",
)
expect(
    "dq_stock",
    failures(
        ("no_negative_stock", "raw.products.stock_qty", rows_where("raw_products", "cast(stock_qty as int) < 0")),
        STOCK_MART,
    ),
    "raw_products", "d_prod",
)
expect(
    "dq_negative_revenue_rows",
    """select 'raw.items' as target, concat('ORD', lpad(cast(l_orderkey as varchar), 7, '0')) as order_id, product_id,
              cast(qty as int) as qty, cast((unit_price - discount) * qty as double) as gross_revenue_idr
       from raw_lines where (unit_price - discount) * qty < 0 or qty < 0
       union all select 'fact_order_items', order_id, product_id, cast(qty as int), cast(gross_revenue_idr as double)
       from fact where gross_revenue_idr < 0 or cogs_idr < 0""",
    "raw_lines", "fact",
)
expect(
    "dq_order_dates_rows",
    f"""select 'orders' as target, cast(o_orderkey as varchar) as order_id, cast(o_orderdate as date) as order_date
        from orders where cast(o_orderdate as date) not between date '2020-01-01' and {AS_OF} + 1
        union all select 'fact_order_items', order_id, order_date from fact
        where order_date not between date '2020-01-01' and {AS_OF} + 1""",
    "fact",
)
expect(
    "dq_stock_rows",
    """select 'raw.products' as target, product_id, cast(stock_qty as int) as stock_qty from raw_products
       where cast(stock_qty as int) < 0
       union all select 'dim_products', product_id, cast(stock_qty as int) from d_prod where stock_qty < 0""",
    "raw_products", "d_prod",
)
expect(
    "dq_orphan_rows",
    """select customer_id, count(*) as n_rows from raw_heads
       where customer_id not in (select customer_id from raw_customers) group by 1""",
    "raw_heads", "raw_customers",
)
expect(
    "dq_raw_counts",
    "\nunion all ".join(
        f"""select 'non_empty' as "check", 'raw.{name}' as target, count(*) as n_rows,
                   cast(count(*) = 0 as bigint) as failures, count(*) > 0 as passed from {block}"""
        for name, block in (("customers", "raw_customers"), ("products", "raw_products"), ("orders", "raw_heads"))
    ),
    "raw_customers", "raw_products", "raw_heads",
)
expect(
    "dq_report",
    "select *, failures = 0 as passed from ("
    + failures(*NOT_NULL_MARTS, REVENUE_MART, DATES_MART, STOCK_MART, *UNIQUE_MARTS, *PARENT_MARTS)
    + ")",
    *MARTS,
)
NESTED = "raw_heads h where exists (select 1 from raw_lines l where l.l_orderkey = h.o_orderkey and l.{} is null)"
expect(
    "dq_document_violations",
    failures(
        ("document", "required.order_id", rows_where("raw_heads", "order_id is null")),
        ("document", "required.customer_id", rows_where("raw_heads", "customer_id is null")),
        ("document", "required.order_date", rows_where("raw_heads", "order_date is null")),
        ("document", "required.status", rows_where("raw_heads", "status is null")),
        ("document", "required.items", "0"),
        ("document", "enum.status",
         rows_where("raw_heads", "status not in ('pending', 'processing', 'completed', 'cancelled')")),
        ("document", "items.required.product_id", f"select count(*) from {NESTED.format('product_id')}"),
        ("document", "items.required.qty", f"select count(*) from {NESTED.format('qty')}"),
        ("document", "items.required.unit_price", f"select count(*) from {NESTED.format('unit_price')}"),
        *zero("document", "items.type.qty", "items.type.unit_price", "items.type.discount"),
    ),
    "raw_heads", "raw_lines",
)
# Every document once more with bad items: what is wrong with a head counts twice.
ORACLE["dq_document_types"] = f"""
    select "check", target, cast(failures * case when target like 'required.%' or target like 'enum.%' then 2 else 1 end + coalesce(n, 0) as bigint)
        as failures
    from ({ORACLE["dq_document_violations"]}) left join (
        select unnest(case o_orderkey % 3 when 0 then ['items.type.qty', 'items.type.discount'] when 1 then ['required.items']
            else ['items.type.unit_price', 'items.required.product_id'] end) as target, count(*) as n
        from (select o_orderkey from orders union all select o_orderkey from orders where o_orderkey % 67 = 0) group by 1
    ) using (target)"""
expect(
    "dq_dirty_profile",
    failures(
        ("invalid_email", "raw.customers",
         rows_where("raw_customers", r"not regexp_matches(trim(email), '^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$', 'i')")),
        ("zero_price", "raw.products", rows_where("raw_products", "cast(price as double) = 0")),
        ("negative_stock", "raw.products", rows_where("raw_products", "cast(stock_qty as int) < 0")),
        ("null_status", "raw.orders", rows_where("raw_heads", "status is null")),
        ("orphan_customer", "raw.orders",
         rows_where("raw_heads", "customer_id not in (select customer_id from raw_customers)")),
        ("duplicate_order", "raw.orders", "select count(*) - count(distinct order_id) from raw_heads"),
    ),
    "raw_customers", "raw_products", "raw_heads",
)
expect(
    "dq_accepted_values",
    failures(
        ("accepted_values", "stg_orders.order_status",
         rows_where("ord", "order_status not in ('pending', 'processing', 'completed', 'cancelled')")),
        ("accepted_values", "stg_orders.payment_method",
         rows_where("ord", "payment_method not in ('e-wallet', 'transfer bank', 'kartu kredit', 'cod', 'paylater')")),
    ),
    "ord",
)

# The same tests and sums, taken another way.
ORACLE["dq_report_reread"] = ORACLE["dq_report"]
ORACLE["revenue_reconciliation_written"] = ORACLE["revenue_reconciliation"]
