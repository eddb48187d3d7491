"""The catalogue's queries as SQL text for a single-node engine.

The text is written for itself, not generated from the Spark code: rates are found with
that engine's own as-of join, ids with one global ``row_number``, histories with unions.
"""

_CURRENCY = (
    "case {key} % 10 when 5 then ' eur ' when 6 then 'EUR' when 7 then 'GBP'"
    " when 8 then 'XYZ' when 9 then null else 'USD' end"
)
_BATCH_1 = "timestamp '2025-01-01 02:00:00'"
_BATCH_2 = "timestamp '2025-01-02 02:00:00'"
_FIRST_AT = "timestamp '2001-01-01 00:00:00'"
_SECOND_AT = "timestamp '2001-07-01 00:00:00'"

_LINE_ID = """cast('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey,
    l_suppkey, cast(l_shipdate as date))), 1, 15) as bigint)"""


def _lines(quantity: str, currency: str, second: str) -> str:
    return f"""
    select {_LINE_ID} as id, l_orderkey as order_id,
           case when l_partkey % 20 = 0 then l_partkey + 10000000000 else l_partkey end
             as product_id,
           cast({quantity} as integer) as quantity,
           cast(l_extendedprice as decimal(10,2)) as unit_price,
           {currency} as currency,
           case when {second} then {_BATCH_2} else {_BATCH_1} end as _loaded_at
    from lineitem"""


def _cleaned_lines(source: str) -> str:
    return f"""
    select id as order_item_id, order_id, product_id, quantity, unit_price,
           upper(trim(currency)) as currency,
           upper(trim(currency)) in ('USD', 'EUR', 'GBP') as is_valid_currency,
           cast(quantity * unit_price as decimal(18,2)) as line_amount_native,
           _loaded_at
    from {source}"""


def _in_usd(items: str, orders: str, how: str = "left") -> str:
    return f"""
    select x.*, cast(x.rate_to_usd * x.line_amount_native as decimal(37,8)) as line_amount_usd,
           x.rate_to_usd is not null as is_fx_convertible
    from (
      select i.*, o.order_date, o.customer_id,
             case when o.order_date is not null
                  then coalesce(r.rate_to_usd, e.rate_to_usd) end as rate_to_usd
      from {items} i
      {how} join {orders} o on o.order_id = i.order_id
      asof left join stg_rates r
        on r.currency = i.currency and r.rate_date <= cast(o.order_date as date)
      left join (select currency, arg_min(rate_to_usd, rate_date) as rate_to_usd
                 from stg_rates group by currency) e on e.currency = i.currency
    ) x"""


def _fact_of(usd: str) -> str:
    return f"""
    select u.order_item_id, u.order_id, u.customer_id,
           case when p.id is null then -1 else u.product_id end as product_id,
           u.order_date, cast(u.order_date as date) as order_date_day,
           extract(hour from u.order_date) as order_hour,
           u.quantity, u.unit_price, u.currency, u.is_valid_currency, u.line_amount_native,
           u.rate_to_usd, u.line_amount_usd, u.is_fx_convertible,
           p.id is null as is_unknown_product, u._loaded_at
    from {usd} u left join raw_prod p on p.id = u.product_id
    where u.customer_id is not null"""


_PRODUCT = """
    select p_partkey as id, '  ' || p_name as name, p_type || ' ' as category,
           p_brand as description, cast(p_retailprice as decimal(10,2)) as base_price,
           ' usd ' as currency
    from part"""

_CORRECTED = "(l_orderkey % 6 = 1 and l_linenumber = 1)"
_LINE_CURRENCY = _CURRENCY.format(key="l_orderkey")

_COMMON = f"""
with raw_lines as ({_lines("l_quantity", _LINE_CURRENCY, "l_orderkey % 6 = 0")}),
raw_lines_2 as ({_lines(
    f"l_quantity + case when {_CORRECTED} then 1 else 0 end",
    f"case when {_CORRECTED} then 'XYZ' else {_LINE_CURRENCY} end",
    f"l_orderkey % 6 = 0 or {_CORRECTED}",
)}),
raw_ord as (
    select o_orderkey as id, o_custkey as customer_id,
           o_orderdate + (o_orderkey * 37 % 24) * interval 1 hour as order_date,
           cast(o_totalprice as decimal(10,2)) as total_amount,
           {_CURRENCY.format(key="o_orderkey")} as currency, o_orderstatus as status,
           case when o_orderkey % 6 = 0 then {_BATCH_2} else {_BATCH_1} end as _loaded_at
    from orders),
raw_cust as (
    select c_custkey as id, ' ' || c_name || ' ' as name,
           ' ' || c_name || '@Shop.Example ' as email,
           timestamp '1994-01-01 08:30:00' + (c_custkey % 365) * interval 1 day
             as registration_date,
           n_name || ' ' as country
    from customer left join nation on n_nationkey = c_nationkey),
all_parts as ({_PRODUCT}),
raw_prod as (select * from all_parts),
raw_prod_2 as (
    select id, name, case when part % 13 = 0 then 'MOVED' else category end as category,
           case when part % 17 = 0 then 'reworded' else description end as description,
           case when part % 7 = 0 then cast(base_price * cast(1.1 as decimal(2,1)) as decimal(10,2))
                else base_price end as base_price,
           currency
    from (select *, id as part from all_parts
          union all
          select * replace (id + 10000000000 as id), id from all_parts where id % 40 = 0)
    where part % 11 <> 0),
fx_days as (
    select cast(date_trunc('month', o_orderdate)
                + case when day(o_orderdate) < 15 then interval 0 day else interval 14 day end
                + interval 1 year as date) as rate_date,
           cast(sum(cast(round(o_totalprice * 100) as bigint)) % 1000 as decimal(18,6))
             * cast(0.0001 as decimal(5,4)) as x
    from orders group by 1),
raw_fx as (
    select 'USD' as base_currency, 'USD' as quote_currency, rate_date,
           cast(1 as decimal(18,6)) as rate from fx_days
    union all
    select ' Eur', 'USD', rate_date, cast(1.0 + x as decimal(18,6)) from fx_days
    union all
    select 'gbp ', ' usd', rate_date, cast(1.2 + x as decimal(18,6)) from fx_days
    where extract(day from rate_date) = 1
    union all
    select 'USD', 'EUR', rate_date, cast(0.9 + x as decimal(18,6)) from fx_days),
stg_rates as (
    select upper(trim(base_currency)) as currency, rate_date, rate as rate_to_usd
    from raw_fx where upper(trim(quote_currency)) = 'USD'),
stg_cust as (
    select id as customer_id, trim(name) as customer_name, lower(trim(email)) as email,
           registration_date, trim(country) as country from raw_cust),
stg_prod as (
    select id as product_id, trim(name) as product_name, trim(category) as category,
           description, base_price, upper(trim(currency)) as currency from raw_prod),
stg_prod_2 as (
    select id as product_id, trim(name) as product_name, trim(category) as category,
           description, base_price, upper(trim(currency)) as currency from raw_prod_2),
stg_ord as (
    select id as order_id, customer_id, order_date, total_amount,
           upper(trim(currency)) as currency,
           upper(trim(currency)) in ('USD', 'EUR', 'GBP') as is_valid_currency,
           status, _loaded_at from raw_ord),
stg_lines as ({_cleaned_lines("raw_lines")}),
stray_lines as (
    select * replace (case when order_id % 50 = 7 then order_id + 10000000000 else order_id end
                      as order_id)
    from stg_lines),
stg_lines_2 as ({_cleaned_lines("raw_lines_2")}),
usd as ({_in_usd("stg_lines", "stg_ord")}),
fact as ({_fact_of("usd")}),
hours as (
    select h as hour_of_day,
           ['Night (00-05)', 'Morning (06-11)', 'Afternoon (12-17)', 'Evening (18-23)'][h // 6 + 1]
             as day_part,
           h // 6 + 1 as day_part_sort
    from range(24) t(h))
"""

_FACT_COLUMNS = """order_item_id, order_id, customer_id, product_id, order_date,
    order_date_day, order_hour, cast(quantity as bigint) as quantity,
    cast(unit_price as double) as unit_price, currency, is_valid_currency,
    cast(line_amount_native as double) as line_amount_native,
    cast(rate_to_usd as double) as rate_to_usd,
    cast(line_amount_usd as double) as line_amount_usd, is_fx_convertible,
    is_unknown_product, _loaded_at"""

_USD_COLUMNS = """order_item_id, order_id, product_id, order_date,
    cast(quantity as bigint) as quantity, cast(unit_price as double) as unit_price,
    currency, is_valid_currency, cast(line_amount_native as double) as line_amount_native,
    cast(rate_to_usd as double) as rate_to_usd,
    cast(line_amount_usd as double) as line_amount_usd, is_fx_convertible, _loaded_at"""

_LINE_COLUMNS = """order_item_id, order_id, product_id, cast(quantity as bigint) as quantity,
    cast(unit_price as double) as unit_price, currency, is_valid_currency,
    cast(line_amount_native as double) as line_amount_native, _loaded_at"""

_EXCEPTION = "(not is_valid_currency or is_unknown_product or not is_fx_convertible)"

_REASONS = """concat_ws('; ',
    case when not is_valid_currency then 'invalid_currency_code' end,
    case when is_unknown_product then 'product_id_not_in_catalogue' end)"""

_USD_IF = "case when is_fx_convertible then line_amount_usd end"


def _money(expression: str) -> str:
    return f"cast(round({expression}, 2) as double)"


_TOP = f"""
    select product_id, product_name, category, cast(units as bigint) as units_sold,
           {_money("revenue")} as revenue_usd, order_count,
           rank() over (order by units desc) as rank_by_volume,
           rank() over (order by revenue desc nulls last) as rank_by_revenue
    from (select f.product_id, any_value(trim(p.name)) as product_name,
                 any_value(trim(p.category)) as category, sum(f.quantity) as units,
                 sum({_USD_IF}) as revenue, count(distinct f.order_id) as order_count
          from fact f join raw_prod p on p.id = f.product_id
          group by f.product_id)"""


def _promo(per_order: str) -> str:
    return f"""
    select h.hour_of_day, h.day_part, count(o.order_id) as order_count,
           {_money("sum(o.usd)")} as revenue_usd,
           round(cast(avg(o.usd) as double), 2) as avg_order_value_usd,
           rank() over (order by count(o.order_id) desc) as rank_by_order_count
    from hours h left join ({per_order}) o on o.order_hour = h.hour_of_day
    group by h.hour_of_day, h.day_part"""


_PROMO = _promo(f"select order_id, order_hour, sum({_USD_IF}) as usd from fact group by 1, 2")

_KPIS = f"""
    select {_money(f"sum({_USD_IF})")} as total_revenue_usd,
           cast(sum(quantity) as bigint) as total_units,
           count(distinct order_id) as total_orders,
           count(*) filter ({_EXCEPTION}) as dq_exceptions, count(*) as total_lines,
           round(count(*) filter ({_EXCEPTION}) / count(*), 8) as flagged_line_rate
    from fact"""

_HISTORY = f"""
    select a.product_id, a.product_name, a.category, a.description, a.base_price, a.currency,
           {_FIRST_AT} as valid_from,
           case when b.product_id is not null
                 and (a.product_name, a.category, a.base_price, a.currency)
                     <> (b.product_name, b.category, b.base_price, b.currency)
                then {_SECOND_AT} end as valid_to
    from stg_prod a left join stg_prod_2 b using (product_id)
    union all
    select b.product_id, b.product_name, b.category, b.description, b.base_price, b.currency,
           {_SECOND_AT}, cast(null as timestamp)
    from stg_prod_2 b left join stg_prod a using (product_id)
    where a.product_id is null
       or (a.product_name, a.category, a.base_price, a.currency)
          <> (b.product_name, b.category, b.base_price, b.currency)"""

_NATIVE = """
    select product_id, trim(name) as product_name, trim(category) as category, description,
           base_price, upper(trim(currency)) as currency, valid_from,
           lead(valid_from) over (partition by product_id order by valid_from) as valid_to
    from (select l_partkey as product_id,
                 cast(date_trunc('year', l_shipdate) as timestamp) as valid_from,
                 cast(max(l_extendedprice) as decimal(10,2)) as base_price
          from lineitem group by 1, 2)
    join (select id, name, category, description, currency from all_parts) on id = product_id"""

_VERSION_COLUMNS = """product_id, product_name, category, description,
    cast(base_price as double) as base_price, currency, valid_from, valid_to"""


def _product_dimension(history: str) -> str:
    return f"""
    select {_VERSION_COLUMNS}, valid_to is null as is_current from ({history})
    union all
    select -1, 'Unknown / Unmatched Product', 'Unknown', null, null, null, null, null, true"""


def _null(model: str, source: str, column: str) -> str:
    return f"""select '{model}' as model, '{column}' as column_name, 'not_null' as test,
        'error' as severity, count(*) as failures from {source} where {column} is null"""


def _twice(model: str, source: str, column: str) -> str:
    return f"""select '{model}', '{column}', 'unique', 'error', count(*) from
        (select {column} from {source} where {column} is not null
         group by 1 having count(*) > 1)"""


def _versions_twice(label: str, where: str, *columns: str) -> str:
    return f"""select 'dim_products', '{label}', 'unique', 'error', count(*) from
        (select 1 from ({_product_dimension(_HISTORY)}) where {where}
         group by {", ".join(columns)} having count(*) > 1)"""


def _untrue(model: str, source: str, column: str) -> str:
    return f"""select '{model}', '{column}', 'always_true', 'warn', count(*) from {source}
        where not {column}"""


_DAYS = """(select unnest(generate_series(min(cast(order_date as date)),
    max(cast(order_date as date)), interval 1 day)) as date_day from raw_ord)"""
_PRODUCT_KEYS = "(select product_id from stg_prod union all select -1 as product_id)"

_TESTS = f"""
    select *, case when failures = 0 then 'pass' when severity = 'error' then 'fail'
                   else 'warn' end as status
    from (
    {_null("stg_customers", "stg_cust", "customer_id")}
    union all {_null("stg_customers", "stg_cust", "email")}
    union all {_twice("stg_customers", "stg_cust", "customer_id")}
    union all {_null("stg_orders", "stg_ord", "order_id")}
    union all {_null("stg_orders", "stg_ord", "customer_id")}
    union all {_null("stg_orders", "stg_ord", "is_valid_currency")}
    union all {_twice("stg_orders", "stg_ord", "order_id")}
    union all {_untrue("stg_orders", "stg_ord", "is_valid_currency")}
    union all {_null("stg_order_items", "stg_lines", "order_item_id")}
    union all {_null("stg_order_items", "stg_lines", "order_id")}
    union all {_null("stg_order_items", "stg_lines", "product_id")}
    union all {_twice("stg_order_items", "stg_lines", "order_item_id")}
    union all {_untrue("stg_order_items", "stg_lines", "is_valid_currency")}
    union all {_null("stg_products", "stg_prod", "product_id")}
    union all {_twice("stg_products", "stg_prod", "product_id")}
    union all {_null("stg_fx_rates", "stg_rates", "currency")}
    union all {_null("stg_fx_rates", "stg_rates", "rate_to_usd")}
    union all {_null("dim_customers", "stg_cust", "customer_id")}
    union all {_twice("dim_customers", "stg_cust", "customer_id")}
    union all {_null("dim_products", _PRODUCT_KEYS, "product_id")}
    union all {_versions_twice("product_id, valid_from", "true", "product_id", "valid_from")}
    union all {_versions_twice("product_id where is_current", "is_current and product_id is not null", "product_id")}
    union all {_null("dim_date", _DAYS, "date_day")}
    union all {_twice("dim_date", _DAYS, "date_day")}
    union all {_null("dim_time_of_day", "hours", "hour_of_day")}
    union all {_twice("dim_time_of_day", "hours", "hour_of_day")}
    union all {_null("fact_order_items", "fact", "order_item_id")}
    union all {_null("fact_order_items", "fact", "order_id")}
    union all {_null("fact_order_items", "fact", "customer_id")}
    union all {_null("fact_order_items", "fact", "product_id")}
    union all {_twice("fact_order_items", "fact", "order_item_id")}
    union all {_untrue("fact_order_items", "fact", "is_fx_convertible")}
    union all select 'fact_order_items', 'customer_id', 'relationship', 'error', count(*)
      from fact where customer_id not in (select customer_id from stg_cust)
    union all select 'fact_order_items', 'product_id', 'relationship', 'error', count(*)
      from fact where product_id not in (select product_id from {_PRODUCT_KEYS}))"""

_AFTER_TWO_LOADS = f"""
, usd_2 as ({_in_usd("stg_lines_2", "stg_ord")}), fact_2 as ({_fact_of("usd_2")})
"""


def _second_report(report: str) -> str:
    """A report over the fact after both loads."""
    return f"{_AFTER_TWO_LOADS} {report.replace('from fact', 'from fact_2')}"


_BODIES = {
    "raw_scan_typed": """select id, order_id, product_id, cast(quantity as bigint) as quantity,
        cast(unit_price as double) as unit_price, currency, _loaded_at from raw_lines""",
    "raw_contract": " union all ".join(
        f"""select '{table}' as table_name, '{column}' as column_name,
                   count_if({column} is null) as null_rows from {source}"""
        for table, source, columns in (
            ("raw_customers", "raw_cust", "id name email registration_date country"),
            (
                "raw_orders",
                "raw_ord",
                "id customer_id order_date total_amount currency status _loaded_at",
            ),
            (
                "raw_order_items",
                "raw_lines",
                "id order_id product_id quantity unit_price currency _loaded_at",
            ),
            ("raw_products", "raw_prod", "id name category base_price currency"),
            ("raw_fx_rates", "raw_fx", "base_currency quote_currency rate_date rate"),
        )
        for column in columns.split()
    ),
    "fx_json_flatten": """select base_currency, quote_currency, rate_date,
        cast(rate as double) as rate from raw_fx""",
    "assign_sequential_id": """
        select row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey,
               l_shipdate) as id, l_orderkey, cast(l_linenumber as bigint) as l_linenumber,
               l_partkey, l_suppkey, l_shipdate, l_quantity from lineitem""",
    "stamp_loaded_at": f"""
        select id, customer_id, order_date,
               case when id <= (select max(id) * 2 // 3 from raw_ord) then {_BATCH_1}
                    else {_BATCH_2} end as _loaded_at from raw_ord""",
    "batch_split_semi": """
        select id, order_id, product_id, cast(quantity as bigint) as quantity,
               cast(unit_price as double) as unit_price, currency, _loaded_at
        from raw_lines where order_id in
          (select id from raw_ord where id <= (select max(id) * 2 // 3 from raw_ord))""",
    "batch_split_orders": """
        select id, customer_id, order_date, cast(total_amount as double) as total_amount,
               currency, status, _loaded_at
        from raw_ord where id <= (select max(id) * 2 // 3 from raw_ord)""",
    "stg_customers": "select * from stg_cust",
    "stg_products": """select product_id, product_name, category, description,
        cast(base_price as double) as base_price, currency from stg_prod""",
    "stg_orders": """select order_id, customer_id, order_date,
        cast(total_amount as double) as total_amount, currency, is_valid_currency, status,
        _loaded_at from stg_ord""",
    "stg_order_items": f"select {_LINE_COLUMNS} from stg_lines",
    "stg_fx_rates": """select currency, rate_date, cast(rate_to_usd as double) as rate_to_usd
        from stg_rates""",
    "fx_asof_interval": """select order_item_id, currency, order_date,
        cast(rate_to_usd as double) as rate_to_usd from usd""",
    "fx_asof_ranked": """
        select u.order_item_id, u.currency, b.order_day,
               cast(b.rate_to_usd as double) as rate_to_usd,
               cast(b.is_future as bigint) as is_future, b.days_apart
        from usd u join (
          select currency, order_day, rate_to_usd, is_future, days_apart
          from (select n.currency, n.order_day, r.rate_to_usd,
                       case when r.rate_date <= n.order_day then 0 else 1 end as is_future,
                       abs(date_diff('day', n.order_day, r.rate_date)) as days_apart
                from (select distinct currency, cast(order_date as date) as order_day from usd) n
                join stg_rates r on r.currency = n.currency)
          qualify row_number() over (partition by currency, order_day
                                     order by is_future, days_apart) = 1) b
        on b.currency = u.currency and b.order_day = cast(u.order_date as date)""",
    "order_items_usd": f"""select {_USD_COLUMNS}
        from ({_in_usd("stray_lines", "stg_ord")})""",
    "order_items_usd_inner": f"""select {_USD_COLUMNS}
        from ({_in_usd("stray_lines", "stg_ord", "inner")})""",
    "fact_order_items": f"select {_FACT_COLUMNS} from fact",
    "fact_colocated": f"select {_FACT_COLUMNS} from fact",
    "fact_partition_pruned": f"""
        select order_date_day, count(*) as lines, cast(sum(quantity) as bigint) as units,
               {_money("sum(line_amount_usd)")} as revenue_usd
        from fact where order_date >= timestamp '1998-01-01'
          and order_date < timestamp '1998-04-01' group by 1""",
    "dim_customers": "select * from stg_cust",
    "dim_products": _product_dimension(_HISTORY),
    "dim_date": """
        select cast(s.d as date) as date_day, year(s.d) as year, quarter(s.d) as quarter,
               month(s.d) as month, monthname(s.d) as month_name, day(s.d) as day_of_month,
               isodow(s.d) % 7 as day_of_week_num, dayname(s.d) as day_of_week_name,
               isodow(s.d) >= 6 as is_weekend, count(o.id) as orders
        from (select unnest(generate_series(min(cast(order_date as date)),
                     max(cast(order_date as date)), interval 1 day)) as d from raw_ord) s
        left join raw_ord o on cast(o.order_date as date) = cast(s.d as date)
        group by s.d""",
    "dim_time_of_day": """
        select hour_of_day, day_part, day_part_sort, count(o.id) as orders
        from hours left join raw_ord o on hour(o.order_date) = hour_of_day group by all""",
    "orders_hourly": f"""
        select order_id, order_hour, max(customer_id) as customer_id,
               {_money(f"sum({_USD_IF})")} as order_revenue_usd
        from fact group by order_id, order_hour""",
    "rpt_top_products": _TOP,
    "top10_products": f"""select * from ({_TOP})
        order by rank_by_revenue, product_id limit 10""",
    "rank_lines_by_amount": """
        select order_item_id, cast(line_amount_native as double) as line_amount_native,
               cast(quantity as bigint) as quantity,
               rank() over (order by stg_lines.line_amount_native desc) as rank_by_amount,
               rank() over (order by stg_lines.quantity desc) as rank_by_quantity
        from stg_lines""",
    "rpt_promo_time_of_day": _PROMO,
    "rpt_promo_line_grain": f"""
        select h.hour_of_day, h.day_part, count(distinct f.order_id) as order_count,
               {_money(f"sum({_USD_IF})")} as revenue_usd,
               rank() over (order by count(distinct f.order_id) desc) as rank_by_order_count
        from hours h left join fact f on f.order_hour = h.hour_of_day
        group by h.hour_of_day, h.day_part""",
    "promo_purchase_events": _promo(
        """select event_id as order_id, hour(ts) as order_hour,
           case when event_type = 'purchase' then cast(value as decimal(18,2)) end as usd
           from events"""
    ),
    "rpt_dq_exceptions": f"""
        select order_item_id, order_id, order_date, product_id, currency,
               cast(line_amount_native as double) as line_amount_native,
               not is_valid_currency as flag_invalid_currency_code,
               is_unknown_product as flag_product_id_not_in_catalogue,
               not is_fx_convertible as flag_fx_conversion_failed,
               {_REASONS} as exception_reasons
        from fact where {_EXCEPTION}""",
    "export_dq_exceptions": f"""
        select order_item_id, order_id, order_date, product_id, currency,
               cast(line_amount_native as double) as line_amount_native,
               not is_valid_currency as flag_invalid_currency_code,
               is_unknown_product as flag_product_id_not_in_catalogue,
               {_REASONS} as exception_reasons
        from fact where {_EXCEPTION}""",
    "export_top_products": f"""
        select product_id, product_name, category, units_sold, revenue_usd, rank_by_volume,
               rank_by_revenue
        from ({_TOP})""",
    "export_promo": f"""
        select hour_of_day, day_part, order_count, revenue_usd from ({_PROMO})""",
    "export_kpis": f"""
        select total_revenue_usd, total_units, total_orders, dq_exceptions, total_lines
        from ({_KPIS})""",
    "kpis_summary": _KPIS,
    "high_water_mark": """
        select max(_loaded_at) as high_water_mark, 'loaded' as target from raw_lines
        union all select timestamp '1900-01-01', 'empty'""",
    "incremental_delta": f"select {_LINE_COLUMNS} from stg_lines where _loaded_at > {_BATCH_1}",
    "fact_incremental": f"{_AFTER_TWO_LOADS} select {_FACT_COLUMNS} from fact_2",
    "fact_merge": f"""{_AFTER_TWO_LOADS}, merged as (
        select new.order_item_id, old.order_item_id is not null and new._loaded_at > old._loaded_at
                 as updated, new.order_id, new.customer_id, new.product_id, new.order_date,
               new.order_date_day, new.order_hour, new.quantity, new.unit_price,
               case when updated then old.currency else new.currency end as currency,
               case when updated then old.is_valid_currency else new.is_valid_currency end
                 as is_valid_currency,
               case when updated then old.line_amount_native else new.line_amount_native end
                 as line_amount_native,
               case when updated then old.rate_to_usd else new.rate_to_usd end as rate_to_usd,
               new.line_amount_usd, new.is_fx_convertible, new.is_unknown_product,
               new._loaded_at
        from fact_2 new
        left join (select * from fact where _loaded_at = {_BATCH_1}) old
          on old.order_item_id = new.order_item_id)
        select {_FACT_COLUMNS} from merged""",
    "fact_corrected": f""", dearest as (
        select order_item_id as id from fact
        order by line_amount_native desc nulls last, order_item_id limit 100),
    corrected as (
        select fact.* replace (quantity + case when id is null then 0 else 1 end as quantity)
        from fact left join dearest on id = order_item_id)
        select {_FACT_COLUMNS} from corrected""",
    "fact_rerated": f"select {_FACT_COLUMNS} from fact",
    "kept_top_products": _second_report(_TOP),
    "kept_promo_time_of_day": _second_report(_PROMO),
    "kept_kpis": _second_report(_KPIS),
    "schema_sync": f"""
        select order_item_id, order_id, product_id, cast(quantity as bigint) as quantity,
               cast(unit_price as double) as unit_price, currency, is_valid_currency,
               case when _loaded_at > {_BATCH_1} then cast(line_amount_native as double) end
                 as line_amount_native, _loaded_at
        from stg_lines""",
    "scd2_snapshot": f"select {_VERSION_COLUMNS} from ({_HISTORY})",
    "scd2_from_native": _product_dimension(_NATIVE),
    "pit_product_join": f"""
        select l.order_item_id, l.product_id, o.order_date,
               cast(l.unit_price as double) as unit_price,
               cast(v.base_price as double) as list_price, v.valid_from as version_from
        from stg_lines l join stg_ord o on o.order_id = l.order_id
        asof left join ({_NATIVE}) v
          on v.product_id = l.product_id and v.valid_from <= o.order_date""",
    "dq_tests": _TESTS,
    "dq_rate_anomaly": f"""
        select order_date_day, lines, exceptions, round(rate, 8) as exception_rate,
               round(usual, 8) as usual_rate, round(spread, 8) as usual_deviation,
               rate > 0.5 as is_over_limit,
               coalesce(abs(rate - usual) > 3 * spread, false) as is_unusual
        from (select *, avg(rate) over w as usual, stddev(rate) over w as spread
              from (select order_date_day, count(*) as lines,
                           count(*) filter ({_EXCEPTION}) as exceptions,
                           exceptions / lines as rate
                    from fact group by 1)
              window w as (order by order_date_day rows between 28 preceding and 1 preceding))""",
    "reconcile_totals": f"""
        select cast(w.units as bigint) as fact_units, cast(w.lost as bigint) as unknown_units,
               {_money("w.usd")} as fact_revenue_usd,
               {_money("w.lost_usd")} as unknown_revenue_usd,
               cast(r.units as bigint) as reported_units,
               {_money("r.usd")} as reported_revenue_usd,
               w.units = r.units + w.lost and w.usd = r.usd + w.lost_usd as is_reconciled
        from (select sum(quantity) as units, sum({_USD_IF}) as usd,
                     coalesce(sum(quantity) filter (product_id = -1), 0) as lost,
                     coalesce(sum({_USD_IF}) filter (product_id = -1), 0) as lost_usd
              from fact) w,
             (select sum(f.quantity) as units, sum({_USD_IF}) as usd
              from fact f join raw_prod p on p.id = f.product_id) r""",
    "unknown_product_bucket": f"""
        select currency, count(*) as lines, cast(sum(quantity) as bigint) as units,
               {_money("sum(line_amount_usd)")} as revenue_usd
        from fact where product_id = -1 group by currency""",
    "landing_latest_by_key": f"""
        select product_id, cast(price as double) as price, changed_at, change_id,
               last_day(changed_at) as extracted_at, last_day(changed_at) as extract_date
        from (select l_partkey as product_id, cast(l_extendedprice as decimal(10,2)) as price,
                     l_shipdate as changed_at, {_LINE_ID} as change_id from lineitem)
        qualify row_number() over (partition by product_id
                                   order by changed_at desc, change_id desc) = 1""",
    "latest_stream_state": f"""
        select product_id, cast(price as double) as price, changed_at, change_id,
               last_day(changed_at) as extracted_at
        from (select l_partkey as product_id, cast(l_extendedprice as decimal(10,2)) as price,
                     l_shipdate as changed_at, {_LINE_ID} as change_id from lineitem)
        qualify row_number() over (partition by product_id
                                   order by changed_at desc, change_id desc) = 1""",
    "stream_fact_upsert": f"{_AFTER_TWO_LOADS} select {_FACT_COLUMNS} from fact_2",
}

ORACLE_SQL = {name: f"{_COMMON} {body}" for name, body in _BODIES.items()}
