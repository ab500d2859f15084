"""SQL that DuckDB runs on the same tables, one text per query of the catalog."""

from __future__ import annotations

from starmart.bindings import extended
from starmart.bindings.raw import raw_sql
from starmart.operators.quality import SPECS, QualitySpec

ORDERS_MARK = "timestamp '1998-01-01 00:00:00'"
START = "timestamp '1900-01-01 00:00:00'"
FUTURE = "timestamp '2100-01-01 00:00:00'"


def _raw(name: str) -> str:
    return f"({raw_sql(name)})"


def _money(expression: str) -> str:
    return f"cast(sum(cast({expression} as decimal(18,2))) as double)"


def _weekend(at: str) -> str:
    return f"case when dayofweek({at}) in (0, 6) then 1 else 0 end"


def _bucket(value: str) -> str:
    return (
        f"case when {value} < 50 then '0-50' when {value} < 100 then '50-100' "
        f"when {value} < 500 then '100-500' else '500+' end"
    )


def _region(state: str) -> str:
    return (
        f"case when {state} in ('SP','RJ','MG','ES') then 'Southeast' "
        f"when {state} in ('PR','RS','SC') then 'South' else 'Other' end"
    )


def _weight(kg: str) -> str:
    return f"case when {kg} < 1 then 'Light' when {kg} < 5 then 'Medium' else 'Heavy' end"


def _size(volume: str) -> str:
    return f"case when {volume} < 5000 then 'Small' when {volume} < 20000 then 'Medium' else 'Large' end"


def _kg(grams: str) -> str:
    return f"cast(round(cast({grams} / 1000 as decimal(18,6)), 3) as double)"


_VOLUME = "product_length_cm * product_height_cm * product_width_cm"
_TOTAL = "cast(cast(price as decimal(18,2)) + cast(freight_value as decimal(18,2)) as double)"
_SENTIMENT = (
    "case when review_score >= 4 then 'positive' when review_score = 3 then 'neutral' "
    "else 'negative' end"
)



def _orders(mark: str) -> str:
    return f"""
        select order_id, customer_id, order_status, purchase_ts, approved_ts,
            delivered_carrier_ts, delivered_customer_ts, estimated_delivery_ts,
            cast(year(purchase_ts) as int) as year, cast(month(purchase_ts) as int) as month,
            cast(quarter(purchase_ts) as int) as quarter, cast(day(purchase_ts) as int) as day,
            cast(date_diff('day', purchase_ts, delivered_customer_ts) as int) as delivery_days,
            case when delivered_customer_ts > estimated_delivery_ts then 1 else 0 end as is_late
        from (
            select order_id, customer_id, order_status,
                try_cast(order_purchase_timestamp as timestamp) as purchase_ts,
                try_cast(order_approved_at as timestamp) as approved_ts,
                try_cast(order_delivered_carrier_date as timestamp) as delivered_carrier_ts,
                try_cast(order_delivered_customer_date as timestamp) as delivered_customer_ts,
                try_cast(order_estimated_delivery_date as timestamp) as estimated_delivery_ts
            from (select distinct * from {_raw('orders')})
            where order_id is not null and customer_id is not null and order_status is not null
        )
        where purchase_ts > {mark}
            and (delivered_customer_ts is null
                or date_diff('day', purchase_ts, delivered_customer_ts) >= 0)"""


SILVER = {
    "orders": _orders(START),
    "order_items": f"""
        select order_id, order_item_id, product_id, seller_id,
            try_cast(shipping_limit_date as timestamp) as shipping_limit_ts, price, freight_value,
            {_TOTAL} as total_item_value, round(freight_value / price, 4) as shipping_ratio
        from (select distinct * from {_raw('order_items')})
        where order_id is not null and product_id is not null and seller_id is not null
            and price > 0 and freight_value >= 0""",
    "payments": f"""
        select order_id, payment_sequential, lower(trim(payment_type)) as payment_type,
            payment_installments, payment_value,
            case when payment_installments > 1 then 1 else 0 end as is_installment,
            {_bucket('payment_value')} as payment_bucket
        from (select distinct * from {_raw('payments')})
        where order_id is not null and payment_value > 0""",
    "reviews": f"""
        select review_id, order_id, review_score,
            try_cast(review_creation_date as timestamp) as review_creation_ts,
            try_cast(review_answer_timestamp as timestamp) as review_answer_ts,
            review_comment_title, review_comment_message, {_SENTIMENT} as sentiment,
            case when length(trim(coalesce(review_comment_message, ''))) > 0 then 1 else 0 end
                as has_comment
        from (select distinct * from {_raw('reviews')})
        where review_id is not null and order_id is not null and review_score between 1 and 5""",
    "customers": f"""
        select customer_id, customer_unique_id, customer_zip_code_prefix,
            lower(trim(customer_city)) as customer_city, upper(trim(customer_state)) as customer_state
        from (select distinct * from {_raw('customers')})
        where customer_id is not null and customer_unique_id is not null""",
    "sellers": f"""
        select seller_id, seller_zip_code_prefix, lower(trim(seller_city)) as seller_city,
            upper(trim(seller_state)) as seller_state
        from (select distinct * from {_raw('sellers')})
        where seller_id is not null""",
    "products": f"""
        select product_id, lower(trim(product_category_name)) as product_category_name,
            product_name_lenght, product_description_lenght, product_photos_qty, product_weight_g,
            {_kg('product_weight_g')} as weight_kg, product_length_cm, product_height_cm,
            product_width_cm, {_VOLUME} as product_volume_cm3
        from (select distinct * from {_raw('products')})
        where product_id is not null""",
    "geolocation": f"""
        select zip as geolocation_zip_code_prefix, city as geolocation_city,
            state as geolocation_state, avg(geolocation_lat) as avg_lat,
            avg(geolocation_lng) as avg_lng, concat_ws('_', zip, state) as location_key
        from (
            select geolocation_zip_code_prefix as zip, lower(trim(geolocation_city)) as city,
                upper(trim(geolocation_state)) as state, geolocation_lat, geolocation_lng
            from {_raw('geolocation')}
            where geolocation_zip_code_prefix is not null and geolocation_lat is not null
                and geolocation_lng is not null
        )
        group by zip, city, state""",
    "category_translation": f"""
        select lower(trim(product_category_name)) as product_category_name,
            lower(trim(product_category_name_english)) as product_category_name_english
        from (select distinct * from {_raw('category_translation')})
        where product_category_name is not null and product_category_name_english is not null""",
}


def _silver(name: str) -> str:
    return f"({SILVER[name]})"


def _key(order_by: str) -> str:
    """Keys count buckets of the digest of the business key first, then the business key."""
    text = f"coalesce(cast({order_by} as varchar), '')"
    return f"row_number() over (order by md5({text})[1:2], {order_by}) - 1"


_DIM_CUSTOMER = f"""
    select {_key('customer_id')} as customer_key, customer_id, customer_unique_id, customer_city,
        customer_state, {_region('customer_state')} as customer_region
    from {_silver('customers')}"""

_DIM_PRODUCT = f"""
    select {_key('product_id')} as product_key, product_id, product_category_name,
        product_category_name_english, product_name_lenght, product_description_lenght,
        product_photos_qty, weight_kg, {_weight('weight_kg')} as weight_category,
        product_volume_cm3, {_size('product_volume_cm3')} as product_size_category
    from {_silver('products')} left join {_silver('category_translation')}
        using (product_category_name)"""

_DIM_SELLER = f"""
    select {_key('seller_id')} as seller_key, seller_id, seller_city, seller_state,
        {_region('seller_state')} as seller_region
    from {_silver('sellers')}"""


def _dim_date(source: str) -> str:
    return f"""
    select cast(strftime(full_date, '%Y%m%d') as bigint) as date_key, full_date,
        cast(year(full_date) as int) as year, cast(quarter(full_date) as int) as quarter,
        cast(month(full_date) as int) as month, cast(day(full_date) as int) as day,
        monthname(full_date) as month_name, dayname(full_date) as day_of_week,
        {_weekend('full_date')} as is_weekend
    from (select distinct cast(purchase_ts as date) as full_date from {source})"""


_FACT = f"""
    with orders_s as {_silver('orders')},
    dim_c as ({_DIM_CUSTOMER}),
    dim_p as ({_DIM_PRODUCT}),
    dim_s as ({_DIM_SELLER}),
    dim_d as ({_dim_date('orders_s')}),
    paid as (
        select order_id, {_money('payment_value')} as payment_value
        from {_silver('payments')} group by order_id
    ),
    scored as (
        select order_id, avg(review_score) as review_score from {_silver('reviews')} group by order_id
    )
    select customer_key, product_key, seller_key, date_key, i.order_id, order_item_id, price,
        freight_value, payment_value, review_score, delivery_days, is_late
    from {_silver('order_items')} i
        left join orders_s o on i.order_id = o.order_id
        left join paid p on i.order_id = p.order_id
        left join scored r on i.order_id = r.order_id
        left join dim_c on o.customer_id = dim_c.customer_id
        left join dim_p on i.product_id = dim_p.product_id
        left join dim_s on i.seller_id = dim_s.seller_id
        left join dim_d on cast(o.purchase_ts as date) = dim_d.full_date"""

_SIGN = "(case when l_returnflag = 'A' then -1 else 1 end)"
_LINES = (
    f"select l_orderkey * {_SIGN} as order_id, l_linenumber as order_item_id, "
    f"l_partkey * {_SIGN} as product_id, l_suppkey * {_SIGN} as seller_id, "
    "l_extendedprice as price from lineitem"
)
_ALL_ORDERS = (
    "select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as purchase_ts from orders"
)
_ORDERS_WITH_NULLS = (
    "select o_orderkey, nullif(o_orderstatus, 'P') as status, "
    "nullif(o_orderpriority, '5-LOW') as priority from orders"
)
_DELIVERIES = (
    "select o_orderkey, o_orderdate as purchase_ts, o_orderdate + interval '60' day as estimated_ts, "
    "delivered_ts from orders left join (select l_orderkey, max(l_shipdate) as delivered_ts "
    "from lineitem group by l_orderkey) on o_orderkey = l_orderkey"
)
_MONTHLY = (
    "select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, "
    f"{_money('o_totalprice')} as revenue from orders group by 1, 2"
)
_ORDER_BATCH = (
    "select distinct * from (select order_id, customer_id, order_status, "
    "order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, "
    "order_delivered_customer_date, order_estimated_delivery_date, "
    f"try_cast(order_purchase_timestamp as timestamp) as purchase_ts from {_raw('orders')} "
    "where order_status is not null)"
)


def _marks(orders: str, reviews: str) -> str:
    return (
        f"select 'orders' as table_name, {orders} as last_processed_ts "
        f"union all select 'reviews', {reviews} union all select 'order_items', {START}"
    )


def _loaded(orders: str, rows: str) -> str:
    return f"select *, {rows} as rows_loaded from ({_marks(orders, START)})"


def _report(name: str, spec: QualitySpec) -> str:
    """Every metric as its own count over the raw table."""
    raw = _raw(name)
    parts = [f"select 'row_count' as metric_name, count(*) as metric_value from {raw}"]
    for column in spec.critical:
        parts.append(f"select 'null_{column}', count(*) from {raw} where {column} is null")
    keys = ", ".join(spec.key)
    parts.append(
        f"select '{spec.duplicate_metric}', count(*) from "
        f"(select {keys} from {raw} group by {keys} having count(*) > 1)"
    )
    return " union all ".join(parts)


def _draw(seed: int, salt: int, size: int) -> str:
    mixed = f"((o_orderkey % 2147483647) * 48271 + {seed * 7919 + salt * 104729}) % 2147483647"
    return f"cast(((({mixed}) * 16807 + {salt}) % 2147483647) % {size} as int)"


_SYNTH = f"""
    select 'order_' || lpad(cast(o_orderkey as varchar),
            greatest(5, length(cast(o_orderkey as varchar)))::int, '0') as order_id,
        'customer_' || lpad(cast(o_orderkey % 100 as varchar), 4, '0') as customer_id,
        'product_' || lpad(cast(o_orderkey % 50 as varchar), 3, '0') as product_id,
        (['electronics','furniture','toys','fashion','food'])[{_draw(1, 1, 5)} + 1] as category,
        ({_draw(1, 2, 48001)} + 2000) / 100.0::double as price,
        {_draw(1, 3, 30)} + 1 as delivery_days,
        {_draw(1, 4, 5)} + 1 as review_score,
        2018 as year,
        {_draw(1, 5, 12)} + 1 as month,
        (['SP','RJ','MG','RS','PR'])[{_draw(1, 6, 5)} + 1] as customer_state
    from orders"""

ORACLE = {
    "src_csv_roundtrip": "select * from documents",
    "synth_orders": _SYNTH,
    "sink_parquet_overwrite": "select * from orders",
    "sink_partitioned_append": (
        "select *, cast(year(o_orderdate) as int) as year, "
        "cast(month(o_orderdate) as int) as month from orders"
    ),
    "sink_append": "select * from events union all select * from events",
    "sink_csv_report": _MONTHLY,
    "obs_row_counts": (
        f"select 'orders_before' as step, count(*) as rows from ({_ORDER_BATCH}) "
        f"union all select 'orders_after', count(*) from ({_orders(ORDERS_MARK)})"
    ),
    "top_n_preview": "select * from orders order by o_orderkey limit 5",
    "clean_exact_distinct": (
        "select distinct * from (select * from lineitem "
        "union all select * from lineitem where l_returnflag = 'R')"
    ),
    "clean_required_keys": (
        f"select * from ({_ORDERS_WITH_NULLS}) where status is not null and priority is not null"
    ),
    "clean_not_null": f"select * from ({_ORDERS_WITH_NULLS}) where status is not null",
    "clean_positive": (
        "select * from (select l_orderkey, l_linenumber, l_quantity - 10 as price, "
        "nullif(l_discount, 0.1::double) - 0.05::double as freight from lineitem) "
        "where price > 0 and freight >= 0"
    ),
    "clean_between": (
        "select event_id, cast(floor(value / 20) as int) as score from events "
        "where event_type <> 'error' and floor(value / 20) between 1 and 5"
    ),
    "clean_null_or_nonneg": (
        "select * from (select o_orderkey, case o_orderstatus when 'O' then null "
        "else cast(floor(o_totalprice / 6000) as int) - 30 end as delivery_days from orders) "
        "where delivery_days is null or delivery_days >= 0"
    ),
    "std_trim_lower": "select p_partkey, lower(p_name) as name from part",
    "std_trim_upper": "select c_custkey, upper(c_mktsegment) as segment from customer",
    "std_parse_ts": (
        "select o_orderkey, try_cast(case o_orderpriority when '5-LOW' then 'n/a' "
        "else cast(o_orderdate as varchar) end as timestamp) as purchase_ts from orders"
    ),
    "feat_location_key": (
        "select c_custkey, '0' || c_nationkey || case when c_mktsegment = 'MACHINERY' then '' "
        "else '_' || c_mktsegment end as location_key from customer"
    ),
    "feat_has_comment": (
        "select conv_id, turn, case when turn > 1 and length(trim(text)) > 0 then 1 else 0 end "
        "as has_comment from conversations"
    ),
    "feat_calendar_parts": (
        "select o_orderkey, cast(year(o_orderdate) as int) as year, "
        "cast(month(o_orderdate) as int) as month, cast(quarter(o_orderdate) as int) as quarter, "
        "cast(day(o_orderdate) as int) as day from orders"
    ),
    "feat_delivery_days": (
        "select o_orderkey, cast(date_diff('day', purchase_ts, delivered_ts) as int) "
        f"as delivery_days from ({_DELIVERIES})"
    ),
    "feat_is_late": (
        "select o_orderkey, case when delivered_ts > estimated_ts then 1 else 0 end as is_late "
        f"from ({_DELIVERIES})"
    ),
    "feat_total_value": (
        f"select order_id, order_item_id, price, {_TOTAL} as total_item_value "
        f"from {_raw('order_items')}"
    ),
    "feat_ratio": (
        "select l_orderkey, l_linenumber, round(l_tax / l_extendedprice, 4) as shipping_ratio "
        "from lineitem"
    ),
    "feat_threshold_flag": (
        "select order_id, payment_sequential, "
        f"case when payment_installments > 1 then 1 else 0 end as is_installment from {_raw('payments')}"
    ),
    "feat_value_bucket": (
        f"select order_id, payment_sequential, {_bucket('payment_value')} as payment_bucket "
        f"from {_raw('payments')}"
    ),
    "feat_weight_kg": (
        f"select product_id, {_kg('product_weight_g')} as weight_kg from {_raw('products')}"
    ),
    "feat_volume": f"select product_id, {_VOLUME} as product_volume_cm3 from {_raw('products')}",
    "feat_weight_class": (
        f"select product_id, {_weight('product_weight_g / 1000')} as weight_category "
        f"from {_raw('products')}"
    ),
    "feat_size_class": (
        f"select product_id, {_size(_VOLUME)} as product_size_category from {_raw('products')}"
    ),
    "feat_sentiment": (
        f"select review_id, {_SENTIMENT} as sentiment from {_raw('reviews')}"
    ),
    "feat_region": (
        f"select customer_id, {_region('upper(trim(customer_state))')} as customer_region "
        f"from {_raw('customers')}"
    ),
    "feat_date_key": (
        "select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as bigint) as date_key from orders"
    ),
    "feat_date_names": (
        "select o_orderkey, monthname(o_orderdate) as month_name, "
        "dayname(o_orderdate) as day_of_week from orders"
    ),
    "feat_weekend": f"select o_orderkey, {_weekend('o_orderdate')} as is_weekend from orders",
    "key_surrogate": f"select {_key('c_name')} as customer_key, c_name, c_custkey from customer",
    "agg_geo_centroid": (
        "select s_nationkey, avg(floor(s_acctbal)) as avg_lat, avg(s_suppkey) as avg_lng "
        "from supplier group by s_nationkey"
    ),
    "agg_payments_by_order": (
        f"select order_id, {_money('payment_value')} as payment_value "
        f"from {_raw('payments')} group by order_id"
    ),
    "agg_score_by_order": (
        f"select order_id, avg(review_score) as review_score from {_raw('reviews')} group by order_id"
    ),
    "agg_monthly_revenue": f"{_MONTHLY} order by 1, 2",
    "join_category": (
        "select product_id, product_category_name, product_category_name_english "
        f"from {_silver('products')} left join {_silver('category_translation')} "
        "using (product_category_name)"
    ),
    "join_items_orders": f"select * from ({_LINES}) left join ({_ALL_ORDERS}) using (order_id)",
    "join_payments": (
        f"select * from ({_LINES}) left join (select l_orderkey as order_id, "
        f"{_money('l_extendedprice')} as payment_value from lineitem group by 1) using (order_id)"
    ),
    "join_reviews": (
        f"select * from ({_LINES}) left join (select order_id, avg(review_score) as review_score "
        f"from {_raw('reviews')} group by order_id) using (order_id)"
    ),
    "join_dim_customer": (
        "select order_id, customer_id, customer_key from (select o_orderkey as order_id, o_custkey * "
        "(case when o_orderstatus = 'P' then -1 else 1 end) as customer_id from orders) left join "
        f"(select c_custkey as customer_id, {_key('c_custkey')} as customer_key from customer) "
        "using (customer_id)"
    ),
    "join_dim_product": (
        f"select * from ({_LINES}) left join (select p_partkey as product_id, "
        f"{_key('p_partkey')} as product_key from part) using (product_id)"
    ),
    "join_dim_seller": (
        f"select * from ({_LINES}) left join (select s_suppkey as seller_id, "
        f"{_key('s_suppkey')} as seller_key from supplier) using (seller_id)"
    ),
    "join_dim_date": (
        "select order_id, full_date, date_key from (select o_orderkey as order_id, "
        "case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as full_date from orders) "
        f"left join ({_dim_date(f'({_ALL_ORDERS})')}) using (full_date)"
    ),
    "inc_hwm_filter": f"select * from orders where o_orderdate > {ORDERS_MARK}",
    "inc_new_hwm": _loaded(
        f"(select max(purchase_ts) from ({_ORDER_BATCH}) where purchase_ts > {ORDERS_MARK})",
        f"(select count(*) from ({_orders(ORDERS_MARK)}))",
    ),
    "inc_empty_batch": _loaded(
        FUTURE, f"(select count(*) from ({_ORDER_BATCH}) where purchase_ts > {FUTURE})"
    ),
    "ctl_init": (
        f"select 'orders' as table_name, {START} as last_processed_ts, count(*) as pending_rows "
        f"from orders where o_orderdate > {START} union all "
        f"select 'reviews', {START}, count(*) from events where ts > {START} union all "
        f"select 'order_items', {START}, count(*) from lineitem where l_shipdate > {START}"
    ),
    "ctl_set_mark": _marks("(select max(o_orderdate) from orders)", START),
    "ctl_lookup": "select max(ts) as last_processed_ts from events",
    "ctl_update_mark": _marks(
        "(select max(o_orderdate) from orders)", "(select max(ts) from events)"
    ),
    "dq_row_count": "select count(*) as row_count from lineitem",
    "dq_null_counts": (
        "select count(*) - count(o_orderkey) as null_o_orderkey, "
        "count(*) - count(status) as null_status, count(*) - count(priority) as null_priority "
        f"from ({_ORDERS_WITH_NULLS})"
    ),
    "dq_duplicate_keys": (
        'select l_orderkey, l_linenumber, count(*) as "count" from lineitem '
        "group by l_orderkey, l_linenumber having count(*) > 1"
    ),
    "dq_report": _report("orders", SPECS["orders"]),
    "dq_report_all": " union all ".join(
        f"select '{name}' as table_name, * from ({_report(name, spec)})"
        for name, spec in SPECS.items()
    ),
    "silver_orders": _orders(ORDERS_MARK),
    "silver_order_items": SILVER["order_items"],
    "silver_payments": SILVER["payments"],
    "silver_reviews": SILVER["reviews"],
    "silver_customers": SILVER["customers"],
    "silver_sellers": SILVER["sellers"],
    "silver_products": SILVER["products"],
    "silver_geolocation": SILVER["geolocation"],
    "silver_category": SILVER["category_translation"],
    "dim_customer": _DIM_CUSTOMER,
    "dim_product": _DIM_PRODUCT,
    "dim_seller": _DIM_SELLER,
    "dim_date": _dim_date(_silver("orders")),
    "dim_location": (
        "select location_key, geolocation_zip_code_prefix as zip_code, geolocation_city as city, "
        "geolocation_state as state, avg_lat as latitude, avg_lng as longitude "
        f"from {_silver('geolocation')}"
    ),
    "fact_sales": _FACT,
}

extended.register_all()
ORACLE.update(extended.EXTENDED_SQL)
