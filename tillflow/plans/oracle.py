"""The registered queries in ANSI SQL, for checking against another engine."""

from __future__ import annotations

import re

from tillflow.schemas import ENTITIES, WIRE

RUN = "timestamp '2026-01-01 00:00:00'"


def _round2(x: str) -> str:
    """Half-up rounding of the shortest decimal text, as Spark rounds a double."""
    return f"cast(cast(cast({x} as varchar) as decimal(38,2)) as double)"


def _total(x: str) -> str:
    return f"cast(sum(cast({x} as decimal(18,2))) as double)"


def _parts(time: str, prefix: str) -> str:
    return ", ".join(
        f"cast(extract({part} from {time}) as integer) as {prefix}_{part}" for part in ("year", "month", "day")
    )


DAY = "purchase_date, purchase_year, purchase_month, purchase_day"

# Every common table expression by name; a query gets those it mentions, in this order.
CTES = {
    "feed_clickstream": """
        select case when event_id % 71 = 0 then ' ' else cast(user_id as varchar) end as user_id,
               case when event_id % 59 = 0 then 'bad-ts' else cast(ts as varchar) end as "timestamp",
               ' https://shop.example.com/p/' || json_extract_string(props, '$.k') || ' ' as page_url,
               case when event_id % 61 = 0 then null when event_type = 'view' then ' page_view'
                    when event_type = 'signup' then 'add_to_cart ' when event_type = 'error' then 'scroll'
                    else event_type end as event_type,
               cast(1000 + cast(json_extract_string(props, '$.k') as integer) as integer) as product_id,
               cast(user_id as varchar) || '-' || cast(cast(ts as date) as varchar) as session_id,
               event_id
        from events""",
    "feed_purchases": """
        select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as order_id,
               case when o_custkey % 3 = 0 then '1'
                    when o_custkey % 5 = 0 and not (l_linenumber = 7 and l_quantity <= 12) then 'guest'
                    else cast(o_custkey as varchar) end as user_id,
               case when l_orderkey % 83 = 0 then null else cast(o_orderdate as varchar) end as "timestamp",
               cast(l_partkey as integer) as product_id,
               case when l_partkey % 89 = 0 then 0 when l_partkey % 97 = 0 then null
                    else cast(l_quantity as integer) end as quantity,
               case when l_suppkey % 47 = 0 then -p_retailprice else p_retailprice end as price,
               l_shipdate, l_partkey, l_suppkey, l_extendedprice
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "feed_customers": """
        select cast(c_custkey as varchar) as customer_id,
               case when c_custkey % 101 = 0 then '  ' else ' ' || c_name || ' ' end as name,
               case when c_custkey % 53 = 0 then null when c_custkey % 41 = 0 then 'not-an-email'
                    when c_custkey % 37 = 0 then 'a@b.museums'
                    else ' ' || replace(c_name, '#', '.') || '@' || c_mktsegment || '.Example.COM ' end as email,
               ' ' || lower(n_name) as country,
               cast(date '1994-01-01' + cast(c_custkey % 365 as integer) as varchar) as signup_date
        from customer join nation on c_nationkey = n_nationkey""",
    "bronze_clickstream": """
        select user_id, try_cast("timestamp" as timestamp) as "timestamp", trim(page_url) as page_url,
               trim(event_type) as event_type, product_id, session_id, event_id from feed_clickstream""",
    "bronze_purchases": """
        select order_id, user_id, try_cast("timestamp" as timestamp) as "timestamp", product_id, quantity, price
        from feed_purchases""",
    "bronze_customers": """
        select customer_id, name, email, country, try_cast(signup_date as timestamp) as signup_date
        from feed_customers""",
    "clean_clickstream": """
        select trim(user_id) as user_id, try_cast("timestamp" as timestamp) as "timestamp",
               trim(page_url) as page_url, upper(trim(event_type)) as event_type, product_id,
               trim(session_id) as session_id from feed_clickstream""",
    "clean_purchases": """
        select trim(order_id) as order_id, trim(user_id) as user_id,
               try_cast("timestamp" as timestamp) as "timestamp", product_id, quantity, price from feed_purchases""",
    "clean_customers": """
        select trim(customer_id) as customer_id, trim(name) as name, lower(trim(email)) as email,
               upper(trim(country)) as country, try_cast(signup_date as timestamp) as signup_date
        from feed_customers""",
    "judged_clickstream": """
        select *, case when user_id is null or user_id = '' then 'user_id missing'
                       when "timestamp" is null then 'timestamp missing'
                       when event_type is null or event_type = '' then 'event_type missing' end as failed_rule
        from clean_clickstream""",
    "judged_purchases": """
        select *, case when order_id is null or order_id = '' then 'order_id missing'
                       when user_id is null or user_id = '' then 'user_id missing'
                       when "timestamp" is null then 'timestamp missing'
                       when quantity <= 0 then 'quantity not positive'
                       when price < 0 then 'price negative' end as failed_rule
        from clean_purchases""",
    "judged_customers": """
        select *, case when customer_id is null or customer_id = '' then 'customer_id missing'
                       when name is null or name = '' then 'name missing'
                       when email is null or email = '' then 'email missing'
                       when not regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,6}$')
                       then 'email malformed' end as failed_rule
        from clean_customers""",
    "silver_clickstream": f"""
        select user_id, "timestamp", page_url, event_type, product_id, session_id,
               {RUN} as processed_timestamp, strftime("timestamp", '%Y-%m-%d') as event_date,
               cast(extract(hour from "timestamp") as integer) as event_hour, {_parts('"timestamp"', 'event')},
               'batch_csv' as data_source
        from judged_clickstream where failed_rule is null""",
    "silver_purchases": f"""
        select order_id, user_id, "timestamp", product_id, quantity, {_round2('price')} as unit_price,
               {_round2('quantity * price')} as total_amount, {RUN} as processed_timestamp,
               strftime("timestamp", '%Y-%m-%d') as purchase_date,
               cast(extract(hour from "timestamp") as integer) as purchase_hour, {_parts('"timestamp"', 'purchase')},
               'batch_csv' as data_source
        from judged_purchases where failed_rule is null""",
    "silver_customers": f"""
        select customer_id, name, email, country, signup_date, {RUN} as processed_timestamp,
               {_parts('signup_date', 'signup')}, list_last(string_split(email, '@')) as email_domain,
               'batch_csv' as data_source
        from judged_customers where failed_rule is null""",
    "stg_clickstream": f"""
        select user_id, "timestamp" as event_timestamp, page_url, event_type, product_id, session_id,
               processed_timestamp, cast(event_date as date) as event_date, event_hour, event_year, event_month,
               event_day, data_source, {RUN} as loaded_at from silver_clickstream where user_id is not null""",
    "stg_purchases": f"""
        select order_id, user_id as customer_id, "timestamp" as purchase_timestamp, product_id, quantity,
               unit_price, total_amount, processed_timestamp, cast(purchase_date as date) as purchase_date,
               purchase_hour, purchase_year, purchase_month, purchase_day, data_source, {RUN} as loaded_at
        from silver_purchases where order_id is not null""",
    "stg_customers": f"""
        select *, lower(email) as email_clean, {RUN} as loaded_at from silver_customers
        where customer_id is not null""",
    "customer_rollup": f"""
        select customer_id, count(*) as total_orders, {_total('total_amount')} as total_spent,
               {_total('total_amount')} / count(total_amount) as avg_order_value,
               min(purchase_date) as first_purchase_date, max(purchase_date) as last_purchase_date
        from stg_purchases group by customer_id""",
    "dim_customers": """
        select c.customer_id, c.name, c.email_clean as email, c.email_domain, c.country, c.signup_date,
               coalesce(r.total_orders, 0) as total_orders, coalesce(r.total_spent, 0) as total_spent,
               coalesce(r.avg_order_value, 0) as avg_order_value, r.first_purchase_date, r.last_purchase_date,
               case when r.total_orders is null then 'No Purchases' when r.total_orders = 1 then 'One-time'
                    when r.total_orders between 2 and 5 then 'Regular' when r.total_orders > 5 then 'Frequent'
               end as customer_segment, c.loaded_at
        from stg_customers c left join customer_rollup r on c.customer_id = r.customer_id""",
    "fct_purchases": f"""
        select p.order_id, p.customer_id, p.product_id, p.purchase_timestamp, {', '.join('p.' + c for c in DAY.split(', '))},
               p.quantity, p.unit_price, p.total_amount, c.name, c.email, c.country, c.customer_segment, p.loaded_at
        from stg_purchases p left join dim_customers c on p.customer_id = c.customer_id""",
    "daily_sales_summary": f"""
        select {DAY}, count(*) as total_orders, count(distinct customer_id) as unique_customers,
               count(distinct product_id) as unique_products, cast(sum(quantity) as bigint) as total_quantity,
               {_total('total_amount')} as total_revenue,
               {_total('total_amount')} / count(total_amount) as avg_order_value,
               count(distinct case when customer_segment = 'One-time' then customer_id end) as new_customers,
               count(distinct case when customer_segment in ('Regular', 'Frequent') then customer_id end)
                   as returning_customers,
               {RUN} as loaded_at
        from fct_purchases group by {DAY}""",
    "click_windows": f"""
        select time_bucket(interval '1 minute', "timestamp") as window_start,
               time_bucket(interval '1 minute', "timestamp") + interval '1 minute' as window_end,
               page_url, event_type, count(*) as event_count, count(distinct user_id) as unique_users,
               count(distinct session_id) as unique_sessions,
               cast(extract(hour from window_start) as integer) as hour_of_day,
               cast(dayofweek(window_start) + 1 as integer) as day_of_week, {RUN} as processing_time,
               cast(case event_type when 'purchase' then count(*) * 5 when 'add_to_cart' then count(*) * 3
                    when 'click' then count(*) * 2 else count(*) end as bigint) as engagement_score
        from bronze_clickstream where "timestamp" is not null group by window_start, page_url, event_type""",
    "sale_windows": f"""
        select time_bucket(interval '1 minute', "timestamp") as window_start,
               time_bucket(interval '1 minute', "timestamp") + interval '1 minute' as window_end,
               product_id, count(order_id) as order_count, cast(sum(quantity) as bigint) as total_quantity,
               {_round2("cast(sum(quantity * cast(price as decimal(18,2))) as double)")} as total_revenue,
               {_round2("cast(sum(cast(price as decimal(18,2))) as double) / count(price)")} as avg_price,
               {RUN} as processing_time
        from bronze_purchases where "timestamp" is not null group by window_start, product_id""",
    "upserted_purchases": """
        select * from (select *, try_cast("timestamp" as timestamp) as bought_at,
            row_number() over (partition by order_id order by l_shipdate desc, l_partkey desc, l_suppkey desc,
                               l_extendedprice desc) as place from feed_purchases)
        where place = 1""",
}


def _with(body: str) -> str:
    """The query with the table expressions it needs in front."""
    needed: list[str] = []
    text = body
    for name in reversed(CTES):
        if re.search(rf"\b{name}\b", text):
            needed.insert(0, name)
            text += CTES[name]
    if not needed:
        return body
    return "with " + ",\n".join(f"{name} as ({CTES[name]})" for name in needed) + "\n" + body


def _null_check(table: str, column: str, name: str | None = None) -> str:
    return f"select 'not_null {name or table}.{column}' as \"check\", count(*) as failures from {table} where {column} is null"


def _unique_check(table: str, column: str, name: str | None = None) -> str:
    return (
        f"select 'unique {name or table}.{column}' as \"check\", count(*) as failures from (select {column} from {table} "
        f"where {column} is not null group by {column} having count(*) > 1)"
    )


def _checks() -> str:
    not_null = [
        ("stg_customers", "customer_id"), ("stg_purchases", "order_id"), ("stg_purchases", "customer_id"),
        ("dim_customers", "customer_id"), ("fct_purchases", "order_id"), ("fct_purchases", "customer_id"),
        ("daily_sales_summary", "purchase_date"),
    ]
    unique = [
        ("stg_customers", "customer_id"), ("stg_purchases", "order_id"), ("dim_customers", "customer_id"),
        ("fct_purchases", "order_id"), ("daily_sales_summary", "purchase_date"),
    ]
    parts = [_null_check(*c) for c in not_null] + [_unique_check(*c) for c in unique]
    parts.append(
        "select 'date_consistency' as \"check\", count(*) as failures from fct_purchases where "
        + " or ".join(f"purchase_{p} <> extract({p} from purchase_date)" for p in ("year", "month", "day"))
    )
    parts.append(
        "select 'orphaned_purchases' as \"check\", count(*) as failures from fct_purchases p "
        "left join dim_customers c on p.customer_id = c.customer_id where c.customer_id is null"
    )
    parts.append(
        f"select 'revenue_reconciliation' as \"check\", case when (select {_total('total_revenue')} from daily_sales_summary) "
        f"= (select {_total('total_amount')} from fct_purchases) then 0 else 1 end as failures"
    )
    return (
        "select \"check\", case when failures = 0 then 'PASS' else 'FAIL' end as status, cast(failures as bigint) as observed, "
        "cast(0 as bigint) as expected from (" + " union all ".join(parts) + ")"
    )


def _dq_metrics() -> str:
    names = {
        "clickstream": ["user_id missing", "timestamp missing", "event_type missing"],
        "purchases": [
            "order_id missing", "user_id missing", "timestamp missing", "quantity not positive", "price negative",
        ],
        "customers": ["customer_id missing", "name missing", "email missing", "email malformed"],
    }
    parts = []
    for entity in ENTITIES:
        for rule in names[entity]:
            parts.append(
                f"select '{entity}' as \"table\", 'failed_rule' as metric, '{rule}' as name, "
                f"count(*) filter (where failed_rule = '{rule}') as records, count(*) as n from judged_{entity}"
            )
        for column in WIRE[entity].names:
            parts.append(
                f"select '{entity}' as \"table\", 'filled' as metric, '{column}' as name, "
                f"count(\"{column}\") as records, count(*) as n from clean_{entity}"
            )
    return (
        "select \"table\", metric, name, records, cast(records as double) / n as ratio from ("
        + " union all ".join(parts) + ")"
    )


def _counts(*tables: str) -> str:
    return " union all ".join(f"select '{t}' as \"table\", count(*) as records from {t}" for t in tables)


def _columns(entity: str) -> str:
    return ", ".join(f'"{c}"' for c in WIRE[entity].names)


def _profile(entity: str) -> str:
    from tillflow.schemas import silver_schema

    return " union all ".join(
        f"select '{entity}' as \"table\", count(*) as records, cast({i + 1} as integer) as position, '{f.name}' as \"column\", "
        f"'{f.dataType.simpleString()}' as type, count(\"{f.name}\") as filled from silver_{entity}"
        for i, f in enumerate(silver_schema(entity))
    )


def build() -> dict[str, str]:
    bodies: dict[str, str] = {}
    for entity in ENTITIES:
        columns = _columns(entity)
        bodies[f"feed_{entity}"] = f"select {columns} from feed_{entity}"
        bodies[f"silver_{entity}"] = f"select * from silver_{entity}"
        bodies[f"quarantine_{entity}"] = f"select * from judged_{entity} where failed_rule is not null"
        kept = {"clickstream": "event_type is not null", "purchases": "quantity > 0", "customers": "email is not null"}
        filtered = f"select {columns} from bronze_{entity} where {kept[entity]}"
        bodies[f"stream_filter_{entity}"] = filtered
        bodies[f"stream_silver_{entity}"] = filtered
        bodies[f"stream_bronze_{entity}"] = f"select {columns} from bronze_{entity}"
        bodies[f"stg_{entity}"] = f"select * from stg_{entity}"

    # The last windows stay open: their end lies past the newest time less the lateness allowed.
    def closed(windows: str, bronze: str) -> str:
        return (
            f"select * from {windows} where window_end <= "
            f"(select max(\"timestamp\") from {bronze}) - interval '1 minute'"
        )

    rounded = (
        f"select purchase_date, total_orders, unique_customers, {_round2('total_revenue')} as total_revenue, "
        f"{_round2('avg_order_value')} as avg_order_value from daily_sales_summary"
    )
    countries = (
        f"select country, count(customer_id) as customer_count, '2026-01-01' as snapshot_date, {RUN} as processing_time "
        "from bronze_customers group by country"
    )
    silver_counts = " union all ".join(
        f"select '{e}' as \"table\", count(*) as records from silver_{e}" for e in ENTITIES
    )
    csv_typed = (
        "select order_id, user_id, try_cast(\"timestamp\" as timestamp) as \"timestamp\", product_id, quantity, price "
        "from feed_purchases"
    )
    # The row of each key that arrived last.
    last_click = (
        "select user_id, \"timestamp\", page_url, event_type, product_id, session_id from (select *, row_number() over "
        "(partition by user_id, \"timestamp\" order by event_id desc) as place from bronze_clickstream "
        "where user_id is not null and \"timestamp\" is not null) where place = 1"
    )
    last_purchase = (
        "select order_id, user_id, bought_at as \"timestamp\", product_id, quantity, price from upserted_purchases"
    )
    # The third lines come last: a line counts if its window ends after the newest of the other lines, less a minute.
    in_time = """
        select * from bronze_purchases where not (order_id like '%-3' and time_bucket(interval '1 minute', "timestamp")
            + interval '1 minute' <= (select max("timestamp") from bronze_purchases where order_id not like '%-3') - interval '1 minute')"""
    late_windows = CTES["sale_windows"].replace("from bronze_purchases", f"from ({in_time})")
    for entity in ENTITIES:
        bodies[f"bronze_full_{entity}"] = bodies[f"feed_{entity}"]
        bodies[f"batch_silver_{entity}"] = bodies[f"silver_{entity}"]
    columns = _columns("customers")
    bodies |= {
        "stream_layers_bronze": bodies["stream_bronze_purchases"],
        "stream_layers_silver": bodies["stream_silver_purchases"],
        "stream_layers_keyed": last_purchase,
        "stream_medallion": last_purchase,
        "keyed_load": last_purchase,
        "stream_restart": bodies["stream_bronze_customers"],
        "stream_new_checkpoint": f"select {columns}, 'bronze' as layer from bronze_customers union all select {columns}, 'keyed' "
        f"from bronze_customers union all select {columns}, 'silver' from bronze_customers where email is not null",
        "stream_snapshot_new_checkpoint": countries,
        "stream_analytics_job": countries,
        "stream_one_delivery": closed("sale_windows", "bronze_purchases"),
        "stream_late_rows": closed(f"({late_windows})", "bronze_purchases"),
        "stream_approx_bound": "select window_start, page_url, event_type, event_count, true as within_bound from ("
        + closed("click_windows", "bronze_clickstream") + ")",
        "bronze_append_rows": "select customer_id, nullif(trim(name), '') as name, trim(email) as email, trim(country) as country, signup_date "
        "from feed_customers, (values (1), (2)) t(delivery)",
        "retention_applied": "select * from silver_purchases where \"timestamp\" >= timestamp '1998-01-01 00:00:00'",
        "preview_check": "select least(count(*), 3) as shown, least(count(*), 3) as known from silver_customers",
        "csv_header": "select cast(position as bigint) as position, \"column\" from (values (1, 'customer_id'), (2, 'name'), (3, 'email'), "
        "(4, 'country'), (5, 'signup_date')) t(position, \"column\")",
        "source_gate": "select 'missing sources: customers' as said, count(*) as not_loaded from feed_customers",
        "staging_views": "select * from stg_customers",
        "export_dim_customers": "select * from dim_customers",
        "export_fct_purchases": "select * from fct_purchases",
        "customer_rollup": "select * from customer_rollup",
        "dim_customers": "select * from dim_customers",
        "fct_purchases": "select * from fct_purchases",
        "daily_sales_summary": "select * from daily_sales_summary",
        "gold_job": "select * from daily_sales_summary",
        "export_gold": "select * from daily_sales_summary",
        "daily_sales_trend": f"{rounded} order by purchase_date desc",
        "top_days": "select purchase_date, total_orders, unique_customers, total_revenue, avg_order_value "
        "from daily_sales_summary order by total_revenue desc, purchase_date limit 5",
        "top_customers": "select name, email, country, total_orders, total_spent, customer_segment from dim_customers "
        "where total_spent > 0 order by total_spent desc, customer_id limit 5",
        "recent_purchases": "select purchase_date, name, country, product_id, quantity, total_amount from fct_purchases "
        "order by purchase_date desc, purchase_timestamp desc, order_id, product_id, quantity nulls first, "
        "total_amount nulls first, name nulls first, country nulls first limit 5",
        "segment_distribution": "select customer_segment, count(*) as customers from dim_customers group by customer_segment",
        "product_performance": "select product_id, count(*) as total_orders, cast(sum(quantity) as bigint) as total_quantity, "
        f"{_total('total_amount')} as total_revenue from stg_purchases group by product_id",
        "sliced_join": "select c.country, count(*) as purchases from stg_purchases p left join stg_customers c "
        "on p.customer_id = c.customer_id group by c.country",
        "orphaned_purchases": "select order_id, customer_id, total_amount from fct_purchases p where not exists "
        "(select 1 from dim_customers c where c.customer_id = p.customer_id)",
        "orphan_count": "select count(*) as orphaned_purchases from stg_purchases p where not exists "
        "(select 1 from stg_customers c where c.customer_id = p.customer_id)",
        "revenue_reconciliation": f"select a as total_from_summary, b as total_from_facts, a = b as matches from "
        f"(select {_total('total_revenue')} as a from daily_sales_summary), (select {_total('total_amount')} as b from fct_purchases)",
        "date_consistency": "select count(*) as inconsistent_dates from stg_purchases where "
        + " or ".join(f"purchase_{p} <> extract({p} from purchase_date)" for p in ("year", "month", "day")),
        "check_not_null": " union all ".join(
            _null_check("feed_purchases", c, "purchases") for c in ("order_id", '"timestamp"', "quantity")
        ).replace('purchases."timestamp"\'', "purchases.timestamp'"),
        "check_unique": _unique_check("feed_purchases", "order_id", "purchases"),
        "check_unique_after_upsert": _unique_check("upserted_purchases", "order_id", "purchases"),
        "run_checks": _checks(),
        "validate": _checks(),
        "row_counts": _counts(
            "stg_clickstream", "stg_purchases", "stg_customers", "dim_customers", "fct_purchases", "daily_sales_summary"
        ),
        "schema_conformance": "select \"table\", true as columns_match, '' as missing_columns, '' as extra_columns "
        "from (values ('clickstream'), ('purchases'), ('customers')) t(\"table\") union all select 'purchases (raw)', false, "
        "'unit_price,total_amount,processed_timestamp,purchase_date,purchase_hour,purchase_year,purchase_month,"
        "purchase_day,data_source', 'price'",
        "silver_presence": f"select \"table\", true as present, records, records > 0 as ok from ({silver_counts})",
        "file_stats": f"select \"table\", records, true as all_sized from ({silver_counts})",
        "processing_stats": "select cast(3 as bigint) as total_tables, cast(3 as bigint) as valid_tables, "
        f"cast(sum(records) as bigint) as total_records, true as has_bytes, true as is_healthy, {RUN} as as_of "
        f"from ({silver_counts})",
        "batch_silver": silver_counts,
        "bronze_full": " union all ".join(f"select '{e}' as \"table\", count(*) as records from feed_{e}" for e in ENTITIES),
        "bronze_append": "select trim(country) as country, 2 * count(*) as records from feed_customers group by 1",
        "profile": _profile("customers"),
        "retention": "select * from silver_purchases where \"timestamp\" >= timestamp '1998-01-01 00:00:00'",
        "clickstream_analytics": "select * from click_windows",
        "purchase_analytics": "select * from sale_windows",
        "customer_analytics": countries,
        "stream_customer_analytics": countries,
        "stream_clickstream_analytics": closed("click_windows", "bronze_clickstream"),
        "stream_purchase_analytics": closed("sale_windows", "bronze_purchases"),
        "engagement_score": "select event_type, count(*) as event_count, cast(count(*) * case event_type when 'purchase' "
        "then 5 when 'add_to_cart' then 3 when 'click' then 2 else 1 end as bigint) as engagement_score "
        "from bronze_clickstream group by event_type",
        "decode_json": csv_typed,
        "csv_typed": csv_typed,
        "csv_inferred": csv_typed,
        "csv_declared": f"select {_columns('purchases')} from feed_purchases",
        "silver_csv": "select * from stg_customers",
        "export_manifest": f"""
            with sizes as (
                select 'dim_customers' as "table", count(*) as records, 'Customer dimension table with purchase metrics'
                       as description from dim_customers
                union all select 'fct_purchases', count(*), 'Purchase fact table with transaction details' from fct_purchases
                union all select 'daily_sales_summary', count(*), 'Daily aggregated sales metrics' from daily_sales_summary)
            select "table", records, 1 as tables, description, {RUN} as exported_at from sizes
            union all select 'TOTAL', cast(sum(records) as bigint), count(*), 'All tables', {RUN} from sizes""",
        "stream_upsert": last_click,
        "keyed_compacted": last_click,
        "stream_layers": "select 'bronze' as \"table\", count(*) as records from bronze_purchases union all "
        "select 'silver', count(*) from bronze_purchases where quantity > 0 union all "
        "select 'keyed', count(distinct order_id) from bronze_purchases",
        "upsert_purchases": "select order_id, user_id, bought_at as \"timestamp\", product_id, quantity, price from upserted_purchases",
        "upsert_clickstream": "select user_id, \"timestamp\", page_url, event_type, product_id, session_id from (select "
        "f.* replace (try_cast(f.\"timestamp\" as timestamp) as \"timestamp\"), row_number() over (partition by user_id, "
        "try_cast(f.\"timestamp\" as timestamp) order by event_id desc) as place from feed_clickstream f) "
        "where place = 1 and \"timestamp\" is not null",
        "upsert_customers": "select customer_id, name, email, upper(trim(country)) as country, signup_date from bronze_customers",
        "dedupe_latest": "select * exclude (place) from (select *, row_number() over (partition by customer_id order by "
        "purchase_timestamp desc nulls last, order_id desc nulls last, product_id desc nulls last, "
        "quantity desc nulls last, unit_price desc nulls last) as place from stg_purchases) where place = 1",
        "dq_metrics": _dq_metrics(),
        "freshness": "select max(\"timestamp\") as latest, date_sub('second', max(\"timestamp\"), "
        "timestamp '2024-02-01 00:00:00') as lag_seconds from silver_clickstream",
        "volume_daily": """
            with days as (select cast("timestamp" as date) as day, count(*) as records from silver_clickstream group by 1)
            select d.day, d.records, b.records as previous, d.records - b.records as growth
            from days d left join days b on b.day = d.day - 1""",
    }
    bodies["retention_partitioned"] = (
        "select *, cast(\"timestamp\" as date) > date '2024-01-18' as same_file from silver_clickstream "
        "where \"timestamp\" >= timestamp '2024-01-18 09:30:00'"
    )
    bodies["batch_summary"] = " union all ".join(_profile(entity) for entity in ENTITIES)
    bodies["stored_counts"] = _counts("silver_clickstream", "silver_purchases", "silver_customers", "dim_customers", "fct_purchases", "daily_sales_summary")
    closed_before_late = (
        "time_bucket(interval '1 minute', \"timestamp\") + interval '1 minute' <= "
        "(select max(\"timestamp\") from bronze_purchases where order_id not like '%-3') - interval '1 minute'"
    )
    sale = _columns("purchases")
    bodies |= {
        "daily_incremental": "select * from daily_sales_summary",
        "stream_late_split": f"select {sale}, order_id like '%-3' and coalesce({closed_before_late}, false) as late from bronze_purchases",
        "stream_deduped": f"select distinct {_columns('clickstream')} from bronze_clickstream where \"timestamp\" is not null",
        "stream_layers_committed": " union all ".join(
            f"select {sale}, '{layer}' as layer from ({bodies[f'stream_layers_{layer}']})" for layer in ("bronze", "keyed", "silver")
        ),
        "sketch_rollup_bound": " union all ".join(
            f"select '{grain}' as grain, date_trunc('{grain}', \"timestamp\") as start, page_url, event_type, count(*) as event_count, "
            f"true as within_bound from bronze_clickstream where \"timestamp\" is not null group by all" for grain in ("hour", "day")
        ),
        "stream_batches": """
            select 'clicks' as query, cast(least(coalesce(floor((t - low) / (high - low) * 4), 0), 3) as bigint) as batch, count(*) as "rows"
            from (select epoch("timestamp") as t from bronze_clickstream),
                 (select epoch(min("timestamp")) as low, epoch(max("timestamp")) as high from bronze_clickstream) group by all""",
        "stream_quarantine": """
            with numbered as (select *, cast(split_part(order_id, '-', 1) as bigint) as n from judged_purchases)
            select null::varchar as order_id, null::varchar as user_id, null::timestamp as "timestamp", null::integer as product_id,
                   null::integer as quantity, null::double as price, '{"order_id":"' || order_id as "raw", 'message unreadable' as failed_rule
            from numbered where n % 11 = 0
            union all select order_id, null, null, null, null, null, '{"order_id":"' || order_id || '","quantity":"many"}', 'field unreadable'
            from numbered where n % 11 <> 0 and n % 13 = 0
            union all select null, null, null, null, null, null, null, 'message missing'
            from numbered where n % 11 <> 0 and n % 13 <> 0 and n % 17 = 0
            union all select order_id, user_id, "timestamp", product_id, quantity, price, null, failed_rule
            from numbered where n % 11 <> 0 and n % 13 <> 0 and n % 17 <> 0 and failed_rule is not null""",
    }
    keyed = {"clickstream": last_click, "purchases": last_purchase, "customers": bodies["stream_bronze_customers"]}
    for entity in ENTITIES:
        for layer in ("bronze", "silver"):
            bodies[f"stream_medallion_{layer}_{entity}"] = bodies[f"stream_{layer}_{entity}"]
        bodies[f"stream_medallion_keyed_{entity}"] = keyed[entity]
    bodies["stream_analytics_job_customers"] = countries
    bodies["stream_analytics_job_clickstream"] = closed("click_windows", "bronze_clickstream")
    bodies["stream_analytics_job_purchases"] = closed("sale_windows", "bronze_purchases")
    lookups = {
        "lookup_customers_email_domain": "'machinery.example.com'",
        "lookup_customers_country": "'NATION_7'",
        "lookup_customers_signup_year": "1994",
        "lookup_purchases_user_id": "'1'",
        "lookup_purchases_product_id": "42",
        "lookup_purchases_purchase_year": "1997",
        "lookup_purchases_purchase_month": "3",
        "lookup_clickstream_event_type": "'ADD_TO_CART'",
        "lookup_clickstream_product_id": "1042",
        "lookup_clickstream_session_id": "'7-2024-01-05'",
        "lookup_clickstream_event_year": "2024",
        "lookup_clickstream_event_month": "1",
    }
    for name, value in lookups.items():
        _, entity, column = name.split("_", 2)
        bodies[name] = f"select * from silver_{entity} where {column} = {value}"
    bodies["lookup_files"] = " union all ".join(
        f"select '{entity}' as \"table\", '{column}' as \"column\", count(*) as records, true as skips_most from silver_{entity} where {column} = {value}"
        for (_, entity, column), value in ((name.split("_", 2), value) for name, value in lookups.items())
    )
    return {name: _assembled(body) for name, body in bodies.items()}


def _assembled(body: str) -> str:
    """A body that starts with its own table expressions joins them to the shared ones."""
    own = body.strip()
    if not own.startswith("with "):
        return _with(own)
    shared = _with("#" + own[len("with "):])
    head, _, rest = shared.rpartition("\n#")
    return f"{head},\n{rest}" if head else "with " + shared[1:]
