"""The queries in SQL, over the same tables.

They are written from the definition of each result, with plain joins and window
functions, and share nothing with the Spark plans. Amounts are divided in whole
cents because engines round binary fractions differently on ties.
"""

from __future__ import annotations

# ---- the campaign tables --------------------------------------------------
FX = """
fx_users as (
  select user_id, case when user_id % 3 = 0 then 0
                  else user_id % (select count(*) from part) end as part_key
  from (select distinct user_id from events)),
fx_products as (
  select cast(p_partkey as varchar) as product_id, p_name as product_name,
         cast(p_retailprice as decimal(10,2)) as price
  from part where p_partkey % 25 <> 24),
fx_mapping as (
  select cast(user_id as varchar) as ad_id, cast(part_key as varchar) as product_id
  from fx_users where user_id % 10 <> 9),
fx_spend as (
  select cast(user_id as varchar) as ad_id, cast(ts as date) as date,
         cast(sum(cast(value as decimal(18,2))) as decimal(10,2)) as daily_spend
  from events where event_type = 'click' group by 1, 2),
fx_sales as (
  select cast(e.ts as date) as fecha, e.event_id, e.ts,
         cast(u.part_key as varchar) as product_id, p.p_name as product_name,
         cast(1 + e.event_id % 3 as bigint) as quantity, p.p_retailprice as unit_price,
         cast(e.value as decimal(18,2)) as total_amount,
         'zone ' || cast(e.user_id % 5 as varchar) as region, 'ecommerce' as channel
  from events e join fx_users u on u.user_id = e.user_id join part p on p.p_partkey = u.part_key
  where e.event_type = 'purchase'),
fx_counts as (
  select cast(ts as date) as fecha, user_id, event_type as age_range,
         sum(case when event_id % 2 = 0 then 1 else 0 end) as f,
         sum(case when event_id % 2 = 1 then 1 else 0 end) as m
  from events where event_type in ('view', 'error') group by 1, 2, 3),
fx_meta as (
  select fecha, cast(user_id as varchar) as ad_id, n.n_name as country, age_range,
         min(fecha) over (partition by user_id) as ad_delivery_start_time,
         cast(sum(f) over (partition by user_id, age_range order by fecha) as bigint) as female,
         cast(sum(m) over (partition by user_id, age_range order by fecha) as bigint) as male
  from fx_counts join nation n on n.n_nationkey = user_id % 25)
"""

# ---- layers ---------------------------------------------------------------
SILVER = """
s_sales as (
  select fecha, product_id, product_name, cast(sum(quantity) as bigint) as ventas_unidades,
         sum(total_amount) as ventas_importe
  from fx_sales group by 1, 2, 3),
s_spend as (
  select s.date as fecha, s.ad_id, m.product_id, p.product_name, p.price, s.daily_spend
  from fx_spend s left join fx_mapping m on m.ad_id = s.ad_id
  left join fx_products p on p.product_id = m.product_id)
"""

GRID = """
g_product as (
  select ad_id, min(product_id) as product_id, min(product_name) as product_name
  from s_spend group by ad_id),
g_start as (select ad_id, min(ad_delivery_start_time) as start from fx_meta group by ad_id),
g_grid as (
  select d.fecha, a.ad_id, p.product_id, p.product_name, a.start
  from (select distinct fecha from fx_meta) d cross join g_start a
  left join g_product p on p.ad_id = a.ad_id
  where d.fecha >= a.start),
g_cumulative as (
  select fecha, ad_id, sum(female + male) as total from fx_meta group by 1, 2),
g_reach as (
  select fecha, ad_id, cast(greatest(total - coalesce(
           lag(total) over (partition by ad_id order by fecha), 0), 0) as bigint) as alcance
  from g_cumulative),
g_spend as (select fecha, ad_id, sum(daily_spend) as gasto from s_spend group by 1, 2)
"""


def cents(amount: str) -> str:
    return f"cast(({amount}) * 100 as hugeint)"


def ratio(amount: str, cost: str) -> str:
    a, c = cents(amount), cents(cost)
    return (
        f"case when ({cost}) > 0 then cast((200 * {a} + {c}) // (2 * {c}) as double) / 100 "
        "else 0.0 end"
    )


DAILY = f"""
g_joined as (
  select g.*, coalesce(sp.gasto, 0) as gasto, coalesce(r.alcance, 0) as alcance,
         coalesce(s.ventas_unidades, 0) as units, coalesce(s.ventas_importe, 0) as amount
  from g_grid g
  left join s_sales s on s.fecha = g.fecha and s.product_id = g.product_id
       and s.product_name = g.product_name
  left join g_spend sp on sp.fecha = g.fecha and sp.ad_id = g.ad_id
  left join g_reach r on r.fecha = g.fecha and r.ad_id = g.ad_id)
"""

SPINE = """
h_days as (
  select cast(unnest(generate_series(lo - 5, hi + 5, interval 1 day)) as date) as fecha
  from (select min(cast(ts as date)) as lo, max(cast(ts as date)) as hi from events)),
h_spine as (
  select d.fecha, coalesce(sum(s.daily_spend), 0) as gasto
  from h_days d left join fx_spend s on s.date = d.fecha group by 1),
h_shares as (
  select fecha, gasto, least(1.0, cast(sum(gasto) over (order by fecha) as double)
         / (select case when sum(gasto) <= 0 then 1.0 else cast(sum(gasto) as double) end
            from h_spine)) as factor
  from h_spine)
"""


def sql(body: str, *parts: str) -> str:
    return "with " + ",\n".join(p.strip() for p in (FX, *parts)) + "\n" + body.strip()


ORACLES: dict[str, str] = {}

BRONZE_SALES = """
select cast(fecha as varchar) as fecha, cast(event_id as varchar) as event_id,
       epoch_us(ts) as timestamp, product_id, product_name, quantity,
       cast(unit_price as double) as unit_price, cast(total_amount as double) as total_amount,
       region, channel
from fx_sales
"""
ORACLES["bronze_sales"] = sql(BRONZE_SALES)

ORACLES["t_landing_stream"] = sql(
    f"""
select s.*, cast(substr(fecha, 1, 4) as integer) as anio,
       cast(substr(fecha, 6, 2) as integer) as mes, cast(substr(fecha, 9, 2) as integer) as dia
from ({BRONZE_SALES}) s
"""
)

ORACLES["bronze_meta"] = sql(
    """
select cast(fecha as varchar) as fecha, ad_id, cast(sum(female + male) as bigint) as eu_total_reach,
       cast(ad_delivery_start_time as varchar) as ad_delivery_start_time,
       'All' as target_gender, '18,65' as target_ages, 'site,app' as publisher_platforms,
       count(*) as breakdown_rows
from fx_meta group by fecha, ad_id, ad_delivery_start_time
"""
)

ORACLES["bronze_date_parts"] = sql(
    """
select cast(year(fecha) as integer) as anio, cast(month(fecha) as integer) as mes,
       cast(day(fecha) as integer) as dia, count(*) as rows
from fx_sales group by 1, 2, 3
"""
)

ORACLES["silver_sales_daily"] = sql(
    """
select cast(fecha as varchar) as fecha, product_id, product_name, ventas_unidades,
       cast(ventas_importe as double) as ventas_importe from s_sales
""",
    SILVER,
)

ORACLES["silver_sales_daily_from_bronze"] = ORACLES["silver_sales_daily"]

ORACLES["silver_ad_spend"] = sql(
    """
select cast(fecha as varchar) as fecha, ad_id, product_id, product_name,
       cast(price as double) as price, cast(daily_spend as double) as daily_spend from s_spend
""",
    SILVER,
)

ORACLES["silver_meta"] = sql(
    """
select cast(fecha as varchar) as fecha, ad_id,
       cast(sum(female + male) over (partition by fecha, ad_id) as bigint) as eu_total_reach,
       cast(ad_delivery_start_time as varchar) as ad_delivery_start_time,
       'All' as target_gender, '18,65' as target_ages, 'site,app' as publisher_platforms,
       country, age_range, female, male, female + male as reach
from fx_meta
"""
)

ORACLES["gold_ad_product"] = sql("select * from g_product", SILVER, GRID)

ORACLES["gold_active_grid"] = sql(
    """
select cast(fecha as varchar) as fecha, ad_id, product_id, product_name,
       cast(start as varchar) as fecha_inicio_anuncio from g_grid
""",
    SILVER,
    GRID,
)

ORACLES["gold_reach_delta"] = sql(
    "select cast(fecha as varchar) as fecha, ad_id, alcance from g_reach", SILVER, GRID
)

ORACLES["gold_spend_by_ad_day"] = sql(
    """
select cast(fecha as varchar) as fecha, ad_id, cast(gasto as double) as gasto from g_spend
""",
    SILVER,
    GRID,
)

ORACLES["gold_demographic_reach"] = sql(
    """
select cast(m.fecha as varchar) as fecha, m.ad_id, p.product_id, p.product_name, m.country,
       m.age_range, m.gender, m.reach
from (select fecha, ad_id, country, age_range, 'female' as gender, female as reach from fx_meta
      union all
      select fecha, ad_id, country, age_range, 'male', male from fx_meta) m
left join g_product p on p.ad_id = m.ad_id
where m.reach > 0
""",
    SILVER,
    GRID,
)

ORACLES["gold_ad_daily_metrics"] = sql(
    f"""
select cast(fecha as varchar) as fecha, ad_id, product_id, product_name,
       cast(gasto as double) as gasto, cast(alcance as bigint) as alcance,
       cast(units as bigint) as ventas_unidades, cast(amount as double) as ventas_importe,
       {ratio("amount", "gasto")} as roas,
       cast(datediff('day', start, fecha) as integer) as dias_desde_inicio
from g_joined
""",
    SILVER,
    GRID,
    DAILY,
)

ORACLES["gold_ad_total_metrics"] = sql(
    f"""
select ad_id, product_id, product_name, cast(gasto as double) as gasto_total,
       alcance_total, ventas_unidades_total, cast(amount as double) as ventas_importe_total,
       {ratio("amount", "gasto")} as roas_total
from (select ad_id, product_id, product_name, sum(gasto) as gasto, sum(amount) as amount,
             cast(sum(alcance) as bigint) as alcance_total,
             cast(sum(units) as bigint) as ventas_unidades_total
      from g_joined group by 1, 2, 3) t
""",
    SILVER,
    GRID,
    DAILY,
)
ORACLES["gold_ad_total_from_stored"] = ORACLES["gold_ad_total_metrics"]

ORACLES["gold_saturation_curve"] = sql(
    f"""
select cast(fecha as varchar) as fecha, cast(gasto as double) as gasto_total_dia,
       cast(units as bigint) as ventas_unidades_total_dia,
       cast(amount as double) as ventas_total_dia, {ratio("amount", "gasto")} as roas_global
from (select g.fecha, g.gasto, coalesce(s.units, 0) as units, coalesce(s.amount, 0) as amount
      from (select fecha, sum(daily_spend) as gasto from s_spend group by 1) g
      left join (select fecha, sum(ventas_unidades) as units, sum(ventas_importe) as amount
                 from s_sales group by 1) s on s.fecha = g.fecha) t
""",
    SILVER,
)

ORACLES["fn_safe_ratio"] = f"""
with l as (
  select l_orderkey, cast(count(*) - 1 as decimal(10,2)) as lines from lineitem group by 1),
o as (
  select o_orderkey, cast(o_totalprice as decimal(18,2)) as price, lines
  from orders left join l on l_orderkey = o_orderkey)
select o_orderkey, {ratio("price", "lines")} as ratio,
       case when lines > 0 and price / lines >= 0.005 then 1 else 0 end as positive
from o
"""

ORACLES["fn_saturation_response"] = sql(
    """
select ad_id, cast(date as varchar) as date, cast(daily_spend as double) as daily_spend,
       cast(per_day as bigint) as per_day,
       cast(greatest(1, trunc(per_day / 16.0)) as bigint) as per_hour
from (select *, greatest(10, trunc(180 * (1 - exp(-0.00015 * cast(daily_spend * 100 as double)))))
             as per_day from fx_spend) t
"""
)

ORACLES["h_spend_spine"] = sql(
    "select cast(fecha as varchar) as fecha, cast(gasto as double) as gasto from h_spine", SPINE
)

ORACLES["h_cumulative_share"] = sql(
    """
select cast(fecha as varchar) as fecha, cast(gasto as double) as gasto,
       round(factor, 9) as factor from h_shares
""",
    SPINE,
)

ORACLES["h_product_weights"] = sql(
    """
select p.product_id, 1 + count(m.ad_id) as weight
from fx_products p left join fx_mapping m on m.product_id = p.product_id group by 1
"""
)

# stored rows stay as they are; of two deliveries the lower amount comes first
ORACLES["h_insert_absent"] = sql(
    """
select ad_id, cast(date as varchar) as date,
       cast(daily_spend + case when date < date '2024-01-11' then 1 else 0 end as double)
         as daily_spend
from fx_spend
"""
)

LATEST = """
latest as (
  select fecha, ad_id, ad_delivery_start_time, sum(female + male) as reach
  from fx_meta where fecha = (select max(fecha) from fx_meta) group by 1, 2, 3)
"""
ORACLES["h_latest_snapshot"] = sql(
    """
select 'landing/meta_ads/' || strftime(fecha, '%Y/%m/%d') || '/meta_ads_20240101_000000.json'
         as file_path,
       ad_id as id, cast(reach as bigint) as eu_total_reach,
       cast(ad_delivery_start_time as varchar) as ad_delivery_start_time
from latest
""",
    LATEST,
)
ORACLES["h_ad_ids"] = sql("select ad_id from latest", LATEST)

ORACLES["h_assemble_pages"] = sql(
    """
select '2024-02-01' as extraction_date,
       '2024-02-01T06:30:00.000000+00:00' as extraction_timestamp,
       count(*) over () as total_ads, ad_id as id, cast(reach as bigint) as eu_total_reach
from (select ad_id, sum(female + male) as reach from fx_meta
      where fecha = ad_delivery_start_time group by 1) t
"""
)

ORACLES["h_backcast"] = sql(
    """
select cast(s.fecha as varchar) as fecha, m.ad_id,
       cast(greatest(1, trunc(m.total * s.factor)) as bigint) as eu_total_reach,
       m.country, m.age_range, cast(trunc(m.female * s.factor) as bigint) as female,
       cast(trunc(m.male * s.factor) as bigint) as male
from (select *, sum(female + male) over (partition by ad_id, fecha) as total,
             max(fecha) over (partition by ad_id) as newest from fx_meta) m
join h_shares s on s.fecha >= m.ad_delivery_start_time
where m.fecha = m.newest
""",
    SPINE,
)

ORACLES["h_backcast_landed"] = ORACLES["h_backcast"]

ORACLES["q_duplicate_keys"] = """
select l_partkey, l_suppkey, count(*) as rows from lineitem group by 1, 2 having count(*) > 1
"""

ORACLES["q_orphan_mapping"] = sql(
    """
select ad_id, product_id from fx_mapping
where product_id not in (select product_id from fx_products)
"""
)

ORACLES["q_nulls"] = sql(
    "\nunion all\n".join(
        f"select '{c}' as column_name, count(*) - count({c}) as null_rows from s_spend"
        for c in ("fecha", "ad_id", "product_id", "product_name", "price")
    ),
    SILVER,
)

ORACLES["q_event_contract"] = """
with e as (
  select case when event_id % 11 <> 0 then cast(event_id as varchar) end as event_id,
         event_id as n
  from events where event_type = 'purchase')
select event_id, 'missing event_id' as rule from e where n % 11 = 0
union all select event_id, 'quantity' from e where n % 4 = 3
union all select event_id, 'channel' from e where n % 5 = 0
union all select event_id, 'total_amount' from e where n % 7 = 0
"""

ORACLES["q_envelope_count"] = sql(
    """
select 'landing/ventas/' || strftime(fecha, '%Y/%m/%d') || '/ventas_'
         || cast(event_id // 50 as varchar) || '.json' as file_path,
       count(*) + 1 as total_events, count(*) as actual
from fx_sales where (event_id // 50) % 3 = 0
group by fecha, event_id // 50
"""
)

ORACLES["t_parse_messages"] = sql(
    """
select product_id, epoch_us(timestamp '2024-02-01 00:00:00') as enqueued_time,
       count(*) as events, cast(sum(quantity) as bigint) as quantity
from (select product_id, quantity from fx_sales
      union all select product_id, quantity from fx_sales where event_id % 5 = 0
      union all select null, null from events where event_type = 'signup') t
group by 1
"""
)

ORACLES["t_capture_stream"] = sql(
    """
select product_id, product_name, count(*) as events, cast(sum(quantity) as bigint) as quantity,
       cast(sum(total_amount) as double) as amount
from (select * from fx_sales
      union all select * from fx_sales where event_id % 5 = 0) t
group by 1, 2
"""
)

ORACLES["fn_lenient_dates"] = """
select event_id,
       case when event_id % 6 in (0, 1) then day end as as_date,
       case when event_id % 6 = 0 then epoch_us(cast(cast(ts as date) as timestamp))
            when event_id % 6 = 1 then epoch_us(date_trunc('second', ts)) - 7200000000
            end as as_micros,
       case when event_id % 6 in (0, 1, 2) then day end as published,
       case when event_id % 6 <> 4 then day end as in_path
from (select *, cast(cast(ts as date) as varchar) as day from events) e
"""

ORACLES["t_quarantine_stream"] = """
select '{broken ' || cast(event_id as varchar) as text from events where event_type = 'signup'
"""

ORACLES["t_silver_days"] = sql(
    """
select cast(fecha as varchar) as fecha, product_id, product_name,
       ventas_unidades + case when fecha between date '2024-01-11' and date '2024-01-12'
                         then 1000 else 0 end as ventas_unidades,
       cast(ventas_importe as double) as ventas_importe,
       cast(year(fecha) as integer) as anio, cast(month(fecha) as integer) as mes,
       cast(day(fecha) as integer) as dia
from s_sales where fecha between date '2024-01-08' and date '2024-01-14'
""",
    SILVER,
)

ORACLES["t_append_absent"] = sql(
    """
select ad_id, case when cast(ad_id as bigint) % 2 = 0 then '' else 'late ' end || product_id
       as product_id
from fx_mapping
"""
)

# first snapshots come in on the first of February, newest ones on the second
EXTRACTED = """
x_days as (
  select m.*, min(fecha) over (partition by ad_id) as lo, max(fecha) over (partition by ad_id) as hi
  from fx_meta m),
x_landed as (
  select date '2024-02-01' as day, * from x_days where fecha = lo
  union all select date '2024-02-02', * from x_days where fecha = hi),
x_ads as (
  select day, ad_id, fecha, ad_delivery_start_time, cast(sum(female + male) as bigint) as reach
  from x_landed group by 1, 2, 3, 4)
"""

ORACLES["h_landed_snapshots"] = sql(
    """
select cast(x.day as varchar) as fecha, x.ad_id, a.reach as eu_total_reach,
       cast(x.ad_delivery_start_time as varchar) as ad_delivery_start_time,
       'All' as target_gender, '18,65' as target_ages, 'site,app' as publisher_platforms,
       x.country, x.age_range, x.female, x.male, x.female + x.male as reach
from x_landed x join x_ads a on a.day = x.day and a.ad_id = x.ad_id
""",
    EXTRACTED,
)

ORACLES["h_raw_snapshot"] = sql(
    """
select '2024-02-02T06:30:00.000000+00:00' as extraction_timestamp, count(*) over () as total_ads,
       ad_id as id, reach as eu_total_reach,
       cast(ad_delivery_start_time as varchar) as ad_delivery_start_time,
       cast(cast(fecha + interval 9 day as date) as varchar) as ad_delivery_stop_time
from x_ads where day = date '2024-02-02'
""",
    EXTRACTED,
)

ORACLES["q_snapshot_count"] = sql(
    """
select cast(day as varchar) || 'T06:30:00.000000+00:00' as extraction_timestamp,
       count(*) as total_ads, count(*) filter (cast(ad_id as bigint) % 7 <> 0) as actual
from x_ads group by 1 having count(*) <> count(*) filter (cast(ad_id as bigint) % 7 <> 0)
""",
    EXTRACTED,
)

ORACLES["s_catalogue"] = """
select cast(p_partkey as varchar) as product_id, p_name as product_name, p_type as category,
       cast(cast(p_retailprice as decimal(10,2)) as double) as price
from part
"""

ORACLES["q_event_contract_doubles"] = """
with e as (
  select case when event_id % 11 <> 0 then cast(event_id as varchar) end as event_id,
         event_id as n
  from events where event_type = 'purchase')
select event_id, 'missing event_id' as rule from e where n % 11 = 0
union all select event_id, 'quantity' from e where n % 4 = 3 or n % 13 = 0
union all select event_id, 'channel' from e where n % 5 = 0
union all select event_id, 'total_amount' from e where n % 7 = 0 or n % 13 = 0 or n % 17 = 0
"""

ORACLES["t_landing_documents"] = sql(
    """
select cast(fecha as varchar) as fecha, cast(event_id as varchar) as event_id, product_id, quantity,
       cast(total_amount as double) as total_amount, 'bronze' as found_in
from fx_sales
union all
select null, cast(event_id as varchar), null, null, null, 'quarantine'
from events where event_type = 'signup'
"""
)

ORACLES["t_capture_rerun"] = sql(
    """
select '2024-02-01' as fecha, cast(event_id as varchar) as event_id, epoch_us(ts) as timestamp,
       product_id, product_name, quantity, cast(unit_price as double) as unit_price,
       cast(total_amount as double) as total_amount, region, channel, null as raw
from (select * from fx_sales union all select * from fx_sales where event_id % 5 = 0) t
union all
select null, null, null, null, null, null, null, null, null, null,
       unnest(['signup', '{"event_id":"' || cast(event_id as varchar) || '","quantity":"two"}'])
from events where event_type = 'signup'
"""
)

ORACLES["t_landing_large"] = ORACLES["t_landing_stream"]
ORACLES["t_landing_archived"] = ORACLES["t_landing_documents"]

ORACLES["t_capture_reset"] = sql(
    """
select cast(event_id as varchar) as event_id, epoch_us(ts) as timestamp, product_id, product_name, quantity,
       cast(unit_price as double) as unit_price, cast(total_amount as double) as total_amount, region, channel,
       null as raw
from (select * from fx_sales union all select * from fx_sales where event_id % 5 = 0) t
union all
select null, null, null, null, null, null, null, null, null,
       unnest(['signup', '{"event_id":"' || cast(event_id as varchar) || '","quantity":"two"}'])
from events where event_type = 'signup'
"""
)

EVENT_TEXTS = """
x_events as (
  select cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as timestamp,
         product_id, product_name, quantity, cast(unit_price as double) as unit_price,
         cast(total_amount as double) as total_amount, region, channel
  from (select * from fx_sales union all select * from fx_sales where event_id % 5 = 0) t)
"""

ORACLES["t_capture_events"] = sql("select 1 as total_events, * from x_events", EVENT_TEXTS)

ORACLES["t_parse_events"] = sql(
    """
select *, epoch_us(timestamp '2024-02-01 00:00:00') as enqueued_time, null as raw from x_events
union all
select null, null, null, null, null, null, null, null, null, epoch_us(timestamp '2024-02-01 00:00:00'), event_type
from events where event_type = 'signup'
""",
    EVENT_TEXTS,
)

ORACLES["t_events_in_order"] = sql(
    """
select 'landing/ventas/' || strftime(fecha, '%Y/%m/%d') || '/ventas_' || cast(event_id // 50 as varchar) || '.json' as file_path,
       cast(row_number() over (partition by fecha, event_id // 50 order by ts, cast(event_id as varchar)) - 1 as integer) as place,
       cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as timestamp
from fx_sales
"""
)

TREE = """
x_tree as (
  select *, sum(female + male) over (partition by ad_id, fecha) as total, 1 as unknown from fx_meta)
"""

ORACLES["bronze_meta_tree"] = sql(
    """
select cast(fecha as varchar) as fecha, ad_id, cast(total as bigint) as eu_total_reach,
       cast(ad_delivery_start_time as varchar) as ad_delivery_start_time, 'All' as target_gender,
       '18,65' as target_ages, 'site,app' as publisher_platforms, country, age_range, female, male, unknown
from x_tree
""",
    TREE,
)

ORACLES["h_assemble_days"] = sql(
    """
select cast(fecha as varchar) as extraction_date, cast(fecha as varchar) || 'T06:30:00.000000+00:00' as extraction_timestamp,
       (select count(distinct ad_id) from fx_meta m where m.fecha = t.fecha) as total_ads, ad_id as id,
       cast(total as bigint) as eu_total_reach, cast(ad_delivery_start_time as varchar) as ad_delivery_start_time,
       'All' as target_gender, '18,65' as target_ages, 'site,app' as publisher_platforms, country, age_range,
       female, male, unknown
from x_tree t
""",
    TREE,
)

ORACLES["t_jobs_full"] = ORACLES["gold_ad_daily_metrics"]
ORACLES["t_jobs_range"] = ORACLES["gold_ad_daily_metrics"]
ORACLES["t_jobs_range_reach"] = ORACLES["gold_demographic_reach"]


def _with_late_products(query: str) -> str:
    """The query over spend that names other products from the second day on."""
    renamed = "case when s.date > date '2024-01-01' then 'p' || {0} else {0} end as {1}"
    pieces = {
        "s.ad_id, m.product_id, p.product_name, p.price": "s.ad_id, "
        + ", ".join(renamed.format(*c) for c in (("m.product_id", "product_id"), ("p.product_name", "product_name")))
        + ", p.price",
        "min(product_name) as product_name": "arg_min(product_name, product_id) as product_name",
    }
    for old, new in pieces.items():
        query = query.replace(old, new)
    return query


ORACLES["t_jobs_late_days"] = "\nunion all by name\n".join(
    f"select '{name}' as gold, * from ({_with_late_products(ORACLES[name])})"
    for name in ("gold_ad_daily_metrics", "gold_ad_total_metrics", "gold_demographic_reach", "gold_saturation_curve")
)
