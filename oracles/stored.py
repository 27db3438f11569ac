"""Reference SQL for the queries over stored tables."""

from __future__ import annotations

from oracles.trips import (
    BRIDGE,
    DAILY_BASE,
    DATES,
    DIM_ZONE,
    KEYS,
    ORACLES,
    STAGING,
    TO_FACT,
    TO_SILVER,
    TO_TAGGED,
    mean,
    over,
    total,
    whole,
)

# --- states and incremental Gold ----------------------------------------------

ORACLES["hourly_from_states"] = ORACLES["agg_hourly_zone"]
ORACLES["daily_from_states"] = ORACLES["agg_daily_borough"]
ORACLES["payments_from_states"] = ORACLES["agg_payment_trends"]
ORACLES["airport_from_states"] = ORACLES["b4_airport_revenue_per_mile"]
ORACLES["weekend_hours_from_states"] = ORACLES["b5_weekend_hour_durations"]
ORACLES["gold_incremental"] = ORACLES["agg_daily_borough"]
ORACLES["gold_incremental_hourly"] = ORACLES["agg_hourly_zone"]
ORACLES["catalog_gold"] = ORACLES["agg_daily_borough"]
ORACLES["stream_into_silver"] = ORACLES["medallion_rerun"]
ORACLES["zorder_silver"] = ORACLES["layout_range"]
ORACLES["gold_incremental_parts"] = over(
    [*TO_FACT, DAILY_BASE],
    """
select * from (with touched as (
  select distinct strftime(pickup_datetime, '%Y-%m') as part, last_day(cast(pickup_datetime as date)) as ends
  from tagged where reject_reason is null and source_month = '2024-03'
),
days as (
  select pickup_date, lag(pickup_date, 7) over (partition by pickup_borough order by pickup_date) as back
  from daily_base
),
reached as (
  select part from touched
  union
  select strftime(pickup_date, '%Y-%m') from days, touched
  where pickup_date > ends and (back is null or back <= ends)
),
parts as (select distinct pickup_year_month as part from fact)
select name as table_name, part as pickup_year_month, part in (select part from touched) as rewritten
from parts, (values ('fact_trips'), ('trip_states'), ('agg_hourly_zone')) as t(name)
union all
select 'agg_daily_borough', part, part in (select part from reached) from parts)""",
)

# --- drifted files ------------------------------------------------------------

LOST = "(source_month = '2024-05' and RatecodeID % 3 = 2 and payment_type = 1)"
ORACLES["drifted_columns"] = """
select * from (values
  ('passenger_count', 'bigint', 'bigint', true),
  ('passenger_count', 'string', 'bigint', true),
  ('surge', 'double', 'double', false),
  ('surge', 'int', 'double', false),
  ('trip_distance', 'double', 'double', true),
  ('trip_distance', 'string', 'double', true)
) as t(column_name, found_type, read_as, is_declared)"""
SURGE = """case when source_month = '2024-05' and RatecodeID % 3 = 1 then VendorID * 10.0::double
    when source_month = '2024-05' and RatecodeID % 3 = 2 then VendorID * 0.5::double end"""
ORACLES["drifted_month"] = over(
    [BRIDGE],
    f"""
select source_month, count(*) as row_count, {whole("passenger_count")} as passengers,
  {total(f"(case when {LOST} then null else trip_distance end)")} as distance,
  {total(f"({SURGE})")} as surge, count(*) filter ({LOST}) as rescued_rows
from trips group by source_month""",
)
ORACLES["drifted_values"] = over(
    [BRIDGE],
    f"""
select source_month, 'unreadable_value: does not fit the declared type' as reject_reason,
  'trip_distance' as column_name, count(*) as value_count
from trips where {LOST} group by source_month""",
)

# --- sketches, layout, buckets, pruning ----------------------------------------

ORACLES["users_by_month"] = """
select event_type, cast(date_trunc('month', ts) as date) as month_start, count(distinct user_id) as users,
  true as within_bound
from events group by all"""
ORACLES["zorder_skipping"] = over(
    TO_SILVER,
    f"""
select count(*) as row_count, {total("total_cost")} as revenue,
  true as time_skips, true as borough_skips, true as both_skip_more
from silver
where pickup_datetime >= timestamp '2024-02-01' and pickup_datetime < timestamp '2024-03-01' and pickup_borough = 'Queens'""",
)
ORACLES["bucketed_dedup"] = ORACLES["dedup_keep_first"]
ORACLES["bucketed_copies"] = over(
    TO_TAGGED,
    f"""
select count(*) as repeated_keys, cast(sum(n) as bigint) as rows
from (select count(*) as n from tagged where reject_reason is null group by {KEYS} having count(*) > 1)""",
)
ORACLES["bucketed_lines"] = f"""
select l_returnflag, l_linestatus, count(*) as row_count, {total("l_extendedprice")} as revenue
from ({ORACLES["lineitem_dedup"]}) group by all"""
ORACLES["star_join_quarter"] = over(
    [*TO_FACT, DATES, DIM_ZONE],
    f"""
select d.month_name, d.is_us_holiday, pz.borough_type as pickup_borough_type,
  dz.is_airport_zone as dropoff_is_airport_zone, count(*) as trips, {total("f.total_cost")} as revenue
from fact f join dates d on f.date_key = d.date_key
left join dim_zone pz on f.pickup_location_id = pz.location_id
left join dim_zone dz on f.dropoff_location_id = dz.location_id
where d.quarter_label = 'Q3' and d.year = 2024
group by all""",
)

# --- calendar, view, gate, unknown numbers ------------------------------------

ORACLES["holiday_rules"] = """
with span as (
  select min(cast(o_orderdate + interval 26 year as date)) as low, max(cast(o_orderdate + interval 26 year as date)) as high
  from orders
),
years as (select unnest(range(cast(year(low) as bigint) - 1, cast(year(high) as bigint) + 2)) as y from span),
fixed as (
  select make_date(y, m, d) as day from years, (values (1, 1), (6, 19), (7, 4), (11, 11), (12, 25)) as t(m, d)
),
mondays as (
  -- the first Monday or Thursday of a month, and the nth from it
  select first + cast((w - dayofweek(first) + 7) % 7 + 7 * (n - 1) as int) as day
  from (select make_date(y, m, 1) as first, w, n
        from years, (values (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) as t(m, w, n))
),
last_mondays as (
  select last_day(make_date(y, 5, 1)) - cast((dayofweek(last_day(make_date(y, 5, 1))) + 6) % 7 as int) as day from years
),
moving as (select cast(day as date) as day from mondays union all select cast(day as date) from last_mondays),
observed as (
  select cast(case dayofweek(day) when 6 then day - 1 when 0 then day + 1 else day end as date) as day from fixed
  union
  select day from moving
)
select day as calendar_date, strftime(day, '%A') as day_name,
  day in (select day from fixed) or day in (select day from moving) as on_its_day
from observed, span where day between low and high"""
ORACLES["staging_view"] = over(
    [*TO_SILVER, STAGING],
    "select pickup_year_month, count(*) as trips, count(distinct trip_id) as trip_ids from staging group by all",
)
ORACLES["gate_outcome"] = f"""
select count(*) filter (failures > 0) as failed_checks, count(*) filter (failures > 0) > 0 as stopped
from ({ORACLES["medallion_quality"]})"""
ODD = "(case when payment_type in (1, 2) then null else fare_amount end)"
ORACLES["unknown_numbers"] = over(
    [BRIDGE],
    f"""
select source_month, {total(ODD)} as fares, {mean(ODD, 2)} as mean_fare, count({ODD}) as known
from trips group by source_month""",
)
