"""Reference SQL for the registered queries, written for DuckDB.

The SQL is independent of the Spark code: it repeats the intent, in one text per
query, over the same tables. Doubles are rounded on their shortest decimal text
(halves away from zero), and money is summed as decimals of full precision.
"""

from __future__ import annotations

# Fixed values, stated here once more so that the reference does not lean on the code under test:
# federal holidays of 2024 and names of major zones.
US_HOLIDAYS = [
    "2024-01-01",
    "2024-01-15",
    "2024-02-19",
    "2024-05-27",
    "2024-06-19",
    "2024-07-04",
    "2024-09-02",
    "2024-10-14",
    "2024-11-11",
    "2024-11-28",
    "2024-12-25",
]
MAJOR_HUBS = [
    "Times Sq/Theatre District",
    "Midtown Center",
    "Penn Station/Madison Sq West",
    "Grand Central",
    "Upper East Side North",
    "Upper East Side South",
    "JFK Airport",
    "LaGuardia Airport",
]

ORACLES: dict[str, str] = {}


def rnd(expr: str, digits: int) -> str:
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38, 18)), {digits}) as double)"


def exact(expr: str) -> str:
    return f"cast(cast({expr} as varchar) as decimal(38, 12))"


def total(expr: str, digits: int = 2, over: str = "") -> str:
    return f"cast(round(sum({exact(expr)}) {over}, {digits}) as double)"


def units(expr: str) -> str:
    """The sum in ten-thousandths, as a double: whole for money, and the one division after it then exact to the last bit."""
    return f"cast(sum({exact(expr)}) * 10000 as double)"


def mean(expr: str, digits: int) -> str:
    return rnd(f"{units(expr)} / nullif(count({expr}) * 10000.0::double, 0)", digits)


def ratio(top: str, bottom: str, digits: int = 2) -> str:
    return rnd(f"{units(top)} / nullif({units(bottom)}, 0)", digits)


def whole(expr: str) -> str:
    return f"cast(sum({expr}) as bigint)"


def pct(current: str, prior: str, digits: int = 1) -> str:
    return rnd(
        f"cast(100.0 as double) * (cast({current} as double) - cast({prior} as double))"
        f" / nullif(cast({prior} as double), 0)",
        digits,
    )


def share(value: str, over: str, digits: int = 1) -> str:
    return rnd(f"cast(100.0 as double) * {value} / nullif(cast(sum({value}) over ({over}) as double), 0)", digits)


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# --- common table expressions, in order of dependence --------------------------

BRIDGE = """
bridge_base as (
  select *, o_orderdate + interval 26 year as d0,
         (l_partkey * 37) % 1440 as m0,
         cast(floor(l_extendedprice) as bigint) as cents,
         cast(substring(o_orderpriority, 1, 1) as int) as pay
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey
),
bridge_shaped as (
  select l_partkey, d0,
    cast(l_linenumber % 2 + 1 as int) as VendorID,
    d0 + interval 1 minute * m0 as tpep_pickup_datetime,
    d0 + interval 1 minute * (m0 + cast(l_quantity as bigint) * 2 - 3
       + case when l_partkey % 211 = 0 then 525600 else 0 end) as tpep_dropoff_datetime,
    cast(nullif(l_suppkey % 7, 6) as bigint) as passenger_count,
    cast(l_partkey % 400 - 5 as double) / 10 as trip_distance,
    cast(l_linenumber as bigint) as RatecodeID,
    case when l_returnflag = 'R' then 'Y' else 'N' end as store_and_fwd_flag,
    case when l_partkey % 97 = 0 then null else c_nationkey end as PULocationID,
    s_nationkey as DOLocationID,
    pay as payment_type,
    cast(cents % 8000 - 100 as double) / 100 as fare_amount,
    cast(l_linenumber as double) / 4 as extra,
    cast(0.5 as double) as mta_tax,
    case when pay = 1 then cast(cents % 1600 as double) / 100 else cast(0 as double) end as tip_amount,
    cast(l_partkey % 3 as double) as tolls_amount,
    cast(1 as double) as improvement_surcharge
  from bridge_base
),
bridge_both as (
  select * exclude (l_partkey, d0), substring(cast(d0 as varchar), 1, 7) as source_month
  from bridge_shaped
  union all
  select * exclude (l_partkey, d0) replace (tip_amount + 1 as tip_amount),
         substring(cast(d0 + interval 1 month as varchar), 1, 7) as source_month
  from bridge_shaped where l_partkey % 20 = 7
),
trips as (
  select *, 'yellow_tripdata_' || source_month || '.parquet' as source_file,
         tpep_pickup_datetime as pickup_datetime, tpep_dropoff_datetime as dropoff_datetime
  from bridge_both
)"""

ZONES = """
zones as (
  select n_nationkey as LocationID,
    case when n_nationkey = 1 then 'EWR' when n_nationkey = 20 then 'Staten Island'
         when r_name = 'AFRICA' then 'Manhattan' when r_name = 'AMERICA' then 'Brooklyn'
         when r_name = 'ASIA' then 'Queens' when r_name = 'EUROPE' then 'Bronx'
         else 'Unknown' end as Borough,
    case n_nationkey when 1 then 'Newark Airport' when 2 then 'JFK Airport'
         when 3 then 'LaGuardia Airport' when 5 then 'Grand Central'
         else n_name end as Zone,
    case when n_nationkey in (1, 2, 3) then 'Airports' else 'Boro Zone' end as service_zone
  from nation join region on n_regionkey = r_regionkey
  where n_nationkey <> 24
)"""

REASON_CASE = """case
      when year(pickup_datetime) <> 2024 then 'date_infiltration: pickup year != 2024'
      when year(dropoff_datetime) <> 2024 then 'date_infiltration: dropoff year != 2024'
      when pickup_datetime >= dropoff_datetime then 'causality_violation: pickup >= dropoff'
      when trip_distance < 0 then 'invalid_distance: negative'
      when fare_amount < 0 then 'invalid_fare: negative'
      when passenger_count is null or passenger_count <= 0 then 'invalid_passengers: null or zero'
      when PULocationID is null or DOLocationID is null then 'missing_location_id'
    end"""

TAGGED = f"""
tagged as (
  select *, {REASON_CASE} as reject_reason
  from trips
)"""

KEYS = "pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, fare_amount"

KEPT = f"""
kept as (
  select * exclude (position, reject_reason) from (
    select *, row_number() over (partition by {KEYS} order by source_month nulls first) as position
    from tagged where reject_reason is null
  ) where position = 1
)"""


def derived(source: str, name: str = "derived") -> str:
    return f"""
{name} as (
  select *,
    cast(hour(pickup_datetime) as int) as pickup_hour,
    cast(dayofweek(pickup_datetime) + 1 as int) as pickup_day_of_week,
    cast(month(pickup_datetime) as int) as pickup_month,
    strftime(pickup_datetime, '%Y-%m') as pickup_year_month,
    cast(pickup_datetime as date) as pickup_date,
    dayofweek(pickup_datetime) in (0, 6) as is_weekend,
    {rnd("fare_amount + extra + mta_tax + tip_amount + tolls_amount + improvement_surcharge", 2)} as total_cost,
    case when fare_amount > 0 then {rnd("tip_amount / fare_amount * 100", 1)} end as tip_pct,
    case payment_type when 1 then 'credit_card' when 2 then 'cash' when 3 then 'no_charge'
         when 4 then 'dispute' else 'unknown' end as payment_type_label,
    avg_speed_mph > 100 as is_speed_outlier
  from (
    select *, case when trip_duration_min > 0
                   then {rnd("trip_distance / (trip_duration_min / 60)", 2)} end as avg_speed_mph
    from (select *, {rnd("date_diff('second', pickup_datetime, dropoff_datetime) / 60", 2)} as trip_duration_min
          from {source})
  )
)"""


def enriched(source: str, name: str) -> str:
    return f"""
{name} as (
  select t.*, pu.Borough as pickup_borough, pu.Zone as pickup_zone, pu.service_zone as pickup_service_zone,
         dr.Borough as dropoff_borough, dr.Zone as dropoff_zone, dr.service_zone as dropoff_service_zone
  from {source} t
  left join zones pu on t.PULocationID = pu.LocationID
  left join zones dr on t.DOLocationID = dr.LocationID
)"""


def _key_part(name: str) -> str:
    return f"coalesce(cast({name} as varchar), '_dbt_utils_surrogate_key_null_')"


STAGING = f"""
staging as (
  select md5({" || '-' || ".join(_key_part(k) for k in KEYS.split(", "))}) as trip_id,
    pickup_datetime, dropoff_datetime, pickup_date, pickup_hour, pickup_day_of_week, pickup_month,
    pickup_year_month, is_weekend,
    cast(PULocationID as int) as pickup_location_id, cast(DOLocationID as int) as dropoff_location_id,
    pickup_borough, pickup_zone, pickup_service_zone, dropoff_borough, dropoff_zone, dropoff_service_zone,
    trip_distance, trip_duration_min, avg_speed_mph, is_speed_outlier, passenger_count,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_cost, tip_pct,
    payment_type, payment_type_label, VendorID as vendor_id, RatecodeID as rate_code_id, store_and_fwd_flag,
    source_month, source_file
  from silver
)"""

FACT = """
fact as (
  select trip_id, cast(strftime(pickup_date, '%Y%m%d') as int) as date_key,
    pickup_location_id, dropoff_location_id, pickup_month, pickup_year_month, pickup_date,
    pickup_datetime, dropoff_datetime, pickup_hour, pickup_day_of_week, is_weekend,
    pickup_borough, pickup_zone, pickup_service_zone, dropoff_borough, dropoff_zone, dropoff_service_zone,
    passenger_count, trip_distance, trip_duration_min, avg_speed_mph,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_cost, tip_pct,
    payment_type_label, rate_code_id, vendor_id, store_and_fwd_flag,
    coalesce(pickup_borough <> dropoff_borough, false) as is_cross_borough,
    coalesce(regexp_matches(pickup_zone, 'Airport|JFK|LaGuardia'), false)
      or coalesce(regexp_matches(dropoff_zone, 'Airport|JFK|LaGuardia'), false) as is_airport_trip,
    source_month
  from staging
  where is_speed_outlier = false and trip_duration_min > 0 and trip_distance > 0
)"""

DATES = f"""
dates as (
  select cast(strftime(day, '%Y%m%d') as int) as date_key, day as calendar_date,
    cast(year(day) as int) as year, cast(quarter(day) as int) as quarter_num,
    'Q' || cast(quarter(day) as varchar) as quarter_label,
    cast(month(day) as int) as month_num, strftime(day, '%B') as month_name, strftime(day, '%b') as month_abbr,
    cast(weekofyear(day) as int) as week_of_year, strftime(day, '%A') as day_name, strftime(day, '%a') as day_abbr,
    cast(dayofweek(day) + 1 as int) as day_of_week, cast(dayofmonth(day) as int) as day_of_month,
    cast(dayofyear(day) as int) as day_of_year,
    dayofweek(day) in (0, 6) as is_weekend,
    strftime(day, '%Y-%m-%d') in ({listed(US_HOLIDAYS)}) as is_us_holiday,
    last_day(day) as last_day_of_month,
    cast(date_trunc('week', day) as date) as week_start_date,
    cast(date_trunc('month', day) as date) as month_start_date,
    cast(date_trunc('quarter', day) as date) as quarter_start_date,
    year(day) = 2024 and month(day) = 6 as is_current_month,
    year(day) = 2024 as is_current_year
  from (
    select cast(unnest(generate_series(min(cast(o_orderdate + interval 26 year as date)),
                                       max(cast(o_orderdate + interval 26 year as date)),
                                       interval 1 day)) as date) as day
    from orders
  )
)"""

DIM_ZONE = f"""
dim_zone as (
  select LocationID as location_id, Zone as zone_name, Borough as borough, service_zone,
    case when Borough = 'Manhattan' then 'core'
         when Borough in ('Brooklyn', 'Queens', 'Bronx', 'Staten Island') then 'outer'
         else 'unknown' end as borough_type,
    regexp_matches(Zone, 'Airport|JFK|LaGuardia|Newark') as is_airport_zone,
    Zone in ({listed(MAJOR_HUBS)}) as is_major_hub
  from zones
)"""

HOURLY = f"""
hourly as (
  select pickup_date, pickup_month, pickup_hour, is_weekend, pickup_location_id,
    pickup_borough, pickup_zone, pickup_service_zone,
    count(*) as total_trips, {whole("passenger_count")} as total_passengers,
    {total("total_cost")} as total_revenue, {mean("total_cost", 2)} as avg_fare_per_trip,
    {total("tip_amount")} as total_tips, {mean("tip_pct", 1)} as avg_tip_pct,
    {mean("trip_distance", 2)} as avg_trip_distance_mi, {mean("trip_duration_min", 1)} as avg_trip_duration_min,
    {mean("avg_speed_mph", 1)} as avg_speed_mph,
    count(*) filter (payment_type_label = 'credit_card') as trips_credit_card,
    count(*) filter (payment_type_label = 'cash') as trips_cash,
    count(*) filter (is_airport_trip) as airport_trips,
    count(*) filter (is_cross_borough) as cross_borough_trips,
    {ratio("total_cost", "trip_distance")} as revenue_per_mile
  from fact
  group by pickup_date, pickup_month, pickup_hour, is_weekend, pickup_location_id,
    pickup_borough, pickup_zone, pickup_service_zone
)"""

DAILY_BASE = f"""
daily_base as (
  select pickup_date, pickup_month, is_weekend, pickup_borough,
    count(*) as total_trips, {total("total_cost")} as total_revenue, {mean("total_cost", 2)} as avg_fare,
    {mean("trip_distance", 2)} as avg_distance_mi, {mean("trip_duration_min", 1)} as avg_duration_min,
    {total("tip_amount")} as total_tips, {mean("tip_pct", 1)} as avg_tip_pct,
    {whole("passenger_count")} as total_passengers,
    count(*) filter (is_airport_trip) as airport_trips,
    count(*) filter (is_cross_borough) as cross_borough_trips,
    count(distinct pickup_location_id) as active_pickup_zones
  from fact
  group by pickup_date, pickup_month, is_weekend, pickup_borough
)"""

ROW_LAG = "lag({0}, 7) over (partition by pickup_borough order by pickup_date)"
DAY_LAG = (
    "first({0}) over (partition by pickup_borough order by pickup_date"
    " range between interval 7 day preceding and interval 7 day preceding)"
)


def week_changes(lag: str) -> str:
    trips, revenue = lag.format("total_trips"), lag.format("total_revenue")
    return f"""{trips} as trips_wow_prior,
    {pct("total_trips", trips)} as trips_wow_pct_change,
    {pct("total_revenue", revenue)} as revenue_wow_pct_change"""


MONTH_WINDOW = (
    "over (partition by pickup_borough, date_trunc('month', pickup_date) order by pickup_date"
    " rows between unbounded preceding and current row)"
)
MTD = f"""cast(sum(total_trips) {MONTH_WINDOW} as bigint) as mtd_trips,
    {total("total_revenue", 2, MONTH_WINDOW)} as mtd_revenue"""
RANKS = """cast(rank() over (partition by pickup_date order by total_trips desc) as int) as borough_rank_by_trips,
    cast(rank() over (partition by pickup_date order by total_revenue desc) as int) as borough_rank_by_revenue"""

DAILY = f"""
daily as (
  select *, {week_changes(ROW_LAG)},
    {MTD},
    {RANKS}
  from daily_base
)"""

BANDS = """count(*) filter (tip_pct = 0) as trips_no_tip,
    count(*) filter (tip_pct > 0 and tip_pct <= 15) as trips_low_tip,
    count(*) filter (tip_pct > 15 and tip_pct <= 25) as trips_mid_tip,
    count(*) filter (tip_pct > 25) as trips_high_tip"""

PAYMENTS = f"""
payments as (
  select *, {share("trip_count", "partition by pickup_month, pickup_borough, is_weekend")} as payment_type_share_pct
  from (
    select pickup_month, pickup_borough, is_weekend, payment_type_label,
      count(*) as trip_count, {total("total_cost")} as total_revenue, {total("tip_amount")} as total_tips,
      {mean("tip_pct", 1)} as avg_tip_pct,
      {BANDS}
    from fact
    group by pickup_month, pickup_borough, is_weekend, payment_type_label
  )
)"""


def over(parts: list[str], select: str) -> str:
    return "with" + ",".join(parts) + "\n" + select.strip()


TO_TAGGED = [BRIDGE, TAGGED]
TO_KEPT = [*TO_TAGGED, KEPT]
TO_SILVER = [*TO_KEPT, ZONES, derived("kept"), enriched("derived", "silver")]
TO_FACT = [*TO_SILVER, STAGING, FACT]
TO_HOURLY = [*TO_FACT, HOURLY]
TO_DAILY = [*TO_FACT, DAILY_BASE, DAILY]
TO_PAYMENTS = [*TO_FACT, PAYMENTS]
TO_STAR = [*TO_FACT, DATES, DIM_ZONE]

# --- rejects, dedup, derive, enrich -------------------------------------------

ORACLES["reject_profile"] = over(
    TO_TAGGED,
    "select reject_reason, count(*) as row_count from tagged where reject_reason is not null group by reject_reason",
)

FUNNEL = f"""
  (select count(*) from tagged) as raw_rows,
  (select count(*) from tagged where reject_reason like 'date_infiltration%') as date_rejects,
  (select count(*) from tagged where reject_reason not like 'date_infiltration%') as rule_rejects,
  (select count(*) from tagged where reject_reason is null)
    - (select count(*) from (select distinct {KEYS} from tagged where reject_reason is null)) as dupes_removed,
  (select count(*) from (select distinct {KEYS} from tagged where reject_reason is null)) as silver_rows"""

ORACLES["funnel_counts"] = over(TO_TAGGED, "select" + FUNNEL)
ORACLES["quarantine_rows"] = over(TO_TAGGED, "select * from tagged where reject_reason is not null")
ORACLES["quarantine_union"] = over(
    TO_TAGGED,
    f"""
select case when reject_reason like 'date_infiltration%' then null else 'business' end as stage, reject_reason,
  count(*) as row_count, {total("fare_amount")} as fares
from tagged where reject_reason is not null group by all""",
)
ORACLES["strict_null_rules"] = over(
    TO_TAGGED,
    """
select case when PULocationID is null then 'missing_value: PULocationID'
            when passenger_count is null then 'missing_value: passenger_count'
            else reject_reason end as reject_reason, count(*) as row_count
from tagged
where PULocationID is null or passenger_count is null or reject_reason is not null
group by 1""",
)
ORACLES["dedup_keep_first"] = over(TO_KEPT, "select * exclude (source_file) from kept")
ORACLES["derived_trip_columns"] = over(
    [*TO_KEPT, derived("kept")],
    f"""
select {KEYS}, source_month, trip_duration_min, avg_speed_mph, pickup_hour, pickup_day_of_week, pickup_month,
  pickup_year_month, pickup_date, is_weekend, total_cost, tip_pct, payment_type_label, is_speed_outlier
from derived""",
)
ORACLES["zone_enrichment"] = over(
    TO_SILVER,
    f"""
select {KEYS}, pickup_borough, pickup_zone, pickup_service_zone, dropoff_borough, dropoff_zone, dropoff_service_zone
from silver""",
)
ORACLES["staging_conform"] = over([*TO_SILVER, STAGING], "select * from staging")

# --- gold ---------------------------------------------------------------------

ORACLES["fact_trips"] = over(TO_FACT, "select * from fact")
ORACLES["dim_date"] = over([DATES], "select * from dates order by calendar_date")
ORACLES["dim_zone"] = over([ZONES, DIM_ZONE], "select * from dim_zone order by location_id")
ORACLES["agg_hourly_zone"] = over(TO_HOURLY, "select * from hourly")
ORACLES["agg_daily_borough_base"] = over([*TO_FACT, DAILY_BASE], "select * from daily_base")
ORACLES["agg_daily_borough"] = over(TO_DAILY, "select * from daily")

_FEW = "select pickup_date, pickup_borough, total_trips, total_revenue, {0} from daily_base"
_TO_BASE = [*TO_FACT, DAILY_BASE]
ORACLES["wow_rows"] = over(_TO_BASE, _FEW.format(week_changes(ROW_LAG)))
ORACLES["wow_calendar"] = over(_TO_BASE, _FEW.format(week_changes(DAY_LAG)))
ORACLES["mtd_running"] = over(_TO_BASE, _FEW.format(MTD))
ORACLES["borough_rank"] = over(_TO_BASE, _FEW.format(RANKS))

_MONTH_LAG = (
    "first({0}) over (partition by pickup_borough order by month_start"
    " range between interval 1 month preceding and interval 1 month preceding)"
)
ORACLES["mom_borough"] = over(
    TO_FACT,
    f"""
select *, {pct("total_trips", _MONTH_LAG.format("total_trips"))} as trips_mom_pct_change,
  {pct("total_revenue", _MONTH_LAG.format("total_revenue"))} as revenue_mom_pct_change
from (
  select pickup_borough, cast(date_trunc('month', pickup_date) as date) as month_start,
    count(*) as total_trips, {total("total_cost")} as total_revenue
  from fact group by all
)""",
)
ORACLES["agg_payment_trends"] = over(TO_PAYMENTS, "select * from payments")
ORACLES["tip_bands"] = over(
    TO_FACT, f"select payment_type_label, count(*) as trip_count, {BANDS} from fact group by payment_type_label"
)
ORACLES["payment_share"] = over(
    TO_FACT,
    f"""
select *, {share("trip_count", "partition by pickup_month")} as share_pct
from (select pickup_month, payment_type_label, count(*) as trip_count from fact group by all)""",
)
ORACLES["revenue_metrics"] = over(
    TO_FACT,
    f"""
select pickup_borough, {total("total_cost")} as total_revenue, {mean("total_cost", 2)} as avg_fare_per_trip,
  {total("tip_amount")} as total_tips, {mean("tip_pct", 1)} as avg_tip_pct,
  {ratio("total_cost", "trip_distance")} as revenue_per_mile
from fact group by pickup_borough""",
)
ORACLES["volume_metrics"] = over(
    TO_FACT,
    f"""
select pickup_borough, count(*) as total_trips, {whole("passenger_count")} as total_passengers,
  {mean("trip_distance", 2)} as avg_distance_mi, {mean("trip_duration_min", 1)} as avg_duration_min,
  {mean("avg_speed_mph", 1)} as avg_speed_mph
from fact group by pickup_borough""",
)
ORACLES["star_join_holiday"] = over(
    TO_STAR,
    f"""
select d.quarter_label, d.is_us_holiday, p.borough_type as pickup_borough_type,
  p.is_major_hub as pickup_is_major_hub, r.borough_type as dropoff_borough_type,
  r.is_airport_zone as dropoff_is_airport_zone, count(*) as trips, {total("total_cost")} as revenue
from fact f
left join dates d on f.date_key = d.date_key
left join dim_zone p on f.pickup_location_id = p.location_id
left join dim_zone r on f.dropoff_location_id = r.location_id
group by all""",
)

# --- quality ------------------------------------------------------------------


def _line(kind: str, table: str, column: str, failures: str) -> str:
    return f"""select '{kind}' as "check", '{table}' as "table", '{column}' as "column", ({failures}) as failures"""


def _nulls(table: str, source: str, *columns: str) -> list[str]:
    return [_line("not_null", table, c, f"select count(*) from {source} where {c} is null") for c in columns]


def _repeats(table: str, source: str, *columns: str) -> list[str]:
    count = "select count(*) from (select {0} from {1} where {0} is not null group by {0} having count(*) > 1)"
    return [_line("unique", table, c, count.format(c, source)) for c in columns]


def _strays(table: str, source: str, column: str, values: str) -> str:
    return _line("accepted_values", table, column, f"select count(*) from {source} where {column} not in ({values})")


def _lost(table: str, source: str, column: str, parent: str, key: str) -> str:
    found = f"select count(*) from {source} c where c.{column} is not null and not exists"
    return _line("relationships", table, column, f"{found} (select 1 from {parent} p where p.{key} = c.{column})")


def _report(parts: list[str], lines: list[str]) -> str:
    return over(parts, "\nunion all ".join(lines))


TO_ALL = [*TO_FACT, DATES, DIM_ZONE, HOURLY, DAILY_BASE, DAILY, PAYMENTS]
_LABELS = "'credit_card', 'cash', 'no_charge', 'dispute', 'unknown'"
_BOROUGHS = "'Manhattan', 'Brooklyn', 'Queens', 'Bronx', 'Staten Island', 'EWR', 'Unknown'"

NOT_NULL_LINES = [
    *_nulls(
        "silver_trips", "silver", "pickup_datetime", "dropoff_datetime", "fare_amount", "PULocationID", "DOLocationID"
    ),
    *_nulls("dim_date", "dates", "date_key", "calendar_date", "is_weekend"),
    *_nulls("dim_zone", "dim_zone", "location_id", "borough"),
    *_nulls(
        "fact_trips", "fact", "trip_id", "date_key", "pickup_location_id", "fare_amount", "total_cost",
        "trip_duration_min",
    ),
    *_nulls(
        "agg_hourly_zone", "hourly", "pickup_date", "pickup_hour", "pickup_location_id", "total_trips", "total_revenue"
    ),
    *_nulls("agg_daily_borough", "daily", "pickup_date", "pickup_borough", "total_trips"),
    *_nulls("agg_payment_trends", "payments", "pickup_month", "payment_type_label"),
]
UNIQUE_LINES = [
    *_repeats("dim_date", "dates", "date_key", "calendar_date"),
    *_repeats("dim_zone", "dim_zone", "location_id"),
    *_repeats("fact_trips", "fact", "trip_id"),
]
ACCEPTED_LINES = [
    _strays("dim_date", "dates", "is_weekend", "true, false"),
    _strays("dim_zone", "dim_zone", "borough", _BOROUGHS),
    _strays("fact_trips", "fact", "payment_type_label", _LABELS),
    _strays("agg_payment_trends", "payments", "payment_type_label", _LABELS),
]
PARENT_LINES = [
    _lost("fact_trips", "fact", "date_key", "dates", "date_key"),
    _lost("fact_trips", "fact", "pickup_location_id", "dim_zone", "location_id"),
    _lost("fact_trips", "fact", "dropoff_location_id", "dim_zone", "location_id"),
]
ASSERTION_LINES = [
    _line("assertion", "fact_trips", "no_negative_fares", "select count(*) from fact where fare_amount < 0"),
    _line(
        "assertion",
        "fact_trips",
        "pickup_before_dropoff",
        "select count(*) from fact where pickup_datetime >= dropoff_datetime or trip_duration_min <= 0",
    ),
]
ORACLES["dq_not_null"] = _report(TO_ALL, NOT_NULL_LINES)
ORACLES["dq_unique"] = _report([*TO_FACT, DATES, DIM_ZONE], UNIQUE_LINES)
ORACLES["dq_accepted_values"] = _report(TO_ALL, ACCEPTED_LINES)
ORACLES["dq_relationships"] = _report(TO_STAR, PARENT_LINES)
ORACLES["dq_raw_trips"] = _report(
    [BRIDGE, ZONES, DIM_ZONE],
    [
        *_nulls("trips", "trips", "PULocationID", "passenger_count", "fare_amount"),
        *_repeats("trips", "trips", "pickup_datetime"),
        _strays("trips", "trips", "payment_type", "1, 2, 3, 4"),
        _lost("trips", "trips", "PULocationID", "dim_zone", "location_id"),
        _line("assertion", "trips", "no_negative_fares", "select count(*) from trips where fare_amount < 0"),
    ],
)
ORACLES["assert_no_negative_fares"] = over(
    TO_FACT,
    """
select trip_id, fare_amount, pickup_datetime, pickup_borough, 'negative fare in fact_trips' as failure_reason
from fact where fare_amount < 0""",
)
_ORDER = "'causality violation: pickup >= dropoff' as failure_reason"
ORACLES["assert_pickup_before_dropoff"] = over(
    TO_FACT,
    f"""
select trip_id, pickup_datetime, dropoff_datetime, trip_duration_min, pickup_borough, {_ORDER}
from fact where pickup_datetime >= dropoff_datetime or trip_duration_min <= 0""",
)
ORACLES["raw_negative_fares"] = over(
    [BRIDGE],
    """
select pickup_datetime, fare_amount, PULocationID, 'negative fare in fact_trips' as failure_reason
from trips where fare_amount < 0""",
)
ORACLES["raw_wrong_order"] = over(
    [BRIDGE, derived("trips")],
    f"""
select pickup_datetime, dropoff_datetime, trip_duration_min, {_ORDER}
from derived where pickup_datetime >= dropoff_datetime or trip_duration_min <= 0""",
)
_ORPHANS = """select '{0}' as trip_end, {0}_location_id as location_id, count(*) as row_count
from fact where {0}_location_id not in (select location_id from dim_zone) group by {0}_location_id"""
ORACLES["fk_orphans"] = over(
    [*TO_FACT, DIM_ZONE], _ORPHANS.format("pickup") + "\nunion all " + _ORPHANS.format("dropoff")
)

# --- consumer questions -------------------------------------------------------

_ZONE_REVENUE = f"""
select pickup_zone, pickup_borough, {total("total_revenue")} as revenue, {whole("total_trips")} as trips
from hourly where {{0}} group by pickup_zone, pickup_borough
order by revenue desc, pickup_zone nulls first, pickup_borough nulls first limit 10"""
ORACLES["b1_evening_weekday_zones"] = over(
    TO_HOURLY, _ZONE_REVENUE.format("pickup_hour between 18 and 20 and not is_weekend")
)
CASH = f"""
monthly as (
  select pickup_month, cash_trips, all_trips,
    {rnd("cast(100.0 as double) * cash_trips / all_trips", 2)} as cash_share_pct
  from (select pickup_month, count(*) filter (payment_type_label = 'cash') as cash_trips, count(*) as all_trips
        from fact group by pickup_month)
)"""
ORACLES["b2_cash_by_month"] = over(
    [*TO_FACT, CASH],
    f"""
select m.*, p.cash_share_pct as prior_share_pct,
  {rnd("m.cash_share_pct - p.cash_share_pct", 2)} as share_change_points,
  {pct("m.cash_trips", "p.cash_trips")} as cash_trips_mom_pct
from monthly m left join monthly p on p.pickup_month = m.pickup_month - 1""",
)
ORACLES["b3_third_quarter_growth"] = over(
    TO_DAILY,
    f"""
select pickup_borough, max(trips_wow_pct_change) as max_wow_pct, {mean("trips_wow_pct_change", 2)} as mean_wow_pct,
  count(*) as days_compared
from daily where quarter(pickup_date) = 3 and trips_wow_pct_change is not null
group by pickup_borough order by max_wow_pct desc, pickup_borough nulls first""",
)
ORACLES["b4_airport_revenue_per_mile"] = over(
    TO_FACT,
    f"""
select is_airport_trip, count(*) as trips, {total("total_cost")} as revenue,
  {ratio("total_cost", "trip_distance")} as revenue_per_mile
from fact group by is_airport_trip""",
)
ORACLES["b5_weekend_hour_durations"] = over(
    TO_FACT,
    f"""
select pickup_hour, {mean("trip_duration_min", 2)} as avg_duration_min, count(*) as trips
from fact where is_weekend group by pickup_hour order by avg_duration_min desc, pickup_hour""",
)
ORACLES["b6_friday_evening_zones"] = over(
    TO_HOURLY, _ZONE_REVENUE.format("pickup_hour between 17 and 21 and dayofweek(pickup_date) = 5")
)
ORACLES["b7_growth_since"] = over(
    TO_DAILY,
    """
select pickup_date, pickup_borough, total_trips, trips_wow_pct_change from daily
where pickup_date >= date '2024-06-01' order by pickup_date, pickup_borough nulls first""",
)
ORACLES["b8_payment_share_by_month"] = over(
    TO_PAYMENTS,
    f"""
select *, {share("trips", "partition by pickup_month", 2)} as weighted_share_pct
from (
  select pickup_month, payment_type_label, {whole("trip_count")} as trips,
    {mean("payment_type_share_pct", 5)} as avg_share_pct
  from payments group by pickup_month, payment_type_label
)
order by pickup_month, trips desc, payment_type_label""",
)

# --- the same operators on the star tables ------------------------------------

_REGION = "partition by region order by order_date"
_WEEK = f"over ({_REGION} range between interval 7 day preceding and interval 7 day preceding)"
_MONTH = (
    "over (partition by region, date_trunc('month', order_date) order by order_date"
    " rows between unbounded preceding and current row)"
)
ORACLES["orders_daily_region_trends"] = f"""
select order_date, region, orders, revenue,
  {pct("orders", f"lag(orders, 7) over ({_REGION})")} as orders_row_pct,
  {pct("revenue", f"lag(revenue, 7) over ({_REGION})")} as revenue_row_pct,
  first(orders) {_WEEK} as orders_week_before,
  {pct("orders", f"first(orders) {_WEEK}")} as orders_wow_pct,
  {pct("revenue", f"first(revenue) {_WEEK}")} as revenue_wow_pct,
  cast(date_trunc('month', order_date) as date) as month_start,
  cast(sum(orders) {_MONTH} as bigint) as mtd_orders,
  {total("revenue", 2, _MONTH)} as mtd_revenue,
  cast(rank() over (partition by order_date order by orders desc) as int) as rank_by_orders,
  cast(rank() over (partition by order_date order by revenue desc) as int) as rank_by_revenue
from (
  select cast(o_orderdate as date) as order_date, r_name as region, count(*) as orders,
    {total("o_totalprice")} as revenue
  from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  group by all
)"""
ORACLES["lineitem_dedup"] = """
select * exclude (position) from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate nulls first, l_partkey nulls first, l_suppkey nulls first, l_quantity nulls first,
      l_extendedprice nulls first, l_discount nulls first, l_tax nulls first, l_returnflag nulls first,
      l_linestatus nulls first) as position
  from lineitem
) where position = 1"""
ORACLES["shipdate_causality"] = f"""
select case when l_shipdate < o_orderdate then 'shipped before order' else 'shipped on order day' end as reject_reason,
  l_returnflag, count(*) as row_count, {total("l_extendedprice")} as revenue
from lineitem join orders on l_orderkey = o_orderkey
where l_shipdate <= o_orderdate group by all"""
ORACLES["events_hourly_type"] = f"""
select cast(ts as date) as event_date, cast(hour(ts) as int) as event_hour, event_type, count(*) as event_count,
  count(distinct user_id) as users, {total("value")} as total_value, {mean("value", 2)} as avg_value
from events group by all"""
ORACLES["events_type_share"] = f"""
select *, {share("event_count", "partition by event_date")} as share_pct
from (select cast(ts as date) as event_date, event_type, count(*) as event_count from events group by all)"""
ORACLES["segment_share"] = f"""
select *, {share("order_count", "partition by nation")} as order_share_pct
from (
  select n_name as nation, c_mktsegment, count(*) as order_count, {total("o_totalprice")} as revenue
  from orders join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
  group by c_nationkey, n_name, c_mktsegment
)"""
ORACLES["order_price_bands"] = f"""
select case o_orderstatus when 'F' then 'filled' when 'O' then 'open' else 'other' end as status,
  count(*) filter (o_totalprice = 0) as free,
  count(*) filter (o_totalprice > 0 and o_totalprice <= 100000) as small,
  count(*) filter (o_totalprice > 100000 and o_totalprice <= 250000) as medium,
  count(*) filter (o_totalprice > 250000) as large,
  {mean("o_totalprice", 2)} as avg_price, count(distinct o_custkey) as customers
from orders group by 1"""
ORACLES["schema_drift"] = over(
    [BRIDGE],
    """
select VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, RatecodeID,
  store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount,
  cast(null as double) as tolls_amount, improvement_surcharge, extra * 2 as surge
from trips""",
)

# --- written tables -----------------------------------------------------------

ORACLES["medallion_run_log"] = over(
    TO_TAGGED,
    f"""
select 'bronze_to_silver_trips' as pipeline_name, 'all' as target_month, 'full' as run_mode,
  raw_rows, silver_rows, date_rejects + rule_rejects as quarantine_rows, dupes_removed
from (select {FUNNEL})""",
)
ORACLES["bronze_lineage"] = over(
    [BRIDGE],
    f"""
select source_month, source_file as file_name, timestamp '2024-06-15 06:00:00' as ingested_at,
  count(*) as row_count, {total("fare_amount")} as fares
from trips group by all""",
)
ORACLES["medallion_quality"] = _report(
    TO_ALL, NOT_NULL_LINES + UNIQUE_LINES + ACCEPTED_LINES + PARENT_LINES + ASSERTION_LINES
)
ORACLES["medallion_rerun"] = over(
    TO_SILVER,
    f"""
select source_month, pickup_year_month, count(*) as row_count, {total("total_cost")} as revenue
from silver group by all""",
)
ORACLES["medallion_gold"] = ORACLES["agg_daily_borough"]
_BY_BOROUGH = over(
    TO_SILVER,
    f"select pickup_borough, count(*) as trips, {total('total_cost')} as revenue from silver group by pickup_borough",
)
ORACLES["layout_range"] = _BY_BOROUGH
ORACLES["layout_zorder"] = _BY_BOROUGH

# --- streaming ----------------------------------------------------------------

ORACLES["stream_clean_and_tag"] = over(
    [*TO_TAGGED, ZONES, derived("tagged"), enriched("derived", "streamed")],
    f"""
select reject_reason, pickup_borough, count(*) as row_count, {total("total_cost")} as revenue
from streamed group by all""",
)
ORACLES["stream_hourly_events"] = f"""
select date_trunc('hour', ts) as hour_start, event_type, count(*) as event_count, {total("value")} as total_value
from events group by all"""
ORACLES["stream_dedup_keys"] = over(TO_TAGGED, f"select distinct {KEYS} from tagged where reject_reason is null")

ORACLES["bronze_extra_columns"] = over(
    TO_SILVER,
    f"""
select 'quarantine' as part, source_month, count(*) as row_count, {total("VendorID * 2.5::double")} as surcharge
from tagged where reject_reason is not null group by all
union all
select 'silver' as part, source_month, count(*) as row_count, {total("VendorID * 2.5::double")} as surcharge
from silver group by all""",
)
ORACLES["landed_twice"] = over(
    [BRIDGE],
    """
select source_month as target_month, status, count(*) as row_count
from trips, (values ('Succeeded'), ('Read')) as v(status) where source_month = '2024-03' group by all""",
)
ORACLES["sum_small_values"] = f"""
select l_returnflag, {total("l_tax / 1000", 6)} as total_tiny, {mean("l_tax / 1000", 9)} as mean_tiny
from lineitem group by all"""
