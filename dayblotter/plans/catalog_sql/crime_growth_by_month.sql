-- Incidents are counted by day before the calendar is joined.
with days as (
  select to_date(date_of_occurrence) as `date`, count(crime_id) as n from crime_data group by 1
), months as (
  select d.month as calendar_month, d.year as calendar_year, sum(n) as crime_amount
  from days join `date` d using (`date`)
  group by d.month, d.year
), changes as (
  select
    *,
    lag(crime_amount) over (order by calendar_year, calendar_month) as prev_month_crime_amount,
    crime_amount - lag(crime_amount) over (order by calendar_year, calendar_month) as diff
  from months
), rounded as (
  -- Hundredths of a percent, half away from zero.
  select
    *,
    cast(sign(diff) as bigint)
      * ((20000 * abs(diff) + prev_month_crime_amount) div (2 * prev_month_crime_amount)) as points
  from changes
)
select
  calendar_month, calendar_year, crime_amount, prev_month_crime_amount, diff,
  case
    when points is null then null
    when abs(points) < 100000 then concat(lpad(cast(cast(points * 0.01 as decimal(20, 2)) as string), 7, ' '), '%')
    when points < 0 then '-###.##%'
    else ' ###.##%'
  end as crime_growth,
  cast(cast(points * 0.01 as decimal(20, 2)) as double) as crime_growth_percent
from rounded
order by calendar_year, calendar_month
