with totals as (
  select
    cast(floor(beat / 100) as string) as district,
    count(if(arrest = 'Y', crime_id, null)) as total_arrests,
    count(crime_id) as total_crimes
  from crime_data
  group by 1
  having total_arrests > 0
)
select
  district, s.district_name, s.address, s.zip, s.phone, total_arrests, total_crimes,
  case
    when total_arrests <= total_crimes then
      concat(lpad(cast(cast(((20000 * total_arrests + total_crimes) div (2 * total_crimes)) * 0.01 as decimal(20, 2)) as string), 7, ' '), '%')
  end as arrest_percentage,
  cast(dense_rank() over (order by (10000 * total_arrests) div total_crimes desc) as bigint) as arrest_ratio_rank,
  cast(dense_rank() over (order by total_arrests) as bigint) as arrest_total_rank,
  cast(dense_rank() over (order by total_crimes) as bigint) as total_crimes_rank
from police_stations s
join totals using (district)
