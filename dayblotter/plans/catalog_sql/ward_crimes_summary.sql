with counts as (
  select ward, primary_description, count(crime_id) as n from crime_data group by ward, primary_description
), tops as (
  select
    ward,
    max(if(place = 1, primary_description, null)) as dist_most_popular_crime,
    max(if(place = 2, primary_description, null)) as dist_second_most_popular_crime
  from (
    select *, row_number() over (partition by ward order by n desc, primary_description nulls last) as place from counts
  )
  where place <= 2
  group by ward
), totals as (
  select ward, sum(n) as dist_total_crimes from counts group by ward
)
select
  ward, w.alderman, dist_most_popular_crime, dist_second_most_popular_crime, dist_total_crimes,
  cast(dense_rank() over (order by dist_total_crimes desc) as bigint) as dist_total_crimes_rank
from ward_offices w join totals using (ward) join tops using (ward)
order by ward
