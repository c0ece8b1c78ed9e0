select
  *,
  case
    when date_of_occurrence is null then 'unknown'
    when hour(date_of_occurrence) < 6 then 'night'
    when hour(date_of_occurrence) < 12 then 'morning'
    when hour(date_of_occurrence) < 18 then 'afternoon'
    else 'evening'
  end as time_of_day
from crime_data
