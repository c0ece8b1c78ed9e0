-- Means to two places, half away from zero; days without incidents do not count.
with days as (
  select to_date(date_of_occurrence) as `date`, count(crime_id) as n from crime_data group by 1
), kinds as (
  select if(d.holiday_name is null, 'N', 'Y') as holiday, sum(n) as total, count(*) as days
  from days join `date` d using (`date`)
  group by 1
)
select
  cast(cast(((200 * total + days) div (2 * days)) * 0.01 as decimal(20, 2)) as double) as average_crimes_count,
  holiday
from kinds
