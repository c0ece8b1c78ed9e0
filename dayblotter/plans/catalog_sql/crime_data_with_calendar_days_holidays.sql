select
  c.*, d.year, d.day, d.month, d.day_of_week_name, d.month_name, d.day_of_week, d.holiday_name
from crime_data c
left join `date` d on to_date(c.date_of_occurrence) = d.`date`
