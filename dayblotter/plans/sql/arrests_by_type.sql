-- incidents and arrests of every type, with the place of the type by arrests
select
  primary_description,
  count(crime_id) as crimes,
  count_if(arrest = 'Y') as arrests,
  cast(dense_rank() over (order by count_if(arrest = 'Y') desc) as bigint) as arrests_rank
from crime_data
group by primary_description;
