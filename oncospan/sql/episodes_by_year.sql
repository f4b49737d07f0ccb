-- Episodes of one kind by gender and year of their start, groups of at least :least persons.
select p.gender_source_value as gender, cast(year(e.episode_start_date) as int) as start_year,
       count(*) as n_episodes, count(distinct e.person_id) as n_persons
from episode e join person p on p.person_id = e.person_id
where e.episode_concept_id = :kind
group by p.gender_source_value, year(e.episode_start_date)
having count(distinct e.person_id) >= :least
