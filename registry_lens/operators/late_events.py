"""Per-period counts of late and out-of-order events: the event-period by arrival-period triangle, in SQL.

Each cell counts the events of one event day that were observed on one arrival day. Summed
along the arrivals a row of the triangle is the history of one day's count: every corrected
revision, in order. Arrivals beyond the cut-off are kept apart and enter no cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Events with both instants in microseconds and the verdict. The first observation of an id counts;
#: ties are broken by the other fields. A text without an offset is UTC.
CLASSIFIED = """
with parsed as (
  select id, kind, cast(at as bigint) * 1000000 as at_us, backfill,
         unix_micros(try_cast(case when observed_at rlike '([zZ]|[+-][0-9]{{2}}:?[0-9]{{2}})$' then observed_at else concat(observed_at, 'Z') end as timestamp)) as seen_us
  from {events}
  where id is not null
), firsts as (
  select id, min(struct(seen_us, at_us, backfill, kind)) as f
  from parsed
  where seen_us is not null
  group by id
)
select id, f.kind as kind, f.at_us as at_us, f.seen_us as seen_us,
       date_add(date'1970-01-01', cast(floor(f.at_us / 86400000000D) as int)) as event_day,
       date_add(date'1970-01-01', cast(floor(f.seen_us / 86400000000D) as int)) as arrival_day,
       case when f.seen_us - f.at_us > {hours} * 3600000000L then 'too_late'
            when floor(f.seen_us / 86400000000D) > floor(f.at_us / 86400000000D) then 'corrects'
            else 'on_time' end as verdict
from firsts
where f.at_us is not null and f.backfill is distinct from 1
"""

#: Every revision of every day and kind; revision 1 is the first count.
TRIANGLE = """
with cells as (
  select event_day, kind, greatest(arrival_day, event_day) as arrival_day, count(*) as n
  from {classified}
  where verdict <> 'too_late'
  group by 1, 2, 3
)
select event_day, kind, arrival_day, n as added,
       sum(n) over (partition by event_day, kind order by arrival_day) as total,
       row_number() over (partition by event_day, kind order by arrival_day) as revision,
       lead(arrival_day) over (partition by event_day, kind order by arrival_day) is null as is_last
from cells
"""


def classify(events: DataFrame, cut_off_hours: int = 72) -> DataFrame:
    """One row per event id with its verdict: on_time, corrects or too_late.

    Rows without id, without a readable observation time or without event time have no
    place in the triangle; back-filled events (backfill = 1) are left out, a null counts as
    not back-filled. Events observed before they happened are on time. Further columns of
    ``events`` are ignored.
    """
    return events.sparkSession.sql(CLASSIFIED, events=events, hours=int(cut_off_hours))


def revisions(events: DataFrame, cut_off_hours: int = 72) -> DataFrame:
    """The triangle, cumulated: event_day, kind, arrival_day, added, total, revision, is_last.

    Cells are few (days by days by kinds), so the windows see little data however large
    the input; the counting combines before its shuffle.
    """
    return events.sparkSession.sql(TRIANGLE, classified=classify(events, cut_off_hours))
