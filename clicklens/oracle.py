"""DuckDB SQL that recomputes each registered query from the driver's tables.

Written independently of the Spark code: straight window functions and
GROUP BYs over the same fixture views, so a difference points at a bug in
one of the two. Column names match the Spark outputs.
"""

from __future__ import annotations

VISITS = """
visits as (
  select event_id, cast(cast(ts as date) as varchar) as date, user_id,
         concat('s', cast(user_id as varchar)) as session_id,
         (event_id*31 + user_id*17) % 10 + 1 as page_id, ts as action_time,
         case when event_type='view' then concat('kw', cast(k%6 as varchar)) end as search_keyword,
         case when event_type='click' then k%20+1 else -1 end as click_category_id,
         case when event_type='click' then k+1 else -1 end as click_product_id,
         case when event_type='purchase' then ids end as order_category_ids,
         case when event_type='purchase' then ids end as order_product_ids,
         case when event_type='signup' then ids end as pay_category_ids,
         case when event_type='signup' then ids end as pay_product_ids,
         user_id % 25 as city_id
  from (select *, case event_id%3
          when 0 then cast(k%20+1 as varchar)
          when 1 then concat(cast(k%20+1 as varchar), ',', cast((k+7)%20+1 as varchar))
          else concat(cast(k%20+1 as varchar), ',', cast((k+7)%20+1 as varchar),
               ',', cast((k+11)%20+1 as varchar)) end as ids
        from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events))
)"""

CLICKS = """
clicks as (
  select event_id, ts, r_name as area, n_name as city, cast(user_id as varchar) as uid,
         cast(cast(regexp_extract(props, '([0-9]+)', 1) as bigint) % 6 + 1 as varchar) as adid,
         cast(floor((floor(epoch_us(ts) / 1000) + 43200000) / 432000000) as bigint) as batch_id
  from events join nation on n_nationkey = user_id % 25
              join region on r_regionkey = n_regionkey
  where event_type = 'click'
)"""

# Ad-log lines, broken ones among them, and the clicks that can be read from them.
LINES = """
lines as (
  select event_id, batch_id,
         case when event_id % 97 = 0 then 'x' || whole
              when event_id % 89 = 0 then head
              when event_id % 83 = 0 then whole || chr(10)
              else whole end as value
  from (select *, concat(head, ' ', uid, ' ', adid) as whole
        from (select *, concat(cast(cast(floor(epoch_us(ts) / 1000) as bigint) as varchar), ' ',
                               replace(area, ' ', '_'), ' ', replace(city, ' ', '_')) as head from clicks))
)"""

LINE_CLICKS = """
parsed as (
  select event_id, batch_id, p[1] as time, p[2] as area, p[3] as cid, p[4] as uid, p[5] as adid
  from (select event_id, batch_id, string_split(value, ' ') as p from lines)
  where len(p) >= 5 and regexp_full_match(p[1], '[+-]?[0-9]+')
),
line_clicks as (
  select event_id, batch_id, make_timestamp(cast(time as bigint) * 1000) as ts, area, cid as city, uid, adid
  from parsed
)"""

# Java-split of a comma list (trailing empties dropped), then one row per id.
ACTIONS = """
actions as (
  select event_id, action, unnest(case when regexp_full_match(ids, ',+') then []::varchar[]
                                      else string_split(regexp_replace(ids, ',+$', ''), ',') end) as category_id
  from (select event_id,
               case when click_category_id <> -1 then 'click'
                    when order_category_ids is not null then 'order'
                    when pay_category_ids is not null then 'pay' end as action,
               case when click_category_id <> -1 then cast(click_category_id as varchar)
                    when order_category_ids is not null then order_category_ids
                    when pay_category_ids is not null then pay_category_ids end as ids
        from visits)
  where ids is not null
)"""

CATEGORY_COUNTS = """
category_counts as (
  select category_id,
         count(*) filter (where action = 'click') as click_count,
         count(*) filter (where action = 'order') as order_count,
         count(*) filter (where action = 'pay') as pay_count
  from actions group by category_id
)"""


def top_categories_cte(task_id: str, n: int) -> str:
    return f"""
top_categories as (
  select '{task_id}' as task_id, category_id, click_count, order_count, pay_count
  from category_counts
  order by click_count desc, order_count desc, pay_count desc, category_id asc
  limit {n}
)"""


def transitions_cte() -> str:
    return """
transitions as (
  select session_id, event_id, page_id as from_page,
         lead(page_id) over (partition by session_id order by action_time, event_id) as to_page
  from visits
)"""


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


def target_pairs_sql(pairs: list[tuple[int, int]]) -> str:
    return " or ".join(f"(from_page = {a} and to_page = {b})" for a, b in pairs) or "false"
