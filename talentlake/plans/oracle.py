"""Equivalent DuckDB SQL per query. The cascade is spelled out level by level here, with
every left join and residual row in full, so it checks the decided form from outside."""

from __future__ import annotations

# Letter classes that fold, and the letter each becomes.
FOLDS = {
    "àáâãäå": "a",
    "èéêë": "e",
    "ìíîï": "i",
    "òóôõö": "o",
    "ùúûü": "u",
    "ýÿ": "y",
    "ñ": "n",
    "ç": "c",
}


def _folded(text: str) -> str:
    for letters, letter in FOLDS.items():
        text = f"regexp_replace({text}, '[{letters}]', '{letter}', 'g')"
    return text


def _normalized(name: str) -> str:
    spaced = f"regexp_replace(lower(trim({name})), '[.\\-'']', ' ', 'g')"
    return f"trim(regexp_replace({_folded(spaced)}, '\\s+', ' ', 'g'))"


def _number(raw: str) -> str:
    digits = f"regexp_extract({raw}, '([0-9]+(?:[.,][0-9]+)?)', 1)"
    return f"try_cast(replace({digits}, ',', '.') as double)"


RAW = "lower(trim(market_value_raw))"
NUMBER = _number(RAW)
EUR = f"""case when contains({RAW}, 'mio') then {NUMBER} * 1000000.0
    when regexp_matches({RAW}, '\\b[0-9]+(?:[.,][0-9]+)?\\s*m\\b') then {NUMBER} * 1000000.0
    when contains({RAW}, 'k') then {NUMBER} * 1000.0
    when {NUMBER} is not null then {NUMBER} else 0.0 end"""


def _letter(step: int) -> str:
    return f"chr(cast(97 + floor(person_id / {step}) % 26 as int))"


PEOPLE = f"""texts as (
  select doc_id, source, lang, regexp_extract_all(
    regexp_replace(replace(text, 'ß', 'ss'), '[ \\n]+', ' ', 'g'), '[^ ]+(?: [^ ]+){{0,2}}') as word_groups
  from documents
), placed_words as (
  select doc_id * 1000000 + unnest(range(len(word_groups))) as person_id, source, lang,
    unnest(word_groups) as words
  from texts
), people as (
  select person_id, source, lang, split_part(words, ' ', 1) as t1, split_part(words, ' ', 2) as t2,
    concat(split_part(words, ' ', 3), {_letter(1)}, {_letter(26)}, {_letter(676)}) as t3
  from placed_words
)"""

ROSTER_RAW = """roster_listed as (
  select person_id as player_id, lang as league_name,
    case when person_id % 4 = 1 then concat(substr(t1, 1, 1), '. ', t2, '-', t3)
      else concat(t1, ' ', t2, '-', t3) end as own_name,
    concat(t1, ' ', t2, '-', t3) as loan_name, source
  from people
), roster_rows as (
  select player_id, league_name, unnest(case when player_id % 20 in (1, 8, 16)
    then [{'n': own_name, 't': source}, {'n': loan_name, 't': 'loan'}]
    else [{'n': own_name, 't': source}] end) as listing
  from roster_listed
), roster_raw as (
  select player_id, listing.n as player_name_api, listing.t as team_name, league_name,
    '20240101' as extraction_date
  from roster_rows
)"""

VALUES_RAW = """values_listed as (
  select person_id,
    case when person_id % 3 = 0 then concat('zzqx', t1, ' ', t2, ' ', t3)
      when person_id % 5 = 1 then concat(substr(t1, 2), ' ', t2, ' ', t3)
      when person_id % 5 = 2 then upper(concat(t1, ' ', t2, ' ', t3))
      else concat('  ', t1, '  ', t2, ' ', t3) end as own_name,
    concat(t1, 'x ', t2, ' ', t3) as again_name,
    case when person_id % 7 = 0 then 'k. A.'
      when person_id % 7 = 1 then concat(cast(person_id % 90 + 1 as varchar), ' K €')
      when person_id % 7 = 2 then concat(cast(person_id % 90 + 1 as varchar), ',',
        cast(person_id % 10 as varchar), '0 mio. €')
      when person_id % 7 = 3 then concat('€', cast(person_id % 90 + 1 as varchar), '.5m')
      when person_id % 7 = 4 then '-'
      when person_id % 7 = 6 then concat(cast(person_id % 90 + 1 as varchar), ' mille €') end as raw
  from people
), values_rows as (
  select person_id, unnest(case when person_id % 10 = 3
    then [{'n': own_name, 'r': raw}, {'n': again_name, 'r': '2,50 mio. €'}]
    else [{'n': own_name, 'r': raw}] end) as listing
  from values_listed
), values_raw as (
  select person_id, listing.n as player_name, listing.r as market_value_raw,
    'https://values.example/listing' as scraped_url
  from values_rows
)"""

SIDES = f"""{PEOPLE}, {ROSTER_RAW}, {VALUES_RAW}, l0 as (
  select *, {_normalized("player_name_api")} as name_normalized from roster_raw
), l as (
  select *, split_part(name_normalized, ' ', -1) as last_name,
    substr(name_normalized, 1, 1) as first_initial
  from l0
), v0 as (
  select player_name, market_value_raw, {EUR} as market_value_eur,
    {_normalized("player_name")} as name_normalized
  from values_raw
), v as (
  select *, split_part(name_normalized, ' ', -1) as last_name,
    substr(name_normalized, 1, 1) as first_initial
  from v0
)"""

ROW = "player_id, player_name_api, team_name, league_name, extraction_date"
KEYS = "name_normalized, last_name, first_initial"
VALUE = "market_value_eur, market_value_raw"

BEST_ORDER = """partition by player_id order by distance asc nulls first, v_name asc nulls first,
    market_value_eur desc nulls last, market_value_raw asc nulls last, team_name, player_name_api"""


def _candidates(source: str) -> str:
    return f"""select {_of("s", f"{ROW}, {KEYS}")}, v.name_normalized as v_name, {_of("v", VALUE)},
    levenshtein(s.name_normalized, v.name_normalized) as distance
  from {source} s left join v on s.last_name = v.last_name"""


def _of(alias: str, columns: str) -> str:
    return ", ".join(f"{alias}.{c.strip()}" for c in columns.split(","))


LEVELS = f"""{SIDES}, level_1 as (
  select {_of("l", f"{ROW}, {KEYS}")}, {_of("v", VALUE)}
  from l left join v on l.name_normalized = v.name_normalized
), matched_1 as (
  select {ROW}, {VALUE}, 'exact' as match_type from level_1 where market_value_eur is not null
), unmatched_1 as (
  select {ROW}, {KEYS} from level_1 where market_value_eur is null
), level_2 as (
  select {_of("u", f"{ROW}, {KEYS}")}, {_of("v", VALUE)}
  from unmatched_1 u left join v
    on u.last_name = v.last_name and u.first_initial = v.first_initial
), matched_2 as (
  select {ROW}, {VALUE}, 'lastname_initial' as match_type
  from level_2 where market_value_eur is not null
), unmatched_2 as (
  select {ROW}, {KEYS} from level_2 where market_value_eur is null
), candidates as (
  {_candidates("unmatched_2")}
), ranked as (
  select *, row_number() over ({BEST_ORDER}) as candidate_rank from candidates
), best as (
  select * from ranked where candidate_rank = 1 and distance <= 3
), matched_3 as (
  select {ROW}, {VALUE}, 'fuzzy' as match_type from best where market_value_eur is not null
), no_match as (
  select {ROW}, 0.0::double as market_value_eur, '0' as market_value_raw,
    'no_match' as match_type
  from best where market_value_eur is null
), matched_rows as (
  select * from matched_1 union all select * from matched_2 union all select * from matched_3
), cascade as (
  select * from matched_rows union all select * from no_match
)"""

FINAL = f"""{LEVELS}, top as (
  select coalesce(max(market_value_eur), 1.0) as top_value from cascade
), final as (
  select player_id, player_name_api, team_name, league_name, market_value_eur,
    round(case when market_value_eur > 0 then market_value_eur / top_value * 100
      else 0.0 end, 6) as value_index,
    match_type, extraction_date, '20240101' as event_time
  from cascade, top
)"""

LINK = "player_id, player_name_api, team_name"
MATCH = f"{LINK}, market_value_eur, market_value_raw, match_type"

# Envelope inputs: files of up to 2000 players of each of 64 documents, and what each file holds.
FEED = f"""{PEOPLE}, {ROSTER_RAW}, feed as (
  select *, cast(floor(player_id / 64000000) * 500 + floor(player_id % 1000000 / 2000) as int) as shard,
    split_part(player_name_api, ' ', 1) as firstname,
    case when player_id % 6 <> 0 then split_part(player_name_api, ' ', -1) end as lastname,
    case when player_id % 11 = 0 then 0 when player_id % 3 = 1 then 2 else 1 end as n_statistics
  from roster_raw
)"""
SQUADS = f"""{PEOPLE}, {ROSTER_RAW}, squads as (
  select length(team_name)::bigint as team_id, team_name, player_id,
    case when player_id % 13 <> 0 then player_name_api end as player_name_api
  from roster_raw
)"""

PAGES = """landed as (
  select o_orderpriority as team_name, floor(o_orderkey / 50) as page,
    count(*) as n, count(*) filter (where o_orderstatus <> 'P') as n_with_id
  from orders group by all
)"""

LI = r"(?is)<li\b[^>]*>(.*?)</li>"
ITEMS = f"""items as (
  select page_id, url, unnest(regexp_extract_all(html, '{LI}', 1)) as item,
    unnest(range(len(regexp_extract_all(html, '{LI}', 1)))) as position
  from pages
), links as (
  select page_id, url, cast(position as int) as position,
    trim(regexp_replace(regexp_extract(item, '(?is)<a\\b[^>]*>(.*?)</a>', 1),
      '(?s)<[^>]*>', '', 'g')) as text,
    regexp_extract(item, '(?is)<a\\b[^>]*\\bhref="([^"]*)"', 1) as href
  from items
)"""

FORMATTED_VALUES = f"""with {PEOPLE}, {VALUES_RAW}
  select player_name, market_value_raw, scraped_url, {EUR} as market_value_eur,
    '20240101' as extraction_date from values_raw"""

ORACLE_SQL = {
    "parquet_scan": """select l_orderkey, l_linenumber, l_quantity, l_extendedprice
        from lineitem where l_returnflag = 'R' and l_quantity >= 25""",
    "json_envelope_scan": f"""with {FEED}
        select 'players_by_teams' as get, 61 as league, 2024 as season,
          count(*)::int as results, count(*)::int as entries,
          shard::bigint as failed_team_id
        from feed group by shard""",
    "json_schema_scan": f"""with {PEOPLE}, {VALUES_RAW}
        select player_name, market_value_raw, scraped_url from values_raw""",
    "empty_source_fallback": FORMATTED_VALUES,
    "envelope_validate": f"with {FEED} select shard, count(*)::int as results from feed group by shard",
    "snapshot_write_read": """select event_id, strftime(ts, '%Y%m%d') as event_date,
          case when strftime(ts, '%Y%m%d') = '20240115' then value * 2 else value end as value
        from events where strftime(ts, '%Y%m%d') <> '20240116'""",
    "multi_date_read": """select strftime(ts, '%Y%m%d') as event_date, event_type,
          count(*) as n, round(sum(value), 2) as total_value
        from events where strftime(ts, '%Y%m%d') between '20240105' and '20240120'
        group by all""",
    "snapshot_asof": """with asked as (select distinct strftime(l_shipdate, '%Y%m%d') as as_of from lineitem),
        present as (select distinct strftime(o_orderdate, '%Y%m%d') as day from orders)
        select as_of, max(day) as chosen_day from asked left join present on day <= as_of
        group by as_of""",
    "snapshot_read_asof": """with e as (select event_id, strftime(ts, '%Y%m%d') as event_date from events
          where cast(strftime(ts, '%d') as int) % 3 <> 0),
        asked(as_of) as (values ('19000101'), ('20240103'), ('20240115'), ('20240118'), ('20991231')),
        chosen as (select as_of, max(event_date) as event_date from asked join e on event_date <= as_of group by as_of)
        select as_of, event_date, count(*) as n, sum(event_id)::bigint as ids
        from chosen join e using (event_date) group by all""",
    "page_assembly": f"""with {PAGES}
        select 'entries' as part, team_name, sum(n)::bigint as n from landed
          where page % 7 <> 0 group by team_name
        union all select 'results', team_name, sum(n)::bigint from landed
          where page % 7 <> 0 group by team_name
        union all select 'ok_blocks', team_name, count(*) from landed
          where page % 7 <> 0 group by team_name
        union all select part, team_name, count(*) from landed,
          (values ('errors'), ('failed_pages')) parts(part)
          where page % 7 = 0 group by part, team_name
        union all select 'with id', o_orderstatus, count(*) from orders
          where o_orderstatus <> 'P' and o_orderkey <> 0 and floor(o_orderkey / 50) % 7 <> 0
          group by o_orderstatus""",
    "dimension_fallback": """select r_regionkey::bigint as team_id,
          concat('team_', r_regionkey) as team_name, 'empty' as input from region
        union all select n_nationkey::bigint, n_name, 'filled' from nation""",
    "response_triage": """with landed as (
          select event_id, event_type = 'error' as quota,
            [200, 429, 500, 404, 200, 502, 503, 504][event_id % 8 + 1] as status
          from events
        ), judged as (select *, status in (429, 500, 502, 503, 504) as retryable from landed)
        select event_id, status, retryable, quota,
          case when retryable then 'retry' when quota then 'quota' else 'ok' end as outcome
        from judged""",
    "response_verdict": """with landed as (
          select strftime(ts, '%Y%m%d') as day, user_id as team_id, event_id as attempt,
            [200, 429, 500, 404, 200, 502, 503, 504][event_id % 8 + 1] in (429, 500, 502, 503, 504) as retryable,
            event_type = 'error' and user_id % 7 = 0 as quota
          from events
        ), attempts as (
          select day, team_id, count(*) as n, bool_or(quota) as quota,
            arg_max(case when retryable then 'retry' when quota then 'quota' else 'ok' end, attempt) as outcome
          from landed group by day, team_id
        ), counts as (
          select day, count(*) as teams, count(*) filter (outcome = 'ok' and team_id % 2 = 0) as ok_teams,
            count(*) filter (outcome = 'retry' and n < 3) as open_teams, bool_or(quota) as quota
          from attempts group by day)
        select *, case when quota then 'quota' when open_teams > 0 then 'retry'
          when ok_teams > 0 then 'ok' else 'empty' end as verdict
        from counts""",
    "html_rows_extract": f"""with {ITEMS}
        select page_id, position, text, href from links where text <> '' and href <> ''""",
    "html_table_extract": f"""with {ITEMS}
        select text as player_name, href as market_value_raw, url as scraped_url from links""",
    "index_documents": f"""with {FINAL}
        select 'player_value-20240101' as _index, concat(player_id, '_20240101') as _id, {LINK},
          market_value_eur, value_index, match_type, '2024-01-01' as event_time,
          '2024-01-01' as indexed_at
        from final""",
    "upsert_latest": """select concat(user_id, '_', strftime(ts, '%Y%m%d')) as _id, event_id, value
        from events
        qualify row_number() over (partition by _id order by ts desc, event_id desc) = 1""",
    "explode_response": f"""with {FEED}
        select player_id, player_name_api, n_statistics from feed""",
    "nested_paths": f"""with {FEED}
        select player_id, firstname, lastname,
          case n_statistics when 0 then '' when 1 then team_name
            else concat(team_name, '|former') end as team_names
        from feed""",
    "first_element": f"""with {FEED}
        select player_id, case when n_statistics > 0 then team_name end as team_name,
          case when n_statistics > 0 then league_name end as league_name
        from feed""",
    "explode_nested": f"""with {SQUADS}
        select team_id, team_name, player_id, player_name_api from squads""",
    "dropna_subset": f"""with {SQUADS}
        select {LINK} from squads where player_name_api is not null""",
    "format_player_stats": f"""with {FEED}
        select player_id, player_name_api, firstname, lastname,
          concat_ws(' ', firstname, lastname) as player_name_full_api,
          case when n_statistics > 0 then team_name end as team_name,
          case when n_statistics > 0 then league_name end as league_name, extraction_date
        from feed""",
    "large_feed_scan": f"""with {FEED}
        select player_id, player_name_api, firstname, lastname,
          concat_ws(' ', firstname, lastname) as player_name_full_api,
          case when n_statistics > 0 then team_name end as team_name,
          case when n_statistics > 0 then league_name end as league_name, extraction_date
        from feed""",
    "format_roster": f"""with {SQUADS}
        select {LINK}, 'Ligue 1' as league_name, '20240101' as extraction_date
        from squads where player_name_api is not null""",
    "format_values": FORMATTED_VALUES,
    "name_normalize": f"""with {SIDES} select {LINK}, name_normalized from l""",
    "accent_fold": f"""select doc_id, {_folded("text")} as folded from documents""",
    "last_name": f"with {SIDES} select {LINK}, last_name from l",
    "first_initial": f"with {SIDES} select {LINK}, first_initial from l",
    "full_name": f"""with {PEOPLE}
        select person_id, concat_ws(' ', t1, case when person_id % 6 <> 0 then t2 end) as full_name
        from people""",
    "number_extract": f"""with {PEOPLE}, {VALUES_RAW}
        select person_id, market_value_raw, {NUMBER} as number from values_raw""",
    "money_parse": f"""with {PEOPLE}, {VALUES_RAW}
        select person_id, market_value_raw, {EUR} as market_value_eur from values_raw""",
    "money_grammar": f"""with cents as (
          select o_orderkey, round(o_totalprice * 100)::bigint as c from orders
        ), parts as (
          select o_orderkey, c, c // 100 as whole, (c // 100000)::varchar as a,
            lpad((c // 100 % 1000)::varchar, 3, '0') as b, lpad((c % 100)::varchar, 2, '0') as f
          from cents
        ), spelled as (
          select o_orderkey, c, whole, [
            a || '.' || b || ',' || f || ' €', 'EUR ' || a || ',' || b || '.' || f, a || ' ' || b || ' K',
            a || ',' || right(b, 1) || ' Mrd. €', a || '.' || b || ' mln',
            a || chr(160) || b || ' €', 'CHF ' || a || '''' || b][o_orderkey % 7 + 1] as market_value_raw
          from parts)
        select o_orderkey, market_value_raw as raw, {EUR} as by_table,
          round(case o_orderkey % 7 when 0 then c / 100.0 when 1 then c / 100.0 when 2 then whole * 1e3
            when 3 then (whole // 1000 + whole % 10 / 10.0) * 1e9 when 4 then whole * 1e3
            else whole end, 2)::double as by_grammar
        from spelled""",
    "name_compose": f"""with {SIDES} select {LINK}, name_normalized from l""",
    "edit_distance": f"""with {PEOPLE}, {VALUES_RAW}, measured as (
          select person_id, player_name,
            levenshtein({_normalized("concat_ws(' ', t1, t2, t3)")},
              {_normalized("player_name")})::int as distance
          from people join values_raw using (person_id) where player_name is not null)
        select *, case when distance <= 3 then distance else -1 end as distance_to_3
        from measured""",
    "iso_date": """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as iso_day,
          strftime(o_orderdate - interval 1 day, '%Y%m%d') as run_day
        from orders""",
    "exact_match": f"""with {LEVELS}
        select {LINK}, {VALUE},
          case when market_value_eur is not null then 'exact' end as match_type
        from level_1""",
    "residual_split": f"""with {LEVELS}
        select {LINK}, 'matched' as side from matched_1
        union all select {LINK}, 'residual' from unmatched_1""",
    "lastname_initial_match": f"""with {LEVELS}
        select {LINK}, {VALUE},
          case when market_value_eur is not null then 'lastname_initial' end as match_type
        from level_2""",
    "best_candidate": f"""with {SIDES}, candidates as ({_candidates("l")}), ranked as (
          select *, row_number() over ({BEST_ORDER}) as candidate_rank from candidates)
        select {LINK}, v_name, distance::int as distance, {VALUE}
        from ranked where candidate_rank = 1 and distance <= 3""",
    "crowded_names": """with names as (
          select distinct lower(c_mktsegment) as family, unnest([
            translate((c_custkey * 7)::varchar, '0123456789', 'abcdefghij'),
            translate(substr(md5(c_name), 1, 14), '0123456789', 'ghijklmnop')]) as given
          from customer
        ), targets as (
          select lower(c_mktsegment) as family, c_acctbal, c_name, unnest([
            translate((c_custkey * 10)::varchar, '0123456789', 'abcdefghij'),
            translate(substr(md5(c_name), 2, 14), '0123456789', 'ghijklmnop')]) as given
          from customer
        ), pairs as (
          select n.family, n.given, t.given as v_given, c_acctbal, c_name, levenshtein(n.given, t.given) as distance
          from names n join targets t on n.family = t.family
        ), ranked as (
          select *, row_number() over (partition by family, given
            order by distance, v_given, c_acctbal desc nulls last, c_name) as place
          from pairs)
        select concat(given, ' ', family) as name_normalized, least(distance, 4)::int as distance,
          case when distance <= 3 then concat(v_given, ' ', family) end as v_name,
          case when distance <= 3 then c_acctbal end as market_value_eur,
          case when distance <= 3 then c_name end as market_value_raw
        from ranked where place = 1""",
    "fuzzy_match": f"""with {LEVELS}
        select {LINK}, {VALUE}, 'fuzzy' as match_type, v_name, distance::int as distance
        from best where market_value_eur is not null""",
    "cascade_union": f"""with {LEVELS}
        select {MATCH} from matched_rows
        union all select {LINK}, market_value_eur, null, match_type from no_match""",
    "match_cascade": f"with {LEVELS} select {MATCH}, league_name from cascade",
    "match_cascade_keep_unmatched": f"""with {LEVELS}, unmatched as (
          select *, row_number() over (partition by player_id
            order by team_name, player_name_api, league_name) as listing
          from l where player_id not in (select player_id from matched_rows))
        select {MATCH}, league_name from matched_rows
        union all select {LINK}, 0.0::double, '0', 'no_match', league_name
        from unmatched where listing = 1""",
    "value_index": f"with {FINAL} select * from final",
    "bulk_write": f"""with {FINAL}, placed as (
          select *, row_number() over (partition by player_id order by market_value_eur desc nulls last,
            match_type, team_name, player_name_api) as place from final)
        select player_id, player_name_api, team_name, match_type, market_value_eur,
          (select count(distinct player_id) from final) as indexed, 0::bigint as failed
        from placed where place = 1""",
    "final_projection": f"with {FINAL} select * from final",
    "top_players": f"""with {FINAL}
        select {LINK}, market_value_eur, value_index, match_type from final
        order by market_value_eur desc, player_id, team_name, player_name_api, match_type
        limit 10""",
    "match_type_stats": f"""with {LEVELS}
        select match_type, count(*) as count from cascade group by match_type""",
    "cascade_level_counts": f"""with {LEVELS}
        select (select count(*) from l) as roster_rows,
          (select count(*) from v) as values_rows,
          (select count(*) from matched_1) as exact_rows,
          (select count(*) from unmatched_1) as unmatched_1,
          (select count(*) from matched_2) as lastname_initial_rows,
          (select count(*) from unmatched_2) as unmatched_2,
          (select count(*) from matched_3) as fuzzy_rows,
          (select count(*) from no_match) as no_match_rows,
          (select count(*) from cascade where market_value_eur > 0) as positive_rows,
          (select count(*) from cascade) as output_rows""",
    "match_rate": f"""with {LEVELS}, counted as (
          select count(*) filter (where market_value_eur > 0) as matched_rows,
            count(*) as output_rows,
            count(distinct player_id) filter (where market_value_eur > 0) as matched_players,
            (select count(distinct player_id) from l) as input_players
          from cascade)
        select *, round(matched_rows / output_rows * 100.0, 6) as match_rate,
          round(matched_players / input_players * 100.0, 6) as player_match_rate
        from counted""",
}
