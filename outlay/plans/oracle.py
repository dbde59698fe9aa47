"""The same queries as plain SQL for DuckDB, in the straightforward form of each."""

_VIEWS = """
costs as (
  select cast(ts as date) as segments_date, cast(user_id as varchar) as customer_id,
         event_type as campaign_id, cast(round(value * 1000000) as bigint) as metrics_cost_micros,
         date_trunc('hour', ts) as last_extracted_at, event_id as src_ord
  from events),
costs_text as (
  select case when event_type = 'error' and value > 100 then 'unknown'
              else cast(cast(ts as date) as varchar) end as segments_date,
         case when event_type = 'signup' and value < 2 then null
              else cast(user_id as varchar) end as customer_id,
         event_type as campaign_id,
         case when event_type = 'error' and value < 1 then 'n/a'
              else cast(cast(round(value * 1000000) as bigint) as varchar)
         end as metrics_cost_micros,
         case when event_type = 'error' and value < 2 then 'never'
              else strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') end as last_extracted_at,
         event_id as src_ord
  from events),
accounts as (
  select case when c_acctbal >= 0 then cast(c_custkey as varchar) end as account_id,
         case c_custkey % 5 when 0 then 'EUR' when 1 then 'USD' when 2 then 'BRL'
                            when 3 then 'GBP' else 'SEK' end as currency,
         r_name as channel_type, nullif(c_mktsegment, 'FURNITURE') as brand, n_name as domain
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
order_currency as (
  select case o_custkey % 5 when 0 then 'EUR' when 1 then 'USD' when 2 then 'BRL'
                            when 3 then 'GBP' else 'SEK' end as currency, *
  from orders),
quotes as (
  select currency, least((dayofmonth(o_orderdate) - 1) // 10, 2) as third,
         count(*) as n, max(o_orderkey) as last_key, min(o_orderkey) as src_ord
  from order_currency group by 1, 2),
rates as (
  select currency, case when currency = 'SEK' then 'GBP' else 'EUR' end as base,
         cast((n + last_key) % 4000 + 500 as double) / 1000 as rate,
         cast(date '2024-01-01' + cast(third * 10 as integer) as date) as valid_from,
         cast(date '2024-01-01' + cast(third * 10 + case
           when third = 2 and currency <> 'GBP' then 10
           when currency = 'BRL' then 14 when currency = 'GBP' then 6 else 9 end as integer)
           as date) as valid_to,
         src_ord
  from quotes),
rates_text as (
  select currency, case when o_orderstatus = 'P' then 'USD' else 'EUR' end as base,
         case when o_orderpriority = '4-NOT SPECIFIED' then 'not quoted'
              when o_totalprice < 2000 then '0' else cast(o_totalprice as varchar) end as rate,
         cast(cast(date '2024-01-01' + cast(dayofmonth(o_orderdate) - 1 as integer) as date)
              as varchar) as valid_from,
         case when o_orderstatus = 'O' then 'open'
              else cast(cast(date '2024-01-01' + cast(dayofmonth(o_orderdate) + 1 as integer)
                        as date) as varchar) end as valid_to,
         o_orderkey as src_ord
  from order_currency),
first_quotes as (
  select currency as quote_currency, day, arg_min_null(rate, src_ord) as rate
  from (select q.currency, d.day, try_cast(q.rate as double) as rate, q.src_ord
        from (select distinct segments_date as day from costs) d
        join rates_text q on q.base = 'EUR' and q.currency <> 'EUR'
          and d.day between try_cast(q.valid_from as date) and try_cast(q.valid_to as date))
  group by all),
ranked as (
  select *, row_number() over (partition by campaign_id, segments_date, customer_id
                               order by last_extracted_at desc nulls last, src_ord desc)
            as extraction_rank
  from costs),
latest as (select * exclude (extraction_rank) from ranked where extraction_rank = 1),
latest_accounts as (
  select latest.*, accounts.* from latest left join accounts on customer_id = account_id),
matches as (
  select c.*, r.rate as looked_up_rate, r.valid_from, r.valid_to, r.src_ord as quote_ord
  from latest_accounts c left join rates r
    on c.currency = r.currency and r.base = 'EUR' and c.currency <> 'EUR'
   and c.segments_date between r.valid_from and r.valid_to),
priced_all as (
  select *, case when currency = 'EUR' then 1.0::double else looked_up_rate end as rate
  from matches),
priced as (
  select * from priced_all
  qualify row_number() over (partition by src_ord order by quote_ord) = 1),
audit as (
  select segments_date, domain, brand, channel_type,
         sum(metrics_cost_micros / rate) as total_spend_eur,
         cast(sum(metrics_cost_micros) as bigint) as total_metrics_cost,
         avg(rate) as rate,
         arg_min(currency, src_ord) filter (where currency is not null) as currency,
         count(distinct currency) as n_currencies,
         count(*) filter (where rate is null) as n_missing_rate,
         min(rate) as least_rate, max(rate) as greatest_rate
  from priced group by all),
spend as (
  select segments_date, domain, brand, channel_type, round(total_spend_eur, 2) as total_spend_eur
  from audit),
mismatches as (
  select *, total_metrics_cost / rate as expected_spend_eur,
         n_currencies = 1 and n_missing_rate = 0 and least_rate = greatest_rate as comparable
  from audit
  where abs(total_spend_eur - total_metrics_cost / rate)
        > 1e-8 + 1e-5 * abs(total_metrics_cost / rate)),
copies as (
  select campaign_id, segments_date, customer_id, last_extracted_at, count(*) as n
  from costs group by all having count(*) > 1),
text_copies as (
  select campaign_id, segments_date, customer_id, last_extracted_at, count(*) as n
  from costs_text group by all having count(*) > 1),
orphans as (
  select distinct customer_id from costs_text t
  where not exists (select 1 from accounts where account_id = t.customer_id)),
report as (
  select row_number() over (order by segments_date nulls first, total_spend_eur nulls first,
                            domain nulls first, brand nulls first, channel_type nulls first)
           as rank,
         strftime(segments_date, '%Y-%m-%d') as segments_date, domain as country, brand,
         channel_type, printf('%.2f', total_spend_eur) as total_spend_eur
  from spend),
shown as (
  select rank, segments_date, coalesce(country, 'None') as country,
         coalesce(brand, 'None') as brand, coalesce(channel_type, 'None') as channel_type,
         coalesce(total_spend_eur, 'NaN') as total_spend_eur
  from report
  union all
  select 0, 'segments_date', 'country', 'brand', 'channel_type', 'total_spend_eur'),
widths as (
  select max(length(segments_date))::integer as w1, max(length(country))::integer as w2,
         max(length(brand))::integer as w3, max(length(channel_type))::integer as w4,
         max(length(total_spend_eur))::integer as w5
  from shown)
"""

_GROUP = "segments_date, domain, brand, channel_type"

_TYPED_COSTS = """
select try_cast(segments_date as date) as segments_date, customer_id, campaign_id,
       cast(try_cast(metrics_cost_micros as bigint) as double) as metrics_cost_micros,
       epoch(try_cast(replace(last_extracted_at, 'Z', '') as timestamp)) as last_extracted_at,
       src_ord as event_id
from costs_text
"""

_MANY_QUOTES = """
select src_ord, segments_date, customer_id, metrics_cost_micros, currency, rate
from latest_accounts c left join first_quotes q
  on c.currency = q.quote_currency and c.segments_date = q.day
"""

_PRICED_COLUMNS = "src_ord, segments_date, customer_id, metrics_cost_micros, currency"

_HALF_EVEN = """
case when {x} - floor({x}) = 0.5 and cast(floor({x}) as bigint) % 2 = 0
     then cast(cast(floor({x}) as bigint) as varchar)
     else cast(cast(round({x}) as bigint) as varchar) end
"""

_REPORT_CHECKS = """
select 'costs_columns_present' as "check", true as passed, 0::bigint as n_bad
union all select 'accounts_columns_present', true, 0
union all select 'rates_columns_present', true, 0
union all select 'costs_customer_id_not_null', count(*) = 0, count(*)
  from costs_text where customer_id is null
union all select 'costs_segments_date_parses', count(*) = 0, count(*)
  from costs_text where try_cast(segments_date as date) is null
union all select 'costs_cost_is_numeric', count(*) = 0, count(*)
  from costs_text where try_cast(metrics_cost_micros as bigint) is null
union all select 'costs_last_extracted_at_parses', count(*) = 0, count(*)
  from costs_text where try_cast(replace(last_extracted_at, 'Z', '') as timestamp) is null
union all select 'costs_duplicate_groups', true, count(*) from text_copies
union all select 'costs_duplicate_rows', true, cast(coalesce(sum(n), 0) as bigint) from text_copies
union all select 'rates_rate_is_numeric', count(*) = 0, count(*)
  from rates_text where try_cast(rate as double) is null
union all select 'rates_rate_not_zero', count(*) = 0, count(*)
  from rates_text where try_cast(rate as double) = 0
union all select 'rates_rate_is_finite', count(*) = 0, count(*)
  from rates_text where not isfinite(try_cast(rate as double))
union all select 'rates_rate_not_negative', count(*) = 0, count(*)
  from rates_text where isfinite(try_cast(rate as double)) and try_cast(rate as double) < 0
union all select 'accounts_account_id_not_null', count(*) = 0, count(*)
  from accounts where account_id is null
union all select 'costs_customers_have_accounts', count(*) = 0, count(*) from orphans
union all select 'spend_matches_cost_over_rate', count(*) = 0, count(*)
  from mismatches where comparable
union all select 'spend_has_no_missing_rate', count(*) = 0, count(*)
  from audit where n_missing_rate > 0
union all select 'spend_eur_rate_is_one', count(*) = 0, count(*)
  from audit where currency = 'EUR' and n_currencies = 1 and rate <> 1
"""

_FINDINGS = """
findings as (
  select src_ord, customer_id, segments_date, metrics_cost_micros, last_extracted_at,
         customer_id is null as no_id, try_cast(segments_date as date) is null as no_day,
         try_cast(metrics_cost_micros as bigint) is null as no_cost,
         try_cast(replace(last_extracted_at, 'Z', '') as timestamp) is null as no_time,
         not exists (select 1 from accounts where account_id = t.customer_id) as no_account
  from costs_text t),
failed as (
  select 'costs_customer_id_not_null' as "check", customer_id as "value" from findings where no_id
  union all select 'costs_segments_date_parses', segments_date from findings where no_day
  union all select 'costs_cost_is_numeric', metrics_cost_micros from findings where no_cost
  union all select 'costs_last_extracted_at_parses', last_extracted_at from findings where no_time
  union all select 'costs_customers_have_accounts', customer_id from findings where no_account)
"""

_SELECTS = {
    # Every cell's spend in units of 2^-60, as whole numbers; read as text, the sum is rounded once.
    "daily_spend_exact": f"""
        select {_GROUP}, cast(cast(sum(units) as varchar) as double) / 1152921504606846976.0::double
                 as total_spend_eur
        from (select {_GROUP}, cast(floor(x) as hugeint) * 1152921504606846976
                     + cast(floor((x - floor(x)) * 1152921504606846976.0::double) as hugeint) as units
              from (select {_GROUP}, currency,
                           cast(sum(metrics_cost_micros) as double) / any_value(rate) as x
                    from priced group by {_GROUP}, currency))
        group by {_GROUP}""",
    "scan_csv_mixed_headers": _TYPED_COSTS,
    "keep_latest_incremental": "select * exclude (last_extracted_at) from latest",
    "dq_quarantine": """
        select src_ord, customer_id, concat_ws(' ',
                 case when no_id then 'costs_customer_id_not_null' end,
                 case when no_day then 'costs_segments_date_parses' end,
                 case when no_cost then 'costs_cost_is_numeric' end,
                 case when no_time then 'costs_last_extracted_at_parses' end,
                 case when no_account then 'costs_customers_have_accounts' end) as findings
        from findings where no_id or no_day or no_cost or no_time or no_account""",
    "dq_offenders": """
        select "check", "value", count(*) as n from failed group by "check", "value"
        qualify row_number() over (partition by "check" order by count(*) desc, "value" nulls first) <= 5""",
    "daily_spend_report_by_day": """
        select strftime(segments_date, '%Y-%m-%d') as segments_date, domain as country, brand,
               channel_type, printf('%.2f', total_spend_eur
                 * case when dayofmonth(segments_date) % 2 = 1 then 10 else 1 end) as total_spend_eur
        from spend""",
    "daily_spend": "select * from spend",
    "daily_spend_audit": f"""
        select {_GROUP}, round(total_spend_eur, 2) as total_spend_eur, total_metrics_cost,
               round(rate, 9) as rate, currency, n_currencies, n_missing_rate, least_rate,
               greatest_rate
        from audit""",
    "daily_spend_all_matches": f"""
        select {_GROUP}, round(sum(metrics_cost_micros / rate), 2) as total_spend_eur
        from priced_all group by all""",
    "daily_spend_drop_null_keys": """
        select * from spend
        where segments_date is not null and domain is not null and brand is not null
          and channel_type is not null""",
    "daily_spend_zero_fill": f"""
        select {_GROUP}, coalesce(total_spend_eur, 0) as total_spend_eur from spend""",
    "scan_csv_typed": _TYPED_COSTS,
    "scan_csv_na_tokens": """
        select src_ord as event_id, segments_date, customer_id,
               nullif(metrics_cost_micros, 'n/a') as metrics_cost_micros
        from costs_text""",
    "normalize_columns": "select event_id, user_id, event_type, value from events",
    "preprocess_costs": _TYPED_COSTS,
    "preprocess_rates": """
        select currency, base, try_cast(rate as double) as rate,
               try_cast(valid_from as date) as valid_from, try_cast(valid_to as date) as valid_to,
               src_ord
        from rates_text""",
    "row_ordinal": """
        select src_ord, customer_id, metrics_cost_micros,
               row_number() over (order by src_ord) - 1 as row_ordinal
        from costs""",
    "extraction_rank": """
        select campaign_id, segments_date, customer_id, src_ord, extraction_rank from ranked""",
    "keep_latest": "select * exclude (last_extracted_at) from latest",
    "keep_latest_max_by": "select * exclude (last_extracted_at) from latest",
    "costs_with_accounts": "select * exclude (last_extracted_at) from latest_accounts",
    "fx_interval_join": f"""
        select {_PRICED_COLUMNS}, looked_up_rate as rate, valid_from, valid_to from matches""",
    "fx_interval_join_broadcast": f"""
        select {_PRICED_COLUMNS}, looked_up_rate as rate, valid_from, valid_to from matches""",
    "fx_first_match": f"select {_PRICED_COLUMNS}, looked_up_rate as rate from priced",
    "base_currency_rate": "select src_ord, currency, looked_up_rate, rate from priced",
    "cost_eur": f"""
        select {_PRICED_COLUMNS}, rate, metrics_cost_micros / rate as cost_eur from priced""",
    "dq_costs_summary": """
        select count(*) as n_rows,
               count(*) filter (where customer_id is null) as n_null_customer_id,
               count(*) filter (where try_cast(segments_date as date) is null)
                 as n_bad_segments_date,
               count(*) filter (where try_cast(metrics_cost_micros as bigint) is null)
                 as n_bad_cost,
               count(*) filter (
                 where try_cast(replace(last_extracted_at, 'Z', '') as timestamp) is null)
                 as n_bad_last_extracted_at
        from costs_text""",
    "dq_rates_summary": """
        select count(*) as n_rows,
               count(*) filter (where try_cast(rate as double) is null) as n_bad_rate,
               count(*) filter (where try_cast(rate as double) = 0) as n_zero_rate,
               count(*) filter (where not isfinite(try_cast(rate as double)))
                 as n_not_finite_rate,
               count(*) filter (where isfinite(try_cast(rate as double))
                                  and try_cast(rate as double) < 0) as n_negative_rate
        from rates_text""",
    "dq_accounts_summary": """
        select count(*) as n_rows, count(*) filter (where account_id is null) as n_null_account_id
        from accounts""",
    "dq_orphan_customers": "select customer_id from orphans",
    "dq_orphan_customers_except": """
        select customer_id from costs_text except select account_id from accounts""",
    "dq_duplicate_groups": """
        select campaign_id, segments_date, customer_id,
               cast(last_extracted_at as varchar) as last_extracted_at, n
        from copies""",
    "dq_duplicate_rows": """
        select src_ord, campaign_id, segments_date, customer_id,
               count(*) over (partition by campaign_id, segments_date, customer_id,
                                           last_extracted_at) > 1 as is_duplicate
        from costs""",
    "dq_cost_eur_mismatch": f"""
        select {_GROUP}, round(total_spend_eur, 2) as total_spend_eur,
               round(expected_spend_eur, 2) as expected_spend_eur, comparable
        from mismatches""",
    "dq_eur_rate": f"""
        select {_GROUP}, round(spoilt, 9) as rate
        from (select *, case when total_metrics_cost % 3 = 0 then rate + 1 else rate end as spoilt
              from audit)
        where currency = 'EUR' and n_currencies = 1 and spoilt <> 1""",
    "dq_single_currency": f"""
        select {_GROUP}, round(total_spend_eur, 2) as total_spend_eur, currency from audit
        where n_currencies = 1 and n_missing_rate = 0 and least_rate = greatest_rate""",
    "dq_total": """
        select 'spend_total_matches_rows' as "check", true as passed, 0::bigint as n_bad
        from (select sum(metrics_cost_micros / rate) as by_rows from priced) p,
             (select sum(total_spend_eur) as total from audit) a
        where abs(total - by_rows) <= 1e-8 + 1e-5 * abs(by_rows)""",
    "dq_groups": """
        select 'spend_groups_match_rows' as "check", count(*) = 0 as passed, count(*) as n_bad
        from (select total_spend_eur as by_rows,
                     total_spend_eur + case when total_metrics_cost % 3 = 0 then 1e5 else 0 end as total
              from audit)
        where abs(total - by_rows) > 1e-8 + 1e-5 * abs(by_rows)""",
    "spend_text_cents": """
        select src_ord, eighths / 8.0::double as amount,
               (cents // 100)::varchar || '.' || lpad((cents % 100)::varchar, 2, '0') as amount_text
        from (select *, case when eighths * 25 % 2 = 0 then eighths * 25 // 2
                             else (eighths * 25 // 2) + (eighths * 25 // 2) % 2 end as cents
              from (select src_ord, metrics_cost_micros % 1000003 as eighths from costs))""",
    "keep_latest_hourly": """
        select strftime(hour, '%Y-%m-%d %H:%M:%S') as segments_date, customer_id, campaign_id,
               metrics_cost_micros, src_ord
        from (select c.*, date_trunc('hour', e.ts) as hour, e.ts as extracted
              from costs c join events e on c.src_ord = e.event_id)
        qualify row_number() over (partition by campaign_id, hour, customer_id
                                   order by extracted desc, src_ord desc) = 1""",
    "spend_decimal_costs": """
        select strftime(hour, '%Y-%m-%d %H:%M:%S') as segments_date, domain, brand, channel_type,
               round(sum(micros / rate), 2) as total_spend_eur
        from (select c.*, a.*, case when a.currency = 'EUR' then 1.0::double else r.rate end as rate
              from (select date_trunc('hour', e.ts) as hour, c.customer_id,
                           c.metrics_cost_micros + (c.src_ord % 100) / 100 as micros, c.src_ord,
                           c.segments_date as day
                    from costs c join events e on c.src_ord = e.event_id
                    qualify row_number() over (
                      partition by c.campaign_id, date_trunc('hour', e.ts), c.customer_id
                      order by date_trunc('second', e.ts) desc, c.src_ord desc) = 1) c
              left join accounts a on c.customer_id = a.account_id
              left join rates r on a.currency = r.currency and r.base = 'EUR'
                and a.currency <> 'EUR' and c.day between r.valid_from and r.valid_to
              qualify row_number() over (partition by c.src_ord order by r.src_ord) = 1)
        group by all""",
    "fx_first_match_many_quotes": _MANY_QUOTES,
    "fx_first_match_many_quotes_shuffled": _MANY_QUOTES,
    "daily_spend_many_quotes": f"""
        select {_GROUP}, round(sum(metrics_cost_micros
                 / case when currency = 'EUR' then 1.0::double else rate end), 2) as total_spend_eur
        from latest_accounts c left join first_quotes q
          on c.currency = q.quote_currency and c.segments_date = q.day
        group by all""",
    "dq_report": _REPORT_CHECKS,
    "daily_spend_report": "select * from report",
    "report_rank_text_order": f"""
        select row_number() over (order by segments_date nulls first, amount nulls first,
                                  domain nulls first, brand nulls first, channel_type nulls first)
                 as rank,
               strftime(segments_date, '%Y-%m-%d') as segments_date, domain as country, brand,
               channel_type, amount as total_spend_eur
        from (select *, {_HALF_EVEN.format(x="total_spend_eur")} as amount from spend)""",
    "spend_text_half_even": f"""
        select src_ord, amount, {_HALF_EVEN.format(x="amount")} as amount_text
        from (select src_ord, round(metrics_cost_micros / 100000.0::double, 1) as amount
              from costs)""",
    "report_lines": """
        select cast(rank as bigint) as line_no,
               lpad(segments_date, w1, ' ') || ' ' || lpad(country, w2, ' ') || ' '
               || lpad(brand, w3, ' ') || ' ' || lpad(channel_type, w4, ' ') || '  '
               || lpad(total_spend_eur, w5, ' ') as line
        from shown, widths""",
}


def oracle_sql() -> dict[str, str]:
    return {name: f"with {_VIEWS}, {_FINDINGS} {select}" for name, select in _SELECTS.items()}
