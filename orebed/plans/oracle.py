"""Reference SQL per registered query, for a check on the same tables."""

from __future__ import annotations

# Statement text, one query per block, each headed by its name.
_TEXT = r"""
-- s1_ingest_incremental
select o_orderkey as order_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as order_timestamp, o_custkey as customer_id,
       o_orderpriority = '1-URGENT' as wants_email, o_orderstatus = 'P' as wants_sms
from orders
-- s1_schema_log
select case when o_orderstatus = 'P' then concat('P', o_orderkey) else cast(o_orderkey as varchar) end as order_id,
       case when o_orderstatus = 'F' then floor(o_totalprice) else o_totalprice end as amount, o_custkey as customer_id,
       case when o_orderstatus = 'O' then o_orderpriority end as priority,
       case when o_orderstatus = 'P' then 2 end as n_tags, cast(null as varchar) as _rescued_data
from orders
-- s1_schema_versions
select 1 as version, count(*) as n_rows, count(*) filter (o_orderstatus <> 'P') as n_ids,
       count(*) filter (o_orderstatus = 'F' or o_totalprice = floor(o_totalprice)) as n_amounts,
       count(*) filter (o_orderstatus <> 'F') as n_rescued
from orders
union all select 2, count(*), count(*) filter (o_orderstatus <> 'P'), count(*), count(*) filter (o_orderstatus = 'P') from orders
union all select 3, count(*), count(*), count(*), 0 from orders
-- l9_run_metrics
select cast(1 as bigint) as run, count(*) as rows_added from orders where o_orderstatus <> 'P'
union all select 2, count(*) from orders where o_orderstatus = 'P'
union all select 3, 0
-- l9_metric_log
with c as (
  select 'rows_read' as metric, count(*) as value from orders
  union all select 'rows', count(*) from orders
  union all select 'rows_kept', count(*) from orders
  union all select 'failed_valid_price', count(*) from orders where not o_totalprice > 50000
  union all select 'failed_valid_status', count(*) from orders where o_orderstatus not in ('F', 'O'))
select sink, metric, value from c, (values ('file'), ('batch')) s(sink)
-- p1_bronze_metadata
select *, 'orders.parquet' as source_file from orders
-- s3_rescued
select event_id, concat('{"k":"', json_extract_string(props, '$.k'), '"}') as _rescued_data from events
-- s6_csv_export
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders
-- s7_jsonl_export
select event_id, ts, user_id, event_type, value from events
-- s12_latest_status
select order_id, order_status, status_ts
from (select user_id as order_id, event_type as order_status, ts as status_ts,
             row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) t
where rn = 1
-- p2_silver_projection
select o_orderkey as order_id, o_orderdate as order_timestamp, o_custkey as customer_id from orders
-- p3_star_except
select * exclude (o_orderpriority, o_orderstatus) from orders
-- p4_filter_eq
select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'P'
-- d1_expect_warn
select o_orderkey, o_totalprice, o_totalprice > 50000 as valid_price from orders
-- d2_expect_drop
select o_orderkey, o_totalprice from orders where o_totalprice > 50000
-- d3_expect_fail
select o_orderkey, o_totalprice from orders
-- d4_expect_metrics
select 'valid_price' as constraint_name, count(*) filter (where o_totalprice > 50000) as passed,
       count(*) filter (where not o_totalprice > 50000) as failed from orders
union all
select 'valid_status', count(*) filter (where o_orderstatus in ('F', 'O')),
       count(*) filter (where o_orderstatus not in ('F', 'O')) from orders
-- d5_expect_conditional
select event_id, event_type, value from events where coalesce(value > 20 or event_type = 'error', false)
-- d7_ts_vs_string
select o_orderkey, o_orderdate > '2000-01-01' as valid_timestamp from orders
-- d8_quarantine
select o_orderkey, concat_ws(',', case when o_totalprice > 50000 then null else 'valid_price' end,
                                  case when o_orderstatus in ('F', 'O') then null else 'valid_status' end) as failed_rules
from orders where not (o_totalprice > 50000 and o_orderstatus in ('F', 'O'))
-- q01_null
select c_custkey, c_name from customer
where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')
-- q02_future_date
select o_orderkey, o_orderdate from orders where o_orderdate > timestamp '2001-01-01 00:00:00'
-- q03_duplicate_key
select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by l_orderkey, l_linenumber having count(*) > 1
-- q03_duplicate_rows
select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem
where (l_orderkey, l_linenumber) in
      (select (l_orderkey, l_linenumber) from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
-- q04_case_inconsistent
select p_partkey, split_part(p_name, ' ', 1) as code from part
where split_part(p_name, ' ', 1) not in (select p_type from part)
  and lower(split_part(p_name, ' ', 1)) in (select lower(p_type) from part)
-- q05_out_of_range
select c_custkey, c_acctbal from customer where c_acctbal < 0 or c_acctbal > 9000
-- q06_zero_when_status
select l_orderkey, l_linenumber, l_partkey from lineitem where l_discount = 0 and l_returnflag = 'R'
-- q07_orphan_fk
select l_orderkey, l_linenumber from lineitem
where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus <> 'P')
-- q08_negative
select s_suppkey, s_acctbal from supplier where s_acctbal < 0
-- q09_date_order
select l_orderkey, l_linenumber, l_shipdate, o_orderdate from lineitem join orders on l_orderkey = o_orderkey
where l_shipdate < o_orderdate
-- q10_ratio_bound
select l_orderkey, l_linenumber, l_partkey from lineitem join part on l_partkey = p_partkey
where l_extendedprice > l_quantity * p_retailprice * cast(1.2 as double)
-- q11_bucket_mismatch
select l_orderkey, l_linenumber, stored
from (select l_orderkey, l_linenumber, d,
             case when d - 30 <= 0 then 'Al_Dia' when d - 30 <= 30 then '1-30' when d - 30 <= 60 then '31-60'
                  when d - 30 <= 90 then '61-90' else 'Mayor_90' end as stored
      from (select l_orderkey, l_linenumber, date_diff('day', cast(l_shipdate as date), date '2001-01-01') as d
            from lineitem) a) t
where stored <> case when d <= 0 then 'Al_Dia' when d <= 30 then '1-30' when d <= 60 then '31-60'
                     when d <= 90 then '61-90' else 'Mayor_90' end
-- q12_sentinel
select p_partkey from part where p_retailprice in (cast(900.0 as double), cast(999.9 as double))
-- q13_unknown_code
select o_orderkey, o_orderstatus as code from orders where o_orderstatus not in (select l_linestatus from lineitem)
-- q14_ratio_above_one
select p_partkey, p_retailprice / 950 as ratio from part where p_retailprice / 950 > 1
-- q15_zero_with_activity
select l_orderkey, count(*) as n_lines from lineitem group by l_orderkey having max(l_discount) = 0 and min(l_discount) = 0
-- q15_zero_with_rows
select p_partkey as l_partkey, p_retailprice - 900 as excess from part
where p_retailprice = 900 and p_partkey in (select l_partkey from lineitem)
-- q16_dq_report
with r as (
  select 'customer' as table_name, 'negative_balance' as rule, count(*) as n_violations from customer where c_acctbal < 0
  union all select 'customer', 'out_of_range', count(*) from customer where c_acctbal < 0 or c_acctbal > 9000
  union all select 'supplier', 'negative_balance', count(*) from supplier where s_acctbal < 0
  union all select 'orders', 'future_date', count(*) from orders where o_orderdate > timestamp '2001-01-01'
  union all select 'lineitem', 'zero_discount', count(*) from lineitem where l_discount = 0 and l_returnflag = 'R'
  union all select 'lineitem', 'duplicate_key', cast(coalesce(sum(n - 1), 0) as bigint)
    from (select count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1) t
  union all select 'lineitem', 'orphan_order', count(*) from lineitem
    where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus <> 'P'))
select * from r union all select 'all', 'all', cast(sum(n_violations) as bigint) from r
-- q16_bank_report
with d as (select date_diff('day', cast(l_shipdate as date), date '2001-01-01') as days, l_quantity, l_discount, l_tax,
                  l_extendedprice from lineitem),
k as (select cast(o_orderdate as date) as day, sum(case when o_orderstatus = 'P' then o_totalprice else 0 end) as late,
             sum(case when o_orderstatus <> 'P' then o_totalprice else 0 end) as total
      from orders group by 1),
r as (
  select 'customers' as table_name, 'missing_region' as rule, count(*) as n_violations from customer where c_acctbal < 0
  union all select 'customers', 'future_acquisition', count(*) from customer
    where date '2000-01-01' + c_nationkey * 30 > date '2001-01-01'
  union all select 'customers', 'segment_case', count(*) from customer where c_acctbal > 9000
  union all select 'customers', 'score_range', count(*) from customer where not floor(c_acctbal / 10) between 300 and 850
  union all select 'customers', 'duplicate_id', count(*) - count(distinct c_custkey) from customer
  union all select 'branches', 'missing_region', count(*) from supplier where s_acctbal < 0
  union all select 'branches', 'type_case', count(*) from supplier where s_acctbal > 9000
  union all select 'branches', 'duplicate_id', count(*) - count(distinct s_name) from supplier
  union all select 'transactions', 'zero_approved', count(*) from orders where o_orderpriority = '5-LOW' and o_orderstatus = 'F'
  union all select 'transactions', 'missing_date', count(*) from orders where o_totalprice <= 5000
  union all select 'transactions', 'negative_amount', count(*) from orders
    where o_orderpriority <> '5-LOW' and o_orderstatus = 'P' and o_totalprice > 0
  union all select 'transactions', 'orphan_customer', count(*) from orders where o_orderpriority = '1-URGENT'
  union all select 'transactions', 'orphan_branch', count(*) from orders
    where concat('Supplier#', lpad(cast(o_custkey as varchar), 9, '0')) not in (select s_name from supplier)
  union all select 'loans', 'negative_days', count(*) from d where days < 0
  union all select 'loans', 'ends_before_start', count(*) from d where l_quantity < 5
  union all select 'loans', 'balance_above_original', count(*) from d
    where l_extendedprice * (l_discount * 4 + cast(0.9 as double)) > l_extendedprice * cast(1.2 as double)
  union all select 'loans', 'missing_rate', count(*) from d where l_tax <= 0
  union all select 'loans', 'bucket_mismatch', count(*) from d
    where case when days - 30 <= 0 then 0 when days - 30 <= 30 then 1 when days - 30 <= 60 then 2
               when days - 30 <= 90 then 3 else 4 end
          <> case when days <= 0 then 0 when days <= 30 then 1 when days <= 60 then 2 when days <= 90 then 3 else 4 end
  union all select 'kpis', 'ratio_above_one', count(*) from k where total > 0 and late > total
  union all select 'kpis', 'zero_with_disbursements', count(*) from k where total = 0
  union all select 'kpis', 'growth_sentinel', count(*) from k where month(day) = 2
  union all select 'kpis', 'unknown_region', count(*) from k where dayofweek(day) = 0)
select * from r union all select 'all', 'all', cast(sum(n_violations) as bigint) from r
-- c1_scd1
select user_id, ts, value
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) t
where rn = 1 and event_type <> 'error'
-- c2_scd1_incremental
select user_id, ts, value
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) t
where rn = 1 and event_type <> 'error'
-- c4_keyed_log
select user_id, ts, value
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) t
where rn = 1 and event_type <> 'error'
-- c5_scd2
select user_id, value, ts as start_at, nx as end_at, nx is null as is_current
from (select *, lead(ts) over (partition by user_id order by ts, event_id) as nx from events) t
where event_type <> 'error'
-- c5_scd2_incremental
select user_id, value, ts as start_at, nx as end_at, nx is null as is_current
from (select *, lead(ts) over (partition by user_id order by ts, event_id) as nx from events) t
where event_type <> 'error'
-- c6_merge
with t as (select o_orderkey as k, o_totalprice as v from orders where o_orderstatus <> 'P'),
     s as (select o_orderkey as k, o_totalprice * 2 as v,
                  case when o_orderpriority = '1-URGENT' then 'DELETE' when o_orderpriority = '2-HIGH' then 'UPDATE'
                       else 'INSERT' end as op
           from orders where o_orderdate >= timestamp '1997-01-01')
select coalesce(t.k, s.k) as k, case when t.k is null then s.v when s.op = 'UPDATE' then s.v else t.v end as v
from t full outer join s on t.k = s.k
where not (t.k is not null and coalesce(s.op, '') = 'DELETE') and not (t.k is null and s.op <> 'INSERT')
-- c7_dedupe_latest
select user_id, event_type, value
from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events) t
where rn = 1
-- a1_daily_orders
select cast(o_orderdate as date) as order_date, count(*) as total_daily_orders, count(distinct o_custkey) as unique_customers
from orders group by 1
-- a1_daily_incremental
select cast(o_orderdate as date) as order_date, count(*) as total_daily_orders, count(distinct o_custkey) as unique_customers
from orders group by 1
-- a2_monthly_fact
with r as (select o_custkey, strftime(o_orderdate, '%Y-%m') as ym, o_orderpriority,
                  row_number() over (partition by o_custkey, strftime(o_orderdate, '%Y-%m')
                                     order by count(*) desc, o_orderpriority) as rn
           from orders group by 1, 2, 3)
select o.o_custkey as customer_id, strftime(o.o_orderdate, '%Y-%m') as year_month, count(*) as total_transactions,
       round(sum(o.o_totalprice), 2) as total_amount, round(avg(o.o_totalprice), 6) as avg_ticket,
       any_value(r.o_orderpriority) as top_channel
from orders o join r on o.o_custkey = r.o_custkey and strftime(o.o_orderdate, '%Y-%m') = r.ym and r.rn = 1
group by 1, 2
-- a3_table_counts
select 'orders' as table_name, count(*) as row_count from orders union all select 'customer', count(*) from customer
union all select 'events', count(*) from events union all select 'lineitem', count(*) from lineitem
-- a4_profile_summary
select c_custkey as customer_id, c_name as name, c_mktsegment as state, c_nationkey as city from customer
-- a5_npl_ratio
select c_mktsegment, round(sum(o_totalprice), 2) as portfolio,
       round(sum(case when o_orderstatus = 'P' then o_totalprice else 0 end) / sum(o_totalprice), 6) as npl_ratio
from orders join customer on o_custkey = c_custkey group by c_mktsegment
-- a5_npl_by_flag
select l_returnflag, round(sum(l_extendedprice), 2) as portfolio,
       round(sum(case when date_diff('day', cast(l_shipdate as date), date '2001-01-01') > 90 then l_extendedprice else 0 end)
             / sum(l_extendedprice), 6) as npl_ratio
from lineitem group by l_returnflag
-- a6_dpd_bucket_mix
select case when l_quantity <= 10 then 'Al_Dia' when l_quantity <= 20 then '1-30' when l_quantity <= 30 then '31-60'
            when l_quantity <= 40 then '61-90' else 'Mayor_90' end as dpd_bucket,
       count(*) as n_loans, round(sum(l_extendedprice), 2) as balance
from lineitem group by 1
-- a7_yoy_growth
with m as (select cast(year(o_orderdate) as bigint) as y, cast(month(o_orderdate) as bigint) as m, sum(o_totalprice) as t
           from orders group by 1, 2)
select a.y, a.m, round(a.t / b.t - 1, 4) as yoy_growth from m a left join m b on a.y = b.y + 1 and a.m = b.m
-- a8_kpi_daily
select n_regionkey, cast(o_orderdate as date) as kpi_date, round(sum(o_totalprice), 2) as total_portfolio,
       round(sum(case when o_orderstatus = 'P' then o_totalprice else 0 end) / sum(o_totalprice), 4) as npl_ratio,
       round(sum(case when o_orderstatus = 'O' then o_totalprice else 0 end), 2) as new_disbursements,
       round(sum(case when o_orderstatus = 'F' then o_totalprice else 0 end), 2) as collections,
       round(sum(case when o_orderstatus = 'P' then o_totalprice else 0 end) * cast(0.2 as double), 2) as provision_expense,
       count(distinct o_custkey) as active_customers
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by n_regionkey, cast(o_orderdate as date)
-- a9_metric_rollup
select r_name, n_name, count(*) as n_customers, round(sum(c_acctbal), 2) as balance
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
group by rollup(r_name, n_name)
-- a9_measures
select r_name, c_mktsegment, cast(grouping(r_name, c_mktsegment) as bigint) as level,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as portfolio,
       cast(sum(case when o_orderstatus = 'P' then cast(o_totalprice as decimal(18,2)) else 0 end) as double) as overdue,
       round(cast(sum(case when o_orderstatus = 'P' then cast(o_totalprice as decimal(18,2)) else 0 end) as double)
             / cast(sum(cast(o_totalprice as decimal(18,2))) as double), 6) as npl_ratio,
       count(distinct o_custkey) as n_customers
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
group by grouping sets ((r_name), (c_mktsegment), ())
-- a10_distinct
select distinct o_orderstatus, o_orderpriority from orders
-- j1_star_join
select o_orderkey, c_name, n_name, r_name
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
     join region on n_regionkey = r_regionkey
-- j2_left_join
select o_orderkey, c_name, c_acctbal from orders left join (select * from customer where c_acctbal >= 0) c
     on o_custkey = c.c_custkey
-- j3_lookup_default
select o_orderkey, coalesce(c.c_mktsegment, 'NONE') as segment
from orders left join (select * from customer where c_acctbal >= 0) c on o_custkey = c.c_custkey
-- j4_left_semi
select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')
-- j5_left_anti
select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')
-- j6_stream_stream
select a.event_id as click_id, b.event_id as purchase_id
from events a join events b on a.user_id = b.user_id and a.event_type = 'click' and b.event_type = 'purchase'
     and b.ts >= a.ts and b.ts <= a.ts + interval 1 hour
-- j6_stream_late
with due as (
  select *, least(cast(floor((day(ts) - 1) / 8) as int), 3) as slice from events where event_type in ('click', 'purchase')
), came as (
  select *, least(slice + case when event_id % 50 = 7 then 1 else 0 end, 3) as batch from due
), marks as (
  select b.batch, max(epoch_ms(c.ts)) - 7200000 as mark from (select distinct batch from came) b left join came c on c.batch < b.batch
  group by b.batch
), judged as (
  select came.*, coalesce(epoch_us(ts) < 1000 * mark, false) as late from came join marks using (batch)
)
select 'pair' as kind, a.event_id as click_id, b.event_id as purchase_id
from judged a join judged b on a.user_id = b.user_id and a.event_type = 'click' and b.event_type = 'purchase'
     and b.ts >= a.ts and b.ts <= a.ts + interval 1 hour and not a.late and not b.late
union all
select 'late', case when event_type = 'click' then event_id end, case when event_type = 'purchase' then event_id end
from judged where late
-- u1_union_all
select o_custkey as k from orders union all select c_custkey from customer
-- u2_except_distinct
select c_custkey from customer except select o_custkey from orders where o_orderstatus = 'P'
-- o1_sort
select o_orderkey, o_orderdate from orders order by o_orderdate, o_orderkey
-- o2_topk_desc
select o_orderkey, o_orderdate, o_custkey from orders order by o_orderdate desc, o_orderkey limit 10
-- o3_limit
select count(*) as n from (select * from orders limit 10) t
-- f1_rlike_email
select c_custkey,
       regexp_matches(concat(lower(c_mktsegment), case when c_acctbal < 0 then '' else '@' end, 'shop.example.com'),
                      '^([a-zA-Z0-9_\-\.]+)@([a-zA-Z0-9_\-\.]+)\.([a-zA-Z]{2,5})$') as ok
from customer
-- f2_epoch_to_ts
select event_id, date_trunc('second', ts) as status_ts, ts as exact_ts from events
-- f6_slug
select c_custkey, regexp_replace(lower(c_name), '[^a-z0-9]', '_', 'g') as slug from customer
-- f7_id_format
select c_custkey, concat('CUS-', lpad(cast(c_custkey as varchar), 6, '0')) as customer_id,
       upper(substr(c_mktsegment, 1, 3)) as code
from customer
-- f9_contains
select p_partkey, contains(p_name, 'ring') as has_ring from part
-- f10_temporal
select o_orderkey, cast(o_orderdate as date) + 360 as maturity,
       date_diff('day', cast(o_orderdate as date), date '2001-01-01') as elapsed,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as iso
from orders
-- f11_numeric
select c_custkey, round(-abs(c_acctbal), 2) as neg, greatest(0.0, c_acctbal) as floored, least(1.0, c_acctbal / 5000) as capped
from customer
-- f12_map_default
select o_orderkey, case o_orderpriority when '1-URGENT' then 25 when '2-HIGH' then 15 when '3-MEDIUM' then 12 else 8 end as freq
from orders
-- f13_json_extract
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events
-- f15_calendar
select c.d as kpi_date, coalesce(e.n, 0) as n
from (select cast(unnest(generate_series(min(ts)::date::timestamp, max(ts)::date::timestamp, interval 1 day)) as date) as d from events) c
     left join (select cast(ts as date) as d, count(*) as n from events group by 1) e on c.d = e.d
-- l1_verify_counts
select 'orders' as table_name, count(*) as row_count from orders
union all select 'orders_clean', count(*) from orders
union all select 'order_summary', count(distinct cast(o_orderdate as date)) from orders
-- l2_verify_counts
with w as (select event_type, row_number() over (partition by user_id order by ts desc) as rn
           from events where event_type = 'error' or value >= 5)
select 'customers_raw' as table_name, count(*) as row_count from events
union all select 'customers_clean', count(*) from events where event_type = 'error' or value >= 5
union all select 'customers (current)', count(*) from w where rn = 1 and event_type <> 'error'
-- l2_verify_deleted
with w as (select user_id, event_type, row_number() over (partition by user_id order by ts desc) as rn
           from events where event_type = 'error' or value >= 5)
select concat('CUS-', lpad(cast(user_id as varchar), 6, '0')) as customer_id from events where event_type = 'error'
except
select concat('CUS-', lpad(cast(user_id as varchar), 6, '0')) from w where rn = 1 and event_type <> 'error'
-- l2_verify_city
with w as (select *, row_number() over (partition by user_id order by ts desc) as rn
           from events where event_type = 'error' or value >= 5)
select concat('CUS-', lpad(cast(user_id as varchar), 6, '0')) as customer_id,
       concat('User ', cast(user_id as varchar)) as name,
       concat('user', cast(user_id as varchar), '@example.com') as email, event_type as city, 'PU' as state
from w where rn = 1 and event_type = 'purchase'
-- l2_medallion_customers
with e as (
  select concat('CUS-', lpad(cast(user_id as varchar), 6, '0')) as customer_id,
         concat('User ', cast(user_id as varchar)) as name,
         case when value < 5 then 'unknown' else concat('user', cast(user_id as varchar), '@example.com') end as email,
         concat(cast(event_id as varchar), ' Main Street') as address, event_type as city,
         upper(substr(event_type, 1, 2)) as state,
         lpad(cast(event_id as varchar), cast(greatest(5, length(cast(event_id as varchar))) as integer), '0') as zip_code,
         event_type, ts, event_id
  from events),
w as (select *, row_number() over (partition by customer_id order by ts desc) as rn
      from e where event_type = 'error' or email <> 'unknown')
select customer_id, name, email, address, city, state, zip_code, date_trunc('second', ts) as timestamp_datetime
from w where rn = 1 and event_type <> 'error'
-- m1_amount_outlier_alert
select l_orderkey, l_linenumber, l_extendedprice
from (select *, avg(l_extendedprice) over (partition by l_suppkey) as mu,
             stddev_samp(l_extendedprice) over (partition by l_suppkey) as sd from lineitem) t
where l_extendedprice > mu + 1.7 * sd
-- m2_structuring_alert
select o_custkey, cast(o_orderdate as date) as d, count(*) as n, round(sum(o_totalprice), 2) as total
from orders group by 1, 2 having count(*) >= 2
-- m2_high_tier_alert
select l_orderkey, l_linenumber, p_partkey, p_type from lineitem join part on l_partkey = p_partkey where p_type = 'PROMO'
-- m3_group_stats_pandas
select c_mktsegment, c_nationkey, count(*) as n, round(sum(c_acctbal), 2) / count(c_acctbal) as mean_bal, round(max(c_acctbal), 2) as max_bal
from customer group by c_mktsegment, c_nationkey
-- m4_risk_features
select o_custkey, count(*) as n_loans, round(max(o_totalprice), 2) as max_amount,
       count(*) filter (where o_orderstatus = 'P') as n_past_due
from orders group by o_custkey
-- m4_fixed_score
select o_custkey, round(1.0 / (1.0 + exp(-(-1.0 + 0.05 * count(*) - 0.00001 * round(max(o_totalprice), 2)
                                           + 0.5 * count(*) filter (where o_orderstatus = 'P')))), 6) as score
from orders group by o_custkey
-- g1_row_filter
select c_custkey, r_name, c_acctbal
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
where r_name in ('ASIA', 'EUROPE')
-- g1_policy_view
with u as (select 0 as viewer, min(n_name) as u from nation union all select 1, max(n_name) from nation)
select u.viewer, c_custkey, r.r_name, case when r.r_regionkey % 2 = 0 then c_acctbal end as c_acctbal
from u join nation m on m.n_name = u.u join region r on m.n_regionkey = r.r_regionkey
join nation n on n.n_regionkey = r.r_regionkey join customer on c_nationkey = n.n_nationkey
-- g2_column_mask
select c_custkey, concat(substr(c_name, 1, 3), repeat('*', length(c_name) - 3)) as c_name,
       case when r_name in ('ASIA', 'EUROPE') then c_acctbal end as c_acctbal
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
-- g3_audit_log
select 'first' as run_id, 'customer' as table_name, 'negative_balance' as rule, count(*) as n_violations,
       sha256('struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string>') as schema_hash
from customer where c_acctbal < 0
union all
select 'second', 'customer', 'negative_balance', count(*),
       sha256('struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string>')
from customer where c_acctbal < 0
union all
select 'first', 'orders', 'future_date', count(*),
       sha256('struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>')
from orders where o_orderdate > timestamp '2000-01-01'
union all
select 'second', 'orders', 'future_date', count(*),
       sha256('struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>')
from orders where o_orderdate > timestamp '2001-01-01'
"""

# Queries that reach another query's result on another way.
SAME_RESULT = {
    "l1_medallion_orders": "a1_daily_orders",
    "l3_csv_medallion": "a2_monthly_fact",
    "s9_ensure_table": "a2_monthly_fact",
    "s12_status_feed": "s12_latest_status",
}


def statements() -> dict[str, str]:
    found: dict[str, str] = {}
    for block in _TEXT.split("\n-- ")[1:]:
        name, _, text = block.partition("\n")
        found[name.strip()] = text.strip()
    found.update({name: found[other] for name, other in SAME_RESULT.items()})
    return found
