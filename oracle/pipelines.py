"""DuckDB text for the registered pipeline queries."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["json_path_cast"] = "select event_type, sum(k)::bigint as sum_k, max(k) as max_k, max(k::varchar) as max_text, 0::bigint as absent, count(*) as n from (select event_type, (props->>'$.k')::bigint as k from events) group by all"
SQL["json_paths_deep"] = """select o_orderdate::date::varchar as day, count(*) as n, sum(o_custkey)::bigint as cust, count(*) filter (n >= 4) as with_fourth, 0::bigint as never
  from orders join (select l_orderkey, count(*) as n from lineitem group by all) on l_orderkey = o_orderkey group by all"""
SQL["json_flatten"] = "select l_partkey as part, sum(l_quantity)::bigint as quantity, count(*) as n from lineitem join orders on o_orderkey = l_orderkey group by all"
SQL["json_flatten_nested"] = """select 0::bigint as pos, l_returnflag as extra, count(*) as n, sum(l_quantity)::bigint as quantity from lineitem join orders on o_orderkey = l_orderkey group by all
  union all select 1, l_linestatus, count(*), sum(l_quantity)::bigint from lineitem join orders on o_orderkey = l_orderkey group by all"""
SQL["object_nest_address"] = """select '{"c_address":[{"n_name":"' || n_name || '","r_name":"' || r_name || '"}],"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' as customer
  from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey"""
SQL["row_to_object"] = """select '{"o_orderkey":' || o_orderkey || case when o_orderstatus = 'O' then '' else ',"status":"' || o_orderstatus || '"' end || ',"o_orderpriority":"' || o_orderpriority || '"}' as object from orders"""
SQL["rows_to_json_array"] = "select o_orderkey, o_custkey, nullif(o_orderstatus, 'O') as o_orderstatus from orders order by o_totalprice desc, o_orderkey desc limit 100"
SQL["json_relational_join"] = "select c_mktsegment, count(*) as n, sum(o_orderkey)::bigint as ids from orders join customer on c_custkey = o_custkey where o_orderkey in (select l_orderkey from lineitem) group by all"
SQL["array_building"] = """select o_orderkey, o_orderstatus || '|' || o_orderkey as status_key, array_to_string(list_append(list_concat([o_orderstatus], string_split(o_orderpriority, '-')), 'end'), '|') as parts,
  len(string_split(o_orderpriority, '-')) + 2 as n_parts from orders"""
SQL["prediction_columns"] = "select doc_id, quality::bigint as class, toxic / 4 as false_probability, 1 - toxic / 4 as true_probability from labels"

_ACTION = "case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end"
_LOG = f"""log as (select user_id::varchar as key, epoch_us(ts) // 1000 as committed_at, {_ACTION} as action, 'c' || user_id % 7 as client, 'T' || user_id % 30 as ticker,
  case when user_id % 2 = 0 then 'LONG' else 'SHORT' end as position, value::decimal(18,3) as price, (props->>'$.k')::decimal(38,3) as quantity from events where event_type <> 'view')"""
SQL["cdc_sources"] = f"select 'PROD' as source_schema, if(event_type = 'view', 'AUDIT', 'LIMIT_ORDERS') as source_table, {_ACTION} as action, count(*) as n_rows from events group by all"
SQL["cdc_current_state"] = f"""with {_LOG} select key, make_timestamp(committed_at * 1000)::varchar as last_updated, client, ticker, position, price::double as price, quantity::double as quantity from (from log qualify rank() over (partition by key order by committed_at desc) = 1) where action <> 'DELETE'"""
SQL["cdc_scd2"] = f"""with {_LOG}, ranked as (
    select *, rank() over (partition by key order by committed_at desc) as score, lag(committed_at) over (partition by key order by committed_at desc, action desc) as valid_to from log)
  select key, action, client, ticker, position, if(action = 'DELETE', null, price)::double as price, if(action = 'DELETE', null, quantity)::double as quantity, score = 1 as is_latest,
    max(score) over (partition by key) + 1 - score as version, make_timestamp(committed_at * 1000)::varchar as valid_from, make_timestamp(valid_to * 1000)::varchar as valid_to from ranked"""
SQL["cdc_summary"] = f"""with {_LOG}, cur as (from log qualify rank() over (partition by key order by committed_at desc) = 1)
  select ticker, position, min(price)::double as min_price, max(price)::double as max_price, round(avg(price), 2) as average_price, sum(quantity)::double as total_shares, round(sum(quantity) * round(avg(price), 2), 2)::double as total_value_usd
  from cur where action <> 'DELETE' group by all"""
SQL["stream_current_state"] = SQL["cdc_current_state"]
SQL["stream_scd2"] = SQL["cdc_scd2"]
SQL["scd2_apply"] = """with c as (select *, c_acctbal < 0 or c_acctbal > 9000 as moved from customer), rows as (
    select 'REVIEW' as seg, '2024-06-01' as a, null as b, c_custkey from c where moved
    union all select c_mktsegment, '2024-01-01', if(moved, '2024-06-01', null), c_custkey from c
    union all select c_mktsegment, '2023-01-01', '2024-01-01', c_custkey from c where c_mktsegment = 'BUILDING'
    union all select if(moved, 'REVIEW', c_mktsegment), if(moved, '2024-06-01', '2024-01-01'), '9999-12-31', c_custkey from c)
  select seg as c_mktsegment, a as record_start_time, b as record_end_time, count(*) as n, sum(c_custkey)::bigint as keys from rows group by all"""
SQL["incremental_two_stage"] = """select 'N' || user_id % 25 as country, event_type as conditions, count(*) as n, round(sum((value + 250 - 273.15)::decimal(12,4)), 2)::double as temp, round(max(value + 260 - 273.15), 4) as hottest,
  min(strftime(date_trunc('second', ts) + interval 1 hour, '%Y-%m-%d %H:%M:%S')) as first_local, sum(user_id % 360)::double as wind_dir from events group by all"""

SQL["csv_round_trip_counts"] = "select 'source' as location, count(*) as n_rows from customer union all select 'loaded', count(*) from customer"
SQL["json_round_trip_counts"] = "select 'source' as location, count(*) as n_rows from orders union all select 'loaded', count(*) from orders"
SQL["csv_round_trip_values"] = """select s_suppkey, case s_suppkey % 4 when 0 then 'say "' || s_name || '",' || chr(10) || 'twice' when 1 then '  ' || s_name || ' ' || chr(9) when 2 then '' end as note, s_acctbal from supplier"""
_NOTE = """'a "q, ' || o_orderstatus || '" b '"""
SQL["copy_into_once"] = f"""with o as (select *, {_NOTE} as note, o_orderkey % 10 = 3 as bad from orders where o_orderstatus in ('F', 'O')),
  steps as (select unnest([1, 2, 3])::bigint as load), modes as (select unnest(['stop', 'skip', 'report']) as mode),
  seen as (from o, steps, modes where o_orderstatus = 'F' or load = 3)
  select mode, load, note, count(*) as n, sum(o_orderkey)::bigint as keys, count(*) filter (o_orderkey % 4 <> 0) as prices from seen where mode = 'stop' or not bad group by all
  union all select mode, load, 'o_orderkey: no 9 is no bigint', count(*), null, null from seen where mode = 'report' and bad group by all
  union all select 'report', load, 'fields', if(load = 3, 2, 1), null, null from steps"""
SQL["ingest_pipe"] = f"""with o as (select *, o_orderkey % 10 = 3 as bad from orders where o_orderstatus = 'P')
  select {_NOTE} as note, count(*) as n, count(*) filter (o_orderkey % 4 <> 0) as prices, count(*) as stamped from o where not bad group by all
  union all select 'rejected', count(*) filter (bad) + 1, null, null from o"""
SQL["json_pipe"] = """select o_orderpriority as priority, count(*) as n, sum(o_orderkey)::bigint as keys from orders where o_orderkey % 7 <> 0 group by all
  union all select 'no JSON', count(*), null from orders where o_orderkey % 7 = 0 having count(*) > 0"""
_col = lambda i, n, t, d, c="count(*)": f"select {i}::bigint as position, '{n}' as name, {c} as n_values, '{t}' as type, '{d}' as declared from lineitem"
SQL["infer_csv_schema"] = " union all ".join([_col(1, "l_orderkey", "bigint", "number(38,0)"), _col(2, "l_linenumber", "bigint", "number(38,0)"), _col(3, "l_extendedprice", "double", "double"),
                                              _col(4, "l_returnflag", "string", "string"), _col(5, "l_shipdate", "date", "date"), _col(6, "nothing", "string", "string", "count(*) filter (l_linenumber > 99)")])
SQL["inferred_table_text"] = """select string_agg(line, chr(10) order by i) as ddl from (values (1, 'create or replace table SUPPLIER'), (2, '('), (3, '"S_SUPPKEY" number(38,0),'), (4, '"S_NAME" string,'),
  (5, '"S_NATIONKEY" number(38,0),'), (6, '"S_ACCTBAL" double'), (7, ');')) t(i, line) where exists (from supplier)"""
SQL["positional_load"] = "select p_size::bigint as size, count(*) as n, sum(p_retailprice::decimal(10,2))::double as price from part where p_size <= 25 group by all"
SQL["null_tokens"] = "select c_custkey % 5 as rest, count(*) as n, count(*) filter (c_custkey % 5 >= 3) as known from customer group by all"
SQL["gen_rows"] = "select count(*) as n_rows, count(*) * (count(*) + 1) // 2 as sum_n, 10::bigint as shortest, 10::bigint as longest from orders"
SQL["list_files"] = "select least(3, count(*)) as files, least(3, count(*)) as filled from orders"
SQL["peek_rows"] = "select least(10, count(*)) as n, least(10, count(*)) as second from orders"
SQL["json_variant_scan"] = "select c_mktsegment as segment, count(*) as n, sum(c_custkey)::bigint as keys from customer group by all"
SQL["merge_upsert"] = """select o_orderstatus, count(*) as n, sum(t)::double as total from (select o_orderkey, if(o_orderstatus = 'P', 'M', o_orderstatus) as o_orderstatus, if(o_orderstatus = 'P', 0, o_totalprice)::decimal(12,2) as t
  from orders where o_orderkey % 10 <> 3 or o_orderstatus = 'P') group by all"""
SQL["delete_update"] = """select case when c_acctbal < 0 then 'DEBT' when c_mktsegment <> 'BUILDING' then c_mktsegment end as seg, count(*) as n, sum(c_acctbal::decimal(12,2))::double as balance from customer where c_mktsegment <> 'MACHINERY' group by all"""
SQL["snapshot_feed"] = """with old as (select o_orderkey, o_orderstatus, o_totalprice::decimal(12,2) as price from orders where o_orderkey % 10 <> 3),
  merged as (select o_orderkey, if(o_orderkey % 20 >= 13, 'M', o_orderstatus) as o_orderstatus, o_totalprice::decimal(12,2) as price from orders where o_orderkey % 10 <> 3 or o_orderkey % 20 >= 13),
  new as (select o_orderkey, o_orderstatus, price + if(o_orderkey % 11 = 0, 1, 0) as price from merged where o_orderkey % 7 <> 0),
  gone as (from old except from new), come as (from new except from old),
  moves as (select 'DELETE' as action, o_orderkey in (select o_orderkey from come) as is_update, * from gone union all select 'INSERT', o_orderkey in (select o_orderkey from gone), * from come)
  select action, is_update, count(*) as n, sum(o_orderkey)::bigint as keys, sum(price)::double as price from moves group by all
  union all select kind, null, count(*), sum(o_orderkey)::bigint, sum(price)::double from new, (select unnest(['replayed', 'read']) as kind) group by all"""
SQL["summary_maintained"] = """select o_custkey, count(*) as n_rows, sum(o_totalprice::decimal(12,2))::double as sum_price, min(o_orderdate::date)::varchar as min_day, min(o_totalprice::decimal(12,2))::double as min_price, max(o_totalprice::decimal(12,2))::double as max_price,
  count(distinct o_orderstatus) as n_distinct_o_orderstatus, count(distinct o_orderdate::date) as n_distinct_day from orders where o_orderkey % 5 = 4 or (o_totalprice <= 200000 and o_custkey % 9 <> 0) group by all"""
SQL["ctas_append"] = "select n_regionkey::bigint as n_regionkey, count(*) * if(n_regionkey = 1, 2, 1) as n from nation group by n_regionkey"

SQL["unique_violations"] = "select l_orderkey, l_linenumber::bigint as l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1"
SQL["fk_orphans"] = "select l_returnflag, count(*) as n from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P') group by all"
SQL["fk_referenced"] = "select p_brand, count(*) as n from part where p_partkey in (select l_partkey from lineitem) group by all"
SQL["quote_repair"] = """select 'A' as id, p_partkey::varchar as part_id, substr(p_name, 1, 3) || '"' || substr(p_name, 4, 30) as text1, 'other""thing' as text2, p_brand || '"TACK' as other_id, '' as text3, '' as text4, '' as text5 from part"""
SQL["typed_load_rejects"] = """select 'loaded' as side, count(*) as n, sum(c_custkey)::bigint as ids, count(*) filter (c_custkey % 7 <> 0) as balances from customer where c_custkey % 10 <> 3
  union all select 'rejected', count(*), null, count(*) from customer where c_custkey % 10 = 3"""
SQL["null_defaults"] = """select if(o_orderstatus = 'O', 'INQUEUE', o_orderstatus) as what, count(*) as n from orders group by all
  union all select 'missing ' || concat_ws(',', if(o_orderstatus = 'O', 'o_orderstatus', null), if(o_orderpriority = '5-LOW', 'o_orderpriority', null)) as what, count(*) from orders where o_orderstatus = 'O' or o_orderpriority = '5-LOW' group by all"""

_EMP = """emp as (select 'E' || s_suppkey as employee_id, 'E' || s_suppkey // 2 as reports_to, s_suppkey * 1000 + 50000 as salary, (['ENGINEERING', 'MARKETING', 'HR', 'FINANCE'])[(s_suppkey % 4 + 1)::int] as department,
  lpad((s_suppkey % 1000)::varchar, 3, '5') || '-44-' || lpad((s_suppkey * 7 % 10000)::varchar, 4, '0') as ssn from supplier)"""
_CLOSURE = f"recursive_pairs as (select employee_id as employee, reports_to as manager from emp union select c.employee, e.reports_to from recursive_pairs c join emp e on e.employee_id = c.manager)"
SQL["mask_partial"] = f"""with {_EMP} select 'ACCOUNTADMIN' as role, employee_id, null::bigint as salary, '***-**-' || substr(ssn, 8, 4) as ssn, '***' as department from emp
  union all select 'RL_PRIVACY_ADMIN', employee_id, salary, ssn, department from emp"""
_SEEN = """seen as (select role, emp.*, case role when 'RL_EMPLOYEE' then employee_id = 'E5' when 'RL_MANAGER' then employee_id in (select employee from recursive_pairs where manager = 'E3')
  when 'RL_HR_REP' then department <> 'HR' when 'RL_PRIVACY_ADMIN' then true else false end as visible from emp, (select unnest(['RL_EMPLOYEE', 'RL_MANAGER', 'RL_HR_REP', 'RL_PRIVACY_ADMIN', 'PUBLIC']) as role))"""
SQL["mask_role_matrix"] = f"with recursive {_EMP}, {_CLOSURE}, {_SEEN} select role, department, count(*) as n, sum(salary) filter (visible)::bigint as salary, count(*) filter (role <> 'RL_PRIVACY_ADMIN') as masked from seen group by all"
SQL["row_filter_by_mask"] = f"with recursive {_EMP}, {_CLOSURE}, {_SEEN} select role, employee_id, salary from seen where visible"
SQL["manager_closure"] = f"with recursive {_EMP}, {_CLOSURE} from recursive_pairs"
SQL["rollup_only_role"] = f"with {_EMP} select department, count(*) as employees, sum(salary)::bigint as total_salary from emp group by all"
SQL["tenant_view"] = "select o_orderpriority, count(*) as n, sum(o_totalprice::decimal(12,2))::double as total from orders where o_custkey in (select c_custkey from customer where c_nationkey = 7) group by all"
SQL["aes_decrypt_view"] = "select role, c_custkey, if(role = 'PII_ALLOWED', c_name, null) as decrypted from customer, (select unnest(['PII_ALLOWED', 'PUBLIC', 'BROKEN']) as role)"

_months = lambda kind, value, fmt: ", ".join(fmt.format(f"sum(if(back = {i}, {value}, 0))") + f" as {kind}{'' if i == 1 else i}" for i in range(1, 7))
SQL["cost_allocation"] = f"""with m as (select user_id % 20 as e, date_trunc('hour', ts) as a, count(*) filter (event_type = 'purchase') as credits from events group by all),
  j as (select 'WH' || e as warehouse_name, 'u' || user_id % 50 as user_name, a, x::double / sum(x) over (partition by e, a)::double * credits as credit
        from m join (select *, event_id % 97 + 1 as x from events where event_type <> 'error') on user_id % 20 = e and ts between a and a + interval 1 hour),
  k as (select *, 24 * 12 + 2 + 12 * 2000 - (year(a) * 12 + month(a)) as back from j)
  select warehouse_name, user_name, {_months('credits_in_prev_month', 'credit', 'round({}, 2)')}, {_months('query_count_in_prev_month', '1', '{}::bigint')} from k group by all"""
SQL["month_offset_pivot"] = "select o_orderpriority, " + ", ".join(f"sum(o_totalprice::decimal(12,2)) filter (2001 * 12 + 6 - year(o_orderdate) * 12 - month(o_orderdate) = {i})::double as prev_month{i}" for i in range(1, 7)) + \
    " from orders where o_orderdate >= timestamp '2000-12-01' and o_orderdate < timestamp '2001-06-01' group by all"
SQL["privacy_erasure"] = """with p as (select o_custkey as c, o_totalprice::decimal(18,2) as price, (o_totalprice - if(o_custkey % 3 = 0, 10, 0))::decimal(18,2) as paid, o_orderdate::date as d from orders where o_custkey % 2 = 0 or year(o_orderdate) < 2000),
  gone as (select c from p where c % 5 < 2 group by all having sum(price) = sum(paid) and max(d) <= date '2000-06-15')
  select 'reviews' as kind, count(*) as n, sum(o_custkey)::bigint as ids from orders where o_orderstatus = 'F' and o_custkey % 5 >= 2
  union all select 'purchases', count(*), sum(c)::bigint from p where c not in (from gone)"""
_FIT = """d as (select event_type as series, ts::date as day, sum(value::decimal(18,4))::double as y, (ts::date - date '1970-01-01')::double as x, dayofweek(ts::date) as dow from events group by all),
  w as (select series, dow, count(*) as n, avg(x) as wx, avg(y) as wy, regr_sxx(y, x) as sxx, regr_sxy(y, x) as sxy, regr_syy(y, x) as syy from d where day <= date '2024-01-21' group by all),
  s as (select series, sum(n) as days, count(*) as k, sum(sxx) as sxx, sum(sxy) / sum(sxx) as b, sum(syy) - sum(sxy) * sum(sxy) / sum(sxx) as rest, sum(n * wx) / sum(n) as mx, sum(n * wy) / sum(n) as my from w group by all),
  f as (select d.series, day, y, coalesce(wy, my) + b * (x - coalesce(wx, mx)) as fc, 1.5 * sqrt(rest / (days - k - 1)) * sqrt(1 + 1 / coalesce(n, days) + (x - coalesce(wx, mx)) ** 2 / s.sxx) as half
    from d join s using (series) left join w on w.series = d.series and w.dow = d.dow where day > date '2024-01-21'),
  an as (select *, fc - half as lo, fc + half as hi, y < fc - half or y > fc + half as bad from f)"""
SQL["anomaly_daily"] = f"with {_FIT} select series, day::varchar as ts, round(y, 4) as y, round(fc, 4) as forecast, round(lo, 4) as lower_bound, round(hi, 4) as upper_bound, bad as is_anomaly from an"
SQL["alert_exists"] = f"with {_FIT} select bool_or(bad) as fire, 'start' as since from an union all select false, 'end'"
SQL["hash_split"] = "select count(*) as n, count(*) as stable, true as near_95 from orders"
SQL["classifier_predictions"] = "select count(*) > 0 as all_scored, true as each_has_a_class, true as sums_to_one, true as accurate from lineitem"
SQL["feature_importance"] = "select 'l_discount' as first, 4::bigint as n_features, true as weights from lineitem limit 1"
SQL["class_balance"] = "select quality::bigint as quality, count(*) as cnt, count(*)::double * 100 / sum(count(*)) over ()::double as percent from labels group by all"
_SC = "sc as (select quality::bigint as q, n_chars / (n_chars + 1000) as s, (n_chars > 500)::bigint as p from labels join documents using (doc_id))"
SQL["confusion_matrix"] = f"with {_SC} select q as actual, p as predicted, count(*) as n_rows from sc group by all"
SQL["evaluation_metrics"] = f"""with {_SC}, c as (select unnest([0, 1])::bigint as class) select class, count(*) filter (q = class) as support, count(*) filter (q = class and p = class)::double / nullif(count(*) filter (p = class), 0) as precision,
  count(*) filter (q = class and p = class)::double / nullif(count(*) filter (q = class), 0) as recall, (2 * count(*) filter (q = class and p = class))::double / (count(*) filter (q = class) + count(*) filter (p = class)) as f1 from sc, c group by all"""
SQL["threshold_curve"] = f"""with {_SC}, t as (select round(s, 2) as threshold, count(*) filter (q = 1) as a, count(*) filter (q = 0) as b from sc group by all), u as (select threshold, sum(a) over w::bigint as tp, sum(b) over w::bigint as fp, sum(a) over ()::double as pa, sum(b) over ()::double as pb from t window w as (order by threshold desc))
  select threshold, tp, fp, tp::double / (tp + fp) as precision, tp::double / pa as recall, fp::double / pb as false_positive_rate from u"""
SQL["auc"] = f"with {_SC} select sum(if(a.s > b.s, 1, if(a.s = b.s, 0.5, 0)))::double / count(*)::double as auc from sc a, sc b where a.q = 1 and b.q = 0"
SQL["auc_skewed"] = """with sc as (select quality as q, if(doc_id % 50 = 0, 1, round(n_chars / (n_chars + 1000), 3) / 100000) as s from labels join documents using (doc_id))
  select sum(if(a.s > b.s, 1, if(a.s = b.s, 0.5, 0)))::double / count(*)::double as auc from sc a, sc b where a.q = 1 and b.q = 0"""
SQL["text_blob_rows"] = "select c_nationkey::bigint as c_nationkey, c_custkey as id, ' ' || c_name as name from customer"
SQL["row_count"] = "select count(*) as n_rows from orders"
SQL["summary_answer"] = "select o_custkey, sum(o_totalprice::decimal(12,2))::double as sum_total_price, count(*) as num_orders from orders where o_custkey between 55 and 60 group by all"
SQL["denorm_lookup"] = "select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, c_name from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey where c_custkey = 77"
SQL["sorted_load_counts"] = "select 'source' as location, count(*) as n_rows from lineitem union all select 'sorted', count(*) from lineitem union all select 'part 7', count(*) from lineitem where l_partkey = 7"
