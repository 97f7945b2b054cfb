"""DuckDB text for the registered operator queries."""

from __future__ import annotations

from oracle.kit import keys, lags, top

REV = "(l_extendedprice::decimal(12,2) * (1 - l_discount::decimal(4,2)))"
SQL: dict[str, str] = {}


def mean(x):
    return f"(sum({x})::double / count({x}))"


SQL["revenue_share_by_region"] = top(f"""
  select r_name, n_name, yr, v::double as revenue, v::double * 100 / sum(v) over (partition by r_name, yr)::double as share_pct from (
    select r_name, n_name, year(o_orderdate) as yr, sum({REV}) as v from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
    join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey group by all)""", "r_name, yr, revenue desc, n_name")
SQL["star_brand_by_month"] = top(f"""select year(o_orderdate) as yr, p_brand, sum({REV})::double as revenue from lineitem join part on p_partkey = l_partkey and p_type = 'PROMO'
  join orders on o_orderkey = l_orderkey where month(o_orderdate) = 11 group by all""", "yr, revenue desc, p_brand")
SQL["left_join_net"] = f"""select o_orderpriority, sum(o_totalprice::decimal(12,2) - coalesce(back, 0))::double as net, count(back) as orders_with_returns, count(*) as orders
  from orders left join (select l_orderkey, sum({REV}) as back from lineitem where l_returnflag = 'R' group by all) on l_orderkey = o_orderkey group by all"""
SQL["left_join_made_inner"] = "select o_orderstatus, count(*) as n, sum(l_quantity::decimal(12,2))::double as quantity from orders left join lineitem on l_orderkey = o_orderkey where l_quantity > 45 group by all"
_pairs = lambda y: f"(select distinct o_custkey as c, l_partkey as p, 1 as hit from lineitem join orders on o_orderkey = l_orderkey where year(o_orderdate) = {y})"
SQL["full_outer_overlap"] = f"""select count(*) filter (b.hit is null) as early_only, count(*) filter (a.hit is null) as late_only, count(*) filter (a.hit + b.hit = 2) as both
  from {_pairs(1996)} a full join {_pairs(1997)} b using (c, p)"""
SQL["anti_no_orders"] = "select c_mktsegment, count(*) as n, sum(c_acctbal::decimal(12,2))::double as balance from customer where c_custkey not in (select o_custkey from orders where year(o_orderdate) >= 2001) group by all"
SQL["semi_or_exists"] = """select c_nationkey::bigint as c_nationkey, count(*) as n from customer where exists (from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT' and year(o_orderdate) = 1997)
  or c_custkey in (select o_custkey from orders where o_totalprice > 490000) group by all"""
SQL["exists_other_supplier"] = """select l_suppkey, count(*) as n, count(distinct l_orderkey) as orders from lineitem a where l_returnflag = 'R'
  and exists (from lineitem b where b.l_orderkey = a.l_orderkey and b.l_suppkey <> a.l_suppkey) and not exists (from lineitem b where b.l_orderkey = a.l_orderkey and b.l_linestatus = 'O') group by all"""
SQL["range_join_hourly"] = """select e.event_type as event_type, count(*) as pairs, count(distinct p.event_id) as purchases, count(distinct e.event_id) as events from events e
  join (select event_id, user_id, ts as a, ts + interval 2 hour as b from events where event_type = 'purchase') p on p.user_id = e.user_id and e.ts between a and b group by all"""
SQL["shifted_year_compare"] = """with y as (select o_orderpriority, year(o_orderdate) as yr, sum(o_totalprice::decimal(12,2)) as t from orders group by all)
  select a.o_orderpriority as o_orderpriority, a.yr as yr, a.t::double as total, b.t::double as total_next, b.t::double / a.t::double as growth from y a join y b on a.o_orderpriority = b.o_orderpriority and b.yr = a.yr + 1"""
SQL["or_band_filter"] = f"""select sum({REV})::double as revenue, count(*) as n from lineitem join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
  where case p_type when 'SMALL' then l_quantity between 1 and 11 and c_mktsegment = 'BUILDING' when 'MEDIUM' then l_quantity between 10 and 20 and c_mktsegment = 'MACHINERY'
    when 'LARGE' then l_quantity between 20 and 30 and c_mktsegment = 'FURNITURE' else false end"""
SQL["corr_avg_part"] = """select sum(l_extendedprice::decimal(12,2))::double as total, count(*) as n from lineitem a
  where l_quantity > (select sum(l_quantity::bigint)::double / count(*) * 1.3::double from lineitem b where b.l_partkey = a.l_partkey)"""
SQL["corr_count_or"] = top("""select distinct p_name, p_brand from part a where p_size between 10 and 40 and (select count(*) from part b where b.p_brand = a.p_brand
  and ((b.p_type = 'PROMO' and b.p_size in (1, 2, 3) and b.p_name like '%ring') or (b.p_type = 'ECONOMY' and b.p_size in (48, 49, 50) and b.p_name like '%widget'))) > 0""", "p_name, p_brand")


def _pick(i, least):
    f = f"filter (l_quantity between {10 * i + 1} and {10 * i + 10})"
    avg = lambda x: f"sum({x}) {f}::double / count(*) {f}"
    return f"case when count(*) {f} > {least} then {avg('l_extendedprice::decimal(12,2)')} else {avg('l_discount::decimal(4,2)')} end as bucket{i + 1}"


SQL["scalar_bucket_choice"] = "select " + ", ".join(_pick(i, n) for i, n in enumerate((1000, 20000, 100, 10 ** 9, 5))) + " from lineitem"
SQL["nested_in_week"] = """select wk::date::varchar as week, count(*) as n, sum(o_totalprice::decimal(12,2))::double as total from (select *, date_trunc('week', o_orderdate) as wk from orders)
  where wk in (select date_trunc('week', o_orderdate) from orders qualify row_number() over (partition by o_orderstatus order by o_totalprice desc, o_orderkey desc) = 1) group by all"""
SQL["nonequi_residual"] = f"""select c_nationkey::bigint as c_nationkey, sum({REV})::double as revenue, count(*) as n from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
  join supplier on s_suppkey = l_suppkey and s_nationkey <> c_nationkey where l_shipdate::date > o_orderdate::date and l_shipdate::date <= o_orderdate::date + 30 group by all"""
SQL["cross_one_row_results"] = "select urgent, low, urgent::double / low as ratio from (select count(*) filter (o_orderpriority = '1-URGENT') as urgent, count(*) filter (o_orderpriority = '5-LOW') as low from orders)"
SQL["in_long_list"] = "select p_brand, count(*) as n from part where p_partkey in (select l_partkey from lineitem where l_quantity = 50 and l_discount >= 0.09::double) group by all"
SQL["cte_chain"] = """with f as (select l_partkey from lineitem group by all having count(*) > 30), s as (select o_custkey as c, l_partkey as p, l_extendedprice::decimal(12,2) as v from lineitem join orders on o_orderkey = l_orderkey),
  t as (select c, sum(v) as t from s group by all) select sum(v)::double as total, count(*) as n from s where p in (from f) and c in (select c from t where t::double > 0.6::double * (select max(t)::double from t))"""

_days = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
SQL["pivot_weekday"] = "select o_orderpriority, " + ", ".join(f"sum(o_totalprice::decimal(12,2)) filter (dayname(o_orderdate) = '{d}')::double as {d[:3].lower()}" for d in _days) + " from orders group by all"
SQL["lag_buckets"] = f"select l_returnflag, {lags('n')} from (select l_returnflag, l_shipdate::date - o_orderdate::date as n from lineitem join orders on o_orderkey = l_orderkey) group by all"
SQL["rollup_grouping"] = """select r_name, n_name, sum(o_totalprice::decimal(12,2))::double as total, count(*) as n, (grouping(r_name) + grouping(n_name))::bigint as level, grouping(n_name)::bigint as g_nation
  from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey group by rollup (r_name, n_name)"""
_k8 = "p_type, p_brand, p_size, yr, qtr, mo, l_returnflag, l_linestatus"
SQL["rollup8_top100"] = top(f"""select *, rank() over (partition by p_type order by sumsales desc nulls first) as rk from (select {_k8}, sum(v)::double as sumsales from (
  select p_type, p_brand, p_size::bigint as p_size, year(o_orderdate) as yr, quarter(o_orderdate) as qtr, month(o_orderdate) as mo, l_returnflag, l_linestatus, {REV} as v
  from lineitem join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey where year(o_orderdate) = 1998) group by rollup ({_k8})) qualify rk <= 100""", _k8 + ", sumsales, rk")
SQL["count_distinct_multi"] = "select l_returnflag, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers, count(distinct l_quantity) as quantities, count(*) as n from lineitem group by all"
SQL["stddev_cov"] = """select l_partkey, count(*) as n, round(stddev_samp(l_extendedprice), 6) as stdev,
  round(stddev_samp(l_extendedprice) / nullif(sum(l_extendedprice::decimal(12,2))::double / count(*), 0), 6) as cov from lineitem group by all having cov > 0.6 or n = 1"""
SQL["having_scalar"] = "with t as (select o_custkey, sum(o_totalprice::decimal(12,2)) as t from orders group by all) select o_custkey, t::double as total from t where t::double > (select sum(t)::double / count(t) * 1.5::double from t)"
SQL["segments_hist"] = "select round(o_totalprice / 50000)::bigint as segment, count(*) as n, segment * 50000 as segment_base from orders group by all"
SQL["ratio_to_report"] = "select o_orderstatus, count(*) as cnt, count(*)::double * 100 / sum(count(*)) over ()::double as percent from orders group by all"
SQL["agg_of_agg"] = f"select l_suppkey, {mean('v')} as avg_revenue, max(v)::double as max_revenue, count(*) as parts from (select l_suppkey, l_partkey, sum({REV}) as v from lineitem group by all) group by all"
SQL["geomean"] = "select event_type, sum(value::decimal(12,2))::double as total, round(exp(avg(ln(value))), 6) as geomean from events where value > 0 group by all"
SQL["run_time_summary"] = "select round(sum(value), 4) as total_seconds, round(exp(avg(ln(value))), 6) as geomean_seconds from events where value > 0"
SQL["distinct_groups"] = "select distinct l_returnflag, l_linestatus, l_discount::decimal(4,2)::double as discount from lineitem"
SQL["group_by_all"] = "select o_orderpriority, year(o_orderdate) as yr, count(*) as n from orders group by all"
SQL["dec_ratio"] = "select l_suppkey, round(sum(l_quantity::bigint) filter (l_returnflag = 'R')::double / sum(l_quantity::bigint)::double, 8) as return_ratio from lineitem group by all"
SQL["nested_objects"] = "select l_orderkey, string_agg(l_linenumber || ':' || l_partkey, '|' order by l_linenumber, l_partkey) as lines from lineitem group by all"

SQL["share_of_class"] = top(f"""select p_type, p_partkey, v::double as revenue, v::double * 100 / sum(v) over (partition by p_type)::double as share_pct from (
  select p_type, p_partkey, sum({REV}) as v from lineitem join part on p_partkey = l_partkey group by all)""", "p_type, revenue desc, p_partkey")
SQL["avg_over_sum_deviation"] = f"""select p_brand, qtr, v::double as sum_sales, mid as avg_sales from (select *, sum(v) over w::double / count(*) over w as mid from (
  select p_brand, quarter(o_orderdate) as qtr, sum({REV}) as v from lineitem join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey where year(o_orderdate) = 1999 group by all) window w as (partition by p_brand))
  where mid > 0 and abs(v::double - mid) / mid > 0.1"""
SQL["rank_in_rollup"] = f"""select p_type, p_brand, total, level, rank() over (partition by level, case when leaf = 0 then p_type end order by total desc nulls first) as rank_in_parent from (
  select p_type, p_brand, sum({REV})::double as total, (grouping(p_type) + grouping(p_brand))::bigint as level, grouping(p_brand) as leaf from lineitem join part on p_partkey = l_partkey group by rollup (p_type, p_brand))"""
SQL["cumulative_overtake"] = top("""select l_suppkey, day::varchar as day, cb::double as cum_back, ck::double as cum_kept, pb::double as peak_back from (
  select *, sum(back) over w as cb, sum(kept) over w as ck, max(back) over w as pb from (
    select l_suppkey, l_shipdate::date as day, sum(l_extendedprice::decimal(12,2)) filter (l_returnflag = 'R') as back, sum(l_extendedprice::decimal(12,2)) filter (l_returnflag = 'N') as kept
    from lineitem where l_returnflag <> 'A' group by all) window w as (partition by l_suppkey order by day rows unbounded preceding)) where cb > ck""", "l_suppkey, day")
SQL["best_worst_rank"] = f"""with a as (select l_partkey, {mean(REV)} as v from lineitem group by all), k as (select l_partkey, rank() over (order by v) as lo, rank() over (order by v desc) as hi from a)
  select x.lo as rnk, x.l_partkey as worst, y.l_partkey as best from k x join k y on x.lo = y.hi where x.lo <= 10"""
SQL["top_n_per_group"] = "select o_orderpriority, o_orderkey, o_totalprice as price, rank() over (partition by o_orderpriority order by o_totalprice desc) as rk from orders qualify rk <= 5"
SQL["prev_next_period"] = """select o_orderpriority, yr, mo, t::double as total, lag(t) over w::double as prev, lead(t) over w::double as next from (select o_orderpriority, year(o_orderdate) as yr, month(o_orderdate) as mo,
  sum(o_totalprice::decimal(12,2)) as t from orders group by all) window w as (partition by o_orderpriority order by yr, mo) qualify yr = 1999"""
SQL["qualify_latest"] = "select user_id, event_id, event_type from events qualify rank() over (partition by user_id order by ts desc) = 1"
SQL["last_over_partition"] = """select event_id, user_id, event_type, last_value(event_type) over w as last_type, first_value(event_type) over w as first_type from events
  window w as (partition by user_id order by ts, event_id rows between unbounded preceding and unbounded following) qualify event_type = 'purchase'"""
SQL["row_number_global"] = "select l_orderkey, l_linenumber::bigint as l_linenumber, l_extendedprice::decimal(12,2)::double as price, row_number() over (order by l_extendedprice::decimal(12,2) desc, l_orderkey, l_linenumber) as n from lineitem"
SQL["running_total_global"] = "select o_orderkey, o_totalprice::decimal(12,2)::double as price, (sum(o_totalprice::decimal(12,2)) over (order by o_orderdate, o_orderkey))::double as turnover from orders"
SQL["interval_join_years"] = """with c as (select c_custkey, timestamp '1995-01-01' + to_days((c_custkey % 1500)::int) as a, c_custkey % 6 as kind from customer)
  select kind, count(*) as n, sum(o_orderkey)::bigint as orders from orders join c on o_custkey = c_custkey and o_orderdate between a and a + to_minutes(pow(12, kind + 1)::bigint) group by all"""
SQL["row_number_orders"] = "select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as n from orders qualify n <= 2"
SQL["cost_share"] = """select l_linenumber::bigint as l_linenumber, round(sum(cost::decimal(20,6)), 2)::double as cost, count(*) as n from (
  select l_linenumber, q::double / sum(q) over (partition by l_orderkey)::double * o_totalprice as cost from (select l_orderkey, l_linenumber, l_quantity::bigint as q, o_totalprice from lineitem join orders on o_orderkey = l_orderkey)) group by all"""

SQL["sort_null_order"] = top("select o_orderpriority, o_orderstatus, count(*) as n from orders group by rollup (o_orderpriority, o_orderstatus)", "o_orderpriority desc, o_orderstatus", n=9)
SQL["top_n_orders"] = top("select o_orderkey, o_custkey, o_totalprice from orders", "o_totalprice desc, o_orderkey")
SQL["union_distinct_channels"] = "select l_suppkey, count(distinct o_custkey) as customers from lineitem join orders on o_orderkey = l_orderkey group by all"
_buy = lambda f: f"select o_custkey, month(o_orderdate) as mo from lineitem join orders on o_orderkey = l_orderkey where l_returnflag = '{f}' and year(o_orderdate) in (1996, 1997)"
SQL["intersect_three"] = f"select mo, count(*) as n from ({' intersect '.join(map(_buy, 'RAN'))}) group by all"
SQL["except_chain"] = f"select mo, count(*) as n from ({' except '.join(map(_buy, 'RAN'))}) group by all"
SQL["union_all_reagg"] = top(f"""select l_partkey, (sum({REV}) - coalesce(sum({REV}) filter (l_returnflag = 'R'), 0))::double as net, 1 + max((l_returnflag = 'R')::bigint) as parts from lineitem group by all""", "net desc, l_partkey")
SQL["union_counts"] = "select 'orders' as location, count(*) as n_rows from orders union all select 'lineitem', count(*) from lineitem union all select 'orders in lineitem', count(distinct l_orderkey) from lineitem"
SQL["filter_forms"] = """select o_orderkey as order_key, c_name, o_totalprice from orders join customer on c_custkey = o_custkey where o_totalprice between 100000 and 300000 and o_orderpriority in ('1-URGENT', '2-HIGH')
  and c_name like 'Customer#%1' and c_mktsegment ilike 'b%' and o_orderstatus <> 'F' and c_acctbal > 0 and o_totalprice / c_acctbal > 20 and o_totalprice between 200000 * (1 - 0.4::double) and 200000 * (1 + 0.4::double)"""
SQL["projection_forms"] = "select c_custkey, c_name, c_acctbal, n_name, c_acctbal / 2 as half, c_acctbal / 4 as quarter, c_name || '/' || n_name as label, 'crm' as source from customer join nation on n_nationkey = c_nationkey"
SQL["string_funcs"] = """select c_custkey, substr(c_name, 3, 4) as sub, left(c_name, 3) as l3, right(c_name, 4) as r4, length(c_name) as len, upper(c_name) as up, c_name as trimmed, replace(c_name, '000', '-') as repl,
  split_part(c_name, '#', 2) as part2, '' as part3, split_part(c_name, '#', 2) as tok2, null::varchar as tok3, c_name || ':' || c_mktsegment as cat from customer"""
SQL["date_funcs"] = """select o_orderkey, (d + 30)::varchar as plus30, (d - 30)::varchar as minus30, (d + 60)::varchar as plus60, (d - interval 1 month)::date::varchar as prev_month, date_trunc('month', d)::date::varchar as month, quarter(d) as q,
  date '2001-01-01' - d as age, (epoch(timestamp '2001-01-01') - epoch(o_orderdate))::bigint // 3600 as hours,
  strftime(o_orderdate + case when d > a - dayofweek(a)::int and d <= b - dayofweek(b)::int then interval 2 hour else interval 1 hour end, '%Y-%m-%d %H:%M') as paris
  from (select *, o_orderdate::date as d, make_date(year(d), 3, 31) as a, case when year(d) < 1996 then make_date(year(d), 9, 30) else make_date(year(d), 10, 31) end as b from orders)"""
SQL["math_funcs"] = """select l_orderkey, l_linenumber::bigint as l_linenumber, abs(y - 25) as dist, round(x)::bigint as rounded, y::bigint::double / 7 as frac, round(x / 50)::bigint as seg, round(exp(ln(y)), 6) as expln, null::double as "none"
  from (select l_orderkey, l_linenumber, max(l_extendedprice) as x, max(l_quantity) as y from lineitem group by all)"""
SQL["cond_funcs"] = """select o_orderkey, case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 else 0 end::bigint as code, if(o_totalprice > 250000, 'big', 'small') as size, nullif(o_orderstatus, 'O') as not_open,
  case when o_orderstatus = 'O' then '?' else o_orderstatus end as status, case when o_orderstatus = 'O' then o_orderpriority else o_orderstatus end as filled, case when o_orderkey > 5 then o_totalprice / (o_orderkey - 5) end as guarded from orders"""
SQL["try_casts"] = """select c_custkey, c_custkey as as_int, case when c_acctbal = floor(c_acctbal) and false then 0 end::bigint as balance_int, c_acctbal as as_double, case when c_custkey % 40 between 1 and 31 then (date '2024-01-01' + (c_custkey % 40 - 1)::int)::varchar end as as_date,
  c_acctbal::decimal(38,2)::double as as_decimal from customer"""
SQL["regex_lookaround"] = r"""select doc_id, md5(replace(text, '.' || chr(10), '***' || chr(10))) as replaced, regexp_matches(text, '(?i)\bthe an') as found, 'foo***barfoo' || doc_id as stars from documents"""
SQL["strtok_split_table"] = """with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from documents), t as (select *, list_filter(string_split(line, ' '), lambda x: x <> '') as tok from l)
  select line_no, count(*) as n, sum(length(line))::bigint as chars, count(tok[3]) as with_third_token, min(tok[1]) as least from t group by all"""
