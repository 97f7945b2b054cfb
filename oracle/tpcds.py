"""DuckDB formulations of the query pack over the derived star."""

from __future__ import annotations

from oracle.kit import CH, WEEK, avg, back, cov, item, keys, lags, ratio, sd, sold, star, top, weekdays, within

Q: dict[str, str] = {}

Q["q01"] = top("""
  with totals as (
    select sr_customer_sk, sr_store_sk, sum(sr_return_amt_inc_tax) as total
    from store_returns join date_dim on d_date_sk = sr_returned_date_sk where d_year = 1999 group by all),
  averages as (select sr_store_sk as st, sum(total)::double / count(total) * 1.2::double as lim from totals group by all)
  select c_customer_id from totals join averages on st = sr_store_sk and total::double > lim
  join store on s_store_sk = sr_store_sk and s_state = 'NM' join customer on c_customer_sk = sr_customer_sk""", "c_customer_id")

Q["q02"] = f"""
  with weekly as (
    select d_week_seq, {weekdays('price')} from (
      select ws_sold_date_sk as sk, ws_ext_sales_price as price from web_sales
      union all by name select cs_sold_date_sk as sk, cs_ext_sales_price as price from catalog_sales)
    join date_dim on d_date_sk = sk group by d_week_seq)
  select a.d_week_seq as d_week_seq1, {', '.join(f"round({ratio(f'a.{d[:3].lower()}_sales', f'b.{d[:3].lower()}_sales')}, 2) as {d[:3].lower()}_ratio" for d in WEEK)}
  from weekly a join weekly b on b.d_week_seq = a.d_week_seq + 53
  join date_dim da on da.d_week_seq = a.d_week_seq and da.d_year = 1999
  join date_dim db on db.d_week_seq = b.d_week_seq and db.d_year = 2000"""

Q["q03"] = top(f"""
  select d_year, i_brand_id as brand_id, i_brand as brand, sum(ss_ext_discount_amt)::double as sum_agg
  from {sold('ss')}{item('ss')} where i_manufact_id = 540 and d_moy = 12 group by all""", "d_year, sum_agg desc, brand_id", "brand")


def growth(p, first, measure, agg="sum"):
    _, cust, *_ = CH[p]
    return (f"select {cust} as cust, {agg}({measure}) filter (d_year = {first}) as y1, {agg}({measure}) filter (d_year = {first + 1}) as y2"
            f" from {sold(p)} where d_year in ({first}, {first + 1}) and {cust} is not null group by all having y1 > 0 and y2 is not null")


def _q04_measure(p):
    return f"{p}_ext_list_price - {p}_ext_wholesale_cost - {p}_ext_discount_amt + {p}_ext_sales_price"


Q["q04"] = top(f"""
  with s as ({growth('ss', 1999, _q04_measure('ss'))}), k as ({growth('cs', 1999, _q04_measure('cs'))}), w as ({growth('ws', 1999, _q04_measure('ws'))})
  select c_customer_id as customer_id, c_first_name as customer_first_name, c_last_name as customer_last_name, c_login as customer_login
  from s join k using (cust) join w using (cust) join customer on c_customer_sk = cust
  where k.y2::double / k.y1::double > s.y2::double / s.y1::double and k.y2::double / k.y1::double > w.y2::double / w.y1::double""", "customer_id")

_two_weeks = within("2002-08-09", 0, 14)
Q["q05"] = top(f"""
  with lines as (
    select 'store channel' as channel, 'store' || s_store_id as id, * exclude (s_store_id) from (
      select s_store_id, ss_ext_sales_price as sales, 0 as returns, ss_net_profit as profit from {sold('ss')} join store on s_store_sk = ss_store_sk where {_two_weeks}
      union all select s_store_id, 0, sr_return_amt, -sr_net_loss from store_returns join date_dim on d_date_sk = sr_returned_date_sk join store on s_store_sk = sr_store_sk where {_two_weeks})
    union all
    select 'catalog channel', 'catalog_page' || cp_catalog_page_id, * exclude (cp_catalog_page_id) from (
      select cp_catalog_page_id, cs_ext_sales_price, 0, cs_net_profit from {sold('cs')} join catalog_page on cp_catalog_page_sk = cs_catalog_page_sk where {_two_weeks}
      union all select cp_catalog_page_id, 0, cr_return_amount, -cr_net_loss from catalog_returns join date_dim on d_date_sk = cr_returned_date_sk join catalog_page on cp_catalog_page_sk = cr_catalog_page_sk where {_two_weeks})
    union all
    select 'web channel', 'web_site' || web_site_id, * exclude (web_site_id) from (
      select web_site_id, ws_ext_sales_price, 0, ws_net_profit from {sold('ws')} join web_site on web_site_sk = ws_web_site_sk where {_two_weeks}
      union all select web_site_id, 0, wr_return_amt, -wr_net_loss from web_returns join date_dim on d_date_sk = wr_returned_date_sk
        join web_sales on ws_item_sk = wr_item_sk and ws_order_number = wr_order_number join web_site on web_site_sk = ws_web_site_sk where {_two_weeks}))
  select channel, id, sum(sales)::double as sales, sum(returns)::double as returns, sum(profit)::double as profit from lines group by rollup (channel, id)""",
  "channel, id", "sales, returns, profit")

Q["q06"] = top(f"""
  with dear as (select i_item_sk from (select *, sum(i_current_price) over w::double / count(*) over w as mid from item window w as (partition by i_category))
                where i_current_price::double > mid * 1.2::double)
  select ca_state as state, count(*) as cnt from {sold('ss')} join dear on i_item_sk = ss_item_sk join customer on c_customer_sk = ss_customer_sk
  join customer_address on ca_address_sk = c_current_addr_sk where d_year = 2002 and d_moy = 7 group by all having cnt >= 10""", "cnt, state")


def demo_avg(p, cdemo, gender, marital, education, year):
    return top(f"""
      select i_item_id, {avg(p + '_quantity')} as agg1, {avg(p + '_list_price')} as agg2, {avg(p + '_coupon_amt')} as agg3, {avg(p + '_sales_price')} as agg4
      from {sold(p)}{item(p)} join customer_demographics on cd_demo_sk = {cdemo} join promotion on p_promo_sk = {p}_promo_sk
      where (cd_gender, cd_marital_status, cd_education_status) = ('{gender}', '{marital}', '{education}') and 'N' in (p_channel_email, p_channel_event) and d_year = {year}
      group by all""", "i_item_id")


Q["q07"] = demo_avg("ss", "ss_cdemo_sk", "M", "M", "4 yr Degree", 2001)
Q["q08"] = top(f"""
  with areas as (
    select substr(zip, 1, 2) as area from (select distinct substr(ca_zip, 1, 5) as zip from customer_address where ca_gmt_offset = -6) listed
    semi join (select substr(ca_zip, 1, 5) as zip from customer join customer_address on ca_address_sk = c_current_addr_sk
               where c_preferred_cust_flag = 'Y' group by all having count(*) > 10) liked using (zip))
  select s_store_name, sum(ss_net_profit)::double as net_profit from {sold('ss')} join store on s_store_sk = ss_store_sk join areas on area = substr(s_zip, 1, 2)
  where d_qoy = 1 and d_year = 2002 group by all""", "s_store_name")


def _bucket(i, limit):
    a, b = 20 * i + 1, 20 * i + 20
    inside = f"(ss_quantity between {a} and {b})"
    mean = lambda c: f"sum({c}) filter {inside}::double / count({c}) filter {inside}"
    return f"case when count(*) filter {inside} > {limit} then {mean('ss_ext_discount_amt')} else {mean('ss_net_paid_inc_tax')} end as bucket{i + 1}"


Q["q09"] = "select " + ", ".join(_bucket(i, n) for i, n in enumerate((177560856, 1000, 357290662, 1000, 80111186))) + " from store_sales"


def active(when, extra=""):
    return f"""customer join customer_address on ca_address_sk = c_current_addr_sk join customer_demographics on cd_demo_sk = c_current_cdemo_sk
      where c_customer_sk in (select ss_customer_sk from {sold('ss')} where {when}) {extra}"""


def elsewhere(when):
    return f"""(c_customer_sk in (select ws_bill_customer_sk from {sold('ws')} where {when} and ws_bill_customer_sk is not null)
      or c_customer_sk in (select cs_ship_customer_sk from {sold('cs')} where {when} and cs_ship_customer_sk is not null))"""


_q10 = "d_year = 2002 and d_moy between 3 and 6"
Q["q10"] = top(f"""
  select cd_gender, cd_marital_status, cd_education_status, n as cnt1, cd_purchase_estimate, n as cnt2, cd_credit_rating, n as cnt3, cd_dep_count, n as cnt4,
         cd_dep_employed_count, n as cnt5, cd_dep_college_count, n as cnt6
  from (select cd_gender, cd_marital_status, cd_education_status, cd_purchase_estimate, cd_credit_rating, cd_dep_count, cd_dep_employed_count, cd_dep_college_count, count(*) as n
        from {active(_q10, "and ca_county in ('Polk County', 'Denton County', 'Union County', 'Swisher County', 'Cherokee County') and " + elsewhere(_q10))} group by all)""",
  "cd_gender, cd_marital_status, cd_education_status, cd_purchase_estimate, cd_credit_rating, cd_dep_count, cd_dep_employed_count, cd_dep_college_count")

Q["q11"] = top(f"""
  with s as ({growth('ss', 1999, 'ss_ext_list_price - ss_ext_discount_amt')}), w as ({growth('ws', 1999, 'ws_ext_list_price - ws_ext_discount_amt')})
  select c_customer_id as customer_id, c_first_name as customer_first_name, c_last_name as customer_last_name, c_login as customer_login
  from s join w using (cust) join customer on c_customer_sk = cust where w.y2::double / w.y1::double > s.y2::double / s.y1::double""", "customer_id")


def class_share(p, categories, start, limit=True):
    q = f"""
      select *, itemrevenue * 100 / (sum(rev) over (partition by i_class))::double as revenueratio from (
        select i_item_id, i_item_desc, i_category, i_class, i_current_price::double as i_current_price, sum({p}_ext_sales_price) as rev, rev::double as itemrevenue
        from {sold(p)}{item(p)} where i_category in {categories} and {within(start, 0, 30)} group by all)"""
    q = f"select * exclude (rev) from ({q})"
    return top(q, "i_category, i_class, i_item_id, i_item_desc, revenueratio", "i_current_price, itemrevenue") if limit else q


Q["q12"] = class_share("ws", ("Shoes", "Children", "Electronics"), "2002-04-12")
Q["q13"] = f"""
  select {avg('ss_quantity')} as avg_quantity, {avg('ss_ext_sales_price')} as avg_ext_sales_price, {avg('ss_ext_wholesale_cost')} as avg_ext_wholesale_cost,
         sum(ss_ext_wholesale_cost)::double as sum_ext_wholesale_cost
  from {sold('ss')} join store on s_store_sk = ss_store_sk join customer_demographics on cd_demo_sk = ss_cdemo_sk join household_demographics on hd_demo_sk = ss_hdemo_sk
  join customer_address on ca_address_sk = ss_addr_sk
  where d_year = 2001 and case cd_marital_status
      when 'D' then cd_education_status in ('2 yr Degree') and ss_sales_price between 0 and 1500 and hd_dep_count = 3
      when 'U' then cd_education_status = 'Primary' and ss_sales_price between 50 and 5000 and hd_dep_count = 1
      when 'W' then cd_education_status = 'Secondary' and ss_sales_price between 15 and 2000 and hd_dep_count = 1 else false end
    and case when ca_state in ('MI', 'MN', 'NC') then ss_net_profit between -5000 and 20000 when ca_state in ('GA', 'OH', 'MT') then ss_net_profit between 150 and 3000
             when ca_state in ('NM', 'AL', 'TX') then ss_net_profit between 50 and 25000 else false end"""

_cross = f"""
  shared as (
    {' intersect '.join(f"select i_brand_id, i_class_id, i_category_id from {sold(p)}{item(p)} where d_year between 1998 and 2000" for p in CH)}),
  cross_item as (select i_item_sk, i_brand_id, i_class_id, i_category_id from item semi join shared using (i_brand_id, i_class_id, i_category_id)),
  typical as (select {avg('v')} as mid from ({' union all '.join(f"select {p}_quantity * {p}_list_price as v from {sold(p)} where d_year between 1998 and 2000" for p in CH)}))"""


def _kind(p, label, when):
    return f"""select '{label}' as channel, i_brand_id, i_class_id, i_category_id, sum({p}_quantity * {p}_list_price) as amount, count(*) as n
      from {sold(p)} join cross_item on i_item_sk = {p}_item_sk where {when} group by all having amount::double > (select mid from typical)"""


_nov = "d_year = 2000 and d_moy = 11"
Q["q14"] = top(f"""
  with {_cross} select channel, i_brand_id, i_class_id, i_category_id, sum(amount)::double as sum_sales, sum(n)::bigint as number_sales
  from ({_kind('ss', 'store', _nov)} union all {_kind('cs', 'catalog', _nov)} union all {_kind('ws', 'web', _nov)})
  group by rollup (channel, i_brand_id, i_class_id, i_category_id)""", "channel, i_brand_id, i_class_id, i_category_id", "sum_sales, number_sales")


def _dec28(year):
    return f"d_week_seq = (select d_week_seq from date_dim where d_date = date '{year}-12-28')"


Q["q14b"] = top(f"""
  with {_cross}, ty as ({_kind('ss', 'store', _dec28(1999))}), ly as ({_kind('ss', 'store', _dec28(1998))})
  select ty.channel as ty_channel, ty.i_brand_id as ty_brand, ty.i_class_id as ty_class, ty.i_category_id as ty_category, ty.amount::double as ty_sales, ty.n as ty_number_sales,
         ly.channel as ly_channel, ly.i_brand_id as ly_brand, ly.i_class_id as ly_class, ly.i_category_id as ly_category, ly.amount::double as ly_sales, ly.n as ly_number_sales
  from ty join ly using (i_brand_id, i_class_id, i_category_id)""", "ty_channel, ty_brand, ty_class, ty_category")

_zips = ("85669", "86197", "88274", "83405", "86475", "85392", "85460", "80348", "81792")
Q["q15"] = top(f"""
  select ca_zip, sum(cs_sales_price)::double as sum_sales from {sold('cs')} join customer on c_customer_sk = cs_bill_customer_sk join customer_address on ca_address_sk = c_current_addr_sk
  where d_year = 2000 and d_qoy = 2 and (left(ca_zip, 5) in {_zips} or ca_state in ('CA', 'WA', 'GA') or cs_sales_price > 500) group by all""", "ca_zip")


def shipped(p, date, start, state, outlet, returned):
    table, _, _, rt, _, n, rn, _ = CH[p]
    several = f"{n} in (select {n} from {table} group by all having count(distinct {p}_warehouse_sk) > 1)"
    return f"""select count(distinct {n}) as order_count, sum({p}_ext_ship_cost)::double as total_shipping_cost, sum({p}_net_profit)::double as total_net_profit
      from {table} join date_dim on d_date_sk = {date} join customer_address on ca_address_sk = {p}_ship_addr_sk and ca_state = '{state}' join {outlet}
      where {within(start, 0, 60)} and {several} and {'' if returned else 'not'} exists (from {rt} where {rn} = {n})"""


Q["q16"] = shipped("cs", "cs_ship_date_sk", "2000-03-01", "AL", "call_center on cc_call_center_sk = cs_call_center_sk and cc_county in ('Luce County', 'Ziebach County', 'San Miguel County', 'Dauphin County', 'Marshall County')", False)


def chain(first, later, again):
    return f"""(select * from {sold('ss')} where {first}) a join (select * from store_returns join date_dim on d_date_sk = sr_returned_date_sk where {later}) b
      on ss_customer_sk = sr_customer_sk and ss_item_sk = sr_item_sk and ss_ticket_number = sr_ticket_number
      join (select * from {sold('cs')} where {again}) k on cs_bill_customer_sk = sr_customer_sk and cs_item_sk = sr_item_sk
      join store on s_store_sk = ss_store_sk join item on i_item_sk = ss_item_sk"""


def _spread(col, name):
    return f"count({col}) as {name}_quantitycount, {avg(col)} as {name}_quantityave, {sd(col)} as {name}_quantitystdev, {cov(col)} as {name}_quantitycov"


_q17 = "d_quarter_name in ('1999Q1', '1999Q2', '1999Q3')"
Q["q17"] = top(f"""select i_item_id, i_item_desc, s_state, {_spread('ss_quantity', 'store_sales')}, {_spread('sr_return_quantity', 'store_returns')}, {_spread('cs_quantity', 'catalog_sales')}
  from {chain("d_quarter_name = '1999Q1'", _q17, _q17)} group by all""", "i_item_id, i_item_desc, s_state")

_q18 = ["cs_quantity", "cs_list_price", "cs_coupon_amt", "cs_sales_price", "cs_net_profit", "c_birth_year", "cd1.cd_dep_count"]
Q["q18"] = top(f"""
  select i_item_id, ca_country, ca_state, ca_county, {', '.join(f"{avg(f'({v})::decimal(12,2)')} as agg{i}" for i, v in enumerate(_q18, 1))}
  from {sold('cs')}{item('cs')} join customer_demographics cd1 on cd1.cd_demo_sk = cs_bill_cdemo_sk join customer on c_customer_sk = cs_bill_customer_sk
  join customer_demographics cd2 on cd2.cd_demo_sk = c_current_cdemo_sk join customer_address on ca_address_sk = c_current_addr_sk
  where cd1.cd_gender = 'F' and cd1.cd_education_status = 'Secondary' and c_birth_month in (1, 4, 6, 9, 11, 12) and d_year = 1998 and ca_state in ('TN', 'GA', 'MI', 'OH', 'NM', 'TX', 'VA')
  group by rollup (i_item_id, ca_country, ca_state, ca_county)""", "ca_country, ca_state, ca_county, i_item_id", "agg1, agg2, agg3")

Q["q19"] = top(f"""
  select i_brand_id as brand_id, i_brand as brand, i_manufact_id, i_manufact, sum(ss_ext_sales_price)::double as ext_price
  from {sold('ss')}{item('ss')} join customer on c_customer_sk = ss_customer_sk join customer_address on ca_address_sk = c_current_addr_sk join store on s_store_sk = ss_store_sk
  where i_manager_id = 8 and d_moy = 11 and d_year = 1999 and left(ca_zip, 5) <> left(s_zip, 5) group by all""", "ext_price desc, brand, brand_id, i_manufact_id, i_manufact")
Q["q20"] = class_share("cs", ("Men", "Electronics", "Music"), "2001-03-09")
Q["q21"] = top(f"""
  select w_warehouse_name, i_item_id, coalesce(sum(inv_quantity_on_hand) filter (d_date < date '2000-05-19'), 0)::bigint as inv_before,
         coalesce(sum(inv_quantity_on_hand) filter (d_date >= date '2000-05-19'), 0)::bigint as inv_after
  from inventory join date_dim on d_date_sk = inv_date_sk join item on i_item_sk = inv_item_sk join warehouse on w_warehouse_sk = inv_warehouse_sk
  where i_current_price between 0.99 and 1.49 and {within('2000-05-19', 30, 30)} group by all
  having inv_before > 0 and inv_after::double / inv_before between 2::double / 3 and 3::double / 2""", "w_warehouse_name, i_item_id", "inv_before, inv_after")
Q["q22"] = top(f"""
  select i_product_name, i_brand, i_class, i_category, {avg('inv_quantity_on_hand')} as qoh from inventory join date_dim on d_date_sk = inv_date_sk join item on i_item_sk = inv_item_sk
  where d_month_seq between 1190 and 1201 group by rollup (i_product_name, i_brand, i_class, i_category)""", "qoh, i_product_name, i_brand, i_class, i_category")

_best = f"""
  often as (select ss_item_sk as it from {sold('ss')}{item('ss')} where d_year between 2000 and 2003 group by substr(i_item_desc, 1, 30), ss_item_sk, d_date having count(*) > 1),
  spent as (select ss_customer_sk as cu, sum(ss_quantity * ss_sales_price) as total, sum(ss_quantity * ss_sales_price) filter (d_year between 2000 and 2003) as recent
            from store_sales left join date_dim on d_date_sk = ss_sold_date_sk where ss_customer_sk is not null group by all),
  best as (select cu from spent where total::double > (select max(recent) from spent)::double * 0.5::double)"""


def _best_lines(p, what):
    return f"select {what} from {sold(p)} join customer on c_customer_sk = {CH[p][1]} where d_year = 2000 and d_moy = 2 and {p}_item_sk in (from often) and {CH[p][1]} in (from best)"


Q["q23"] = f"with {_best} select sum(v)::double as sum_sales from ({_best_lines('cs', 'cs_quantity * cs_list_price as v')} union all {_best_lines('ws', 'ws_quantity * ws_list_price as v')})"
Q["q23b"] = top(f"""with {_best} {' union all '.join(_best_lines(p, f'c_last_name, c_first_name, sum({p}_quantity * {p}_list_price)::double as sales') + ' group by all' for p in ('cs', 'ws'))}""", "c_last_name, c_first_name, sales")


def color_paid(color):
    return f"""
      with groups as (
        select c_last_name, c_first_name, s_store_name, i_color, sum(ss_net_paid_inc_tax) as paid
        from store_sales{back('ss', 'inner')} join store on s_store_sk = ss_store_sk and s_market_id = 8{item('ss')} join customer on c_customer_sk = ss_customer_sk
        join customer_address on ca_address_sk = c_current_addr_sk and ca_zip = s_zip and upper(ca_country) <> c_birth_country
        group by c_last_name, c_first_name, s_store_name, ca_state, s_state, i_color, i_current_price, i_manager_id, i_units, i_size)
      select c_last_name, c_first_name, s_store_name, sum(g.paid)::double as paid from groups g where i_color = '{color}' group by all
      having sum(g.paid)::double > (select {avg('paid')} * 0.05::double from groups)"""


Q["q24"], Q["q24b"] = color_paid("cornsilk"), color_paid("lime")
_q25 = "d_moy between 4 and 10 and d_year = 2002"
Q["q25"] = top(f"""select i_item_id, i_item_desc, s_store_id, s_store_name, min(ss_net_profit)::double as store_sales_profit, min(sr_net_loss)::double as store_returns_loss,
  min(cs_net_profit)::double as catalog_sales_profit from {chain('d_moy = 4 and d_year = 2002', _q25, _q25)} group by all""", "i_item_id, i_item_desc, s_store_id, s_store_name")
Q["q26"] = demo_avg("cs", "cs_bill_cdemo_sk", "M", "S", "4 yr Degree", 1998)
Q["q27"] = top(f"""
  select i_item_id, s_state, grouping(s_state)::bigint as g_state, {avg('ss_quantity')} as agg1, {avg('ss_list_price')} as agg2, {avg('ss_coupon_amt')} as agg3, {avg('ss_sales_price')} as agg4
  from {sold('ss')}{item('ss')} join store on s_store_sk = ss_store_sk join customer_demographics on cd_demo_sk = ss_cdemo_sk
  where (cd_gender, cd_marital_status, cd_education_status) = ('F', 'U', '2 yr Degree') and d_year = 2000 and s_state in ('SD', 'OH', 'NM', 'MI', 'TX')
  group by rollup (i_item_id, s_state)""", "i_item_id, s_state")

_bands = ((0, 5, 173, 12318, 4), (6, 10, 148, 15913, 54), (11, 15, 114, 10419, 20), (16, 20, 120, 13066, 41), (21, 25, 42, 5802, 8), (26, 30, 22, 281, 48))


def _band(i, lo, hi, price, coupon, cost):
    w = (f"(ss_quantity between {lo} and {hi} and (ss_list_price between {price} and {price + 10} or ss_coupon_amt between {coupon} and {coupon + 1000}"
         f" or ss_wholesale_cost between {cost} and {cost + 20}))")
    n = f"count(ss_list_price) filter {w}"
    return f"sum(ss_list_price) filter {w}::double / nullif({n}, 0) as b{i}_lp, {n} as b{i}_cnt, count(distinct ss_list_price) filter {w} as b{i}_cntd"


Q["q28"] = "select " + ", ".join(_band(i, *b) for i, b in enumerate(_bands, 1)) + " from store_sales"
Q["q29"] = top(f"""select i_item_id, i_item_desc, s_store_id, s_store_name, sum(ss_quantity)::bigint as store_sales_quantity, sum(sr_return_quantity)::bigint as store_returns_quantity,
  sum(cs_quantity)::bigint as catalog_sales_quantity from {chain('d_moy = 4 and d_year = 2000', 'd_moy between 4 and 7 and d_year = 2000', 'd_year between 2000 and 2002')} group by all""",
  "i_item_id, i_item_desc, s_store_id, s_store_name")


def returners(table, p, amount, year, state, columns):
    return top(f"""
      with totals as (
        select {p}_returning_customer_sk as cu, ca_state as st, sum({amount}) as total from {table} join date_dim on d_date_sk = {p}_returned_date_sk
        join customer_address on ca_address_sk = {p}_returning_addr_sk where d_year = {year} group by all),
      limits as (select st, {avg('total')} * 1.2::double as lim from totals group by all)
      select {columns}, total::double as ctr_total_return from totals join limits using (st) join customer on c_customer_sk = cu
      join customer_address on ca_address_sk = c_current_addr_sk and ca_state = '{state}' where total::double > lim""", columns, "ctr_total_return")


Q["q30"] = returners("web_returns", "wr", "wr_return_amt", 2001, "MI",
                     "c_customer_id, c_salutation, c_first_name, c_last_name, c_preferred_cust_flag, c_birth_day, c_birth_month, c_birth_year, c_birth_country, c_login, c_email_address, c_last_review_date")


def _quarters(p):
    return f"""select ca_county, {', '.join(f"sum({p}_ext_sales_price) filter (d_qoy = {q}) as q{q}" for q in (1, 2, 3))}
      from {sold(p)} join customer_address on ca_address_sk = {CH[p][2]} where d_year = 1999 group by all"""


Q["q31"] = f"""
  with s as ({_quarters('ss')}), w as ({_quarters('ws')})
  select ca_county, 1999::bigint as d_year, {ratio('w.q2', 'w.q1')} as web_q1_q2_increase, {ratio('s.q2', 's.q1')} as store_q1_q2_increase,
         {ratio('w.q3', 'w.q2')} as web_q2_q3_increase, {ratio('s.q3', 's.q2')} as store_q2_q3_increase
  from s join w using (ca_county) where s.q1 > 0 and s.q2 > 0 and w.q1 > 0 and w.q2 > 0 and web_q1_q2_increase > store_q1_q2_increase and web_q2_q3_increase > store_q2_q3_increase"""


def excess(p, maker, start):
    d = f"{p}_ext_discount_amt"
    return f"""select sum({d})::double as excess_discount_amount from (
      select {d}, sum({d}) over w::double / count({d}) over w * 1.3::double as lim from {sold(p)}{item(p)} where i_manufact_id = {maker} and {within(start, 0, 90)}
      window w as (partition by {p}_item_sk)) where {d}::double > lim"""


Q["q32"] = excess("cs", 283, "1999-02-22")


def all_channels(key, wanted, when, gmt, order):
    parts = " union all ".join(f"select {key}, {p}_ext_sales_price as price from {sold(p)}{item(p)} join customer_address on ca_address_sk = {CH[p][2]} where {when} and ca_gmt_offset = {gmt} and {key} in (select {key} from item where {wanted})" for p in CH)
    return top(f"select {key}, sum(price)::double as total_sales from ({parts}) group by all", order, key)


Q["q33"] = all_channels("i_manufact_id", "i_category = 'Electronics'", "d_year = 1999 and d_moy = 7", -5, "total_sales")


def tickets(when, store, household, least, most):
    return f"""select c_last_name, c_first_name, c_salutation, c_preferred_cust_flag, ss_ticket_number, cnt from (
      select ss_ticket_number, ss_customer_sk, count(*) as cnt from {sold('ss')} join store on s_store_sk = ss_store_sk join household_demographics on hd_demo_sk = ss_hdemo_sk
      where {when} and s_county in {store} and {household} group by all having cnt between {least} and {most}) join customer on c_customer_sk = ss_customer_sk"""


Q["q34"] = tickets("(d_dom in (1, 2, 3) or d_dom between 25 and 28) and d_year in (1998, 1999, 2000)", ("Quay County", "Sumner County", "Harper County", "Pipestone County", "Kittitas County", "Surry County", "Wadena County", "Richland County"),
                   "hd_buy_potential in ('1001-5000', '0-500') and hd_vehicle_count > 0 and hd_dep_count::double / hd_vehicle_count > 1.2", 2, 20)
_q35 = "d_year = 2000 and d_qoy < 4"


def _stat(c, i):
    s = c[3:]
    return f"{c}, count(*) as cnt{i}, {sd(c)} as stddev_samp_{s}, max({c}) as max_{s}, sum({c})::bigint as sum_{s}"


Q["q35"] = top(f"""select ca_state, cd_gender, cd_marital_status, {_stat('cd_dep_count', 1)}, {_stat('cd_dep_employed_count', 2)}, {_stat('cd_dep_college_count', 3)}
  from {active(_q35, 'and ' + elsewhere(_q35))} group by ca_state, cd_gender, cd_marital_status, cd_dep_count, cd_dep_employed_count, cd_dep_college_count""",
  "ca_state, cd_gender, cd_marital_status, cd_dep_count, cd_dep_employed_count, cd_dep_college_count")


def hierarchy(source, a, b, value, name, direction):
    return top(f"""select * exclude (leaf), rank() over (partition by lochierarchy, case when leaf = 0 then {a} end order by {name} {direction}) as rank_within_parent from (
      select {a}, {b}, {value} as {name}, (grouping({a}) + grouping({b}))::bigint as lochierarchy, grouping({b}) as leaf from {source} group by rollup ({a}, {b}))""",
      f"lochierarchy desc, case when lochierarchy = 0 then {a} end, rank_within_parent", f"{a}, {b}, {name}")


Q["q36"] = hierarchy(f"{sold('ss')}{item('ss')} join store on s_store_sk = ss_store_sk where d_year = 1998 and s_state in ('GA', 'AL', 'LA', 'NM', 'MN', 'CO', 'MI')", "i_category", "i_class",
                     ratio("sum(ss_net_profit)", "sum(ss_ext_sales_price)"), "gross_margin", "asc nulls last")


def stocked(price, start, makers, sales):
    return top(f"""select distinct i_item_id, i_item_desc, i_current_price::double as i_current_price from item
      where i_current_price between {price} and {price + 30} and i_manufact_id in {makers} and exists (from {sales} = i_item_sk)
        and exists (from inventory join date_dim on d_date_sk = inv_date_sk where inv_item_sk = i_item_sk and {within(start, 0, 60)} and inv_quantity_on_hand between 100 and 500)""", "i_item_id", "i_item_desc")


Q["q37"] = stocked(58, "2001-02-11", (910, 893, 984, 865), "catalog_sales where cs_item_sk")


def name_days(p, first):
    return f"select c_last_name, c_first_name, d_date from {sold(p)} join customer on c_customer_sk = {CH[p][1]} where d_month_seq between {first} and {first + 11}"


Q["q38"] = "select count(*) as cnt from (" + " intersect ".join(name_days(p, 1176) for p in CH) + ")"


def unsteady(least):
    return f"""
      with stats as (
        select w_warehouse_sk, i_item_sk, d_moy, {avg('inv_quantity_on_hand')} as mean, {cov('inv_quantity_on_hand')} as cov
        from inventory join item on i_item_sk = inv_item_sk join warehouse on w_warehouse_sk = inv_warehouse_sk join date_dim on d_date_sk = inv_date_sk
        where d_year = 2001 group by w_warehouse_name, w_warehouse_sk, i_item_sk, d_moy having cov > 1)
      select a.*, b.w_warehouse_sk as next_w_warehouse_sk, b.i_item_sk as next_i_item_sk, b.d_moy as next_d_moy, b.mean as next_mean, b.cov as next_cov
      from stats a join stats b using (w_warehouse_sk, i_item_sk) where a.d_moy = 1 and b.d_moy = 2 and a.cov > {least}"""


Q["q39"], Q["q39b"] = unsteady(1), unsteady(1.5)
_net = "cs_sales_price - coalesce(cr_refunded_cash, 0)"
Q["q40"] = top(f"""
  select w_state, i_item_id, coalesce(sum({_net}) filter (d_date < date '2002-05-08'), 0)::double as sales_before, coalesce(sum({_net}) filter (d_date >= date '2002-05-08'), 0)::double as sales_after
  from {sold('cs')}{back('cs')}{item('cs')} join warehouse on w_warehouse_sk = cs_warehouse_sk where i_current_price between 0.99 and 1.49 and {within('2002-05-08', 30, 30)} group by all""", "w_state, i_item_id")
Q["q41"] = top("""
  select distinct i_product_name from item a where i_manufact_id between 869 and 909 and (select count(*) from item b where b.i_manufact = a.i_manufact and (
    (b.i_category = 'Women' and b.i_color in ('thistle', 'papaya', 'rose') and b.i_units in ('Gross', 'Oz', 'Carton', 'Box') and b.i_size in ('petite', 'small', 'extra large'))
    or (b.i_category = 'Men' and b.i_color in ('burlywood', 'peach') and b.i_units in ('Dram', 'Bundle', 'Box') and b.i_size in ('petite', 'small', 'large')))) > 0""", "i_product_name")


def managed(cols, manager, month, year, order):
    return top(f"select {cols}, sum(ss_ext_sales_price)::double as ext_price from {sold('ss')}{item('ss')} where i_manager_id = {manager} and d_moy = {month} and d_year = {year} group by all", order)


Q["q42"] = managed("d_year, i_category_id, i_category", 1, 12, 2001, "ext_price desc, d_year, i_category_id, i_category")
Q["q43"] = top(f"select s_store_name, s_store_id, {weekdays('ss_sales_price', '::double')} from {sold('ss')} join store on s_store_sk = ss_store_sk where s_gmt_offset = -6 and d_year = 2000 group by all", "s_store_name, s_store_id")
Q["q44"] = """
  with items as (
    select ss_item_sk as it, sum(ss_net_profit)::double / count(ss_net_profit) as v from store_sales where ss_store_sk = 3 group by all
    having v > (select sum(ss_net_profit)::double / count(ss_net_profit) * 0.9::double from store_sales where ss_store_sk = 3 and ss_hdemo_sk is null)),
  ranked as (select it, rank() over (order by v) as lo, rank() over (order by v desc) as hi from items)
  select a.lo as rnk, x.i_product_name as best_performing, y.i_product_name as worst_performing
  from ranked a join ranked b on a.lo = b.hi and a.lo <= 10 join item x on x.i_item_sk = a.it join item y on y.i_item_sk = b.it"""
Q["q45"] = top(f"""
  select ca_zip, ca_city, sum(ws_sales_price)::double as sum_sales from {sold('ws')}{item('ws')} join customer on c_customer_sk = ws_bill_customer_sk join customer_address on ca_address_sk = c_current_addr_sk
  where d_year = 1998 and d_qoy = 1 and (left(ca_zip, 5) in {_zips} or i_item_id in (select i_item_id from item where i_item_sk in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29))) group by all""", "ca_zip, ca_city")


def away(when, cities, household, aggs, columns, order):
    return top(f"""
      select c_last_name, c_first_name, h.ca_city as ca_city, bought_city, ss_ticket_number, {columns} from (
        select ss_ticket_number, ss_customer_sk, ss_addr_sk, ca_city as bought_city, {aggs} from {sold('ss')} join store on s_store_sk = ss_store_sk
        join household_demographics on hd_demo_sk = ss_hdemo_sk join customer_address on ca_address_sk = ss_addr_sk where {when} and s_city in {cities} and ({household}) group by all)
      join customer on c_customer_sk = ss_customer_sk join customer_address h on h.ca_address_sk = c_current_addr_sk where h.ca_city <> bought_city""", order, "c_last_name, c_first_name, ca_city, bought_city, ss_ticket_number, " + columns)


Q["q46"] = away("d_dow in (0, 6) and d_year in (1999, 2000, 2001)", ("Woodland", "Rockville", "Oakdale", "Pleasant Grove", "Springfield"), "hd_dep_count = 4 or hd_vehicle_count = 3",
                "sum(ss_coupon_amt)::double as amt, sum(ss_net_profit)::double as profit", "amt, profit", "c_last_name, c_first_name, ca_city, bought_city, ss_ticket_number")


def months(p, groups, extra, year, columns, order):
    return top(f"""
      with m as (select {groups}, d_year, d_moy, sum({p}_sales_price) as s from {sold(p)}{item(p)} {extra}
                 where d_year = {year} or (d_year = {year - 1} and d_moy = 12) or (d_year = {year + 1} and d_moy = 1) group by all)
      select {columns}, d_year, d_moy, mid as avg_monthly_sales, s::double as sum_sales, psum::double as psum, nsum::double as nsum from (
        select *, sum(s) over (partition by {groups}, d_year)::double / count(s) over (partition by {groups}, d_year) as mid,
               lag(s) over (partition by {groups} order by d_year, d_moy) as psum, lead(s) over (partition by {groups} order by d_year, d_moy) as nsum from m)
      where d_year = {year} and mid > 0 and psum is not null and nsum is not null and abs(s::double - mid) / mid > 0.1""", "sum_sales - avg_monthly_sales, " + order, columns + ", d_year, d_moy, avg_monthly_sales, sum_sales, psum, nsum")


Q["q47"] = months("ss", "i_category, i_brand, s_store_name, s_company_name", "join store on s_store_sk = ss_store_sk", 1999, "s_store_name, s_company_name", "sum_sales")
Q["q48"] = f"""
  select sum(ss_quantity)::bigint as sum_quantity from {sold('ss')} join store on s_store_sk = ss_store_sk join customer_demographics on cd_demo_sk = ss_cdemo_sk join customer_address on ca_address_sk = ss_addr_sk
  where d_year = 2001 and ((cd_marital_status || cd_education_status = 'DSecondary' and ss_sales_price between 100 and 150) or (cd_marital_status || cd_education_status = 'W2 yr Degree' and ss_sales_price between 50 and 100)
      or (cd_marital_status || cd_education_status = 'UUnknown' and ss_sales_price between 150 and 200))
    and ((ca_state in ('VA', 'MI', 'FL') and ss_net_profit between 0 and 2000) or (ca_state in ('SC', 'GA', 'MN') and ss_net_profit between 150 and 3000) or (ca_state in ('OK', 'IA', 'TX') and ss_net_profit between 50 and 25000))"""


def worst(p, label):
    _, _, _, _, rp, _, _, amt = CH[p]
    return f"""select '{label}' as channel, * from (
      select item, return_ratio, rank() over (order by return_ratio) as return_rank, rank() over (order by currency_ratio) as currency_rank from (
        select {p}_item_sk as item, {ratio(f'sum({rp}_return_quantity)', f'sum({p}_quantity)')} as return_ratio, {ratio(f'sum({amt})', f'sum({p}_net_paid)')} as currency_ratio
        from {sold(p)}{back(p, 'inner')} where d_year = 2002 and d_moy = 11 and {amt} > 10000 and {p}_net_profit > 1 and {p}_net_paid > 0 and {p}_quantity > 0 group by all))
      where least(return_rank, currency_rank) <= 10"""


Q["q49"] = top(" union ".join(worst(p, n) for p, n in (("ws", "web"), ("cs", "catalog"), ("ss", "store"))), "channel, return_rank, currency_rank, item")
_store = "s_store_name, s_company_id, s_street_number, s_street_name, s_street_type, s_suite_number, s_city, s_county, s_state, s_zip"
Q["q50"] = top(f"""select {_store}, {lags('(sr_returned_date_sk - ss_sold_date_sk)')} from store_returns join date_dim on d_date_sk = sr_returned_date_sk
  join store_sales on ss_ticket_number = sr_ticket_number and ss_item_sk = sr_item_sk and ss_customer_sk = sr_customer_sk join store on s_store_sk = ss_store_sk where d_year = 1998 and d_moy = 10 group by all""", _store)


def cume(p, name):
    return f"""select item_sk, d_date, sum(s) over (partition by item_sk order by d_date rows unbounded preceding) as {name} from (
      select {p}_item_sk as item_sk, d_date, sum({p}_sales_price) as s from {sold(p)} where d_month_seq between 1176 and 1187 group by all)"""


Q["q51"] = top(f"""
  select item_sk, d_date::varchar as d_date, web_sales::double as web_sales, store_sales::double as store_sales, wc::double as web_cumulative, sc::double as store_cumulative from (
    select *, max(web_sales) over w as wc, max(store_sales) over w as sc from ({cume('ws', 'web_sales')}) full join ({cume('ss', 'store_sales')}) using (item_sk, d_date)
    window w as (partition by item_sk order by d_date rows unbounded preceding)) where wc > sc""", "item_sk, d_date")
Q["q52"] = managed("d_year, i_brand_id as brand_id, i_brand as brand", 1, 11, 2002, "d_year, ext_price desc, brand_id, brand")

_kinds = """((i_category in ('Books', 'Children', 'Electronics') and i_class in ('personal', 'portable', 'reference', 'self-help')
    and i_brand in ('scholaramalgamalg #14', 'scholaramalgamalg #7', 'exportiunivamalg #9', 'scholaramalgamalg #9'))
  or (i_category in ('Women', 'Music', 'Men') and i_class in ('accessories', 'classical', 'fragrances', 'pants')
    and i_brand in ('amalgimporto #1', 'edu packscholar #1', 'exportiimporto #1', 'importoamalg #1')))"""


def off_average(first, key, period, name, order):
    return top(f"""
      select {key}, s::double as sum_sales, mid as {name} from (
        select {key}, s, sum(s) over (partition by {key})::double / count(*) over (partition by {key}) as mid from (
          select {key}, {period}, sum(ss_sales_price) as s from {sold('ss')}{item('ss')} join store on s_store_sk = ss_store_sk
          where d_month_seq between {first} and {first + 11} and {_kinds} group by all)) where mid > 0 and abs(s::double - mid) / mid > 0.1""", order)


Q["q53"] = off_average(1213, "i_manufact_id", "d_qoy", "avg_quarterly_sales", "avg_quarterly_sales, sum_sales, i_manufact_id")
Q["q54"] = top(f"""
  with buyers as ({' union '.join(f"select {CH[p][1]} as cu from {sold(p)}{item(p)} where i_category = 'Shoes' and i_class = 'womens' and d_moy = 5 and d_year = 2000" for p in ('cs', 'ws'))}),
  revenue as (
    select ss_customer_sk, sum(ss_ext_sales_price) as r from {sold('ss')} join customer on c_customer_sk = ss_customer_sk join customer_address on ca_address_sk = c_current_addr_sk
    join store on s_county = ca_county and s_state = ca_state where ss_customer_sk in (from buyers where cu is not null) and d_month_seq - (select min(d_month_seq) from date_dim where d_moy = 5 and d_year = 2000) in (1, 2, 3) group by all)
  select round(r::double / 50)::bigint as segment, count(*) as num_customers, segment * 50 as segment_base from revenue group by all""", "segment, num_customers")
Q["q55"] = managed("i_brand_id as brand_id, i_brand as brand", 96, 12, 2002, "ext_price desc, brand_id, brand")
Q["q56"] = all_channels("i_item_id", "i_color in ('rose', 'brown', 'drab')", "d_year = 2000 and d_moy = 4", -5, "total_sales, i_item_id")
Q["q57"] = months("cs", "i_category, i_brand, cc_name", "join call_center on cc_call_center_sk = cs_call_center_sk", 2001, "i_brand", "nsum")


def _rev(p):
    return f"(select i_item_id as item_id, sum({p}_ext_sales_price)::double as {p}_item_rev from {sold(p)}{item(p)} where d_week_seq = (select d_week_seq from date_dim where d_date = date '1999-04-16') group by all)"


_pairs = " and ".join(f"{a}_item_rev between {b}_item_rev * 0.9::double and {b}_item_rev * 1.1::double" for a in CH for b in CH if a != b)
Q["q58"] = top(f"""
  select item_id, ss_item_rev, ss_item_rev / average * 100 as ss_dev, cs_item_rev, cs_item_rev / average * 100 as cs_dev, ws_item_rev, ws_item_rev / average * 100 as ws_dev, average
  from (select *, (ss_item_rev + cs_item_rev + ws_item_rev) / 3 as average from {_rev('ss')} join {_rev('cs')} using (item_id) join {_rev('ws')} using (item_id)) where {_pairs}""", "item_id, ss_item_rev")
_d = [d[:3].lower() for d in WEEK]
Q["q59"] = top(f"""
  with weekly as (select d_week_seq, s_store_id, s_store_name, {weekdays('ss_sales_price')} from {sold('ss')} join store on s_store_sk = ss_store_sk group by all)
  select a.s_store_name as s_store_name1, a.s_store_id as s_store_id1, a.d_week_seq as d_week_seq1, {', '.join(f"{ratio(f'a.{x}_sales', f'b.{x}_sales')} as {x}_ratio" for x in _d)}
  from weekly a join weekly b on a.s_store_id = b.s_store_id and b.d_week_seq = a.d_week_seq + 52
  join date_dim x on x.d_week_seq = a.d_week_seq and x.d_month_seq between 1201 and 1212 join date_dim y on y.d_week_seq = b.d_week_seq and y.d_month_seq between 1213 and 1224""", "s_store_name1, s_store_id1, d_week_seq1")
Q["q60"] = all_channels("i_item_id", "i_category = 'Jewelry'", "d_year = 1999 and d_moy = 9", -6, "i_item_id, total_sales")
Q["q61"] = f"""
  select promotions::double as promotions, total::double as total, {ratio('promotions', 'total')} * 100 as share from (
    select sum(ss_ext_sales_price) as total, sum(ss_ext_sales_price) filter ('Y' in (p_channel_dmail, p_channel_email, p_channel_tv)) as promotions
    from {sold('ss')}{item('ss')} join store on s_store_sk = ss_store_sk and s_gmt_offset = -6 join customer on c_customer_sk = ss_customer_sk
    join customer_address on ca_address_sk = c_current_addr_sk and ca_gmt_offset = -6 left join promotion on p_promo_sk = ss_promo_sk where i_category = 'Sports' and d_year = 1999 and d_moy = 11)"""


def ship_lags(p, first, outlet, name):
    return top(f"""select left(w_warehouse_name, 20) as warehouse, sm_type, {name}, {lags(f'({p}_ship_date_sk - {p}_sold_date_sk)')} from {CH[p][0]} join date_dim on d_date_sk = {p}_ship_date_sk
      join warehouse on w_warehouse_sk = {p}_warehouse_sk join ship_mode on sm_ship_mode_sk = {p}_ship_mode_sk join {outlet} where d_month_seq between {first} and {first + 11} group by all""", f"warehouse, sm_type, {name}")


Q["q62"] = ship_lags("ws", 1214, "web_site on web_site_sk = ws_web_site_sk", "web_name")
Q["q63"] = off_average(1188, "i_manager_id", "d_moy", "avg_monthly_sales", "i_manager_id, avg_monthly_sales, sum_sales")
_who = ", ".join(f"{a}.ca_{x} as {a}_{x}" for a in ("b", "c") for x in ("street_number", "street_name", "city", "zip"))
_who_names = ", ".join(f"p.{a}_{x} as {a}_{x}" for a in ("b", "c") for x in ("street_number", "street_name", "city", "zip"))
Q["q64"] = f"""
  with good as (select cs_item_sk as it from catalog_sales{back('cs', 'inner')} group by all having sum(cs_ext_list_price) > 2 * sum(cr_refunded_cash + cr_reversed_charge + cr_store_credit)),
  g as (
    select i_item_sk, i_product_name as product_name, s_store_name as store_name, s_zip as store_zip, {_who}, d1.d_year as syear, d2.d_year as fs, d3.d_year as s2y,
           count(*) as cnt, sum(ss_wholesale_cost)::double as s1, sum(ss_list_price)::double as s2, sum(ss_coupon_amt)::double as s3
    from store_sales{back('ss', 'inner')}{item('ss')} join date_dim d1 on d1.d_date_sk = ss_sold_date_sk join store on s_store_sk = ss_store_sk join customer on c_customer_sk = ss_customer_sk
    join date_dim d2 on d2.d_date_sk = c_first_sales_date_sk join date_dim d3 on d3.d_date_sk = c_first_shipto_date_sk join promotion on p_promo_sk = ss_promo_sk
    join customer_demographics m1 on m1.cd_demo_sk = ss_cdemo_sk join customer_demographics m2 on m2.cd_demo_sk = c_current_cdemo_sk and m2.cd_marital_status <> m1.cd_marital_status
    join household_demographics h1 on h1.hd_demo_sk = ss_hdemo_sk join household_demographics h2 on h2.hd_demo_sk = c_current_hdemo_sk
    join income_band i1 on i1.ib_income_band_sk = h1.hd_income_band_sk join income_band i2 on i2.ib_income_band_sk = h2.hd_income_band_sk
    join customer_address b on b.ca_address_sk = ss_addr_sk join customer_address c on c.ca_address_sk = c_current_addr_sk
    where i_color in ('cornsilk', 'rose', 'drab', 'coral', 'puff', 'peach', 'indian', 'green', 'papaya') and i_current_price between 23 and 32 and ss_item_sk in (from good) group by all)
  select p.product_name as product_name, p.store_name as store_name, p.store_zip as store_zip, {_who_names}, p.syear as syear, p.cnt as cnt, p.s1 as s11, p.s2 as s21, p.s3 as s31,
         n.s1 as s12, n.s2 as s22, n.s3 as s32, n.syear as syear_2, n.cnt as cnt_2
  from g p join g n on n.i_item_sk = p.i_item_sk and n.store_name = p.store_name and n.store_zip = p.store_zip and p.syear = 1999 and n.syear = 2000 and n.cnt <= p.cnt"""
Q["q65"] = top(f"""
  select s_store_name, i_item_desc, r::double as revenue, i_current_price::double as i_current_price, i_wholesale_cost::double as i_wholesale_cost, i_brand from (
    select ss_store_sk, ss_item_sk, sum(ss_sales_price) as r, sum(sum(ss_sales_price)) over (partition by ss_store_sk)::double / count(*) over (partition by ss_store_sk) * 0.1::double as lim
    from {sold('ss')} where d_month_seq between 1192 and 1203 group by ss_store_sk, ss_item_sk)
  join store on s_store_sk = ss_store_sk join item on i_item_sk = ss_item_sk where r::double <= lim""", "s_store_name, i_item_desc", "revenue")
_m = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_place = "w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country"
_lines66 = " union all ".join(f"""select {_place}, d_year as year, d_moy, {price} * {p}_quantity as sales, {p}_net_paid * {p}_quantity as net from {sold(p)} join warehouse on w_warehouse_sk = {p}_warehouse_sk
  join time_dim on t_time_sk = {p}_sold_time_sk join ship_mode on sm_ship_mode_sk = {p}_ship_mode_sk where d_year = 1998 and t_time between 46866 and 75666 and sm_carrier in ('GREAT EASTERN', 'UPS')""" for p, price in (("ws", "ws_ext_sales_price"), ("cs", "cs_sales_price")))
Q["q66"] = top(f"""select {_place}, 'GREAT EASTERN,UPS' as ship_carriers, year,
  {', '.join(f"coalesce(sum(sales) filter (d_moy = {i}), 0)::double as {m}_sales" for i, m in enumerate(_m, 1))},
  {', '.join(f"coalesce(sum(sales) filter (d_moy = {i}), 0)::double / w_warehouse_sq_ft as {m}_sales_per_sq_foot" for i, m in enumerate(_m, 1))},
  {', '.join(f"coalesce(sum(net) filter (d_moy = {i}), 0)::double as {m}_net" for i, m in enumerate(_m, 1))} from ({_lines66}) group by {_place}, year""", "w_warehouse_name")
_q67 = "i_category, i_class, i_brand, i_product_name, d_year, d_qoy, d_moy, s_store_id"
Q["q67"] = top(f"""select *, rank() over (partition by i_category order by sumsales desc nulls first) as rk from (
  select {_q67}, sum(coalesce(ss_sales_price * ss_quantity, 0))::double as sumsales from {sold('ss')}{item('ss')} join store on s_store_sk = ss_store_sk
  where d_month_seq between 1213 and 1224 group by rollup ({_q67})) qualify rk <= 100""", _q67 + ", sumsales, rk")
Q["q68"] = away("d_dom <= 2 and d_year in (2000, 2001, 2002)", ("Walnut Grove", "Enterprise"), "hd_dep_count = 3 or hd_vehicle_count = 3",
                "sum(ss_ext_sales_price)::double as extended_price, sum(ss_ext_tax)::double as extended_tax, sum(ss_ext_list_price)::double as list_price", "extended_price, extended_tax, list_price", "c_last_name, ss_ticket_number")
_q69 = "d_year = 2001 and d_moy in (4, 5, 6)"
Q["q69"] = top(f"""
  select cd_gender, cd_marital_status, cd_education_status, n as cnt1, cd_purchase_estimate, n as cnt2, cd_credit_rating, n as cnt3 from (
    select cd_gender, cd_marital_status, cd_education_status, cd_purchase_estimate, cd_credit_rating, count(*) as n
    from {active(_q69, "and ca_state in ('IA', 'GA', 'MN') and not " + elsewhere(_q69))} group by all)""", "cd_gender, cd_marital_status, cd_education_status, cd_purchase_estimate, cd_credit_rating")
Q["q70"] = hierarchy(f"{sold('ss')} join store on s_store_sk = ss_store_sk where d_month_seq between 1210 and 1221", "s_state", "s_county", "sum(ss_net_profit)::double", "total_sum", "desc nulls first")
Q["q71"] = f"""select i_brand_id as brand_id, i_brand as brand, t_hour, t_minute, sum(price)::double as ext_price from (
  {' union all '.join(f"select {p}_ext_sales_price as price, {p}_item_sk as it, {p}_sold_time_sk as tm from {sold(p)} where d_moy = 11 and d_year = 2001" for p in CH)})
  join item on i_item_sk = it join time_dim on t_time_sk = tm where i_manager_id = 1 and t_meal_time in ('breakfast', 'dinner') group by all"""
Q["q72"] = top(f"""
  select i_item_desc, w_warehouse_name, d1.d_week_seq as d_week_seq, count(*) filter (p_promo_sk is null) as no_promo, count(p_promo_sk) as promo, count(*) as total_cnt
  from catalog_sales join date_dim d1 on d1.d_date_sk = cs_sold_date_sk and d1.d_year = 2002 join date_dim d3 on d3.d_date_sk = cs_ship_date_sk and d3.d_date > d1.d_date + 5
  join inventory on inv_item_sk = cs_item_sk and inv_quantity_on_hand < cs_quantity join date_dim d2 on d2.d_date_sk = inv_date_sk and d2.d_week_seq = d1.d_week_seq
  join warehouse on w_warehouse_sk = inv_warehouse_sk join item on i_item_sk = cs_item_sk join customer_demographics on cd_demo_sk = cs_bill_cdemo_sk and cd_marital_status = 'M'
  join household_demographics on hd_demo_sk = cs_bill_hdemo_sk and hd_buy_potential = '>10000' left join promotion on p_promo_sk = cs_promo_sk{back('cs')} group by all""", "total_cnt desc, i_item_desc, w_warehouse_name, d_week_seq")
Q["q73"] = tickets("d_dom in (1, 2) and d_year in (1998, 1999, 2000)", ("Orange County", "San Miguel County", "Williamson County", "Brazos County"),
                   "hd_buy_potential in ('>10000', '0-500') and hd_vehicle_count > 0 and hd_dep_count > hd_vehicle_count", 1, 5)
Q["q74"] = top(f"""with s as ({growth('ss', 2001, 'ss_net_paid', 'min')}), w as ({growth('ws', 2001, 'ws_net_paid', 'min')})
  select c_customer_id as customer_id, c_first_name as customer_first_name, c_last_name as customer_last_name from s join w using (cust) join customer on c_customer_sk = cust
  where w.y2::double / w.y1::double > s.y2::double / s.y1::double""", "customer_last_name, customer_first_name, customer_id")
_k75 = "i_brand_id, i_class_id, i_category_id, i_manufact_id"


def _net75(p):
    return f"select d_year, {_k75}, {p}_quantity - coalesce({CH[p][4]}_return_quantity, 0) as n, {p}_ext_sales_price - coalesce({CH[p][7]}, 0) as a from {sold(p)}{item(p)}{back(p)} where i_category = 'Shoes'"


Q["q75"] = top(f"""with y as (select d_year, {_k75}, sum(n) as n, sum(a) as a from ({' union '.join(_net75(p) for p in CH)}) group by all)
  select p.d_year as prev_year, c.d_year as year, c.i_brand_id as i_brand_id, c.i_class_id as i_class_id, c.i_category_id as i_category_id, c.i_manufact_id as i_manufact_id,
         p.n::bigint as prev_yr_cnt, c.n::bigint as curr_yr_cnt, (c.n - p.n)::bigint as sales_cnt_diff, (c.a - p.a)::double as sales_amt_diff
  from y c join y p using ({_k75}) where c.d_year = 2000 and p.d_year = 1999 and {ratio('c.n', 'p.n')} < 0.9::double""", "sales_cnt_diff, sales_amt_diff", "i_brand_id, i_class_id, i_category_id, i_manufact_id")
Q["q76"] = top(" union all ".join(f"select '{n}' as channel, '{col}' as col_name, d_year, d_qoy, i_category, count(*) as sales_cnt, sum({p}_ext_sales_price)::double as sales_amt from {sold(p)}{item(p)} where {col} is null group by all"
                                  for n, p, col in (("store", "ss", "ss_hdemo_sk"), ("web", "ws", "ws_ship_mode_sk"), ("catalog", "cs", "cs_ship_customer_sk"))), "channel, col_name, d_year, d_qoy, i_category")
_w77 = within("1998-08-21", 0, 30)
_s77 = lambda p, k: f"(select {k} as id, sum({p}_ext_sales_price) as s, sum({p}_net_profit) as g from {sold(p)} where {_w77} group by all)"
_r77 = lambda p, k, t, a: f"(select {k} as id, sum({a}) as r, sum({p}_net_loss) as l from {t} join date_dim on d_date_sk = {p}_returned_date_sk where {_w77} group by all)"
Q["q77"] = top(f"""select channel, id, sum(s)::double as sales, sum(r)::double as returns, sum(p)::double as profit from (
  select 'store channel' as channel, id, s, coalesce(r, 0) as r, g - coalesce(l, 0) as p from {_s77('ss', 'ss_store_sk')} left join {_r77('sr', 'sr_store_sk', 'store_returns', 'sr_return_amt')} using (id)
  union all select 'catalog channel', a.id, s, r, g - l from {_s77('cs', 'cs_call_center_sk')} a, {_r77('cr', 'cr_call_center_sk', 'catalog_returns', 'cr_return_amount')} b
  union all select 'web channel', id, s, coalesce(r, 0), g - coalesce(l, 0) from {_s77('ws', 'ws_web_page_sk')} left join {_r77('wr', 'wr_web_page_sk', 'web_returns', 'wr_return_amt')} using (id))
  group by rollup (channel, id)""", "channel, id", "sales, returns, profit")


def _kept(p):
    return f"""(select {p}_item_sk as it, {CH[p][1]} as cu, sum({p}_quantity)::bigint as {p}q, sum({p}_wholesale_cost) as {p}w, sum({p}_sales_price) as {p}s
      from {sold(p)} where d_year = 2001 and not exists (from {CH[p][3]} where {CH[p][6]} = {CH[p][5]} and {CH[p][4]}_item_sk = {p}_item_sk) group by all)"""


Q["q78"] = top(f"""select cu as ss_customer_sk, round({ratio('ssq', 'coalesce(wsq, 0) + coalesce(csq, 0)')}, 2) as ratio, ssq as store_qty, ssw::double as store_wholesale_cost, sss::double as store_sales_price,
  coalesce(wsq, 0) + coalesce(csq, 0) as other_chan_qty, (coalesce(wsw, 0) + coalesce(csw, 0))::double as other_chan_wholesale_cost, (coalesce(wss, 0) + coalesce(css, 0))::double as other_chan_sales_price
  from {_kept('ss')} left join {_kept('ws')} using (it, cu) left join {_kept('cs')} using (it, cu) where greatest(wsq, csq) > 0""",
  "ss_customer_sk, store_qty desc, store_wholesale_cost desc, store_sales_price desc, other_chan_qty, other_chan_wholesale_cost, other_chan_sales_price, ratio")
Q["q79"] = top(f"""select c_last_name, c_first_name, left(s_city, 30) as city, ss_ticket_number, amt, profit from (
  select ss_ticket_number, ss_customer_sk, ss_addr_sk, s_city, sum(ss_coupon_amt)::double as amt, sum(ss_net_profit)::double as profit from {sold('ss')} join store on s_store_sk = ss_store_sk
  join household_demographics on hd_demo_sk = ss_hdemo_sk where (hd_dep_count = 1 or hd_vehicle_count > 3) and d_dow = 1 and d_year in (2000, 2001, 2002) and s_number_employees between 200 and 295 group by all)
  join customer on c_customer_sk = ss_customer_sk""", "c_last_name, c_first_name, city, profit", "ss_ticket_number, amt")


def outlet80(p, label, kind, table, pk, fk, ident):
    rp, amt = CH[p][4], CH[p][7]
    return f"""select '{label}' as channel, '{kind}' || {ident} as id, {p}_ext_sales_price as s, coalesce({amt}, 0) as r, {p}_net_profit - coalesce({rp}_net_loss, 0) as p
      from {sold(p)}{item(p)}{back(p)} join {table} on {pk} = {fk} join promotion on p_promo_sk = {p}_promo_sk and p_channel_tv = 'N' where i_current_price > 50 and {within('2002-08-04', 0, 30)}"""


Q["q80"] = top(f"""select channel, id, sum(s)::double as sales, sum(r)::double as returns, sum(p)::double as profit from ({outlet80('ss', 'store channel', 'store', 'store', 's_store_sk', 'ss_store_sk', 's_store_id')}
  union all {outlet80('cs', 'catalog channel', 'catalog_page', 'catalog_page', 'cp_catalog_page_sk', 'cs_catalog_page_sk', 'cp_catalog_page_id')}
  union all {outlet80('ws', 'web channel', 'web_site', 'web_site', 'web_site_sk', 'ws_web_site_sk', 'web_site_id')}) group by rollup (channel, id)""", "channel, id", "sales, returns, profit")
Q["q81"] = returners("catalog_returns", "cr", "cr_return_amt_inc_tax", 2000, "VA",
                     "c_customer_id, c_salutation, c_first_name, c_last_name, ca_street_number, ca_street_name, ca_street_type, ca_suite_number, ca_city, ca_county, ca_state, ca_zip, ca_country, ca_gmt_offset, ca_location_type")
Q["q82"] = stocked(72, "1998-01-23", (412, 343, 781, 156), "store_sales where ss_item_sk")


def _qty(p, table):
    return f"""(select i_item_id as item_id, sum({p}_return_quantity)::bigint as {p}_item_qty from {table} join date_dim on d_date_sk = {p}_returned_date_sk{item(p)}
      where d_week_seq in (select d_week_seq from date_dim where d_date in (date '1998-02-20', date '1998-09-28', date '1998-11-14')) group by all)"""


Q["q83"] = top(f"""select item_id, {', '.join(f"{p}_item_qty, {p}_item_qty::double / t / 3 * 100 as {p}_dev" for p in ('sr', 'cr', 'wr'))}, t::double / 3 as average
  from (select *, sr_item_qty + cr_item_qty + wr_item_qty as t from {_qty('sr', 'store_returns')} join {_qty('cr', 'catalog_returns')} using (item_id) join {_qty('wr', 'web_returns')} using (item_id))""", "item_id, sr_item_qty")
Q["q84"] = top("""select c_customer_id as customer_id, concat(c_last_name, ', ', c_first_name) as customername from customer join customer_address on ca_address_sk = c_current_addr_sk and ca_city = 'Shady Grove'
  join household_demographics on hd_demo_sk = c_current_hdemo_sk join income_band on ib_income_band_sk = hd_income_band_sk and ib_lower_bound >= 29438 and ib_upper_bound <= 79438
  join customer_demographics on cd_demo_sk = c_current_cdemo_sk join store_returns on sr_cdemo_sk = cd_demo_sk""", "customer_id")
Q["q85"] = top(f"""select left(r_reason_desc, 20) as reason, {avg('ws_quantity')} as avg_quantity, {avg('wr_refunded_cash')} as avg_refunded_cash, {avg('wr_fee')} as avg_fee
  from {sold('ws')}{back('ws', 'inner')} join web_page on wp_web_page_sk = ws_web_page_sk join customer_demographics a on a.cd_demo_sk = wr_refunded_cdemo_sk
  join customer_demographics b on b.cd_demo_sk = wr_returning_cdemo_sk and (b.cd_marital_status, b.cd_education_status) = (a.cd_marital_status, a.cd_education_status)
  join customer_address on ca_address_sk = wr_refunded_addr_sk join reason on r_reason_sk = wr_reason_sk
  where d_year = 1998 and case a.cd_marital_status when 'D' then a.cd_education_status = 'Primary' and ws_sales_price between 10 and 1500 when 'U' then a.cd_education_status = '4 yr Degree' and ws_sales_price between 5 and 1000
      when 'W' then a.cd_education_status = 'Advanced Degree' and ws_sales_price between 15 and 2000 else false end
    and case when ca_state in ('NM', 'CO', 'TX') then ws_net_profit between 100 and 20000 when ca_state in ('OH', 'VA', 'MO') then ws_net_profit between 150 and 30000
      when ca_state in ('FL', 'GA', 'MI') then ws_net_profit between 50 and 25000 else false end group by r_reason_desc""", "reason, avg_quantity, avg_refunded_cash, avg_fee")
Q["q86"] = hierarchy(f"{sold('ws')}{item('ws')} where d_month_seq between 1205 and 1216", "i_category", "i_class", "sum(ws_net_paid)::double", "total_sum", "desc nulls first")
Q["q87"] = "select count(*) as cnt from (" + " except ".join(name_days(p, 1208) for p in CH) + ")"
_slots = ["h8_30_to_9", "h9_to_9_30", "h9_30_to_10", "h10_to_10_30", "h10_30_to_11", "h11_to_11_30", "h11_30_to_12", "h12_to_12_30"]
_traffic = "from store_sales join time_dim on t_time_sk = ss_sold_time_sk join household_demographics on hd_demo_sk = ss_hdemo_sk join store on s_store_sk = ss_store_sk and s_store_name = 'ese'"
Q["q88"] = f"""select {', '.join(f"count(*) filter (t_time >= {(17 + i) * 1800} and t_time < {(18 + i) * 1800}) as {n}" for i, n in enumerate(_slots))} {_traffic}
  where hd_dep_count in (-1, 0, 1) and hd_vehicle_count <= hd_dep_count + 2"""
_k89 = "i_category, i_brand, s_store_name, s_company_name"
Q["q89"] = top(f"""select i_category, i_class, i_brand, s_store_name, s_company_name, d_moy, s::double as sum_sales, mid as avg_monthly_sales from (
  select *, sum(s) over (partition by {_k89})::double / count(s) over (partition by {_k89}) as mid from (
    select i_category, i_class, i_brand, s_store_name, s_company_name, d_moy, sum(ss_sales_price) as s from {sold('ss')}{item('ss')} join store on s_store_sk = ss_store_sk where d_year = 2000
      and ((i_category in ('Electronics', 'Women', 'Home') and i_class in ('cameras', 'maternity', 'kids')) or (i_category in ('Sports', 'Jewelry', 'Shoes') and i_class in ('guns', 'semi-precious', 'athletic'))) group by all))
  where mid <> 0 and abs(s::double - mid) / mid > 0.1""", "sum_sales - avg_monthly_sales, s_store_name", "i_category, i_class, i_brand, s_store_name, s_company_name, d_moy, sum_sales")
Q["q90"] = """select count(*) filter (t_hour in (8, 9))::double / nullif(count(*) filter (t_hour in (18, 19)), 0) as am_pm_ratio from web_sales join time_dim on t_time_sk = ws_sold_time_sk
  join household_demographics on hd_demo_sk = ws_ship_hdemo_sk and hd_dep_count = 9 join web_page on wp_web_page_sk = ws_web_page_sk and wp_char_count between 5000 and 5200"""
Q["q91"] = """select cc_call_center_id as call_center, cc_name as call_center_name, cc_manager as manager, sum(cr_net_loss)::double as returns_loss from catalog_returns join date_dim on d_date_sk = cr_returned_date_sk
  join call_center on cc_call_center_sk = cr_call_center_sk join customer on c_customer_sk = cr_returning_customer_sk join customer_demographics on cd_demo_sk = c_current_cdemo_sk
  join household_demographics on hd_demo_sk = c_current_hdemo_sk and starts_with(hd_buy_potential, 'Unknown') join customer_address on ca_address_sk = c_current_addr_sk and ca_gmt_offset = -6
  where d_year = 2002 and d_moy = 11 and (cd_marital_status, cd_education_status) in (('M', 'Unknown'), ('W', 'Advanced Degree')) group by cc_call_center_id, cc_name, cc_manager, cd_marital_status, cd_education_status"""
Q["q92"] = excess("ws", 939, "2002-02-16")
Q["q93"] = top(f"select ss_customer_sk, sum((ss_quantity - coalesce(sr_return_quantity, 0)) * ss_sales_price)::double as sumsales from store_sales{back('ss', 'inner')} join reason on r_reason_sk = sr_reason_sk where r_reason_desc = 'reason 70' group by all", "sumsales, ss_customer_sk")
_site = "web_site on web_site_sk = ws_web_site_sk and web_company_name = 'pri'"
Q["q94"] = shipped("ws", "ws_ship_date_sk", "2002-02-01", "CA", _site, False)
Q["q95"] = shipped("ws", "ws_ship_date_sk", "2002-02-01", "TN", _site, True)
Q["q96"] = f"select count(*) as cnt {_traffic} where t_hour = 8 and t_minute >= 30 and hd_dep_count = 5"
Q["q97"] = f"""select count(*) filter (a and b is null) as store_only, count(*) filter (b and a is null) as catalog_only, count(*) filter (a and b) as store_and_catalog
  from (select distinct ss_customer_sk as cu, ss_item_sk as it, true as a from {sold('ss')} where d_month_seq between 1214 and 1225 and ss_customer_sk is not null)
  full join (select distinct cs_bill_customer_sk as cu, cs_item_sk as it, true as b from {sold('cs')} where d_month_seq between 1214 and 1225 and cs_bill_customer_sk is not null) using (cu, it)"""
Q["q98"] = class_share("ss", ("Women", "Electronics", "Shoes"), "2002-05-27", limit=False)
Q["q99"] = ship_lags("cs", 1200, "call_center on cc_call_center_sk = cs_call_center_sk", "cc_name")

SQL = {f"tpcds_{name}": star(text) for name, text in Q.items()}
