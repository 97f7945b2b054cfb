"""A retail star schema (24 tables) derived from the order/line tables by plain SQL.

The query pack in ``millrace.plans.tpcds`` runs on any catalogue that has the
public TPC-DS table and column names.  Where no such data set is at hand this
module derives one: every fact row comes from one order line, every dimension
row from a customer, part or supplier, so the volume grows with the input.

The text is written once for both engines; the few places where the engines
spell a function differently go through ``Dialect``.  Money is computed in
whole cents and only then turned into ``decimal(8,2)``, so that both sides
agree to the last digit and ``sum`` stays within a 64-bit decimal.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# Value domains of the derived dimensions (fixed values).
STATES = ["TN", "GA", "MI", "OH", "VA", "TX", "AL", "MN", "CA", "NM", "IA", "FL"]
PLACES = [  # city, county, state, zip shared by stores and a third of the addresses
    ("Woodland", "Quay County", "NM", "85669"),
    ("Walnut Grove", "Orange County", "MI", "86197"),
    ("Enterprise", "Williamson County", "GA", "88274"),
    ("Springfield", "Sumner County", "TN", "83405"),
    ("Oakdale", "Brazos County", "OH", "35709"),
]
CITIES = ["Shady Grove", "Rockville", "Woodland", "Oakdale", "Pleasant Grove", "Fairview", "Midway"]
COUNTIES = ["Polk County", "Denton County", "Union County", "Swisher County", "Cherokee County", "Luce County"]
ZIPS = ["86475", "85392", "85460", "80348", "81792", "31904", "57834", "28721", "69843", "74136"]
COUNTRIES = ["CANADA", "FRANCE", "UNITED STATES", "JAPAN", "BRAZIL"]
CATEGORIES = ["Women", "Men", "Children", "Shoes", "Music", "Jewelry", "Home", "Sports", "Books", "Electronics"]
CLASSES = ["personal", "portable", "reference", "self-help", "accessories", "classical", "fragrances", "pants",
           "cameras", "maternity", "kids", "guns", "semi-precious", "athletic", "womens", "mens"]
BRANDS = ["scholaramalgamalg #14", "scholaramalgamalg #7", "exportiunivamalg #9", "scholaramalgamalg #9",
          "amalgimporto #1", "edu packscholar #1", "exportiimporto #1", "importoamalg #1", "corpnameless #3"]
MANUFACTURERS = [540, 283, 939, 910, 893, 984, 865, 412, 343, 781, 156, 870, 880, 890, 900, 12, 77, 205, 318, 666]
MANAGERS = [1, 8, 96, 17, 28, 39, 40, 52]
COLORS = ["cornsilk", "lime", "rose", "brown", "drab", "burlywood", "coral", "dark", "puff", "smoke", "peach",
          "seashell", "indian", "thistle", "green", "steel", "papaya"]
UNITS = ["Carton", "Dozen", "Box", "Tsp", "Dram", "Bundle", "Gross", "Oz"]
SIZES = ["small", "extra large", "N/A", "large", "petite", "economy"]
EDUCATION = ["Primary", "Secondary", "College", "2 yr Degree", "4 yr Degree", "Advanced Degree", "Unknown"]
BUY_POTENTIAL = ["0-500", "501-1000", "1001-5000", "5001-10000", ">10000", "Unknown"]
FIRST_NAMES = ["Ann", "Ben", "Cleo", "Dan", "Eve", "Finn", "Gail", "Hugo", "Iris", "Jon", "Kim"]
LAST_NAMES = ["Abbot", "Baker", "Cole", "Dorn", "Ellis", "Frost", "Grant", "Hayes", "Irwin", "Jones", "Kane", "Lowe", "Moss"]
DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Date key of a sale from the day of its order; sales are partitioned by periods of it, which a fact shows in a column of this suffix.
SOLD = "{} + 540 + 2440588"
PERIOD_DAYS, PERIOD_SUFFIX = 91, "_period"


@dataclass(frozen=True)
class Dialect:
    name: str

    def div(self, a, b):
        return f"(({a}) div ({b}))" if self.name == "spark" else f"(({a}) // ({b}))"

    def days(self, expr):
        """Days since 1970-01-01."""
        if self.name == "spark":
            return f"cast(datediff(cast({expr} as date), date '1970-01-01') as bigint)"
        return f"cast(datediff('day', date '1970-01-01', cast({expr} as date)) as bigint)"

    def date_of(self, days):
        if self.name == "spark":
            return f"date_add(date '1970-01-01', cast({days} as int))"
        return f"(date '1970-01-01' + cast({days} as int))"

    def ints(self, lo, hi):
        """One column ``n`` with the integers lo..hi."""
        if self.name == "spark":
            return f"(select id as n from range({lo}, {hi + 1}))"
        return f"(select n from range({lo}, {hi + 1}) r(n))"


def _pick(values, index):
    text = "|".join(str(v) for v in values).replace("'", "''")
    return f"split_part('{text}', '|', cast(({index}) % {len(values)} as int) + 1)"


def _money(cents):
    return f"cast(cast({cents} as decimal(18,0)) * 0.01 as decimal(8,2))"


def _id(prefix, expr):
    return f"concat('{prefix}', lpad(cast({expr} as varchar(20)), 10, '0'))"


def star_sql(dialect_name: str) -> dict[str, str]:
    """name -> SELECT text, in dependency order."""
    d = Dialect(dialect_name)
    t: dict[str, str] = {}

    def period(name, alias=None):
        """One more column, the period of the sale: only Spark's tables have it."""
        return f", {name} as {alias or name}" if d.name == "spark" else ""

    # The one join under all facts; Spark writes it once, as it came, and the facts are views of it.
    # Orders grow like their lines, so they meet by a shuffle at any size: what is moved stays in proportion to the input.
    lines = "lineitem join orders on l_orderkey = o_orderkey"
    if d.name == "spark":
        t["order_line"] = f"""
select /*+ merge(orders) */ l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax, o_custkey, o_orderdate,
       cast({d.div(SOLD.format(d.days('o_orderdate')), PERIOD_DAYS)} as int) as sold_period
from {lines}"""
        lines = "order_line"
    # One row per order line; everything the facts need, in cents.
    t["sale_line"] = f"""
select l_orderkey + 1 as ord, l_linenumber as ln, l_partkey + 1 as item_sk, l_suppkey as supp,
       o_custkey as cust, l_orderkey % 10 as m, l_returnflag as flag,
       {SOLD.format(d.days('o_orderdate'))} as sold_sk,
       l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7 as h,
       (l_orderkey * 7919 + 13) % 86400 as time_sk,
       2 * cast(l_quantity as bigint) as qty,
       cast(floor(l_extendedprice / l_quantity * 10) as bigint) as list_c,
       {d.div("cast(floor(l_extendedprice / l_quantity * 10) as bigint) * (100 - cast(round(l_discount * 100) as bigint))", 100)} as price_c,
       {d.div("cast(floor(l_extendedprice / l_quantity * 10) as bigint) * (40 + (l_orderkey + l_partkey) % 50)", 100)} as cost_c,
       cast(round(l_tax * 100) as bigint) as tax_pct{period('sold_period')}
from {lines}"""
    t["sale_amounts"] = f"""
select *, qty * price_c as ext_c, qty * list_c as extl_c, qty * cost_c as extw_c,
       case when h % 5 = 0 then {d.div('qty * price_c', 10)} else 0 end as coupon_c,
       qty * price_c - case when h % 5 = 0 then {d.div('qty * price_c', 10)} else 0 end as paid_c,
       1 + h % qty as rqty, (1 + h % qty) * price_c as ramt_c
from sale_line"""

    def amounts(p, ship_cost):
        cols = [("wholesale_cost", "cost_c"), ("list_price", "list_c"), ("sales_price", "price_c"),
                ("ext_discount_amt", "extl_c - ext_c"), ("ext_sales_price", "ext_c"),
                ("ext_wholesale_cost", "extw_c"), ("ext_list_price", "extl_c"),
                ("ext_tax", d.div("paid_c * tax_pct", 100)), ("coupon_amt", "coupon_c"),
                ("net_paid", "paid_c"), ("net_paid_inc_tax", "paid_c + " + d.div("paid_c * tax_pct", 100)),
                ("net_profit", "paid_c - extw_c")]
        if ship_cost:
            cols.append(("ext_ship_cost", d.div("ext_c", 12)))
        return ", ".join(f"{_money(e)} as {p}_{n}" for n, e in cols)

    def returns(p, amount):
        cols = [(amount, "ramt_c"), ("return_amt_inc_tax", "ramt_c + " + d.div("ramt_c * tax_pct", 100)),
                ("fee", "50 + h % 9900"), ("refunded_cash", d.div("ramt_c", 2)),
                ("reversed_charge", d.div("ramt_c", 5)), ("net_loss", d.div("ramt_c", 10) + " + 50")]
        cols.append(("account_credit" if p == "wr" else "store_credit", d.div("ramt_c", 10)))
        return ", ".join(f"{_money(e)} as {p}_{n}" for n, e in cols)

    customer = "case when h % 60 = 0 then null else cust + 1 end"
    address = "(cust - cust % 4) + 1"
    demo = "(cust - cust % 3) + 1"
    home_demo = "(cust - cust % 2) + 1"
    store = d.div("supp", 10) + " + 1"
    depot = d.div("supp", 20) + " + 1"
    t["store_sales"] = f"""
select sold_sk as ss_sold_date_sk, time_sk as ss_sold_time_sk, item_sk as ss_item_sk, {customer} as ss_customer_sk,
       {demo} as ss_cdemo_sk, case when h % 50 = 0 then null else {home_demo} end as ss_hdemo_sk,
       {address} as ss_addr_sk, {store} as ss_store_sk,
       case when h % 30 = 0 then null else supp + 1 end as ss_promo_sk, ord as ss_ticket_number, qty as ss_quantity,
       {amounts('ss', False)}{period('sold_period', 'ss_sold_date_sk' + PERIOD_SUFFIX)}
from sale_amounts where m <= 4"""
    t["store_returns"] = f"""
select sold_sk + 1 + h % 130 as sr_returned_date_sk, item_sk as sr_item_sk, {customer} as sr_customer_sk,
       {demo} as sr_cdemo_sk, {store} as sr_store_sk, h % 70 + 1 as sr_reason_sk, ord as sr_ticket_number,
       rqty as sr_return_quantity, {returns('sr', 'return_amt')}
from sale_amounts where m <= 4 and flag = 'R'"""
    cat_date = "sold_sk + case when m = 3 then 40 else 0 end"
    t["catalog_sales"] = f"""
select {cat_date} as cs_sold_date_sk, time_sk as cs_sold_time_sk, {cat_date} + 1 + h % 130 as cs_ship_date_sk,
       {customer} as cs_bill_customer_sk, {demo} as cs_bill_cdemo_sk, {home_demo} as cs_bill_hdemo_sk,
       {address} as cs_bill_addr_sk, case when h % 40 = 0 then null else cust + 1 end as cs_ship_customer_sk,
       cust + 1 as cs_ship_addr_sk, {depot} as cs_call_center_sk, supp + 1 as cs_catalog_page_sk,
       h % 20 + 1 as cs_ship_mode_sk, {depot} as cs_warehouse_sk, item_sk as cs_item_sk,
       case when h % 30 = 0 then null else supp + 1 end as cs_promo_sk, ord as cs_order_number, qty as cs_quantity,
       {amounts('cs', True)}
from sale_amounts where m in (3, 4, 5, 6, 9)"""
    t["catalog_returns"] = f"""
select {cat_date} + 1 + h % 130 as cr_returned_date_sk, item_sk as cr_item_sk,
       {customer} as cr_returning_customer_sk, {address} as cr_returning_addr_sk, {depot} as cr_call_center_sk,
       supp + 1 as cr_catalog_page_sk, ord as cr_order_number, rqty as cr_return_quantity,
       {returns('cr', 'return_amount')}
from sale_amounts where m in (3, 4, 5, 6, 9) and flag = 'R'"""
    web_date = "sold_sk + case when m in (5, 6) then 10 else 0 end"
    t["web_sales"] = f"""
select {web_date} as ws_sold_date_sk, time_sk as ws_sold_time_sk, {web_date} + 1 + h % 130 as ws_ship_date_sk,
       item_sk as ws_item_sk, {customer} as ws_bill_customer_sk, {address} as ws_bill_addr_sk,
       {home_demo} as ws_ship_hdemo_sk, cust + 1 as ws_ship_addr_sk, supp + 1 as ws_web_page_sk,
       {depot} as ws_web_site_sk, case when h % 40 = 0 then null else h % 20 + 1 end as ws_ship_mode_sk,
       {depot} as ws_warehouse_sk, supp + 1 as ws_promo_sk, ord as ws_order_number, qty as ws_quantity,
       {amounts('ws', True)}
from sale_amounts where m >= 4"""
    t["web_returns"] = f"""
select {web_date} + 1 + h % 130 as wr_returned_date_sk, item_sk as wr_item_sk, {demo} as wr_refunded_cdemo_sk,
       case when h % 2 = 0 then {demo} else {home_demo} end as wr_returning_cdemo_sk,
       {customer} as wr_returning_customer_sk, {address} as wr_refunded_addr_sk, {address} as wr_returning_addr_sk,
       supp + 1 as wr_web_page_sk, h % 70 + 1 as wr_reason_sk, ord as wr_order_number,
       rqty as wr_return_quantity, {returns('wr', 'return_amt')}
from sale_amounts where m >= 4 and flag = 'R'"""
    # Eight weekly stock counts after every order line.
    stock = "case when (item_sk + n) % 3 = 0 then (item_sk * 13 + n * 17) % 900 + 50 else (item_sk + n * n) % 9 end"
    t["inventory"] = f"""
select distinct {d.div('sold_sk', 7)} * 7 + 7 * n as inv_date_sk, item_sk as inv_item_sk, {depot} as inv_warehouse_sk,
       {stock}
           as inv_quantity_on_hand
from sale_line cross join {d.ints(0, 7)} weeks"""
    if d.name == "spark":
        # The same rows: the weeks of an item and warehouse meet, and the eightfold of them is made and told apart where they are.
        # A count is below 1000, so it and its date fit one number.
        stock_of = lambda lines: f"""
select {d.div('dated', 1000)} as inv_date_sk, item_sk as inv_item_sk, inv_warehouse_sk, dated % 1000 as inv_quantity_on_hand
from (select item_sk, inv_warehouse_sk, explode(array_distinct(flatten(transform(weeks, w -> transform(sequence(0L, 7L), n -> (w + n) * 7000 + {stock}))))) as dated
      from (select item_sk, {depot} as inv_warehouse_sk, collect_set({d.div('sold_sk', 7)}) as weeks from {lines} group by 1, 2))"""
        t["inventory"] = stock_of("sale_line")
        # Stock of some days comes from the lines of the same week and the seven before; no week lies in two periods.
        t["stock_line"] = f"""
select * from sale_line left semi join (
    select explode(sequence({d.div('d_date_sk', 7)} - 7, {d.div('d_date_sk', 7)})) as week from calendar where d_date_sk % 7 = 0)
on {d.div('sold_sk', 7)} = week and sold_period = {d.div('week * 7', PERIOD_DAYS)}"""
        t["inventory_near"] = stock_of("stock_line")

    k = "c_custkey"
    place = [_pick([p[i] for p in PLACES], d.div(k, 3)) for i in range(4)]
    t["customer"] = f"""
select {k} + 1 as c_customer_sk, {_id('C', k)} as c_customer_id, ({k} - {k} % 20) + 1 as c_current_cdemo_sk,
       ({k} - {k} % 7) + 1 as c_current_hdemo_sk, {k} + 1 as c_current_addr_sk,
       2440588 + 9500 + ({k} * 37) % 1500 as c_first_sales_date_sk,
       2440588 + 9530 + ({k} * 37) % 1500 as c_first_shipto_date_sk,
       {_pick(['Mr.', 'Mrs.', 'Dr.', 'Ms.'], k)} as c_salutation,
       case when {k} % 50 = 49 then null else {_pick(FIRST_NAMES, d.div(k, 13))} end as c_first_name,
       {_pick(LAST_NAMES, k)} as c_last_name,
       case when {k} % 2 = 0 then 'Y' else 'N' end as c_preferred_cust_flag,
       {k} % 28 + 1 as c_birth_day, {k} % 12 + 1 as c_birth_month, 1930 + {k} % 60 as c_birth_year,
       {_pick(COUNTRIES, d.div(k, 2))} as c_birth_country, cast(null as varchar(10)) as c_login,
       concat('c', cast({k} as varchar(20)), '@example.com') as c_email_address,
       2440588 + 10500 + {k} % 300 as c_last_review_date
from src_customer"""
    t["customer_address"] = f"""
select {k} + 1 as ca_address_sk, cast(1 + ({k} * 7) % 999 as varchar(10)) as ca_street_number,
       {_pick(['Main', 'Oak', 'Hill', 'Lake', 'Park'], k)} as ca_street_name,
       {_pick(['Street', 'Ave', 'Blvd', 'Lane'], k)} as ca_street_type,
       concat('Suite ', cast({k} % 100 as varchar(10))) as ca_suite_number,
       case when {k} % 3 = 0 then {place[0]} else {_pick(CITIES, k)} end as ca_city,
       case when {k} % 3 = 0 then {place[1]} else {_pick(COUNTIES, d.div(k, 2))} end as ca_county,
       case when {k} % 3 = 0 then {place[2]} else {_pick(STATES, d.div(k, 4))} end as ca_state,
       case when {k} % 3 = 0 then {place[3]} else {_pick(ZIPS, d.div(k, 5))} end as ca_zip,
       'United States' as ca_country, cast(case when {d.div(k, 3)} % 3 = 0 then -6 else -5 end as bigint) as ca_gmt_offset,
       {_pick(['apartment', 'condo', 'single family'], k)} as ca_location_type
from src_customer"""
    t["customer_demographics"] = f"""
select {k} + 1 as cd_demo_sk, {_pick(['M', 'F'], d.div(k, 30))} as cd_gender,
       {_pick(['M', 'S', 'D', 'W', 'U'], d.div(k, 15))} as cd_marital_status,
       {_pick(EDUCATION, d.div(k, 3))} as cd_education_status, ({k} % 20 + 1) * 500 as cd_purchase_estimate,
       {_pick(['Low Risk', 'Good', 'High Risk', 'Unknown'], d.div(k, 5))} as cd_credit_rating,
       {d.div(k, 5)} % 7 as cd_dep_count, {d.div(k, 35)} % 7 as cd_dep_employed_count,
       {d.div(k, 10)} % 7 as cd_dep_college_count
from src_customer"""
    t["household_demographics"] = f"""
select {k} + 1 as hd_demo_sk, {k} % 20 + 1 as hd_income_band_sk, {_pick(BUY_POTENTIAL, d.div(k, 2))} as hd_buy_potential,
       {d.div(k, 4)} % 10 as hd_dep_count, {k} % 5 as hd_vehicle_count
from src_customer"""
    t["income_band"] = f"""
select b as ib_income_band_sk, case when b = 1 then 0 else (b - 1) * 10000 + 1 end as ib_lower_bound,
       b * 10000 as ib_upper_bound
from (select distinct {k} % 20 + 1 as b from src_customer) bands"""
    t["ship_mode"] = f"""
select b as sm_ship_mode_sk, {_pick(['EXPRESS', 'OVERNIGHT', 'REGULAR', 'TWO DAY', 'LIBRARY'], 'b')} as sm_type,
       {_pick(['UPS', 'DHL', 'GREAT EASTERN', 'FEDEX'], 'b')} as sm_carrier
from (select distinct {k} % 20 + 1 as b from src_customer) modes"""
    t["reason"] = f"""
select b as r_reason_sk, concat('reason ', cast(b as varchar(10))) as r_reason_desc
from (select distinct {k} % 70 + 1 as b from src_customer) reasons"""

    day = "(2440588 + n)"
    date = d.date_of("n")
    t["date_dim"] = f"""
select {day} as d_date_sk, dt as d_date, cast(year(dt) as bigint) as d_year, cast(month(dt) as bigint) as d_moy,
       cast(day(dt) as bigint) as d_dom, cast(quarter(dt) as bigint) as d_qoy, (n + 4) % 7 as d_dow,
       {_pick(DAYS, '(n + 4)')} as d_day_name, {d.div('n + 4', 7)} as d_week_seq,
       cast((year(dt) - 1900) * 12 + month(dt) - 1 as bigint) as d_month_seq,
       concat(cast(year(dt) as varchar(4)), 'Q', cast(quarter(dt) as varchar(1))) as d_quarter_name
from (select n, {date} as dt from {d.ints(8766, 12783)} days) calendar"""
    t["time_dim"] = f"""
select n as t_time_sk, n as t_time, {d.div('n', 3600)} as t_hour, {d.div('n', 60)} % 60 as t_minute,
       case when {d.div('n', 3600)} between 6 and 8 then 'breakfast'
            when {d.div('n', 3600)} between 11 and 13 then 'lunch'
            when {d.div('n', 3600)} between 17 and 20 then 'dinner' end as t_meal_time
from {d.ints(0, 86399)} seconds"""

    p = "p_partkey"
    t["item"] = f"""
select {p} + 1 as i_item_sk, {_id('I', d.div(p, 2))} as i_item_id, concat(p_name, ' ', lower(p_type), ' ', cast({p} as varchar(20))) as i_item_desc,
       {_money(f"case {p} % 7 when 0 then 99 + {p} % 50 when 1 then 2200 + {p} % 1000 else 100 + ({p} * 7919) % 10000 end")} as i_current_price,
       {_money(f"50 + ({p} * 4271) % 6000")} as i_wholesale_cost,
       cast({_pick(range(1, 10), d.div(p, 10))} as bigint) as i_brand_id, {_pick(BRANDS, d.div(p, 10))} as i_brand,
       {d.div(p, 20)} % 16 + 1 as i_class_id, {_pick(CLASSES, d.div(p, 20))} as i_class,
       {p} % 10 + 1 as i_category_id, {_pick(CATEGORIES, p)} as i_category,
       cast({_pick(MANUFACTURERS, f'{p} * 3 + ' + d.div(p, 50))} as bigint) as i_manufact_id,
       concat('manufact', {_pick(MANUFACTURERS, f'{p} * 3 + ' + d.div(p, 50))}) as i_manufact,
       {_pick(SIZES, d.div(p, 3))} as i_size, {_pick(COLORS, p)} as i_color, {_pick(UNITS, d.div(p, 7))} as i_units,
       cast({_pick(MANAGERS, d.div(p, 3))} as bigint) as i_manager_id, concat('product ', cast({p} as varchar(20))) as i_product_name
from src_part"""

    s = "s_suppkey"
    b10, b20 = d.div(s, 10), d.div(s, 20)
    sp = [_pick([x[i] for x in PLACES], b10) for i in range(4)]
    t["store"] = f"""
select {b10} + 1 as s_store_sk, {_id('S', b10)} as s_store_id, {_pick(['ese', 'ought', 'able', 'pri', 'ese', 'anti'], b10)} as s_store_name,
       200 + {b10} % 100 as s_number_employees, case when {b10} % 4 in (0, 1) then 8 else 3 end as s_market_id,
       cast(1 as bigint) as s_company_id, 'Unknown' as s_company_name, cast(100 + {b10} as varchar(10)) as s_street_number,
       'Market' as s_street_name, 'Street' as s_street_type, concat('Suite ', cast({b10} % 10 as varchar(10))) as s_suite_number,
       {sp[0]} as s_city, {sp[1]} as s_county, {sp[2]} as s_state, {sp[3]} as s_zip,
       case when {b10} % 2 = 0 then -6 else -5 end as s_gmt_offset
from src_supplier where {s} % 10 = 0"""
    t["warehouse"] = f"""
select {b20} + 1 as w_warehouse_sk, concat('Warehouse number ', cast({b20} as varchar(10))) as w_warehouse_name,
       50000 + {b20} * 1111 as w_warehouse_sq_ft, {_pick([x[0] for x in PLACES], b20)} as w_city,
       {_pick([x[1] for x in PLACES], b20)} as w_county, {_pick([x[2] for x in PLACES], b20)} as w_state,
       'United States' as w_country
from src_supplier where {s} % 20 = 0"""
    t["call_center"] = f"""
select {b20} + 1 as cc_call_center_sk, {_id('CC', b20)} as cc_call_center_id, concat('center ', cast({b20} as varchar(10))) as cc_name,
       {_pick(LAST_NAMES, b20)} as cc_manager, {_pick(['Luce County', 'Marshall County', 'Bronx County'], b20)} as cc_county
from src_supplier where {s} % 20 = 0"""
    t["web_site"] = f"""
select {b20} + 1 as web_site_sk, {_id('W', b20)} as web_site_id, concat('site_', cast({b20} as varchar(10))) as web_name,
       {_pick(['pri', 'able'], b20)} as web_company_name
from src_supplier where {s} % 20 = 0"""
    t["web_page"] = f"select {s} + 1 as wp_web_page_sk, 5000 + ({s} * 13) % 1000 as wp_char_count from src_supplier"
    t["catalog_page"] = f"select {s} + 1 as cp_catalog_page_sk, {_id('P', s)} as cp_catalog_page_id from src_supplier"
    flag = lambda n: f"case when {s} % {n} = 0 then 'Y' else 'N' end"
    t["promotion"] = f"""
select {s} + 1 as p_promo_sk, {flag(2)} as p_channel_email, {flag(3)} as p_channel_event,
       {flag(5)} as p_channel_dmail, {flag(7)} as p_channel_tv
from src_supplier"""
    return t


# Source tables whose name a derived table also uses; they are read under this alias.
RENAMED_SOURCES = {"src_customer": "customer", "src_part": "part", "src_supplier": "supplier"}


def needed_tables(texts: dict[str, str], query: str) -> list[str]:
    """Names from ``texts`` that ``query`` uses, directly or not, in definition order."""
    found: set[str] = set()
    todo = [query]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        new = [n for n in texts if n in words and n not in found]
        found.update(new)
        todo.extend(texts[n] for n in new)
    return [n for n in texts if n in found]
