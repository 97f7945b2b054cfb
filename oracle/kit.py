"""Small text helpers for the DuckDB side of the checks."""

from __future__ import annotations

from millrace.plans.star import RENAMED_SOURCES, needed_tables, star_sql

_STAR = star_sql("duckdb")


def star(query: str) -> str:
    """Put the derived tables a query uses in front of it."""
    ctes = [f"{alias} as (select * from {src})" for alias, src in RENAMED_SOURCES.items()]
    ctes += [f"{n} as ({_STAR[n]})" for n in needed_tables(_STAR, query)]
    return f"with {', '.join(ctes)} select * from ({query}) answer"


def avg(x: str) -> str:
    return f"(sum({x})::double / count({x}))"


def ratio(a: str, b: str) -> str:
    return f"(({a})::double / nullif(({b})::double, 0))"


def sd(x: str) -> str:
    return f"round(stddev_samp(({x})::double), 6)"


def cov(x: str) -> str:
    return f"round(stddev_samp(({x})::double) / nullif({avg(x)}, 0), 6)"


def keys(text: str) -> str:
    """Spell out the null order: NULL is the largest value."""
    out = []
    for k in text.split(","):
        k = k.strip()
        out.append(k + " nulls first" if k.endswith(" desc") else k + " nulls last")
    return ", ".join(out)


def top(query: str, order: str, columns: str = "", n: int = 100) -> str:
    full = order + (", " + columns if columns else "")
    return f"select * from ({query}) ranked order by {keys(full)} limit {n}"


def within(day: str, before: int, after: int) -> str:
    return f"d_date between date '{day}' - {before} and date '{day}' + {after}"


def lags(days: str) -> str:
    edges = [("d30", None, 30), ("d60", 30, 60), ("d90", 60, 90), ("d120", 90, 120), ("over", 120, None)]
    parts = []
    for name, lo, hi in edges:
        cond = " and ".join(([f"{days} > {lo}"] if lo is not None else []) + ([f"{days} <= {hi}"] if hi is not None else []))
        parts.append(f'count(*) filter ({cond}) as "{name}"')
    return ", ".join(parts)


WEEK = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def weekdays(value: str, cast: str = "") -> str:
    return ", ".join(f"sum({value}) filter (d_day_name = '{d}'){cast} as {d[:3].lower()}_sales" for d in WEEK)


# sales prefix -> sales table, buyer, buyer address, returns table, returns prefix, number, return number, return amount
CH = {
    "ss": ("store_sales", "ss_customer_sk", "ss_addr_sk", "store_returns", "sr", "ss_ticket_number", "sr_ticket_number", "sr_return_amt"),
    "cs": ("catalog_sales", "cs_bill_customer_sk", "cs_bill_addr_sk", "catalog_returns", "cr", "cs_order_number", "cr_order_number", "cr_return_amount"),
    "ws": ("web_sales", "ws_bill_customer_sk", "ws_bill_addr_sk", "web_returns", "wr", "ws_order_number", "wr_order_number", "wr_return_amt"),
}


def sold(p: str) -> str:
    return f"{CH[p][0]} join date_dim on d_date_sk = {p}_sold_date_sk"


def item(p: str) -> str:
    return f" join item on i_item_sk = {p}_item_sk"


def back(p: str, how: str = "left") -> str:
    t, rp, n, rn = CH[p][3], CH[p][4], CH[p][5], CH[p][6]
    return f" {how} join {t} on {rn} = {n} and {rp}_item_sk = {p}_item_sk"
