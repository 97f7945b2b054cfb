"""The query pack on the derived star, with parameters that suit its value domains."""

from __future__ import annotations

from millrace.plans.catalog.common import plain
from millrace.plans.star import COLORS
from millrace.plans.tables import derived_tables
from millrace.plans.tpcds import QUERIES

# Where the published parameters select nothing on the derived star.
PARAMETERS = {
    "q08": lambda t: {"zips": t.customer_address.where("ca_gmt_offset = -6").select("ca_zip")},
    "q09": lambda t: {"thresholds": (177560856, 1000, 357290662, 1000, 80111186)},
    "q13": lambda t: {"demo": (("D", "2 yr Degree", 0, 1500, 3), ("U", "Primary", 50, 5000, 1), ("W", "Secondary", 15, 2000, 1)),
                      "address": ((("MI", "MN", "NC"), -5000, 20000), (("GA", "OH", "MT"), 150, 3000), (("NM", "AL", "TX"), 50, 25000))},
    "q18": lambda t: {"states": ("TN", "GA", "MI", "OH", "NM", "TX", "VA")},
    "q23": lambda t: {"often": 1, "share": 0.5},
    "q23b": lambda t: {"often": 1, "share": 0.5},
    "q34": lambda t: {"least": 2},
    "q41": lambda t: {"variants": (("Women", ("thistle", "papaya", "rose"), ("Gross", "Oz", "Carton", "Box"), ("petite", "small", "extra large")),
                                   ("Men", ("burlywood", "peach"), ("Dram", "Bundle", "Box"), ("petite", "small", "large")))},
    "q44": lambda t: {"store": 3},
    "q64": lambda t: {"colors": tuple(COLORS[::2])},
    "q85": lambda t: {"demo": (("D", "Primary", 10, 1500), ("U", "4 yr Degree", 5, 1000), ("W", "Advanced Degree", 15, 2000)),
                      "address": ((("NM", "CO", "TX"), 100, 20000), (("OH", "VA", "MO"), 150, 30000), (("FL", "GA", "MI"), 50, 25000))},
}


def _entry(name):
    def run(spark, folder):
        tables = derived_tables(spark, folder)
        return plain(QUERIES[name](tables, **(PARAMETERS[name](tables) if name in PARAMETERS else {})))
    return run


PACK = {f"tpcds_{name}": _entry(name) for name in QUERIES}
