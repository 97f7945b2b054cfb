"""The decision-support query pack: 103 parameterised DataFrame queries.

``QUERIES[name](tables, **parameters)`` runs one query on any object that has
the tables as attributes, see ``millrace.plans.tables``.
"""

from millrace.plans.tpcds import part1, part2, part3, part4

QUERIES = {
    name: fn
    for part in (part1, part2, part3, part4)
    for name, fn in vars(part).items()
    if name[0] == "q" and name[1:3].isdigit() and callable(fn)
}
