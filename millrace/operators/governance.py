"""Role- and tenant-dependent views.

Spark itself does not enforce who may call what: these functions build the data
a principal is meant to see, and whoever exposes the data must pass the caller.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import work_dir
from millrace.sources.files import save

ADMIN = "RL_PRIVACY_ADMIN"


def mask(c, policy: str, role: str, allowed=(ADMIN,), constant: str = "***") -> Column:
    """A column as ``role`` sees it.  Only allowed roles see values, no other role is special."""
    c = F.col(c) if isinstance(c, str) else c
    if role in allowed:
        return c
    if policy == "null":
        return F.when(F.lit(False), c)
    if policy == "last4":
        return F.concat(F.lit("***-**-"), F.substring(c, 8, 4))
    if policy == "constant":
        return F.lit(constant)
    raise ValueError(f"unknown policy {policy}")


def employee_view(df: DataFrame, role: str, user: str, reports: DataFrame | None = None) -> DataFrame:
    """Salaries for oneself, one's reports, staff outside HR, or everybody, by role.

    Managers see the employees below them, direct and indirect: those of
    ``reports``, a closure of ``reports_closure``, or else found from the manager
    downwards.
    """
    salary, out = F.col("salary"), df
    if role == "RL_EMPLOYEE":
        seen = F.upper("employee_id") == user.upper()
    elif role == "RL_MANAGER":
        below = reports_below(df, user) if reports is None else reports.where(F.upper("manager") == user.upper()).select("employee").distinct()
        below = below.select(F.col("employee").alias("__e"), F.lit(True).alias("__below"))
        out = df.join(below, F.col("employee_id") == F.col("__e"), "left")
        seen = F.coalesce("__below", F.lit(False))
    elif role == "RL_HR_REP":
        seen = F.col("department") != "HR"
    else:
        seen = F.lit(role == ADMIN)
    return out.select("employee_id", "reports_to", "department", F.when(seen, salary).alias("salary"), mask("ssn", "last4", role).alias("ssn"))


def visible_rows(df: DataFrame, role: str, user: str, reports: DataFrame | None = None) -> DataFrame:
    """Rows whose salary the caller may see; the masking view doubles as the row filter."""
    return employee_view(df, role, user, reports).where("salary is not null").select("employee_id", "reports_to", "department", "salary")


def reports_below(df: DataFrame, user: str, employee: str = "employee_id", manager: str = "reports_to") -> DataFrame:
    """The employees below one manager, direct and indirect, each once.

    The walk goes down level by level; each level is written and names seen
    before are dropped, so it costs what lies below and ends on loops.
    """
    spark = df.sparkSession
    root = f"{work_dir(spark)}/below-{uuid.uuid4().hex}"
    edges = df.select(F.col(employee).alias("employee"), F.col(manager).alias("above")).where("employee is not null and above is not null")
    level, seen = 0, None
    found = edges.where(F.upper("above") == user.upper()).select("employee").distinct()
    while True:
        found.write.parquet(f"{root}/level={level}")
        newest = spark.read.schema(found.schema).parquet(f"{root}/level={level}")
        if seen is not None and newest.isEmpty():
            return seen
        seen = spark.read.schema(found.schema).parquet(*[f"{root}/level={i}" for i in range(level + 1)])
        found = edges.join(newest.select(F.col("employee").alias("above")), "above", "left_semi").select("employee").distinct().join(seen, "employee", "left_anti")
        level += 1


def reports_closure(df: DataFrame, employee: str = "employee_id", manager: str = "reports_to") -> DataFrame:
    """Every (employee, manager) pair, direct and indirect.

    Steps double: what is known of paths shorter than a length is joined with the
    pairs exactly that far apart, and those with themselves, so a hierarchy of depth d takes about
    log2(d) rounds.  Each round writes the pairs it adds, once, to the shared work folder.  Pairs known before are dropped,
    so loops (an employee who reports to themselves) end: a round that adds nothing is the last.
    """
    spark = df.sparkSession
    root = f"{work_dir(spark)}/closure-{uuid.uuid4().hex}"
    edges = df.select(F.col(employee).alias("employee"), F.col(manager).alias("manager")).where("employee is not null and manager is not null").distinct()
    known, hop, number = [], save(edges, f"{root}/hop-0"), 0  # pairs 2**number apart
    while True:
        far = hop.select(F.col("employee").alias("via"), F.col("manager").alias("above"))
        added = hop
        if known:
            seen = spark.read.schema(edges.schema).parquet(*known)
            longer = seen.join(far, F.col("manager") == F.col("via")).select("employee", F.col("above").alias("manager"))
            added = hop.unionByName(longer).distinct().join(seen, ["employee", "manager"], "left_anti")
        if save(added, f"{root}/added-{number}").isEmpty():
            return spark.read.schema(edges.schema).parquet(*known) if known else hop
        known.append(f"{root}/added-{number}")
        number += 1
        hop = save(hop.join(far, F.col("manager") == F.col("via")).select("employee", F.col("above").alias("manager")).distinct(), f"{root}/hop-{number}")


def department_rollup(df: DataFrame, role: str, allowed=("RL_FINANCE", ADMIN)) -> DataFrame:
    """Head count and salaries per department; nothing for other roles."""
    rows = df if role in allowed else df.where(F.lit(False))
    return rows.groupBy("department").agg(F.count(F.lit(1)).alias("employees"), F.sum("salary").alias("total_salary"))


def tenant_view(df: DataFrame, mapping: DataFrame, key: str, account: str, owner: str = "account", mapping_key: str | None = None) -> DataFrame:
    """Rows whose key is mapped to the account, once per row."""
    from millrace.operators.relational import entitled
    return entitled(df, mapping, key, mapping_key or key, owner, account)


def decrypt_view(df: DataFrame, column: str, key: str, role: str, allowed=("PII_ALLOWED", "PII_ADMIN"), name: str = "decrypted") -> DataFrame:
    """The decrypted column for entitled roles, NULL otherwise.  Take the key from configuration."""
    from millrace.functions.semantics import decrypt_text
    value = decrypt_text(column, key) if role in allowed else F.lit(None).cast("string")
    return df.withColumn(name, value)
