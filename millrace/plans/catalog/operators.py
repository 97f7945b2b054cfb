"""All registered operator queries."""

from millrace.plans.catalog import pipelines, relational

OPERATORS = {**relational.QUERIES, **pipelines.QUERIES}
