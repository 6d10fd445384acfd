"""Every operator as a query over the given tables, next to the SQL it must agree with."""

from docgroups.registry import features, groups, jobs, scoring, sources, sparse, vectors

ALL = {}
for part in (sources, features, vectors, sparse, scoring, groups, jobs):
    ALL.update(part.QUERIES)
