"""All registered queries and their SQL twins."""

from tallyhouse.workload import cleaning, featuring, modelling, recording, splitting, storing  # noqa: F401
from tallyhouse.workload.registry import QUERIES, SQL, Query
from tallyhouse.workload.splitting import flagship

__all__ = ["flagship", "oracle_sql", "queries"]


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
