"""All registered corpus queries and their SQL twins."""

from tallyhouse.llm import (  # noqa: F401
    decontamination,
    divergence,
    fingerprints,
    language_id,
    license_scan,
    mixing,
    secret_scan,
    simhash_dedup,
    substring_dedup,
    toxicity,
    url_filter,
    vector_codes,
    warc,
)
from tallyhouse.llm.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
