"""Run a query and its SQL twin on the same folder and compare rows and types."""

import math
import time

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Type names that mean the same on both sides.
SAME_TYPE = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"}, "date": {"DATE"},
}


# Joins that pair every row with every row.
PAIRING_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, folder, query, sql):
    """Returns (problems, spark rows, seconds)."""
    start = time.time()
    df = query(spark, folder)
    types = dict(df.dtypes)
    plan = df._jdf.queryExecution().executedPlan().toString()
    mine = _rows(df.columns, df.collect())
    seconds = time.time() - start
    relation = connection.sql(sql)
    theirs_types = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    theirs = _rows(relation.columns, relation.fetchall())
    problems = [f"plan has {node}" for node in PAIRING_NODES if node in plan]
    if sorted(types) != sorted(theirs_types):
        problems.append(f"columns {sorted(types)} / {sorted(theirs_types)}")
    else:
        for name, kind in types.items():
            if theirs_types[name] not in SAME_TYPE.get(kind, set()):
                problems.append(f"type of {name}: {kind} / {theirs_types[name]}")
    if mine != theirs:
        a, b = set(mine) - set(theirs), set(theirs) - set(mine)
        problems.append(
            f"rows {len(mine)} / {len(theirs)}; only here {sorted(a)[:3]}; only there {sorted(b)[:3]}"
        )
    return problems, len(mine), seconds
