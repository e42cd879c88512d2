"""Splits on the given tables. The SQL ranks whole strata; the operators do not."""

from pyspark.sql import functions as F

from tallyhouse.operators import clean, ledger, split
from tallyhouse.operators.digests import table_fingerprint
from tallyhouse.workload.registry import query
from tallyhouse.workload.tables import SEED, TEST_SIZE, VAL_SIZE, table

HASH = "md5('42|' || {key}::VARCHAR)"


def stratified_sql(source: str, key: str, stratum: str, fraction: float) -> str:
    """Rows of ``source`` with ``taken``: the plain form, one sort per stratum."""
    return f"""
      SELECT s.*, row_number() OVER (
               PARTITION BY s.{stratum} ORDER BY {HASH.format(key='s.' + key)}, s.{key}) <= quota AS taken
      FROM ({source}) AS s JOIN (
        SELECT {stratum}, base + (row_number() OVER (
                 ORDER BY rest DESC, {HASH.format(key=stratum)}) <= k - sum(base) OVER ())::INTEGER AS quota
        FROM (
          SELECT {stratum}, k, (k * n) // total AS base, (k * n) % total AS rest
          FROM (SELECT {stratum}, count(*)::BIGINT AS n FROM ({source}) GROUP BY 1),
               (SELECT count(*)::BIGINT AS total, ceil({fraction}::DOUBLE * count(*))::BIGINT AS k
                FROM ({source}))
        )
      ) AS q USING ({stratum})
    """


ORDERS_SQL = "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders"


def keyed_orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")


def flagship(spark, folder):
    """Price filter, stratified split, rows by side and stratum."""
    kept = clean.price_range(keyed_orders(spark, folder), "o_totalprice", 50_000, 350_000)
    fitted = split.fit_split(kept, "o_orderkey", TEST_SIZE, SEED, "o_orderpriority")
    return (
        fitted.apply(kept)
        .groupBy("split", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"))
    )


query(
    "split_sizes",
    f"""
    SELECT CASE WHEN taken THEN 'test' ELSE 'trainval' END AS split, o_orderpriority, count(*) AS n
    FROM ({stratified_sql(ORDERS_SQL + " WHERE o_totalprice BETWEEN 50000 AND 350000",
                          "o_orderkey", "o_orderpriority", TEST_SIZE)})
    GROUP BY 1, 2
    """,
)(flagship)


@query(
    "split_random",
    f"""
    SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {HASH.format(key="o_orderkey")}, o_orderkey)
             <= ceil(0.2::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'trainval' END AS split
    FROM orders
    """,
)
def split_random(spark, folder):
    orders = keyed_orders(spark, folder).select("o_orderkey")
    return split.fit_split(orders, "o_orderkey", TEST_SIZE, SEED).apply(orders)


@query(
    "split_stratified",
    f"""
    SELECT o_orderkey, o_orderpriority, CASE WHEN taken THEN 'test' ELSE 'trainval' END AS split
    FROM ({stratified_sql(ORDERS_SQL, "o_orderkey", "o_orderpriority", TEST_SIZE)})
    """,
)
def split_stratified(spark, folder):
    orders = keyed_orders(spark, folder).drop("o_totalprice")
    return split.fit_split(orders, "o_orderkey", TEST_SIZE, SEED, "o_orderpriority").apply(orders)


FIRST_SQL = stratified_sql(ORDERS_SQL, "o_orderkey", "o_orderpriority", TEST_SIZE)
REST_SQL = f"SELECT o_orderkey, o_orderpriority FROM ({FIRST_SQL}) WHERE NOT taken"


@query(
    "split_three_way",
    f"""
    SELECT o_orderkey, o_orderpriority, 'test' AS split FROM ({FIRST_SQL}) WHERE taken
    UNION ALL
    SELECT o_orderkey, o_orderpriority, CASE WHEN taken THEN 'validation' ELSE 'train' END
    FROM ({stratified_sql(REST_SQL, "o_orderkey", "o_orderpriority", VAL_SIZE)})
    """,
)
def split_three_way(spark, folder):
    orders = keyed_orders(spark, folder).drop("o_totalprice")
    fitted = split.fit_split(
        orders, "o_orderkey", TEST_SIZE, SEED, "o_orderpriority", val_size=VAL_SIZE
    )
    return fitted.apply(orders)


@query(
    "split_repeat",
    f"""
    WITH taken AS ({FIRST_SQL}),
    sides AS (
      SELECT o_orderkey, 'test' AS split FROM taken WHERE taken
      UNION ALL SELECT o_orderkey, CASE WHEN taken THEN 'validation' ELSE 'train' END
                FROM ({stratified_sql(REST_SQL, "o_orderkey", "o_orderpriority", VAL_SIZE)}))
    SELECT split, count(*) AS n_first, count(*) AS n_again, count(*) AS n_same, sum(o_orderkey)::BIGINT AS key_sum
    FROM sides GROUP BY split
    """,
)
def split_repeat(spark, folder):
    """The same split fitted anew on rows in another order and in other partitions."""
    orders = keyed_orders(spark, folder).drop("o_totalprice")
    sides = []
    for i, rows in enumerate((orders, orders.repartition(13, F.md5(F.col("o_orderkey").cast("string"))))):
        fitted = split.fit_split(rows, "o_orderkey", TEST_SIZE, SEED, "o_orderpriority", val_size=VAL_SIZE)
        sides.append(fitted.apply(rows).select("o_orderkey", F.col("split").alias(f"_{i}")))
    both = sides[0].join(sides[1], "o_orderkey", "full")
    counted = F.explode(F.array(*[F.struct(F.col(f"_{i}").alias("split"), F.lit(i).alias("fit")) for i in (0, 1)]))
    same = F.col("_0").eqNullSafe(F.col("_1"))
    return (
        both.select("o_orderkey", same.alias("same"), counted.alias("side"))
        .groupBy(F.col("side.split").alias("split"))
        .agg(
            F.count_if(F.col("side.fit") == 0).alias("n_first"),
            F.count_if(F.col("side.fit") == 1).alias("n_again"),
            F.count_if((F.col("side.fit") == 0) & F.col("same")).alias("n_same"),
            F.sum(F.when(F.col("side.fit") == 0, F.col("o_orderkey"))).alias("key_sum"),
        )
    )


def fingerprint_sql(columns: list[str], source: str, by: str = "") -> str:
    """Row count and fingerprint of a source, for columns already of text type."""
    parts = " || ".join(
        f"coalesce(length({c})::VARCHAR || ':' || {c}, 'N')" for c in columns
    )
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""
      SELECT {lead}count(*) AS n_rows, sha256(count(*)::VARCHAR || '|' ||
             coalesce(sum(v & 1048575), 0)::VARCHAR || '|' ||
             coalesce(sum((v >> 20) & 1048575), 0)::VARCHAR || '|' ||
             coalesce(sum(v >> 40), 0)::VARCHAR) AS fingerprint
      FROM (SELECT {lead}concat('0x', substr(md5({parts}), 1, 15))::BIGINT AS v FROM ({source})) {group}
    """


@query(
    "split_identity",
    f"""
    SELECT n_rows, sha256('{{"parameters":{{"random_seed":42,"stratify_by":"o_orderpriority","test_size":0.2}},'
           || '"source_sha256":"' || fingerprint || '"}}') AS split_id
    FROM ({fingerprint_sql(
        ["o_orderkey", "o_orderpriority", "o_totalprice"],
        "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderpriority, "
        "o_totalprice::DECIMAL(18,2)::VARCHAR AS o_totalprice FROM orders")})
    """,
)
def split_identity(spark, folder):
    orders = keyed_orders(spark, folder).withColumn(
        "o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")
    )
    return table_fingerprint(orders).select(
        "n_rows",
        split.split_identity(F.col("fingerprint"), TEST_SIZE, SEED, "o_orderpriority").alias(
            "split_id"
        ),
    )


def _sides(spark, folder):
    orders = keyed_orders(spark, folder)
    return orders, *split.split_two(orders, "o_orderkey", TEST_SIZE, SEED, "o_orderpriority")


@query(
    "split_disjoint",
    f"""
    WITH s AS ({FIRST_SQL})
    SELECT (SELECT count(*) FROM s WHERE NOT taken) AS n_trainval,
           (SELECT count(*) FROM s WHERE taken) AS n_test,
           (SELECT count(*) FROM (SELECT o_orderkey FROM s WHERE taken
                                  INTERSECT SELECT o_orderkey FROM s WHERE NOT taken)) AS n_common
    """,
)
def split_disjoint(spark, folder):
    _, trainval, test = _sides(spark, folder)
    common = ledger.common_rows(trainval.select("o_orderkey"), test.select("o_orderkey"))
    return trainval.agg(F.count(F.lit(1)).alias("n_trainval")).select(
        "n_trainval",
        test.agg(F.count(F.lit(1))).scalar().alias("n_test"),
        common.agg(F.count(F.lit(1))).scalar().alias("n_common"),
    )


@query(
    "split_cover",
    f"""
    WITH s AS ({FIRST_SQL}), u AS (SELECT o_orderkey, o_orderpriority, o_totalprice FROM s)
    SELECT (SELECT count(*) FROM orders) AS n_source, (SELECT count(*) FROM u) AS n_union,
           (SELECT count(*) FROM ({ORDERS_SQL} EXCEPT ALL SELECT * FROM u))
           + (SELECT count(*) FROM (SELECT * FROM u EXCEPT ALL {ORDERS_SQL})) AS n_differing
    """,
)
def split_cover(spark, folder):
    orders, trainval, test = _sides(spark, folder)
    both = trainval.unionByName(test).select(*orders.columns)
    differing = ledger.multiset_difference(both, orders)
    return orders.agg(F.count(F.lit(1)).alias("n_source")).select(
        "n_source",
        both.agg(F.count(F.lit(1))).scalar().alias("n_union"),
        differing.agg(F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).cast("bigint"))
        .scalar()
        .alias("n_differing"),
    )
