"""Forests and metrics on the given tables."""

from pyspark.sql import functions as F

from tallyhouse.operators import clean, ledger, model, split
from tallyhouse.plans.lookups import join_lookup, stored_lookup
from tallyhouse.plans.shared import checkpointed, new_folder, shuffles_freed, written
from tallyhouse.workload.registry import query
from tallyhouse.workload.splitting import stratified_sql
from tallyhouse.workload.tables import LISTING_SQL, SEED, TEST_SIZE, VAL_SIZE, listings, table

# The default forest: 100 trees of depth 15.
FOREST = {}
GRID = {
    "deep": {},
    "shallow": {"maxDepth": 5},
    "few-trees": {"numTrees": 20},
}
# One tree without draws, which SQL can grow too.
PLAIN_TREE = {
    "numTrees": 1, "maxDepth": 3, "minInstancesPerNode": 20, "featureSubsetStrategy": "all",
    "bootstrap": False, "exactThresholds": True,
}


def priced_splits(spark, folder):
    """Priced listings by side, test and validation strata by room type."""
    with shuffles_freed(spark):
        priced = written(
            clean.price_range(listings(spark, folder), "price", 1_000, 900_000), "priced"
        )
        fitted = split.fit_split(priced, "id", TEST_SIZE, SEED, "room_type", val_size=VAL_SIZE)
    tagged = fitted.apply(priced, "_side")
    return [
        tagged.where(F.col("_side") == side).drop("_side")
        for side in (split.TRAIN, split.VALIDATION, split.TEST)
    ]


@query("rf_predict")
def rf_predict(spark, folder):
    train, _, test = priced_splits(spark, folder)
    fitted = model.fit_forest(train, SEED, FOREST)
    return fitted.predict(test, ["id", "price"])


@query("feature_importance")
def feature_importance(spark, folder):
    train, _, _ = priced_splits(spark, folder)
    fitted = model.fit_forest(train, SEED, FOREST)
    return spark.createDataFrame(
        model.feature_importance(fitted), "feature string, importance double"
    )


@query("rf_grid")
def rf_grid(spark, folder):
    train, validation, _ = priced_splits(spark, folder)
    _, scores = model.fit_grid(train, validation, SEED, GRID)
    return ledger.rank_candidates(model.require_finite(checkpointed(scores)))


PRICED_SQL = "SELECT id, room_type, price FROM listing WHERE price BETWEEN 1000 AND 900000"


@query(
    "rf_facts",
    f"""
    WITH {LISTING_SQL},
    test AS (SELECT id FROM ({stratified_sql(PRICED_SQL, "id", "room_type", TEST_SIZE)}) WHERE taken)
    SELECT count(*) AS n_test, count(*) AS n_within_labels, TRUE AS beats_the_mean,
           11::BIGINT AS n_importances, 1.0::DOUBLE AS importance_sum
    FROM test
    """,
)
def rf_facts(spark, folder):
    """What holds for any sound forest: a prediction for each test row, within the labels it
    learned from, better than their mean, and importances of all features that add up to 1."""
    train, _, test = priced_splits(spark, folder)
    fitted = model.fit_forest(train, SEED, FOREST)
    importances = model.feature_importance(fitted)
    low, high, mean = train.agg(F.min("price"), F.max("price"), F.avg("price")).first()
    off = F.col("price") - F.col("prediction")
    return fitted.predict(test, ["id", "price"]).agg(
        F.count("prediction").alias("n_test"),
        F.count_if(F.col("prediction").between(low, high)).alias("n_within_labels"),
        (F.sum(off * off) < F.sum((F.col("price") - mean) ** 2)).alias("beats_the_mean"),
        F.lit(len(importances)).cast("bigint").alias("n_importances"),
        F.round(F.lit(sum(w for _, w in importances)), 6).alias("importance_sum"),
    )


@query(
    "rf_stump",
    """
    WITH o AS (SELECT o_orderkey AS id, o_totalprice AS y, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS f0,
                      (o_orderstatus = 'F')::INTEGER AS f1, (o_orderstatus = 'O')::INTEGER AS f2,
                      (o_orderstatus = 'P')::INTEGER AS f3, month(o_orderdate) AS f4, dayofweek(o_orderdate) AS f5
               FROM orders),
    long AS (UNPIVOT o ON f0, f1, f2, f3, f4, f5 INTO NAME feature VALUE x),
    sums AS (SELECT feature, x, count(*) AS n, sum(y) AS s FROM long GROUP BY 1, 2),
    cuts AS (SELECT feature, x, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
                    sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s
             FROM sums WINDOW w AS (PARTITION BY feature ORDER BY x)),
    best AS (SELECT * FROM cuts WHERE nl < n
             ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)
    SELECT id, round(CASE WHEN long.x <= best.x THEN sl / nl ELSE (s - sl) / (n - nl) END, 4) AS prediction
    FROM long JOIN best USING (feature)
    """,
)
def rf_stump(spark, folder):
    """One tree of one split, over columns of few values."""
    orders = orders_as_listings(spark, folder, continuous=False)
    fitted = model.fit_forest(orders, SEED, {**PLAIN_TREE, "maxDepth": 1, "minInstancesPerNode": 1})
    return fitted.predict(orders, ["id"]).withColumn("prediction", F.round("prediction", 4))


def orders_as_listings(spark, folder, continuous=True):
    """Orders stand in as listings: the priority is the ordinal column, the status the category.

    ``continuous`` adds two columns of many values, the customer and the date.
    """
    day, nothing = F.col("o_orderdate"), F.lit(0)
    many = {
        "longitude": F.col("o_custkey").cast("double"),
        "last_review": day.cast("date"),
    }
    if not continuous:
        many = {"longitude": nothing, "last_review": F.lit(None).cast("date")}
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("room_type"),
        F.col("o_orderstatus").alias("neighbourhood_group"),
        F.month(day).alias("minimum_nights"),
        F.dayofweek(day).alias("number_of_reviews"),
        *[nothing.alias(c) for c in ("reviews_per_month", "calculated_host_listings_count")],
        *[nothing.alias(c) for c in ("availability_365", "latitude")],
        *[value.alias(c) for c, value in many.items()],
        F.lit("plain").alias("name"),
    )


# Slots of the feature vector that vary, in order, with the source column of each.
SLOTS = {
    0: ("room_type", "dense_rank() OVER (ORDER BY o_orderpriority) - 1"),
    1: ("neighbourhood_group", "(o_orderstatus = 'F')::INTEGER"),
    2: ("neighbourhood_group", "(o_orderstatus = 'O')::INTEGER"),
    3: ("neighbourhood_group", "(o_orderstatus = 'P')::INTEGER"),
    4: ("minimum_nights", "month(o_orderdate)"),
    5: ("number_of_reviews", "dayofweek(o_orderdate) + 1"),
    9: ("longitude", "o_custkey"),
    11: ("last_review", "max(o_orderdate::DATE) OVER () - o_orderdate::DATE"),
}


def slots_sql(name: str, source: str) -> str:
    """``name``: (id, y in hundredths, f, src, x) for every varying slot of some orders."""
    each = " UNION ALL ".join(
        f"SELECT id, y, {f} AS f, '{column}' AS src, x{f}::DOUBLE AS x FROM {name}_wide"
        for f, (column, _) in SLOTS.items()
    )
    columns = ", ".join(f"{value} AS x{f}" for f, (_, value) in SLOTS.items())
    return f"""
    {name}_wide AS MATERIALIZED (
      SELECT o_orderkey AS id, round(o_totalprice * 100)::BIGINT AS y, {columns} FROM ({source})),
    {name} AS MATERIALIZED ({each})"""


def tree_sql(rows: str, depth: int = 3, least: int = 20) -> str:
    """``nodes``: the tree that tries every cut of every column, written out level by level."""
    parts = [f"at0 AS (SELECT DISTINCT id, y, 1::BIGINT AS node FROM {rows})"]
    for level in range(depth):
        parts.append(f"""
    cuts{level} AS (
      SELECT node, f, x, lead(x) OVER up AS after, sum(n) OVER up AS nl, sum(s) OVER up AS sl,
             sum(n) OVER (PARTITION BY node, f) AS n, sum(s) OVER (PARTITION BY node, f) AS s
      FROM (SELECT node, f, x, count(*) AS n, sum(r.y) AS s FROM at{level} JOIN {rows} r USING (id) GROUP BY ALL)
      WINDOW up AS (PARTITION BY node, f ORDER BY x)),
    best{level} AS MATERIALIZED (
      SELECT node, f, x + (after - x) / 2 AS threshold
      FROM (SELECT *, (sl * n - s * nl)::DOUBLE ** 2 / ((nl * (n - nl))::DOUBLE * n) AS gain FROM cuts{level})
      WHERE after IS NOT NULL AND nl >= {least} AND n - nl >= {least} AND gain > 0
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, x) = 1),
    at{level + 1} AS MATERIALIZED (
      SELECT a.id, a.y, a.node * 2 + (r.x > b.threshold)::INTEGER AS node
      FROM at{level} a JOIN best{level} b USING (node) JOIN {rows} r ON r.id = a.id AND r.f = b.f)""")
    every = " UNION ALL ".join(f"SELECT * FROM at{level}" for level in range(depth + 1))
    chosen = " UNION ALL ".join(f"SELECT * FROM best{level}" for level in range(depth))
    parts.append(f"""
    nodes AS MATERIALIZED (
      SELECT node, f, threshold, count(*) AS n, sum(y)::DOUBLE / count(*) / 100 AS value
      FROM ({every}) LEFT JOIN ({chosen}) USING (node) GROUP BY ALL)""")
    return ",".join(parts)


def follow_sql(rows: str, name: str, depth: int = 3, keys: str = "id", value: str = "r.x") -> str:
    """``name``: every node on the way of each row of ``rows``, as (keys, node)."""
    parts = [f"{name}0 AS (SELECT DISTINCT {keys}, 1::BIGINT AS node FROM {rows})"]
    for level in range(depth):
        parts.append(f"""
    {name}{level + 1} AS MATERIALIZED (
      SELECT {", ".join(f"a.{k.strip()}" for k in keys.split(","))}, a.node * 2 + ({value} > n.threshold)::INTEGER AS node
      FROM {name}{level} a JOIN nodes n USING (node) JOIN {rows} r
        ON {" AND ".join(f"r.{k.strip()} = a.{k.strip()}" for k in keys.split(","))} AND r.f = n.f)""")
    every = " UNION ALL ".join(f"SELECT * FROM {name}{level}" for level in range(depth + 1))
    return ",".join(parts) + f", {name} AS MATERIALIZED ({every})"


@query(
    "rf_reload",
    f"""
    WITH {slots_sql("r", "SELECT * FROM orders")}, {tree_sql("r")}, {follow_sql("r", "way")}
    SELECT id, round(arg_max(value, node), 4) AS prediction FROM way JOIN nodes USING (node) GROUP BY id
    """,
)
def rf_reload(spark, folder):
    """A tree is grown, saved, loaded, and followed by joins alone."""
    orders = orders_as_listings(spark, folder)
    path = new_folder(spark, "saved-model")
    model.fit_forest(orders, SEED, PLAIN_TREE).save(path)
    loaded = model.load_model(path)
    scored = loaded.predict(orders, ["id"], by_joins=True)
    return scored.withColumn("prediction", F.round("prediction", 4))


@query(
    "rf_exact",
    f"""
    WITH {slots_sql("r", "SELECT * FROM orders")}, {tree_sql("r", depth=2)}
    SELECT node, f::INTEGER AS feature, round(threshold, 6) AS threshold, n AS n_rows, round(value, 4) AS value FROM nodes
    """,
)
def rf_exact(spark, folder):
    """The nodes of a tree of depth two, with exact thresholds of two columns of many values."""
    fitted = model.fit_forest(orders_as_listings(spark, folder), SEED, {**PLAIN_TREE, "maxDepth": 2})
    return fitted.forest.nodes.select(
        "node",
        "feature",
        F.round("threshold", 6).alias("threshold"),
        F.col("rows").alias("n_rows"),
        F.round("value", 4).alias("value"),
    )


SOURCE_SQL = " UNION ALL ".join(
    f"SELECT {f} AS f, '{column}' AS feature" for f, (column, _) in SLOTS.items()
)
FEATURE_LIST = ", ".join(f"('{c}')" for c in model.FeatureSpec().columns)


@query(
    "split_importance",
    f"""
    WITH {slots_sql("r", "SELECT * FROM orders")}, {tree_sql("r")},
    gains AS (
      SELECT p.f, a.n * b.n / (a.n + b.n)::DOUBLE * (a.value - b.value) ** 2 AS gain
      FROM nodes p JOIN nodes a ON a.node = p.node * 2 JOIN nodes b ON b.node = p.node * 2 + 1),
    shares AS (SELECT feature, sum(gain) / (SELECT sum(gain) FROM gains) AS importance
               FROM gains JOIN ({SOURCE_SQL}) USING (f) GROUP BY feature)
    SELECT feature, round(coalesce(importance, 0), 6) AS importance
    FROM (VALUES {FEATURE_LIST}) AS every(feature) LEFT JOIN shares USING (feature)
    """,
)
def split_importance(spark, folder):
    """Importances of a tree of depth three, from the gains of its splits."""
    fitted = model.fit_forest(orders_as_listings(spark, folder), SEED, PLAIN_TREE)
    found = spark.createDataFrame(
        model.feature_importance(fitted), "feature string, importance double"
    )
    return found.withColumn("importance", F.round("importance", 6))


@query(
    "permutation_importance",
    f"""
    WITH {slots_sql("r", "SELECT * FROM orders")}, {tree_sql("r")},
    here AS (SELECT id, row_number() OVER (ORDER BY md5('{SEED}|' || id::VARCHAR)) AS place FROM r_wide),
    there AS (SELECT id AS other, row_number() OVER (ORDER BY md5('{SEED + 1}|' || id::VARCHAR)) AS place FROM r_wide),
    every AS (SELECT '' AS feature UNION ALL VALUES {FEATURE_LIST}),
    mixed AS MATERIALIZED (
      SELECT feature, a.id, a.y, a.f, CASE WHEN a.src = feature THEN b.x ELSE a.x END AS x
      FROM here JOIN there USING (place) JOIN r a USING (id) JOIN r b ON b.id = other AND b.f = a.f, every),
    {follow_sql("mixed", "way", keys="feature, id")},
    scored AS (SELECT feature, id, arg_max(value, node) AS prediction FROM way JOIN nodes USING (node) GROUP BY ALL),
    errors AS (SELECT feature, avg((y / 100 - prediction) ** 2) AS mse FROM scored JOIN r_wide USING (id) GROUP BY feature),
    base AS (SELECT mse AS least FROM errors WHERE feature = '')
    SELECT feature, round((mse - least) / least, 6) AS increase FROM errors, base WHERE feature <> ''
    """,
)
def permutation_importance(spark, folder):
    """By how much, in parts of the error, a tree gets worse once one column is shuffled."""
    orders = orders_as_listings(spark, folder)
    fitted = model.fit_forest(orders, SEED, PLAIN_TREE)
    found = model.permutation_importance(fitted, orders, SEED)
    share = F.col("increase") / (F.col("mse") - F.col("increase"))
    return found.select("feature", F.round(share, 6).alias("increase"))


EXACT_GRID = {f"depth-{d}": {**PLAIN_TREE, "maxDepth": d} for d in (1, 2, 3)}
SIDES_SQL = f"""
    sides AS (SELECT o_orderkey, taken FROM ({stratified_sql("SELECT * FROM orders", "o_orderkey", "o_orderpriority", TEST_SIZE)}))
"""


@query(
    "rf_grid_exact",
    f"""
    WITH {SIDES_SQL},
    {slots_sql("r", "SELECT * FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM sides WHERE NOT taken)")},
    {tree_sql("r")},
    {slots_sql("h", "SELECT * FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM sides WHERE taken)")},
    {follow_sql("h", "way")},
    depths AS (SELECT unnest([1, 2, 3]) AS depth),
    scored AS (SELECT depth, id, arg_max(value, node) AS p
               FROM way JOIN nodes USING (node), depths WHERE node < 1 << (depth + 1) GROUP BY ALL),
    m AS (SELECT avg(y / 100) AS mean FROM h_wide)
    SELECT 'depth-' || depth AS run_id, round(avg(abs(y / 100 - p)), 4) AS mae,
           round(1 - sum((y / 100 - p) ** 2) / sum((y / 100 - mean) ** 2), 6) AS r2
    FROM scored JOIN h_wide USING (id), m GROUP BY depth
    """,
)
def rf_grid_exact(spark, folder):
    """Three exact trees grown together and scored on the same held-out orders."""
    orders = written(orders_as_listings(spark, folder), "grid-orders")
    train, validation = split.split_two(orders, "id", TEST_SIZE, SEED, "room_type")
    _, scores = model.fit_grid(train, validation, SEED, EXACT_GRID)
    scores = model.require_finite(checkpointed(scores))
    return scores.select("run_id", F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


def predicted_lines(spark, folder):
    """Line prices with quantity times retail price as a stand-in prediction."""
    part = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice"
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return join_lookup(
        lines, stored_lookup(part), ["l_partkey"], "inner", spread_by=["l_orderkey"]
    ).withColumn("predicted", F.col("l_quantity") * F.col("p_retailprice"))


METRICS_SQL = """
  round(avg(abs(l_extendedprice - l_quantity * p_retailprice)), 4) AS mae,
  round(1 - sum((l_extendedprice - l_quantity * p_retailprice) ** 2)
        / nullif(sum((l_extendedprice - m) ** 2), 0), 6) AS r2
"""


@query(
    "regression_metrics",
    f"""
    SELECT p_brand, {METRICS_SQL}
    FROM (SELECT *, avg(l_extendedprice) OVER (PARTITION BY p_brand) AS m
          FROM lineitem JOIN part ON l_partkey = p_partkey)
    GROUP BY p_brand
    """,
)
def regression_metrics(spark, folder):
    scores = model.regression_metrics(
        predicted_lines(spark, folder), "l_extendedprice", "predicted", ["p_brand"]
    )
    return scores.select("p_brand", F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


@query(
    "metrics_finite",
    """
    WITH m AS (SELECT l_orderkey, avg(abs(l_extendedprice - l_quantity * p_retailprice)) AS mae,
                      count(*) AS n, count(DISTINCT l_extendedprice) AS values
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
    SELECT l_orderkey, round(mae, 4) AS mae FROM m WHERE values = 1
    """,
)
def metrics_finite(spark, folder):
    """Orders whose metrics are not finite: a single price has no spread, hence no R2."""
    scores = model.regression_metrics(
        predicted_lines(spark, folder), "l_extendedprice", "predicted", ["l_orderkey"]
    )
    return model.bad_metrics(scores).select("l_orderkey", F.round("mae", 4).alias("mae"))
