"""Feature steps on the given tables."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyhouse.functions.text import stop_tokens, tokens, without_stop_words
from tallyhouse.operators import clean, features, model
from tallyhouse.plans.shared import written
from tallyhouse.schemas import ZERO_FILLED
from tallyhouse.workload.cleaning import gapped_customers
from tallyhouse.workload.registry import query
from tallyhouse.workload.tables import LISTING_SQL, SEGMENTS, listings, table

TOKENS_SQL = r"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}')"
STOP_SQL = ", ".join(f"'{word}'" for word in stop_tokens())
TERMS = 20


@query(
    "encode_ordinal",
    """
    SELECT o_orderkey, o_orderstatus, (SELECT count(DISTINCT o_orderstatus) FROM orders AS x
             WHERE x.o_orderstatus < orders.o_orderstatus) AS status_code
    FROM orders
    """,
)
def encode_ordinal(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    codes = features.category_codes(orders, "o_orderstatus")
    return features.encode_ordinal(
        orders, "o_orderstatus", codes, "status_code", spread_by=["o_orderkey"]
    ).select("o_orderkey", "o_orderstatus", "status_code")


@query(
    "impute_mode",
    """
    WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS s FROM customer)
    SELECT c_custkey, coalesce(s, (SELECT s FROM c WHERE s IS NOT NULL GROUP BY s
             ORDER BY count(*) DESC, s LIMIT 1)) AS c_mktsegment
    FROM c
    """,
)
def impute_mode(spark, folder):
    customer = gapped_customers(spark, folder).select("c_custkey", "c_mktsegment")
    return features.impute_mode(customer, "c_mktsegment")


@query(
    "encode_one_hot",
    """
    WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS s FROM customer),
    f AS (SELECT c_custkey, coalesce(s, (SELECT s FROM c WHERE s IS NOT NULL GROUP BY s
             ORDER BY count(*) DESC, s LIMIT 1)) AS s FROM c)
    SELECT c_custkey, (s = 'AUTOMOBILE')::INTEGER::DOUBLE AS is_AUTOMOBILE,
           (s = 'BUILDING')::INTEGER::DOUBLE AS is_BUILDING,
           (s = 'FURNITURE')::INTEGER::DOUBLE AS is_FURNITURE,
           (s = 'HOUSEHOLD')::INTEGER::DOUBLE AS is_HOUSEHOLD,
           (s = 'MACHINERY')::INTEGER::DOUBLE AS is_MACHINERY
    FROM f
    """,
)
def encode_one_hot(spark, folder):
    customer = gapped_customers(spark, folder).select("c_custkey", "c_mktsegment")
    filled = features.impute_mode(customer, "c_mktsegment")
    return features.encode_one_hot(filled, "c_mktsegment", SEGMENTS, "is_").drop("c_mktsegment")


@query(
    "impute_zero",
    f"""
    WITH {LISTING_SQL}
    SELECT id, coalesce(minimum_nights, 0) AS minimum_nights,
           coalesce(number_of_reviews, 0) AS number_of_reviews,
           coalesce(reviews_per_month, 0) AS reviews_per_month,
           coalesce(calculated_host_listings_count, 0) AS calculated_host_listings_count,
           coalesce(availability_365, 0) AS availability_365,
           coalesce(longitude, 0) AS longitude, coalesce(latitude, 0) AS latitude
    FROM listing
    """,
)
def impute_zero(spark, folder):
    return features.impute_zero(
        listings(spark, folder).select("id", *ZERO_FILLED), ZERO_FILLED
    )


@query(
    "days_since_latest",
    """
    WITH d AS (SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END,
                 DATE '2010-01-01') AS d FROM orders)
    SELECT o_orderkey, datediff('day', d, (SELECT max(d) FROM d))::BIGINT AS days FROM d
    """,
)
def days_since_latest(spark, folder):
    """Pending orders have no date, so the old date stands in, here the latest of all."""
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    orders = table(spark, folder, "orders").select("o_orderkey", day.alias("day"))
    return features.days_since_latest(orders, "day", "days").drop("day")


@query(
    "tokenize",
    f"""
    SELECT doc_id, len(t)::BIGINT AS n_tokens, md5(array_to_string(t, ' ')) AS digest
    FROM (SELECT doc_id, {TOKENS_SQL.format(text="text")} AS t FROM documents)
    """,
)
def tokenize(spark, folder):
    words = tokens(F.col("text"))
    documents = table(spark, folder, "documents").select("doc_id", words.alias("t"))
    return documents.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("t", " ")).alias("digest"),
    )


@query(
    "remove_stop_words",
    f"""
    SELECT doc_id, len(t)::BIGINT AS n_tokens, md5(array_to_string(t, ' ')) AS digest
    FROM (SELECT doc_id, list_filter({TOKENS_SQL.format(text="text")},
            lambda w: w NOT IN ({STOP_SQL})) AS t FROM documents)
    """,
)
def remove_stop_words(spark, folder):
    words = without_stop_words(tokens(F.col("text")))
    documents = table(spark, folder, "documents").select("doc_id", words.alias("t"))
    return documents.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("t", " ")).alias("digest"),
    )


WORDS_SQL = f"""
words AS (SELECT doc_id, unnest({TOKENS_SQL.format(text="text")}) AS term FROM documents),
kept AS (SELECT * FROM words WHERE term NOT IN ({STOP_SQL})),
vocabulary AS (SELECT term, count(*) AS corpus_count, count(DISTINCT doc_id) AS document_count
               FROM kept GROUP BY term ORDER BY corpus_count DESC, term LIMIT {TERMS})
"""


@query("vocabulary_topk", f"WITH {WORDS_SQL} SELECT * FROM vocabulary")
def vocabulary_topk(spark, folder):
    documents = table(spark, folder, "documents").select("text")
    return features.fit_vocabulary(documents, "text", TERMS).terms.table


@query(
    "tfidf",
    f"""
    WITH {WORDS_SQL},
    raw AS (SELECT doc_id, term, count(*) * (ln((1.0 + (SELECT count(*) FROM documents))
              / (1.0 + any_value(document_count))) + 1.0) AS w
            FROM kept JOIN vocabulary USING (term) GROUP BY doc_id, term)
    SELECT CASE WHEN doc_id % 10 < 9 THEN doc_id // 3 END AS key, term,
           round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight
    FROM raw
    """,
)
def tfidf(spark, folder):
    """Three documents share a key, and every tenth has none."""
    shared = F.when(F.col("doc_id") % 10 < 9, F.floor(F.col("doc_id") / 3))
    documents = table(spark, folder, "documents").select(shared.alias("key"), "text")
    vocabulary = features.fit_vocabulary(documents, "text", TERMS)
    weights = features.tfidf(documents, "key", "text", vocabulary)
    return weights.withColumn("weight", F.round("weight", 6))


SLOTS = 1 + 5 + 7 + 1 + 5


@query(
    "assemble_features",
    f"""
    WITH {LISTING_SQL},
    l AS (SELECT * FROM listing WHERE price BETWEEN 1000 AND 900000),
    mode AS (SELECT neighbourhood_group AS g FROM l WHERE neighbourhood_group IS NOT NULL
             GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    latest AS (SELECT max(coalesce(last_review, DATE '2010-01-01')) AS d FROM l),
    words AS (SELECT id, unnest({TOKENS_SQL.format(text="coalesce(name, '')")}) AS term FROM l),
    kept AS (SELECT * FROM words WHERE term NOT IN ({STOP_SQL})),
    vocabulary AS (SELECT term, count(DISTINCT id) AS n FROM kept GROUP BY term
                   ORDER BY count(*) DESC, term LIMIT 5),
    placed AS (SELECT term, row_number() OVER (ORDER BY term) AS place,
                      ln((1.0 + (SELECT count(*) FROM l)) / (1.0 + n)) + 1.0 AS idf FROM vocabulary),
    raw AS (SELECT id, place, count(*) * any_value(idf) AS w
            FROM kept JOIN placed USING (term) GROUP BY id, place),
    unit AS (SELECT id, place, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM raw),
    wide AS (SELECT id, {", ".join(
        f"max(CASE WHEN place = {i} THEN w END) AS t{i}" for i in range(1, 6))} FROM unit GROUP BY id),
    g AS (SELECT l.*, coalesce(neighbourhood_group, (SELECT g FROM mode)) AS grp FROM l)
    SELECT id, ['F', 'O', 'P'].list_position(room_type) - 1.0::DOUBLE AS f0,
           {", ".join(f"(grp = '{s}')::INTEGER::DOUBLE AS f{i}" for i, s in enumerate(SEGMENTS, 1))},
           coalesce(minimum_nights, 0)::DOUBLE AS f6, coalesce(number_of_reviews, 0)::DOUBLE AS f7,
           coalesce(reviews_per_month, 0)::DOUBLE AS f8,
           coalesce(calculated_host_listings_count, 0)::DOUBLE AS f9,
           coalesce(availability_365, 0)::DOUBLE AS f10, coalesce(longitude, 0)::DOUBLE AS f11,
           coalesce(latitude, 0)::DOUBLE AS f12,
           datediff('day', coalesce(last_review, DATE '2010-01-01'), (SELECT d FROM latest))::DOUBLE AS f13,
           {", ".join(f"round(coalesce(t{i}, 0), 6) AS f{i + 13}" for i in range(1, 6))}
    FROM g LEFT JOIN wide USING (id)
    """,
)
def assemble_features(spark, folder):
    """The whole preprocessing of priced listings, one column per vector slot."""
    priced = written(
        clean.price_range(listings(spark, folder), "price", 1_000, 900_000), "priced"
    )
    spec = model.FeatureSpec()
    fitted = model.preprocessor(spec).fit(priced)
    vectors = model.assemble(priced, fitted, ["id"])
    return vectors.select("id", vector_to_array("features").alias("f")).select(
        "id", *[F.round(F.get("f", F.lit(i)), 6).alias(f"f{i}") for i in range(SLOTS)]
    )
