import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import mixing as op
from tests.llm import cases


def brute_targets(sizes, total=op.TOTAL):
    """{source: target} by sharing again until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: op.WEIGHTS[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = total * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in sizes if s not in capped)
        share = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / open_weight for s in sizes}
        over = {s for s in sizes if s not in capped and share[s] > 2 * sizes[s]}
        if not over:
            return share
        capped |= over


def sizes_of(rows):
    found = {}
    for _, text, _, source in rows:
        found[source] = found.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return found


def test_targets_of_odd_rows(spark):
    docs = cases.documents(spark, extra=True)
    wanted = {r.key: r for r in op.targets(op.sized(docs)).collect()}
    sizes = sizes_of(cases.TEXTS)
    expected = brute_targets(sizes)
    assert len(wanted) == len(sizes)
    for source, size in sizes.items():
        row = wanted["~" if source is None else "=" + source]
        assert row.source_size == size
        assert row.target == pytest.approx(expected[source])


def test_query_on_given_documents(spark, medium):
    docs = cases.given(spark, medium)
    rows = op.op5_mixing(spark, medium).toPandas()
    assert sorted(rows.doc_id) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert (rows.taken <= 2 * rows["size"]).all() and (rows.taken % rows["size"].clip(lower=1) == 0).all()
    expected = brute_targets(sizes_of([(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]))
    source = {r.doc_id: r.source for r in docs.collect()}
    for name, part in rows.groupby(rows.doc_id.map(source)):
        assert part.target.iloc[0] == pytest.approx(expected[name])
        assert part.source_size.iloc[0] == part["size"].sum()
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 0.02 * part["size"].sum()
    again = op.op5_mixing(spark, medium).toPandas()
    order = ["doc_id", "taken"]
    assert rows[order].sort_values(order).values.tolist() == again[order].sort_values(order).values.tolist()


@pytest.mark.parametrize("shards", [1, 5, 8])
def test_quotas_are_exact_at_every_split(spark, shards):
    quotas = {"=a": 1000, "=b": 37, "=c": 1, "~": 250}
    df = spark.createDataFrame(list(quotas.items()), "key string, quota bigint")
    rows = op.shard_quotas(df, shards).toPandas()
    assert rows.groupby("key").quota.sum().to_dict() == quotas
    assert sorted(rows["shard"].unique()) == list(range(shards))
    by_shard = rows.groupby("shard").quota.sum()
    assert by_shard.max() - by_shard.min() <= shards
    assert (rows.quota >= 0).all()


def test_chunks_of_sources_split_as_exactly(spark):
    quotas = {f"={i:03d}": 1 + i * i % 40 for i in range(150)}
    df = spark.createDataFrame(list(quotas.items()), "key string, quota bigint")
    rows = op.shard_quotas(df, 8, chunk_sources=9).toPandas()
    assert rows.groupby("key").quota.sum().to_dict() == quotas
    by_shard = rows.groupby("shard").quota.sum()
    assert len(by_shard) == 8 and by_shard.max() - by_shard.min() <= 8
    assert (rows.quota >= 0).all()
    again = op.shard_quotas(df.repartition(3), 8, chunk_sources=9).toPandas()
    order = ["shard", "key"]
    assert rows.sort_values(order).values.tolist() == again.sort_values(order).values.tolist()
    assert op.shard_quotas(df.limit(0), 8).count() == 0


def test_the_tree_decides_where_blocks_go(spark, medium):
    """The shards in the result are those of the tree's quotas, block by block."""
    docs = cases.given(spark, medium)
    sizes = op.sized(docs)
    units = op.plan_units(sizes, op.targets(sizes))
    quotas = op.shard_quotas(units.groupBy("key").agg(F.count("*").alias("quota"))).where("quota > 0")
    dealt = {(r.key, r.shard): r["count"] for r in units.groupBy("key", "shard").count().collect()}
    assert dealt == {(r.key, r.shard): r.quota for r in quotas.collect()}
    held = {}
    for r in op.draw(docs, units).select("doc_id", "shard").collect():
        held.setdefault(r.doc_id, []).append(r.shard)
    for r in op.op5_mixing(spark, medium).collect():
        assert r.shards == ",".join(map(str, sorted(held.get(r.doc_id, []))))
        assert r.taken == r.size * len(held.get(r.doc_id, []))


def test_mixture_holds_disjoint_blocks(spark, medium):
    docs = cases.given(spark, medium).withColumn("shard", F.lit("old"))
    sizes = op.sized(docs)
    units = op.plan_units(sizes, op.targets(sizes))
    assert units.groupBy("key", "block", "copy").count().where("count > 1").count() == 0
    mixture = op.draw(docs, units)
    copies = mixture.groupBy("doc_id").count().toPandas()
    taken = op.op5_mixing(spark, medium).where("taken > 0").toPandas()
    ratio = dict(zip(taken.doc_id, taken.taken // taken["size"]))
    held = {i: n for i, n in zip(copies.doc_id, copies["count"]) if i in ratio}
    assert held == ratio
    assert {r[0] for r in mixture.select("shard").distinct().collect()} == set(range(op.SHARDS))


def test_odd_and_empty_tables(spark):
    docs = cases.documents(spark, extra=True)
    sizes = op.sized(docs)
    units = op.plan_units(sizes, op.targets(sizes))
    mixture = op.draw(docs.withColumn("copy", F.lit("old")), units)
    assert mixture.columns == [*docs.columns, "copy", "shard", "place"]
    assert mixture.where("key <> 'kept' or copy not in (1, 2)").count() == 0
    nothing = op.sized(cases.empty(spark))
    assert op.targets(nothing).count() == 0
    assert op.plan_units(nothing, op.targets(nothing)).count() == 0
    blank = op.sized(cases.documents(spark, [(1, None, None, "a"), (2, "", None, None)]))
    assert [r.target for r in op.targets(blank).collect()] == [0.0, 0.0]
    assert op.plan_units(blank, op.targets(blank)).count() == 0
    with pytest.raises(ValueError):
        op.targets(blank, total=3)
