"""The refreshed cube against the rebuilt one after random batches, and bitmap counts against distinct counts."""

import random
from decimal import Decimal

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from tidewatch.operators import distinct, metrics
from tidewatch.operators.cube_store import CubeStore, changed_rows

SCHEMA = """subscriber_id string, plan_type string, churn_reason string, risk_band string, home_metro string, clv_at_risk_usd decimal(14,2), open_ticket_count bigint,
  churn_risk_score double, churn_signal_score double"""


def row(rng, key):
    maybe = lambda x: None if rng.random() < 0.2 else x
    return (key, rng.choice(["mobile", "bundle"]), maybe("price"), rng.choice(["critical", "elevated", "healthy"]), maybe("Kiel"), maybe(Decimal(rng.randrange(10**6)) / 100),
            maybe(rng.randrange(4)), maybe(rng.randrange(100) / 100), maybe(rng.randrange(100) / 100))


def frame(spark, rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def keys(spark, names):
    return spark.createDataFrame([(k,) for k in names], "subscriber_id string")


def test_twenty_random_batches(spark, tmp_path):
    rng, now = random.Random(11), {}
    store = CubeStore(spark, str(tmp_path), frame(spark, []).schema, buckets=2, fanout=3)
    for n in range(20):
        changed = {k: row(rng, k) for k in {f"s{rng.randrange(30)}" for _ in range(rng.randrange(6))}}
        gone = {k for k in rng.sample(sorted(now), min(len(now), 2)) if k not in changed} if n % 2 else set()
        store.refresh(frame(spark, changed.values()), keys(spark, gone) if gone else None, batch=f"b{n}")
        now = {k: r for k, r in (now | changed).items() if k not in gone}
        if n % 5 == 4:
            want = metrics.metric_cube(frame(spark, now.values()))
            got = store.cube()
            same_rows(want, got)
            assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    _, parts = store.manifest.read()
    assert len(parts) <= 2 * 3 and sum(len(p["batches"]) for p in parts) == 20
    store.vacuum()
    assert set(store.manifest.folders()) == {p["name"] for p in parts}
    same_rows(metrics.metric_cube(frame(spark, now.values())), store.cube())


def test_buckets_of_unchanged_subscribers_are_not_read(spark, tmp_path):
    rng = random.Random(5)
    now = {f"s{k}": row(rng, f"s{k}") for k in range(200)}
    store = CubeStore(spark, str(tmp_path), frame(spark, []).schema, buckets=8)
    store.refresh(frame(spark, now.values()), batch="all")
    # An unreadable file in every other bucket: a refresh that opened one would fail.
    mine = keys(spark, ["s3"]).select(F.pmod(F.xxhash64("subscriber_id"), F.lit(8))).first()[0]
    part = store.manifest.read()[1][0]["name"]
    for b in set(range(8)) - {mine}:
        (tmp_path / part / "rows" / f"_bucket={b}" / "part-broken.parquet").write_bytes(b"not a parquet file")
    now["s3"] = row(rng, "s3")
    assert store.refresh(frame(spark, [now["s3"]]), batch="one") == [mine]
    same_rows(metrics.metric_cube(frame(spark, now.values())), store.cube())


def test_groups_leave_and_batches_do_not_repeat(spark, tmp_path):
    rng = random.Random(2)
    one = row(rng, "a")
    store = CubeStore(spark, str(tmp_path), frame(spark, []).schema, buckets=2)
    assert store.cube().isEmpty()
    store.refresh(frame(spark, [one, one, (None, *one[1:])]), batch="x")
    same_rows(metrics.metric_cube(frame(spark, [one])), store.cube())
    assert store.refresh(frame(spark, [one]), batch="x") == []
    store.refresh(frame(spark, [one]), batch="same row")
    same_rows(metrics.metric_cube(frame(spark, [one])), store.cube())
    store.refresh(frame(spark, []), keys(spark, ["a", "never seen"]), batch="gone")
    assert store.cube().isEmpty()
    store.refresh(frame(spark, [one]), batch="back")
    same_rows(metrics.metric_cube(frame(spark, [one])), store.cube())


def test_floats_are_refused(spark, tmp_path):
    schema = frame(spark, []).withColumn("clv_at_risk_usd", F.col("clv_at_risk_usd").cast("double")).schema
    with pytest.raises(TypeError):
        CubeStore(spark, str(tmp_path), schema)


def test_changed_rows_names_new_different_and_gone(spark):
    rng = random.Random(4)
    a, b, c, d = (row(rng, k) for k in "abcd")
    other = (*b[:-1], 0.125)
    changed, gone = changed_rows(frame(spark, [a, b, c]), frame(spark, [a, other, d]), "subscriber_id")
    assert {tuple(r) for r in changed.collect()} == {other, d} and [tuple(r) for r in gone.collect()] == [("c",)]


def test_bitmaps_count_like_distinct(spark):
    rng = random.Random(9)
    ids = [0, -1, 1, 32768, 32769, -32768, 65536, 2**40, None]
    rows = spark.createDataFrame([(rng.choice("xyz"), rng.choice(["p", "q", None]), rng.choice(ids + list(range(40)))) for _ in range(600)] + [("only null", "p", None)],
                                 "city string, country string, id bigint")
    whole = distinct.bitmap_cube(rows, ["city", "country"], "id")
    parts = distinct.added(*[distinct.bitmap_cube(rows.filter(F.pmod(F.hash("id"), F.lit(3)) <= n), ["city", "country"], "id") for n in range(3)])
    for dims in (["city", "country"], ["country"], ["city"], []):
        want = rows.groupBy(*dims).agg(F.countDistinct("id").alias("n_distinct")).filter("n_distinct > 0")
        same_rows(distinct.distinct_from_cube(whole, dims), want)
        same_rows(distinct.distinct_from_cube(parts, dims), want)
    assert distinct.distinct_from_cube(whole.limit(0), []).first()[0] == 0
