"""Planning helpers: checked broadcast, spreading small sources, lineage cuts."""

import os

from pyspark.sql import functions as F

from quarry.operators import _plan


def _plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sized_broadcast_only_under_the_limit(spark):
    small = spark.range(100).withColumnRenamed("id", "k")
    big = spark.range(100000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = big.join(_plan.sized_broadcast(small, 16), "k")
        assert "BroadcastHashJoin" in _plan_text(hinted)
        spark.conf.set("quarry.broadcast.maxBytes", "64")
        not_hinted = big.join(_plan.sized_broadcast(small, 16), "k")
        assert "BroadcastHashJoin" not in _plan_text(not_hinted)
    finally:
        spark.conf.unset("quarry.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_is_a_no_op_on_parallel_input(spark):
    wide = spark.range(0, 1000, numPartitions=16)
    assert _plan.spread(wide) is wide
    narrow = spark.range(0, 1000, numPartitions=1)
    assert _plan.spread(narrow, 4).rdd.getNumPartitions() == 4


def test_cut_lineage_writes_to_checkpoint_dir_and_release(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    cut = _plan.cut_lineage(df)
    files = cut.inputFiles()
    assert files and all(spark.sparkContext.getCheckpointDir().split(":")[-1].rstrip("/") in f for f in files)
    assert sorted(r[1] for r in cut.collect()) == [2 * i for i in range(10)]
    path = files[0].replace("file:", "")
    assert _plan.release_tables(spark) >= 1
    assert not os.path.exists(path)


def test_joined_terms_come_back_as_lists_in_bounded_stretches(spark):
    """terms go to Python as one string a row and are lists again, some rows and bytes at a time; null and empty stay apart."""
    import pyarrow as pa
    from quarry.functions.text import word_terms
    from quarry.operators._plan import LIST_BYTES, LIST_ROWS, joined_terms, term_lists
    texts = [None, "", " .,! ", "Eine Größe, zwei_2 ÑANDÚ", "x"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").coalesce(1)
    got = rows.select("i", word_terms("t").alias("want"), joined_terms(word_terms("t")).alias("t")).orderBy("i").toArrow()
    back = [r for b in term_lists(got.to_batches(), "t") for r in b.to_pylist()]
    assert [r["t"] for r in back] == [r["want"] for r in back] and back[0]["t"] is None and back[1]["t"] == []
    many = [f"a{i} b" for i in range(5000)] + ["long " * 600_000 + "x"] * 3 + [None, ""]
    parts = list(term_lists([pa.record_batch({"n": pa.array(range(len(many))), "t": pa.array(many)})], "t"))
    assert max(p.num_rows for p in parts) <= LIST_ROWS and len(parts) > 4
    assert all(p.num_rows == 1 or sum(len(many[n]) for n in p.column("n").to_pylist() if many[n]) <= LIST_BYTES for p in parts)
    assert [r for p in parts for r in p.to_pylist()] == [{"n": i, "t": None if t is None else t.split()} for i, t in enumerate(many)]
