from pyspark.sql import functions as F

from lakeloom.llm import common


def test_rows_of_files_are_numbered_by_their_place(spark, tmp_path):
    path = (tmp_path / "t").as_uri()
    spark.range(100).withColumn("v", F.col("id") % 7).repartition(3).write.parquet(path)
    scan = spark.read.parquet(path)
    top = (tmp_path / "top").as_uri()
    other = spark.createDataFrame([(i,) for i in range(7)] * 2, "w long")
    plans = {
        "scan": (scan, True), "selected": (scan.select("id").where("id > 10"), True), "exploded": (scan.withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(2)))), False), "joined": (scan.join(other, F.col("v") == F.col("w")), False),
        "chosen": (scan.where(F.rand(1) < 0.5), False), "limited": (scan.limit(9), False), "made": (spark.createDataFrame([(1,), (1,)], "id long"), False), "named": (scan.withColumnRenamed("v", "_metadata"), True), "empty": (scan.where("id < 0"), True),
    }
    for name, (df, is_scan) in plans.items():
        assert common.is_scan(df) == is_scan, name
        out = common.numbered(df, "_row", f"{top}/{name}")
        first, again = ({tuple(r) for r in out.collect()} for _ in range(2))
        assert out.columns == [*df.columns, "_row"] and first == again
        rows = [r["_row"] for r in out.collect()]
        assert len(set(rows)) == len(rows) and (name == "chosen" or len(rows) == df.count()), name


def test_joins_of_hot_keys_equal_plain_ones(spark, monkeypatch):
    many = spark.createDataFrame([(i % 5 if i % 3 else 0, i) for i in range(300)], "k long, v long")
    one = spark.createDataFrame([(k, f"x{k}") for k in range(4)], "k long, name string")
    want = sorted(tuple(r) for r in many.join(one, "k").collect())
    for hot in (10_000, 50, 0):
        monkeypatch.setattr(common, "HOT", hot)
        assert sorted(tuple(r) for r in common.hot_join(many, one, "k").collect()) == want
    for most in (10, 0):
        monkeypatch.setattr(common, "BROADCAST_ROWS", most)
        assert common.meet(many, F.col("k") == F.col("_k"), one.select(F.col("k").alias("_k")), "left_anti").count() == many.where("k > 3").count()


def test_equal_bytes_hash_alike_and_others_do_not():
    import numpy as np

    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 3 * common.PIECE_BYTES, dtype=np.uint8)
    starts = np.array([0, 5, 100, 2000, 2100 + common.PIECE_BYTES])
    ends = np.array([5, 9, 1900, 2050 + common.PIECE_BYTES, 3 * common.PIECE_BYTES])
    one = common.span_hashes(raw, starts, ends)
    for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
        assert common.span_hashes(raw[a:b], np.array([0]), np.array([b - a]))[0] == one[i]
    small = [raw[a : a + 12].tobytes() for a in range(5000)]
    hashes = common.span_hashes(np.frombuffer(b"".join(small), np.uint8), np.arange(5000) * 12, np.arange(1, 5001) * 12)
    assert len(set(hashes.tolist())) == len(set(small))
    same = common.same_spans(raw, starts, raw.copy(), starts, ends - starts)
    other = raw.copy()
    other[2001] ^= 1
    assert same.all() and common.same_spans(raw, starts, other, starts, ends - starts).tolist() == [True, True, True, False, True]
