from fieldglass.llm import common
from fieldglass.llm.common import stage


def test_join_hot(spark):
    """A key with most rows, nulls, keys without a partner; null keys meet nothing."""
    keys = [7] * 500 + list(range(40)) + [None, None]
    left = stage(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i int"))
    right = spark.createDataFrame([(k, k * 10) for k in range(30)], "k long, v long")
    for how in ("inner", "left"):
        got = sorted((r["i"], r["v"]) for r in common.join_hot(left, right, "k", how).collect())
        want = [(i, k * 10 if k is not None and k < 30 else None) for i, k in enumerate(keys)]
        assert got == [w for w in want if how == "left" or w[1] is not None]
    assert common.join_hot(left.where("false"), right, "k").collect() == []


def test_join_salted(spark):
    keys = [7] * 500 + list(range(40)) + [None]
    left = stage(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i int"))
    right = spark.createDataFrame([(k, str(k)) for k in range(30)], "k long, v string")
    got = sorted((r["i"], r["v"]) for r in common.join_salted(left, right, "k", "i").collect())
    assert got == [(i, str(k)) for i, k in enumerate(keys) if k is not None and k < 30]


def test_stage_only_deletes_its_own(spark):
    """Each call deletes what was staged within it, also in another thread, and nothing else."""
    from concurrent.futures import ThreadPoolExecutor

    outside = stage(spark.range(3))

    def work(n):
        held = []

        def make():
            held.append(stage(spark.range(n)))
            return held[0].selectExpr("id + 1 AS id")

        out = common.stage_only(make)
        return held[0].staged_path, out

    with ThreadPoolExecutor(2) as pool:
        for path, out in pool.map(work, (5, 6)):
            from pathlib import Path

            assert not Path(path).exists() and out.count() in (5, 6)
    assert outside.count() == 3
