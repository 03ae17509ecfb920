import duckdb
import numpy as np
from siltbed.llm import queries, vafile

SF = "/root/testdata/sf0.001"


def brute(vectors, queries, k):
    out = []
    for q, own in sorted(queries):
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in vectors if i != q and len(v) == len(own))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


def test_bounds_hold():
    rnd = np.random.default_rng(1)
    vectors = rnd.integers(-200, 200, (500, 16))
    file = vafile.ApproximationFile(np.arange(500), vectors, 8)
    queries = rnd.integers(-200, 200, (20, 16))
    exact = queries @ file.vectors.T
    assert (file.bounds(queries) >= exact).all() and (file.bounds(queries) - exact).mean() > 0


def test_equals_brute_force(spark):
    rnd = np.random.default_rng(3)
    vectors = [(i, rnd.integers(-3, 4, 4).tolist()) for i in range(300)] + [(i, [1, 1, 1, 1]) for i in range(300, 400)]
    vectors += [(500, [1 << 40, 1]), (501, [1 << 40, 2]), (502, []), (503, [7])]
    queries = [v for v in vectors if v[0] % 7 == 0 or v[0] >= 500]
    rows = vectors + [(None, [1, 1, 1, 1]), (600, None)]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(3)
    asked = frame.where("vec_id % 7 = 0 or vec_id >= 500")
    for size in (8192, 50):
        got = vafile.top_k(frame, asked, 6, block_rows=size).select("query_id", "rank", "vec_id", "score").collect()
        want = [(q, r, i, min(s, 2 ** 63 - 1)) for q, r, i, s in brute(vectors, queries, 6)]
        assert sorted(map(tuple, got)) == want


def test_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25], 0), (2, None, 0), (3, [None, 1.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [-0.001, 0.999], 1), (7, [-inf, 0.0], 1)]
    got = vafile.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<float>, vector int")).collect()
    assert sorted(map(tuple, got)) == [(1, [128, 64]), (6, [-1, 255])]
    assert vafile.top_k(spark.createDataFrame([], "vec_id long, vector array<long>"), spark.createDataFrame([], "vec_id long, vector array<long>"), 3).count() == 0


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = queries.op7_vafile(spark, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(queries.ORACLES["op7_vafile"]).fetchall())
