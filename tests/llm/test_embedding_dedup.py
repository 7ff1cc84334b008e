import numpy as np

from rowsmith.llm import embedding_dedup
from rowsmith.llm.queries import LLM_QUERIES


def brute(rows, cosine=0.93):
    """Links, components and the number of linked pairs, by comparing everything."""
    unit = []
    for _, v, label in rows:
        ok = label is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)
        unit.append(np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if ok else None)
    n = [0] * len(rows)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = 0
    for i in range(len(rows)):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= cosine:
                n[i] += 1
                n[j] += 1
                pairs += 1
                a, b = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                root[b] = a
    return {rows[i][0]: (n[i], rows[find(i)][0]) for i in range(len(rows))}, pairs


def clusters(seed=0, n=300, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dims))
    rows = []
    for i in range(n):
        v = centres[rng.integers(30)] + rng.normal(size=dims) * rng.choice([0.02, 0.25, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(2))))
    rows += [(n + i, rows[0][1], rows[0][2]) for i in range(40)]  # a class of copies
    rows += [(n + 40, [2 * x for x in rows[0][1]], rows[0][2]), (n + 41, None, 0), (n + 42, [], 1), (n + 43, [0.0] * dims, 0)]
    rows += [(n + 44, [None] + [1.0] * (dims - 1), 0), (n + 45, [float("nan")] + [1.0] * (dims - 1), 1), (n + 46, rows[1][1], None)]
    rows += [(n + 47, [1.0, 0.0, 0.0], 0), (n + 48, [1.0, 0.01, 0.0], 0), (n + 49, [float("inf")] * dims, 0), (n + 50, [1e-300] * dims, 0), (n + 51, [1.0] * dims, 0)]
    return rows


SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, part int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA.replace("float", "double")).withColumn("embedding", __import__("pyspark").sql.functions.col("embedding"))


def test_against_brute_force(spark):
    rows = clusters()
    want, pairs = brute(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.annotate(table(spark, rows)).collect()}
    assert set(got) == set(want)
    assert sum(n for n, _ in got.values()) >= 0.99 * 2 * pairs
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(got[i] == want[i] for i in got) >= 0.98 * len(got)


def test_blocks_and_cells_count_each_pair_once(spark):
    """With all cells visited and tiny blocks the result is exact."""
    rows = clusters(3, 150)
    want, _ = brute(rows)
    out = embedding_dedup.annotate(table(spark, rows), recall=1.0, per_cell=4, block=7).collect()
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out}
    assert got == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want, _ = brute(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in LLM_QUERIES["op8_embedding_dedup"](spark, sf_dir).collect()}
    assert got == want


def test_empty_and_unlinked(spark):
    assert embedding_dedup.annotate(table(spark, [])).count() == 0
    out = embedding_dedup.annotate(table(spark, [(1, None, 1), (2, [1.0, 0.0], None)])).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in out} == {(1, 0, 1, True), (2, 0, 2, True)}


def test_traversal_is_in_order_and_complete():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.random(6), rng.random(5)
        cells = embedding_dedup.multi_sequence(a, b, 0.8)
        total = (a[:, None] + b[None, :]).ravel()
        want = [i for i in np.argsort(total, kind="stable") if total[i] <= total.min() + 0.8]
        assert cells == want
