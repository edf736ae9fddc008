"""The pigeonhole join against all pairs."""

import os
import threading

import numpy as np
import pytest
from conftest_llm import key
from velomart.llm import embedding_join as E


def brute(vectors, threshold):
    n = len(vectors)
    ok, unit = [], []
    for v in vectors:
        good = v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(good)
        unit.append(np.array(v, float) / np.linalg.norm(v) if good else None)
    links = [[j for j in range(n) if j != i and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    return links


def components(ids, links):
    label = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i, near in enumerate(links):
            for j in near:
                if label[j] < label[i]:
                    label[i], changed = label[j], True
    least = {}
    for i, root in enumerate(label):
        if ids[i] is not None:
            least[root] = min(least.get(root, ids[i]), ids[i])
    return [least.get(root) for root in label]


def vectors(seed, dims, count):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        kind = rng.random()
        if out and kind < 0.15:
            out.append(out[rng.integers(len(out))])
        elif out and kind < 0.6:
            base = np.array(out[rng.integers(len(out))])
            out.append((base + rng.standard_normal(dims) * rng.choice([0.02, 0.3, 0.45]) * np.linalg.norm(base) / np.sqrt(dims)).tolist())
        else:
            out.append((rng.standard_normal(dims) * rng.choice([0.1, 1, 50])).tolist())
    return out


@pytest.mark.parametrize(("dims", "tile"), [(1, 8 << 20), (5, 64), (33, 8 << 20), (64, 64)])
def test_all_links_are_found(spark, monkeypatch, dims, tile):
    monkeypatch.setattr(E, "TILE_BYTES", tile)
    data = vectors(dims, dims, 150)
    data += [None, [], [0.0] * dims, [float("nan")] * dims, [None] + [1.0] * (dims - 1), [float("inf")] * dims, [1.0] * (dims + 1), [2.0] * (dims + 1)]
    ids = [*range(len(data))]
    ids[7] = None
    df = spark.createDataFrame(list(zip(ids, data, [1] * len(data), strict=True)), "vec_id long, embedding array<double>, node long")
    got = {r.vec_id: r for r in E.near_duplicates(df, 0.9).collect()}
    links = brute(data, 0.9)
    want = components(ids, links)
    assert len(got) == len(ids)
    for i, v in enumerate(ids):
        assert (got[v].n_links, got[v].component_id, got[v].kept) == (len(links[i]), want[i], v is not None and v == want[i])


def test_equal_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 3.0])], "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df).collect()), key=lambda r: (key(r[0]), r))
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_tiles_split_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE_BYTES", 1)  # 64 rows a tile
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    data = [(i, (base + rng.standard_normal(16) * 0.01).tolist()) for i in range(700)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = E.near_duplicates(df).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(699, 0)}


def test_some_block_is_within_its_budget():
    rng = np.random.default_rng(1)
    for dims in (3, 16, 17, 64):
        turn = E.rotation(dims)
        assert np.allclose(turn @ turn.T, np.eye(dims))
        x = rng.standard_normal(dims)
        y = x + rng.standard_normal(dims) * 0.3 * np.linalg.norm(x) / np.sqrt(dims)
        x, y = x / np.linalg.norm(x), y / np.linalg.norm(y)
        parts = [((x @ turn - y @ turn)[b:e] ** 2).sum() for b, e in E.blocks(dims)]
        assert np.isclose(E.budgets(dims, 0.9).sum(), 0.2)
        if x @ y >= 0.9:
            assert (parts <= E.budgets(dims, 0.9)).any()


def test_pairs_near_the_threshold_are_verified(spark):
    """Cosines within a sketch's error of the threshold, on both sides of it."""
    data = [[1.0] + [0.0] * 39]
    for k in range(60):
        cos = 0.9 + (k - 30) * 1e-5
        data.append([cos] + [float(np.sqrt(1 - cos * cos)) if i == k % 39 else 0.0 for i in range(39)])
    df = spark.createDataFrame(list(enumerate(data)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in E.near_duplicates(df, 0.9).collect()}
    want = [len(near) for near in brute(data, 0.9)]
    assert [got[i] for i in range(1, 30)] == want[1:30]
    assert [got[i] for i in range(32, 61)] == want[32:]


def test_disk_is_in_proportion_to_the_input(spark, scratch):
    rng = np.random.default_rng(5)
    data = rng.standard_normal((12000, 64)).astype(np.float32)
    path, seen, done = scratch("vectors"), [], threading.Event()
    spark.createDataFrame([(i, v) for i, v in enumerate(data.tolist())], "vec_id long, embedding array<float>").write.parquet(path)
    dirs = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()] + [os.path.dirname(path)]

    def used(*tops):
        total = 0
        for name in (os.path.join(d, f) for top in tops for d, _, files in os.walk(top) for f in files):
            try:
                total += os.path.getsize(name)
            except OSError:  # removed since
                pass
        return total

    start = used(*dirs)

    def watch():
        while not done.wait(0.05):
            seen.append(used(*dirs) - start)

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        got = E.near_duplicates(spark.read.parquet(path)).agg({"n_links": "sum"}).first()[0]
    finally:
        done.set()
        watching.join()
    assert got == 0
    assert max(seen) < 4 * used(path)


def test_cells_of_several_lengths_and_chunks(spark, monkeypatch):
    """Many cells, cells in several chunks, chunks of several cells, copies in either."""
    monkeypatch.setattr(E, "CELL_ROWS", 20)
    monkeypatch.setattr(E, "TILE_BYTES", 64)
    rng = np.random.default_rng(9)
    close = rng.standard_normal(70)
    data = vectors(11, 70, 150) + vectors(12, 6, 90) + [(close + rng.standard_normal(70) * 0.1).tolist() for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(data)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in E.near_duplicates(df, 0.9).collect()}
    links = brute(data, 0.9)
    want = components(range(len(data)), links)
    assert [(got[i].n_links, got[i].component_id) for i in range(len(data))] == [(len(near), c) for near, c in zip(links, want, strict=True)]
