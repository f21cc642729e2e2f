"""Boosted trees, side-by-side SVMs and the truncated SVD against plain numpy on small tables."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from reviewmine.operators import blocks, clusters, linear, recommend, svd, trees


def sparse_table(spark, matrix, labels, dense_every=3):
    rows = []
    for i, (x, y) in enumerate(zip(matrix, labels)):
        at = np.flatnonzero(x)
        vector = Vectors.dense(x) if i % dense_every == 0 else Vectors.sparse(len(x), at.tolist(), x[at].tolist())
        rows.append((i, float(y) if y is not None else None, vector))
    schema = StructType([StructField("key", LongType()), StructField("label", DoubleType()), StructField("features", VectorUDT())])
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def points():
    draw = np.random.default_rng(3)
    x = np.round(draw.random((240, 7)) * (draw.random((240, 7)) < 0.5), 1)
    y = np.where(x[:, 0] + x[:, 1] > 0.8, 2, np.where(x[:, 2] > 0.3, 1, 0))
    return x, y


# ---- boosted trees -----------------------------------------------------------------------


def plain_trees(x, y, classes, rounds, depth, eta, reg, least):
    """Exact greedy trees on the distinct values; zeros are absent and go to the better side."""
    margins, forests = np.zeros((len(x), classes)), []
    for _ in range(rounds):
        p = np.exp(margins - margins.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g, h = p.copy(), np.maximum(2 * p * (1 - p), 1e-16)
        g[np.arange(len(y)), y] -= 1
        new, splits = margins.copy(), 0
        for c in range(classes):
            def grow(rows, level, c=c):
                nonlocal splits
                all_g, all_h = g[rows, c].sum(), h[rows, c].sum()
                best = None
                for j in range(x.shape[1]) if level < depth else ():
                    v = x[rows, j]
                    for cut in np.unique(v[v > 0]):
                        for absent in (False, True):
                            left = np.where(v > 0, v <= cut, absent)
                            a, b = g[rows[left], c].sum(), h[rows[left], c].sum()
                            if b < least or all_h - b < least:
                                continue
                            gain = a * a / (b + reg) + (all_g - a) ** 2 / (all_h - b + reg) - all_g ** 2 / (all_h + reg)
                            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                                best = gain, left
                if best is None:
                    new[rows, c] += -eta * all_g / (all_h + reg)
                else:
                    splits += 1
                    grow(rows[best[1]], level + 1)
                    grow(rows[~best[1]], level + 1)
            grow(np.arange(len(x)), 0)
        margins = new
        forests.append(splits)
    return margins, forests


def test_trees_are_exact_greedy_trees(spark, points, monkeypatch):
    x, y = points
    monkeypatch.setattr(trees, "RANGE_CELLS", 60)  # several ranges of columns
    monkeypatch.setattr(trees, "STORED_EVERY", 2)
    monkeypatch.setattr(blocks, "TASK_ROWS", 80)
    table = sparse_table(spark, x, y)
    model = trees.fit_softmax_trees(table, 3, x.shape[1], rounds=5, depth=3, bins=16)
    margins, splits = plain_trees(x, y, 3, 5, 3, 0.3, 1.0, 1.0)
    assert [sum(len(t.splits) for t in r) for r in model.rounds] == splits
    got = {r.key: r for r in model.transform(table).collect()}
    assert np.allclose([got[i].margins for i in range(len(x))], margins, atol=1e-9)
    for r in got.values():
        assert abs(sum(r.probabilities) - 1) < 1e-9 and r.prediction == int(np.argmax(r.margins))
    terms = [f"t{j}" for j in range(x.shape[1])]
    top = model.importance(terms)
    assert {t for t, _, _ in top[:3]} == {"t0", "t1", "t2"} and abs(sum(g for _, g, _ in top) - 1) < 1e-9
    assert sum(n for _, _, n in top) == sum(splits)


def test_trees_save_and_edges(spark, points, tmp_path):
    x, y = points
    rows = sparse_table(spark, np.vstack([x, np.zeros((2, 7))]), [*y, None, 0])
    rows = rows.unionByName(spark.createDataFrame([(999, 1.0)], "key long, label double"), allowMissingColumns=True)
    model = trees.fit_softmax_trees(rows, 3, 7, rounds=2, depth=2)
    loaded = trees.BoostedTrees.load(model.save(str(tmp_path / "trees")))
    first, again = (sorted(map(tuple, m.transform(rows).select("key", "margins", "prediction").collect())) for m in (model, loaded))
    assert first == again and first[-1] == (999, None, None)
    empty = trees.fit_softmax_trees(rows.limit(0), 3, 7, rounds=3)
    assert len(empty.rounds) == 1
    assert all(abs(p - 1 / 3) < 1e-12 for p in empty.transform(rows).first().probabilities)
    one = trees.fit_softmax_trees(rows.withColumn("label", F.lit(1.0)), 3, 7, rounds=3)
    assert one.transform(rows).first().prediction == 1.0


def test_sums_meet_by_several_ranges_and_columns_are_found_without_a_copy(spark, points, monkeypatch):
    monkeypatch.setattr(blocks, "TASK_ROWS", 80)
    monkeypatch.setattr(trees, "RANGE_WORTH", 20, raising=False)
    x, y = points
    asked, bounds = [], []
    real, search = trees._best_splits, np.searchsorted
    monkeypatch.setattr(trees, "_best_splits", lambda parts, ranges, *a: asked.append(ranges) or real(parts, ranges, *a))
    trees.fit_softmax_trees(sparse_table(spark, x, y), 3, 7, rounds=1, depth=1, bins=16)
    assert asked == [min(spark.sparkContext.defaultParallelism, 7 * 16 // 20)]
    block = trees.Block(np.arange(4, dtype=np.int32), np.array([1, 17, 18, 40], dtype=np.int32), 16)
    monkeypatch.setattr(trees.np, "searchsorted", lambda a, v, **k: bounds.append(np.asarray(v).dtype) or search(a, v, **k))
    rows, bins = block.column(1)
    assert rows.tolist() == [1, 2] and bins.tolist() == [1, 2] and bounds == [np.dtype(np.int32)]


def test_a_level_is_one_shuffle_of_sums(spark, points, monkeypatch):
    monkeypatch.setattr(blocks, "TASK_ROWS", 80)
    x, y = points
    plans = []
    real = trees._best_splits
    try:
        trees._best_splits = lambda *a: plans.append(real(*a)) or plans[-1]
        trees.fit_softmax_trees(sparse_table(spark, x, y), 3, 7, rounds=1, depth=2)
    finally:
        trees._best_splits = real
    assert len(plans) == 2  # a pass per level, whatever the number of classes and nodes
    for plan in plans:
        text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert text.count("Exchange") == 1 and text.count("MapInArrow") == 2


# ---- linear models -----------------------------------------------------------------------


def plain_svm(x, sign, c):
    """Newton steps on the squared hinge, intercept as one more column."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(60):
        short = np.maximum(0, 1 - sign * (z @ w))
        on = short > 0
        gradient = w - 2 * c * z.T @ (sign * short)
        hessian = np.eye(len(w)) + 2 * c * z[on].T @ z[on]
        step = np.linalg.solve(hessian, gradient)
        value = lambda v: 0.5 * v @ v + c * (np.maximum(0, 1 - sign * (z @ v)) ** 2).sum()
        t = 1.0
        while value(w - t * step) > value(w) and t > 1e-10:
            t /= 2
        w = w - t * step
    return w


def test_models_side_by_side_are_single_ones(spark, points):
    x, y = points
    table = sparse_table(spark, x, y)
    fold = F.col("key") % 3
    problems = [linear.Problem(k, f, c) for k in range(3) for f in (-1, 0, 2) for c in (0.3, 1.0)]
    model = linear.fit_linear_svms(table, 7, problems, fold=fold, tolerance=1e-7)
    at = np.arange(len(x)) % 3
    for j, p in enumerate(problems):
        own = at != p.left_out
        want = plain_svm(x[own], np.where(y[own] == p.label, 1.0, -1.0), p.c)
        assert np.allclose(model.weights[:, j], want, atol=1e-4), p
    whole = linear.LinearModels([p for p in problems if p.left_out == -1 and p.c == 1.0],
                                model.weights[:, [j for j, p in enumerate(problems) if p.left_out == -1 and p.c == 1.0]])
    scored = {r.key: r for r in whole.transform(table).collect()}
    want = np.hstack([x, np.ones((len(x), 1))]) @ whole.weights
    assert np.allclose([scored[i].margins for i in range(len(x))], want)
    assert [scored[i].prediction for i in range(len(x))] == want.argmax(axis=1).tolist()


def test_calibration_is_the_mean_of_the_folds(spark, points, tmp_path):
    x, y = points
    table = sparse_table(spark, x, y)
    model = linear.fit_calibrated_svm(table, 7, 3, F.col("key") % 4, folds=4)
    at = np.arange(len(x)) % 4
    shares = np.zeros((len(x), 3))
    z = np.hstack([x, np.ones((len(x), 1))]) @ model.models.weights
    for f in range(4):
        odds = np.zeros((len(x), 3))
        for k in range(3):
            m, held = z[:, f * 3 + k], at == f
            a, b = model.sigmoids[f, k]
            positive = (y[held] == k).sum()
            t = np.where(y[held] == k, (positive + 1) / (positive + 2), 1 / (held.sum() - positive + 2))
            p = 1 / (1 + np.exp(-(a * m[held] + b)))
            assert abs(((p - t) * m[held]).sum()) < 1e-3 and abs((p - t).sum()) < 1e-3  # the sigmoid's own optimum
            odds[:, k] = 1 / (1 + np.exp(-(a * m + b)))
        shares += odds / odds.sum(axis=1, keepdims=True) / 4
    got = {r.key: r for r in model.transform(table).collect()}
    assert np.allclose([got[i].probabilities for i in range(len(x))], shares)
    assert (np.array([got[i].prediction for i in range(len(x))]) == y).mean() > 0.8
    loaded = linear.CalibratedSVM.load(model.save(str(tmp_path / "svm")))
    assert np.allclose(loaded.sigmoids, model.sigmoids) and np.allclose(loaded.models.weights, model.models.weights)


# ---- truncated SVD -----------------------------------------------------------------------


def test_svd_is_numpy_s(spark, points, tmp_path, monkeypatch):
    x, _ = points
    monkeypatch.setattr(blocks, "TASK_ROWS", 50)
    monkeypatch.setattr(blocks, "BLOCK_ENTRIES", 300)
    monkeypatch.setattr(svd, "RANGE_CELLS", 20)
    table = sparse_table(spark, x, x[:, 0])
    model = svd.fit_truncated_svd(table, 7, 4)
    _, singular, right = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(model.singular, singular[:4]) and np.allclose(np.abs(model.vectors.T @ right[:4].T), np.eye(4), atol=1e-8)
    assert np.allclose(model.vectors.T @ model.vectors, np.eye(4))
    loaded = svd.TruncatedSVD.load(model.save(str(tmp_path / "svd")))
    got = {r.key: r.point for r in loaded.transform(table).collect()}
    assert np.allclose([got[i] for i in range(len(x))], x @ model.vectors)


def test_svd_of_low_rank_and_of_nothing(spark):
    draw = np.random.default_rng(1)
    x = draw.random((60, 2)) @ draw.random((2, 30))
    model = svd.fit_truncated_svd(sparse_table(spark, x, x[:, 0]), 30, 5)
    assert model.vectors.shape == (30, 2) and np.allclose(model.singular, np.linalg.svd(x)[1][:2])
    table = sparse_table(spark, x, x[:, 0])
    assert svd.fit_truncated_svd(table.limit(0), 30, 5).vectors.shape == (30, 0)
    with pytest.raises(ValueError):
        svd.fit_truncated_svd(table, 1 << 24, 5)


def test_svd_in_groups_of_columns_and_vectors_brings_small_factors(spark, points, monkeypatch):
    x, _ = points
    monkeypatch.setattr(svd, "TASK_CELLS", 600)  # three groups of the rows' images
    monkeypatch.setattr(svd, "RANGE_CELLS", 14)  # two vectors at a time
    monkeypatch.setattr(svd, "CHUNK", 50)
    table = sparse_table(spark, x, x[:, 0])
    calls = []
    gathered = svd.TruncatedSVD.gathered
    monkeypatch.setattr(svd.TruncatedSVD, "gathered", lambda self, a, b: calls.append((a, b)) or gathered(self, a, b))
    model = svd.fit_truncated_svd(table, 7, 5)
    assert not calls and np.allclose(model.products(), np.eye(5), atol=1e-12)
    got = np.array([r.point for r in model.transform(table).orderBy("key").collect()])
    assert calls == [(0, 2), (2, 4), (4, 5)]
    assert np.allclose(got, x @ model.vectors) and np.allclose(np.linalg.norm(got, axis=0), np.linalg.svd(x)[1][:5])


# ---- clusters ----------------------------------------------------------------------------


def test_clusters_stand_at_the_means_of_their_rows(spark, points, tmp_path, monkeypatch):
    x, _ = points
    monkeypatch.setattr(blocks, "TASK_ROWS", 50)
    monkeypatch.setattr(clusters, "BLOCK_ENTRIES", 100)
    monkeypatch.setattr(clusters, "CHUNK", 64)
    monkeypatch.setattr(clusters, "PASS_BYTES", 1)  # one start after the other
    table = sparse_table(spark, x, x[:, 0])
    model = clusters.fit_clusters(table, k=4, restarts=3, max_iter=60)
    got = np.array([r.prediction for r in model.transform(table).orderBy("key").collect()])
    distances = ((x[:, None] - model.centres) ** 2).sum(axis=2)
    assert (got == distances.argmin(axis=1)).all() and model.centres.shape == (4, 7)
    assert np.allclose(model.centres, [x[got == j].mean(axis=0) for j in range(4)])
    cost = distances.min(axis=1).sum()
    monkeypatch.undo()
    assert np.isclose(cost, ((x[:, None] - clusters.fit_clusters(table, k=4, restarts=3, max_iter=60).centres) ** 2).sum(axis=2).min(axis=1).sum(), rtol=0.1)
    again = clusters.Clusters.load(model.save(str(tmp_path / "clusters")))
    assert (again.centres == model.centres).all() and len(again.clusterCenters()) == 4


def test_clusters_of_few_different_rows(spark):
    x = np.array([[1.0, 0.0, 0.0]] * 5 + [[0.0, 2.0, 0.0]] * 3 + [[0.0, 0.0, 0.0]] * 2)
    model = clusters.fit_clusters(sparse_table(spark, x, x[:, 0]), k=5, restarts=2)
    assert sorted(map(tuple, model.centres)) == [(0, 0, 0), (0, 2, 0), (1, 0, 0)]
    with pytest.raises(ValueError):
        clusters.fit_clusters(sparse_table(spark, x, x[:, 0]).limit(0))


def test_passes_of_clusters_bring_no_centres_to_the_driver(spark, monkeypatch):
    width = 200_000  # ten centres are 16 MB
    rows = [(Vectors.sparse(width, sorted({i * 37 % width, i * 7919 % width, i % 5}), [1.0] * len({i * 37 % width, i * 7919 % width, i % 5})),)
            for i in range(1, 400)]
    table = spark.createDataFrame(rows, StructType([StructField("features", VectorUDT())]))
    monkeypatch.setattr(clusters, "_centres", lambda *a: np.zeros((10, 1)))
    conf = spark.sparkContext._jsc.sc().conf()
    conf.set("spark.driver.maxResultSize", "1m")
    try:
        assert clusters.fit_clusters(table, k=10, restarts=2, max_iter=3).centres.shape == (10, 1)
    finally:
        conf.remove("spark.driver.maxResultSize")


def test_fits_leave_no_blocks_behind_and_numbers_come_back(spark, points, monkeypatch):
    x, _ = points
    for kind in (np.uint16, np.int32, np.float64):
        for n in (0, 1, 1000):
            own = np.random.default_rng(n).integers(0, 60_000, n).astype(kind)
            assert (blocks.unsqueezed(blocks.squeezed(own), n, kind) == own).all()
    table, written = sparse_table(spark, x, x[:, 0]), []
    for module in (clusters, svd):
        stored = module.stored_blocks
        monkeypatch.setattr(module, "stored_blocks", lambda *a, stored=stored, **k: written.append(stored(*a, **k)) or written[-1])
    clusters.fit_clusters(table, k=2, restarts=1, max_iter=1)
    svd.fit_truncated_svd(table, 7, 2)
    assert len(written) == 2
    for df in written:
        with pytest.raises(Exception):
            df.count()


def test_groups_of_images_stay_within_the_bytes_of_a_pass():
    n, slices, most = 500_000, 6, 1 << 29
    groups = svd._groups(np.eye(60), n, slices, most)
    assert all(16 * slices * n * g.shape[1] <= most for g in groups) and (np.hstack(groups) == np.eye(60)).all()
    assert len(svd._groups(np.eye(60), 100, slices, most)) == 1


# ---- recommendation ----------------------------------------------------------------------


def test_best_items_are_brute_force(monkeypatch):
    draw = np.random.default_rng(4)
    monkeypatch.setattr(recommend, "ITEM_BLOCK", 16)
    items = draw.random((500, 4)) * draw.random((500, 1)) ** 3
    items[100:110] = items[0]  # equal scores
    ids = draw.permutation(500)
    norms = np.linalg.norm(items, axis=1)
    order = np.lexsort((ids, -norms))
    users = np.vstack([draw.random((80, 4)), np.zeros((1, 4))])
    found, scores, made = recommend.best_items(users, ids[order], items[order], norms[order], 5)
    for u, own, score in zip(users, found, scores):
        want = sorted(zip(-np.round(items @ u, 12), ids))[:5]
        assert [i for _, i in want] == own.tolist() and np.allclose([-s for s, _ in want], score)
    assert made < len(users) * len(items) / 2  # most items are never looked at
    few, _, _ = recommend.best_items(users, ids[:3], items[:3], norms[:3], 5)
    assert few.shape == (81, 3)


def test_boxes_of_items_are_brute_force(monkeypatch):
    draw = np.random.default_rng(5)
    for name, value in (("ITEM_BLOCK", 16), ("LEAF", 8), ("GROUP", 4)):
        monkeypatch.setattr(recommend, name, value)
    for low in (0.0, -0.5):  # factors of any sign
        items = draw.random((3000, 3)) + low
        items[100:110] = items[0]
        ids = draw.permutation(3000)
        users = np.vstack([draw.random((50, 3)) + low, np.zeros((1, 3))])
        wanted = [sorted(zip(-np.round(items @ u, 12), ids))[:5] for u in users]
        found, scores, made = recommend.ItemBoxes(ids, items).best(users, 5)
        assert [[i for _, i in w] for w in wanted] == found.tolist() and np.allclose([[-s for s, _ in w] for w in wanted], scores)
        assert made < len(users) * len(items) / 3
        known = None
        for part in (ids % 3 == 0, ids % 3 == 1, ids % 3 == 2):  # round by round
            known = recommend.ItemBoxes(ids[part], items[part]).best(users, 5, known)[:2]
        assert known[0].tolist() == found.tolist()
    few, _, _ = recommend.ItemBoxes(ids[:3], items[:3]).best(users, 5)
    assert few.shape == (51, 5) and (few == recommend.NO_ITEM).sum() == 51 * 2


def test_more_items_than_a_broadcast_go_round_by_round(spark, monkeypatch):
    draw = np.random.default_rng(6)
    rows = [(int(u), int(i), float(1 + (u * i) % 5)) for u in range(40) for i in draw.permutation(60)[:20]]
    triples, users, items = recommend.rating_triples(spark.createDataFrame(rows, "user int, item int, rating double"), "user", "item", "rating")
    rec = recommend.Recommender(recommend.als(3, 3).fit(triples), users, items)
    whole = {r.u: r.recommendations for r in recommend.top_items(rec, 5).collect()}
    monkeypatch.setattr(recommend, "ITEM_CELLS", 60)
    type(rec.model).recommendForAllUsers, real = None, type(rec.model).recommendForAllUsers  # never all pairs
    try:
        parts = {r.u: r.recommendations for r in recommend.top_items(rec, 5).collect()}
    finally:
        type(rec.model).recommendForAllUsers = real
    assert len(whole) == 40 and parts == whole


def test_models_that_stand_still_take_no_part_in_later_passes(spark, monkeypatch):
    rows = [(float(i % 3), Vectors.sparse(6, {i % 3: 1.0, 3 + i % 2: 0.5 + 0.1 * (i % 7)})) for i in range(60)]
    df = spark.createDataFrame(rows, ["label", "features"])
    widths, losses = [], linear._losses

    def counted(blocks, weights, problems, ranges):
        widths.append(weights.shape[1])
        return losses(blocks, weights, problems, ranges)

    problems = [linear.Problem(0, c=1e-6), linear.Problem(1, c=10.0)]
    alone = linear.fit_linear_svms(df, 6, problems[1:])
    monkeypatch.setattr(linear, "_losses", counted)
    both = linear.fit_linear_svms(df, 6, problems)
    assert widths[0] == 2 and widths[-1] == 1
    assert np.allclose(both.weights[:, 1], alone.weights[:, 0], atol=1e-6)
