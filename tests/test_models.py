import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalflow import schemas as S
from vitalflow.models import boosted, scoring
from vitalflow.operators import metrics
from vitalflow.plans import catalog, datasets
from vitalflow.operators.filters import drop_incomplete
from vitalflow.operators.windows import stratified_split
from vitalflow.session import session_settings, staged
from vitalflow.streaming import jobs

SMALL = boosted.BoostedTrees(trees=5, depth=3, rate=0.1, balanced=True)
SMALL_FIT = boosted.BoostedTrees.fit


@pytest.fixture(scope="module")
def parts(spark):
    rows = drop_incomplete(datasets.labeled(spark, "/root/testdata/sf0.001"))
    split = staged(stratified_split(rows), "model-test")
    return split.filter(~F.col("is_test")), split.filter("is_test")


@pytest.fixture(scope="module")
def model(parts):
    return SMALL.fit(parts[0])


def test_better_than_the_majority_class(parts, model):
    test = parts[1]
    report = {r.name: r for r in metrics.classification_report(model.score(test, "prediction")).collect()}
    n = report["accuracy"].support
    majority = max(report[str(c)].support for c in S.CLASSES) / n
    assert report["accuracy"].f1 > majority + 0.1


def test_probabilities_add_up(parts, model):
    rows = model.probabilities(parts[1])
    off = rows.filter(F.abs(F.col("p0") + F.col("p1") + F.col("p2") - 1) > 1e-9)
    assert off.count() == 0
    best = F.array_position(F.array("p0", "p1", "p2"), F.greatest("p0", "p1", "p2")) - 1
    assert model.score(rows, "c").filter(F.col("c") != best).count() == 0
    loss = metrics.multi_logloss(rows).first().logloss
    assert 0 < loss < 1.1


def test_save_and_load(parts, model, tmp_path):
    model.save(str(tmp_path / "m"))
    loaded = boosted.load_models({"gb": str(tmp_path / "m")})["gb"]
    both = scoring.compare_models(parts[1], {"a": model, "b": loaded})
    assert both.filter(~F.col("agree")).count() == 0 and both.filter("delta != 0").count() == 0


def test_scores_a_stream(spark, parts, model, tmp_path):
    test = parts[1]
    test.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(test.schema).parquet(f"{tmp_path}/in")
    jobs.start_files(
        jobs.score_stream(stream, model), f"{tmp_path}/out", f"{tmp_path}/progress"
    ).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").select("seq", "stress_level")
    assert got.exceptAll(model.score(test, "stress_level").select("seq", "stress_level")).count() == 0
    assert got.count() == test.count()


def test_loss_falls_while_training(parts, model):
    rows = boosted.staged_multi_logloss(model, parts[1], every=1).collect()
    losses = [r.logloss for r in rows]
    assert [r.trees for r in rows] == [1, 2, 3, 4, 5] and losses == sorted(losses, reverse=True)
    for trees, loss in zip((2, 5), (losses[1], losses[4])):
        scored = model.first(trees).probabilities(parts[1])
        assert metrics.multi_logloss(scored).first().logloss == pytest.approx(loss)


def plain_bins(values, bins):
    """Bin numbers by the rule of cells, one feature after the other."""
    out = np.zeros(values.shape, dtype=int)
    for f in range(values.shape[1]):
        v = values[:, f]
        cell = np.minimum(np.floor((v - v.min()) / (v.max() - v.min()) * boosted.CELLS), boosted.CELLS - 1)
        before = np.array([(cell < c).sum() for c in cell])
        out[:, f] = np.minimum(before * bins // len(v), bins - 1)
    return out


def plain_boosting(values, labels, settings):
    """Class scores after all rounds, by going through every cut of every leaf."""
    n = len(labels)
    w = np.ones(n)
    if settings.balanced:
        w = np.array([n / (len(set(labels)) * (labels == c).sum()) for c in labels])
    p = np.array([w[labels == k].sum() / w.sum() for k in range(3)])
    scores = np.tile(np.log(p), (n, 1))
    binned = plain_bins(values, settings.bins)
    for _ in range(settings.trees):
        shares = boosted.softmax(scores)
        for k in range(3):
            g, h = w * ((labels == k) - shares[:, k]), w * shares[:, k] * (1 - shares[:, k])
            size = h if settings.newton else np.ones(n)
            leaves = {1: np.arange(n)}

            def cut(node):
                best = (0.0, None)
                rows = leaves[node]
                if settings.depth is not None and node.bit_length() > settings.depth:
                    return best
                for f in range(values.shape[1]):
                    for b in range(settings.bins):
                        left = rows[binned[rows, f] <= b]
                        right = rows[binned[rows, f] > b]
                        if min(len(left), len(right)) < settings.min_rows:
                            continue
                        gain = sum(g[x].sum() ** 2 / size[x].sum() for x in (left, right))
                        gain = round(gain - g[rows].sum() ** 2 / size[rows].sum(), boosted.GAIN_DECIMALS)
                        if gain > best[0]:
                            best = (gain, (f, b))
                return best

            cuts = {1: cut(1)}
            while len(leaves) < (settings.leaves or 1 << 30) and max(c[0] for c in cuts.values()) > 0:
                node = max(cuts, key=lambda i: (cuts[i][0], -i))
                _, (f, b) = cuts.pop(node)
                rows = leaves.pop(node)
                leaves[2 * node], leaves[2 * node + 1] = rows[binned[rows, f] <= b], rows[binned[rows, f] > b]
                cuts[2 * node], cuts[2 * node + 1] = cut(2 * node), cut(2 * node + 1)
            for rows in leaves.values():
                scores[rows, k] += settings.rate * settings.step * g[rows].sum() / h[rows].sum()
    return scores


@pytest.mark.parametrize(
    "settings",
    [
        boosted.BoostedTrees(trees=3, depth=3, rate=0.3, bins=16, newton=False, step=2 / 3),
        boosted.BoostedTrees(trees=12, depth=2, rate=0.3, bins=8, min_rows=20, balanced=True),
        boosted.BoostedTrees(trees=3, leaves=12, rate=0.3, bins=16, min_rows=5, balanced=True, step=2 / 3),
    ],
)
@pytest.mark.parametrize("few", [0, 60, 20_000])
def test_trees_equal_those_of_going_through_all_cuts(parts, monkeypatch, few, settings):
    """Whether nodes are summed up level by level, grown in one task, or first one, then the other."""
    monkeypatch.setattr(boosted, "FEW_ROWS", few)
    rows = parts[0].filter("seq < 400")
    table = rows.select(*S.FEATURES, "label", "seq").toPandas().sort_values("seq")
    want = plain_boosting(table[list(S.FEATURES)].to_numpy(float), table["label"].to_numpy(), settings)
    got = settings.fit(rows.repartition(3)).scores(rows).orderBy("seq").select("f0", "f1", "f2").toPandas()
    assert np.allclose(got.to_numpy(), want)


@pytest.mark.parametrize("few", [0, 60, 20_000])
def test_rows_held_by_one_task_give_the_trees_of_jobs(parts, monkeypatch, few):
    """With drawn rows and features, limits of both kinds, and scores written in between."""
    rows = parts[0].filter("seq < 400").repartition(3)
    monkeypatch.setattr(boosted, "HELD_ROUNDS", 2)
    monkeypatch.setattr(boosted, "BLOCK_ROWS", 100)
    for settings in (
        dataclasses.replace(boosted.LEAF_BOOSTING, trees=5, min_rows=5, rate=0.3),
        boosted.BoostedTrees(trees=3, depth=3, rate=0.3, bins=16, row_share=0.7),
    ):
        got = settings.fit(rows, row_key="seq")
        with monkeypatch.context() as jobs_only:
            jobs_only.setattr(boosted, "HELD_ROWS", 0)
            jobs_only.setattr(boosted, "FEW_ROWS", few)
            want = settings.fit(rows, row_key="seq")
        assert len(got.rounds) == len(want.rounds) == settings.trees
        for a, b in zip((t for r in got.rounds for t in r), (t for r in want.rounds for t in r), strict=True):
            for name, values in vars(a).items():
                assert np.allclose(values, getattr(b, name)), name


def test_a_round_of_few_rows_is_no_job_of_its_own(spark, parts):
    context = spark.sparkContext

    def jobs_of(trees):
        try:
            context.setJobGroup(f"rounds-{trees}", "boosting")
            dataclasses.replace(SMALL, trees=trees).fit(parts[0])
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        return len(context.statusTracker().getJobIdsForGroup(f"rounds-{trees}"))

    assert jobs_of(2) == jobs_of(12)


def test_losses_do_not_depend_on_how_many_rows_are_scored_at_a_time(spark, parts, model, monkeypatch):
    want = [r.logloss for r in boosted.staged_multi_logloss(model, parts[1], every=1).collect()]
    with session_settings(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": "10"}):
        for rows in (1, 25, 1_000):
            monkeypatch.setattr(boosted, "SCORED_ROWS", rows)
            got = [r.logloss for r in boosted.staged_multi_logloss(model, parts[1], every=1).collect()]
            assert got == pytest.approx(want)


def test_rounds_take_as_many_tasks_as_rows_need(spark, parts):
    """However wide the session's shuffles are, and however few files the rows come in."""
    context, group = spark.sparkContext, "rounds"
    try:
        context.setJobGroup(group, "boosting")
        with session_settings(spark, **{"spark.sql.shuffle.partitions": "50"}):
            SMALL.fit(parts[0])
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) < 50


def test_rows_are_spread_evenly_over_tasks(spark, parts, monkeypatch):
    monkeypatch.setattr(boosted, "LEAST_ROWS", 100)
    monkeypatch.setattr(boosted, "BLOCK_ROWS", 50)
    fit = boosted._Fit(SMALL, parts[0].coalesce(1), "label", "seq")
    blocks = fit._with_bins().select("n", F.spark_partition_id().alias("task")).collect()
    sizes = [sum(b.n for b in blocks if b.task == t) for t in {b.task for b in blocks}]
    assert sum(sizes) == parts[0].count() and len(sizes) > 4 and max(sizes) < 1.5 * min(sizes)


def test_parts_of_a_tree_are_the_rows_that_come_to_its_nodes():
    tree = boosted.Tree(
        np.array([0, 1, 0, 0, 0]), np.array([3, 1, 0, 0, 0]), np.array([1, 3, 2, 3, 4]),
        np.array([2, 4, 2, 3, 4]), np.array([0.0, 0, 1, 2, 3]), np.zeros(5, np.int64), 2,
    )
    columns = np.array([[0, 5, 3, 2, 9], [2, 0, 1, 0, 7]], dtype=np.uint8)
    scores = np.zeros(5)
    tree.add_to(scores, columns)
    assert scores.tolist() == [3, 1, 2, 2, 1]
    wanted = np.array([False, True, False, False, True])
    got = {node: rows.tolist() for node, rows in tree.parts(columns, np.array([0, 1, 3]), wanted)}
    assert got == {1: [0, 3], 4: [0]}


def test_leaf_wise_trees_go_deep(parts):
    grown = dataclasses.replace(boosted.LEAF_BOOSTING, trees=2).fit(parts[0], row_key="seq")
    deepest = dataclasses.replace(boosted.LEAF_BOOSTING, trees=1, min_rows=2).fit(parts[0], row_key="seq")
    trees = [t for r in (*grown.rounds, *deepest.rounds) for t in r]
    assert all(t.leaves <= 31 for t in trees) and max(t.leaves for t in deepest.rounds[0]) == 31
    assert max(t.depth for t in deepest.rounds[0]) > 5
    again = dataclasses.replace(boosted.LEAF_BOOSTING, trees=2).fit(parts[0].repartition(4), row_key="seq")
    for a, b in zip(grown.rounds, again.rounds):
        assert all(np.array_equal(x.feature, y.feature) and np.allclose(x.value, y.value) for x, y in zip(a, b))
    assert {len(boosted.LEAF_BOOSTING.features_of(r, k)) for r in range(9) for k in range(3)} == {5}
    u = np.arange(100_000, dtype=np.uint64) * np.uint64(42_949)
    share = boosted.drawn(u, boosted.LEAF_BOOSTING.salt(3), 0.8).mean()
    assert abs(share - 0.8) < 0.01


def test_odd_training_rows(spark, parts, model):
    columns = [F.lit(None).cast("double").alias(c) for c in S.FEATURES]
    missing = parts[1].limit(5).select("seq", "label", *columns)
    shares = model.probabilities(missing).first()
    assert shares.p0 + shares.p1 + shares.p2 == pytest.approx(1)
    none = SMALL.fit(parts[0].limit(0))
    assert none.rounds == () and none.probabilities(missing).first().p1 == pytest.approx(1 / 3)
    foreign = parts[0].withColumn("label", F.lit(7))
    assert SMALL.fit(foreign).rounds == ()
    one = SMALL.fit(parts[0].limit(50).withColumn("label", F.lit(1)))
    assert one.score(parts[1]).filter("stress_level != 1").count() == 0


def test_loss_query_scores_the_whole_booster(spark, sf_dir, monkeypatch):
    seen = []

    def fit(settings, rows, label="label", row_key=None):
        seen.append(settings)
        return SMALL_FIT(SMALL, rows, label, row_key)

    monkeypatch.setattr(boosted.BoostedTrees, "fit", fit)
    monkeypatch.setattr(catalog, "_LEAF_MODELS", {})
    monkeypatch.setattr(boosted.staged_multi_logloss, "__defaults__", ("label", 1))
    losses = catalog.QUERIES["train_lgbm_logloss"](spark, sf_dir).collect()
    assert sorted(r.trees for r in losses) == [1, 2, 3, 4, 5] and all(r.lower for r in losses)
    catalog.QUERIES["train_lgbm"](spark, sf_dir).count()
    assert seen == [boosted.LEAF_BOOSTING]  # fitted once for both


def test_settings_of_the_three_models():
    assert (boosted.GRADIENT_BOOSTING.trees, boosted.GRADIENT_BOOSTING.depth) == (50, 4)
    assert boosted.HISTOGRAM_BOOSTING.balanced and boosted.HISTOGRAM_BOOSTING.bins == 255
    assert (boosted.LEAF_BOOSTING.trees, boosted.LEAF_BOOSTING.rate) == (300, 0.05)
