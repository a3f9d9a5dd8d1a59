"""The leaf-wise booster against plain Python."""

import hashlib
import json
import math
import random
from dataclasses import replace

import numpy as np
import pytest
from compare import difference, duckdb_over
from pyspark.sql import functions as F

from promolens.config import LeafwiseConfig, RunConfig
from promolens.operators import binning, boosting, trees
from promolens.plans import runs
from promolens.sources import artifacts
from test_model import separable
from testkit import oracle, registry

SMALL = LeafwiseConfig(rounds=4, patience=4, learning_rate=0.3, leaves=6, min_rows=5,
                       max_bins=16, block=2)


def frame(spark, rows=900, seed=5):
    pick = random.Random(seed)
    made = []
    for i in range(rows):
        a, b, c = pick.randrange(30), round(pick.gauss(0, 3), 2), pick.choice([0.0, 1.0])
        label = int(a + 4 * b * c + pick.gauss(0, 6) > 15)
        made.append((i, a, b, c, label, int(i % 5 == 0)))
    return spark.createDataFrame(
        made, "key long, a int, b double, c double, label int, is_validation int"
    ).repartition(5)


NAMES = ("a", "b", "c")


# -- bins ------------------------------------------------------------------------------------------


def test_cuts_are_quantiles(spark):
    df = frame(spark)
    found = binning.fit_bins(df, NAMES, 16)
    for name, cuts in zip(NAMES, found.cuts, strict=True):
        values = sorted(float(r[0]) for r in df.select(name).collect())
        exact = {values[math.ceil(i / 16 * len(values)) - 1] for i in range(1, 16)}
        assert list(cuts) == sorted(x for x in exact if x < values[-1])


def test_rows_fall_into_the_bins_of_their_values(spark):
    df = frame(spark)
    bins = binning.fit_bins(df, NAMES, 16)
    keep = [F.col(n).cast("double").alias(f"v_{n}") for n in NAMES]
    for r in binned_rows(df, bins, keep):
        values = [r["v_a"], r["v_b"], r["v_c"]]
        assert list(r["x"]) == [
            sum(c < v for c in cuts) for v, cuts in zip(values, bins.cuts, strict=True)
        ]


def binned_rows(df, bins, keep):
    return binning.binned(df, bins, keep).collect()


def test_bins_of_odd_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, None, float("nan")), (1.0, 6.0, None, 2.0), (1.0, None, None, 3.0)],
        "same double, two double, none double, `not a.number` double",
    )
    bins = binning.fit_bins(df, df.columns, 8)
    assert bins.cuts == ((), (5.0,), (), (2.0,))
    assert [list(r["x"]) for r in binned_rows(df, bins, [])] == [
        [0, 0, 0, 0], [0, 1, 0, 0], [0, 0, 0, 1]]
    assert binning.fit_bins(df.where("false"), df.columns, 8).cuts == ((),) * 4
    with pytest.raises(ValueError, match="max_bins"):
        binning.fit_bins(df, df.columns, 1)


# -- one tree --------------------------------------------------------------------------------------


def brute_tree(rows, n_features, cfg):
    """Leaf by leaf from the rows themselves: {path: (feature, bin, gain)} and {path: value}."""
    def shrunk(g):
        return math.copysign(max(abs(g) - cfg.l1, 0.0), g)

    def worth(some):
        g = sum(r[1] for r in some) / boosting.UNIT
        h = sum(r[2] for r in some) / boosting.UNIT
        return shrunk(g) ** 2 / (h + cfg.l2)

    def options(some):
        for f in range(n_features):
            for b in sorted({r[0][f] for r in some}):
                low = [r for r in some if r[0][f] <= b]
                high = [r for r in some if r[0][f] > b]
                if min(len(low), len(high)) >= cfg.min_rows and all(
                    sum(r[2] for r in side) / boosting.UNIT >= cfg.min_hessian
                    for side in (low, high)
                ):
                    gain = worth(low) + worth(high) - worth(some)
                    if gain > 0:
                        yield round(-gain, 9), f, b

    leaves, splits = {(): rows}, {}
    while len(leaves) < cfg.leaves:
        best = min(((*min(o), path) for path, some in leaves.items()
                    if (o := list(options(some)))), default=None,
                   key=lambda x: (x[0], x[3]))
        if best is None:
            break
        gain, f, b, path = best
        some = leaves.pop(path)
        splits[path] = (f, b, -gain)
        leaves[(*path, 0)] = [r for r in some if r[0][f] <= b]
        leaves[(*path, 1)] = [r for r in some if r[0][f] > b]
    values = {
        path: -shrunk(sum(r[1] for r in some) / boosting.UNIT)
        / (sum(r[2] for r in some) / boosting.UNIT + cfg.l2)
        for path, some in leaves.items()
    }
    return splits, values


def paths_of(tree):
    splits, values, at = {}, {}, [((), 0)]
    for path, i in at:
        if tree.feature[i] < 0:
            values[path] = tree.value[i]
        else:
            splits[path] = (tree.feature[i], tree.bin[i], round(tree.gain[i], 9))
            at += [((*path, 0), tree.left[i]), ((*path, 1), tree.right[i])]
    return splits, values


def local_histograms(rows, n_features, width, asked):
    def reached(tree, x):
        i = 0
        while tree.feature[i] >= 0:
            i = tree.left[i] if x[tree.feature[i]] <= tree.bin[i] else tree.right[i]
        return i

    def histograms(tree, nodes):
        asked.append(len(nodes))
        out = {n: np.zeros((n_features, width, 3), np.int64) for n in nodes}
        for x, g, h in rows:
            node = reached(tree, x)
            if node in out:
                for f in range(n_features):
                    out[node][f, x[f]] += (g, h, 1)
        return out

    return histograms


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("leaves", [2, 5, 40])
def test_tree_equals_the_one_grown_split_by_split(seed, leaves):
    pick = random.Random(seed)
    rows = [
        (tuple(pick.randrange(7) for _ in range(4)),
         pick.randrange(-boosting.UNIT, boosting.UNIT), pick.randrange(1, boosting.UNIT // 4))
        for _ in range(160)
    ]
    cfg = replace(SMALL, leaves=leaves, min_rows=3, l1=0.2, l2=0.4, learning_rate=1.0)
    bins = binning.Bins(("a", "b", "c", "d"), (tuple(map(float, range(6))),) * 4)
    asked: list[int] = []
    tree = boosting.grow(local_histograms(rows, 4, 7, asked), bins, [0, 1, 2, 3], cfg)
    splits, values = paths_of(tree)
    wanted_splits, wanted_values = brute_tree(rows, 4, cfg)
    assert splits.keys() == wanted_splits.keys()
    for path, (f, b, gain) in wanted_splits.items():
        assert splits[path][:2] == (f, b) and splits[path][2] == pytest.approx(gain, abs=1e-8)
    assert values == pytest.approx(wanted_values, abs=1e-12)
    assert tree.leaves <= leaves and sum(tree.rows[i] for i in range(len(tree.rows))
                                         if tree.feature[i] < 0) == len(rows)
    # One pass looks at many leaves; the first ones have few to look at.
    assert len(asked) <= max(6, tree.leaves // 2)


def test_leaf_values_have_both_penalties():
    cfg = replace(SMALL, l1=0.5, l2=2.0)
    unit = boosting.UNIT
    assert boosting.leaf_value(-3 * unit, 3 * unit, cfg) == pytest.approx(2.5 / 5)
    assert boosting.leaf_value(3 * unit, 3 * unit, cfg) == pytest.approx(-2.5 / 5)
    assert boosting.leaf_value(unit // 4, unit, cfg) == 0
    assert boosting.leaf_value(unit, 0, replace(cfg, l2=0.0)) == 0


def test_nothing_to_split():
    same = np.zeros((2, 3, 3), np.int64)
    same[:, 1] = (5, 5, 100)
    assert boosting.best_split(same, SMALL) is None
    bins = binning.Bins(("a", "b"), ((), ()))
    for answer in ({}, {0: same[:, :1] * 0 + same[:, 1:2]}):
        tree = boosting.grow(lambda t, n, a=answer: a, bins, [0, 1], SMALL)
        assert tree.leaves == 1 and tree.depth == 0


# -- draws -----------------------------------------------------------------------------------------


def test_draws_follow_hashes(spark):
    keys = spark.range(500).select(F.col("id").alias("k"))
    drawn = {r["k"] for r in keys.where(boosting.is_drawn(F.col("k"), 7, 3, 0.6)).collect()}
    expected = {
        k for k in range(500)
        if int(hashlib.md5(f"{k}|3|7".encode()).hexdigest()[:15], 16) < int(0.6 * 2**60)
    }
    assert drawn == expected and 250 < len(drawn) < 350
    names = [f"f{i}" for i in range(10)]
    each = [boosting.drawn_features(1, t, names, 0.6) for t in range(50)]
    assert all(len(f) == 6 and f == sorted(f) for f in each) and len(set(map(tuple, each))) > 20
    assert boosting.drawn_features(1, 1, names, 0.01) != []


# -- whole fits ------------------------------------------------------------------------------------


def test_rounds_equal_a_plain_booster(spark):
    df = frame(spark, 600)
    fitted = boosting.fit(df, NAMES, SMALL, seed=3)
    bins = binning.fit_bins(df.where("is_validation = 0"), NAMES, SMALL.max_bins)
    rows = sorted(binning.binned(df, bins, [F.col("key"), F.col("label"),
                                            F.col("is_validation")]).collect())
    train = [r for r in rows if not r["is_validation"]]
    share = sum(r["label"] for r in train) / len(train)
    margin = {r["key"]: math.log(share / (1 - share)) for r in rows}
    assert fitted.model.base == pytest.approx(math.log(share / (1 - share)))
    for number, tree in enumerate(fitted.model.trees, 1):
        used = boosting.drawn_features(3, number, NAMES, SMALL.feature_fraction)
        cut = int(SMALL.row_fraction * 2**60)
        sample = []
        for r in train:
            if int(hashlib.md5(f"{r['key']}|{number}|3".encode()).hexdigest()[:15], 16) < cut:
                p = 1 / (1 + math.exp(-margin[r["key"]]))
                sample.append((tuple(r["x"][f] for f in used),
                               round((p - r["label"]) * boosting.UNIT),
                               round(p * (1 - p) * boosting.UNIT)))
        splits, values = brute_tree(sample, len(used), SMALL)
        got, got_values = paths_of(tree)
        assert {p: (used[s[0]], s[1]) for p, s in splits.items()} == {
            p: s[:2] for p, s in got.items()}
        for path, value in values.items():
            assert got_values[path] == pytest.approx(SMALL.learning_rate * value, abs=1e-9)
        for r in rows:
            path = ()
            while path in got:
                path = (*path, int(r["x"][got[path][0]] > got[path][1]))
            margin[r["key"]] += got_values[path]
    scored = {r["key"]: r["score"] for r in fitted.model.probabilities(df).collect()}
    assert scored == pytest.approx({k: 1 / (1 + math.exp(-m)) for k, m in margin.items()})


def test_result_does_not_depend_on_the_layout(spark):
    df = frame(spark, 400)
    one = boosting.fit(df.coalesce(1), NAMES, SMALL).model.to_text()
    assert boosting.fit(df.repartition(7), NAMES, SMALL).model.to_text() == one


def test_broken_run_goes_on_and_ends_alike(spark, tmp_path, monkeypatch):
    df = frame(spark, 500)
    whole = boosting.fit(df, NAMES, SMALL)
    folder, trained = str(tmp_path / "progress"), []
    real = boosting._round

    def breaking(*args):
        trained.append(args[2])
        if args[2] == 4 and trained.count(4) == 1:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(boosting, "_round", breaking)
    with pytest.raises(RuntimeError, match="lost"):
        boosting.fit(df, NAMES, SMALL, folder=folder)
    again = boosting.fit(df, NAMES, SMALL, folder=folder)
    assert trained == [1, 2, 3, 4, 3, 4]
    assert again.model.to_text() == whole.model.to_text() and again.areas == whole.areas
    # A finished run is not trained again; other data are.
    assert boosting.fit(df, NAMES, SMALL, folder=folder).areas == whole.areas
    assert len(trained) == 6
    boosting.fit(df.where("key <> 7"), NAMES, SMALL, folder=folder)
    assert len(trained) == 10


def test_rows_that_are_gone_are_made_again(spark, tmp_path):
    df, folder = frame(spark, 400), str(tmp_path / "progress")
    whole = boosting.fit(df, NAMES, replace(SMALL, rounds=4))
    boosting.fit(df, NAMES, replace(SMALL, rounds=4), folder=folder)
    path = f"{folder}/state"
    record = json.loads(spark.read.text(path).first()["value"])
    record |= {"blocks": record["blocks"][:1], "areas": record["areas"][:2], "rows": "/nowhere"}
    artifacts.write_json_record(spark, record, path)
    again = boosting.fit(df, NAMES, replace(SMALL, rounds=4), folder=folder)
    assert again.model.to_text() == whole.model.to_text() and again.areas == whole.areas


def test_no_round_beyond_the_patience(spark, monkeypatch):
    areas = iter([0.5, 0.7, 0.6, 0.6, 0.65, 0.9, 0.9])
    monkeypatch.setattr(boosting, "_areas", lambda c, new: [next(areas) for _ in new])
    numbers = []
    real = boosting._round
    monkeypatch.setattr(boosting, "_round", lambda *a: numbers.append(a[2]) or real(*a))
    cfg = replace(SMALL, rounds=50, patience=3, leaves=2, block=10)
    fitted = boosting.fit(frame(spark, 300), NAMES, cfg)
    assert numbers == [1, 2, 3, 4, 5] and fitted.best_round == 2
    assert len(fitted.areas) == 5


def test_one_class_on_a_side_fails(spark):
    df = frame(spark, 100)
    for bad in (df.where("is_validation = 0"), df.withColumn("label", F.lit(1))):
        with pytest.raises(ValueError, match="both classes"):
            boosting.fit(bad, NAMES, SMALL)
    for wrong in ({"leaves": 1}, {"row_fraction": 0}, {"l1": -1}, {"rounds": 0}):
        with pytest.raises(ValueError):
            LeafwiseConfig(**wrong)


def test_features_with_clashing_names(spark):
    df = frame(spark, 400)
    odd = df.select("key", "label", "is_validation", F.col("a").alias("margin"),
                    F.col("b").alias("x"), F.col("c").alias("held.back"))
    found = boosting.fit(odd, ["margin", "x", "held.back"], replace(SMALL, feature_fraction=1.0))
    plain = boosting.fit(df, NAMES, replace(SMALL, feature_fraction=1.0))
    assert [t.feature for t in found.model.trees] == [t.feature for t in plain.model.trees]
    assert found.model.probabilities(odd).count() == 400


# -- trees as text and expressions -----------------------------------------------------------------


def test_text_and_sql_score_alike(spark, tmp_path):
    df = frame(spark, 500)
    model = boosting.fit(df, NAMES, SMALL).model
    trees.save_text(spark, model, str(tmp_path / "m"))
    back = trees.load_text(spark, str(tmp_path / "m"))
    assert back == model
    scored = back.probabilities(df).withColumn("by_sql", F.expr(model.sql()))
    assert scored.where("abs(score - by_sql) > 1e-12").count() == 0
    rows = df.select(*NAMES).toPandas()  # noqa: F841 read by name below
    import duckdb

    query = f"SELECT sum({model.sql(lambda n: n)}) FROM rows"
    other = duckdb.connect().execute(query).fetchone()[0]
    assert other == pytest.approx(scored.agg(F.sum("score")).first()[0])
    with pytest.raises(ValueError, match="not a"):
        trees.BoostedTrees.from_text("{}")


def test_ensembles_are_planned_in_parts(spark, monkeypatch):
    df = frame(spark, 300)
    model = boosting.fit(df, NAMES, SMALL).model
    whole = sorted(model.margins(df).select("key", "margin").collect())
    monkeypatch.setattr(trees, "TREES_AT_ONCE", 1)
    assert sorted(model.margins(df).select("key", "margin").collect()) == whole
    none = trees.BoostedTrees(NAMES, 0.25, [])
    assert {r["margin"] for r in none.margins(df).collect()} == {0.25}


def test_a_run_with_the_leafwise_booster(spark, tmp_path):
    cfg = RunConfig(boosting=replace(SMALL, feature_fraction=1.0, min_rows=10))
    features, folder = separable(spark), str(tmp_path / "m")
    result = runs.run(spark, features, folder, cfg, str(tmp_path / "out"))
    assert result.metrics["validation_auc"] > 0.95
    assert result.metrics["params"]["leaves"] == 6
    importance = result.importance.collect()
    assert importance[0].feature == "orders_12m" and importance[0].importance_gain > 0
    assert len(importance) == 4
    again = runs.score_only(spark, features, folder, cfg)
    assert sorted(map(str, again.collect())) == sorted(map(str, result.segments.collect()))
    assert artifacts.load_metadata(spark, folder) == result.metadata
    version = artifacts.trees_path(spark, folder).removesuffix("/trees")
    record = {**result.metadata.to_record(), "model_uid": "other", "model_text": True}
    artifacts.write_json_record(spark, record, f"{version}/prep_metadata")
    with pytest.raises(ValueError, match="other"):
        artifacts.load_model(spark, folder)


# -- queries ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["boost_bins", "boost_draws", "boost_gradient_sums",
                                  "boost_round"])
def test_queries_on_rows_enough_to_split(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    found = registry.QUERIES[name](spark, sf_dir)
    assert difference(found, duckdb_over(sf_dir), oracle.oracle_sql()[name]) is None
    if name == "boost_round":
        assert found.select("leaf_rows").distinct().count() > 3


def test_a_pass_finds_the_node_of_a_row_once(spark, monkeypatch):
    """A filter would be put below the projection and find it again."""
    tree = trees.Tree()
    for value in (0.0, -1.0, 1.0):
        tree.add(value, 2)
    tree.feature[0], tree.bin[0], tree.left[0], tree.right[0] = 0, 0, 1, 2
    rows = spark.createDataFrame(
        [([0, 3], [0, 3], 5, 7), ([1, 2], [1, 2], 11, 13), ([1, 3], [1, 3], 17, 19)],
        "x array<smallint>, all array<smallint>, g long, h long",
    )
    plans = []
    kind = type(rows)
    whole = kind.toArrow

    def told(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return whole(df)

    monkeypatch.setattr(kind, "toArrow", told)
    found = boosting.node_histograms(rows, tree, [2], 4)
    assert plans[0].count("aggregate(") == 1 and "Filter" not in plans[0]
    assert list(found) == [2]
    assert found[2][0, 1].tolist() == [28, 32, 2]
    assert found[2][1, 2].tolist() == [11, 13, 1] and found[2][1, 3].tolist() == [17, 19, 1]
    assert found[2].sum() == 2 * (28 + 32 + 2)
