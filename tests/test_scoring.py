from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.operators import scoring as sc
from barline.plans.files import NoOverlap, load_model_file, merge_and_score_files, score_file, score_frame
from barline.sources.models import latest_model, read_model_trees

MODEL = """tree
version=v4
num_class=1
num_tree_per_iteration=1
label_index=0
max_feature_idx=2
objective={objective}
feature_names=a b c
feature_infos=none none none

Tree=0
num_leaves=3
num_cat=0
split_feature=0 1
split_gain=1 1
threshold=0.5 1.5
decision_type={kind} {kind}
left_child=1 -1
right_child=-3 -2
leaf_value=1 2 3
leaf_weight=1 1 1
shrinkage=1

Tree=1
num_leaves=1
num_cat=0
split_feature=
threshold=
decision_type=
left_child=
right_child=
leaf_value=0.25
shrinkage=1

end of trees

feature_importances:
a=1
"""


def write_model(folder, kind=10, objective="regression"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "model.txt").write_text(MODEL.format(kind=kind, objective=objective))
    return str(folder)


def wide(spark, rows):
    return spark.createDataFrame(rows, "id int, a double, b double, c double")


def scores(df):
    return [r.y_pred for r in df.orderBy("id").collect()]


ROWS = [(0, 0.5, 1.0, 0.0), (1, 0.5, 2.0, 0.0), (2, 0.6, 0.0, 0.0), (3, None, 1.0, 0.0), (4, 0.1, None, 0.0)]


@pytest.mark.parametrize("method", ["expression", "batch"])
@pytest.mark.parametrize("kind,missing", [
    (10, [1.25, 2.25, 3.25, 1.25, 1.25]),   # missing goes left
    (8, [1.25, 2.25, 3.25, 3.25, 2.25]),    # missing goes right
    (0, [1.25, 2.25, 3.25, 1.25, 1.25]),    # missing counts as zero
    (4, [1.25, 2.25, 3.25, 3.25, 2.25]),    # zero is missing, right
])
def test_missing_directions(spark, tmp_path, method, kind, missing):
    model = load_model_file(spark, write_model(tmp_path / f"k{kind}", kind))
    assert model.features == ("a", "b", "c")
    assert scores(sc.score_wide(wide(spark, ROWS), model, method=method)) == missing


def test_iterations_and_link(spark, tmp_path):
    model = load_model_file(spark, write_model(tmp_path / "m", objective="binary sigmoid:1"))
    got = scores(sc.score_wide(wide(spark, ROWS), model, num_iteration=1))
    assert np.allclose(got, 1 / (1 + np.exp(-np.array([1.0, 2.0, 3.0, 1.0, 1.0]))))


def test_both_methods_agree_on_a_random_forest(spark):
    rng = np.random.default_rng(0)
    nodes = []
    for tree in range(20):
        for n in range(7):
            nodes.append(("m", tree, n, f"f{rng.integers(0, 5)}", float(rng.normal()), bool(rng.integers(0, 2)), 2 * n + 1, 2 * n + 2, None))
        nodes += [("m", tree, n, None, None, None, None, None, float(rng.normal())) for n in range(7, 15)]
    trees = spark.createDataFrame(nodes, "model_path string, tree_id int, node_id int, feature string, threshold double, "
                                  "default_left boolean, left int, right int, leaf_value double")
    model = sc.load_models(trees)[0]
    maps = spark.range(500).select("id", F.map_from_arrays(
        F.array(*[F.lit(f"f{i}") for i in range(5)]),
        F.array(*[F.when(F.rand(i) > 0.2, F.randn(i)) for i in range(5)])).alias("feature_map"))
    both = sc.score_maps(sc.score_maps(maps, model, out="x", method="expression"), model, out="y", method="batch")
    worst = both.agg(F.max(F.abs(F.col("x") - F.col("y")))).first()[0]
    assert worst < 1e-12


ODD = [("nan", float("nan")), ("inf", float("inf")), ("low", float("-inf")), ("null", None), ("one", 1.0)]


@pytest.mark.parametrize("method", ["expression", "batch"])
def test_nan_is_missing_however_a_model_is_evaluated(spark, method):
    stump = spark.createDataFrame([("m", 0, 0, "a", 0.0, True, 1, 2, None), ("m", 0, 1, None, None, None, None, None, -1.0),
                                   ("m", 0, 2, None, None, None, None, None, 1.0)],
                                  "model_path string, tree_id int, node_id int, feature string, threshold double, "
                                  "default_left boolean, left int, right int, leaf_value double")
    model = sc.load_models(stump)[0]
    wide = spark.createDataFrame(ODD, "id string, a double")
    maps = wide.withColumn("feature_map", F.create_map(F.lit("a"), F.col("a")))
    want = {"nan": -1.0, "inf": 1.0, "low": -1.0, "null": -1.0, "one": 1.0}
    assert {r.id: r.y_pred for r in sc.score_wide(wide, model, method=method).collect()} == want
    assert {r.id: r.y_pred for r in sc.score_maps(maps, model, method=method).collect()} == want


def test_averaged_forest_and_objectives(spark):
    leaf = {0: sc.Node(None, None, True, None, None, 2.0)}
    one = spark.createDataFrame([(1,)], "id int")
    for method in ("expression", "batch"):
        def score(objective="regression", average=False):
            model = sc.TreeModel("m", (), (leaf, leaf), objective, average=average)
            return sc.score_wide(one, model, method=method).first().y_pred

        assert (score(), score(average=True)) == (4.0, 2.0)
        assert score("cross_entropy_lambda") == pytest.approx(np.log1p(np.exp(4.0)))
        for unknown in ("multiclass num_class:3", "no_such_objective"):
            with pytest.raises(ValueError):
                score(unknown)


def test_strict_skips_lenient_fills(spark, tmp_path):
    model = load_model_file(spark, write_model(tmp_path / "m"))
    rows = spark.createDataFrame([(0, '{"a":0.1,"b":2,"c":null,"z":9}'), (1, '{"a":0.1,"b":2}'), (2, "{}"), (3, "{bad"), (4, None)],
                                 "id int, features string")
    maps = sc.with_feature_map(rows)
    strict = sc.align_strict(maps, model).orderBy("id").collect()
    assert [r.skip_reason for r in strict] == [None, "missing_features", "no_features", "no_features", "no_features"]
    assert [(r.id, r.y_pred) for r in sc.score_many(maps, [model]).collect()] == [(0, 2.25)]
    text = spark.createDataFrame([(0, "0.1", "x", "extra")], "id int, a string, b string, z string")
    assert score_frame(text, model, id_column="id").collect() == [(0, 1.25)]
    assert score_frame(text, model, id_column="id", merge_input=True).columns == ["id", "y_pred", "a", "b", "z"]
    filled = sc.align_lenient(text, ["b", "a", "q"], fill=-1.0).first()
    assert filled.asDict() == {"b": None, "a": 0.1, "q": -1.0}


def test_newest_model_wins(spark, tmp_path):
    import os

    for i, name in enumerate(["run_b", "run_a", "run_c"]):
        folder = write_model(tmp_path / "root" / name)
        os.utime(folder + "/model.txt", (1000 + i, 1000 + i))
    root = str(tmp_path / "root")
    assert latest_model(spark, root).endswith("run_c/model.txt")
    assert latest_model(spark, root, root + "/run_a").endswith("run_a/model.txt")
    assert latest_model(spark, root, root + "/run_a/model.txt").endswith("run_a/model.txt")
    assert read_model_trees(spark, root).select("model_path").distinct().count() == 3
    os.rename(root + "/run_b/model.txt", root + "/run_b/model.lgb")
    os.rename(root + "/run_a/model.txt", root + "/run_a/other.name")
    assert latest_model(spark, root + "/run_b", root + "/run_b").endswith("model.lgb")
    assert latest_model(spark, root, root + "/run_a/other.name").endswith("run_a/other.name")
    assert read_model_trees(spark, root).select("model_path").distinct().count() == 2
    assert read_model_trees(spark, root + "/run_a/other.name").count() > 0
    write_model(tmp_path / "deep" / "x" / "y")
    assert latest_model(spark, str(tmp_path / "deep")).endswith("x/y/model.txt")
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception):
        latest_model(spark, str(tmp_path / "empty"))


def test_merge_and_score_files(spark, tmp_path):
    model = load_model_file(spark, write_model(tmp_path / "m"))
    (tmp_path / "cur_1.csv").write_text("time,a,b\n2024-01-01,0.1,2\n2024-01-02,0.9,2\n2024-01-03,0.1,1\n")
    (tmp_path / "norm_1.csv").write_text("when,b,c\n2024-01-01,0,7\n2024-01-03,9,7\n")
    args = (spark, str(tmp_path), "cur_*.csv", "norm_*.csv", model)
    got = {r.timestamp.day: r.y_pred for r in merge_and_score_files(*args, "2024-01-01").collect()}
    assert got == {1: 2.25, 3: 1.25}
    other = {r.timestamp.day: r.y_pred for r in merge_and_score_files(*args, "2024-01-01", "2024-01-02", "norm").collect()}
    assert other == {1: 1.25}
    with pytest.raises(NoOverlap):
        merge_and_score_files(*args, "2025-01-01")


def test_score_file(spark, tmp_path):
    model = load_model_file(spark, write_model(tmp_path / "m"))
    (tmp_path / "in.csv").write_text("timestamp,b,a\n2024-01-01,2,0.1\n2024-01-02,oops,0.9\n")
    out = str(tmp_path / "out")
    score_file(spark, str(tmp_path / "in.csv"), model, out, id_column="timestamp")
    back = spark.read.option("header", "true").csv(out)
    assert back.columns == ["timestamp", "y_pred"]
    assert sorted((r.timestamp, float(r.y_pred)) for r in back.collect()) == [("2024-01-01", 2.25), ("2024-01-02", 3.25)]


def forest(spark, name, n_trees, n_features, seed, kinds=("nan",), average=False, objective="regression"):
    """A random model of depth 3, and its trees for a walk row by row."""
    rng = np.random.default_rng(seed)
    trees = []
    for _ in range(n_trees):
        tree = {n: sc.Node(f"f{rng.integers(n_features)}", float(rng.normal()), bool(rng.integers(2)), 2 * n + 1, 2 * n + 2, None,
                           str(rng.choice(kinds))) for n in range(7)}
        trees.append(tree | {n: sc.Node(None, None, False, None, None, float(rng.integers(-64, 64)) / 32) for n in range(7, 15)})
    return sc.TreeModel(name, tuple(f"f{i}" for i in range(n_features)), tuple(trees), objective, average=average)


def walk(model, values):
    total = 0.0
    for tree in model.trees:
        node = tree[0]
        while node.leaf_value is None:
            v = values.get(node.feature)
            if node.missing_type == "nan":
                left = node.default_left if v is None else v <= node.threshold
            elif node.missing_type == "zero":
                left = node.default_left if v is None or abs(v) <= sc.ZERO_THRESHOLD else v <= node.threshold
            else:
                left = (v or 0.0) <= node.threshold
            node = tree[node.left if left else node.right]
        total += node.leaf_value
    return total / len(model.trees) if model.average else total


@pytest.mark.parametrize("kinds", [("nan",), ("nan", "zero", "none")])
def test_json_of_many_features_and_trees(spark, kinds):
    rng = np.random.default_rng(3)
    many, few = forest(spark, "many", 300, 500, 1, kinds), forest(spark, "few", 4, 30, 2, kinds, average=True)
    rows = []
    for i in range(60):
        held = {f"f{k}": None if rng.random() < 0.1 else (0.0 if rng.random() < 0.1 else float(rng.normal())) for k in range(500)}
        rows.append((i, json.dumps(held), held))
    df = spark.createDataFrame([r[:2] for r in rows], "id int, features string")
    made = sc.score_json(df, [many, few])
    got = {(r.id, r.model_path): r.y_pred for r in made.collect()}
    assert got == {(i, m.path): pytest.approx(walk(m, held)) for i, _, held in rows for m in (many, few)}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") <= 3 and plan.count("ArrowEvalPython") == 1  # values, and variants where a value is NULL
    assert "element_at" not in plan and "map<string" not in plan


ODD_JSON = [
    ("ok", '{"a":1,"b":2,"c":"text"}', 3.0, 3.0), ("null", '{"a":null,"b":2}', 2.0, 2.0), ("absent", '{"b":2}', None, 2.0),
    ("nan", '{"a":NaN,"b":2}', 2.0, 2.0), ("text", '{"a":"1","b":2}', None, 2.0), ("nested", '{"a":{"b":1},"b":2}', None, 2.0),
    ("broken", '{"a":1,', None, 0.0), ("list", "[1]", None, 0.0), ("empty", "{}", None, 0.0), ("none", None, None, 0.0), ("blank", "", None, 0.0),
    ("case", '{"A":9,"a":1,"b":2}', 3.0, 3.0), ("twice", '{"a":1,"a":5,"b":2}', 7.0, 7.0)]


@pytest.mark.parametrize("method", ["expression", "batch"])
def test_odd_json(spark, method):
    """A model that adds a and b, by thresholds at whole numbers; a missing value adds nothing."""
    def count(name):
        return tuple({0: sc.Node(name, k + 0.5, True, 1, 2, None), 1: sc.Node(None, None, False, None, None, 0.0),
                      2: sc.Node(None, None, False, None, None, 1.0)} for k in range(10))

    model = sc.TreeModel("sum", ("a", "b"), count("a") + count("b"))
    df = spark.createDataFrame([r[:2] for r in ODD_JSON], "id string, features string")
    strict = {r.id: r.y_pred for r in sc.score_json(df, [model], method=method).collect()}
    assert strict == {i: y for i, _, y, _ in ODD_JSON if y is not None}
    loose = {r.id: r.y_pred for r in sc.score_json(df, [model], method=method, strict=False).collect()}
    assert loose == {i: y for i, _, _, y in ODD_JSON}


def test_feature_names_that_differ_in_case_or_hold_dots(spark):
    names = ("x.y", "X.Y", "a b", "`q`")
    tree = {0: sc.Node("X.Y", 1.0, True, 1, 2, None), 1: sc.Node(None, None, False, None, None, -1.0), 2: sc.Node(None, None, False, None, None, 1.0)}
    df = spark.createDataFrame([(1, '{"x.y":0,"X.Y":5,"a b":1,"`q`":2}'), (2, '{"x.y":5,"X.Y":0,"a b":1,"`q`":2}'), (3, '{"x.y":5}')], "id int, features string")
    for method in ("expression", "batch"):
        got = {r.id: r.y_pred for r in sc.score_json(df, [sc.TreeModel("m", names, (tree,))], method=method).collect()}
        assert got == {1: 1.0, 2: -1.0}


@pytest.mark.parametrize("method", ["expression", "batch"])
def test_nulls_in_strings_keys_and_twice(spark, method):
    """Null values are told from other ones whatever else the text holds."""
    def model(*names):
        split = {0: sc.Node(names[0], 0.5, True, 1, 2, None), 1: sc.Node(None, None, False, None, None, 0.0),
                 2: sc.Node(None, None, False, None, None, 1.0)}
        return sc.TreeModel("m", names, (split,))

    texts = {"spaced": '{"a": null,"b" :\tnull}', "string": '{"a":1,"b":2,"s":"x:null,\\": null}"}', "key": '{"a":1,"b:null":3,"b": 2}',
             "only in a key": '{"a":1,"b:null":null}', "null, then text": '{"a":null,"a":"x","b":1}', "text, then null": '{"a":"x","a":null,"b":1}',
             "inside": '{"a":{"b":null},"b":1}', "text of null": '{"a":":null","b":1}', "cut": '{"a":null,"b":null'}
    df = spark.createDataFrame(list(texts.items()), "id string, features string")
    got = {r.id: r.y_pred for r in sc.score_json(df, [model("a", "b")], method=method).collect()}
    assert got == {"spaced": 0.0, "string": 1.0, "key": 1.0, "text, then null": 0.0}
    colon = spark.createDataFrame([(1, '{"a:NaN":1,"b":1}'), (2, '{"a:null":1,"b":1}')], "id int, features string")
    assert [r.id for r in sc.score_json(colon, [model("a:NaN", "b")], method=method).collect()] == [1]


def test_null_values_cost_no_second_parse(spark):
    """Only rows that lack a feature are parsed again, into variants."""
    df = spark.createDataFrame([(1, '{"a":null,"b": null}'), (2, '{"a":1,"b":null}')], "id int, features string")
    plan = sc.score_json(df, [forest(spark, "m", 2, 3, 1)])._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(replace(features" in plan and "exists(" not in plan


def test_wide_query_deals_rows_out(spark, tmp_path):
    from suite import queries

    orders = [(i, i % 7 if i % 5 else None) for i in range(64)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    made = queries()["M3_score_many_trees"](spark, str(tmp_path))
    placed = made.select("o_orderkey", F.spark_partition_id().alias("p")).collect()
    assert sorted(r.o_orderkey for r in placed) == [i for i, c in orders if c is not None]
    assert len({r.p for r in placed}) > 4


def test_small_trees_node_by_node_sum_to_the_same_bits(spark):
    """However a tree is evaluated, and whatever the values: nothing depends on its shape."""
    rng = np.random.default_rng(7)
    odd = [0.0, -0.0, 1e-36, -1e-36, 1.0, float("inf"), float("-inf"), float("nan")]

    def tree(depth):
        nodes = {}
        for n in range(2 ** (depth + 1) - 1):
            if n >= 2 ** depth - 1 or (n and rng.random() < 0.1):
                nodes[n] = sc.Node(None, None, False, None, None, float(rng.normal()))
            else:
                nodes[n] = sc.Node(f"f{rng.integers(0, 4)}", float(rng.choice([*odd, rng.normal()])), bool(rng.integers(0, 2)),
                                   2 * n + 1, 2 * n + 2, None, str(rng.choice(["nan", "zero", "none"])))
        return nodes

    class Walked(sc.Forest):
        BROAD = 0

    columns = {f"f{i}": i for i in range(4)}
    models = [sc.TreeModel("m", tuple(columns), tuple(tree(d) for d in depths)) for depths in ([0, 1, 2, 3, 3, 8], [], [3, 0, 4])]
    x = np.where(rng.random((300, 4)) < 0.5, rng.choice(odd, (300, 4)), rng.normal(size=(300, 4)))
    mixed, walked = sc.Forest(models, columns), Walked(models, columns)
    assert [nodes is None for *_, nodes in mixed.trees] == [False] * 5 + [True] + [False] * 3
    assert all(nodes is None for *_, nodes in walked.trees)
    assert (mixed.sums(x).view(np.int64) == walked.sums(x).view(np.int64)).all()


def test_spaced_nulls_are_only_replaced_where_there_are_any(spark):
    df = spark.createDataFrame([(1, '{"a":null,"b":1}'), (2, '{"a": null, "b":null}'), (3, None)], "id int, features string")
    got = df.select("id", sc._nulls_as_nan(F.col("features")).alias("t"))
    assert [r.t for r in got.orderBy("id").collect()] == ['{"a":NaN,"b":1}', '{"a":NaN, "b":NaN}', None]
    assert "Contains" in got._jdf.queryExecution().optimizedPlan().toString()


def test_wide_query_scores_whole_texts_made_in_generated_code(spark, tmp_path):
    from suite import queries

    orders = [(7, 3), (150001, 14), (-12, 5), (10 ** 12, 999), (8, None), (None, 8)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))

    def score(k, c):
        total = 0.0
        for t in range(300):
            n = 0
            while n < 7:
                v = int(np.fmod(k * 31 + (t * 7 + n) % 500 * 17 + c, 1009))
                left = (t + n) % 2 == 0 if v % 11 == 0 else v <= (t * 37 + n * 101) % 997
                n = 2 * n + (1 if left else 2)
            total += ((t * 13 + n * 29) % 201 - 100) / 64
        return total

    made = queries()["M3_score_many_trees"](spark, str(tmp_path))
    assert {r.o_orderkey: r.y_pred for r in made.collect()} == {k: score(k, c) for k, c in orders if None not in (k, c)}
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan  # a function over an array is interpreted, a value at a time
