"""Scoring feature maps with boosted-tree models.

Small models become plain Column expressions and run in generated code; larger
ones are evaluated by an Arrow-batched function that walks all rows of a batch
down each tree at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, StringType, StructField, StructType, VariantType

from barline.functions.columns import number
from barline.operators.features import parse_features

# Models of more nodes are evaluated in batches; the result is the same.
MAX_EXPRESSION_NODES = 400

# Fixed value of the published model format: |x| at most this counts as zero.
ZERO_THRESHOLD = 1e-35


@dataclass(frozen=True)
class Node:
    feature: str | None
    threshold: float | None
    default_left: bool
    left: int | None
    right: int | None
    leaf_value: float | None
    missing_type: str = "nan"


@dataclass(frozen=True)
class TreeModel:
    """An ensemble: trees as ``{node_id: Node}``, and the feature order."""

    path: str
    features: tuple[str, ...]
    trees: tuple[dict[int, Node], ...]
    objective: str = "regression"
    best_iteration: int | None = None
    average: bool = False

    def first(self, num_iteration: int | None) -> tuple[dict[int, Node], ...]:
        """Trees to use: the given number, else the best iteration, else all."""
        n = num_iteration or self.best_iteration
        return self.trees[:n] if n and n > 0 else self.trees


def load_models(trees: DataFrame, paths: Sequence[str] | None = None, *,
                best_iteration: dict[str, int] | None = None) -> list[TreeModel]:
    """Fetch models from a node table, a partition at a time. Models are what a
    caller names or a folder holds; they are kept on the driver and sent to tasks."""
    if paths is not None:
        trees = trees.where(F.col("model_path").isin(list(paths)))
    by_model: dict[str, dict[int, dict[int, Node]]] = {}
    extras: dict[str, dict] = {}
    for r in trees.toLocalIterator():
        d = r.asDict()
        node = Node(d["feature"], d["threshold"], bool(d["default_left"]), d["left"], d["right"], d["leaf_value"],
                    d.get("missing_type") or "nan")
        by_model.setdefault(d["model_path"], {}).setdefault(d["tree_id"], {})[d["node_id"]] = node
        extras.setdefault(d["model_path"], d)
    models = []
    for path in sorted(by_model):
        by_tree = by_model[path]
        listed = extras[path].get("features")
        used = sorted({n.feature for t in by_tree.values() for n in t.values() if n.feature is not None})
        models.append(TreeModel(path, tuple(listed or used), tuple(by_tree[t] for t in sorted(by_tree)),
                                extras[path].get("objective") or "regression",
                                (best_iteration or {}).get(path), bool(extras[path].get("average"))))
    return models


def _sql_number(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def tree_sql(tree: dict[int, Node], names: dict[str, str], node_id: int = 0) -> str:
    """One tree as a CASE expression over the columns in ``names``."""
    node = tree[node_id]
    if node.leaf_value is not None:
        return _sql_number(node.leaf_value)
    x = names[node.feature]
    left, right = (tree_sql(tree, names, child) for child in (node.left, node.right))
    below = f"{x} <= {_sql_number(node.threshold)}"
    if node.missing_type == "nan":
        test = f"{x} IS NULL OR {below}" if node.default_left else below
    elif node.missing_type == "zero":
        gone = f"{x} IS NULL OR abs({x}) <= {ZERO_THRESHOLD}"
        test = f"{gone} OR {below}" if node.default_left else f"NOT ({gone}) AND {below}"
    else:  # a missing value counts as zero
        test = f"coalesce({x}, 0) <= {_sql_number(node.threshold)}"
    return f"CASE WHEN {test} THEN {left} ELSE {right} END"


def model_sql(model: TreeModel, names: dict[str, str], num_iteration: int | None = None) -> str:
    """The sum over the trees as SQL text."""
    return " + ".join(f"({tree_sql(t, names)})" for t in model.first(num_iteration)) or "CAST(0 AS DOUBLE)"


def _averaged(total: Column, model: TreeModel, num_iteration: int | None) -> Column:
    """The raw score: the sum over the trees, or their mean in an averaged forest."""
    n = len(model.first(num_iteration))
    return total / F.lit(float(n)) if model.average and n else total


# Objectives whose score is the sum over the trees as it is.
IDENTITY = ("regression", "regression_l1", "l1", "l2", "mse", "mae", "huber", "fair", "quantile", "mape", "lambdarank",
            "rank_xendcg", "custom", "none")


def _link(raw: Column, model: TreeModel) -> Column:
    kind, *options = model.objective.split()
    settings = dict(o.split(":", 1) for o in options if ":" in o)
    if kind in ("binary", "cross_entropy"):
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.lit(float(settings.get("sigmoid", 1.0))) * raw))
    if kind in ("poisson", "gamma", "tweedie"):
        return F.exp(raw)
    if kind == "regression" and "sqrt" in options:
        return F.signum(raw) * raw * raw
    if kind == "cross_entropy_lambda":
        return F.log1p(F.exp(raw))
    if kind in IDENTITY:
        return raw
    raise ValueError(f"objective {kind!r} is not supported")


class Forest:
    """The trees of several models. A tree of not many more nodes than levels is
    evaluated node by node from its leaves up, each node for all rows at once. The
    others are packed as node arrays that the rows walk down: inner nodes and leaves
    in one run, children as absolute places, one root and depth per tree."""

    #: Rows taken together, so that their nodes and inputs stay in the cache.
    ROWS = 8192
    #: Nodes for each level of a tree above which walking it costs less.
    BROAD = 8

    def __init__(self, models: Sequence[TreeModel], columns: dict[str, int], num_iteration: int | None = None):
        kinds = {"none": 0, "zero": 1, "nan": 2}
        feature, threshold, default_left, left, right, value, missing = ([] for _ in range(7))
        self.trees: list[tuple[int, int, int, tuple | None]] = []  # model, root, depth, or its nodes from the leaves up
        for m, model in enumerate(models):
            for tree in model.first(num_iteration):
                depth = _depth(tree)
                if len(tree) <= self.BROAD * max(depth, 1):
                    self.trees.append((m, 0, depth, _upwards(tree, columns)))
                    continue
                at = {n: len(value) + i for i, n in enumerate(sorted(tree))}
                for n in sorted(tree):
                    node, leaf = tree[n], tree[n].leaf_value is not None
                    feature.append(0 if leaf else columns[node.feature])
                    threshold.append(math.inf if leaf else node.threshold)
                    default_left.append(leaf or node.default_left)
                    left.append(at[n] if leaf else at[node.left])
                    right.append(at[n] if leaf else at[node.right])
                    value.append(node.leaf_value if leaf else 0.0)
                    missing.append(2 if leaf else kinds[node.missing_type])
                self.trees.append((m, at[0], depth, None))
        self.models = len(models)
        self.feature, self.left, self.right = (np.array(x, np.int32) for x in (feature, left, right))
        self.threshold, self.value = np.array(threshold, float), np.array(value, float)
        self.default_left, self.missing = np.array(default_left, bool), np.array(missing, np.int8)
        self.plain = bool((self.missing == 2).all())  # only NaN is missing, everywhere

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Per row of ``x`` and model the sum over the model's trees, a tree at a time."""
        out = np.zeros((len(x), self.models))
        for a in range(0, len(x), self.ROWS):
            part = np.ascontiguousarray(x[a:a + self.ROWS])
            total = np.zeros((self.models, len(part)))
            by_feature = np.ascontiguousarray(part.T) if any(nodes is not None for *_, nodes in self.trees) else None
            flat, start = part.ravel(), np.arange(len(part), dtype=np.int64) * part.shape[1]
            for m, root, depth, nodes in self.trees:
                if nodes is not None:
                    total[m] += _evaluate(*nodes, by_feature)
                    continue
                node = np.full(len(part), root, np.int32)
                for _ in range(depth):
                    node = self._down(node, flat[start + self.feature[node]])
                total[m] += self.value[node]
            out[a:a + self.ROWS] = total.T
        return out

    def _down(self, node: np.ndarray, v: np.ndarray) -> np.ndarray:
        gone = np.isnan(v)
        if not self.plain:
            kind = self.missing[node]
            v = np.where(gone & (kind != 2), 0.0, v)
            gone = (gone & (kind == 2)) | ((kind == 1) & (np.abs(v) <= ZERO_THRESHOLD))
        go_left = v <= self.threshold[node]
        if gone.any():
            go_left = np.where(gone, self.default_left[node], go_left)
        return np.where(go_left, self.left[node], self.right[node])


def _upwards(tree: dict[int, Node], columns: dict[str, int]) -> tuple[list, np.ndarray]:
    """The inner nodes that can be reached, children before parents, with the columns they
    split; children are places of nodes, or ``~i`` for leaf ``i``. And the values of the leaves."""
    order, stack = [], [0]
    while stack:
        n = stack.pop()
        order.append(n)
        if tree[n].leaf_value is None:
            stack += [tree[n].left, tree[n].right]
    leaves = [n for n in order if tree[n].leaf_value is not None]
    inner = [n for n in reversed(order) if tree[n].leaf_value is None]
    at = {n: i for i, n in enumerate(inner)} | {n: ~i for i, n in enumerate(leaves)}
    nodes = [(tree[n], columns[tree[n].feature], at[tree[n].left], at[tree[n].right]) for n in inner]
    return nodes, np.array([tree[n].leaf_value for n in leaves], float)


def _evaluate(nodes: list, values: np.ndarray, by_feature: np.ndarray) -> np.ndarray | float:
    """A tree's value for each row; ``by_feature`` has a line of values per feature.
    Each node passes on the numbers of the leaves its rows come to."""
    number_of = np.min_scalar_type(len(values)).type
    made: list = []
    for node, column, *children in nodes:
        left, right = (made[c] if c >= 0 else number_of(~c) for c in children)
        made.append(_split(node, by_feature[column]).view(np.uint8) * (left ^ right) ^ right)
    return values[made[-1]] if made else values[0]


def _split(node: Node, v: np.ndarray) -> np.ndarray:
    """Which values go left. No comparison with NaN holds."""
    if node.missing_type == "zero":
        gone = np.isnan(v) | (np.abs(v) <= ZERO_THRESHOLD)
        return gone | (v <= node.threshold) if node.default_left else ~gone & (v <= node.threshold)
    left = node.default_left if node.missing_type == "nan" else 0.0 <= node.threshold
    if left and not math.isnan(node.threshold):
        return ~(v > node.threshold)
    return np.isnan(v) if left else v <= node.threshold


def _depth(tree: dict[int, Node]) -> int:
    stack, deepest = [(0, 0)], 0
    while stack:
        n, d = stack.pop()
        deepest = max(deepest, d)
        if tree[n].leaf_value is None:
            stack += [(tree[n].left, d + 1), (tree[n].right, d + 1)]
    return deepest


def _matrix(inputs, width: int) -> np.ndarray:
    """Rows of doubles from an Arrow array of lists of one length; NULL becomes NaN."""
    return inputs.flatten().to_numpy(zero_copy_only=False).reshape(len(inputs), width)


def _batch_sums(models: Sequence[TreeModel], inputs: Column, names: Sequence[str], num_iteration: int | None) -> Column:
    """An array with the raw sum of each model; ``inputs`` is an array of the values of ``names`` in order."""
    forest, width = Forest(models, {f: i for i, f in enumerate(names)}, num_iteration), len(names)

    @F.arrow_udf(ArrayType(DoubleType()))
    def score(batch):
        import pyarrow as pa

        total = forest.sums(_matrix(batch, width))
        return pa.ListArray.from_arrays(np.arange(len(total) + 1, dtype=np.int32) * forest.models, total.ravel())

    return score(inputs)


def missing_features(features: Column, model: TreeModel) -> Column:
    """The model features a map lacks."""
    wanted = F.array(*[F.lit(f) for f in model.features]).cast("array<string>")
    held = F.coalesce(F.map_keys(features), F.array().cast("array<string>"))
    return F.array_except(wanted, held)


def align_strict(df: DataFrame, model: TreeModel, features: str = "feature_map") -> DataFrame:
    """Adds ``skip_reason``: NULL when the row can be scored, else
    ``no_features`` or ``missing_features``. Nothing is filled in."""
    m = F.col(features)
    empty = m.isNull() | (F.size(m) == 0)
    lacks = F.size(missing_features(m, model)) > 0
    return df.withColumn("skip_reason", F.when(empty, "no_features").when(lacks, "missing_features"))


def align_lenient(df: DataFrame, expected: Sequence[str], fill: float | None = None, drop_extra: bool = True,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Wide rows in model order: missing columns filled (NULL by default),
    text coerced to numbers, other columns dropped."""
    have = set(df.columns)
    filled = F.lit(fill).cast("double")
    aligned = [(number(F.col(f"`{f}`")) if f in have else filled).alias(f) for f in expected]
    extra = [] if drop_extra else [F.col(f"`{c}`") for c in df.columns if c not in expected and c not in keep]
    return df.select(*[F.col(f"`{c}`") for c in keep], *aligned, *extra)


def _small(model: TreeModel, num_iteration: int | None, method: str) -> bool:
    if method not in ("auto", "expression", "batch"):
        raise ValueError(f"unknown scoring method {method!r}")
    used = sum(len(t) for t in model.first(num_iteration))
    return method == "expression" or (method == "auto" and used <= MAX_EXPRESSION_NODES)


def _score_inputs(df: DataFrame, inputs: Sequence[Column], model: TreeModel, out: str, num_iteration: int | None,
                  method: str) -> DataFrame:
    inputs = [number(c) for c in inputs]  # NaN is missing, however the model is evaluated
    if _small(model, num_iteration, method):
        names = {f: f"_x{i}" for i, f in enumerate(model.features)}
        staged = df.withColumns({names[f]: c for f, c in zip(model.features, inputs)})
        raw = _averaged(F.expr(model_sql(model, names, num_iteration)), model, num_iteration)
        return staged.withColumn(out, _link(raw, model)).drop(*names.values())
    packed = F.array(*inputs).cast("array<double>")
    raw = _averaged(_batch_sums([model], packed, model.features, num_iteration)[0], model, num_iteration)
    return df.withColumn("_raw", raw).withColumn(out, _link(F.col("_raw"), model)).drop("_raw")


def score_maps(df: DataFrame, model: TreeModel, features: str = "feature_map", *, out: str = "y_pred",
               num_iteration: int | None = None, method: str = "auto") -> DataFrame:
    """Add the score of each row's feature map; absent features are missing."""
    m = F.col(features)
    inputs = [F.try_element_at(m, F.lit(f)).cast("double") for f in model.features]
    return _score_inputs(df, inputs, model, out, num_iteration, method)


def score_wide(df: DataFrame, model: TreeModel, *, out: str = "y_pred", num_iteration: int | None = None,
               method: str = "auto") -> DataFrame:
    """Add the score of wide rows that hold all model features as columns."""
    inputs = [F.col(f"`{f}`").cast("double") for f in model.features]
    return _score_inputs(df, inputs, model, out, num_iteration, method)


def score_many(df: DataFrame, models: Iterable[TreeModel], features: str = "feature_map", *,
               num_iteration: int | None = None, method: str = "auto") -> DataFrame:
    """One row per input row and model that can score it: adds ``model_path``
    and ``y_pred``. The input is read once for all models."""
    models = list(models)
    staged, results = df, []
    for i, model in enumerate(models):
        staged = score_maps(staged, model, features, out=f"_y{i}", num_iteration=num_iteration, method=method)
        lacks = F.size(missing_features(F.col(features), model)) > 0
        results.append(F.when(~lacks, F.struct(F.lit(model.path).alias("model_path"), F.col(f"_y{i}").alias("y_pred"))))
    # A row without features lacks every feature, so it gives no element here.
    scored = staged.withColumn("_s", F.explode(F.array_compact(F.array(*results))))
    columns = [F.col(f"`{c}`") for c in df.columns if c not in ("model_path", "y_pred")]
    return scored.select(*columns, "_s.model_path", "_s.y_pred")


# Fixed value: where from_json tells that a field was of another type; no JSON object has it.
_BAD = "\0bad"


def _fields(names: Sequence[str], kind: DataType) -> StructType:
    """A JSON object's fields, and one that none has, so that the struct is never empty."""
    return StructType([StructField(n, kind) for n in (*names, "\0end")])


def _doubles(json: Column, names: Sequence[str]) -> Column:
    """``json`` parsed into a struct of doubles ``x0``, ``x1`` and so on, and ``bad``,
    the text itself where it is broken or a field is of another type."""
    # positional casts: names may differ in case only, or hold dots
    kinds = ", ".join([*(f"x{i}: double" for i in range(len(names))), "end: double", "bad: string"])
    fields = _fields(names, DoubleType()).add(_BAD, StringType())
    return F.from_json(json, fields, {"columnNameOfCorruptRecord": _BAD}).cast(f"struct<{kinds}>")


def _nulls_as_nan(json: Column) -> Column:
    """The text with NaN for null values. Inside of strings this changes only
    values that are no numbers and keys that hold a colon."""
    plain = F.replace(json, F.lit(":null"), F.lit(":NaN"))
    # A search for a text costs a fraction of its replacement, and most writers put no space there.
    return F.when(F.contains(json, F.lit(" null")), F.replace(plain, F.lit(": null"), F.lit(":NaN"))).otherwise(plain)


def score_json(df: DataFrame, models: Iterable[TreeModel], json: str = "features", *, strict: bool = True,
               num_iteration: int | None = None, method: str = "auto") -> DataFrame:
    """One row per input row and model: adds ``model_path`` and ``y_pred``.

    The text of column ``json`` is parsed once, into one struct of all features
    that any of the models uses; models above MAX_EXPRESSION_NODES share one
    transfer to Python. A null or NaN value is a missing one. With ``strict`` a
    model gives no row where one of its features is absent or is no number;
    else such a feature counts as missing. Null values are read as NaN there, so
    that only rows with such a feature are read again, to tell which it is.
    """
    models = list(models)
    names = list(dict.fromkeys(f for m in models for f in m.features))
    place = {f: f"x{i}" for i, f in enumerate(names)}
    if strict and not any(":" in f for f in names):
        staged = df.withColumn("_q", _doubles(_nulls_as_nan(F.col(json)), names))
        staged = staged.withColumn("_d", F.when(F.col("_q.bad").isNull(), F.col("_q")).otherwise(_doubles(F.col(json), names)))
    else:
        staged = df.withColumn("_d", _doubles(F.col(json), names))
    if strict:
        gaps = F.greatest(F.lit(False), F.lit(False), *[F.col(f"_d.{p}").isNull() for p in place.values()])
        variants = ", ".join(f"{p}: variant" for p in place.values())
        staged = staged.withColumn("_v", F.when(F.col("_d").isNull() | gaps, F.from_json(json, _fields(names, VariantType())).cast(
            f"struct<{variants}{', ' * bool(names)}end: variant>")))
        # the features a row lacks, as a set of their places; empty for most rows
        lacking = F.when(F.col("_v").isNotNull() | F.col("_d").isNull(), F.array_compact(F.array(*[
            F.when(F.col(f"_d.{p}").isNull() & ~F.coalesce(F.is_variant_null(F.col(f"_v.{p}")), F.lit(False)), F.lit(i))
            for i, p in enumerate(place.values())]).cast("array<int>")))
        staged = staged.withColumn("_lacks", lacking)
    large = [m for m in models if not _small(m, num_iteration, method)]
    if large:
        staged = staged.withColumn("_sums", _batch_sums(
            large, F.array(*[F.col(f"_d.{p}") for p in place.values()]).cast("array<double>"), names, num_iteration))
    index = {f: i for i, f in enumerate(names)}
    columns = {f: f"nanvl(_d.{p}, cast(null as double))" for f, p in place.items()}
    small = {m.path: F.expr(model_sql(m, {f: f"_{place[f]}" for f in names}, num_iteration)) for m in models if m not in large}
    if small:
        used = {f for m in models if m not in large for f in m.features}
        staged = staged.withColumns({f"_{place[f]}": F.expr(columns[f]) for f in names if f in used})
    results = []
    for m in models:
        raw = F.col("_sums")[large.index(m)] if m in large else small[m.path]
        made = F.struct(F.lit(m.path).alias("model_path"), _link(_averaged(raw, m, num_iteration), m).alias("y_pred"))
        if strict:
            own = F.array(*[F.lit(index[f]) for f in m.features]).cast("array<int>")
            made = F.when(F.col("_lacks").isNull() | ~F.arrays_overlap(F.col("_lacks"), own), made)
        results.append(made)
    scored = staged.withColumn("_s", F.explode(F.array_compact(F.array(*results))))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("model_path", "y_pred")]
    return scored.select(*kept, "_s.model_path", "_s.y_pred")


def with_feature_map(df: DataFrame, json: str = "features", out: str = "feature_map") -> DataFrame:
    return df.withColumn(out, parse_features(json))
