"""Boosted-tree models as a table of nodes.

``model_trees`` columns: ``model_path, tree_id, node_id, feature, threshold,
default_left, left, right, leaf_value``. Node 0 is the root of each tree; an
inner node has a feature and children, a leaf has a value.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.sources.files import latest_file

MODEL_FILES = "{model.txt,model.lgb,lgbm_model.txt}"
TREE_SCHEMA = (
    "model_path string, tree_id int, node_id int, feature string, threshold double, default_left boolean, "
    "left int, right int, leaf_value double, missing_type string, objective string, features array<string>, "
    "average boolean"
)
_MISSING = {0: "none", 1: "zero", 2: "nan"}


def _is_file(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(target) and fs.getFileStatus(target).isFile())


def latest_model(spark: SparkSession, root: str, model_path: str | None = None) -> str:
    """The model file to use: an explicit file of any name or a run folder wins,
    else the newest model file one folder below ``root``, else the newest
    anywhere. Model files are named ``model.txt``, ``model.lgb`` or
    ``lgbm_model.txt``."""
    if model_path is not None:
        return latest_file(spark, model_path, "*" if _is_file(spark, model_path) else MODEL_FILES)
    try:
        return latest_file(spark, root.rstrip("/") + "/*/", MODEL_FILES)
    except (FileNotFoundError, AnalysisException):  # no such folder level, or no model on it
        return latest_file(spark, root, MODEL_FILES, recursive=True)


def _section(text: str) -> dict[str, str]:
    pairs = (line.split("=", 1) for line in text.splitlines() if "=" in line)
    return {k.strip(): v.strip() for k, v in pairs}


def _nodes(path: str, text: str) -> Iterator[tuple]:
    """Node rows of one model in the published text format."""
    body = text.split("end of trees", 1)[0]
    head, *trees = body.split("\nTree=")
    meta = _section(head)
    names = meta["feature_names"].split()
    common = (meta.get("objective", "regression"), names, "average_output" in (line.strip() for line in head.splitlines()))
    for tree in trees:
        number, rest = tree.split("\n", 1)
        part = _section(rest)
        if int(part.get("num_cat", "0")) > 0 or int(part.get("is_linear", "0")) > 0:
            raise ValueError(f"{path}: categorical splits and linear leaves are not supported")
        values = [float(v) for v in part["leaf_value"].split()]
        inner = len(values) - 1

        def number_of(child: str) -> int:
            c = int(child)
            return c if c >= 0 else inner + (~c)

        if inner > 0:
            split = [part[k].split() for k in
                     ("split_feature", "threshold", "decision_type", "left_child", "right_child")]
            for i, (f, t, d, left, right) in enumerate(zip(*split)):
                kind = int(d)
                yield (path, int(number), i, names[int(f)], float(t), bool(kind & 2), number_of(left),
                       number_of(right), None, _MISSING[(kind >> 2) & 3], *common)
        for i, v in enumerate(values):
            yield (path, int(number), inner + i, None, None, None, None, None, v, None, *common)


def read_model_trees(spark: SparkSession, root: str) -> DataFrame:
    """Node rows of every model file under ``root``, or of the one file that
    ``root`` is; one file per row, parsed in parallel."""
    columns = [f.split()[0] for f in TREE_SCHEMA.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = list(_nodes(path, bytes(content).decode("utf-8")))
                out = pd.DataFrame(rows, columns=columns)
                for c in ("node_id", "tree_id", "left", "right"):
                    out[c] = out[c].astype("Int32")
                yield out

    pattern = "*" if _is_file(spark, root) else MODEL_FILES
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(root).select("path", "content"))
    return files.mapInPandas(parse, TREE_SCHEMA)


def feature_names(trees: DataFrame) -> DataFrame:
    """The ordered feature names each model expects: ``model_path, features``."""
    if "features" in trees.columns:
        return trees.groupBy("model_path").agg(F.max("features").alias("features"))
    used = trees.where(F.col("feature").isNotNull())
    return used.groupBy("model_path").agg(F.array_sort(F.collect_set("feature")).alias("features"))
