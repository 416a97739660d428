"""Fitted pipelines as column expressions, so that a recursive forecast stays one projection.

A tree model becomes flat arrays of nodes, held as one constant; a fold over the tree's depth walks from the root to a leaf.
No Python runs per row, and no vector is assembled: a series' flag is compared with its number.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.operators.features import FEATURES
from storecast.session import scratch_path

#: Nodes of a model that is still held as a constant: 200,000 are some 20 MB in each plan.
MOST_NODES = 200_000
INDEX = "series_index"


class ColumnModel:
    """A pipeline of `feature_stages` and a regressor as a predictor: named feature columns to a prediction.

    The expression reads the column `series_index`, which `context` holds for every series of the model. A series that
    the model does not know is an error, as in the pipeline.
    """

    def __init__(self, model: PipelineModel, series: str = "series"):
        self.model, self.series = model, series
        self.labels = list(model.stages[0].labels)
        last = model.stages[-1]
        if isinstance(last, LinearRegressionModel):
            self.weights, self.start = [float(c) for c in last.coefficients], float(last.intercept)
        else:
            self._read_trees(last)

    @staticmethod
    def fits(model: PipelineModel) -> bool:
        """Whether the pipeline can be written as columns: a linear or tree model that is not too large."""
        last = model.stages[-1]
        if isinstance(last, (GBTRegressionModel, RandomForestRegressionModel)):
            return last.totalNumNodes <= MOST_NODES
        return isinstance(last, LinearRegressionModel)

    def context(self, spark) -> DataFrame:
        """(series, series_index), one row per series of the model."""
        rows = [(label, i) for i, label in enumerate(self.labels)]
        return spark.createDataFrame(rows, f"`{self.series}` string, {INDEX} int")

    def _read_trees(self, last) -> None:
        """Nodes from the model's own stored form; they are as many as the model on the driver has."""
        from pyspark.sql import SparkSession

        spark = SparkSession.active()
        path = scratch_path(spark, "trees")
        last.write().save(path)
        rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
        first = {}
        for place, r in enumerate(rows):
            first.setdefault(r.treeID, place)
        self.nodes = {k: [] for k in ("feature", "cut", "left", "right", "value")}
        depth = [0] * len(rows)
        for place, r in enumerate(rows):
            left, right, cut = r.leftChild, r.rightChild, 0.0
            if left >= 0:
                left, right = left + first[r.treeID], right + first[r.treeID]
                depth[left] = depth[right] = depth[place] + 1
                cut = r.split.leftCategoriesOrThreshold[0] if r.split.leftCategoriesOrThreshold else 0.0
                if r.split.numCategories == 2:  # a flag: the categories that go left are 0, or 1
                    left, right = (right, left) if cut == 1.0 else (left, right)
                    cut = 0.5
                elif r.split.numCategories > 2:
                    raise ValueError("splits over more than two categories are not supported")
            found = (r.split.featureIndex if r.leftChild >= 0 else -1, cut, left, right, r.prediction)
            for k, v in zip(self.nodes, found):
                self.nodes[k].append(v)
        weights = [float(w) for w in last.treeWeights]
        if isinstance(last, RandomForestRegressionModel):
            weights = [w / len(weights) for w in weights]
        self.roots = list(zip(first.values(), weights))
        self.depth = max(depth, default=0)

    def __call__(self, features: dict[str, Column]) -> Column:
        own = F.coalesce(F.col(INDEX), F.raise_error(F.lit("a series is not in the model")).cast("int"))
        base = [features[f].cast("double") for f in FEATURES]
        if isinstance(self.model.stages[-1], LinearRegressionModel):
            flags = _constant(self.weights[len(base) :], "array<double>")
            return sum((F.lit(w) * x for w, x in zip(self.weights, base)), F.lit(self.start) + F.get(flags, own))
        kinds = {"cut": "array<double>", "value": "array<double>"}
        nodes = {k: _constant(v, kinds.get(k, "array<int>")) for k, v in self.nodes.items()}
        roots = _constant([{"at": a, "weight": w} for a, w in self.roots], "array<struct<at:int,weight:double>>")

        def step(at: Column, x: Column) -> Column:
            feature = F.get(nodes["feature"], at)
            flag = F.when(feature - len(base) == own, F.lit(1.0)).otherwise(F.lit(0.0))
            value = F.when(feature < len(base), F.get(x, feature)).otherwise(flag)
            further = F.when(value <= F.get(nodes["cut"], at), F.get(nodes["left"], at))
            return F.when(feature < 0, at).otherwise(further.otherwise(F.get(nodes["right"], at)))

        def walked(x: Column) -> Column:
            def leaf(root: Column) -> Column:
                levels = F.sequence(F.lit(1), F.lit(self.depth))
                return F.aggregate(levels, root, lambda at, _: step(at, x)) if self.depth else root

            return F.aggregate(
                roots, F.lit(0.0), lambda acc, r: acc + r["weight"] * F.get(nodes["value"], leaf(r["at"]))
            )

        # A one-element array binds the features once for all trees.
        return F.transform(F.array(F.array(*base)), walked)[0]


def _constant(values: list, kind: str) -> Column:
    """An array literal of any length: text that is parsed once, when the plan is optimized."""
    return F.from_json(F.lit(json.dumps(values)), kind)
