"""Boosted trees as data: a text that any reader can load, Spark expressions, and SQL."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.functions.expr import ident, quoted

FORMAT = "boosted-trees-1"
TREES_AT_ONCE = 50  # trees of one projection: larger expressions take long to plan


@dataclass
class Tree:
    """Nodes in arrays; node 0 is the root, a leaf has no feature (-1).

    A row goes left where its feature is at most the threshold. ``bin`` is the threshold among the
    bins the tree was grown on; ``gain`` and ``rows`` are those of training.
    """

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)

    def add(self, value: float, rows: int) -> int:
        for name, x in (("feature", -1), ("threshold", 0.0), ("bin", -1), ("left", -1),
                        ("right", -1), ("value", value), ("gain", 0.0), ("rows", rows)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    @property
    def depth(self) -> int:
        """Splits on the longest way; children always follow their parent."""
        at = [0] * len(self.feature)
        for i, f in enumerate(self.feature):
            if f >= 0:
                at[self.left[i]] = at[self.right[i]] = at[i] + 1
        return max(at, default=0)

    @property
    def leaves(self) -> int:
        return sum(f < 0 for f in self.feature)

    def node(self, values: str, on_bins: bool = False) -> Column:
        """The leaf that the array ``values`` of all features reaches.

        One step down a level, looked up in constant arrays, so the expression's size does not
        grow with the paths. A leaf leads to itself, so no step asks whether it is at one.
        """
        if not self.depth:
            return F.lit(0)

        def listed(numbers, kind) -> str:
            return f"array({', '.join(kind(x) for x in numbers)})"

        bound = listed(self.bin, str) if on_bins else listed(self.threshold, _double)
        of = listed((max(f, 0) for f in self.feature), str)
        left, right = (
            listed((i if c < 0 else c for i, c in enumerate(side)), str)
            for side in (self.left, self.right)
        )
        return F.expr(
            f"aggregate(sequence(1, {self.depth}), 0, (n, i) ->"
            f" if({values}[{of}[n]] <= {bound}[n], {left}[n], {right}[n]))"
        )

    def output(self, values: str, on_bins: bool = False) -> Column:
        """The value of that leaf."""
        return F.array(*(F.lit(v) for v in self.value))[self.node(values, on_bins)]

    def sql(self, names, node: int = 0) -> str:
        """The tree as nested CASE over columns, for any SQL engine."""
        if self.feature[node] < 0:
            return _double(self.value[node])
        return (
            f"CASE WHEN {names[self.feature[node]]} <= {_double(self.threshold[node])}"
            f" THEN {self.sql(names, self.left[node])}"
            f" ELSE {self.sql(names, self.right[node])} END"
        )


def _double(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


@dataclass
class BoostedTrees:
    """A binary classifier: the log-odds of a row are ``base`` plus the trees' values."""

    names: tuple[str, ...]
    base: float
    trees: list[Tree]

    def to_text(self) -> str:
        return json.dumps(
            {"format": FORMAT, "names": list(self.names), "base": self.base,
             "trees": [asdict(t) for t in self.trees]}
        )

    @classmethod
    def from_text(cls, text: str) -> BoostedTrees:
        record = json.loads(text)
        if record.get("format") != FORMAT:
            raise ValueError(f"not a {FORMAT} model")
        return cls(tuple(record["names"]), record["base"], [Tree(**t) for t in record["trees"]])

    def first(self, rounds: int) -> BoostedTrees:
        return BoostedTrees(self.names, self.base, self.trees[:rounds])

    def margins(self, df: DataFrame, to: str = "margin") -> DataFrame:
        """``df`` with the log-odds; values are read as they are in the named columns."""
        values = F.array(*(quoted(n).cast("double") for n in self.names))
        kept = [quoted(c) for c in df.columns]
        rows = df.select(*kept, values.alias("_x"), F.lit(self.base).alias("_margin"))
        for at in range(0, len(self.trees), TREES_AT_ONCE):
            margin = F.col("_margin")
            for tree in self.trees[at : at + TREES_AT_ONCE]:
                margin = margin + tree.output("_x")
            rows = rows.select(*kept, "_x", margin.alias("_margin"))
        return rows.select(*kept, F.col("_margin").alias(to))

    def probabilities(self, df: DataFrame, to: str = "score") -> DataFrame:
        """``df`` with the probability of the positive class."""
        rows = self.margins(df, "_log_odds")
        return rows.withColumn(to, 1 / (1 + F.exp(-F.col("_log_odds")))).drop("_log_odds")

    def sql(self, quote=ident) -> str:
        """The probability as one SQL expression over the named columns."""
        names = [quote(n) for n in self.names]
        margin = " + ".join([_double(self.base), *(f"({t.sql(names)})" for t in self.trees)])
        return f"1 / (1 + exp(-({margin})))"

    def importance(self, spark: SparkSession) -> DataFrame:
        """Total gain and number of splits of each feature, the most useful first."""
        gain, splits = [0.0] * len(self.names), [0] * len(self.names)
        for tree in self.trees:
            for f, g in zip(tree.feature, tree.gain, strict=True):
                if f >= 0:
                    gain[f] += g
                    splits[f] += 1
        rows = list(zip(self.names, gain, splits, strict=True))
        listed = spark.createDataFrame(
            rows, "feature string, importance_gain double, importance_split long"
        )
        return listed.orderBy(F.desc("importance_gain"), "feature")


def save_text(spark: SparkSession, model: BoostedTrees, path: str) -> None:
    """The model as one text file."""
    lines = spark.createDataFrame([(model.to_text(),)], "value string")
    lines.coalesce(1).write.mode("overwrite").text(path)


def load_text(spark: SparkSession, path: str) -> BoostedTrees:
    return BoostedTrees.from_text(spark.read.text(path, wholetext=True).first()["value"])
