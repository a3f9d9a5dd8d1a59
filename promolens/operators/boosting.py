"""Gradient boosting that grows leaf by leaf, on histograms that Spark aggregates.

Rows are binned and stored once. A round turns margins into gradients and hessians, whole numbers of
1e-7 so that sums depend on no order, and grows one tree: the leaf of the largest gain is split
next, until the leaf limit. All leaves that may come next are looked at in one pass: only the smaller
child of each is counted (``groupBy(node, feature, bin)``), the larger one is the parent less it. So a
tree takes about as many passes as it is deep, not one a leaf, and is the same as if it were grown
split by split. Histograms on the driver are bounded by leaves, features and bins, not by rows.

Rows and features of a round are drawn by hashes of (seed, round, key) and (seed, tree, feature).
The held-out AUC is known before a round is trained that patience could rule out. After each block
of rounds the margins are stored and the state is recorded, from which a broken run goes on.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
from collections.abc import Callable
from dataclasses import asdict, dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.config import LeafwiseConfig
from promolens.functions.expr import key_hash, quoted
from promolens.operators.binning import Bins, binned, fit_bins
from promolens.operators.metrics import roc_auc
from promolens.operators.trees import TREES_AT_ONCE, BoostedTrees, Tree
from promolens.session import remove_staged, stage, staging_path
from promolens.sources.sinks import read_json_record, write_json_record

UNIT = 10_000_000  # of gradients and hessians: exact sums of up to 9e11 rows
HASH_RANGE = 1 << 60


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    bin: int
    left: tuple[int, int, int]  # gradient, hessian, rows
    right: tuple[int, int, int]


def soft(gradient, l1: float):
    """The gradient after the L1 penalty."""
    return np.sign(gradient) * np.maximum(np.abs(gradient) - l1, 0.0)


def leaf_value(gradient: int, hessian: int, cfg: LeafwiseConfig) -> float:
    """The value of a leaf before the learning rate."""
    weight = hessian / UNIT + cfg.l2
    return float(-soft(gradient / UNIT, cfg.l1) / weight) if weight > 0 else 0.0


def best_split(histogram: np.ndarray, cfg: LeafwiseConfig) -> Split | None:
    """The split of the largest gain; equal ones go by feature, then by bin.

    ``histogram`` holds gradient, hessian and rows by feature and bin.
    """
    total = histogram[0].sum(axis=0)
    left = histogram.cumsum(axis=1)[:, :-1]
    right = total - left

    def worth(sums):
        weight = sums[..., 1] / UNIT + cfg.l2
        return soft(sums[..., 0] / UNIT, cfg.l1) ** 2 / np.where(weight > 0, weight, np.inf)

    gain = worth(left) + worth(right) - worth(total)
    least = np.minimum(left, right)
    allowed = (least[..., 2] >= cfg.min_rows) & (least[..., 1] / UNIT >= cfg.min_hessian)
    gain = np.where(allowed & (gain > 0), gain, -1.0)
    if not gain.size or gain.max() <= 0:
        return None
    f, b = divmod(int(gain.argmax()), gain.shape[1])
    return Split(float(gain[f, b]), f, b, tuple(map(int, left[f, b])), tuple(map(int, right[f, b])))


class _Growing:
    """A node of the tree in growth."""

    def __init__(self, path: tuple[int, ...], sums: tuple[int, int, int], histogram):
        self.path, self.sums, self.histogram = path, sums, histogram
        self.split: Split | None = None
        self.children: tuple[_Growing, _Growing] | None = None


def grow(
    histograms: Callable[[Tree, list[int]], dict[int, np.ndarray]],
    bins: Bins,
    features: list[int],
    cfg: LeafwiseConfig,
) -> Tree:
    """One tree of at most ``cfg.leaves`` leaves, the leaf of the largest gain split next.

    ``histograms(tree, nodes)`` counts the rows that reach the nodes, over ``features``.
    Equal gains go by the path from the root, left first.
    """
    empty = Tree()
    empty.add(0.0, 0)
    whole = histograms(empty, [0]).get(0)
    if whole is None:
        return empty
    root = _Growing((), tuple(map(int, whole[0].sum(axis=0))), whole)
    root.split = best_split(whole, cfg)
    while True:
        chosen, waiting = _replay(root, cfg.leaves)
        if not waiting:
            return _finished(root, chosen, bins, features, cfg)
        _look_ahead(root, waiting, histograms, bins, features, cfg)


def _replay(root: _Growing, leaves: int) -> tuple[set, list[_Growing]]:
    """The splits made so far, and, if the next one has not been looked at, what may come soon.

    Those are as many nodes as there are splits left, the largest gains first.
    """
    chosen: set[tuple[int, ...]] = set()
    heap = [(-root.split.gain, root.path, root)] if root.split else []
    while heap and len(chosen) + 1 < leaves:
        if heap[0][2].children is None:
            ends = [e for _, _, n in heap for e in _ends(n) if e is not heap[0][2]]
            more = heapq.nsmallest(leaves - len(chosen) - 2, ends, lambda n: -n.split.gain)
            return chosen, [heap[0][2], *more]
        _, path, node = heapq.heappop(heap)
        chosen.add(path)
        for child in node.children:
            if child.split:
                heapq.heappush(heap, (-child.split.gain, child.path, child))
    return chosen, []


def _ends(node: _Growing) -> list[_Growing]:
    """The nodes below, or the node itself, that can be split and have not been looked at."""
    if node.children is None:
        return [node] if node.split else []
    return [e for child in node.children for e in _ends(child)]


def _look_ahead(root, waiting, histograms, bins, features, cfg) -> None:
    """Split the waiting nodes, whose children are counted in one pass."""
    for node in waiting:
        node.children = tuple(
            _Growing((*node.path, side), sums, None)
            for side, sums in enumerate((node.split.left, node.split.right))
        )
    every = _paths(root)
    tree, numbers = _as_tree(root, every, bins, features, cfg)
    worthwhile = [n for n in waiting if max(c.sums[2] for c in n.children) >= 2 * cfg.min_rows]
    smaller = {n.path: min(n.children, key=lambda c: c.sums[2]) for n in worthwhile}
    counted = histograms(tree, [numbers[c.path] for c in smaller.values()]) if smaller else {}
    for node in worthwhile:
        few = smaller[node.path]
        many = node.children[1] if few is node.children[0] else node.children[0]
        few.histogram = counted.get(numbers[few.path], np.zeros_like(node.histogram))
        many.histogram = node.histogram - few.histogram
        for child in node.children:
            child.split = best_split(child.histogram, cfg)
        node.histogram = None
    for node in waiting:
        node.histogram = None


def _paths(node: _Growing) -> set[tuple[int, ...]]:
    """Every node that has been split, also those that may not stay."""
    if node.children is None:
        return set()
    return {node.path}.union(*map(_paths, node.children))


def _as_tree(root, inner, bins, features, cfg) -> tuple[Tree, dict[tuple[int, ...], int]]:
    tree, numbers = Tree(), {}
    queue = [root]
    for node in queue:
        numbers[node.path] = tree.add(
            cfg.learning_rate * leaf_value(node.sums[0], node.sums[1], cfg), node.sums[2]
        )
        if node.path in inner:
            queue.extend(node.children)
    for node in queue:
        if node.path in inner:
            i, feature = numbers[node.path], features[node.split.feature]
            tree.feature[i], tree.bin[i] = feature, node.split.bin
            tree.threshold[i] = bins.cuts[feature][node.split.bin]
            tree.left[i], tree.right[i] = (numbers[c.path] for c in node.children)
            tree.gain[i] = node.split.gain
    return tree, numbers


def _finished(root, chosen, bins, features, cfg) -> Tree:
    return _as_tree(root, chosen, bins, features, cfg)[0]


def drawn_features(seed: int, tree: int, names, fraction: float) -> list[int]:
    """The features of a tree: those with the smallest hashes of (seed, tree, name)."""
    wanted = max(1, round(fraction * len(names)))

    def rank(i: int) -> str:
        return hashlib.md5(f"{names[i]}|{tree}|{seed}".encode()).hexdigest()

    return sorted(sorted(range(len(names)), key=rank)[:wanted])


def is_drawn(key: Column, seed: int, number: int, fraction: float) -> Column:
    """Whether a key is among the rows of a round."""
    hashed = key_hash(F.concat(key.cast("string"), F.lit(f"|{number}")), seed)
    return hashed < F.lit(math.floor(fraction * HASH_RANGE))


def gradients(margin: Column, label: Column) -> tuple[Column, Column]:
    """Gradient and hessian of the logistic loss, in whole units."""
    p = 1 / (1 + F.exp(-margin))
    return (
        F.round((p - label) * UNIT).cast("long"),
        F.round(p * (1 - p) * UNIT).cast("long"),
    )


def node_histograms(
    rows: DataFrame, tree: Tree, nodes: list[int], width: int
) -> dict[int, np.ndarray]:
    """Sums of ``g``, ``h`` and rows of the nodes, by place in ``x`` and bin.

    ``rows`` has ``x`` (bins of the drawn features), ``all`` (of all features), ``g`` and ``h``.
    Combined before the shuffle; what comes back has one row for each node, feature and bin.
    """
    node = tree.node("all", on_bins=True).alias("node")
    placed = rows.select("x", "g", "h", node)
    held = F.col("x")
    if len(nodes) < len(tree.feature):
        # No filter: it would be put below, and so find the node of every row it keeps twice.
        wanted = F.array_contains(F.array(*map(F.lit, nodes)), F.col("node"))
        held = F.when(wanted, held)
    cells = placed.select("node", "g", "h", F.posexplode(held).alias("feature", "bin"))
    sums = cells.groupBy("node", "feature", "bin").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n")
    )
    found = sums.toArrow()
    columns = {c: found.column(c).to_numpy() for c in found.column_names}
    features = int(columns["feature"].max(initial=-1)) + 1
    out = {}
    for wanted in nodes:
        here = columns["node"] == wanted
        if here.any():
            held = out[wanted] = np.zeros((features, width, 3), np.int64)
            at = columns["feature"][here], columns["bin"][here]
            for i, c in enumerate(("g", "h", "n")):
                held[(*at, i)] = columns[c][here]
    return out


@dataclass
class Fitted:
    """The trees up to the best round, and the held-out AUC after every trained round."""

    model: BoostedTrees
    areas: list[float | None]

    @property
    def best_round(self) -> int:
        return len(self.model.trees)


def best_of(areas: list[float | None]) -> int:
    """The first round of the highest AUC, from 1; 0 if there is none."""
    if not areas:
        return 0
    return 1 + max(range(len(areas)), key=lambda i: (areas[i] or 0.0, -i))


class _State:
    """What a broken run goes on from: trees by block, AUCs, and the rows with their margins."""

    def __init__(self, spark: SparkSession, folder: str, fingerprint: str):
        self.spark, self.folder, self.fingerprint = spark, folder, fingerprint

    def load(self) -> dict | None:
        try:
            record = read_json_record(self.spark, f"{self.folder}/state")
        except AnalysisException:
            return None
        return record if record["fingerprint"] == self.fingerprint else None

    def block_trees(self, path: str) -> list[Tree]:
        return [Tree(**t) for t in read_json_record(self.spark, path)["trees"]]

    def save(self, record: dict, trees: list[Tree]) -> None:
        """The trees of a block, then the record that names them."""
        path = f"{self.folder}/trees-{len(record['blocks']):06d}-{self.fingerprint[:12]}"
        write_json_record(self.spark, {"trees": [asdict(t) for t in trees]}, path)
        record["blocks"].append(path)
        self.note(record)

    def note(self, record: dict) -> None:
        write_json_record(
            self.spark, {**record, "fingerprint": self.fingerprint}, f"{self.folder}/state"
        )


def fit(
    rows: DataFrame,
    names,
    cfg: LeafwiseConfig = LeafwiseConfig(),
    seed: int = 42,
    key: str = "key",
    label: str = "label",
    held_out: str = "is_validation",
    folder: str | None = None,
) -> Fitted:
    """Boost on the rows that are not held out, and stop by the AUC of those that are.

    A round that comes more than ``patience`` after the best one is never trained. With a
    ``folder``, a run that was broken goes on from its last block if data and settings are the
    same; the result is that of an unbroken run. Labels are 0 and 1; a NULL key is one key for
    the draw; missing feature values are 0. Both sides need rows of both classes.
    """
    spark = rows.sparkSession
    names = tuple(names)
    side = F.col("held")
    # Stored, because it is read several times, and because filters on the expressions of a split
    # take the optimizer very long beside many features.
    plain = stage(_plain(rows, names, key, label, held_out), "boosting-input")
    names_in = _slots(names)
    counts = {
        r["held"]: r
        for r in plain.groupBy("held").agg(
            F.count(F.lit(1)).alias("n"), F.sum("label").cast("long").alias("ones"),
            F.expr("cast(sum(cast(xxhash64(*) as decimal(20,0))) as string)").alias("content"),
        ).collect()
    }
    if set(counts) != {0, 1} or any(not 0 < r["ones"] < r["n"] for r in counts.values()):
        raise ValueError("training and held-out rows must both hold both classes")
    told = json.dumps([list(names), asdict(cfg), seed, [list(counts[s]) for s in (0, 1)]])
    fingerprint = hashlib.md5(told.encode()).hexdigest()
    state = _State(spark, folder or staging_path(spark, "boosting"), fingerprint)
    record = state.load()
    if record is None:
        cuts = fit_bins(plain.where(side == 0), names_in, cfg.max_bins).cuts
        share = counts[0]["ones"] / counts[0]["n"]
        record = {
            "base": math.log(share / (1 - share)), "blocks": [], "areas": [],
            "cuts": [list(c) for c in cuts], "rows": None,
        }
    bins = Bins(tuple(names_in), tuple(tuple(c) for c in record["cuts"]))
    trees = [t for path in record["blocks"] for t in state.block_trees(path)]
    current = None
    while (block := _next_block(len(trees), record["areas"], cfg)) > 0:
        if current is None:
            current = _stored_rows(plain, bins, record, trees)
        new: list[Tree] = []
        for _ in range(block):
            new.append(_round(current, new, len(trees) + len(new) + 1, bins, names, cfg, seed))
        record["areas"] += _areas(current, new)
        following = stage(_with_margins(current, new), "boosting-rows")
        record["rows"] = following.inputFiles()[0].rsplit("/", 1)[0]
        state.save(record, new)
        remove_staged(spark, current)
        current, trees = following, trees + new
    remove_staged(spark, plain)
    if current is not None:
        state.note({**record, "rows": None})
        remove_staged(spark, current)
    best = best_of(record["areas"])
    return Fitted(BoostedTrees(names, record["base"], trees[:best]), record["areas"])


def _next_block(trained: int, areas: list[float | None], cfg: LeafwiseConfig) -> int:
    """Rounds that will be needed whatever their AUC, at most a block."""
    return min(cfg.block, cfg.rounds - trained, best_of(areas) + cfg.patience - trained)


def _stored_rows(plain: DataFrame, bins: Bins, record: dict, trees: list[Tree]) -> DataFrame:
    """The binned rows with the margins after ``trees``: as stored, else computed again."""
    spark = plain.sparkSession
    if record["rows"] is not None:
        try:
            return spark.read.parquet(record["rows"])
        except AnalysisException:
            pass  # the shared folder has been cleaned
    keep = ["key", "label", "held", F.lit(record["base"]).alias("margin")]
    rows = binned(plain, bins, keep)
    for at in range(0, len(trees), TREES_AT_ONCE):
        rows = _with_margins(rows, trees[at : at + TREES_AT_ONCE])
    return stage(rows, "boosting-rows")


def _slots(names) -> list[str]:
    return [f"feature {i}" for i in range(len(names))]


def _plain(rows: DataFrame, names, key: str, label: str, held_out: str) -> DataFrame:
    """Features under numbers, so that no name clashes."""
    return rows.select(
        F.coalesce(quoted(key).cast("string"), F.lit("")).alias("key"),
        quoted(label).cast("int").alias("label"),
        quoted(held_out).cast("int").alias("held"),
        *(quoted(n).alias(s) for n, s in zip(names, _slots(names), strict=True)),
    )


def _margin(new: list[Tree]) -> Column:
    margin = F.col("margin")
    for tree in new:
        margin = margin + tree.output("x", on_bins=True)
    return margin


def _with_margins(current: DataFrame, new: list[Tree]) -> DataFrame:
    return current.select("key", "label", "held", _margin(new).alias("margin"), "x")


def _round(current, new, number, bins, names, cfg, seed) -> Tree:
    features = drawn_features(seed, number, names, cfg.feature_fraction)
    g, h = gradients(F.col("now"), F.col("label"))
    drawn = is_drawn(F.col("key"), seed, number, cfg.row_fraction)
    rows = (
        current.where((F.col("held") == 0) & drawn)
        .select("label", "x", _margin(new).alias("now"))
        .select(
            F.col("x").alias("all"), F.array(*(F.col("x")[i] for i in features)).alias("x"),
            g.alias("g"), h.alias("h"),
        )
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        return grow(
            lambda tree, nodes: node_histograms(rows, tree, nodes, bins.width),
            bins, features, cfg,
        )
    finally:
        rows.unpersist()


def _areas(current: DataFrame, new: list[Tree]) -> list[float | None]:
    """The held-out AUC after each new round, all in one pass."""
    steps = F.array(*(t.output("x", on_bins=True) for t in new))
    rows = current.where("held = 1").select("label", "margin", steps.alias("steps"))
    each = F.expr(
        f"transform(sequence(1, {len(new)}), k -> struct(k AS round,"
        " aggregate(slice(steps, 1, k), margin, (s, x) -> s + x) AS score))"
    )
    found = roc_auc(rows.select("label", F.inline(each)), by="round").collect()
    by_round = {r["round"]: r["auc"] for r in found}
    return [by_round.get(i + 1) for i in range(len(new))]
