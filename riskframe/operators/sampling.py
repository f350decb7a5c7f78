"""Splits, folds, stratified subsets and SMOTE.

Randomness is a hash of the row key and a seed, never ``rand()``, so a split
is the same after repartitioning or recomputation. Exact sizes come from cuts in
the hash order: a few aggregations over the hashes find the hash at a wanted
rank, and every row is then placed by comparing its own hash with the cuts. Wide
rows are neither moved nor written. Rows of one key fall on the same side.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.hashing import hash_hex, uniform_hash
from riskframe.session import written

_DIGITS = 4  # hex digits settled per pass: at most 16**4 groups per open cut
_ABOVE = "g"  # over every hex string


def hash_cuts(df: DataFrame, key: str, seed: int, group: str | None, wanted: dict) -> dict:
    """``{(class, rank): cut}`` for ``wanted = {class: [rank, ...]}``: exactly
    ``rank`` rows of the class have a hash under the cut (null is a class)."""
    rows = df.select(hash_hex(key, seed).alias("h"), (F.col(group) if group else F.lit(0)).alias("c"))
    open_ = {(c, r): ("", r) for c, ranks in wanted.items() for r in ranks}
    cuts = {}
    for width in range(_DIGITS, 32 + _DIGITS, _DIGITS):
        cond = F.lit(False)
        for c, prefix in {(c, p) for (c, _), (p, _) in open_.items()}:
            cond = cond | (F.col("c").eqNullSafe(F.lit(c)) & F.col("h").startswith(prefix))
        counts = rows.where(cond).groupBy("c", F.substring("h", 1, width).alias("p")).count().collect()
        by_class: dict = {}
        for r in sorted(counts, key=lambda r: r["p"]):
            by_class.setdefault(r["c"], []).append((r["p"], r["count"]))
        for target, (prefix, left) in list(open_.items()):
            for p, n in by_class.get(target[0], []):
                if p.startswith(prefix):
                    if left < n:
                        open_[target] = (p, left)
                        break
                    left -= n
            else:
                open_[target] = (_ABOVE, 0)
            if open_[target][1] == 0 or width >= 32:
                cuts[target] = open_.pop(target)[0]
        if not open_:
            break
    return cuts


def _sizes(df: DataFrame, label: str) -> dict:
    """Rows per class; classes are few."""
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


def _is_class(label: str, c) -> Column:
    return F.col(label).eqNullSafe(F.lit(c))


def train_test_split(df: DataFrame, key: str, test: float = 0.3, seed: int = 17,
                     split_col: str = "split") -> DataFrame:
    """Random, unstratified: the ceil(test * n) rows first in hash order are
    'test', the rest 'train'."""
    n_test = math.ceil(round(test * df.count(), 9))
    cut = hash_cuts(df, key, seed, None, {0: [n_test]})[0, n_test]
    return df.withColumn(split_col, F.when(hash_hex(key, seed) < cut, F.lit("test")).otherwise(F.lit("train")))


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 17,
                     fold_col: str = "fold") -> DataFrame:
    """Each class in hash order is cut into k folds whose sizes differ by at most
    one. A null label is a class of its own."""
    sizes = _sizes(df, label)
    wanted = {c: sorted({-(-f * n // k) for f in range(1, k)}) for c, n in sizes.items()}
    cuts = hash_cuts(df, key, seed, label, wanted)
    h = hash_hex(key, seed)
    fold = F.lit(0)
    for c, n in sizes.items():
        own = sum(((h >= cuts[c, -(-f * n // k)]).cast("int") for f in range(1, k)), F.lit(0))
        fold = F.when(_is_class(label, c), own).otherwise(fold)
    return df.withColumn(fold_col, fold.cast("int"))


def stratified_sample(df: DataFrame, key: str, label: str, frac: float, seed: int = 17) -> DataFrame:
    """Per class (null is one), the first floor(frac * n_c + 0.5) rows in hash
    order."""
    take = {c: math.floor(round(frac * n, 9) + 0.5) for c, n in _sizes(df, label).items()}
    cuts = hash_cuts(df, key, seed, label, {c: [r] for c, r in take.items()})
    keep = F.lit(False)
    for c, r in take.items():
        keep = keep | (_is_class(label, c) & (hash_hex(key, seed) < cuts[c, r]))
    return df.where(keep)


def _made(base: DataFrame, near: DataFrame, names: list[str], k: int, seed: int) -> DataFrame:
    """The ``_m`` synthetic points (``_j``, see ``_point``) of every row of ``base`` from its ``near``
    rows ``(*names, rank, _xn)``. Rows meet their neighbours once and multiply afterwards: the many
    points are not shuffled, nor broadcast as if they were as few as the rows."""
    lists = near.groupBy(*names).agg(F.sort_array(F.collect_list(F.struct("rank", "_xn"))).alias("_near"))
    tag = F.concat(F.col("_id"), F.lit("#"), F.col("_j").cast("string"))
    return (base.where(F.col("_m") > 0).join(lists.hint("merge"), names)
            .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
            .withColumn("_xn", F.get("_near", F.floor(uniform_hash(tag, seed) * k).cast("int"))["_xn"])
            .where(F.col("_xn").isNotNull()).withColumn("_u", uniform_hash(tag, seed + 1)).drop("_near"))


def _point(i: int) -> Column:
    """A number of a synthetic point. Not one array of them by a lambda function: every number
    would compute the whole array, and every element of it the hash."""
    return F.col("_x")[i] + F.col("_u") * (F.col("_xn")[i] - F.col("_x")[i])


def smote(df: DataFrame, key: str, label: str, features: list[str], k: int = 5,
          strategy: float = 1.0, seed: int = 17, minority=1, keep: Column | None = None) -> DataFrame:
    """Synthetic minority rows until minority = strategy x majority, and the rows of ``df``
    themselves (those under the condition ``keep``, if one is given).

    Of s synthetic rows, each of the m minority rows makes s div m, the first
    s mod m in hash order one more. Synthetic row j of row x takes neighbour
    floor(u1 * k) of x's k nearest minority rows and the point
    x + u2 (x_nn - x), with u1, u2 hashes of (key, j). Neighbours come with their
    vectors from the exact ``knn_join``; everything else is joins and projections.
    New keys are unique and disjoint from the old: ``<key>_syn<j>`` for strings,
    else numbers over the largest key. Raises if the minority has no k other
    rows, or the key type has no room."""
    from riskframe.operators.knn import knn_join
    sizes = _sizes(df, label)
    n_min = sizes.get(minority, 0)
    n_maj = max([n for c, n in sizes.items() if c != minority] or [0])
    n_syn = max(0, int(strategy * n_maj) - n_min)
    kept = df if keep is None else df.where(keep)
    if n_syn == 0:
        return kept
    if n_min <= k:
        raise ValueError(f"{n_min} rows of class {minority} have no {k} neighbours each")
    # the join, the cuts and the synthetic rows read the minority, not all rows, again
    mino = written(df.where(F.col(label) == F.lit(minority)).select(
        F.col(key).alias("_key"), F.col(key).cast("string").alias("_id"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("_x")), "minority")
    nn = knn_join(mino, mino, k, qkey="_id", rkey="_id", vec="_x", exclude_self=True, seed=seed,
                  carry="_x")
    each, rest = divmod(n_syn, n_min)
    cut = hash_cuts(mino, "_id", seed, None, {0: [rest]})[0, rest]
    base = mino.withColumn("_m", F.lit(each) + (hash_hex("_id", seed) < cut).cast("int"))
    syn = _made(base, nn.withColumnRenamed("_x", "_xn"), ["_id"], k, seed)
    key_type = df.schema[key].dataType
    if isinstance(key_type, T.StringType):
        new_key = F.concat(F.col("_id"), F.lit("_syn"), F.col("_j").cast("string"))
    else:
        low, high = df.agg(F.min(key), F.max(key)).first()
        room = (1 << {"tinyint": 7, "smallint": 15, "int": 31}.get(key_type.simpleString(), 63)) - 1
        if high + (high - low + 1) * (each + 1) > room:
            raise ValueError(f"no room for new keys of type {key_type.simpleString()}: use a wider or a string key")
        new_key = (F.lit(high + 1).cast("long")
                   + (F.col("_key").cast("long") - F.lit(low)) * F.lit(each + 1) + F.col("_j")).cast(key_type)
    out = syn.select(new_key.alias(key), F.lit(minority).cast(df.schema[label].dataType).alias(label),
                     *[_point(i).alias(c) for i, c in enumerate(features)])
    cast_df = kept.select(*[F.col(c).cast("double").alias(c) if c in features else F.col(c)
                            for c in df.columns])
    return cast_df.unionByName(out, allowMissingColumns=True)


def smote_in_folds(df: DataFrame, key: str, label: str, features: list[str], fold: str = "fold", k: int = 5,
                   strategy: float = 1.0, seed: int = 17, minority=1) -> DataFrame:
    """The synthetic minority rows of every training set of a cross-validation:
    ``(excluded, key, label, *features)``, one set per fold held out, each made as by
    ``smote`` from the rows of the other folds alone.

    One neighbour join serves all folds: it keeps the k nearest minority rows of every
    fold, so the k nearest outside a fold are among those of the remaining ones. The rest
    is one pass over rows x folds. Keys are strings, ``<key>_syn<j>``, unique within a set.
    Raises if a training set's minority has no k other rows."""
    from riskframe.operators.knn import knn_join
    sizes = {}
    for r in df.groupBy(fold, label).count().collect():  # folds x classes
        sizes.setdefault(r[fold], {})[r[label]] = r["count"]
    plan = {}
    for e in sizes:
        rest: dict = {}
        for f, classes in sizes.items():
            for c, n in classes.items():
                rest[c] = rest.get(c, 0) + (n if f != e else 0)
        few, many = rest.get(minority, 0), max([n for c, n in rest.items() if c != minority] or [0])
        made = max(0, int(strategy * many) - few)
        if made and few <= k:
            raise ValueError(f"without fold {e}, {few} rows of class {minority} have no {k} neighbours each")
        plan[e] = divmod(made, few) if made else (0, 0)
    mino = written(df.where(F.col(label) == F.lit(minority)).select(
        F.col(key).cast("string").alias("_id"), F.col(fold).alias("_fold"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("_x")), "minority")
    near = knn_join(mino, mino, k, qkey="_id", rkey="_id", vec="_x", exclude_self=True, seed=seed, carry="_x", per="_fold")
    held = F.explode(F.array(*[F.lit(e) for e in plan])).alias("excluded")
    order = Window.partitionBy("_id", "excluded").orderBy("dist", "nn")
    near = (near.drop("rank").select("*", held).where(F.col("_fold") != F.col("excluded"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("_id", "excluded", "rank", F.col("_x").alias("_xn")))
    rows = mino.select("*", held).where(F.col("_fold") != F.col("excluded"))
    cuts = hash_cuts(rows, "_id", seed, "excluded", {e: [rest] for e, (_, rest) in plan.items()})
    times = F.lit(0)
    for e, (each, rest) in plan.items():
        times = F.when(F.col("excluded") == F.lit(e), F.lit(each) + (hash_hex("_id", seed) < cuts[e, rest]).cast("int")).otherwise(times)
    made = _made(rows.withColumn("_m", times), near, ["_id", "excluded"], k, seed)
    return made.select("excluded", F.concat(F.col("_id"), F.lit("_syn"), F.col("_j").cast("string")).alias(key),
                       F.lit(minority).cast(df.schema[label].dataType).alias(label),
                       *[_point(i).alias(c) for i, c in enumerate(features)])


class ResampleThenFit:
    """Estimator whose ``fit`` resamples the training rows, then fits the
    wrapped estimator; the fitted model never resamples (scoring rows stay
    untouched), so resampling happens inside training folds only."""

    def __init__(self, resample, estimator):
        self.resample, self.estimator = resample, estimator

    def fit(self, df: DataFrame):
        return self.estimator.fit(self.resample(df))


class WeighThenFit:
    """Estimator whose ``fit`` gives every training row the balanced weight of its class,
    from the training rows alone, then fits the wrapped estimator."""

    def __init__(self, estimator, label: str = "label", weight_col: str = "w"):
        self.estimator, self.label, self.weight_col = estimator, label, weight_col

    def fit(self, df: DataFrame):
        from riskframe.operators.profile import with_class_weights
        return self.estimator.fit(with_class_weights(df.drop(self.weight_col), self.label, self.weight_col))
