"""Feature engineering as fitted transformers.

Each ``fit`` runs one aggregation and keeps a few scalars per column on the
driver; each ``transform`` is a lazy projection of built-in expressions (no
shuffle, no Python). The classes are ``pyspark.ml`` Estimators/Models, so they
compose with built-in stages in an ``ml.Pipeline`` fitted on training rows
only.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.frames import to_long
from riskframe.operators.profile import FENCE_K, fences


class OneHot(Estimator):
    """A 0/1 int column ``<col>_<value>`` per category seen at fit, sorted;
    no category dropped; null or unseen -> all zeros. The categories become
    columns, so they pass through the driver; ``one_hot_vector`` is the form for
    columns with very many of them."""

    def __init__(self, cols: list[str], drop: bool = True):
        super().__init__()
        self.cols, self.drop = cols, drop

    def _fit(self, df: DataFrame) -> "OneHotModel":
        distinct = (to_long(df, self.cols, "string").where(F.col("value").isNotNull())
                    .distinct())
        cats = {c: [] for c in self.cols}
        for r in distinct.collect():
            cats[r["column"]].append(r["value"])
        return OneHotModel({c: sorted(v) for c, v in cats.items()}, self.drop)


def one_hot_vector(cols: list[str], suffix: str = "_vec"):
    """The sparse form: an estimator that adds one 0/1 vector per column, a place
    per category in order of frequency, and a last place for null or unseen."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    numbers = [f"{c}_number" for c in cols]
    return Pipeline(stages=[
        StringIndexer(inputCols=cols, outputCols=numbers, handleInvalid="keep"),
        OneHotEncoder(inputCols=numbers, outputCols=[c + suffix for c in cols], dropLast=False)])


class OneHotModel(Model):
    def __init__(self, categories: dict[str, list[str]], drop: bool = True):
        super().__init__()
        self.categories, self.drop = categories, drop

    def output_columns(self) -> list[str]:
        return [f"{c}_{v}" for c, vs in self.categories.items() for v in vs]

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {f"{c}_{v}": F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0))
               for c, vs in self.categories.items() for v in vs}
        out = df.withColumns(new)
        return out.drop(*self.categories) if self.drop else out


class OutlierToMedian(Estimator):
    """Values outside the Tukey fences (strict) become the column median."""

    def __init__(self, cols: list[str], k: float = FENCE_K):
        super().__init__()
        self.cols, self.k = cols, k

    def _fit(self, df: DataFrame) -> "OutlierToMedianModel":
        rows = fences(df, self.cols, self.k).collect()
        return OutlierToMedianModel({r["column"]: (r["lower"], r["upper"], r["median"])
                                     for r in rows})


class OutlierToMedianModel(Model):
    def __init__(self, bounds: dict[str, tuple[float, float, float]]):
        super().__init__()
        self.bounds = bounds

    def _transform(self, df: DataFrame) -> DataFrame:
        def fix(c, lo, hi, med):
            x = F.col(c)
            return F.when((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(med)).otherwise(x.cast("double"))
        return df.withColumns({c: fix(c, *b) for c, b in self.bounds.items() if b[0] is not None})


class StandardScale(Estimator):
    """(x - mean) / population std; a zero std divides by 1."""

    def __init__(self, cols: list[str]):
        super().__init__()
        self.cols = cols

    def _fit(self, df: DataFrame) -> "StandardScaleModel":
        aggs = []
        for c in self.cols:
            aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
        row = df.agg(*aggs).first()
        return StandardScaleModel({c: (row[f"m_{c}"], row[f"s_{c}"]) for c in self.cols})


class StandardScaleModel(Model):
    def __init__(self, stats: dict[str, tuple[float, float]]):
        super().__init__()
        self.stats = stats

    def _transform(self, df: DataFrame) -> DataFrame:
        def scale(c, m, s):
            s = 1.0 if (s is None or s == 0) else s
            return (F.col(c).cast("double") - F.lit(m if m is not None else 0.0)) / F.lit(s)
        return df.withColumns({c: scale(c, *ms) for c, ms in self.stats.items()})


def poly_names(cols: list[str], degree: int = 2, interaction_only: bool = False) -> list[tuple]:
    """Monomials in the usual order: degree 1 terms, then each term of degree
    d as an index-sorted combination (with replacement unless interaction-only)."""
    out = []
    for d in range(1, degree + 1):
        combos = (itertools.combinations if interaction_only else
                  itertools.combinations_with_replacement)(range(len(cols)), d)
        out += [tuple(cols[i] for i in combo) for combo in combos]
    return out


def _term_name(term: tuple) -> str:
    if len(term) == 1:
        return term[0]
    counts = {}
    for t in term:
        counts[t] = counts.get(t, 0) + 1
    return "_x_".join(t if k == 1 else f"{t}_pow{k}" for t, k in counts.items())


class PolyFeatures(Transformer):
    """All monomials up to ``degree`` of ``cols`` (no bias), as named columns
    (a stateless projection)."""

    def __init__(self, cols: list[str], degree: int = 2, interaction_only: bool = False,
                 keep_inputs: bool = True):
        super().__init__()
        self.cols, self.degree = cols, degree
        self.interaction_only, self.keep_inputs = interaction_only, keep_inputs

    def output_columns(self) -> list[str]:
        return [_term_name(t) for t in poly_names(self.cols, self.degree, self.interaction_only)]

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for term in poly_names(self.cols, self.degree, self.interaction_only):
            if len(term) == 1:
                continue
            expr = F.col(term[0]).cast("double")
            for t in term[1:]:
                expr = expr * F.col(t).cast("double")
            new[_term_name(term)] = expr
        return df.withColumns(new)


def Interactions(cols: list[str]) -> PolyFeatures:
    """Pairwise products without squares, plus the inputs."""
    return PolyFeatures(cols, degree=2, interaction_only=True)


#: Features of one array of ``anova_f_scores``.
ANOVA_WIDTH = 8


def anova_f_scores(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """One-way ANOVA F of each feature against the class label, from a single
    ``groupBy`` of count, mean and population variance per feature (numerically
    stable moments, no sum of squares): one shuffle of #classes x #features values
    per task. A row gives one array per ``ANOVA_WIDTH`` features, grouped by label
    and place of the array: one aggregate over all features at once is too much
    generated code for the JVM to compile."""
    w = ANOVA_WIDTH
    arrays = [F.array(*[F.col(c).cast("double") for c in features[i:i + w]]) for i in range(0, len(features), w)]
    names = F.array(*[F.array(*map(F.lit, features[i:i + w])) for i in range(0, len(features), w)])
    x = [F.get("_x", F.lit(j)) for j in range(min(w, len(features)))]  # null past the end of the last array
    wide = (df.select(F.col(label).alias("_y"), F.posexplode(F.array(*arrays)).alias("_part", "_x")).groupBy("_y", "_part")
            .agg(*[F.struct(F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v")).alias(f"_{j}") for j, v in enumerate(x)]))
    # from here on one row per class and feature
    per = (wide.select("_y", F.get(names, F.col("_part")).alias("_names"), F.posexplode(F.array(*[f"_{j}" for j in range(len(x))])).alias("_j", "s"))
           .select("_y", F.get("_names", F.col("_j")).alias("feature"), "s.*").where(F.col("n") > 0))
    tot = per.groupBy("feature").agg(
        F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("k_all"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("gm"))
    j = per.join(F.broadcast(tot), "feature")  # one row per feature
    ss = j.groupBy("feature", "n_all", "k_all").agg(
        F.sum(F.col("n") * (F.col("m") - F.col("gm")) * (F.col("m") - F.col("gm"))).alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"))
    f = F.try_divide(F.col("ssb") / (F.col("k_all") - 1),
                     F.col("ssw") / (F.col("n_all") - F.col("k_all")))
    return ss.select("feature", f.alias("f_score"))


class SelectKBest(Estimator):
    """Keep the ``k`` features with the largest F (ties by name)."""

    def __init__(self, features: list[str] | None, label: str, k: int = 20,
                 keep: list[str] | None = None):
        super().__init__()
        self.features, self.label, self.k, self.keep = features, label, k, keep or []

    def _fit(self, df: DataFrame) -> "SelectKBestModel":
        from riskframe.operators.frames import dtype_columns
        feats = self.features or [c for c in dtype_columns(df, "number")
                                  if c not in self.keep and c != self.label]
        top = (anova_f_scores(df, feats, self.label)
               .orderBy(F.col("f_score").desc_nulls_last(), F.col("feature")).limit(self.k)
               .collect())
        return SelectKBestModel([r["feature"] for r in top], self.keep + [self.label])


class SelectKBestModel(Model):
    def __init__(self, selected: list[str], keep: list[str]):
        super().__init__()
        self.selected, self.keep = selected, keep

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[c for c in self.keep if c in df.columns and c not in self.selected],
                         *self.selected)


class CenteredPCA(Estimator):
    """Principal components of the centred columns. Covariance comes from one
    aggregation (d(d+1)/2 ``covar_samp``); the d x d eigenproblem is solved on
    the driver. Each component's sign is fixed so its largest-magnitude
    loading is positive."""

    def __init__(self, cols: list[str], k: int = 2, prefix: str = "PC"):
        super().__init__()
        self.cols, self.k, self.prefix = cols, k, prefix

    def _fit(self, df: DataFrame) -> "CenteredPCAModel":
        cols, d = self.cols, len(self.cols)
        aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
        pairs = [(i, j) for i in range(d) for j in range(i, d)]
        aggs += [F.covar_samp(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double"))
                 .alias(f"c{i}_{j}") for i, j in pairs]
        row = df.dropna(subset=cols).agg(*aggs).first()
        cov = np.zeros((d, d))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = row[f"c{i}_{j}"] or 0.0
        vals, vecs = np.linalg.eigh(cov)
        order = np.argsort(vals)[::-1][: self.k]
        comps = vecs[:, order].T
        for r in range(comps.shape[0]):
            if comps[r, np.argmax(np.abs(comps[r]))] < 0:
                comps[r] = -comps[r]
        means = [row[f"m{i}"] for i in range(d)]
        return CenteredPCAModel(cols, means, comps.tolist(), vals[order].tolist(), self.prefix)


class CenteredPCAModel(Model):
    def __init__(self, cols, means, components, explained_variance, prefix="PC"):
        super().__init__()
        self.cols, self.means, self.components = cols, means, components
        self.explained_variance, self.prefix = explained_variance, prefix

    def output_columns(self) -> list[str]:
        return [f"{self.prefix}{i + 1}" for i in range(len(self.components))]

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for i, comp in enumerate(self.components):
            expr = None
            for c, m, w in zip(self.cols, self.means, comp):
                term = (F.col(c).cast("double") - F.lit(m)) * F.lit(float(w))
                expr = term if expr is None else expr + term
            new[f"{self.prefix}{i + 1}"] = expr
        return df.withColumns(new)


def assemble(df: DataFrame, cols: list[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Columns -> one ``VectorUDT`` column for the JVM learners."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


class AssembleAll(Transformer):
    """Assemble every numeric column except ``exclude`` (column set known only
    after upstream stages are fitted) into one vector column."""

    def __init__(self, exclude: list[str], out: str = "features"):
        super().__init__()
        self.exclude, self.out = exclude, out

    def _transform(self, df: DataFrame) -> DataFrame:
        from riskframe.operators.frames import dtype_columns
        cols = [c for c in dtype_columns(df, "number") if c not in self.exclude]
        return assemble(df, cols, self.out)
