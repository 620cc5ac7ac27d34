"""From a feature table to a model matrix: splits, imputing, scaling, encoding, text weights."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import (
    CountVectorizer,
    ElementwiseProduct,
    FeatureHasher,
    IDF,
    Normalizer,
    OneHotEncoder,
    PolynomialExpansion,
    RegexTokenizer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    UnivariateFeatureSelector,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.aggregates import exact_quantiles, top_value
from tidemark.operators.history import ordinal
from tidemark.skew import DEFAULT, SkewPolicy, settle, spread_join
from tidemark.spans import instant, micros


def draw(ids: Sequence[str], seed: int) -> Column:
    """A repeatable number in [0, 1) per row, from its id; the same after any retry or repartition."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *ids), 11) / F.lit(float(1 << 53))


def stratified_split(
    df: DataFrame, label: str, ids: Sequence[str], test_share: float, seed: int = 42, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Add is_test with the same share in every class, to within one row of each class."""
    drawn = df.withColumn("_tm_draw", draw(ids, seed))
    limits = exact_quantiles(drawn, "_tm_draw", [test_share], [label], policy).withColumnRenamed("q0", "_tm_limit")
    # settled, the few limits have a known size: Spark copies them to the rows instead of piling the rows up by class
    split = spread_join(drawn, settle(limits, "limits"), label, ids, policy, how="left", hot_from=df)
    chosen = F.coalesce((F.col("_tm_draw") <= F.col("_tm_limit")).cast("int"), F.lit(0))
    return split.withColumn("is_test", chosen).select(*df.columns, "is_test")


def chronological_split(
    df: DataFrame, time: str, shares: Sequence[float], names: Sequence[str], policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Add part: earlier rows to the first name, later ones to the next, cut at shares of the rows in time order."""
    ends = [sum(shares[: i + 1]) for i in range(len(shares) - 1)]
    timed = df.withColumn("_tm_at", micros(time))
    points = exact_quantiles(timed, "_tm_at", ends, policy=policy)
    cuts = points.select(F.array(*[f"q{i}" for i in range(len(ends))])).scalar()
    part = F.when(F.col("_tm_at") <= F.get(cuts, F.lit(0)), names[0])
    for i, name in enumerate(names[1:-1], start=1):
        part = part.when(F.col("_tm_at") <= F.get(cuts, F.lit(i)), name)
    return timed.withColumn("part", part.otherwise(names[-1])).drop("_tm_at")


def split_at(df: DataFrame, time: str, moment) -> DataFrame:
    return df.withColumn("part", F.when(F.col(time) < instant(moment), "train").otherwise("test"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (classes × rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    return counts.select(label, "n", (whole["rows"] / (whole["classes"] * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, ids) -> DataFrame:
    return spread_join(df, class_weights(df, label).drop("n"), label, ids)


def positive_weight(df: DataFrame, label: str) -> DataFrame:
    """Weight positives by negatives / positives, for binary labels."""
    ratio = df.agg(F.sum(1 - F.col(label)) / F.nullif(F.sum(label), F.lit(0))).scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def impute_modes(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """Fill null text with the most frequent value of the training rows (all rows if none are given), ties to the smallest."""
    source = df if train is None else train
    result = df
    for name in columns:
        keyed = source.select(F.lit(1).alias("_tm_all"), name)
        mode = top_value(keyed, "_tm_all", name, "_tm_mode").select("_tm_mode").scalar()
        result = result.withColumn(name, F.coalesce(F.col(name), mode))
    return result


def standardise(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation, both from the training rows; a constant column becomes 0."""
    stats = train.agg(
        F.struct(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
        )
    ).scalar()
    scaled = {
        f"{c}_z": (F.col(c) - stats[f"m{i}"]) / F.when(stats[f"s{i}"] == 0, F.lit(1.0)).otherwise(stats[f"s{i}"])
        for i, c in enumerate(columns)
    }
    return df.withColumns(scaled)


def one_hot_columns(df: DataFrame, name: str, levels: Sequence[str]) -> DataFrame:
    """One 0/1 column per known level; an unknown value gives zeros everywhere."""
    return df.withColumns({f"{name}_{level}": F.coalesce((F.col(name) == level).cast("int"), F.lit(0)) for level in levels})


def ordinal_code(name: str, levels: Sequence[str]) -> Column:
    """Position in the level list, -1 for anything else."""
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(name)) - 1, F.lit(-1)).cast("int")


def label_codes(df: DataFrame, name: str, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Code per distinct text value in alphabetical order; joined back it encodes, read by code it decodes.

    Any number of values: they are numbered in slices of about equally many, whose counts are carried on.
    """
    values = df.select(name).where(F.col(name).isNotNull()).distinct()
    numbered = ordinal(values, [], name, [], "code", policy)
    return numbered.select((F.col("code") - 1).cast("int").alias("code"), name)


def hashed_features(columns: Sequence[str], width: int = 15, output: str = "hashed") -> FeatureHasher:
    return FeatureHasher(inputCols=list(columns), outputCol=output, numFeatures=width)


class FillMissing(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns one value per column from the training rows, to stand in for null and NaN.

    ``strategy`` is mean, median (exact), mode (most frequent value, ties to the smallest) or constant (``constants``, one per
    column). A column without any known value has none and keeps its nulls.
    """

    inputCols = Param(Params._dummy(), "inputCols", "columns to fill", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "names of the filled columns", TypeConverters.toListString)
    strategy = Param(Params._dummy(), "strategy", "mean, median, mode or constant", TypeConverters.toString)
    constants = Param(Params._dummy(), "constants", "values as a JSON list", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), outputCols: Sequence[str] = (), strategy: str = "mean", constants: str = "[]"):
        super().__init__()
        self._setDefault(inputCols=[], outputCols=[], strategy="mean", constants="[]")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FilledMissing:
        chosen, how = self.getOrDefault(self.inputCols), self.getOrDefault(self.strategy)
        if how not in ("mean", "median", "mode", "constant"):
            raise ValueError(f"unknown strategy {how}")
        if how == "constant":
            values = json.loads(self.getOrDefault(self.constants))
        elif how == "mean":
            values = list(df.agg(*[F.avg(_known(df, name)).alias(f"m{i}") for i, name in enumerate(chosen)]).first())
        elif how == "median":
            rows = [exact_quantiles(df.select(_known(df, name).alias("x")), "x", [0.5]).first() for name in chosen]
            values = [row and row["q0"] for row in rows]
        else:
            rows = [top_value(df.select(F.lit(1).alias("_tm_all"), _known(df, name).alias(name)), "_tm_all", name, "mode").first() for name in chosen]
            values = [row and row["mode"] for row in rows]
        return FilledMissing(inputCols=chosen, outputCols=self.getOrDefault(self.outputCols), values=json.dumps(values))


class FilledMissing(Model, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted ``FillMissing``: fills with expressions only."""

    inputCols, outputCols = FillMissing.inputCols, FillMissing.outputCols
    values = Param(Params._dummy(), "values", "learned values as a JSON list", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), outputCols: Sequence[str] = (), values: str = "[]"):
        super().__init__()
        self._setDefault(inputCols=[], outputCols=[], values="[]")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        values = json.loads(self.getOrDefault(self.values))
        named = zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.outputCols), values, strict=True)
        return df.withColumns({out: F.coalesce(_known(df, name), F.lit(value)) for name, out, value in named})


def _known(df: DataFrame, name: str) -> Column:
    return F.when(~F.isnan(name), F.col(name)) if dict(df.dtypes)[name] in ("double", "float") else F.col(name)


class PairwiseProducts(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds squares and pairwise products of chosen columns."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to multiply", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = ()):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**self._input_kwargs)

    def output_names(self) -> list[str]:
        chosen = self.getOrDefault(self.inputCols)
        return [f"{a}_x_{b}" for i, a in enumerate(chosen) for b in chosen[i:]]

    def _transform(self, df: DataFrame) -> DataFrame:
        chosen = self.getOrDefault(self.inputCols)
        return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for i, a in enumerate(chosen) for b in chosen[i:]})


def matrix_stages(
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    *,
    impute: str = "mean",
    scale: bool = True,
    encode: str = "onehot",
    extra_vectors: Sequence[str] = (),
    output: str = "features",
) -> list:
    """Per-column stages ending in one vector: impute and scale numbers, encode text."""
    stages: list = []
    parts: list[str] = []
    if numeric:
        filled = [f"{c}_filled" for c in numeric]
        stages.append(FillMissing(inputCols=list(numeric), outputCols=filled, strategy=impute))
        stages.append(VectorAssembler(inputCols=filled, outputCol="numbers", handleInvalid="keep"))
        if scale:
            stages.append(StandardScaler(inputCol="numbers", outputCol="numbers_scaled", withMean=True, withStd=True))
        parts.append("numbers_scaled" if scale else "numbers")
    if categorical:
        codes = [f"{c}_code" for c in categorical]
        stages.append(
            StringIndexer(
                inputCols=list(categorical), outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
        if encode == "onehot":
            # the unknown code is the last one and is dropped, so unknown text gives zeros
            hot = [f"{c}_hot" for c in categorical]
            stages.append(OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=True))
            parts += hot
        else:
            parts += codes
    stages.append(VectorAssembler(inputCols=[*parts, *extra_vectors], outputCol=output))
    return stages


def polynomial_stages(numeric: Sequence[str], degree: int = 2, output: str = "features") -> list:
    return [
        VectorAssembler(inputCols=list(numeric), outputCol="plain"),
        PolynomialExpansion(degree=degree, inputCol="plain", outputCol="expanded"),
        StandardScaler(inputCol="expanded", outputCol=output, withMean=True),
    ]


class InverseFrequency(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Term counts times ln((1+n)/(1+df)) + 1, as in ``text_weights``; Spark's IDF lacks the 1, so a term of all documents would weigh nothing."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ElementwiseProduct:
        columns = {"inputCol": self.getInputCol(), "outputCol": self.getOutputCol()}
        weights = IDF(**columns).fit(df).idf.toArray() + 1
        return ElementwiseProduct(scalingVec=Vectors.dense(weights), **columns)


def text_stages(text: str, *, min_df: float = 5, max_df: float = 0.85, max_features: int = 1000, output: str = "text_vector") -> list:
    return [
        RegexTokenizer(inputCol=text, outputCol="_tm_words", pattern=r"(?U)\w\w+", gaps=False),
        StopWordsRemover(inputCol="_tm_words", outputCol="_tm_terms"),
        CountVectorizer(inputCol="_tm_terms", outputCol="_tm_counts", minDF=min_df, maxDF=max_df, vocabSize=max_features),
        InverseFrequency(inputCol="_tm_counts", outputCol="_tm_weighted"),
        Normalizer(inputCol="_tm_weighted", outputCol=output),
    ]


def text_weights(
    docs: DataFrame,
    doc_id: str,
    text: str,
    *,
    stop_words: Sequence[str] = (),
    min_df: int = 5,
    max_df: float = 0.85,
    max_features: int = 1000,
) -> DataFrame:
    """TF-IDF as (document, term, weight) rows: count × (ln((1+n)/(1+df)) + 1), each document of length 1.

    The vocabulary keeps the most frequent terms, ties alphabetical, and is at most ``max_features`` rows.
    """
    words = F.filter(
        F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1)),
        lambda w: ~w.isin(*stop_words) if stop_words else F.lit(True),
    )
    present = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(doc_id, text)
    repeated = settle(docs.where(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.count(F.lit(1)).alias("_tm_n")).where("_tm_n > 1").select(doc_id), "repeated")
    # texts stay where they are, but for those of documents of several rows, whose counts are added up
    once, several = (present, None) if repeated.isEmpty() else (present.join(repeated, doc_id, "left_anti"), present.join(repeated, doc_id, "left_semi"))

    def merged(chosen: Column) -> DataFrame:
        return _one_by_one(_term_counts(several, doc_id, chosen), doc_id).groupBy(doc_id, "term").agg(F.sum("tf").alias("tf"))

    counts = _one_by_one(_term_counts(once, doc_id, words), doc_id).select("term", "tf")
    if several is not None:
        counts = counts.unionByName(merged(words).select("term", "tf"))
    size = docs.agg(F.count(F.lit(1))).scalar()
    vocabulary = (
        counts.groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("uses"))
        .where((F.col("df") >= min_df) & (F.col("df") <= size * F.lit(max_df)))
        .orderBy(F.desc("uses"), "term")
        .limit(max_features)
    )
    # at most max_features rows
    idf = {row["term"]: row["idf"] for row in vocabulary.select("term", (F.log((1 + size) / (1 + F.col("df"))) + 1).alias("idf")).collect()}
    known = F.filter(words, lambda w: w.isin(*idf) if idf else F.lit(False))
    terms = _term_counts(once, doc_id, known)
    if several is not None:
        # a document has at most max_features terms here
        terms = terms.unionByName(merged(known).groupBy(doc_id).agg(F.collect_list(F.struct("term", "tf")).alias(TERMS)))
    by_term = F.create_map(*[F.lit(x) for pair in idf.items() for x in pair]) if idf else F.lit(None).cast("map<string, double>")
    raw = terms.select(doc_id, F.transform(TERMS, lambda x: F.struct(x["term"].alias("term"), (x["tf"] * by_term[x["term"]]).alias("raw"))).alias(TERMS))
    length = F.sqrt(F.aggregate(TERMS, F.lit(0.0), lambda total, x: total + x["raw"] * x["raw"]))
    weighted = raw.withColumn("_tm_length", length)
    scaled = F.transform(TERMS, lambda x: F.struct(x["term"].alias("term"), (x["raw"] / F.col("_tm_length")).alias("weight")))
    return _one_by_one(weighted.select(doc_id, scaled.alias(TERMS)), doc_id)


TERMS = "_tm_terms"


def _term_counts(rows: DataFrame, doc_id: str, words: Column) -> DataFrame:
    """Per row its different words with their counts, from the lengths of runs in the sorted words."""
    w, starts = F.col("_tm_words"), F.col("_tm_starts")
    begins = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: (i == 1) | (F.get(w, i - 1) != F.get(w, i - 2)))
    found = rows.select(doc_id, F.sort_array(words).alias("_tm_words"))
    # a sequence from 1 to 0 would run backwards
    found = found.withColumn("_tm_starts", F.when(F.size(w) > 0, begins).otherwise(F.array().cast("array<int>")))
    runs = F.transform(
        starts, lambda at, i: F.struct(F.get(w, at - 1).alias("term"), (F.coalesce(F.get(starts, i + 1), F.size(w) + 1) - at).cast("bigint").alias("tf"))
    )
    return found.select(doc_id, runs.alias(TERMS))


def _one_by_one(terms: DataFrame, doc_id: str) -> DataFrame:
    # the inner form would ask first whether there are any, and find all words a second time for that
    return terms.select(doc_id, F.inline_outer(TERMS)).where(F.col("term").isNotNull())


def top_terms(weights: DataFrame, classes: DataFrame, doc_id: str, label: str, k: int = 5) -> DataFrame:
    """The k terms with the highest mean weight per class."""
    size = classes.groupBy(label).agg(F.count(F.lit(1)).alias("_tm_docs"))
    sums = weights.join(classes.select(doc_id, label), doc_id).groupBy(label, "term").agg(F.sum("weight").alias("_tm_sum"))
    sized = spread_join(sums, size, label, "term", hot_from=classes)
    scored = sized.select(label, "term", (F.col("_tm_sum") / F.col("_tm_docs")).alias("mean_weight"))
    rank = F.row_number().over(Window.partitionBy(label).orderBy(F.desc(F.round("mean_weight", 9)), "term"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def best_features(df: DataFrame, columns: Sequence[str], label: str, k: int):
    """Keep the k columns with the highest regression F-score; returns (fitted selector, chosen names)."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="all_features").transform(df)
    selector = UnivariateFeatureSelector(
        featuresCol="all_features", labelCol=label, outputCol="features", selectionMode="numTopFeatures"
    )
    selector = selector.setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(k)
    fitted = selector.fit(assembled)
    return fitted, [columns[i] for i in fitted.selectedFeatures]


def f_scores(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """F-score of each column against the label, r²(n-2)/(1-r²), best first."""
    one_row = df.agg(F.count(F.lit(1)).alias("n"), *[F.corr(c, label).alias(f"r{i}") for i, c in enumerate(columns)])
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            (F.pow(f"r{i}", 2) * (F.col("n") - 2) / F.nullif(1 - F.pow(f"r{i}", 2), F.lit(0.0))).alias("f_score"),
        )
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*cells)))


def pipeline(stages: Sequence, model) -> Pipeline:
    return Pipeline(stages=[*stages, model])
