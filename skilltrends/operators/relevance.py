"""Passage relevance classifier with MLlib.

Training data: documents with a 0/1 label. Pipeline: regex tokens -> HashingTF (2**18 columns, a
documented width; every token counts, none is cut off) -> IDF -> L2 Normalizer -> LogisticRegression.
A decision threshold below 0.5 favours recall (few relevant passages missed).
The fitted pipeline is saved to / loaded from shared storage with ``PipelineModel``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .select_text import TOKEN_RX


def relevance_pipeline(text_col: str = "text", label_col: str = "label",
                       width: int = 1 << 18, threshold: float = 0.35,
                       max_iter: int = 25, reg: float = 0.01) -> Pipeline:
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=TOKEN_RX,
                         gaps=False, toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=width)
    idf = IDF(inputCol="_tf", outputCol="_tfidf")
    norm = Normalizer(inputCol="_tfidf", outputCol="features", p=2.0)
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter,
                            regParam=reg, threshold=threshold)
    return Pipeline(stages=[tok, tf, idf, norm, lr])


def train(df: DataFrame, **kw) -> PipelineModel:
    """Fit the pipeline. The tokenised input is persisted (memory and disk, recomputable
    from lineage) while the idf and classifier passes run over it, so the
    regex tokenisation of the texts runs once instead of once per fitted stage."""
    from pyspark import StorageLevel
    stages = relevance_pipeline(**kw).getStages()
    tok, rest = stages[0], stages[1:]
    tokens = tok.transform(df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = Pipeline(stages=rest).fit(tokens)
    finally:
        tokens.unpersist()
    return PipelineModel(stages=[tok] + list(fitted.stages))


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    out = model.transform(df)
    p1 = F.get(vector_to_array(F.col("probability")), 1)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      p1.alias("p_relevant"))


def columns_of(tokens: DataFrame, width: int = 1 << 18) -> DataFrame:
    """(token, column): the hashed column of each token of a (token) table of distinct tokens."""
    tf = HashingTF(inputCol="_t", outputCol="_v", numFeatures=width)
    hashed = tf.transform(tokens.select("token", F.array("token").alias("_t")))
    place = F.regexp_extract(F.col("_v").cast("string"), r"\[(\d+)\]", 1)  # (width,[column],[1.0])
    return hashed.select("token", place.cast("int").alias("column"))


def model_tables(spark: SparkSession, model: PipelineModel) -> tuple[DataFrame, DataFrame, float]:
    """The fitted pipeline as tables for relational scoring: (column, idf), (column, coef) and the
    intercept. Both tables have ``width`` rows (a model parameter).

    ``select_text.linear_scores`` over them, with term counts per hashed column
    (:func:`columns_of`), gives the classifier's margin."""
    idf_model, lr = model.stages[2], model.stages[-1]
    idf_t = spark.createDataFrame(enumerate(idf_model.idf.toArray().tolist()), "column INT, idf DOUBLE")
    coef_t = spark.createDataFrame(enumerate(lr.coefficients.toArray().tolist()), "column INT, coef DOUBLE")
    return idf_t, coef_t, float(lr.intercept)
