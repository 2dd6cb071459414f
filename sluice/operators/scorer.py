"""A quality scorer trained on labelled texts: hashed terms, inverse document frequency, logistic regression."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import HashingTF, IDF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import WORD
from sluice.session import intermediates


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``_id``, ``_text`` and ``label`` of labelled texts; null labels teach nothing, null texts are empty."""
    marks = labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col), F.col(label_col).cast("double").alias("label"))
    return docs.join(marks, id_col).select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"), "label")


def holdout(id_col: str, parts: int = 5) -> Column:
    """True for one row of ``parts``, by a hash of its id."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit("holdout")), F.lit(parts)) == 0


def train_scorer(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, features: int = 1 << 16,
    iterations: int = 40, penalty: float = 0.1,
) -> PipelineModel:
    """The fitted pipeline. Features are hashed to a fixed width, so nothing on the driver grows with the words; gradients
    are summed in a tree over the partitions. The model is stored in the shared folder and read back, without the table
    and the session that a freshly fitted one still holds on to."""
    rows = labelled(docs, labels, id_col, text_col, label_col)
    stages = [
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=WORD, gaps=False),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features),
        IDF(inputCol="_counts", outputCol="_terms", minDocFreq=2),
        # Long texts weigh no more than short ones.
        Normalizer(inputCol="_terms", outputCol="_weights"),
        LogisticRegression(
            featuresCol="_weights", probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_out", maxIter=iterations,
            regParam=penalty, aggregationDepth=3,
        ),
    ]
    folder = f"{intermediates(docs.sparkSession)}/model-{uuid.uuid4().hex}"
    Pipeline(stages=stages).fit(rows).save(folder)
    return PipelineModel.load(folder)


def score_texts(model: PipelineModel, df: DataFrame, text_col: str, output: str = "score") -> DataFrame:
    """``df`` with the probability that a text has the label, in one pass without an exchange."""
    out = model.transform(df.withColumn("_text", F.coalesce(text_col, F.lit(""))))
    return out.select(*df.columns, vector_to_array("_p")[1].alias(output))


def held_out_auc(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, **options
) -> float:
    """Area under the curve on a fifth of the labelled rows that did not train."""
    model = train_scorer(docs, labels.filter(~holdout(id_col)), id_col, text_col, label_col, **options)
    rows = labelled(docs, labels.filter(holdout(id_col)), id_col, text_col, label_col)
    out = model.transform(rows)
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="_raw").evaluate(out)
