"""A mail classifier that is trained on labelled mail and scored in the JVM.

Words are hashed, weighed by how rare they are, and given to a multinomial logistic regression. Training and scoring are Spark ML's and
distributed; the model is saved and loaded as a folder. The phrase rules of ``models.classify`` serve where a
text has no word at all or no model is there.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .models import classify

#: Slots that words are hashed to, and rounds of the regression.
SLOTS, ROUNDS, PENALTY = 1 << 15, 30, 1e-3


def held_out(message_id: Column) -> Column:
    """Messages that training leaves out: crc32 of the id leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(message_id.cast("binary")) % 3 == 1, F.lit(False))


def train_classifier(labelled: DataFrame) -> PipelineModel:
    """Model from mail (text, label); rows without either are left out. At least one row is needed."""
    rows = labelled.filter("text is not null and label is not null").select("text", "label")
    labels = StringIndexer(inputCol="label", outputCol="_y", stringOrderType="alphabetAsc").fit(rows)
    return Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=SLOTS, binary=True),
        IDF(inputCol="_tf", outputCol="_x", minDocFreq=2), labels,
        LogisticRegression(featuresCol="_x", labelCol="_y", predictionCol="_p", maxIter=ROUNDS, regParam=PENALTY, family="multinomial"),
        IndexToString(inputCol="_p", outputCol="_label", labels=labels.labels),
    ]).fit(rows)


def classify_trained(messages: DataFrame, model: PipelineModel | None) -> DataFrame:
    """(message_id, label) of messages (message_id, text) by a trained model, by phrase rules where it has nothing to go by."""
    rows = messages.select("message_id", "text")
    rules = classify(F.col("text"))
    if model is None:
        return rows.select("message_id", rules.alias("label"))
    # Scoring needs no labels, so the stage that indexes them is left out.
    scored = rows.withColumn("text", F.coalesce("text", F.lit("")))
    for stage in model.stages:
        if "StringIndexer" not in type(stage).__name__:
            scored = stage.transform(scored)
    return scored.select("message_id", F.when(F.size("_words") > 0, F.col("_label")).otherwise(rules).alias("label"))


def macro_f1(answers: DataFrame) -> float:
    """Mean F1 over the labels of (label, answer) rows; the driver gets one row per pair of labels."""
    counts = {(r["label"], r["answer"]): r["count"] for r in answers.groupBy("label", "answer").count().collect()}
    labels = sorted({label for label, _ in counts if label is not None})
    total = 0.0
    for label in labels:
        right = counts.get((label, label), 0)
        said = sum(n for (_, a), n in counts.items() if a == label)
        there = sum(n for (x, _), n in counts.items() if x == label)
        total += 2 * right / (said + there)
    return total / len(labels) if labels else 0.0
