"""The set of message ids that have been handled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..operators.joins import keyed_join
from ..schemas import PROCESSED


def load_processed(spark: SparkSession, path: str) -> DataFrame:
    """Ids from JSON text; a missing file counts as empty, and so does a file with a broken array.

    Reads one id per line, one object per line, or arrays of ids, on one line or over several. Files without an array
    are split between tasks like any text; a file with one is read whole, since only then is its end known.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PROCESSED)
    file = F.col("_metadata.file_path").alias("file")
    # The driver has listed the files already, so their names fit.
    whole = [r["file"] for r in lines.filter(F.col("value").rlike(r"^\s*\[")).select(file).distinct().collect()]
    single = F.coalesce(
        F.get_json_object("value", "$.message_id"),
        F.nullif(F.regexp_extract("value", r'^\s*"([^"]*)",?\s*$', 1), F.lit("")),
    )
    ids = lines.filter(~file.isin(whole) if whole else F.lit(True)).select(single.alias("message_id"))
    if whole:
        # Without line breaks every array of a file is on its own line, or the file is one array.
        text = F.regexp_replace("value", r"\s*\n\s*(?!\[)", " ")
        arrays = F.filter(F.split(text, "\n"), lambda line: F.trim(line) != "")
        listed = F.transform(arrays, _array_of_ids)
        sound = ~F.exists(listed, lambda x: x.isNull())
        read = spark.read.text(whole, wholetext=True).select(F.when(sound, F.flatten(listed)).alias("ids"))
        ids = ids.unionByName(read.select(F.explode("ids").alias("message_id")))
    return ids.filter("message_id is not null")


def _array_of_ids(text: Column) -> Column:
    """The array a text holds, or null if it is no whole JSON array."""
    closed = F.trim(text).startswith("[") & F.trim(text).endswith("]")
    return F.when(closed, F.from_json(text, "array<string>", {"mode": "PERMISSIVE"}))


def mark_processed(processed: DataFrame, new_ids: DataFrame) -> DataFrame:
    """The processed set with ``new_ids`` added; adding an id twice changes nothing."""
    return processed.select("message_id").union(new_ids.select("message_id")).distinct()


def save_processed(processed: DataFrame, new_ids: DataFrame, path: str) -> None:
    """Append the ids that are not in the set yet."""
    fresh = unprocessed(new_ids.select("message_id").distinct(), processed)
    fresh.write.mode("append").json(path)


def export_processed(processed: DataFrame) -> DataFrame:
    """The sorted id list."""
    return processed.select("message_id").distinct().orderBy("message_id")


def unprocessed(messages: DataFrame, processed: DataFrame) -> DataFrame:
    """Messages whose id is not in the processed set."""
    return keyed_join(messages, processed.select("message_id"), ["message_id"], "left_anti")


def next_messages(
    messages: DataFrame, processed: DataFrame, n: int = 10, limit_first: bool = False
) -> DataFrame:
    """The ``n`` newest unhandled messages.

    ``limit_first`` takes the newest ``n`` before looking at the processed set, which
    never reaches older unread mail.
    """
    from .messages import latest_messages

    if limit_first:
        return unprocessed(latest_messages(messages, n), processed)
    return latest_messages(unprocessed(messages, processed), n)
