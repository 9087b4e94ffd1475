"""DataFrame helpers shared by the operators of this folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.kernels import FILTER_BITS
from ledgermill.session import cut_lineage as cut
from ledgermill.session import discard as drop

_PIECE = 32_768  # bits held by one value of bitmap_construct_agg


#: Rows and bytes of one batch handed to Python. A batch is held several times over, by the JVM and by Python, and texts
#: may be long, so the defaults (10,000 rows, 64 MB) would need hundreds of megabytes per task.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after its session has been told to hand rows to Python in small batches."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def bitmap_of(hashes: DataFrame) -> np.ndarray:
    """Bitmap of the 64-bit hashes in the only column, ``FILTER_BITS`` bits whatever the input.

    The driver gets at most 256 pieces of 4 KB.
    """
    h = F.col(hashes.columns[0])
    slot = F.pmod(F.shiftrightunsigned(h, 8), F.lit(FILTER_BITS))
    pieces = (
        hashes.select(slot.alias("slot"))
        .groupBy(F.floor(F.col("slot") / _PIECE).alias("piece"))
        .agg(F.bitmap_construct_agg((F.col("slot") % _PIECE)).alias("bits"))
        .collect()
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in pieces:
        at = row["piece"] * (_PIECE // 8)
        out[at : at + _PIECE // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Connected components: (node, component), component being the smallest node.

    Alternates large-star and small-star steps on a table of edges in the shared folder until it
    no longer changes. Every step is an aggregate and a join; no neighbourhood is gathered.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        ).distinct()

    def sign(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    now = cut(ordered(edges.select(F.col(u).alias("u"), F.col(v).alias("v"))))
    mark = sign(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = ordered(
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        last, now = now, cut(ordered(
            small.select("u", F.col("m").alias("v")).unionByName(
                small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            )
        ))
        drop(last)
        before, mark = mark, sign(now)
        if mark == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
