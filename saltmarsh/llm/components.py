"""Connected components of a link table, without collecting it: least labels with pointer jumping.

Defined cases: links with a null end, and links of a node to itself, join nothing; repeated links and links both ways count
once; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b: long): the least node that can be reached.

    Each round takes the least label among a node's neighbours and then the label of that label, so paths shorten by
    halves; labels only fall, so rounds end. Every round is a written table, and the one before it goes. Hot nodes are
    pre-aggregated map-side, and joins may split them.
    """
    spark = links.sparkSession
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    now = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", "node", F.least("node", "m")).toDF("node", "label", "next"), "labels")
    while not now.where("next <> label").isEmpty():
        labels = now.select("node", F.col("next").alias("label"))
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("m"))
        low = stored(labels.join(near, F.col("node") == F.col("a")).select("node", "label", F.least("label", "m").alias("low")), "labels-low")
        up = low.select(F.col("node").alias("_n"), F.col("low").alias("_low"))
        after = stored(low.join(up, F.col("low") == F.col("_n"), "left").select("node", "label", F.least("low", F.coalesce("_low", "low")).alias("next")), "labels")
        release(spark, [now, low])
        now = after
    release(spark, [both])
    out = now.select("node", F.col("next").alias("component"))
    out.stored_at = now.stored_at
    return out
