"""Connected components of a link table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexfold.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its least reachable node, of links ``a``, ``b``.

    Links are taken both ways; null ends and loops add nothing.  Every round
    takes the least label among neighbours and then the label's own label, so
    rounds grow with the logarithm of a component's width.
    """
    both = links.filter("a is not null and b is not null and a <> b").select("a", "b")
    both = written(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        near = both.join(label, both.b == label.node).groupBy("a").agg(F.min("component").alias("m"))
        lower = label.join(near, label.node == near.a).select("node", "component", F.least("component", "m").alias("l"))
        up = label.select(F.col("node").alias("p"), F.col("component").alias("jump"))
        new = written(lower.join(up, lower.l == up.p).select("node", F.least("l", "jump").alias("component"), (F.least("l", "jump") < F.col("component")).alias("moved")), "labels")
        label = new.select("node", "component")
        if new.filter("moved").isEmpty():
            return label
