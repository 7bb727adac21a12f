"""Connected components of a link table by contraction, without bringing links together.

Each round every node takes the least of itself and its neighbours as its label, found by an
aggregation; labels of labels are followed (pointer jumping, one row a node) until all of them name
themselves. Then the links are read once more, now between labels: those inside a class are gone,
those between two classes are one. So a group of g nodes with g * g links costs its links once, not
once a round. The tables of a round are cut into the shared folder and deleted when the next ones stand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadbay.session import cut, drop_cut


def components(links: DataFrame) -> DataFrame:
    """links: (a long, b long). Returns (node, label): label is the least node it reaches.

    Null ends are left out; loops and repeated links are harmless; no links, no rows.
    """
    links = _between(links.where("a IS NOT NULL AND b IS NOT NULL"))
    labels = None
    while True:
        own = _followed(cut(links.select("a", "b").union(links.select("b", "a")).groupBy("a").agg(F.min("b").alias("m"))
                            .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels"))
        if labels is None:
            labels, spent = own, []
        else:
            # a label without links left is final
            to = own.select(F.col("node").alias("_label"), F.col("label").alias("_to"))
            spent = [labels, own]
            labels = cut(labels.join(to, F.col("label") == F.col("_label"), "left").select(
                "node", F.coalesce("_to", "label").alias("label")), "labels")
        at_a = own.select(F.col("node").alias("_a"), F.col("label").alias("la"))
        at_b = own.select(F.col("node").alias("_b"), F.col("label").alias("lb"))
        left = _between(links.join(at_a, F.col("a") == F.col("_a")).join(at_b, F.col("b") == F.col("_b"))
                        .select(F.col("la").alias("a"), F.col("lb").alias("b")))
        for old in [links, *spent]:
            drop_cut(old)
        links = left
        if links.isEmpty():
            drop_cut(links)
            return labels


def _between(links: DataFrame) -> DataFrame:
    """Each pair of different ends once, the lesser end first."""
    return cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")


def _followed(labels: DataFrame) -> DataFrame:
    """Labels of labels, until every label names itself."""
    while True:
        up = labels.select(F.col("node").alias("up"), F.col("label").alias("top"))
        jumped = cut(labels.join(up, labels["label"] == up["up"]).select(
            "node", F.col("label").alias("old"), F.col("top").alias("label")), "labels")
        changed = jumped.where("old <> label").limit(1).count()
        drop_cut(labels)
        kept = jumped.drop("old")
        kept._cut_path = jumped._cut_path
        labels = kept
        if not changed:
            return labels
