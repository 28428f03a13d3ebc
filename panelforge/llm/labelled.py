"""A bounded sample of labelled documents for fitting a classifier on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, written

ALL = 1_000_000


def sampled(doc_id: Column, label: Column, shares: tuple[int, int], seed: int = 5) -> Column:
    """Whether a hash of the id alone puts it among so many millionths of all ids, by the label 0 or 1."""
    return F.pmod(F.xxhash64(F.lit(seed), doc_id), F.lit(ALL)) < F.when(label == 0, shares[0]).otherwise(shares[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, most_bytes: int, balanced: bool = False) -> tuple[DataFrame, tuple[int, int]]:
    """(doc_id, text, label int) of about so many labelled documents, each id once, none of them held out, and the shares of the documents of label 0 and 1 that they are, in millionths.

    Which documents are taken depends on a hash of their id and their label; where their texts have more bytes than most_bytes together, the shares
    are lowered so that they have about as many. balanced takes each label's documents up to half of rows, and what the rarer one leaves of its half from the other,
    so a rare label isn't lost in the sample. Rows without a label or id are left out; an id with more than one label takes the
    smallest, one with more than one text the first in order. The sample is written to the shared folder.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    known = known.where(~held_out(F.col("doc_id")))
    few, many = known.agg(F.count(F.when(F.col("label") == 0, 1)), F.count(F.when(F.col("label") != 0, 1))).first()
    if balanced:
        wanted = max(rows // 2, rows - many), max(rows // 2, rows - few)
        shares = tuple(min(ALL, int(ALL * w / max(1, n))) for w, n in zip(wanted, (few, many), strict=True))
    else:
        shares = (min(ALL, int(ALL * rows / max(1, few + many))),) * 2
    chosen = known.where(sampled(F.col("doc_id"), F.col("label"), shares)).groupBy("doc_id").agg(F.min("label").alias("label"))
    # texts that no label's share takes don't come to the join
    most = (max(shares),) * 2
    found = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & sampled(F.col("doc_id"), F.lit(0), most)).join(chosen, "doc_id")
    found = written(found.groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")))
    size = found.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most_bytes:
        shares = tuple(int(s * most_bytes / size) for s in shares)
        found = found.where(sampled(F.col("doc_id"), F.col("label"), shares))
    return found, shares
