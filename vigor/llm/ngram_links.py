"""The links of operator 4 themselves: verified pairs between classes, and the number of links of every document.

:func:`ngram_join.join` gives components and skips pairs that can't change them.  Here every list of a prefix shingle is
read in tiles with each class as a component of its own, so no link between different texts is left out; size bands,
bitmaps and the exact intersection are the join's.  Documents with the same shingle set are one class: they link with each other
and all with the same others, so copies are never paired, and a document's links are counted from the sizes of classes.

The cost follows the links: a group of near copies with different texts has as many pairs as it has links.

Defined cases: those of the join.  A null or wordless text has no class and no links; rows that repeat a doc_id are one document; rows without doc_id
are left out; other columns are ignored; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngram_join import passing, signatures, tiled_pairs, verified
from .shared import stored

#: Rows of a list that a task holds: all pairs of a tile may link here, and their ids are what it keeps in memory.
TILE = 1024


def _signed(docs: DataFrame, k: int, share: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Stored signatures of the documents that have an id, and (f1, f2, n, rep, size) of their classes."""
    if 2 * share[0] <= share[1]:
        raise ValueError("shares up to 1/2 are not supported: bitmaps are compared over one doubling of size")
    signed = stored(signatures(docs.filter(F.col("doc_id").isNotNull()), k, share), "signatures")
    classes = signed.filter("n > 0").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("size"))
    return signed, stored(classes, "classes")


def _links(docs: DataFrame, signed: DataFrame, classes: DataFrame, k: int, share: tuple[int, int]) -> DataFrame:
    members = stored(signed.join(classes, ["f1", "f2", "n"]).filter(F.col("doc_id") == F.col("rep")).dropDuplicates(["rep"])
                     .select("rep", "n", "prefix", "bits", "wide"), "members")
    lists = members.select("rep", F.explode("prefix").alias("token"))
    shared = lists.groupBy("token").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("token")
    postings = stored(lists.join(shared, "token").join(members.select("rep", "n", "bits"), "rep").select(
        "token", "rep", "n", F.col("rep").alias("component"), "bits"), "postings")
    tiled = stored(tiled_pairs(postings, share, TILE), "tiled")
    return verified(stored(passing(tiled, members.select("rep", "n", "wide"), share), "candidates"), docs, k, share).distinct()


def links(docs: DataFrame, *, k: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """(a, b), a < b: every two classes that link, by their smallest doc_id."""
    return _links(docs, *_signed(docs, k, share), k, share)


def memberships(docs: DataFrame, *, k: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """(doc_id, rep, n_links): the class of every document and the number of other documents that it links with."""
    signed, classes = _signed(docs, k, share)
    pairs = stored(_links(docs, signed, classes, k, share), "links")
    sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("rep").alias("b"), "size")
    others = sides.join(sizes, "b").groupBy(F.col("a").alias("rep")).agg(F.sum("size").alias("others"))
    counted = classes.join(others, "rep", "left").select(
        "f1", "f2", "n", "rep", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    ids = signed.select("doc_id", "f1", "f2", "n").distinct()
    return ids.join(counted, ["f1", "f2", "n"], "left").select("doc_id", "rep", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
