"""What each of five filters removes in every order of them, per language."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.byte_transducer import counted
from mercato.llm.store import saved

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}


def failures() -> Column:
    """Bits of the filters A to D that a counted row fails."""
    rules = {
        "A": F.col("n_words") < 200,
        "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        "C": 100 * F.col("n_capitals") > 3 * F.col("n_points"),
        "D": F.col("n_symbols") > 0,
    }
    return sum(F.when(rule, BIT[f]).otherwise(0) for f, rule in rules.items())


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, part, digest, fails, good, toxic) of every row: failures of A to D, labels of the document, digest of its text."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("part"),
                      F.col(text_col).cast("string").alias("text"))
    own = own.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    rows = counted(own, ["doc_id", "part", "digest"]).withColumn("fails", failures())
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    return rows.select("doc_id", "part", "digest", "fails").join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])


def histogram(rows: DataFrame) -> DataFrame:
    """rows of judged to (part, mask, n, good, toxic): documents by the set of filters they fail, copies (E) included.

    Rows of one text are counted by id first, then per part and labels with the least id and its rows, so a text with very
    many copies is added up in many tasks and meets its least id as a handful of rows.
    """
    key = ["digest", "part", "fails", "good", "toxic"]
    by_id = rows.groupBy("doc_id", *key).agg(F.count("*").alias("n"))
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    groups = by_id.groupBy(*key).agg(F.sum("n").alias("n"), F.min(named).alias("least"),
                                     F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    groups = groups.withColumn("firsts", F.col("nameless") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0))
    apart = groups.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("fails").alias("mask"), F.col("firsts").alias("n")),
        F.struct((F.col("fails") + BIT["E"]).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")))).alias("e"))
    return apart.groupBy("part", F.col("e.mask").cast("int").alias("mask")).agg(
        F.sum("e.n").alias("n"), F.sum(F.col("e.n") * F.col("good")).alias("good"), F.sum(F.col("e.n") * F.col("toxic")).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """Per part (language), order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    E fails a row whose text is that of a row with a smaller id, anywhere in the table; repeated rows of one id are each
    judged, a row without an id never fails E and makes no other fail. Null texts are empty, null languages the part ''.
    Of several labels of a document each counts if any row holds 1; other columns are ignored. An empty table has no part.
    """
    masks = saved(histogram(judged(docs, labels, **columns)), "masks")
    steps = [(order, i + 1, BIT[order[i]], sum(BIT[f] for f in order[:i])) for order in ORDERS for i in range(len(order))]
    listed = F.from_json(F.lit("[" + ",".join('{"o":"%s","s":%d,"f":%d,"b":%d}' % s for s in steps) + "]"),
                         "array<struct<o:string,s:int,f:int,b:int>>")
    spread = masks.withColumn("t", F.explode(listed))
    mask, own, before = F.col("mask"), F.col("t.f"), F.col("t.b")
    fails, earlier = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) != 0
    removed = fails & ~earlier

    def total(which: Column, what: str) -> Column:
        return F.sum(F.when(which, F.col(what)).otherwise(0)).cast("long")

    # A document that fails k filters is removed by each of them in one k-th of all orders.
    share = F.col("n") * F.expr(f"{len(ORDERS)} div bit_count(mask)")
    return spread.groupBy("part", F.col("t.o").alias("filter_order"), F.col("t.s").alias("step")).agg(
        total(~fails & ~earlier, "n").alias("kept"), total(removed, "n").alias("removed"),
        total(fails & earlier, "n").alias("redundant"), total(mask == own, "n").alias("unique_fails"),
        total(removed, "good").alias("good_lost"), total(removed, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, share).otherwise(0)).cast("long").alias("shapley"))
