"""Mixing sources to target weights, with DataFrame functions only.

Every source gets a target of words: the sources in code point order (null
last) weigh 5, 2, 1, 5, 2, ... and share ``SHARE`` times all words; no target
exceeds ``MOST`` times its source's words, and what a capped source leaves is
shared by weight among the others.  Documents get hash-random keys, are
(the MD5 of seed and id) range-sorted within their source, and distributed prefix sums of their words
say where the source's budget ends: whole epochs first, then the documents up
to the cut, the last of them in part, so a source gives its target to the word.

Null and empty texts have size 0 and are never taken; a source of size 0 has
target 0.  Rows that repeat a doc_id are documents of their own; where key, id
and size tie, the rows are alike and share the result in any order.  An empty
table gives no row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.llm.prefix import running

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 17
_SPACE = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; 0 for null."""
    bare = F.btrim(text, F.lit(_SPACE))
    return F.when(F.length(bare) > 0, F.size(F.split(bare, rf"[{_SPACE}]+"))).otherwise(0).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.  A source is
    capped if its cap is at most its weight times the level at which the
    sources that are not capped share the rest; the caps over the weights are
    sorted, so the level follows from running sums."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running(per.withColumn("_one", F.lit(1)), [F.col("source").asc_nulls_last()], {"_rank": "_one"}).drop("_one")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_rank") % len(WEIGHTS) + 1).cast("int"))
    capped = ranked.withColumn("_w", weight.cast("double")).withColumn("_cap", F.col("source_size") * float(MOST))
    capped = capped.withColumn("_ratio", F.col("_cap") / F.col("_w")).drop("_rank")
    before = running(capped, [F.col("_ratio"), F.col("source").asc_nulls_last()], {"_caps": "_cap", "_ws": "_w"})
    total = capped.agg(F.sum("source_size").alias("words"), F.sum("_w").alias("weight")).first()
    if total["words"] is None:
        return capped.select("source", "source_size", F.col("_cap").alias("target"))
    level = (F.lit(float(total["words"]) * SHARE) - F.col("_caps")) / (F.lit(total["weight"]) - F.col("_ws"))
    # the level is that of the first source, in order of the ratios, whose ratio reaches its own
    cut = before.withColumn("_level", level).where(F.col("_ratio") >= F.col("_level")) \
        .agg(F.min_by("_level", F.struct("_ratio", "_caps"))).first()[0]
    target = F.col("_cap") if cut is None else F.least(F.col("_cap"), F.col("_w") * cut)
    return capped.select("source", "source_size", target.alias("target"))


def taken(documents: DataFrame, keep: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every document,
    and the columns of ``keep``."""
    keep = keep or {}
    sized = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                             *(c.alias(k) for k, c in keep.items()))
    keyed = sized.withColumn("_key", F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    order = [F.col("source").asc_nulls_last(), F.col("_key"), F.col("doc_id"), F.col("size")]
    placed = running(keyed, order, {"_before": "size"}, group="source")
    targets = source_targets(placed).withColumnRenamed("source", "_source")
    budget = F.floor(F.col("target")).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    part = F.least(F.greatest(budget - F.col("_epochs") * F.col("source_size") - F.col("_before"), F.lit(0)), F.col("size"))
    return (placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("_epochs", epochs.cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", *keep,
                    (F.col("_epochs") * F.col("size") + part).alias("taken")))


def mix(documents: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``documents``: a row for each whole
    copy that is taken, and for the document that a source's cut divides one
    more with its first words (joined by single blanks).  Rows alike in all they
    hold are one document here, taken as often as they are together; rows that
    repeat id and text but differ in another column (maps aside) are not.
    Columns beside doc_id, source, text and n_chars travel on as they are,
    whatever their names."""
    held = [F.col(f"`{c}`") for c in documents.columns if "map<" not in documents.schema[c].dataType.simpleString()]
    mark = F.xxhash64(*held, *(c.isNull() for c in held))
    share = taken(documents, keep={"_mark": mark}).groupBy("doc_id", "_mark").agg(
        F.max("size").alias("size"), F.sum("taken").alias("taken")).where("taken > 0")
    share = share.select(F.col("doc_id").alias("id"), F.col("_mark").alias("its"), "size", "taken")
    # the document's columns travel as one, whatever their names
    rows = documents.select(F.struct(*documents.columns).alias("doc"), mark.alias("mark")).join(
        share, F.col("doc.doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("its"))).dropDuplicates(["id", "its"])
    whole, rest = F.expr("cast(taken div size as int)"), F.expr("cast(taken % size as int)")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(rest > 0, F.array(rest)).otherwise(F.expr("array()")))
    rows = rows.select("doc", F.explode(copies).alias("words"))
    bare = F.btrim(F.col("doc.text"), F.lit(_SPACE))
    cut = F.array_join(F.slice(F.split(bare, rf"[{_SPACE}]+"), 1, F.greatest(F.col("words"), F.lit(1))), " ")
    text = F.when(F.col("words") > 0, cut).otherwise(F.col("doc.text"))
    new = {"text": text}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.when(F.col("words") > 0, F.length(cut)).otherwise(F.col("doc.n_chars")).cast(documents.schema["n_chars"].dataType)
    return rows.select(*(new.get(c, F.col("doc")[c]).alias(c) for c in documents.columns))
