"""Mixing sources to target weights by blocks of words, with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.lineage import materialize
from .names import free_names

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST_TIMES = 1.5, 2
BLOCK_WORDS = 128
SLOTS_PER_SHARD = 1024
_ROUNDS = 10                 # of the index permutation
_LINES = 4096                # a source's documents are laid out in this many lines that follow one another
_CHUNK = 4096                # slots that one row expands to
_TASK_SLOTS = 65_536         # and about as many a task


def permuted(df: DataFrame, name: str, index: str, size: str, key: list[Column]) -> DataFrame:
    """
    `df` plus `name`: a pseudorandom permutation of 0..`size`-1, chosen by `key`, at `index`. Swap-or-not rounds: each pairs
    every index with its mirror image around a pseudorandom point and swaps the pair by a pseudorandom bit, so
    that a round is its own inverse on any size.
    """
    def swap(at: Column, i: Column) -> Column:
        mirror = F.pmod(F.xxhash64(i, *key) - at, F.col(size))
        bit = F.xxhash64(i + 1, F.greatest(at, mirror), *key).bitwiseAND(1) == 1
        return F.when(bit, mirror).otherwise(at)

    return df.withColumn(name, F.aggregate(F.array(*(F.lit(2 * i) for i in range(_ROUNDS))), F.col(index).cast("long"), swap))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most_times: float = MOST_TIMES) -> DataFrame:
    """
    `sizes` (source, source_size: one row per source) plus `target`. Sources by code point, null last, get the weights in
    turn; together they take `share` of all sizes. Where a weighted share is above `most_times` the source's size the
    target stops there and the rest is shared anew, until none is above: that is the level at which
    sum(min(most_times * size, level * weight)) is the wanted total, found by running sums in the order in which
    sources reach their limit. One row per source meets in one task here.
    """
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("_rank", rank).withColumn("_weight", weight)
    by_limit = Window.orderBy(F.col("_limit") / F.col("_weight"), "_rank")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("_limit", F.col("source_size") * float(most_times))
        .withColumn("_level", (F.lit(total * share) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
                    / F.sum("_weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", F.when(F.col("_level") <= F.col("_limit") / F.col("_weight"), F.col("_level")))
    )
    # the first source that stays below its limit sets the level
    level = rows.filter("_level IS NOT NULL").agg(F.min_by("_level", F.struct(F.col("_limit") / F.col("_weight"), F.col("_rank")))).first()[0]
    target = F.col("_limit") if level is None else F.least("_limit", F.lit(level) * F.col("_weight"))
    return rows.select("source", "source_size", "_rank", target.alias("target"))


def row_key(id_column: str = "doc_id", text_column: str = "text", seed: int = 0) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column))


def mixed_documents(docs: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """
    The mix as documents: one row, with all columns of `docs`, for each document and epoch that takes words of it; its text is
    the words taken, joined by single spaces, or the document's own text where all are taken. Rows follow `mix`; documents
    of which nothing is taken are not in the mix.
    """
    _, spans = mix(docs, text_column=text_column, **options)
    taken = spans.groupBy("row_key", "source", "first_word", "epoch", "size").agg(
        F.sort_array(F.collect_list(F.struct("word", "n_words"))).alias("_parts"), F.sum("n_words").alias("_n"))
    key = row_key(options.get("id_column", "doc_id"), text_column, options.get("seed", 0))
    source = F.col(options.get("source_column", "source"))
    own, from_ = free_names(docs, "_key", "_source")
    once = docs.withColumn(own, key).withColumn(from_, source).dropDuplicates([own, from_])
    both = once.alias("d").join(taken.alias("t"), (F.col(f"d.{own}") == F.col("t.row_key")) & F.col(f"d.{from_}").eqNullSafe(F.col("t.source")))
    words = F.regexp_extract_all(F.col(f"d.{text_column}"), F.lit(WORD), F.lit(0))
    part = lambda p: F.array_join(F.slice(words, (p["word"] + 1).cast("int"), p["n_words"].cast("int")), " ")
    text = F.when(F.col("_n") == F.col("t.size"), F.col(f"d.{text_column}")).otherwise(F.array_join(F.transform("_parts", part), " "))
    return both.select(*(text.alias(c) if c == text_column else F.col(f"d.{c}") for c in docs.columns))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most_times: float = MOST_TIMES, block_words: int = BLOCK_WORDS,
    slots_per_shard: int = SLOTS_PER_SHARD, seed: int = 0, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """
    (documents, spans). `documents`: doc_id, source, size, source_size, target, row_key (a hash of id and text), first_word
    (of the document in its source's line of words). `spans`: one row for each stretch of a document's words in each block that the mix takes: shard, slot,
    doc_id, source, size, row_key, first_word, block, epoch, word (from 0 in the document), n_words.

    Words are packed into blocks of `block_words`, source by source; the documents lie in the order of a hash. Every source
    gets slots for as many words as its target, rounded: whole epochs over all its blocks, then part of one, of which the last slot takes
    the first words of its block, so many as are left. The slots of all sources are dealt to output shards by a
    pseudorandom permutation, so that each shard's counts are a multinomial draw given the totals. A source's slots
    take its blocks through another permutation for every epoch (a last block that isn't full comes last), so that no block is taken more than
    once more often than another and, as targets end at `most_times` the size, no document more than `most_times` its size. The slots
    are written, in as many partitions as their number needs; slots and blocks are joined by (source, block); all row counts follow the input
    and no key is hot: a large source is many blocks.

    Null texts have no words and no spans; null sources are one source; null ids and repeated rows count as documents
    (equal rows lie side by side and share what is taken in their order); an empty table gives empty tables; other columns are not read.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
        F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_key(id_column, text_column, seed).alias("_order"))
    # equal rows first as one, so that they cannot fill one line; split again below
    rows = materialize(
        rows.groupBy("source", "doc_id", "size", "_order").agg(F.count("*").alias("_times")).withColumn("_line", F.pmod("_order", F.lit(_LINES))),
        "mix-rows")
    words = F.col("size") * F.col("_times")
    lines = materialize(rows.groupBy("source", "_line").agg(F.sum(words).alias("_words")), "mix-lines")
    sizes = materialize(lines.groupBy("source").agg(F.sum("_words").alias("source_size")), "mix-sources")      # one row per source
    targets = materialize(source_targets(sizes, weights, share, most_times), "mix-targets")
    # at most _LINES rows per source in a group
    starts = lines.withColumn(
        "_start", F.sum("_words").over(Window.partitionBy("source").orderBy("_line")) - F.col("_words")).drop("_words")
    within = Window.partitionBy("source", "_line").orderBy("_order", F.col("doc_id").asc_nulls_last(), "size")
    same_source = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    laid = (
        rows.withColumn("_in_line", F.sum(words).over(within) - words).alias("r")
        .join(starts.alias("s"), same_source("r", "s") & (F.col("r._line") == F.col("s._line")))
        .join(targets.alias("t"), same_source("r", "t"))
        .select("r.doc_id", "r.source", "r.size", "t.source_size", "t.target", "t._rank", F.col("_order").alias("row_key"), (F.col("_start") + F.col("_in_line")).alias("_first"), "_times")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)))
        .withColumn("first_word", F.col("_first") + F.col("_copy") * F.col("size")).drop("_first", "_times", "_copy")
    )
    # slots
    size, in_full = F.col("source_size"), F.floor(F.col("source_size") / block_words).cast("long")
    plan = materialize(
        targets.filter("source_size > 0").withColumn("_words", F.least(F.round("target").cast("long"), F.floor(size * float(most_times))))
        .withColumns({"_full": in_full, "_blocks": F.ceil(size / block_words).cast("long"), "_epochs": F.floor(F.col("_words") / size)})
        .withColumn("_rest", F.col("_words") - F.col("_epochs") * size)
        .withColumn("_slots", F.col("_epochs") * F.col("_blocks") + F.ceil(F.col("_rest") / block_words))
        .filter("_slots > 0")
        .withColumn("_base", F.sum("_slots").over(Window.orderBy("_rank")) - F.col("_slots"))      # one row per source
        .withColumn("_all", F.sum("_slots").over(Window.partitionBy(F.lit(0))))
        .select("_rank", "_full", "_blocks", "_epochs", "_rest", "_slots", "_base", "_all"),
        "mix-plan")
    n_slots = plan.agg(F.max("_all")).first()[0] or 0
    slots = (
        plan.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slots") - 1, F.lit(_CHUNK).cast("long"))))
        .repartition(max(1, -(-n_slots // _TASK_SLOTS)), "_rank", "_from")
        .withColumn("_i", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + _CHUNK, "_slots") - 1)))
        .withColumn("epoch", F.floor(F.col("_i") / F.col("_blocks")))
        .withColumn("_in_epoch", F.pmod("_i", "_blocks"))
        .withColumn("_place", F.col("_base") + F.col("_i"))
        .withColumn("_most", F.greatest("_full", F.lit(1).cast("long")))
    )
    slots = permuted(slots, "_mixed", "_in_epoch", "_most", [F.lit(seed), F.col("_rank"), F.col("epoch")])
    slots = permuted(slots, "_out", "_place", "_all", [F.lit(seed), F.lit(-1)])
    left = F.when(F.col("epoch") == F.col("_epochs"), F.least(F.lit(block_words), F.col("_rest") - F.col("_in_epoch") * block_words)).otherwise(F.lit(block_words))
    slots = materialize(slots.select(
        "_rank", F.when(F.col("_in_epoch") < F.col("_full"), F.col("_mixed")).otherwise(F.col("_full")).alias("block"), "epoch",
        F.floor(F.col("_out") / slots_per_shard).alias("shard"), F.pmod("_out", F.lit(slots_per_shard)).alias("slot"), left.cast("int").alias("_limit")), "mix-slots")
    # the documents' stretches in each block
    first, last = F.floor(F.col("first_word") / block_words), F.floor((F.col("first_word") + F.col("size") - 1) / block_words)
    begin = F.greatest(F.col("block") * block_words, "first_word")
    stretches = (
        laid.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
        .withColumn("word", begin - F.col("first_word"))
        .withColumn("n_words", F.least((F.col("block") + 1) * block_words, F.col("first_word") + F.col("size")) - begin)
        .select("_rank", "block", "doc_id", "source", "size", "row_key", "first_word", "word", "n_words")
    )
    in_block = F.col("first_word") + F.col("word") - F.col("block") * block_words
    spans = stretches.join(slots, ["_rank", "block"]).withColumn("n_words", F.least(F.col("n_words"), F.col("_limit") - in_block)).filter("n_words > 0").select(
        "shard", "slot", "doc_id", "source", "size", "row_key", "first_word", "block", "epoch", "word", "n_words")
    return laid.drop("_rank"), spans


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    documents, spans = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    key = ["doc_id", "source", "size", "first_word"]
    taken = spans.groupBy(*key).agg(F.sum("n_words").alias("taken"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in key]
    return documents.alias("d").join(taken.alias("t"), same[0] & same[1] & same[2] & same[3], "left").select(
        "d.doc_id", "d.source", "d.size", "d.source_size", "d.target", F.coalesce("t.taken", F.lit(0).cast("long")).alias("taken"))
