"""Mixing sources to target weights, in fixed-length blocks of words.

Every source is one long stream of words, in an order of documents given by a hash of their ids, and
is cut into blocks of ``block_words``; the last one may be shorter. The mixture needs a number of
blocks of each source. All those slots form one deck, which a pseudorandom permutation deals to the
output shards: the numbers of each source in a shard are a multinomial draw that adds up to the
source's target. A source's k-th slot takes the block that the source's own permutation puts at k;
a second permutation serves the second pass. Slots and documents meet in a join on the block number.

The last slot of a source is cut short, so a source's words come out at its target, rounded.

Only DataFrame functions are used. One source may hold most rows, and rows may lack ids: streams are laid
out by prefix sums over ranges of their order, not by a window over the source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.llm.common import partitions, permuted, stored, text_key, whole_text, word_array, word_count

# The weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
CHUNK = 65_536


@dataclass(frozen=True)
class MixRule:
    """``share``: words of the mixture over words there are. ``cap``: most uses of a source, at most 2.

    ``slots_per_shard``: blocks in an output shard.
    """

    weights: tuple[int, ...] = WEIGHTS
    share: float = 1.5
    cap: float = 2.0
    block_words: int = 1024
    slots_per_shard: int = 1024


def id_hash(doc_id: Column) -> Column:
    """32 bits that spread even consecutive ids evenly; a null id counts as 0."""
    low = F.pmod(F.coalesce(doc_id, F.lit(0)).cast("long"), F.lit(1 << 31).cast("long"))
    return F.pmod(low * F.lit(2654435761).cast("long"), F.lit(1 << 32).cast("long"))


def sized(docs: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """One row per document with its size; the text itself is read only here."""
    return stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").alias("source"),
            word_count(whole_text("text")).cast("long").alias("size"),
            text_key("text").alias("text_key"),
            id_hash(F.col("doc_id")).alias("h"),
        ),
        "mix-sizes",
    )


def source_targets(sizes: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """One row per source: words, weight, target and numbers of blocks and slots.

    Shares follow the weights; a source whose share exceeds ``cap`` times its words gets that, and the
    rest is shared among the others by weight. Sorted by words per weight, the capped sources come
    first, so the level is found in one pass over the sources.
    """
    if not 0 < rule.share <= rule.cap <= 2:
        raise ValueError("0 < share <= cap <= 2 must hold")
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in rule.weights])
    per = per.withColumn("rank", F.row_number().over(by_name).cast("long") - 1)
    per = per.withColumn(
        "weight", F.element_at(weights, (F.col("rank") % len(rule.weights) + 1).cast("int"))
    )
    most = F.col("source_size") * F.lit(float(rule.cap))
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before, after = Window.unboundedPreceding, Window.unboundedFollowing
    total = F.sum("source_size").over(Window.partitionBy())
    level = (
        total * F.lit(float(rule.share))
        - F.coalesce(F.sum(most).over(by_cap.rowsBetween(before, -1)), F.lit(0.0))
    ) / F.sum("weight").over(by_cap.rowsBetween(0, after))
    per = per.withColumn("_level", level)
    # While sources are capped the level rises, from the first uncapped one on it falls.
    per = per.withColumn("_level", F.max("_level").over(Window.partitionBy()))
    target = F.least(most, F.col("_level") * F.col("weight"))
    size, block = F.col("source_size"), F.lit(rule.block_words)
    per = per.withColumn("target", target).withColumn("take", F.floor(F.col("target") + 0.5))
    per = per.withColumn("blocks", F.ceil(size / block).cast("long"))
    per = per.withColumn("passes", F.when(size > 0, F.floor(F.col("take") / size)).otherwise(0))
    per = per.withColumn("rest", F.col("take") - F.col("passes") * size)
    # One more slot than the rest needs if all its blocks were full: one of them may be short.
    last = F.when(
        F.col("rest") > 0, F.least(F.ceil(F.col("rest") / block) + 1, F.col("blocks"))
    ).otherwise(0)
    per = per.withColumn("slots", (F.col("passes") * F.col("blocks") + last).cast("long"))
    per = per.drop("_level")
    return stored(per, "mix-sources")


def slots(targets: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """One row per slot of the mixture: shard, place in it, source, pass, block, words taken of it."""
    deck = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    per = targets.filter(F.col("slots") > 0).withColumns(
        {
            "deck": F.coalesce(F.sum("slots").over(deck), F.lit(0)),
            "deck_size": F.sum("slots").over(Window.partitionBy()),
        }
    )
    # Numbers 0..slots-1 in two steps, so that no row holds an array as long as its source.
    last = F.floor((F.col("slots") - 1) / CHUNK)
    out = per.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    out = out.repartition("rank", "chunk")
    first = F.col("chunk") * CHUNK
    out = out.withColumn(
        "k", F.explode(F.sequence(first, F.least(first + CHUNK, F.col("slots")) - 1))
    )
    out = out.withColumns(
        {
            "pass": F.floor(F.col("k") / F.col("blocks")),
            "block": F.col("k") % F.col("blocks"),
            "deal": F.col("deck") + F.col("k"),
            "_deck_key": F.lit(1).cast("long"),
        }
    )
    out = out.withColumn("_key", F.col("rank") * 2 + F.col("pass") + 5)
    out = permuted(out, "block", "blocks", "_key")
    out = permuted(out, "deal", "deck_size", "_deck_key")
    length = F.when(
        F.col("block") < F.col("blocks") - 1, F.lit(rule.block_words).cast("long")
    ).otherwise(F.col("source_size") - (F.col("blocks") - 1) * rule.block_words)
    out = out.withColumn("_length", length)
    # The last pass stops at the target: a slot's words less what the slots before it have given.
    place = F.col("k") % F.col("blocks")
    short = F.col("block") == F.col("blocks") - 1
    gap = stored(out.withColumn("_place", place), "mix-slots")
    where_short = gap.filter(short).select(
        F.col("rank").alias("_r"), F.col("pass").alias("_p"), F.col("_place").alias("_short")
    )
    out = gap.join(
        where_short, (F.col("rank") == F.col("_r")) & (F.col("pass") == F.col("_p")), "left"
    )
    lost = F.when(
        F.col("_place") > F.col("_short"),
        F.col("blocks") * rule.block_words - F.col("source_size"),
    ).otherwise(0)
    given = F.col("_place") * rule.block_words - lost
    words = F.when(F.col("pass") < F.col("passes"), F.col("_length")).otherwise(
        F.greatest(F.least(F.col("_length"), F.col("rest") - given), F.lit(0))
    )
    return out.select(
        F.floor(F.col("deal") / rule.slots_per_shard).alias("shard"),
        (F.col("deal") % rule.slots_per_shard).alias("slot"),
        "rank",
        "source",
        "pass",
        "block",
        words.cast("long").alias("words"),
    ).filter(F.col("words") > 0)


def shard_draws(plan: DataFrame) -> DataFrame:
    """How many blocks of each source every output shard has drawn."""
    return plan.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("blocks"))


def laid_out(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """The documents with the place of their first word in their source's stream."""
    per = targets.select(F.col("source").alias("_s"), "rank", "source_size", "target", "blocks")
    rows = sizes.join(per, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # Ranges of the streams' order; sizes and texts tell rows apart that have no id or share one.
    order = ["h", "doc_id", "size", "text_key"]
    dealt = rows.repartitionByRange(partitions(sizes.sparkSession), "rank", *order)
    rows = stored(dealt.withColumn("range", F.spark_partition_id()), "mix-ranges")
    so_far = Window.unboundedPreceding
    per_range = rows.groupBy("rank", "range").agg(F.sum("size").alias("_n"))
    ranges = Window.partitionBy("rank").orderBy("range").rowsBetween(so_far, -1)
    base = per_range.select(
        F.col("rank").alias("_rank"),
        F.col("range").alias("_range"),
        F.coalesce(F.sum("_n").over(ranges), F.lit(0)).alias("_base"),
    )
    inside = Window.partitionBy("rank", "range").orderBy(*order)
    rows = rows.withColumn("_end", F.sum("size").over(inside.rowsBetween(so_far, 0)))
    same = (F.col("rank") == F.col("_rank")) & (F.col("range") == F.col("_range"))
    rows = rows.join(base, same)
    offset = F.col("_base") + F.col("_end") - F.col("size")
    return rows.withColumn("offset", offset).drop("_end", "_base", "_rank", "_range", "range", "h")


def pieces(rows: DataFrame, plan: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """One row per use of a piece of a document: its first word (from 0) and number of words."""
    block = rule.block_words
    first = F.floor(F.col("offset") / block)
    last = F.floor((F.col("offset") + F.col("size") - 1) / block)
    parts = rows.filter(F.col("size") > 0).withColumn("block", F.explode(F.sequence(first, last)))
    used = plan.select(
        F.col("rank").alias("_rank"), F.col("block").alias("_block"), "pass", "words"
    )
    parts = parts.join(
        used, (F.col("rank") == F.col("_rank")) & (F.col("block") == F.col("_block")), "left"
    )
    begin = F.greatest(F.col("block") * block, F.col("offset"))
    end = F.least(
        F.col("block") * block + F.coalesce(F.col("words"), F.lit(0)),
        F.col("offset") + F.col("size"),
    )
    return parts.withColumns(
        {
            "first": begin - F.col("offset"),
            "n": F.greatest(end - begin, F.lit(0)),
        }
    )


def mix_report(docs: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """How many words of each document the mixture takes, repeats counted.

    One row per input row. A null text has size 0. Null ids and sources are allowed: all null sources
    are one source, last in order. Rows that repeat an id are documents of their own. Documents
    without words are returned with nothing taken. An empty table gives no rows.
    """
    sizes = sized(docs, rule)
    targets = source_targets(sizes, rule)
    rows = laid_out(sizes, targets)
    keys = ["rank", "offset", "doc_id", "text_key", "size", "source", "source_size", "target"]
    taken = pieces(rows, slots(targets, rule), rule).groupBy(*keys).agg(F.sum("n").alias("taken"))
    none = rows.filter(F.col("size") == 0).select(*keys, F.lit(0).cast("long").alias("taken"))
    return taken.select(*keys, "taken").unionByName(none).drop("rank", "offset", "text_key")


def mix_documents(docs: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """The mixture as documents: a row for each document and pass, with the words that pass takes.

    A document that a pass takes whole keeps its text as it is; of one taken in part, the words are
    joined by single spaces. ``n_chars`` follows the text; other columns are carried along. Documents
    of which nothing is taken are not returned. Null texts have no words; rows without an id or a source, and
    rows that repeat an id, are mixed like any other. An empty table gives no rows.
    """
    sizes = sized(docs, rule)
    targets = source_targets(sizes, rule)
    rows = laid_out(sizes, targets)
    copy = Window.partitionBy("doc_id", "text_key").orderBy("source")
    rows = rows.withColumn("_copy", F.row_number().over(copy))
    uses = (
        pieces(rows, slots(targets, rule), rule)
        .filter(F.col("n") > 0)
        .groupBy(
            F.col("doc_id").alias("_id"),
            F.col("text_key").alias("_text_key"),
            F.col("_copy").alias("_use_copy"),
            F.col("size").alias("_size"),
            F.col("pass").alias("_pass"),
        )
        .agg(
            F.sum("n").alias("_taken"),
            F.sort_array(F.collect_list(F.struct("first", "n"))).alias("_parts"),
        )
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    kept = docs.select(
        F.struct(*columns).alias("doc"),
        F.col("doc_id"),
        text_key("text").alias("text_key"),
        F.col("source"),
    )
    twin = Window.partitionBy("doc_id", "text_key").orderBy("source")
    kept = kept.withColumn("copy", F.row_number().over(twin))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_id"))
        & (F.col("text_key") == F.col("_text_key"))
        & (F.col("copy") == F.col("_use_copy"))
    )
    whole = F.col("_taken") == F.col("_size")
    out = kept.join(uses, same).select(
        "doc", "_parts", F.when(~whole, word_array(F.col("doc.text"))).alias("_words")
    )
    cut = F.transform(
        F.col("_parts"),
        lambda p: F.slice(F.col("_words"), (p["first"] + 1).cast("int"), p["n"].cast("int")),
    )
    text = F.coalesce(F.array_join(F.flatten(cut), " "), F.col("doc.text"))
    changed = {"text": text, "n_chars": F.length(text)}
    return out.select(
        *[
            changed.get(f.name, F.col("doc").getField(f.name)).cast(f.dataType).alias(f.name)
            for f in docs.schema
        ]
    )
