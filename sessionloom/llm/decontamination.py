"""Benchmark decontamination by templates.

Numbers, units that follow a number, and capitalised words become typed placeholders; what is left is
lower-cased and stripped of punctuation. Windows of such tokens are joined by hash with the windows of
the benchmark items, so a question is found again after its numbers and names were changed. Each window
has a second, literal form, its lower-cased words and numbers, so other capitals hide nothing; an item's
window is held if either form is. A pair
of document and item then has to agree on its slots: every value of an item is bound to the value that
most windows show in its place, and windows that show another one do not count, unless all their values
are the item's own. The vote is taken in each occurrence, the windows at about one distance between their
places in the document and in the item, and once over the whole document; the best one counts.

Windows that are mostly placeholders are sought in their literal form only. They count for items that
have no others. Windows that many wordings of items share, such as a common instruction, tell nothing about
an item that has others and are left out. Items with fewer tokens than a window are sought as a whole, by
their lower-cased tokens.

Only DataFrame functions are used. If the hashes of the benchmark's windows are counted to be at most
``BROADCAST_WINDOWS`` they are broadcast, without tokens and items, and the texts are read once, without a
shuffle. Otherwise a bitmap of them is broadcast, the hashes it lets through are shuffled, and the matching
documents are read again. Either way a window that is met goes on with its own tokens only, never with those of
its document, and the items that have it are joined afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.llm.common import stored, text_key, whole_text

NUMBER, UNIT, NAME = "", "", ""
# Words taken as units when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram "
    "kilograms oz lb lbs pound pounds ton tons ml l liter liters litre litres gallon gallons ms s sec "
    "second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "km h mph kmh hz khz mhz ghz v volt volts w kw watt watts j kj joule joules n newton newtons "
    "dollar dollars cent cents euro euros percent degree degrees"
)
_WORD = r"\p{L}\p{M}\p{N}"
_UNITS = "|".join(sorted(set(UNITS.split()), key=lambda u: (-len(u), u)))
_NUMBER = r"\p{N}+"
_AFTER_NUMBER = rf"(?i){NUMBER}\s+(?:{_UNITS})(?![{_WORD}])"
_CAPITALISED = rf"(?<![{_WORD}])\p{{Lu}}[\p{{Ll}}\p{{M}}]+(?![{_WORD}])"
_BREAK = rf"[^{_WORD}{NUMBER}-{NAME}]+"
BROADCAST_WINDOWS = 1_000_000  # hashes, of some 60 bytes each
BROADCAST_ITEMS = 50_000  # windows with their tokens, of some 500 bytes each
BITMAP_WORDS = 1 << 20  # of 64 bits, a row each
SHIFT = 3  # tokens that come or go inside an occurrence, at once


@dataclass(frozen=True)
class LeakRule:
    """``window``: tokens, a power of two. ``literals``: tokens of a window that are no placeholders.

    ``coverage``: share of an item's windows that a document must hold. ``quote``: words of an item in a
    row that are enough, whatever their share. ``shared``: wordings of items that may have a window in
    common before it tells nothing about any of them.
    """

    window: int = 8
    literals: int = 4
    coverage: float = 0.5
    quote: int = 13
    shared: int = 4


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, _BREAK), "")


def templates(df: DataFrame, text: str) -> DataFrame:
    """Add ``surface``, the lower-cased words and numbers, and ``shape``, the same ones with types.

    Placeholders stand in the place of what they replace, so the two match one for one.
    """
    typed = F.regexp_replace(whole_text(text), _NUMBER, NUMBER)
    typed = F.regexp_replace(typed, _AFTER_NUMBER, f"{NUMBER} {UNIT}")
    typed = F.regexp_replace(typed, _CAPITALISED, NAME)
    return df.withColumn("surface", _tokens(F.lower(whole_text(text)))).withColumn(
        "shape", _tokens(F.lower(typed))
    )


def _with_hashes(df: DataFrame, size: int) -> DataFrame:
    """Add ``hashes`` and ``own_hashes``: one for every window of ``shape`` and of ``surface``."""
    if size < 2 or size & (size - 1):
        raise ValueError("the window must be a power of two")
    df = _hashed(df, "hashes", F.transform("shape", lambda t: F.xxhash64(t)), size)
    return _hashed(df, "own_hashes", F.transform("surface", lambda t: F.xxhash64(t, F.lit(1))), size)


def _hashed(df: DataFrame, name: str, of_tokens: Column, size: int) -> DataFrame:
    """Hashes of windows, built by doubling."""
    df = df.withColumn(name, of_tokens)
    span = 1
    while span < size:
        later = F.slice(name, span + 1, F.greatest(F.size(name), F.lit(1)))
        df = df.withColumn(name, F.zip_with(name, later, lambda x, y: F.xxhash64(x, y)))
        span *= 2
    # The last size - 1 entries have run over the end.
    return df.withColumn(name, F.slice(name, 1, F.greatest(F.size("shape") - (size - 1), F.lit(0))))


def _is_type(token: Column) -> Column:
    return F.substring(token, 1, 1).isin(NUMBER, UNIT, NAME)


def benchmark_windows(items: DataFrame, rule: LeakRule) -> DataFrame:
    """The distinct windows of every item in both forms; those that are mostly placeholders as literals.
    Windows that more than ``shared`` wordings have are left out of items that have others.

    ``counted``: the windows that an item's coverage is a share of.
    """
    rows = items.select(
        "item_id", "_text", "shape", "surface", "own_hashes", F.posexplode("hashes").alias("place", "window")
    )
    rows = rows.select(
        "item_id",
        F.xxhash64("_text").alias("wording"),
        "window",
        F.element_at("own_hashes", F.col("place") + 1).alias("own"),
        F.col("place").alias("item_place"),
        F.slice("shape", F.col("place") + 1, rule.window).alias("item_shape"),
        F.slice("surface", F.col("place") + 1, rule.window).alias("item_surface"),
    )
    usable = rule.window - F.size(F.filter("item_shape", _is_type)) >= rule.literals
    any_usable = F.max("usable").over(Window.partitionBy("item_id"))
    rows = rows.withColumn("usable", usable).withColumn("counted", F.col("usable") | ~any_usable)
    typed = F.struct(F.lit(False).alias("literal"), F.col("window").alias("hash"))
    own = F.struct(F.lit(True).alias("literal"), F.col("own").alias("hash"))
    rows = rows.withColumn("form", F.explode(F.when(F.col("usable"), F.array(typed, own)).otherwise(F.array(own))))
    values = F.struct("window", "counted", "item_shape", "item_surface", "item_place", "wording")
    rows = rows.groupBy("item_id", "form").agg(F.min_by(values, "item_place").alias("first"))
    rows = rows.select("item_id", "form.*", "first.*")
    wordings = rows.groupBy("literal", "hash").agg(F.countDistinct("wording").alias("wordings"))
    few = F.col("wordings") <= rule.shared
    rows = rows.join(wordings, ["literal", "hash"]).withColumn("telling", few)
    any_telling = F.max(F.col("telling") & F.col("counted")).over(Window.partitionBy("item_id"))
    rows = rows.withColumn("any_telling", any_telling).filter(F.col("telling") | ~F.col("any_telling"))
    return rows.drop("wording", "wordings", "telling", "any_telling")


def leaks(docs: DataFrame, benchmark: DataFrame, rule: LeakRule = LeakRule()) -> DataFrame:
    """The pairs of document and benchmark item where the document holds the item or quotes it at length.

    One row per (doc_id, text, item): ``n_windows`` consistent windows out of ``item_windows``, their
    ``coverage``, ``exact`` if every slot holds the item's own value, and ``item_tokens``, the length of the
    item: a phrase of a few words may stand in a document by chance. ``text_key`` tells apart rows
    that repeat an id; wholly equal rows give one result. Null texts hold nothing, null ids are kept
    as they are, and items without an id are one item per text, with a null id in the result. Empty
    tables give no rows. Other columns are not read.
    """
    bench = benchmark.select(F.col("item_id").alias("_id"), F.col("text").alias("_text")).distinct()
    bench = bench.withColumn("item_id", F.xxhash64("_id", "_text"))
    bench = stored(_with_hashes(templates(bench, "_text"), rule.window), "leak-benchmark")
    windows = stored(benchmark_windows(bench, rule), "leak-windows")
    hashes = stored(windows.select("hash").distinct(), "leak-hashes")
    totals = windows.filter("counted").groupBy("item_id")
    totals = totals.agg(F.countDistinct("window").alias("item_windows"))
    short = bench.filter((F.size("surface") > 0) & (F.size("surface") < rule.window))
    sizes = sorted(r.n for r in short.select(F.size("surface").alias("n")).distinct().collect())

    keyed = docs.select("doc_id", text_key("text").alias("text_key"), "text")
    rows = _with_hashes(templates(keyed, "text"), rule.window)
    if hashes.count() <= BROADCAST_WINDOWS:
        met = _met_at_once(rows, hashes, rule)
    else:
        met = _met_again(keyed, rows, hashes, rule)
    # Stored, so that what a document's windows have in common with many items is never in memory at once.
    met = stored(met, "leak-windows-met")
    few = windows.count() <= BROADCAST_ITEMS
    found = _slots(met.join(F.broadcast(windows) if few else windows.hint("merge"), "hash"))
    if sizes:
        found = found.unionByName(_found_whole(rows, short, sizes))
        totals = totals.unionByName(short.select("item_id", F.lit(1).cast("long").alias("item_windows")))
    kept = _consistent(stored(found, "leak-matches"), totals, rule)
    ids = bench.select(
        "item_id", F.col("_id").alias("_benchmark_id"), F.size("surface").cast("long").alias("item_tokens")
    )
    return kept.join(ids, "item_id").select(
        "doc_id",
        F.col("_benchmark_id").alias("item_id"),
        "n_windows",
        "item_windows",
        (F.col("n_windows") / F.col("item_windows")).alias("coverage"),
        "exact",
        "item_tokens",
        "text_key",
    )


PER = ("doc_id", "text_key", "item_id")


def _slots(rows: DataFrame) -> DataFrame:
    """One row per window in both texts, with its slots. Hashes propose, the tokens decide."""
    # Neither less nor greater: a plain equality would become a key of the join, and every window's
    # tokens would be copied for it. In this form only windows whose hash has met are looked at.
    mine = F.when(F.col("literal"), F.col("surface")).otherwise(F.col("shape"))
    item = F.when(F.col("literal"), F.col("item_surface")).otherwise(F.col("item_shape"))
    rows = rows.filter((mine <= item) & (mine >= item))
    slots = F.filter(
        F.arrays_zip(
            F.col("item_shape").alias("type"),
            F.col("item_surface").alias("item_value"),
            F.col("surface").alias("doc_value"),
        ),
        lambda s: _is_type(s["type"]),
    )
    return rows.select(*PER, "place", "window", "literal", "counted", "item_place", slots.alias("slots"))


def _exploded(rows: DataFrame, rule: LeakRule) -> DataFrame:
    """One row per window and form, with its ``place`` and ``hash``.

    The outer form keeps Spark from adding a filter that computes all hashes a second time.
    """
    both = F.posexplode_outer(F.concat("hashes", "own_hashes")).alias("_at", "hash")
    rows = rows.select("doc_id", "text_key", "shape", "surface", both)
    n = F.greatest(F.size("shape") - (rule.window - 1), F.lit(1))
    return rows.withColumn("place", F.pmod("_at", n)).drop("_at")


def _cut(rows: DataFrame, rule: LeakRule) -> DataFrame:
    """The window's own tokens in the place of the whole document's.

    Spark holds all rows that it makes of one document until the next operator has them, so a row with the
    document's tokens would take memory in proportion to the square of the document's length.
    """
    own = [F.slice(c, F.col("place") + 1, rule.window).alias(c) for c in ("shape", "surface")]
    return rows.select("doc_id", "text_key", "place", "hash", *own)


def _met_at_once(rows: DataFrame, hashes: DataFrame, rule: LeakRule) -> DataFrame:
    """The documents' windows that a benchmark has whose hashes fit a broadcast."""
    return _cut(_exploded(rows, rule).join(F.broadcast(hashes), "hash", "left_semi"), rule)


def _met_again(keyed: DataFrame, rows: DataFrame, hashes: DataFrame, rule: LeakRule) -> DataFrame:
    """The windows that a larger benchmark has: only hashes are shuffled, then the texts that match."""
    exploded = _exploded(rows, rule).select("doc_id", "text_key", "place", "hash")
    hits = _let_through(exploded, hashes).join(hashes.hint("merge"), "hash", "left_semi").distinct()
    places = hits.groupBy(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")).agg(
        F.collect_list(F.struct("place", "hash")).alias("places")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t"))
    again = templates(keyed.join(places, same), "text")
    return _cut(again.select("doc_id", "text_key", "shape", "surface", F.inline("places")), rule)


def _let_through(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """The rows whose hash is set in a bitmap of ``hashes``: all that are among them, and a few others."""
    word = F.shiftright("hash", 6).bitwiseAND(F.lit(BITMAP_WORDS - 1)).alias("_word")
    bit = F.col("hash").bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bitmap = hashes.groupBy(word).agg(F.bit_or(one).alias("_bits"))
    rows = rows.select("*", word).join(F.broadcast(bitmap), "_word")
    return rows.filter(F.getbit("_bits", bit) == 1).drop("_word", "_bits")


def _found_whole(rows: DataFrame, short: DataFrame, sizes: list[int]) -> DataFrame:
    """The matches of items shorter than a window: all their tokens, in a row."""
    surface, held = F.col("surface"), F.size("surface")

    def phrases(n: int) -> Column:
        found = F.transform(
            F.sequence(F.lit(1), F.greatest(held - (n - 1), F.lit(1))),
            lambda at: F.array_join(F.slice(surface, at, n), " "),
        )
        return F.when(held >= n, found).otherwise(F.array().cast("array<string>"))

    each = F.explode_outer(F.array_distinct(F.concat(*[phrases(n) for n in sizes]))).alias("phrase")
    items = short.select("item_id", F.array_join("surface", " ").alias("phrase"))
    if short.count() <= BROADCAST_WINDOWS:
        items = F.broadcast(items)
    value = "array<struct<type:string,item_value:string,doc_value:string>>"
    return rows.select("doc_id", "text_key", each).join(items, "phrase").select(
        *PER,
        F.lit(0).alias("place"),
        F.lit(0).cast("long").alias("window"),
        F.lit(True).alias("literal"),
        F.lit(True).alias("counted"),
        F.lit(0).alias("item_place"),
        F.array().cast(value).alias("slots"),
    )


def _occurrences(rows: DataFrame) -> DataFrame:
    """Add ``occurrence``: each row once for its occurrence, and once for the whole document (-1)."""
    by_shift = Window.partitionBy(*PER).orderBy("_shift")
    rows = rows.withColumn("_shift", F.col("place") - F.col("item_place"))
    jump = F.col("_shift") - F.lag("_shift", 1).over(by_shift) > SHIFT
    rows = rows.withColumn("_jump", F.coalesce(jump.cast("int"), F.lit(0)))
    rows = rows.withColumn("_no", F.sum("_jump").over(by_shift).cast("int"))
    both = F.explode(F.array(F.lit(-1), F.col("_no")))
    return rows.withColumn("occurrence", both).drop("_shift", "_jump", "_no")


def _with_runs(rows: DataFrame) -> DataFrame:
    """Add ``run``: how many literal windows follow one another in the document around this one."""
    by_place = Window.partitionBy(*PER, "literal").orderBy("place")
    rows = rows.withColumn("_island", F.col("place") - F.dense_rank().over(by_place))
    island = Window.partitionBy(*PER, "literal", "_island")
    length = F.max("place").over(island) - F.min("place").over(island) + 1
    return rows.withColumn("run", F.when(F.col("literal"), length).otherwise(0)).drop("_island")


def _consistent(rows: DataFrame, totals: DataFrame, rule: LeakRule) -> DataFrame:
    """Count the windows of each pair whose slots agree with the bindings of its best occurrence."""
    per = [*PER, "occurrence"]
    own = ~F.exists("slots", lambda s: s["item_value"] != s["doc_value"])
    rows = _occurrences(_with_runs(rows.withColumn("own", own)))
    typed = rows.filter(~F.col("literal"))
    slots = typed.select(*per, "place", F.explode("slots").alias("s")).select(*per, "place", "s.*")
    votes = slots.groupBy(*per, "type", "item_value", "doc_value").agg(F.count(F.lit(1)).alias("n"))
    by_value = Window.partitionBy(*per, "type", "item_value").orderBy(F.desc("n"), "doc_value")
    lost = votes.withColumn("turn", F.row_number().over(by_value)).filter(F.col("turn") > 1)
    wrong = _matched(slots, lost, [*per, "type", "item_value", "doc_value"], "left_semi")
    wrong = wrong.select(*per, "place").distinct()
    agreed = _matched(rows.filter(~F.col("own")), wrong, [*per, "place"], "left_anti")
    out = agreed.unionByName(rows.filter("own")).groupBy(*per).agg(
        F.countDistinct(F.when(F.col("counted"), F.col("window"))).alias("n_windows"),
        F.min("own").alias("exact"),
        F.max("run").alias("run"),
    )
    best = F.max(F.struct("n_windows", "exact")).alias("best")
    out = out.groupBy(*PER).agg(best, F.max("run").alias("run")).select(*PER, "best.*", "run")
    out = out.join(totals, "item_id")
    held = F.col("n_windows") >= F.lit(rule.coverage) * F.col("item_windows")
    return out.filter(held | (F.col("run") >= max(1, rule.quote - rule.window + 1)))


def _matched(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """A semi or anti join on columns that may be null."""
    names = {c: f"_other_{i}" for i, c in enumerate(columns)}
    right = right.select(*[F.col(c).alias(n) for c, n in names.items()])
    same = F.lit(True)
    for c, n in names.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    return left.join(right, same, how)


def without_leaks(docs: DataFrame, found: DataFrame, least_tokens: int = 5) -> DataFrame:
    """The documents that hold no item, with the columns they came with.

    Items of fewer than ``least_tokens`` tokens are common phrases or single words; a document that has one
    stays. Null ids and texts and repeated rows are matched like any other; empty tables give no rows.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("doc"), "doc_id", text_key("text").alias("text_key"))
    bad = found.filter(F.col("item_tokens") >= least_tokens)
    bad = bad.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t"))
    return rows.join(bad, same, "left_anti").select("doc.*")
