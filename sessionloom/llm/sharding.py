"""Sharding by balanced label propagation.

Linked documents should share a shard, and shards should hold equally many rows. Equal texts are linked, and so are
documents that have a line in common: one of ``line_chars`` characters or more, however many texts have it. A
line's votes add up to the same whoever has it, so boilerplate, which is in all shards alike, speaks for none.

Rows of equal text are one unit, which has one label and moves as a whole. Every unit starts in a shard given by a
hash of its text. Then, round by round, units move to the shard where most of their neighbours are: Spark joins
count each group's rows per shard, a unit adds up the shares of its groups, and what wants to come is granted as
far as the shard has room, or as far as as many rows want to go the opposite way. Half of the moves wait in each
round, so that two neighbours do not pass each other. Units without neighbours wait; their rows fill what is left,
so that in the end every quota is met exactly.

Equal texts of more rows than a part of a shard (``large_group``) are cut into units that fill one shard after the
other and stay there; others may come to them.

Links are rows (row, group): a document may be in many groups, and a group of n documents costs n rows,
not n * n links. A large group is dealt out in parts, so that its rows do not all meet in one task.

The law is ``rows``: numbers of rows differ by one at most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import stored, text_key, whole_text, with_rank

LAW = "rows"
#: A whole vote: shares of a group are whole numbers of this size, so that sums do not depend on their order.
WHOLE = 1 << 20
#: Rows of a group that may meet in one task of a join; of larger groups at most ``LARGE_GROUPS`` are broadcast.
GROUP_ROWS = 4096
LARGE_GROUPS = 100_000


@dataclass(frozen=True)
class ShardRule:
    """``rounds`` of propagation at most; it ends earlier when hardly anybody moves (``least_moves`` of the linked
    rows). ``large_group``: rows of a unit, as a share of a shard."""

    shards: int = 16
    rounds: int = 24
    least_moves: float = 0.005
    large_group: float = 0.05
    line_chars: int = 60


def _quotas(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


def units(rows: DataFrame, homes: DataFrame | None, quotas: list[int], rule: ShardRule) -> DataFrame:
    """(row, unit, home, start) of every row: what moves together, and the shard it starts in.

    ``homes`` has (row, home); rows of one home are a unit, or several if they are many. Without it every row is a
    unit of its own.
    """
    shards, least = len(quotas), max(1, min(quotas, default=1))
    if homes is None:
        own = rows.select("row", F.col("row").alias("unit"), F.col("row").alias("home"))
        return own.withColumn("start", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    size = max(1, int(least * rule.large_group))
    ranked = with_rank(homes.select("row", "home"), ["row"], ["home"], "no")
    part = F.floor(F.col("no") / size)
    # The parts of a large group fill one shard after the other.
    filled = F.floor(part * size / least)
    start = F.pmod(F.xxhash64("home") + filled, F.lit(shards)).cast("int")
    return ranked.select("row", F.xxhash64("home", part).alias("unit"), "home", start.alias("start"))


def of_groups(rows: DataFrame, groups: DataFrame, held_by: str) -> DataFrame:
    """``rows`` joined with ``groups`` by group; ``held_by`` is the groups' column for their number of rows.

    The rows of a very large group would all meet in one task, so these groups are broadcast. As groups share the
    rows, at most ``LARGE_GROUPS`` are larger than the limit, which grows only as far as that asks for.
    """
    every = groups.agg(F.sum(held_by)).first()[0] or 0
    large = F.col(held_by) > max(GROUP_ROWS, every // LARGE_GROUPS)
    few = F.broadcast(groups.filter(large))
    rest = rows.join(F.broadcast(groups.filter(large).select("group")), "group", "left_anti")
    return rows.join(few, "group").unionByName(rest.join(groups.filter(~large), "group"))


def links(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """(unit, group, weight, n, total, parts, part): the rows of a unit in each group, all rows of the group, the
    number of parts of the group, and which of them the unit is in.

    ``members`` has (home, group, weight), ``sizes`` (unit, home, n). Groups of a single unit link nothing.
    """
    per = members.join(sizes.select("unit", "home", "n"), "home").groupBy("unit", "group").agg(
        F.max("n").alias("n"), F.max("weight").alias("weight")
    )
    per = stored(per, "shard-members")
    totals = per.groupBy("group").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held_by"))
    totals = stored(totals.filter("held_by > 1"), "shard-totals")
    parts = F.ceil(F.col("held_by") / GROUP_ROWS).cast("int")
    linked = of_groups(per, totals, "held_by").withColumn("parts", parts).drop("held_by")
    return stored(linked.withColumn("part", F.pmod(F.xxhash64("unit"), F.col("parts")).cast("int")), "shard-links")


def propagated(
    linked: DataFrame,
    state: DataFrame,
    quotas: list[int],
    rule: ShardRule = ShardRule(),
    trace: list[dict] | None = None,
) -> DataFrame:
    """(unit, n, fixed, label) after the rounds, from ``state`` with the same columns; ``fixed`` units stay.

    Labels follow the quotas in expectation; ``balanced`` makes them exact. ``trace`` takes a row per round: the
    rows that wanted to move, those that were granted, and the share of all votes that agree before the round.
    """
    shards = len(quotas)
    for turn in range(rule.rounds):
        held = {r.label: r.n for r in state.groupBy("label").agg(F.sum("n").alias("n")).collect()}
        votes = stored(_votes(linked, state), "shard-votes")
        # At most one row per pair of shards.
        flows = [[0] * shards for _ in range(shards)]
        eager = votes.filter(~F.col("fixed") & (F.col("best.value") > F.col("own")))
        for r in eager.groupBy("label", "best.to").agg(F.sum("n").alias("n")).collect():
            flows[r.label][r.to] = r.n
        wanted = sum(map(sum, flows))
        room = [max(0, q - held.get(s, 0)) for s, q in enumerate(quotas)]
        share = F.array(*[F.lit(x) for x in _granted(flows, room)])
        granted = F.element_at(share, F.col("label") * shards + F.col("best.to") + 1)
        moves = eager.filter(_draw(F.col("unit"), F.lit(turn)) < granted)
        moves = stored(moves.select(F.col("unit").alias("_unit"), "best.to", F.col("n").alias("_n")), "shard-moves")
        moved = moves.agg(F.sum("_n")).first()[0] or 0
        if trace is not None:
            agree = votes.agg(F.sum(F.col("own") * F.col("n")), F.sum(F.col("every") * F.col("n"))).first()
            trace.append({"wanted": wanted, "moved": moved, "agreed": (agree[0] or 0) / max(1, agree[1] or 0)})
        if not moved:
            break
        state = state.join(moves, F.col("unit") == F.col("_unit"), "left").select(
            "unit", "n", "fixed", F.coalesce("to", "label").alias("label")
        )
        state = stored(state, "shard-labels")
        if moved < rule.least_moves * sum(held.values()):
            break
    return state


def _granted(flows: list[list[int]], room: list[int]) -> list[float]:
    """The share of each flow that may move, row by row of the matrix: what the opposite flow makes up for, and a
    part of the room in the shard it goes to; half of it at most."""
    n = len(room)
    over = [[max(0, flows[s][t] - flows[t][s]) for t in range(n)] for s in range(n)]
    coming = [sum(over[s][t] for s in range(n)) for t in range(n)]
    out = []
    for s in range(n):
        for t in range(n):
            free = min(1.0, room[t] / coming[t]) if coming[t] else 0.0
            allowed = min(flows[s][t], flows[t][s]) + over[s][t] * free
            out.append(min(0.5, allowed / flows[s][t]) if flows[s][t] else 0.0)
    return out


def _votes(linked: DataFrame, state: DataFrame) -> DataFrame:
    """(unit, n, fixed, label, own, every, best): the votes for the shard a unit is in, all of them, and the best other one.

    A group is counted once per shard it is in, and each member meets those counts: at most as many rows per
    link as there are shards, however large the group is. Each part of a group has a copy of the counts.
    """
    labelled = linked.join(state.select("unit", "label"), "unit")
    counts = labelled.groupBy("group", "parts", F.col("label").alias("to")).agg(F.sum("n").alias("rows"))
    counts = counts.select("group", "to", "rows", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    here = F.col("to") == F.col("label")
    others = F.col("rows") - F.when(here, F.col("n")).otherwise(0)
    value = F.floor(others * F.col("weight") * WHOLE / (F.col("total") - F.col("n"))).cast("long")
    met = labelled.join(counts, ["group", "part"])
    votes = met.groupBy("unit", "label", "to").agg(F.sum(value).alias("value"))
    # Ties go by a hash, or every tie would move to shard 0.
    rank = F.struct("value", F.xxhash64("unit", "to").alias("tie"), "to")
    best = votes.groupBy("unit", "label").agg(
        F.coalesce(F.max(F.when(here, F.col("value"))), F.lit(0)).alias("own"),
        F.sum("value").alias("every"),
        F.max(F.when(~here, rank)).alias("best"),
    )
    return best.join(state.select("unit", "n", "fixed"), "unit")


def balanced(rows: DataFrame, labels: DataFrame, quotas: list[int]) -> DataFrame:
    """(row, shard) with exactly ``quotas`` rows in the shards, given the labels of the linked rows.

    A shard keeps its linked rows up to its quota, those of a lower ``turn`` first, home by home; what is over and the
    rows without links fill the free places in order.
    """
    ranked = with_rank(labels.select("label", "turn", "home", "row"), ["turn", "home", "row"], ["label"], "rank")
    quota = F.element_at(_longs(quotas), F.col("label") + 1)
    kept = ranked.filter(F.col("rank") < quota).select("row", F.col("label").alias("shard"))
    kept = stored(kept, "shard-kept")
    free = list(quotas)
    for r in kept.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():
        free[r.shard] -= r.n
    over = ranked.filter(F.col("rank") >= quota).select("home", "row")
    single = rows.join(labels.select("row"), "row", "left_anti")
    pool = over.unionByName(single.select(F.xxhash64("row").alias("home"), "row"))
    pool = with_rank(pool, ["home", "row"], [], "rank")
    ends, total = [], 0
    for f in free:
        total += f
        ends.append(total)
    place = F.size(F.filter(_longs(ends), lambda e: e <= F.col("rank"))).cast("int")
    return kept.unionByName(pool.select("row", place.alias("shard")))


def shard_rows(
    rows: DataFrame,
    members: DataFrame,
    rule: ShardRule = ShardRule(),
    homes: DataFrame | None = None,
    trace: list[dict] | None = None,
) -> DataFrame:
    """(row, shard, slot) for ``rows`` with a unique long ``row``; slots count from 0 in each shard.

    ``members`` has (row, group), or (home, group) if there are ``homes``, which are as in ``units``; it may have a
    whole ``weight``.
    """
    quotas = _quotas(rows.count(), rule.shards)
    if "weight" not in members.columns:
        members = members.withColumn("weight", F.lit(1))
    if homes is None:
        members = members.withColumnRenamed("row", "home")
    of = stored(units(rows, homes, quotas, rule), "shard-units")
    sizes = of.groupBy("unit", "home").agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("label"))
    sizes = stored(sizes, "shard-sizes")
    cut = sizes.groupBy("home").agg(F.count(F.lit(1)).alias("held_by"), F.sum("n").alias("home_rows"))
    cut = cut.filter("held_by > 1").select(F.col("home").alias("_home"), "home_rows")
    # Of the groups that stay, the largest have the first right to their places.
    fixed = sizes.join(cut, F.col("home") == F.col("_home"), "left").withColumns(
        {"fixed": F.col("_home").isNotNull(), "turn": -F.coalesce("home_rows", F.lit(0))}
    )
    sizes = stored(fixed.drop("_home", "home_rows"), "shard-fixed")
    linked = links(members, sizes)
    tied = sizes.join(linked.select("unit").distinct(), "unit", "left_semi")
    tied = stored(tied.select("unit", "n", "fixed", "label"), "shard-labels")
    labels = propagated(linked, tied, quotas, rule, trace)
    # Rows of equal texts stay together also where they have no neighbours to follow.
    alone = sizes.filter("n > 1 OR fixed").join(tied.select("unit"), "unit", "left_anti")
    labels = labels.unionByName(alone.select("unit", "n", "fixed", "label")).select("unit", "label")
    labels = labels.join(sizes.select("unit", "turn"), "unit")
    labels = of.join(labels, "unit").select("row", "label", "home", "turn")
    labels = stored(labels, "shard-kept-labels")
    placed = balanced(rows.select("row"), labels, quotas)
    return with_rank(placed, ["row"], ["shard"], "slot")


def split_groups(assigned: DataFrame, members: DataFrame) -> DataFrame:
    """(group, rows, shards) of each group in more than one shard: what the sharding has cut."""
    both = members.join(assigned.select("row", "shard"), "row")
    per = both.groupBy("group").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("shard").alias("shards")
    )
    return per.filter(F.col("shards") > 1)


def document_links(docs: DataFrame, rule: ShardRule = ShardRule()) -> DataFrame:
    """(home, group) of the lines that texts have in common; ``home`` is a hash of the text."""
    texts = docs.select(_home().alias("home"), whole_text("text").alias("text"))
    long_lines = F.filter(F.split("text", "\n"), lambda line: F.length(line) >= rule.line_chars)
    hashes = F.array_distinct(F.transform(long_lines, lambda line: F.xxhash64(line, F.lit(7))))
    # Lines by text, not by row: copies have the same ones.
    lines = stored(texts.select("home", F.explode(hashes).alias("group")).distinct(), "shard-lines")
    counts = lines.groupBy("group").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    counts = stored(counts, "shard-line-counts")
    return of_groups(lines, counts, "texts").select("home", "group")


def _home() -> Column:
    return F.xxhash64(text_key("text"), F.octet_length(whole_text("text")))


def shard_documents(docs: DataFrame, rule: ShardRule = ShardRule(), trace: list[dict] | None = None) -> DataFrame:
    """Documents into shards, equal texts and texts with lines in common together where quotas allow.

    One row per input row: doc_id, size (UTF-8 bytes plus 1), text_crc32, law, shard, slot, grown_shard
    (always null under this law). A null text has no bytes and counts as equal to the empty text. Null
    ids come first in every order; rows that repeat an id are rows of their own, and wholly equal rows
    are one group like other equal texts. Other columns are not read. An empty table gives no rows.
    """
    text = whole_text("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        text_key("text").alias("text_key"),
        _home().alias("home"),
    )
    rows = stored(with_rank(rows, ["doc_id", "text_key"], [], "row"), "shard-rows")
    members = document_links(docs, rule)
    placed = shard_rows(rows, members, rule, rows.select("row", "home"), trace).withColumnRenamed("row", "_row")
    return rows.join(placed, F.col("row") == F.col("_row")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
