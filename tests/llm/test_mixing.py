from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sessionloom.llm import common
from sessionloom.llm.common import permuted, with_rank
from sessionloom.llm.mixing import (
    MixRule,
    laid_out,
    mix_documents,
    mix_report,
    shard_draws,
    sized,
    slots,
    source_targets,
)

RULES = [MixRule(), MixRule(block_words=4, slots_per_shard=8), MixRule(block_words=7, share=1.9)]


def targets(sizes, rule):
    """Shares by weight, capped, the excess shared again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: rule.weights[i % len(rule.weights)] for i, s in enumerate(names)}
    left, total, out = set(names), rule.share * sum(sizes.values()), {}
    while left:
        level = total / sum(weight[s] for s in left)
        over = [s for s in left if level * weight[s] >= rule.cap * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in left}
        for s in over:
            out[s] = rule.cap * sizes[s]
            total -= out[s]
            left.remove(s)
    return out


@pytest.mark.parametrize("rule", RULES)
def test_report(frame, rows, rule):
    full = [(i, t, [None, "b", "a", "é", "Z"][k % 5]) for k, (i, t) in enumerate(rows)]
    got = mix_report(frame(full), rule).collect()
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter(
        (i, len((t or "").encode().split()), s) for i, t, s in full
    )
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = targets(sizes, rule)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
    assert Counter(map(tuple, got)) == Counter(map(tuple, mix_report(frame(full, parts=5), rule).collect()))


@pytest.mark.parametrize("rule", RULES[1:])
def test_documents_hold_the_words_of_the_report(frame, rows, rule):
    df = frame(rows)
    report = mix_report(df, rule).collect()
    out = mix_documents(df, rule)
    assert out.schema == df.schema
    words = Counter()
    texts = defaultdict(set)
    for i, t in rows:
        texts[i].add(" ".join((t or "").split()) if t else "")
    for r in out.collect():
        words[r.doc_id] += len(r.text.encode().split())
        assert r.n_chars == len(r.text) and r["pass"] == 7
        inside = set(r.text.encode().split())
        assert any(inside <= set((t or "").encode().split()) for i, t in rows if i == r.doc_id)
    taken = Counter()
    for r in report:
        taken[r.doc_id] += r.taken
    assert +words == +taken


def test_one_source_and_no_words(frame):
    got = mix_report(frame([(1, None, "a"), (2, "", "a"), (3, None, None)])).collect()
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 3
    assert mix_report(frame([])).count() == 0 and mix_documents(frame([])).count() == 0
    only = mix_report(frame([(i, "a b c d e", "x") for i in range(40)]), RULES[1]).collect()
    assert sum(r.taken for r in only) == 300


def test_draws_add_up_and_vary(frame):
    rule = MixRule(block_words=5, slots_per_shard=20)
    rows = [(i, "w " * (10 + i % 7), f"s{i % 4}") for i in range(200)]
    plan = slots(source_targets(sized(frame(rows), rule), rule), rule)
    per_source = plan.groupBy("source").agg(F.sum("words").alias("n")).collect()
    assert sum(r.n for r in per_source) == pytest.approx(1.5 * sum(10 + i % 7 for i in range(200)), abs=4)
    draws = defaultdict(list)
    for r in shard_draws(plan).collect():
        draws[r.source].append(r.blocks)
    assert all(len(set(d)) > 1 for d in draws.values())
    places = plan.select("shard", "slot").collect()
    assert len(set(places)) == len(places)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 5000])
def test_permutation(spark, n):
    df = spark.range(n).withColumns({"x": F.col("id"), "n": F.lit(n).cast("long"), "k": F.lit(3).cast("long")})
    out = [r.x for r in permuted(df, "x", "n", "k").orderBy("id").collect()]
    assert sorted(out) == list(range(n)) and (n < 100 or out != list(range(n)))


def permuted_by_hand(x, n, key):
    """The same rounds with whole numbers of any size."""
    primes = common.PRIMES

    def affine(x, n, key):
        pick = key % 4
        a = primes[pick] if n % primes[pick] else primes[pick + 4]
        return (x * a + (key * 31 + 17) % n) % n

    for r in range(3):
        x = affine(x, n, key * 7919 + r * 104729 + 13)
        cut = max(n * (5 + 2 * r) // 13, 1)
        if x < cut:
            x = n - cut + affine(x, cut, key * 6131 + r * 15485863 + 7)
        else:
            x = affine(x - cut, max(n - cut, 1), key * 3571 + r * 32452843 + 3)
    return x


@pytest.mark.parametrize("n", [1000, 2**34 + 3, 2**36, 2**46])
def test_permutation_of_long_decks(spark, n):
    some = [i * (n // 500) + i for i in range(500)] + [n - 1]
    df = spark.createDataFrame([(x, x, n, 12) for x in some], "id long, x long, n long, k long")
    out = {r.id: r.x for r in permuted(df, "x", "n", "k").collect()}
    assert out == {x: permuted_by_hand(x, n, 12) for x in some} and len(set(out.values())) == len(out)


def test_rows_without_ids_spread_over_ranges(spark, frame):
    """A table of rows without ids, or with ids that share a hash, is laid out by many tasks."""
    rows = [(None if i % 2 else (i % 8) << 31, f"w{i} " * (i % 9 + 1), "one") for i in range(400)]
    sizes = sized(frame(rows))
    out = laid_out(sizes, source_targets(sizes))
    ranges = out.groupBy(F.spark_partition_id()).count().count()
    spans = sorted((r.offset, r.offset + r["size"]) for r in out.collect())
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and ranges > 1
    files = spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0])
    assert files.groupBy("range").count().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_ranks(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1000).alias("v"))
    df = df.withColumn("g", F.when(F.col("g") > 0, F.col("g")))  # a third of the rows has no group
    seen = defaultdict(list)
    for r in with_rank(df, ["v"], ["g"], "r").orderBy("v").collect():
        seen[r.g].append(r.r)
    assert set(seen) == {None, 1, 2} and all(v == list(range(len(v))) for v in seen.values())
