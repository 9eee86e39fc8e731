"""Token files, sharding, fingerprints, SimHash, and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from sessionloom.llm import fingerprints as fp
from sessionloom.llm import queries, simhash, token_files
from sessionloom.llm.components import components
from sessionloom.llm.sharding import ShardRule, shard_documents, shard_rows, split_groups
from sessionloom.llm.simhash import SimHashRule, near_duplicates, one_of_each
from sessionloom.session import work_folder

# --- token files ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def written(spark, df, **options):
    path = work_folder(spark, "test-tokens")
    token_files.write_tokens(df, path, token_files.TokenFormat(queries.tokenizer_path(), **options))
    return path


def test_token_files(spark, frame, rows, tokenizer):
    path = written(spark, frame(rows))
    got = token_files.token_digests(spark, path).orderBy("start").collect()
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows}
    packed = {t: np.array(x, dtype="<u4").tobytes() for t, x in ids.items()}
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (i, len(ids[t]), zlib.crc32(packed[t])) for i, t in rows
    )
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    again = token_files.read_tokens(spark, path).filter("doc_id = 21").collect()
    assert [list(r.ids) for r in again] == [ids[t] for i, t in rows if i == 21]
    index = token_files.read_index(spark, path)
    assert index.agg(F.sum("tokens")).first()[0] == sum(r.n_tokens for r in got)
    plan = token_files.read_tokens(spark, path).filter("doc_id = 21")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,21)" in plan


def test_no_documents(spark, frame):
    assert token_files.token_digests(spark, written(spark, frame([]))).count() == 0


def test_encoder_equals_the_tokenizer(tokenizer, monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    odd = "it's don't. İstanbul café, x--y <|endoftext|> a<|endoftext|>b ǅ. 12.5 éa ﬁne Ⅷ ß!! 日本語。 's s's. ŉa".split(" ")
    texts = [" ".join(rng.choice([*odd, "plain", "Words,", f"w{rng.random()}"]) for _ in range(50)) for _ in range(80)]
    texts += ["", " \n\t", "a b", "x  y\r\n"]
    monkeypatch.setattr(token_files, "CACHED_WORDS", 100)
    encode = token_files._Encoder(queries.tokenizer_path())
    for a in range(0, len(texts), 9):
        part = texts[a : a + 9]
        ids, n = encode(pa.array([t.encode() for t in part], pa.binary()), 1)
        want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in part]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_other_tokenizers(spark, frame):
    import public_tokenizers

    with pytest.raises(Exception, match="span blanks"):
        token_files._Encoder(public_tokenizers.path("byte_bpe_50k.json"))


# --- sharding -------------------------------------------------------------------------------------


def test_shards(frame, rows):
    copies = [(1000 + i, "the same text") for i in range(40)] + [(2000 + i, f"pair {i // 2}") for i in range(60)]
    full = rows + copies
    out = shard_documents(frame(full)).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t in full
    )
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    counts = [len(slots[s]) for s in range(16)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(full)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    pairs = defaultdict(set)
    for r in out:
        if 2000 <= (r.doc_id or 0) < 2060:
            pairs[r.doc_id // 2].add(r.shard)
    assert sum(len(p) > 1 for p in pairs.values()) <= 3
    # Forty copies need at least five shards of some nine rows; they should not be in many more.
    assert len({r.shard for r in out if 1000 <= (r.doc_id or 0) < 1040}) <= 8


def test_shards_of_little(frame):
    assert shard_documents(frame([])).count() == 0
    out = shard_documents(frame([(1, None), (2, ""), (3, "x")])).collect()
    assert sorted(r.shard for r in out) == [0, 1, 2] and all(r.slot == 0 for r in out)


def test_rows_in_several_groups(spark):
    rng = random.Random(1)
    # Eight clusters of rows that share several groups with their own cluster.
    rows = spark.range(400).withColumnRenamed("id", "row")
    links = {(i, (i % 8) * 10 + rng.randrange(4)) for i in range(400) for _ in range(3)}
    members = spark.createDataFrame(sorted(links), "row long, group long")
    out = shard_rows(rows, members, ShardRule(shards=8)).cache()
    counts = [r[1] for r in out.groupBy("shard").count().collect()]
    assert sorted(counts) == [50] * 8
    random_cut = members.select("row", "group", (F.xxhash64("row") % 8).alias("shard"))
    cut = split_groups(out, members).agg(F.sum("shards")).first()[0] or 0
    base = random_cut.groupBy("group").agg(F.countDistinct("shard").alias("n")).agg(F.sum("n")).first()[0]
    assert cut < 0.8 * base


def test_texts_that_all_occur_twice_stay_together(frame):
    out = shard_documents(frame([(i, f"text {i // 2}") for i in range(4000)])).collect()
    assert set(Counter(r.shard for r in out).values()) == {250}
    shards = defaultdict(set)
    for r in out:
        shards[r.doc_id // 2].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 32


def test_propagation_brings_linked_documents_together(spark, sf_dir):
    """Moves are granted on the given table, votes come to agree, and fewer lines are cut than at the start."""
    docs = queries.documents(spark, sf_dir.replace("sf0.001", "sf0.01"))
    trace: list[dict] = []
    out = shard_documents(docs, trace=trace)
    start = shard_documents(docs, ShardRule(rounds=0))
    assert sum(t["moved"] for t in trace) > 100 and trace[-1]["wanted"] < trace[0]["wanted"] / 4
    assert trace[-1]["agreed"] > 0.8 > 0.5 > trace[0]["agreed"]
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).distinct()
    lines = lines.filter(F.length("line") >= 60)

    def cut(assigned):
        both = lines.join(assigned.select("doc_id", "shard"), "doc_id").groupBy("line")
        return both.agg(F.countDistinct("shard").alias("n")).agg(F.sum(F.col("n") - 1)).first()[0]

    assert cut(out) < 0.5 * cut(start)
    sizes = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and len(sizes) == 16
    equal = out.join(docs.select("doc_id", "text"), "doc_id").groupBy("text")
    assert equal.agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0


def test_lines_in_very_many_texts_link(frame, monkeypatch):
    from sessionloom.llm import sharding

    # One line in every second text, one in every text of a block of forty, and one in a single text.
    common, own = "a line that every second text has " * 2, "a line of block {} of forty neighbours " * 2
    texts = [f"{own.format(i // 40, i // 40)}\ntext {i}" + (f"\n{common}" if i % 2 else "") for i in range(1200)]
    docs = frame([(i, t) for i, t in enumerate(texts)] + [(5000, "a line that no other text has at all, not one " * 2)])
    links = sharding.document_links(docs)
    assert sorted(Counter(r.group for r in links.collect()).values()) == [40] * 30 + [600]
    rows = docs.select(F.col("doc_id").alias("row"), sharding._home().alias("home"))
    sizes = rows.select(F.col("row").alias("unit"), "home", F.lit(1).alias("n"), (F.col("row") % 16).alias("label"))
    members = links.withColumn("weight", F.lit(1))

    def votes():
        linked = sharding.links(members, sizes)
        state = sizes.select("unit", "n", F.lit(False).alias("fixed"), "label")
        found = sharding._votes(linked, state).select("unit", "label", "own", "every", "best")
        return linked.agg(F.max("part")).first()[0], Counter(map(str, found.collect()))

    last, whole = votes()
    assert last == 0 and sum(whole.values()) == 1200
    # Groups in parts, and the largest ones broadcast, vote as they do whole.
    monkeypatch.setattr(sharding, "GROUP_ROWS", 50)
    monkeypatch.setattr(sharding, "LARGE_GROUPS", 10)
    last, parts = votes()
    assert last == 11 and parts == whole
    assert sharding.document_links(docs).count() == links.count()


def test_granted_moves_keep_the_quotas():
    from sessionloom.llm.sharding import _granted

    # Ten rows want to go from 0 to 1 and four back; there is room for three in 1 and none in 0.
    share = _granted([[0, 10], [4, 0]], [0, 3])
    assert share[1] * 10 == pytest.approx(5) and share[2] == pytest.approx(0.5)
    assert _granted([[0, 10], [0, 0]], [0, 3]) == [0, pytest.approx(0.3), 0, 0]
    assert _granted([[0, 0], [0, 0]], [1, 1]) == [0, 0, 0, 0]


def test_a_text_of_a_third_of_all_rows_is_few_units(frame):
    from sessionloom.llm import sharding

    rows = frame([(i, "the same text") if i % 3 == 0 else (i, f"text {i}") for i in range(1500)])
    out = shard_documents(rows).collect()
    shards = Counter(r.shard for r in out if r.doc_id % 3 == 0)
    assert set(Counter(r.shard for r in out).values()) <= {93, 94} and len(shards) <= 9
    numbered = rows.select(F.col("doc_id").alias("row"), F.xxhash64("text").alias("home"))
    units = sharding.units(numbered, numbered, [94] * 16, ShardRule())
    assert units.groupBy("unit").count().agg(F.max("count")).first()[0] <= 5


# --- fingerprints ---------------------------------------------------------------------------------


def test_edit_report(frame, rows):
    unique = [r for k, r in enumerate(rows) if r[0] is not None and r[0] not in {i for i, _ in rows[:k]}]
    out = {r.doc_id: r for r in fp.edit_report(frame(unique)).collect()}
    order = sorted(unique, key=lambda r: -r[0])
    assert len(out) == len(unique)
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        text, new = t or "", fp.edited(t or "", following or "")
        known, changed, after = (fp.fingerprints([x.encode()]) for x in (text, new, following or ""))
        r = out[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (fp.encoded(*known)[0], fp.encoded(*changed)[0])
        assert r.near_edited == fp.likeness(known, changed)[0] and r.near_next == fp.likeness(known, after)[0]


def test_reports_of_repeated_and_missing_ids(frame, rows):
    out = fp.edit_report(frame(rows)).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in rows)
    (one,) = fp.edit_report(frame([(5, "abcdef")])).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1
    assert fp.edit_report(frame([])).count() == 0 and fp.fingerprint_documents(frame([])).count() == 0
    assert fp.edit_report(frame([(None, None), (None, "x")])).count() == 2


def test_fingerprints_are_sums():
    parts = [f"paragraph {i} of some length" for i in range(50)]
    mixed = random.Random(2).sample(parts, 50)
    whole = fp.encoded(*fp.fingerprints(["\n".join(parts).encode()]))[0]
    assert fp.encoded(*fp.fingerprints(["\n\n".join(mixed).encode()]))[0] == whole
    fewer = fp.encoded(*fp.fingerprints(["\n".join(parts[:45]).encode()]))[0]
    rest = [p.encode() for p in parts[45:]]
    assert fp.inserted(fewer, rest) == whole and fp.inserted(whole, rest, -1) == fewer
    assert fp.encoded(*fp.fingerprints([("\n".join(parts) + "\n" + parts[0]).encode()]))[0] != whole
    assert set(fp.encoded(*fp.fingerprints([b" \n \n"]))[0]) == {"0"}


@pytest.mark.parametrize("n", [8, 100, 3000])
def test_likeness_follows_what_is_shared(n):
    parts = [f"line {i}" for i in range(2 * n)]
    make = lambda a, b: fp.fingerprints(["\n".join(parts[a:b]).encode()])
    assert fp.likeness(make(0, n), make(0, n))[0] == 1
    assert fp.likeness(make(0, n), make(n, 2 * n))[0] < 0.15
    assert 0.5 < fp.likeness(make(0, n), make(max(1, n // 10), n))[0] < 1


def test_likeness_of_very_long_texts():
    n, found = 200_000, []
    for k in range(4):
        lines = [f"line {i} of text {k}" for i in range(n)]
        a, b = ("\n".join(part).encode() for part in (lines, lines[n // 2 :] + ["new"]))
        found.append(fp.likeness(fp.fingerprints([a]), fp.fingerprints([b]))[0])
    assert 0.35 < sum(found) / len(found) < 0.65


# --- SimHash --------------------------------------------------------------------------------------


def plain_fingerprint(text, k=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = lower.encode().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints, ids, distance=3):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for a, i in enumerate(ids):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return [least.get(find(a)) for a in range(len(prints))]


def test_near_duplicates(frame, rows):
    rng = random.Random(6)
    base = [f"word{rng.randrange(500)}" for _ in range(300)]
    near = [(3000 + i, " ".join([*base[:-1], f"end{i % 9}"])) for i in range(30)]
    full = rows + near + [(9000, " ".join(base).upper())]
    out = near_duplicates(frame(full)).collect()
    prints = [plain_fingerprint(t) for _, t in full]
    named = plain_components(prints, [i for i, _ in full])
    want = Counter((i, f"{p:016x}", c) for (i, _), p, c in zip(full, prints, named))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in out) == want
    kept = one_of_each(frame(full))
    assert kept.schema == frame(full).schema
    apart = set(zip(plain_components(prints, range(len(full))), named))  # components, also of one least id
    assert Counter(r.doc_id for r in kept.collect()) == Counter(c for _, c in apart if c is not None)


def test_one_of_each_loses_no_text(frame):
    """Rows of one id in several components, and components whose smallest id other texts have too."""
    shared, lone = "one two three four five six", "alpha beta gamma delta epsilon zeta"
    rows = [(7, lone), (7, shared), (9, shared), (11, shared), (7, "third text of the same id here"), (None, lone)]
    kept = Counter((r.doc_id, r.text) for r in one_of_each(frame(rows)).collect())
    assert kept == Counter({(7, lone): 1, (7, shared): 1, (7, "third text of the same id here"): 1})
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(12)]
    rows = [(rng.randrange(5), rng.choice(texts)) for _ in range(120)]
    found = near_duplicates(frame(rows)).collect()
    members = defaultdict(set)
    for (i, t), key in {(r, simhash.fingerprint(r[1].encode())) for r in rows}:
        members[key].add((i, t))
    kept = one_of_each(frame(rows)).collect()
    assert len(kept) == len({simhash.fingerprint(t.encode()) for _, t in rows}) > 5
    assert all((r.doc_id, r.text) in members[simhash.fingerprint(r.text.encode())] for r in kept)
    assert {min(i for i, _ in m) for m in members.values()} == {r.component_id for r in found}


def test_rows_without_ids_only(frame):
    rows = [(None, "a b c d"), (None, "a b c d"), (None, None)]
    assert {r.component_id for r in near_duplicates(frame(rows)).collect()} == {None}
    assert one_of_each(frame(rows)).count() == 3
    assert near_duplicates(frame([])).count() == 0 and one_of_each(frame([])).count() == 0


@pytest.mark.parametrize("hot", [simhash.HOT_BUCKET, 40])
def test_links_connect_what_is_near(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    prints = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(300):  # a dense group, and chains that lead away from it
        p = centre
        for b in rng.sample(range(64), rng.choice([1, 2, 3, 6])):
            p ^= 1 << b
        prints.add(p)
    chain = rng.getrandbits(64)
    for b in range(0, 60, 3):
        prints.add(chain)
        chain ^= 7 << b
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(nodes)).collect()}
    got = [roots.get(s, s) for s in signed]
    want = plain_components(prints, signed)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_search_in_a_large_bucket():
    rng = np.random.default_rng(4)
    fps = np.unique(np.concatenate([rng.integers(0, 2**64, 300, dtype=np.uint64), np.uint64(9) ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))]))
    table = np.bitwise_count(fps[:, None] ^ simhash.pivots()[None]).astype(np.int8)
    a, b = simhash._search(fps, table, 3)
    assert all(int(x ^ y).bit_count() <= 3 for x, y in zip(a, b)) and len(a) < len(fps)
    named = plain_components([int(f) for f in fps], range(len(fps)))
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        root[find(x)] = find(y)
    assert len({find(int(f)) for f in fps}) == len(set(named))


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (-5, 7)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {out.get(i, i) for i in range(31)} == {-5} and {out.get(100 + i, 100) for i in range(50)} == {100}
    assert 200 not in out
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pipeline -------------------------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    columns, held = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = work_folder(spark, "test-stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        held.append(docs.count())
    assert held[0] > held[1] > held[2] >= held[3] > 0
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == held[-1]


def test_stages_take_awkward_rows(spark, frame, rows, sf_dir, tmp_path):
    docs = frame(rows)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[1:]):
        out = stage(spark, docs, sf_dir)
        if n < 3:
            assert out.schema == docs.schema
        assert out.count() > 0
        assert stage(spark, frame([]), sf_dir).count() == 0


def test_stages_are_the_ones_agreed():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == [
        "quality classifier",
        "simhash near-dedup",
        "benchmark decontamination",
        "mixing sources",
        "token files",
    ]
    assert len(queries.queries()) == 13 and SimHashRule() == SimHashRule(3, 3, 42)


def test_ranges_by_cuts(spark):
    for n in (0, 1, 2, 3, 10, 99, 1000):
        cuts = [5 * (n - i) for i in range(n)]
        df = spark.range(-3, 5 * n + 4).withColumn("r", fp._larger(cuts, F.col("id")))
        assert all(r.r == sum(c > r.id for c in cuts) for r in df.collect())
