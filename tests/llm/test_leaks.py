from collections import Counter

import pytest

from sessionloom.llm import decontamination
from sessionloom.llm.decontamination import LeakRule, leaks, without_leaks

ITEM = "Tom drove 120 km in 3 hours and then he met Anna near the old bridge while Tom waited there"
OTHER = "Paul drove 85 km in 2 hours and then he met Julia near the old bridge while Paul waited there"
TWICE = "Tom said that he met Anna near the old bridge and then Tom went home again with Anna and her friends"
MIXED = "Paul said that he met Julia near the old bridge and then Max went home again with Julia and her friends"


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string, rank int")


@pytest.fixture(params=[10**6, 0], ids=["broadcast", "shuffled"])
def way(request, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", request.param)


def found(spark, frame, docs, items, rule=LeakRule()):
    rows = leaks(frame(docs), table(spark, [(i, t, 0) for i, t in items]), rule).collect()
    return {(r.doc_id, r.item_id): (r.n_windows, r.item_windows, r.exact) for r in rows}


def test_changed_names_and_numbers_are_found(spark, frame, way):
    docs = [(1, f"x y z {ITEM} and so on"), (2, f"intro. {OTHER}"), (3, "nothing of the kind " * 20)]
    got = found(spark, frame, docs, [(9, ITEM)])
    n = got[1, 9][1]
    assert n > 3 and got == {(1, 9): (n, n, True), (2, 9): (n, n, False)}


def test_windows_with_other_bindings_do_not_count(spark, frame):
    same = TWICE.replace("Tom", "Paul").replace("Anna", "Julia")
    got = found(spark, frame, [(1, TWICE), (2, same), (3, MIXED)], [(9, TWICE)])
    n = got[1, 9][1]
    assert got[1, 9] == (n, n, True) and got[2, 9] == (n, n, False)
    assert n / 2 <= got[3, 9][0] < n and not got[3, 9][2]


def test_punctuation_and_breaks_do_not_matter(spark, frame):
    text = ITEM.replace(" and ", ",\nand   ").replace(" near ", " (near) ")
    assert (1, 9) in found(spark, frame, [(1, text)], [(9, ITEM)])


def test_part_of_an_item(spark, frame):
    words = ITEM.split()
    assert (1, 9) in found(spark, frame, [(1, " ".join(words[:16]))], [(9, ITEM)])
    assert not found(spark, frame, [(1, " ".join(words[:9]))], [(9, ITEM)])


def test_awkward_rows(spark, frame, rows, way):
    items = [(1, None, 0), (2, "", 0), (3, "too short", 0), (4, ITEM, 0), (4, ITEM, 0), (None, OTHER, 0)]
    docs = [*rows, (500, ITEM), (500, ITEM), (500, "other text"), (None, ITEM), (501, ITEM * 40)]
    df = frame(docs)
    bench = table(spark, items)
    got = Counter((r.doc_id, r.item_id) for r in leaks(df, bench).collect())
    assert got == Counter({(i, j): 1 for i in (500, None, 501) for j in (4, None)})
    kept = without_leaks(df, leaks(df, bench))
    assert kept.schema == df.schema
    want = Counter(d for d in docs if not (d[1] or "").startswith(ITEM))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == want


def test_empty_tables(spark, frame):
    assert leaks(frame([]), table(spark, [(1, ITEM, 0)])).count() == 0
    assert leaks(frame([(1, ITEM)]), table(spark, [])).count() == 0
    assert without_leaks(frame([(1, ITEM)]), leaks(frame([(1, ITEM)]), table(spark, []))).count() == 1


def test_against_plain_search(spark, sf_dir):
    import re

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    held = {}
    for r in bench.collect():
        w = words(r.text)
        for k in range(len(w) - 7):
            held.setdefault(tuple(w[k : k + 8]), set()).add(r.item_id)
    want = set()
    for r in docs.collect():
        w = words(r.text)
        hits = Counter(i for k in range(len(w) - 7) for i in held.get(tuple(w[k : k + 8]), ()))
        want |= {(r.doc_id, i) for i in hits}
    assert {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()} == want


def test_each_occurrence_is_bound_by_itself(spark, frame, way):
    same = TWICE.replace("Tom", "Paul").replace("Anna", "Julia")
    third = TWICE.replace("Tom", "Adam").replace("Anna", "Zoe")
    docs = [(1, TWICE), (2, f"{TWICE}. {same}"), (3, f"{same}, {third}. {same}"), (4, f"{third}. {same}")]
    got = found(spark, frame, docs, [(9, TWICE)])
    n = got[1, 9][1]
    assert got == {(1, 9): (n, n, True), (2, 9): (n, n, True), (3, 9): (n, n, False), (4, 9): (n, n, False)}


def test_capitals_do_not_matter(spark, frame, way):
    got = found(spark, frame, [(1, ITEM), (2, ITEM.lower()), (3, f"X {ITEM.upper()}"), (4, ITEM.title())], [(9, ITEM)])
    n = got[1, 9][1]
    assert got == {(i, 9): (n, n, True) for i in (1, 2, 3, 4)}


SUM = "Compute 12 + 5 * 7 - 3 / 9 + 14 - 2 * 6 + 18 and give 3 digits"
LIST = "Anna Tom Paul Julia Max Zoe Adam Eve Carl Dora"


def test_items_without_usable_windows_are_found_exactly(spark, frame, way):
    docs = [(1, f"x {SUM} y"), (2, f"x {LIST.lower()}"), (3, "It was a Short Phrase, he said"), (4, "a short one")]
    docs += [(5, SUM.replace("12", "13").replace("7", "8").replace("14", "15"))]
    items = [(1, SUM), (2, LIST), (3, "short phrase"), (4, "")]
    got = found(spark, frame, docs, items)
    assert set(got) == {(1, 1), (2, 2), (3, 3)} and all(n == m and exact for n, m, exact in got.values())


def test_long_quotes_are_found_whatever_their_share(spark, frame, way):
    words = [f"w{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(59)]
    cuts = {1: words[20:33], 2: words[20:32], 3: words[10:22] + ["x"] + words[22:30]}
    got = found(spark, frame, [(i, " ".join(["a", *w, "z"])) for i, w in cuts.items()], [(9, " ".join(words))])
    assert got == {(1, 9): (6, 52, True)}


def test_shared_instructions_make_no_pairs(spark, frame, way):
    """A line that all items begin with is no quote of any of them; what is their own still is found."""
    line = "read the following question with care and give the one best answer out of those below"
    own = [" ".join(f"q{'abcdefghijklmnopqrst'[i]}{'abcdefghijklmnop'[k]}" for k in range(16)) for i in range(20)]
    items = [(i, f"{line} {own[i]}") for i in range(20)]
    docs = [(100 + i, f"{line} and more of text number {'abcdefghij'[i % 10]}") for i in range(30)]
    docs += [(1, items[3][1]), (2, f"x {own[4]} y")]
    got = found(spark, frame, docs, items)
    assert {k for k in got if k[0] < 100} == {(1, 3), (2, 4)} and len(got) == 2
    # A question that comes under many ids is still found under each of them.
    same = [(i, items[0][1]) for i in range(12)]
    assert set(found(spark, frame, [(1, items[0][1])], same)) == {(1, i) for i in range(12)}
    # An item that is the line and one word is found by its last window.
    bare = [(i, f"{line} {'abcdefghij'[i]}") for i in range(10)]
    assert set(found(spark, frame, [*docs[:3], (1, bare[0][1])], bare)) == {(1, 0)}


def test_short_items_do_not_empty_the_corpus(spark, frame):
    docs = frame([(i, f"the text number {i} names Paris, too") for i in range(50)] + [(99, "say what is the capital of France now")])
    items = table(spark, [(1, "Paris", 0), (2, "the", 0), (3, "What is the capital of France", 0)])
    got = leaks(docs, items)
    assert got.filter("item_tokens < 5").count() == 101
    assert without_leaks(docs, got).count() == 50


def test_long_documents_full_of_matches(spark, frame, way):
    """40,000 windows of one document are met, and each is in four items."""
    text = " ".join([ITEM] * 1000)
    got = found(spark, frame, [(1, text), (2, "nothing of the kind " * 20)], [(i, ITEM) for i in range(4)])
    n = got[1, 0][1]
    assert got == {(1, i): (n, n, True) for i in range(4)}


def test_windows_of_many_items(spark, frame, way, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ITEMS", 0)
    got = found(spark, frame, [(1, f"x {ITEM} y"), (None, OTHER), (3, None)], [(9, ITEM), (8, ITEM)])
    n = got[1, 9][1]
    assert got == {(d, i): (n, n, d == 1) for d in (1, None) for i in (8, 9)}
