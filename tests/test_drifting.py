"""Records whose fields drift."""

import json
from collections import Counter

from helpers import at, plan_of
from sessionloom.sources import drifting

LINES = [
    '{"type":"a","event":{"customer-id":7,"timestamp":"2023-01-01T00:01:00"}}',
    '{"type":"a","customer-id":8,"event":{"customer-id":9,"timestamp":"2023-01-01T00:02:00.5"}}',
    '{"type":"a","customer-id":null,"timestamp":"2023-01-01T00:03:00","event":{"customer-id":9,"extra":[1]}}',
    '{"customer-id":7.0}',
    "{}",
    '{"event":null,"type":null}',
    '{"event":5,"customer-id":1}',
    '{"customer-id":"7","type":"a"}',
    '{"customer-id":7.5}',
    '{"customer-id":99999999999999999999}',
    '{"customer-id":true}',
    '{"customer-id":1,"timestamp":17}',
    '{"customer-id":1,"timestamp":"2023-01-01 00:01:00"}',
    '{"customer-id":1,"type":["a"]}',
    "nope",
    "[1,2]",
    "3",
    '{"customer-id":1',
    "   ",
]


def lines(spark, tmp_path, rows=LINES):
    path = tmp_path / "lines"
    path.mkdir(exist_ok=True)
    (path / "part.json").write_text("\n".join(rows) + "\n")
    return drifting.read_lines(spark, str(path))


def test_sift(spark, tmp_path):
    sifted = drifting.sift(lines(spark, tmp_path), keep={"event-id": "long"})
    got = Counter(tuple(r) for r in sifted.events.collect())
    half = at(2).replace(microsecond=500_000)
    assert got == Counter(
        [
            (None, 7, at(1), "a"),
            (None, 8, half, "a"),
            (None, 9, at(3), "a"),
            (None, 7, None, None),
            (None, None, None, None),
            (None, None, None, None),
            (None, 1, None, None),
        ]
    )
    reasons = {r.line: r.reason for r in sifted.aside.collect()}
    assert reasons == {
        **dict.fromkeys(LINES[7:11], drifting.BAD_CUSTOMER),
        **dict.fromkeys(LINES[11:13], drifting.BAD_TIME),
        LINES[13]: drifting.BAD_TYPE,
        **dict.fromkeys(LINES[14:18], drifting.NO_RECORD),
    }
    target = str(tmp_path / "aside")
    for _ in range(2):
        sifted.quarantine(target)
    assert Counter(r.line for r in spark.read.parquet(target).collect()) == Counter(2 * list(reasons))


def test_lines_are_parsed_once(spark, tmp_path):
    sifted = drifting.sift(lines(spark, tmp_path), keep={"event-id": "long"})
    for part in (sifted.events, sifted.aside):
        assert plan_of(part).count("parseJson") == 1


def test_profile(spark, tmp_path):
    names = {str: "text", int: "number", float: "number", bool: "flag", type(None): "null", list: "list", dict: "struct"}
    want = Counter()
    for line in LINES[:-1]:
        try:
            record = json.loads(line)
        except ValueError:
            record = None
        if not isinstance(record, dict):
            want[None, None, "no record"] += 1
            continue
        for field, value in record.items():
            want["top", field, names[type(value)]] += 1
        for field, value in (record.get("event") or {}).items() if isinstance(record.get("event"), dict) else ():
            want["inside", field, names[type(value)]] += 1
    got = {(r.place, r.field, r.kind): r.records for r in drifting.field_profile(lines(spark, tmp_path)).collect()}
    assert got == want


def test_no_lines(spark, tmp_path):
    none = lines(spark, tmp_path, [""])
    assert drifting.field_profile(none).count() == 0
    sifted = drifting.sift(none)
    assert sifted.events.count() == 0 and sifted.aside.count() == 0
    assert sifted.events.columns == ["customer_id", "timestamp", "type"]
