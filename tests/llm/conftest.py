import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns named like those the operators work with.
CLASHING = ("text_key", "pass", "rank", "range", "slot", "shard", "label", "row", "spans", "blob", "doc", "hash")


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) or (id, text, source), with columns of clashing names."""

    def make(rows, extra=True, parts=3):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else f"s{i % 3}", len(r[1] or ""))
            for i, r in enumerate(rows)
        ]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts)
        if extra:
            for name in CLASHING:
                from pyspark.sql import functions as F

                df = df.withColumn(name, F.lit(7))
        return df

    return make


def awkward(rng):
    """Texts that break naive code: empty, blank, long, repeated, not ASCII, periodic."""
    words = ["alpha", "beta", "Gamma,", "délta", "12", "km", "x" * 40, "日本", "it's", " nb"]
    long = " ".join(rng.choice(words) + str(rng.randrange(300)) for _ in range(6000))
    plain = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))) for _ in range(25)]
    shared = " ".join(f"w{i}" for i in range(40))
    texts = [None, "", " ", "\t\n \x0b\x0c\r", "one", "a" * 3000, "ab " * 900, long, long + " end", *plain]
    texts += [shared, f"before {shared} after", f"{shared}\n{shared}", shared.upper(), f"  {shared}\r\n"]
    texts += [f"{long[:4000]} {shared} {long[4000:9000]}"] + plain[:6]
    return texts


@pytest.fixture(scope="session")
def rows():
    import random

    rng = random.Random(4)
    texts = awkward(rng)
    out = [(i * 7 % 101, t) for i, t in enumerate(texts)]
    out += [out[9], out[9], (out[10][0], "another text under the same id " * 5)]
    return out + [(None, texts[-1]), (None, None), (None, texts[9])]
