import datetime as dt
import random

from pyspark.sql import functions as F

from decisionlake.operators import messages

T = dt.datetime


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, t timestamp_ntz, body string, bucket string, key string")


def test_repeats_against_counting(spark):
    rng = random.Random(5)
    rows = [(f"M{rng.randrange(3000)}" + rng.choice(["", " ", "  "]), T(2024, rng.randrange(1, 7), 3), str(i), "b", "k") for i in range(4000)]
    rows += [("hot", T(2024, 2, 1), str(i), "b", "k") for i in range(2000)]
    counts = {}
    for r in rows:
        counts[r[0].strip().upper()] = counts.get(r[0].strip().upper(), 0) + 1
    got = [r.key for r in messages.repeated_keys(frame(spark, rows), "id", "t").collect()]
    assert sorted(got) == sorted(k for k, n in counts.items() if n > 1)
    once = messages.exactly_once(frame(spark, rows), "id", "t").collect()
    assert sorted(r.id.strip().upper() for r in once) == sorted(counts)


def test_edges(spark):
    rows = [(None, T(2024, 1, 1), "x", None, None), (None, T(2024, 1, 1), "x", None, None), (" ", None, "y", None, None), ("a", None, "1", None, None), ("A ", T(2024, 1, 1), "2", None, None), ("b", T(2024, 1, 1), "3", None, None), ("b", T(2024, 1, 1), "3", None, None)]
    once = messages.exactly_once(frame(spark, rows), "id", "t")
    assert once.columns == ["id", "t", "body", "bucket", "key"]
    got = [(r.id, r.body) for r in once.collect()]
    assert sorted(got, key=repr) == sorted([(None, "x"), (None, "x"), (" ", "y"), ("a", "1"), ("b", "3")], key=repr)
    assert messages.exactly_once(frame(spark, []), "id", "t").count() == 0
    assert messages.repeated_keys(frame(spark, []), "id", "t").count() == 0


def test_filters_miss_nothing(spark):
    rows = [(f"K{i}", T(2024, 1 + i % 2, 1), "", "", "") for i in range(500)] + [(f"K{i}", T(2024, 2 - i % 2, 1), "", "", "") for i in range(500)]
    store, size = messages.stored(frame(spark, rows), "id", "t")
    found = messages.possible_repeats(store, size).select("key").distinct().count()
    assert found == 500
    alone = messages.stored(frame(spark, rows[:500]), "id", "t")
    assert messages.possible_repeats(*alone).count() <= 10
    assert messages.bloom_filters(store).agg(F.max(F.length("bits"))).first()[0] == messages.BITS // 8
