import random

from pyspark.sql import functions as F

from decisionlake.operators import asof, replay


def test_as_of_against_search(spark):
    rng = random.Random(7)
    changes = [(f"e{rng.randrange(4)}", rng.randrange(0, 300) * asof.SPAN // 40, n) for n in range(400)]
    changes += [("hot", rng.randrange(0, 100) * asof.SPAN // 40, 1000 + n) for n in range(300)]
    events = [(rng.choice(["e0", "e1", "hot", "none"]), rng.randrange(-5, 320) * asof.SPAN // 40, f"v{n}") for n in range(500)] + [(None, 1, "x"), ("e0", None, "y")]
    c = spark.createDataFrame(changes, "entity string, at long, rank long")
    e = spark.createDataFrame(events, "entity string, at long, event string")
    got = {r.event: r.effective for r in asof.as_of(c, e, c.select("entity", "rank", F.lit(1).alias("version_name"))).collect()}
    want = {}
    for entity, at, event in events:
        seen = [r for x, t, r in changes if x == entity and at is not None and t <= at]
        if seen:
            want[event] = max(seen)
    assert got == want
    split = asof.as_of(c, e, c.select("entity", "rank"), heavy=3)
    assert {r.event: r.effective for r in split.collect()} == want


def test_a_hot_entity_is_split(spark):
    """A third of all rows on one entity within one span: no piece holds more than a small part of them."""
    rows = [("hot", n * (asof.SPAN // 2000), None) for n in range(2000)] + [(f"e{n % 500}", n * (asof.SPAN // 4000), None) for n in range(4000)]
    narrow = spark.createDataFrame(rows, "entity string, at long, rank long")
    largest = asof._spanned(narrow, asof.SPAN, 100).groupBy("entity", "span").count().agg(F.max("count")).first()[0]
    assert largest <= 20


def test_as_of_empty(spark):
    c = spark.createDataFrame([], "entity string, at long, rank long")
    e = spark.createDataFrame([("a", 1, "x")], "entity string, at long, event string")
    assert asof.as_of(c, e, c.select("entity", "rank")).count() == 0
    assert asof.as_of(c, e.limit(0), c.select("entity", "rank")).count() == 0


FEED = [("a", 5, "u", "x", 1), ("a", 5, "u", "x", 1), ("a", 3, "c", "w", 2), ("b", 4, "d", None, 3), ("b", 2, "c", "q", 4), ("c", 9, "c", "__none", 5), ("c", 8, "d", None, 6), ("c", 7, "c", "old", 7), ("d", 11, "u", "__none", 8), ("d", 10, "c", "kept", 9), (None, 1, "c", "z", 10), ("e", None, "c", "z", 11)]


EACH = replay.Commits("n")


def feed(spark, rows=FEED):
    return spark.createDataFrame(rows, "k string, n long, op string, address string, watermark long")


def gone():
    return F.col("op") == "d"


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_replay(spark):
    rows = FEED[:]
    random.Random(1).shuffle(rows)
    assert pairs(replay.last_changes(feed(spark, rows), "k", "n", gone(), EACH)) == {("a", 5), ("c", 9), ("d", 11)}
    state = {r.k: (r.n, r.address) for r in replay.current_state(feed(spark, rows), "k", "n", gone(), EACH, {"address": "__none"}).collect()}
    assert state == {"a": (5, "x"), "c": (9, None), "d": (11, "kept")}
    assert replay.last_changes(feed(spark, []), "k", "n", gone(), EACH).count() == 0
    # in an open feed more of the last transaction may come
    assert pairs(replay.last_changes(feed(spark, rows), "k", "n", gone(), replay.Commits("n", closed=False))) == {("a", 5), ("c", 9), ("d", 10)}


def test_watermark_holds_gaps_and_incomplete_transactions(spark):
    gaps = replay.Commits("n", dense=True)
    dense = spark.createDataFrame([("a", 1, "c"), ("b", 2, "c"), ("a", 3, "u"), ("b", 5, "d")], "k string, n long, op string")
    assert replay.committed_watermark(dense, "n", gaps).first()[0] == 3
    assert pairs(replay.last_changes(dense, "k", "n", gone(), gaps)) == {("a", 3), ("b", 2)}
    far = spark.createDataFrame([(n,) for n in (replay.SPAN - 1, replay.SPAN, replay.SPAN + 2)], "n long")
    assert replay.committed_watermark(far, "n", gaps).first()[0] == replay.SPAN
    # t2 lacks a change; t1 was committed only behind t2's first, so that it is held as a whole; a repeated change counts once
    parts = spark.createDataFrame([("a", 1, "c", "t0", 1), ("b", 2, "c", "t1", 2), ("a", 3, "u", "t2", 3), ("c", 4, "c", "t2", 3), ("c", 4, "c", "t2", 3), ("b", 5, "u", "t1", 2), ("d", 6, "c", None, None)], "k string, n long, op string, t string, size int")
    sized = replay.Commits("t", "size")
    assert replay.committed_watermark(parts, "n", sized).first()[0] == 2
    assert pairs(replay.last_changes(parts, "k", "n", gone(), sized)) == {("a", 1)}
    # the change before 4 never came
    chain = spark.createDataFrame([("a", 1, "c", None), ("b", 2, "c", 1), ("a", 4, "u", 3), ("b", 5, "d", 4)], "k string, n long, op string, before long")
    linked = replay.Commits("n", previous="before")
    assert pairs(replay.last_changes(chain, "k", "n", gone(), linked)) == {("a", 1), ("b", 2)}


def test_ablation_on_the_whole_feed(spark, small):
    """With a transaction torn in the middle of the stored feed, the watermark decides which customers come out."""
    stored = spark.read.parquet(f"{small}/customer_profile_raw.parquet")
    key, lsn, deleted = "internal_customer_uuid", "cdc_lsn", F.lower("cdc_op") == "d"
    plain = pairs(replay.last_changes(stored, key, lsn, deleted, replay.Commits("cdc_source_ts_ms")))
    numbers = sorted({r[0] for r in stored.select(lsn).collect()})
    torn = numbers[len(numbers) // 2]
    marked = stored.withColumn("changes", F.when(F.col(lsn) == torn, 2).otherwise(1).cast("int")).withColumn("commit", F.col(lsn))
    held = pairs(replay.last_changes(marked, key, lsn, deleted, replay.Commits("commit", "changes")))
    assert held != plain and max(n for _, n in held) < torn
    want: dict = {}
    for r in sorted({(r[0], r[1], r[2]) for r in stored.select(key, lsn, "cdc_op").collect() if r[0] and r[1] < torn}, key=lambda r: r[1]):
        want.pop(r[0], None)
        if r[2] != "d":
            want[r[0]] = r[1]
    assert held == set(want.items())
