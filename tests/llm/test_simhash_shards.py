"""A shard is worked on in one task, also when the join before it is turned into a broadcast one."""

import random

from orderlake.llm import simhash


def test_all_links_of_a_frame_in_many_parts(spark):
    rng = random.Random(9)
    values = {rng.getrandbits(64) for _ in range(3000)}
    for x in list(values)[:300]:  # a chain of near values behind each of some
        for _ in range(8):
            for b in rng.sample(range(64), 2):
                x ^= 1 << b
            values.add(x)
    values = sorted(values)
    prints = spark.createDataFrame([(simhash._signed(x),) for x in values], "fp long").repartition(8).checkpoint()
    tops = []
    for pairs in (((a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 3),
                  ((r["src"] % (1 << 64), r["dst"] % (1 << 64)) for r in simhash.links(prints).collect())):
        top = {x: x for x in values}

        def root(x):
            while top[x] != x:
                x = top[x]
            return x

        for a, b in pairs:
            a, b = sorted((root(a), root(b)))
            top[b] = a
        tops.append({x: root(x) for x in values})
    assert tops[0] == tops[1] and len(set(tops[0].values())) < len(values)


def test_shards_are_dealt_after_the_join(spark):
    """The adaptive planner may turn a join into a broadcast one and drop its deal; the shards keep theirs."""
    prints = spark.createDataFrame([(x,) for x in range(50)], "fp long").checkpoint()
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = simhash.links(prints)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    after = plan[plan.index("MapInArrow"):]
    assert "Exchange" in after[:after.index("SortMergeJoin")]
