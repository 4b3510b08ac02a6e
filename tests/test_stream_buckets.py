"""The streamed replay packs the states of many orders into one bucket of the state store."""

import random

import pandas as pd

from orderlake.operators import lifecycle as L
from orderlake.streaming import lifecycle as stream


class _Held:
    def __init__(self):
        self.state = None

    @property
    def exists(self):
        return self.state is not None

    @property
    def get(self):
        return self.state

    def update(self, state):
        self.state = state


def test_a_bucket_replays_its_orders_like_each_alone():
    rng = random.Random(5)
    functions, orgs = [L.CREATE, L.VERIFY, L.SHARE, L.PUBLISH, L.CREATE_APPROVE, "other"], [L.ORG1, L.ORG2]
    bucket, alone, got, want = _Held(), {}, [], []
    for trigger in range(3):
        rows = [(o, trigger * 9 + rng.randrange(9), tx, rng.choice(functions), rng.choice(orgs), rng.choice(["h", "g", None]), rng.random() < 0.7)
                for tx, o in enumerate(rng.choices(["a", "b", "c", None], k=40))]
        rows = [r for r in rows if r[0] or r[3] != L.CREATE]
        batch = pd.DataFrame(rows, columns=["orderId", *stream._COMMAND])
        for out in stream._fold_bucket((0,), [batch.iloc[:13], batch.iloc[13:]], bucket):
            got += out.astype(object).where(out.notna(), None).values.tolist()
        for o in ("a", "b", "c", None):
            own = batch[batch["orderId"].isna() if o is None else batch["orderId"] == o]
            if len(own):
                for out in stream._fold((o,), [own], alone.setdefault(o, _Held())):
                    want += out.astype(object).where(out.notna(), None).values.tolist()
    assert sorted(got, key=str) == sorted(want, key=str) and any(r[5] for r in got) and not all(r[5] for r in got)
    assert stream._unpack(bucket.state[0]) == {o: h.state for o, h in alone.items()}


def test_the_state_store_holds_a_row_for_each_bucket(spark, scratch):
    columns = "orderId string, block long, tx int, function string, org string, customerId string, order struct<employee:int>, orderDetails struct<total:double>"
    rows = [(f"o{i}", 1, i, L.CREATE, L.ORG2, f"c{i}", (1,), (1.0,)) for i in range(60)]
    spark.createDataFrame(rows, columns).write.parquet(scratch + "/in")
    stated = stream.replay_stream(spark.readStream.schema(columns).parquet(scratch + "/in"), buckets=7)
    q = stated.writeStream.format("parquet").option("path", scratch + "/log").option("checkpointLocation", scratch + "/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 7
    assert spark.read.parquet(scratch + "/log").where("accepted").count() == 60
