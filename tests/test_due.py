import random
from datetime import datetime, timedelta


from sluice.streaming import due

SCHEMA = "key string, at timestamp, number long, due timestamp, item string"
T0 = datetime(2024, 1, 1)


def model(rows, until):
    held, out = {}, []
    for key, at, _, when, item in sorted(rows, key=lambda r: (r[1], r[2])):
        if key in held and held[key][0] <= at:
            out.append((key, *held.pop(key)))
        held.pop(key, None)
        if when is not None:
            held[key] = (when, item)
    out += [(k, *v) for k, v in held.items() if v[0] <= until]
    return sorted(out)


def test_each_item_fires_once_also_after_a_restart(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        at = T0 + timedelta(minutes=10 * i + rng.randrange(10))
        rows.append((f"k{rng.randrange(12)}", at, i, None if rng.random() < 0.1 else at + timedelta(minutes=rng.choice([0, 5, 60, 200, 900])), f"i{i}"))
    rows.append(("end", T0 + timedelta(days=9), 999, None, "e"))
    source, state, out = (f"file://{tmp_path}/{x}" for x in ("in", "state", "out"))

    def run(part):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = due.due_items(spark.readStream.schema(SCHEMA).parquet(source))
        stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()

    for a, b in ((0, 80), (80, 81), (81, 200), (200, 301)):
        run(rows[a:b])
    got = sorted((r.key, r.due, r.item) for r in spark.read.schema(due.OUT).parquet(out).collect())
    assert got == model(rows, T0 + timedelta(days=9)) and len(got) > 50
    assert len({r[2] for r in got}) == len(got)
