import threading
import time

import pytest

from sluice import queries
from sluice.plans import audience, stages


def builder(spark, small, **leaves):
    b = queries._builder(spark, small)
    b.leaves.update({k: (lambda b, leaf, f=f: f(leaf)) for k, f in leaves.items()})
    return b


def slow(spark, seconds, fail=False):
    def run(batches):
        import time

        for b in batches:
            time.sleep(seconds)
            if fail:
                raise ValueError("this leaf fails")
            yield b

    return lambda leaf: spark.createDataFrame([(str(leaf.value),), ("7",)], "id string").coalesce(1).mapInPandas(run, "id string")


def leaf(key, value=1):
    return {"key": key, "op": "=", "value": value}


def test_two_leaves_overlap(spark, small, tmp_path):
    times, lock, save = {}, threading.Lock(), stages.save_in(f"file://{tmp_path}/s")

    def timed(name, ids):
        began = time.time()
        out = save(name, ids)
        with lock:
            times[name] = (began, time.time())
        return out

    b = builder(spark, small, a=slow(spark, 2), b=slow(spark, 2))
    run = stages.Run(b, {"op": "$and", "rules": [leaf("a"), leaf("b", 2)]}, timed)
    assert [r.id for r in run.wait().collect()] == ["7"]
    (a0, a1), (b0, b1), (top0, _) = (times[n] for n in run.states)
    assert max(a0, b0) < min(a1, b1) and top0 >= max(a1, b1)
    assert set(run.states.values()) == {stages.DONE} and all(d == t > 0 for _, d, t in run.progress().values())
    again = stages.Run(b, {"op": "$and", "rules": [leaf("a"), leaf("b", 2)]}, save, threads=1)
    began = time.time()
    assert [r.id for r in again.wait().collect()] == ["7"] and time.time() - began < 2  # nothing is made twice


def test_a_failed_leaf_stops_those_that_need_it(spark, small, tmp_path):
    b = builder(spark, small, good=slow(spark, 0.5), bad=slow(spark, 0.2, True))
    data = {"op": "$or", "rules": [{"op": "$and", "rules": [leaf("good"), leaf("good", 2)]}, {"op": "$and", "rules": [leaf("good", 3), leaf("bad")]}]}
    run = stages.Run(b, data, stages.save_in(f"file://{tmp_path}/s"))
    with pytest.raises(Exception, match="this leaf fails"):
        run.wait()
    by = {str(audience._plain(b.stages[n].rule)): s for n, s in run.states.items()}
    assert sorted(by.values()) == sorted([stages.DONE] * 4 + [stages.FAILED] + [stages.SKIPPED] * 2)
    assert by[str(audience._plain(audience.tree(data["rules"][0])))] == stages.DONE


def test_cancel(spark, small, tmp_path):
    b = builder(spark, small, long=slow(spark, 60))
    run = stages.Run(b, {"op": "$or", "rules": [leaf("long"), leaf("long", 2)]}, stages.save_in(f"file://{tmp_path}/s"))
    while stages.RUNNING not in run.states.values() or not any(t for _, _, t in run.progress().values()):
        time.sleep(0.1)
    began = time.time()
    run.cancel()
    with pytest.raises(RuntimeError, match="cancelled"):
        run.wait()
    assert time.time() - began < 30 and set(run.states.values()) == {stages.CANCELLED}
