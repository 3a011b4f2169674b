import numpy as np
import pyarrow as pa

from rollcall.llm import _session
from rollcall.llm.components import components


def test_keep_and_clean(spark):
    kept = _session.keep(spark.range(5))
    assert kept.count() == 5 and "/rollcall-" in kept.inputFiles()[0]
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    _session.clean(spark)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs)


def test_scratch_is_set_once(spark):
    assert _session.scratch(spark) == _session.scratch(spark)


def test_components_in_rounds(spark, monkeypatch):
    monkeypatch.setattr("rollcall.llm.components.LAST_EDGES", 2)
    chain = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_workers_give_back_large_arrays(spark):
    """Also with small ones that stay between them, and after the first was freed; Arrow's buffers too."""
    _session.prepare(spark)

    def run(batches):
        resident = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20
        for _ in batches:
            del (first := [np.ones(640_000)])[:]
            held, pins, before = [], [], resident()
            for _ in range(40):
                held.append(np.ones(640_000))
                pins.append(np.ones(1000))
            most = resident()
            del first, held
            yield pa.RecordBatch.from_arrays([pa.array([most - before]), pa.array([resident() - before]), pa.array([pa.default_memory_pool().backend_name])], ["most", "after", "pool"])

    row = spark.range(1, numPartitions=1).mapInArrow(run, "most long, after long, pool string").first()
    assert row.most > 180 and row.after < 40 and row.pool == "system"
