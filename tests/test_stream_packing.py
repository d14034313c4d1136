"""Packing across micro-batches: the blocks do not depend on how the input is cut."""

import pandas as pd
import pytest

from textloom.functions.hashing import HASH_BITS
from textloom.streaming import packing
from textloom.streaming.blocks import read_new_files
from textloom.streaming.packing import pack_stream, use_rocksdb

SCHEMA = "seq long, key string, ids array<int>, ts timestamp"
SHARDS, LENGTH = 2, 7


def rows(spark, numbers, end=False):
    data = [(i, f"k{i}", [i] * (i % 5), 1_700_000_000 + i) for i in numbers]
    data += [(10**6, None, None, 1_800_000_000)] if end else []
    return spark.createDataFrame(data, "seq long, key string, ids array<int>, t long").selectExpr(
        "seq", "key", "ids", "timestamp_seconds(t) as ts"
    )


def run(spark, folder, batches, stop_after=None):
    """Each batch is one file; the query ends after each run and goes on from its checkpoint."""
    inbox, out, state = (str(folder / n) for n in ("in", "out", "state"))
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(inbox)
        stream = read_new_files(spark, inbox, spark.createDataFrame([], SCHEMA).schema, max_files=1)
        q = pack_stream(stream, SHARDS, LENGTH).writeStream.format("parquet").option("path", out)
        q.option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return sorted((r.shard, r.block_no, tuple(r.input_ids)) for r in spark.read.parquet(out).collect())


def plain(spark, count):
    import hashlib

    width = (1 << HASH_BITS) // SHARDS + 1
    held = [[] for _ in range(SHARDS)]
    for i in range(count):
        shard = int(hashlib.md5(f"42:k{i}".encode()).hexdigest()[:15], 16) // width
        held[shard] += [i] * (i % 5)
    return [(s, n // LENGTH, tuple(ids[n : n + LENGTH])) for s, ids in enumerate(held) for n in range(0, len(ids), LENGTH)]


@pytest.fixture(scope="module")
def rocks(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(spark)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


@pytest.mark.parametrize("cuts", [[0, 40], [0, 3, 4, 31, 40]])
def test_any_cut_gives_the_same_blocks(rocks, tmp_path, cuts):
    parts = [rows(rocks, range(a, b)) for a, b in zip(cuts, cuts[1:])]
    assert run(rocks, tmp_path, [*parts, rows(rocks, [], end=True)]) == plain(rocks, 40)


def test_keys_that_come_again_are_dropped(rocks, tmp_path):
    parts = [rows(rocks, range(25)), rows(rocks, range(10, 40)), rows(rocks, range(40), end=True)]
    assert run(rocks, tmp_path, parts) == plain(rocks, 40)


def test_other_state_stores_are_refused(rocks):
    rocks.conf.set("spark.sql.streaming.stateStore.providerClass", "another")
    with pytest.raises(ValueError):
        pack_stream(rows(rocks, [1]), 1)
    use_rocksdb(rocks)


def test_blocks_are_given_as_they_fill(monkeypatch):
    """No more than a few ids wait in memory, whatever the order of the rows and their frames."""
    monkeypatch.setattr(packing, "GIVEN", 20)

    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

    class Keys(set):
        containsKey = set.__contains__

        def updateValue(self, key, value):
            self.add(key)

    class Timers(list):
        listTimers = list.__iter__
        deleteTimer = list.remove
        registerTimer = list.append

    packer = packing._Packer(LENGTH, 1000, None)
    packer.open, packer.taken, packer.handle = Value(), Keys(), Timers()
    seqs = [i * 37 % 100 for i in range(100)]
    data = [(s, f"k{s}", None if s == 50 else [s] * 3, pd.Timestamp(s, unit="s")) for s in seqs] + [(0, "k3", [9], pd.Timestamp(0)), (1, None, None, pd.Timestamp(9e9))]
    frames = [pd.DataFrame(data[i : i + 9], columns=["seq", "key", "ids", "ts"]) for i in range(0, len(data), 9)]
    found = list(packer.handleInputRows((4,), iter(frames), None))
    given = [i for f in found for b in f["input_ids"] for i in b.tolist()]
    wanted = [0] * 3 + [9] + [s for s in range(100) if s not in (0, 3, 50) for _ in range(3)]
    assert given + packer.open.held[0] == wanted and len(packer.open.held[0]) < LENGTH
    assert [n for f in found for n in f["block_no"]] == list(range(packer.open.held[1])) and len(found) > 10
    assert list(packer.handle) == [100_000] and ("k50",) not in packer.taken
