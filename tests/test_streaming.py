from __future__ import annotations

import glob
import os

import pytest

from shelfscan.plans.build import run_models
from shelfscan.plans.ingest import ingest, load_name, merge_into_raw, read_raw
from shelfscan.sources import read_state
from shelfscan.streaming import stream_into_raw
from shelfscan.operators import latest_per_key
from shelfscan.streaming.incremental import checkpoint_folder, newest_per_key, stream_id


def test_arriving_files_are_merged_once(spark, source_rows, tmp_path):
    source, root = str(tmp_path / "exports"), str(tmp_path / "tables")
    name = load_name("brazil", backend="stream")

    def arrive(*rows):
        made = source_rows(*[{"code": c, "last_modified_t": t} for c, t in rows])
        made.coalesce(1).write.mode("append").parquet(source)
        query = stream_into_raw(spark, source, root, buckets=4)
        query.awaitTermination(120)
        assert not query.isActive
        return sorted((r.code, r.last_modified_t) for r in read_raw(spark, root, name).collect())

    assert arrive(("7891", 5), ("7891", 6), ("4001", 9)) == [("7891", 6)]
    assert arrive(("7891", 4), ("7892", 1)) == [("7891", 6), ("7892", 1)]
    assert arrive(("7892", 8)) == [("7891", 6), ("7892", 8)]
    stg, _ = run_models(spark, root, backend="stream")
    assert sorted(r.product_id for r in stg.collect()) == ["7891", "7892"]


def test_a_finished_batch_is_not_merged_again(spark, source_rows, tmp_path):
    root, name = str(tmp_path), load_name("replayed", backend="stream")
    delta = ingest(source_rows({"code": "7891", "last_modified_t": 5}))
    first = merge_into_raw(spark, delta, root, name, buckets=2, batch=("s1", 0))
    written = sorted(glob.glob(f"{root}/**/*.parquet", recursive=True))
    assert merge_into_raw(spark, delta, root, name, batch=("s1", 0)) == first
    assert sorted(glob.glob(f"{root}/**/*.parquet", recursive=True)) == written
    assert merge_into_raw(spark, delta, root, name, batch=("s1", 1)).version == 2
    # a new checkpoint folder is a new stream: its numbers begin anew
    again = merge_into_raw(spark, delta, root, name, batch=("s2", 0))
    assert (again.version, again.stream, again.batch) == (3, "s2", 0)
    assert merge_into_raw(spark, delta, root, name).batch == 0


def test_a_batch_replayed_by_the_stream_writes_nothing(spark, source_rows, tmp_path):
    source, root, checkpoint = (str(tmp_path / x) for x in ("exports", "tables", "checkpoint"))
    name = load_name("brazil", backend="stream")
    source_rows({"code": "7891", "last_modified_t": 5}).write.parquet(source)
    run = lambda: stream_into_raw(spark, source, root, buckets=2, checkpoint=checkpoint).awaitTermination(120)
    run()
    state = read_state(spark, f"{root}/state", name)
    assert (state.version, state.batch) == (1, 0) and state.stream == stream_id(spark, checkpoint)
    for commit in glob.glob(f"{checkpoint}/commits/*") + glob.glob(f"{checkpoint}/commits/.*.crc"):
        os.remove(commit)  # as if the driver was lost between the merge and the stream's note of it
    run()
    assert read_state(spark, f"{root}/state", name) == state


def test_checkpoint_folder_comes_from_the_session(spark):
    assert checkpoint_folder(spark, "x").endswith("/checkpoint/x")


def test_checkpoint_folder_must_be_known(spark):
    class Unset:
        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        checkpoint_folder(Unset, "x")


def test_newest_rows_of_a_stream(spark, tmp_path):
    """Batch by batch only touched keys come; all together are what the batch operator gives."""
    source, schema = str(tmp_path / "rows"), "code string, t bigint, v string, tags array<string>"
    parts = [
        [("a", 5, "x", ["p"]), ("a", 5, "y", None), ("b", None, "x", []), ("hot", 1, "x", None)],
        [("a", 4, "late", None), ("c", 1, None, ["q"]), *[("hot", i, f"v{i}", None) for i in range(500)]],
        [("b", 1, "z", ["r"])],
    ]
    known, touched = {}, []

    def keep(batch, _):
        rows = batch.collect()
        touched.append(sorted(r.code for r in rows))
        known.update({r.code: tuple(r) for r in rows})

    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = newest_per_key(spark.readStream.schema(schema).parquet(source), ["code"], "t")
        query = stream.writeStream.outputMode("update").foreachBatch(keep)
        query = query.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        everything = spark.createDataFrame(sum(parts[: i + 1], []), schema)
        expected = {r.code: tuple(r) for r in latest_per_key(everything, ["code"], "t").collect()}
        assert known == expected
    assert [x for x in touched if x] == [["a", "b", "hot"], ["a", "c", "hot"], ["b"]]
