"""The stream's final buffer equals the batch rule over all rows, also across several
micro-batches, with late rows, after a restart and when a batch is replayed."""

from __future__ import annotations

import pyarrow.parquet as pq

from staffmart.plans.charts import rolling_buffer
from staffmart.streaming.rolling import current_buffers, fold_batch, rolling_stream_result, run_rolling_stream

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.select("user_id", "x", "y", "event_id").collect())


def test_stream_equals_batch_single_file(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    conf = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    got = rolling_stream_result(spark, SF, 5, file_glob="events.parquet", run_dir=str(tmp_path / "run"))
    assert _rows(got) == _rows(rolling_buffer(events, 5))
    assert conf == {k: spark.conf.get(k) for k in conf}


def _split(tmp_path, order):
    src = tmp_path / "src"
    src.mkdir()
    table = pq.read_table(f"{SF}/events.parquet").sort_by([("ts", "ascending"), ("event_id", "ascending")])
    step = -(-table.num_rows // 4)
    for i, q in enumerate(order):
        pq.write_table(table.slice(q * step, step), str(src / f"events-{i + 1}.parquet"))
    return str(src)


def test_late_rows_restart_and_replayed_batch(spark, tmp_path):
    """Files arrive newest first, so every later batch holds late rows only."""
    src, run = _split(tmp_path, [3, 1, 2, 0]), str(tmp_path / "run")
    run_rolling_stream(spark, src, 3, run_dir=run, max_files_per_trigger=1)
    want = _rows(rolling_buffer(spark.read.parquet(src), 3))
    assert _rows(current_buffers(spark, run)) == want
    # a restart finds nothing new
    run_rolling_stream(spark, src, 3, run_dir=run, max_files_per_trigger=1)
    assert _rows(current_buffers(spark, run)) == want
    # the last batch once more, as after a crash before its commit: the same version again
    last = spark.read.parquet(f"{src}/events-4.parquet").selectExpr("user_id", "cast(ts as timestamp_ntz) as ts", "event_id", "value")
    fold_batch(last, 3, run, 3)
    assert _rows(current_buffers(spark, run)) == want


def test_hot_key_is_cut_before_the_shuffle(spark):
    import contextlib
    import io

    from staffmart.streaming.rolling import newest

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        newest(spark.read.parquet(f"{SF}/events.parquet").select("user_id", "ts", "event_id", "value"), 3).explain()
    plan = buf.getvalue()
    assert "WindowGroupLimit" in plan and "Python" not in plan


def _versions_of(run):
    from pathlib import Path

    return {b.name: sorted(v.name for v in b.iterdir() if v.name.startswith("batch=")) for b in Path(run, "buffers").iterdir() if b.name.startswith("bucket=")}


def test_stream_over_micro_batches(spark, tmp_path):
    src, run = _split(tmp_path, [0, 1, 2, 3]), str(tmp_path / "run")
    run_rolling_stream(spark, src, 3, run_dir=run, max_files_per_trigger=1, buckets=8)
    assert _rows(current_buffers(spark, run)) == _rows(rolling_buffer(spark.read.parquet(src), 3))
    # four micro-batches, two versions of each bucket at most
    assert {v for found in _versions_of(run).values() for v in found} <= {f"batch={i}" for i in range(4)}
    assert all(len(found) <= 2 for found in _versions_of(run).values())


def test_a_batch_rewrites_only_its_keys_buckets(spark, tmp_path):
    from pathlib import Path

    run = str(tmp_path / "run")
    events = spark.read.parquet(f"{SF}/events.parquet").selectExpr("user_id", "cast(ts as timestamp_ntz) as ts", "event_id", "value")
    every = fold_batch(events, 0, run, 3, buckets=16)
    assert len(every) > 5
    user = events.first()["user_id"]
    one = events.where(events.user_id == user)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in Path(run, "buffers").rglob("*.parquet")}
    before = files()
    for i in (1, 2, 3, 4):
        touched = fold_batch(one, i, run, 3, buckets=16)
        assert len(touched) == 1
    after = files()
    mine = f"bucket={touched[0]}/"
    assert {p: t for p, t in after.items() if mine not in p} == {p: t for p, t in before.items() if mine not in p}
    assert _versions_of(run)[f"bucket={touched[0]}"] == ["batch=3", "batch=4"]      # no version before the last two
    assert _rows(current_buffers(spark, run)) == _rows(rolling_buffer(events, 3))


def test_uncommitted_batch_is_not_seen(spark, tmp_path):
    """A batch that was written, but whose commit did not happen, changes nothing for readers; its
    replay counts."""
    src, run = _split(tmp_path, [0, 1, 2, 3]), str(tmp_path / "run")
    import shutil

    later = tmp_path / "later"
    later.mkdir()
    shutil.move(f"{src}/events-4.parquet", later / "events-4.parquet")
    run_rolling_stream(spark, src, 3, run_dir=run, max_files_per_trigger=1)
    want = _rows(rolling_buffer(spark.read.parquet(src), 3))
    rows = spark.read.parquet(str(later)).selectExpr("user_id", "cast(ts as timestamp_ntz) as ts", "event_id", "value")
    fold_batch(rows, 3, run, 3)
    assert _rows(current_buffers(spark, run)) == want
    shutil.copy(later / "events-4.parquet", f"{src}/events-4.parquet")
    run_rolling_stream(spark, src, 3, run_dir=run, max_files_per_trigger=1)
    assert _rows(current_buffers(spark, run)) == _rows(rolling_buffer(spark.read.parquet(src), 3))


def test_empty_folder_and_empty_batch(spark, tmp_path):
    run = str(tmp_path / "run")
    nothing = spark.createDataFrame([], "user_id long, ts timestamp_ntz, event_id long, value double")
    assert fold_batch(nothing, 0, run, 3) == []
    assert current_buffers(spark, run).collect() == []
