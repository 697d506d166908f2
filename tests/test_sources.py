"""Archives, copies, the result store, progress and the detectors' error arm."""

import os
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_engine import rows
from veriframe.operators import modalities as X
from veriframe.sources import archives, copies, media
from veriframe.sources.store import LostVersion, ResultStore
from veriframe.streaming import incremental


def zipped(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(name, content)
    return str(path)


def test_archives(spark, tmp_path):
    spark.dataSource.register(archives.ArchiveSource)
    one = zipped(tmp_path / "one.zip", {"a/": "", "a/x.txt": "xx", "a/y.bin": b"\0" * 3000, "z.txt": ""})
    two = zipped(tmp_path / "two.zip", {"../up.txt": "no", "/abs.txt": "ok", "C:/d.txt": "no", "a/../b.txt": "ok", "a\\..\\..\\c": "no"})
    none = zipped(tmp_path / "none.zip", {})
    bad = tmp_path / "bad.zip"
    bad.write_bytes(b"PK\x03\x04 not an archive")
    torn = tmp_path / "torn.zip"
    data = bytearray(open(zipped(tmp_path / "t.zip", {"p.txt": "p" * 500, "q.txt": "fine"}), "rb").read())
    data[40] ^= 255  # in the first member's content
    torn.write_bytes(data)
    paths = "\n".join([one, f"file://{two}", none, str(bad), str(torn), str(tmp_path / "missing.zip")])
    df = spark.read.format("archive").option("paths", paths).option("partitionbytes", "2").load()
    assert df.rdd.getNumPartitions() > 8
    got = {(os.path.basename(r.archive), r.member): (None if r.content is None else bytes(r.content), r.reason) for r in df.collect()}
    assert got["one.zip", "a/x.txt"] == (b"xx", None) and got["one.zip", "a/y.bin"][0] == b"\0" * 3000 and got["one.zip", "z.txt"] == (b"", None) and ("one.zip", "a/") not in got
    assert got["two.zip", "/abs.txt"] == got["two.zip", "a/../b.txt"] == (b"ok", None)
    assert got["two.zip", "../up.txt"] == (None, "path escapes upload dir: '../up.txt'") and got["two.zip", "C:/d.txt"] == (None, "unsafe path in upload: 'C:/d.txt'")
    assert got["two.zip", "a\\..\\..\\c"][0] is None and got["none.zip", None] == (None, "zip contained no files")
    assert got["bad.zip", None][1].startswith("corrupt zip: ") and got["missing.zip", None][1].startswith("FileNotFoundError")
    assert got["torn.zip", "p.txt"][0] is None and got["torn.zip", "p.txt"][1] and got["torn.zip", "q.txt"] == (b"fine", None)


def test_copies_are_all_or_nothing(spark, tmp_path):
    spark.dataSource.register(copies.CopySink)
    for k in range(6):
        (tmp_path / f"s{k}").write_text(f"content {k}")
    root = tmp_path / "out"
    root.mkdir()
    plan = [(str(tmp_path / f"s{k}"), f"v{k % 2}/f{k}.txt") for k in range(6)]
    copy = lambda items: spark.createDataFrame(items, "path string, target string").repartition(3).write.format("copies").option("root", str(root)).mode("append").save()
    with pytest.raises(Exception, match="gone|FileNotFound"):
        copy([*plan, (str(tmp_path / "gone"), "x.txt")])
    assert list(root.rglob("*")) == []  # a failed task leaves nothing
    copy(plan)
    files = {p.relative_to(root).as_posix(): p.read_text() for p in root.rglob("*") if p.is_file()}
    assert files == {t: f"content {k}" for k, (_, t) in enumerate(plan)} and not list(root.glob(".copies*"))
    times = {p: p.stat().st_mtime_ns for p in root.rglob("*.txt")}
    copy(plan)
    assert {p: p.stat().st_mtime_ns for p in root.rglob("*.txt")} == times  # a rerun copies nothing
    with pytest.raises(Exception, match="escapes"):
        copy([(plan[0][0], "../out.txt")])


def test_store_rewrites_only_touched_buckets(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path), "volunteer_id string, filename string, n int", buckets=8)
    frame = lambda *items: spark.createDataFrame(items, "volunteer_id string, filename string, n int")
    assert store.latest() is None and store.read().count() == 0 and store.lookup("1").count() == 0
    store.merge(frame(*((str(v), f"f{v}", 0) for v in range(40)), (None, "none", 0)), 0, ["volunteer_id", "filename"])
    store.merge(frame(("7", "f7", 1), ("7", "g7", 1), (None, "none", 1)), 1, ["volunteer_id", "filename"])
    first, second = store.folders(0), store.folders(1)
    assert set(first) == set(second) and 1 <= sum(first[b] != second[b] for b in first) <= 2
    got = {(r.volunteer_id, r.filename): r.n for r in store.read().collect()}
    assert len(got) == 42 and got["7", "f7"] == got["7", "g7"] == got[None, "none"] == 1 and got["8", "f8"] == 0 and store.read(0).count() == 41
    assert {r.filename for r in store.lookup("7").collect()} == {"f7", "g7"} and len(store.lookup("7").inputFiles()) < len(store.read().inputFiles())
    store.merge(frame(("9", "again", 5)), 1, ["volunteer_id", "filename"])  # the same version once more changes nothing
    assert store.read(1).count() == 42
    store.merge(frame().where("false") if False else spark.createDataFrame([], "volunteer_id string, filename string, n int"), 2, ["volunteer_id", "filename"])
    assert store.folders(2) == second and store.latest() == 2


def test_lost_version_is_an_error(spark, tmp_path):
    batch = rows(spark, ("a", "video", "check_container", "PASS", ""))
    incremental.merge_batch(batch, 0, str(tmp_path), incremental.R.Aggregation())
    with pytest.raises(LostVersion):
        incremental.merge_batch(rows(spark, ("b", "video", "check_container", "PASS", "")), 5, str(tmp_path), incremental.R.Aggregation())
    assert [r.filename for r in incremental.version(spark, str(tmp_path), 0).collect()] == ["a"]
    with pytest.raises(LostVersion):
        incremental.version(spark, str(tmp_path), 3)


def test_progress_while_it_runs(spark, tmp_path):
    told = []
    progress = incremental.Progress("check_rows", total=3, tell=lambda p: told.append(p.text))
    spark.streams.addListener(progress)
    try:
        for k in range(3):
            rows(spark, (f"f{k}", "video", "check_container", "FAIL" if k == 1 else "PASS", ""), (f"f{k}", "frame", "c", "PASS", "")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        incremental.follow(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), files_per_batch=1).awaitTermination()
        for _ in range(100):
            if progress.done >= 3:
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(progress)
    assert [t.split(" (")[0] for t in told] == ["1/3 files", "2/3 files", "3/3 files"] and told[-1] == "3/3 files (100%), 1 failed"


OBSERVED = "path string, frame_index int, ok boolean, message string"


def working():
    def detect(batch: pd.DataFrame) -> pd.DataFrame:
        if (batch["data"].map(bytes) == b"bad").any():
            raise ValueError("cannot  look")
        return pd.DataFrame({"path": batch["path"], "frame_index": batch["frame_index"], "ok": True, "message": "hand detected"})

    return detect


def unavailable():
    raise FileNotFoundError("models/hand.task")


def test_no_error_is_lost(spark):
    frames = spark.createDataFrame([("a", 0, b"x", None), ("a", 1, b"bad", None), ("a", 2, b"x", None), ("b", None, None, "OSError: broken"), ("c", 0, b"x", None)], "path string, frame_index int, data binary, reason string").coalesce(1)
    got = {(r.path, r.frame_index): (r.ok, r.error, r.lacks) for r in media.observe(frames, working, OBSERVED, "hand").collect()}
    assert got == {("a", 0): (True, None, None), ("a", 1): (None, None, {"hand": "hand detection error: ValueError: cannot look"}), ("a", 2): (True, None, None), ("b", None): (None, "OSError: broken", None), ("c", 0): (True, None, None)}
    got = {(r.path, r.frame_index): (r.error, r.lacks) for r in media.observe(frames, working, OBSERVED, "hand", skips=False).collect()}
    assert got["a", 1] == ("hand detection error: ValueError: cannot look", None)
    got = {r.path: r.lacks for r in media.observe(frames.where("data is not null"), unavailable, OBSERVED, "hand").collect()}
    assert set(map(str, got.values())) == {"{'hand': 'hand model bundle unavailable'}"}


def test_missing_hand_model_skips_its_checks(spark):
    stills = spark.createDataFrame([("/d/1_palm_L_N.jpg", 0, b"x", None)], "path string, frame_index int, data binary, reason string")
    seen = media.observe(stills, unavailable, OBSERVED, "hand")
    point = "struct<x:double,y:double,z:double>"
    images = seen.withColumns({
        "volunteer_id": F.lit("1"), "data_type": F.lit("palm"), "filename": F.lit("1_palm_L_N.jpg"), "extension": F.lit(".jpg"), "readable": F.lit(True), "meta_reason": F.lit("ok"), "channel_count": F.lit(3), "is_color": F.lit(True),
        "width": F.lit(640), "height": F.lit(480), "hand": F.lit("L"), "pose": F.lit("N"), "points": F.lit(None).cast(f"array<{point}>"), "px": F.lit(None).cast(f"array<{point}>"), "box_width": F.lit(None).cast("int"),
        "box_height": F.lit(None).cast("int"), "label": F.lit(None).cast("string"), "score": F.lit(None).cast("double"), "luma": F.lit(None).cast("double"),
    })
    got = {r.check_name: (r.status, r.reason) for r in X.palm_rows(images).collect()}
    hand = {c: v for c, v in got.items() if c.startswith("check_palm")}
    assert len(hand) == 7 and set(hand.values()) == {("SKIP", "hand model bundle unavailable")} and got["check_container"][0] == got["check_resolution"][0] == "PASS"
