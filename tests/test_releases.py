"""Releases: what readers see, what verification tells, files as they lie on disk."""

import hashlib
import pathlib

import pytest

from limes.sources import releases


@pytest.fixture()
def path(tmp_path):
    return f"file://{tmp_path}/store"


def local(path):
    return pathlib.Path(path.removeprefix("file://"))


def test_readers_see_complete_releases_only(spark, path):
    with pytest.raises(FileNotFoundError):
        releases.current_release(spark, path)
    first, second = spark.createDataFrame([(1, "a")], "id int, v string"), spark.createDataFrame([(2, "b"), (3, "c")], "id int, v string")
    releases.publish(spark, path, "2.0", {"t": first, "u": first})
    first.write.parquet(f"{path}/versions/1.9/t")  # cut off: no mark
    assert releases.current_release(spark, path) == "2.0" and releases.read_release(spark, path, "t").count() == 1
    releases.publish(spark, path, "1.9", {"t": second, "u": second})  # done again under the same name
    assert releases.current_release(spark, path) == "1.9" and releases.read_release(spark, path, "t").count() == 2
    assert releases.read_release(spark, path, "t", "2.0").count() == 1
    with pytest.raises(ValueError, match="already"):
        releases.publish(spark, path, "2.0", {"t": second})


def test_faults_of_a_release(spark, path):
    df = spark.range(100).repartition(4)
    releases.publish(spark, path, "1", {"t": df, "empty": df.filter("id < 0")}, {"dataset_id": "xx"})
    assert releases.release_faults(spark, path).count() == 0
    assert {r.dataset_id for r in spark.read.json(f"{path}/manifests/1").collect()} == {"xx"}
    parts = sorted(p for p in (local(path) / "versions/1/t").iterdir() if p.name.startswith("part-"))
    for p in parts[:3]:  # the local file system would tell of the change itself
        p.with_name(f".{p.name}.crc").unlink()
    parts[0].write_bytes(parts[0].read_bytes()[:-1] + b"?")
    parts[1].write_bytes(parts[1].read_bytes() + b"more")
    parts[2].rename(parts[2].with_name("part-other.parquet"))
    got = {r.path: r.reason for r in releases.release_faults(spark, path).collect()}
    assert got == {f"t/{parts[0].name}": "digest_mismatch", f"t/{parts[1].name}": "digest_mismatch", f"t/{parts[2].name}": "missing", "t/part-other.parquet": "not_listed"}


def test_digests_are_of_the_bytes_on_disk(spark, tmp_path):
    (tmp_path / "store" / "deep").mkdir(parents=True)
    files = {"a.bin": bytes(range(256)), "deep/b c.txt": "naïve\n".encode(), "deep/none": b"\n"}
    for name, data in files.items():
        (tmp_path / "store" / name).write_bytes(data)
    got = {r.path: (r.sha256, r.size) for r in releases.digested_files(spark, f"file://{tmp_path}/store/").collect()}
    assert {k.replace("%20", " "): v for k, v in got.items()} == {k: (hashlib.sha256(v).hexdigest(), len(v)) for k, v in files.items()}
    assert {r["size"] for r in releases.file_list(spark, str(tmp_path / "store")).collect()} == {256, 7, 1}
