"""Archives made by many tasks, read by the standard library."""

import random
import tarfile

import pytest

from veritrail.sources import archive


@pytest.mark.parametrize("size", [archive.MEMBER_BYTES, 2000])
def test_archive(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(archive, "MEMBER_BYTES", size)
    r = random.Random(1)
    files = [(f"task{x}", f"{'é' * 60}/{'d' * k}/f{k}.txt", "".join(r.choice("ab\n") for _ in range(k * 37))) for x in ("", "-1", "-10", " 2") for k in range(1, 12)] + [("z", "empty", ""), ("z", "null", None), ("z", "long/" * 40 + "x", "y")]
    index = archive.write(spark.createDataFrame(files, "task_id string, path string, content string").repartition(5), f"{tmp_path}/a.tar.gz")
    with tarfile.open(tmp_path / "a.tar.gz") as tar:
        found = tar.getmembers()
        got = {m.name: tar.extractfile(m).read().decode() for m in found if m.isfile()}
        names = [m.name for m in found]
    assert got == {f"{t}/{p}": c or "" for t, p, c in files}
    assert len(names) == len(set(names)) and {n for n in names if n not in got} == {f"{t}/{p}".rsplit("/", k)[0] for t, p, _ in files for k in range(1, p.count("/") + 2)}
    assert [n.split("/")[0] for n in names] == sorted(n.split("/")[0] for n in names)
    assert all(n.rsplit("/", 1)[0] in names[: k + 1] or "/" not in n for k, n in enumerate(names))
    read = archive.read(spark, index, f"{tmp_path}/a.tar.gz").collect()
    assert sorted((x.name, x.size, x.folder) for x in read) == sorted((m.name, m.size, m.isdir()) for m in found)
    assert index.count() > 20 if size == 2000 else index.count() < 20


def test_empty(spark, tmp_path):
    archive.write(spark.createDataFrame([], "task_id string, path string, content string"), f"{tmp_path}/a.tar.gz")
    with tarfile.open(tmp_path / "a.tar.gz") as tar:
        assert tar.getmembers() == []
