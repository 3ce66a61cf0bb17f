"""Lines of growing files, once each, whatever way the files grow."""

from __future__ import annotations

import io
import random

import pytest

from millrace.sources import tail
from millrace.streaming import runs


@pytest.mark.parametrize("step", [1, 3, 1 << 16])
def test_ranges_share_out_all_lines(monkeypatch, step):
    monkeypatch.setattr(tail, "STEP", step)
    pick = random.Random(1)
    data = b"".join(pick.choice([b"", b"a", b"bc\r", b"d" * 40]) + b"\n" for _ in range(60))
    whole, at = [], 0
    for line in data.split(b"\n")[:-1]:
        whole.append((at, line))
        at += len(line) + 1
    for size in (1, 2, 7, 50, 10_000):
        found = [x for start in range(0, len(data), size) for x in tail.lines_from(io.BytesIO(data), start, min(start + size, len(data)), 0)]
        assert found == whole
    assert tail.last_line_end(io.BytesIO(data + b"open"), len(data) + 4, 0) == len(data)
    assert tail.last_line_end(io.BytesIO(b"open"), 4, 0) == 0 and tail.last_line_end(io.BytesIO(data), len(data), len(data)) == len(data)


def test_appended_lines_appear_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    (folder / "sub").mkdir(parents=True)
    step = lambda: sorted((r.path.rsplit("/", 1)[-1], r.position, r.value) for r in
                          runs.to_files(tail.follow(spark, str(folder), max_range_bytes=5), out).collect())
    a, b = folder / "a.log", folder / "sub" / "b.log"
    a.write_text("one\ntwo\nhal")
    (folder / "_hidden").write_text("no\n")
    seen = [("a.log", 0, "one"), ("a.log", 4, "two")]
    assert step() == seen
    with a.open("a") as file:
        file.write("f\n\nünd\r\n")
    b.write_text("long line number one\nlast\n")
    seen += [("a.log", 8, "half"), ("a.log", 13, ""), ("a.log", 14, "ünd"), ("b.log", 0, "long line number one"), ("b.log", 21, "last")]
    assert step() == sorted(seen)
    assert step() == sorted(seen)  # a restart without news
    a.write_text("new\n")  # replaced by a shorter file
    b.unlink()
    assert step() == sorted([*seen, ("a.log", 0, "new")])


def test_start_at_the_end(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a").write_text("old\n")
    read = lambda: runs.to_files(tail.follow(spark, str(folder), "latest"), out)
    assert read().count() == 0
    with (folder / "a").open("a") as file:
        file.write("fresh\n")
    assert [r.value for r in read().collect()] == ["fresh"]
    with pytest.raises(ValueError):
        tail.follow(spark, str(folder), "middle")
