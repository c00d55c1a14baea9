import pytest

from tidemark.operators import timelines
from tidemark.sources import captures


def capture(spark, *frames, source="pg"):
    """``frames``: (kind, lsn, timeline); data starts at its LSN, the others end there."""
    rows = [(source, i, kind, lsn if kind == "w" else None, lsn + 1 if kind == "w" else lsn, 0, None, tid, None) for i, (kind, lsn, tid) in enumerate(frames)]
    return spark.createDataFrame(rows, captures.WAL_CAPTURE)


def w(*positions):
    return [("w", p, None) for p in positions]


def test_later_forks_take_earlier_ones_along(spark):
    c = capture(spark, *w(10, 20, 30), ("t", 25, 2), *w(25, 40), ("t", 15, 3), *w(15, 50), ("t", 50, 3), *w(60))
    lines = timelines.timelines(c)
    assert [(r.tid, r.from_lsn, r.until_lsn, r.before, r.live) for r in lines.orderBy("seq").collect()] == [
        (1, None, 15, None, True), (2, 25, 15, 1, False), (3, 15, None, 2, True)
    ]
    lost = timelines.abandoned_frames(c, lines).orderBy("seq").collect()
    assert [(r.seq, r.tid) for r in lost] == [(1, 1), (2, 1), (4, 2), (5, 2)]
    kept = timelines.present_frames(c, lines)
    assert kept.columns == c.columns
    assert [r.seq for r in kept.orderBy("seq").collect()] == [0, 3, 6, 7, 8, 9, 10]


def test_cursors_go_back_to_their_fork(spark):
    c = capture(spark, *w(10, 20, 30), ("t", 25, 2), *w(25, 40), ("t", 45, 3), *w(45))
    lines = timelines.timelines(c)
    at = lambda tid, lsn: timelines.branch_points(lines, {"pg": (tid, lsn)})["pg"]
    assert (at(1, 20), at(1, 25), at(1, 30), at(2, 40), at(2, 99), at(3, 99)) == (20, 25, 25, 40, 45, 99)
    assert [r.seq for r in timelines.branch_resume(c, {"pg": (1, 30)}, lines).orderBy("seq").collect()] == [3, 4, 5, 6, 7]
    assert timelines.branch_points(lines, {}) == {}
    with pytest.raises(ValueError, match="timeline"):
        at(7, 1)


def test_sources_apart_and_no_switch(spark):
    both = capture(spark, *w(10, 30), ("t", 20, 2), *w(20)).unionByName(capture(spark, *w(10, 30), source="other"))
    assert [(r.source, r.seq) for r in timelines.abandoned_frames(both).collect()] == [("pg", 1)]
    assert timelines.timelines(both.limit(0)).count() == 0
    assert timelines.present_frames(both.filter("source = 'other'")).count() == 2


def test_first_frame_is_a_switch(spark):
    c = capture(spark, ("t", 20, 2), *w(20))
    assert [(r.tid, r.abandoned) for r in timelines.with_timeline(c, timelines.timelines(c)).orderBy("seq").collect()] == [(2, False)] * 2


def test_switch_without_a_position(spark):
    c = capture(spark, *w(10)).unionByName(spark.createDataFrame([("pg", 9, "t", None, None, 0, None, 2, None)], captures.WAL_CAPTURE))
    with pytest.raises(Exception, match="without an LSN"):
        timelines.timelines(c).collect()
