"""The streaming ratings source appends parsed pairs to a table."""

import os
import tempfile

from pairrank.streaming import append_interactions, ratings_stream


def test_stream_appends_pairs(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    out = tempfile.mkdtemp(prefix="stream-out-")
    with open(os.path.join(src, "a.dat"), "w") as fh:
        fh.write("1::10::5::1\n2::11::3::2\n")
    q = append_interactions(ratings_stream(spark, src), out + "/t", out + "/ckpt")
    q.awaitTermination(120)
    with open(os.path.join(src, "b.dat"), "w") as fh:
        fh.write("3::12\n")
    q = append_interactions(ratings_stream(spark, src), out + "/t", out + "/ckpt")
    q.awaitTermination(120)
    got = sorted((r.user_id, r.item_id) for r in spark.read.parquet(out + "/t").collect())
    assert got == [(1, 10), (2, 11), (3, 12)]


def test_strict_stream_fails_on_a_bad_line(spark):
    import pytest
    src = tempfile.mkdtemp(prefix="stream-bad-")
    out = tempfile.mkdtemp(prefix="stream-bad-out-")
    with open(os.path.join(src, "a.dat"), "w") as fh:
        fh.write("1::10\n2::eleven\n")
    q = append_interactions(ratings_stream(spark, src).select("user_id"), out + "/t", out + "/ckpt")
    with pytest.raises(Exception, match="malformed ratings line"):
        q.awaitTermination(120)
