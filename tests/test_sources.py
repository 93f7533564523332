"""Ratings text and behaviour rows."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pairrank.sources import (distinct_behaviour, normalise_behaviour, read_ratings,
                              render_behaviour, write_ratings)
from pairrank.schema import RAW_BEHAVIOUR

GOOD = ["1::10::5::978300760", "1::11::3::978300761", "2::10::4::9", "3::12", "2::13::1::x::y"]


def _ratings_file(lines):
    d = tempfile.mkdtemp(prefix="ratings-")
    path = os.path.join(d, "tiny_ratings.dat")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_read_ratings_fields_0_and_1(spark):
    got = read_ratings(spark, _ratings_file(GOOD)).orderBy("user_id", "item_id").collect()
    assert [(r.user_id, r.item_id) for r in got] == [(1, 10), (1, 11), (2, 10), (2, 13), (3, 12)]


def test_strict_fails_on_bad_line(spark):
    path = _ratings_file(GOOD + ["7::abc::1"])
    with pytest.raises(Exception, match="malformed ratings line"):
        read_ratings(spark, path, strict=True).collect()


def test_strict_fails_whatever_is_read(spark):
    path = _ratings_file(GOOD + ["7::abc::1", "x::12"])
    for read in (lambda df: df.count(), lambda df: df.select("item_id").distinct().collect(),
                 lambda df: df.select("user_id").collect(), lambda df: df.agg(F.max("item_id")).collect()):
        with pytest.raises(Exception, match="malformed ratings line"):
            read(read_ratings(spark, path, strict=True))


def test_malformed_behaviour_is_null_counted_or_raises(spark):
    from pairrank.sources import malformed_behaviour
    rows = [("u", "i", "buy", "x", "3.0", "c", "soon"), ("u", "i", "buy", "1", "abc", "c", "null"),
            ("u", "j", "buy", "null", "", "c", "2024-01-01 13:05:00"), ("u", "k", None, None, None, None, None)]
    raw = spark.createDataFrame(rows, RAW_BEHAVIOUR)
    got = normalise_behaviour(raw).orderBy("item_id", "bhv_amt").collect()
    assert [(r.bhv_amt, r.bhv_cnt) for r in got] == [(None, None), (1.0, None), (None, 1), (None, 1)]
    assert tuple(malformed_behaviour(raw).first()) == (1, 2, 1)
    for bad in (raw.limit(1), raw.where("bhv_cnt = 'abc'")):
        with pytest.raises(Exception, match="malformed behaviour row"):
            normalise_behaviour(bad, strict=True).count()
    assert normalise_behaviour(raw.where("item_id > 'i'"), strict=True).count() == 2


def test_text_factors_read_back(spark):
    from pairrank.sources import read_factors, write_factors
    df = spark.createDataFrame([(3, [0.5, -1e-300]), (-1, [2.0, 0.1]), (2, [])], "user_id bigint, factors array<double>")
    d = tempfile.mkdtemp(prefix="factors-back-")
    write_factors(df, d + "/f", key="user_id", fmt="text")
    got = {r.user_id: r.factors for r in read_factors(spark, d + "/f", fmt="text").collect()}
    assert got == {3: [0.5, -1e-300], -1: [2.0, 0.1], 2: []}
    spark.createDataFrame([("(1,oops",)], "value string").write.text(d + "/bad")
    with pytest.raises(Exception, match="malformed factor line"):
        read_factors(spark, d + "/bad", fmt="text").count()


def test_lenient_drops_bad_lines(spark):
    path = _ratings_file(GOOD + ["7::abc::1", "justone", ""])
    assert read_ratings(spark, path, strict=False).count() == len(GOOD)


def test_write_read_roundtrip(spark):
    df = spark.createDataFrame([(0, 5), (0, 5), (-3, 7)], "user_id bigint, item_id bigint")
    d = tempfile.mkdtemp(prefix="ratings-out-")
    write_ratings(df, d + "/r")
    back = read_ratings(spark, d + "/r").orderBy("user_id", "item_id").collect()
    assert [(r.user_id, r.item_id) for r in back] == [(-3, 7), (0, 5), (0, 5)]


def test_mixed_behaviour_normalisation(spark):
    rows = [
        ("u1", "i1", "buy", "4.5", "2", "great", "2024-01-01 01:05:00 PM"),
        ("u1", "i2", "view", "null", "null", "null", "2024-01-01 13:05:00"),
        ("u2", "i1", "null", "3", "", "ok", "2024-01-01 12:00:00 AM"),
        ("u2", "i1", "null", "3", "", "ok", "null"),
    ]
    raw = spark.createDataFrame(rows, RAW_BEHAVIOUR)
    got = normalise_behaviour(raw).withColumn("t", F.date_format("bhv_datetime", "yyyy-MM-dd HH:mm:ss")) \
        .orderBy("user_id", "item_id", "t").collect()
    a, b, c, d = got[0], got[1], got[3], got[2]
    assert (a.bhv_amt, a.bhv_cnt, a.t) == (4.5, 2, "2024-01-01 13:05:00")
    assert (b.bhv_amt, b.bhv_cnt, b.content, b.t) == (None, 1, None, "2024-01-01 13:05:00")
    assert (c.bhv_type, c.bhv_cnt, c.t) == (None, 1, "2024-01-01 00:00:00")
    assert d.t is None


def test_distinct_and_render(spark):
    rows = [("u1", "i1", None, "1", None, None, None)] * 3 + [("u1", "i2", None, "1", None, None, None)]
    typed = normalise_behaviour(spark.createDataFrame(rows, RAW_BEHAVIOUR))
    out = render_behaviour(distinct_behaviour(typed)).orderBy("item_id").collect()
    assert len(out) == 2
    assert out[0].line == ("User_Behavior{userId='u1', itemId='i1', bhvType='null', bhvAmt='1.0', "
                           "bhvCnt='1', content='null', bhvDatetime='null'}")


def test_write_factors_text_is_ordered(spark):
    from pairrank.sources import write_factors
    df = spark.createDataFrame([(3, [0.5, -1.0]), (1, [2.0, 0.25]), (2, [0.0, 1.5])],
                               "user_id bigint, factors array<double>")
    d = tempfile.mkdtemp(prefix="factors-text-")
    write_factors(df, d + "/f", key="user_id", fmt="text")
    lines = [r.value for r in spark.read.text(d + "/f").collect()]
    assert sorted(lines) == ["(1,[2.0,0.25])", "(2,[0.0,1.5])", "(3,[0.5,-1.0])"]
    files = sorted(f for f in os.listdir(d + "/f") if f.startswith("part-"))
    ordered = [line for f in files for line in open(os.path.join(d + "/f", f)).read().split()]
    assert ordered == sorted(ordered, key=lambda s: int(s[1:s.index(",")]))


def test_to_behaviour_three_fields_and_json(spark):
    import json

    from pairrank.sources import to_behaviour, write_behaviour
    src = spark.createDataFrame([(5, 9, 1.5)], "u bigint, i bigint, score double")
    typed = to_behaviour(src, {"user_id": "u", "item_id": "i", "bhv_amt": "score"})
    row = typed.first()
    assert (row.user_id, row.item_id, row.bhv_amt, row.bhv_cnt) == ("5", "9", 1.5, 1)
    assert row.bhv_type is None and row.content is None and row.bhv_datetime is None
    d = tempfile.mkdtemp(prefix="behaviour-json-")
    write_behaviour(typed, d + "/j")
    lines = [json.loads(r.value) for r in spark.read.text(d + "/j").collect()]
    assert lines == [{"user_id": "5", "item_id": "9", "bhv_amt": 1.5, "bhv_cnt": 1}]
