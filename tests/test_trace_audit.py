"""The audit of a traced run moves no vectors."""

from pyspark.sql import functions as F


def test_trace_audit_moves_no_vectors_and_sees_a_broken_chain(spark, monkeypatch):
    from types import SimpleNamespace

    from pairrank.plans import queries as Q
    one = F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))
    trace = spark.range(6).select(
        F.lit(0).alias("shard"), F.col("id").alias("step"), F.lit(1).alias("user_idx"), F.lit(2).alias("pos_idx"), (F.col("id") + 10).alias("neg_idx"),
        F.lit(0.0).alias("x_uij"), F.lit(0.5).alias("weight"),
        *[(F.when(F.col("id") == 3, F.array(F.lit(1.0), F.lit(2.0), F.lit(3.5))).otherwise(one) if c == "user_after" else one).alias(c)
          for c in ("user_before", "user_after", "pos_before", "pos_after", "neg_before", "neg_after")])
    assert {kind for _, kind in Q._touched(trace).dtypes} == {"int", "bigint", "tinyint"}
    monkeypatch.setattr(Q, "_trace_model", lambda *_: SimpleNamespace(trace=trace))
    assert tuple(Q.trace_audit_orders(spark, "").first()) == (6, 0, 1)
