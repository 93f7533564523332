"""Fixed schemas of the engine's tables."""

from pyspark.sql import types as T

# Behaviour record as uploaded: every field is text, missing values are "null".
RAW_BEHAVIOUR = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("bhv_type", T.StringType()),
    T.StructField("bhv_amt", T.StringType()),
    T.StructField("bhv_cnt", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("bhv_datetime", T.StringType()),
])

# Behaviour record after normalisation.
BEHAVIOUR = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("bhv_type", T.StringType()),
    T.StructField("bhv_amt", T.DoubleType()),
    T.StructField("bhv_cnt", T.LongType()),
    T.StructField("content", T.StringType()),
    T.StructField("bhv_datetime", T.TimestampType()),
])

# Output of the per-shard training kernel: new user rows, item deltas.
SHARD_OUTPUT = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("idx", T.LongType()),
    T.StructField("values", T.ArrayType(T.DoubleType())),
])

# One row per training step, touched rows only.
TRACE = T.StructType([
    T.StructField("iteration", T.IntegerType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("draw_no", T.LongType()),
    T.StructField("step", T.LongType()),
    T.StructField("user_idx", T.LongType()),
    T.StructField("pos_idx", T.LongType()),
    T.StructField("neg_idx", T.LongType()),
    T.StructField("x_uij", T.DoubleType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("user_before", T.ArrayType(T.DoubleType())),
    T.StructField("user_after", T.ArrayType(T.DoubleType())),
    T.StructField("pos_before", T.ArrayType(T.DoubleType())),
    T.StructField("pos_after", T.ArrayType(T.DoubleType())),
    T.StructField("neg_before", T.ArrayType(T.DoubleType())),
    T.StructField("neg_after", T.ArrayType(T.DoubleType())),
])
