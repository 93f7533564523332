"""Behaviour records: the upload text form, normalisation, dedup, rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import BEHAVIOUR, RAW_BEHAVIOUR

# The text that stands for a missing field in uploads, the
# default count, and the two datetime forms that arrive mixed.
NULL_TEXT = "null"
DEFAULT_COUNT = 1
DATETIME_12H = "yyyy-MM-dd hh:mm:ss a"
DATETIME_24H = "yyyy-MM-dd HH:mm:ss"

FIELDS = [f.name for f in BEHAVIOUR.fields]


def _text(c: Column) -> Column:
    """NULL for the missing-value marker."""
    return F.when(c == F.lit(NULL_TEXT), F.lit(None).cast("string")).otherwise(c)


def parse_datetime(c: Column) -> Column:
    """One timestamp from either the 12-hour or the 24-hour form; NULL otherwise."""
    return F.coalesce(F.try_to_timestamp(c, F.lit(DATETIME_12H)),
                      F.try_to_timestamp(c, F.lit(DATETIME_24H)))


def _typed(raw: DataFrame) -> tuple[dict, dict]:
    """Typed field expressions, and for the parsed fields whether the text is malformed."""
    c = {name: _text(F.col(name).cast("string")) for name in RAW_BEHAVIOUR.fieldNames()}
    parsed = {"bhv_amt": c["bhv_amt"].try_cast("double"), "bhv_cnt": c["bhv_cnt"].try_cast("bigint"),
              "bhv_datetime": parse_datetime(c["bhv_datetime"])}
    given = {name: c[name].isNotNull() & (F.trim(c[name]) != "") for name in parsed}
    malformed = {name: F.coalesce(given[name] & value.isNull(), F.lit(False)) for name, value in parsed.items()}
    parsed["bhv_cnt"] = F.when(F.coalesce(given["bhv_cnt"], F.lit(False)), parsed["bhv_cnt"]).otherwise(
        F.lit(DEFAULT_COUNT).cast("bigint"))
    return c | parsed, malformed


def normalise_behaviour(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Text behaviour rows → typed rows.

    ``"null"`` and the empty text are missing: NULL in every field, 1 for the
    count.  Both datetime forms become one timestamp.  A malformed score, count
    or datetime becomes NULL (``malformed_behaviour`` counts them); ``strict``
    fails the job instead.
    """
    typed, malformed = _typed(raw)
    if strict:
        bad = malformed["bhv_amt"] | malformed["bhv_cnt"] | malformed["bhv_datetime"]
        row = F.to_json(F.struct(*RAW_BEHAVIOUR.fieldNames()))
        raw = raw.where(F.when(bad, F.raise_error(F.concat(F.lit("malformed behaviour row: "), row)).cast("boolean"))
                        .otherwise(F.lit(True)))
    return raw.select(*[typed[name].alias(name) for name in FIELDS])


def malformed_behaviour(raw: DataFrame) -> DataFrame:
    """One row: how many scores, counts and datetimes are given but malformed."""
    _, malformed = _typed(raw)
    return raw.agg(*[F.count_if(bad).alias(name) for name, bad in malformed.items()])


def raw_behaviour_from_events(events: DataFrame) -> DataFrame:
    """Events in the upload form, as a logging client would send them.

    Mapping: user_id → user, ``$.k`` of props → item, event_type → type,
    value → score (sent as "null" for signup and error events, which carry no
    score), count sent only for purchases, props sent as content only for
    clicks, the timestamp in 12-hour form for even event ids and 24-hour form
    for odd ones.
    """
    has_score = ~F.col("event_type").isin("signup", "error")
    twelve = F.pmod(F.col("event_id"), F.lit(2)) == 0
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("item_id"),
        F.col("event_type").alias("bhv_type"),
        F.when(has_score, F.col("value").cast("string")).otherwise(F.lit(NULL_TEXT)).alias("bhv_amt"),
        F.when(F.col("event_type") == "purchase", F.lit("1")).otherwise(F.lit(NULL_TEXT)).alias("bhv_cnt"),
        F.when(F.col("event_type") == "click", F.col("props")).otherwise(F.lit(NULL_TEXT)).alias("content"),
        F.when(twelve, F.date_format("ts", DATETIME_12H))
         .otherwise(F.date_format("ts", DATETIME_24H)).alias("bhv_datetime"),
    )


def to_behaviour(df: DataFrame, mapping: dict) -> DataFrame:
    """Typed behaviour rows from any table: ``mapping`` gives a SQL expression
    (or Column) per behaviour field; unmapped fields are NULL, except the
    count, which defaults to 1 (so a user/item/score mapping is the 3-field
    form)."""
    cols = []
    for field in BEHAVIOUR.fields:
        src = mapping.get(field.name)
        if src is None:
            c = F.lit(DEFAULT_COUNT) if field.name == "bhv_cnt" else F.lit(None)
        else:
            c = F.expr(src) if isinstance(src, str) else src
        cols.append(c.cast(field.dataType).alias(field.name))
    return df.select(*cols)


# Fixed mapping of the events table onto behaviour fields.
EVENTS_MAPPING = {
    "user_id": "user_id",
    "item_id": "get_json_object(props, '$.k')",
    "bhv_type": "event_type",
    "bhv_amt": "value",
    "bhv_datetime": "ts",
}


def behaviour_from_events(events: DataFrame) -> DataFrame:
    """Typed behaviour rows straight from events (no text round trip)."""
    return to_behaviour(events, EVENTS_MAPPING)


def distinct_behaviour(df: DataFrame) -> DataFrame:
    """Whole-row dedup over all seven fields, NULLs equal to NULLs."""
    return df.dropDuplicates(FIELDS)


def _quoted(name: str, c: Column) -> Column:
    return F.concat(F.lit(f"{name}='"), F.coalesce(c.cast("string"), F.lit("null")), F.lit("'"))


def render_behaviour(df: DataFrame, column: str = "line") -> DataFrame:
    """One text line per row.

    Fixed format: User_Behavior{userId='…', itemId='…', bhvType='…',
    bhvAmt='…', bhvCnt='…', content='…', bhvDatetime='…'}; a NULL prints as
    null.  Timestamps print as yyyy-MM-dd HH:mm:ss.
    """
    names = ["userId", "itemId", "bhvType", "bhvAmt", "bhvCnt", "content", "bhvDatetime"]
    cols = []
    for name, field in zip(names, FIELDS):
        c = F.col(field)
        if dict(df.dtypes).get(field) == "timestamp":
            c = F.date_format(c, DATETIME_24H)
        cols.append(_quoted(name, c))
    body = F.concat_ws(", ", *cols)
    return df.select(*df.columns, F.concat(F.lit("User_Behavior{"), body, F.lit("}")).alias(column))


def write_behaviour(df: DataFrame, path: str) -> None:
    """Rows as JSON lines."""
    df.select(F.to_json(F.struct(*FIELDS)).alias("value")).write.mode("overwrite").text(path)
