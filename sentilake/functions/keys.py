"""Hour keys, ISO timestamps and names of shards, chunks and outputs."""

from datetime import date

from pyspark.sql import Column, functions as F


def utc_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.f]`` in UTC, whatever the session's zone.

    Counted from the epoch in a type without a zone: a shift of zoned times would go
    wrong in the hours that a zone skips or repeats.
    """
    seconds = (F.unix_micros(ts.cast("timestamp")).cast("decimal(20,0)") / 1000000).cast("decimal(18,6)")
    none = F.lit(0)
    return (F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(none, none, none, seconds)).cast("string")


def utc_midnight(day: date) -> Column:
    """The first moment of a day in UTC."""
    return F.timestamp_seconds(F.lit((day - date(1970, 1, 1)).days * 86400))


def day_key(ts: Column) -> Column:
    return F.substring(utc_text(ts), 1, 10)


def hour_key(ts: Column) -> Column:
    """Key of an hourly history row, in UTC."""
    text = utc_text(ts)
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 2))


def hour_id(ts: Column) -> Column:
    """Key of an hourly post archive, in UTC."""
    return F.translate(hour_key(ts), "-T", "")


def hour_start(key: Column) -> Column:
    """The first moment of an hour key."""
    return F.to_timestamp(F.concat(key, F.lit(":00:00+00:00")), "yyyy-MM-dd'T'HH:mm:ssXXX")


def iso_timestamp(ts: Column) -> Column:
    """ISO-8601 text with offset; the fraction, six digits, appears only when there is one."""
    text = utc_text(ts)
    fraction = F.when(F.length(text) > 19, F.rpad(F.substring(text, 20, 7), 7, "0")).otherwise("")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), fraction, F.lit("+00:00"))


def epoch_or_timestamp(c: Column) -> Column:
    """Timestamp from epoch seconds or ISO text; NULL when neither."""
    text = c.cast("string")
    epoch = text.try_cast("double")
    return F.when(epoch.isNotNull(), F.timestamp_micros((epoch * 1000000).cast("bigint"))) \
        .otherwise(F.try_to_timestamp(text))


def shard_name(index: Column) -> Column:
    """Name of a shard, counted from one."""
    return F.format_string("shard-%06d", index + 1)


def chunk_name(low: Column, high: Column) -> Column:
    return F.format_string("chunk-%07d-%07d", low, high)


def output_prefix(prefix: Column, run_id: Column, shard: Column, worker: Column) -> Column:
    return F.concat_ws("/", prefix, run_id, shard, worker)
