"""Running usage of the last days per key, kept as stream state whose timers let events age out."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tabwright.functions.scalar import as_instant

DAY_MS = 86_400_000


def changes(days: dict[int, list[int]], windows: list[int], after: int, until: int) -> list[tuple[int, list[int]]]:
    """What the windows hold at the end of each day in (after, until] on which an event day enters or leaves one."""
    points = sorted({t for d in days for t in (d, *(d + n for n in windows)) if after < t <= until})
    return [(t, [sum(c[i] for d, c in days.items() if t - n < d <= t) for i, n in enumerate(windows)]) for t in points]


#: Groups of keys that share a state: a call costs milliseconds, whatever it holds.
BUCKETS = 8192


def add_counts(keys: dict[str | None, dict[int, list[int]]], pdf: pd.DataFrame, names: list[str]) -> None:
    """Add the rows ``(_key, _day, names...)`` to the counts per key and day."""
    code, found = pd.factorize(pdf["_key"], use_na_sentinel=False)
    day = pdf["_day"].to_numpy()
    first = day.min()
    place, at = np.unique(code * (day.max() - first + 1) + (day - first), return_inverse=True)
    sums = [np.bincount(at, weights=pdf[n].to_numpy()).astype("int64").tolist() for n in names]
    owner, days = np.divmod(place, day.max() - first + 1)
    found = [None if pd.isna(k) else k for k in found]
    for k, d, *c in zip(owner.tolist(), (days + first).tolist(), *sums, strict=True):
        mine = keys.setdefault(found[k], {})
        mine[d] = [a + b for a, b in zip(mine.get(d, [0] * len(names)), c, strict=True)]


def running_usage(
    stream: DataFrame, key: str, ts: str, counts: dict[str, tuple[int, Column]], late: str = "2 days", buckets: int = BUCKETS
) -> DataFrame:
    """``(key, day, counts...)``: events of the last n days, that day included, from ``day`` to the key's next row.

    ``counts`` maps output columns to ``(days, condition)``. A row is given out when its day is complete, that is when the
    watermark (the latest event less ``late``) has passed it: on every day on which a key has events, and on every day on which
    some leave a window. Per key the state holds one count per day and column of the longest window, however many events there
    are; keys are dealt to ``buckets`` by their hash, and those of a bucket share a state and a timer, which wakes them on the next such day of
    any; a key without events in any window is forgotten. More keys want more buckets, fixed for as long as the stream keeps its
    checkpoint. Rows later than the watermark are dropped. A null key is a key; rows without a time are ignored. The key is of a
    type that goes through text and back; binary ones go as base64.
    """
    names, windows = list(counts), [n for n, _ in counts.values()]
    plain = dict(stream.dtypes)[ts] == "timestamp_ntz"  # event time must be an instant
    timed = (stream.withColumn(ts, as_instant(ts)) if plain else stream).filter(F.col(ts).isNotNull()).withWatermark(ts, late)
    day = F.floor(F.unix_millis(ts) / DAY_MS)
    kind = stream.schema[key].dataType
    # 0.0 and -0.0 are one key
    value = F.col(key) + F.lit(0.0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(key)
    text = F.base64(value) if isinstance(kind, T.BinaryType) else value.cast("string")
    rows = timed.select(ts, text.alias("_key"), day.alias("_day"), *[F.coalesce(c, F.lit(False)).cast("bigint").alias(n) for n, (_, c) in counts.items()])
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int"))
    out = T.StructType([T.StructField("_key", T.StringType()), T.StructField("day", T.DateType()), *[T.StructField(n, T.LongType()) for n in names]])
    kept = T.StructType().add("until", T.LongType()).add("keys", T.StringType())

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        until, body = state.get if state.exists else (-(1 << 40), "[]")
        keys = {k: {int(d): c for d, c in days.items()} for k, days in json.loads(body)}
        if not state.hasTimedOut:
            for pdf in batches:
                if len(pdf):
                    add_counts(keys, pdf, names)
        mark = state.getCurrentWatermarkMs()
        complete = max(until, mark // DAY_MS - 1)
        found = [(k, t, c) for k, days in keys.items() for t, c in changes(days, windows, until, complete)]
        keys = {k: {d: c for d, c in days.items() if d + max(windows) > complete} for k, days in keys.items()}
        keys = {k: days for k, days in keys.items() if days}
        if keys:
            state.update((complete, json.dumps(list(keys.items()))))
            due = min(t for d in {d for days in keys.values() for d in days} for t in (d, *(d + n for n in windows)) if t > complete)
            state.setTimeoutTimestamp(max((due + 1) * DAY_MS, mark + 1))
        else:
            state.remove()
        if found:
            epoch = dt.date(1970, 1, 1)
            table = {"_key": [k for k, _, _ in found], "day": [epoch + dt.timedelta(days=t) for _, t, _ in found]}
            yield pd.DataFrame(table | {n: [c[i] for _, _, c in found] for i, n in enumerate(names)})

    usage = rows.groupBy("_bucket").applyInPandasWithState(step, out, kept, "append", GroupStateTimeout.EventTimeTimeout)
    back = F.unbase64("_key") if isinstance(kind, T.BinaryType) else F.col("_key").cast(kind)
    return usage.select(back.alias(key), "day", *names)
