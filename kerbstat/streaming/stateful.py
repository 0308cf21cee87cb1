"""Event-time state of one's own: several window widths from one aggregate, and exact rolling windows per road segment."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kerbstat.functions import clock
from kerbstat.functions.flags import flag
from kerbstat.operators.grouping import severe_count
from kerbstat.plans.trends import SEGMENT
from kerbstat.streaming.windows import ALERT_FROM, WATERMARK, event_time

PANE_MINUTES = 5
WIDTH_MINUTES = (5, 15, 60)
SUMS = ("accidents", "rated", "total", "severe", "alerts")


class Widths(StatefulProcessor):
    """Closed panes of a key become windows of every width: at once if the watermark has passed their end, else when it does.

    State has a row per open window, so a key holds no more rows than there are widths and panes behind the watermark.
    """

    def __init__(self, widths: Sequence[int]):
        self.widths = [w * 60 for w in widths]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "width long, start long", ", ".join(f"{c} long" for c in SUMS))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        panes = pd.concat(list(rows), ignore_index=True)
        pane, closed = PANE_MINUTES * 60, timerValues.getCurrentWatermarkInMs() // 1000
        for width in self.widths:
            starts = panes["second"] // width * width
            sums = panes.groupby(starts)[list(SUMS)].sum()
            if width == pane:
                yield self.out(key, width, sums.index.to_numpy(), sums.to_numpy())
                continue
            whole = []
            for start, new in zip(sums.index.tolist(), sums.to_numpy().tolist()):
                at, begun = (width, start), self.open.containsKey((width, start))
                now = tuple(int(a + b) for a, b in zip(self.open.getValue(at) if begun else [0] * len(SUMS), new))
                if start + width > closed:
                    self.open.updateValue(at, now)
                    self.handle.registerTimer((start + width) * 1000)
                    continue
                whole.append((start, now))
                if begun:
                    self.open.removeKey(at)
            if whole:
                yield self.out(key, width, np.array([s for s, _ in whole]), np.array([x for _, x in whole]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() // 1000
        for width in self.widths:
            at = (width, end - width)
            if self.open.containsKey(at):
                yield self.out(key, width, np.array([end - width]), np.array([list(self.open.getValue(at))]))
                self.open.removeKey(at)

    @staticmethod
    def out(key, width: int, starts: np.ndarray, sums: np.ndarray) -> pd.DataFrame:
        found = pd.DataFrame(sums.astype(np.int64), columns=list(SUMS))
        found.insert(0, "state", pd.Series([key[0]] * len(found), dtype=object))
        found.insert(1, "second", starts.astype(np.int64))
        found.insert(2, "width", np.int64(width))
        return found

    def close(self) -> None:
        pass


def all_windows(accidents: DataFrame, *, widths: Sequence[int] = WIDTH_MINUTES, watermark: str = WATERMARK, alert_from: int = ALERT_FROM) -> DataFrame:
    """``width_minutes, window_start, window_end, state`` and the measures of ``windowed_severity`` for every width, from one pass.

    Events are counted once, in panes of five minutes, whose rows tasks combine before the shuffle; closed panes
    then make up the wider windows, so only they are shuffled again. Widths are multiples of a pane. A stream only.
    """
    level = F.col("predicted_severity") if "predicted_severity" in accidents.columns else F.lit(None)
    panes = (
        event_time(accidents)
        .withWatermark("start_time", watermark)
        .groupBy(F.window("start_time", f"{PANE_MINUTES} minutes").alias("pane"), "state")
        .agg(
            F.count("*").alias("accidents"),
            F.count("severity").alias("rated"),
            F.coalesce(F.sum("severity"), F.lit(0)).cast("long").alias("total"),
            severe_count().alias("severe"),
            F.sum(flag(level >= alert_from)).cast("long").alias("alerts"),
        )
    )
    rows = panes.select(F.window_time("pane").alias("closed"), F.unix_seconds("pane.start").alias("second"), "state", *SUMS)
    schema = "state string, second long, width long, " + ", ".join(f"{c} long" for c in SUMS)
    found = rows.groupBy("state").transformWithStateInPandas(Widths(widths), schema, "Append", "EventTime")
    bound = lambda second: clock.from_instant(F.timestamp_seconds(second))
    measures = {
        "accidents": F.col("accidents"),
        "avg_severity": F.round(F.try_divide(F.col("total").cast("double"), "rated"), 3),
        "severe_count": F.col("severe"),
    }
    if "predicted_severity" in accidents.columns:
        measures["alert_count"] = F.col("alerts")
    return found.select(
        (F.col("width") / 60).cast("int").alias("width_minutes"),
        bound(F.col("second")).alias("window_start"),
        bound(F.col("second") + F.col("width")).alias("window_end"),
        "state",
        *[c.alias(n) for n, c in measures.items()],
    )


class Rolling(StatefulProcessor):
    """Per segment, the counts of its active seconds within one window length before the last; an event-time timer forgets a quiet segment."""

    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getValueState("recent", "second array<long>, n array<long>, total array<long>, severe array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True).sort_values("second")
        columns = [new[c].to_numpy(np.int64) for c in ("second", "n", "total", "severe")]
        old = [np.array(x, np.int64) for x in self.recent.get()] if self.recent.exists() else [np.zeros(0, np.int64)] * 4
        second, n, total, severe = (np.r_[a, b] for a, b in zip(old, columns))
        if len(old[0]):
            self.handle.deleteTimer(int(old[0][-1] + self.seconds) * 1000)
        own = np.arange(len(old[0]), len(second))
        first = np.searchsorted(second, second[own] - (self.seconds - 1))
        within = lambda x: (sums := np.r_[0, np.cumsum(x)])[own + 1] - sums[first]
        accidents, severity = within(n), within(total)
        out = pd.DataFrame({c: pd.Series([k] * len(own), dtype=object) for c, k in zip(SEGMENT, key)})
        out["second"], out["accidents"], out["severe_accidents"] = second[own], accidents, within(severe)
        out["severity_total"] = severity
        yield out
        kept = second > second[-1] - self.seconds
        self.recent.update(tuple(x[kept].tolist() for x in (second, n, total, severe)))
        self.handle.registerTimer(int(second[-1] + self.seconds) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.recent.clear()
        return iter(())

    def close(self) -> None:
        pass


def rolling_severity_stream(accidents: DataFrame, *, seconds: int = 15 * 60, watermark: str = WATERMARK) -> DataFrame:
    """The rows of ``trends.rolling_severity`` from a stream: one per second in which a segment has accidents, once the second is closed.

    Tasks combine a second's rows before the shuffle, so a busy segment's state and work are bounded by the seconds of a window.
    """
    per_second = (
        event_time(accidents)
        .filter(F.col("street").isNotNull())
        .withWatermark("start_time", watermark)
        .groupBy(F.window("start_time", "1 second").alias("pane"), *SEGMENT)
        .agg(F.count("severity").alias("n"), F.coalesce(F.sum("severity"), F.lit(0)).cast("long").alias("total"), severe_count().alias("severe"))
    )
    rows = per_second.select(F.window_time("pane").alias("closed"), F.unix_seconds("pane.start").alias("second"), *SEGMENT, "n", "total", "severe")
    names = ", ".join(f"{c} string" for c in SEGMENT)
    schema = f"{names}, second long, accidents long, severe_accidents long, severity_total long"
    found = rows.groupBy(*SEGMENT).transformWithStateInPandas(Rolling(seconds), schema, "Append", "EventTime")
    mean = F.try_divide(F.col("severity_total").cast("double"), "accidents").alias("avg_severity")
    return found.select(*SEGMENT, "second", "accidents", "severe_accidents", mean)
