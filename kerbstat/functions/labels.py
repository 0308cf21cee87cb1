"""Display text for roads, places and severity levels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity level -> text.
SEVERITY_LABELS = {1: "Minor", 2: "Moderate", 3: "Serious", 4: "Critical"}
SEVERITY_DESCRIPTIONS = {
    1: "Short delay, no road closure",
    2: "Significant delay, possible lane closure",
    3: "Long delay, road partially/fully closed",
    4: "Major accident, full closure + EMS",
}
SEVERITY_DURATIONS = {1: "2–5 min", 2: "10–30 min", 3: "45min–2hr", 4: "3–6+ hrs"}
SEVERITY_RESPONSES = {
    1: "None needed",
    2: "Police + Tow Truck",
    3: "Police + Ambulance + Tow",
    4: "Full Emergency Response",
}


# Road types by junction and traffic signal.
JUNCTION, NO_JUNCTION = "Junction", "No Junction"
SIGNAL, NO_SIGNAL = "Signal", "No Signal"


def road_type(junction: Column, traffic_signal: Column) -> Column:
    """``Junction + No Signal`` and so on; a null flag reads as absent."""
    return F.concat(
        F.when(junction, F.lit(JUNCTION)).otherwise(F.lit(NO_JUNCTION)),
        F.lit(" + "),
        F.when(traffic_signal, F.lit(SIGNAL)).otherwise(F.lit(NO_SIGNAL)),
    )


def place_label(first: Column, second: Column) -> Column:
    """``first, second``; null when either part is null."""
    return F.concat(first, F.lit(", "), second)


def _lookup(level: Column, texts: dict[int, str]) -> Column:
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(texts.items())])
    return pairs[level.cast("int")]


def severity_label(level: Column) -> Column:
    return _lookup(level, SEVERITY_LABELS)


def severity_description(level: Column) -> Column:
    return _lookup(level, SEVERITY_DESCRIPTIONS)


def severity_duration(level: Column) -> Column:
    return _lookup(level, SEVERITY_DURATIONS)


def severity_response(level: Column) -> Column:
    return _lookup(level, SEVERITY_RESPONSES)
