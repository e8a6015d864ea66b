"""Event-time window helpers with per-row window configuration.

Window sizes travel with each matched row (a rule's version fixes them), so
``F.window`` (constant sizes, slide <= size) does not fit.  These helpers
compute window starts arithmetically in epoch milliseconds; sizes are given
in seconds, as in the rule JSON.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sec_to_ms(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint") * F.lit(1000)


def sliding_starts(ms: Column, size_ms: Column, slide_ms: Column) -> Column:
    """All starts s = floor(ms/slide)*slide - i*slide with s > ms - size.

    slide > size is legal (gaps: an event can fall in no window); a slide
    that does not divide the size is legal too.  The starts form one
    arithmetic run, so they are a plain ``sequence`` (no lambda: the
    expression stays inside whole-stage codegen).  With r = ms mod slide,
    start i is valid while i * slide < size - r: ceil((size - r) / slide)
    starts, none when the event falls in a gap.
    """
    last = ms - F.pmod(ms, slide_ms)
    room = size_ms - (ms - last)
    count = F.floor((room + slide_ms - 1) / slide_ms).cast("bigint")
    run = F.sequence(last, last - (count - 1) * slide_ms, -slide_ms)
    return F.when((slide_ms > 0) & (room > 0), run).otherwise(F.array().cast("array<bigint>"))


def start_bounds(ms: Column, size_ms: Column, slide_ms: Column) -> tuple[Column, Column]:
    """The smallest and the largest of ``sliding_starts`` (NULL where there are none)."""
    last = ms - F.pmod(ms, slide_ms)
    room = size_ms - (ms - last)
    some = (slide_ms > 0) & (room > 0)
    return F.when(some, last - (F.ceil(room / slide_ms).cast("bigint") - 1) * slide_ms), F.when(some, last)


def next_start(ms: Column, slide_ms: Column) -> Column:
    """The first window start at or after ``ms``."""
    return ms + F.pmod(-ms, slide_ms)


def tumbling_start(ms: Column, size_ms: Column) -> Column:
    """Start of the tumbling window of ``size_ms`` holding ``ms``."""
    return ms - F.pmod(ms, size_ms)


_STEPS = 92


def pane_ms(size_ms: Column, slide_ms: Column) -> Column:
    """Width of panes that tile every sliding window exactly.

    Windows start at multiples of ``slide`` and end at start + ``size``, so a
    pane of width gcd(size, slide) never straddles a window edge;
    the common cases (slide divides size, or size divides slide) need no
    division; else Euclid's steps run, at most ``_STEPS`` of them for longs.
    """
    pair = F.struct(size_ms.cast("bigint").alias("a"), slide_ms.cast("bigint").alias("b"))
    steps = F.sequence(F.lit(1), F.lit(_STEPS))
    gcd = F.aggregate(steps, pair, lambda p, _: F.when(p["b"] == 0, p).otherwise(
        F.struct(p["b"].alias("a"), F.pmod(p["a"], F.greatest(p["b"], F.lit(1))).alias("b"))), lambda p: p["a"])
    return (F.when(F.pmod(size_ms, slide_ms) == 0, slide_ms)
            .when(F.pmod(slide_ms, size_ms) == 0, size_ms)
            .otherwise(gcd))


def ms_to_text(ms: Column) -> Column:
    """Epoch ms -> 'yyyy-MM-ddTHH:mm:ss.SSSZ' (session time zone must be UTC)."""
    from rulestream.schemas import OUTPUT_TIME_FORMAT
    return F.date_format(F.timestamp_millis(ms), OUTPUT_TIME_FORMAT)
