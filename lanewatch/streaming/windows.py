"""Event-time window settings."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class WindowSpec:
    """Window type, lengths and lateness, as Spark interval text.

    ``kind`` is ``tumbling`` or ``sliding`` in any case; ``slide`` is only read
    for the latter.
    """

    kind: str = "tumbling"
    length: str = "60 seconds"
    slide: str | None = "10 seconds"
    delay: str = "30 seconds"

    def column(self, event_time: str = "event_time") -> Column:
        kind = self.kind.lower()
        if kind == "tumbling":
            return F.window(event_time, self.length)
        if kind == "sliding":
            if not self.slide:
                raise ValueError("a sliding window needs a slide")
            return F.window(event_time, self.length, self.slide)
        raise ValueError(f"unsupported window type: {self.kind!r}")

    def pane(self) -> str | None:
        """The slide, if every sliding window is made of whole slides; else None."""
        if self.kind.lower() != "sliding" or not self.slide:
            return None
        try:
            length, slide = pd.Timedelta(self.length), pd.Timedelta(self.slide)
        except ValueError:  # a length such as months, which has no fixed size
            return None
        whole = slide > pd.Timedelta(0) and length % slide == pd.Timedelta(0)
        return self.slide if whole else None

    def panes(self) -> tuple[int, int] | None:
        """Microseconds of a pane and panes of a window, where sliding windows are made of panes."""
        pane = self.pane()
        if pane is None:
            return None
        length, slide = pd.Timedelta(self.length), pd.Timedelta(pane)
        micros = slide // pd.Timedelta(microseconds=1)
        return (micros, length // slide) if slide == pd.Timedelta(microseconds=micros) else None
