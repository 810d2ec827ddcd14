"""Packing of a stream: each key's open pack is kept between batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def pack(df: DataFrame, length: str, key: str, capacity: int, lanes: int = 8, timeout_ms: int = 60_000) -> DataFrame:
    """``lane, pack, n, total`` of packs that are full, or whose lane has had no row for ``timeout_ms``.

    Rows are dealt to ``lanes`` by a hash of ``key`` and packed by next-fit as they come. A stream has no
    end, so an open pack is given out by the timeout. The state is the open pack's three numbers.
    """

    def run(lane: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pack, n, total = state.get if state.exists else (0, 0, 0)
        out = []

        def close() -> None:
            nonlocal pack, n, total
            out.append((lane[0], pack, n, total))
            pack, n, total = pack + 1, 0, 0

        if state.hasTimedOut:
            if n:
                close()
        else:
            for pdf in frames:
                for size in pdf.sort_values("__key")["__len"]:
                    if n and total + size > capacity:
                        close()
                    n, total = n + 1, total + int(size)
                    if total >= capacity:
                        close()
            state.setTimeoutDuration(timeout_ms)
        state.update((pack, n, total))
        yield pd.DataFrame(out, columns=["lane", "pack", "n", "total"])

    rows = df.select(F.pmod(F.xxhash64(key), F.lit(lanes)).alias("lane"), F.col(key).cast("string").alias("__key"), F.col(length).cast("long").alias("__len"))
    return rows.groupBy("lane").applyInPandasWithState(
        run, "lane long, pack long, n long, total long", "pack long, n long, total long", "append", GroupStateTimeout.ProcessingTimeTimeout
    )
