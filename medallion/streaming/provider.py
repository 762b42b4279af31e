"""Provider answers across micro-batches (D1): each address is asked once, while a stream runs and after it restarts.

The state per address, kept by Structured Streaming in the checkpoint, is its answer and, for an address the provider did not
know or failed on, until when that answer holds. A batch asks for the addresses without a valid answer only; rows of one
address share one call however many there are, since the state is keyed by it. Found answers never expire; a negative one is
looked at when its address comes again (a timer would keep an available-now run going for ever).

Answers, not transactions, travel through the state: join the answers' table to the rows (``geo.fill_coordinates``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from medallion.functions.columns import address_key
from medallion.operators.geo import FOUND, KEY, Provider, _ask
from medallion.session import ship_package

ANSWER = f"{KEY} string, latitude double, longitude double, outcome string, asked_at bigint"
_STATE = "outcome string, valid_until bigint"

FOREVER = (1 << 62)


def _answer(provider: Provider, negative_ms: int):
    def run(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        for _ in rows:  # the address itself is all that is needed
            pass
        if state.exists and state.get[1] > now:
            return
        lat, lon, outcome = _ask(provider, [key[0]])[0]
        until = FOREVER if outcome == FOUND else now + negative_ms
        state.update((outcome, until))
        yield pd.DataFrame({KEY: [key[0]], "latitude": pd.Series([lat], dtype="float64"), "longitude": pd.Series([lon], dtype="float64"),
                            "outcome": [outcome], "asked_at": [now]})
    return run


def answers(stream: DataFrame, provider: Provider, address: str | Column, negative_hours: float = 24.0,
            lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """A stream of new provider answers for the addresses of ``stream`` that need a coordinate: address_key, latitude,
    longitude, outcome (found, unknown, failed), asked_at (ms). An unknown or failed address is asked again when it comes
    after ``negative_hours``. Write it in append mode; the checkpoint of that query is the memory of what was asked."""
    ship_package(stream.sparkSession)
    addr = F.col(address) if isinstance(address, str) else address
    need = F.col(lat_col).isNull() | F.col(lon_col).isNull()
    keys = stream.filter(need).select(address_key(addr).alias(KEY)).filter(F.col(KEY).isNotNull())
    return keys.groupBy(KEY).applyInPandasWithState(_answer(provider, int(negative_hours * 3600_000)), ANSWER, _STATE, "append",
                                                    GroupStateTimeout.NoTimeout)


def latest(answered: DataFrame) -> DataFrame:
    """One row per address of the written answers: a found one if there is any, the newest otherwise."""
    order = F.struct((F.col("outcome") == FOUND).alias("found"), "asked_at", "latitude", "longitude", "outcome")
    return (answered.groupBy(KEY).agg(F.max(order).alias("m"))
            .select(KEY, "m.latitude", "m.longitude", "m.outcome", "m.asked_at"))
