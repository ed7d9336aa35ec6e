"""Matching new records against a fixed index as they arrive: a stream joined to a table, no state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowkin.operators.blocking import token_candidates


def match_arrivals(arrivals: DataFrame, index: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, k: int = 20) -> StreamingQuery:
    """Each batch of arrivals (s, tokens) gets its candidates from the index (token, q, idf) and goes to ``sink``."""

    def batch(rows: DataFrame, number: int) -> None:
        queries = rows.select("s", F.explode(F.array_distinct("tokens")).alias("token"))
        sink(token_candidates(queries, index, k), number)

    return arrivals.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
