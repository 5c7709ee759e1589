"""Deriving events from a stream of observations: only the baseline is state, the rules are those of the batch.

The stateful step attaches to every observation the fields of its package's last readable
one, keeping no more than that per package; the rest is the batch projection. Observations
of a package arrive in run order, as the archive is written; one that is older than the
state is compared with the state but does not replace it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from registry_lens.operators.derive import diffable, events_of

BASELINE = ("times", "maintainerHashes", "maintainers", "revInt")
OUT = T.StructType([T.StructField("row", T.StringType()), T.StructField("prev", T.StringType())])
STATE = T.StructType([T.StructField("at", T.StringType()), T.StructField("baseline", T.StringType())])


def _attach(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    at, baseline = state.get if state.exists else (None, None)
    rows = pd.concat(list(frames)).sort_values("at", kind="stable")  # a package's rows of one micro-batch
    out = []
    for r in rows.itertuples(index=False):
        out.append((r.row, baseline))
        if r.baseline is not None and (at is None or r.at >= at):
            at, baseline = r.at, r.baseline
    if baseline is not None:
        state.update((at, baseline))
    yield pd.DataFrame(out, columns=["row", "prev"])


def with_baseline_stream(obs: DataFrame, fields: tuple[str, ...] = BASELINE) -> DataFrame:
    """Streaming form of ``with_baseline``: the same columns, ``prev`` from keyed state."""
    schema = obs.schema
    prev = T.StructType([schema[f] for f in fields])
    packed = obs.where("name is not null").select(
        "name",
        F.concat_ws("|", "fetchedAt", "run", F.lpad(F.coalesce(F.col("seq").cast("string"), F.lit("")), 20, "0")).alias("at"),
        F.to_json(F.struct(*obs.columns)).alias("row"),
        F.when(diffable(), F.to_json(F.struct(*fields))).alias("baseline"),
    )
    rows = packed.groupBy("name").applyInPandasWithState(_attach, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
    return rows.select(F.from_json("row", schema).alias("o"), F.from_json("prev", prev).alias("prev")).select("o.*", "prev")


def derive_stream(obs: DataFrame) -> DataFrame:
    """Events of a stream of observations, before equal ids are collapsed; the sink keeps the first of each id."""
    return events_of(with_baseline_stream(obs))


def run_to_table(obs: DataFrame, root: str) -> None:
    """Drain a stream of observations into ``root``/events, one overwritten folder per micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/events/batch={batch_id:010d}")

    query = derive_stream(obs).writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
