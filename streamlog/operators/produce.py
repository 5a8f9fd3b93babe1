"""Writing envelopes: expand to records, place them, report where they went."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import envelope, partitioner
from streamlog.sources import log
from streamlog.workspace import materialize


SEND_ORDER = {"seq": "envelope_id", "then": ("pos",)}


def expand(envelopes: DataFrame, partitions: partitioner.Partitions | None = None) -> DataFrame:
    """One row per output record with ``envelope_id`` (unique integers) and ``pos``.

    Records are sent in that order. With ``partitions`` explicit partitions and
    key hashes are filled in. Empty envelopes yield no row. The records are stored
    in the shared folder, because placing them reads them several times.
    """
    sends = envelope.explode_records(envelopes, "envelope_id")
    if partitions is not None:
        sends = sends.withColumn("partition", partitioner.known_partition(partitions))
    return materialize(sends, "sends")


@dataclass(frozen=True)
class Produced:
    records: DataFrame
    results: DataFrame


def flexi_flow(
    envelopes: DataFrame, partitions: partitioner.Partitions, *, ends: DataFrame | None = None
) -> Produced:
    """Records to append, and one result per envelope in ``envelope_id`` order.

    Partitions are chosen by record, key or turn, and offsets are given out in
    send order. ``envelopes``: envelope_id, records and columns that pass through. A result
    has ``parts``, the placed records of the envelope in order; it is empty for
    an envelope without records. ``ends`` gives the current end of the target log.

    Envelopes are evaluated and stored once. What passes through is stored with the
    first record, or in a row of its own without one. It is left out while records
    get their places and meets them again when they are grouped by envelope.
    """
    through = F.struct(*[c for c in envelopes.columns if c != "records"])
    exploded = envelopes.select(through.alias("_through"), F.posexplode_outer("records").alias("pos", "_r"))
    sent = F.col("pos").isNotNull()
    stored = exploded.select(
        "_through.envelope_id", "pos", F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("_through")).alias("_through"), "_r.*"
    )
    stored = materialize(
        stored.withColumn("partition", F.when(sent, partitioner.known_partition(partitions))), "sends"
    )
    chosen = partitioner.deal(stored.filter(sent).drop("_through"), partitions, **SEND_ORDER)
    placed = log.append_offsets(chosen, **SEND_ORDER, base=ends)
    part = F.struct("pos", *model.TP, "offset", "key", "value").alias("_part")
    first = stored.filter(F.coalesce("pos", F.lit(0)) == 0).select("envelope_id", "_through", F.lit(None).alias("_part"))
    rows = placed.select("envelope_id", F.lit(None).alias("_through"), part).unionByName(first)
    results = rows.groupBy("envelope_id").agg(
        F.first("_through", ignorenulls=True).alias("_through"),
        F.array_sort(F.collect_list("_part")).alias("parts"),
    )
    return Produced(placed, results.select("_through.*", "parts"))


def kind(parts: Column) -> Column:
    """Whether a result stands for one record, many, or none."""
    n = F.coalesce(F.size(parts), F.lit(0))
    return F.when(parts.isNull() | (n == 0), "pass_through").when(n == 1, "single").otherwise("multi")


def render_results(results: DataFrame, *, name: str = "text") -> DataFrame:
    """``topic/partition offset: value`` for each part, or ``passed through``."""
    line = F.transform(
        "parts",
        lambda p: F.concat(
            p["topic"], F.lit("/"), p["partition"], F.lit(" "), p["offset"], F.lit(": "), p["value"]
        ),
    )
    text = F.when(F.size("parts") > 0, F.concat_ws(", ", line)).otherwise(F.lit("passed through"))
    return results.withColumn(name, text)


def with_policy(df: DataFrame, valid: Column, *, on_error: str) -> tuple[DataFrame, DataFrame]:
    """Rows that can be sent, and those that cannot.

    "resume" drops a bad row from the stream of commits as well, so its offset is
    covered only by a later one; the second frame is for a dead-letter table.
    "stop" fails the query at the first bad row.
    """
    ok = F.coalesce(valid, F.lit(False))
    if on_error == "resume":
        return df.filter(ok), df.filter(~ok)
    if on_error == "stop":
        checked = F.when(ok, True).otherwise(F.raise_error(F.lit("record cannot be sent")).cast("boolean"))
        return df.filter(checked), df.filter(F.lit(False))
    raise ValueError(f"unknown failure policy: {on_error}")
