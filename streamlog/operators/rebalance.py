"""Assignment tables over time: which member reads which topic-partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlog import model
from streamlog.workspace import measured

_OWNED = ["epoch", "member", *model.TP]


def events(assignments: DataFrame) -> DataFrame:
    """Assigned and revoked topic-partitions from each epoch to the next.

    ``assignments``: epoch, member, topic, partition; epochs are consecutive
    integers. In the first epoch everything is assigned. A lost topic-partition
    shows as revoked.
    """
    now = assignments.select(*_OWNED, F.lit(True).alias("_now"))
    before = assignments.select(
        (F.col("epoch") + 1).alias("epoch"), "member", *model.TP, F.lit(True).alias("_before")
    )
    epochs = assignments.select("epoch").distinct()
    changed = F.col("_now").isNull() | F.col("_before").isNull()
    event = F.when(F.col("_now").isNull(), "revoked").otherwise("assigned")
    return (
        now.join(before, _OWNED, "full_outer")
        .filter(changed)
        .join(epochs, "epoch", "left_semi")
        .select(*_OWNED, event.alias("event"))
    )


def drop_revoked(buffered: DataFrame, revoked: DataFrame, assigned: DataFrame) -> DataFrame:
    """Buffered records without those of topic-partitions revoked and not assigned again."""
    gone = revoked.select(*model.TP).join(assigned.select(*model.TP), model.TP, "left_anti")
    return buffered.join(measured(gone), model.TP, "left_anti")
