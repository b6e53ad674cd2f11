"""Orders, status history and daily facts kept up to date by a stream.

The state is a set of published tables, not state in the executors: every
micro-batch is a change set that is restated like a load, and its number goes into
the same manifest that switches the tables.  A batch that is replayed after a
failure finds its number there and does nothing; one that failed before the switch
has changed nothing.  State therefore grows and is read like any table, and any
split of the rows into batches gives the tables of a batch build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from harborline.plans import increments
from harborline.schemas import LINEAGE, RAW_COLUMNS, text_schema
from harborline.session import TIGHT, materialize
from harborline.sources.published import Published

BATCH = "stream_batch"   # manifest property: the last batch the tables contain


def apply_batch(tables: Published, batch: DataFrame, number: int, dimensions: increments.Dimensions,
                items: DataFrame | None = None) -> bool:
    """Restate the tables by the order versions of a batch; False if they contain it already.

    The first batch builds them, with the lines in ``items``.
    """
    target = tables.begin()
    if int(target.base.properties.get(BATCH, -1)) >= number:
        return False
    # a micro-batch may be read anew by every action; its rows must not differ between them
    rows = materialize(batch, "batch", TIGHT)
    orders = increments.Change(rows)
    no_lines = tables.spark.createDataFrame([], text_schema(RAW_COLUMNS["order_items"]))
    if "order_base" not in target:
        increments.build_orders(target, rows, items if items is not None else no_lines, dimensions)
        increments.build_history(target, rows)
    else:
        increments.restate_orders(target, orders, increments.Change(no_lines), dimensions)
        increments.restate_history(target, orders)
    target.publish(**{BATCH: str(number)})
    return True


def maintain_orders(stream: DataFrame, tables: Published, dimensions: increments.Dimensions, checkpoint: str,
                    items: DataFrame | None = None) -> StreamingQuery:
    """Keep the tables up to date with a stream of landed order rows until it is drained.

    ``stream`` has the landing columns of orders and their lineage.  ``items`` are
    the lines landed when the tables are first built; lines of orders that are not
    there yet wait for them.  Later lines are a change set of their own.
    """
    columns = [*RAW_COLUMNS["orders"], *LINEAGE]

    def run(batch: DataFrame, number: int) -> None:
        apply_batch(tables, batch.select(columns), number, dimensions, items)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
