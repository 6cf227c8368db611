"""Pages up to the first empty one, as a stream whose pages arrive in any order."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from textmart.streaming.first_seen import _run, _run_available
from textmart.streaming.state import keyed_state


class TakeWhile(StatefulProcessor):
    """State of a key: the page it waits for, whether it has ended, and the pages held back."""

    def __init__(self, schema: T.StructType, key: str, page: str, first: int) -> None:
        self.schema, self.first = schema, first
        self.row, names = Row(*schema.fieldNames()), schema.fieldNames()
        self.page, self.keep = names.index(page), names.index("_keep")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.place = handle.getValueState("place", "next LONG, ended BOOLEAN")
        self.held = handle.getMapState("held", "page LONG", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wanted, ended = self.place.get() or (self.first, False)
        if ended:
            return
        for row in rows:
            number = row[self.page]
            # Of a repeated page the first to arrive counts; pages of no number or before the first are none.
            if number is None or number < wanted:
                continue
            if number > wanted:
                if not self.held.containsKey((number,)):
                    self.held.updateValue((number,), tuple(row))
                continue
            while row is not None:
                if not row[self.keep]:
                    self.held.clear()
                    self.place.update((wanted, True))
                    return
                yield self.row(*row)
                wanted += 1
                row = None
                if self.held.containsKey((wanted,)):
                    row = tuple(self.held.getValue((wanted,)))
                    self.held.removeKey((wanted,))
        self.place.update((wanted, False))

    def close(self) -> None:
        pass


def stream_take_while(
    pages: DataFrame, key: str, page: str, keep: Column, store: str, checkpoint: str, first: int = 0
) -> StreamingQuery:
    """The rows of each key before its first page where `keep` fails, stored below `store`.

    Pages of a key are numbered `first`, `first` + 1 and so on, and may arrive in any order and in any
    micro-batch. A page is stored once all pages before it have arrived and passed; until
    then it is held as state of its key, and with the first page that fails all state but the end mark goes.
    What is stored in the end equals `take_while` of all pages whatever their
    order; a page that never arrives holds back those after it. `keep` that is NULL fails.

    A micro-batch writes to a folder named by the checkpoint's id and its number, which a
    replay overwrites. State grows with the pages that wait, and by one row for each key. A
    key's pages are worked on in one task, row by row. Rows with a NULL key form a key.
    """
    spark = pages.sparkSession
    numbered = pages.withColumn(page, F.col(page).cast("long")).withColumn("_keep", F.coalesce(keep, F.lit(False)))
    read = numbered.groupBy(key).transformWithState(
        TakeWhile(numbered.schema, key, page, first), numbered.schema, "Append", "None"
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.drop("_keep").write.mode("overwrite").parquet(f"{store}/run={_run(spark, checkpoint)}/batch_id={batch_id}")

    with keyed_state(spark):
        return _run_available(read, write, checkpoint)
