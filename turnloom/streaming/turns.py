"""Merging turns while they arrive, with keyed state.

A call's turns are state, one value that is read and written once a batch.  Whenever a batch brings turns of a call, in whatever order, its merged turns are made again from
the state and sent as the call's next version; a reader takes each call's latest version, so a turn that comes late changes what was sent
before.  Where turns have a time with a watermark, a call's turns leave the state once the watermark has passed the last one by ``idle_s``
seconds; what comes after that is another session of the call.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from turnloom.schemas import MERGE_GAP

MERGED = "session bigint, version bigint, idx bigint, speaker string, start_s double, end_s double, text string, merged_from bigint, first_idx bigint, turn int"
SENT = Row("call_id", *(c.split()[0] for c in MERGED.split(", ")))


def islands(turns: list[tuple], max_gap: float) -> list[list[tuple]]:
    """Turns (idx, speaker, start_s, end_s, text) in order, grouped as ``operators.dialogue.merge_turns`` does."""
    out: list[list[tuple]] = []
    for turn in turns:
        last = out[-1][-1] if out else None
        joined = last is not None and last[1] == turn[1] and last[3] is not None and turn[2] is not None and turn[2] - last[3] <= max_gap
        if joined:
            out[-1].append(turn)
        else:
            out.append([turn])
    return out


class MergeTurns(StatefulProcessor):
    """Keyed by call: one value with the version that was sent last and the turns, and a timer that ends an idle call."""

    def __init__(self, max_gap: float, idle_s: float | None):
        self.max_gap, self.idle_ms = max_gap, None if idle_s is None else int(idle_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        """Declare the state; each read or write of it is a message to Spark, so a call has one value."""
        self.handle = handle
        self.call = handle.getValueState("call", "session bigint, n bigint, turns string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        """Add turns and send the call's merged turns anew; a turn that comes again replaces the one of its index."""
        session, number, turns = self.call.get() or (0, 0, "[]")
        ends, held = 0, {t[0]: tuple(t) for t in json.loads(turns)}
        for row in rows:
            idx, ms = row[1], row[6]
            speaker, start, end, text = (None if x != x else x for x in row[2:6])  # no NaN
            held[idx] = (idx, speaker, start, end, text)
            if self.idle_ms is not None:
                ends = max(ends, ms + self.idle_ms)
        known = [held[k] for k in sorted(held)]
        number += 1
        self.call.update((session, number, json.dumps(known, ensure_ascii=False)))
        if self.idle_ms is not None:
            before = list(self.handle.listTimers())
            if ends > max(before, default=0):
                for old in before:
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(ends)
        for n, group in enumerate(islands(known, self.max_gap)):
            yield SENT(key[0], session, number, n, group[0][1], group[0][2], group[-1][3], " ".join(t[4] or "" for t in group), len(group), group[0][0], n + 1)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:  # noqa: N802, N803
        """Forget the turns of an idle call; two numbers stay."""
        self.call.update((self.call.get()[0] + 1, 0, "[]"))
        return iter(())

    def close(self) -> None:
        """Nothing is held outside the state."""


def merged_turns(turns: DataFrame, max_gap: float = MERGE_GAP, idle_s: float | None = None) -> DataFrame:
    """Merged turns of a stream of turns (call_id, idx, speaker, start_s, end_s, text) as versions of whole calls.

    With ``idle_s`` turns need ``at``, a time that has a watermark; turns that are older than it are dropped by Spark.  Needs a state store with
    transform support (RocksDB).  See ``latest`` for reading what was written.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # Spark asks the processor on the driver, without the session's files
    kind = turns.schema["call_id"].dataType.simpleString()
    timed = [F.unix_millis("at").alias("ms"), "at"] if idle_s is not None else [F.lit(0).cast("bigint").alias("ms")]
    slim = turns.select("call_id", F.col("idx").cast("bigint").alias("idx"), "speaker", F.col("start_s").cast("double").alias("start_s"), F.col("end_s").cast("double").alias("end_s"), "text", *timed)
    schema = StructType.fromDDL(f"call_id {kind}, {MERGED}")
    return slim.groupBy("call_id").transformWithState(MergeTurns(max_gap, idle_s), schema, "append", "None" if idle_s is None else "EventTime")


def latest(versions: DataFrame) -> DataFrame:
    """The merged turns of each call by the latest version of each of its sessions, numbered anew."""
    newest = F.max("version").over(Window.partitionBy("call_id", "session"))
    rows = versions.withColumn("_newest", newest).where("version = _newest")
    number = F.row_number().over(Window.partitionBy("call_id").orderBy("first_idx"))
    return rows.withColumn("idx", (number - 1).cast("bigint")).withColumn("turn", number.cast("int")).drop("_newest", "version", "session")
