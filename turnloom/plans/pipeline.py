"""Steps as a graph: running them in order, resuming by what changed, and telling what is kept, stale or missing.

A step has a key, a digest of its own settings and of snapshots of the tables and files that it reads.  It is kept only while its key is the
one that it ran under, its table is the one that it wrote, and all steps that it reads are kept; so turning an optional step on, another
setting, new recordings or calls removed from a table run again what depends on them, and nothing else.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from time import monotonic

from pyspark.sql import Column, DataFrame, SparkSession

from turnloom.operators.sets import spans
from turnloom.plans.tables import snapshot, written


@dataclass(frozen=True)
class Step:
    """A step, the steps whose tables it reads, and whether it can be left out."""

    name: str
    inputs: tuple[str, ...] = ()
    optional: bool = False


# The steps in the order of their numbers.
GRAPH = (
    Step("preprocess"),
    Step("diarize", ("preprocess",)),
    Step("scrub", ("diarize",), True),
    Step("validate", ("scrub",), True),
    Step("segment", ("validate", "preprocess")),
    Step("filter", ("segment",)),
    Step("enroll", ("filter",)),
    Step("label", ("filter", "enroll")),
    Step("export", ("label",)),
)
STEPS = {s.name: s for s in GRAPH}
ORDER = list(STEPS)
OPTIONAL = tuple(s.name for s in GRAPH if s.optional)
Stage = Callable[[Mapping[str, DataFrame]], DataFrame]
Metrics = Mapping[str, Mapping[str, Column]]


def inputs_of(step: str, active: set[str]) -> list[str]:
    """The steps whose tables a step reads: in place of one that does not take part, those that it would have read."""
    found = itertools.chain.from_iterable([i] if i in active else inputs_of(i, active) for i in STEPS[step].inputs)
    return list(dict.fromkeys(found))


@dataclass
class Manifest:
    """A log of steps that ended; what is complete, and what a reader of the file sees, follow from it."""

    config: dict = field(default_factory=dict)
    started_at: str = field(default_factory=lambda: now())
    events: list[dict] = field(default_factory=list)
    resumed_at: str | None = None

    def record(self, step: str, status: str, elapsed: float, error: str | None = None, **more: object) -> None:
        """Add the end of a step."""
        # The fields' names and the rounding, which readers of the file know.
        event = {"step": step, "status": status, "elapsed": round(elapsed, 1), "finished_at": now(), "error": error, **more}
        self.events.append({k: v for k, v in event.items() if v is not None})

    def complete(self, step: str) -> bool:
        """Whether a step's last end was a good one."""
        return (self.last(step) or {}).get("status") == "complete"

    def last(self, step: str) -> dict | None:
        """A step's last end."""
        return next((e for e in reversed(self.events) if e["step"] == step), None)

    def rest(self, steps: list[str]) -> list[str]:
        """The steps that have to run: all that do not belong to the unbroken row of complete ones at the beginning."""
        done = list(itertools.takewhile(self.complete, steps))
        return steps[len(done) :]

    def tallies(self) -> dict[str, dict[str, int]]:
        """What the last writing of each step counted."""
        return {s: e["counts"] for s in ORDER if (e := self.last(s)) and "counts" in e}

    def text(self) -> str:
        """The manifest as JSON: the last end of each step."""
        steps = {e["step"]: {k: v for k, v in e.items() if k != "step"} for e in self.events}
        whole = {"started_at": self.started_at, "resumed_at": self.resumed_at, "config": self.config, "steps": steps}
        return json.dumps({k: v for k, v in whole.items() if v is not None}, indent=2, ensure_ascii=False)

    @classmethod
    def parsed(cls, text: str) -> Manifest:
        """The manifest of an earlier run, taken up now."""
        data = json.loads(text)
        return cls(data.get("config", {}), data["started_at"], [{"step": s, **e} for s, e in data.get("steps", {}).items()], now())


def now() -> str:
    """The time in UTC as ISO-8601."""
    return datetime.now(timezone.utc).isoformat()


def chosen_steps(spec: str | None = None, skip: Mapping[str, str] | None = None) -> list[str]:
    """Steps by number, span or name (``1,3-5``, ``segment,7``, ``all``), in order, without optional ones that ``SKIP_<STEP>`` turns off."""
    parts = [p for p in (x.strip().lower() for x in (spec or "all").split(",")) if p]
    numbers = spans(",".join(p for p in parts if p != "all" and p not in STEPS), 1, len(ORDER))
    wanted = set(ORDER) if "all" in parts else {p for p in parts if p in STEPS} | {ORDER[k - 1] for k in numbers}
    # What turns a switch on.
    off = {s for s in OPTIONAL if (os.environ if skip is None else skip).get(f"SKIP_{s.upper()}", "").lower() in ("1", "true", "yes")}
    return [s for s in ORDER if s in wanted - off]


def saved_at(spark: SparkSession, path: str) -> tuple[Manifest | None, Callable[[Manifest], None]]:
    """The manifest that a file holds, if it is there, and a function that replaces the file; both through Spark's file systems."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def save(manifest: Manifest) -> None:
        out = system.create(place, True)
        out.write(bytearray(manifest.text().encode()))
        out.close()

    if not system.exists(place):
        return None, save
    return Manifest.parsed("\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())), save


class _Run:
    """What a run and a report of states have in common: keys and states of the steps that take part, in order."""

    def __init__(self, spark: SparkSession, root: str, steps: list[str], manifest: Manifest, settings: Mapping[str, object], sources: Mapping[str, list[str]]):
        self.spark, self.root, self.manifest, self.settings, self.sources = spark, root, manifest, settings, sources
        self.active = set(steps) | {s for s in ORDER if manifest.complete(s)}
        self.kept: set[str] = set()
        self._seen: dict[str, str | None] = {}

    def table(self, step: str) -> str | None:
        if step not in self._seen:
            self._seen[step] = snapshot(self.spark, f"{self.root}/{step}")
        return self._seen[step]

    def key(self, step: str) -> str:
        read = {i: self.table(i) for i in inputs_of(step, self.active)}
        files = {p: snapshot(self.spark, p) for p in self.sources.get(step, [])}
        return hashlib.sha256(json.dumps([step, self.settings.get(step), read, files], sort_keys=True, default=str).encode()).hexdigest()

    def state(self, step: str) -> tuple[str, str]:
        """Kept, stale or missing, and why."""
        event, table = self.manifest.last(step), self.table(step)
        if not self.manifest.complete(step) or table is None:
            return "missing", "never complete" if event is None else "its table is gone" if self.manifest.complete(step) else "failed"
        changed = [i for i in inputs_of(step, self.active) if i not in self.kept]
        if changed:
            return "stale", f"reads {', '.join(changed)}"
        if event.get("table", table) != table:
            return "stale", "its table was changed"
        if event.get("key") not in (None, self.key(step)):
            return "stale", "its settings or inputs changed"
        self.kept.add(step)
        return "kept", ""

    def ran(self, step: str) -> None:
        self._seen.pop(step, None)
        self.kept.add(step)


def states(spark: SparkSession, root: str, steps: list[str], manifest: Manifest | None = None, settings: Mapping[str, object] | None = None, sources: Mapping[str, list[str]] | None = None) -> list[tuple[str, str, str]]:
    """Each step that takes part with its state (kept, stale, missing) and the reason; nothing is run."""
    manifest = manifest or saved_at(spark, f"{root}/manifest.json")[0] or Manifest()
    about = _Run(spark, root, steps, manifest, settings or {}, sources or {})
    return [(s, *about.state(s)) for s in ORDER if s in about.active]


def run(
    spark: SparkSession, root: str, stages: Mapping[str, Stage], steps: list[str], manifest: Manifest | None = None, save: Callable[[Manifest], None] | None = None,
    settings: Mapping[str, object] | None = None, sources: Mapping[str, list[str]] | None = None, metrics: Metrics | None = None,
) -> dict[str, DataFrame]:
    """Run those of the steps that are not kept, in order; each stage table is written under ``root`` and read again.

    A stage sees the tables of all steps before it, also of those that an earlier run completed.  ``settings`` and ``sources`` (paths of files)
    of a step belong to its key.  Rows, and the ``metrics`` of a step, are counted while its table is written, and stand in the manifest.
    Unless the caller does so, the manifest is kept in ``root/manifest.json``, so a run that is started again goes on where it is needed.
    """
    if manifest is None:
        known, own = saved_at(spark, f"{root}/manifest.json")
        manifest, save = known or Manifest(), save or own
    save = save or (lambda m: None)
    about = _Run(spark, root, steps, manifest, settings or {}, sources or {})
    tables: dict[str, DataFrame] = {}
    for step in ORDER:
        path = f"{root}/{step}"
        if step in about.active and about.state(step)[0] != "kept" and step in steps:
            began, key = monotonic(), about.key(step)
            try:
                _, counts = written(stages[step](tables), path, (metrics or {}).get(step))
            except Exception as e:
                manifest.record(step, "failed", monotonic() - began, str(e)[:500])
                save(manifest)
                raise
            about.ran(step)
            manifest.record(step, "complete", monotonic() - began, key=key, table=about.table(step), counts=counts)
            save(manifest)
        if manifest.complete(step):
            tables[step] = spark.read.parquet(path)
    return tables
