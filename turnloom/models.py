"""Plug-in points for speech, language and speaker models.

A model is any object with the method of its protocol; it is built once in each Python worker by a factory and then fed batches.
Failures stay with their item: rows come back as (ok, value, error).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BUILT: dict[object, object] = {}


class Transcriber(Protocol):
    """Speech to a JSON document of segments."""

    def transcribe(self, content: bytes, num_speakers: int | None, language: str | None) -> str: ...


class Scorer(Protocol):
    """Prompt to text, at temperature 0, so that a retried task gives the same answer."""

    def complete(self, prompts: list[str], max_tokens: int) -> list[str]: ...


class Encoder(Protocol):
    """Clip to a vector."""

    def embed(self, content: bytes) -> list[float]: ...


def key_of(factory: Callable[[], object]) -> str:
    """What tells a factory's models apart: its ``key``, else its code and all that it holds."""
    return getattr(factory, "key", None) or hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()


def built(factory: Callable[[], object], key: str | None = None) -> object:
    """The model of a factory, built once a worker."""
    key = key_of(factory) if key is None else key
    if key not in _BUILT:
        _BUILT[key] = factory()
    return _BUILT[key]


def _answer(ok: bool, value: str | None = None, error: str | None = None) -> dict:
    return {"ok": ok, "value": value, "error": error}


def _with_answers(rows: DataFrame, out: str, answers: Callable[[pd.DataFrame], list[dict]]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            frame[out] = answers(frame)
            yield frame

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(run, f"{fields}, `{out}` struct<ok:boolean,value:string,error:string>")


def isolated(rows: DataFrame, column: str, out: str, factory: Callable[[], object], call: Callable[[object, object], str], accept: Callable[[str], bool] | None = None, retries: int = 2) -> DataFrame:
    """Add ``out`` struct (ok, value, error): the model's answer to each row.

    An answer that is not accepted is asked for again up to ``retries`` times; then, or after an exception, the row is marked failed and
    the others go on.
    """
    key = key_of(factory)

    def one(model: object, x: object) -> dict:
        for _ in range(retries + 1):
            try:
                value = call(model, x)
            except Exception as e:  # the item fails, the batch goes on
                return _answer(False, error=f"{type(e).__name__}: {e}")
            if accept is None or accept(value):
                return _answer(True, value)
        return _answer(False, error="not accepted")

    return _with_answers(rows, out, lambda frame: [one(built(factory, key), x) for x in frame[column]])


def completed(rows: DataFrame, column: str, out: str, factory: Callable[[], Scorer], max_tokens: int, prompt: Callable[[str], str] = lambda body: body, accept: Callable[[str], bool] | None = None, retries: int = 2) -> DataFrame:
    """Like ``isolated`` for prompts: the model gets a batch of them at once, and again those whose answers were not accepted.

    If a batch raises, its prompts are asked one by one, so one bad prompt fails alone.
    """
    key = key_of(factory)

    def ask(model: Scorer, prompts: list[str]) -> list[dict]:
        try:
            return [_answer(True, value) for value in model.complete(prompts, max_tokens)]
        except Exception as e:
            return [_answer(False, error=f"{type(e).__name__}: {e}")] if len(prompts) == 1 else [x for p in prompts for x in ask(model, [p])]

    def answers(frame: pd.DataFrame) -> list[dict]:
        model, prompts = built(factory, key), [prompt(x) for x in frame[column]]
        found: list[dict] = [_answer(False, error="not accepted")] * len(prompts)
        open_ = list(range(len(prompts)))
        for _ in range(retries + 1):
            if open_:
                for k, got in zip(list(open_), ask(model, [prompts[k] for k in open_]), strict=True):
                    if not got["ok"] or accept is None or accept(got["value"]):
                        found[k] = got
                        open_.remove(k)
        return found

    return _with_answers(rows, out, answers)


def json_value(text: str) -> object:
    """The JSON in noisy model output, found as ``functions.text.json_text`` finds it; ValueError without any."""
    bare = text.strip()
    if bare.startswith("```"):
        bare = re.sub(r"\s*```\s*$", "", re.sub(r"^```[a-zA-Z]*\s*", "", bare)).strip()
    try:
        return json.loads(bare)
    except ValueError:
        for opening, closing in ("{}", "[]"):
            first, last = bare.find(opening), bare.rfind(closing)
            if 0 <= first < last:
                return json.loads(bare[first : last + 1])
        raise


def assignments_in(text: str) -> list[dict] | None:
    """The assignments of a validation response, or null if it has none."""
    try:
        value = json_value(text)
    except ValueError:
        return None
    found = value.get("assignments") if isinstance(value, dict) else value
    return found if isinstance(found, list) and all(isinstance(a, dict) for a in found) else None


def succeeded(rows: DataFrame, out: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their values, and the quarantine of failed ones."""
    return rows.where(F.col(out)["ok"]).withColumn(out, F.col(out)["value"]), rows.where(~F.col(out)["ok"]).withColumn("error", F.col(out)["error"]).drop(out)


def tallies(rows: DataFrame, out: str) -> DataFrame:
    """Number of succeeded and failed rows."""
    return rows.groupBy(F.when(F.col(out)["ok"], "succeeded").otherwise("failed").alias("status")).agg(F.count("*").alias("n"))


def carried(turns: DataFrame, batch: int, context: int, factory: Callable[[], object], call: Callable[[object, list[dict], list[dict]], list[str]]) -> DataFrame:
    """Correct the speakers of each call batch by batch, giving the model the last turns as already corrected.

    A batch depends on the one before, so a call is one group; calls are bounded by their length and run in parallel.
    """
    key = key_of(factory)

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        model, rows = built(factory, key), frame.sort_values("idx").to_dict("records")
        done: list[dict] = []
        for at in range(0, len(rows), batch):
            part = rows[at : at + batch]
            for row, speaker in zip(part, call(model, done[-context:], part), strict=False):
                row["speaker"] = speaker
            done += part
        return pd.DataFrame(done)[list(frame.columns)]

    return turns.groupBy("call_id").applyInPandas(one, turns.schema)


def carried_answers(turns: DataFrame, batch: int, context: int, factory: Callable[[], Scorer], prompt: Callable[[list[dict], list[dict]], str], max_tokens: int, retries: int = 2) -> DataFrame:
    """Ask for the assignments of each call batch by batch; return (call_id, batch, answer: ok, value, error).

    ``prompt(context, turns)`` gets the last turns with the speakers that earlier answers gave them.  A call ends at its first batch without
    a usable answer.
    """
    key = key_of(factory)
    id_type = turns.schema["call_id"].dataType.simpleString()

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        model, rows = built(factory, key), frame.sort_values("idx").to_dict("records")
        done: list[dict] = []
        made = []
        for at in range(0, len(rows), batch):
            part, got = rows[at : at + batch], _answer(False, error="not accepted")
            for _ in range(retries + 1):
                try:
                    value = model.complete([prompt(done[-context:] if context else [], part)], max_tokens)[0]
                except Exception as e:
                    got = _answer(False, error=f"{type(e).__name__}: {e}")
                    break
                if (found := assignments_in(value)) is not None:
                    got = _answer(True, value)
                    speakers = {a.get("index"): a.get("speaker") for a in found}
                    done += [r | {"speaker": speakers.get(r["idx"]) or r["speaker"]} for r in part]
                    break
            made.append((rows[0]["call_id"], at // batch, got))
            if not got["ok"]:
                break
        return pd.DataFrame(made, columns=["call_id", "batch", "answer"])

    return turns.groupBy("call_id").applyInPandas(one, f"call_id {id_type}, batch bigint, answer struct<ok:boolean,value:string,error:string>")


def embedded(clips: DataFrame, factory: Callable[[], Encoder], rate: int = 16000, seconds: float = 0.5) -> DataFrame:
    """Add ``embedding`` and ``error`` to clips (content, n_samples, sample_rate).

    A clip of less than ``seconds`` has no vector; one of another rate, or that the model refuses, has an error.
    """
    key = key_of(factory)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            vectors, errors = [], []
            for content, n, own in zip(frame["content"], frame["n_samples"], frame["sample_rate"], strict=True):
                vector = error = None
                if own != rate:
                    error = f"expected {rate} Hz, got {own} Hz"
                elif n >= int(seconds * rate):
                    try:
                        vector = [float(x) for x in built(factory, key).embed(content)]
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                vectors.append(vector)
                errors.append(error)
            frame["embedding"], frame["error"] = vectors, errors
            yield frame

    slim = clips.drop("embedding", "error")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields)
    return slim.mapInPandas(run, f"{fields}, embedding array<float>, error string")
