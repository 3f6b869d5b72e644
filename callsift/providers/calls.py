"""Language-model calls as a map over rows: retries, back-off, bounded concurrency."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from callsift.settings import Settings
from callsift.shipping import ship

log = logging.getLogger(__name__)

#: Calls of a kind after which a task reports its progress.
PROGRESS = {"classify": 10, "label": 1, "findings": 20}


@dataclass(frozen=True)
class Usage:
    input_tokens: int = 0
    output_tokens: int = 0

    def __add__(self, other: "Usage") -> "Usage":
        return Usage(self.input_tokens + other.input_tokens, self.output_tokens + other.output_tokens)


class LanguageModel(Protocol):
    """``ask`` returns the parsed answer (a dict, or None if it could not be parsed) and its usage."""

    name: str

    def ask(self, task: str, instructions: str, prompt: str) -> tuple[dict[str, Any] | None, Usage]: ...


def with_retries(
    ask: Callable[[], tuple[dict | None, Usage]], attempts: int, backoff: float, sleep: Callable[[float], None] = time.sleep, timeout: float | None = None
) -> tuple[dict, Usage]:
    """The first parsed answer; usage adds up over attempts, the last error is raised again.

    An attempt without an answer after ``timeout`` seconds counts as failed; its thread is left behind.
    """
    used = Usage()
    for n in range(attempts):
        try:
            answer, usage = _within(ask, timeout) if timeout else ask()
            used = used + usage
            if answer is None:
                raise ValueError("the answer could not be parsed")
            return answer, used
        except Exception:
            if n + 1 == attempts:
                raise
            sleep(backoff * 2**n)
    raise AssertionError("at least one attempt is made")


def _within(ask: Callable[[], tuple[dict | None, Usage]], timeout: float) -> tuple[dict | None, Usage]:
    pool = ThreadPoolExecutor(1)
    try:
        return pool.submit(ask).result(timeout)
    finally:
        pool.shutdown(wait=False)


def map_calls(rows: DataFrame, key: str, task: str, fields: str, provider: LanguageModel, settings: Settings) -> DataFrame:
    """``key``, the answer's ``fields``, and the token usage, for every row of ``key, instructions, prompt``.

    At most ``llm_concurrency`` calls are in flight: rows are spread over so many partitions, each of
    which makes one call after the other. A call that fails for good fails its task.
    """
    ship(rows.sparkSession)
    schema = T.StructType([rows.schema[key], *T.StructType.fromDDL(fields).fields, T.StructField("input_tokens", T.LongType()), T.StructField("output_tokens", T.LongType())])
    arrow = to_arrow_schema(schema)
    names = [f.name for f in T.StructType.fromDDL(fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            made = []
            for k, instructions, prompt in zip(*(batch.column(i).to_pylist() for i in range(3))):
                answer, usage = with_retries(
                    lambda: provider.ask(task, instructions, prompt), settings.llm_maximum_attempts, settings.llm_initial_backoff_seconds,
                    timeout=settings.llm_timeout_seconds,
                )
                made.append({key: k, **{n: answer.get(n) for n in names}, "input_tokens": usage.input_tokens, "output_tokens": usage.output_tokens})
                done += 1
                if done % PROGRESS.get(task, 20) == 0:
                    log.info("%s: %d calls answered in this task", task, done)
            yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return rows.select(key, "instructions", "prompt").repartition(settings.llm_concurrency, key).mapInArrow(run, schema)


def as_json(value: Any) -> str:
    return json.dumps(value, sort_keys=True)
