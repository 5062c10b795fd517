"""Language-model steps behind a client: per-row calls whose failures become rows."""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Callable, Iterator
from string import Template
from typing import Protocol
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame


class JsonClient(Protocol):
    def create(self, prompt: str, schema: dict) -> str: ...


#: Seconds that a call may take.
TIMEOUT = 45


class HttpJson:
    """A model behind an HTTP endpoint that takes a prompt with a strict schema and gives JSON text."""

    def __init__(self, endpoint: str, model: str, key_variable: str, system: str = "", timeout: float = TIMEOUT):
        self.endpoint, self.model, self.key_variable, self.system, self.timeout = endpoint, model, key_variable, system, timeout

    def create(self, prompt: str, schema: dict) -> str:
        key = os.environ.get(self.key_variable, "")
        if not key:
            raise ValueError(f"the environment variable {self.key_variable} is not set")
        body = {"model": self.model, "system": self.system, "prompt": prompt, "schema": schema, "strict": True}
        request = Request(self.endpoint, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {key}"}, method="POST")
        with urlopen(request, timeout=self.timeout) as answer:
            return answer.read().decode("utf-8")


class Static:
    """A deterministic client for tests: answers by a function of the prompt."""

    def __init__(self, answer: Callable[[str], str]):
        self.answer = answer

    def create(self, prompt: str, schema: dict) -> str:
        return self.answer(prompt)


def rendered(template: str, values: dict) -> str:
    return Template(template).safe_substitute({k: "" if v is None else v for k, v in values.items()})


def called(client: JsonClient, prompt: str, schema: dict) -> tuple[str, str]:
    """(JSON, error): one more try if the answer is no JSON object with the fields asked for."""
    error = ""
    for _ in range(2):
        try:
            raw = client.create(prompt, schema)
            value = json.loads(raw)
            lacking = [k for k in schema.get("required", []) if not isinstance(value, dict) or k not in value]
            if not lacking:
                return json.dumps(value, ensure_ascii=False, sort_keys=True), ""
            error = "invalid json: missing " + ", ".join(lacking)
        except json.JSONDecodeError as e:
            error = f"invalid json: {e}"
        except (TimeoutError, OSError, ValueError) as e:
            return "", f"{type(e).__name__}: {e}"[:1000]
    return "", error[:1000]


def per_row(df: DataFrame, key: str, template: str, schema: dict, client: Callable[[], JsonClient], trace: bool = False) -> DataFrame:
    """key, answer (JSON), error; one client a task.

    With ``trace`` also the prompt, the SHA-256 of prompt and answer, and the
    seconds of each call: a table of what was asked, to be written beside the
    answers.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = client()
        for batch in batches:
            told: dict[str, list] = {name: [] for name in names}
            for row in batch.to_dict("records"):
                prompt, began = rendered(template, row), time.monotonic()
                answer, error = called(own, prompt, schema)
                parts = {"answer": answer, "error": error, "prompt": prompt, "prompt_sha256": _sha256(prompt), "answer_sha256": _sha256(answer), "seconds": time.monotonic() - began}
                for name in names:
                    told[name].append(parts[name])
            yield pd.DataFrame({key: batch[key], **told})

    names = ["answer", "error", *(["prompt", "prompt_sha256", "answer_sha256", "seconds"] if trace else [])]
    kinds = ", ".join(f"{n} {'double' if n == 'seconds' else 'string'}" for n in names)
    return df.mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, {kinds}")


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def asked(client: JsonClient, template: str, values: dict, schema: dict, check: Callable[[dict], None] | None = None, attempts: int = 1) -> dict:
    """One answer for a whole configuration; what ``check`` finds wrong is told to the next attempt, the last failure is an error."""
    told, error = dict(values), ""
    for _ in range(attempts):
        answer, error = called(client, rendered(template, told), schema)
        if not error:
            found = json.loads(answer)
            try:
                if check is not None:
                    check(found)
                return found
            except ValueError as e:
                error = str(e)
        told["feedback"] = f"The last answer failed: {error}"
    raise ValueError(error)
