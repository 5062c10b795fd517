"""Runs of named steps: selection, a manifest with file hashes, resumption, pauses."""

from __future__ import annotations

import datetime
import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field


class Pause(Exception):
    """A run stops for a review of the named file; it goes on once that is approved."""


def utc_now(clock: Callable[[], float] = time.time) -> str:
    """The time of a clock in UTC, as ISO 8601."""
    return datetime.datetime.fromtimestamp(clock(), datetime.UTC).isoformat()


def new_run_id(clock: Callable[[], float] = time.time, chance: Callable[[], str] = lambda: uuid.uuid4().hex) -> str:
    """A short id: the second in UTC and eight digits of chance."""
    return datetime.datetime.fromtimestamp(clock(), datetime.UTC).strftime("%Y%m%dT%H%M%SZ") + "-" + chance()[:8]


@dataclass(frozen=True)
class Settings:
    """What the steps of a run share; paths are taken from its folder."""

    collection: str
    folder: str = "."
    run_id: str = field(default_factory=new_run_id)
    model: str | None = None
    contract: str | None = None

    def path(self, name: str, make: bool = False) -> str:
        found = name if os.path.isabs(name) else os.path.join(self.folder, name)
        if make:
            os.makedirs(os.path.dirname(found) or ".", exist_ok=True)
        return found


@dataclass
class StepResult:
    status: str = "succeeded"
    counts: dict[str, int] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    error: str = ""
    inputs: Sequence[str] = ()
    outputs: Sequence[str] = ()


def selected(steps: Sequence[str], first: str | None = None, last: str | None = None, only: str | None = None) -> list[str]:
    """The steps of a plan between two, or one alone."""
    for name in (first, last, only):
        if name is not None and name not in steps:
            raise ValueError(f"no step {name}; steps are " + ", ".join(steps))
    if only is not None:
        return [only]
    begin, end = steps.index(first) if first else 0, steps.index(last) + 1 if last else len(steps)
    if begin >= end:
        raise ValueError("the first step comes after the last")
    return list(steps[begin:end])


def file_hash(path: str) -> str | None:
    """SHA-256 of a file, or of a folder's files in order of their names."""
    if not os.path.exists(path):
        return None
    names = [path] if os.path.isfile(path) else sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs)
    digest = hashlib.sha256()
    for name in names:
        with open(name, "rb") as f:
            while part := f.read(1 << 20):
                digest.update(part)
    return digest.hexdigest()


class Manifest:
    """What each step of a run did; a resumed run adds to it."""

    def __init__(self, path: str, clock: Callable[[], float] = time.time):
        self.path, self.clock = path, clock
        self.steps: list[dict] = []
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                self.steps = json.load(f)["steps"]

    def add(self, name: str, result: StepResult, seconds: float) -> None:
        files = {kind: {p: file_hash(p) for p in paths} for kind, paths in (("inputs", result.inputs), ("outputs", result.outputs))}
        self.steps.append({"step": name, "status": result.status, "counts": result.counts, "warnings": result.warnings, "error": result.error, "seconds": round(seconds, 3), "at": self.clock(), **files})
        with open(self.path, "w", encoding="utf-8") as f:
            json.dump({"steps": self.steps}, f, indent=2, ensure_ascii=False)

    def resume_step(self, plan: Sequence[str]) -> str | None:
        """The first step of the plan whose last record didn't succeed, or that has none."""
        status = {s["step"]: s["status"] for s in self.steps}
        return next((name for name in plan if status.get(name) != "succeeded"), None)


def approved(path: str) -> bool:
    if not os.path.exists(path):
        return False
    with open(path, encoding="utf-8") as f:
        return json.load(f).get("status") == "approved"


def run(plan: Sequence[str], functions: dict[str, Callable[[], StepResult]], manifest: Manifest) -> str:
    """Run the steps in order until one fails or pauses: succeeded, failed or paused."""
    for name in plan:
        began = time.monotonic()
        try:
            result = functions[name]()
        except Pause as e:
            manifest.add(name, StepResult("paused", warnings=[str(e)]), time.monotonic() - began)
            return "paused"
        except Exception as e:  # the manifest keeps what went wrong
            manifest.add(name, StepResult("failed", error=f"{type(e).__name__}: {e}"), time.monotonic() - began)
            return "failed"
        manifest.add(name, result, time.monotonic() - began)
        if result.status != "succeeded":
            return result.status
    return "succeeded"


MAIN = ["normalize", "screen_scope", "full_text", "tagging_config", "tagging_rules", "tag", "audit", "export"]
COLLECT = ["plan_search", "fetch", "deduplicate", "screen_titles", "verify_full_text", "backfill", "export_included"]
CALIBRATE = ["select_calibration", "calibration_full_text", "calibrate_contract"]
BOOTSTRAP = ["generate_contract", "fetch_reviews", "review_full_text", "refine_contract"]
REVIEW = ["label_values", "validate_labels", "coverage_report", "evidence_map", "write_sections", "edit_sections", "assemble"]


def _before(plan: list[str], step: str, *new: str) -> list[str]:
    at = plan.index(step)
    return plan[:at] + [x for x in new if x not in plan] + plan[at:]


def main_plan(calibrate: bool = False, review_categories: bool = False, extract_labels: bool = False, review_values: bool = False, write_review: bool = False) -> list[str]:
    """The steps of a tagging run with what is asked for besides.

    Labels of reviews are extracted while papers are tagged, so their
    configuration comes before; a review is written after the export.
    """
    plan = list(MAIN)
    if calibrate:
        plan = _before(plan, "tagging_config", "calibrate_contract")
    if review_categories:
        plan = _before(plan, "tagging_config", "review_categories")
    if extract_labels or review_values or write_review:
        at = plan.index("full_text") + 1
        plan = _before(plan[:at] + ["filter_reviews"] + plan[at:], "tag", "review_config")
    if write_review or (review_values and not extract_labels):
        plan += _before(REVIEW, "validate_labels", "review_values") if review_values else REVIEW
    return plan


def collection_plan(with_contract: bool = False) -> list[str]:
    return [*BOOTSTRAP, *COLLECT] if with_contract else list(COLLECT)
