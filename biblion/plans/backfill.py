"""Filling a collection until enough papers can be had.

A round fetches, deduplicates against what is there, screens, checks full texts
and settles what was put off; rounds end when enough papers are eligible, a
round brings nothing new, or every query is exhausted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblion.operators.papers import unseen
from biblion.operators.state import held

Step = Callable[[DataFrame], DataFrame]


@dataclass
class Backfill:
    """The steps of a round.  ``fetch`` gets the number wanted and the candidates so far; None says that all is exhausted."""

    fetch: Callable[[int, DataFrame], DataFrame | None]
    screen: Step
    verify: Step
    finalize: Callable[[DataFrame, DataFrame], DataFrame]

    def run(self, candidates: DataFrame, screening: DataFrame, availability: DataFrame, target: int, key: str, ordinal: str, verified_only: bool = True) -> tuple[dict[str, DataFrame], list[dict]]:
        """The tables after the last round, and what each round did."""
        tables, told = {"candidates": candidates, "screening": screening, "availability": availability}, []
        while True:
            have = eligible(tables["screening"], tables["availability"], key, verified_only).count()
            if have >= target:
                return tables, [*told, {"round": len(told) + 1, "eligible": have, "new": 0, "ended": "enough"}]
            found = self.fetch(target - have, tables["candidates"])
            if found is None:
                return tables, [*told, {"round": len(told) + 1, "eligible": have, "new": 0, "ended": "exhausted"}]
            new = held(unseen(found, tables["candidates"], key, ordinal))
            n = new.count()
            if not n:
                return tables, [*told, {"round": len(told) + 1, "eligible": have, "new": 0, "ended": "nothing_new"}]
            screened = held(self.screen(new))
            known = held(self.verify(screened))
            parts = {"candidates": new, "screening": self.finalize(screened, known), "availability": known}
            # lineage ends each round
            tables = {k: held(tables[k].unionByName(v, allowMissingColumns=True)) for k, v in parts.items()}
            told.append({"round": len(told) + 1, "eligible": have, "new": n, "ended": ""})


def eligible(screening: DataFrame, availability: DataFrame, key: str, verified_only: bool = True) -> DataFrame:
    """Included rows, with a verified full text if that is asked for."""
    rows = screening.filter(F.col("screening_decision") == "include")
    if not verified_only:
        return rows
    return rows.join(availability.filter("full_text_availability_status = 'verified'").select(key), key, "left_semi")
