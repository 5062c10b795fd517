"""Ids that a model may have mistyped, resolved against a short list of known ones."""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLOSE = 0.94


def closest(asked: str | None, known: Sequence[str]) -> str:
    """The id itself, else the only one at a ratio of CLOSE or more, else empty."""
    if not asked or asked in known:
        return asked or ""
    near = []
    told = SequenceMatcher(None, b=asked)
    for k in known:
        # no ratio is above what the lengths alone allow, nor above what the letters do
        if 2 * min(len(k), len(asked)) < CLOSE * (len(k) + len(asked)):
            continue
        told.set_seq1(k)
        # the ratio depends on which comes first
        if told.quick_ratio() >= CLOSE and SequenceMatcher(None, asked, k).ratio() >= CLOSE:
            near.append(k)
    return near[0] if len(near) == 1 else ""


def resolved(known: Sequence[str]):
    """A column function; ``known`` is a configuration's list, small by nature."""
    ids = sorted(set(known))

    @F.pandas_udf(T.StringType())
    def run(asked: pd.Series) -> pd.Series:
        told = {a: closest(a, ids) for a in asked.unique()}
        return asked.map(told)

    return run
