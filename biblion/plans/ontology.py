"""Whether the categories of a contract are fit to tag papers with: coded issues, and warnings that stop nothing."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from biblion.plans.contract import RETIRED_CATEGORIES, label_of

# They must be these for the results to be right.
LEAST_CATEGORIES = 6
LEAST_VALUES = 2
FALLBACKS = ["ambiguous", "mixed", "mixed_or_unclear", "none", "not_applicable", "not_reported", "other", "unclear", "unknown"]
CATCH_ALL = [*FALLBACKS, "miscellaneous", "not_specified"]
META_IDS = """category category_type dimension dimension_type knowledge_area knowledge_category knowledge_dimension
knowledge_label knowledge_type label_type paper_focus paper_type research_area tag_dimension tag_type""".split()
META_VALUES = """application approach category claim context data dimension domain equity evidence intervention mechanism
method outcome phenomenon population research_area setting target technology tool""".split()
BOILERPLATE_IDS = "data_source_type population_group study_design study_population study_type target_population".split()
BOILERPLATE_VALUES = """case_control cohort cross_sectional experimental longitudinal meta_analysis mixed_methods
observational patients review survey systematic_review""".split()
SNAKE = re.compile("[a-z][a-z0-9]*(_[a-z0-9]+)*")


@dataclass(frozen=True)
class Issue:
    code: str
    category_id: str | None
    values: tuple[str, ...] = ()


def concrete(values: list) -> list[str]:
    """Values other than fallbacks."""
    return [v for v in values if isinstance(v, str) and label_of(v) not in FALLBACKS]


def _of(words: list[str], values: list) -> list[str]:
    return [v for v in values if isinstance(v, str) and label_of(v) in words]


def _meta(name: str, c: dict) -> list[str] | None:
    own = concrete(c["values"])
    found = _of(META_VALUES, own)
    return found if len(found) >= 2 or (found and len(found) == len(own)) else None


def _parent(c: dict) -> str:
    return str((c.get("applies_when") or {}).get("category_id") or "")


#: Code and rule: nothing if all is well, else the values meant, or True for the category itself.
RULES: list[tuple[str, Callable[[str, dict], object]]] = [
    ("meta_category_id", lambda name, c: label_of(name) in META_IDS),
    ("retired_category_id", lambda name, c: label_of(name) in RETIRED_CATEGORIES),
    ("non_snake_category_id", lambda name, c: not SNAKE.fullmatch(name)),
    ("boilerplate_category_id", lambda name, c: label_of(name) in BOILERPLATE_IDS),
    ("too_few_values", lambda name, c: (concrete(c["values"]) or True) if len(concrete(c["values"])) < LEAST_VALUES else None),
    ("catchall_values", lambda name, c: _of(CATCH_ALL, c["values"])),
    ("meta_values", _meta),
    ("non_snake_values", lambda name, c: [v for v in concrete(c["values"]) if not SNAKE.fullmatch(v)]),
    ("meta_dependency", lambda name, c: [_parent(c)] if label_of(_parent(c)) in META_IDS else None),
    ("broad_dependency_values", lambda name, c: _of(META_VALUES, (c.get("applies_when") or {}).get("values") or [])),
]


def issues(contract: dict) -> list[Issue]:
    """What makes the categories of a generated contract weak, category by category."""
    categories = contract["tagging"]["categories"]
    found = [Issue("too_few_categories", None)] if len(categories) < LEAST_CATEGORIES else []
    for name, c in categories.items():
        for code, rule in RULES:
            if told := rule(str(name), c):
                found.append(Issue(code, str(name), () if told is True else tuple(told)))
    return found


def warnings(contract: dict) -> list[Issue]:
    """Categories and values that any field could have; a run goes on with them."""
    found = []
    for name, c in contract["tagging"]["categories"].items():
        own = concrete(c["values"])
        if label_of(name) in BOILERPLATE_IDS:
            found.append(Issue("boilerplate_category_id", str(name)))
        if own and len(_of(BOILERPLATE_VALUES, own)) == len(own):
            found.append(Issue("boilerplate_values", str(name), tuple(own)))
    return found
