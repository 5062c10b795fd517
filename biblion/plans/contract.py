"""Contracts: the configuration that topics, tags, screening and collection come from.

A contract is a small mapping that is read on the driver.  Its shape is a
table; what the operators take from it are their own dataclasses.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Iterator

from biblion.operators.audit import Category, Label
from biblion.operators.matching import FIELDS, given_groups, unique_terms

# They must be these for the results to be right.
MOST_RETRIEVAL_TERMS = 12
RETIRED_CATEGORIES = ["knowledge_goal"]
GENERAL_POLICIES = ["prefer_unclear_when_allowed", "prefer_mixed_or_unclear_when_unclear_missing", "missing_information_value"]

_GROUP = {"label": "text", "field?": "field", "terms": "terms", "retrieval_terms?": "few", "matching_terms?": "texts"}
#: Keys with ``?`` may be missing.
SHAPE = {
    "topic_id": "text",
    "research_topic": {"title": "text", "description": "text"},
    "topic_structure": {"anchor_topic_id": "text", "anchor_reason": "text", "main_topics": [{"topic_id": "text", **_GROUP}]},
    "scope": {"include_criteria": "list", "exclude_criteria": "list", "boundary_rules": "list"},
    "rule_based_screening": {"include_terms": "texts", "exclude_terms": "texts", "exclude_wins": "flag"},
    "candidate_screening": {"missing_abstract_policy": "text", "borderline_policy": "text", "human_review_policy": "text"},
    "tagging": {"fallback_policy": "map", "categories": "map"},
    "collection": {"allowed_providers": "terms", "preferred_provider": "text"},
}
_CATEGORY = {"values": "terms", "required?": "flag", "selection?": "selection"}


def _is_text(x) -> bool:
    return isinstance(x, str) and bool(x.strip())


_KINDS = {
    "text": ("must be a text that isn't empty", _is_text),
    "flag": ("must be true or false", lambda x: isinstance(x, bool)),
    "list": ("must be a list", lambda x: isinstance(x, list)),
    "map": ("must be a mapping", lambda x: isinstance(x, dict)),
    "texts": ("must be a list of texts", lambda x: isinstance(x, list) and all(map(_is_text, x))),
    "terms": ("must be a list of texts that isn't empty", lambda x: isinstance(x, list) and bool(x) and all(map(_is_text, x))),
    "few": (f"must be at most {MOST_RETRIEVAL_TERMS} texts", lambda x: isinstance(x, list) and len(x) <= MOST_RETRIEVAL_TERMS and all(map(_is_text, x))),
    "field": (f"must be one of {FIELDS}", lambda x: x in FIELDS),
    "selection": ("must be single or multi", lambda x: x in ("single", "multi")),
}


def faults(value, shape, path: str = "contract") -> Iterator[str]:
    """What in ``value`` isn't of this shape, in the order of the shape."""
    if isinstance(shape, str):
        said, fine = _KINDS[shape]
        if not fine(value):
            yield f"{path} {said}."
    elif isinstance(shape, list):
        if not isinstance(value, list):
            yield f"{path} must be a list."
            return
        for n, x in enumerate(value, 1):
            yield from faults(x, shape[0], f"{path}[{n}]")
    elif not isinstance(value, dict):
        yield f"{path} must be a mapping."
    else:
        for key, inner in shape.items():
            name = key.rstrip("?")
            if name != key and value.get(name) is None:
                continue
            yield from faults(value.get(name), inner, f"{path}.{name}")


def problems(contract: dict) -> Iterator[str]:
    """All that is wrong with a contract: its shape, then what its parts say of each other."""
    wrong = list(faults(contract, SHAPE))
    yield from wrong
    if wrong:
        return
    yield from _topic_problems(contract["topic_structure"])
    yield from _category_problems(contract["tagging"]["categories"])
    chosen, asked = contract["collection"], contract["collection"].get("search_queries")
    if chosen["preferred_provider"] not in chosen["allowed_providers"]:
        yield "collection.preferred_provider must be allowed."
    if "search_queries" in chosen:
        yield from faults(asked, "list", "collection.search_queries")
        for n, q in enumerate(asked if isinstance(asked, list) else [], 1):
            yield from faults({"query": q} if isinstance(q, str) else q, {"query": "text"}, f"collection.search_queries[{n}]")
            if isinstance(q, dict) and "reason" in q:
                yield from faults(q["reason"], "text", f"collection.search_queries[{n}].reason")


def _topic_problems(structure: dict) -> Iterator[str]:
    ids = [t["topic_id"] for t in structure["main_topics"]]
    if len(ids) < 2:
        yield "topic_structure.main_topics must contain at least two topics."
    if len(set(ids)) < len(ids):
        yield "topic_structure.main_topics has an id twice."
    if structure["anchor_topic_id"] not in ids:
        yield "topic_structure.anchor_topic_id must be a main topic."
    second, group = structure.get("secondary_topics"), {"secondary_topic_id": "text", **_GROUP}
    if isinstance(second, dict):
        for topic, groups in second.items():
            at = f"topic_structure.secondary_topics.{topic}"
            if topic not in ids:
                yield f"{at} is no main topic."
            plain = isinstance(groups, list) and not any(isinstance(g, dict) for g in groups)
            yield from faults(groups, "terms" if plain or not groups else [group], at)
    elif isinstance(second, list):
        for n, x in enumerate(second, 1):
            at = f"topic_structure.secondary_topics[{n}]"
            yield from faults(x, {"main_topic_id": "text", **group}, at)
            if isinstance(x, dict) and x.get("main_topic_id") not in ids:
                yield f"{at}.main_topic_id is no main topic."
    else:
        yield "topic_structure.secondary_topics must be a mapping or a list."


def _category_problems(categories: dict) -> Iterator[str]:
    if not categories:
        yield "tagging.categories must not be empty."
    for name, c in categories.items():
        at = f"tagging.categories.{name}"
        wrong = list(faults(name, "text", at)) + list(faults(c, _CATEGORY, at))
        yield from wrong
        if wrong:
            continue
        if len(set(c["values"])) < len(c["values"]):
            yield f"{at}.values has a value twice."
        when = c.get("applies_when")
        if when in (None, {}):
            continue
        wrong = list(faults(when, {"category_id": "text", "values": "terms"}, f"{at}.applies_when"))
        yield from wrong
        if wrong:
            continue
        parent = categories.get(when["category_id"])
        if when["category_id"] == name or not isinstance(parent, dict):
            yield f"{at}.applies_when.category_id must be another category."
        elif not set(when["values"]) <= set(parent.get("values") or []):
            yield f"{at}.applies_when.values must be values of {when['category_id']}."


def checked(contract: dict) -> dict:
    """The contract; its first problem is an error."""
    for said in problems(contract):
        raise ValueError(said)
    return contract


def screening(contract: dict) -> dict:
    """Rule-based screening, its terms widened by those of all topics."""
    rules, structure = checked(contract)["rule_based_screening"], contract["topic_structure"]
    terms = rules["include_terms"] + [t for topic in structure["main_topics"] for t in topic["terms"]]
    for _, group in given_groups(structure):
        terms += [t for key in ("terms", "retrieval_terms", "matching_terms") for t in group.get(key) or []] if isinstance(group, dict) else group
    return {**rules, "include_terms": unique_terms(terms)}


def tag_categories(contract: dict) -> list[Category]:
    """The categories of tags, without the retired and those that depend on them."""
    known = checked(contract)["tagging"]["categories"]
    retired = {k for k in known if label_of(k) in RETIRED_CATEGORIES}
    found = []
    for name, c in known.items():
        when = c.get("applies_when") or {}
        if name in retired or when.get("category_id") in retired:
            continue
        found.append(Category(name, tuple(c["values"]), c.get("selection") or "multi", bool(c.get("required")), when.get("category_id"), tuple(when.get("values") or ())))
    return found


def label_of(value) -> str:
    """A value as a label: lower case, other than letters and digits as single underscores."""
    return re.sub(r"[^a-z0-9]+", "_", str(value or "").casefold()).strip("_")


def labels_of(values, at: str) -> list[str]:
    if not isinstance(values, list):
        raise ValueError(f"{at} must be a list.")
    return [x for x in dict.fromkeys(label_of(v.get("value") if isinstance(v, dict) else v) for v in values) if x]


def reviewed_label(label: Label, found: list[str], review: dict) -> Label:
    """A review label after a person's review of the values found.

    Kept are the values of the review and the targets of its merges; a value
    found that is neither kept nor merged is dropped, as are those named.
    """
    at = f"labels.{label.label_id}"
    merges = review.get("merge_values") or {}
    if not isinstance(merges, dict):
        raise ValueError(f"{at}.merge_values must be a mapping.")
    pairs = {label_of(k): label_of(v) for k, v in merges.items()}
    pairs = {k: v for k, v in pairs.items() if k and v and k != v}
    kept = list(dict.fromkeys([*labels_of(review.get("values"), f"{at}.values"), *pairs.values()]))
    dropped = set(labels_of(review.get("drop_values", []), f"{at}.drop_values")) | (set(found) - set(kept) - set(pairs))
    return Label(label.label_id, label.mode, tuple(kept), dict(sorted(pairs.items())), tuple(sorted(dropped)), label.selection, label.required)


def reviewed_contract(contract: dict, review: dict, completed: dict[str, list[str]] | None = None) -> tuple[dict, list[str]]:
    """The contract with the categories of a person's review, and what had to change besides.

    Values that the review leaves open (missing, empty or ``auto``) come from
    ``completed``.  Dependencies on what is gone are loosened or removed.
    """
    asked = review.get("categories")
    if not isinstance(asked, dict) or not asked:
        raise ValueError("the review must keep at least one category.")
    merged, said, new = copy.deepcopy(contract), [], {}
    old = merged["tagging"]["categories"]
    for raw, told in asked.items():
        name = label_of(raw)
        if not name or name in new:
            raise ValueError(f"the id {raw!r} of a reviewed category is empty or there twice.")
        values = told.get("values") if isinstance(told, dict) else told
        open_ = not values or (isinstance(values, str) and label_of(values) == "auto")
        chosen = (completed or {}).get(name, []) if open_ else labels_of(values, name)
        if name not in old:
            said.append(f"added {name}")
        start = {"label": name, "required": False, "selection": "multi", "applies_when": None}
        new[name] = start | old.get(name, {}) | {"values": chosen}
    said += [f"removed {name}" for name in sorted(set(old) - set(new))]
    for name, c in new.items():
        when = c.get("applies_when")
        if not when:
            c["applies_when"] = None
            continue
        parent = label_of(when.get("category_id")) if isinstance(when, dict) else ""
        left = [v for v in map(label_of, when.get("values") or []) if v in new[parent]["values"]] if parent in new else []
        c["applies_when"] = {"category_id": parent, "values": left} if left else None
        if not left:
            said.append(f"{name} no longer depends on {parent or 'anything'}")
    merged["tagging"]["categories"] = new
    policy = merged["tagging"].get("fallback_policy") or {}
    for name in [k for k in policy if k not in GENERAL_POLICIES]:
        if name not in new or (isinstance(policy[name], str) and policy[name] not in new[name]["values"]):
            del policy[name]
            said.append(f"no fallback for {name}")
    return checked(merged), said


MODES = ("controlled_fixed", "controlled_auto", "free_text", "evidence_quote")
CAPS = ("max_values_per_paper", "max_words_per_value", "max_items_per_paper", "max_words_per_item")


def review_labels(contract: dict) -> list[Label]:
    """The labels of a contract's review.

    Values that are listed, or the main topics, are fixed; a label without is
    automatic, unless its mode says otherwise.
    """
    found: dict[str, Label] = {}
    for raw, told in ((contract.get("review") or {}).get("labels") or {}).items():
        name, at = label_of(raw), f"review.labels.{raw}"
        if not name or name in found:
            raise ValueError(f"{at} is empty or there twice.")
        for cap in CAPS:
            if told.get(cap) not in (None, "") and not (isinstance(told[cap], int) and told[cap] > 0):
                raise ValueError(f"{at}.{cap} must be a positive number.")
        if told.get("values_from") == "topic_structure.main_topics":
            mode, values = "controlled_fixed", labels_of([t.get("topic_id") for t in contract["topic_structure"]["main_topics"]], at)
        else:
            values = [] if told.get("values") in (None, "auto") else labels_of(told["values"], f"{at}.values")
            mode = told.get("value_mode") or ("controlled_fixed" if values else "controlled_auto")
        selection = (told.get("selection") or "multi") if mode.startswith("controlled") else "multi"
        if mode not in MODES or selection not in ("single", "multi") or (mode == "controlled_fixed" and not values):
            raise ValueError(f"{at} has no such mode or selection, or is fixed without values.")
        found[name] = Label(name, mode, tuple(values), selection=selection, required=bool(told.get("required")))
    return list(found.values())


# The labels of a review that a contract doesn't configure, their caps and the sections that tell of them.
DEFAULT_STUDY_DESIGNS = [
    "observational_study",
    "experimental_study",
    "randomized_controlled_trial",
    "quasi_experimental_study",
    "cohort_study",
    "case_control_study",
    "cross_sectional_study",
    "longitudinal_study",
    "qualitative_study",
    "survey_study",
    "case_study",
    "mixed_methods_study",
    "validation_study",
    "simulation_study",
    "benchmark_study",
    "model_development_study",
    "secondary_data_analysis",
    "unclear",
]
DEFAULT_LABELS = {
    "methodology": {"value_mode": "controlled_auto", "selection": "multi", "values": "auto", "max_values_per_paper": 2, "max_words_per_value": 5, "evidence_sections": ["title", "abstract", "methods", "methodology", "materials_and_methods", "study_design", "procedure", "approach", "analysis"]},
    "study_design": {"value_mode": "controlled_fixed", "selection": "single", "values": DEFAULT_STUDY_DESIGNS, "max_values_per_paper": 1, "max_words_per_value": 4, "evidence_sections": ["title", "abstract", "introduction", "methods", "methodology", "materials_and_methods", "study_design", "procedure", "approach"]},
    "dataset_or_sample": {"value_mode": "free_text", "max_items_per_paper": 2, "max_words_per_item": 18, "evidence_sections": ["abstract", "methods", "methodology", "materials_and_methods", "study_design", "data", "sample", "participants", "population", "cohort"]},
    "key_finding": {"value_mode": "free_text", "required": True, "max_items_per_paper": 1, "max_words_per_item": 35, "evidence_sections": ["results", "findings", "discussion", "conclusion"]},
    "paper_limitation": {"value_mode": "free_text", "max_items_per_paper": 2, "max_words_per_item": 25, "evidence_sections": ["limitations", "discussion", "conclusion", "abstract"]},
    "direct_quote": {"value_mode": "evidence_quote", "evidence_sections": ["introduction", "results", "findings", "discussion", "conclusion"]},
    "future_work_or_gap": {"value_mode": "free_text", "max_items_per_paper": 2, "max_words_per_item": 25, "evidence_sections": ["future_work", "discussion", "conclusion", "limitations"]},
}
DEFAULT_REVIEW = {"enabled": True, "review_type": "narrative", "output": {"formats": ["markdown"], "citation_style": "harvard", "max_quote_words": 40}}
DEFAULT_SECTIONS = ["abstract", "results", "discussion", "conclusion"]


def review_config(contract: dict) -> dict:
    """A contract's review with its defaults: type, output, and each label's mode, values, caps and sections.

    A contract without a review is given all defaults; labels that it lists
    take the place of the default ones.
    """
    given = contract.get("review")
    if given is not None and not isinstance(given, dict):
        raise ValueError("review must be a mapping.")
    given = given or {}
    labels = given.get("labels", DEFAULT_LABELS)
    if not isinstance(labels, dict) or not labels:
        raise ValueError("review.labels must name a label.")
    told = {label_of(k): v for k, v in labels.items()}
    found = []
    for x in review_labels({**contract, "review": {"labels": labels}}):
        sections = told[x.label_id].get("evidence_sections", DEFAULT_SECTIONS)
        if not sections:
            raise ValueError(f"review.labels.{x.label_id}.evidence_sections must name a section.")
        caps = {c: told[x.label_id].get(c) for c in CAPS}
        found.append({"label_id": x.label_id, "value_mode": x.mode, "selection": x.selection, "required": x.required, "allowed_values": list(x.allowed), "evidence_sections": list(sections), **caps})
    output = {**DEFAULT_REVIEW["output"], **(given.get("output") or {})}
    return {"enabled": bool(given.get("enabled", True)), "review_type": label_of(given.get("review_type")) or DEFAULT_REVIEW["review_type"], "output": output, "label_count": len(found), "labels": found}
