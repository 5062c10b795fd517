"""Queries to a provider, planned from the topics of a contract.

Tier 0 asks for all main topics; tier k replaces k of them, the anchor never,
by secondary groups, in every way.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import combinations, product

from biblion.operators.matching import field_of, secondary_groups, unique_terms
from biblion.plans.contract import MOST_RETRIEVAL_TERMS
from biblion.sources.provider import query_text

#: What a tier is for.
GOAL = "fill what is still wanted before the next tier is asked"
# They must be these for the results to be right.
REVIEW_WORDS = ["review", "overview", "survey", "meta-analysis"]


def retrieval_terms(topic: dict) -> list[str]:
    """At most twelve terms, those meant for retrieval before the others."""
    return unique_terms(topic.get("retrieval_terms") or topic.get("terms"))[:MOST_RETRIEVAL_TERMS]


def plain_queries(query_id: str, blocks: Sequence[dict]) -> list[dict]:
    """For providers without AND and OR: as many queries as the longest block has terms, the shorter ones repeating."""
    cycles = [t for t in (unique_terms(b["terms"]) for b in blocks) if t]
    found: dict[str, dict] = {}
    for n in range(max(map(len, cycles), default=0)):
        text = " ".join(c[n % len(c)] for c in cycles)
        found.setdefault(text.casefold(), {"query_id": f"{query_id}_fallback_{n + 1}", "logical_query_id": query_id, "query": text, "reason": f"one term of each topic of {query_id}"})
    return list(found.values())


def _part(value: str) -> str:
    return re.sub("[^a-z0-9]+", "_", value.lower()).strip("_") or "secondary"


def _query(tier: int, name: str, phase: str, screen: bool, blocks: list[dict], replaced: Sequence[dict] = ()) -> dict:
    instead = [{"main_topic_id": g["main_topic_id"], "secondary_topic_id": g["secondary_topic_id"], "label": g["label"]} for g in replaced]
    return {
        "query_id": name,
        "tier": tier,
        "query": query_text([b["terms"] for b in blocks]),
        "reason": "all main topics" if not replaced else "instead of " + ", ".join(f"{g['main_topic_id']}: {g['label']}" for g in replaced),
        "requires_title_screening": screen,
        "retrieval_phase": phase,
        "blocks": blocks,
        "replaced_main_topics": [g["main_topic_id"] for g in replaced],
        "replacement_secondary_groups": instead,
        "fallback_queries": plain_queries(name, blocks),
    }


def query_groups(contract: dict, most: int | None = None, rounds: int = 2) -> dict:
    """The tiers of queries of a contract; empty if no topic has terms."""
    structure = contract.get("topic_structure") or {}
    mains = {str(t["topic_id"]).strip(): t for t in structure.get("main_topics") or [] if isinstance(t, dict) and str(t.get("topic_id") or "").strip()}
    fields = {k: field_of(t) for k, t in mains.items()}
    relaxed = any(f != "title" for f in fields.values())
    options: dict[str, list[dict]] = {k: [] for k in mains if k != str(structure.get("anchor_topic_id") or "").strip()}
    for g in secondary_groups(structure):
        if retrieval_terms(g) and g["main_topic_id"] in options:
            options[g["main_topic_id"]].append(g)
    options = {k: v for k, v in options.items() if v}

    def blocks(swap: dict[str, dict], field: str | None = None) -> list[dict] | None:
        made = []
        for k, topic in mains.items():
            g = swap.get(k)
            made.append({"topic_id": k, "kind": "secondary" if g else "main", "field": field or (g["field"] if g else fields[k]), "terms": retrieval_terms(g or topic)})
            if g:
                made[-1] |= {"secondary_topic_id": g["secondary_topic_id"], "secondary_topic_label": g["label"]}
        return made if made and all(b["terms"] for b in made) else None

    groups = []
    if relaxed and (b := blocks({}, "title")):
        groups.append({"group_id": "tier_0_title", "tier": 0, "priority": 0, "goal": GOAL, "queries": [_query(0, "tier_0_all_main_title", "strict_title", False, b)]})
    for tier in range(len(options) + 1):
        queries = []
        for topics in combinations(options, tier):
            for chosen in product(*(options[t] for t in topics)):
                if b := blocks({g["main_topic_id"]: g for g in chosen}):
                    parts = "__".join(f"{_part(g['main_topic_id'])}_with_{_part(g['secondary_topic_id'])}" for g in chosen)
                    name = f"tier_{tier}_replace_{parts}" if tier else "tier_0_all_main"
                    queries.append(_query(tier, name, "secondary" if tier else "field_relaxed", bool(tier) or relaxed, b, chosen))
        if queries:
            groups.append({"group_id": f"tier_{tier}", "tier": tier, "priority": tier + relaxed, "goal": GOAL, "queries": queries})
    if not groups:
        return {}
    return {"mode": "tiered_topic_blocks", "target_max_results": most, "iterations_per_group": rounds, "retrieval_terms_per_topic_limit": MOST_RETRIEVAL_TERMS, "query_groups": groups}


def review_queries(contract: dict) -> list[str]:
    """The contract's search queries, leaning towards reviews; else its title."""
    asked = (contract.get("collection") or {}).get("search_queries") or []
    texts = [str((q.get("query") if isinstance(q, dict) else q) or "").strip() for q in asked]
    texts = [t for t in texts if t] or [contract["research_topic"]["title"]]
    texts = [t if any(w in t.lower() for w in REVIEW_WORDS) else f"{t} review overview" for t in texts]
    return list({t.lower(): t for t in reversed(texts)}.values())[::-1]
