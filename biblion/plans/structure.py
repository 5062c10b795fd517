"""Weak topic structures of a contract: concepts that are merged, buried, misplaced or too broad.

Topics are compared by their words.  Rules are tables of a code and a test, of
topics, of terms, and of groups that stand in for a topic; a few compare the
structure with the description that it was made from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

from biblion.operators.matching import secondary_groups
from biblion.plans.contract import label_of

# They must be these for the results to be right.
CONNECTORS = ["and", "in", "for", "with", "using", "use of", "impact on", "effect on", "effects on", "outcomes in"]
ROLE_WORDS = {"area", "context", "domain", "family", "focus", "outcome", "setting", "target", "topic"}
STOPWORDS = {"and", "for", "from", "into", "the", "use", "using", "with"}
GENERIC_TERMS = {
    "area", "areas", "context", "contexts", "digital technologies", "digital technology", "domain", "domains", "edtech", "education", "educational context",
    "educational contexts", "educational setting", "educational settings", "educational technologies", "educational technology", "field", "fields", "learning",
    "learning environment", "learning environments", "method", "methods", "outcome", "outcomes", "performance metric", "performance metrics", "population",
    "populations", "research", "setting", "settings", "student outcomes", "students", "studies", "study", "technologies", "technology", "tool", "tools", "topic", "topics",
}
UMBRELLA_TERMS = {"analysis", "approach", "condition", "data analysis", "disease", "disorder", "method", "neurological disorder", "research", "science", "technology"}
UMBRELLA_WORDS = {"abilities", "ability", "behavior", "behaviors", "cognition", "cognitive", "effect", "effects", "function", "functions", "impact", "impacts", "outcome", "outcomes", "performance"}
PLACE_WORDS = {
    "classroom", "classrooms", "communities", "community", "context", "contexts", "environment", "environments", "hospital", "hospitals", "patient", "patients",
    "population", "populations", "school", "schools", "setting", "settings", "workplace", "workplaces",
}
DETAIL_WORDS = {
    "adoption", "calibration", "deployment", "evaluation", "evidence", "explanation", "explanatory", "feasibility", "implementation", "integration", "mechanism",
    "mechanisms", "mechanistic", "mediation", "mediator", "mediators", "metric", "metrics", "moderation", "moderator", "moderators", "pathway", "pathways", "process",
    "processes", "protocol", "protocols", "signal", "signals", "threshold", "thresholds", "usability", "validation", "workflow", "workflows",
}
METHOD_WORDS = {"analysis", "approach", "approaches", "computational", "method", "methods", "model", "modeling", "modelling", "models", "technique", "techniques"}
METHOD_SUBTYPES = {
    "a.i.", "ai", "algorithm", "algorithm development", "algorithms", "artificial intelligence", "bioinformatics", "classification", "computational biology",
    "computational genomics", "computational modeling", "deep learning", "ensemble learning", "machine learning", "mathematical modeling", "ml", "modeling",
    "network analysis", "predictive modeling", "statistical modeling", "supervised learning", "systems biology", "unsupervised learning",
}
BARE_DOMAINS = {
    "amyloid plaques", "biomarker", "biomarkers", "cancer", "cognitive decline", "dementia", "gene expression", "genomics", "parkinson", "parkinson's disease",
    "parkinsons disease", "patient cohort", "patient cohorts", "tau tangles",
}
DISEASE_NAMES = {"ad", "alzheimer", "alzheimer disease", "alzheimer's disease", "alzheimers disease"}
DISEASE_FAMILY = DISEASE_NAMES | {
    "cognitive decline", "dementia", "dementia related cognitive impairment", "dementia-related cognitive impairment", "mci", "mild cognitive impairment",
    "preclinical ad", "preclinical alzheimer disease", "preclinical alzheimer's disease", "preclinical alzheimers disease", "preclinical disease",
    "prodromal ad", "prodromal alzheimer disease", "prodromal alzheimer's disease", "prodromal alzheimers disease", "prodromal disease",
}
DISEASE_PROCESSES = {"amyloid pathology", "amyloid plaque", "amyloid plaques", "memory loss", "neurodegeneration", "tau pathology", "tau tangles"}
NOT_OF_GROUP = {
    "parkinsons disease": {"movement disorder", "movement disorders"},
    "experimental methods": {"clinical trial", "clinical trials", "data collection", "experimental design", "experimental designs"},
}
VAGUE_GROUPS = {"adjacent diseases", "dementia types", "disease types", "neurodegenerative diseases", "neurodegenerative disorders", "other diseases", "related diseases"}
VAGUE_TERMS = {"cognitive impairments", "dementia types", "disease types", "diseases", "neurodegenerative diseases", "neurodegenerative disorders", "other diseases", "related diseases"}
CRITERIA = {"eco", "ecological", "environment", "environmental", "green", "renewable", "sustainability", "sustainable"}
GENERIC_USES = {"advanced", "innovation", "innovations", "innovative", "novel", "science", "technology"}
PROCESSES = {
    "approach", "approaches", "efficiency", "efficient", "impact", "impacts", "improvement", "improvements", "innovation", "innovations", "integrity", "method",
    "methods", "performance", "practice", "practices", "process", "processes", "strategies", "strategy", "technique", "techniques",
}
MATERIALS = {"based", "bio", "biodegradable", "biomaterial", "biomaterials", "bioplastic", "bioplastics", "hybrid", "material", "materials"}
REPLACING = {"alternative", "alternatives", "replace", "replacement", "replacements", "substitute", "substitutes", "substitution"}
COMPARED = {"alternative", "alternatives", "application", "applications", "comparator", "concrete", "material", "materials", "replace", "replacement", "replacements", "substitute", "substitutes"}
COVERS_COMPARED = {"alternative", "alternatives", "comparator", "concrete", "replace", "replacement", "replacements", "substitute", "substitutes"}
INSTEAD = ["instead of", "replace", "replaces", "replacing", "replacement for", "substitute for", "alternative to"]
TARGET_STOPWORDS = {"a", "an", "and", "application", "applications", "area", "areas", "case", "cases", "certain", "for", "in", "of", "some", "the", "to", "use", "uses", "with"}
USE_QUALIFIERS = {"architectural", "building", "classroom", "clinical", "construction", "educational", "housing", "industrial", "medical", "school", "structural", "workplace"}
USE_HEADS = {"application", "applications", "context", "contexts", "environment", "environments", "lesson", "lessons", "material", "materials", "practice", "practices", "product", "products", "setting", "settings"}
SOURCE_STOPWORDS = {"a", "an", "and", "as", "be", "could", "for", "in", "of", "the", "to", "use", "used", "using", "with"}
SOURCE_MODIFIERS = {"chronic", "environmental", "green", "renewable", "sustainable"}
PAIR_STOPWORDS = {"a", "an", "and", "effect", "effects", "for", "impact", "impacts", "in", "its", "of", "on", "research", "the", "their", "to", "use", "using", "with"}
SURFACE_FORMS = [
    ("artificial intelligence", {"ai", "a.i."}, {"artificial intelligence"}),
    ("machine learning", {"ml"}, {"machine learning"}),
    ("large language models", {"llm", "llms"}, {"large language model", "large language models"}),
    ("Alzheimer's disease", {"ad"}, {"alzheimer disease", "alzheimer's disease"}),
    ("mild cognitive impairment", {"mci"}, {"mild cognitive impairment"}),
    ("electroencephalography", {"eeg"}, {"electroencephalography"}),
    ("magnetic resonance imaging", {"mri"}, {"magnetic resonance imaging"}),
    ("positron emission tomography", {"pet"}, {"positron emission tomography"}),
    ("electronic health records", {"ehr", "ehrs"}, {"electronic health record", "electronic health records"}),
]
LEAST_TERMS = 4
CRUCIAL = {
    "abstract_only_main_topic_field", "anchor_field_not_title", "application_secondary_criterion_term", "application_topic_criterion_term",
    "criterion_topic_instead_of_comparator", "cross_topic_retrieval_term", "cross_topic_term", "disease_research_anchor_expected",
    "explicit_pair_buried_in_umbrella_topic", "generic_secondary_topic_bucket", "generic_secondary_topic_term", "main_topic_non_family_term", "merged_topic_id",
    "merged_topic_label", "missing_secondary_topic", "non_exception_topic_field_not_title", "parent_secondary_term_overlap",
    "replacement_application_not_main_topic", "replacement_secondary_application_term", "replacement_secondary_criterion_term",
    "replacement_secondary_foreign_component_term", "replacement_secondary_material_family_term", "replacement_target_not_main_topic",
    "replacement_topic_application_term", "replacement_topic_criterion_term", "replacement_topic_foreign_component_term",
    "replacement_topic_material_family_term", "secondary_topic_non_family_term", "source_anchor_expected",
}
LISTS = ("terms", "retrieval_terms", "matching_terms")


@dataclass(frozen=True)
class Issue:
    code: str
    topic_id: str = ""
    value: str = ""

    @property
    def crucial(self) -> bool:
        return self.code in CRUCIAL


def words(value: object) -> set[str]:
    """Words that count in a comparison, singulars beside plurals."""
    found = set()
    for w in re.findall("[a-z0-9]+", str(value or "").casefold()):
        if w in ("ai", "ml"):
            found.add(w)
        elif len(w) >= 3 and w not in STOPWORDS:
            found |= {w} | ({w[:-1]} if len(w) > 3 and w.endswith("s") else set()) | ({"education"} if w == "educational" else set())
    return found


def plain(value: object) -> str:
    return " ".join(str(value or "").casefold().replace("_", " ").split())


def materials(found: set[str]) -> bool:
    """Words of a family of materials, "material" alone aside."""
    return bool((found & MATERIALS) - {"material", "materials"})


@dataclass(frozen=True)
class View:
    """A topic, or a group that stands in for one, by its words."""

    topic_id: str
    raw: dict = field(hash=False)

    @property
    def field(self) -> str:
        return str(self.raw.get("field") or "title").strip()

    @property
    def label(self) -> str:
        return str(self.raw.get("label") or "").strip()

    @cached_property
    def terms(self) -> list[tuple[str, str]]:
        """(list, term) of each term that isn't empty."""
        return [(k, str(t).strip()) for k in LISTS if isinstance(self.raw.get(k), list) for t in self.raw[k] if str(t or "").strip()]

    @cached_property
    def named(self) -> set[str]:
        return words(f"{self.topic_id} {self.label}")

    @cached_property
    def core(self) -> set[str]:
        return self.named - ROLE_WORDS

    @cached_property
    def component(self) -> set[str]:
        """The words of its name and of its plain terms."""
        return self.named.union(*(words(t) for k, t in self.terms if k == "terms"))

    @cached_property
    def text(self) -> set[str]:
        return self.named.union(*(words(t) for _, t in self.terms))

    @cached_property
    def surface(self) -> set[str]:
        return {plain(t) for _, t in self.terms}

    @property
    def replaces(self) -> bool:
        return bool(self.named & REPLACING)

    @property
    def applies(self) -> bool:
        return bool(self.named & USE_QUALIFIERS and self.named & USE_HEADS)

    @property
    def is_method(self) -> bool:
        return bool(self.named & METHOD_WORDS)

    @property
    def is_disease(self) -> bool:
        return bool((self.surface | {plain(self.topic_id), plain(self.label)}) & DISEASE_NAMES)

    def allowed(self, targets: list[str]) -> set[str]:
        """What the terms of a topic of replacement may speak of."""
        found = self.named | REPLACING | set(targets)
        for one, other in (("concrete", "cement"), ("cement", "concrete")):
            if one in self.named | set(targets) | REPLACING:
                found.add(other)
        return found


# what a description names


def pairs(description: str) -> list[tuple[str, str]]:
    """Concepts on either side of an "and"."""
    tokens = re.findall(r"[A-Za-z][A-Za-z0-9'-]*", description.casefold())
    good = lambda t: t not in PAIR_STOPWORDS and len(t) >= 3
    found = []
    for i, t in enumerate(tokens):
        if t == "and":
            left, right = next(filter(good, reversed(tokens[:i])), ""), next(filter(good, tokens[i + 1 :]), "")
            if left and right and left != right:
                found.append((left, right))
    return list(dict.fromkeys(found))


def replaced(description: str) -> list[str]:
    """What a description asks to replace."""
    some = r"([a-z][a-z0-9'-]*(?:\s+[a-z][a-z0-9'-]*){0,2})"
    asked = [rf"\b(?:replace|replaces|replacing)\s+{some}", rf"\b(?:replacement|alternative|alternatives|substitute|substitutes)\s+(?:for|to)\s+{some}", rf"\binstead\s+of\s+{some}"]
    found = []
    for pattern in asked:
        for m in re.finditer(pattern, description.casefold()):
            # the first word of the phrase that says something
            said = [w for t in m[1].split() for w in sorted(words(t), key=len, reverse=True) if w not in TARGET_STOPWORDS and len(w) >= 3 and w not in found]
            found += said[:1]
    return found


def uses(description: str) -> list[tuple[str, set[str]]]:
    """Areas of use that a description names, such as building materials."""
    tokens = re.findall(r"[a-z][a-z0-9'-]*", description.casefold())
    found = {f"{a}_{b}": words(f"{a} {b}") for a, b in zip(tokens, tokens[1:], strict=False) if a in USE_QUALIFIERS and b in USE_HEADS}
    return [(k, w) for k, w in found.items() if len(w) >= 2]


def sources(description: str) -> list[set[str]]:
    """What a description asks to use."""
    some = r"([a-z][a-z0-9'-]*(?:\s+[a-z][a-z0-9'-]*){0,4})"
    asked = [rf"\b(?:could|can|should|may|might|would)\s+{some}\s+be\s+used\s+to\b", rf"\buse\s+of\s+{some}\b", rf"\busing\s+{some}\s+(?:to|for|in)\b"]
    found = []
    for pattern in asked:
        for m in re.finditer(pattern, description.casefold()):
            head = re.split(r"\b(?:as|for|in|into|of|on|to|with)\b", m[1])[0]
            said = {w for t in head.split() for w in words(t)} - SOURCE_STOPWORDS - SOURCE_MODIFIERS
            if said and said not in found:
                found.append(said)
    return found


# rules

#: Of a main topic alone: code, and what is wrong (its value), or None.
TOPIC_RULES = [
    ("anchor_field_not_title", lambda t, s: t.field if t.topic_id == s.anchor and t.field != "title" else None),
    ("abstract_only_main_topic_field", lambda t, s: t.field if t.field == "abstract" else None),
    ("context_topic_field_not_title", lambda t, s: t.field if t.topic_id != s.anchor and t.field != "title" and t.named & PLACE_WORDS else None),
    ("non_exception_topic_field_not_title", lambda t, s: t.field if t.topic_id != s.anchor and t.field == "title_or_abstract" and not t.named & DETAIL_WORDS else None),
    ("merged_topic_id", lambda t, s: t.topic_id if any(f"_{c.replace(' ', '_')}_" in label_of(t.topic_id) for c in CONNECTORS) else None),
    ("merged_topic_label", lambda t, s: t.label if " and " in f" {t.label.casefold()} " and "research and development" not in t.label.casefold() else None),
    ("too_few_main_topic_terms", lambda t, s: str(s.few(t)) if t.topic_id in s.rich and not t.replaces and s.few(t) < LEAST_TERMS else None),
]


def _foreign_use(w: set[str], allowed: set[str]) -> bool:
    return bool(w & USE_HEADS and (w & USE_QUALIFIERS or not (w & allowed) - REPLACING))


#: Of a term of a topic of replacement, and of one of use; the codes differ for main topics and groups.
REPLACEMENT_RULES = [
    ("material_family_term", lambda w, t, s: materials(w) and not w & t.allowed(s.targets)),
    ("criterion_term", lambda w, t, s: w & CRITERIA),
    ("foreign_component_term", lambda w, t, s: (w & s.other_core(t)) - t.allowed(s.targets)),
    ("application_term", lambda w, t, s: _foreign_use(w, t.allowed(s.targets))),
]
USE_RULES = [
    ("generic_term", lambda w: w & GENERIC_USES),
    ("process_or_property_term", lambda w: w & PROCESSES and not w & USE_HEADS),
    ("criterion_term", lambda w: w & CRITERIA),
]
#: Of any term of a main topic: list, term, words, topic, structure.
TERM_RULES = [
    ("generic_topic_term", lambda k, x, w, t, s: plain(x) in GENERIC_TERMS),
    ("main_topic_non_family_term", lambda k, x, w, t, s: t.is_disease and plain(x) in DISEASE_PROCESSES),
    ("method_topic_bare_domain_term", lambda k, x, w, t, s: t.is_method and plain(x) in BARE_DOMAINS),
    ("broad_umbrella_topic_term", lambda k, x, w, t, s: k != "matching_terms" and plain(x) in UMBRELLA_TERMS and not w & t.named),
    ("broad_material_family_term", lambda k, x, w, t, s: materials(w) and not w & t.component),
    ("cross_topic_retrieval_term", lambda k, x, w, t, s: k == "retrieval_terms" and w & s.other_core(t) and w & t.core),
    ("cross_topic_term", lambda k, x, w, t, s: any(f" {c} " in f" {x.casefold()} " for c in CONNECTORS) and w & s.other_component(t)),
]


class Structure:
    """The topics of a contract and what its description names."""

    def __init__(self, contract: dict, description: str = ""):
        raw = contract["topic_structure"]
        self.description, self.raw = description or "", raw
        self.topics = [View(str(t.get("topic_id") or "").strip(), t) for t in raw["main_topics"]]
        self.by_id = {t.topic_id: t for t in self.topics if t.topic_id}
        self.anchor = str(raw.get("anchor_topic_id") or "").strip()
        self.targets = replaced(self.description)
        self.sources = sources(self.description)
        # of each source the first topic that names it
        self.rich = {next((i for i, t in self.by_id.items() if s & t.core), "") for s in self.sources} - {""}
        self.core = set().union(*(t.core for t in self.by_id.values()))

    def other_core(self, t: View) -> set[str]:
        return set().union(*(o.core for i, o in self.by_id.items() if i != t.topic_id))

    def other_component(self, t: View) -> set[str]:
        return set().union(*(o.component for i, o in self.by_id.items() if i != t.topic_id))

    @staticmethod
    def few(t: View) -> int:
        return len({plain(x) for k, x in t.terms if k == "terms"})

    def of_description(self) -> Iterator[Issue]:
        for left, right in pairs(self.description):
            if {left, right} <= self.core:
                continue
            for i, t in self.by_id.items():
                if {left, right} <= t.text and t.core & UMBRELLA_WORDS:
                    yield Issue("explicit_pair_buried_in_umbrella_topic", i, f"{left} and {right}")
        said = words(self.description)
        compares = said & COMPARED or any(f" {p} " in f" {self.description.casefold()} " for p in INSTEAD)
        if self.description and compares and not self.core & COVERS_COMPARED and said & CRITERIA:
            yield from (Issue("criterion_topic_instead_of_comparator", i) for i, t in self.by_id.items() if t.core & CRITERIA)
        yield from (Issue("replacement_target_not_main_topic", "", x) for x in self.targets if x not in self.core)
        if self.targets:
            yield from (Issue("replacement_application_not_main_topic", "", name) for name, w in uses(self.description) if not any(w <= t.core for t in self.by_id.values()))
        anchor = self.by_id.get(self.anchor)
        disease = next((i for i, t in self.by_id.items() if t.is_disease), "")
        if disease and anchor and anchor.is_method and not anchor.is_disease:
            yield Issue("disease_research_anchor_expected", self.anchor, disease)
        for s in self.sources:
            if not s & (anchor.core if anchor else set()):
                yield from (Issue("source_anchor_expected", self.anchor, i) for i in [i for i, t in self.by_id.items() if i != self.anchor and s & t.core][:1])

    def of_topics(self) -> Iterator[Issue]:
        for t in self.topics:
            for code, rule in TOPIC_RULES:
                if (value := rule(t, self)) is not None:
                    yield Issue(code, t.topic_id, value)
            for name, short, full in SURFACE_FORMS:
                if bool(t.surface & short) != bool(t.surface & full):
                    yield Issue("missing_common_surface_form", t.topic_id, name)
            for key, term in t.terms:
                w = words(term)
                codes = [code for code, rule in TERM_RULES if rule(key, term, w, t, self)]
                codes += self._roles(t, w, "topic")
                yield from (Issue(code, t.topic_id, term) for code in codes)

    def _roles(self, t: View, w: set[str], kind: str) -> list[str]:
        found = [f"replacement_{kind}_{code}" for code, rule in REPLACEMENT_RULES if t.replaces and rule(w, t, self)]
        return found + [f"application_{kind}_{code}" for code, rule in USE_RULES if t.applies and rule(w)]

    def of_groups(self) -> Iterator[Issue]:
        having = set()
        for g in secondary_groups(self.raw):
            parent = self.by_id.get(g["main_topic_id"])
            if parent is None:
                continue
            i, own = parent.topic_id, View(g["secondary_topic_id"], g)
            having.add(i)
            names = [(k, str(g.get(k) or "").strip()) for k in ("secondary_topic_id", "label") if str(g.get(k) or "").strip()]
            for key, term in [*names, *own.terms]:
                w, named = words(term), key not in LISTS
                if named and plain(term) in VAGUE_GROUPS:
                    yield Issue("generic_secondary_topic_bucket", i, term)
                if not named and plain(term) in VAGUE_TERMS:
                    yield Issue("generic_secondary_topic_term", i, term)
                if not named and plain(term) in NOT_OF_GROUP.get(plain(own.topic_id), ()):
                    yield Issue("secondary_topic_non_family_term", i, term)
                yield from (Issue(code, i, term) for code in self._roles(parent, w, "secondary"))
                if parent.applies and materials(w) and not w & parent.core:
                    yield Issue("application_secondary_material_family_term", i, term)
            held = ({plain(x) for _, x in names} | own.surface) - {i, ""}
            if held & parent.surface:
                yield Issue("parent_secondary_term_overlap", i, own.topic_id)
            if parent.is_method and any(f" {m} " in f" {x} " for x in held for m in METHOD_SUBTYPES):
                yield Issue("secondary_topic_internal_subtype", i, own.topic_id)
            if parent.is_disease and held & DISEASE_FAMILY:
                yield Issue("secondary_topic_disease_family_variant", i, own.topic_id)
        yield from (Issue("missing_secondary_topic", i) for i in self.by_id if i not in having)


def issues(contract: dict, description: str = "") -> list[Issue]:
    """What is weak in a contract's topics, and against its description."""
    made = Structure(contract, description)
    return [*made.of_description(), *made.of_topics(), *made.of_groups()]


def checked(contract: dict, description: str = "") -> dict:
    """The contract; issues that no structure may have are an error."""
    if bad := [i for i in issues(contract, description) if i.crucial]:
        raise ValueError("; ".join(f"{i.code}: {i.topic_id} {i.value}".strip() for i in bad))
    return contract
