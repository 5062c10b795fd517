"""The YAML that configurations are written in: nested mappings and lists by indentation, scalars, flow lists, block texts.

Anchors, tags, several documents and complex keys are not read: they are an
error, as are repeated keys.
"""

from __future__ import annotations

import json
import re

_KEY = re.compile(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s#&*!|>%@`'"\[\]{},-][^#]*?|-[^\s#][^#]*?)\s*:(?:\s+(.*))?$""")
_WORDS = {"true": True, "false": False, "yes": True, "no": False, "on": True, "off": False, "null": None, "~": None, "": None}


def parsed(text: str):
    """The value of a document; None for an empty one."""
    lines = [(len(x) - len(x.lstrip(" ")), x.strip(), x) for x in text.splitlines() if x.strip() not in ("---",)]
    at, value = _block(lines, _next(lines, 0), 0)
    if _next(lines, at) < len(lines):
        raise ValueError("YAML: can't read " + lines[_next(lines, at)][1][:60])
    return value


def _next(lines: list, at: int) -> int:
    """The next line that says something."""
    while at < len(lines) and (not lines[at][1] or lines[at][1].startswith("#")):
        at += 1
    return at


def _bare(text: str) -> str:
    """A line without the comment behind it."""
    found = re.match(r"""((?:"(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^#"']|(?<=\S)["'#])*)""", text)
    return found[0].rstrip()


def _block(lines: list, at: int, least: int):
    if at >= len(lines) or lines[at][0] < least:
        return at, None
    depth, text, _ = lines[at]
    if text == "-" or text.startswith("- "):
        return _list(lines, at, depth)
    if _KEY.match(_bare(text)):
        return _mapping(lines, at, depth)
    return at + 1, scalar(_bare(text))


def _list(lines: list, at: int, depth: int):
    found = []
    while at < len(lines) and lines[at][0] == depth and (lines[at][1] == "-" or lines[at][1].startswith("- ")):
        rest = lines[at][1][1:].lstrip()
        if not _bare(rest):
            at, value = _block(lines, _next(lines, at + 1), depth + 1)
        else:  # what follows the dash is a line of its own, further in
            inner = depth + len(lines[at][1]) - len(rest)
            lines[at] = (inner, rest, " " * inner + rest)
            if _KEY.match(_bare(rest)) or rest.startswith("- "):
                at, value = _block(lines, at, inner)
            else:
                at, value = _value(lines, at, rest, depth)
        found.append(value)
        at = _next(lines, at)
    return at, found


def _mapping(lines: list, at: int, depth: int):
    found: dict = {}
    while at < len(lines) and lines[at][0] == depth:
        told = _KEY.match(_bare(lines[at][1]))
        if not told:
            raise ValueError("YAML: no key in " + lines[at][1][:60])
        key = scalar(told[1])
        if key in found:
            raise ValueError(f"YAML: the key {key} stands twice")
        rest = (told[2] or "").strip()
        if rest:
            at, found[key] = _value(lines, at, rest, depth)
        else:
            nxt = _next(lines, at + 1)
            # a list may stand as far in as its key
            same = nxt < len(lines) and lines[nxt][0] == depth and (lines[nxt][1] == "-" or lines[nxt][1].startswith("- "))
            at, found[key] = _list(lines, nxt, depth) if same else _block(lines, nxt, depth + 1)
        at = _next(lines, at)
    return at, found


def _value(lines: list, at: int, rest: str, depth: int):
    if rest[0] in "&*!%@`" or rest.startswith("? "):
        raise ValueError("YAML: can't read " + rest[:60])
    if re.fullmatch(r"[|>][+-]?", _bare(rest)):
        style, body, at = _bare(rest), [], at + 1
        while at < len(lines) and (not lines[at][1] or lines[at][0] > depth):
            body.append(lines[at][2])
            at += 1
        inner = min((len(x) - len(x.lstrip(" ")) for x in body if x.strip()), default=0)
        body = [x[inner:].rstrip() if x.strip() else "" for x in body]
        while body and not body[-1]:
            body.pop()
        text = "\n".join(body) if style[0] == "|" else re.sub(r"(?<=\S)\n(?=\S)", " ", "\n".join(body))
        return at, text if style.endswith("-") else text + "\n" * bool(body)
    text, at = _bare(rest), at + 1
    while (text[0] in "[{" and not _closed(text)) or (text[0] not in "[{\"'" and at < len(lines) and lines[at][1] and not lines[at][1].startswith("#") and lines[at][0] > depth):
        if at >= len(lines):
            raise ValueError("YAML: not closed: " + text[:60])
        text, at = f"{text} {_bare(lines[at][1])}", at + 1
    return at, scalar(text)


def _closed(text: str) -> bool:
    plain = re.sub(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*')""", "", text)
    return sum(plain.count(c) for c in "[{") <= sum(plain.count(c) for c in "]}")


def scalar(text: str):
    """A scalar or a flow list or mapping."""
    text = text.strip()
    if text[:1] in ("[", "{"):
        if text[-1] != {"[": "]", "{": "}"}[text[0]]:
            raise ValueError("YAML: not closed: " + text[:60])
        parts = _parts(text[1:-1])
        if text[0] == "[":
            return [scalar(p) for p in parts]
        pairs = [p.partition(":") for p in parts]
        return {scalar(k): scalar(v) for k, _, v in pairs}
    if text[:1] == '"':
        return json.loads(text)
    if text[:1] == "'":
        return text[1:-1].replace("''", "'")
    if text.lower() in _WORDS:
        return _WORDS[text.lower()]
    if re.fullmatch(r"[-+]?[0-9]+", text):
        return int(text)
    if re.fullmatch(r"[-+]?(?:[0-9]+\.[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?", text):
        return float(text)
    return text


def _parts(text: str) -> list[str]:
    """Parts between commas outside of quotes and brackets; an empty last one goes."""
    parts, depth = [""], 0
    for token in re.findall(r""""(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|.""", text, re.S):
        depth += (token in "[{") - (token in "]}") if len(token) == 1 else 0
        if token == "," and not depth:
            parts.append("")
        else:
            parts[-1] += token
    return [p for p in map(str.strip, parts) if p]
