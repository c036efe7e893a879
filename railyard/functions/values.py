"""Plain functions on values, for the few operators that need Python."""

from __future__ import annotations

import ast
import json
import math
import re


def normal_value(v):
    """Booleans stay, numbers and numeric texts become floats, texts are trimmed, containers are walked."""
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", float(v)) if math.isfinite(v) else ("s", str(v))
    if isinstance(v, str):
        t = v.strip()
        if t.lower() in ("true", "false"):
            return ("b", t.lower() == "true")
        if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", t):
            return ("n", float(t))
        return ("s", t)
    if isinstance(v, dict):
        return ("o", tuple(sorted((k, normal_value(x)) for k, x in v.items())))
    if isinstance(v, list):
        return ("a", tuple(normal_value(x) for x in v))
    return ("z",)


def json_object(text: str | None) -> dict:
    """The object, or an empty one for anything else."""
    try:
        v = json.loads(text) if text else {}
    except (ValueError, RecursionError):
        return {}
    return v if isinstance(v, dict) else {}


def normal_call(name: str, arguments: str | None) -> tuple[str, dict]:
    return name, {k: normal_value(v) for k, v in json_object(arguments).items()}


def call_match(gold: tuple[str, dict], got: tuple[str, dict], same_keys: bool) -> bool:
    missing = ("z",)
    if gold[0] != got[0] or any(got[1].get(k, missing) != v for k, v in gold[1].items()):
        return False
    return not same_keys or gold[1].keys() == got[1].keys()


def bag_match(gold: list, got: list, same_keys: bool) -> bool:
    """Each gold call takes the first free call that fits; all must find one, none may be left."""
    free = list(got)
    for g in gold:
        for i, c in enumerate(free):
            if call_match(g, c, same_keys):
                del free[i]
                break
        else:
            return False
    return not free


def canonical_json(text: str | None) -> str | None:
    """Sorted keys, no blanks, letters as they are; null for what is no JSON."""
    try:
        return json.dumps(json.loads(text), sort_keys=True, ensure_ascii=False, separators=(",", ":")) if text is not None else None
    except (ValueError, RecursionError):
        return None


def leading_array(text: str) -> list | None:
    """The JSON array a text begins with (after other words), whatever follows it."""
    at = text.find("[")
    while at >= 0:
        try:
            v, _ = json.JSONDecoder().raw_decode(text, at)
        except (ValueError, RecursionError):
            v = None
        if isinstance(v, list):
            return v
        at = text.find("[", at + 1)
    return None


def leaf_strings(v, least: int = 0) -> list[str]:
    """All texts inside nested values, in order."""
    if isinstance(v, str):
        return [v] if len(v) >= least else []
    if isinstance(v, dict):
        v = list(v.values())
    return [s for x in v for s in leaf_strings(x, least)] if isinstance(v, list) else []


def leaf_numbers(v) -> list[float]:
    """All numbers inside nested lists and objects, in order; truth values are none."""
    if isinstance(v, bool):
        return []
    if isinstance(v, (int, float)):
        return [v]
    inside = list(v.values()) if isinstance(v, dict) else v if isinstance(v, list) else []
    return [n for x in inside for n in leaf_numbers(x)]


def without_null_branch(parameters: dict) -> dict:
    """A parameter schema whose properties have one type: of alternatives the first that is not null, its keys beside those already there."""

    def flat(prop: dict) -> dict:
        if not prop.get("anyOf"):
            return {k: v for k, v in prop.items() if k != "anyOf"}
        branches = prop["anyOf"]
        chosen = next((b for b in branches if b.get("type") != "null"), branches[0])
        return chosen | {k: v for k, v in prop.items() if k != "anyOf"}

    return parameters | {"properties": {name: flat(p) for name, p in (parameters.get("properties") or {}).items()}}


def function_definition(tool: dict) -> dict:
    """A tool definition in the wrapped dialect: type function around name, description and parameters of type object."""
    parameters = dict(tool.get("parameters") or {"type": "object", "properties": {}})
    if parameters.get("type") == "dict":
        parameters["type"] = "object"
    return {"type": "function", "function": {"name": tool.get("name", ""), "description": tool.get("description", ""), "parameters": parameters}}


def scored(score, messages: str | list | None, *more) -> dict[str, float]:
    """The numbers of score(messages, ...), which may be given as JSON; never raises: what cannot be read or scored has score 0."""
    try:
        rows = json.loads(messages) if isinstance(messages, str) else messages or []
    except (ValueError, RecursionError):
        rows = []
    try:
        found = score(rows, *more)
    except Exception:  # noqa: BLE001 - a reward must not end a run
        found = {}
    return {"score": 0.0} | {k: float(v) for k, v in found.items() if isinstance(v, (int, float))}


def split_outside(text: str, mark: str = ",") -> list[str]:
    """Parts between marks that stand outside brackets and quotes."""
    parts, depth, quote, begin, escaped = [], 0, "", 0, False
    for i, c in enumerate(text):
        if quote:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == quote:
                quote = ""
        elif c in "'\"":
            quote = c
        elif c in "([{":
            depth += 1
        elif c in ")]}":
            depth -= 1
        elif c == mark and depth == 0:
            parts.append(text[begin:i])
            begin = i + 1
    parts.append(text[begin:])
    return [p.strip() for p in parts if p.strip()]


def literal(text: str):
    """A literal in either notation; anything else stays text."""
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        pass
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return text


def bracket_calls(text: str) -> list[tuple[str, str]] | None:
    """Calls of the form ``[name(key=value, ..), ..]`` as (name, arguments json); null for anything else.

    A name is what stands before the first parenthesis.
    """
    t = text.strip()
    if not (t.startswith("[") and t.endswith("]")):
        return None
    out = []
    for part in split_outside(t[1:-1]):
        name, opened, rest = part.partition("(")
        if not opened or not rest.endswith(")"):
            return None
        arguments = {}
        for pair in split_outside(rest[:-1]):
            key, eq, value = pair.partition("=")
            if not eq or not key.strip():
                return None
            arguments[key.strip()] = literal(value.strip())
        try:
            out.append((name.strip(), json.dumps(arguments, sort_keys=True, ensure_ascii=False, default=str)))
        except (TypeError, ValueError):
            return None
    return out


_TAGGED = re.compile(r"<tool_call>\s*(.*?)\s*</tool_call>", re.S)
_FUNCTION = re.compile(r"<function=([^>\s]+)>(.*?)</function>", re.S)
_PARAMETER = re.compile(r"<parameter=([^>\s]+)>\s*(.*?)\s*</parameter>", re.S)
_FENCED = re.compile(r"```(?:json)?\s*(\{.*?\}|\[.*?\])\s*```", re.S)


def _from_json(v) -> list[tuple[str, str]]:
    found = []
    for x in v if isinstance(v, list) else [v]:
        if not isinstance(x, dict):
            continue
        f = x.get("function") if isinstance(x.get("function"), dict) else x
        name, arguments = f.get("name"), f.get("arguments", f.get("parameters", {}))
        if isinstance(name, str):
            if isinstance(arguments, str):
                arguments = json_object(arguments)
            found.append((name, json.dumps(arguments if isinstance(arguments, dict) else {}, sort_keys=True, ensure_ascii=False)))
    return found


def text_calls(text: str | None) -> tuple[list[tuple[str, str]], int]:
    """Tool calls in a model's text and the characters after the last tagged block.

    In this order: tagged blocks (JSON or function form), function form alone, a fenced JSON block, a bare
    JSON text, the bracket form. The first form that gives a call holds.
    """
    if not text:
        return [], 0
    calls, end = [], 0
    for m in _TAGGED.finditer(text):
        end = m.end()
        inner = _FUNCTION.search(m[1])
        if inner:
            calls.append((inner[1], json.dumps({p[1]: literal(p[2]) for p in _PARAMETER.finditer(inner[2])}, sort_keys=True, ensure_ascii=False, default=str)))
        else:
            try:
                calls += _from_json(json.loads(m[1]))
            except (ValueError, RecursionError):
                pass
    if calls:
        return calls, len(text[end:].strip())
    for m in _FUNCTION.finditer(text):
        calls.append((m[1], json.dumps({p[1]: literal(p[2]) for p in _PARAMETER.finditer(m[2])}, sort_keys=True, ensure_ascii=False, default=str)))
    if calls:
        return calls, 0
    for candidate in [*(m[1] for m in _FENCED.finditer(text)), text.strip()]:
        try:
            calls += _from_json(json.loads(candidate))
        except (ValueError, RecursionError):
            continue
    return (calls, 0) if calls else (bracket_calls(text) or [], 0)


def segments(text: str | None) -> list[tuple[int, str, str, str | None]]:
    """An episode's text as (pos, role, content, call id).

    Where several calls wait for answers, the first answer serves all of them and further ones are dropped; this
    is how the format is defined.
    """
    out: list[tuple[int, str, str, str | None]] = []
    waiting: list[str] = []
    n = 0
    for m in re.finditer(r"<\|(system|user|assistant|tool)\|>(.*?)(?=<\|(?:system|user|assistant|tool)\|>|\Z)", text or "", re.S):
        role, content = m[1], m[2].strip()
        if role == "tool":
            for call in waiting:
                out.append((len(out), role, content, call))
            waiting = []
            continue
        out.append((len(out), role, content, None))
        if role == "assistant":
            found, _ = text_calls(content)
            waiting = [f"call_{n + i + 1}" for i in range(len(found))]
            n += len(found)
    return out


def span_mask(tokens: list[int], opening: list[int], closing: int, last_user_end: int) -> list[int]:
    """Labels: tokens of the spans that begin after ``opening`` and end with ``closing``, past the last user turn; -100 elsewhere."""
    labels = [-100] * len(tokens)
    i = max(0, last_user_end)
    while i <= len(tokens) - len(opening):
        if tokens[i : i + len(opening)] == opening:
            i += len(opening)
            while i < len(tokens):
                labels[i] = tokens[i]
                i += 1
                if tokens[i - 1] == closing:
                    break
        else:
            i += 1
    return labels
