"""What can be told about a regular expression from how it is written."""

from __future__ import annotations

import re

_QUANTIFIER = re.compile(r"[?*+]|\{\d*,?\d*\}")


def alternatives(pattern: str) -> list[str]:
    """The pattern split at every ``|`` that is in no group or class."""
    parts, depth, inside, i = [""], 0, False, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            parts[-1] += pattern[i : i + 2]
            i += 2
            continue
        if inside:
            inside = c != "]"
        elif c == "[":
            inside = True
        elif c in "()":
            depth += 1 if c == "(" else -1
        if c == "|" and not depth and not inside:
            parts.append("")
        else:
            parts[-1] += c
        i += 1
    return parts


def _end_of_group(pattern: str, start: int) -> int:
    depth, i, inside = 0, start, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif inside:
            inside = c != "]"
        elif c == "[":
            inside = True
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if not depth:
                return i
        i += 1
    raise ValueError(f"open group in {pattern!r}")


def literals(pattern: str) -> list[tuple[str, bool, bool]]:
    """(text, opens, closes): word characters that every match of an alternative holds in a row.

    ``opens`` and ``closes`` tell that a word begins and ends with them.  What is not understood
    counts as a gap, so a literal may be missed but is never wrong.
    """
    out: list[tuple[str, bool, bool]] = []
    run, opens, edge, i = "", False, False, 0

    def end(closes: bool) -> None:
        nonlocal run, edge
        if run:
            out.append((run.lower(), opens, closes))
        run, edge = "", closes

    while i < len(pattern):
        c, step = pattern[i], 1
        if c == "(":
            stop = _end_of_group(pattern, i)
            behind = _QUANTIFIER.match(pattern, stop + 1)
            head = re.match(r"\((?:\?(?:-?[a-z]+)?:)?(?!\?)", pattern[i:])
            body = pattern[i + head.end() : stop] if head else ""
            if head and not behind and len(alternatives(body)) == 1:
                pattern = pattern[:i] + body + pattern[stop + 1 :]
                continue
            end(False)
            i = behind.end() if behind else stop + 1
            continue
        if c == "[":
            stop = pattern.index("]", i + 2)
            plain = re.fullmatch(r"[^\w^\\]+|\\[-./]", pattern[i + 1 : stop]) is not None
            step = stop + 1 - i
            kind = "apart" if plain else "gap"
        elif c == "\\":
            step, escaped = 2, pattern[i + 1]
            kind = {"b": "border", "s": "apart", "W": "apart"}.get(escaped, "gap")
            if not escaped.isalnum():
                kind = "apart"
        elif c in "^$":
            kind = "border"
        elif c == ".":
            kind = "gap"
        else:
            kind = "letter" if c.isalnum() or c == "_" else "apart"
        i += step
        behind = _QUANTIFIER.match(pattern, i) if kind != "border" else None
        if behind:
            i = behind.end() + (pattern[behind.end() : behind.end() + 1] in ("?", "+"))
            if behind[0] != "+":
                end(False)
                continue
        if kind == "letter":
            if not run:
                opens = edge
            run += c
            if behind:
                end(False)
        elif kind == "gap":
            end(False)
        else:
            end(True)
    end(False)
    return out
