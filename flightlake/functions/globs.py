"""Path patterns as regular-expression filters, so they run inside the scan stage."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\[!?\]?[^\]]*\]|\*+|\?|[^*?\[]+|\[")


def _to_regex(pattern: str, star: str, single: str) -> str:
    parts = []
    for token in _TOKEN.findall(pattern):
        if token[0] == "*":
            parts.append(star)
        elif token == "?":
            parts.append(single)
        elif token[0] == "[" and len(token) > 2:
            body = token[1:-1].replace("\\", "\\\\").replace("[", "\\[").replace("&", "\\&")
            body = "^" + body[1:] if body.startswith("!") else body
            parts.append(f"[{body}]")
        else:
            parts.append(re.escape(token))
    return "^(?s:" + "".join(parts) + ")$"


def exclude_regex(pattern: str) -> str:
    """Shell-style match on the whole path: ``*`` also crosses folders."""
    return _to_regex(pattern, ".*", ".")


def wildcard_regexes(pattern: str) -> list[str]:
    """Regexes of which any may match.

    Without ``**`` a star stays inside one folder level.  From the level that
    holds ``**`` on, stars cross folders, and ``**/`` may stand for no folder.
    """
    if "**" not in pattern:
        return [_to_regex(pattern, "[^/]*", "[^/]")]
    levels = pattern.split("/")
    first = next(i for i, level in enumerate(levels) if "**" in level)
    head, tail = "/".join(levels[:first]), "/".join(levels[first:])
    tails = {tail}
    if "/**/" in tail:
        tails.add(tail.replace("/**/", "/"))
    for form in list(tails):
        if form.startswith("**/"):
            tails.add(form.removeprefix("**/"))
    prefix = _to_regex(head + "/", "[^/]*", "[^/]")[5:-2] if head else ""
    return [
        "^(?s:" + prefix + _to_regex(form, ".*", ".")[5:] for form in sorted(tails)
    ]


def matches_wildcard(path: Column, pattern: str) -> Column:
    return F.coalesce(path.rlike("|".join(wildcard_regexes(pattern))), F.lit(False))


def matches_any(path: Column, patterns: list[str]) -> Column:
    """True when the whole path matches one of the shell-style patterns."""
    if not patterns:
        return F.lit(False)
    return path.rlike("|".join(exclude_regex(p) for p in patterns))
