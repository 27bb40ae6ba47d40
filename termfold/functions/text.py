"""Column functions for attributes of the form ``head^part^part``.

Text compares without regard to case and trailing blanks: ``norm`` gives the key
for equality, membership and grouping. Patterns ignore case but not blanks.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

HAT = "^"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: Column | str) -> Column:
    """Comparison key: lower case, no trailing blanks."""
    return F.lower(F.rtrim(col(c)))


def norm_text(text: str) -> str:
    """``norm`` for a driver-side constant."""
    return text.rstrip(" ").lower()


def blank(c: Column | str) -> Column:
    """True for NULL, empty and all-blank text; never NULL."""
    return norm(F.coalesce(col(c), F.lit(""))) == ""


def head(c: Column | str) -> Column:
    """Text before the first ``^``; the whole text without one."""
    return F.substring_index(col(c), HAT, 1)


def suffix(c: Column | str) -> Column:
    """Text from the first ``^`` on, else ''.

    At most as many characters as the text has without its trailing blanks.
    """
    c = col(c)
    return F.substring(c, F.length(head(c)) + 1, F.length(F.rtrim(c)))


def regroup(group: Column | str, c: Column | str) -> Column:
    """The group name in place of the head, sub-parts kept."""
    group = F.lit(group) if isinstance(group, str) else group
    return F.concat(group, suffix(c))


def like_regex(pattern: str) -> str:
    """Regular expression for a LIKE pattern with ``%``, ``_`` and ``[set]``."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        close = pattern.find("]", i + 1) if ch == "[" else -1
        if ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif close > 0:
            members = pattern[i + 1:close]
            negated = members.startswith("^")
            members = re.sub(r"([\\\[\]&^])", r"\\\1", members[negated:])
            out.append("[" + ("^" if negated else "") + members + "]")
            i = close
        else:
            out.append(re.sub(r"([^\w\s])", r"\\\1", ch))
        i += 1
    return r"(?is)\A" + "".join(out) + r"\z"


def like(c: Column | str, pattern: str) -> Column:
    """Case-insensitive LIKE; bracket sets go through a regular expression."""
    if "[" in pattern:
        return col(c).rlike(like_regex(pattern))
    return col(c).ilike(pattern.replace("\\", "\\\\"))


def like_any(c: Column | str, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [like(c, p) for p in patterns])


def one_of(c: Column | str, values: list[str]) -> Column:
    """Membership under ``norm``."""
    return norm(c).isin(sorted({norm_text(v) for v in values}))


def class_key(columns: list[str]) -> Column:
    """Values joined with ``|``; NULL counts as empty text."""
    parts = ", ".join(f"coalesce(CAST(`{c}` AS STRING), '')" for c in columns)
    return F.expr(f"concat_ws('|', {parts})")


def revised_name(source: str) -> str:
    """Name of the coarsened copy of an attribute: METHOD_TYP -> METHOD_REV."""
    return re.sub(r"_(TYP|ASPCT)$", "", source) + "_REV"


def working_name(class_value: str) -> str:
    """Class value usable as a table or directory name: HEM/BC -> HEMBC."""
    return class_value.replace("/", "")
