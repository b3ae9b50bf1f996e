"""Many patterns at once: one pass for the strings that they require, regular expressions on candidates only.

A pattern can only match where a string that it requires stands.  The required strings of
all patterns make one trie, written as a regular expression whose branches share no
first character: at a place of the text at most one branch is followed, whatever the
number of patterns, as an automaton would.  Only texts in which it finds something are tried
against the patterns themselves, and not even these if all patterns are plain strings.
Everything stays in the JVM.
"""

from __future__ import annotations

import re
from re import _constants as kind
from re import _parser as parser

from pyspark.sql import Column
from pyspark.sql import functions as F


def _literals(parsed) -> list[str]:
    """Strings of which every match of a sequence holds all, the longest first."""
    found, run = [], ""
    for op, value in [*parsed, (None, None)]:
        if op is kind.LITERAL:
            run += chr(value)
            continue
        if op is kind.AT:  # takes no place
            continue
        if run:
            found.append(run)
        run = ""
        if op is kind.SUBPATTERN and not value[1] and not value[2]:
            found += _literals(value[3])
        elif op in (kind.MAX_REPEAT, kind.MIN_REPEAT) and value[0] >= 1:
            found += _literals(value[2])
    return sorted(found, key=len, reverse=True)


def required(pattern: str) -> list[str] | None:
    """Strings of which each match of the pattern holds one; None if no such strings are known.

    Java's syntax is read by Python's parser where both mean the same; what that one does not know, and flags, make it None.
    """
    if re.search(r"\(\?[a-z-]|\\[QEpPhHRXGzZ]|&&|\[:|\[\^?\[|[*+?}]\+", pattern):
        return None
    try:
        parsed = parser.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return None
    parts = list(parsed)
    if len(parts) == 1 and parts[0][0] is kind.SUBPATTERN and not parts[0][1][1]:
        parts = list(parts[0][1][3])
    # alternatives have their common beginning before them
    branches = parts[-1][1][1] if parts and parts[-1][0] is kind.BRANCH and len(parts) == 1 else [parts]
    each = [next(iter(_literals(b)), None) for b in branches]
    return None if not each or any(x is None for x in each) else each


def is_plain(pattern: str) -> bool:
    """Whether the pattern is a string without any operator."""
    try:
        return all(op is kind.LITERAL for op, _ in parser.parse(pattern)) and required(pattern) is not None
    except (re.error, OverflowError, RecursionError):
        return False


def _quoted(text: str) -> str:
    return "".join(ch if ch.isalnum() or ch in "/_ " else f"\\{ch}" if ch.isascii() and ch.isprintable() else f"\\x{{{ord(ch):X}}}" for ch in text)


def trie(strings: list[str]) -> str:
    """A regular expression for any of the strings: branches by first character, ends where a string ends."""
    if "" in strings:
        return ""
    by: dict[str, list[str]] = {}
    for x in sorted(set(strings)):
        by.setdefault(x[0], []).append(x[1:])
    branches = []
    for first, rest in by.items():
        shared = first
        while "" not in rest and len({x[0] for x in rest}) == 1:  # a chain
            shared += rest[0][0]
            rest = [x[1:] for x in rest]
        branches.append(_quoted(shared) + trie(rest))
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def live(patterns: list[str]) -> list[str]:
    """The patterns without blanks around them, comments and empty lines."""
    return [p for p in (x.strip() for x in patterns) if p and not p.startswith("#")]


def matches(text: Column, patterns: list[str]) -> Column:
    """Whether any of the patterns is in the text, as ``rlike`` of their alternation says; null of a null, false without a pattern."""
    found = F.when(text.isNotNull(), False)
    free = [p for p in patterns if required(p) is None]
    known = [p for p in patterns if required(p) is not None]
    if free:
        found = text.rlike("|".join(free))
    plain = [p for p in known if is_plain(p)]
    if plain:
        found = found | text.rlike(trie([required(p)[0] for p in plain]))
    other = [p for p in known if not is_plain(p)]
    if other:
        found = found | (text.rlike(trie([x for p in other for x in required(p)])) & text.rlike("|".join(other)))
    return found
