"""Character n-grams for looking up many search terms at once, and the literal texts that a
pattern cannot match without."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAM = 3
#: Letters beyond ASCII that case-insensitive matching takes for ASCII ones, and these.
FOLDED, PLAIN = "ſKİı", "skii"
_LITERAL = re.compile(r"[A-Za-z0-9 _,;:@#%&=<>'\"!~`/-]")


def folded(text: Column) -> Column:
    """Lower case in which every text that matches an ASCII literal regardless of case holds it."""
    text = F.coalesce(text, F.lit(""))
    for c, plain in zip(FOLDED, PLAIN, strict=True):  # four searches, mostly in vain, where translate walks over all letters
        text = F.replace(text, F.lit(c), F.lit(plain))
    return F.lower(text)


def grams(text: Column, sizes=(1, 2, GRAM)) -> Column:
    """The different substrings of these sizes, found in one walk over the text for each size."""
    return F.array_distinct(F.concat(*(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1)) for k in sizes)))


def held_grams(text: Column, wanted: list[str]) -> Column:
    """Those of the wanted texts that the text holds, found in one walk over the text for each
    of their sizes.  Only places where one begins are kept, so the work hardly depends on how
    many are wanted, and none of the text's other n-grams is built."""
    of_size = [sorted({w for w in wanted if len(w) == k}) for k in sorted({len(w) for w in wanted})]
    return F.array_distinct(F.concat(*(F.regexp_extract_all(text, F.lit(_at_any_of(own)), F.lit(1)) for own in of_size)))


def _java(chars) -> dict[str, str]:
    return {c: c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):X}}}" for c in chars}


def _at_any_of(texts: list[str]) -> str:
    """Java pattern of the places where one of these texts, all of one size, begins; group 1 is
    the text.  Most places fail already at the characters that a text may have there."""
    classes = "".join(f"[{''.join(_java(sorted(set(chars))).values())}]" for chars in zip(*texts, strict=True))
    return f"(?={classes})(?=({_any_of(texts)}))"


def _any_of(texts: list[str]) -> str:
    tails: dict[str, list[str]] = {}
    for t in texts:
        tails.setdefault(t[0], []).append(t[1:])
    java = _java(tails)
    if len(texts[0]) == 1:
        return f"[{''.join(java.values())}]"
    return "(?:" + "|".join(java[c] + _any_of(rest) for c, rest in tails.items()) + ")"


def py_grams(text: str) -> list[str]:
    """The grams that a text holding ``text`` must have: its own of full size, or itself."""
    k = min(GRAM, len(text))
    return sorted({text[i : i + k] for i in range(len(text) - k + 1)}) if text else []


def required_literals(pattern: str) -> list[str] | None:
    """Lower-case texts of which every match of the pattern, regardless of case, holds at least
    one: the longest literal run of each alternative.  None if some alternative has none."""
    runs: list[list[str]] = [[""]]
    i, n = 0, len(pattern)
    while i < n:
        c, size, literal = pattern[i], 1, ""
        if c == "|":
            runs.append([""])
            i += 1
            continue
        if c == "\\":
            size = 2
            if pattern[i + 1 : i + 2] and not pattern[i + 1].isalnum():
                literal = pattern[i + 1] if pattern[i + 1].isascii() else ""
        elif c in "([":
            size = _closed(pattern, i) - i
        elif _LITERAL.match(c):
            literal = c
        m = re.compile(r"[*+?]\??|\{\d+(?:,\d*)?\}\??").match(pattern, i + size)
        if m and literal:  # the item may be missing, or come more than once
            if m[0][0] == "+" or (m[0][0] == "{" and int(re.match(r"\{(\d+)", m[0])[1]) > 0):
                runs[-1][-1] += literal
            runs[-1].append("")
            if m[0][0] == "+":
                runs[-1][-1] = literal
        elif literal:
            runs[-1][-1] += literal
        else:
            runs[-1].append("")
        i += size + (len(m[0]) if m else 0)
    best = [max(r, key=len).lower() for r in runs]
    return sorted(set(best)) if all(best) else None


def _closed(pattern: str, i: int) -> int:
    """Where the group or class that opens at ``i`` has closed."""
    depth, in_class = 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif in_class:
            in_class = c != "]"
            if not in_class and depth == 0:
                return i + 1
        elif c == "[":
            in_class = True
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if depth == 0:
                return i + 1
        i += 1
    return i
