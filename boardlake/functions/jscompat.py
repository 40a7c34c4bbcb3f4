"""JavaScript-compatible text semantics expressed as Spark column functions.

Postings are produced by JavaScript tooling, and users hand us JavaScript
regular expressions.  Java's regex dialect (used by ``rlike`` /
``regexp_replace``) differs in whitespace, word boundaries, ``$`` and a few
class rules, so we rewrite patterns once on the driver at plan-build time
and keep every per-row evaluation inside Spark's built-in expressions.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters JavaScript's \s and String.prototype.trim treat
# as whitespace (ECMAScript WhiteSpace + LineTerminator).
JS_WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r \u00a0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# The same set as a Java regex class body (no brackets).
WS_BODY = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
WS = "[" + WS_BODY + "]"
NOT_WS = "[^" + WS_BODY + "]"

# JavaScript \b is ASCII-only; Java's \b is Unicode-aware.  Lookarounds on
# the ASCII word class reproduce the JavaScript behaviour.
_W = "[A-Za-z0-9_]"
WORD_BOUNDARY = f"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"
NOT_WORD_BOUNDARY = f"(?:(?<={_W})(?={_W})|(?<!{_W})(?!{_W}))"

# JavaScript "." excludes exactly these line terminators.
JS_DOT = r"[^\n\r\x{2028}\x{2029}]"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def js_trim(c) -> Column:
    """String.prototype.trim: strip JavaScript whitespace at both ends."""
    return F.btrim(col_of(c), F.lit(JS_WHITESPACE_CHARS))


def let(value: Column, body) -> Column:
    """``body`` over ``value`` evaluated once, however often body uses it (an
    expression used twice may otherwise be worked out twice).

    An aggregate over no elements: its finish sees the start.  An element of a transformed
    array would have its type derived from the whole body again for every row, and from nested
    bodies several times."""
    return F.aggregate(F.array(), value, lambda x, _: x, body)


def py_js_trim(s: str) -> str:
    """Driver-side twin of :func:`js_trim` for plan-time arguments."""
    return s.strip(JS_WHITESPACE_CHARS)


def truthy_or(*cols) -> Column:
    """JavaScript ``a || b || ...`` over strings: '' and NULL fall through.

    The last operand is returned as is (like JS), so pass a literal default.
    """
    cs = [col_of(c) for c in cols]
    if len(cs) == 1:
        return cs[0]
    head = [F.nullif(c, F.lit("")) for c in cs[:-1]]
    return F.coalesce(*head, cs[-1])


def utf16_len(s: str) -> int:
    """String length as JavaScript counts it (UTF-16 code units)."""
    return len(s.encode("utf-16-le")) // 2


def js_escape_literal(s: str) -> str:
    """Escape regex metacharacters the way the reference's keyword matcher does."""
    return re.sub(r"[.*+?^${}()|\[\]\\]", lambda m: "\\" + m.group(0), s)


_QUANT = re.compile(r"\{\d+(,\d*)?\}")
_GROUP = re.compile(r"\((?!\?)|\(\?<(?![=!])")
_HEX2, _HEX4 = re.compile(r"[0-9A-Fa-f]{2}"), re.compile(r"[0-9A-Fa-f]{4}")


class JsRegexError(ValueError):
    """A user pattern JavaScript itself would reject (or we cannot express)."""


def _char(code: int) -> str:
    return f"\\x{{{code:X}}}"


def _escape(pattern: str, i: int, groups: int, named: bool, in_class: bool) -> tuple[str, int]:
    """Java text of the JavaScript escape whose backslash is at ``i``, and its
    length.  Letters without a meaning in JavaScript are plain letters; Java
    gives several of them one."""
    nx = pattern[i + 1]
    rest = pattern[i + 2 :]
    if nx in "dDwWnrtf":
        return "\\" + nx, 2
    if nx == "s":
        return (WS_BODY if in_class else WS), 2
    if nx == "S":
        return NOT_WS, 2  # inside a class the caller takes it out
    if nx == "v":
        return _char(0x0B), 2
    if nx == "b":
        return (_char(8) if in_class else WORD_BOUNDARY), 2
    if nx == "B" and not in_class:
        return NOT_WORD_BOUNDARY, 2
    if nx == "c" and rest[:1].isascii() and rest[:1].isalpha():
        return _char(ord(rest[0]) % 32), 3
    if nx == "x" and _HEX2.match(rest):
        return _char(int(rest[:2], 16)), 4
    if nx == "u" and _HEX4.match(rest):
        return _char(int(rest[:4], 16)), 6
    if nx == "k" and named and not in_class:
        return "\\k", 2
    if nx.isascii() and nx.isdigit():
        digits = re.match(r"\d+", pattern[i + 1 :])[0]
        if not in_class and nx != "0" and int(digits) <= groups:
            return "\\" + digits, 1 + len(digits)
        octal = re.match(r"[0-3][0-7]{0,2}|[4-7][0-7]?", pattern[i + 1 :])
        return (_char(int(octal[0], 8)), 1 + len(octal[0])) if octal else (nx, 2)
    if nx.isascii() and nx.isalpha():
        return nx, 2
    return "\\" + nx, 2


def js_regex(pattern: str, ignore_case: bool = True) -> str:
    """Rewrite a JavaScript regex source into an equivalent Java regex.

    Handles the dialect gaps that change results: ``\\s``/``\\S`` (Unicode
    whitespace, also inside classes), ``\\b``/``\\B`` (ASCII), escapes that
    only Java knows (plain letters in JavaScript), ``$`` (absolute end),
    ``.`` (JS line terminators), ``[^]``/``[]``, a literal ``[`` or ``&&``
    inside a class, and ``{`` that is not a quantifier.  Inline flag groups
    and possessive quantifiers are syntax errors in JavaScript and rejected.
    """
    out = []
    i, n = 0, len(pattern)
    groups = len(_GROUP.findall(re.sub(r"\\.|\[(?:\\.|[^\]\\])*\]", "", pattern, flags=re.S)))
    named = "(?<" in re.sub(r"\(\?<[=!]", "", pattern)
    quantified = False  # the last item was a quantifier
    while i < n:
        ch = pattern[i]
        if ch == "+" and quantified:
            raise JsRegexError(f"nothing to repeat at offset {i}")
        before, quantified = quantified, False
        if ch == "\\":
            if i + 1 >= n:
                raise JsRegexError("pattern ends with a lone backslash")
            text, size = _escape(pattern, i, groups, named, False)
            out.append(text)
            i += size
        elif ch == "[":
            text, i = _js_class(pattern, i, groups, named)
            out.append(text)
        elif ch == "(" and pattern.startswith("(?", i):
            if pattern[i + 2 : i + 3] not in (":", "=", "!", "<"):
                raise JsRegexError(f"invalid group at offset {i}: inline flags are not JavaScript")
            out.append("(?")
            i += 2
        elif ch in "*+?":
            out.append(ch)
            quantified = not (ch == "?" and before)
            if not quantified and pattern[i + 1 : i + 2] == "+":
                raise JsRegexError(f"nothing to repeat at offset {i + 1}")
            i += 1
        elif ch == "{":
            m = _QUANT.match(pattern, i)
            out.append(m[0] if m else r"\{")
            quantified = bool(m)
            i += len(m[0]) if m else 1
        else:
            out.append({"$": r"\z", ".": JS_DOT}.get(ch, ch))
            i += 1
    body = "".join(out)
    return ("(?iu)" if ignore_case else "") + body


def _js_class(pattern: str, i: int, groups: int, named: bool) -> tuple[str, int]:
    """Java text of the character class that starts at ``i``, and where it ends."""
    if pattern.startswith("[^]", i):
        return r"[\s\S]", i + 3
    if pattern.startswith("[]", i):
        return "(?!)", i + 2
    negated = pattern.startswith("[^", i)
    i += 2 if negated else 1
    body, ink = [], False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "]":
            text = "".join(body)
            if not ink:
                return f"[{'^' if negated else ''}{text}]", i + 1
            if negated:  # blanks that the rest does not name
                return (f"(?:(?![{text}]){WS})" if text else WS), i + 1
            return (f"(?:[{text}]|{NOT_WS})" if text else NOT_WS), i + 1
        if ch == "\\":
            if i + 1 >= len(pattern):
                break
            if pattern[i + 1] == "S":
                ink, size = True, 2
            else:
                text, size = _escape(pattern, i, groups, named, True)
                body.append(text)
            i += size
            continue
        if ch == "&" and pattern.startswith("&&", i):
            body.append(r"&\&")
            i += 2
            continue
        body.append(r"\[" if ch == "[" else ch)
        i += 1
    raise JsRegexError("unterminated character class")


def validate_java_regex(spark, java_pattern: str) -> None:
    """Fail at plan-build time (not mid-job) when the JVM rejects a pattern."""
    jvm = getattr(getattr(spark, "sparkContext", None), "_jvm", None)
    if jvm is None:
        return
    try:
        jvm.java.util.regex.Pattern.compile(java_pattern)
    except Exception as exc:  # py4j wraps PatternSyntaxException
        raise JsRegexError(f"invalid regular expression: {exc}") from None


def any_of(cols) -> Column:
    cols = list(cols)
    if not cols:
        return F.lit(False)
    return reduce(lambda a, b: a | b, cols)
