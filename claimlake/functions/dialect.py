"""Text shim for warehouse-dialect expressions stored in rule and mapping
tables (``TO_NUMBER(x)``, ``TO_DATE(x)``, ``DATEDIFF(unit, a, b)``,
``CURRENT_DATE()``, ``IFF``, ``a / b``).

Not a SQL translator: it rewrites a handful of known function spellings into
Spark SQL text, which ``F.expr`` then compiles to ordinary Catalyst
expressions.
"""

from __future__ import annotations

import datetime as _dt
import re

from claimlake.functions.dates import boundary_diff_sql

_FUNC = re.compile(r"\b(TRY_TO_NUMBER|TO_NUMBER|TO_DECIMAL|TRY_TO_DATE|TO_DATE|DATEDIFF|IFF|TRY_TO_TIMESTAMP|"
                   r"TO_TIMESTAMP|TO_VARCHAR)\s*\(", re.IGNORECASE)
_DIV = re.compile(r"(?<![\w.])([A-Za-z_][\w.]*|\d+(?:\.\d+)?)\s*/\s*([A-Za-z_][\w.]*|\d+(?:\.\d+)?)(?![\w.(])")
_ALIAS = re.compile(r"^(?P<expr>.*\S)\s+AS\s+(?P<name>[A-Za-z_][\w]*)\s*$", re.IGNORECASE | re.DOTALL)


def _split_args(s: str) -> list[str]:
    out, depth, cur, quote = [], 0, [], None
    for ch in s:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in ("'", '"'):
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            out.append("".join(cur).strip())
            cur = []
            continue
        cur.append(ch)
    if "".join(cur).strip():
        out.append("".join(cur).strip())
    return out


def _close(text: str, start: int) -> int:
    """Index of the parenthesis closing the one opened just before ``start``."""
    depth, quote = 1, None
    for i in range(start, len(text)):
        ch = text[i]
        if quote:
            if ch == quote:
                quote = None
            continue
        if ch in ("'", '"'):
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0:
                return i
    raise ValueError(f"unbalanced parentheses in {text!r}")


def _rewrite_call(name: str, args: list[str]) -> str:
    n = name.upper()
    if n in ("TO_NUMBER", "TRY_TO_NUMBER", "TO_DECIMAL"):
        p, s = (args[1], args[2]) if len(args) >= 3 else ("18", "2")
        return f"try_cast({args[0]} AS DECIMAL({p},{s}))"
    if n in ("TO_DATE", "TRY_TO_DATE"):
        if len(args) > 1:
            return f"to_date(try_to_timestamp({args[0]}, {args[1]}))"
        return f"try_cast({args[0]} AS DATE)"
    if n in ("TO_TIMESTAMP", "TRY_TO_TIMESTAMP"):
        if len(args) > 1:
            return f"try_to_timestamp({args[0]}, {args[1]})"
        return f"try_cast({args[0]} AS TIMESTAMP_NTZ)"
    if n == "DATEDIFF" and len(args) == 3:
        return boundary_diff_sql(args[0].strip("'\" "), args[1], args[2])
    if n == "IFF":
        return f"if({', '.join(args)})"
    if n == "TO_VARCHAR":
        if len(args) > 1:
            return f"date_format({args[0]}, {args[1]})"
        return f"CAST({args[0]} AS STRING)"
    return f"{name}({', '.join(args)})"


def to_spark_sql(text: str, as_of=None) -> str:
    """Rewrite one warehouse-dialect expression into Spark SQL text."""
    s = text
    if as_of is not None:
        if isinstance(as_of, _dt.datetime):
            d, ts = as_of.date().isoformat(), as_of.isoformat(sep=" ")
        else:
            d = _dt.date.fromisoformat(str(as_of)[:10]).isoformat()
            ts = d + " 00:00:00"
        parts = re.split(r"('(?:[^']|'')*')", s)  # odd items are string literals
        for i in range(0, len(parts), 2):
            parts[i] = re.sub(r"\bCURRENT_DATE\b\s*(\(\s*\))?", f"DATE'{d}'", parts[i], flags=re.IGNORECASE)
            parts[i] = re.sub(r"\b(CURRENT_TIMESTAMP|SYSDATE|GETDATE)\b\s*(\(\s*\))?", f"TIMESTAMP_NTZ'{ts}'", parts[i], flags=re.IGNORECASE)
        s = "".join(parts)
    # innermost-first rewriting of the known calls
    while True:
        m = None
        for cand in _FUNC.finditer(s):
            m = cand
        if m is None:
            break
        end = _close(s, m.end())
        args = [to_spark_sql(a, None) for a in _split_args(s[m.end():end])]
        s = s[:m.start()] + "\x00" + _rewrite_call(m.group(1), args).replace("(", "\x01") + s[end + 1:]
    s = s.replace("\x00", "").replace("\x01", "(")
    # ANSI division by zero raises: a / b becomes try_divide(a, b) (NULL on 0)
    parts = re.split(r"('(?:[^']|'')*')", s)  # odd items are string literals
    for i in range(0, len(parts), 2):
        parts[i] = _DIV.sub(lambda m: f"try_divide({m.group(1)}, {m.group(2)})", parts[i])
    return "".join(parts)


def split_alias(text: str) -> tuple[str, str | None]:
    """``expr AS name`` -> (expr, name); plain expressions -> (expr, None)."""
    m = _ALIAS.match(text.strip())
    if not m:
        return text.strip(), None
    return m.group("expr"), m.group("name")
