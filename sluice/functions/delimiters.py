"""Delimiter options: written as escapes in job configs, resolved once on the driver.

A delimiter such as ``\\001``, ``\\t`` or ``\\u0001`` is a *config value*, so it is
unescaped in Python once when the option is read; no per-row work is involved.
Split delimiters are matched literally by default (each character is hex-escaped into
a Java regex), so ``|`` or ``.`` never turn into regex operators.
"""

from __future__ import annotations

import re

_SIMPLE = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", "\\": "\\", "'": "'", '"': '"'}
_ESCAPE_RE = re.compile(r"\\(u+[0-9a-fA-F]{4}|[0-3]?[0-7]{1,2}|.)", re.S)


def unescape_delim(text: str | None) -> str | None:
    """Resolve Java-style escapes: ``\\t \\n \\r \\b \\f \\\\ \\' \\"``, octal ``\\001`` and ``\\uXXXX``."""
    if text is None:
        return None

    def repl(m: re.Match) -> str:
        tok = m.group(1)
        if tok[0] == "u":
            return chr(int(tok.lstrip("u"), 16))
        if tok[0] in "01234567":
            return chr(int(tok, 8))
        if tok in _SIMPLE:
            return _SIMPLE[tok]
        return tok  # unknown escape: keep the character

    return _ESCAPE_RE.sub(repl, text)


def literal_regex(delim: str) -> str:
    """A Java regex that matches ``delim`` literally (every non-alphanumeric char hex-escaped)."""
    out = []
    for ch in delim:
        if ch.isalnum() and ch.isascii():
            out.append(ch)
        else:
            out.append("\\x{%x}" % ord(ch))
    return "".join(out)


def split_pattern(delim: str, regex: bool = False) -> str:
    """Pattern for ``F.split``: the unescaped delimiter, quoted unless ``regex=True``."""
    d = unescape_delim(delim)
    if d is None or d == "":
        raise ValueError("field delimiter must not be empty")
    return d if regex else literal_regex(d)
