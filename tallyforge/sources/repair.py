"""objects from model answers that are almost JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.sources.logs import outer_object

_SCALAR = re.compile(r"[^\s,:\]}{\[\"']+")
_WORDS = {"true": True, "false": False, "null": None, "none": None, "nan": None}
_CLOSING = {"{": "}", "[": "]"}
#: brackets open at once in an answer that is still read
DEEPEST = 200


class Broken(ValueError):
    pass


class _Reader:
    """Reads a value and forgives: trailing and missing commas, either quotes, bare keys, Python's words, line feeds in strings, comments, and an end that was cut off."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def blank(self) -> None:
        while m := re.compile(r"\s+|//[^\n]*|/\*.*?(?:\*/|\Z)", re.S).match(self.text, self.at):
            self.at = m.end()

    def next(self) -> str:
        self.blank()
        return self.text[self.at : self.at + 1]

    def value(self, depth: int = 0):
        if depth > DEEPEST:
            raise Broken("too deep")
        c = self.next()
        if c in _CLOSING:
            return self.members(c, depth)
        if c and c in "\"'":
            return self.string()
        m = _SCALAR.match(self.text, self.at)
        if not m:
            raise Broken(f"no value at {self.at}")
        self.at = m.end()
        if m[0].lower() in _WORDS:
            return _WORDS[m[0].lower()]
        try:
            return json.loads(m[0])
        except ValueError:
            return m[0]

    def members(self, opening: str, depth: int):
        out = {} if opening == "{" else []
        self.at += 1
        while (c := self.next()) and c not in "}]":
            if c in ",:":
                self.at += 1
            elif opening == "[":
                out.append(self.value(depth + 1))
            else:
                key = self.value(depth + 1)
                if self.next() == ":":
                    self.at += 1
                    out[str(key)] = None if self.next() in ("", ",", "}") else self.value(depth + 1)
        if c == _CLOSING[opening]:  # another bracket closes this one and is left to the one outside
            self.at += 1
        return out

    def string(self) -> str:
        quote, parts = self.text[self.at], []
        self.at += 1
        while self.at < len(self.text) and (c := self.text[self.at]) != quote:
            if c == "\\":
                m = re.compile(r"\\(?:u[0-9a-fA-F]{4}|.?)", re.S).match(self.text, self.at)
                try:
                    c = json.loads(f'"{m[0]}"')
                except ValueError:
                    c = m[0][1:]
                self.at = m.end() - 1
            parts.append(c)
            self.at += 1
        self.at += 1
        return "".join(parts)


def repaired(text: str | None) -> str | None:
    """JSON text of the object in an answer: as it stands if it parses, else as a forgiving reader understands it; None if that is no object."""
    whole = (text or "").strip()
    try:
        return whole if isinstance(json.loads(whole), dict) else None
    except (ValueError, RecursionError):
        pass
    begin = whole.find("{")
    if begin < 0:
        return None
    if (found := outer_object(whole)) is not None and whole.find(found) == begin:
        return found
    try:
        value = _Reader(whole[begin:]).value()
    except Broken:
        return None
    return json.dumps(value, ensure_ascii=False) if isinstance(value, dict) and value else None


def repaired_column(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda x: repaired(None if pd.isna(x) else x))

    return run(text)
