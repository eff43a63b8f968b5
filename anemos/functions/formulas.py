"""Columns computed from formula text, e.g. ``"Loss / (Made + Loss) * 100"``.

A formula may use columns (``name`` or ``[any name]``), numbers, texts, ``true`` and ``false``, and, binding
from loose to tight: ``c ? a : b`` and ``a ?? b`` (``b`` where ``a`` is null); ``||``; ``&&``; ``== != < <= > >=``, ``=~ !~`` (a text holds
a match of a pattern) and ``in (a, b)``; ``& | ^``; ``<< >>``; ``+ -``; ``* / %``; ``**``; ``! - + ~``. ``+`` joins texts. Bits are
those of whole numbers. Dividing by zero gives null. Anything else is refused before the query is planned.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import number_text


class FormulaError(ValueError):
    """The formula uses an unknown column or something that is not supported."""


class Value(NamedTuple):
    """A part of a formula: its column, and whether that is a number, a text, a truth, a time or anything."""

    column: Column
    kind: str


_TOKENS = re.compile(r"""\s*(?:
    (?P<number>0[xX][0-9a-fA-F]+|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)
  | (?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")
  | (?P<name>\[[^\[\]]+\]|[^\W\d]\w*)
  | (?P<sign>\*\*|\|\||&&|\?\?|==|!=|<=|>=|=~|!~|<<|>>|[-+*/%<>!~&|^?:(),])
)""", re.VERBOSE)

# How tightly signs between two values bind.
_BINDS = {
    "?": 1, "??": 1, "||": 2, "&&": 3,
    **dict.fromkeys(("==", "!=", "<", "<=", ">", ">=", "=~", "!~", "in"), 4),
    **dict.fromkeys("&|^", 5), "<<": 6, ">>": 6, "+": 7, "-": 7, "*": 8, "/": 8, "%": 8, "**": 9,
}
_ARITHMETIC: dict[str, Callable[[Column, Column], Column]] = {
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b,
    "/": F.try_divide,
    "%": lambda a, b: a % F.nullif(b, F.lit(0.0)),
    "**": F.pow,
}
_BITS: dict[str, Callable[[Column, Column], Column]] = {
    "&": lambda a, b: a.bitwiseAND(b),
    "|": lambda a, b: a.bitwiseOR(b),
    "^": lambda a, b: a.bitwiseXOR(b),
    "<<": lambda a, b: F.call_function("shiftleft", a, b.cast("int")),
    ">>": lambda a, b: F.call_function("shiftright", a, b.cast("int")),
}
_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def _kind_of(data_type: str) -> str:
    if data_type in ("string", "boolean"):
        return {"string": "text", "boolean": "truth"}[data_type]
    if data_type.startswith(("timestamp", "date")):
        return "time"
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    return "number" if data_type.startswith(numbers) else "any"


def _unquoted(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text[1:-1], flags=re.DOTALL)


class _Parser:
    """Reads one formula by precedence climbing."""

    def __init__(self, text: str, kinds: Mapping[str, str]):
        self.text, self.kinds, self.at = text, kinds, 0
        self.tokens = self._tokens()

    def _tokens(self) -> list[tuple[str, str]]:
        found, at = [], 0
        while self.text[at:].strip():
            match = _TOKENS.match(self.text, at)
            if not match:
                raise FormulaError(f"cannot read formula {self.text!r} from {self.text[at:].strip()!r} on")
            found.append((match.lastgroup, match[match.lastgroup]))
            at = match.end()
        return found

    def _next(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def _take(self, sign: str) -> bool:
        if self._next()[1] == sign and self._next()[0] != "text":
            self.at += 1
            return True
        return False

    def _expect(self, sign: str) -> None:
        if not self._take(sign):
            raise FormulaError(f"formula {self.text!r} lacks {sign!r}")

    def whole(self) -> Column:
        value = self.expression(1)
        if self._next()[0] != "end":
            raise FormulaError(f"not supported in a formula: {self._next()[1]!r} in {self.text!r}")
        return value.column

    def expression(self, least: int) -> Value:
        """A value and all that follows it by signs that bind as ``least`` or tighter."""
        left = self.operand()
        while (binds := self._binding()) >= least:
            sign = self._next()[1]
            self.at += 1
            if sign == "?":
                left = self.choice(left)
            elif sign == "in":
                left = self.membership(left)
            else:
                # a ?? b ?? c is the same either way; powers climb to the right
                left = self.combined(sign, left, self.expression(binds if sign in ("**", "??") else binds + 1))
        return left

    def _binding(self) -> int:
        kind, text = self._next()
        return _BINDS.get(text, 0) if kind == "sign" or text == "in" and kind == "name" else 0

    def operand(self) -> Value:
        kind, text = self._next()
        self.at += 1
        if kind == "number":
            return Value(F.lit(float(int(text, 16) if text[:2].lower() == "0x" else text)), "number")
        if kind == "text":
            return Value(F.lit(_unquoted(text)), "text")
        if kind == "name" and text in ("true", "false"):
            return Value(F.lit(text == "true"), "truth")
        if kind == "name" and text != "in":
            return self.named(text[1:-1] if text.startswith("[") else text)
        if text == "(" and kind == "sign":
            value = self.expression(1)
            self._expect(")")
            return value
        if kind == "sign" and text in "!-+~":
            return self.prefixed(text, self.expression(max(_BINDS.values()) + 1))
        raise FormulaError(f"cannot read formula {self.text!r} at {text or 'its end'!r}")

    def named(self, name: str) -> Value:
        if name not in self.kinds:
            raise FormulaError(f"unknown column {name!r} in {self.text!r}")
        return Value(F.col(f"`{name}`"), self.kinds[name])

    def prefixed(self, sign: str, value: Value) -> Value:
        if sign == "!":
            return Value(~self._of("truth", sign, value), "truth")
        column = self._of("number", sign, value)
        if sign == "~":
            return Value(F.bitwise_not(column.cast("bigint")).cast("double"), "number")
        return Value(-column if sign == "-" else column, "number")

    def choice(self, test: Value) -> Value:
        """``test ? a : b``; without ``: b`` null where the test is not true."""
        body = self.expression(1)
        chosen = F.when(self._of("truth", "?", test), body.column)
        if not self._take(":"):
            return Value(chosen, body.kind)
        other = self.expression(1)
        self._same(body, other, "? :")
        return Value(chosen.otherwise(other.column), body.kind if body.kind == other.kind else "any")

    def membership(self, value: Value) -> Value:
        self._expect("(")
        found = F.lit(False)
        while True:
            found = found | self.combined("==", value, self.expression(1)).column
            if self._take(")"):
                return Value(found, "truth")
            self._expect(",")

    def combined(self, sign: str, left: Value, right: Value) -> Value:
        kinds = {left.kind, right.kind}
        if sign == "??":
            self._same(left, right, sign)
            return Value(F.coalesce(left.column, right.column), right.kind if left.kind == "any" else left.kind)
        if sign in ("&&", "||"):
            one, two = (self._of("truth", sign, value) for value in (left, right))
            return Value(one & two if sign == "&&" else one | two, "truth")
        if sign in _COMPARE:
            self._same(left, right, sign)
            return Value(_COMPARE[sign](*self._comparable(left, right)), "truth")
        if sign in ("=~", "!~"):
            one, two = (self._of("text", sign, value) for value in (left, right))
            matches = F.rlike(one, two)
            return Value(matches if sign == "=~" else ~matches, "truth")
        if sign == "+" and "text" in kinds:
            return Value(F.concat(*map(self._as_text, (left, right))), "text")
        one, two = (self._of("number", sign, value) for value in (left, right))
        if sign in _BITS:
            return Value(_BITS[sign](one.cast("bigint"), two.cast("bigint")).cast("double"), "number")
        return Value(_ARITHMETIC[sign](one, two), "number")

    def _of(self, kind: str, sign: str, value: Value) -> Column:
        if value.kind not in (kind, "any"):
            raise FormulaError(f"{sign!r} needs a {kind}, not a {value.kind}, in {self.text!r}")
        return value.column

    def _same(self, left: Value, right: Value, sign: str) -> None:
        kinds = {left.kind, right.kind} - {"any"}
        if len(kinds) > 1 and kinds != {"time", "text"}:
            raise FormulaError(f"{sign!r} needs two values of a kind, not {' and '.join(sorted(kinds))}, in {self.text!r}")

    @staticmethod
    def _comparable(left: Value, right: Value) -> tuple[Column, Column]:
        """A text that stands beside a time is read as one."""
        if {left.kind, right.kind} == {"time", "text"}:
            return tuple(value.column.cast("timestamp_ntz") for value in (left, right))
        return left.column, right.column

    @staticmethod
    def _as_text(value: Value) -> Column:
        return number_text(value.column.cast("double")) if value.kind == "number" else value.column.cast("string")


def formula_column(text: str, columns: Iterable[str] | Mapping[str, str]) -> Column:
    """The formula as a column; only ``columns`` may be named in it.

    Given with their types (as ``dict(df.dtypes)``), values of the wrong kind are refused and ``+`` knows texts.
    """
    kinds = {name: _kind_of(kind) for name, kind in columns.items()} if isinstance(columns, Mapping) else dict.fromkeys(columns, "any")
    return _Parser(text, kinds).whole()
