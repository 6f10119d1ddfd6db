"""Grouping keys as bit fields of a few 64-bit integers.

An aggregate over dozens of keys carries all of them through its hash table and its shuffle.
Labels of a known set, small numbers, dates and short codes fit a few bits each; packed, a
row of keys is a handful of integers, and is unfolded after the aggregate.  Packing is exact:
a value that does not fit its field raises and names the key.

Fields are written as SQL text: one parsed expression costs far less to plan than the dozens
of column calls it stands for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

WORD = 63  # bits used of an integer, so that it never turns negative
SHORT = 7  # bytes of a code that fits one integer
FIRST_DAY = -719_162  # 0001-01-01, in days from 1970


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _raised(name: str, why: str) -> str:
    message = f"a value of {name} {why}: give the key a wider field"
    return f"cast(raise_error({_text(message)}) as bigint)"


@dataclass(frozen=True)
class Label:
    """One of a few known texts, or NULL."""

    values: tuple[str, ...]

    @property
    def bits(self) -> int:
        return len(self.values).bit_length()

    def code(self, c: str, name: str) -> str:
        whens = " ".join(f"when {_text(v)} then {k}L" for k, v in enumerate(self.values, 1))
        return f"case when {c} is null then 0L else case {c} {whens} else {_raised(name, 'is none of its labels')} end end"

    def value(self, code: str) -> str:
        return f"get(array(cast(null as string), {', '.join(map(_text, self.values))}), int({code}))"


@dataclass(frozen=True)
class Number:
    """A whole number from ``low`` on, or NULL."""

    bits: int
    low: int = 0
    type: str = "int"

    def code(self, c: str, name: str) -> str:
        high = self.low + (1 << self.bits) - 2
        outside = _raised(name, f"lies outside {self.low} to {high}")
        return (
            f"case when {c} is null then 0L when {c} between {self.low}L and {high}L "
            f"then cast({c} as bigint) - {self.low}L + 1L else {outside} end"
        )

    def value(self, code: str) -> str:
        return f"cast(if({code} > 0, {code} + {self.low - 1}L, null) as {self.type})"


@dataclass(frozen=True)
class Day:
    """A date of the years 1 to 9999, or NULL."""

    bits: int = 22

    def code(self, c: str, name: str) -> str:
        return Number(self.bits, FIRST_DAY).code(f"unix_date({c})", name)

    def value(self, code: str) -> str:
        return f"date_from_unix_date({Number(self.bits, FIRST_DAY).value(code)})"


@dataclass(frozen=True)
class Code:
    """A text of up to seven bytes, or NULL."""

    bits: int = 8 * SHORT + 4

    def code(self, c: str, name: str) -> str:
        return (
            f"case when {c} is null then 0L when octet_length({c}) <= {SHORT} then "
            f"shiftleft(coalesce(cast(conv(hex({c}), 16, 10) as bigint), 0L), 4) + octet_length({c}) + 1L "
            f"else {_raised(name, f'has more than {SHORT} bytes')} end"
        )

    def value(self, code: str) -> str:
        digits = f"lpad(hex(shiftrightunsigned({code}, 4)), {2 * SHORT}, '0')"
        size = f"int({code} & 15L) - 1"
        return f"case when {code} = 0 then null when {size} = 0 then '' else decode(unhex(right({digits}, 2 * ({size}))), 'UTF-8') end"


Field = Label | Number | Day | Code


class Packing:
    """Where each key lies: fields fill integers in order, each field within one of them."""

    def __init__(self, fields: Mapping[str, Field], prefix: str = "__packed") -> None:
        self.fields, self.prefix = dict(fields), prefix
        self.places: dict[str, tuple[int, int]] = {}
        used: list[int] = []  # bits of each integer
        for name, field in self.fields.items():
            if not 0 < field.bits <= WORD:
                raise ValueError(f"{name} needs 1 to {WORD} bits")
            at = next((k for k, bits in enumerate(used) if bits + field.bits <= WORD), len(used))
            if at == len(used):
                used.append(0)
            self.places[name] = at, used[at]
            used[at] += field.bits
        self.names = [f"{prefix}{k}" for k in range(len(used))]

    def columns(self, stands_in: str = "{}") -> list[Column]:
        """The integers that hold the keys, found in columns named ``stands_in`` of the key."""
        words: list[list[str]] = [[] for _ in self.names]
        for name, field in self.fields.items():
            at, bit = self.places[name]
            code = field.code(f"`{stands_in.format(name)}`", name)
            words[at].append(f"shiftleft({code}, {bit})" if bit else f"({code})")
        return [F.expr(" | ".join(w)).alias(n) for w, n in zip(words, self.names, strict=True)]

    def key(self, name: str) -> str:
        """One key out of the integers, as SQL."""
        (at, bit), bits = self.places[name], self.fields[name].bits
        word = f"shiftrightunsigned({self.names[at]}, {bit})" if bit else self.names[at]
        return self.fields[name].value(f"({word} & {(1 << bits) - 1}L)")

    def filled(self, labels: Mapping[str, str]) -> list[Column]:
        """The integers, and where they are NULL those of ``labels``, every other key being NULL."""
        words = [0] * len(self.names)
        for name, label in labels.items():
            at, bit = self.places[name]
            words[at] |= (self.fields[name].values.index(label) + 1) << bit
        return [F.expr(f"coalesce({n}, {w}L)").alias(n) for n, w in zip(self.names, words, strict=True)]

    def unfolded(self, names: Sequence[str] | None = None) -> list[Column]:
        return [F.expr(self.key(n)).alias(n) for n in (self.fields if names is None else names)]
