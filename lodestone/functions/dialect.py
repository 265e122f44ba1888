"""Expressions rendered as SQL text, for Spark's engine and for an ANSI database that checks it.

The text operators are compositions of a few primitives. Spark renders them as
built-in expressions (no Python in the plan); the other rendering is the oracle.
``let`` binds a value once, so that nested operators neither compute it again
nor grow the expression tree.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable

_names = itertools.count()

#: Unicode White_Space.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


class Dialect:
    name = ""

    def lit(self, s: str) -> str:
        raise NotImplementedError

    def fresh(self) -> str:
        return f"v{next(_names)}"

    # strings
    def concat(self, *xs: str) -> str:
        return "(" + " || ".join(xs) + ")"

    def contains(self, x: str, s: str) -> str:
        return f"(instr({x}, {self.lit(s)}) > 0)"

    def instr(self, x: str, s: str) -> str:
        return f"instr({x}, {self.lit(s)})"

    def starts(self, x: str, s: str) -> str:
        return f"starts_with({x}, {self.lit(s)})"

    def ends(self, x: str, s: str) -> str:
        return f"ends_with({x}, {self.lit(s)})"

    def replace(self, x: str, s: str, to: str = "") -> str:
        return f"replace({x}, {self.lit(s)}, {self.lit(to)})"

    def substr(self, x: str, start: str | int, n: str | int | None = None) -> str:
        return f"substr({x}, {start}{'' if n is None else f', {n}'})"

    def chars(self, x: str) -> str:
        return f"length({x})"

    def extract(self, x: str, pattern: str, group: int) -> str:
        return f"regexp_extract({x}, {self.lit(pattern)}, {group})"

    def extract_all(self, x: str, pattern: str, group: int) -> str:
        return f"regexp_extract_all({x}, {self.lit(pattern)}, {group})"

    def case(self, *pairs: tuple[str, str], other: str) -> str:
        return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {other} END"

    def lines(self, x: str) -> str:
        """Lines without their ends (LF or CRLF); no empty last line."""
        return self.let(self.split_lines(x), lambda a: self.case((f"{self.item(a, self.size(a))} = ''", self.slice(a, "1", f"{self.size(a)} - 1")), other=a))

    # to be rendered by each dialect
    def octets(self, x: str) -> str:
        raise NotImplementedError

    def matches(self, x: str, pattern: str) -> str:
        raise NotImplementedError

    def sub(self, x: str, pattern: str, to: str) -> str:
        raise NotImplementedError

    def trim(self, x: str, chars: str = SPACE, side: str = "both") -> str:
        raise NotImplementedError

    def split_lines(self, x: str) -> str:
        raise NotImplementedError

    def map(self, a: str, f: Callable[[str], str]) -> str:
        raise NotImplementedError

    def map_at(self, a: str, f: Callable[[str, str], str]) -> str:
        """f gets the item and its place, from 1."""
        raise NotImplementedError

    def keep(self, a: str, f: Callable[[str], str]) -> str:
        raise NotImplementedError

    def fold(self, a: str, start: str, f: Callable[[str, str], str]) -> str:
        """f gets the state and the item; both are strings."""
        raise NotImplementedError

    def let(self, x: str, f: Callable[[str], str]) -> str:
        return self.item(self.map(self.array(x), f), "1")

    def array(self, *xs: str) -> str:
        raise NotImplementedError

    def item(self, a: str, i: str) -> str:
        raise NotImplementedError

    def size(self, a: str) -> str:
        raise NotImplementedError

    def slice(self, a: str, start: str, n: str) -> str:
        raise NotImplementedError

    def join(self, a: str, sep: str) -> str:
        raise NotImplementedError

    def position(self, a: str, value: str) -> str:
        """From 1; 0 if it is not there."""
        raise NotImplementedError

    def reverse(self, a: str) -> str:
        raise NotImplementedError

    def greatest_of(self, a: str) -> str:
        raise NotImplementedError

    def pair(self, **fields: str) -> str:
        raise NotImplementedError

    def table(self, sf_dir: str, name: str) -> str:
        raise NotImplementedError


class Spark(Dialect):
    name = "spark"

    def lit(self, s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r").replace("\x00", "\\0") + "'"

    def contains(self, x: str, s: str) -> str:
        return f"contains({x}, {self.lit(s)})"

    def starts(self, x: str, s: str) -> str:
        return f"startswith({x}, {self.lit(s)})"

    def ends(self, x: str, s: str) -> str:
        return f"endswith({x}, {self.lit(s)})"

    def octets(self, x: str) -> str:
        return f"octet_length({x})"

    def matches(self, x: str, pattern: str) -> str:
        return f"regexp_like({x}, {self.lit(pattern)})"

    def sub(self, x: str, pattern: str, to: str) -> str:
        return f"regexp_replace({x}, {self.lit(pattern)}, {self.lit(to)})"

    def trim(self, x: str, chars: str = SPACE, side: str = "both") -> str:
        return f"trim({ {'both': 'BOTH', 'left': 'LEADING', 'right': 'TRAILING'}[side] } {self.lit(chars)} FROM {x})"

    def split_lines(self, x: str) -> str:
        return f"split({x}, {self.lit(chr(13) + '?' + chr(10))}, -1)"

    def map(self, a: str, f: Callable[[str], str]) -> str:
        v = self.fresh()
        return f"transform({a}, {v} -> {f(v)})"

    def map_at(self, a: str, f: Callable[[str, str], str]) -> str:
        v, i = self.fresh(), self.fresh()
        return f"transform({a}, ({v}, {i}) -> {f(v, f'({i} + 1)')})"

    def keep(self, a: str, f: Callable[[str], str]) -> str:
        v = self.fresh()
        return f"filter({a}, {v} -> {f(v)})"

    def fold(self, a: str, start: str, f: Callable[[str, str], str]) -> str:
        s, v = self.fresh(), self.fresh()
        return f"aggregate({a}, {start}, ({s}, {v}) -> {f(s, v)})"

    def array(self, *xs: str) -> str:
        return f"array({', '.join(xs)})"

    def item(self, a: str, i: str) -> str:
        return f"get({a}, {i} - 1)"

    def size(self, a: str) -> str:
        return f"size({a})"

    def slice(self, a: str, start: str, n: str) -> str:
        return f"slice({a}, {start}, {n})"

    def join(self, a: str, sep: str) -> str:
        return f"array_join({a}, {self.lit(sep)})"

    def position(self, a: str, value: str) -> str:
        return f"array_position({a}, {value})"

    def reverse(self, a: str) -> str:
        return f"reverse({a})"

    def greatest_of(self, a: str) -> str:
        return f"array_max({a})"

    def pair(self, **fields: str) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"

    def table(self, sf_dir: str, name: str) -> str:
        return f"parquet.`{sf_dir}/{name}.parquet`"


class Duck(Dialect):
    name = "duck"

    def lit(self, s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def octets(self, x: str) -> str:
        return f"strlen({x})"

    def matches(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, {self.lit(pattern)})"

    def sub(self, x: str, pattern: str, to: str) -> str:
        return f"regexp_replace({x}, {self.lit(pattern)}, {self.lit(re.sub(r'[$](\d)', r'\\\1', to))}, 'g')"

    def trim(self, x: str, chars: str = SPACE, side: str = "both") -> str:
        return f"{ {'both': 'trim', 'left': 'ltrim', 'right': 'rtrim'}[side] }({x}, {self.lit(chars)})"

    def split_lines(self, x: str) -> str:
        return f"string_split_regex({x}, {self.lit(chr(13) + '?' + chr(10))})"

    def map(self, a: str, f: Callable[[str], str]) -> str:
        v = self.fresh()
        return f"list_transform({a}, lambda {v}: {f(v)})"

    def map_at(self, a: str, f: Callable[[str, str], str]) -> str:
        v, i = self.fresh(), self.fresh()
        return f"list_transform({a}, lambda {v}, {i}: {f(v, i)})"

    def keep(self, a: str, f: Callable[[str], str]) -> str:
        v = self.fresh()
        return f"list_filter({a}, lambda {v}: {f(v)})"

    def fold(self, a: str, start: str, f: Callable[[str, str], str]) -> str:
        s, v = self.fresh(), self.fresh()
        return f"list_reduce({a}, lambda {s}, {v}: {f(s, v)}, {start})"

    def array(self, *xs: str) -> str:
        return f"[{', '.join(xs)}]"

    def item(self, a: str, i: str) -> str:
        return f"({a})[{i}]"

    def size(self, a: str) -> str:
        return f"len({a})"

    def slice(self, a: str, start: str, n: str) -> str:
        return f"list_slice({a}, {start}, {start} + {n} - 1)"

    def join(self, a: str, sep: str) -> str:
        return f"array_to_string({a}, {self.lit(sep)})"

    def position(self, a: str, value: str) -> str:
        return f"coalesce(list_position({a}, {value}), 0)"

    def reverse(self, a: str) -> str:
        return f"list_reverse({a})"

    def greatest_of(self, a: str) -> str:
        return f"list_max({a})"

    def pair(self, **fields: str) -> str:
        return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"

    def table(self, sf_dir: str, name: str) -> str:
        return name


SPARK, DUCK = Spark(), Duck()
