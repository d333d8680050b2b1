"""Named-field patterns compiled to one Java regular expression with positional groups.

Field names such as ``close-reason``, or one name used twice, are legal in patterns but not as
Java group names, so groups are numbered and the names are kept beside them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.functions import grok_library
from docflow.functions.let import let

_REFERENCE = re.compile(r"%\{(\w+)(?::([^}:]+))?(?::(\w+))?\}")
_CASTS = {"int": "bigint", "long": "bigint", "float": "double", "double": "double", "string": "string"}
# Separates the groups of one match: a run of one control character between two of another.
_RUN, _END = "\u0001", "\u0002"
_MARK = _END + _RUN + _END


def parse_library(text: str) -> dict[str, str]:
    """Read ``NAME regex`` lines; blank lines and ``#`` comments are ignored."""
    library = {}
    for line in text.split("\n"):
        line = line.rstrip("\r")
        if line.strip() and not line.startswith("#"):
            name, _, body = line.partition(" ")
            library[name] = body
    return library


@lru_cache(maxsize=1)
def _builtin() -> dict[str, str]:
    library = {}
    for group in grok_library.GROUPS:
        library.update(parse_library(group))
    return library


def builtin_library() -> dict[str, str]:
    """All built-in definitions by name."""
    return dict(_builtin())


def load_library(path: str) -> dict[str, str]:
    """Built-in definitions extended (or overridden) by those of a text file."""
    with open(path, encoding="utf-8") as handle:
        return {**builtin_library(), **parse_library(handle.read())}


@dataclass
class Grok:
    """A compiled pattern.

    ``fields`` maps each field to the group numbers that may fill it; the first non-empty one
    wins. An unmatched or empty group gives NULL. Matching is an unanchored, leftmost find unless
    ``full_match`` is set, which is needed when the pattern ends in a lazy ``%{DATA}``.
    """

    pattern: str
    library: dict[str, str] | None = None
    full_match: bool = False
    regex: str = ""
    groups: int = 0
    fields: dict[str, list[int]] = field(default_factory=dict)
    casts: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        definitions = builtin_library() if self.library is None else {**builtin_library(), **self.library}
        self.regex = self._number_groups(self._expand(self.pattern, definitions, ()))

    def _expand(self, pattern: str, definitions: dict[str, str], open_names: tuple[str, ...]) -> str:
        def replace(match: re.Match) -> str:
            name, target, cast = match.groups()
            if name not in definitions:
                raise ValueError(f"unknown pattern %{{{name}}}")
            if name in open_names:
                raise ValueError(f"pattern %{{{name}}} refers to itself")
            body = self._expand(definitions[name], definitions, (*open_names, name))
            if target is None:
                return f"(?:{body})"
            if cast:
                if cast not in _CASTS:
                    raise ValueError(f"unknown field type {cast!r}")
                self.casts[target] = _CASTS[cast]
            return f"(?<{target}>{body})"

        return _REFERENCE.sub(replace, pattern)

    def _number_groups(self, regex: str) -> str:
        """Turn named groups into numbered ones and every other group into a non-capturing one."""
        out, at, in_class = [], 0, False
        while at < len(regex):
            char = regex[at]
            if char == "\\":
                if not in_class and regex[at + 1 : at + 2].isdigit() and regex[at + 1] != "0":
                    raise ValueError("back-references are not supported")
                out.append(regex[at : at + 2])
                at += 2
                continue
            if in_class:
                in_class = char != "]"
            elif char == "[":
                in_class = True
                # A bracket right after the opening (or its negation) is a literal member.
                lead = re.match(r"\[\^?\]?", regex[at:]).group(0)
                out.append(lead.replace("]", r"\]"))
                at += len(lead)
                continue
            elif char == "(":
                name = re.match(r"\(\?<(?![=!])([^>]+)>", regex[at:])
                if name:
                    self.groups += 1
                    self.fields.setdefault(name.group(1), []).append(self.groups)
                    out.append("(")
                    at += name.end()
                    continue
                if regex[at + 1 : at + 2] != "?":
                    out.append("(?:")
                    at += 1
                    continue
            out.append(char)
            at += 1
        return "".join(out)

    @property
    def search_regex(self) -> str:
        return rf"\A(?:{self.regex})\z" if self.full_match else self.regex

    def matches(self, text: Column) -> Column:
        return F.coalesce((F.length(text) > 0) & text.rlike(self.search_regex), F.lit(False))

    def _groups(self, text: Column) -> Column:
        """All groups of the match as an array, after one empty element; shorter without a match.

        One run of the regular expression returns every group: the match is replaced by its own
        groups, separated by a mark, and split again.
        """
        whole = self.search_regex if self.full_match else rf"(?s:\A.*?)(?:{self.regex})(?s:.*)\z"
        template = _MARK + _MARK.join(f"${i}" for i in range(1, self.groups + 1))
        # A run longer than any in the text cannot be confused with the text itself.
        longest = F.array_max(F.transform(F.regexp_extract_all(text, F.lit(f"{_RUN}+"), F.lit(0)), F.length))
        longer = F.concat(F.lit(_END), F.repeat(F.lit(_RUN), longest + 1), F.lit(_END))
        mark = F.when(text.contains(_RUN), longer).otherwise(F.lit(_MARK))
        replaced = F.regexp_replace(text, F.lit(whole), F.replace(F.lit(template), F.lit(_MARK), mark))
        # A text that does not match comes back unchanged and therefore in one piece.
        return F.when(F.length(text) > 0, F.split(replaced, mark))

    def extract(self, text: Column) -> Column:
        """STRUCT of all fields, NULL where the text is empty or does not match."""
        return let(self._groups(text), lambda g: F.when(F.size(g) > 1, F.struct(*self._columns(g))))

    def _columns(self, groups: Column) -> list[Column]:
        columns = []
        for name, numbers in self.fields.items():
            values = [F.nullif(F.get(groups, F.lit(i)), F.lit("")) for i in numbers]
            value = F.coalesce(*values) if len(values) > 1 else values[0]
            columns.append(value.try_cast(self.casts.get(name, "string")).alias(name))
        return columns or [F.lit(True).alias("matched")]

    def extract_map(self, text: Column) -> Column:
        """MAP of the fields that have a value, NULL where the text does not match.

        Wide or alternative layouts are cheaper this way than as a struct of many columns.
        """
        names = dict(sorted((number, name) for name, numbers in self.fields.items() for number in numbers))
        # Field names never hold a line feed; the split of a literal is folded into a constant.
        keys = F.split(F.lit("\n".join(names.values())), "\n") if names else F.array().cast("array<string>")

        def to_map(groups: Column) -> Column:
            pairs = F.zip_with(keys, F.slice(groups, 2, self.groups), lambda k, v: F.struct(k.alias("key"), v.alias("value")))
            # Reversed, because the last of equal keys is kept and the first non-empty one must win.
            filled = F.reverse(F.filter(pairs, lambda p: p["value"] != ""))
            return F.when(F.size(groups) > 1, F.map_from_entries(filled))

        return let(self._groups(text), to_map)


def iso_utc(value: Column, date_format: str) -> Column:
    """Re-write a date read as UTC with ``date_format`` in ISO-8601; NULL when unreadable."""
    parsed = F.try_to_timestamp(value, F.lit(date_format))
    return F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def is_token(text: Column, name: str, library: dict[str, str] | None = None) -> Column:
    """Whether the whole text is one occurrence of a named pattern."""
    return text.rlike(Grok(f"%{{{name}}}", library, full_match=True).search_regex)


def tokens(text: Column, name: str, library: dict[str, str] | None = None) -> Column:
    """Every substring of the whole text that a named pattern matches, left to right."""
    return F.regexp_extract_all(text, F.lit(Grok(f"%{{{name}}}", library).regex), F.lit(0))
