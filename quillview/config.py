"""Tag language in table and column comments, and the specifications it declares.

    table    index:"docType,all"  index:"-"  join:"field,type"  inline:"name,field,addScript,delScript"
    column   index:"field,pk|id|routing"  index:"-"  join:"name|parent"  inline:"name,pk|parent|routing"
"""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass, field

log = logging.getLogger(__name__)


class TagSyntaxError(ValueError):
    """A comment is not in the tag language."""


class ConfigError(ValueError):
    """Tags contradict each other or leave something necessary out."""


@dataclass(frozen=True)
class Tag:
    name: str
    values: tuple[str, ...]

    def value(self, k: int) -> str:
        return self.values[k] if k < len(self.values) else ""


_NAME = re.compile(r'[^\s:"\x00-\x1f\x7f]+(?=:")')
_QUOTED = re.compile(r'"(?:[^"\\\n]|\\.)*"')
# Escapes of a quoted string; \x and octal ones are bytes, \u and \U code points.
_ESCAPE = re.compile(rb'\\(?:([abfnrtv\\"])|x([0-9a-fA-F]{2})|([0-3][0-7]{2})|u([0-9a-fA-F]{4})|U([0-9a-fA-F]{8})|(.?))', re.S)
_CHARACTERS = {b"a": b"\a", b"b": b"\b", b"f": b"\f", b"n": b"\n", b"r": b"\r", b"t": b"\t", b"v": b"\v", b"\\": b"\\", b'"': b'"'}


def unquote(quoted: str) -> str:
    """The text of a quoted string. Bytes that are no UTF-8 become replacement characters."""

    def one(m: re.Match) -> bytes:
        simple, hexadecimal, octal, short, long, _ = m.groups()
        if simple:
            return _CHARACTERS[simple]
        if hexadecimal or octal:
            return bytes([int(hexadecimal, 16) if hexadecimal else int(octal, 8)])
        if short or long:
            point = int(short or long, 16)
            if point <= 0x10FFFF and not 0xD800 <= point < 0xE000:
                return chr(point).encode()
        raise TagSyntaxError(f"bad escape in {quoted}")

    return _ESCAPE.sub(one, quoted[1:-1].encode()).decode(errors="replace")


def parse_tags(comment: str | None) -> list[Tag]:
    """Tags of a comment; ``#`` or four spaces in a row begin free text that is ignored."""
    text, at, out = comment or "", 0, []
    while True:
        start = at
        while at < len(text) and text[at] == " ":
            at += 1
        if at == len(text) or text[at] == "#" or at - start > 3:
            return out
        name = _NAME.match(text, at)
        quoted = name and _QUOTED.match(text, name.end() + 1)
        if not quoted:
            raise TagSyntaxError(f"not a tag at {at}: {text[at : at + 40]!r}")
        out.append(Tag(name[0], tuple(unquote(quoted[0]).split(","))))
        at = quoted.end()


def find(tags: list[Tag], name: str) -> list[Tag]:
    return [t for t in tags if t.name == name]


def first(tags: list[Tag], name: str) -> Tag | None:
    return next(iter(find(tags, name)), None)


@dataclass
class ColumnSpec:
    name: str
    field: str = ""
    indexed: bool = False
    in_key: bool = False  # part of the table's own primary key
    old_in_log: bool = False  # the log has its old value for updates and deletes

    def __post_init__(self) -> None:
        self.field = self.field or self.name


@dataclass
class JoinSpec:
    field: str = "join"
    type_name: str = ""
    type_column: str | None = None
    parent_column: str | None = None


@dataclass
class InlineSpec:
    """Rows of ``source`` as objects in an array of the documents of ``parent``."""

    name: str
    parent: str
    field: str
    add: str = "inline_add"
    remove: str = "inline_del"
    source: str | None = None
    pk: str | None = None
    parent_column: str | None = None
    routing: str | None = None
    columns: list[str] = field(default_factory=list)
    aliases: dict[str, str] = field(default_factory=dict)  # kept, without effect on the output
    upsert_only: bool = False


@dataclass
class TableSpec:
    name: str
    schema: str = "public"
    columns: dict[str, ColumnSpec] = field(default_factory=dict)
    doc_type: str = ""
    indexed: bool = True
    index_all: bool = False
    pk: str | None = None
    prefix_id: bool = True
    routing: str | None = None
    join: JoinSpec | None = None
    inlines: list[InlineSpec] = field(default_factory=list)  # arrays of its own documents
    inlined_in: list[InlineSpec] = field(default_factory=list)  # arrays that its rows go to
    upsert_only: bool = False

    def __post_init__(self) -> None:
        self.doc_type = self.doc_type or self.name

    @property
    def document_columns(self) -> list[ColumnSpec]:
        return [c for c in self.columns.values() if c.indexed]

    @property
    def needed_columns(self) -> list[str]:
        """Columns to read: the indexed ones, those of inlines, and every key, each once."""
        wanted = [c.name for c in self.columns.values() if c.indexed and self.indexed]
        if self.indexed:
            wanted += [x for x in (self.pk, self.routing) if x]
            if self.join:
                wanted += [x for x in (self.join.type_column, self.join.parent_column) if x]
        for i in self.inlined_in:
            wanted += [*i.columns, *(x for x in (i.pk, i.parent_column, i.routing) if x)]
        return list(dict.fromkeys(wanted))


@dataclass
class Config:
    database: str
    tables: dict[tuple[str, str], TableSpec]

    def table(self, name: str, schema: str = "public") -> TableSpec:
        return self.tables[schema, name]

    def index_name(self, schema: str) -> str:
        return self.database if schema == "public" else f"{self.database}_{schema}"

    def ordered(self) -> list[TableSpec]:
        """Tables that make documents or feed inlines, parents before their sources."""
        wanted = {k: t for k, t in self.tables.items() if t.indexed or t.inlined_in}
        out: list[TableSpec] = []
        state: dict[tuple[str, str], int] = {}

        def visit(key: tuple[str, str]) -> None:
            if state.get(key) == 2 or key not in wanted:
                return
            if state.get(key) == 1:
                log.warning("tables inline each other in a circle at %s", key)
                return
            state[key] = 1
            for i in sorted(wanted[key].inlined_in, key=lambda i: i.name):
                if i.parent != key[1]:
                    visit((key[0], i.parent))
            state[key] = 2
            out.append(wanted[key])

        for key in sorted(wanted):
            visit(key)
        return out

    def describe(self) -> list[dict]:
        """A row per table for display."""
        return [
            {
                "schema": t.schema, "table": t.name, "doc_type": t.doc_type, "indexed": t.indexed, "pk": t.pk, "routing": t.routing,
                "fields": ",".join(c.field for c in t.document_columns), "upsert_only": t.upsert_only,
                "inlines": ",".join(i.name for i in t.inlines), "inlined_in": ",".join(i.name for i in t.inlined_in),
            }
            for t in self.ordered()
        ]


def _table_tags(spec: TableSpec, tags: list[Tag], inlines: dict[tuple[str, str], InlineSpec]) -> None:
    if tag := first(tags, "index"):
        if tag.value(0) == "-":
            spec.indexed = False
        else:
            spec.doc_type = tag.value(0) or spec.doc_type
        spec.index_all = "all" in tag.values[1:]
    if tag := first(tags, "join"):
        spec.join = JoinSpec(tag.value(0) or "join", tag.value(1) or spec.doc_type)
    for tag in find(tags, "inline"):
        name = tag.value(0)
        if not name:
            raise ConfigError(f"inline of {spec.name} has no name")
        made = InlineSpec(name, spec.name, tag.value(1) or name)
        if len(tag.values) > 3:
            made.add, made.remove = tag.value(2) or made.add, tag.value(3) or made.remove
        if (spec.schema, name) in inlines:
            raise ConfigError(f"inline {name} is declared twice in {spec.schema}")
        inlines[spec.schema, name] = made
        spec.inlines.append(made)


def _column_tags(spec: TableSpec, column: ColumnSpec, tags: list[Tag], inlines: dict[tuple[str, str], InlineSpec]) -> None:
    if tag := first(tags, "index"):
        if tag.value(0) == "-":
            column.indexed = False
        else:
            column.indexed = True
            column.field = tag.value(0) or column.field
            for option in tag.values[1:]:
                if option in ("pk", "id"):
                    spec.pk, spec.prefix_id = column.name, option == "pk"
                elif option == "routing":
                    spec.routing = column.name
                elif option:
                    raise ConfigError(f"unknown option {option!r} at {spec.name}.{column.name}")
    for tag in find(tags, "join"):
        spec.join = spec.join or JoinSpec("join", spec.doc_type)
        if tag.value(0) == "name":
            spec.join.type_column = column.name
        elif tag.value(0) == "parent":
            spec.join.parent_column = column.name
        else:
            raise ConfigError(f"join of {spec.name}.{column.name} must say name or parent")
    for tag in find(tags, "inline"):
        made = inlines.get((spec.schema, tag.value(0)))
        if made is None:
            raise ConfigError(f"inline {tag.value(0)!r} is declared on no table of {spec.schema}")
        if made.source not in (None, spec.name):
            raise ConfigError(f"inline {made.name} has two sources, {made.source} and {spec.name}")
        made.source = spec.name
        if made not in spec.inlined_in:
            spec.inlined_in.append(made)
        made.columns.append(column.name)
        for option in tag.values[1:]:
            if option == "pk":
                made.pk = column.name
            elif option == "parent":
                made.parent_column = column.name
            elif option == "routing":
                made.routing = column.name
            elif option:
                made.aliases[option] = column.name


def _finish(spec: TableSpec) -> None:
    keys = [c.name for c in spec.columns.values() if c.in_key]
    if spec.indexed and spec.pk is None:
        if len(keys) != 1:
            raise ConfigError(f"{spec.name} needs a column with option pk or id: its key is {keys}")
        spec.pk = keys[0]
    kept = lambda c: c is None or spec.columns[c].old_in_log
    spec.upsert_only = not (kept(spec.pk) and kept(spec.routing))
    for i in spec.inlined_in:
        if i.parent_column is None:
            raise ConfigError(f"inline {i.name} has no parent column")
        i.pk = i.pk or spec.pk or (keys[0] if len(keys) == 1 else None)
        if i.pk is None:
            raise ConfigError(f"inline {i.name} has no key column")
        i.upsert_only = not (kept(i.pk) and kept(i.parent_column) and kept(i.routing))


def build_config(database: str, rows: list[dict]) -> Config:
    """``rows``: schema, table, column, table_comment, column_comment, pk, old_in_log, in column order.

    Free-text comments declare nothing; they are logged.
    """

    def tags(comment: str | None, where: str) -> list[Tag]:
        try:
            return parse_tags(comment)
        except TagSyntaxError:
            log.warning("comment of %s is no tag, ignored", where)
            return []

    tables: dict[tuple[str, str], TableSpec] = {}
    inlines: dict[tuple[str, str], InlineSpec] = {}
    for r in rows:
        key = r["schema"], r["table"]
        if key not in tables:
            tables[key] = TableSpec(r["table"], r["schema"])
            _table_tags(tables[key], tags(r.get("table_comment"), r["table"]), inlines)
        t = tables[key]
        t.columns[r["column"]] = ColumnSpec(r["column"], indexed=t.index_all, in_key=bool(r.get("pk")), old_in_log=bool(r.get("old_in_log")))
    for r in rows:
        t = tables[r["schema"], r["table"]]
        _column_tags(t, t.columns[r["column"]], tags(r.get("column_comment"), f"{t.name}.{r['column']}"), inlines)
    for t in tables.values():
        _finish(t)
    return Config(database, tables)
