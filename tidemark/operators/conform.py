"""Raw rows to typed rows, driven by a table of fields instead of one function per model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.operators.snapshot import LOAD_ID, snapshot_rows

# How a raw value becomes a typed one. "number_text" is a decimal that arrives as text;
# "json" is a nested value kept whole as text; the rest are plain casts.
KINDS = {
    "long": "bigint",
    "double": "double",
    "text": "string",
    "flag": "boolean",
    "date": "date",
    "time": "timestamp",
    "number_text": "double",
    "json": "string",
}


@dataclass(frozen=True)
class Field:
    """One output column: `source` is a column or a dotted path into a struct or document."""

    source: str
    name: str
    kind: str

    def expression(self, types: dict[str, str]) -> str:
        """The column as SQL text; `types` holds the raw column types by lower-cased name."""
        target = KINDS[self.kind]
        parent, _, path = self.source.partition(".")
        if parent.lower() not in types:
            return f"CAST(NULL AS {target}) AS `{self.name}`"
        value = f"`{parent}`"
        if path and types[parent.lower()] == "variant":
            inside = "variant" if self.kind == "json" else target
            value = f"variant_get({value}, '$.{path}', '{inside}')"
        elif path:
            value = f"{value}.`{path}`"
        if self.kind == "number_text":
            value = f"nullif(trim({value}), '')"
        if self.kind == "json":
            return f"to_json({value}, map('ignoreNullFields', 'false')) AS `{self.name}`"
        return f"CAST({value} AS {target}) AS `{self.name}`"


@dataclass(frozen=True)
class Derived:
    """One output column computed from conformed ones, as SQL text, placed after `after`."""

    name: str
    after: str
    expression: str


def fields(kind: str, *names: str | tuple[str, str]) -> list[Field]:
    """Fields of one kind; a pair renames, a bare name is kept."""
    pairs = [(n, n) if isinstance(n, str) else n for n in names]
    return [Field(source, name, kind) for source, name in pairs]


def conform(
    raw: DataFrame,
    spec: Sequence[Field],
    load_id: str,
    derived: Sequence[Derived] = (),
) -> DataFrame:
    """One load of a raw table as a typed table: rename, cast, derive, keep the load id.

    Fields the raw frame lacks come out as typed NULLs, so the output schema never moves. Casts
    are strict: text that is not a number, a date or a time stops the build.
    """
    types = {f.name.lower(): f.dataType.simpleString() for f in raw.schema}
    typed = snapshot_rows(raw, load_id).selectExpr(
        *[f.expression(types) for f in spec], f"`{LOAD_ID}` AS load_id"
    )
    if not derived:
        return typed
    order = [f.name for f in spec]
    for extra in derived:
        order.insert(order.index(extra.after) + 1, extra.name)
    extras = {d.name: f"{d.expression} AS `{d.name}`" for d in derived}
    return typed.selectExpr(*[extras.get(n, f"`{n}`") for n in order], "load_id")
