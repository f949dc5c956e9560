"""Readers over VARIANT columns with the source's loose typing.

Payload fields arrive as numbers, quoted numbers, booleans, nulls or not at
all. These helpers state what each use of a field means, so that a surprising
type becomes NULL or false and never a failed task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(rows: DataFrame, keep: Sequence[str], **columns: Column) -> DataFrame:
    """Select ``keep`` plus computed columns that later filters may not see through.

    Catalyst moves a filter below the projection it reads from by copying the
    projected expression into it, which would parse a document once per mention
    in the predicate. A one-row generator is a boundary that filters stay above.
    """
    computed = F.struct(*[value.alias(name) for name, value in columns.items()])
    return rows.select(*keep, F.inline(F.array(computed)))


def _path(*keys: str) -> str:
    return "$" + "".join(f"['{key}']" for key in keys)


def node(doc: Column, *keys: str) -> Column:
    """The VARIANT at a key path: SQL NULL when missing, a VARIANT null when present and null."""
    return F.try_variant_get(doc, _path(*keys), "variant")


def text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def integer(value: Column) -> Column:
    """Whole number out of a number, quoted number or boolean; anything else is NULL.

    Fractions truncate towards zero; a quoted fraction is not a whole number.
    """
    return F.try_variant_get(value, "$", "bigint")


def read(payload: Column, shape: str) -> Column:
    """Fields of a JSON text in one tokenizer pass that skips everything ``shape`` leaves out.

    ``variant`` leaves keep the JSON type, including a present null; a leaf
    that does not fit is NULL and leaves its neighbours alone.
    """
    return F.from_json(payload, shape)


def typed(doc: Column, shape: str, *keys: str) -> Column:
    """The value at a key path of an opened document, cast to a struct or array leaf by leaf."""
    return F.try_variant_get(doc, _path(*keys), shape)


def kind(doc: Column) -> Column:
    return F.schema_of_variant(doc)


def is_object(doc: Column) -> Column:
    return F.coalesce(F.startswith(kind(doc), F.lit("OBJECT<")), F.lit(False))


# JSON text of the values that count as nothing; a string always carries its quotes.
_NOTHING = r'^(null|false|""|\[\]|\{\}|-?0(\.0*)?(E-?\d+)?)$'


def truthy(value: Column) -> Column:
    """Presence with substance: not missing, null, false, zero or empty.

    Every non-empty string counts, including ``"false"`` and ``"0"``.
    """
    return F.coalesce(~F.to_json(value).rlike(_NOTHING), F.lit(False))


def is_false(value: Column) -> Column:
    """True only for a JSON ``false``; a missing or otherwise falsy value is not it."""
    return F.coalesce(F.to_json(value) == "false", F.lit(False))


def dual_shape(doc: Column, parent: str, leaf: str) -> Column:
    """A VARIANT leaf that is either flattened (``"parent.leaf"``) or nested.

    The flattened key wins whenever it exists, even with a null value: the
    VARIANT null is not SQL NULL, so ``coalesce`` stops there.
    """
    return F.coalesce(doc.getField(f"{parent}.{leaf}"), doc[parent][leaf])


def dual_schema(parent: str, *leaves: str) -> str:
    """Schema that reads both placements of the leaves."""
    flat = ", ".join(f"`{parent}.{leaf}`: variant" for leaf in leaves)
    nested = ", ".join(f"{leaf}: variant" for leaf in leaves)
    return f"struct<{flat}, {parent}: struct<{nested}>>"
