"""Column expressions shared by the operators. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# JSON texts that count as missing in a chain of alternatives.
FALSY_JSON = ["null", '""', "0", "0.0", "-0.0", "false", "{}", "[]"]

_SPACE = r"[\s\x1C-\x1F\x85\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def truthy(value: Column) -> Column:
    """Whether a VARIANT is there and neither null, empty, zero nor false; never null itself."""
    return F.coalesce(~F.to_json(value).isin(FALSY_JSON), F.lit(False))


def first_truthy(values: Sequence[Column], default: Column | None = None) -> Column:
    """The first truthy VARIANT; else the default, or the last alternative as it is."""
    # Through an array, so that each alternative is evaluated, and compiled, once.
    found = F.get(F.filter(F.array(*values), truthy), F.lit(0))
    return F.coalesce(found, values[-1] if default is None else default)


def holds(value: Column, test) -> Column:
    """test(value) as a boolean, with value evaluated once however often test refers to it; null counts as false."""
    return F.exists(F.array(value), lambda v: F.coalesce(test(v), F.lit(False)))


def at(variant: Column, path: str) -> Column:
    """The value at a path of a VARIANT, case-sensitive; null if there is none."""
    return F.try_variant_get(variant, f"$.{path}", "variant")


def typed(variant: Column, kind: str, path: str = "") -> Column:
    """The value at a path of a VARIANT as string, bigint or double; null if it doesn't convert or, for strings, is an object or list."""
    value = F.try_variant_get(variant, f"$.{path}" if path else "$", kind)
    if kind != "string":
        return value
    # Only what looks like an object or list pays for the question whether it is one.
    nested = F.schema_of_variant(at(variant, path) if path else variant).rlike("^(OBJECT|ARRAY)")
    return F.when(~F.substring(value, 1, 1).isin("{", "["), value).otherwise(F.when(~nested, value))


def truthy_text(text: Column, variant: Column) -> Column:
    """truthy(variant) where its text is known: only short texts that zero, false or an empty value could have look at the VARIANT."""
    unsure = (F.length(text) <= 5) & F.substring(text, 1, 1).isin("0", "-", "f", "{", "[", "n")
    return F.when(text.isNull() | (text == ""), False).when(unsure, truthy(variant)).otherwise(True)


def plain_text(text: Column, variant: Column) -> Column:
    """The text of a value, null if that is an object or list; only what looks like one looks at the VARIANT."""
    nested = F.schema_of_variant(variant).rlike("^(OBJECT|ARRAY)")
    return F.when(~F.substring(text, 1, 1).isin("{", "["), text).when(text.isNotNull() & ~nested, text)


def exploded(rows: DataFrame, column: str) -> DataFrame:
    """A row for each element of a VARIANT list, as pos and value in the list's place; none for anything that isn't a list.

    The list is walked as it is, without a round trip through text.
    """
    name = f"`{column}`"
    kept = ", ".join(f"t.`{c}`" for c in rows.columns if c != column)
    listed = rows.filter(F.schema_of_variant(F.col(name)).startswith("ARRAY"))
    return rows.sparkSession.sql(f"SELECT {kept}{', ' if kept else ''}e.pos, e.value FROM {{listed}} t, LATERAL variant_explode(t.{name}) e", listed=listed)


def ustrip(text: Column) -> Column:
    """text without white space at its ends, of any script."""
    return F.regexp_replace(text, f"^{_SPACE}|{_SPACE}$", "")


def folded(text: Column) -> Column:
    """For comparisons that ignore case and outer white space; accents count.

    Full case folding, up to which letter stands for a class: by way of capitals, so that ß is ss. The dotless i, whose capital
    is I, keeps apart under a character that no text has, and the final sigma is a sigma.
    """
    apart = F.upper(F.translate(ustrip(text), "ı", "\uFDD0"))
    return F.translate(F.lower(F.replace(apart, F.lit("ẞ"), F.lit("SS"))), "ς\uFDD0", "σı")


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def is_cnpj(text: Column) -> Column:
    return F.length(digits(text)) == 14


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def strict_double(text: Column) -> Column:
    """A decimal literal as a double; null for null and for anything else (see `rejected`)."""
    plain = ustrip(text)
    return F.when(plain.rlike(r"(?i)^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|nan|inf(inity)?)$"), plain.try_cast("double"))


def strict_long(text: Column) -> Column:
    plain = ustrip(text)
    return F.when(plain.rlike(r"^[+-]?\d+$"), plain.try_cast("long"))


def money_sum(value: Column, kind: str = "decimal(28,6)") -> Column:
    """A sum that doesn't depend on the order of rows: added up as decimals, then a double."""
    return F.sum(value.cast(kind)).cast("double")


def sha256_hex(body: Column) -> Column:
    return F.sha2(body, 256)


def safe_suffix(content_type: Column, url: Column) -> Column:
    """A file suffix from the content type, or else from the URL's path; '.bin' if there is none of 8 characters or fewer."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    name = F.regexp_replace(F.regexp_extract(F.regexp_replace(path, "/+$", ""), r"[^/]*$", 0), ";.*$", "")
    suffix = F.lower(F.regexp_extract(name, r"[^.](\.[^.]+)$", 1))
    return (
        F.when(F.contains(kind, F.lit("json")), ".json").when(F.contains(kind, F.lit("html")), ".html")
        .when(F.contains(kind, F.lit("pdf")), ".pdf").when((suffix != "") & (F.length(suffix) <= 8), suffix).otherwise(".bin")
    )


def canonical_json(columns: Sequence[str]) -> Column:
    """The columns as one JSON object with keys in order and nulls kept."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})
