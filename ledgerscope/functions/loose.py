"""Members of loose JSON records: read once, as texts, and settled by the VARIANT only where a text leaves a value open."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .expr import at, plain_text, truthy, truthy_text, typed


def name(key: str) -> str:
    """A field name that tells keys apart where names ignore case."""
    return "_" + key.encode().hex()


def members(record: Column, keys: Iterable[str]) -> Column:
    """The members of a VARIANT object as a struct of texts (JSON of nested values), all in one pass over it.

    A key a.b is a member of the object a, which is a struct of its own; null if a is no object.
    """
    tree: dict[str, list[str]] = {}
    for key in sorted(set(keys)):
        base, _, rest = key.partition(".")
        tree.setdefault(base, []).extend([rest] if rest else [])

    def schema(called) -> T.StructType:
        texts = lambda inner: T.StructType([T.StructField(called(k), T.StringType()) for k in inner]) if inner else T.StringType()
        return T.StructType([T.StructField(called(base), texts(inner)) for base, inner in tree.items()])

    return F.try_variant_get(record, "$", schema(str).simpleString()).cast(schema(name))


@dataclass(frozen=True)
class Loose:
    """A record and what was read of it.

    Keys are those of the record, or base.key for a member of one of its objects; `objects` says at which paths an
    object is looked for. `texts` has the struct of texts of the record (under "") and of each object, `there`
    whether each path but an object's last holds a truthy value.
    """

    record: Column
    objects: dict[str, list[str]]
    texts: dict[str, Column]
    there: dict[str, Column]

    def chosen(self, base: str, value) -> Column:
        """value(path) of the first path of an object with a truthy value, else of the last."""
        *tried, last = self.objects[base]
        found = value(last)
        for path in reversed(tried):
            found = F.when(self.there[path], value(path)).otherwise(found)
        return found

    def text(self, key: str) -> Column:
        base, _, rest = key.rpartition(".")
        return self.texts[base][name(rest)]

    def variant(self, key: str) -> Column:
        base, _, rest = key.rpartition(".")
        return self.chosen(base, lambda path: at(self.record, f"{path}.{rest}")) if base else at(self.record, rest)

    def truthy(self, key: str) -> Column:
        return truthy_text(self.text(key), self.variant(key))

    def typed(self, key: str, kind: str) -> Column:
        """The value of a key as string, bigint or double."""
        text = self.text(key)
        if kind == "string":
            return plain_text(text, self.variant(key))
        simple = text.rlike(r"^-?[0-9]{1,15}$" if kind == "bigint" else r"^-?[0-9]{1,15}([.][0-9]{1,10})?$")
        return F.when(simple, text.try_cast(kind)).when(text.isNotNull(), typed(self.variant(key), kind))

    def first(self, keys: list[str], kind: str, default: Column | None = None) -> Column:
        """The first truthy key; else the default, or the last key as it is."""
        *tried, last = keys
        if default is not None:
            tried, found = keys, default
        else:
            found = self.typed(last, kind)
        for key in reversed(tried):
            found = F.when(self.truthy(key), self.typed(key, kind)).otherwise(found)
        return found


def paths(keys: Iterable[str], objects: dict[str, list[str]]) -> list[str]:
    """Where the keys may lie in a record."""
    split = [key.rpartition(".") for key in keys]
    return [f"{path}.{rest}" for base, _, rest in split if base for path in objects[base]] + [rest for base, _, rest in split if not base]


def is_there(record: Column, read: Column, path: str, keys: Iterable[str]) -> Column:
    """Whether a path holds a truthy value: an object with one of the keys does, else the VARIANT is asked."""
    return F.coalesce(*[read[name(path)][name(k)] for k in keys]).isNotNull() | truthy(at(record, path))


def apart(column: Column) -> Column:
    """column as it is, in a form that keeps its projection out of whole-stage code.

    There all columns of a wide projection become one method; beyond 8,000 bytes of code the JVM interprets it for good. Outside,
    Spark splits the columns into methods that it compiles.
    """
    return F.get(F.transform(F.array(column), lambda value: value), F.lit(0))
