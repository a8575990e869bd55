"""Deeply nested records to flat, related tables by Merkle subtree identities.

Every object of a record (line item, check, issue, ...) gets the hash of its canonical form, computed bottom-up: the
hash of a parent is made from the hashes of its children. Identical objects share one hash and are stored once
(``objects``); every occurrence stays as one bridge row with its parent and its ordinal (``bridge``). With containers,
the arrays, maps and structs on the way, up to the record's root, are objects with bridge rows, too, so that every
parent identity has an object behind it. Every subtree is hashed once: a record costs as much as it is long.

Defined results: a NULL array or map gives no rows; a NULL element keeps its place (the ordinal counts it) and has
the hash NULL; an empty struct is an object like any other; repeated records give repeated bridge rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from albaran.session import settle

NULL_MARK = "~"


def canonical(c: Column, kind: T.DataType) -> Column:
    """Reference of a value inside its parent's canonical form: a leaf in length-prefixed text, an object by its hash.

    NULL for NULL. Field order of structs and entry order of maps do not matter; array order does.
    """
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return merkle_hash(c, kind)
    text = c.cast("string")
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def merkle_hash(c: Column, kind: T.DataType) -> Column:
    """SHA-256 identity of the subtree at c; NULL for NULL."""
    if isinstance(kind, T.StructType):
        parts: list[Column] = [F.lit("S")]
        for f in sorted(kind.fields, key=lambda f: f.name):
            parts += [F.lit(f"|{f.name}="), F.coalesce(canonical(c.getField(f.name), f.dataType), F.lit(NULL_MARK))]
        body = F.concat(*parts)
    elif isinstance(kind, T.ArrayType):
        each = F.transform(c, lambda x: F.coalesce(canonical(x, kind.elementType), F.lit(NULL_MARK)))
        body = F.concat(F.lit("A|"), F.array_join(each, "|"))
    elif isinstance(kind, T.MapType):
        entries = F.array_sort(
            F.transform(
                F.map_entries(c),
                lambda e: F.concat(
                    canonical(e["key"], kind.keyType), F.lit("="), F.coalesce(canonical(e["value"], kind.valueType), F.lit(NULL_MARK))
                ),
            )
        )
        body = F.concat(F.lit("M|"), F.array_join(entries, "|"))
    else:
        body = F.concat(F.lit("L|"), canonical(c, kind))
    return F.when(c.isNotNull(), F.sha2(body, 256))


def _array_body(hashes: Column) -> Column:
    """The canonical form of an array of structs from the identities of its elements."""
    return F.concat(F.lit("A|"), F.array_join(hashes, "|", NULL_MARK))


@dataclass(frozen=True)
class Child:
    """One kind of child rows.

    path: dotted path of an array or map column. inner: field of the array's structs that is itself an array; its
    elements are the children then and their parent is the place of the struct. parent: from (record columns, element)
    to the text of the column ``parent``.
    """

    kind: str
    path: str
    inner: str | None = None
    parent: Callable[[Column], Column] | None = None


def _type_at(schema: T.StructType, path: str) -> T.DataType:
    kind: T.DataType = schema
    for step in path.split("."):
        kind = kind[step].dataType  # type: ignore[index]
    return kind


ROW = "struct<child:string,pos:string,parent:string,parent_hash:string,child_hash:string,payload:string>"


def _row(kind: str, pos: Column, parent: Column, up: Column, own: Column, payload: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("child"), pos.alias("pos"), parent.alias("parent"), up.alias("parent_hash"), own.alias("child_hash"), payload.alias("payload")
    )


def _json(x: Column, kind: T.DataType) -> Column:
    return F.to_json(x) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else x.cast("string")


def _container(path: str, up: Column, own: Column, payload: Column) -> Column:
    return _row(path, F.lit(""), F.lit(""), up, own, payload)


def _hashed(df: DataFrame, children: list[Child], containers: bool) -> tuple[DataFrame, dict[str, Column], dict[str, Column], dict[str, Column]]:
    """df with the identities of its subtrees, and by path: the elements' identities, the containers' and their canonical forms."""
    schema = df.schema
    elements: dict[str, Column] = {}
    own: dict[str, Column] = {}
    forms: dict[str, Column] = {}
    steps: list[dict[str, Column]] = [{}, {}]
    paths = list(dict.fromkeys(c.path for c in children))
    for i, path in enumerate(paths):
        kind, at = _type_at(schema, path), F.col(path)
        own[path] = F.col(f"_own{i}")
        if isinstance(kind, T.ArrayType):
            inner = kind.elementType
            steps[0][f"_each{i}"] = F.transform(at, lambda x, k=inner: merkle_hash(x, k))
            elements[path] = F.col(f"_each{i}")
            nested = isinstance(inner, (T.StructType, T.ArrayType, T.MapType))
            steps[1][f"_own{i}"] = F.when(at.isNotNull(), F.sha2(_array_body(elements[path]), 256)) if nested else merkle_hash(at, kind)
            forms[path] = _array_body(elements[path]) if nested else F.to_json(at)
        else:
            steps[1][f"_own{i}"] = merkle_hash(at, kind)
            forms[path] = F.to_json(at)
    if containers:
        # the structs on the way, deepest first, and the record itself (path "")
        ways = {".".join(p.split(".")[:n]) for p in paths for n in range(len(p.split(".")))}
        for n, way in enumerate(sorted(ways, key=lambda w: (-len(w.split(".")) * bool(w), w))):
            if way:
                kind, inside = _type_at(schema, way), [f"{way}.{f.name}" for f in sorted(_type_at(schema, way).fields, key=lambda f: f.name)]
            else:
                inside = sorted({p.split(".")[0] for p in paths})
            parts = [F.lit("S")]
            for p in inside:
                ref = own.get(p, None)
                ref = canonical(F.col(p), _type_at(schema, p)) if ref is None else ref
                parts += [F.lit(f"|{p.rsplit('.', 1)[-1]}="), F.coalesce(ref, F.lit(NULL_MARK))]
            form = F.concat(*parts)
            steps += [{f"_form{n}": form}, {f"_way{n}": F.when(F.col(way).isNotNull() if way else F.lit(True), F.sha2(F.col(f"_form{n}"), 256))}]
            own[way], forms[way] = F.col(f"_way{n}"), F.col(f"_form{n}")
    for step in steps:
        df = df.withColumns(step)
    # computed above this point: a lambda that named an expression would compute it for every element
    return settle(df, *[c for step in steps for c in step]), elements, own, forms


def _occurrences(schema: T.StructType, child: Child, elements: dict[str, Column], own: dict[str, Column], with_payload: bool) -> Column:
    """Array of the child rows of one record."""
    kind, at, up = _type_at(schema, child.path), F.col(child.path), own[child.path]
    say = _json if with_payload else lambda x, t: F.lit(None).cast("string")
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return F.transform(
            F.map_entries(at), lambda e: _row(child.kind, e["key"].cast("string"), F.lit(""), up, merkle_hash(e, entry), say(e, entry))
        )
    outer, each = kind.elementType, elements[child.path]
    if child.inner is None:
        parent = child.parent or (lambda x: F.lit(""))
        return F.transform(
            at, lambda x, i: _row(child.kind, (i + 1).cast("string"), parent(x), up, F.get(each, i), say(x, outer))
        )
    inner = outer[child.inner].dataType.elementType
    return F.flatten(
        F.transform(
            at,
            lambda x, i: F.coalesce(
                F.transform(
                    x.getField(child.inner),
                    lambda y, j: _row(child.kind, (j + 1).cast("string"), (i + 1).cast("string"), F.get(each, i), merkle_hash(y, inner), say(y, inner)),
                ).cast(f"array<{ROW}>"),
                F.array().cast(f"array<{ROW}>"),
            ),
        )
    )


def bridge(df: DataFrame, src: str, row_id: str, children: list[Child], with_payload: bool = False, containers: bool = False) -> DataFrame:
    """All parent-child occurrences of the records, NULL places included (child_hash NULL): no shuffle, one pass.

    Columns: src, row_id, child, pos (place from 1, or the map key), parent, parent_hash (of the record's containing
    array, or of the outer object), child_hash, and payload (JSON, only with_payload; of arrays of objects and of structs
    the canonical form with the identities of what they hold). With containers, there is a row for each array, map and
    struct that is there, too: child is its path, pos and parent are ''; the record itself is the child 'record', whose
    parent_hash is NULL.
    """
    schema = df.schema
    df, elements, own, forms = _hashed(df, children, containers)
    rows = [F.coalesce(_occurrences(schema, c, elements, own, with_payload).cast(f"array<{ROW}>"), F.array().cast(f"array<{ROW}>")) for c in children]
    if containers:
        none = F.lit(None).cast("string")
        ups = {p: own[p.rpartition(".")[0]] if p else none for p in own}
        each = [F.when(own[p].isNotNull(), _container(p or "record", ups[p], own[p], forms[p] if with_payload else none)) for p in own]
        rows.append(F.array_compact(F.array(*each)).cast(f"array<{ROW}>"))
    out = df.select(F.lit(src).alias("src"), F.col(row_id).cast("bigint").alias("row_id"), F.explode_outer(F.concat(*rows)).alias("_child"))
    # explode_outer, so that no filter on the array's size makes Spark build the array twice
    out = out.where(F.col("_child").isNotNull()).select("src", "row_id", "_child.*")
    return out if with_payload else out.drop("payload")


def objects(occurrences: DataFrame) -> DataFrame:
    """Each distinct object once: child, child_hash, payload and the number of its occurrences (pre-aggregated map-side)."""
    return (
        occurrences.where(F.col("child_hash").isNotNull())
        .groupBy("child", "child_hash")
        .agg(F.min("payload").alias("payload"), F.count(F.lit(1)).alias("occurrences"))
    )


def found(occurrences: DataFrame) -> DataFrame:
    """The occurrences of objects that are there, without the hashes."""
    return occurrences.where(F.col("child_hash").isNotNull()).select("src", "row_id", "child", "pos", "parent")


def line_check_parent(x: Column) -> Column:
    """The check's line number where a line item of the record stands at that place, else ''."""
    n = x.getField("line_number")
    there = F.get(F.col("line_items"), n - 1).isNotNull() & (n >= 1)
    return F.coalesce(F.when(there, n.cast("string")), F.lit(""))


EXTRACTED = [Child("line_item", "line_items")]
VALIDATED = [
    Child("line_item", "line_items"),
    Child("error", "validation.errors"),
    Child("warning", "validation.warnings"),
    Child("field_check", "validation.field_checks"),
    Child("line_check", "validation.line_item_checks", parent=line_check_parent),
    Child("line_issue", "validation.line_item_checks", inner="issues"),
    Child("ocr_issue", "validation.ocr_checks.issues"),
]
