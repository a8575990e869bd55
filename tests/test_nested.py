"""Merkle identities and bridge rows against a plain walk over the records."""

import json

from pyspark.sql import functions as F

from albaran.operators import nested

SCHEMA = """val_id bigint, line_items array<struct<description:string,quantity:string,unit_price:string,total_price:string>>,
validation struct<is_valid:boolean,errors:array<string>,warnings:array<string>,math_checks:map<string,boolean>,field_checks:map<string,boolean>,
line_item_checks:array<struct<line_number:int,description:string,is_valid:boolean,issues:array<string>,matches_price:boolean>>,
ocr_checks:struct<has_garbled_text:boolean,has_missing_rows:boolean,confidence_very_low:boolean,issues:array<string>>>, child string, extra int"""

ITEM = ("pipe", "1", "2", "2")
ROWS = [
    (1, [ITEM, None, ITEM], (True, ["e1", None, "e1"], [], {}, {"a": True, "b": None}, [(1, "x", True, ["i", None], None), None, (2, "y", True, None, None), (9, "z", True, [], None)], (None, None, None, ["o"])), "c", 1),
    (2, None, None, "c", 2),
    (3, [], (None, None, None, None, None, None, None), "c", 3),
    (1, [ITEM], (True, [], [], {}, {}, [], None), "c", 4),
    (4, [(None, None, None, None)], (True, ["", "e1"], ["w"], {}, {}, [(0, None, None, ["i"], None)], None), "c", 5),
]


def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def expected():
    out = []
    for vid, items, v, _, _ in ROWS:
        items = items or []
        out += [(vid, "line_item", str(i), "") for i, x in enumerate(items, 1) if x is not None]
        if not v:
            continue
        _, errors, warnings, _, checks, lines, ocr = v
        out += [(vid, "error", str(i), "") for i, x in enumerate(errors or [], 1) if x is not None]
        out += [(vid, "warning", str(i), "") for i, x in enumerate(warnings or [], 1) if x is not None]
        out += [(vid, "field_check", k, "") for k in checks or {}]
        for i, x in enumerate(lines or [], 1):
            if x is None:
                continue
            n = x[0]
            there = n is not None and 1 <= n <= len(items) and items[n - 1] is not None
            out.append((vid, "line_check", str(i), str(n) if there else ""))
            out += [(vid, "line_issue", str(j), str(i)) for j, y in enumerate(x[3] or [], 1) if y is not None]
        out += [(vid, "ocr_issue", str(i), "") for i, x in enumerate((ocr or [None] * 4)[3] or [], 1) if x is not None]
    return sorted(out)


def test_found_equals_a_plain_walk(spark):
    got = nested.found(nested.bridge(rows(spark), "validated", "val_id", nested.VALIDATED)).collect()
    assert sorted((r.row_id, r.child, r.pos, r.parent) for r in got) == expected()


def test_equal_objects_are_stored_once_and_every_place_is_kept(spark):
    b = nested.bridge(rows(spark), "validated", "val_id", nested.VALIDATED, with_payload=True)
    objs = {(r.child, r.child_hash): r for r in nested.objects(b).collect()}
    items = [r for (kind, _), r in objs.items() if kind == "line_item"]
    assert sorted(r.occurrences for r in items) == [1, 3]
    assert json.loads(max(items, key=lambda r: r.occurrences).payload)["description"] == "pipe"
    assert b.where("child = 'error'").count() == 5  # the NULL place too
    assert b.where("child_hash is null").count() == 4


def test_hash_depends_on_content_and_order_but_not_on_map_order(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2}, ["x", "y"]), ({"b": 2, "a": 1}, ["y", "x"]), ({"a": 1}, ["x:1", "y"])], "m map<string,int>, l array<string>")
    h = df.select(nested.merkle_hash(F.col("m"), df.schema["m"].dataType).alias("m"), nested.merkle_hash(F.col("l"), df.schema["l"].dataType).alias("l")).collect()
    assert h[0].m == h[1].m != h[2].m and len({r.l for r in h}) == 3


def test_empty_table(spark):
    empty = rows(spark).limit(0)
    assert nested.found(nested.bridge(empty, "validated", "val_id", nested.VALIDATED)).count() == 0


def test_every_parent_identity_has_an_object(spark):
    for kind, key, children in (("validated", "val_id", nested.VALIDATED), ("extracted", "val_id", nested.EXTRACTED)):
        b = nested.bridge(rows(spark), kind, key, children, with_payload=True, containers=True)
        own = {r.child_hash for r in nested.objects(b).collect()}
        got = b.collect()
        assert {r.parent_hash for r in got if r.parent_hash} <= own
        assert sorted(r.row_id for r in got if r.child == "record") == [1, 1, 2, 3, 4] and all(r.parent_hash is None for r in got if r.child == "record")
        plain = nested.found(nested.bridge(rows(spark), kind, key, children))
        inner = {c.kind for c in children}
        assert sorted(map(tuple, plain.collect())) == sorted((r.src, r.row_id, r.child, r.pos, r.parent) for r in got if r.child in inner and r.child_hash)
    # equal subtrees are one object, and a change below reaches the root
    r = {(x.row_id, x.child): x.child_hash for x in b.collect()}
    assert r[(1, "line_items")] != r[(4, "line_items")] and r[(1, "record")] != r[(4, "record")]


def test_cost_grows_with_the_length(spark):
    import time

    took = []
    for n in (100, 100, 400, 1600):
        one = spark.range(8).selectExpr("id as val_id", f"transform(sequence(1, {n}), i -> named_struct('a', concat(id, ':', i), 'b', '1')) as line_items")
        began = time.perf_counter()
        assert nested.found(nested.bridge(one, "x", "val_id", nested.EXTRACTED)).where("pos <> '0'").count() == 8 * n
        took.append(time.perf_counter() - began)
    assert took[3] < 10 * max(took[1], 0.3)
