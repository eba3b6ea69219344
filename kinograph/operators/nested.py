"""Deeply nested records as flat tables, by way of an adjacency table.

``shred`` turns every JSON reply into rows of one *node table*: the node, its
parent, its label (the key it stands under), its ordinal (the place in its
array), its kind and, for scalars, its value.  Everything after that is
relational: ``scalars_of`` pivots the scalar children of an object into
columns, ``children`` follows the links, and entity tables are joins of these.

Scale: a reply's nodes are made where the reply is read, and only the labels
that a caller asks for leave that task.  The joins are on (record, node), so a
reply with very many nodes is spread like any other; no group is gathered.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinograph.functions.terms import SPACE_CLASS

NODE_SCHEMA = "record bigint, node int, parent int, label string, ordinal int, kind string, scalar string"
_ARROW = pa.schema(
    [("record", pa.int64()), ("node", pa.int32()), ("parent", pa.int32()), ("label", pa.string()), ("ordinal", pa.int32()), ("kind", pa.string()), ("scalar", pa.string())]
)
OBJECT, ARRAY = "object", "array"
_KINDS = {bool: "bool", int: "int", float: "float", str: "str", type(None): "null"}
_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\]:,])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?|true|false|null))')
_SPACE = re.compile(r"[ \t\n\r]*")


def _not_json(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


class _Digits(str):
    """A whole number of more digits than Python makes a number of, kept as it is written."""


_KINDS[_Digits] = "int"


def _whole(text: str) -> Any:
    return int(text) if len(text) < 4000 else _Digits(text)


def _loads(text: str) -> Any:
    try:
        return json.loads(text, parse_constant=_not_json)
    except json.JSONDecodeError:
        raise
    except ValueError:  # NaN, or a number of very many digits
        return json.loads(text, parse_constant=_not_json, parse_int=_whole)


def _parse_deep(text: str) -> Any:
    """``json.loads`` with a stack of its own, for replies that nest beyond the recursion limit."""
    holder: list = []
    stack: list[tuple[Any, str | None]] = [(holder, None)]
    pos, want = 0, "value"  # value, first (value or ]), key, firstkey (key or }), colon, after
    while True:
        top, key = stack[-1]
        if len(stack) == 1 and holder:
            if _SPACE.match(text, pos).end() != len(text):
                raise ValueError("text after the value")
            return holder[0]
        m = _TOKEN.match(text, pos)
        if not m:
            raise ValueError(f"no token at {pos}")
        pos = m.end()
        mark, string, other = m.groups()
        if want in ("key", "firstkey"):
            if string is not None:
                stack[-1], want = (top, json.loads(string)), "colon"
                continue
            if not (mark == "}" and want == "firstkey"):
                raise ValueError("a key is missing")
        elif want == "colon":
            if mark != ":":
                raise ValueError("a colon is missing")
            want = "value"
            continue
        elif want == "after" and mark == ",":
            want = "key" if isinstance(top, dict) else "value"
            continue
        if mark in ("}", "]") and want != "value":
            if len(stack) == 1 or isinstance(top, dict) != (mark == "}"):
                raise ValueError("unbalanced")
            stack.pop()
            want = "after"
            continue
        if want not in ("value", "first") or mark in (":", ",", "}", "]"):
            raise ValueError(f"unexpected {mark or string or other}")
        made = {} if mark == "{" else [] if mark == "[" else _loads(string or other)
        if isinstance(top, dict):
            top[key] = made
        else:
            top.append(made)
        want = "after"
        if mark:
            stack.append((made, None))
            want = "firstkey" if mark == "{" else "first"


def parse(payload: str | None) -> tuple[bool, Any]:
    """(valid, value) of a reply; a JSON string that holds JSON is read once more."""
    value: Any = payload
    for _ in range(2):
        if not isinstance(value, str) or isinstance(value, _Digits):
            break
        try:
            value = _loads(value)
        except RecursionError:
            try:
                value = _parse_deep(value)
            except ValueError:
                return False, None
        except ValueError:
            return False, None
    return payload is not None, value


def _clean(text: str | None) -> str | None:
    """``text`` without lone surrogates, which JSON escapes can make and UTF-8 cannot hold."""
    if text is None or text.isascii():
        return text
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def shred(df: DataFrame, record: str, payload: str, scalars: Sequence[str] | None = None) -> DataFrame:
    """The node table of the JSON in ``payload``; NODE_SCHEMA.

    ``scalars`` names the labels whose scalar nodes are wanted (all, if None);
    containers and array elements are always kept, so every link holds.

    * null, empty or not wholly valid JSON (NaN and Infinity are not JSON): no node;
    * a JSON string that holds JSON is read once more; one that does not is one node;
    * of a key that an object repeats, the last value counts;
    * nesting beyond Python's recursion limit is read with an explicit stack; whole numbers of any length are kept;
    * a record that comes twice gives its nodes twice: make ``record`` a key first;
    * other columns are not read.
    """
    wanted = None if scalars is None else frozenset(scalars)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in _ARROW]
        records, nodes, parents, labels, ordinals, kinds, scalars_ = columns
        names: dict[str | None, str | None] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
            for c in columns:
                c.clear()
            return out

        def clean_label(label: str | None) -> str | None:
            if label not in names:
                if len(names) > 10_000:
                    names.clear()
                names[label] = _clean(label)
            return names[label]

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                valid, value = parse(text)
                if not valid:
                    continue
                node = 0
                stack: list[tuple[Any, int, str | None, int | None]] = [(value, -1, None, None)]
                while stack:
                    v, parent, label, ordinal = stack.pop()
                    kind = type(v)
                    if kind is dict:
                        name, scalar = OBJECT, None
                        # scalars under labels that nobody asked for get no node; links between the others hold without them
                        stack.extend((x, node, k, None) for k, x in v.items() if wanted is None or k in wanted or type(x) is dict or type(x) is list)
                    elif kind is list:
                        name, scalar = ARRAY, None
                        stack.extend((x, node, None, i) for i, x in enumerate(v))
                    else:
                        name, scalar = _KINDS[kind], None if v is None else _clean(v) if isinstance(v, str) else json.dumps(v)
                    records.append(key)
                    nodes.append(node)
                    parents.append(parent)
                    labels.append(clean_label(label))
                    ordinals.append(ordinal)
                    kinds.append(name)
                    scalars_.append(scalar)
                    node += 1
                if len(records) >= 50_000:
                    yield flush()
        if records:
            yield flush()

    return df.select(F.col(f"`{record}`").cast("bigint").alias("record"), F.col(f"`{payload}`").alias("payload")).mapInArrow(run, NODE_SCHEMA)


def scalars_of(nodes: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row (record, parent, and a struct ``kind, scalar`` per label) for each object with one of these scalar children."""
    value = F.struct("kind", "scalar")
    return (
        nodes.where(F.col("label").isin(list(labels)) & ~F.col("kind").isin(OBJECT, ARRAY))
        .groupBy("record", "parent")
        .agg(*(F.max(F.when(F.col("label") == name, value)).alias(name) for name in labels))
    )


def whole_id(value: F.Column) -> F.Column:
    """The bigint of a ``kind, scalar`` struct that is a whole number or a string of digits, else null."""
    text = value["scalar"]
    digits = (value["kind"] == "str") & text.rlike("^[0-9]+$")
    whole = (value["kind"] == "int") | ((value["kind"] == "float") & text.rlike(r"^-?[0-9]+\.0+$"))
    return F.when(digits | whole, F.regexp_replace(text, r"\.0+$", "").try_cast("bigint"))


def credit_entities(nodes: DataFrame) -> DataFrame:
    """The persons in the ``cast`` and ``crew`` of a node table, a row for each character or job.

    Columns: record, credit_kind, pos, role_pos, tmdb_person_id, role_name, and
    the links entry_node and container_node.  ``nodes`` must hold the scalars
    id, character and job.  Entries of another kind than object have no person
    and give no row, though their places count.
    """
    containers = nodes.where(F.col("label").isin("cast", "crew") & F.col("kind").isin(OBJECT, ARRAY)).select(
        "record", F.col("node").alias("container_node"), F.col("label").alias("credit_kind"), F.col("kind").alias("container_kind")
    )
    elements = nodes.where(F.col("ordinal").isNotNull()).select("record", F.col("node"), "parent", "ordinal", "kind")
    in_array = elements.where(F.col("kind") == OBJECT).join(
        containers.where(F.col("container_kind") == ARRAY).withColumnRenamed("container_node", "parent"), ["record", "parent"]
    )
    entries = in_array.select("record", F.col("node").alias("entry_node"), F.col("parent").alias("container_node"), "credit_kind", F.col("ordinal").alias("pos")).unionByName(
        containers.where(F.col("container_kind") == OBJECT).select("record", F.col("container_node").alias("entry_node"), "container_node", "credit_kind", F.lit(0).alias("pos"))
    )
    values = scalars_of(nodes, ["id", "character", "job"])
    own = values.withColumnRenamed("parent", "entry_node")
    persons = (
        nodes.where((F.col("label") == "person") & (F.col("kind") == OBJECT))
        .select("record", "node", F.col("parent").alias("entry_node"))
        .join(values.select("record", F.col("parent").alias("node"), whole_id(F.col("id")).alias("person_id")), ["record", "node"])
        .select("record", "entry_node", "person_id")
    )
    lists = nodes.where(F.col("label").isin("roles", "jobs") & (F.col("kind") == ARRAY)).select(
        "record", F.col("node").alias("list_node"), F.col("parent").alias("entry_node"), F.col("label").alias("list_label")
    )
    roles = (
        elements.select("record", F.col("parent").alias("list_node"), "node", F.col("ordinal").alias("role_pos"))
        .join(lists, ["record", "list_node"])
        .join(values.select("record", F.col("parent").alias("node"), F.col("character").alias("c"), F.col("job").alias("j")), ["record", "node"], "left")
        .select("record", "entry_node", "list_label", "role_pos", "c", "j")
    )
    counted = (
        entries.join(own, ["record", "entry_node"], "left")
        .join(persons, ["record", "entry_node"], "left")
        .withColumn("tmdb_person_id", F.coalesce(whole_id(F.col("id")), F.col("person_id")))
        .where(F.col("tmdb_person_id").isNotNull())
    )
    cast = F.col("credit_kind") == "cast"
    listed = counted.join(roles, ["record", "entry_node"], "left")
    name = F.when(
        F.col("role_pos").isNull(), F.when(cast, F.coalesce(F.col("character"), F.col("job"))).otherwise(F.coalesce(F.col("job"), F.col("character")))
    ).otherwise(F.when(cast, F.coalesce(F.col("c"), F.col("j"))).otherwise(F.coalesce(F.col("j"), F.col("c"))))
    return listed.select(
        "record", "credit_kind", "pos", F.coalesce("role_pos", F.lit(0)).alias("role_pos"), "tmdb_person_id", trimmed(name["scalar"]).alias("role_name"), "entry_node", "container_node"
    )


def links(nodes: DataFrame) -> DataFrame:
    """Every node with its parent's label and kind, which are null at a root: the parent-child links followed once."""
    up = nodes.select("record", F.col("node").alias("parent"), F.col("label").alias("parent_label"), F.col("kind").alias("parent_kind"))
    return nodes.join(up, ["record", "parent"], "left").select("record", "parent_label", "parent_kind", "label", "ordinal", "kind", "scalar")


def trimmed(text: F.Column) -> F.Column:
    """Without outer white space of any kind; null becomes the empty string."""
    return F.coalesce(F.regexp_replace(text, f"^{SPACE_CLASS}|{SPACE_CLASS}$", ""), F.lit(""))
