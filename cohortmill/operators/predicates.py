"""Declarative filters: a tree of ``and`` / ``or`` / ``in`` / ``=`` nodes, and its meaning as a predicate column."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

Tree = dict[str, Any]

# Named filter keys and the nested fields they stand for.
NAMED_FIELDS = {
    "project": "cases.project.project_id",
    "primary_site": "cases.primary_site",
    "disease_type": "cases.disease_type",
    "sample_type": "cases.samples.sample_type",
    "tissue_type": "cases.samples.tissue_type",
    "data_category": "data_category",
    "data_type": "data_type",
    "data_format": "data_format",
    "experimental_strategy": "experimental_strategy",
    "workflow_type": "analysis.workflow_type",
    "platform": "platform",
    "access": "access",
    "program": "cases.project.program.name",
}


def is_in(field: str, values: Any) -> Tree:
    listed = [values] if isinstance(values, (str, int, float)) else list(values)
    return {"op": "in", "content": {"field": field, "value": listed}}


def equals(field: str, value: Any) -> Tree:
    return {"op": "=", "content": {"field": field, "value": value}}


def _join(op: str, nodes: tuple[Tree | None, ...]) -> Tree:
    flat: list[Tree] = []
    for node in filter(None, nodes):
        flat += node["content"] if node.get("op") == op else [node]
    return flat[0] if len(flat) == 1 else {"op": op, "content": flat}


def all_of(*nodes: Tree | None) -> Tree:
    """AND of the given nodes; empty ones are skipped, nested ANDs flattened, a single one returned as it is."""
    return _join("and", nodes)


def any_of(*nodes: Tree | None) -> Tree:
    return _join("or", nodes)


def named_filters(filters: dict[str, Any], fields: dict[str, str] = NAMED_FIELDS, *, explicit: Tree | None = None, cases: list[str] | None = None) -> Tree:
    """Tree of the named filters; ``explicit`` overrides them, selected case ids are added by AND."""
    unknown = sorted(set(filters) - set(fields))
    if unknown:
        raise ValueError(f"unknown filters: {unknown}")
    tree = explicit or all_of(*[is_in(fields[k], v) for k, v in filters.items() if v])
    return all_of(tree, is_in("cases.case_id", cases)) if cases else tree


def add_on_filters(primary: dict[str, Any], add_ons: dict[str, dict[str, Any]], name: str, *, explicit: Tree | None = None) -> Tree:
    """Tree of a named add-on selection beside a primary one, over open files only.

    The add-on takes the primary's ``project`` unless it has one of its own or an ``explicit`` tree, which stands alone.
    An unknown name, or an add-on without any filter, raises ``ValueError``.
    """
    if name not in add_ons:
        raise ValueError(f"unknown add-on: {name!r}; known: {sorted(add_ons)}")
    own = add_ons[name]
    if not own and explicit is None:
        raise ValueError(f"add-on {name!r} has no filter")
    inherited = {"project": primary["project"]} if explicit is None and "project" in primary else {}
    return open_access(named_filters(inherited | own, explicit=explicit))


def open_access(tree: Tree | None) -> Tree:
    return all_of(tree, is_in("access", ["open"]))


def at_case_level(tree: Tree) -> Tree:
    """The same filter with its root at the case: ``cases.x`` is ``x``, anything of the file goes below ``files``."""
    content = tree.get("content")
    if isinstance(content, list):
        return tree | {"content": [at_case_level(x) for x in content]}
    if not isinstance(content, dict) or "field" not in content:
        return tree
    field = content["field"]
    if field.startswith("cases."):
        field = field.removeprefix("cases.")
    elif not field.startswith("files."):
        field = f"files.{field}"
    return tree | {"content": content | {"field": field}}


def _on_path(value: Column, kind: Any, path: list[str], test) -> Column:
    """``test`` on a nested field; through an array, any element may satisfy it."""
    if isinstance(kind, ArrayType):
        return F.exists(value, lambda x: F.coalesce(_on_path(x, kind.elementType, path, test), F.lit(False)))
    if not path:
        return test(value)
    if not isinstance(kind, StructType) or path[0] not in kind.fieldNames():
        raise ValueError(f"no field {path[0]!r}")
    return _on_path(value[path[0]], kind[path[0]].dataType, path[1:], test)


def predicate(tree: Tree, schema: StructType) -> Column:
    """Boolean column of a tree over rows of ``schema``; never null. An empty AND is true, an empty OR false."""
    op, content = tree["op"], tree["content"]
    if op in ("and", "or"):
        parts = [predicate(x, schema) for x in content]
        return reduce(lambda a, b: a & b if op == "and" else a | b, parts) if parts else F.lit(op == "and")
    if op not in ("in", "="):
        raise ValueError(f"unknown operator: {op!r}")
    first, *path = content["field"].split(".")
    if first not in schema.fieldNames():
        raise ValueError(f"no field {first!r}")
    test = (lambda x: x.isin(*content["value"])) if op == "in" else (lambda x: x == F.lit(content["value"]))
    return F.coalesce(_on_path(F.col(first), schema[first].dataType, path, test), F.lit(False))


def filter_tree(df: DataFrame, tree: Tree | None) -> DataFrame:
    return df.filter(predicate(tree, df.schema)) if tree else df


def filter_cases(cases: DataFrame, files: DataFrame, tree: Tree, *, key: str = "case_id") -> DataFrame:
    """Cases with at least one file that satisfies a file-level tree."""
    hit = filter_tree(files, tree).select(F.explode("cases").alias("_c")).select(F.col(f"_c.{key}").alias(key)).distinct()
    return cases.join(hit, key, "left_semi")
