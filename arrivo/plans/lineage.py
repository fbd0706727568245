"""Which source columns a column is made of, read off the analysed plan.

Renaming, deriving, aggregating, windows, unions and scalar subqueries are followed; rows that filters and joins choose are
not. A written table is a source: what happened before it was written is not seen.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from arrivo.plans.features import unknown_at
from arrivo.schemas import DEFAULT_ANCHOR


def _is_tree(value) -> bool:
    return isinstance(value, list) and bool(value) and isinstance(value[0], dict) and "num-children" in value[0]


def _tree(flat: list[dict]) -> dict:
    """Nodes listed parents first, as a tree."""
    nodes = iter(flat)

    def build() -> dict:
        node = next(nodes)
        return node | {"_children": [build() for _ in range(node["num-children"])], "_kind": node["class"].rsplit(".", 1)[-1]}

    return build()


def _parts(value) -> Iterator[dict]:
    """The expressions (or plans of subqueries) in a field of a node."""
    if _is_tree(value):
        yield _tree(value)
    elif isinstance(value, list):
        for member in value:
            yield from _parts(member)


def _inner(node: dict) -> list[dict]:
    return [part for name, value in node.items() if not name.startswith("_") for part in _parts(value)]


def _id(node: dict) -> str:
    return f"{node['exprId']['id']}/{node['exprId']['jvmId']}"


class Lineage:
    """For every expression id of a plan the ids it is made of, and the names of those that come from a source."""

    def __init__(self, df: DataFrame):
        self.made_of: dict[str, set[str]] = defaultdict(set)
        self.names: dict[str, str] = {}
        output = self._plan(_tree(json.loads(df._jdf.queryExecution().analyzed().toJSON())))
        self.columns = dict(zip(df.columns, output))

    def _plan(self, node: dict) -> list[str]:
        """Ids of the output of a plan node, after a walk through all below it."""
        below = [self._plan(child) for child in node["_children"]]
        kind, everything = node["_kind"], [i for ids in below for i in ids]
        if "output" in node:  # a source, or an operator that says no more than that it makes these
            made = [part for part in _parts(node["output"])]
            for part in made:
                if not below:
                    self.names[_id(part)] = part["name"]
                self.made_of[_id(part)].update(i for i in everything if i != _id(part))
            return [_id(part) for part in made]
        fields = {name: list(_parts(value)) for name, value in node.items() if not name.startswith("_")}
        for parts in fields.values():
            for part in parts:
                self._expression(part)
        listed = fields.get("projectList") or fields.get("aggregateExpressions")
        if listed:
            return [_id(part) for part in listed]
        if kind == "Union":
            for ids in below[1:]:
                for first, other in zip(below[0], ids):
                    self.made_of[first].add(other)
            return below[0]
        if kind == "Generate":
            made = [_id(part) for part in fields["generatorOutput"]]
            for one in made:
                self.made_of[one].update(i for part in fields["generator"] for i in self._expression(part))
            return everything + made
        if kind == "Window":
            return everything + [_id(part) for part in fields["windowExpressions"]]
        if kind == "Join" and "Semi" not in str(node.get("joinType")) and "Anti" not in str(node.get("joinType")):
            return everything
        return below[0] if below else []

    def _expression(self, node: dict) -> set[str]:
        """Ids that an expression reads; what it names on the way is noted."""
        if node["_kind"] == "AttributeReference":
            return {_id(node)}
        read: set[str] = set()
        for child in node["_children"]:
            read |= self._expression(child)
        for part in _inner(node):
            # the plan of a subquery, or an expression kept in a field
            read |= set(self._plan(part)) if ".plans.logical." in part["class"] or ".datasources." in part["class"] else self._expression(part)
        if node["_kind"] == "Alias":
            self.made_of[_id(node)].update(read - {_id(node)})
            return {_id(node)}
        return read

    def sources(self, column: str) -> set[str]:
        """Names of the source columns that the column is made of."""
        seen, wanted = set(), [self.columns[column]]
        while wanted:
            one = wanted.pop()
            if one not in seen:
                seen.add(one)
                wanted.extend(self.made_of.get(one, ()))
        return {self.names[i] for i in seen if i in self.names}


def refuse_leaks(df: DataFrame, columns: Iterable[str], anchor: str = DEFAULT_ANCHOR) -> None:
    """Refuse columns that are made of something that only comes to be known after the anchor, whatever their names."""
    lineage, late = Lineage(df), unknown_at(anchor)
    found = {column: sorted(lineage.sources(column) & late) for column in columns}
    if leaks := [f"{column} (from {', '.join(names)})" for column, names in found.items() if names]:
        raise ValueError(f"not yet known at the {anchor} anchor: {'; '.join(leaks)}")
