"""What to do when a plan leaves the JVM for Python code: warn, fail or accept."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import DataFrame

from eventloom.workspace import STAGED, noted_python

# Names of the plan nodes that run Python code.
PYTHON_NODES = (
    "BatchEvalPython",
    "ArrowEvalPython",
    "ArrowAggregate",
    "AggregateInPandas",
    "WindowInPandas",
    "ArrowWindowPython",
    "MapInPandas",
    "MapInArrow",
    "PythonMapInArrow",
    "FlatMapGroupsInPandas",
    "FlatMapGroupsInArrow",
    "FlatMapCoGroupsInPandas",
    "FlatMapCoGroupsInArrow",
    "BatchEvalPythonUDTF",
    "ArrowEvalPythonUDTF",
)
_NODE = re.compile(rf"({'|'.join(PYTHON_NODES)})\b\s*(.*)")


class PythonUdfError(RuntimeError):
    """The plan runs Python code although the policy forbids it."""


def _staged_folders(df: DataFrame) -> list[str]:
    """Folders of staged tables that the plan reads."""
    folders, nodes = set(), [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if node.getClass().getSimpleName() == "LogicalRelation" and node.relation().getClass().getSimpleName() == "HadoopFsRelation":
            paths = node.relation().location().rootPaths()
            folders |= {paths.apply(i).toString() for i in range(paths.size())}
    return sorted(f for f in folders if STAGED in f)


def udf_report(df: DataFrame) -> list[str]:
    """One line per plan node that runs Python code, of this plan and of what made the staged tables that it reads;
    empty when all of it stays in the JVM."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    own = [f"{match.group(1)} {match.group(2)}".strip() for match in map(_NODE.search, plan.splitlines()) if match]
    before = [node for folder in _staged_folders(df) for node in noted_python(df.sparkSession, folder)]
    return own + [f"staged: {node.removeprefix('staged: ')}" for node in before]


def apply_policy(df: DataFrame, policy: str = "warn") -> DataFrame:
    """Check the plan: ``ignore`` passes, ``warn`` warns, ``error`` raises PythonUdfError."""
    if policy not in ("ignore", "warn", "error"):
        raise ValueError(f"unknown policy {policy!r}")
    if policy != "ignore" and (nodes := udf_report(df)):
        message = "plan runs Python code: " + "; ".join(nodes)
        if policy == "error":
            raise PythonUdfError(message)
        warnings.warn(message, stacklevel=2)
    return df
