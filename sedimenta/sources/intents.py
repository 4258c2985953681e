"""Changes of several folders that are carried out whole, also across a break.

The steps are written down before the first of them; whoever opens the warehouse next finds
the note and carries out what is left. Each step can be repeated:

    replace   the new folder takes the place of the current one, which is moved aside first;
              done when the new folder is gone from where it was prepared
    delete    the folder goes; done when it is not there

A break before the note leaves everything as it was. Folders are moved within one file system.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from sedimenta.sources.files import (
    delete_path,
    list_names,
    move_path,
    path_exists,
    read_text,
    write_text,
)


@dataclass(frozen=True)
class Replace:
    current: str
    new: str
    aside: str


@dataclass(frozen=True)
class Delete:
    path: str


Step = Replace | Delete


def _folder(root: str) -> str:
    return f"{root}/_intents"


def carry_out(spark: SparkSession, root: str, name: str, steps: Sequence[Step]) -> None:
    """Notes the steps under the name, takes them, and removes the note."""
    noted = [{type(step).__name__: vars(step)} for step in steps]
    write_text(spark, f"{_folder(root)}/{name}.json", json.dumps(noted))
    _take(spark, root, f"{name}.json", steps)


def complete_pending(spark: SparkSession, root: str) -> list[str]:
    """Takes the steps that earlier sessions have noted and not finished; returns their names."""
    kinds = {kind.__name__: kind for kind in (Replace, Delete)}
    names = [name for name in list_names(spark, _folder(root)) if name.endswith(".json")]
    for name in sorted(names):
        noted = json.loads(read_text(spark, f"{_folder(root)}/{name}"))
        steps = [kinds[kind](**fields) for step in noted for kind, fields in step.items()]
        _take(spark, root, name, steps)
    return names


def _take(spark: SparkSession, root: str, name: str, steps: Sequence[Step]) -> None:
    for step in steps:
        if isinstance(step, Delete):
            delete_path(spark, step.path)
        elif path_exists(spark, step.new):
            if path_exists(spark, step.current):
                if path_exists(spark, step.aside):  # what a broken move has left
                    delete_path(spark, step.current)
                else:
                    move_path(spark, step.current, step.aside)
            move_path(spark, step.new, step.current)
    delete_path(spark, f"{_folder(root)}/{name}")
