"""The load log: which loads are committed, and how far every table has come.

The log is the commit of every step. It is kept in two parts. The tail is a table of small
files, a few per run; once it has many, they are folded: all rows move to the history, and
one state row per table takes their place in the tail. What a run needs to know is in the
tail, which is read once per step, whatever the number of runs before. The history is
opened for the audit, and for a batch key that the tail does not know.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sedimenta.schemas import FACT_HOURLY, LOAD_HISTORY, LOAD_LOG, Table
from sedimenta.sources.files import list_names
from sedimenta.sources.intents import Delete, Replace, carry_out
from sedimenta.sources.storage import Load, Store

OPEN = " open"  # ends the step's name in the rows that fix a load's input
STATE = "state"  # the step's name in the rows that stand for folded ones
MERGE = "merge"  # the step's name in the rows that name merged folders
#: Files of the tail that are left unfolded.
FOLD_AT = 64

_LOG_DDL = ", ".join(f"{c} {dtype}" for c, dtype in LOAD_LOG.columns)
_SUMMED_UP = ("load_id", "mark_high", "scanned_high", "max_key", "source_load", "recorded_at")


class Progress:
    """What the load log says about each table."""

    def __init__(self, rows: Sequence[Row]):
        self._rows: dict[str, list[Row]] = {}
        for row in rows:
            if row["step"] != MERGE and not row["step"].endswith(OPEN):
                self._rows.setdefault(row["table_name"], []).append(row)

    @property
    def table_names(self) -> list[str]:
        return sorted(self._rows)

    def of(self, table: Table | str, field: str):
        """The highest value that the log has in a field."""
        name = table if isinstance(table, str) else table.full_name
        values = [row[field] for row in self._rows.get(name, ()) if row[field] is not None]
        return max(values, default=None)

    def newest(self, table: Table | str, field: str):
        """The value of the last load, be it NULL."""
        name = table if isinstance(table, str) else table.full_name
        rows = self._rows.get(name, ())
        return max(rows, key=lambda row: row["load_id"])[field] if rows else None

    def next_load(self, table: Table) -> Load:
        """Loads are numbered per step, so a failed one gets its number again."""
        return Load((self.of(table, "load_id") or 0) + 1)


class LoadLog:
    def __init__(self, store: Store):
        self.store = store
        self._tail: list[Row] | None = None

    def refresh(self) -> None:
        """Read the tail again: another session may have written."""
        self.store.spark.catalog.refreshTable(self.store.name(LOAD_LOG))
        self._tail = None

    def tail(self) -> list[Row]:
        """At most the rows of FOLD_AT files and one state row per table."""
        if self._tail is None:
            self._tail = self.store.read(LOAD_LOG).collect()
        return self._tail

    def progress(self) -> Progress:
        return Progress(self.tail())

    def _all(self) -> DataFrame:
        tail = self.store.read(LOAD_LOG).where(F.col("step") != STATE)
        return tail.unionByName(self.store.read(LOAD_HISTORY))

    def loads(self) -> DataFrame:
        """The committed loads, of all times."""
        return self._all().where(~F.col("step").endswith(OPEN) & (F.col("step") != MERGE))

    def merges(self) -> DataFrame:
        return self._all().where(F.col("step") == MERGE)

    def committed(self, step: str, batch_key: str | None) -> bool:
        if batch_key is None:
            return False
        if any(r["step"] == step and r["batch_key"] == batch_key for r in self.tail()):
            return True
        if batch_key.startswith(OWN_KEY) or not any(r["step"] == STATE for r in self.tail()):
            return False  # made for this run, or nothing has been folded yet
        done = (F.col("step") == step) & (F.col("batch_key") == batch_key)
        return not self.store.read(LOAD_HISTORY).where(done).isEmpty()

    def open_gold(self) -> Row | None:
        """The gold load that was begun and not committed."""
        following = self.progress().next_load(FACT_HOURLY).load_id
        begun = [r for r in self.tail() if r["step"] == f"gold{OPEN}" and r["load_id"] == following]
        return min(begun, key=lambda r: r["recorded_at"], default=None)

    def commit(self, load: Load, step: str, batch_key: str | None, rows: list[dict]) -> None:
        common = {
            "load_id": load.load_id,
            "step": step,
            "batch_key": batch_key,
            "recorded_at": datetime.now(timezone.utc).replace(tzinfo=None),
        }
        self._append([row | common for row in rows])

    def _append(self, rows: list[dict]) -> None:
        entries = [tuple(row.get(c) for c, _ in LOAD_LOG.columns) for row in rows]
        self.store.append(LOAD_LOG, self._frame(entries))
        if self._tail is not None:
            names = [c for c, _ in LOAD_LOG.columns]
            self._tail += [Row(**dict(zip(names, entry))) for entry in entries]

    def _frame(self, entries: list[tuple]) -> DataFrame:
        return self.store.spark.createDataFrame(entries, _LOG_DDL).coalesce(1)

    def n_files(self) -> int:
        names = list_names(self.store.spark, self.store.location(LOAD_LOG))
        return sum(not name.startswith(("_", ".")) for name in names)

    def fold(self, most_files: int = FOLD_AT) -> bool:
        """Move the tail to the history when it has too many files; True when it did.

        Both parts are written beside the old ones and take their place by a noted change.
        A gold load that is still open keeps the tail as it is.
        """
        if self.n_files() <= most_files or self.open_gold() is not None:
            return False
        store, mark = self.store, uuid.uuid4().hex[:10]
        progress = self.progress()
        state = [
            {c: progress.of(name, c) for c in _SUMMED_UP}
            | {"step": STATE, "table_name": name, "index_keys": progress.newest(name, "index_keys")}
            for name in progress.table_names
        ]
        entries = [tuple(row.get(c) for c, _ in LOAD_LOG.columns) for row in state]
        beside, aside = f"{store.root}/_fold-{mark}", f"{store.root}/_folded-{mark}"
        kept = self._all().where(~F.col("step").endswith(OPEN)).coalesce(1)
        steps = []
        for table, rows in ((LOAD_HISTORY, kept), (LOAD_LOG, self._frame(entries))):
            new = f"{beside}/{table.name}"
            rows.write.parquet(new)
            steps.append(Replace(store.location(table), new, f"{aside}/{table.name}"))
        carry_out(store.spark, store.root, f"fold-{mark}", [*steps, Delete(beside), Delete(aside)])
        store.spark.catalog.refreshTable(store.name(LOAD_HISTORY))
        self.refresh()
        return True


OWN_KEY = "run "  # begins the batch keys that a run makes up for itself


def own_key() -> str:
    return f"{OWN_KEY}{uuid.uuid4().hex}"
