"""The warehouse runs: documents -> bronze -> silver -> gold, with an audit log.

Each step reads the loads its target has not taken over, writes, and only then
appends its rows to the load log. The log is the commit: a step that failed
before it is run again under the same load number, all that it had written is
removed or replaced, and no later step reads what is not in the log. The step to
gold changes tables in place; the log therefore fixes its input before the
first write, and a retry takes that input, whatever has come in since. Readers of
Warehouse.table() see committed loads only. Runs are expected one at a time per warehouse.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions import day_of, sql_timestamp
from sedimenta.operators import conform as clean
from sedimenta.operators import star
from sedimenta.operators.incremental import newer_than
from sedimenta.operators.keys import dense_ids, highest
from sedimenta.operators.merge import (
    INSERTED,
    absent_keys,
    apply_changes,
    number_inserts,
    op_measures,
    touched_rows,
)
from sedimenta.operators.partitions import with_month
from sedimenta.operators.quality import (
    check_table,
    merged_profiles,
    profile_measures,
    profile_rows,
)
from sedimenta.plans.log import MERGE, OPEN, LoadLog, Progress, own_key
from sedimenta.schemas import (
    BRONZE,
    BRONZE_REJECTS,
    DAILY_STATE,
    DIM_CONDITION,
    DIM_LOCATION,
    FACT_DAY,
    FACT_HOURLY,
    FIRST_MARK,
    LOAD_PROFILE,
    MEASURES,
    READING_INDEX,
    SILVER,
    SILVER_REJECTS,
    TABLES,
    Table,
)
from sedimenta.session import stored
from sedimenta.sources import landing
from sedimenta.sources.intents import complete_pending
from sedimenta.sources.merging import LEAST, TARGET_BYTES, merge_folders
from sedimenta.sources.storage import Load, Store, observe


@dataclass(frozen=True)
class Options:
    """Choices between the intended semantics (defaults) and historic ones.

    dedupe_keys      a reading collected twice is one row, the copy collected first,
                     whichever loads its copies are in; ("id",) keeps both. `identity` is
                     name and country, or country and coordinates without a name
    falsy_as_null    0 and '' in a payload count as missing
    null_safe_days   False: a stored NULL sunrise or sunset is not filled by itself
    local_day        days at the reading's own offset instead of UTC
    calendar         [first, end) dates outside which a reading is rejected
    shifted_wind     silver wind columns out of step, as once loaded by position
    by_load          an increment is the loads not yet taken over: nothing is lost that
                     arrives late; False: the rows above the mark, as once
    merge_every      run() merges small load folders each time that many loads have come;
                     0: never
    """

    dedupe_keys: tuple[str, ...] = ("identity", "data_timestamp")
    falsy_as_null: bool = False
    null_safe_days: bool = True
    local_day: bool = False
    calendar: tuple[date, date] | None = None
    shifted_wind: bool = False
    by_load: bool = True
    merge_every: int = 24


#: Append tables whose load folders are merged, and the step that fills each. What its
#: readers have taken over bounds the merge.
_MERGED = (BRONZE, BRONZE_REJECTS, SILVER, SILVER_REJECTS, READING_INDEX, FACT_HOURLY, DAILY_STATE)
#: Days up to which the time range of an increment is given day by day.
MOST_DAYS = 64


class Warehouse:
    def __init__(
        self, spark: SparkSession, root: str, prefix: str = "", options: Options = Options()
    ):
        self.spark = spark
        self.store = Store(spark, root.rstrip("/"), prefix)
        self.options = options
        broken_off = complete_pending(spark, self.store.root)
        self.store.create_tables()
        if broken_off:
            self.store.recover()
        self.log = LoadLog(self.store)

    def table(self, table: Table) -> DataFrame:
        """The committed rows of a table."""
        rows = self.store.read(table)
        if "load_id" not in dict(table.partition_by):
            return rows
        self.log.refresh()
        newest = _committed_load(table, self.log.progress())
        # A load is never NULL; where that is not said, Spark infers it in any order.
        return rows.where(F.col("load_id").isNotNull() & (F.col("load_id") <= newest))

    def refresh(self) -> None:
        """Forget cached file listings after another session has written."""
        for table in TABLES:
            self.spark.catalog.refreshTable(self.store.name(table))
        self.log.refresh()

    def audit(self) -> DataFrame:
        """The committed loads."""
        return self.log.loads()

    def _commit(self, load: Load, step: str, batch_key: str | None, rows: list[dict]) -> None:
        self.log.commit(load, step, batch_key, rows)

    def _begin(self, step: str, batch_key: str | None) -> Progress | None:
        """Where every table stands, by one reading of the log; None when the step is
        already committed under the key."""
        self.log.refresh()
        return None if self.log.committed(step, batch_key) else self.log.progress()

    def _increment(
        self, source: Table, target: Table, progress: Progress, newest_load: int | None
    ) -> DataFrame:
        """Committed source rows up to a load that the target has not taken over.

        By mark, the log knows the newest collected_at of every source load, so
        the folders of older loads are not opened.
        """
        rows = self.store.read(source)
        if newest_load is None:
            return rows.where(F.lit(False))
        if self.options.by_load:
            taken = progress.of(target, "source_load") or 0
            return rows.where(F.col("load_id").between(taken + 1, newest_load))
        mark = progress.of(target, "mark_high") or FIRST_MARK
        loads = self.audit().where(F.col("table_name") == source.full_name)
        newer = newer_than(loads, "mark_high", mark)
        first_load = newer.agg(F.min("load_id").alias("first")).first()["first"]
        if first_load is None:
            return rows.where(F.lit(False))
        open_loads = rows.where(F.col("load_id").between(first_load, newest_load))
        return newer_than(open_loads, "collected_at", mark)

    # ---- documents -> bronze ----------------------------------------------

    def load_bronze(
        self, documents: DataFrame, batch_key: str | None = None, many_months: bool = False
    ) -> None:
        """Parse documents and append the readings; unusable ones go to the
        rejected documents."""
        progress = self._begin("bronze", batch_key)
        if progress is None:
            return
        load = progress.next_load(BRONZE)
        flat = landing.flatten(landing.parse(documents), self.options.falsy_as_null)
        seen, watched = observe(flat, rejected=F.count_if(F.col("reject_reason").isNotNull()))
        after = progress.of(BRONZE, "max_key") or 0
        # The documents are read and parsed once; numbering reads the stored rows.
        newest = landing.first_landed(landing.good_documents(watched))
        entry = self._write_bronze(landing.bronze_rows(newest, after), load, many_months)
        counts = seen.get
        entry["copies"] = counts["row_count"] - counts["rejected"] - entry["inserted"]
        # The second read of the documents is made only when something was rejected.
        if counts["rejected"]:
            rejects = landing.rejected_documents(flat)
            counted = self.store.write_load(BRONZE_REJECTS, rejects, load.load_id)
            entry["rejected"] = counted["row_count"]
        self._commit(load, "bronze", batch_key, [entry])

    def append_readings(self, readings: DataFrame, batch_key: str | None = None) -> None:
        """Append rows that already have the bronze columns."""
        progress = self._begin("bronze", batch_key)
        if progress is None:
            return
        load = progress.next_load(BRONZE)
        entry = self._write_bronze(readings, load, False) | {"copies": 0}
        self._commit(load, "bronze", batch_key, [entry])

    def _write_bronze(self, readings: DataFrame, load: Load, many_months: bool) -> dict:
        seen = self.store.write_load(
            BRONZE,
            with_month(readings, "data_timestamp"),
            load.load_id,
            many_months,
            newest=F.max("collected_at"),
            max_key=F.max("id"),
        )
        return {
            "table_name": BRONZE.full_name,
            "inserted": seen["row_count"],
            "updated": 0,
            "rejected": 0,
            "mark_high": seen["newest"],
            "max_key": seen["max_key"],
        }

    # ---- bronze -> silver --------------------------------------------------

    def transform(self, batch_key: str | None = None, many_months: bool = False) -> None:
        """Clean the bronze increment into silver; invalid rows go to the rejects."""
        progress = self._begin("silver", batch_key)
        if progress is None:
            return
        load = progress.next_load(SILVER)
        options = self.options
        newest_load = progress.of(BRONZE, "load_id")
        tagged = clean.conform(
            self._increment(BRONZE, SILVER, progress, newest_load).drop("p_month", "load_id"),
            (),
            calendar=options.calendar,
            shifted_wind=options.shifted_wind,
        ).withColumn("created_at", _now())
        # The keys, silver and the rejects are each taken from stored bronze: cleaning is a
        # projection, cheaper than a copy of all columns, and the keys need few of them.
        scan, watched = observe(
            tagged,
            rejected=F.count_if(F.col("reject_reason").isNotNull()),
            newest=F.max("collected_at"),
        )
        valid = with_month(clean.valid_rows(watched), "data_timestamp")
        if self._index_keys:
            copies = self._index(tagged, load, progress)
            if copies is not None:
                valid = valid.join(copies, "id", "left_anti")
        written = self.store.write_load(
            SILVER,
            valid,
            load.load_id,
            many_months,
            newest=F.max("collected_at"),
            **profile_measures([c for c, _ in MEASURES]),
        )
        scanned = scan.get
        rejected = scanned["rejected"]
        if rejected:
            # Rows above the target's mark can be scanned twice; they are
            # reported as rejected the first time only.
            fresh = clean.rejected_rows(tagged)
            already = progress.of(SILVER, "scanned_high")
            if already and not self.options.by_load:
                fresh = newer_than(fresh, "collected_at", already)
            rejected = self.store.write_load(SILVER_REJECTS, fresh, load.load_id)["row_count"]
        self._store_profile(written, load)
        entry = {
            "table_name": SILVER.full_name,
            "inserted": written["row_count"],
            "updated": 0,
            "rejected": rejected,
            "copies": scanned["row_count"] - scanned["rejected"] - written["row_count"],
            "mark_high": written["newest"],
            "scanned_high": scanned["newest"],
            "source_load": newest_load,
            "index_keys": self._index_keys,
        }
        self._commit(load, "silver", batch_key, [entry])

    def _store_profile(self, written: dict, load: Load) -> None:
        """What the write of a silver load has seen of its measures; no second read."""
        seen = profile_rows(written, [c for c, _ in MEASURES])
        names = [c for c, _ in LOAD_PROFILE.columns]
        ddl = ", ".join(f"{c} {t}" for c, t in LOAD_PROFILE.columns)
        rows = [(SILVER.full_name, *[row[c] for c in names[1:]]) for row in seen]
        self.store.write_load(
            LOAD_PROFILE, self.spark.createDataFrame(rows, ddl).coalesce(1), load.load_id
        )

    def profile(self) -> DataFrame:
        """Counts, NULL rates, ranges and numbers of distinct values of silver's measures over
        all committed loads, from what every load has stored: silver is not read."""
        return merged_profiles(self.table(LOAD_PROFILE))

    # ---- copies of readings --------------------------------------------------

    @property
    def _index_keys(self) -> str | None:
        """What the reading index is keyed by; None when copies are kept."""
        keys = self.options.dedupe_keys
        return None if not keys or tuple(keys) == ("id",) else ", ".join(keys)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """Rows with `reading_key` and `p_day`; those with a NULL key are nobody's copies and
        left out. Keys without the reading time are all of one day."""
        keys = list(self.options.dedupe_keys)
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        others = [F.col(k).cast("string") for k in keys if k != "data_timestamp"]
        moment = F.col("data_timestamp") if "data_timestamp" in keys else sql_timestamp(FIRST_MARK)
        return (
            rows.where(whole)
            .withColumns(
                {"reading_key": F.concat_ws("\u0001", *others), "data_timestamp": moment}
            )
            .withColumn("p_day", day_of(F.col("data_timestamp")))
        )

    def _index(self, tagged: DataFrame, load: Load, progress: Progress) -> DataFrame | None:
        """Adds the new keys of an increment to the index. Returns the ids of valid readings that
        are copies, of one in the increment or of a stored one; None when there are none.

        Of the copies in an increment the one collected first stays. Only keys and ids are
        shuffled. Of the index the days of the increment are opened, and in their
        files the row groups of its times: that depends on the increment, not on how much
        the month holds already.
        """
        self._complete_index(load, progress)
        keys = self._keyed(clean.valid_rows(tagged)).select(
            "id", "reading_key", "data_timestamp", "collected_at", "p_day"
        )
        seen, watched = observe(keys)
        narrow = stored(watched, "reading-keys")
        spans = narrow.groupBy("p_day").agg(
            F.min("data_timestamp").alias("first"), F.max("data_timestamp").alias("last")
        )
        taken = self.store.read(READING_INDEX).where(
            _within(spans.collect()) & (F.col("load_id") < load.load_id)
        )
        age = F.struct(F.col("collected_at").isNull(), "collected_at", "id")
        on = ["reading_key", "data_timestamp"]
        firsts = narrow.groupBy(*on, "p_day").agg(F.min_by("id", age).alias("id"))
        fresh = firsts.join(taken.select(*on), on, "left_anti")
        kept = self.store.write_load(READING_INDEX, fresh.drop("id"), load.load_id)
        if seen.get["row_count"] == kept["row_count"]:
            return None
        # the index has no ids; they are found again from the stored keys, and only here
        return stored(narrow.select("id").join(fresh.select("id"), "id", "left_anti"), "reading-copies")

    def _complete_index(self, load: Load, progress: Progress) -> None:
        """Build the index anew where silver has loads that it does not know or knows by other
        keys, as after a change of the keys. Stored rows have name and country in one."""
        if progress.newest(SILVER, "index_keys") == self._index_keys or load.load_id == 1:
            return
        last = load.load_id - 1
        self.store.drop_tables([READING_INDEX], delete_files=True)
        self.store.create_tables([READING_INDEX])
        silver = self.store.read(SILVER).where(F.col("load_id") <= last)
        named = silver.withColumn("identity", clean.stored_identity())
        keys = self._keyed(named).select("reading_key", "data_timestamp", "p_day").distinct()
        self.store.write_load(READING_INDEX, keys, last, many_months=True)

    # ---- silver -> gold ----------------------------------------------------

    def load_gold(self, batch_key: str | None = None, many_months: bool = False) -> None:
        """Bring dimensions and facts up to silver.

        The hourly fact, which holds the mark, is written last; all writes before
        it can be repeated. A load that failed is first repeated with its own
        input; what silver has taken in since is a load after it.
        """
        progress = self._begin("gold", batch_key)
        if progress is None:
            return
        begun = self.log.open_gold()
        if begun is not None:
            self._gold(begun, progress, many_months)
            progress = self.log.progress()
            taken = begun["source_load"] == progress.of(SILVER, "load_id")
            if taken or self.log.committed("gold", batch_key):
                return
        load = progress.next_load(FACT_HOURLY)
        source = {"table_name": FACT_HOURLY.full_name, "source_load": progress.of(SILVER, "load_id")}
        self._commit(load, f"gold{OPEN}", batch_key, [source])
        self._gold(self.log.open_gold(), progress, many_months)

    def _gold(self, begun: Row, progress: Progress, many_months: bool) -> None:
        load = Load(begun["load_id"], str(begun["recorded_at"]))
        newest_load = begun["source_load"]
        increment = self._increment(SILVER, FACT_HOURLY, progress, newest_load)
        increment = increment.drop("p_month", "load_id", "created_at")
        # One narrow pass serves the dimensions and the daily fact, one wide pass the
        # hourly fact.
        days, _ = self.store.stage(
            "city_days", star.city_days(increment, self.options.local_day), load
        )
        entries = [
            self._load_locations(days, load),
            self._load_conditions(days, load),
            self._load_days(days, load),
            self._load_hourly(increment, load, many_months) | {"source_load": newest_load},
        ]
        self._store_daily(load)
        self._commit(load, "gold", begun["batch_key"], entries)
        self.store.unstage(load)

    def _load_locations(self, days: DataFrame, load: Load) -> dict:
        """New cities are appended; only a moved city makes the table be rewritten."""
        dim = self.store.read(DIM_LOCATION)
        changes, counts = self.store.stage(
            "changed_locations",
            star.changed_locations(dim, star.locations_of(days)),
            load,
            **op_measures(),
        )
        if counts["inserted"]:  # most increments bring no new city and need no numbers
            top = highest(dim, "location_id")
            numbered = number_inserts(changes, "location_id", ["city"], top)
            changes, _ = self.store.stage("locations", _stamp_inserts(numbered), load)
        if counts["updated"]:
            after = apply_changes(dim, changes, ["city"])
            staged, _ = self.store.stage("dim_location", after, load)
            self.store.overwrite(DIM_LOCATION, staged)
        elif counts["inserted"]:
            # A failed attempt may have appended them already.
            self.store.append(DIM_LOCATION, changes.join(dim, "city", "left_anti"))
        return _entry(DIM_LOCATION, counts["inserted"], counts["updated"])

    def _load_conditions(self, days: DataFrame, load: Load) -> dict:
        dim = self.store.read(DIM_CONDITION)
        key, id_column = "weather_condition", "weather_condition_id"
        new, seen = self.store.stage(
            "new_conditions", absent_keys(dim, star.conditions_of(days), key), load
        )
        if seen["row_count"]:
            numbered = dense_ids(new, [key], id_column, after=highest(dim, id_column))
            stamped = numbered.withColumn("created_at", _now())
            rows, _ = self.store.stage("conditions", stamped, load)
            # A failed attempt may have appended them already.
            self.store.append(DIM_CONDITION, rows.join(dim, "weather_condition", "left_anti"))
        return _entry(DIM_CONDITION, seen["row_count"])

    def _load_days(self, days: DataFrame, load: Load) -> dict:
        source = star.day_source_of(days, self.store.read(DIM_LOCATION))
        # A reading without a known city cannot be a row of the fact.
        known = source.where(F.col("location_id").isNotNull()).drop("city")
        rows, span = self.store.stage(
            "day_source", known, load, first=F.min("day"), last=F.max("day")
        )
        if span["first"] is None:
            return _entry(FACT_DAY)
        # Only the days of the increment are read and replaced.
        touched = (
            self.store.read(FACT_DAY)
            .where(F.col("day").between(F.lit(span["first"]), F.lit(span["last"])))
            .join(rows.select("day").distinct(), "day", "left_semi")
            .select(*[c for c, _ in FACT_DAY.columns])
        )
        merged = star.merge_days(touched, rows, self.options.null_safe_days)
        staged, counts = self.store.stage(
            "fact_day", _stamp_inserts(merged), load, **op_measures()
        )
        if counts["inserted"] or counts["updated"]:
            changed = touched_rows(staged).select("day").distinct()
            self.store.overwrite_partitions(
                FACT_DAY, staged.join(changed, "day", "left_semi").hint("rebalance", "day")
            )
        return _entry(FACT_DAY, counts["inserted"], counts["updated"])

    def _load_hourly(self, increment: DataFrame, load: Load, many_months: bool) -> dict:
        locations, conditions = self.store.read(DIM_LOCATION), self.store.read(DIM_CONDITION)
        rows = star.hourly_rows(increment, locations, conditions)
        seen = self.store.write_load(
            FACT_HOURLY,
            with_month(rows.withColumn("created_at", _now()), "data_timestamp"),
            load.load_id,
            many_months,
            newest=F.max("collected_at"),
        )
        return _entry(FACT_HOURLY, seen["row_count"]) | {"mark_high": seen["newest"]}

    def _store_daily(self, load: Load) -> None:
        """What the load's hourly rows add to the daily summary. A warehouse that has loads
        from before there was a summary gets theirs as one."""
        hourly = self.store.read(FACT_HOURLY)

        def add(rows: DataFrame, load_id: int) -> None:
            state = star.daily_state(rows)
            self.store.write_load(DAILY_STATE, with_month(state, "day"), load_id)

        if load.load_id > 1 and not self.store.has_files(DAILY_STATE):
            add(hourly.where(F.col("load_id") < load.load_id), load.load_id - 1)
        add(hourly.where(F.col("load_id") == load.load_id), load.load_id)

    def daily_summary(self) -> DataFrame:
        """Readings and temperatures per city and day, from what every load has added: the
        hourly fact is not read."""
        states = star.merged_states(self.table(DAILY_STATE))
        return star.summary_of(states, self.store.read(DIM_LOCATION))

    # ---- checks ------------------------------------------------------------

    def check(self) -> DataFrame:
        """Violations of every declared constraint of every table, and the readings that
        gold has taken over without an hourly row."""
        stored = {table.full_name: self.table(table) for table in TABLES}
        checks = [
            check_table(stored[table.full_name], table, stored)
            for table in TABLES
            if table.unique or table.required or table.references
        ]
        taken = self.log.progress().of(FACT_HOURLY, "source_load") or 0
        silver = stored[SILVER.full_name].where(F.col("load_id") <= taken).select("id")
        lost = silver.join(self.table(FACT_HOURLY).select("id"), "id", "left_anti")
        checks.append(
            lost.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(FACT_HOURLY.full_name).alias("table_name"),
                F.lit("every silver id").alias("constraint_name"),
                "violations",
            )
        )
        return reduce(DataFrame.unionByName, checks)

    # ---- whole runs --------------------------------------------------------

    def run(
        self, documents: DataFrame, batch_key: str | None = None, many_months: bool = False
    ) -> DataFrame:
        """One increment from documents to gold; returns its audit rows. With a
        `batch_key`, a step that was committed under it is not done again."""
        batch_key = batch_key or own_key()
        self.load_bronze(documents, batch_key, many_months)
        self.transform(batch_key, many_months)
        self.load_gold(batch_key, many_months)
        self.maintain()
        return self.audit().where(F.col("batch_key") == batch_key)

    def maintain(self) -> None:
        """What keeps the number of files bounded: the log's tail is folded when it is long,
        load folders are merged once in `merge_every` loads."""
        loads = self.log.progress().of(BRONZE, "load_id") or 0
        if self.options.merge_every and loads and loads % self.options.merge_every == 0:
            self.merge_loads()
        self.log.fold()

    def merge_loads(self, target_bytes: int = TARGET_BYTES, least: int = LEAST) -> None:
        """Merge the folders of loads that every target has taken over; see merging."""
        self.log.refresh()
        progress = self.log.progress()
        taken = {
            BRONZE: progress.of(SILVER, "source_load"),
            SILVER: progress.of(FACT_HOURLY, "source_load"),
        }
        for table in _MERGED:
            upto = taken.get(table, _committed_load(table, progress)) or 0
            for done in merge_folders(self.store, table, upto, target_bytes, least):
                entry = {"table_name": table.full_name, "inserted": done["rows"]}
                note = f"{done['folders']} folders into {done['bins']}"
                self._commit(Load(done["load_id"]), MERGE, note, [entry])

    def replay(self, path: str, layout: str = "landed") -> DataFrame:
        """Rebuild every table from the landed documents, one landing month after
        the other, so that a step never holds more than a month.

        The new tables grow beside the old ones and take their place when the last
        month is committed; a replay that fails leaves the old tables as they were.
        """
        months = landing.landing_months(self.spark, path, layout)
        documents = landing.read_landed(self.spark, path, layout)
        mark = uuid.uuid4().hex[:10]
        beside = Warehouse(
            self.spark, f"{self.store.root}/replay-{mark}", f"r{mark}_", self.options
        )
        for month in months:
            end = F.add_months(F.lit(month), 1)
            part = documents.where((F.col("ingest_date") >= month) & (F.col("ingest_date") < end))
            beside.run(part, f"replay {month:%Y-%m}", many_months=True)
        self.store.replace_with(beside.store, f"replay-{mark}")
        self.log.refresh()
        return self.audit()


def _committed_load(table: Table, progress: Progress) -> int:
    """The newest committed load of the step that fills an append table."""
    own = {
        BRONZE_REJECTS: BRONZE,
        SILVER_REJECTS: SILVER,
        READING_INDEX: SILVER,
        LOAD_PROFILE: SILVER,
        DAILY_STATE: FACT_HOURLY,
    }
    return progress.of(own.get(table, table), "load_id") or 0


def _within(spans: list[Row]) -> Column:
    """Rows of the given days, each between its first and last time; of many days, rows
    between the first and the last."""
    if not spans:
        return F.lit(False)
    if len(spans) > MOST_DAYS:
        first, last = min(r["first"] for r in spans), max(r["last"] for r in spans)
        spans = [Row(p_day=None, first=first, last=last)]
        days = F.col("p_day").between(F.lit(first.date()), F.lit(last.date()))
    else:
        days = F.col("p_day").isin([r["p_day"] for r in spans])
    times = [
        F.col("data_timestamp").between(sql_timestamp(r["first"]), sql_timestamp(r["last"]))
        for r in spans
    ]
    # the days prune folders, the times row groups
    return days & reduce(lambda a, b: a | b, times)


def _now() -> Column:
    """The time of the run: one literal, the same on every retried task."""
    return sql_timestamp(datetime.now(timezone.utc).replace(tzinfo=None))


def _stamp_inserts(merged: DataFrame) -> DataFrame:
    return merged.withColumn(
        "created_at", F.when(F.col("_op") == INSERTED, _now()).otherwise(F.col("created_at"))
    )


def _entry(table: Table, inserted: int = 0, updated: int = 0) -> dict:
    return {
        "table_name": table.full_name,
        "inserted": inserted,
        "updated": updated,
        "rejected": 0,
    }
