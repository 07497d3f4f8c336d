"""Keyed score and feature tables on parquet, written as batches.

A write adds one batch: new rows, and the keys whose earlier rows it replaces.
Nothing stored is rewritten, so a write costs what its batch is worth. A batch
counts from the moment its commit file exists: writes are all or nothing, and
folders of failed writers are never read. ``compact`` merges batches.

``rows/batch=N-x/day=D`` holds rows, ``gone/batch=N-x/day=D`` replaced keys,
``marks/batch=N-x`` the newest time of each group, ``_commits/N.json`` what batch
N is. The key is a parameter: ``(series, ts, model_path)`` for scores written by
the backfill, plus ``feature_key`` where several feature versions are scored side by side.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions.columns import naive_utc, parse_ts, ts_lit
from barline.operators.joins import DuplicateKeys, duplicate_keys, require_unique
from barline.session import cut, scratch_path, stack

SCORE_SCHEMA = ("series string, ts timestamp_ntz, model_path string, y_pred double, feature_key string, "
                "dataset string, created_at timestamp_ntz")
FEATURE_SCHEMA = "feature_key string, series string, ts timestamp_ntz, features string, created_at timestamp_ntz"
SCORE_KEY = ("series", "ts", "model_path")
SCORE_VERSION_KEY = ("series", "ts", "model_path", "feature_key")
FEATURE_KEY = ("series", "feature_key", "ts")
DAY, BATCH = "day", "batch"
#: Columns of the groups whose newest time is kept, as far as a table has them.
MARKED = ("series", "model_path", "dataset")
UNIQUE = "_unique-"


class BadRows(ValueError):
    """Rows lack a required value."""


class WriteConflict(RuntimeError):
    """Another writer has committed since this one looked."""


class Store:
    """A parquet table of batches with a unique key.

    Every write keeps the key unique, so the whole table is checked only when it
    is opened for the first time under a key; an empty file in its folder,
    named after the key, records that. Rows that others add to the folder are not seen.
    Of two writers that commit at once one fails.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: Sequence[str]):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, list(key)

    @property
    def columns(self) -> list[str]:
        return [f.split()[0] for f in self.schema.split(", ")]

    @property
    def types(self) -> dict[str, str]:
        return dict(f.split() for f in self.schema.split(", "))

    @property
    def marked(self) -> list[str]:
        return [c for c in MARKED if c in self.columns]

    def _at(self, name: str = ""):
        """A place in the table's folder, and its file system."""
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path + (f"/{name}" if name else ""))
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _has(self, name: str) -> bool:
        target, fs = self._at(name)
        return bool(fs.exists(target))

    def exists(self) -> bool:
        return self._has("_commits")

    def _names(self, pattern: str) -> list[str]:
        target, fs = self._at(pattern)
        return sorted(f.getPath().getName() for f in fs.globStatus(target) or [])

    def _touch(self, name: str, text: str = "") -> None:
        """Create a file that must not exist yet."""
        target, fs = self._at(name)
        out = fs.create(target, False)
        out.write(bytearray(text.encode()))
        out.close()

    def _remove(self, name: str) -> None:
        target, fs = self._at(name)
        fs.delete(target, True)

    # --- keys known to be unique

    def _checked_keys(self) -> list[tuple[str, list[str]]]:
        """The marks of keys known to be unique: file name and columns."""
        return [(n, n[len(UNIQUE):].split("-")) for n in self._names(UNIQUE + "*")]

    def _mark_unique(self) -> None:
        name = UNIQUE + "-".join(self.key)
        if not self._has(name):
            self._touch(name)

    def _known_unique(self) -> bool:
        return any(set(k) <= set(self.key) for _, k in self._checked_keys())

    def ensure(self) -> "Store":
        """Create the table if absent; check its key otherwise. A folder of plain
        parquet is checked and taken in as the first batch."""
        if not self.exists():
            plain = self._plain()
            target, fs = self._at("_commits")
            if plain is None:
                fs.mkdirs(target)
                self._mark_unique()
                return self
            require_unique(plain, self.key, f"table at {self.path}")
            self._mark_unique()
            with self._staged(plain) as batch:
                self._commit("append", batch)
            return self
        if not self._known_unique():
            require_unique(self.read(), self.key, f"table at {self.path}")
            self._mark_unique()
        return self

    def _plain(self) -> DataFrame | None:
        """Rows of a folder that is not a table of batches yet; None without any."""
        if not self._has(""):
            return None
        try:
            rows = self.spark.read.parquet(self.path)
        except AnalysisException as e:
            if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            return None
        lacking = [c for c in self.key if c not in rows.columns]
        if lacking:
            raise BadRows(f"table at {self.path} has no column {lacking}; recreate it with the current schema")
        return rows.drop(DAY)

    # --- commits

    def commits(self) -> list[dict]:
        """The batches that count, oldest first: those from the last full compaction on."""
        base = max((n.split(".")[0] for n in self._names("_commits/*.base")), default="")
        io, out = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils, []
        for name in [n for n in self._names("_commits/*.json") if n >= base]:
            target, fs = self._at(f"_commits/{name}")
            stream = fs.open(target)
            try:
                text = io.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text:  # an empty one was never finished
                out.append(json.loads(text))
        return out

    def _number(self) -> int:
        """The number after the last one used."""
        return max((int(n.split(".")[0]) for n in self._names("_commits/*.json")), default=0) + 1

    def _commit(self, kind: str, rows: DataFrame | None = None, gone: DataFrame | None = None, marks: DataFrame | None = None,
                number: int | None = None, base: bool = False, **more) -> None:
        """Write the parts of a batch, then the file that makes it count. ``rows``
        and ``gone`` should be stored frames: they are read more than once."""
        number = number or self._number()
        batch = f"{number:010d}-{uuid.uuid4().hex[:8]}"
        entry = {"batch": batch, "kind": kind, "rows": False, "gone": False, "marks": False} | more
        if rows is not None:
            span = rows.agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last")).first()
            if span.first is not None:
                entry |= {"rows": True} | ({} if kind == "compact" else {"first": str(span.first), "last": str(span.last)})
                # Rebalancing gives each day few files, and splits a day that holds much.
                placed = rows.select(*self.columns).withColumn(DAY, F.to_date("ts")).hint("rebalance", DAY)
                placed.write.partitionBy(DAY).parquet(f"{self.path}/rows/{BATCH}={batch}")
                marks = self._newest_of(rows) if marks is None and kind != "compact" else marks
        if gone is not None:
            entry["gone"] = True
            gone.select(*self.key).withColumn(DAY, F.to_date("ts")).hint("rebalance", DAY).write.partitionBy(DAY).parquet(
                f"{self.path}/gone/{BATCH}={batch}")
        if marks is not None and self.marked:
            entry["marks"] = True
            marks.select(*self.marked, "ts").write.parquet(f"{self.path}/marks/{BATCH}={batch}")
        try:
            self._touch(f"_commits/{number:010d}.json", json.dumps(entry))
        except Exception as e:
            if "already exists" not in str(e):
                raise
            raise WriteConflict(f"batch {number} of {self.path} is another writer's") from e
        if base:  # only spares readers the files before it
            self._touch(f"_commits/{number:010d}.base")

    # --- reading

    def _part(self, name: str, entries: Sequence[dict], schema: str) -> DataFrame:
        """One part of the given batches, with their batch and day."""
        base = f"{self.path}/{name}"
        paths = [f"{base}/{BATCH}={e['batch']}" for e in entries if e[name]]
        full = f"{schema}, {BATCH} string" + ("" if name == "marks" else f", {DAY} date")
        if not paths:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", base).parquet(*paths)

    @staticmethod
    def _voided(rows: DataFrame, entries: Sequence[dict], days: bool = True) -> DataFrame:
        """Without what a later compaction holds or a later delete removed."""
        for e in entries:
            before = F.col(BATCH) < e["batch"]
            if e["kind"] == "compact" and days:
                covered = F.col(DAY).between(F.lit(e["first"]).cast("date"), F.lit(e["last"]).cast("date"))
                rows = rows.where(~(before & covered))
            if e["kind"] == "delete" and "dataset" in rows.columns:
                rows = rows.where(~(before & F.col("dataset").eqNullSafe(F.lit(e["label"]))))
        return rows

    def _live(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """The rows that count, with batch and day, of the days asked for. Batches
        and days outside are not read."""
        entries = self.commits()

        def meets(e: dict) -> bool:
            return not ((first is not None and e.get("last") and e["last"] < str(first))
                        or (last is not None and e.get("first") and e["first"] > str(last)))

        def bounded(rows: DataFrame) -> DataFrame:
            if first is not None:
                rows = rows.where(F.col(DAY) >= F.lit(str(first)).cast("date"))
            return rows.where(F.col(DAY) <= F.lit(str(last)).cast("date")) if last is not None else rows

        near = [e for e in entries if meets(e)]
        rows = self._voided(bounded(self._part("rows", near, self.schema)), entries)
        if any(e["gone"] for e in near):
            key_schema = ", ".join(f"{k} {self.types[k]}" for k in self.key)
            gone = self._voided(bounded(self._part("gone", near, key_schema)), entries)
            latest = gone.groupBy(DAY, *self.key).agg(F.max(BATCH).alias("_gone")).select(
                F.col(DAY).alias("_day"), *[F.col(k).alias(f"_{k}") for k in self.key], "_gone")
            same = (F.col(DAY) == F.col("_day")) & (F.col(BATCH) < F.col("_gone"))
            for k in self.key:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            rows = rows.join(latest, same, "left_anti")
        return rows

    def read(self, first: object = None, last: object = None) -> DataFrame:
        """The stored rows; with bounds (times), those from ``first`` to
        ``last``, and only their days are read."""
        rows = self._live(*[None if b is None else naive_utc(b).date() for b in (first, last)])
        if first is not None:
            rows = rows.where(F.col("ts") >= ts_lit(first))
        if last is not None:
            rows = rows.where(F.col("ts") <= ts_lit(last))
        return rows.select(*self.columns)

    def high_water(self) -> DataFrame:
        """The newest time (``ts``) of each group that has rows: series, model
        and dataset, as far as the table has them. Reads the marks that writes
        leave, one row per group and batch, and none of the rows."""
        entries = self.commits()
        if any(e.get("stale") for e in entries) and max((e["batch"] for e in entries if e.get("stale")), default="") > max(
                (e["batch"] for e in entries if e["kind"] == "marks"), default=""):
            self._mend_marks()  # a writer was lost between a replacement and its marks
            entries = self.commits()
        marks = self._voided(self._part("marks", entries, self._mark_schema()), entries, days=False)
        mended = [e for e in entries if e["kind"] == "marks"]
        if mended:  # marks of a group before its last mending don't count
            late = marks.where(F.col(BATCH).isin([e["batch"] for e in mended])).groupBy(*self.marked).agg(F.max(BATCH).alias("_from"))
            late = late.select(*[F.col(c).alias(f"_{c}") for c in self.marked], "_from")
            same = F.lit(True)
            for c in self.marked:
                same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
            marks = marks.join(late, same, "left").where(F.col("_from").isNull() | (F.col(BATCH) >= F.col("_from")))
        return marks.groupBy(*self.marked).agg(F.max("ts").alias("ts")).where("ts is not null")

    def _mark_schema(self) -> str:
        return ", ".join(f"{c} {self.types[c]}" for c in [*self.marked, "ts"])

    def _newest_of(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.marked).agg(F.max("ts").alias("ts"))

    # --- writing

    def conform(self, rows: DataFrame) -> DataFrame:
        """Rows with the table's columns; absent ones are NULL, and
        ``created_at`` is now."""
        fill = {"created_at": F.current_timestamp().cast("timestamp_ntz")}
        absent = {c: fill.get(c, F.lit(None)) for c in self.columns if c not in rows.columns}
        full = rows.withColumns({c: v.cast(self.types[c]) for c, v in absent.items()}) if absent else rows
        return full.select(*[F.col(c).cast(self.types[c]).alias(c) for c in self.columns])

    @contextmanager
    def _staged(self, rows: DataFrame) -> Iterator[DataFrame]:
        """The conformed rows, written once to a staging folder: the batch is
        computed a single time, and the checked rows are the stored rows."""
        staging = scratch_path(self.spark, "staging")
        try:
            self.conform(rows).write.parquet(staging)
            yield self.spark.read.schema(self.schema).parquet(staging)
        finally:
            target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging)
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def _near(self, batch: DataFrame) -> DataFrame:
        """Stored rows between the first and last day of the batch."""
        days = batch.agg(F.to_date(F.min("ts")).alias("lo"), F.to_date(F.max("ts")).alias("hi")).first()
        return self._live(days.lo, days.hi)

    def _write(self, rows: DataFrame, kind: str = "append", number: int | None = None, gone: DataFrame | None = None, **more) -> None:
        """Add a checked batch. Rows unique under this key need not be so under another."""
        for name, key in self._checked_keys():
            if not set(self.key) <= set(key):
                self._remove(name)
        self._commit(kind, rows, gone, number=number, **more)

    def append_unique(self, rows: DataFrame) -> int:
        """Add rows; a key that is stored already, or twice in the batch, fails
        the whole batch. Returns the number of rows."""
        number = self._number()
        with self._staged(rows) as batch:
            n = batch.count()
            if not n:
                return 0
            require_unique(batch, self.key, "batch")
            clash = batch.join(self._near(batch).select(*self.key), self.key, "left_semi").limit(5).collect()
            if clash:
                raise DuplicateKeys(f"already stored: {[tuple(r[k] for k in self.key) for r in clash]}")
            self._write(batch, number=number)
            return n

    def append_missing(self, rows: DataFrame) -> None:
        """Add only rows whose key is not stored yet, one per key."""
        number = self._number()
        with self._staged(rows) as batch:
            if batch.limit(1).count():
                fresh = batch.join(self._near(batch).select(*self.key), self.key, "left_anti").dropDuplicates(self.key)
                with self._staged(fresh) as checked:
                    self._write(checked, number=number)

    def replace_by_key(self, rows: DataFrame) -> None:
        """Replace rows of the same key; a key that is twice in ``rows`` fails
        the batch. Writes the rows and their keys, and nothing that is stored."""
        number = self._number()
        with self._staged(rows) as batch:
            if not batch.limit(1).count():
                return
            require_unique(batch, self.key, "batch")
            lost = self._lowered(batch)
            self._write(batch, "replace", number, batch, stale=lost is not None)
            if lost is not None:
                self._mend_marks(lost)

    def _lowered(self, batch: DataFrame) -> DataFrame | None:
        """Groups that lose their newest row when the batch moves it to another
        group; None if there are none."""
        moving = [c for c in self.marked if c not in self.key]
        if not moving:
            return None
        new = batch.select(*self.key, *[F.col(c).alias(f"_{c}") for c in moving])
        same = F.lit(True)
        for c in moving:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        left = self._near(batch).select(*dict.fromkeys([*self.key, *moving])).join(new, self.key).where(~same)
        newest = left.groupBy(*self.marked).agg(F.max("ts").alias("_lost")).select(
            *[F.col(c).alias(f"_{c}") for c in self.marked], "_lost")
        at_top = F.col("ts") == F.col("_lost")
        for c in self.marked:
            at_top = at_top & F.col(c).eqNullSafe(F.col(f"_{c}"))
        groups = cut(self.high_water().join(newest, at_top, "left_semi").select(*self.marked))
        return None if groups.isEmpty() else groups

    def _mend_marks(self, groups: DataFrame | None = None) -> None:
        """Find the newest time of the groups (all by default) from the last day
        backwards, and let it replace their marks."""
        entries = self.commits()
        if groups is None:
            groups = self._part("marks", entries, self._mark_schema()).select(*self.marked).distinct()
        days = [date.fromisoformat(e[k]) for e in entries for k in ("first", "last") if e.get(k)]
        left, found = cut(groups), []
        last, reach = max(days, default=None), 8
        while last is not None and last >= min(days) and not left.isEmpty():
            first = last - timedelta(days=reach - 1)
            rows = self._live(first, last)
            here = cut(self._newest_of(_among(rows, left, self.marked)))
            found.append(here)
            left = cut(_among(left, here, self.marked, "left_anti"))
            last, reach = first - timedelta(days=1), reach * 4
        marks = stack(*found, left.withColumn("ts", F.lit(None).cast("timestamp_ntz")))
        self._commit("marks", marks=marks)

    def delete_dataset(self, label: str) -> None:
        """Remove the rows of a dataset: what is stored so far is passed over from now on."""
        self._commit("delete", label=label)

    def compact(self, first: date | None = None, last: date | None = None) -> None:
        """Write the rows of the days from ``first`` to ``last`` (all by default)
        as one batch that stands for the earlier ones, replaced and deleted rows
        left out. Older files stay for readers that began before; see :meth:`clean`."""
        number, entries = self._number(), self.commits()
        days = [date.fromisoformat(e[k]) for e in entries for k in ("first", "last") if e.get(k)]
        if not days:
            return
        whole = first is None and last is None
        span = {"first": str(first or min(days)), "last": str(last or max(days))}
        marks = self.high_water() if whole and self.marked else None
        with self._staged(self._live(first, last)) as rows:
            self._commit("compact", rows, marks=marks, number=number, base=whole, **span)

    def clean(self) -> int:
        """Remove the folders of batches before the last full compaction, and of
        writers that never committed; no other reader or writer may be at work.
        Returns how many."""
        live = {e["batch"] for e in self.commits()}
        dead = [f"{part}/{n}" for part in ("rows", "gone", "marks") for n in self._names(f"{part}/{BATCH}=*")
                if n.removeprefix(f"{BATCH}=") not in live]
        for name in dead:
            self._remove(name)
        return len(dead)


def _among(rows: DataFrame, groups: DataFrame, columns: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose ``columns`` are (or are not) among the groups, NULL equal to NULL."""
    named = groups.select(*[F.col(c).alias(f"_{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(named, same, how)


def score_store(spark: SparkSession, path: str, key: Sequence[str] = SCORE_KEY) -> Store:
    return Store(spark, path, SCORE_SCHEMA, key)


def feature_store(spark: SparkSession, path: str) -> Store:
    return Store(spark, path, FEATURE_SCHEMA, FEATURE_KEY)


def upsert_features(store: Store, rows: DataFrame) -> None:
    store.ensure().replace_by_key(rows)


def first_present(df: DataFrame, names: Sequence[str]) -> Column:
    """The first non-empty value among the columns the frame has."""
    have = [F.col(n).cast("string") for n in names if n in df.columns]
    return F.coalesce(*[F.when(c != "", c) for c in have]) if have else F.lit(None).cast("string")


def normalize_payload(df: DataFrame, keys: Sequence[str] = ("series",), on_bad: str = "fail") -> DataFrame:
    """Payload rows to ``keys, ts, y_pred, model_path, feature_key``.

    Accepts ``ts`` or ``timestamp`` and ``model_path`` or ``model_run``; all
    four values are required. ``on_bad``: ``fail`` when the row is reached,
    ``drop``, or ``keep`` (adds the column ``bad``).
    """
    named = df.select(
        *keys, parse_ts(first_present(df, ["ts", "timestamp"])).alias("ts"),
        first_present(df, ["y_pred"]).try_cast("double").alias("y_pred"),
        first_present(df, ["model_path", "model_run"]).alias("model_path"),
        first_present(df, ["feature_key"]).alias("feature_key"))
    required = ("ts", "y_pred", "model_path", "feature_key")
    bad = F.greatest(*[F.col(c).isNull() for c in required])
    if on_bad == "keep":
        return named.withColumn("bad", bad)
    if on_bad == "drop":
        return named.where(~bad)
    message = F.concat(F.lit("payload lacks ts, y_pred, model_path or feature_key: "), F.to_json(F.struct("*")))
    return named.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def append_check(stored: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Batch rows that an append must reject: stored already, or twice in the
    batch. Columns ``key, reason``."""
    key = list(key)
    twice = duplicate_keys(batch, key, None).select(*key, F.lit("twice_in_batch").alias("reason"))
    known = batch.join(stored.select(*key), key, "left_semi").select(*key, F.lit("stored").alias("reason")).distinct()
    return stack(twice, known)


def replaced(stored: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The table after a delete-and-insert of ``batch``."""
    kept = stored.join(batch.select(*key), list(key), "left_anti")
    return stack(kept, batch, allow_missing=True).select(*stored.columns)


def without_dataset(stored: DataFrame, label: str) -> DataFrame:
    """The table without a dataset; rows of no dataset stay."""
    return stored.where(~F.col("dataset").eqNullSafe(F.lit(label)))


def add_models(scores: DataFrame, new_paths: Sequence[str]) -> DataFrame:
    """The same scores under further model paths, to be stored side by side."""
    return scores.withColumn("model_path", F.explode(F.array(*[F.lit(p) for p in new_paths])))
