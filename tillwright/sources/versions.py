"""Versioned tables: slots in files that never change, and one pointer that moves.

A load writes its files beside all others, then a manifest of every file that the new
version holds, and last a small file with the next number. That file is the commit: it
appears at once or not at all, so readers see the whole of the old version or the
whole of the new one, and a driver lost at any moment leaves the old one as it was.

    <root>/data/load=<id>/kind=rows/date=.../hour=.../*.parquet
    <root>/manifests/<id>/*.parquet     all files of a version, with their keys' range and origin
    <root>/versions/00000007.json       what version 7 is

``date_tmsp`` is not stored but told from the date, so a condition on it is one on
the folders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions.slotted import in_dates, in_lists, in_slots
from tillwright.functions.times import utc_midnight
from tillwright.operators.slots import SlotLists, with_slot
from tillwright.schemas import Dataset
from tillwright.session import discard, list_names, read_text, rename_new, write_text
from tillwright.sources.lake import Slots, by_slot, unescaped

ROWS, REJECTED = "rows", "rejected"
REASONS = "reasons"
# Tells a rejected row from all others, by what it held.
LINEAGE = "lineage"
# Ranges that a merge takes its keys in.
_RANGES = 64
_FILE = "kind string, date string, hour string, folder string, file string, bytes bigint, " \
        "n_rows bigint, low string, high string, written bigint, origin string"
_PLACE = r"/data/(load=[^/]+/kind=([^/]+)/date=([^/]+)/hour=([^/]+))/([^/]+)$"


class Conflict(Exception):
    """Another writer committed first, and this change cannot follow it."""


@dataclass(frozen=True)
class Store:
    """A versioned table of one dataset; ``cluster`` is the column its files are cut by."""

    root: str
    dataset: Dataset
    cluster: str = "product_id"

    @property
    def columns(self) -> list[str]:
        return [*self.dataset.body.fieldNames(), "date", "hour"]

    @property
    def file_schema(self) -> T.StructType:
        text = (REASONS, LINEAGE, "load", "kind", "date", "hour")
        return T.StructType([*self.dataset.body.fields, *[T.StructField(n, T.StringType()) for n in text]])


@dataclass(frozen=True)
class Version:
    number: int
    manifest: str
    facts: dict = field(default_factory=dict)


def versions(spark: SparkSession, store: Store) -> list[int]:
    """Numbers of the committed versions, in order."""
    names = list_names(spark, f"{store.root}/versions")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def version(spark: SparkSession, store: Store, number: int | None = None) -> Version | None:
    """The version of that number, or the newest; None where nothing was committed yet."""
    if number is None:
        known = versions(spark, store)
        if not known:
            return None
        number = known[-1]
    held = json.loads(read_text(spark, f"{store.root}/versions/{number:08d}.json"))
    return Version(number, held["manifest"], held["facts"])


def _no_files(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _FILE)


def files(spark: SparkSession, store: Store, at: Version | None) -> DataFrame:
    """Every file of a version: kind, slot, folder, size, rows and range of the clustered key.

    ``origin`` is what the load was told of the slot's source, null where that is not known.
    """
    if at is None:
        return _no_files(spark)
    return spark.read.schema(_FILE).parquet(f"{store.root}/manifests/{at.manifest}")


def _publish(spark: SparkSession, store: Store, number: int, text: str) -> bool:
    """Make the pointer of a version appear, whole, unless it exists."""
    hidden = f"{store.root}/versions/.{uuid.uuid4().hex}"
    write_text(spark, hidden, text)
    return rename_new(spark, hidden, f"{store.root}/versions/{number:08d}.json")


def commit(spark: SparkSession, store: Store, change: Callable[[DataFrame, Version | None], DataFrame],
           facts: dict | None = None, tries: int = 20) -> Version:
    """Make what ``change`` turns the newest version's files into the next version.

    The number is taken by whoever creates its file first. A writer that comes second
    applies its change to what the first one left; changes of other slots never disturb
    each other. ``change`` raises ``Conflict`` where that would be wrong.
    """
    for _ in range(tries):
        base = version(spark, store)
        number = (base.number if base else 0) + 1
        manifest = f"{number:08d}-{uuid.uuid4().hex}"
        after = change(files(spark, store, base), base)
        after.select(*[f.name for f in _no_files(spark).schema]).write.parquet(
            f"{store.root}/manifests/{manifest}")
        if _publish(spark, store, number, json.dumps({"manifest": manifest, "facts": facts or {}})):
            return Version(number, manifest, facts or {})
    raise Conflict(f"no version could be committed in {tries} tries")


def _frame(spark: SparkSession, store: Store, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], store.file_schema)
    reader = spark.read.schema(store.file_schema).option("basePath", f"{store.root}/data")
    return reader.parquet(*[f"{store.root}/data/{p}" for p in paths])


def paths_of(listed: DataFrame) -> list[str]:
    """What to read for some files: the folder where all of it is meant, else single files.

    The driver holds an entry per slot, and a list of files only for slots that a merge
    has rewritten in part.
    """
    by_folder = listed.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"), F.max("written").alias("written")
    )
    whole = by_folder.where("n = written").select("folder").collect()
    parts = by_folder.where("n < written").select("folder")
    single = listed.join(parts, "folder", "left_semi").select("folder", "file").collect()
    return sorted([r.folder for r in whole] + [f"{r.folder}/{r.file}" for r in single])


def _shown(df: DataFrame, store: Store, *more: str) -> DataFrame:
    stamped = df.withColumn("date_tmsp", utc_midnight(F.col("date").cast("date")))
    return stamped.select(*store.dataset.managed_schema.fieldNames(), *more)


def read(spark: SparkSession, store: Store, number: int | None = None,
         dates: Iterable[str] | None = None, slots: Slots | None = None) -> DataFrame:
    """Rows of a version, the newest unless told otherwise, in the dataset's managed columns.

    The version is settled here, so whatever is committed later does not show. Only the
    folders of the ``dates`` or ``slots`` asked for are listed; further conditions on
    ``date``, ``hour`` and ``date_tmsp`` skip folders at the scan.
    """
    return _shown(_frame(spark, store, _paths(spark, store, number, ROWS, dates, slots)), store)


def read_rejected(spark: SparkSession, store: Store, number: int | None = None) -> DataFrame:
    """Rows that the loads of a version held back, with the ``reasons`` and their ``lineage``.

    The lineage is a digest of what a row held. A mended copy that keeps it can be given to
    ``mend``.
    """
    rows = _frame(spark, store, _paths(spark, store, number, REJECTED))
    return _shown(rows, store, REASONS, LINEAGE)


def _paths(spark: SparkSession, store: Store, number: int | None, kind: str,
           dates: Iterable[str] | None = None, slots: Slots | None = None) -> list[str]:
    listed = files(spark, store, version(spark, store, number)).where(F.col("kind") == kind)
    if dates is not None:
        listed = listed.where(in_dates(dates))
    if slots is not None:
        listed = listed.where(in_slots(slots))
    return paths_of(listed)


def slots_of(spark: SparkSession, store: Store, number: int | None = None) -> Slots:
    """Slots of a version, from its manifest."""
    held = files(spark, store, version(spark, store, number)).where(F.col("kind") == ROWS)
    return sorted((r.date, r.hour) for r in held.select("date", "hour").distinct().collect())


def changed_slots(spark: SparkSession, store: Store, since: int | None,
                  until: int | None = None) -> Slots:
    """Slots whose files are not the same in two versions, gone and new ones included."""
    before = _no_files(spark) if since is None else files(spark, store, version(spark, store, since))
    after = files(spark, store, version(spark, store, until))
    key = ["date", "hour", "folder", "file"]
    sides = [side.where(F.col("kind") == ROWS).select(*key) for side in (before, after)]
    differ = sides[0].join(sides[1], key, "left_anti").union(
        sides[1].join(sides[0], key, "left_anti"))
    return sorted((r.date, r.hour) for r in differ.select("date", "hour").distinct().collect())


def settled_slots(spark: SparkSession, store: Store, origins: dict[tuple[str, str], str]) -> Slots:
    """Slots that hold what their load wrote, all of it, from the origin they have in ``origins``.

    A slot that a merge, a mend or another load has touched since, or of which rows were held
    back, is none of them. The driver holds a row per slot.
    """
    held = files(spark, store, version(spark, store)).groupBy("date", "hour").agg(
        F.count(F.lit(1)).alias("n"), F.min("written").alias("written"),
        F.min("origin").alias("least"), F.max("origin").alias("most"), F.count("origin").alias("told"),
        F.count_if(F.col("kind") != ROWS).alias("rejected"))
    whole = held.where("n = written AND n = told AND least = most AND rejected = 0")
    return sorted((r.date, r.hour) for r in whole.collect() if origins.get((r.date, r.hour)) == r.least)


@dataclass(frozen=True)
class Staged:
    """Files of one write that no version holds yet."""

    listed: DataFrame
    facts: dict


def _written(spark: SparkSession, store: Store, load: str) -> DataFrame:
    """The files of a load, told from one column of them.

    A file is written in the order of its key, nulls first. So its least and greatest keys
    are found by their places in it: nothing is sorted or grouped by key.
    """
    data = spark.read.schema(store.file_schema).option("basePath", f"{store.root}/data").parquet(
        f"{store.root}/data/load={load}")
    # The path is decoded per file and not per row.
    path, at = F.col("_metadata.file_path").alias("url"), F.col("_metadata.row_index").alias("at")
    per_file = data.groupBy(path, F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(store.cluster).alias("n_keys"))
    per_file = _kept(spark, store, per_file, "counted")
    first, last = F.col("n_rows") - F.col("n_keys"), F.col("n_rows") - 1
    # One row per file is broadcast, the list that the manifest will hold.
    ends = data.select(path, at, F.col(store.cluster).alias("key")).where("key IS NOT NULL").join(
        F.broadcast(per_file), "url").where((F.col("at") == first) | (F.col("at") == last))
    ranges = ends.groupBy("url").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    place = [F.regexp_extract(unescaped(F.col("url")), _PLACE, i) for i in range(1, 6)]
    listed = per_file.join(ranges, "url", "left").select(
        place[1].alias("kind"), unescaped(place[2]).alias("date"), unescaped(place[3]).alias("hour"),
        place[0].alias("folder"), place[4].alias("file"), "bytes", "n_rows", "low", "high",
        F.lit(None).cast("string").alias("origin"),
    )
    per_folder = listed.groupBy("folder").agg(F.count(F.lit(1)).alias("written"))
    return listed.join(per_folder, "folder")


def stage(df: DataFrame, store: Store, rules: dict[str, Column] | None = None,
          origins: dict[tuple[str, str], str] | None = None) -> Staged:
    """Write the rows of ``df`` that have a slot; nothing reads them before a commit.

    ``rules`` name conditions that a row must not meet; null counts as not met. Rows that
    break one are written apart, with the names of all broken ones, and how many rows
    broke each is counted by the same pass that writes them. ``origins`` tell what the rows
    of a slot come from; see ``settled_slots``.
    """
    spark = df.sparkSession
    load = uuid.uuid4().hex
    broken = {n: F.coalesce(c, F.lit(False)) for n, c in (rules or {}).items()}
    names = F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in broken.items()]) if broken else F.lit("")
    dated = with_slot(df).withColumn("date", F.col("date").cast("string"))
    rows = dated.withColumn(REASONS, F.nullif(names, F.lit("")))
    counts = Observation()
    rows = rows.observe(
        counts, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(REASONS).isNotNull()).alias("rejected"),
        *[F.count_if(c).alias(f"rule_{n}") for n, c in broken.items()],
    ).withColumn("kind", F.when(F.col(REASONS).isNull(), ROWS).otherwise(REJECTED))
    digest = F.sha2(F.to_json(F.struct(*store.columns), {"ignoreNullFields": "false"}), 256)
    marked = rows.withColumn(LINEAGE, F.when(F.col(REASONS).isNotNull(), digest))
    _write(marked, store, load)
    listed = _clustered(spark, store, _written(spark, store, load))
    if origins:
        told = spark.createDataFrame([(*s, o) for s, o in origins.items()], "date string, hour string, origin string")
        # A row per slot is broadcast, as the manifest has it.
        listed = listed.drop("origin").join(F.broadcast(told), ["date", "hour"], "left")
    if listed.isEmpty():  # a source known to be empty is not even run, so nothing was counted
        return Staged(listed, {"rows": 0, "rejected": 0, **{f"rule_{n}": 0 for n in broken}})
    return Staged(listed, dict(counts.get))


def _write(rows: DataFrame, store: Store, load: str) -> None:
    place = ["kind", "date", "hour"]
    by_slot(rows.select(*store.dataset.body.fieldNames(), REASONS, LINEAGE, *place), store.cluster,
            first=("kind",)).write.partitionBy(*place).parquet(f"{store.root}/data/load={load}")


def _clustered(spark: SparkSession, store: Store, listed: DataFrame) -> DataFrame:
    """The same rows in files of a slot whose keys do not overlap.

    Most slots are one file. A slot of several has each of them span all keys, as its
    rows are split by no key. Those slots alone are written again, dealt out by ranges of
    slot and key that Spark finds from a sample. So a key with very many rows gets no task
    to itself: keys that are frequent are also dealt by a hash of the row, and nothing
    but such a key is in more than one file.
    """
    kept = _kept(spark, store, listed, "staged")
    slot = ["kind", "date", "hour"]
    crowded = kept.groupBy(*slot).agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("all_bytes")).where("n > 1")
    size = crowded.agg(F.sum("n").alias("files")).first().files
    if not size:
        return kept
    again = kept.join(crowded.select(*slot), slot, "left_semi")
    rows = _frame(spark, store, paths_of(again)).drop("load")
    load = uuid.uuid4().hex
    rest = [c for c in rows.columns if c not in slot]
    key = F.concat_ws("\0", *slot, store.cluster)
    # Items of more than half a file's share of all rows, found in one pass over the keys.
    often = rows.select(key.alias("k")).stat.freqItems(["k"], max(1e-4, min(0.5, 0.5 / size)))
    hot = F.array_contains(F.lit(often.first().k_freqItems or [""]), key)
    dealt = rows.withColumn("_deal", F.when(hot, F.xxhash64(*rest)).otherwise(F.lit(0)))
    dealt.repartitionByRange(int(size), *slot, store.cluster, "_deal").sortWithinPartitions(
        *slot, store.cluster).drop("_deal").write.partitionBy(*slot).parquet(
        f"{store.root}/data/load={load}")
    dealt_out = _kept(spark, store, _written(spark, store, load), "dealt")
    # What was written twice is in no version yet, and nobody else knows of it.
    for folder in again.select("folder").distinct().collect():
        discard(spark, f"{store.root}/data/{folder.folder}")
    return kept.join(crowded.select(*slot), slot, "left_anti").unionByName(dealt_out)


def _slots_in(staged: Staged) -> DataFrame:
    return staged.listed.select("date", "hour").distinct()


def replace_all(store: Store, df: DataFrame, rules: dict[str, Column] | None = None,
                facts: dict | None = None,
                origins: dict[tuple[str, str], str] | None = None) -> Version:
    """The next version holds exactly ``df``."""
    staged = stage(df, store, rules, origins)
    return commit(df.sparkSession, store, lambda before, base: staged.listed,
                  {**staged.facts, **(facts or {})})


def replace_slots(store: Store, df: DataFrame, lists: SlotLists | None = None,
                  slots: Slots | None = None, rules: dict[str, Column] | None = None,
                  facts: dict | None = None, origins: dict[tuple[str, str], str] | None = None,
                  spared: Slots | None = None) -> Version:
    """The slots of ``df`` are replaced by its rows; so are the named ones, by nothing if need be.

    ``lists`` are dates and hours and work as their cross product, ``slots`` are pairs.
    Other slots keep their files, and so do those ``spared`` of the lists.
    """
    staged = stage(df, store, rules, origins)

    def change(before: DataFrame, base: Version | None) -> DataFrame:
        kept = before if lists is None else before.where(~in_lists(*lists) | in_slots(spared or []))
        kept = kept if slots is None else kept.where(~in_slots(slots))
        return kept.join(_slots_in(staged), ["date", "hour"], "left_anti").unionByName(staged.listed)

    return commit(df.sparkSession, store, change, {**staged.facts, **(facts or {})})


def delete_slots(spark: SparkSession, store: Store, dates: list[str], hours: list[str]) -> Version:
    """Every listed date with every listed hour goes."""
    return commit(spark, store, lambda before, base: before.where(~in_lists(dates, hours)))


def merge(store: Store, df: DataFrame, keys: list[str], matched: str = "update",
          not_matched: str = "insert", delete_when: Column | None = None,
          null_safe: bool = False) -> Version | None:
    """Merge ``df`` into the newest version, file by file.

    ``matched`` is update, ignore or delete, ``not_matched`` insert or ignore. Source rows
    that meet ``delete_when`` delete the row with their keys, and are never inserted. ``keys``
    hold ``date`` and ``hour``; rows without a slot are left out. A key that the source has
    twice is an error. Null in another key is one too, unless ``null_safe`` lets null match null.

    Files are looked for in three steps: the range of their clustered key, then their keys,
    then whether a row would change at all. Only files with such a row are written
    anew, all others keep their names, and a merge that changes nothing commits nothing
    and returns None. A change of one of its files by another writer is a ``Conflict``.
    """
    if not {"date", "hour"} <= set(keys):
        raise ValueError("keys must include date and hour")
    if matched not in ("update", "ignore", "delete") or not_matched not in ("insert", "ignore"):
        raise ValueError("unknown clause")
    spark = df.sparkSession
    base = version(spark, store)
    gone = F.lit(matched == "delete") if delete_when is None else (
        F.lit(matched == "delete") | F.coalesce(delete_when, F.lit(False)))
    scratch = f"{store.root}/manifests/source-{uuid.uuid4().hex}"
    by_slot(with_slot(df).withColumn("date", F.col("date").cast("string")).withColumn("_gone", gone)
            .select(*store.columns, "_gone")).write.parquet(scratch)
    source = spark.read.parquet(scratch)
    other = [k for k in keys if k not in ("date", "hour")]
    twice = source.groupBy(*keys).count().where("count > 1").first()
    if twice:
        raise ValueError(f"the source has a key twice: {twice.asDict()}")
    if not null_safe and other:
        lost = source.where(" OR ".join(f"{k} IS NULL" for k in other)).first()
        if lost:
            raise ValueError(f"the source has a null key: {lost.asDict()}")
    held = files(spark, store, base).where(F.col("kind") == ROWS)
    # Looked for once; the list of files is small, the source may not be.
    near = _kept(spark, store, _candidates(held, source, store, keys), "near")
    paths = paths_of(near)
    found = _touched(spark, store, near, paths, source, keys, null_safe, matched)
    if found.isEmpty() and (not_matched == "ignore" or _unmatched(
            spark, store, paths, source, keys, null_safe).isEmpty()):
        return None
    # What the touched files keep, and what the source puts in.
    old = _frame(spark, store, paths_of(found)).select(*store.columns)
    s, same = _renamed(source), _same_keys(keys, null_safe)
    kept = old.join(s, same, "left")
    take = F.col("s__gone").isNotNull() & F.lit(matched == "update")
    after = kept.where(~F.coalesce("s__gone", F.lit(False))).select(*[
        F.when(take, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) for c in store.columns])
    if not_matched == "insert":
        new = _unmatched(spark, store, paths, source, keys, null_safe)
        after = after.unionByName(new.select(*store.columns))
    staged = stage(after, store)
    key = ["folder", "file"]

    def change(before: DataFrame, now: Version | None) -> DataFrame:
        if (now.number if now else 0) != (base.number if base else 0):
            lost = found.join(before, key, "left_anti").first()
            slots = _slots_in(staged)
            moved = before.join(held, key, "left_anti").join(slots, ["date", "hour"], "left_semi")
            if lost or not moved.isEmpty():
                raise Conflict("a slot of the merge was changed by another writer")
        return before.join(found.select(*key), key, "left_anti").unionByName(staged.listed)

    return commit(spark, store, change, staged.facts)


def mend(store: Store, df: DataFrame, keys: list[str], rules: dict[str, Column] | None = None) -> int:
    """Take in mended copies of rejected rows; returns how many rejected rows they settle.

    ``df`` has the columns of ``read_rejected``. Rows that still break one of ``rules`` are
    passed over. The others are merged by ``keys``, then the rejected rows with their
    ``lineage`` go. Both steps change nothing when done again, so a row enters once, however
    often it is given and wherever a run was lost.
    """
    spark = df.sparkSession
    broken = F.lit(False)
    for condition in (rules or {}).values():
        broken = broken | F.coalesce(condition, F.lit(False))
    scratch = f"{store.root}/manifests/mended-{uuid.uuid4().hex}"
    df.where(~broken).withColumn("date", F.col("date").cast("string")).select(
        *store.columns, LINEAGE).write.parquet(scratch)
    good = spark.read.parquet(scratch)
    merge(store, good.drop(LINEAGE).distinct(), keys)
    settled = good.select(LINEAGE).where(F.col(LINEAGE).isNotNull()).distinct()
    base = version(spark, store)
    held = files(spark, store, base).where(F.col("kind") == REJECTED)
    rows = _frame(spark, store, paths_of(held)).drop("load")
    met = rows.join(settled, LINEAGE, "left_semi")
    slots = met.select("date", "hour").distinct()
    count = met.count()
    if not count:
        return 0
    # All rejected rows of the slots concerned are written again without the settled ones.
    load = uuid.uuid4().hex
    _write(rows.join(slots, ["date", "hour"], "left_semi").join(settled, LINEAGE, "left_anti"), store, load)
    left = _written(spark, store, load)
    old = held.join(slots, ["date", "hour"], "left_semi").select("folder", "file")

    def change(before: DataFrame, now: Version | None) -> DataFrame:
        if old.join(before, ["folder", "file"], "left_anti").first():
            raise Conflict("rejected rows were changed by another writer")
        return before.join(old, ["folder", "file"], "left_anti").unionByName(left)

    commit(spark, store, change)
    return count


def _renamed(source: DataFrame) -> DataFrame:
    return source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns])


def _same_keys(keys: list[str], null_safe: bool) -> Column:
    same = F.lit(True)
    for k in keys:
        left, right = F.col(k), F.col(f"s_{k}")
        same = same & (left.eqNullSafe(right) if null_safe else left == right)
    return same


def _candidates(held: DataFrame, source: DataFrame, store: Store, keys: list[str]) -> DataFrame:
    """Files whose slot and range of the clustered key meet those of source rows.

    The source's keys are taken in ranges, some hundred in all besides the slots, so a slot
    with very many files meets few of them, however many rows the source has. A range may
    meet files that no row of it is in; the keys tell later.
    """
    if store.cluster not in keys:
        return held.join(source.select("date", "hour").distinct(), ["date", "hour"], "left_semi")
    points = source.select(F.col("date").alias("_d"), F.col("hour").alias("_h"),
                           F.col(store.cluster).alias("_k")).distinct()
    ranges = points.repartitionByRange(_RANGES, "_d", "_h", "_k").withColumn(
        "_part", F.spark_partition_id()).groupBy("_d", "_h", "_part").agg(
        F.min("_k").alias("_from"), F.max("_k").alias("_to"), F.max(F.col("_k").isNull()).alias("_null"))
    meets = (F.col("date") == F.col("_d")) & (F.col("hour") == F.col("_h")) & (
        ((F.col("low") <= F.col("_to")) & (F.col("high") >= F.col("_from")))
        | F.col("_null") | F.col("low").isNull())
    return held.join(ranges, meets, "left_semi")


def _kept(spark: SparkSession, store: Store, listed: DataFrame, label: str) -> DataFrame:
    """A list of files, computed now and once."""
    at = f"{store.root}/manifests/{label}-{uuid.uuid4().hex}"
    listed.write.parquet(at)
    return spark.read.schema(listed.schema).parquet(at)


def _touched(spark: SparkSession, store: Store, near: DataFrame, paths: list[str], source: DataFrame,
             keys: list[str], null_safe: bool, matched: str) -> DataFrame:
    """Files with a row that the merge deletes or changes, among those ``near``."""
    if not paths:
        return near.limit(0)
    rows = _frame(spark, store, paths).select(
        *store.columns, F.col("_metadata.file_path").alias("_url"))
    met = rows.join(_renamed(source), _same_keys(keys, null_safe))
    differs = F.lit(False)
    for c in store.columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"s_{c}"))
    change = F.col("s__gone") | (differs if matched == "update" else F.lit(False))
    # The scan gives a path as a URL; it is decoded per file and not per row.
    path = unescaped(F.col("_url"))
    hit = met.where(change).select("_url").distinct().select(
        F.regexp_extract(path, _PLACE, 1).alias("folder"),
        F.regexp_extract(path, _PLACE, 5).alias("file"))
    return _kept(spark, store, near.join(hit, ["folder", "file"], "left_semi"), "touched")


def _unmatched(spark: SparkSession, store: Store, paths: list[str], source: DataFrame,
               keys: list[str], null_safe: bool) -> DataFrame:
    """Source rows to insert: those no held row of ``paths`` has the keys of, deletions left out."""
    rows = _renamed(_frame(spark, store, paths).select(*keys))
    return source.where(~F.col("_gone")).join(rows, _same_keys(keys, null_safe), "left_anti")


def vacuum(spark: SparkSession, store: Store, keep: int = 2) -> int:
    """Delete what only versions older than the newest ``keep`` use; returns loads deleted.

    A reader of an older version, and a writer that has staged but not committed, must be
    done by then, so this belongs where no load is under way.
    """
    known = versions(spark, store)
    held = known[-keep:]
    if not held:
        return 0
    manifests = [version(spark, store, n).manifest for n in held]
    used = _no_files(spark)
    for name in manifests:
        used = used.union(spark.read.schema(_FILE).parquet(f"{store.root}/manifests/{name}"))
    loads = {r.load for r in used.select(
        F.regexp_extract("folder", "^load=([^/]+)", 1).alias("load")).distinct().collect()}
    stale = [n for n in list_names(spark, f"{store.root}/data")
             if n.startswith("load=") and n[5:] not in loads]
    for number in known[:-keep]:
        discard(spark, f"{store.root}/versions/{number:08d}.json")
    for name in stale:
        discard(spark, f"{store.root}/data/{name}")
    for name in list_names(spark, f"{store.root}/manifests"):
        if name not in manifests:
            discard(spark, f"{store.root}/manifests/{name}")
    return len(stale)
