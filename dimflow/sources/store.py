"""The warehouse on a shared file system: layers of Parquet tables with atomic replacement.

Every write goes to directories of its own and takes effect by one commit, a row in a directory with the
commit's number. That row names the live directories, the schema and the high-water mark, so data and mark
change together, a crash leaves the previous state, and readers are never disturbed. Below ``<layer>/<table>``:

- ``gen=<n>`` the table, or the buckets of it that commit n wrote; of a table with many small split buckets a directory
  holds some of them together, in order, and a change of one rewrites those;
- ``kept=<n>`` rows that commit n added for good: no later commit reads or rewrites them;
- ``delta=<n>`` the rows commit n put in, replaced by or took out, for tables derived from this one;
- ``commits/c=<n>`` the commit itself. Commits are numbered without gaps, so the newest is found by doubling steps.

One job writes a table at a time.
"""

from __future__ import annotations

import json
from collections.abc import Collection
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import reduce
from math import ceil, log2

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.keys import hash_bucket
from dimflow.operators.upsert import any_later, keyed, latest_per_key, older_than, repeats, same_columns
from dimflow.registry import TableSpec
from dimflow.session import materialise

RAW, ANALYTICS, AUDIT = "raw", "analytics", "audit"

COMMITS = (
    "generation bigint, table_schema string, live map<int,bigint>, mark timestamp_ntz, committed_at timestamp_ntz, "
    "bucketing string, kept array<bigint>, deltas array<bigint>, last_key bigint, streams map<string,bigint>, "
    "inputs map<string,bigint>"
)
NOWHERE = -1  # the generation of a bucket without rows
AUDIT_TABLES = {
    "pipeline_runs": "run_id string, step string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "status string, error_message string",
    "dimension_waves": "run_id string, table_name string, n_new_versions bigint, n_expired bigint",
    "validation_results": "run_id string, table_name string, check_type string, source_value string, "
    "target_value string, passed boolean, checked_at timestamp_ntz",
}


@dataclass(frozen=True)
class Commit:
    """The state of a table: its generation, the generation each bucket lives in, schema and mark.

    A table replaced whole has no buckets; all of it lives in the latest generation. ``bucketing`` is the
    rule that rows were placed by, which may differ from the one a spec asks for by now. ``kept`` and ``deltas`` are the
    commits with such directories, ``last_key`` the greatest surrogate key given out, ``streams`` the last batch
    of each stream, ``inputs`` the generations of the tables this one was derived from.
    """

    generation: int
    live: dict[int, int]
    schema: T.StructType
    mark: datetime | None = None
    bucketing: str | None = None
    kept: list[int] = field(default_factory=list)
    deltas: list[int] = field(default_factory=list)
    last_key: int | None = None
    streams: dict[str, int] = field(default_factory=dict)
    inputs: dict[str, int] = field(default_factory=dict)


class Store:
    """Tables under one root that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # --- reading ---

    def commit(self, layer: str, table: str, number: int | None = None) -> Commit | None:
        """The last commit of a table, None before the first; or the one with that number."""
        newest = self._newest(layer, table) if number is None else number
        if newest < 0:
            return None
        row = self.spark.read.schema(COMMITS).parquet(self._log(layer, table, newest)).first()
        return Commit(
            row.generation, row.live, T.StructType.fromDDL(row.table_schema), row.mark, row.bucketing, row.kept or [],
            row.deltas or [], row.last_key, row.streams or {}, row.inputs or {},
        )

    def _newest(self, layer: str, table: str) -> int:
        """The number of the newest commit, -1 before the first; asks for some twice as many files as its number has bits."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path
        files = path(self.root).getFileSystem(context._jsc.hadoopConfiguration())

        def there(number: int) -> bool:
            return files.exists(path(f"{self._log(layer, table, number)}/_SUCCESS"))

        low, step = -1, 1
        while there(low + step):
            low, step = low + step, 2 * step
        while step > 1:  # low is there, low + step is not
            step //= 2
            low = low + step if there(low + step) else low
        return low

    def exists(self, layer: str, table: str) -> bool:
        return self.commit(layer, table) is not None

    def find(self, layer: str, table: str) -> DataFrame | None:
        """The table as last committed, None before that."""
        commit = self.commit(layer, table)
        return None if commit is None else self._at(layer, table, commit)

    def read(self, layer: str, table: str) -> DataFrame:
        """The table as last committed; an error before that."""
        return self._at(layer, table, self._committed(layer, table))

    def current(self, layer: str, table: str) -> DataFrame:
        """The table without the rows that are kept for good."""
        return self._at(layer, table, replace(self._committed(layer, table), kept=[]))

    def deltas(self, layer: str, table: str, after: int) -> DataFrame | None:
        """The rows that the commits after one put in, replaced by or took out; None if some commit kept no such record."""
        commit = self._committed(layer, table)
        wanted = range(after + 1, commit.generation + 1)
        if not set(wanted) <= set(commit.deltas) or not wanted:
            return None
        return self.spark.read.parquet(*[self._delta(layer, table, n) for n in wanted])

    def _committed(self, layer: str, table: str) -> Commit:
        commit = self.commit(layer, table)
        if commit is None:
            raise LookupError(f"{layer}.{table} has not been written yet")
        return commit

    def marks(self, layer: str, tables: list[str]) -> DataFrame:
        """The high-water marks of the tables loaded so far."""
        commits = [(t, self.commit(layer, t)) for t in tables]
        rows = [(t, c.mark) for t, c in commits if c is not None and c.mark is not None]
        return self.spark.createDataFrame(rows, "table_name string, last_watermark timestamp_ntz")

    def superseded(self, layer: str, table: str, consumed: int | None = None) -> list[str]:
        """Directories no reader needs any more, for the storage's retention job to remove.

        Those of buckets that no commit refers to, and the deltas up to the commit ``consumed``, which every table derived
        from this one has been brought up to.
        """
        newest = self.commit(layer, table)
        if newest is None:
            return []
        logs = [self._log(layer, table, n) for n in range(newest.generation + 1)]
        places = self.spark.read.schema(COMMITS).parquet(*logs).select(F.explode_outer("live").alias("bucket", "at"), "generation", "bucketing")
        places = places.select("bucket", F.coalesce("at", "generation").alias("at"), "bucketing").where(F.col("at") != NOWHERE)
        used = {self._directory(layer, table, r["at"], None if r.bucket is None else _folder(r.bucket, _share(r.bucketing))) for r in places.distinct().collect()}
        done = [self._delta(layer, table, n) for n in newest.deltas if consumed is not None and n <= consumed]
        return sorted(used - set(self._directories(layer, table, newest))) + done

    # --- writing ---

    def replace(self, layer: str, table: str, df: DataFrame, delta: DataFrame | None = None) -> DataFrame:
        """Replace a table whole, and return it as written. ``delta`` is what it changes, where that is known."""
        commit = self.commit(layer, table)
        generation = commit.generation + 1 if commit else 0
        df.write.mode("overwrite").parquet(self._generation(layer, table, generation))
        deltas = commit.deltas if commit else []
        if delta is not None:
            delta.write.mode("overwrite").parquet(self._delta(layer, table, generation))
            deltas = [*deltas, generation]
        return self._commit(layer, table, Commit(generation, {}, df.schema, deltas=deltas))

    def create(self, layer: str, spec: TableSpec, schema: T.StructType) -> DataFrame:
        """An empty table to upsert into."""
        return self._commit(layer, spec.name, Commit(0, _first_buckets(spec), schema, bucketing=_rule(spec)))

    def upsert(
        self, layer: str, spec: TableSpec, batch: DataFrame, gone: DataFrame | None = None,
        stream: tuple[str, int] | None = None, inputs: dict[str, int] | None = None, keep_newer: bool = True,
    ) -> int:
        """Replace the rows that share a key with the batch by the batch's, and advance the mark.

        The batch is written first: data, keys and mark then come from the same rows, and they stay as the commit's delta.
        Its keys are then counted, and only if one is there twice are the rows moved to keep the latest of each.
        The first batch of a table is written where it stays; later, only the buckets a batch touches are
        read and rewritten. Where the spec's bucketing is not the one the table was written by, the whole
        table is rewritten once by the new rule. With a stamp column, a stored row stays if it is newer than the batch's,
        unless ``keep_newer`` is off.

        ``gone`` has rows, of the table's columns, to take out by key. ``stream`` names a stream and its batch: one that
        is already in the table, or is older than one that is, changes nothing. ``inputs`` goes into the commit, with
        which the table is committed even if nothing changed. Returns the number of rows.
        """
        commit = self.commit(layer, spec.name)
        if commit:
            same_columns(commit.schema, batch.schema)
            if commit.bucketing is None:
                raise ValueError(f"{layer}.{spec.name} is replaced whole, it has no buckets to upsert into")
            if stream and commit.streams.get(stream[0], -1) >= stream[1]:
                return 0
        keys = list(spec.keys)
        stamp = spec.updated_at if spec.updated_at in batch.columns else None
        given = keyed(batch, keys)
        if gone is not None:
            out = gone.select(*batch.columns).join(given.select(*keys), keys, "left_anti").select(*batch.columns).dropDuplicates(keys)
            given = given.withColumn("_gone", F.lit(False)).unionByName(out.withColumn("_gone", F.lit(True)))
        generation = commit.generation + 1 if commit else 0
        old = commit or Commit(generation, _first_buckets(spec), batch.schema, bucketing=_rule(spec))
        moved = old.bucketing != _rule(spec)
        places = _first_buckets(spec) if moved else old.live
        share = _share(_rule(spec))
        stays = commit is None and gone is None and spec.split_rows is None

        def stage(rows: DataFrame) -> DataFrame:
            if stays:
                return self._write_buckets(layer, spec.name, generation, rows.withColumn("_b", _bucket(spec, old.live)), share)
            path = self._delta(layer, spec.name, generation)
            rows.write.mode("overwrite").parquet(path)
            return self.spark.read.schema(rows.schema).parquet(path)

        staged = stage(given)
        if spec.unique:
            _reject_repeats(staged, keys, spec.name)
        elif repeats(staged, keys):
            # Of the rows written, as the batch might be other rows when it is read again.
            staged = stage(materialise(latest_per_key(staged.select(*given.columns), keys, stamp), "latest"))
        if not stays:
            if commit is None:
                places = _first_buckets(spec, staged.count())
                old = replace(old, live=places)
            staged = staged.withColumn("_b", _bucket(spec, places))
        # One row, with at most as many bucket numbers as the table has buckets.
        facts = staged.agg(
            F.count(F.lit(1)).alias("n"),
            F.collect_set("_b").alias("touched"),
            (F.max(stamp) if stamp else F.lit(None)).cast("timestamp_ntz").alias("mark"),
        ).first()
        known = {**(commit.streams if commit else {}), **dict([stream] if stream else [])}
        reached = max((m for m in (old.mark, facts.mark) if m is not None), default=None)
        state = replace(
            old, generation=generation, mark=reached, bucketing=_rule(spec), schema=batch.schema, streams=known,
            inputs=inputs or {}, deltas=[*old.deltas, generation] if commit else [],
        )
        if facts.n == 0:
            if commit and (stream or inputs is not None):
                self._commit(layer, spec.name, state)
            return 0
        if stays:
            self._commit(layer, spec.name, replace(state, live=dict.fromkeys(facts.touched, generation)))
            return facts.n
        touched = old.live if moved else _together(old.live, facts.touched, share)
        stay = {} if moved else {b: g for b, g in old.live.items() if b not in touched}
        rows = staged if gone is None else staged.where(~F.col("_gone")).drop("_gone")
        if any(g != NOWHERE for g in touched.values()):
            base = self._at(layer, spec.name, Commit(old.generation, touched, old.schema, bucketing=old.bucketing))
            base = base.withColumn("_b", _bucket(spec, places))
            if stamp and keep_newer and any_later(rows, base, stamp):
                # Written, as both the rows put in and those taken out need it.
                newer = materialise(older_than(rows, base, keys, stamp), "newer")
                rows = rows.join(newer, keys, "left_anti").select(*base.columns)
            replaced = rows if gone is None else rows.select(*keys).unionByName(staged.where("_gone").select(*keys))
            rows = base.join(replaced.select(*keys), keys, "left_anti").select(*base.columns).unionByName(rows)
        rows = rows.select(*batch.columns, "_b")
        if spec.split_rows is not None:
            rows, sizes = self._split(spec, rows, dict.fromkeys(places if moved else touched, 0))
        written = self._write_buckets(layer, spec.name, generation, rows, share)
        if spec.split_rows is None:
            # A bucket a batch touches holds its row, or a newer one.
            sizes = dict.fromkeys(places if moved else touched, 0) | _sizes(written) if moved or gone is not None else dict.fromkeys(facts.touched, 1)
        live = stay | {b: generation if n else NOWHERE for b, n in sizes.items()}
        self._commit(layer, spec.name, replace(state, live=live))
        return facts.n

    def _split(self, spec: TableSpec, rows: DataFrame, empty: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
        """Rows with the buckets they go to, and how many each gets: one above the target size is cut by more bits of its hash.

        Rows are counted before they are written to the table, and of later rounds only those of buckets that were cut.
        """
        rows = materialise(rows, "split")
        sizes = empty | _sizes(rows)
        counted, cut = sizes, rows
        while large := {b: n for b, n in counted.items() if n > spec.split_rows and b.bit_length() <= _HASH_BITS}:
            finer = {c: 0 for b, n in large.items() for c in _finer(b, ceil(log2(n / spec.split_rows)))}
            sizes = {b: n for b, n in sizes.items() if b not in large} | finer
            cut = cut.where(_among(F.col("_b"), large)).withColumn("_b", _bucket(spec, sizes))
            counted = finer | _sizes(cut)
            sizes |= counted
        return rows.withColumn("_b", _bucket(spec, sizes)) if sizes.keys() != empty.keys() else rows, sizes

    def add(
        self, layer: str, spec: TableSpec, rows: DataFrame, last_key: int | None = None, taken: DataFrame | None = None,
        kept: DataFrame | None = None, delta: DataFrame | None = None, inputs: dict[str, int] | None = None, whole: bool = False,
    ) -> None:
        """Take the rows with the keys of ``taken`` out, put ``rows`` in, and keep other rows for good, in one commit.

        Only the buckets of ``taken`` and ``rows`` are rewritten; with ``whole`` the table is made anew of ``rows``.
        """
        commit, keys = self.commit(layer, spec.name), list(spec.keys)
        generation = commit.generation + 1 if commit else 0
        old = None if whole else commit
        old = old or Commit(generation, _first_buckets(spec), rows.schema, bucketing=_rule(spec))
        if old.bucketing != _rule(spec):
            raise ValueError(f"{layer}.{spec.name} was written by another bucketing: {old.bucketing}")
        place, rows = _bucket(spec, old.live), rows.withColumn("_b", _bucket(spec, old.live))
        touches = [rows.select("_b")] + ([taken.select(place.alias("_b"))] if taken is not None else [])
        share = _share(old.bucketing)
        touched = {r["_b"] for r in reduce(DataFrame.unionAll, touches).distinct().collect()}
        if standing := _together(old.live, touched, share):
            touched |= standing.keys()
            base = self._at(layer, spec.name, Commit(old.generation, standing, old.schema, bucketing=old.bucketing)).withColumn("_b", place)
            if taken is not None:
                base = base.join(taken.select(*keys), keys, "left_anti").select(*rows.columns)
            rows = base.unionByName(rows)
        state = replace(old, generation=generation, last_key=old.last_key if last_key is None else last_key, inputs=inputs or {})
        full = set()
        if touched:
            rows = materialise(rows, "shared") if share else rows
            written = self._write_buckets(layer, spec.name, generation, rows, share)
            full = {r["_b"] for r in (rows if share else written).select("_b").distinct().collect()}
        live = {b: g for b, g in old.live.items() if b not in touched} | dict.fromkeys(full, generation)
        for name, part in (("kept", kept), ("deltas", delta)):
            if part is not None:
                part.write.mode("overwrite").parquet((self._kept if name == "kept" else self._delta)(layer, spec.name, generation))
                state = replace(state, **{name: [*getattr(state, name), generation]})
        self._commit(layer, spec.name, replace(state, live=live))

    def append(self, table: str, rows: DataFrame) -> None:
        """Append to an audit table."""
        schema = T.StructType.fromDDL(AUDIT_TABLES[table])
        rows.to(schema).write.mode("append").parquet(f"{self.root}/{AUDIT}/{table}")

    def audit(self, table: str) -> DataFrame:
        """An audit table, empty before the first entry."""
        rows = _existing(self.spark, f"{self.root}/{AUDIT}/{table}", AUDIT_TABLES[table])
        return rows if rows is not None else self.spark.createDataFrame([], AUDIT_TABLES[table])

    def keep(self, layer: str, spec: TableSpec, rows: DataFrame, last_key: int) -> None:
        """Add rows for good to a table that is only added to."""
        commit = self.commit(layer, spec.name)
        generation = commit.generation + 1 if commit else 0
        old = commit or Commit(generation, {}, rows.schema, bucketing=_rule(spec))
        rows.write.mode("overwrite").parquet(self._kept(layer, spec.name, generation))
        self._commit(layer, spec.name, replace(old, generation=generation, kept=[*old.kept, generation], last_key=last_key))

    def touched(self, layer: str, spec: TableSpec, keys: DataFrame) -> DataFrame:
        """The buckets, without what is kept for good, that some keys are placed in."""
        commit = self._committed(layer, spec.name)
        places = {r["_b"] for r in keys.select(_bucket(spec, commit.live).alias("_b")).distinct().collect()}
        return self._at(layer, spec.name, replace(commit, live={b: g for b, g in commit.live.items() if b in places}, kept=[]))

    def places(self, layer: str, table: str) -> list[str]:
        """The live directories of a table, below its own."""
        base = f"{self.root}/{layer}/{table}/"
        return [path.removeprefix(base) for path in self._directories(layer, table, self._committed(layer, table))]

    def read_places(self, layer: str, table: str, places: list[str]) -> DataFrame:
        """Some of a table's directories. Spark's hidden ``_metadata`` tells which one a row is from."""
        schema = self._committed(layer, table).schema
        paths = [f"{self.root}/{layer}/{table}/{place}" for place in places]
        empty = self.spark.createDataFrame([], schema).withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
        return self.spark.read.schema(schema).parquet(*paths) if paths else empty

    # --- paths ---

    def _log(self, layer: str, table: str, number: int) -> str:
        return f"{self.root}/{layer}/{table}/commits/c={number}"

    def _generation(self, layer: str, table: str, generation: int) -> str:
        return f"{self.root}/{layer}/{table}/gen={generation}"

    def _kept(self, layer: str, table: str, generation: int) -> str:
        return f"{self.root}/{layer}/{table}/kept={generation}"

    def _delta(self, layer: str, table: str, generation: int) -> str:
        return f"{self.root}/{layer}/{table}/delta={generation}"

    def _directory(self, layer: str, table: str, generation: int, bucket: int | None) -> str:
        path = self._generation(layer, table, generation)
        return path if bucket is None else f"{path}/_b={bucket}"

    def _directories(self, layer: str, table: str, commit: Commit) -> list[str]:
        share = _share(commit.bucketing)
        places = sorted({(_folder(bucket, share), at) for bucket, at in commit.live.items()})
        if commit.bucketing is None and not places:
            places = [(None, commit.generation)]
        kept = [self._kept(layer, table, generation) for generation in commit.kept]
        return [self._directory(layer, table, at, bucket) for bucket, at in places if at != NOWHERE] + kept

    def _at(self, layer: str, table: str, commit: Commit) -> DataFrame:
        paths = self._directories(layer, table, commit)
        return self.spark.read.schema(commit.schema).parquet(*paths) if paths else self.spark.createDataFrame([], commit.schema)

    def _write_buckets(self, layer: str, table: str, generation: int, rows: DataFrame, share: int = 0) -> DataFrame:
        """Write rows by bucket. Rebalancing makes files of even size and splits a bucket too large for a task."""
        path = self._generation(layer, table, generation)
        if share:
            rows = rows.withColumnsRenamed({"_b": "_leaf"}).withColumn("_b", _folder_of("_leaf", share))
            rows = rows.hint("rebalance", F.col("_b")).sortWithinPartitions("_b", "_leaf").drop("_leaf")
        else:
            rows = rows.hint("rebalance", F.col("_b"))
        rows.write.mode("overwrite").partitionBy("_b").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _commit(self, layer: str, table: str, commit: Commit) -> DataFrame:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        row = (
            commit.generation, _ddl(commit.schema), commit.live, commit.mark, now, commit.bucketing, commit.kept, commit.deltas,
            commit.last_key, commit.streams, commit.inputs,
        )
        # What an attempt that died left there is overwritten: it is not a commit without its _SUCCESS.
        log = self._log(layer, table, commit.generation)
        self.spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("overwrite").parquet(log)
        return self._at(layer, table, commit)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _rule(spec: TableSpec) -> str:
    """The bucketing as text: two specs with the same rule place every row in the same bucket."""
    if spec.split_rows is not None:
        rule = {"keys": spec.keys, "split": True}
        if spec.split_rows < _FOLDER_ROWS:
            rule["share"] = (_FOLDER_ROWS // spec.split_rows).bit_length() - 1
    elif spec.id_range is None:
        rule = {"keys": spec.keys, "buckets": spec.buckets}
    else:
        rule = {"range_key": spec.range_key, "id_range": spec.id_range}
    return json.dumps(rule, sort_keys=True)


#: Bits of the hash that buckets may be split by. A split bucket's number is a 1 before the low bits its rows share.
_HASH_BITS = 30
#: Rows that the buckets of one directory may hold together, and the bits up to which each has a directory of its own.
_FOLDER_ROWS, _OWN_BITS = 1 << 16, 6
#: So many buckets are named one by one in an expression; more are looked up in a map of bytes.
_NAMED = 200


def _share(rule: str | None) -> int:
    """How many bits of the hash the buckets of one directory may differ in."""
    return json.loads(rule).get("share", 0) if rule else 0


def _folder(bucket: int, share: int) -> int:
    """The number of the directory a bucket is in: its own, or that of the bits it has in common with its neighbours."""
    depth = bucket.bit_length() - 1
    if not share or depth <= _OWN_BITS:
        return bucket
    common = max(_OWN_BITS, depth - share)
    return 1 << common | bucket & (1 << common) - 1


def _folder_of(bucket: str, share: int) -> Column:
    """As :func:`_folder`, of a column."""
    depth = f"(length(bin({bucket})) - 1)"
    common = f"greatest({_OWN_BITS}, {depth} - {share})"
    return F.expr(f"if({depth} <= {_OWN_BITS}, {bucket}, shiftleft(1, {common}) | ({bucket} & (shiftleft(1, {common}) - 1)))")


def _together(live: dict[int, int], buckets: Collection[int], share: int) -> dict[int, int]:
    """The live buckets among some, with those that are in one directory with them."""
    buckets = set(buckets)
    if not share:
        return {b: g for b, g in live.items() if b in buckets}
    hit = {(_folder(b, share), live[b]) for b in buckets if live.get(b, NOWHERE) != NOWHERE}
    return {b: g for b, g in live.items() if b in buckets or (_folder(b, share), g) in hit}


def _sizes(rows: DataFrame) -> dict[int, int]:
    """The number of rows of each bucket."""
    found = rows.groupBy("_b").count().toArrow()
    return dict(zip(found["_b"].to_pylist(), found["count"].to_pylist()))


def _by_depth(buckets: Collection[int]) -> dict[int, list[int]]:
    depths: dict[int, list[int]] = {}
    for bucket in buckets:
        depths.setdefault(bucket.bit_length() - 1, []).append(bucket)
    return dict(sorted(depths.items()))


def _among(place: Column, buckets: Collection[int]) -> Column:
    """Whether a bucket's number is one of some. Many of one depth are a byte each, at the place of their bits."""
    found = F.lit(False)
    for depth, some in _by_depth(buckets).items():
        first, size = 1 << depth, 1 << depth
        if len(some) <= _NAMED or size > 64 * len(some):
            found |= place.isin(some)
            continue
        there = bytearray(size)
        for bucket in some:
            there[bucket - first] = 1
        byte = F.substring(F.lit(bytes(there)), place - first + 1, F.lit(1))
        found |= place.between(first, first + size - 1) & (byte == F.lit(b"\x01"))
    return found


def _first_buckets(spec: TableSpec, n_rows: int = 0) -> dict[int, int]:
    """The buckets a table that can be split starts with, empty; others get theirs from their rows."""
    if spec.split_rows is None:
        return {}
    return dict.fromkeys(_finer(1, ceil(log2(max(1, n_rows / spec.split_rows)))), NOWHERE)


def _finer(bucket: int, bits: int) -> list[int]:
    """The buckets that one is split into by some more bits of the hash."""
    depth = bucket.bit_length() - 1
    low = bucket - (1 << depth)
    bits = min(bits, _HASH_BITS - depth)
    return [1 << depth + bits | more << depth | low for more in range(1 << bits)]


def _bucket(spec: TableSpec, live: dict[int, int]) -> Column:
    """The bucket of a row. In a table with split buckets it is the one of ``live`` whose bits the row's hash ends in."""
    if spec.split_rows is not None:
        hashed = F.xxhash64(*[F.col(k) for k in spec.keys])
        depths = _by_depth(live)
        at = [(hashed.bitwiseAND(F.lit((1 << d) - 1)) + (1 << d)).cast("int") for d in depths]
        # Every hash ends in the bits of one bucket, so what is in none of the others is in one of the deepest.
        return F.coalesce(*[F.when(_among(p, some), p) for p, some in zip(at[:-1], depths.values())], at[-1])
    if spec.id_range is None:
        return hash_bucket(list(spec.keys), spec.buckets)
    key = spec.range_key
    return F.expr(f"cast((`{key}` - pmod(`{key}`, {spec.id_range})) div {spec.id_range} as int)")


def _reject_repeats(rows: DataFrame, keys: list[str], table: str) -> None:
    """Raise if a key is there twice; keys alone are shuffled."""
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").first()
    if twice:
        raise ValueError(f"{table} is declared unique but holds {tuple(twice)[:-1]} {twice['_n']} times")


def _existing(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
