"""Versioned Parquet tables under ``root/<schema>/<table>``.

A table is never overwritten while it may be read: each write goes to a new
version folder ``vNNNNNN`` and becomes visible once Spark's committer has
written ``_SUCCESS`` there; readers take the newest committed version. Each
version carries a small ``_meta.json`` (row count, watermark, schema) that the
write itself measures with an ``Observation``, so checking a table's size
(for example before a broadcast) costs no scan.

Tables that grow with every load (raw rows, fact, bridges) are not rewritten
as a whole: they are *live* tables, plain Spark tables partitioned by ranges of
the report number and bucketed on it. A MERGE reads and replaces only the
partitions its increment falls into (Spark's dynamic partition overwrite, an
option stored with the table: the session's setting is neither read nor
changed, so loads in parallel threads and in any session behave alike).
Their common bucketing lets fact x bridge joins read co-partitioned inputs. A
live table counts as existing once its metadata is written; a load that was
interrupted before is simply run again, since merging the same rows twice
changes nothing. It is registered in the session catalog as an external table
(re-registered from the metadata by any later session).

A change of a live table's columns writes no old file. New columns are added to
the catalog entry (``ALTER TABLE ... ADD COLUMNS``) and read as nulls from older
files; for a dropped or widened column a second entry with the new columns is
made over the same files before the metadata names it, so there is no moment
without the table.

File-system calls go through Hadoop's ``FileSystem`` so ``root`` may be any
shared store the cluster can write (HDFS, object stores, a shared mount).
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

META_FILE = "_meta.json"
#: Partition column of live tables: report number div the partition width.
PART = "dr_part"
#: Rows that a live table's file and partition aim at (see ``fit_layout``), and
#: the fewest partitions that are not thought too many.
FILE_ROWS, PART_ROWS, FEW_PARTS = 50_000, 10_000_000, 4
#: How many writes a live table remembers the partitions of.
WRITES = 64
#: Stored with every live table, so an overwrite replaces the partitions it
#: writes whatever the session's own setting is.
OVERWRITE_OPTION = {"partitionOverwriteMode": "dynamic"}


class TableStore:
    def __init__(self, spark: SparkSession, root: str, keep_versions: int = 2,
                 buckets: int | None = None, part_width: int | None = None, hash_parts: int = 16):
        """``hash_parts`` is the number of key ranges of a snapshot table, sized
        so that a range's open versions fill a few files. ``buckets`` and ``part_width`` (report numbers per partition) size
        the live tables; a table keeps the values of its first write, so a
        store opened later with others still reads and writes one layout. Where
        they are not given, ``fit_layout`` takes them from the first load."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_versions = keep_versions
        self.fixed_buckets, self.fixed_width = buckets, part_width
        self.part_width = part_width or 50_000_000
        self.hash_parts = hash_parts
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.database = "blotter_" + hashlib.md5(self.root.encode()).hexdigest()[:12]
        self._db_ready = False

    # -- catalog (bucketed tables only) ----------------------------------
    def _ensure_database(self) -> None:
        if not self._db_ready:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} "
                           f"LOCATION '{self.root}/_catalog'")
            self._db_ready = True

    def _catalog_name(self, schema: str, name: str, entry: int | None = None) -> str:
        """The catalog entry that the metadata names (or number ``entry``)."""
        if entry is None:
            entry = int((self.meta(schema, name) or {}).get("entry") or 0)
        return f"{self.database}.{schema}__{name}" + (f"__{entry}" if entry else "")

    def _register(self, qualified: str, path: str, meta: dict) -> None:
        if self.spark.catalog.tableExists(qualified):
            return
        self._ensure_database()
        schema = T.StructType.fromJson(json.loads(meta["schema"]))
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{k}`" for k in meta["bucket_by"])
        clustered = f"CLUSTERED BY ({keys}) INTO {meta['buckets']} BUCKETS " if keys else ""
        options = ", ".join(f"{k} '{v}'" for k, v in OVERWRITE_OPTION.items())
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified} ({cols}, `{PART}` bigint) USING parquet "
                       f"OPTIONS ({options}) PARTITIONED BY (`{PART}`) {clustered}"
                       f"LOCATION '{path}'")
        self.spark.catalog.recoverPartitions(qualified)

    # -- paths -----------------------------------------------------------
    def path(self, schema: str, name: str) -> str:
        return f"{self.root}/{schema}/{name}"

    def _p(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._p(path).getFileSystem(self._conf)

    def _version_dirs(self, schema: str, name: str, committed: bool) -> list[int]:
        base = self.path(schema, name)
        fs = self._fs(base)
        if not fs.exists(self._p(base)):
            return []
        out = []
        for st in fs.listStatus(self._p(base)):
            n = st.getPath().getName()
            if st.isDirectory() and n.startswith("v") and n[1:].isdigit():
                if not committed or (fs.exists(self._p(f"{base}/{n}/_SUCCESS"))
                                     and fs.exists(self._p(f"{base}/{n}/{META_FILE}"))):
                    out.append(int(n[1:]))
        return sorted(out)

    def versions(self, schema: str, name: str) -> list[int]:
        """Committed versions: Spark's ``_SUCCESS`` and our metadata both
        present. A version left half-written by a lost driver stays invisible."""
        return self._version_dirs(schema, name, committed=True)

    def _version_path(self, schema: str, name: str, v: int) -> str:
        return f"{self.path(schema, name)}/v{v:06d}"

    def exists(self, schema: str, name: str) -> bool:
        return self.meta(schema, name) is not None

    # -- metadata --------------------------------------------------------
    def _live_path(self, schema: str, name: str) -> str:
        return f"{self.path(schema, name)}/live"

    def meta(self, schema: str, name: str) -> dict | None:
        p = f"{self._live_path(schema, name)}/{META_FILE}"
        if not self._fs(p).exists(self._p(p)):
            vs = self.versions(schema, name)
            if not vs:
                return None
            p = f"{self._version_path(schema, name, vs[-1])}/{META_FILE}"
        stream = self._fs(p).open(self._p(p))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def version_schema(self, schema: str, name: str, v: int) -> T.StructType | None:
        """Schema stored with one committed version (no data read)."""
        p = f"{self._version_path(schema, name, v)}/{META_FILE}"
        fs = self._fs(p)
        if not fs.exists(self._p(p)):
            return None
        stream = fs.open(self._p(p))
        try:
            meta = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return T.StructType.fromJson(json.loads(meta["schema"]))

    def rows(self, schema: str, name: str) -> int | None:
        m = self.meta(schema, name)
        return None if m is None else m.get("rows")

    def watermark(self, schema: str, name: str):
        m = self.meta(schema, name)
        return None if m is None else m.get("watermark")

    def _write_meta(self, path: str, meta: dict) -> None:
        fs = self._fs(path)
        out = fs.create(self._p(f"{path}/{META_FILE}"), True)
        try:
            out.write(bytearray(json.dumps(meta, default=str).encode("utf-8")))
        finally:
            out.close()

    # -- read / write ----------------------------------------------------
    def read(self, schema: str, name: str) -> DataFrame | None:
        m = self.meta(schema, name)
        if m and "bucket_by" in m:
            return self.read_live(schema, name).drop(PART)
        vs = self.versions(schema, name)
        if not vs:
            return None
        path = self._version_path(schema, name, vs[-1])
        reader = self.spark.read
        if m and m.get("schema"):
            reader = reader.schema(T.StructType.fromJson(json.loads(m["schema"])))
        return reader.parquet(path)

    def write(self, df: DataFrame, schema: str, name: str,
              watermark_col: str | None = None, watermark=None,
              sort_within: list[str] | None = None, metrics: dict | None = None) -> DataFrame:
        """Write ``df`` as the next version and return a frame reading it back.

        Row count, ``max(watermark_col)`` and ``metrics`` are observed in the writing
        stage itself, where a task's numbers count once however often it runs.
        ``watermark`` overrides the observed one (pass the previous watermark
        when an increment was empty). ``sort_within`` sorts inside each task's
        output (tighter Parquet min/max statistics, no shuffle).
        """
        every = self._version_dirs(schema, name, committed=False)
        nxt = (every[-1] + 1) if every else 1   # never reuse a half-written folder
        path = self._version_path(schema, name, nxt)
        exprs = [F.count(F.lit(1)).alias("rows")]
        if watermark_col:
            exprs.append(F.max(watermark_col).alias("wm"))
        exprs += [c.alias(f"m__{k}") for k, c in (metrics or {}).items()]
        obs = Observation(f"w_{schema}_{name}_{nxt}_{uuid.uuid4().hex[:8]}")
        out = df.sortWithinPartitions(*sort_within) if sort_within else df
        out.observe(obs, *exprs).write.mode("errorifexists").parquet(path)
        measured = obs.get
        wm = watermark if watermark is not None else measured.get("wm")
        if watermark_col and measured.get("wm") is not None and watermark is not None:
            wm = max(str(watermark), str(measured["wm"]))
        self._write_meta(path, {"rows": int(measured["rows"]), "watermark": wm,
                                "metrics": {k: measured.get(f"m__{k}") for k in (metrics or {})},
                                "schema": df.schema.json(), "version": nxt})
        self._expire(schema, name)
        return self.read(schema, name)

    # -- live tables -------------------------------------------------------
    def read_live(self, schema: str, name: str) -> DataFrame | None:
        """The live table with its partition column."""
        m = self.meta(schema, name)
        if m is None:
            return None
        qualified = self._catalog_name(schema, name)
        self._register(qualified, self._live_path(schema, name), m)
        # The columns that the metadata names: an entry may already have more.
        names = T.StructType.fromJson(json.loads(m["schema"])).names
        return self.spark.table(qualified).select(*names, PART)

    def live_buckets(self, schema: str, name: str) -> int:
        return int((self.meta(schema, name) or {}).get("buckets") or self.buckets)

    def layout(self, schema: str, name: str) -> tuple[int, int] | None:
        """Buckets and report numbers per partition of a live table; tables that
        are read by the same partitions are made with the same."""
        m = self.meta(schema, name) or {}
        return (int(m["buckets"]), int(m["part_width"])) if "bucket_by" in m else None

    def fit_layout(self, df: DataFrame, key: str) -> tuple[int, int]:
        """Layout for a live table whose first load is ``df``.

        A table has up to one file per bucket and partition, and every load that
        touches them opens and writes them all. So the buckets follow the rows
        (one per ``FILE_ROWS``, at least one per core, at most the shuffle
        partitions), and where the report numbers are so far apart that the
        default width has more partitions with rows than the rows ask for, it is
        doubled until it has not. Ranges with rows are counted, not the span,
        so a few stray numbers widen nothing. One pass over the key, of which
        only the sizes are used: rows are counted per range, and only the ranges
        are counted for every width."""
        if self.fixed_buckets and self.fixed_width:
            return self.fixed_buckets, self.fixed_width
        widths = [self.fixed_width] if self.fixed_width else [
            self.part_width << k for k in range(38)]   # up to all positive longs
        # The ranges of the least width first: the wider ones are made of these.
        narrow = df.groupBy(self._number_div(F.col(key).try_cast("long"), widths[0]).alias("at")).agg(
            F.count(F.lit(1)).alias("n"))
        used = narrow.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), *[F.approx_count_distinct(F.coalesce(
            self._number_div(F.col("at"), w // widths[0]), F.lit(-1).cast("long"))).alias(str(w))
            for w in widths]).first()
        rows, cores = int(used["rows"]), self.spark.sparkContext.defaultParallelism
        buckets = self.fixed_buckets or min(self.buckets, max(cores, -(-rows // FILE_ROWS)))
        wanted = max(FEW_PARTS, 2 * -(-rows // PART_ROWS))
        return buckets, next((w for w in widths if used[str(w)] <= wanted), widths[-1])

    def _range(self, key: str, width: int) -> Column:
        return F.coalesce(self._number_div(F.col(key).try_cast("long"), width), F.lit(-1).cast("long"))

    @staticmethod
    def _number_div(number: Column, width: int) -> Column:
        return F.call_function("div", number, F.lit(width).cast("long"))

    def part_of(self, schema: str, name: str, key: str = "dr_no", width: int | None = None) -> Column:
        """The partition that a report number belongs to."""
        return self._range(key, width or int((self.meta(schema, name) or {}).get("part_width") or self.part_width))

    def touched(self, df: DataFrame, schema: str, name: str, key: str = "dr_no") -> list[int]:
        """Partitions that the keys of ``df`` fall into (partition numbers, one
        per range of report numbers, not rows)."""
        part = self.part_of(schema, name, key).alias(PART)
        return sorted(r[0] for r in df.select(part).distinct().collect())

    def _evolve(self, schema: str, name: str, wanted: T.StructType) -> int:
        """Give a live table the columns of ``wanted`` without touching a file;
        returns the number of the catalog entry that has them.

        Only new columns: they are added to the entry. Otherwise (a column
        gone or widened) a new entry over the same files is made; readers move
        to it with the next metadata. A column that comes back after it was
        dropped is refused, since older files would show its old values."""
        meta = self.meta(schema, name)
        path, entry = self._live_path(schema, name), int(meta.get("entry") or 0)
        old = T.StructType.fromJson(json.loads(meta["schema"]))
        kinds = {f.name: f.dataType for f in old.fields}
        new = [f for f in wanted.fields if f.name not in kinds]
        self._register(self._catalog_name(schema, name), path, meta)
        if not new and len(wanted) == len(old) and all(kinds[f.name] == f.dataType for f in wanted.fields):
            return entry
        back = sorted({f.name for f in new} & set(meta.get("dropped") or []))
        if back:
            raise ValueError(f"columns {back} were dropped from {schema}.{name} and cannot come back; use another name")
        stays = {f.name: f.dataType for f in wanted.fields if f.name in kinds}
        if stays == kinds:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            qualified = self._catalog_name(schema, name)
            have = set(self.spark.table(qualified).columns)
            if not {f.name for f in new} <= have:   # a load that was interrupted here is run again
                self.spark.sql(f"ALTER TABLE {qualified} ADD COLUMNS ({cols})")
            return entry
        qualified = self._catalog_name(schema, name, entry + 1)
        self.spark.sql(f"DROP TABLE IF EXISTS {qualified}")
        self._register(qualified, path, {**meta, "schema": wanted.json()})
        return entry + 1

    def write_live(self, df: DataFrame, schema: str, name: str, bucket_by: list[str], watermark,
                   prepartitioned: bool = False, validate=None, metrics: dict | None = None,
                   drop: tuple[str, ...] = (), parts: list[int] | None = None,
                   part: Column | None = None, layout: tuple[int, int] | None = None) -> DataFrame:
        """First write: create the table from ``df``. Later: replace exactly the
        partitions that ``df`` has rows for (so ``df`` must hold all rows of
        those); the files of every other partition stay as they are, also when
        ``df`` has other columns than the table (see ``_evolve``).

        ``metrics`` are observed in the writing stage. ``validate`` gets the
        written table before its metadata makes a first write visible. ``parts``
        (the partitions written) are remembered for ``parts_since``. ``part``
        gives another partition number than the range of the report number; a
        table without ``bucket_by`` is dealt out by partition. ``layout`` sizes a
        first write (see ``fit_layout``)."""
        old = self.meta(schema, name)
        path = self._live_path(schema, name)
        buckets, width = self.layout(schema, name) or layout or (self.buckets, self.part_width)
        exprs = [F.count(F.lit(1)).alias("rows")]
        exprs += [c.alias(f"m__{k}") for k, c in (metrics or {}).items()]
        obs = Observation(f"w_{schema}_{name}_{uuid.uuid4().hex[:8]}")
        out = df.withColumn(PART, self.part_of(schema, name, bucket_by[0], width) if part is None else part.cast("long"))
        if not prepartitioned:
            out = out.repartition(buckets, *(bucket_by or [PART]))
        # The writer sorts by partition, bucket and bucket columns itself.
        out = out.observe(obs, *exprs).drop(*drop)
        self._ensure_database()
        stored = df.drop(*drop).schema
        if old is None:
            entry, qualified = 0, self._catalog_name(schema, name, 0)
            writer = (out.write.mode("overwrite").format("parquet").option("path", path)
                      .options(**OVERWRITE_OPTION).partitionBy(PART))
            if bucket_by:
                writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
            writer.saveAsTable(qualified)
        else:
            entry = self._evolve(schema, name, stored)
            qualified = self._catalog_name(schema, name, entry)
            out.select(*self.spark.table(qualified).columns).write.insertInto(qualified, overwrite=True)
            self.spark.catalog.refreshTable(qualified)
        measured = obs.get
        if validate is not None:
            validate(self.spark.table(qualified))
        gone = set((old or {}).get("dropped") or [])
        if old:
            gone |= set(T.StructType.fromJson(json.loads(old["schema"])).names) - set(stored.names)
        # A dimension is asked for its size: the count is in the files' footers.
        size = {} if bucket_by else {"rows": self.spark.table(qualified).count()}
        self._write_meta(path, {**size, "watermark": watermark, "written_rows": int(measured["rows"]),
                                "metrics": {k: measured.get(f"m__{k}") for k in (metrics or {})},
                                "schema": stored.json(), "previous_schema": old["schema"] if old else None,
                                "bucket_by": bucket_by, "buckets": buckets, "part_width": width,
                                "hash_parts": int((old or {}).get("hash_parts") or self.hash_parts),
                                "entry": entry, "dropped": sorted(gone),
                                "writes": [*((old or {}).get("writes") or []), [watermark, parts]][-WRITES:]})
        return self.read(schema, name)

    def parts_since(self, schema: str, name: str, watermark) -> list[int] | None:
        """Partitions that writes after ``watermark`` have replaced, ``None``
        when that is not known any more (then any may have changed)."""
        writes = (self.meta(schema, name) or {}).get("writes") or []
        if not any(w == watermark for w, _ in writes):
            return None
        later = [p for w, p in writes if w > watermark]
        return None if any(p is None for p in later) else sorted({x for p in later for x in p})

    def _expire(self, schema: str, name: str) -> None:
        vs = self.versions(schema, name)
        for v in vs[:-self.keep_versions] if self.keep_versions else []:
            p = self._version_path(schema, name, v)
            self._fs(p).delete(self._p(p), True)
