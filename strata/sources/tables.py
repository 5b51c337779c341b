"""Managed tables: Parquet folders and one pointer file per table.

Every write goes to a new folder ``<root>/<name>/seg=<id>``; then the table's
small pointer file is replaced, and readers follow it.  So a half-written folder
is never seen, and no path is overwritten while it is read.  The pointer names
the table's folders: one for a plain table, the partition folders for a
partitioned one (at most one list entry per partition and append).  Rewrites of
partitioned tables replace only the partition folders they touch; ``merge_files``
replaces single files, which the pointer then names one by one.  The pointer also
holds the id of the load that made its state (``loading``): data and id are
switched in one rename, so a load that is tried again can tell that it is done.

A folder that neither the pointer nor the one before it names is deleted at the
next write.  One writer per table at a time.
"""
from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.layout import compact, files_for
from ..operators.joins import keys_match
from ..session import cut_lineage, path_exists

PART = "_part"      # partition column of merge tables, made from the key and not shown to readers


def merge_schemas(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Union by name: old columns keep their place, new ones are appended."""
    if old is None:
        return new
    names = set(old.fieldNames())
    return T.StructType(list(old.fields) + [f for f in new.fields if f.name not in names])


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._load: str | None = None

    @contextlib.contextmanager
    def loading(self, load: str):
        """Writes inside name ``load`` as the load that made the table's state."""
        self._load = load
        try:
            yield
        finally:
            self._load = None

    def load_id(self, name: str) -> str | None:
        """The last load that changed the table under an id."""
        entry = self._entry(name)
        return entry.get("load") if entry else None

    # ------------------------------------------------------------ files
    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _entry(self, name: str) -> dict | None:
        """The table's pointer; ``None`` only if there is none."""
        path = f"{self.root}/{name}/current.json"
        if not path_exists(self.spark, path):
            return None
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0])

    def _switch(self, name: str, schema: T.StructType, folders: Sequence[str], by: Sequence[str]) -> None:
        """Replace the pointer in one rename, then drop folders nobody names."""
        before = self._entry(name)
        entry = {"folders": sorted(folders), "before": before["folders"] if before else [],
                 "partition_by": list(by), "schema": schema.jsonValue(),
                 "load": self._load or (before or {}).get("load")}
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        fs, tmp = self._fs(f"{self.root}/{name}/current-{uuid.uuid4().hex}.tmp")
        out = fs.create(tmp, False)
        try:
            out.write(bytearray(json.dumps(entry).encode("utf-8")))
        finally:
            out.close()
        fc = jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(getattr(fc, "Options$Rename"), 1)
        options[0] = getattr(fc, "Options$Rename").OVERWRITE
        target = fc.Path(f"{self.root}/{name}/current.json")
        fc.FileContext.getFileContext(target.toUri(), conf).rename(fs.makeQualified(tmp), fs.makeQualified(target), options)
        named = entry["folders"] + entry["before"]
        for st in fs.listStatus(fc.Path(f"{self.root}/{name}")):
            seg = st.getPath().getName()
            if seg.startswith("seg=") and not any(f"/{seg}/" in f"{x}/" for x in named):
                fs.delete(st.getPath(), True)
        # in segments named file by file, files that are named no more
        for seg in {x.rsplit("/", 1)[0] for x in named if x.endswith(".parquet")}:
            mine = {self._plain(x) for x in named}
            if self._plain(seg) not in mine:
                for x in self._files(seg):
                    if self._plain(x) not in mine:
                        fs.delete(fc.Path(x), False)

    def _files(self, folder: str) -> list[str]:
        """Data files of a folder (of a file: itself)."""
        fs, p = self._fs(folder)
        return [st.getPath().toString() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-")]

    def _leaves(self, seg: str, depth: int) -> list[str]:
        """Partition folders of a new segment (bounded by the partitions)."""
        level = [seg]
        for _ in range(depth):
            found = []
            for d in level:
                fs, p = self._fs(d)
                found += [st.getPath().toString() for st in fs.listStatus(p)
                          if st.isDirectory() and "=" in st.getPath().getName()] if fs.exists(p) else []
            level = found
        return level

    def _write(self, df: DataFrame, name: str, by: Sequence[str]) -> list[str]:
        """Write a new segment; the folders that hold it."""
        seg = f"{self.root}/{name}/seg={uuid.uuid4().hex}"
        if by:
            # AQE sizes the write tasks per partition value (splitting a hot
            # value, merging small ones) instead of every task writing a
            # small file into every partition folder
            df.hint("rebalance", *by).write.mode("errorifexists").partitionBy(*by).parquet(seg)
            return self._leaves(seg, len(by))
        df.write.mode("errorifexists").parquet(seg)
        return [seg]

    def _frame(self, name: str, entry: dict, folders: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*folders)
        return df.select(*schema.fieldNames())      # _metadata stays within reach

    # ------------------------------------------------------------ reading
    def exists(self, name: str) -> bool:
        return self._entry(name) is not None

    def read(self, name: str) -> DataFrame:
        """The table, in its recorded schema: no inference job; folders written
        before a column came read it as null."""
        entry = self._entry(name)
        if entry is None:
            raise ValueError(f"table {name!r} does not exist in {self.root}")
        df = self._frame(name, entry, entry["folders"])
        return df.drop(PART)

    def partition_by(self, name: str) -> list[str]:
        entry = self._entry(name)
        return entry["partition_by"] if entry else []

    def size(self, name: str) -> int:
        """Bytes of the table's files."""
        return sum(self._folder(f)[1] for f in self._entry(name)["folders"])

    def _folder(self, folder: str) -> tuple[int, int]:
        """(data files, bytes) of a folder."""
        fs, p = self._fs(folder)
        files = [st.getLen() for st in fs.listStatus(p) if st.getPath().getName().startswith("part-")]
        return len(files), sum(files)

    # ------------------------------------------------------------ writing
    def publish(self, df: DataFrame, name: str, *, partition_by: Sequence[str] | None = None) -> None:
        """Full rebuild: the table becomes ``df``."""
        by = list(partition_by or [])
        self._switch(name, self._stored(df.schema, by), self._write(df, name, by), by)

    @staticmethod
    def _stored(schema: T.StructType, by: Sequence[str]) -> T.StructType:
        """Schema as read back: partition columns come last."""
        return T.StructType([f for f in schema.fields if f.name not in by] + [schema[c] for c in by])

    def append(self, df: DataFrame, name: str, *, partition_by: Sequence[str] | None = None) -> None:
        """Add rows; the table may gain columns.  A plain table takes the files
        into its folder (they show when the write commits)."""
        entry = self._entry(name)
        if entry is None:
            return self.publish(df, name, partition_by=partition_by)
        by = entry["partition_by"]
        schema = merge_schemas(T.StructType.fromJson(entry["schema"]), df.schema)
        if by:
            self._switch(name, self._stored(schema, by), entry["folders"] + self._write(df, name, by), by)
            return None
        if any(f.endswith(".parquet") for f in entry["folders"]):
            self._switch(name, schema, entry["folders"] + self._write(df, name, by), by)
            return None
        if schema.jsonValue() != entry["schema"]:
            self._switch(name, schema, entry["folders"], by)
        df.write.mode("append").parquet(entry["folders"][0])
        return None

    def _replace(self, name: str, entry: dict, hit: Sequence[str], df: DataFrame, check=None) -> None:
        """Put ``df`` in place of the partition folders ``hit``.  ``check`` sees
        the written rows before the pointer names them."""
        by, gone = entry["partition_by"], set(hit)
        schema = self._stored(merge_schemas(T.StructType.fromJson(entry["schema"]), df.schema), by)
        new = self._write(df, name, by)
        if check is not None:
            check(self._frame(name, {"schema": schema.jsonValue()}, new).drop(PART))
        self._switch(name, schema, [f for f in entry["folders"] if f not in gone] + new, by)

    def delete_where(self, name: str, predicate: Column) -> None:
        """Remove rows where ``predicate`` is true (null counts as false).
        Partitions without such rows stay as they are."""
        entry = self._entry(name)
        df = self._frame(name, entry, entry["folders"])
        goes = F.coalesce(predicate, F.lit(False))
        if not entry["partition_by"]:
            self.publish(df.filter(~goes), name)
            return
        read = self.spark.read.schema(df.schema).option("basePath", f"{self.root}/{name}").parquet(*entry["folders"])
        where = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("d")
        dirs = {self._plain(r["d"]) for r in read.filter(goes).select(where).distinct().collect()}    # partitions
        hit = [f for f in entry["folders"] if self._plain(f) in dirs]
        if hit:
            self._replace(name, entry, hit, self._frame(name, entry, hit).filter(~goes))

    @staticmethod
    def _plain(path: str) -> str:
        """A path without its scheme, to compare the ways Spark and Hadoop write it."""
        from urllib.parse import unquote
        return unquote(path.split(":", 1)[-1]).replace("//", "/").rstrip("/")

    def rewrite(self, name: str, transform: Callable[[DataFrame, int], DataFrame]) -> None:
        """Replace the table by ``transform(table, files)``, ``files`` from its
        bytes; it keeps its partitioning."""
        entry = self._entry(name)
        df = self._frame(name, entry, entry["folders"])
        self.publish(transform(df, files_for(self.size(name))), name, partition_by=entry["partition_by"])

    def compact(self, name: str) -> None:
        """Merge small files.  In a partitioned table only partitions with more
        files than their bytes need are written again."""
        entry = self._entry(name)
        if not entry["partition_by"]:
            self.rewrite(name, compact)
            return
        values: dict[str, list[str]] = {}
        for f in entry["folders"]:      # a partition may lie in a folder of every append
            values.setdefault(f.split("/seg=", 1)[1].split("/", 1)[1], []).append(f)
        hit = []
        for folders in values.values():
            sizes = [self._folder(f) for f in folders]
            if len(folders) > 1 or sum(n for n, _ in sizes) > files_for(sum(b for _, b in sizes)):
                hit += folders
        if hit:
            self._replace(name, entry, hit, self._frame(name, entry, hit))


def key_buckets(keys: Sequence[str], n: int) -> Column:
    """Partition expression: one of ``n`` hash buckets of the null-tagged key."""
    from ..functions.keys import hash_key
    return F.pmod(hash_key(*keys), F.lit(n)).cast("int")


def merge_into(store: TableStore, name: str, batch: DataFrame, merge, partition: Column, check=None) -> None:
    """Merge ``batch`` into table ``name``, rewriting only touched partitions.

    The table is stored partitioned by ``partition``, an expression of the
    business key (so every version of a key lies in one partition) whose values
    new batches hit few of, like a load month.  Only partitions holding a batch
    key are read, merged with ``merge(old_rows, batch)`` and written again.
    ``check`` (optional) sees the merged rows once they are written but before
    readers do: raising leaves the table as it was.  Partition values should be
    integers or plain text (they become folder names).
    """
    entry = store._entry(name)
    old_part = entry is not None and entry["partition_by"] == [PART]
    if not old_part:
        base = store.read(name) if entry is not None else None
        merged = (merge(base, batch) if base is not None else batch).withColumn(PART, partition)
        empty = {"folders": [], "partition_by": [PART], "schema": merged.schema.jsonValue()}
        store._replace(name, empty, [], merged, check)
        return
    touched = {("__HIVE_DEFAULT_PARTITION__" if r[0] is None else str(r[0]))
               for r in batch.select(partition.cast("string")).distinct().collect()}     # partitions
    hit = [f for f in entry["folders"] if f.rstrip("/").rsplit(f"/{PART}=", 1)[1] in touched]
    old = store._frame(name, entry, hit).drop(PART)
    store._replace(name, entry, hit, merge(old, batch).withColumn(PART, partition), check)


def merge_files(store: TableStore, name: str, batch: DataFrame, keys: Sequence[str], merge) -> None:
    """Merge ``batch`` into an unpartitioned table, rewriting only the files that
    hold one of its keys (null-safe).

    The files are found by reading the key columns alone: row groups outside the
    batch's range of the first key are skipped by their minima and maxima, and a
    semi join (which Spark prunes further by a bloom filter of the batch's keys
    if that pays) leaves the names of the files that really hold one.  All other
    files keep their names and are never opened again.  So on a table clustered by its key
    a small batch costs little, whatever the table's size.  ``merge(old, batch)``
    gets the rows of the found files; the list of files passes through the driver.
    """
    entry = store._entry(name)
    batch = cut_lineage(batch)
    if entry is None:
        store.publish(batch, name)
        return
    if entry["partition_by"]:
        raise ValueError(f"table {name!r} is partitioned; use merge_into")
    files = [f for d in entry["folders"] for f in store._files(d)]
    ask = batch.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
    table = store._frame(name, entry, files)
    first = F.col(keys[0])
    bound = batch.agg(F.min(keys[0]).alias("lo"), F.max(keys[0]).alias("hi"))
    held = table.select(*keys, F.col("_metadata.file_path").alias("__file"))
    if batch.filter(first.isNull()).isEmpty():
        held = held.filter((first >= bound.select("lo").scalar()) & (first <= bound.select("hi").scalar()))
    on = keys_match([F.col(k) for k in keys], [F.col(f"__k{i}") for i in range(len(keys))])
    hit = {store._plain(r["__file"]) for r in held.join(ask, on, "left_semi").select("__file").distinct().collect()}    # files
    old = store._frame(name, entry, [f for f in files if store._plain(f) in hit])
    merged = merge(old, batch)
    schema = merge_schemas(T.StructType.fromJson(entry["schema"]), merged.schema)
    new = store._write(merged, name, [])
    store._switch(name, schema, [f for f in files if store._plain(f) not in hit] + new, [])


def create_or_upsert(store: TableStore, name: str, batch: DataFrame, keys: Sequence[str],
                     partition: Column | None = None) -> None:
    """First load creates the table; later loads merge on ``keys`` - with
    ``partition`` (an expression of the keys) in the partitions they touch.
    Only an explicit existence check decides - merge errors propagate."""
    from ..operators.joins import require_unique
    from ..operators.upsert import upsert
    if partition is not None:
        require_unique(batch, keys)
        merge_into(store, name, batch, lambda old, new: upsert(old, new, keys), partition)
    elif store.exists(name):
        store.publish(upsert(store.read(name), batch, keys), name)
    else:
        require_unique(batch, keys)
        store.publish(batch, name)
