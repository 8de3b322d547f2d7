"""Table sink: appended Parquet, resolved when it is read.

Layout on shared storage::

    <base>/<stream>/data/<table>/layout=<i>/_commit=<n>-<tag>/_bucket=<b>/part-*.parquet
    <base>/<stream>/_commits/<n>.json     what commit n stored (rows per table, positions)
    <base>/<stream>/_pointer/<n>.json     the commits and layouts in force after commit n

* A batch appends its newest record per key and reads no stored row.  Rows lie in key-hash buckets;
  children lie in their parent's bucket.
* A read takes the rows of all commits and keeps, per key, the row that the upsert rules choose
  (:func:`~tablestream.operators.merge.resolve`): one aggregate with partial aggregation.  Children are
  those written by the commit whose root row was chosen.
* Every commit keeps the layout it was written with; a read projects its rows to today's layout, so a
  column split rewrites nothing.
* A read for given keys reads only their buckets: partition pruning by literals, or dynamic pruning
  from a table of keys.
* A row with a value that fits no column is set aside in the same write (bucket -1, with the paths and
  the record's position); with its root row set aside, a record's children are not visible either.
* Versions: a batch for a newer version is staged apart while the current one stays visible;
  activation makes the staged commits current; a batch older than the current version is ignored.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import merge
from ..operators.evolve import project
from ..operators.flatten import UNPLACED, apply_schema
from ..plans.evolve import Layout, check_keys, evolve, key_columns
from ..plans.naming import table_name, validate_identifier
from ..plans.tables import SEQUENCE, SOURCE_KEY_PREFIX, TablePlan

BUCKET = "_bucket"
COMMIT = merge.COMMIT
FIRST, LAST, TIMES = "__first_pos", "__last_pos", "__records"   # of a key in a batch
ASIDE = -1              # bucket of the rows set aside
ASIDE_POS = "_pos"      # position of the record a row set aside came from


class UnplacedValues(ValueError):
    """Values of a batch fit no column (P9) and the store was asked to refuse them; nothing was published."""


class NotNullViolation(ValueError):
    """A batch would store NULL in a NOT NULL column (P16); nothing was published."""


class _Fs:
    """Minimal Hadoop FileSystem access from the driver (any cluster filesystem)."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _p(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        p, fs = self._p(path)
        return fs.exists(p)

    def read(self, path: str) -> str | None:
        p, fs = self._p(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def listdir(self, path: str) -> list[str]:
        p, fs = self._p(path)
        if not fs.exists(p):
            return []
        return [st.getPath().getName() for st in fs.listStatus(p)]

    def delete(self, path: str) -> None:
        p, fs = self._p(path)
        fs.delete(p, True)

    def write_new(self, path: str, text: str) -> None:
        """Write ``path`` once: temp file, then rename to a name that does not exist yet."""
        p, fs = self._p(path)
        tmp = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if fs.exists(p) or not fs.rename(tmp, p):
            fs.delete(tmp, False)
            raise OSError(f"{path} exists already (concurrent writer?)")

    def write_atomic(self, path: str, text: str) -> None:
        p, fs = self._p(path)
        tmp = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        # one rename that replaces: a crash leaves the old file or the new one, never none
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf).rename(tmp, p, how)


class StoredTable:
    """Layouts of a table, oldest first, with the changes that led to each, and its commits: tag, number of
    the layout, rows."""

    def __init__(self, layouts: list[Layout], changes: list[list], commits: list[tuple[str, int, int]]):
        self.layouts, self.changes, self.commits = layouts, changes, commits

    @property
    def layout(self) -> Layout:
        return self.layouts[-1]

    def grown(self, layout: Layout, changes: list) -> "StoredTable":
        """With one more layout, if anything changed."""
        if not changes:
            return self
        return StoredTable([*self.layouts, layout], [*self.changes, changes], self.commits)

    def to_json(self) -> dict:
        return {"layouts": [x.to_json() for x in self.layouts], "changes": self.changes, "commits": self.commits}

    @staticmethod
    def from_json(d: dict) -> "StoredTable":
        return StoredTable([Layout.from_json(x) for x in d["layouts"]], d["changes"], d["commits"])


class TableStore:
    def __init__(self, spark: SparkSession, base: str, buckets: int = 64, children: str = "sync",
                 persist_empty: bool = False, refuse_unplaced: bool = False):
        self.spark, self.base, self.buckets = spark, base.rstrip("/"), buckets
        self.children, self.persist_empty, self.refuse_unplaced = children, persist_empty, refuse_unplaced
        self.fs = _Fs(spark)

    # --------------------------------------------------------------- pointer
    # The pointer is a series of immutable files ``_pointer/<n>.json``; the
    # highest number is current.  Publishing writes ``n + 1`` (temp file, then
    # rename to a fresh name), so a crash at any moment leaves either the old
    # or the new pointer readable - never none.
    KEEP_POINTERS = 20

    def _pointer_dir(self, stream: str) -> str:
        return f"{self.base}/{stream}/_pointer"

    def _pointer_numbers(self, stream: str) -> list[int]:
        return sorted(int(n[:-5]) for n in self.fs.listdir(self._pointer_dir(stream))
                      if n.endswith(".json") and n[:-5].isdigit())

    def pointer(self, stream: str) -> dict:
        nums = self._pointer_numbers(stream)
        if not nums:
            return {"version": None, "tables": {}, "staged": {}, "commits": {}, "buckets": self.buckets, "seq": 0}
        ptr = json.loads(self.fs.read(f"{self._pointer_dir(stream)}/{nums[-1]:012d}.json"))
        ptr["seq"] = nums[-1]
        return ptr

    def _publish(self, stream: str, ptr: dict) -> None:
        n = ptr.get("seq", 0) + 1
        body = {k: v for k, v in ptr.items() if k != "seq"}
        self.fs.write_new(f"{self._pointer_dir(stream)}/{n:012d}.json", json.dumps(body, sort_keys=True))
        for old in self._pointer_numbers(stream)[:-self.KEEP_POINTERS]:
            self.fs.delete(f"{self._pointer_dir(stream)}/{old:012d}.json")

    def version(self, stream: str) -> int | None:
        return self.pointer(stream)["version"]

    def table_names(self, stream: str) -> dict[tuple, str]:
        """Stored tables by path."""
        return {tuple(t["layouts"][-1]["path"]): name for name, t in self.pointer(stream)["tables"].items()}

    # --------------------------------------------------------------- reading
    @staticmethod
    def _bucket_col(cols: list[str], buckets: int) -> Column:
        return F.pmod(F.hash(*[F.col(f"`{c}`") for c in cols]), F.lit(buckets))

    def _dir(self, stream: str, name: str, layout: int) -> str:
        return f"{self.base}/{stream}/data/{name}/layout={layout}"

    def _appended(self, stream: str, name: str, st: StoredTable, only=None) -> DataFrame:
        """Rows of all commits in today's layout, with ``_commit`` and ``_bucket``.  ``only`` narrows the
        rows of each layout first."""
        marks = (COMMIT, BUCKET)
        parts = []
        for i, layout in enumerate(st.layouts):
            base = self._dir(stream, name, i)
            paths = [f"{base}/{COMMIT}={tag}" for tag, at, _ in st.commits if at == i]
            if not paths:
                continue
            df = self.spark.read.schema(f"{layout.ddl()}, `{COMMIT}` string, `{BUCKET}` int") \
                .option("basePath", base).parquet(*paths).filter(F.col(BUCKET) > ASIDE)
            for later, changes in zip(st.layouts[i + 1:], st.changes[i + 1:]):
                df = project(df, later, [tuple(c) for c in changes], extra=marks)
            parts.append(only(df) if only is not None else df)
        if not parts:
            return self.spark.createDataFrame([], f"{st.layout.ddl()}, `{COMMIT}` string, `{BUCKET}` int")
        return reduce(DataFrame.unionByName, parts)

    def _only(self, keys, columns: list[str], layout: Layout, buckets: int):
        """Filter to given keys of the root: a list of values (or tuples of values), or a DataFrame whose
        first columns are the key.  NULL is nobody's key."""
        types = {n: t for n, t, _ in layout.columns()}
        if isinstance(keys, DataFrame):
            wanted = keys.select(*[F.col(f"`{have}`").cast(types[c]).alias(c) for have, c in zip(keys.columns, columns)])
            wanted = wanted.withColumn(BUCKET, self._bucket_col(columns, buckets)).distinct()
            # a bucket is never below 0, but a predicate makes Spark prune the partitions it reads by this side
            wanted = wanted.filter(F.col(BUCKET) >= 0)
            return lambda df: df.join(wanted, [BUCKET, *columns], "left_semi").select(*df.columns)
        values = [k if isinstance(k, tuple) else (k,) for k in keys]
        schema = ", ".join(f"`{c}` {types[c]}" for c in columns)
        here = [r[0] for r in self.spark.createDataFrame(values, schema)
                .select(self._bucket_col(columns, buckets)).distinct().collect()]
        if len(columns) == 1:
            match = F.col(f"`{columns[0]}`").isin([v[0] for v in values])
        else:
            match = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [
                F.col(f"`{c}`") == F.lit(x) for c, x in zip(columns, v)]) for v in values], F.lit(False))
        return lambda df: df.filter(F.col(BUCKET).isin(here)).filter(match)

    def _resolved(self, stream: str, tables: dict, buckets: int, path: tuple, columns=None, keys=None) -> DataFrame:
        states = {tuple(t["layouts"][-1]["path"]): (n, StoredTable.from_json(t)) for n, t in tables.items()}
        if path not in states:
            raise KeyError(f"no table {path} in stream {stream}")
        (name, st), (root_name, root) = states[path], states[path[:1]]
        root_keys = key_columns(root.layout)
        own = key_columns(st.layout)
        want = [n for n, _, _ in st.layout.columns() if columns is None or n in columns]
        seq = _column(st.layout, SEQUENCE)

        def rows(name, st, key, cols):
            only = None if keys is None else self._only(keys, key, st.layout, buckets)
            return self._appended(stream, name, st, only).select(
                *[F.col(f"`{c}`") for c in dict.fromkeys([*key, *cols])], COMMIT)

        nullable = {n for n, _, null in st.layout.columns() if null}
        if path == path[:1]:
            out = merge.resolve(rows(name, st, own, [seq, *want]), own, seq, null_keys=bool(nullable & set(own)))
        elif self.children == "legacy":
            levels = [n for n in (_column(st.layout, c) for c in _level_names(st.layout)) if n]
            out = merge.resolve(rows(name, st, own, [*levels, seq, *want]), own + levels, seq,
                                null_keys=bool(nullable & set(own)))
        else:
            root_seq = _column(root.layout, SEQUENCE)
            chosen = merge.resolve(rows(root_name, root, root_keys, [root_seq]), root_keys, root_seq)
            out = merge.children_of(rows(name, st, own, want), chosen, own, root_keys,
                                    total=sum(n for *_, n in st.commits))
        return out.select(*[F.col(f"`{c}`") for c in want])

    def read(self, stream: str, path: tuple | None = None, version: int | None = None,
             columns: list[str] | None = None, keys=None) -> DataFrame:
        """A stored table.  ``columns`` narrows what is read before rows are resolved.  ``keys`` (a
        list of root keys, or a DataFrame of them) reads the buckets of these keys only; on a child
        table they are its parents' keys."""
        ptr = self.pointer(stream)
        tables = ptr["tables"] if version is None or version == ptr["version"] \
            else ptr["staged"][str(version)]
        return self._resolved(stream, tables, ptr["buckets"], tuple(path or (stream,)), columns, keys)

    def read_tables(self, stream: str) -> dict[tuple, DataFrame]:
        """Every current table of ``stream`` as ``{path: DataFrame}``."""
        return {path: self.read(stream, path) for path in self.table_names(stream)}

    def is_empty(self, stream: str, path: tuple | None = None) -> bool:
        """One-row probe of the appended rows."""
        path = tuple(path or (stream,))
        for name, t in self.pointer(stream)["tables"].items():
            if tuple(t["layouts"][-1]["path"]) == path:
                return self._appended(stream, name, StoredTable.from_json(t)).isEmpty()
        return True

    def unplaced(self, stream: str, path: tuple | None = None) -> DataFrame:
        """Rows of a table that were set aside: key columns, the record's position, and the ``paths``
        whose values fit no column.  Reads their partition only."""
        path = tuple(path or (stream,))
        ptr = self.pointer(stream)
        name, st = next((n, StoredTable.from_json(t)) for n, t in ptr["tables"].items()
                        if tuple(t["layouts"][-1]["path"]) == path)
        keys = key_columns(st.layout)
        types = {n: t for n, t, _ in st.layout.columns()}
        schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + [f"`{UNPLACED}` array<string>, `{ASIDE_POS}` bigint, "
                                                                  f"`{COMMIT}` string, `{BUCKET}` int"])
        parts = [self.spark.read.schema(schema).option("basePath", self._dir(stream, name, i))
                 .parquet(f"{self._dir(stream, name, i)}/{COMMIT}={tag}") for tag, i, _ in st.commits]
        rows = reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)
        return rows.filter(F.col(BUCKET) == ASIDE).select(*keys, F.col(ASIDE_POS).alias("pos"), F.col(UNPLACED).alias("paths"))

    def commit_log(self, stream: str) -> list[dict]:
        """A1: what each commit stored, in order: load, batch, segment, version, positions
        (of all its records), records, rows per table, rows set aside."""
        last = self.pointer(stream)["seq"]
        folder = f"{self.base}/{stream}/_commits"
        numbers = sorted(int(n[:-5]) for n in self.fs.listdir(folder) if n.endswith(".json") and n[:-5].isdigit())
        return [json.loads(self.fs.read(f"{folder}/{n:012d}.json")) for n in numbers if n <= last]

    # --------------------------------------------------------------- writing
    def write_batch(self, stream: str, plans: list[TablePlan], records: DataFrame,
                    batch_id: int, version: int | None = None, segment: int = 0, load: str = "") -> dict:
        """Append one batch of every table of ``stream`` and publish it (M4, V1, V2).

        ``records`` are stamped RECORD rows (VARIANT ``record`` + ``_sdc_*``);
        they are flattened with the *evolved* stored layouts, so a value lands
        in its split column.  A commit is known by ``(load, batch_id, segment)``:
        running one again is a no-op (retry safety, T8), and loads (streaming
        queries) never hide each other's batches.  The bucket count is the
        one stored with the stream.
        """
        ptr = self.pointer(stream)
        commits = ptr.setdefault("commits", {})
        if [batch_id, segment] <= commits.get(load, [-1, -1]):
            return {"skipped": "already committed"}
        buckets = ptr.setdefault("buckets", self.buckets)
        current = ptr["version"]
        if version is not None and current is not None and version < current:
            return {"skipped": f"version {version} older than {current}"}   # V2
        staging = version is not None and current is not None and version > current
        if version is not None and current is None and not ptr["tables"]:
            current = version
        target = ptr["staged"].setdefault(str(version), {}) if staging else ptr["tables"]

        states = {name: StoredTable.from_json(t) for name, t in target.items()}
        names = {st.layout.path: name for name, st in states.items()}
        layouts, changed = {}, {}
        for plan in plans:
            name = names.get(plan.path) or validate_identifier(table_name(plan.path, names))
            names[plan.path] = name
            old = states.get(name)
            layout, changes = evolve(old.layout if old else None, plan, name,
                                     table_empty=old is None or not old.commits)
            if old is not None and plan.is_root:
                check_keys(old.layout, plan, layout)
            states[name] = old.grown(layout, changes) if old else StoredTable([layout], [changes], [])
            layouts[plan.path], changed[name] = layout, [c[0] for c in changes]

        pos = "pos" if "pos" in records.columns else None   # breaks sequence ties
        newest = newest_records(records, plans[0], layouts[plans[0].path], pos).persist()
        tag = f"{ptr['seq'] + 1:012d}-{uuid.uuid4().hex[:8]}"
        counts, aside = {}, 0
        try:
            span = newest.agg(F.min(FIRST), F.max(LAST), F.sum(TIMES)).first()
            if not span[2] and not self.persist_empty:
                return {"skipped": "empty batch"}
            keep = (pos,) if pos else ()
            tables = apply_schema(newest, plans, layouts, with_unplaced=True, keep=keep)
            for plan in plans:
                name, layout = names[plan.path], layouts[plan.path]
                keys = key_columns(layout)
                rows = tables[plan.path]
                if not plan.is_root and self.children == "legacy":
                    levels = [_column(layout, c) for c in plan.level_columns()]
                    rows = apply_schema(records, plans, layouts, with_unplaced=True, keep=keep)[plan.path]
                    rows = merge.latest_per_key(rows, keys + levels, _column(layout, SEQUENCE), pos)
                at = f"{self._dir(stream, name, len(states[name].layouts) - 1)}/{COMMIT}={tag}"
                counts[name], n = self._append(rows, layout, keys, buckets, at, pos)
                aside += n
                states[name].commits.append((tag, len(states[name].layouts) - 1, counts[name]))
        finally:
            newest.unpersist()
        target.update({name: st.to_json() for name, st in states.items()})
        if not staging:
            ptr["version"] = current
        commits[load] = [batch_id, segment]
        self.fs.write_atomic(f"{self.base}/{stream}/_commits/{ptr['seq'] + 1:012d}.json", json.dumps(
            {"stream": stream, "load": load, "batch": batch_id, "segment": segment, "version": version,
             "first_pos": span[0], "last_pos": span[1], "records": span[2] or 0, "rows": counts, "unplaced": aside}))
        self._publish(stream, ptr)
        return {**changed, "_rows": counts, "_unplaced": aside}

    def _append(self, rows: DataFrame, layout: Layout, keys: list[str], buckets: int, at: str,
                pos: str | None = None) -> tuple[int, int]:
        """Write one table of a commit; rows stored and rows set aside.  NULL in a NOT NULL column is an
        error (P16): the new directory is then never published."""
        required = [n for n, _, nullable in layout.columns() if not nullable]
        any_null = reduce(lambda a, b: a | b, [F.col(f"`{n}`").isNull() for n in required], F.lit(False))
        unfit = F.size(UNPLACED) > 0 if UNPLACED in rows.columns else F.lit(False)
        if UNPLACED in rows.columns:
            where = F.when(unfit, F.col(pos)) if pos else F.lit(None)
            rows = rows.select(*[F.col(f"`{n}`") for n, _, _ in layout.columns()], where.cast("bigint").alias(ASIDE_POS),
                               F.when(unfit, F.col(UNPLACED)).alias(UNPLACED),
                               F.when(unfit, ASIDE).otherwise(self._bucket_col(keys, buckets)).alias(BUCKET))
            unfit = F.col(BUCKET) == ASIDE
        else:
            rows = rows.withColumn(BUCKET, self._bucket_col(keys, buckets))
        seen = Observation()
        rows = rows.observe(seen, F.count(F.when(~unfit, 1)).alias("rows"), F.count(F.when(unfit, 1)).alias("unplaced"),
                            F.count(F.when(any_null & ~unfit, 1)).alias("null_violations"))
        # sorting inside each task gives one open file at a time and moves no row
        (rows.sortWithinPartitions(BUCKET, *[f"`{k}`" for k in keys])
             .write.mode("overwrite").partitionBy(BUCKET).parquet(at))
        got = seen.get
        if got.get("null_violations"):
            raise NotNullViolation(f"{got['null_violations']} row(s) of {layout.name} hold NULL in a NOT NULL "
                                   f"column ({', '.join(required)}); the batch is not published")
        if got.get("unplaced") and self.refuse_unplaced:
            raise UnplacedValues(f"{got['unplaced']} row(s) of {layout.name} hold a value that fits no column; "
                                 f"the batch is not published")
        return got.get("rows", 0), got.get("unplaced", 0)

    def compact(self, stream: str) -> None:
        """Write every current table's resolved rows as one commit in today's layout, so that reads have
        one directory again.  Never part of a load; what it replaces goes with :meth:`vacuum`."""
        ptr = self.pointer(stream)
        tag = f"{ptr['seq'] + 1:012d}-{uuid.uuid4().hex[:8]}"
        new = {}
        for name, t in ptr["tables"].items():
            st = StoredTable.from_json(t)
            rows = self._resolved(stream, ptr["tables"], ptr["buckets"], st.layout.path)
            n, _ = self._append(rows, st.layout, key_columns(st.layout), ptr["buckets"],
                             f"{self._dir(stream, name, len(st.layouts) - 1)}/{COMMIT}={tag}")
            new[name] = StoredTable(st.layouts, st.changes, [(tag, len(st.layouts) - 1, n)]).to_json()
        ptr["tables"] = new
        self._publish(stream, ptr)

    def vacuum(self, stream: str) -> list[str]:
        """Delete commits that no retained pointer file refers to.  Returns the deleted directories."""
        live = set()
        for n in self._pointer_numbers(stream):
            ptr = json.loads(self.fs.read(f"{self._pointer_dir(stream)}/{n:012d}.json"))
            for tables in [ptr["tables"], *ptr["staged"].values()]:
                live.update(c[0] for t in tables.values() for c in t["commits"])
        gone, data = [], f"{self.base}/{stream}/data"
        for layout in (f"{data}/{t}/{x}" for t in self.fs.listdir(data) for x in self.fs.listdir(f"{data}/{t}")):
            for name in self.fs.listdir(layout):
                if name.removeprefix(f"{COMMIT}=") not in live:
                    self.fs.delete(f"{layout}/{name}")
                    gone.append(f"{layout}/{name}")
        return gone

    def activate_version(self, stream: str, version: int) -> bool:
        """V3: make a staged version current; older, equal or never staged versions are a no-op."""
        ptr = self.pointer(stream)
        if ptr["version"] is not None and version <= ptr["version"]:
            return False
        staged = ptr["staged"].pop(str(version), None)
        if staged is None:   # nothing stored under that version: the current rows stay
            return False
        ptr["tables"] = staged
        ptr["version"] = version
        ptr["staged"] = {k: v for k, v in ptr["staged"].items() if int(k) > version}
        self._publish(stream, ptr)
        return True


def _column(layout: Layout, name: str) -> str | None:
    """Stored name of a metadata column."""
    return next((m["to"] for m in layout.mappings if m["from"] == (name,)), None)


def _level_names(layout: Layout) -> list[str]:
    return [m["from"][0] for m in layout.mappings if len(m["from"]) == 1 and m["from"][0].startswith("_sdc_level_")]


def newest_records(records: DataFrame, root: TablePlan, layout: Layout, pos: str | None) -> DataFrame:
    """W1 on whole records: per key the one with the highest sequence (ties: the later position).  Root
    row and children are then flattened from the record that won, so children need no join.  The
    positions and number of all records of the key come along."""
    row = "__row"
    packed = records.select("*", F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias(row))
    keys = key_columns(layout)
    typed = apply_schema(packed, [root], {root.path: layout}, keep=(row,))[root.path]
    at = F.col(f"{row}.{pos}") if pos else F.lit(None).cast("bigint")
    best = typed.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.max_by(row, merge.newer_first(F.col(_column(layout, SEQUENCE)), at if pos else None)).alias(row),
        F.min(at).alias(FIRST), F.max(at).alias(LAST), F.count(F.lit(1)).alias(TIMES))
    return best.select(f"{row}.*", FIRST, LAST, TIMES)
