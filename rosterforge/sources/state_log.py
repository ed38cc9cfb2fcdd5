"""The record map as a log: every run appends what it changed, and readers join it where it lies.

Below `root`, `segments/` holds one folder per run, bucketed by local id; `manifest/` one line per
version, which names the segments in force. A reader keeps the newest line of each record. The
line is written last, so a run that dies half way leaves the version before it in force.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.operators.changes import STATE_SCHEMA, error_log, no_state, run_stats
from rosterforge.sources.staging import PACKED
from rosterforge.sources.state import _read_or_none

SEGMENT_SCHEMA = STATE_SCHEMA + ", deleted boolean"
MANIFEST_SCHEMA = (
    "version bigint, run_id string, n_buckets int, segments array<struct<seg: int, folder: string>>, floors array<int>, "
    "once array<int>, finished_at timestamp"
)


@dataclass(frozen=True)
class Version:
    """One line of the manifest: rows of a bucket count from the segment `floors[bucket]` on.

    Segments `once` hold one line a record.
    """

    number: int
    n_buckets: int
    segments: tuple[tuple[int, str], ...]
    floors: tuple[int, ...]
    once: tuple[int, ...] = ()

    @property
    def next_segment(self) -> int:
        return max((seg for seg, _ in self.segments), default=0) + 1


class StateLog:
    """A state that costs a run what the run changed. One writer at a time.

    `n_buckets` counts when the log is new, and is the number of shuffle partitions by default; a
    bucket should fit a task. A reader may hold a version while later ones are written, until
    `vacuum` removes the files that only old versions name.
    """

    def __init__(self, spark: SparkSession, root: str, n_buckets: int | None = None) -> None:
        self.spark, self.root = spark, root
        self._new_buckets = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def version(self) -> Version:
        lines = _read_or_none(self.spark, f"{self.root}/manifest", MANIFEST_SCHEMA)
        newest = None if lines is None else lines.agg(F.max_by(F.struct("*"), "version").alias("v")).first()["v"]
        if newest is None:
            return Version(0, self._new_buckets, (), (0,) * self._new_buckets)
        segments = tuple((s["seg"], s["folder"]) for s in newest["segments"])
        once = tuple(newest["once"] or ())
        return Version(newest["version"], newest["n_buckets"], segments, tuple(newest["floors"]), once)

    def _bucket(self, n_buckets: int) -> Column:
        """The bucket of a row, as Spark itself deals bucketed tables."""
        return F.pmod(F.hash("local_id"), F.lit(n_buckets))

    def _in_force(self, df: DataFrame, v: Version) -> DataFrame:
        """Newest line of each record, without the removed ones. Of a lone segment that holds each once, every line."""
        if any(v.floors):
            floors = F.array(*[F.lit(f) for f in v.floors])
            df = df.filter(F.col("seg") >= F.get(floors, self._bucket(v.n_buckets)))
        names = ("target_id", "payload_hash", "synced_at", "deleted")
        if len(v.segments) == 1 and v.segments[0][0] in v.once:
            return df.select("entity", "local_id", *names).filter("NOT deleted").drop("deleted")
        newest = df.groupBy("entity", "local_id").agg(F.max_by(F.struct(*names), "seg").alias("_newest"))
        return newest.select("entity", "local_id", "_newest.*").filter("NOT deleted").drop("deleted")

    def read(self) -> DataFrame:
        """The state in force, as a bucketed table: joins and groups by local id move none of it."""
        v = self.version()
        if not v.segments:
            return no_state(self.spark)
        digest = hashlib.sha1(self.root.encode()).hexdigest()[:12]
        name = f"rosterforge_state_{digest}_{v.number}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({SEGMENT_SCHEMA}, seg int) USING parquet PARTITIONED BY (seg) "
            f"CLUSTERED BY (local_id) SORTED BY (local_id) INTO {v.n_buckets} BUCKETS LOCATION '{self.root}/segments'"
        )
        listed = " ".join(f"PARTITION (seg = {seg}) LOCATION '{self.root}/segments/{folder}'" for seg, folder in v.segments)
        self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {listed}")
        return self._in_force(self.spark.table(name), v)

    def _write_segment(self, rows: DataFrame, v: Version) -> tuple[int, str, bool]:
        """Rows dealt into buckets, at most one file each; empty buckets write none.

        Says as well whether the segment holds one line a record, from its ids where they lie.
        """
        seg, mark = v.next_segment, uuid.uuid4().hex
        folder, name = f"{seg:06d}-{mark}", f"rosterforge_segment_{mark}"
        (
            rows.repartition(v.n_buckets, "local_id").write.format("parquet").bucketBy(v.n_buckets, "local_id")
            .sortBy("local_id").option("path", f"{self.root}/segments/{folder}").options(**PACKED)
            .saveAsTable(name)
        )
        lines = self.spark.table(name).groupBy("entity", "local_id").agg(F.count(F.lit(1)).alias("n"))
        most = lines.agg(F.max("n")).first()[0]
        self.spark.sql(f"DROP TABLE {name}")  # an external table: the files stay
        return seg, folder, most == 1

    def _put_in_force(self, v: Version, run_id: str | None, segments, floors, once) -> None:
        line = [(v.number + 1, run_id, v.n_buckets, list(segments), list(floors), list(once), None)]
        df = self.spark.createDataFrame(line, MANIFEST_SCHEMA).withColumn("finished_at", F.current_timestamp())
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")

    def append(self, outcomes: DataFrame, run_id: str, failures: DataFrame | None = None) -> int:
        """Write what a run changed, and the logs; the number of records written or removed.

        Failed writes change nothing. A run without changes writes its log line alone.
        """
        v = self.version()
        stats = run_stats(outcomes).withColumns({"run_id": F.lit(run_id), "finished_at": F.current_timestamp()})
        lines = stats.collect()  # one line an entity
        changed = sum(line["created"] + line["updated"] + line["removed"] for line in lines)
        if changed:
            rows = outcomes.filter("NOT failed AND action <> 'unchanged'").select(
                "entity", "local_id", "target_id", "payload_hash", F.current_timestamp().alias("synced_at"),
                (F.col("action") == "remove").alias("deleted"),
            )
            seg, folder, is_once = self._write_segment(rows, v)
            once = [*v.once, seg] if is_once else v.once
            self._put_in_force(v, run_id, [*v.segments, (seg, folder)], v.floors, once)
        if failures is not None:
            error_log(failures, run_id).write.mode("append").parquet(f"{self.root}/errors")
        self.spark.createDataFrame(lines, stats.schema).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")
        return changed

    def compact(self, max_segments: int = 8) -> list[int]:
        """Rewrite the buckets that lie in more than `max_segments` segments; the others are not touched.

        Only files of those buckets are read, since a file's name ends in its bucket. The new
        segment holds their newest lines, and older segments no longer count for them.
        """
        v = self.version()
        places: dict[int, int] = {}
        for seg, folder in v.segments:
            for bucket in {b for b, _ in self._files(folder)}:
                if seg >= v.floors[bucket]:
                    places[bucket] = places.get(bucket, 0) + 1
        full = sorted(b for b, n in places.items() if n > max_segments)
        if not full:
            return []
        only = "*_{" + ",".join(f"{b:05d}" for b in full) + "}.c*"
        parts = None
        for seg, folder in v.segments:
            if {b for b, _ in self._files(folder)} & set(full):
                part = self.spark.read.schema(SEGMENT_SCHEMA).option("pathGlobFilter", only).parquet(
                    f"{self.root}/segments/{folder}"
                ).withColumn("seg", F.lit(seg))
                parts = part if parts is None else parts.unionByName(part)
        rows = self._in_force(parts, v).withColumn("deleted", F.lit(False))
        seg, folder, is_once = self._write_segment(rows, v)
        floors = [seg if b in set(full) else f for b, f in enumerate(v.floors)]
        least = min(floors)  # segments below every floor are out of force
        segments = [s for s in (*v.segments, (seg, folder)) if s[0] >= least]
        once = [s for s, _ in segments if s in v.once or (s == seg and is_once)]
        self._put_in_force(v, None, segments, floors, once)
        return full

    def _folder(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _files(self, folder: str) -> list[tuple[int, str]]:
        """(bucket, path) of a segment's files."""
        fs, at = self._folder(f"{self.root}/segments/{folder}")
        found = [str(s.getPath()) for s in fs.listStatus(at)]
        marked = [(re.search(r"_(\d+)\.c\d+", p.rsplit("/", 1)[-1]), p) for p in found]
        return [(int(m[1]), p) for m, p in marked if m]

    def vacuum(self) -> int:
        """Remove files that the version in force does not name; readers of older ones lose them."""
        v = self.version()
        kept, gone = dict((folder, seg) for seg, folder in v.segments), 0
        fs, top = self._folder(f"{self.root}/segments")
        if not fs.exists(top):
            return 0
        for status in fs.listStatus(top):
            folder = status.getPath().getName()
            for bucket, path in self._files(folder):
                if folder not in kept or kept[folder] < v.floors[bucket]:
                    gone += bool(fs.delete(self._folder(path)[1], False))
            if folder not in kept:
                fs.delete(status.getPath(), True)
        return gone
