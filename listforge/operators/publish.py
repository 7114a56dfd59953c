"""Publishing list versions into a folder: immutable version folders, and a manifest that is written last.

A publish writes into a folder of its own and then adds one numbered manifest. Readers start from the newest manifest, so a publish
that dies half-way is never seen, and what it left is swept later. The manifest is put in place by a rename that
never replaces a file, so of two publishers that started from the same version only one commits.

    <root>/commits/00000003.json            what version 3 is made of
    <root>/data/3-<id>/changes              keys that came, changed, went or returned
    <root>/data/3-<id>/closed               row versions that ended with it, under [valid_from_seq, valid_to_seq)
    <root>/data/3-<id>/open/bucket=<b>      rows that are valid after it, and keys that have gone, by hash of the key

Only buckets that hold a changed key are written anew; for the others the manifest names the older folder. The number of buckets
follows the number of keys, so a bucket stays about as large. A publish carries no documents through a shuffle but those
of touched buckets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import drop_path

#: Keys of a bucket; with more than twice as many the buckets are dealt anew.
BUCKET_KEYS = 200_000


class Refused(RuntimeError):
    """A publish that may not happen: its sequence isn't newer, or another publisher was faster."""


@dataclass(frozen=True)
class Commit:
    """What a manifest says. folders: by bucket, the data folder that holds its open rows."""

    number: int
    seq: int
    digest: str
    folder: str
    buckets: int
    keys: int
    schema: str
    counts: dict[str, int]
    folders: dict[str, str] = field(default_factory=dict)


class ListStore:
    """The published versions of a list in a folder that driver and executors share.

    keys are the columns that name a record, unique within a candidate; ``hash_col`` tells whether its content is the same.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], hash_col: str = "content_hash", bucket_keys: int = BUCKET_KEYS):
        self.spark, self.root, self.keys, self.hash_col, self.bucket_keys = spark, root.rstrip("/"), list(keys), hash_col, bucket_keys

    # --- manifests

    def _files(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits")
        return jvm, path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifests(self) -> list[str]:
        """Paths of all manifests, oldest first."""
        _, path, fs = self._files()
        found = fs.listStatus(path) if fs.exists(path) else []
        return sorted(s.getPath().toString() for s in found if s.getPath().getName().endswith(".json"))

    def _load(self, paths: list[str]) -> list[Commit]:
        texts = self.spark.read.format("binaryFile").load(paths).select("content").collect() if paths else []
        return sorted((Commit(**json.loads(bytes(r["content"]))) for r in texts), key=lambda c: c.number)

    def commits(self) -> list[Commit]:
        """All committed versions, oldest first."""
        return self._load(self._manifests())

    def newest(self) -> Commit | None:
        """The newest version; only its manifest is read."""
        found = self._load(self._manifests()[-1:])
        return found[0] if found else None

    def _add(self, commit: Commit) -> None:
        """Put a manifest in place, unless its number is taken."""
        jvm, path, fs = self._files()
        fs.mkdirs(path)
        made, final = (jvm.org.apache.hadoop.fs.Path(path, n) for n in (f".{uuid.uuid4().hex}", f"{commit.number:08d}.json"))
        out = fs.create(made, False)
        out.write(bytearray(json.dumps(asdict(commit)).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(context.makeQualified(made), context.makeQualified(final), none)
        except Exception as e:
            fs.delete(made, False)
            if "AlreadyExists" in str(e):
                raise Refused(f"version {commit.number} was committed by another publisher") from None
            raise

    # --- reading

    def _read(self, paths: Sequence[str], schema: str) -> DataFrame:
        kind = StructType.fromDDL(schema)
        return self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)

    def _open(self, commit: Commit | None, schema: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """Open rows and gone keys of some buckets (all, if not given)."""
        wanted = [] if commit is None else [f"{self.root}/data/{f}/open/bucket={b}" for b, f in commit.folders.items() if buckets is None or int(b) in buckets]
        return self._read(wanted, f"{schema}, gone boolean, valid_from_seq long")

    def _closed(self, commits: Sequence[Commit], schema: str) -> DataFrame:
        return self._read([f"{self.root}/data/{c.folder}/closed" for c in commits], f"{schema}, valid_from_seq long, valid_to_seq long")

    def _known(self) -> list[Commit]:
        found = self.commits()
        if not found:
            raise LookupError(f"nothing is published in {self.root}")
        return found

    def current(self) -> DataFrame:
        """The records of the newest version."""
        last = self.newest()
        if last is None:
            raise LookupError(f"nothing is published in {self.root}")
        return self._open(last, last.schema).where("NOT gone").drop("gone")

    def as_of(self, seq: int) -> DataFrame:
        """The records of the newest version up to a sequence. Only versions after it are read for what has ended since."""
        found = self._known()
        last = found[-1]
        ended = self._closed([c for c in found if c.seq > seq], last.schema).where(F.col("valid_from_seq") <= seq).drop("valid_to_seq")
        return self._open(last, last.schema).where(~F.col("gone") & (F.col("valid_from_seq") <= seq)).drop("gone").unionByName(ended)

    def versions(self) -> DataFrame:
        """All row versions with [valid_from_seq, valid_to_seq); the latter is null for current rows."""
        found = self._known()
        now = self.current().withColumn("valid_to_seq", F.lit(None).cast("long"))
        return now.unionByName(self._closed(found, found[-1].schema))

    def changes(self) -> DataFrame:
        """The change log of all versions: keys, change_type, old_hash, new_hash, seq."""
        found = self._known()
        parts = [self.spark.read.parquet(f"{self.root}/data/{c.folder}/changes").withColumn("seq", F.lit(c.seq).cast("long")) for c in found]
        return reduce(DataFrame.unionByName, parts)

    # --- publishing

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _digest(self, candidate: DataFrame) -> tuple[str, int]:
        """Content of a candidate without regard to order, and its number of rows."""
        one = F.xxhash64(*self.keys, self.hash_col)
        row = candidate.agg(F.count("*").alias("n"), F.bit_xor(one).alias("x"), F.sum(one.cast("decimal(20,0)")).alias("s")).first()
        return f"{row['n']}-{row['x'] or 0}-{row['s'] or 0}", row["n"]

    def publish(self, seq: int, candidate: DataFrame) -> Commit:
        """Make a candidate the newest version and return its commit.

        The same candidate under the newest sequence again changes nothing; another one, or an older sequence, is refused.
        A key that was there in any earlier version and not in the newest returns as RELIST.
        """
        base = self.newest()
        digest, keys = self._digest(candidate)
        if base is not None and seq <= base.seq:
            if seq == base.seq and digest == base.digest:
                return base
            raise Refused(f"sequence {base.seq} is published; {seq} isn't newer")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in candidate.schema)
        if base is not None and base.schema != schema:
            raise Refused("the columns differ from those of the published version")
        grown = base is None or keys > 2 * base.buckets * self.bucket_keys
        buckets = max(1, 1 << max(0, -(-keys // self.bucket_keys) - 1).bit_length()) if grown else base.buckets
        folder = f"{seq}-{uuid.uuid4().hex}"
        path = f"{self.root}/data/{folder}"

        old = self._open(base, schema).select(*self.keys, F.col(self.hash_col).alias("old_hash"), "gone")
        new = candidate.select(*self.keys, F.col(self.hash_col).alias("new_hash"), F.lit(True).alias("here"))
        kind = F.when(F.col("here").isNull(), F.when(~F.col("gone"), "REMOVE")).when(F.col("gone").isNull(), "ADD").when(F.col("gone"), "RELIST")
        kind = kind.when(~F.col("old_hash").eqNullSafe(F.col("new_hash")), "CHANGE")
        found = old.join(new, self.keys, "full_outer").withColumn("change_type", kind).where("change_type IS NOT NULL")
        found.select(*self.keys, "change_type", "old_hash", "new_hash").write.parquet(f"{path}/changes")

        # from here on only what was written counts, so a task that runs again sees the same
        changed = self.spark.read.parquet(f"{path}/changes").select(*self.keys, "change_type", self.bucket(buckets).alias("bucket"))
        per_bucket = changed.groupBy("bucket", "change_type").count().collect()  # rows: four times the buckets at most
        touched = set(range(buckets)) if base is not None and buckets != base.buckets else {r["bucket"] for r in per_bucket}
        counts = {k: sum(r["count"] for r in per_bucket if r["change_type"] == k) for k in ("ADD", "CHANGE", "REMOVE", "RELIST")}
        same_deal = base is not None and buckets == base.buckets
        before = self._open(base, schema, sorted(touched) if same_deal else None)
        ending = before.where("NOT gone").join(changed.where("change_type IN ('CHANGE', 'REMOVE')").select(*self.keys), self.keys, "left_semi")
        ending.drop("gone").withColumn("valid_to_seq", F.lit(seq).cast("long")).write.parquet(f"{path}/closed")

        staying = before.join(changed.select(*self.keys), self.keys, "left_anti")
        coming = candidate.join(changed.where("change_type <> 'REMOVE'").select(*self.keys), self.keys, "left_semi").withColumn("gone", F.lit(False))
        going = before.join(changed.where("change_type = 'REMOVE'").select(*self.keys), self.keys, "left_semi").withColumn("gone", F.lit(True))
        dated = lambda df: df.withColumn("valid_from_seq", F.lit(seq).cast("long"))
        rows = staying.unionByName(dated(coming)).unionByName(dated(going.drop("valid_from_seq"))).withColumn("bucket", self.bucket(buckets))
        rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/open")

        folders = dict(base.folders) if same_deal else {}
        # a bucket without any key has no folder
        written = self._written(f"{path}/open")
        folders |= {str(b): folder for b in touched if b in written}
        commit = Commit(base.number + 1 if base else 1, seq, digest, folder, buckets, keys, schema, counts, folders)
        self._add(commit)
        return commit

    def _written(self, path: str) -> set[int]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        names = [s.getPath().getName() for s in p.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(p)]
        return {int(n.partition("=")[2]) for n in names if n.startswith("bucket=")}

    # --- keeping house

    def sweep(self, older_than_s: float = 86_400) -> list[str]:
        """Delete what no reader needs: folders of publishes that never committed, and open rows that newer ones replaced.

        Folders younger than the given time stay, as they may belong to a publish that is under way.
        """
        found = self._known()
        jvm, _, fs = self._files()
        data = jvm.org.apache.hadoop.fs.Path(f"{self.root}/data")
        committed, used = {c.folder for c in found}, set(found[-1].folders.values())
        now, gone = jvm.System.currentTimeMillis(), []
        for s in fs.listStatus(data):
            name = s.getPath().getName()
            if now - s.getModificationTime() < older_than_s * 1000:
                continue
            if name not in committed:
                gone.append(f"{self.root}/data/{name}")
            elif name not in used and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "open")):
                gone.append(f"{self.root}/data/{name}/open")
        for p in gone:
            drop_path(self.spark, p)
        return gone


def history(commits: Sequence[Commit]) -> list[tuple]:
    """(number, seq, keys, added, changed, removed, relisted) of committed versions."""
    return [(c.number, c.seq, c.keys, c.counts["ADD"], c.counts["CHANGE"], c.counts["REMOVE"], c.counts["RELIST"]) for c in commits]
