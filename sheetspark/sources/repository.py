"""A stored data set of typed sheets: commits that detect conflicts, schema edits and snapshots.

Everything is only ever added to::

    moves/<branch>/<n>                            where a branch is after its n-th move
    commits/commit_id=<id>/                       parent, title, depth, skips, last_seq
    log/commit_id=<id>/                           sheets created and deleted, columns changed
    edits/<sheet>/<epoch>/commit_id=<id>/         edits in the types of their epoch
    snapshots/<sheet>/<epoch>/commit_id=<id>/     rows at a commit

A commit is published by its move: a file that is created only if there is none of that name.  Of two
commits on one head the second finds the file and is refused.  A commit that broke off before its move
is on no branch; writing it again replaces what it had written, so no edit counts twice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark.operators import lineage, versions
from sheetspark.operators.evolution import LOG, Change, SheetSchema, stored_edits, upgraded
from sheetspark.sources.claims import Conflict, claim, exists

COMMITS = (
    "parent_id string, branch string, title string, committed_at timestamp_ntz, "
    "depth bigint, skips array<string>, last_seq bigint, commit_id string"
)
SNAPSHOT_LOG = "sheet string, epoch string, seq bigint, commit_id string"


@dataclass(frozen=True)
class CreateSheet:
    """Create a sheet, or replace the one that is there."""

    sheet: str
    schema: T.StructType


@dataclass(frozen=True)
class DeleteSheet:
    sheet: str


@dataclass(frozen=True)
class AddColumn:
    sheet: str
    index: int
    name: str
    declared: Any


@dataclass(frozen=True)
class RenameColumn:
    sheet: str
    old: str
    new: str


@dataclass(frozen=True)
class RetypeColumn:
    sheet: str
    name: str
    declared: Any


@dataclass(frozen=True)
class DropColumn:
    sheet: str
    name: str


@dataclass(frozen=True)
class Edits:
    """Edits of rows: ``record_key``, ``op``, ``seq``, ``set`` and columns of the sheet."""

    sheet: str
    rows: DataFrame


@dataclass
class Prepared:
    """A commit that is written but not published."""

    branch: str
    commit_id: str
    move: int
    rows: list[tuple] = field(default_factory=list)


class _Line:
    """The commits of a chain; listed if they are few enough to be literals in a plan."""

    def __init__(self, frame: DataFrame, few: dict[str, int] | None = None):
        if few is None:
            rows = frame.limit(versions.LITERAL_CHAIN + 1).collect()
            if len(rows) <= versions.LITERAL_CHAIN:
                few = {r["commit_id"]: r["distance"] for r in rows}
        self.frame, self.few = frame, few

    def within(self, low: int, high: int) -> _Line:
        """The commits at distances from ``low`` to below ``high``."""
        few = None
        if self.few is not None:
            few = {c: d for c, d in self.few.items() if low <= d < high}
        return _Line(self.frame.where((F.col("distance") >= low) & (F.col("distance") < high)), few)

    def of(self, df: DataFrame) -> DataFrame:
        """Rows of these commits: folders are pruned by literals, or joined for a long chain."""
        if self.few is not None:
            return df.where(F.col("commit_id").isin(list(self.few)))
        return df.join(self.frame.select("commit_id"), "commit_id").select(*df.columns)


def _folder(name: str) -> str:
    """A name that any file system takes."""
    return hashlib.sha1(name.encode()).hexdigest()


class Repository:
    """A data set in a folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, name: str) -> bool:
        return exists(self.spark, f"{self.root}/{name}")

    def _table(self, name: str, schema: str) -> DataFrame:
        if not self._exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    # Branches and commits.

    def _moves(self, branch: str | None = None) -> DataFrame:
        """``branch, move, commit_id`` of all moves or of those of a branch."""
        folder = "*" if branch is None else _folder(branch)
        if not self._exists("moves" if branch is None else f"moves/{folder}"):
            return self.spark.createDataFrame([], "branch string, move bigint, commit_id string")
        lines = self.spark.read.text(f"{self.root}/moves/{folder}")
        parts = F.split(F.input_file_name(), "/")
        value = F.from_json("value", "branch string, commit_id string")
        return lines.select(
            value["branch"].alias("branch"),
            F.element_at(parts, -1).cast("bigint").alias("move"),
            value["commit_id"].alias("commit_id"),
        )

    def _move(self, branch: str, number: int, commit_id: str | None) -> None:
        line = T.StructType().add("branch", "string").add("commit_id", "string")
        text = self.spark.createDataFrame([(branch, commit_id)], line).select(F.to_json(F.struct("*")))
        claim(self.spark, f"{self.root}/moves/{_folder(branch)}/{number:020}", text.first()[0])

    def create_branch(self, branch: str, at: str | None = None) -> None:
        """A branch at a revision, or without any commit; refused if the branch exists."""
        self._move(branch, 0, None if at is None else self.resolve(at))

    def head(self, branch: str) -> tuple[str | None, int]:
        """The commit that a branch is at, and the number of its last move."""
        last = self._moves(branch).agg(F.max_by(F.struct("commit_id", "move"), "move").alias("m")).first()["m"]
        if last is None:
            raise LookupError(f"branch {branch!r} does not exist")
        return last["commit_id"], last["move"]

    def commits(self) -> DataFrame:
        """The published commits."""
        named = self._moves().select("commit_id").distinct()
        return self._table("commits", COMMITS).join(named, "commit_id", "left_semi")

    def unfinished(self) -> DataFrame:
        """Commits that were written but never published."""
        return self._table("commits", COMMITS).join(self._moves(), "commit_id", "left_anti")

    def resolve(self, revision: str) -> str:
        """The commit of a branch, or a published commit."""
        if not self.commits().where(F.col("commit_id") == revision).isEmpty():
            return revision
        commit_id, _ = self.head(revision)
        if commit_id is None:
            raise LookupError(f"branch {revision!r} has no commit")
        return commit_id

    def chain(self, revision: str) -> DataFrame:
        """The commits of a revision with their ``distance`` from it, by their skips."""
        return lineage.chain(self.commits(), self.resolve(revision))

    # Writing.

    def prepare(
        self, branch: str, commit_id: str, title: str, committed_at: str, changes: Sequence[Any]
    ) -> Prepared:
        """Write a commit on the head of a branch without publishing it."""
        if not changes:
            raise ValueError("cannot commit without any modifications")
        if not re.fullmatch(r"[A-Za-z0-9._@-]+", commit_id):
            raise ValueError(f"commit id {commit_id!r} does not name a folder")
        head, move = self.head(branch)
        if not self._moves().where(F.col("commit_id") == commit_id).isEmpty():
            raise ValueError(f"commit {commit_id!r} exists")
        parent = None
        if head is not None:
            known = self._table("commits", COMMITS)
            parent = known.where(F.col("commit_id") == head).first()

            def skips_of(ancestor: str) -> list[str]:
                return known.where(F.col("commit_id") == ancestor).first()["skips"]

            entry = (head, parent["depth"], parent["skips"])
            depth, skips = lineage.next_entry(entry, skips_of)
        else:
            depth, skips = 0, []
        seq = parent["last_seq"] + 1 if parent else 0
        sheets: dict[str, SheetSchema] = {}
        epochs: dict[str, str] = {}
        prepared, frames = Prepared(branch, commit_id, move + 1), {}
        log = None if head is None else self._log(self._line(head))
        for change in changes:
            sheet = change.sheet
            if sheet not in sheets:
                rows = [] if log is None else log.where(F.col("sheet") == sheet).collect()
                sheets[sheet] = SheetSchema.of(rows)
                epochs[sheet] = max(((r["seq"], self._epoch(r["commit_id"], r["seq"])) for r in rows), default=(0, ""))[1]
            schema = sheets[sheet]
            if not schema.exists and not isinstance(change, CreateSheet):
                raise LookupError(f"sheet {sheet!r} does not exist")
            if isinstance(change, Edits):
                size = change.rows.agg(F.max("seq")).first()[0]
                if size is not None:
                    frame = stored_edits(change.rows, schema, seq)
                    frames.setdefault((sheet, epochs[sheet]), []).append(frame)
                    seq += size + 1
                continue
            for step in self._steps(schema, change):
                schema.apply(step, seq)
                prepared.rows.append(step.row(sheet, seq))
                epochs[sheet] = self._epoch(commit_id, seq)
                seq += 1
        for (sheet, epoch), parts in frames.items():
            rows = parts[0]
            for part in parts[1:]:
                rows = rows.unionByName(part)
            rows.write.mode("overwrite").parquet(self._edits(sheet, epoch) + f"/commit_id={commit_id}")
        if prepared.rows:
            rows = self.spark.createDataFrame(prepared.rows, LOG)
            rows.write.mode("overwrite").parquet(f"{self.root}/log/commit_id={commit_id}")
        row = self.spark.range(1).select(
            F.lit(head).cast("string").alias("parent_id"),
            F.lit(branch).alias("branch"),
            F.lit(title).alias("title"),
            F.lit(committed_at).cast("timestamp_ntz").alias("committed_at"),
            F.lit(depth).cast("bigint").alias("depth"),
            F.array(*map(F.lit, skips)).cast("array<string>").alias("skips"),
            F.lit(seq - 1).cast("bigint").alias("last_seq"),
        )
        row.write.mode("overwrite").parquet(f"{self.root}/commits/commit_id={commit_id}")
        return prepared

    def publish(self, prepared: Prepared) -> None:
        """Move the branch to a prepared commit; refused if the branch has moved since."""
        try:
            self._move(prepared.branch, prepared.move, prepared.commit_id)
        except Conflict:
            raise Conflict(
                f"branch {prepared.branch!r} has moved; prepare {prepared.commit_id!r} again"
            ) from None

    def commit(
        self, branch: str, commit_id: str, title: str, committed_at: str, changes: Sequence[Any]
    ) -> None:
        self.publish(self.prepare(branch, commit_id, title, committed_at, changes))

    @staticmethod
    def _steps(schema: SheetSchema, change: Any) -> list[Change]:
        if isinstance(change, CreateSheet):
            return schema.created(change.schema)
        if isinstance(change, DeleteSheet):
            return [Change("delete")]
        if isinstance(change, AddColumn):
            return [schema.inserted(change.index, change.name, change.declared)]
        if isinstance(change, RenameColumn):
            return [schema.renamed(change.old, change.new)]
        if isinstance(change, RetypeColumn):
            return [schema.retyped(change.name, change.declared)]
        if isinstance(change, DropColumn):
            return [schema.dropped(change.name)]
        raise TypeError(f"{change!r} is no change")

    @staticmethod
    def _epoch(commit_id: str, seq: int) -> str:
        return f"{seq:020}-{_folder(commit_id)}"

    def _edits(self, sheet: str, epoch: str) -> str:
        return f"{self.root}/edits/{_folder(sheet)}/{epoch}"

    # Reading.

    def _line(self, commit_id: str) -> _Line:
        return _Line(lineage.chain(self._table("commits", COMMITS), commit_id))

    def _log(self, line: _Line) -> DataFrame:
        """The log along a chain."""
        return line.of(self._table("log", LOG + ", commit_id string"))

    def sheets(self, revision: str) -> DataFrame:
        """The sheets of a revision."""
        return versions.sheet_set(self._log(self._line(self.resolve(revision)))).select("sheet")

    def schema(self, revision: str, sheet: str) -> T.StructType:
        return self._sheet(self._line(self.resolve(revision)), sheet)[0].struct()

    def _sheet(self, line: _Line, sheet: str) -> tuple[SheetSchema, list[tuple[int, str]]]:
        """The schema of a sheet at the end of a chain, and the epochs of its lifetime."""
        rows = self._log(line).where(F.col("sheet") == sheet).collect()
        schema = SheetSchema.of(rows)
        if not schema.exists:
            raise LookupError(f"sheet {sheet!r} does not exist")
        epochs = [(r["seq"], self._epoch(r["commit_id"], r["seq"])) for r in rows if r["seq"] >= schema.since]
        return schema, epochs

    def _upgraded(
        self, folder: str, line: _Line, schema: SheetSchema, epochs: list[tuple[int, str]]
    ) -> DataFrame | None:
        """What the chain's commits have written to the epochs of a sheet, in its schema now."""
        found = None
        for seq, epoch in epochs:
            if not self._exists(f"{folder}/{epoch}"):
                continue
            path = f"{self.root}/{folder}/{epoch}"
            written = self.spark.read.parquet(path).schema  # which may take an id for a number
            fields = [f for f in written.fields if f.name != "commit_id"]
            text = T.StructField("commit_id", T.StringType())
            rows = self.spark.read.schema(T.StructType([*fields, text])).parquet(path)
            rows = upgraded(line.of(rows), seq, schema)
            found = rows if found is None else found.unionByName(rows)
        return found

    def read(self, revision: str, sheet: str) -> DataFrame:
        """``record_key`` and the columns of a sheet at a revision, in its schema there.

        The rows of the nearest ancestor with a stored snapshot of the sheet's lifetime are the adds
        that the edits since then follow; without one, all its edits are read.
        """
        return self._read(self._line(self.resolve(revision)), sheet)

    def _read(self, line: _Line, sheet: str) -> DataFrame:
        schema, epochs = self._sheet(line, sheet)
        edits, since, base = None, line, self._nearest(sheet, line, schema)
        if base is not None:
            distance = base["distance"]
            kept = [(seq, epoch) for seq, epoch in epochs if epoch == base["epoch"]]
            at = line.within(distance, distance + 1)
            edits = self._upgraded(f"snapshots/{_folder(sheet)}", at, schema, kept)
            since = line.within(0, distance)
        later = self._upgraded(f"edits/{_folder(sheet)}", since, schema, epochs)
        if edits is None or later is None:
            edits = later if edits is None else edits
        else:
            edits = edits.unionByName(later)
        if edits is None:
            names = T.StructType([T.StructField("record_key", T.StringType()), *schema.struct().fields])
            return self.spark.createDataFrame([], names)
        return versions.fold(edits)

    def _nearest(self, sheet: str, line: _Line, schema: SheetSchema):
        """The nearest commit of a chain with a snapshot of this lifetime of a sheet, or None."""
        if not self._exists("snapshot_log"):
            return None
        log = self._table("snapshot_log", SNAPSHOT_LOG)
        own = log.where((F.col("sheet") == sheet) & (F.col("seq") >= schema.since))
        return own.join(line.frame, "commit_id").orderBy("distance").first()

    def store_snapshot(self, revision: str, sheet: str) -> None:
        """Store the rows of a sheet at a revision, from the nearest snapshot and the edits since.

        Reading the commit and those after it then costs the edits since.
        """
        commit_id = self.resolve(revision)
        line = self._line(commit_id)
        schema, epochs = self._sheet(line, sheet)
        last = self._table("commits", COMMITS).where(F.col("commit_id") == commit_id).first()["last_seq"]
        rows = self._read(line, sheet)
        adds = stored_edits(rows.select("*", F.lit("add").alias("op"), F.lit(0).alias("seq")), schema, last)
        epoch = max(epochs)[1]
        adds.write.mode("overwrite").parquet(
            f"{self.root}/snapshots/{_folder(sheet)}/{epoch}/commit_id={commit_id}"
        )
        row = self.spark.range(1).select(
            F.lit(sheet).alias("sheet"), F.lit(epoch).alias("epoch"), F.lit(last).cast("bigint").alias("seq")
        )
        row.write.mode("overwrite").parquet(
            f"{self.root}/snapshot_log/commit_id={commit_id}/of={_folder(sheet)}"
        )
