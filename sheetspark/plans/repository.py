"""A stored data set of two typed sheets, made from the events in three commits.

``users``: a signup adds a user (or replaces all columns), a purchase updates one column, an error
deletes.  Until day 10 its columns are value and props; then score comes first and props is called
detail; from day 21 on score is a string and value is gone.  ``views``: a view adds a row of its
user; from day 21 on n is a string, and note, dropped and added again, is another column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark import schema as schemas
from sheetspark.operators import lineage
from sheetspark.plans.history import LOG_SQL, commit_log
from sheetspark.plans.inputs import table
from sheetspark.plans.registry import query
from sheetspark.runtime import fresh_path
from sheetspark.sources.repository import (
    AddColumn,
    CreateSheet,
    DropColumn,
    Edits,
    RenameColumn,
    Repository,
    RetypeColumn,
)

FIRST, SECOND = 10, 20


def _edits(events: DataFrame, updated: str, **values: Column) -> DataFrame:
    kind = F.col("event_type")
    return events.where(kind.isin("signup", "purchase", "error")).select(
        F.col("user_id").cast("string").alias("record_key"),
        F.when(kind == "signup", "add").when(kind == "error", "delete").otherwise("update").alias("op"),
        F.col("event_id").alias("seq"),
        F.array(F.lit(updated)).alias("set"),
        *[v.alias(n) for n, v in values.items()],
    )


def _views(events: DataFrame, number: Column, note: Column) -> DataFrame:
    return events.where(F.col("event_type") == "view").select(
        F.col("user_id").cast("string").alias("record_key"),
        F.lit("add").alias("op"),
        F.col("event_id").alias("seq"),
        number.alias("n"),
        note.alias("note"),
    )


def build(spark: SparkSession, folder: str, compact: bool = False) -> Repository:
    events = table(spark, folder, "events")
    day = F.dayofmonth("ts")
    first, second, third = (
        events.where(day.between(*span)) for span in ((1, FIRST), (FIRST + 1, SECOND), (SECOND + 1, 31))
    )
    value, props = F.col("value"), F.col("props")
    score = F.floor("value").cast("int")
    found = Repository(spark, fresh_path(spark, "repository"))
    found.create_branch("main")
    found.commit("main", "c1", "two sheets", "2024-01-10", [
        CreateSheet("users", schemas.record(value="float64", props="string")),
        CreateSheet("views", schemas.record(n="int64", note="string")),
        Edits("users", _edits(first, "value", value=value, props=props)),
        Edits("views", _views(first, F.col("event_id"), props)),
    ])
    found.commit("main", "c2", "score", "2024-01-20", [
        AddColumn("users", 0, "score", "int32"),
        RenameColumn("users", "props", "detail"),
        Edits("users", _edits(second, "score", score=score, value=value, detail=props)),
        Edits("views", _views(second, F.col("event_id"), props)),
    ])
    if compact:
        found.store_snapshot("c1", "users")
        found.store_snapshot("c2", "users")
    text = F.concat(F.lit("v"), F.col("event_id").cast("string"))
    found.commit("main", "c3", "text", "2024-01-31", [
        RetypeColumn("users", "score", "string"),
        DropColumn("users", "value"),
        RetypeColumn("views", "n", "string"),
        DropColumn("views", "note"),
        AddColumn("views", 1, "note", "float64"),
        Edits("users", _edits(third, "score", score=text, detail=props)),
        Edits("views", _views(third, text, value)),
    ])
    return found


_USERS_SQL = f"""
log AS (
  SELECT *, CAST(user_id AS VARCHAR) AS record_key, day(ts) AS d FROM events
  WHERE event_type IN ('signup', 'purchase', 'error')),
ends AS (
  SELECT record_key, max(CASE WHEN event_type = 'signup' THEN event_id END) AS la,
    max(CASE WHEN event_type = 'error' THEN event_id END) AS ld FROM log GROUP BY record_key),
live AS (
  SELECT log.* FROM log JOIN ends USING (record_key)
  WHERE la IS NOT NULL AND (ld IS NULL OR la > ld) AND event_id >= la),
scored AS (
  SELECT record_key, CASE WHEN d <= {FIRST} THEN NULL
    WHEN d <= {SECOND} THEN CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) ELSE 'v' || event_id END AS score
  FROM live WHERE event_type = 'signup' OR d > {FIRST}
  QUALIFY row_number() OVER (PARTITION BY record_key ORDER BY event_id DESC) = 1),
last_users AS (
  SELECT record_key, score, props AS detail FROM scored JOIN live USING (record_key)
  WHERE event_type = 'signup')
"""


@query(
    f"""WITH log AS (
      SELECT *, CAST(user_id AS VARCHAR) AS record_key FROM events
      WHERE event_type IN ('signup', 'purchase', 'error') AND day(ts) <= {FIRST}),
    ends AS (
      SELECT record_key, max(CASE WHEN event_type = 'signup' THEN event_id END) AS la,
        max(CASE WHEN event_type = 'error' THEN event_id END) AS ld FROM log GROUP BY record_key)
    SELECT record_key, arg_max(value, event_id) AS value,
      arg_max(CASE WHEN event_type = 'signup' THEN props END, event_id) AS props
    FROM log JOIN ends USING (record_key)
    WHERE la IS NOT NULL AND (ld IS NULL OR la > ld) AND event_id >= la GROUP BY record_key"""
)
def schema_before(spark: SparkSession, folder: str) -> DataFrame:
    """A sheet at a commit before its schema was edited, in the schema that it had."""
    return build(spark, folder).read("c1", "users")


@query(f"WITH {_USERS_SQL} SELECT record_key, score, detail FROM last_users")
def schema_after(spark: SparkSession, folder: str) -> DataFrame:
    """The same sheet with a column inserted, one renamed, one retyped and one dropped."""
    return build(spark, folder).read("main", "users")


@query(
    f"""SELECT CAST(user_id AS VARCHAR) AS record_key,
      CASE WHEN day(ts) > {SECOND} THEN 'v' || event_id ELSE CAST(event_id AS VARCHAR) END AS n,
      CASE WHEN day(ts) > {SECOND} THEN value END AS note
    FROM events WHERE event_type = 'view'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""
)
def schema_of_another_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """The other sheet of the same commits: a column that was dropped and added again starts anew."""
    return build(spark, folder).read("main", "views")


@query(f"WITH {_USERS_SQL} SELECT record_key, score, detail FROM last_users")
def snapshot_store(spark: SparkSession, folder: str) -> DataFrame:
    """A head read from the nearest of two stored snapshots and the edits since."""
    return build(spark, folder, compact=True).read("main", "users")


def _asked(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    day = F.col("ts").cast("date")
    dev = (day > F.lit("2024-01-10").cast("date")) & (F.col("user_id") % 3 == 0)
    number = F.lpad((F.col("user_id") % 31 + 1).cast("string"), 2, "0")
    return events.select(
        F.concat(F.when(F.col("user_id") % 5 == 0, "dev@2024-01-").otherwise("main@2024-01-"), number).alias(
            "ancestor_id"
        ),
        F.concat(F.when(dev, "dev@").otherwise("main@"), day.cast("string")).alias("commit_id"),
        (F.col("user_id") % 37).cast("bigint").alias("distance"),
    )


_PAIRS_SQL = f"""
{LOG_SQL},
asked AS (
  SELECT CASE WHEN user_id % 5 = 0 THEN 'dev@2024-01-' ELSE 'main@2024-01-' END
    || lpad(CAST(user_id % 31 + 1 AS VARCHAR), 2, '0') AS ancestor_id, commit_id, user_id % 37 AS distance
  FROM edits),
above AS (
  SELECT commit_id, commit_id AS reached, parent_id, 0 AS steps FROM commits
  UNION ALL
  SELECT above.commit_id, c.commit_id, c.parent_id, steps + 1
  FROM above JOIN commits c ON c.commit_id = above.parent_id)
"""


@query(
    f"""WITH RECURSIVE {_PAIRS_SQL}
    SELECT DISTINCT asked.ancestor_id AS ancestor_id, asked.commit_id AS commit_id,
      above.reached IS NOT NULL AS is_ancestor
    FROM asked LEFT JOIN above ON above.commit_id = asked.commit_id AND reached = ancestor_id"""
)
def ancestor_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """For very many pairs of commits at once, whether one descends from the other."""
    index = lineage.ancestor_index(commit_log(spark, folder))
    asked = _asked(spark, folder).select("ancestor_id", "commit_id").distinct()
    return lineage.is_ancestor(asked, index)


@query(
    f"""WITH RECURSIVE {_PAIRS_SQL}
    SELECT DISTINCT asked.commit_id AS commit_id, distance, above.reached AS ancestor_id
    FROM asked LEFT JOIN above ON above.commit_id = asked.commit_id AND steps = distance"""
)
def ancestor_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The commits that lie given numbers of commits back from others."""
    index = lineage.ancestor_index(commit_log(spark, folder))
    asked = _asked(spark, folder).select("commit_id", "distance").distinct()
    return lineage.ancestor_at(asked, index)


@query(
    f"""WITH RECURSIVE {_PAIRS_SQL}
    SELECT reached AS commit_id, CAST(steps AS BIGINT) AS distance FROM above WHERE commit_id = 'dev@2024-01-25'"""
)
def ancestor_chain(spark: SparkSession, folder: str) -> DataFrame:
    """The chain of a commit from the index of ancestors."""
    return lineage.chain(lineage.ancestor_index(commit_log(spark, folder)), "dev@2024-01-25")
