"""Versioned sheets over a change log made from the events.

Key ``user_id``, seq ``event_id``.  A signup adds the user (or replaces all its
columns), an error deletes it, a purchase updates the value, a click updates the
value and empties the props, a view updates the props.  The commit is the day;
days after the tenth exist on two branches, ``main`` and ``dev``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark import schema as schemas
from sheetspark.operators import columns, order, versions
from sheetspark.operators.query import search
from sheetspark.plans.inputs import table
from sheetspark.plans.registry import query
from sheetspark.runtime import fresh_path
from sheetspark.sources import history as stored_history
from sheetspark.sources.sheets import read_sheet, write_sheet

FORK = "2024-01-10"
COLS = schemas.record(value="float64", props="string", event_type="string")


def _day() -> Column:
    return F.col("ts").cast("date")


def _branch() -> Column:
    return F.when((_day() > F.lit(FORK).cast("date")) & (F.col("user_id") % 3 == 0), "dev").otherwise("main")


def _commit_id(branch: Column, day: Column) -> Column:
    return F.concat(branch, F.lit("@"), day.cast("string"))


def edit_log(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    props = F.when(kind == "click", F.lit(None)).otherwise(F.col("props"))
    supplied = (
        F.when(kind == "purchase", F.array(F.lit("value")))
        .when(kind == "click", F.array(F.lit("value"), F.lit("props")))
        .otherwise(F.array(F.lit("props")))
    )
    return table(spark, folder, "events").select(
        _commit_id(_branch(), _day()).alias("commit_id"),
        F.concat(F.lit("sheet-"), (F.col("user_id") % 4).cast("string")).alias("sheet"),
        F.col("event_id").alias("seq"),
        F.when(kind == "signup", "add").when(kind == "error", "delete").otherwise("update").alias("op"),
        F.col("user_id").alias("record_key"),
        versions.edit_record(COLS, value=F.col("value"), props=props, event_type=kind).alias("cols"),
        supplied.alias("set"),
    )


def commit_log(spark: SparkSession, folder: str) -> DataFrame:
    """One commit per branch and day on which something happened."""
    days = table(spark, folder, "events").select(_branch().alias("branch"), _day().alias("day"))
    first_dev = F.col("day") == F.date_add(F.lit(FORK).cast("date"), 1)
    parent_branch = F.when(first_dev, "main").otherwise(F.col("branch"))
    commits = days.groupBy("branch", "day").agg(F.count(F.lit(1)).alias("edits"))
    previous = commits.select(
        _commit_id(F.col("branch"), F.col("day")).alias("parent_id"), F.lit(True).alias("exists")
    )
    return (
        commits.withColumn("parent_id", _commit_id(parent_branch, F.date_sub("day", 1)))
        .join(previous, "parent_id", "left")
        .select(
            _commit_id(F.col("branch"), F.col("day")).alias("commit_id"),
            F.when(F.col("exists"), F.col("parent_id")).alias("parent_id"),
            "branch",
            F.concat(F.col("edits").cast("string"), F.lit(" edits")).alias("title"),
            F.col("day").cast("timestamp_ntz").alias("committed_at"),
        )
    )


def ref_log(spark: SparkSession, folder: str) -> DataFrame:
    """The branches, and a tag on every commit."""
    commits = commit_log(spark, folder)
    branches = commits.groupBy(F.col("branch").alias("name")).agg(
        F.max("commit_id").alias("commit_id")
    )
    tagged = commits.select(F.concat(F.lit("v-"), F.col("commit_id")).alias("name"), "commit_id")
    return branches.select("name", F.lit("branch").alias("kind"), "commit_id").unionByName(
        tagged.select("name", F.lit("tag").alias("kind"), "commit_id")
    )


LOG_SQL = f"""
log AS (
  SELECT *, CAST(ts AS DATE) AS day, 'sheet-' || (user_id % 4) AS sheet,
    CASE WHEN CAST(ts AS DATE) > DATE '{FORK}' AND user_id % 3 = 0 THEN 'dev' ELSE 'main' END AS branch
  FROM events),
edits AS (
  SELECT *, branch || '@' || day AS commit_id, event_id AS seq,
    CASE WHEN event_type = 'click' THEN NULL ELSE props END AS new_props,
    event_type IN ('signup', 'purchase', 'click') AS sets_value,
    event_type IN ('signup', 'view', 'click') AS sets_props
  FROM log),
days AS (SELECT branch, day, count(*) AS n_edits FROM log GROUP BY branch, day),
commits AS (
  SELECT d.branch || '@' || d.day AS commit_id, d.branch AS branch, d.day AS day, d.n_edits AS n_edits,
    p.branch || '@' || p.day AS parent_id
  FROM days d LEFT JOIN days p ON p.day = d.day - 1 AND p.branch =
    CASE WHEN d.day = DATE '{FORK}' + 1 THEN 'main' ELSE d.branch END),
refs AS (
  SELECT branch AS name, 'branch' AS kind, max(commit_id) AS commit_id FROM commits GROUP BY branch
  UNION ALL SELECT 'v-' || commit_id, 'tag', commit_id FROM commits)
"""


def _chain_sql(commit: str) -> str:
    return f"""
chain AS (
  SELECT commit_id, parent_id, 0 AS distance FROM commits WHERE commit_id = {commit}
  UNION ALL
  SELECT c.commit_id, c.parent_id, chain.distance + 1 FROM commits c JOIN chain
    ON c.commit_id = chain.parent_id)"""


def _fold_sql(edits: str, out: str) -> str:
    """The rows left by the edits of a table, by first principles: last add, last delete, last set."""
    return f"""
{out}_ends AS (
  SELECT user_id, max(CASE WHEN event_type = 'signup' THEN seq END) AS la,
    max(CASE WHEN event_type = 'error' THEN seq END) AS ld FROM {edits} GROUP BY user_id),
{out}_live AS (
  SELECT e.* FROM {edits} e JOIN {out}_ends x ON e.user_id = x.user_id
  WHERE x.la IS NOT NULL AND (x.ld IS NULL OR x.la > x.ld) AND e.seq >= x.la),
{out}_value AS (SELECT user_id, value FROM {out}_live WHERE sets_value
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) = 1),
{out}_props AS (SELECT user_id, new_props FROM {out}_live WHERE sets_props
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) = 1),
{out} AS (
  SELECT v.user_id AS record_key, v.value AS value, p.new_props AS props, 'signup' AS event_type
  FROM {out}_value v JOIN {out}_props p ON v.user_id = p.user_id)"""


_ON_DEV = """dev_chain AS (
  SELECT e.* FROM edits e JOIN chain c ON e.commit_id = c.commit_id)"""


@query(
    f"""WITH RECURSIVE {LOG_SQL}, {_chain_sql("'dev@2024-01-25'")}, {_ON_DEV},
    {_fold_sql("dev_chain", "folded")}
    SELECT * FROM folded"""
)
def snapshot_at(spark: SparkSession, folder: str) -> DataFrame:
    return versions.snapshot(
        edit_log(spark, folder).withColumn("sheet", F.lit("users")),
        commit_log(spark, folder),
        "dev@2024-01-25",
        sheet="users",
    )


@query(
    f"""WITH RECURSIVE {LOG_SQL}, {_chain_sql("'dev@2024-01-25'")}, {_ON_DEV},
    {_fold_sql("dev_chain", "folded")}
    SELECT * FROM folded"""
)
def snapshot_from_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows from the stored snapshot of an ancestor and the edits since."""
    ops, commits = edit_log(spark, folder), commit_log(spark, folder)
    root = fresh_path(spark, "snapshots")
    write_sheet(
        versions.snapshot(
            ops.withColumn("sheet", F.lit("users")), commits, "main@2024-01-10", sheet="users"
        ),
        root,
        "users",
    )
    kept = read_sheet(spark, root, "users")
    return versions.snapshot_from(kept, "main@2024-01-10", ops, commits, "dev@2024-01-25")


@query(
    f"""WITH {LOG_SQL}, main_edits AS (SELECT * FROM edits WHERE branch = 'main'),
    {_fold_sql("main_edits", "folded")}
    SELECT 'sheet-' || (record_key % 4) AS sheet, count(*) AS record_count FROM folded GROUP BY ALL"""
)
def snapshot_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Record counts of every sheet of a revision."""
    commits, refs = commit_log(spark, folder), ref_log(spark, folder)
    head = versions.resolve(commits, refs, "main")
    rows = versions.snapshot(edit_log(spark, folder), commits, head)
    return rows.groupBy("sheet").agg(F.count(F.lit(1)).alias("record_count"))


def sheet_log(spark: SparkSession, folder: str) -> DataFrame:
    """Forty sheets, each created before its first edit; dear sign-ups replace and dear errors delete one."""
    events = table(spark, folder, "events")
    sheet = F.concat(F.lit("sheet-"), (F.col("user_id") % 40).cast("string"))
    first = events.groupBy(sheet.alias("sheet")).agg(
        F.min_by(_commit_id(_branch(), _day()), "event_id").alias("commit_id"),
        (F.min("event_id") - 1).alias("seq"),
    )
    dear = F.col("value") > 97
    op = F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "error", "delete")
    later = events.where(dear & op.isNotNull()).select(
        sheet.alias("sheet"),
        _commit_id(_branch(), _day()).alias("commit_id"),
        F.col("event_id").alias("seq"),
        op.alias("op"),
    )
    return first.withColumn("op", F.lit("create")).unionByName(later)


_LIVES_SQL = """
sheet_ops AS (
  SELECT 'sheet-' || (user_id % 40) AS sheet, min_by(commit_id, seq) AS commit_id, min(seq) - 1 AS seq,
    'create' AS op FROM edits GROUP BY 1
  UNION ALL
  SELECT 'sheet-' || (user_id % 40), commit_id, seq,
    CASE event_type WHEN 'signup' THEN 'create' ELSE 'delete' END
  FROM edits WHERE value > 97 AND event_type IN ('signup', 'error')),
lives AS (
  SELECT sheet, max(CASE WHEN op = 'create' THEN seq END) AS since,
    max(CASE WHEN op = 'delete' THEN seq END) AS gone
  FROM sheet_ops JOIN chain USING (commit_id) GROUP BY sheet),
lived AS (
  SELECT e.* FROM edits e JOIN chain USING (commit_id)
  JOIN lives ON lives.sheet = 'sheet-' || (user_id % 40)
  WHERE since IS NOT NULL AND (gone IS NULL OR since > gone) AND e.seq > since)"""


def _forty_sheets(spark: SparkSession, folder: str) -> DataFrame:
    number = (F.col("record_key") % 40).cast("string")
    return edit_log(spark, folder).withColumn("sheet", F.concat(F.lit("sheet-"), number))


@query(
    f"""WITH RECURSIVE {LOG_SQL}, {_chain_sql("'dev@2024-01-25'")}, {_LIVES_SQL},
    {_fold_sql("lived", "folded")}
    SELECT 'sheet-' || (record_key % 40) AS sheet, * FROM folded"""
)
def replaced_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """All sheets at a commit, of which some were deleted and some created again."""
    return versions.snapshot(
        _forty_sheets(spark, folder),
        commit_log(spark, folder),
        "dev@2024-01-25",
        sheet_ops=sheet_log(spark, folder),
    )


@query(
    f"""WITH RECURSIVE {LOG_SQL}, {_chain_sql("'main@2024-01-20'")}, {_LIVES_SQL},
    {_fold_sql("lived", "folded")},
    counted AS (SELECT 'sheet-' || (record_key % 40) AS sheet, count(*) AS n FROM folded GROUP BY 1)
    SELECT lives.sheet AS sheet, coalesce(n, 0)::BIGINT AS record_count
    FROM lives LEFT JOIN counted ON counted.sheet = lives.sheet
    WHERE since IS NOT NULL AND (gone IS NULL OR since > gone)"""
)
def live_sheet_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Record counts of the sheets that exist at a commit, those without a row too."""
    return versions.record_counts(
        _forty_sheets(spark, folder),
        commit_log(spark, folder),
        "main@2024-01-20",
        sheet_log(spark, folder),
    )


@query(
    f"""WITH RECURSIVE {LOG_SQL}, {_chain_sql("'main@2024-01-20'")}, {_ON_DEV},
    {_fold_sql("dev_chain", "folded")}
    SELECT record_key, value AS result_value, value * 2 AS result_doubled FROM folded
    WHERE value > 20 AND record_key % 4 = 1"""
)
def search_at_revision(spark: SparkSession, folder: str) -> DataFrame:
    """A saved search on one sheet, at the commit that a tag stands for."""
    rows = versions.read_revision(
        edit_log(spark, folder),
        commit_log(spark, folder),
        ref_log(spark, folder),
        "v-main@2024-01-20",
        "sheet-1",
    )
    criteria = {
        "where": {"$gt": ["$.value", 20]},
        "select": [
            "$.record_key",
            {"result.value": "$.value"},
            {"result.doubled": {"$mult": ["$.value", 2]}},
        ],
    }
    return columns.flatten(search(rows, criteria))


@query(
    f"""WITH {LOG_SQL},
    {_fold_sql("edits", "folded")}
    SELECT * FROM folded"""
)
def draft_overlay(spark: SparkSession, folder: str) -> DataFrame:
    """The edits of the second half of the month laid over the snapshot of the first."""
    ops = edit_log(spark, folder)
    first_half = F.substring("commit_id", -10, 10) <= "2024-01-15"
    parent = versions.fold(ops.where(first_half))
    return versions.overlay(parent, ops.where(~first_half))


@query(
    f"""WITH RECURSIVE {LOG_SQL}, {_chain_sql("'dev@2024-01-25'")}
    SELECT c.commit_id AS commit_id, c.parent_id AS parent_id, c.branch AS branch,
      c.n_edits || ' edits' AS title, CAST(c.day AS TIMESTAMP) AS committed_at,
      CAST(chain.distance AS BIGINT) AS age, CAST(chain.distance AS BIGINT) AS pos
    FROM chain JOIN commits c ON c.commit_id = chain.commit_id"""
)
def ancestors(spark: SparkSession, folder: str) -> DataFrame:
    return order.numbered(versions.history(commit_log(spark, folder), "dev@2024-01-25"))


@query(
    f"""WITH {LOG_SQL}, asked AS (
      SELECT DISTINCT CASE event_type WHEN 'click' THEN branch WHEN 'view' THEN commit_id
        WHEN 'error' THEN 'v-' || commit_id ELSE 'user ' || user_id END AS revision
      FROM edits),
    best AS (SELECT name, min_by(commit_id, CASE kind WHEN 'branch' THEN 0 ELSE 1 END) AS commit_id
      FROM refs GROUP BY name)
    SELECT revision, coalesce(c.commit_id, best.commit_id) AS commit_id FROM asked
    LEFT JOIN commits c ON c.commit_id = revision LEFT JOIN best ON best.name = revision"""
)
def resolve_revision(spark: SparkSession, folder: str) -> DataFrame:
    """Commit ids, branches, tags and names that do not exist, asked once per event."""
    commit_id = _commit_id(_branch(), _day())
    asked = table(spark, folder, "events").select(
        F.when(F.col("event_type") == "click", _branch())
        .when(F.col("event_type") == "view", commit_id)
        .when(F.col("event_type") == "error", F.concat(F.lit("v-"), commit_id))
        .otherwise(F.concat(F.lit("user "), F.col("user_id").cast("string")))
        .alias("revision")
    )
    return versions.resolve_all(asked, commit_log(spark, folder), ref_log(spark, folder))


@query(
    """WITH last AS (
      SELECT 'user-' || user_id AS sheet, max(CASE WHEN event_type = 'signup' THEN event_id END) AS made,
        max(CASE WHEN event_type = 'error' THEN event_id END) AS gone FROM events GROUP BY ALL)
    SELECT sheet, made AS created_seq FROM last WHERE made IS NOT NULL AND (gone IS NULL OR made > gone)"""
)
def sheet_set(spark: SparkSession, folder: str) -> DataFrame:
    """Sheets named after users; a signup creates (or replaces) one, an error deletes it."""
    kind = F.col("event_type")
    log = table(spark, folder, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("sheet"),
        F.col("event_id").alias("seq"),
        F.when(kind == "signup", "create").when(kind == "error", "delete").alias("op"),
    )
    return versions.sheet_set(log.where(F.col("op").isNotNull()))


@query(
    f"""WITH {LOG_SQL}, drafts AS (
      SELECT o_orderkey AS number, CASE o_orderstatus WHEN 'F' THEN 'main' WHEN 'O' THEN 'dev'
        ELSE 'main@2024-01-03' END AS head FROM orders),
    counted AS (SELECT l_orderkey AS number, count(*) AS n FROM lineitem WHERE l_quantity > 25 GROUP BY 1)
    SELECT d.number AS number, CASE WHEN head NOT IN (SELECT name FROM refs WHERE kind = 'branch')
        THEN 'HEAD is not a branch' ELSE 'nothing to commit' END AS problem
    FROM drafts d LEFT JOIN counted c ON c.number = d.number
    WHERE c.n IS NULL OR head NOT IN (SELECT name FROM refs WHERE kind = 'branch')"""
)
def commit_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a draft whose edits are its larger line items."""
    status = F.col("o_orderstatus")
    drafts = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("number"),
        F.when(status == "F", "main").when(status == "O", "dev").otherwise("main@2024-01-03").alias("head"),
    )
    edits = table(spark, folder, "lineitem").where(F.col("l_quantity") > 25)
    edits = edits.select(F.col("l_orderkey").alias("number"))
    return versions.commit_problems(drafts, edits, ref_log(spark, folder))


@query(
    f"""WITH RECURSIVE {LOG_SQL}, committed AS (
      SELECT *, 'draft@1' AS own_id FROM edits WHERE day = DATE '2024-01-26' AND branch = 'main'),
    {_chain_sql("'main@2024-01-25'")},
    grown AS (
      SELECT e.* FROM edits e JOIN chain c ON e.commit_id = c.commit_id
      UNION ALL SELECT * EXCLUDE own_id FROM committed),
    {_fold_sql("grown", "folded")}
    SELECT * FROM folded"""
)
def commit_draft(spark: SparkSession, folder: str) -> DataFrame:
    """Commit a day's edits as a draft on a branch, then read the branch."""
    before = F.col("day") <= "2024-01-25"
    ops = edit_log(spark, folder).withColumn("day", F.substring("commit_id", -10, 10))
    commits = commit_log(spark, folder).where(F.col("committed_at") <= F.lit("2024-01-25").cast("timestamp_ntz"))
    refs = commits.groupBy(F.col("branch").alias("name")).agg(
        F.max("commit_id").alias("commit_id")
    ).withColumn("kind", F.lit("branch"))
    draft = ops.where(F.col("commit_id") == "main@2024-01-26").drop("day")
    commits, refs, ops = versions.commit(
        commits,
        refs.select("name", "kind", "commit_id"),
        ops.where(before).drop("day"),
        draft,
        branch="main",
        commit_id="draft@1",
        title="one more day",
        committed_at=F.lit("2024-01-26").cast("timestamp_ntz"),
    )
    return versions.snapshot(ops.withColumn("sheet", F.lit("users")), commits, versions.resolve(commits, refs, "main"), "users")


@query(
    f"""WITH RECURSIVE {LOG_SQL}, committed AS (
      SELECT * FROM edits WHERE day = DATE '2024-01-26' AND branch = 'main'),
    {_chain_sql("'main@2024-01-25'")},
    grown AS (
      SELECT e.* FROM edits e JOIN chain c ON e.commit_id = c.commit_id
      UNION ALL SELECT * FROM committed),
    {_fold_sql("grown", "folded")}
    SELECT * FROM folded"""
)
def commit_stored(spark: SparkSession, folder: str) -> DataFrame:
    """A history is stored, a day's edits are committed to it, and the branch is read back."""
    root = fresh_path(spark, "history")
    ops = edit_log(spark, folder).withColumn("sheet", F.lit("users"))
    commits = commit_log(spark, folder).where(
        F.col("committed_at") <= F.lit("2024-01-25").cast("timestamp_ntz")
    )
    refs = commits.groupBy(F.col("branch").alias("name")).agg(
        F.max("commit_id").alias("commit_id")
    )
    refs = refs.select("name", F.lit("branch").alias("kind"), "commit_id")
    old = F.substring("commit_id", -10, 10) <= "2024-01-25"
    stored_history.create_history(ops.where(old), commits, refs, root)
    stored_history.commit_stored(
        spark,
        root,
        ops.where(F.col("commit_id") == "main@2024-01-26"),
        branch="main",
        commit_id="draft@1",
        title="one more day",
        committed_at=F.lit("2024-01-26").cast("timestamp_ntz"),
    )
    return stored_history.read_stored_revision(spark, root, "main", "users")


@query(
    f"""WITH RECURSIVE {LOG_SQL}, {_chain_sql("'main@2024-01-25'")},
    grown AS (
      SELECT e.* FROM edits e JOIN chain c ON e.commit_id = c.commit_id
      UNION ALL SELECT * FROM edits WHERE commit_id = 'main@2024-01-26'),
    {_fold_sql("grown", "folded")}
    SELECT * FROM folded"""
)
def draft_by_number(spark: SparkSession, folder: str) -> DataFrame:
    """Every day of the main branch as a draft on the day before; the open one of day 26 is read."""
    log, commits = edit_log(spark, folder).withColumn("sheet", F.lit("users")), commit_log(spark, folder)
    day = F.dayofmonth("committed_at")
    drafts = commits.where(F.col("branch") == "main").select(
        day.alias("number"), F.when(day >= 26, "OPEN").otherwise("COMMITTED").alias("state"), "parent_id"
    )
    edits = log.where(F.col("commit_id").startswith("main")).withColumn(
        "number", F.substring("commit_id", -2, 2).cast("int")
    )
    return versions.read_draft(log, commits, drafts, edits, 26, "users")


@query(
    """SELECT o_orderkey AS number, CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'COMMITTED'
         ELSE 'CLOSED' END AS state, CASE WHEN o_custkey % 2 = 0 THEN 'main' ELSE 'dev' END AS branch,
         row_number() OVER (ORDER BY o_orderkey DESC) - 1 AS pos
       FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 2 = 0"""
)
def drafts_by_state(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    drafts = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("number"),
        F.when(status == "O", "OPEN").when(status == "F", "COMMITTED").otherwise("CLOSED").alias("state"),
        F.when(F.col("o_custkey") % 2 == 0, "main").otherwise("dev").alias("branch"),
    )
    return order.numbered(versions.list_drafts(drafts, "OPEN", "main"))


@query(
    f"""WITH {LOG_SQL} SELECT event_id AS id, commit_id, event_type AS sheet, user_id AS creator,
      ts AS created_at, row_number() OVER (ORDER BY ts DESC, event_id) - 1 AS pos
    FROM edits WHERE commit_id = 'main@2024-01-05' AND event_type = 'view'"""
)
def searches_listing(spark: SparkSession, folder: str) -> DataFrame:
    searches = table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        _commit_id(_branch(), _day()).alias("commit_id"),
        F.col("event_type").alias("sheet"),
        F.col("user_id").alias("creator"),
        F.col("ts").alias("created_at"),
    )
    return order.numbered(
        versions.list_searches(
            searches,
            commit_id="main@2024-01-05",
            sheet="view",
            sort=[F.col("created_at").desc(), F.col("id")],
        )
    )


@query(
    f"""WITH {LOG_SQL}, heads AS (
      SELECT user_id, branch AS name, 'branch' AS kind, max(commit_id) AS commit_id
      FROM edits GROUP BY user_id, branch)
    SELECT h.name AS name, h.kind AS kind, user_id, h.commit_id AS commit_id,
      r.commit_id AS current_commit_id
    FROM heads h JOIN refs r ON r.name = h.name AND r.kind = h.kind WHERE r.commit_id <> h.commit_id"""
)
def stale_heads(spark: SparkSession, folder: str) -> DataFrame:
    """Users whose last commit on a branch is not its head."""
    heads = (
        table(spark, folder, "events")
        .groupBy("user_id", _branch().alias("name"))
        .agg(F.max(_commit_id(_branch(), _day())).alias("commit_id"))
        .withColumn("kind", F.lit("branch"))
    )
    return versions.stale_heads(heads, ref_log(spark, folder))
