"""Nested records. A document is a record with a list of lines, each with a list of words."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.operators import nested
from meterline.session import workspace
from meterline.sinks import loads
from querybook.registry import query

LOAD = "load-1"


def with_lines(t, spread: bool = False):
    """Documents with their text as `editions.docs`: a struct of a list of structs with a list.

    `spread` deals out the documents before their lists are made, which are several times larger than the texts.
    """
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            F.length(line).alias("n_chars"), F.struct(F.substring(line, 1, 1).alias("letter")).alias("first"),
            F.split(line, " ").alias("words"),
        ),
    )
    docs = t("documents")
    return (nested.dealt_out(docs) if spread else docs).select(
        "doc_id",
        F.struct(F.col("lang").alias("code"), F.struct(F.col("source").alias("name")).alias("site")).alias("origin"),
        F.struct(F.size(F.split("text", "\n")).alias("count"), lines.alias("docs")).alias("editions"),
    )


def doc_id(name: str = "books") -> str:
    return f"""md5('["{name}","' || doc_id || '"]')"""


def child(parent: str, field: str) -> str:
    """Id of element `i` in SQL, from the id of its parent as text."""
    return f"md5(unhex({parent}) || encode('/{field}/' || i))"


def with_text_ids(df):
    """Ids as text, as both engines write them."""
    ids = [c for c in ("_row_id", "_parent_id") if c in df.columns]
    return df.withColumns({c: F.lower(F.hex(c)) for c in ids})


@query(
    "flatten_struct",
    """
    SELECT doc_id, lang AS origin__code, source AS origin__site__name,
           CAST(len(string_split(text, chr(10))) AS INTEGER) AS editions__count
    FROM documents
    """,
)
def flatten_struct(t):
    return nested.flatten_struct(with_lines(t)).drop("editions__docs")


LINES = f"""
  SELECT {doc_id()} AS _parent_id, CAST(i AS INTEGER) AS _position, lines[i + 1] AS line,
         {child(doc_id(), "editions__docs")} AS _row_id
  FROM (SELECT doc_id, lines, unnest(range(len(lines))) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))
"""


@query(
    "child_scalar_array",
    f"""
    SELECT {child("parent", "lines")} AS _row_id, parent AS _parent_id, CAST(i AS INTEGER) AS _position,
           'load-1' AS _load_id, lines[i + 1] AS value
    FROM (SELECT {doc_id()} AS parent, lines, unnest(range(len(lines))) AS i
          FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))
    """,
)
def child_scalar_array(t):
    books = t("documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return with_text_ids(nested.normalise(books, "books", ["doc_id"], LOAD)["books__lines"])


@query(
    "child_struct_array",
    f"""
    SELECT _row_id, _parent_id, _position, 'load-1' AS _load_id, CAST(length(line) AS INTEGER) AS n_chars,
           line[1:1] AS first__letter
    FROM ({LINES})
    """,
)
def child_struct_array(t):
    return with_text_ids(nested.normalise(with_lines(t), "books", ["doc_id"], LOAD)["books__editions__docs"])


@query(
    "child_nested_levels",
    f"""
    SELECT {child("_row_id", "words")} AS _row_id, _row_id AS _parent_id, CAST(i AS INTEGER) AS _position,
           'load-1' AS _load_id, words[i + 1] AS value
    FROM (SELECT _row_id, words, unnest(range(len(words))) AS i
          FROM (SELECT _row_id, string_split(line, ' ') AS words FROM ({LINES})))
    """,
)
def child_nested_levels(t):
    words = nested.normalise(with_lines(t, spread=True), "books", ["doc_id"], LOAD)["books__editions__docs__words"]
    return with_text_ids(words)


@query(
    "table_metrics",
    """
    SELECT 'books' AS table_name, COUNT(*) AS row_count FROM documents
    UNION ALL SELECT 'books__editions__docs', CAST(SUM(len(string_split(text, chr(10)))) AS BIGINT) FROM documents
    UNION ALL
    SELECT 'books__editions__docs__words', COUNT(*) FROM (
      SELECT unnest(string_split(line, ' ')) FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
    """,
)
def table_metrics(t):
    """Rows of all tables, counted in one pass over the documents."""
    return nested.table_metrics(nested.fan_out(with_lines(t), "books", ["doc_id"], LOAD, spread=True))


@query(
    "load_history",
    """
    SELECT * FROM (VALUES ('load-1', 'labels', 0), ('load-2', 'labels', 0), ('load-3', 'labels', 0))
      AS loads(_load_id, table_name, status),
      (SELECT COUNT(DISTINCT doc_id) AS row_count, CAST(2 AS BIGINT) AS schema_versions FROM labels)
    """,
)
def load_history(t):
    """Two loads of one schema and one of another; each is recorded, the last one's rows remain."""
    root = workspace(t.spark, "loads")
    labels = t("labels")
    for number, records in enumerate([labels, labels, labels.withColumn("source", F.lit("review"))], 1):
        stored = loads.replace_load(records, root, "labels", ["doc_id"], f"load-{number}")
    history = loads.load_history(t.spark, root)
    versions = history.agg(F.count_distinct("schema_version").alias("n"))
    rows = stored["labels"].agg(F.count("*").alias("n"))
    return history.select(
        "_load_id", "table_name", "status", rows.scalar().alias("row_count"), versions.scalar().alias("schema_versions")
    )


@query(
    "normalise_reload",
    """
    SELECT md5('["lines",' || coalesce('"' || l_orderkey || '"', 'null') || ','
                  || coalesce('"' || l_linenumber || '"', 'null') || ']') AS _parent_id,
           position AS _position, flag AS value, 'load-2' AS _load_id, 2 AS tables_stored
    FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate NULLS FIRST, l_extendedprice NULLS FIRST,
                                            l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rank
      FROM lineitem) d,
      LATERAL (VALUES (0, d.l_returnflag), (1, d.l_linestatus)) AS f(position, flag)
    WHERE rank = 1
    """,
)
def normalise_reload(t):
    """Lines with their two flags as a list, one per key, loaded twice: the second load replaces the first.

    The first load has a list of days beside; its table goes with it.
    """
    root = workspace(t.spark, "reload")
    lines = t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice",
        F.array("l_returnflag", "l_linestatus").alias("flags"),
    )
    loads.replace_load(lines.withColumn("days", F.array(F.to_date("l_shipdate"))), root, "lines", ["l_orderkey", "l_linenumber"], "load-1")
    stored = loads.replace_load(lines, root, "lines", ["l_orderkey", "l_linenumber"], "load-2")
    flags = with_text_ids(stored["lines__flags"]).select("_parent_id", "_position", "value", "_load_id")
    return flags.withColumn("tables_stored", F.lit(len(stored)))


@query(
    "load_state",
    """
    SELECT CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'load-1' ELSE 'load-2' END AS _load_id, COUNT(*) AS row_count,
           (SELECT MAX(ts) FROM events) AS cursor
    FROM events WHERE ts IS NOT NULL GROUP BY 1
    """,
)
def load_state(t):
    """Events landed up to a day, then all of them: the second run adds only the newer ones."""
    root = workspace(t.spark, "state")
    events = t("events").dropna(subset=["ts"])
    loads.load_increment(events.where("ts < TIMESTAMP_NTZ '2024-01-15'"), root, "events", "ts", "load-1")
    stored = loads.load_increment(events, root, "events", "ts", "load-2")
    state = loads.load_state(t.spark, root, "events").select("cursor")
    counts = stored.groupBy("_load_id").agg(F.count("*").alias("row_count"))
    return counts.withColumn("cursor", state.scalar())
