"""C (cell-grid shaping) exercised on grids derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sheetmill.exercises._registry import exercise, table
from sheetmill.exercises.sources_sinks import LINES_SQL
from sheetmill.functions.text import clean_header, strip
from sheetmill.operators import grid as G
from sheetmill.operators.timeseries import carry_forward


def _lines(spark, sf):
    return G.grid_from_lines(table(spark, sf, "documents"), "doc_id", "text")


L = f"WITH l AS ({LINES_SQL})"


@exercise("C1_find_marker_row", f"{L} SELECT sheet_id, min(row_idx) AS marker_row FROM l WHERE contains(value, 'the') GROUP BY sheet_id")
def c1_find_marker_row(spark, sf):
    return G.find_marker_row(_lines(spark, sf), G.cell_contains("the"))


C2_SQL = """
WITH cells AS (
  SELECT year(o_orderdate) AS sheet_id, CAST(0 AS INTEGER) AS col_idx, o_orderstatus AS value FROM orders
  UNION ALL SELECT year(o_orderdate), CAST(1 AS INTEGER), o_orderpriority FROM orders
  UNION ALL SELECT year(o_orderdate), CAST(2 AS INTEGER), CAST(o_custkey AS VARCHAR) FROM orders)
SELECT sheet_id, min(col_idx) AS first_col,
       string_agg(DISTINCT CAST(col_idx AS VARCHAR), ',' ORDER BY CAST(col_idx AS VARCHAR)) AS cols
FROM cells WHERE contains(value, 'F') GROUP BY sheet_id
"""


@exercise("C2_find_marker_columns", C2_SQL)
def c2_find_marker_columns(spark, sf):
    """Grid of orders (one sheet per order year); columns holding a cell that contains 'F'."""
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    grid = G.grid_from_table(orders, "year", "o_orderkey", ["o_orderstatus", "o_orderpriority", "o_custkey"])
    found = G.find_marker_columns(grid, G.cell_contains("F"))
    return found.select("sheet_id", "first_col", F.array_join(F.transform("cols", lambda c: c.cast("string")), ",").alias("cols"))


C3_SQL = f"""{L},
s AS (SELECT sheet_id, min(row_idx) AS start_row FROM l WHERE contains(value, 'the') GROUP BY sheet_id),
h AS (SELECT DISTINCT l.sheet_id, l.row_idx FROM l JOIN s USING (sheet_id) WHERE contains(l.value, 'the') AND l.row_idx > s.start_row),
r AS (SELECT sheet_id, row_idx, row_number() OVER (PARTITION BY sheet_id ORDER BY row_idx) AS rn, count(*) OVER (PARTITION BY sheet_id) AS n FROM h)
SELECT sheet_id, min(CASE WHEN rn = 2 THEN row_idx END) AS marker_row, max(n) AS found FROM r GROUP BY sheet_id
"""


@exercise("C3_nth_marker_after", C3_SQL)
def c3_nth_marker_after(spark, sf):
    """2nd line containing 'the' after the first such line, per document (+ how many follow)."""
    lines = _lines(spark, sf)
    starts = G.find_marker_row(lines, G.cell_contains("the"), out="start_row")
    return G.nth_marker_after(lines, G.cell_contains("the"), 2, starts=starts)


BOUNDS_SQL = f"""{L},
b AS (SELECT sheet_id, min(CASE WHEN contains(value, 'the') THEN row_idx END) AS start_row,
             max(CASE WHEN contains(value, 'and') THEN row_idx END) AS end_row
      FROM l GROUP BY sheet_id)
"""


def _bounds(lines):
    return lines.groupBy("sheet_id").agg(
        F.min(F.when(F.col("value").contains("the"), F.col("row_idx"))).alias("start_row"),
        F.max(F.when(F.col("value").contains("and"), F.col("row_idx"))).alias("end_row"),
    ).where(F.col("start_row").isNotNull())


@exercise(
    "C4_slice_rows",
    f"{BOUNDS_SQL} SELECT l.sheet_id, l.row_idx, l.value FROM l JOIN b ON l.sheet_id = b.sheet_id "
    "WHERE b.start_row IS NOT NULL AND l.row_idx >= b.start_row AND (b.end_row IS NULL OR l.row_idx <= b.end_row)",
)
def c4_slice_rows(spark, sf):
    """Lines from the first 'the' line to the last 'and' line (inclusive), per document."""
    lines = _lines(spark, sf)
    return G.slice_rows(lines, _bounds(lines)).select("sheet_id", "row_idx", "value")


@exercise(
    "C5_slice_half_open",
    f"{BOUNDS_SQL} SELECT l.sheet_id, l.row_idx, l.value FROM l JOIN b ON l.sheet_id = b.sheet_id "
    "WHERE b.start_row IS NOT NULL AND l.row_idx >= b.start_row AND (b.end_row IS NULL OR l.row_idx < b.end_row)",
)
def c5_slice_half_open(spark, sf):
    lines = _lines(spark, sf)
    return G.slice_rows(lines, _bounds(lines), end_inclusive=False).select("sheet_id", "row_idx", "value")


WORDS_SQL = """
WITH l AS (SELECT doc_id AS sheet_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS r,
                  unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT sheet_id, r, generate_subscripts(string_split(line, ' '), 1) - 1 AS c, unnest(string_split(line, ' ')) AS value FROM l)
"""


@exercise(
    "C6_drop_empty_rows_cols",
    WORDS_SQL
    + """SELECT sheet_id,
       CAST(dense_rank() OVER (PARTITION BY sheet_id ORDER BY r) - 1 AS INTEGER) AS row_idx,
       CAST(dense_rank() OVER (PARTITION BY sheet_id ORDER BY c) - 1 AS INTEGER) AS col_idx,
       value
FROM w WHERE value <> ''""",
)
def c6_drop_empty_rows_cols(spark, sf):
    """Word grid of every document (row = line, column = word position); blank rows and
    columns dropped and both renumbered."""
    grid = G.grid_from_words(table(spark, sf, "documents"), "doc_id", "text")
    return G.drop_empty(grid)


# (l_orderkey, l_linenumber) is not unique in the test data: order lines by a full tie-break.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
LINE_ORDER_SQL = ", ".join(LINE_ORDER)

C7_SQL = f"""
SELECT l_orderkey, l_linenumber,
       last_value(NULLIF(l_discount, 0) IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS discount_filled
FROM lineitem
"""


def _discounts(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*LINE_ORDER, "l_orderkey", F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("discount_filled"))


@exercise("C7_ffill_lineitem", C7_SQL)
def c7_ffill_lineitem(spark, sf):
    """Zero discounts blanked, then filled from the previous line of the same order."""
    return carry_forward(_discounts(spark, sf), ["l_orderkey"], LINE_ORDER, "discount_filled").select("l_orderkey", "l_linenumber", "discount_filled")


@exercise("C7b_ffill_split_groups", C7_SQL)
def c7b_ffill_split_groups(spark, sf):
    """Same fill, planned for hot groups: each order split into line buckets, carries
    across buckets from a per-bucket summary."""
    filled = carry_forward(_discounts(spark, sf), ["l_orderkey"], LINE_ORDER, "discount_filled", split_by=F.floor(F.col("l_linenumber") / 3))
    return filled.select("l_orderkey", "l_linenumber", "discount_filled")


C7C_SQL = f"""
WITH base AS (
  SELECT l_orderkey AS sheet_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS INTEGER) AS row_idx,
         l_returnflag AS v0, NULLIF(l_linestatus, 'O') AS v1,
         CASE WHEN l_quantity > 25 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS v2,
         NULLIF(l_returnflag, 'N') AS v3
  FROM lineitem),
p AS (SELECT sheet_id, bool_or(v0 IS NOT NULL) AS p0, bool_or(v1 IS NOT NULL) AS p1,
             bool_or(v2 IS NOT NULL) AS p2, bool_or(v3 IS NOT NULL) AS p3 FROM base GROUP BY sheet_id),
f AS (SELECT b.sheet_id, b.row_idx, p0, p1, p2, p3,
             v0 AS f0, coalesce(v1, v0) AS f1, coalesce(v2, v1, v0) AS f2, coalesce(v3, v2, v1, v0) AS f3
      FROM base b JOIN p USING (sheet_id))
SELECT sheet_id, row_idx, CAST(0 AS INTEGER) AS col_idx, f0 AS value FROM f WHERE p0 AND f0 IS NOT NULL
UNION ALL SELECT sheet_id, row_idx, 1, f1 FROM f WHERE p1 AND f1 IS NOT NULL
UNION ALL SELECT sheet_id, row_idx, 2, f2 FROM f WHERE p2 AND f2 IS NOT NULL
UNION ALL SELECT sheet_id, row_idx, 3, f3 FROM f WHERE p3 AND f3 IS NOT NULL
"""


@exercise("C7c_ffill_right", C7C_SQL)
def c7c_ffill_right(spark, sf):
    """Grid per order (row = line, 4 columns with blanks); blanks filled from the left."""
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    li = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.row_number().over(w).alias("r"),
        F.col("l_returnflag").alias("c0"),
        F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")).alias("c1"),
        F.when(F.col("l_quantity") > 25, F.col("l_quantity").cast("bigint").cast("string")).alias("c2"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("c3"),
    )
    grid = G.grid_from_table(li, "l_orderkey", "r", ["c0", "c1", "c2", "c3"])
    return G.ffill_right(grid)


C8_SQL = """
SELECT n_regionkey AS sheet_id, n_nationkey + 1 AS row_idx, CAST(0 AS INTEGER) AS col_idx, CAST(n_nationkey AS VARCHAR) AS value, 'n_nationkey' AS header FROM nation
UNION ALL
SELECT n_regionkey, n_nationkey + 1, CAST(1 AS INTEGER), n_name, 'n_name' FROM nation
"""


@exercise("C8_promote_header", C8_SQL)
def c8_promote_header(spark, sf):
    """Nation grid per region with a header row; the row holding 'n_name' becomes the header."""
    nation = table(spark, sf, "nation").withColumn("r", F.col("n_nationkey") + 1)
    grid = G.grid_from_table(nation, "n_regionkey", "r", ["n_nationkey", "n_name"], header_row=0)
    header_rows = G.find_marker_row(grid, G.cell_equals("n_name"), out="header_row")
    return G.promote_header(grid, header_rows).select("sheet_id", "row_idx", "col_idx", "value", "header")


@exercise(
    "C9_clean_headers",
    r"""SELECT doc_id,
       md5(replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10), '')) AS cleaned_md5,
       CAST(length(replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10), '')) AS BIGINT) AS cleaned_length
FROM documents""",
)
def c9_clean_headers(spark, sf):
    """Header clean-up (strip, then drop newlines) applied to whole document texts."""
    docs = table(spark, sf, "documents")
    cleaned = clean_header("text")
    return docs.select("doc_id", F.md5(cleaned).alias("cleaned_md5"), F.length(cleaned).cast("bigint").alias("cleaned_length"))


@exercise(
    "C11_sheet_title_source",
    f"{L} SELECT sheet_id, arg_min(value, row_idx) AS title, arg_min(value, row_idx) FILTER (WHERE starts_with(value, 'The')) AS source FROM l GROUP BY sheet_id",
)
def c11_sheet_title_source(spark, sf):
    """Per document: title = first line, source = first line starting with 'The'."""
    return G.title_and_source(_lines(spark, sf), prefix="The")


def _notes_grid(spark, sf):
    region = table(spark, sf, "region").select(
        F.lit("notes").alias("sheet"),
        (F.col("r_regionkey") + 2).alias("r"),
        F.concat(F.lit("note "), F.col("r_regionkey").cast("string")).alias("Note number"),
        F.col("r_name").alias("Note text"),
    )
    return G.grid_from_table(region, "sheet", "r", ["Note number", "Note text"], header_row=1)


@exercise("C12_notes_lookup", "SELECT 'notes' AS sheet_id, 'note ' || CAST(r_regionkey AS VARCHAR) AS note_ref, r_name AS note_text FROM region")
def c12_notes_lookup(spark, sf):
    """A notes sheet built from the region table -> note reference -> note text."""
    return G.notes_lookup(_notes_grid(spark, sf))


C13_SQL = """
SELECT p_partkey, p_name AS part_name, p_brand AS brand,
       ' ' || (SELECT r_name FROM region WHERE r_regionkey = 1) || ' ' || COALESCE(r.r_name, '') AS notes
FROM part LEFT JOIN region r ON r.r_regionkey = p_partkey % 5
"""


def _noted_parts(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.col("p_name"), F.lit(" [note "), (F.col("p_partkey") % 5).cast("string"), F.lit("]")).alias("part_name"),
        F.col("p_brand").alias("brand [note 1]"),
    )
    notes = G.notes_lookup(_notes_grid(spark, sf)).drop("sheet_id")
    return G.apply_notes(part, notes, "part_name", notes_col="notes")


@exercise("C13_apply_notes", C13_SQL)
def c13_apply_notes(spark, sf):
    """Row tags in part names and a column tag on the brand column, resolved from the notes sheet."""
    return _noted_parts(spark, sf).select("p_partkey", "part_name", "brand", "notes")


@exercise("C14_require_any_nonblank", f"WITH n AS ({C13_SQL}) SELECT bool_or(length(trim(notes)) > 0) AS any_nonblank FROM n")
def c14_require_any_nonblank(spark, sf):
    noted = _noted_parts(spark, sf)
    G.require_any_nonblank(noted, "notes")
    return noted.agg(F.bool_or(F.length(strip("notes")) > 0).alias("any_nonblank"))
