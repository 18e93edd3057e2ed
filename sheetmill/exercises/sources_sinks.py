"""A (sources) and B (sinks) exercised on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetmill.exercises._registry import exercise, table
from sheetmill.functions.dates import date_stamp
from sheetmill.operators.grid import grid_from_lines
from sheetmill.session import scratch_path
from sheetmill.sources import content, evolution, files, html, manifest, medallion, profiles, workbook, xlsx_source

# Shared SQL fragments for the oracle side (DuckDB dialect).
ANCHOR_RE = r"""'(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>'"""


def _sql_unescape(x: str) -> str:
    return f"replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"


LINES_SQL = """
SELECT sheet_id, row_idx, col_idx, value FROM (
  SELECT doc_id AS sheet_id,
         CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS row_idx,
         CAST(0 AS INTEGER) AS col_idx,
         unnest(string_split(text, chr(10))) AS value
  FROM documents) t
WHERE value <> ''
"""


@exercise("A1_grid_from_text", LINES_SQL)
def a1_grid_from_text(spark, sf):
    """A1' every non-empty line of every document as a cell (the workbook decoder's output shape)."""
    return grid_from_lines(table(spark, sf, "documents"), "doc_id", "text")


_BOOK_SQL = """
WITH l AS (
  SELECT l_orderkey, l_linenumber, max(l_quantity) AS q, max(l_extendedprice) AS p, max(l_returnflag) AS f, max(l_shipdate) AS d
  FROM lineitem GROUP BY ALL),
c AS (
  SELECT l_orderkey, l_linenumber, unnest(range(4)) AS col_idx,
         unnest([CASE WHEN q = floor(q) THEN CAST(CAST(q AS BIGINT) AS VARCHAR) ELSE CAST(q AS VARCHAR) END,
                 CASE WHEN p = floor(p) THEN CAST(CAST(p AS BIGINT) AS VARCHAR) ELSE CAST(p AS VARCHAR) END,
                 f, strftime(d, '%Y-%m-%d')]) AS value
  FROM l)
SELECT 'lines-' || lpad(CAST(l_orderkey // 16384 AS VARCHAR), 6, '0') || '.xlsx' AS workbook,
       CAST(l_orderkey % 16384 * 8 + l_linenumber AS INTEGER) AS row_idx, CAST(col_idx AS INTEGER) AS col_idx, value
FROM c WHERE value IS NOT NULL
"""


def _order_books(spark, sf):
    """Cells of one workbook per block of 16,384 order keys: a sheet of order lines (numbers, shared
    strings, date cells) and a sheet of line states.  Lines are shuffled once, by workbook: grouped,
    made cells and written there."""
    best = [F.max(c).alias(c) for c in ("l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate", "l_linestatus")]
    book = F.format_string("lines-%06d.xlsx", F.floor(F.col("l_orderkey") / 16384))
    lines = table(spark, sf, "lineitem").withColumn("path", book).repartition("path").groupBy("l_orderkey", "l_linenumber", "path").agg(*best)
    sheet = lambda name, kinds, *values: F.struct(F.lit(name).alias("sheet_name"), F.lit(kinds).alias("kinds"), F.array(*(v.cast("string") for v in values)).alias("values"))
    sheets = F.array(
        sheet("Lines", "nnsd", F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_returnflag"), F.date_format("l_shipdate", "yyyy-MM-dd")),
        sheet("State", "s", F.col("l_linestatus")),
    )
    row = (F.col("l_orderkey") % 16384 * 8 + F.col("l_linenumber")).cast("int")
    return lines.select("path", row.alias("row_idx"), F.inline(sheets))


@exercise("A1_workbook_cells", _BOOK_SQL)
def a1_workbook_cells(spark, sf):
    """All order lines written as .xlsx files by tasks, then one sheet of every workbook decoded, a
    large sheet by several tasks."""
    folder = scratch_path(spark, "a1-books")
    xlsx_source.write_workbooks(_order_books(spark, sf), folder, dealt=True)
    cells = workbook.read_workbook_cells(spark, folder, range_bytes=4 << 20).where(F.col("sheet_name") == "Lines")
    return cells.select(manifest.file_name("path").alias("workbook"), "row_idx", "col_idx", "value")


@exercise("A2_read_nested_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def a2_read_nested_json(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", files.parse_json_column("props", "k BIGINT")["k"].alias("k"))


@exercise("A3_read_table", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45")
def a3_read_table(spark, sf):
    li = files.read_table(spark, f"{sf}/lineitem.parquet")
    return li.where(F.col("l_quantity") > 45).select("l_orderkey", "l_linenumber", "l_quantity")


@exercise(
    "A4_read_latest",
    "SELECT n_nationkey, n_name, n_regionkey FROM nation",
)
def a4_read_latest(spark, sf):
    root = scratch_path(spark, "a4")
    medallion.publish(table(spark, sf, "nation"), root, "silver", "tpch", "nation", "published", "2024-01-01")
    return files.read_latest(spark, root, "silver", "tpch", "nation")


@exercise(
    "A5_read_metadata",
    "SELECT r_regionkey, r_name, 'tpch' AS publisher FROM region",
)
def a5_read_metadata(spark, sf):
    """Sidecars written from the region table (one JSON object per file), read back as a table."""
    path = scratch_path(spark, "a5")
    region = table(spark, sf, "region")
    region.withColumn("publisher", F.lit("tpch")).repartition(2).write.json(path)
    return files.read_metadata(spark, path, "r_regionkey INT, r_name STRING, publisher STRING", multiline=False).drop("sidecar_path")


A6_SQL = f"""
WITH a AS (
  SELECT page_id, url,
         regexp_extract_all(html, {ANCHOR_RE}, 1) AS hrefs,
         regexp_extract_all(html, {ANCHOR_RE}, 2) AS texts
  FROM pages),
b AS (
  SELECT page_id, url, hrefs,
         list_filter(range(1, len(texts) + 1),
                     lambda i: contains({_sql_unescape("regexp_replace(texts[i], '<[^>]*>', '', 'g')")}, 'an'))[1] AS i
  FROM a),
c AS (SELECT page_id, url, {_sql_unescape("hrefs[i]")} AS href FROM b)
SELECT page_id,
       CASE WHEN href IS NULL THEN NULL
            WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
            WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || href
            WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href
            ELSE NULL END AS link
FROM c
"""


@exercise("A6_extract_link", A6_SQL)
def a6_extract_link(spark, sf):
    """First anchor whose text contains 'an', resolved against the page URL."""
    pages = table(spark, sf, "pages")
    return pages.select("page_id", html.first_link_containing("html", "url", "an").alias("link"))


@exercise(
    "A6b_links_as_a_parser_sees_them",
    """
WITH u AS (
  SELECT page_id, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) AS origin,
         regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z]+://[^/?#]*', ''), '[^/]*$', '') AS folder
  FROM pages)
SELECT page_id, origin || coalesce(nullif(regexp_replace(folder, '[^/]+/$', ''), ''), '/') || 'p/' || page_id || '.html?x=../y' AS link, 'Section–' || page_id AS heading
FROM u""",
)
def a6b_links_as_a_parser_sees_them(spark, sf):
    """Every page with more in it: a link and a heading in a comment, in a script and in an attribute,
    then real ones with quoted ``>``, nested tags, entities and dot segments."""
    pages = table(spark, sf, "pages")
    hidden = "<a href='/hidden'>planted</a><h3>Section–0</h3>"
    before = F.lit(f"<!-- {hidden} --><SCRIPT>var t = \"{hidden}\"; if (1 < 2) {{}}</SCRIPT><p title=\"{hidden}\">planted</p>")
    link = F.concat(F.lit("<a title='x > y' HREF = \"../p/./q/../"), F.col("page_id").cast("string"), F.lit(".html?x=../y\">All <b>pl&#97;nt</b>ed links</a>"))
    heading = F.concat(F.lit('<h3 class="a > b"> Sec<b>tion</b> &ndash; <i>'), F.col("page_id").cast("string"), F.lit("</i></h3>"))
    more = pages.withColumn("html", F.concat(before, "html", link, heading))
    return more.select(
        "page_id",
        html.first_link_containing("html", "url", "planted").alias("link"),
        html.first_heading_match("html", "Section–[0-9]+").alias("heading"),
    )


A7_SQL = r"""
WITH h AS (
  SELECT page_id,
         list_transform(regexp_extract_all(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>', 1),
           lambda t: regexp_replace(
                  replace(replace(replace(replace(replace(regexp_replace(t, '\s*<[^>]*>\s*', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
                  '^\s+|\s+$', '', 'g')) AS heads
  FROM pages)
SELECT page_id,
       regexp_extract(list_filter(heads, lambda x: regexp_matches(x, '[A-Z][a-z]{3,}'))[1], '[A-Z][a-z]{3,}', 0) AS heading_match
FROM h
"""


@exercise("A7_extract_heading_match", A7_SQL)
def a7_extract_heading_match(spark, sf):
    """First heading (h1 here: the pages carry no h2/h3) whose text matches a pattern."""
    pages = table(spark, sf, "pages")
    return pages.select("page_id", html.first_heading_match("html", "[A-Z][a-z]{3,}", tags=("h1",)).alias("heading_match"))


@exercise(
    "A8_latest_release",
    "SELECT user_id, arg_max(event_id, ts) AS event_id, max(ts) AS ts, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id",
)
def a8_latest_release(spark, sf):
    return manifest.latest_per_group(table(spark, sf, "events"), ["user_id"], "ts", ["event_id", "ts", "event_type"])


@exercise(
    "A9_first_attachment_by_type",
    "SELECT conv_id, min(turn) AS turn, arg_min(text, turn) AS text FROM conversations WHERE role = 'assistant' GROUP BY conv_id",
)
def a9_first_attachment_by_type(spark, sf):
    conv = table(spark, sf, "conversations")
    return manifest.first_in_group_where(conv, ["conv_id"], "turn", F.col("role") == "assistant", ["turn", "text"])


@exercise(
    "A9b_first_array_element_by_type",
    """SELECT conv_id, turn, role FROM conversations WHERE role = 'assistant'""",
)
def a9b_first_array_element_by_type(spark, sf):
    """Array form: each turn carries a small array of typed parts; pick the first part of a given type."""
    conv = table(spark, sf, "conversations")
    parts = F.array(F.struct(F.lit("meta").alias("content_type"), F.col("turn").alias("turn")), F.struct(F.col("role").alias("content_type"), F.col("turn").alias("turn")))
    picked = conv.select("conv_id", manifest.first_element_where(parts, "content_type", "assistant").alias("hit"))
    return picked.where(F.col("hit").isNotNull()).select("conv_id", F.col("hit.turn").alias("turn"), F.col("hit.content_type").alias("role"))


@exercise("A10_nested_get", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def a10_nested_get(spark, sf):
    return table(spark, sf, "events").select("event_id", manifest.nested_get("props", ["k"]).alias("k"))


@exercise("A11_file_basename", "SELECT page_id, NULLIF(regexp_extract(url, '([^/]*)/*$', 1), '') AS filename FROM pages")
def a11_file_basename(spark, sf):
    return table(spark, sf, "pages").select("page_id", manifest.file_name("url").alias("filename"))


@exercise(
    "A12_landing_manifest",
    """
SELECT page_id,
       regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) AS publisher,
       NULLIF(regexp_extract(url, '([^/]*)/*$', 1), '') AS filename,
       'Source: ' || regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) || ', ' || COALESCE(NULLIF(regexp_extract(url, '([^/]*)/*$', 1), ''), '') || '. ' || url || '.' AS citation
FROM pages""",
)
def a12_landing_manifest(spark, sf):
    """Manifest rows for pages treated as landed files: publisher (host), file name, citation."""
    pages = table(spark, sf, "pages")
    host = F.regexp_extract("url", r"^[A-Za-z]+://([^/?#]*)", 1)
    rows = manifest.manifest_rows(pages, "url", host, F.col("url"), keep=["page_id"])
    return rows.select("page_id", "publisher", "filename", "citation")


@exercise("B1_write_table", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def b1_write_table(spark, sf):
    path = scratch_path(spark, "b1")
    medallion.write_table(table(spark, sf, "nation"), path)
    return spark.read.parquet(path)


B2_SQL = """
SELECT n_nationkey, n_name, n_regionkey, 'v1' AS version FROM nation
UNION ALL
SELECT n_nationkey, upper(n_name) AS n_name, n_regionkey, 'v2' AS version FROM nation
"""


def _publish_twice(spark, sf):
    root = scratch_path(spark, "b2")
    nation = table(spark, sf, "nation")
    medallion.publish(nation, root, "silver", "tpch", "nation", "version", "v1")
    medallion.publish(nation.withColumn("n_name", F.upper("n_name")), root, "silver", "tpch", "nation", "version", "v2")
    return root


@exercise("B2_publish_layer", B2_SQL)
def b2_publish_layer(spark, sf):
    """Publish twice under different versions: historical keeps both."""
    root = _publish_twice(spark, sf)
    return files.read_historical(spark, root, "silver", "tpch", "nation").select("n_nationkey", "n_name", "n_regionkey", "version")


@exercise("B2b_publish_latest", "SELECT n_nationkey, upper(n_name) AS n_name, n_regionkey FROM nation")
def b2b_publish_latest(spark, sf):
    """... and latest holds only the second version."""
    root = _publish_twice(spark, sf)
    return files.read_latest(spark, root, "silver", "tpch", "nation")


@exercise(
    "B2c_reader_during_publish",
    """
SELECT 'held' AS reader, o_orderpriority, count(*) AS n, sum(o_custkey)::BIGINT AS customers FROM orders GROUP BY ALL
UNION ALL SELECT 'later', o_orderpriority, count(*), sum(o_custkey)::BIGINT FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL""",
)
def b2c_reader_during_publish(spark, sf):
    """Orders published, resolved by a reader, and published again under the same version: the
    reader that came first still reads all of its version, a later one the new."""
    root = scratch_path(spark, "b2c")
    orders = table(spark, sf, "orders")
    medallion.publish(orders, root, "silver", "tpch", "orders", "version", "v1")
    held = files.read_latest(spark, root, "silver", "tpch", "orders")
    medallion.publish(orders.where("o_orderkey % 3 = 0"), root, "silver", "tpch", "orders", "version", "v1")
    later = files.read_latest(spark, root, "silver", "tpch", "orders")
    both = held.withColumn("reader", F.lit("held")).unionByName(later.withColumn("reader", F.lit("later")))
    return both.groupBy("reader", "o_orderpriority").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("customers"))


@exercise(
    "B3_land_raw",
    "SELECT NULLIF(regexp_extract(url, '([^/]*)/*$', 1), '') AS filename, CAST(octet_length(encode(html)) AS BIGINT) AS size_bytes FROM pages",
)
def b3_land_raw(spark, sf):
    """Land page bodies as a raw payload table (bronze) and read the landed listing back."""
    root = scratch_path(spark, "b3")
    pages = table(spark, sf, "pages")
    payload = pages.select(F.col("url").alias("path"), F.encode("html", "UTF-8").alias("content"))
    medallion.land_raw(payload, root, "pages", "ingested", "2024-01-01T00-00-00Z")
    landed = files.read_latest(spark, root, "bronze", "pages", "file")
    return landed.select(F.when(F.col("filename") != "", F.col("filename")).alias("filename"), "size_bytes")


@exercise("B4_partition_pruned_read", "SELECT n_nationkey, n_name, n_regionkey, 'v1' AS version FROM nation")
def b4_partition_pruned_read(spark, sf):
    root = _publish_twice(spark, sf)
    return medallion.read_version(spark, root, "silver", "tpch", "nation", "version", "v1").select("n_nationkey", "n_name", "n_regionkey", "version")


@exercise("B5_date_stamp", "SELECT event_id, 'ingested=' || strftime(ts, '%Y-%m-%dT%H-%M-%SZ') AS stamp FROM events")
def b5_date_stamp(spark, sf):
    return table(spark, sf, "events").select("event_id", date_stamp("ts", key="ingested").alias("stamp"))


@exercise(
    "G10b_profiles_of_versions",
    """
SELECT 'o_custkey' AS "column", count(*) AS rows, count(*) FILTER (WHERE o_custkey IS NULL) AS nulls, min(o_custkey)::DOUBLE AS low, max(o_custkey)::DOUBLE AS high, NULL::VARCHAR AS smallest, NULL::VARCHAR AS largest, count(DISTINCT o_custkey) AS exact_distinct, true AS distinct_close, true AS median_close FROM orders
UNION ALL SELECT 'o_totalprice', count(*), count(*) FILTER (WHERE o_totalprice IS NULL), min(o_totalprice), max(o_totalprice), NULL, NULL, count(DISTINCT o_totalprice), true, true FROM orders
UNION ALL SELECT 'o_orderpriority', count(*), count(*) FILTER (WHERE o_orderpriority IS NULL), NULL, NULL, min(o_orderpriority), max(o_orderpriority), count(DISTINCT o_orderpriority), true, NULL FROM orders""",
)
def g10b_profiles_of_versions(spark, sf):
    """Orders published as three versions with profiles; the profile of all of them comes from
    the kept sketches alone and is held against exact counts and ranks of the whole table."""
    root = scratch_path(spark, "g10b")
    names = ["o_custkey", "o_totalprice", "o_orderpriority"]
    orders = table(spark, sf, "orders")
    for part in range(3):
        medallion.publish(orders.where(F.col("o_orderkey") % 3 == part), root, "silver", "tpch", "orders", "version", f"v{part}", profile=names)
    kept = profiles.estimates(profiles.merged(profiles.read_profiles(spark, root, "silver", "tpch", "orders")))
    medians = {r["column"]: r["q50"] for r in kept.select("column", "q50").collect()}  # one row per column named
    exact = orders.agg(*[F.count_distinct(n).alias(f"d_{n}") for n in names], *[(F.count_if(F.col(n) <= medians[n]) / F.count(n)).alias(f"r_{n}") for n in names if medians[n] is not None])
    rows = exact.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"d_{n}").alias("exact_distinct"), (F.col(f"r_{n}") if medians[n] is not None else F.lit(None).cast("double")).alias("rank")) for n in names])))
    return kept.join(rows, F.col("column") == F.col("name")).select(
        "column", "rows", "nulls", "low", "high", "smallest", "largest", "exact_distinct",
        (F.abs(F.col("distinct") - F.col("exact_distinct")) <= profiles.DISTINCT_ERROR * F.col("exact_distinct")).alias("distinct_close"),
        (F.abs(F.col("rank") - 0.5) <= profiles.RANK_ERROR).alias("median_close"),
    )


@exercise(
    "A4b_versions_of_different_schemas",
    """
SELECT o_orderkey, o_custkey::DECIMAL(21, 2) AS o_custkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderpriority, NULL::DOUBLE AS o_totalprice, '1' AS version FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, (o_custkey / 4.0)::DECIMAL(21, 2), CAST(o_orderdate AS TIMESTAMP), NULL, o_totalprice, '2' FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderkey, o_custkey::DECIMAL(21, 2), CAST(o_orderdate AS TIMESTAMP) + INTERVAL 5 HOUR, o_orderpriority, floor(o_totalprice), '3' FROM orders WHERE o_orderkey % 3 = 2""",
)
def a4b_versions_of_different_schemas(spark, sf):
    """Orders published as three versions, with columns added, dropped and widened in between,
    read as one table."""
    root = scratch_path(spark, "a4b")
    orders = table(spark, sf, "orders")
    day, priority = F.col("o_orderdate").cast("date").alias("o_orderdate"), F.col("o_orderpriority")
    shapes = [
        ["o_orderkey", F.col("o_custkey").cast("bigint").alias("o_custkey"), day, priority],
        ["o_orderkey", (F.col("o_custkey") / 4).cast("decimal(14,2)").alias("o_custkey"), day, F.col("o_totalprice").cast("double").alias("o_totalprice")],
        [
            priority,
            F.floor("o_totalprice").cast("int").alias("o_totalprice"),
            (F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 5 HOURS")).alias("o_orderdate"),
            F.col("o_custkey").cast("int").alias("o_custkey"),
            "o_orderkey",
        ],
    ]
    for n, shape in enumerate(shapes):
        medallion.publish(orders.where(F.col("o_orderkey") % 3 == n).select(*shape), root, "silver", "tpch", "orders", "version", str(n + 1))
    return evolution.read_evolved(spark, root, "silver", "tpch", "orders")


@exercise(
    "B3b_land_by_content",
    """
WITH first AS (SELECT url, html FROM pages),
second AS (SELECT url, CASE WHEN page_id % 10 = 0 THEN html || '<!-- changed -->' ELSE html END AS html FROM pages),
both_landings AS (SELECT '1' AS landed, * FROM first UNION ALL SELECT '2', * FROM second)
SELECT landed, url AS path, sha256(html) AS digest, octet_length(encode(html))::BIGINT AS size_bytes, sha256(html) AS stored_digest,
       (SELECT count(DISTINCT html) FROM both_landings) AS payloads
FROM both_landings""",
)
def b3b_land_by_content(spark, sf):
    """Page bodies landed twice, every tenth one changed in between: both manifests stay whole, only
    bodies not stored yet are written, and each manifest row finds its bytes again."""
    root = scratch_path(spark, "b3b")
    pages = table(spark, sf, "pages")
    changed = F.when(F.col("page_id") % 10 == 0, F.concat("html", F.lit("<!-- changed -->"))).otherwise(F.col("html"))
    for version, body in (("1", F.col("html")), ("2", changed)):
        content.land_by_content(pages.select(F.col("url").alias("path"), F.encode(body, "UTF-8").alias("content")), root, "pages", "landed", version)
    rows = content.with_payload(files.read_historical(spark, root, "bronze", "pages", content.MANIFEST), root, "pages")
    stored = content.known_payloads(spark, root, "bronze", "pages").agg(F.count(F.lit(1)).alias("payloads"))
    out = rows.select(F.col("landed").cast("string").alias("landed"), "path", "digest", "size_bytes", F.sha2("content", 256).alias("stored_digest"))
    return out.withColumn("payloads", F.lit(stored.first()["payloads"]))
