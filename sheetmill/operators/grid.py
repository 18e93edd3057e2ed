"""C: spreadsheet-shaped data as a long cell grid, and the operators that tidy it.

A grid is a DataFrame ``(keys..., row_idx INT, col_idx INT, value STRING)`` where
``keys`` identify one sheet or one section of a sheet (default ``["sheet_id"]``) and
blank cells are simply absent.  Keeping the grid long means:

* any number of sheets or workbooks is processed by the same plan; every operator
  is a per-key aggregate, a per-key window or an equi-join on the keys, so work
  spreads over tasks by sheet;
* headers are attached to cells by a join on (keys, col_idx), so a tidy table is
  produced without ever building a wide frame with data-dependent columns;
* per-row work is bounded by the sheet width (a spreadsheet row has at most 16,384
  cells), which is the only thing ever gathered into one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW, COL, VAL = "row_idx", "col_idx", "value"


class GridError(ValueError):
    pass


def _k(keys: Sequence[str]) -> list[str]:
    return list(keys)


# ---------------------------------------------------------------- building grids


def grid_from_lines(df: DataFrame, id_col: str, text_col: str, sheet: str = "sheet_id") -> DataFrame:
    """A1' one cell per non-empty line of a text column: (sheet, row_idx = line position, col_idx = 0).

    Row-local ``posexplode``: the grid of a text is produced in the task that read it.
    """
    lines = df.select(F.col(id_col).alias(sheet), F.posexplode(F.split(F.col(text_col), "\n")).alias(ROW, VAL))
    return lines.where(F.col(VAL) != "").select(sheet, F.col(ROW).cast("int").alias(ROW), F.lit(0).alias(COL), VAL)


def grid_from_words(df: DataFrame, id_col: str, text_col: str, sheet: str = "sheet_id") -> DataFrame:
    """A two-dimensional grid from text: row = line position, column = position of a
    space-separated token in the line; empty tokens are blank (absent) cells."""
    lines = df.select(F.col(id_col).alias(sheet), F.posexplode(F.split(F.col(text_col), "\n")).alias(ROW, "__line"))
    cells = lines.select(sheet, ROW, F.posexplode(F.split(F.col("__line"), " ")).alias(COL, VAL))
    return cells.where(F.col(VAL) != "").select(sheet, F.col(ROW).cast("int").alias(ROW), F.col(COL).cast("int").alias(COL), VAL)


def grid_from_table(df: DataFrame, sheet_col: str, row_col: str, columns: Sequence[str], header_row: int | None = None, sheet: str = "sheet_id") -> DataFrame:
    """Cell grid of a table: one cell per non-null value of ``columns`` (rendered as text).

    With ``header_row`` set, the column names are added as that row of every sheet
    (one header per distinct sheet: an aggregate, not a per-row copy).
    """
    cells = df.select(
        F.col(sheet_col).alias(sheet),
        F.col(row_col).cast("int").alias(ROW),
        F.explode(F.array(*[F.struct(F.lit(i).alias(COL), F.col(c).cast("string").alias(VAL)) for i, c in enumerate(columns)])).alias("__c"),
    ).select(sheet, ROW, "__c.*")
    cells = cells.where(F.col(VAL).isNotNull())
    if header_row is None:
        return cells
    sheets = df.select(F.col(sheet_col).alias(sheet)).distinct()
    header = sheets.select(
        sheet, F.lit(header_row).alias(ROW), F.explode(F.array(*[F.struct(F.lit(i).alias(COL), F.lit(c).alias(VAL)) for i, c in enumerate(columns)])).alias("__c")
    ).select(sheet, ROW, "__c.*")
    return cells.unionByName(header)


# ---------------------------------------------------------------- locating markers


def cell_equals(label: str, col_idx: int | None = None) -> Column:
    c = F.col(VAL) == F.lit(label)
    return c if col_idx is None else c & (F.col(COL) == col_idx)


def cell_contains(text: str, col_idx: int | None = None) -> Column:
    c = F.col(VAL).contains(text)
    return c if col_idx is None else c & (F.col(COL) == col_idx)


def cell_startswith(text: str, col_idx: int | None = None) -> Column:
    c = F.startswith(F.col(VAL), F.lit(text))
    return c if col_idx is None else c & (F.col(COL) == col_idx)


def find_marker_row(grid: DataFrame, match: Column, keys: Sequence[str] = ("sheet_id",), out: str = "marker_row", after: Column | None = None) -> DataFrame:
    """C1 first row (per key) holding a cell that satisfies ``match``.  A per-key min:
    partial aggregation, so a key with many matches costs one row per task."""
    cond = match if after is None else match & after
    return grid.where(cond).groupBy(*_k(keys)).agg(F.min(ROW).alias(out))


def find_marker_columns(grid: DataFrame, match: Column, keys: Sequence[str] = ("sheet_id",)) -> DataFrame:
    """C2 columns (per key) having any cell satisfying ``match``: ``first_col`` and the
    sorted ``cols`` array (bounded by the sheet width)."""
    return grid.where(match).groupBy(*_k(keys)).agg(F.min(COL).alias("first_col"), F.sort_array(F.collect_set(COL)).alias("cols"))


def nth_marker_after(
    grid: DataFrame, match: Column, n: int, keys: Sequence[str] = ("sheet_id",), starts: DataFrame | None = None, start_col: str = "start_row", out: str = "marker_row"
) -> DataFrame:
    """C3 the n-th row (1-based) after ``start_col`` holding a matching cell, per key,
    plus ``found`` = how many matching rows follow the start.  Keys with fewer than n
    matches get ``marker_row`` NULL (``require_nth`` turns that into an error).

    Only marker rows take part, never the whole grid, and a sheet with a huge number of
    marker rows is never gathered into one task: ``found`` is a partial-aggregate count,
    and the n-th row comes from ``row_number() == n``, which Spark plans with a partial
    ``WindowGroupLimit`` below the shuffle (at most n rows per key and map task).
    """
    ks = _k(keys)
    hits = grid.where(match).select(*ks, ROW).distinct()
    if starts is not None:
        hits = hits.join(starts.select(*ks, start_col), on=ks, how="inner").where(F.col(ROW) > F.col(start_col)).drop(start_col)
    found = hits.groupBy(*ks).agg(F.count(F.lit(1)).alias("found"))
    nth = hits.withColumn("__rn", F.row_number().over(Window.partitionBy(*ks).orderBy(ROW))).where(F.col("__rn") == n).select(*ks, F.col(ROW).alias(out))
    return found.join(nth, on=ks, how="left").select(*ks, out, "found")


def require_nth(found: DataFrame, n: int, what: str, out: str = "marker_row") -> None:
    bad = found.where(F.col(out).isNull()).limit(5).collect()
    if bad:
        raise GridError(f"expected at least {n} '{what}' rows, found only {[r['found'] for r in bad]} for {[r.asDict() for r in bad]}")


# ---------------------------------------------------------------- slicing


def slice_rows(grid: DataFrame, bounds: DataFrame, keys: Sequence[str] = ("sheet_id",), start: str = "start_row", end: str = "end_row", end_inclusive: bool = True) -> DataFrame:
    """C4 / C5 keep rows ``start <= row <= end`` (or ``< end``), per key; a NULL end
    means "to the last row".  An equi-join on the keys plus a range filter, so the
    join never degenerates to a theta join; bounds may carry extra key columns
    (e.g. one range per payment method of the same sheet)."""
    ks = _k(keys)
    j = grid.join(bounds, on=ks, how="inner")
    upper = (F.col(ROW) <= F.col(end)) if end_inclusive else (F.col(ROW) < F.col(end))
    return j.where((F.col(ROW) >= F.col(start)) & (F.col(end).isNull() | upper))


def dense_renumber(df: DataFrame, keys: Sequence[str], col: str, bucket: int = 4096) -> DataFrame:
    """(keys, col, __new) where ``__new`` = 0-based dense rank of ``col`` within ``keys``.

    Only the distinct values are ranked (partial aggregation first, so a key with many
    cells per value costs one row per value and task), and in buckets of ``bucket``
    consecutive values: one window per (keys, bucket) gives the rank inside the bucket
    and the bucket's size, and a one-row-per-bucket table gives each bucket's offset.
    A key with a huge number of distinct values is therefore spread over many tasks
    instead of one window partition.
    """
    ks = _k(keys)
    d = df.select(*ks, col).where(F.col(col).isNotNull()).distinct().withColumn("__b", F.floor(F.col(col) / bucket))
    wb = Window.partitionBy(*ks, "__b")
    within = d.withColumn("__r", F.row_number().over(wb.orderBy(col)) - 1).withColumn("__n", F.count(F.lit(1)).over(wb))
    counts = within.groupBy(*ks, "__b").agg(F.max("__n").alias("__n"))
    before = Window.partitionBy(*ks).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*ks, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return within.join(offsets, on=[*ks, "__b"]).select(*ks, col, (F.col("__off") + F.col("__r")).cast("int").alias("__new"))


def width_renumber(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """(keys, col, __new): dense rank of ``col`` within ``keys`` for a column whose
    distinct values per key are bounded by the sheet width (the same bound as the
    per-key column list of ``ffill_right``).  One partial aggregate gathers the sorted
    distinct values per key; ``posexplode`` gives the ranks.  No window, no join."""
    ks = _k(keys)
    sets = df.where(F.col(col).isNotNull()).groupBy(*ks).agg(F.sort_array(F.collect_set(col)).alias("__v"))
    return sets.select(*ks, F.posexplode("__v").alias("__new", col)).select(*ks, col, F.col("__new").cast("int").alias("__new"))


def drop_empty(grid: DataFrame, keys: Sequence[str] = ("sheet_id",), bucket: int = 4096) -> DataFrame:
    """C6 drop blank rows and columns and renumber both from 0 (dense ranks of the
    surviving row and column numbers per key).  Blank = absent or NULL.

    The cells are shuffled once, by (keys, bucket of ``bucket`` consecutive rows), so a sheet with
    a huge number of rows is spread over many tasks; a dense rank within the bucket and the
    number of rows in the buckets before give the new row.  A table of one row per (keys, bucket)
    holds that number and the sorted distinct columns of the key (bounded by the sheet width), in
    which a column's place is its new number.  Its join finds the cells already dealt out by
    its keys.
    """
    ks = _k(keys)
    cells = grid.where(F.col(VAL).isNotNull()).withColumn("__b", F.floor(F.col(ROW) / bucket))
    counts = cells.where(F.col(ROW).isNotNull()).select(*ks, "__b", ROW).distinct().groupBy(*ks, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*ks).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*ks, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    cols = cells.where(F.col(COL).isNotNull()).groupBy(*ks).agg(F.sort_array(F.collect_set(COL)).alias("__cols"))
    ranked = cells.withColumn("__row", F.dense_rank().over(Window.partitionBy(*ks, "__b").orderBy(ROW)) - 1)
    placed = ranked.where(F.col(COL).isNotNull()).join(offsets.join(cols, on=ks) if ks else offsets.crossJoin(cols), on=[*ks, "__b"])
    # where no column before is missing, a column is at its own place
    there = F.when(F.col(COL) >= 0, F.try_element_at("__cols", F.col(COL) + 1)) == F.col(COL)
    place = F.when(there & (F.element_at("__cols", 1) >= 0), F.col(COL)).otherwise(F.array_position("__cols", F.col(COL)) - 1)
    out = placed.select(*grid.columns, (F.col("__off") + F.col("__row")).cast("int").alias("__row"), place.cast("int").alias("__col"))
    return out.withColumns({ROW: F.col("__row"), COL: F.col("__col")}).select(*grid.columns)


def ffill_right(grid: DataFrame, keys: Sequence[str] = ("sheet_id",)) -> DataFrame:
    """C7 fill every blank cell from the nearest non-blank cell to its LEFT in the same row,
    over the columns present in the section (merged headers become repeated labels).

    Output is dense from each row's first value to the section's last column.  A
    skeleton of the output positions (per row: the section's columns from the row's
    first value on; per-key column list bounded by the sheet width) is unioned with the
    cells, and ``last(value, ignorenulls)`` runs over a window per (keys, row) ordered by
    column: O(W log W) per row of width W, one row per window partition (never a whole
    sheet), and no per-row lookups.
    """
    ks = _k(keys)
    cells = grid.where(F.col(VAL).isNotNull())
    cols = grid.groupBy(*ks).agg(F.sort_array(F.collect_set(COL)).alias("__cols"))
    firsts = cells.groupBy(*ks, ROW).agg(F.min(COL).alias("__first"))
    skeleton = firsts.join(cols, on=ks).select(
        *ks, ROW, F.explode(F.filter("__cols", lambda c: c >= F.col("__first"))).alias(COL), F.lit(None).cast("string").alias(VAL), F.lit(1).alias("__sk")
    )
    both = cells.select(*ks, ROW, COL, VAL, F.lit(0).alias("__sk")).unionByName(skeleton)
    w = Window.partitionBy(*ks, ROW).orderBy(COL, "__sk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = both.withColumn(VAL, F.last(VAL, ignorenulls=True).over(w))
    return filled.where((F.col("__sk") == 1) & F.col(VAL).isNotNull()).select(*ks, ROW, COL, VAL)


# ---------------------------------------------------------------- headers


def promote_header(grid: DataFrame, header_rows: DataFrame, keys: Sequence[str] = ("sheet_id",), header_col: str = "header_row", out: str = "header") -> DataFrame:
    """C8 the cells of row ``header_row`` become the header of their column; cells in
    later rows are returned with that header attached (long tidy form).  Header cells
    are joined on (keys, col_idx); columns without a header get NULL."""
    ks = _k(keys)
    g = grid.join(header_rows.select(*ks, header_col), on=ks, how="inner")
    headers = g.where(F.col(ROW) == F.col(header_col)).select(*ks, COL, F.col(VAL).alias(out))
    body = g.where(F.col(ROW) > F.col(header_col)).drop(header_col)
    return body.join(headers, on=[*ks, COL], how="left")


def to_wide(cells: DataFrame, keys: Sequence[str], header: str, columns: Sequence[str], value: str = VAL) -> DataFrame:
    """Pivot headed cells to a wide table with a fixed column list (one row per
    (keys, row_idx)); ``columns`` must be known up front so the plan is static."""
    ks = _k(keys)
    return cells.groupBy(*ks, ROW).pivot(header, list(columns)).agg(F.first(value))


def notes_lookup(grid: DataFrame, keys: Sequence[str] = ("sheet_id",), header_marker: str = "Note number", number: str = "Note number", text: str = "Note text") -> DataFrame:
    """C12 a notes sheet -> (keys, note_ref, note_text): header row = first row with a
    cell containing ``header_marker`` in column 0; later rows give number -> text (the last row
    of a repeated number counts)."""
    ks = _k(keys)
    header = find_marker_row(grid, cell_contains(header_marker, 0), ks, out="header_row")
    cells = promote_header(grid, header, ks)
    wide = to_wide(cells, ks, "header", [number, text])
    notes = wide.select(*ks, ROW, F.col(f"`{number}`").alias("note_ref"), F.col(f"`{text}`").alias("note_text")).where(F.col("note_ref").isNotNull())
    return notes.groupBy(*ks, "note_ref").agg(F.max_by("note_text", ROW).alias("note_text"))


def title_and_source(grid: DataFrame, prefix: str = "Source:", keys: Sequence[str] = ("sheet_id",), col_idx: int = 0, min_row: int = 0) -> DataFrame:
    """C11 both sheet facts in ONE aggregation: ``title`` (first cell of the sheet) and
    ``source`` (first cell in column ``col_idx`` starting with ``prefix``; NULL when none)."""
    cells = grid.where(F.col(VAL).isNotNull())
    is_src = cell_startswith(prefix, col_idx) & (F.col(ROW) >= min_row)
    return cells.groupBy(*_k(keys)).agg(
        F.min_by(F.col(VAL), F.struct(F.col(ROW), F.col(COL))).alias("title"),
        F.min_by(F.col(VAL), F.when(is_src, F.col(ROW))).alias("source"),
    )


NOTE_TAG = r"\[(note \d+)\]"


def apply_notes(df: DataFrame, notes: DataFrame, row_col: str, notes_col: str = "Notes", tag: str = NOTE_TAG) -> DataFrame:
    """C13 resolve ``[note n]`` tags against the notes table (note_ref, note_text) of ONE
    workbook (``plans.heat_pumps`` resolves the tags of many, keyed by workbook).

    Column-level tags (first tag of each column name): the note text is appended to
    ``notes_col`` on every row and the tag is removed from the name.  Only the notes
    referenced by column names are fetched (bounded by the number of columns).
    Row-level tags in ``row_col``: the first tag's text is appended to that row and all
    tags are stripped from the value (left join on the note reference, so the notes
    table may be of any size).  ``notes_col`` starts empty and every append adds a
    leading blank, as the source tables do.
    """
    import re

    refs: list[tuple[str, str | None]] = []
    for c in df.columns:
        m = re.search(tag, c)
        refs.append((c, m.group(1) if m else None))
    wanted = sorted({r for _, r in refs if r})
    lookup: dict[str, str] = {}
    if wanted:
        hits = notes.where(F.col("note_ref").isin(wanted)).groupBy("note_ref").agg(F.max("note_text").alias("note_text"))
        lookup = {r["note_ref"]: r["note_text"] for r in hits.collect()}  # at most len(wanted) rows
    prefix = "".join(" " + (lookup.get(r) or "") for _, r in refs if r)
    renamed = df.select(*[F.col(f"`{c}`").alias(c.replace(f"[{r}]", "").strip() if r else c) for c, r in refs])
    dedup = notes.groupBy("note_ref").agg(F.max("note_text").alias("__note_text"))
    with_ref = renamed.withColumn("__ref", F.regexp_extract(F.col(f"`{row_col}`"), tag, 1))
    joined = with_ref.join(dedup, with_ref["__ref"] == dedup["note_ref"], "left")
    stripped = F.regexp_replace(F.regexp_replace(F.col(f"`{row_col}`"), r"\[note \d+\]", ""), r"^\s+|\s+$", "")
    out = joined.withColumn(notes_col, F.concat(F.lit(prefix + " "), F.coalesce(F.col("__note_text"), F.lit("")))).withColumn(row_col, stripped)
    return out.drop("__ref", "note_ref", "__note_text")


def require_any_nonblank(df: DataFrame, col: str = "Notes") -> None:
    """C14 raise when every value of ``col`` is blank (one aggregation)."""
    ok = df.agg(F.bool_or(F.length(F.regexp_replace(F.col(f"`{col}`"), r"^\s+|\s+$", "")) > 0).alias("ok")).first()["ok"]
    if not ok:
        raise GridError(f"column '{col}' is entirely empty: the notes lookup may have failed to match")
