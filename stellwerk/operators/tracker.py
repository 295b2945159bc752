"""The tracker table: matching, merging, removing, ordering, evolving columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk import fixed
from stellwerk.functions.status import status_from_cell
from stellwerk.functions.text import casefold, filled, header_form, pair_key, ref_from_link, strip
from stellwerk.operators.sizes import number_rows
from stellwerk.session import cut

ROW = "_row"
LINK = "Link zur Ausschreibung"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _has_value(df: DataFrame, name: str) -> Column:
    if df.schema[name].dataType.typeName() == "string":
        return F.length(_c(name)) > 0
    return _c(name).isNotNull()


def matched(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Add ``target``: the existing row (``_row``) a new row belongs to, null for none.

    The first row whose reference or link names the ad wins; only if there is none, the
    first row with the same employer and position.  Existing rows are reduced to one per
    key before the join.
    """
    refs = existing.select(strip(_c(fixed.REF_COLUMN)).alias("_key"), ROW)
    links = existing.select(ref_from_link(_c(LINK)).alias("_key"), ROW)
    by_ref = (
        refs.unionAll(links).filter("_key <> ''").groupBy("_key").agg(F.min(ROW).alias("_ref_row"))
    )
    by_pair = (
        existing.select(pair_key(_c("Firma"), _c("Position")).alias("_pair"), ROW)
        .filter("_pair <> ''")
        .groupBy("_pair")
        .agg(F.min(ROW).alias("_pair_row"))
    )
    return (
        new.withColumn("_pair", pair_key(_c("Firma"), _c("Position")))
        .join(by_ref.withColumnRenamed("_key", fixed.REF_COLUMN), fixed.REF_COLUMN, "left")
        .join(by_pair, "_pair", "left")
        .withColumn("target", F.coalesce("_ref_row", "_pair_row"))
        .drop("_ref_row", "_pair_row")
    )


def merge(
    existing: DataFrame, new: DataFrame, overwrite: bool = False, seq: str = "_seq"
) -> DataFrame:
    """Bring new rows into the table.

    Columns follow three policies.  *Automatic* ones always take the new value, *suggested*
    ones only into an empty cell (unless ``overwrite``), all others are left to the user.
    An empty new value never erases anything, except in the status.  Several new rows may
    belong to the same place in the table; they apply in the order of ``seq``.  Adds
    ``change``: 'neu', 'aktualisiert' or null.
    """
    rows = matched(new, existing)
    # New rows that match no row but have the same employer and position share one place.
    place = F.coalesce(
        F.concat(F.lit("r"), F.col("target").cast("string")),
        F.concat(F.lit("p"), F.nullif("_pair", F.lit(""))),
        F.concat(F.lit("n"), _c(fixed.REF_COLUMN)),
    )
    written = [c for c in new.columns if c != seq]
    known = set(existing.columns)
    automatic = {fixed.REF_COLUMN, *fixed.AUTOMATIC_COLUMNS}

    def folded(name: str) -> Column:
        if name == "Status":
            return F.max_by(_c(name), F.col(seq))
        order = F.when(_has_value(new, name), F.col(seq))
        late = name in automatic or overwrite
        return F.max_by(_c(name), order) if late else F.min_by(_c(name), order)

    per_place = cut(
        rows.groupBy(place.alias("_place")).agg(
            F.min("target").alias("_target"),
            F.min(seq).alias(seq),
            F.count(F.lit(1)).alias("_count"),
            *[folded(c).alias(f"_new {c}") for c in written if c in known],
        )
    )
    # Existing rows look their changes up; rows that are new have nothing to look for and are
    # appended, instead of meeting under one empty key.
    changes = per_place.filter("_target is not null")
    kept = existing.join(changes, existing[ROW] == changes["_target"], "left")
    both = kept.unionByName(per_place.filter("_target is null"), allowMissingColumns=True)
    touched = F.col("_place").isNotNull()
    cells = []
    for name in existing.columns:
        old = _c(name)
        if name not in written or not (name in automatic or name in fixed.SUGGESTED_COLUMNS):
            cells.append(old)
            continue
        value = _c(f"_new {name}")
        if name == "Status":
            cell = F.when(touched, value).otherwise(old)
        elif name in automatic or overwrite:
            cell = F.coalesce(value, old)
        elif existing.schema[name].dataType.typeName() == "string":
            # A blank cell stays as it is unless there is something to put in.
            cell = F.coalesce(F.nullif(old, F.lit("")), value, old)
        else:
            cell = F.coalesce(old, value)
        cells.append(cell.alias(name))
    change = F.when(F.col(ROW).isNull(), "neu").when(touched, "aktualisiert")
    # The first row of a new place is new, the ones after it update that row.
    updates = F.when(F.col(ROW).isNull(), F.col("_count") - 1).otherwise(F.col("_count"))
    return both.select(
        *cells, F.col(seq), change.alias("change"), F.coalesce(updates, F.lit(0)).alias("updates")
    )


def change_counts(merged: DataFrame, removed: Column | None = None) -> DataFrame:
    """One row: new, updated and removed rows of an export."""
    return merged.agg(
        F.count_if(F.col("change") == "neu").alias("new"),
        F.coalesce(F.sum("updates"), F.lit(0)).alias("updated"),
        F.coalesce(F.lit(0) if removed is None else F.count_if(removed), F.lit(0)).alias("removed"),
    )


def with_removal(
    table: DataFrame, if_untouched: DataFrame, always: DataFrame, ref: str = fixed.REF_COLUMN
) -> DataFrame:
    """Add ``removed``: references in ``always``, and untouched ones in ``if_untouched``."""
    flags = (
        if_untouched.select(ref, F.lit(False).alias("_always"))
        .unionAll(always.select(ref, F.lit(True).alias("_always")))
        .groupBy(ref)
        .agg(F.max("_always").alias("_always"))
        .withColumnRenamed(ref, "_ref")
    )
    # Rows without reference join under their row number, or they would meet in one task.
    key = F.coalesce(filled(_c(ref)), F.concat(F.lit("\u0000"), F.col(ROW).cast("string")))
    untouched = status_from_cell(_c("Status")) == fixed.FOUND
    gone = F.col("_always") | (F.col("_always").isNotNull() & F.coalesce(untouched, F.lit(False)))
    return (
        table.join(flags, key == F.col("_ref"), "left")
        .withColumn("removed", F.coalesce(gone, F.lit(False)))
        .drop("_ref", "_always")
    )


def remove(table: DataFrame, if_untouched: DataFrame, always: DataFrame) -> DataFrame:
    return with_removal(table, if_untouched, always).filter(~F.col("removed")).drop("removed")


def table_order(df: DataFrame, tail: Sequence[Column]) -> list[Column]:
    """Running applications, then the untouched by fit, then rejections.

    Without a rating column only the blocks count; ``tail`` makes the order total.
    """
    if "Status" in df.columns:
        state = F.coalesce(status_from_cell(_c("Status")), F.lit(fixed.FOUND))
        block = F.when(state.isin(*fixed.RUNNING), 0).when(state == fixed.REJECTED, 2).otherwise(1)
        # The furthest application comes first.
        rank = F.lit(0)
        for status in fixed.RUNNING:
            rank = F.when(state == status, -fixed.STATUSES.index(status)).otherwise(rank)
        keys = [block, rank]
    else:
        keys = []
    if "Passung" in df.columns:
        def column(name: str, missing: Column) -> Column:
            return F.coalesce(_c(name), missing) if name in df.columns else missing

        keys += [
            F.coalesce(filled("Passung"), F.lit("Z")),
            -column("Punkte", F.lit(-1)),
            column("Alter (Tage)", F.lit(10**9)),
            casefold(column("Firma", F.lit(""))),
        ]
    return [*keys, *tail]


def ranked(df: DataFrame, tail: Sequence[Column]) -> DataFrame:
    """The table in its order, numbered from 1 in 'Nr.'."""
    # The sort samples its input before it reads it; ratings are not to be computed twice.
    numbered = number_rows(cut(df.drop("Nr.")), table_order(df, tail), "Nr.")
    return numbered.withColumn("Nr.", _c("Nr.").cast("int"))


def evolved_columns(
    present: Iterable[str], wanted: Sequence[str]
) -> list[tuple[str, str | None]]:
    """(heading, source column or None) of the new layout.

    Wanted columns first, in their order and spelling, then the reference, then the
    user's own columns in the order they had.  Retired columns are dropped.
    """
    by_form: dict[str, str] = {}
    for name in present:
        by_form.setdefault(header_form(name), name)
    target = [*wanted, fixed.REF_COLUMN]
    forms = {header_form(n) for n in target} | {header_form(n) for n in fixed.RETIRED_COLUMNS}
    layout = [(name, by_form.get(header_form(name))) for name in target]
    layout += [(name, name) for form, name in by_form.items() if form and form not in forms]
    return layout


def evolve(table: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The table in the new layout; doing it twice changes nothing."""
    return table.select(
        *[
            (F.lit(None).cast("string") if source is None else _c(source)).alias(name)
            for name, source in evolved_columns(table.columns, wanted)
        ]
    )


def decisions(table: DataFrame, row: str = ROW) -> DataFrame:
    """(referenznummer, cell, row): what the user chose, for ``entries.read_back``."""
    return table.select(
        strip(_c(fixed.REF_COLUMN)).alias("referenznummer"),
        _c("Status").alias("cell"),
        F.col(row).alias("row"),
    ).filter("referenznummer <> ''")
