"""Lines of delimited files put together to records by many tasks, also where quoted fields hold line breaks.

First pass: one row for each block of a file says whether a quote stays open at the end of a line in it, and whether the
last such quote waits for a later block. Only blocks that such a record touches are looked at again, in pieces: there, the
line that closes a quote is found within the piece, or from the pieces' rows where it lies in a later one. All other lines are
records of their own and never move.

A quote opens at the beginning of a field only; elsewhere it stands for itself. A record over several lines must have as
many fields as the header, and its closing quote must end the field. An opening quote without such an end is stray: its
line alone is set aside, and the next line begins a record again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

OPEN_QUOTE = "open quote"
BLOCK = ("_file", "_block_start")
#: Lines of a touched block that are looked at together.
PIECE_LINES = 1 << 14
PIECE = ("_file", "_piece")

_FROM_START = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def _bare(text: Column) -> Column:
    """The text without doubled quotes, which stand for one or for an empty field."""
    return F.replace(text, F.lit('""'), F.lit(""))


def _without_fields(bare: Column) -> Column:
    """The text without its complete quoted fields."""
    return F.regexp_replace(bare, '(^|,)"[^"]*+"', "$1")


def _commas(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))


def stays_open(text: Column) -> Column:
    """Whether a quoted field that begins in this text has no end in it."""
    return F.regexp_like(_without_fields(_bare(text)), F.lit('(^|,)"'))


def separators(text: Column) -> Column:
    """Separators outside of quotes."""
    outside = F.regexp_replace(_without_fields(_bare(text)), '(?s)(^|,)".*$', "$1")
    return F.when(text.contains('"'), _commas(outside)).otherwise(_commas(text))


def _resumed(text: Column) -> Column:
    """A line that begins inside a quoted field."""
    return F.concat(F.lit('"'), text)


def _ends_badly(text: Column) -> Column:
    """Whether the quote that closes the field inside which a line begins is followed by anything but a separator."""
    return F.regexp_like(_bare(_resumed(text)), F.lit('^(?:"[^"]*+")?+[^",]'))


def quoting(text: Column) -> dict[str, Column]:
    """``_opens``: leaves a quote open; ``_closes``: ends one that was open before. Most lines hold no quote at all."""
    quoted = text.contains('"')
    return {
        "_opens": F.when(quoted, stays_open(text)).otherwise(False),
        "_closes": F.when(quoted, _ends_badly(text) | ~stays_open(_resumed(text))).otherwise(False),
    }


def block_rows(lines: DataFrame, text: Column, *more: Column) -> DataFrame:
    """One row per block of lines with ``_opens``, ``_closes``, ``_waits`` (an open quote has no end in the block), and
    ``more`` aggregates."""
    marked = lines.withColumns(quoting(text))
    last = lambda flag: F.coalesce(F.max(F.when(F.col(flag), F.col("_row_seq"))), F.lit(-1))
    return marked.groupBy(*BLOCK).agg(
        F.max("_opens").alias("_opens"), F.max("_closes").alias("_closes"), (last("_opens") >= last("_closes")).alias("_later"), *more
    ).withColumn("_waits", F.col("_opens") & F.col("_later")).drop("_later")


def touched(blocks: DataFrame) -> DataFrame:
    """Adds ``_touched``: a quote stays open in the block, or one from an earlier block waits for its end there."""
    before = Window.partitionBy("_file").orderBy("_block_start").rowsBetween(*_BEFORE)
    event = F.when(F.col("_opens") | F.col("_closes"), F.col("_waits"))
    waiting = F.coalesce(F.last(event, ignorenulls=True).over(before), F.lit(False))
    return blocks.withColumn("_touched", F.col("_opens") | waiting)


def assemble(lines: DataFrame, width: int, parts: int) -> DataFrame:
    """Records of whole touched blocks: the columns of ``lines``, with the text of all lines of a record in ``_text``, the
    position of its first line, and ``_stray`` for a line with an opening quote that ends nowhere.

    Lines have ``_text`` and their position. Blocks are cut into pieces of ``PIECE_LINES``, which are dealt over ``parts``
    tasks and treated like blocks that follow each other, so what a task sorts does not grow with the blocks; only lines of
    records over several lines are grouped again. A line that ends one record and could also start another one is taken as
    the end.
    """
    in_piece = Window.partitionBy(*PIECE).orderBy("_row_seq")
    from_end = Window.partitionBy(*PIECE).orderBy(F.col("_row_seq").desc())
    piece = F.struct("_block_start", F.floor(F.col("_row_seq") / PIECE_LINES).alias("part"))
    text, quoted = F.col("_text"), F.col("_text").contains('"')
    marked = lines.withColumn("_piece", piece).withColumns(quoting(text)).withColumns({
        "_inside": F.when(quoted, separators(_resumed(text))).otherwise(0).cast("bigint"),
        "_clean": F.when(F.col("_closes"), ~_ends_badly(text)).otherwise(False),
    }).repartition(parts, *PIECE)
    summed = marked.withColumn("_sum", F.sum("_inside").over(in_piece.rowsBetween(*_FROM_START)))
    end = F.when(F.col("_closes"), F.struct(F.col("_row_seq").alias("seq"), F.col("_sum").alias("sum"), F.col("_clean").alias("clean")))
    # the nearest closing line after each line of the piece
    ahead = summed.withColumn("_end", end).withColumn(
        "_next", F.last("_end", ignorenulls=True).over(from_end.rowsBetween(*_BEFORE))
    )

    # one row per piece: the nearest closing line in a later one, and the separators up to it
    blocks = summed.groupBy(*PIECE).agg(F.sum("_inside").alias("_all"), F.min(end).alias("_first_end"))
    files = Window.partitionBy("_file")
    running = F.sum("_all").over(files.orderBy("_piece").rowsBetween(*_FROM_START))
    entry = F.when(F.col("_first_end").isNotNull(), F.struct(
        F.col("_piece").alias("block"), (F.col("_until") - F.col("_all") + F.col("_first_end.sum")).alias("until"),
        F.col("_first_end.seq").alias("seq"), F.col("_first_end.clean").alias("clean"),
    ))
    later = blocks.withColumn("_until", running).withColumn(
        "_later", F.last(entry, ignorenulls=True).over(files.orderBy(F.col("_piece").desc()).rowsBetween(*_BEFORE))
    ).select(*PIECE, "_all", "_until", "_later")

    here = F.col("_next").isNotNull()
    candidates = ahead.join(later, list(PIECE)).withColumns({
        "_end_block": F.when(here, F.col("_piece")).otherwise(F.col("_later.block")),
        "_end_seq": F.when(here, F.col("_next.seq")).otherwise(F.col("_later.seq")),
        "_fields": separators(text) + 1 + F.when(here, F.col("_next.sum") - F.col("_sum")).otherwise(
            F.col("_all") - F.col("_sum") + F.col("_later.until") - F.col("_until")
        ),
        "_sound": F.col("_opens") & F.coalesce(F.when(here, F.col("_next.clean")).otherwise(F.col("_later.clean")), F.lit(False)),
    }).withColumn("_sound", F.col("_sound") & (F.col("_fields") == width))
    record = F.struct(
        F.col("_piece").alias("block"), F.col("_row_seq").alias("seq"), F.col("_end_block").alias("end_block"), F.col("_end_seq").alias("end_seq")
    )
    covers = lambda r: F.coalesce(
        (F.col(f"{r}.end_block") > F.col("_piece")) | (F.col(f"{r}.end_block") == F.col("_piece")) & (F.col(f"{r}.end_seq") >= F.col("_row_seq")),
        F.lit(False),
    )
    earlier = candidates.withColumn("_record", F.when(F.col("_sound"), record)).withColumn(
        "_before", F.last("_record", ignorenulls=True).over(in_piece.rowsBetween(*_BEFORE))
    ).withColumn("_inner", covers("_before"))

    # records that run on into later pieces
    open_end = F.max(F.when(F.col("_sound") & ~F.col("_inner") & (F.col("_end_block") > F.col("_piece")), F.col("_record")))
    carried = earlier.groupBy(*PIECE).agg(open_end.alias("_open")).withColumn(
        "_carried", F.last("_open", ignorenulls=True).over(files.orderBy("_piece").rowsBetween(*_BEFORE))
    ).drop("_open")
    placed = earlier.join(carried, list(PIECE)).withColumn("_from_before", covers("_carried"))
    owner = (
        F.when(F.col("_from_before"), F.col("_carried")).when(F.col("_inner"), F.col("_before")).when(F.col("_sound"), F.col("_record"))
    )
    owned = placed.withColumn("_owner", owner).withColumn("_stray", F.col("_opens") & F.col("_owner").isNull())
    kept = [c for c in lines.columns if c not in ("_text", *BLOCK, "_row_seq")]
    single = owned.filter("_owner is null").select(*lines.columns, "_stray")
    several = owned.filter("_owner is not null").groupBy("_file", "_owner").agg(
        *[F.first(c).alias(c) for c in kept],
        F.array_sort(F.collect_list(F.struct("_block_start", "_row_seq", "_text"))).alias("_lines"),
    ).select(
        *kept, "_file", F.col("_owner.block._block_start").alias("_block_start"), F.col("_owner.seq").alias("_row_seq"),
        F.array_join(F.transform("_lines", lambda line: line["_text"]), "\n").alias("_text"), F.lit(False).alias("_stray"),
    )
    return single.unionByName(several)
