"""Raw delimited files -> bronze columns: text as it came, plus lineage; and the typed bulk load."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.casting import is_bad_key, optional
from . import records
from .scratch import stored
from .tables import Table, unique_names

UTF8, LEGACY = "UTF-8", "ISO-8859-1"
CORRUPT = "_corrupt_record"
#: Why a row is set aside; rows that are taken have none.
REASON = "_reason"
OPEN_QUOTE, TOO_WIDE, TOO_SHORT, BAD_KEY = records.OPEN_QUOTE, "too many fields", "too few fields", "bad key"
REASONS = (OPEN_QUOTE, TOO_WIDE, TOO_SHORT, BAD_KEY)

#: Blocks with a verdict that are broadcast; more of them meet their lines in a shuffle.
SMALL_BLOCKS = 20_000
#: Bytes of touched blocks for each task that puts their records together.
TOUCHED_BYTES = 16 << 20

# Position of a row in its file: rows of one block have ascending _row_seq.
ROW_ORDER = ("_source_file", "_block_start", "_row_seq")
_MARK = "\ufeff"   # byte order mark


def header_of(spark: SparkSession, path: str, encoding: str | None = UTF8) -> list[str]:
    """Column names in the first line; without ``encoding`` it is UTF-8 if it can be."""
    return next(csv.reader([_first_line(spark, path, encoding)[0]]))


def _first_line(spark: SparkSession, path: str, encoding: str | None) -> tuple[str, str]:
    """The header, and the file that it was read from."""
    line = spark.read.text(path).select(F.col("value").cast("binary").alias("raw"), F.col("_metadata.file_path").alias("file")).first()
    if line is None:
        raise ValueError(f"no header line in {path}")
    raw = bytes(line.raw)
    if encoding is None:
        try:
            return raw.decode("utf-8-sig").rstrip("\r"), line.file
        except UnicodeDecodeError:
            encoding = LEGACY
    return raw.decode("utf-8-sig" if encoding == UTF8 else encoding).rstrip("\r"), line.file


def _lines(spark: SparkSession, path: str, file: str = "") -> DataFrame:
    """Lines as they came (``_raw``), with their position. Every use of this frame numbers the lines alike. ``file`` is any one
    of the files, which spares work."""
    return spark.read.text(path).select(
        F.col("value").alias("_raw"),
        _source_name(path, file).alias("_source_file"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_row_seq"),
    )


def _decoded(raw: Column, encoding: str) -> Column:
    if encoding == UTF8:
        return F.make_valid_utf8(raw)
    return F.decode(raw.cast("binary"), encoding)


def _unmarked(text: Column) -> Column:
    """The text without a byte order mark before the first line of a file."""
    marked = (F.col("_block_start") == 0) & text.startswith(_MARK)
    return F.when(marked, F.substr(text, F.lit(2))).otherwise(text)


def _same_header(text: Column, header: str) -> Column:
    """Quotes around names do not matter."""
    return _may_be(text, header) & (F.replace(text, F.lit('"'), F.lit("")) == header.replace('"', ""))


def _may_be(text: Column, header: str) -> Column:
    """A look at the first character tells nearly all other lines from the header."""
    return text.startswith(header.replace('"', "")[:1]) | text.startswith('"')


def _blocks(lines: DataFrame, header: str, encoding: str | None) -> DataFrame:
    """One scan leaves one row for each block: quotes left open, bytes that are not UTF-8, and where its first line, its
    header lines and those that are header lines in Latin-1 are. Numbers and flags alone, so that lines are grouped by
    hashing: with a text among the aggregates Spark would sort all of them."""
    raw, at_top, seq = F.col("_raw"), F.col("_block_start") == 0, F.col("_row_seq")
    # quotes, commas and line ends are the same bytes in both encodings
    bytewise = F.when(raw.contains('"'), F.decode(raw.cast("binary"), LEGACY)).otherwise("")
    named = at_top & _same_header(_unmarked(raw), header)
    as_read = at_top & _same_header(_unmarked(_decoded(raw, encoding)), header) if encoding else named
    same_byte = _may_be(raw, header) if header.isascii() else F.lit(True)
    as_legacy = at_top & same_byte & _same_header(_decoded(raw, LEGACY), header)
    return records.block_rows(
        lines, bytewise,
        F.max(F.lit(False) if encoding else ~F.is_valid_utf8(raw)).alias("_legacy"), F.min(seq).alias("_first"),
        F.count_if(named).alias("_headers"), F.min(F.when(as_read, seq)).alias("_named"), F.min(F.when(as_legacy, seq)).alias("_named_legacy"),
        F.sum(F.octet_length(raw)).alias("_bytes"),
    )


def _all_plain(blocks: DataFrame) -> bool:
    """Whether all blocks are UTF-8 without open quotes, and every file has the header once."""
    top = F.col("_block_start") == 0
    found = blocks.agg(F.max(F.col("_opens") | F.col("_legacy") | (top & (F.col("_headers") != 1))).alias("odd")).first()
    return not found.odd


def block_verdicts(blocks: DataFrame) -> DataFrame:
    """What sets blocks apart: ``_legacy`` (the file is not UTF-8), ``_touched`` (by a record over several lines), ``_odd``
    (the file has another header), ``_first`` (the block's first line), ``_bytes`` of its lines. Blocks without any of it have no row."""
    told = records.touched(blocks).withColumn("_legacy", F.max("_legacy").over(Window.partitionBy("_file")))
    named = F.when(F.col("_legacy"), F.col("_named_legacy")).otherwise(F.col("_named"))
    odd = (F.col("_block_start") == 0) & ~F.coalesce(named == F.col("_first"), F.lit(False))
    return told.withColumn("_odd", odd).filter("_legacy or _touched or _odd or _headers > 1").select(
        *records.BLOCK, "_legacy", "_touched", "_odd", "_first", "_bytes"
    )


def file_encodings(spark: SparkSession, path: str) -> DataFrame:
    """``file, encoding`` of each file: UTF-8 where all its lines are, Latin-1 otherwise."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("fits"))
    return lines.groupBy("file").agg(F.when(F.min("fits"), UTF8).otherwise(LEGACY).alias("encoding"))


def _source_name(root: str, file: str) -> Column:
    """The path below the source folder, whose part files in subfolders may share names, or the name of a single file.

    Every row has it, so what paths begin with is taken from ``file``, any one of them; a path that begins otherwise is
    looked through.
    """
    path = F.col("_metadata.file_path")
    # file metadata is percent-encoded, in which a plus sign stands for itself
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    plain = F.when(path.contains("%"), decoded).otherwise(path)
    folder = f"/{root.rstrip('/').rsplit('/', 1)[-1]}/"
    below = F.substr(plain, F.locate(folder, plain) + F.lit(len(folder)))
    searched = F.when(plain.contains(folder), below).otherwise(F.substring_index(plain, "/", -1))
    if not file or "%" in file or not file.isascii():
        return searched
    if folder not in file:
        return F.when(path == file, F.lit(file.rsplit("/", 1)[-1])).otherwise(searched)
    start = file[: file.index(folder) + len(folder)]
    return F.when(path.startswith(start) & ~path.contains("%"), F.substr(path, F.lit(len(start) + 1))).otherwise(searched)


def _told_apart(lines: DataFrame, verdicts: DataFrame, header: str, width: int, encoding: str | None) -> DataFrame:
    """Decoded lines and records where some blocks need more than that."""
    found = verdicts.agg(
        F.count("*").alias("blocks"), F.sum(F.when(F.col("_touched"), F.col("_bytes"))).alias("touched"), F.max(F.when(F.col("_odd"), F.col("_file"))).alias("odd")
    ).first()
    if found.odd is not None:
        raise ValueError(f"{found.odd} has another header than {header!r}")
    at_top, raw = F.col("_block_start") == 0, F.col("_raw")
    told = verdicts.drop("_bytes")
    told = F.broadcast(told) if found.blocks <= SMALL_BLOCKS else told
    legacy = F.coalesce(F.col("_legacy"), F.lit(False))
    text = _decoded(raw, encoding) if encoding else F.when(legacy, _decoded(raw, LEGACY)).otherwise(raw)
    first_line = at_top & (F.coalesce("_first", F.col("_row_seq")) == F.col("_row_seq"))
    decoded = (
        lines.join(told, list(records.BLOCK), "left").withColumn("_text", _unmarked(text))
        .filter(~(first_line & _same_header(F.col("_text"), header))).drop("_raw", "_legacy", "_odd", "_first")
    )
    rows = decoded.filter(~F.coalesce("_touched", F.lit(False))).drop("_touched").withColumn("_stray", F.lit(False))
    if found.touched is not None:
        parts = found.touched // TOUCHED_BYTES + 1
        rows = rows.unionByName(records.assemble(decoded.filter("_touched").drop("_touched"), width, parts))
    return rows


def read_raw(
    spark: SparkSession, path: str, encoding: str | None = None, table: Table | None = None, short_rows: str = "keep"
) -> DataFrame:
    """Every record of the file or folder at ``path`` as text columns with lineage.

    Files that are not UTF-8 are read as Latin-1 (``encoding`` decides for all files instead). Quoted fields may hold line
    breaks wherever a file is split. A row with more fields than the header, one with an opening quote that ends nowhere,
    with ``short_rows="reject"`` one with fewer fields (otherwise the rest is null), and with a ``table`` one whose key does
    not parse are set aside: ``_rejected`` is true, ``_reason`` says why, and ``_corrupt_record`` has the text. Blank lines
    are skipped. A missing path, or another header in one of the files, raises here.

    A first pass over the lines finds out whether any block needs more than parsing. If so, a second one stores a row for
    each of those blocks.
    """
    if short_rows not in ("keep", "reject"):
        raise ValueError(f"short_rows must be keep or reject, not {short_rows!r}")
    header, file = _first_line(spark, path, encoding)
    names = unique_names(next(csv.reader([header])))
    width = len(names)
    lines = _lines(spark, path, file)
    blocks = _blocks(lines, header, encoding)
    at_top, raw = F.col("_block_start") == 0, F.col("_raw")
    if _all_plain(blocks):
        text = _unmarked(_decoded(raw, encoding) if encoding else raw)
        rows = lines.withColumn("_text", text).filter(~(at_top & _same_header(F.col("_text"), header))).withColumn("_stray", F.lit(False))
    else:
        rows = _told_apart(lines, stored(block_verdicts(blocks), "blocks"), header, width, encoding)
    rows = rows.filter(F.trim("_text") != "")

    # the parser keeps the text of a row that has more or fewer fields than the header: others need no count, unless quoted
    off = "_off"
    while off in (n.lower() for n in names):
        off += "_"
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, off])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": off}
    text, fields, row = F.col("_text"), F.col("_fields"), F.col("_row")
    reason = (
        F.when(F.col("_stray"), OPEN_QUOTE).when(fields > width, TOO_WIDE)
        .when(F.lit(short_rows == "reject") & (fields < width), TOO_SHORT)
    )
    counted = F.when(row.getField(off).isNotNull() | text.contains('"'), records.separators(text) + 1).otherwise(width)
    parsed = rows.withColumn("_row", F.from_csv("_text", schema, options)).withColumn("_fields", counted)
    columns = [row.getField(n).alias(n) for n in names]
    if table is not None and table.key is not None:
        field = next(f for f in table.fields if f.name == table.key)
        if field.raw in names:
            reason = reason.when(is_bad_key(row.getField(field.raw), field.type), BAD_KEY)
    return parsed.withColumn(REASON, reason).select(
        *columns, F.when(F.col(REASON).isNotNull(), F.col("_text")).alias(CORRUPT), "_source_file", "_block_start", "_row_seq",
        F.col(REASON).isNotNull().alias("_rejected"), REASON, F.current_timestamp().alias("_ingestion_ts"),
    )


def with_row_index(bronze: DataFrame) -> DataFrame:
    """Adds ``_row_idx``, the dense 0-based ordinal of a row in its source file.

    Needs stored bronze rows: block sizes are counted in one pass and joined back in another. Only blocks with gaps between
    their line numbers (records over several lines, blank lines, rows set aside) are sorted for it.
    """
    block = ["_source_file", "_block_start"]
    sizes = bronze.groupBy(*block).agg(
        F.min("_row_seq").alias("_first"), F.max("_row_seq").alias("_last"), F.count(F.lit(1)).alias("_size")
    )
    before = Window.partitionBy("_source_file").orderBy("_block_start").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file block
    starts = sizes.select(
        *block, "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        (F.col("_last") - F.col("_first") + 1 == F.col("_size")).alias("_dense"),
    )
    placed = bronze.join(starts, block)
    in_block = Window.partitionBy(*block).orderBy("_row_seq")
    dense = (F.col("_start") + F.col("_row_seq") - F.col("_first")).alias("_row_idx")
    ranked = (F.col("_start") + F.row_number().over(in_block) - 1).alias("_row_idx")
    return placed.filter("_dense").select(*bronze.columns, dense).unionByName(placed.filter("not _dense").select(*bronze.columns, ranked))


def read_typed(spark: SparkSession, path: str, table: Table, encoding: str = UTF8) -> DataFrame:
    """Typed bulk load: the header must equal the definition (optional columns may be absent) and any bad value stops
    the read."""
    header = header_of(spark, path, encoding)
    present = [f for f in table.fields if not f.optional or f.raw in header]
    if header != [f.raw for f in present]:
        raise ValueError(f"{path}: header {header} does not match {[f.raw for f in present]}")
    names = unique_names(header)
    types = {field.name: field.dataType for field in table.schema()}
    schema = T.StructType([T.StructField(n, types[f.name]) for n, f in zip(names, present)])
    rows = (
        spark.read.option("header", True).option("encoding", encoding).option("quote", '"').option("escape", '"')
        .schema(schema).option("mode", "FAILFAST")
        .option("enforceSchema", len(set(header)) != len(header)).csv(path)
        .toDF(*[f.name for f in present])
    )
    return rows.select(*[optional(rows, f.name, f.type).alias(f.name) for f in table.fields])
