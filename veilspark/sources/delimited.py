"""Delimited text in the layouts and encodings in which files are delivered.

Every column is read as text. Layouts that need to know where a file starts, and
encodings other than UTF-8, are read as lines first, still split-parallel: lines of
the first split are counted from the first line of their file. Heads are read as a few KB of
each file where tasks can open the store, else by the pass over the lines that finds where files start; a
second one reads them; each file's columns go by its own header. A file is one text file, or a folder `file_nm=<name>` of parts, as `sources.sinks`
writes it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from veilspark.columns import DATA_META, FAILED, OK
from veilspark.functions.parsing import quoted
from veilspark.operators.joins import keyed_join
from veilspark.sources.heads import head_lines_by_range
from veilspark.sources.scratch import materialise

# Texts that mean "missing" when token handling is asked for (fixed values).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

LAYOUTS = ("headered", "headerless", "preamble")
PREAMBLE_HEADER_ROW = 4
PREAMBLE_ROWS = 8
LEGACY_CHARSETS = "spark.sql.legacy.javaCharsets"


def _delivered(path: Column) -> Column:
    """Path of the delivered file: the folder of its parts, or the file itself."""
    folder = F.regexp_extract(path, r"^(.*/file_nm=[^/]+)/", 1)
    return F.coalesce(F.nullif(folder, F.lit("")), path)


def _decoded(text: Column) -> Column:
    """Text of a path, in which other characters than a few come as %XX; plus signs are plain."""
    escaped = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(text, F.lit("%")), escaped).otherwise(text)


def logical_file(path: str = "_metadata.file_path", name: str = "_metadata.file_name") -> Column:
    """Name of the delivered file a row came from, as it was delivered."""
    folder = F.regexp_extract(F.col(path), r"/file_nm=([^/]+)/", 1)
    # A folder's name is escaped once by the writer of partitions, and once more in the path.
    part = _decoded(_decoded(F.nullif(folder, F.lit(""))))
    return F.coalesce(part, _decoded(F.col(name)))


def _lines(spark: SparkSession, paths: str | Sequence[str], glob: str | None) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # The line number grows within a split; only splits that open a file get one.
    opens = F.col("_metadata.file_block_start") == 0
    return reader.text(paths if isinstance(paths, str) else list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        _delivered(F.col("_metadata.file_path")).alias("_file"),
        F.col("_metadata.file_size").alias("_size"),
        logical_file().alias("file_nm"),
        F.when(opens, F.monotonically_increasing_id()).alias("_line"),
        F.col("_metadata.file_block_start").alias("_split"),
    )


def _with_text(lines: DataFrame, encoding: str, fallback: str) -> DataFrame:
    """Lines with their bytes decoded.

    The setting that admits charsets beyond the UTF family is read when the decode
    is resolved, so it is set only here and put back.
    """
    if encoding.upper() == "UTF-8":
        return lines
    spark = lines.sparkSession
    before = spark.conf.get(LEGACY_CHARSETS)
    spark.conf.set(LEGACY_CHARSETS, "true")
    try:
        if encoding != "auto":
            return lines.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))
        # The source is read once; the verdicts and the lines come from the copy, each from its columns.
        raw = lines.withColumns({"value": F.col("value").cast("binary"), "_valid": F.is_valid_utf8("value")})
        staged = materialise(raw, "lines")
        broken = staged.groupBy("_file").agg((~F.min("_valid")).alias("_foreign"))
        known = keyed_join(staged, materialise(broken, "encodings"), ["_file"], "left")
        other = F.decode("value", fallback)
        text = F.when(F.col("_foreign"), other).otherwise(F.col("value").cast("string"))
        return known.withColumn("value", text).drop("_foreign", "_valid")
    finally:
        spark.conf.set(LEGACY_CHARSETS, before)


def detect_encoding(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, fallback: str = "EUC-KR"
) -> DataFrame:
    """Per file UTF-8, or the fallback if any line of it is not valid UTF-8."""
    valid = F.min(F.is_valid_utf8("value"))
    return (
        _lines(spark, paths, glob)
        .groupBy("_file", "file_nm")
        .agg(F.when(valid, "UTF-8").otherwise(fallback).alias("encoding"))
        .drop("_file")
    )


def _layout(first: Column) -> Column:
    names = F.split(F.upper(first), ",")
    meta = F.array(*[F.lit(name.upper()) for name in DATA_META])
    return (
        F.when(F.size(F.array_except(meta, names)) == 0, "headered")
        .when(F.size(names) > len(DATA_META), "headerless")
        .otherwise("preamble")
    )


def detect_layouts(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None
) -> DataFrame:
    """Layout of every delivered file by its first line.

    All meta columns on it: a header. More than five fields: data without a header.
    Anything else: a preamble, with the header on row 4 and data from row 9. A data
    file of five columns or fewer without a header cannot be told from a preamble;
    name its layout.
    """
    heads = head_lines_by_range(spark, paths, glob, 1, {"file_nm": logical_file()})
    first = _first_lines(_lines(spark, paths, glob)) if heads is None else heads.withColumn("_first", F.get("_lines", F.lit(0)))
    return first.select("file_nm", _layout(F.col("_first")).alias("layout")).distinct()


def _first_lines(lines: DataFrame) -> DataFrame:
    """Number and text of the first line of every part."""
    opening = lines.filter(F.col("_line").isNotNull())
    first = F.min_by("value", "_line").alias("_first")
    return opening.groupBy("_path", "file_nm").agg(F.min("_line").alias("_start"), first)


def _heads(lines: DataFrame, layout: str, columns: Sequence[str] | None, sep: str, ranged: DataFrame | None) -> DataFrame:
    """Layout, rows to skip and column names of every part, stored: a row for each.

    `ranged` has the first lines where they are known; else they are found by passes over the lines.
    """
    if ranged is None:
        heads = materialise(_first_lines(lines), "heads")
    else:
        starts = lines.filter(F.col("_line").isNotNull()).groupBy("_path").agg(F.min("_line").alias("_start"))
        lost = F.raise_error(F.concat(F.lit("the files changed while they were read: "), F.col("_path"))).cast("array<string>")
        known = starts.join(ranged, "_path", "left").withColumn("_lines", F.coalesce("_lines", lost))
        first, fourth = (F.get("_lines", F.lit(row)) for row in (0, PREAMBLE_HEADER_ROW - 1))
        heads = known.select("_path", "file_nm", "_start", first.alias("_first"), fourth.alias("_fourth"))
    if layout == "auto":
        heads = heads.withColumn("layout", _layout(F.col("_first")))
    else:
        heads = heads.withColumn("layout", F.lit(layout))
    if ranged is not None:
        pass
    elif layout in ("auto", "preamble"):
        place = F.col("_line") - F.col("_start") == PREAMBLE_HEADER_ROW - 1
        opening = lines.filter(F.col("_line").isNotNull()).select("_path", "_line", "value")
        starts = heads.filter(F.col("layout") == "preamble").select("_path", "_start")
        fourth = keyed_join(opening, starts, ["_path"]).filter(place)
        heads = heads.join(fourth.select("_path", F.col("value").alias("_fourth")), "_path", "left")
    else:
        heads = heads.withColumn("_fourth", F.lit(None).cast("string"))
    is_ = lambda kind: F.col("layout") == kind
    header = F.when(is_("headered"), F.col("_first")).when(is_("preamble"), F.col("_fourth"))
    given = F.array(*[F.lit(name.strip().upper()) for name in columns or ()]).cast("array<string>")
    names = F.when(is_("headerless"), given).otherwise(header_names(header, sep))
    skip = F.when(is_("headered"), 1).when(is_("preamble"), PREAMBLE_ROWS).otherwise(0)
    return materialise(heads.select("_path", "file_nm", "_start", skip.alias("_skip"), names.alias("_names")), "heads")


def _ranged(spark: SparkSession, paths: str | Sequence[str], glob: str | None, layout: str, encoding: str) -> DataFrame | None:
    """The rows up to the header of each part, of layouts that have several; None if they need decoding or can't be had."""
    if layout not in ("auto", "preamble") or encoding.upper() != "UTF-8":
        return None
    return head_lines_by_range(spark, paths, glob, PREAMBLE_HEADER_ROW, {"file_nm": logical_file()})


def _literal(sep: str) -> str:
    return "".join(f"\\{character}" if not character.isalnum() else character for character in sep)


def header_names(header: Column, sep: str = ",") -> Column:
    """The column names of a header line, in upper case, without quotes, spaces around them and byte mark."""
    text = F.concat(F.lit(sep), F.regexp_replace(F.coalesce(header, F.lit("")), "^\ufeff", ""))
    plain = f"[^{_literal(sep)}]*" if len(sep) == 1 else f"(?:(?!{_literal(sep)}).)*"
    field = rf'{_literal(sep)}( *"(?:[^"]|"")*" *(?={_literal(sep)}|$)|{plain})'
    fields = F.regexp_extract_all(text, F.lit(field), F.lit(1))
    bare = lambda name: F.regexp_replace(F.trim(name), '^"(.*)"$', "$1")
    return F.transform(fields, lambda name: F.upper(F.trim(F.replace(bare(name), F.lit('""'), F.lit('"')))))


def _with_names(
    spark: SparkSession, lines: DataFrame, layout: str, columns: Sequence[str] | None, sep: str, line_breaks: str, most_headers: int,
    ranged: DataFrame | None = None,
) -> tuple:
    """Lines with `_names`, the columns of their file, and `_head`, whether they stand before its data.

    With `line_breaks="read"` a row may be a record of several lines. Also the distinct lists of names.

    The lists come with the first file that has them, the first of all first.
    """
    if layout == "headerless":
        if not columns:
            raise ValueError("a headerless layout takes its names from columns")
        names = [name.strip().upper() for name in columns]
        known = F.array(*[F.lit(name) for name in names])
        lines = _records(lines) if line_breaks == "read" else lines
        return lines.withColumns({"_names": known, "_head": F.lit(False)}), [(names, None)]
    if layout not in ("headered", "preamble", "auto"):
        raise ValueError(f"unknown layout {layout!r}")
    heads = _heads(lines, layout, columns, sep, ranged)
    found = heads.groupBy("_names").agg(F.min("file_nm").alias("file_nm")).orderBy("file_nm", "_names")
    lists = [(list(row["_names"]), row["file_nm"]) for row in found.limit(most_headers + 1).collect()]
    if len(lists) > most_headers:
        raise ValueError(f"more than {most_headers} different headers; allow more by most_headers")
    if layout == "auto" and not columns and any(not names for names, _ in lists):
        raise ValueError("a headerless layout takes its names from columns")
    lines = _records(lines) if line_breaks == "read" else lines
    placed = keyed_join(lines, heads.select("_path", "_start", "_skip", "_names"), ["_path"])
    head = F.coalesce(F.col("_line") - F.col("_start") < F.col("_skip"), F.lit(False))
    return placed.withColumn("_head", head).drop("_start", "_skip"), lists


def _unlike(names: Sequence[str], wanted: Sequence[str]) -> str | None:
    """What is wrong with a header, or None."""
    said = [
        ("has no column " + ", ".join(sorted(set(wanted) - set(names)))) * (not set(wanted) <= set(names)),
        ("has more columns: " + ", ".join(sorted(set(names) - set(wanted)))) * (not set(names) <= set(wanted)),
        "repeats a column" * (len(set(names)) < len(names)),
    ]
    return "; ".join(filter(None, said)) or None


def _dialect(value: Column, sep: str) -> Column:
    """How the fields of a record stand: `fields`, how many there are, and `open`, whether it ends within quotes or has a line break outside.

    The texts between quotes are gone through in order. A quote opens a field only at its start, two
    in a row within one are a quote of its text, and any other stands for itself.
    """
    start, plain, quoted_, closed = 0, 1, 2, 3
    after = {start: quoted_, plain: plain, quoted_: closed, closed: quoted_}

    def step(at: Column, text: Column) -> Column:
        state = F.when(at["state"] < 0, F.lit(start))
        for before, then in after.items():
            state = state.when(at["state"] == before, F.lit(then))
        inside, seps = state == quoted_, F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit("")))
        ended = F.when(inside | (F.length(text) == 0), state).when(F.endswith(text, F.lit(sep)), F.lit(start)).otherwise(F.lit(plain))
        more = F.when(inside, F.lit(0)).otherwise((seps / len(sep)).cast("int"))
        broken = at["broken"] | (~inside & F.contains(text, F.lit("\n")))
        return F.struct(ended.alias("state"), (at["seps"] + more).alias("seps"), broken.alias("broken"))

    first = F.struct(F.lit(-1).alias("state"), F.lit(0).alias("seps"), F.lit(False).alias("broken"))
    last = F.aggregate(F.split(value, '"', -1), first, step)
    return F.struct(((last["state"] == quoted_) | last["broken"]).alias("open"), (last["seps"] + 1).alias("fields"))


def _quotes(value: Column) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))


def _opens(value: Column, sep: str) -> Column:
    """Whether quotes are open at a record's end, or line breaks stand outside of them.

    Only records with an odd number of quotes or with a line break are looked at.
    """
    return F.when((_quotes(value) % 2 == 1) | F.contains(value, F.lit("\n")), _dialect(value, sep)["open"]).otherwise(False)


def _fields(value: Column, sep: str) -> Column:
    """How many fields a record has."""
    return _dialect(value, sep)["fields"]


def _parsed(value: Column, width: int, sep: str) -> Column:
    """A record's fields `_0`, `_1` and so on; `_bad` is not null if it has more or fewer than `width`."""
    kinds = ", ".join([*(f"_{i} string" for i in range(width)), "_bad string"])
    return F.from_csv(value, kinds, {"sep": sep, "escape": '"', "columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})


def _records(lines: DataFrame) -> DataFrame:
    """Lines joined to records over line breaks within quotes, by many tasks for a file.

    An even number of quotes before a line means that it begins a record, so the quotes of each split
    are counted, and their sums over the splits before say where a split begins within quotes.
    Each split then joins its own lines, and the pieces of records that reach over the
    border of splits, two for a split, are put together by file. Quotes stand around whole fields and are
    doubled within them; `_dialect` finds records where that does not hold.
    """
    odd = (F.sum(_quotes(F.col("value"))) % 2).alias("_odd")
    # Tasks that join lines get a number for what is the same in all lines of a split.
    same = ("_file", "_size", "file_nm")
    counted = lines.groupBy("_path", "_split").agg(odd, *[F.any_value(name).alias(name) for name in same])
    splits = materialise(counted.withColumn("_id", F.monotonically_increasing_id()), "quotes")
    before = Window.partitionBy("_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2 == 1
    splits = splits.withColumn("_inside", inside).withColumn("_cut", F.col("_inside") != (F.col("_odd") == 1))
    splits = splits.withColumn("_cut", F.col("_cut") | F.col("_inside")).drop("_odd")
    splits = materialise(splits, "borders")
    moved = F.raise_error(F.lit("the files are cut into other splits than before; keep the settings between reads"))
    raw = lines.select(F.col("value").cast("binary").alias("value"), "_line", "_path", "_split")
    states = splits.select("_path", "_split", "_id", "_inside", "_cut")
    known = keyed_join(raw, states, ["_path", "_split"], "left").withColumn("_inside", F.coalesce("_inside", moved.cast("boolean")))
    known = known.select("value", "_line", "_id", "_inside", "_cut")
    schema = known.drop("_inside", "_cut").withColumn("_piece", F.lit(0)).schema
    text = F.col("value").cast("string")
    named = splits.select("_id", "_path", "_split", *same)
    whole = keyed_join(known.drop("_cut").mapInArrow(_line_joiner(), schema).where("_piece = 0"), named, ["_id"])
    cut = keyed_join(known.where("_cut").drop("_cut").mapInArrow(_line_joiner(), schema).where("_piece > 0"), named, ["_id"])
    # 1 goes on with a record, 2 begins one; the first of a file's pieces begins one.
    place = Window.partitionBy("_path").orderBy("_split", "_piece").rowsBetween(Window.unboundedPreceding, 0)
    record = F.sum(F.when(F.col("_piece") == 2, 1).otherwise(0)).over(place)
    pieces = cut.withColumns({"value": text, "_record": record})
    order = F.sort_array(F.collect_list(F.struct("_split", "_piece", "value")))
    joined = pieces.groupBy("_path", "_record").agg(
        F.array_join(F.transform(order, lambda piece: piece["value"]), "\n").alias("value"),
        *[F.min_by(name, F.struct("_split", "_piece")).alias(name) for name in (*same, "_line", "_split")],
    )
    columns = lines.columns
    return whole.withColumn("value", text).select(*columns).unionByName(joined.select(*columns))


def _line_joiner() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that joins the lines of splits to records, each split in order.

    Rows have `value`, `_line`, `_id` of their split and `_inside`, whether it begins within quotes. They come back
    with `_piece`: 0 for a record, 1 for the rest of one from before the split, 2 for the start of
    one that goes on behind it. A split that lies within a record is a rest as a whole.
    """

    def told(firsts: pa.RecordBatch, values: pa.Array, piece: int) -> pa.RecordBatch:
        some = firsts.set_column(firsts.schema.get_field_index("value"), "value", values).drop_columns(["_inside"])
        return some.append_column("_piece", pa.array([piece] * len(some), pa.int32()))

    def joined(lines: pa.Array, starts: Sequence[int] | np.ndarray) -> pa.Array:
        """The lines from each start to the next, or to the end, as one."""
        bounds = pa.array(np.append(starts, len(lines)), pa.int32())
        filled = pc.fill_null(lines, pa.scalar(b"", lines.type))
        return pc.binary_join(pa.ListArray.from_arrays(bounds, filled), pa.scalar(b"\n", lines.type))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opening, held = None, []  # first line of a record that goes on, and the texts of its lines
        at, inside, rest = None, False, False

        def ended(piece: int) -> pa.RecordBatch:
            return told(opening, pa.array([b"\n".join(held)], opening.column("value").type), piece)

        for batch in batches:
            ids = batch.column("_id").to_numpy()
            quotes = pc.fill_null(pc.count_substring(batch.column("value"), '"'), 0).to_numpy(zero_copy_only=False)
            borders = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1), len(batch)]
            for begin, end in zip(borders, borders[1:]):
                if begin == end:
                    continue
                if ids[begin] != at:
                    if opening is not None:
                        yield ended(1 if rest else 2)
                    at, opening, held = ids[begin], None, []
                    inside = rest = batch.column("_inside")[begin].as_py()
                some = batch.slice(begin, end - begin)
                open_ = (np.cumsum(quotes[begin:end]) + inside) % 2 == 1  # at the end of each line
                begins = ~np.append(inside, open_[:-1])
                done = 0
                if inside:
                    closed = np.flatnonzero(~open_)
                    done = closed[0] + 1 if len(closed) else len(some)
                    opening = some.slice(0, 1) if opening is None else opening
                    held.append(joined(some.column("value").slice(0, done), [0])[0].as_py())
                    if len(closed):
                        yield ended(1 if rest else 0)
                        opening, held, rest = None, [], False
                inside = bool(open_[-1])
                if done == len(some):
                    continue
                left, starts = some.slice(done), np.flatnonzero(begins[done:])
                texts = joined(left.column("value"), starts)
                firsts = left.take(pa.array(starts))
                if inside:
                    opening, held = firsts.slice(len(firsts) - 1), [texts[-1].as_py()]
                    firsts, texts = firsts.slice(0, len(firsts) - 1), texts.slice(0, len(texts) - 1)
                if len(firsts):
                    yield told(firsts, texts, 0)
        if opening is not None:
            yield ended(1 if rest else 2)

    return join


def head_lines(spark: SparkSession, path: str, rows: int, encoding: str = "UTF-8") -> list[str]:
    """The first lines of one file."""
    lines = _with_text(_lines(spark, path, None), encoding, "EUC-KR")
    return [row.value for row in lines.filter(F.col("_line").isNotNull()).select("value").take(rows)]


def file_faults(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: str = "headered",
    columns: Sequence[str] | None = None,
    encoding: str = "UTF-8",
    sep: str = ",",
    glob: str | None = None,
    fallback: str = "EUC-KR",
    line_breaks: str = "refuse",
    most_headers: int = 1000,
) -> DataFrame:
    """A row for each delivered file: data rows, rows too wide and too narrow, open quotes, its header's fault.

    `status` is ok without any fault. The header is held against that of the first file by name.
    With `line_breaks="read"` rows are records, which may hold line breaks within quotes.
    """
    lines = _with_text(_lines(spark, paths, glob), encoding, fallback)
    ranged = _ranged(spark, paths, glob, layout, encoding)
    named, lists = _with_names(spark, lines, layout, columns, sep, line_breaks, most_headers, ranged)
    return _faults(named, lists, sep)


def _faults(named: DataFrame, lists: list[tuple], sep: str) -> DataFrame:
    wanted = lists[0][0] if lists else []
    fault = F.lit(None).cast("string")
    for names, _ in lists:
        said = _unlike(names, wanted)
        if said:
            fault = F.when(F.col("_names") == F.array(*[F.lit(n) for n in names]), said).otherwise(fault)
    filled = named.filter(~F.col("_head") & (F.length(F.trim("value")) > 0))
    value, wide = F.col("value"), F.size("_names")
    simple = ((F.length(value) - F.length(F.replace(value, F.lit(sep), F.lit("")))) / len(sep)).cast("int") + 1
    stands = F.struct(F.lit(False).alias("open"), simple.alias("fields"))
    read = F.when(F.contains(value, F.lit('"')), _dialect(value, sep)).otherwise(stands)
    open_, width = F.col("_read.open"), F.col("_read.fields")
    counted = filled.withColumn("_read", read).groupBy("file_nm").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~open_ & (width > wide)).alias("n_wide"),
        F.count_if(~open_ & (width < wide)).alias("n_narrow"),
        F.count_if(open_).alias("n_open"),
        F.max(fault).alias("header_fault"),
    )
    good = (F.col("n_wide") + F.col("n_narrow") + F.col("n_open") == 0) & F.col("header_fault").isNull()
    return counted.withColumn("status", F.when(good, OK).otherwise(FAILED))


def _read_lines(
    spark: SparkSession,
    lines: DataFrame,
    layout: str,
    columns: Sequence[str] | None,
    sep: str,
    on_width: str,
    line_breaks: str,
    most_headers: int,
    ranged: DataFrame | None,
) -> DataFrame:
    named, lists = _with_names(spark, lines, layout, columns, sep, line_breaks, most_headers, ranged)
    wanted = lists[0][0] if lists else []
    if on_width == "fail_file":
        bad = materialise(_faults(named, lists, sep).filter(F.col("status") != OK).select("file_nm"), "faults")
        named = keyed_join(named, bad, ["file_nm"], "left_anti")
    else:
        for names, file in lists:
            if said := _unlike(names, wanted):
                raise ValueError(f"{file} {said}")
    return _cells(named, [names for names, _ in lists if not _unlike(names, wanted)], sep)


def _cells(named: DataFrame, lists: list[list[str]], sep: str) -> DataFrame:
    """The columns of the first list by name, of records with `_names` and `_head`; a wrong record raises."""
    wanted = lists[0] if lists else []
    value = F.col("value")
    # Rows that a filter drops may still be checked before, so the checks leave them alone.
    left = F.col("_head") | (F.length(F.trim("value")) == 0)
    told = F.concat("file_nm", F.lit(": a line has "), _fields(value, sep).cast("string"), F.lit(f" fields, its file has {len(wanted)}"))
    broken = F.concat("file_nm", F.lit(": quotes are open at the end of a line, or at a line break outside; line breaks within them take line_breaks='read'"))
    text = F.when(left, None).when(_opens(value, sep), F.raise_error(broken)).otherwise(value)
    rows = named.withColumn("_row", _parsed(text, len(wanted), sep)).filter(~left)
    row = F.col("_row")
    kind = rows.schema["_row"].dataType
    checked = F.when(row["_bad"].isNotNull(), F.raise_error(told).cast(kind)).otherwise(row)
    parsed = rows.select("file_nm", "_names", checked.alias("_row"))
    if len(lists) <= 1:
        cells = [F.col(f"_row._{i}").alias(name) for i, name in enumerate(wanted)]
    else:
        every = F.array(*[F.col(f"_row._{i}") for i in range(len(wanted))])
        cells = [F.try_element_at(every, F.array_position("_names", name).cast("int")).alias(name) for name in wanted]
    return parsed.select(*cells, "file_nm")


def _headered(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None, sep: str, parts: DataFrame | None = None
) -> DataFrame:
    """Headered UTF-8 files that all have the same header, in one pass.

    The CSV source leaves out each file's first line, having compared it, and gives the others whole, as no line
    holds this separator; one that does raises.
    """
    reader = spark.read.options(
        header=True, sep="\x00\x01\x00", quote="", enforceSchema=False, recursiveFileLookup=True, mode="FAILFAST"
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.csv(paths if isinstance(paths, str) else list(paths))
    if not raw.columns:
        return raw.select(logical_file().alias("file_nm"))
    header = spark.range(1).select(header_names(F.lit(raw.columns[0]), sep).alias("names")).first()
    names = list(header["names"])
    value = F.col(quoted(raw.columns[0])).alias("value")
    if parts is None:
        rows = raw.select(value, logical_file().alias("file_nm"))
    else:
        rows = keyed_join(raw.select(value, F.col("_metadata.file_path").alias("_path")), parts, ["_path"])
    known = F.array(*[F.lit(name) for name in names])
    return _cells(rows.where("value is not null").withColumns({"_names": known, "_head": F.lit(False)}), [names], sep)


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: str = "headered",
    columns: Sequence[str] | None = None,
    encoding: str = "UTF-8",
    missing: str = "null",
    sep: str = ",",
    glob: str | None = None,
    fallback: str = "EUC-KR",
    headers: str = "same",
    on_width: str = "fail",
    line_breaks: str = "refuse",
    most_headers: int = 1000,
    parts: DataFrame | None = None,
) -> DataFrame:
    """All files as one frame of text columns with upper-case names, plus `file_nm`.

    `layout` is `headered`, `headerless` (names from `columns`), `preamble` or `auto`.
    `encoding` may be `auto`: UTF-8, else the fallback, decided per file over all its
    lines. `missing` keeps Spark's reading of empty fields as null, turns the listed
    `tokens` into null too, or makes all of them empty text (`keep`). `glob` picks
    files by name.

    Fields may stand in quotes, and a quote within is doubled; a quote elsewhere stands for itself.
    Columns go by each file's own header; headered UTF-8 files that all have the `same` are read
    in one pass, which raises where one differs, and `headers="by_name"` allows another
    order. A line with more or fewer fields than its file has columns, or with quotes open at its end,
    raises, or with `on_width="fail_file"` its file is left out, as is one whose header has other names;
    `file_faults` reports them. With `line_breaks="read"` a field in quotes may hold line breaks, in all
    layouts and still with many tasks for a file, for two more passes; there a quote may stand only around fields
    and doubled within them. `most_headers` bounds the distinct headers of a read. `parts`, a row for each part with `_path` as in
    `_metadata.file_path` and `file_nm`, restricts the rows to those files, whose names are then not worked out for each line.
    """
    if headers not in ("same", "by_name"):
        raise ValueError("headers is 'same' or 'by_name'")
    if on_width not in ("fail", "fail_file"):
        raise ValueError("on_width is 'fail' or 'fail_file'")
    if line_breaks not in ("refuse", "read"):
        raise ValueError("line_breaks is 'refuse' or 'read'")
    plain = layout == "headered" and encoding.upper() == "UTF-8" and headers == "same" and on_width == "fail"
    if plain and line_breaks == "refuse":
        table = _headered(spark, paths, glob, sep, parts)
    else:
        lines = _with_text(_lines(spark, paths, glob), encoding, fallback)
        ranged = _ranged(spark, paths, glob, layout, encoding)
        table = _read_lines(spark, lines, layout, columns, sep, on_width, line_breaks, most_headers, ranged)
        if parts is not None:
            table = keyed_join(table, parts.select("file_nm").distinct(), ["file_nm"], "left_semi").select(*table.columns)
    return _missing(table, missing)


def _missing(table: DataFrame, missing: str) -> DataFrame:
    values = table.columns[:-1]
    if missing == "keep":
        return table.fillna("", values)
    if missing == "tokens":
        cells = [
            F.when(~F.col(f"`{name}`").isin(*NULL_TOKENS), F.col(f"`{name}`")).alias(name)
            for name in values
        ]
        return table.select(*cells, "file_nm")
    if missing != "null":
        raise ValueError("missing is 'null', 'tokens' or 'keep'")
    return table


def file_headers(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, sep: str = ","
) -> DataFrame:
    """Header columns of every headered file as rows: file, position from 1, name.

    Parts of one delivered file that agree on the header give its rows once.
    """
    file = {"_file": _delivered(F.col("_metadata.file_path")), "file_nm": logical_file()}
    heads = head_lines_by_range(spark, paths, glob, 1, file)
    if heads is None:
        lines = _lines(spark, paths, glob).filter(F.col("_line").isNotNull())
        first = lines.groupBy("_path", "_file", "file_nm").agg(F.min_by("value", "_line").alias("value"))
    else:
        first = heads.withColumn("value", F.get("_lines", F.lit(0)))
    names = F.posexplode(header_names(F.col("value"), sep)).alias("pos", "var_cd")
    rows = first.select("_file", "file_nm", names).distinct()
    return rows.select("file_nm", (F.col("pos") + 1).alias("pos"), "var_cd")


def file_inventory(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, sep: str = ",", line_breaks: str = "refuse"
) -> DataFrame:
    """Bytes, data rows and columns of every headered file, in one pass over the lines.

    With `line_breaks="read"` rows are records, which may hold line breaks within quotes.
    """
    lines = _lines(spark, paths, glob)
    lines = _records(lines) if line_breaks == "read" else lines
    parts = lines.groupBy("_path", "_file", "file_nm").agg(
        F.max("_size").alias("file_sz"),
        (F.count(F.lit(1)) - 1).alias("datum_cnt"),
        F.min_by(F.when(F.col("_line").isNotNull(), F.size(header_names(F.col("value"), sep))), F.col("_line")).alias("var_ea"),
    )
    return (
        parts.groupBy("_file", "file_nm")
        .agg(
            F.sum("file_sz").alias("file_sz"),
            F.sum("datum_cnt").alias("datum_cnt"),
            F.max("var_ea").cast("bigint").alias("var_ea"),
        )
        .drop("_file")
    )
