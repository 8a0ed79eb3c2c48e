"""Dirty CSV exports: dialects of many files, tolerant scan, audit of odd records."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealerlake.functions.clean import null_token
from dealerlake.session import few, met, noted, setting, written

UTF8, LATIN1 = "utf-8-sig", "latin-1"
BOM = "\ufeff"

# Columns of the scan that say where a record stands: file, byte offset of the split, order in it.
FILE, SPLIT, SEQ = "_file", "_split", "_seq"
POSITION = (FILE, SPLIT, SEQ)


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines as raw bytes in a string column, with their position."""
    return spark.read.text(list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(SPLIT),
        F.monotonically_increasing_id().alias(SEQ),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _decoded(line: Column, encoding: Column) -> Column:
    return F.when(encoding == LATIN1, F.decode(line.cast("binary"), "ISO-8859-1")).otherwise(line)


# A quoted field ends at its closing quote, or with the text when it has none.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_CLOSED = f'(?s)^"({_QUOTED[1:]})(?:"|\\z)'


def _fields_by(record: Column, sep: str) -> Column:
    pattern = f'{sep}((?:{_QUOTED}(?:"|\\z))?+[^{sep}]*+)'
    return F.regexp_extract_all(F.concat(F.lit(sep), record), F.lit(pattern), F.lit(1))


def _fields(record: Column, sep: Column) -> Column:
    """Raw fields of a record, however many; a quote opens a quoted field only at its start."""
    return F.when(sep == ";", _fields_by(record, ";")).otherwise(_fields_by(record, ","))


def _parsed(text: Column, sep: Column) -> Column:
    """Raw fields of a record, none of a blank one. Lines without quotes, most of them, are only split."""
    plain = F.when(sep == ";", F.split(text, ";")).otherwise(F.split(text, ","))
    fields = F.when(F.contains(text, F.lit('"')), _fields(text, sep)).otherwise(plain)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(fields)


def _unquoted(field: Column) -> Column:
    """A field without its quotes; doubled ones inside them are one, what follows the closing one is left as it is."""
    inner = F.replace(F.regexp_extract(field, _CLOSED, 1), F.lit('""'), F.lit('"'))
    return F.when(field.startswith('"'), F.concat(inner, F.regexp_replace(field, _CLOSED, ""))).otherwise(field)


def _left_open(line: Column, sep: str) -> Column:
    """Whether the line ends inside quotes, when it begins outside them."""
    last = F.element_at(_fields_by(line, sep), -1)
    closed = last.rlike(f'^{_QUOTED}"')
    return F.when(F.contains(line, F.lit('"')), last.startswith('"') & ~closed).otherwise(False)


def _splits(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per split of a file, from one scan of the lines: what decides the file's dialect and its line numbers."""
    lines = _lines(spark, paths)
    candidate = (F.col(SPLIT) == 0) & (F.col("value") != "")
    header = F.min_by(F.when(candidate, F.col("value")), F.when(candidate, F.col(SEQ)))
    # A set of the two possible answers, as it lets the aggregate hash; with plain columns and a
    # text among them it would sort all lines first.
    valid = F.collect_set(F.is_valid_utf8("value"))
    return lines.groupBy(FILE, SPLIT).agg(
        valid.alias("valid"),
        header.alias("header"),
        F.min(F.when(candidate, F.col(SEQ))).alias("header_seq"),
        F.min(SEQ).alias("first"),
        F.count("*").alias("size"),
        F.max("bytes").alias("bytes"),
        F.max("modified").alias("modified"),
        F.collect_set(_left_open(F.col("value"), ";")).alias("open_semicolon"),
        F.collect_set(_left_open(F.col("value"), ",")).alias("open_comma"),
    )


def _dialects(splits: DataFrame) -> DataFrame:
    """One row per file: path, encoding, sep, header fields, repeated names, where the header stands, whether records span lines."""
    files = splits.groupBy(F.col(FILE).alias("path")).agg(
        F.flatten(F.collect_set("valid")).alias("valid"),
        F.max("header").alias("header"),
        F.max("header_seq").alias("header_seq"),
        F.max("bytes").alias("bytes"),
        F.max("modified").alias("modified"),
        F.flatten(F.collect_set("open_semicolon")).alias("open_semicolon"),
        F.flatten(F.collect_set("open_comma")).alias("open_comma"),
    )
    encoding = F.when(F.array_contains("valid", False), LATIN1).otherwise(UTF8)
    dialects = files.filter(F.col("header").isNotNull()).withColumn("encoding", encoding)
    dialects = dialects.withColumn("line", F.replace(_decoded(F.col("header"), F.col("encoding")), F.lit(BOM), F.lit("")))
    sep = F.when(_count("line", ";") > _count("line", ","), ";").otherwise(",")
    opens = F.when(F.col("sep") == ";", F.array_contains("open_semicolon", True)).otherwise(F.array_contains("open_comma", True))
    return (
        dialects.withColumn("sep", sep)
        .withColumn("header", F.transform(_fields(F.col("line"), F.col("sep")), _unquoted))
        .select(
            "path", "encoding", "sep", "header", _repeated(F.col("header")).alias("repeated"),
            "header_seq", opens.alias("spans"), "bytes", "modified",
        )
    )


def detect_dialects(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row (path, encoding, sep, header fields, repeated names) per file, from one scan of the lines.

    A file is UTF-8 when all of its bytes are, else Latin-1. The delimiter is the one of ``,`` and
    ``;`` that occurs more often in the header line; a tie gives ``,``.
    """
    found = _dialects(_splits(spark, [paths] if isinstance(paths, str) else paths))
    return found.select("path", "encoding", "sep", "header", "repeated")


def _count(column: str, mark: str) -> Column:
    return F.length(column) - F.length(F.replace(F.col(column), F.lit(mark), F.lit("")))


def _repeated(fields: Column) -> Column:
    """Normalized names that occur more than once in a header."""
    names = F.transform(fields, lambda f: F.regexp_replace(F.replace(F.trim(f), F.lit(" "), F.lit("_")), "_{2,}", "_"))
    return F.array_distinct(F.filter(names, lambda n: F.size(F.filter(names, lambda m: m == n)) > 1))


def normalized_name(name: str) -> str:
    """Header name without byte-order mark and outer blanks, inner blanks as single underscores."""
    return re.sub(r"_{2,}", "_", name.replace(BOM, "").strip().replace(" ", "_"))


def column_names(header: Sequence[str], normalize: bool = True) -> list[str]:
    """Unique column names of a header: empty ones become ``unnamed``, repeats get ``_1``, ``_2``, ..."""
    names: list[str] = []
    taken: set[str] = set()
    for raw in header:
        name = normalized_name(raw) if normalize else raw.replace(BOM, "")
        name = name or "unnamed"
        candidate, k = name, 0
        while candidate.lower() in taken:
            k += 1
            candidate = f"{name}_{k}"
        names.append(candidate)
        taken.add(candidate.lower())
    return names


def _layouts(dialects: DataFrame, expected: Sequence[str], normalize: bool) -> tuple[list[str], DataFrame]:
    """All column names, and per distinct header the place of each in it. Only distinct headers come to the driver."""
    rows = dialects.groupBy("header").agg(F.min("path").alias("path")).orderBy("path").collect()
    columns: dict[str, None] = {}
    named = []
    for row in rows:
        names = column_names(row.header, normalize)
        missing = [c for c in expected if c not in names]
        if missing:
            raise ValueError(f"expected columns missing in {row.path}: {missing}; present: {names}")
        columns |= dict.fromkeys(names)
        named.append((list(row.header), names))
    places = [(header, len(header), [names.index(c) if c in names else None for c in columns]) for header, names in named]
    schema = T.StructType(
        [
            T.StructField("header", T.ArrayType(T.StringType())),
            T.StructField("width", T.IntegerType()),
            T.StructField("places", T.ArrayType(T.IntegerType())),
        ]
    )
    return list(columns), dialects.sparkSession.createDataFrame(places, schema)


#: Characters of a record that spans lines; a longer one is not loaded but listed, by its beginning.
MAX_RECORD = 1 << 24
LISTED = 1 << 16


def _states(rows: DataFrame, group: Sequence[str], order: str, entry: Column) -> DataFrame:
    """``rows`` (outside, inside: the state after a row that is met outside or inside quotes) gain ``before`` and ``after``, the states on either side.

    Rows of a ``group`` come by ``order``, the first in state ``entry``; 1 is inside quotes. A row either leads to one state whatever went before, or
    keeps the state, or turns it. So a state is the number of turns since the last row of the first kind, or since the entry.
    """
    along = Window.partitionBy(*group).orderBy(order)
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    turn = F.when((F.col("outside") == 1) & (F.col("inside") == 0), 1).otherwise(0)
    counted = rows.withColumn("_turns", F.sum(turn).over(so_far))
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct("outside", "_turns"))
    counted = counted.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(so_far))
    since = F.col("_turns") - F.coalesce(F.col("_fixed._turns"), F.lit(0))
    placed = counted.withColumn("after", (F.coalesce(F.col("_fixed.outside"), entry) + since) % 2).drop("_turns", "_fixed")
    return placed.withColumn("before", F.coalesce(F.lag("after").over(along), entry))


def _walkers(limit: int):
    """(ways, records): functions on Arrow batches of lines, those of a piece (a split of a file) behind one another in their order."""

    # Imported and defined within this function, so that it travels to the workers as it is: they need not have this package.
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def walked(outside, inside, entry):
        """The states before lines that come one after another, and after them, by the rule of ``_states``; NumPy arrays."""
        turns = np.cumsum((outside == 1) & (inside == 0))
        fixed = np.maximum.accumulate(np.where(outside == inside, np.arange(len(outside)), -1))
        since = turns - np.where(fixed >= 0, turns[fixed], 0)
        after = (np.where(fixed >= 0, outside[fixed], entry) + since) % 2
        return np.concatenate([[entry], after[:-1]]), after

    def runs(batches, *columns):
        """(piece, NumPy arrays of the columns, texts) of runs of lines of one piece, as they come."""
        for batch in batches:
            pieces = batch.column("piece").to_numpy()
            ends = np.append(np.flatnonzero(pieces[1:] != pieces[:-1]) + 1, len(pieces))
            for start, end in zip(np.append(0, ends[:-1]), ends):
                if end > start:
                    run = batch.slice(start, end - start)
                    yield int(pieces[start]), [run.column(c).to_numpy() for c in columns], run.column("text") if "text" in run.schema.names else None

    def ways(batches):
        """A row per piece: the state it is left in and the records begun there, when entered outside and inside quotes."""
        names = ["piece", "outside", "inside", "begun_outside", "begun_inside"]
        at, found = None, [0, 1, 0, 0]
        for piece, (outside, inside), _ in runs(batches, "outside", "inside"):
            if at is not None and piece != at:
                yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, [at, *found])})
                found = [0, 1, 0, 0]
            at = piece
            for way in (0, 1):
                before, after = walked(outside, inside, found[way])
                found[way] = int(after[-1])
                found[2 + way] += int((before == 0).sum())
        if at is not None:
            yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, [at, *found])})

    def records(batches):
        """The records of pieces: (piece, number of the record there, seq of its first line, size, text, edge). What is open on either side of a piece
        is an ``edge``; number 0 continues a record. Lines of a record beyond ``limit`` characters are left behind."""
        names = ["piece", "number", "seq", "size", "text", "edge"]

        def shut(edge):
            text = "\n".join(t for part in rest["texts"] for t in part.to_pylist())
            values = [rest["piece"], rest["number"], rest["seq"], rest["size"], text, edge or rest["number"] == 0]
            return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, values)})

        rest, at, state, count = None, None, 0, 0
        for piece, (seq, size, entry, outside, inside), texts in runs(batches, "seq", "size", "entry", "outside", "inside"):
            if piece != at:
                if rest:
                    yield shut(True)
                rest, at, state, count = None, piece, int(entry[0]), 0
            before, after = walked(outside, inside, state)
            state = int(after[-1])
            starts = np.flatnonzero(before == 0)
            head = starts[0] if len(starts) else len(seq)
            if head:
                rest = rest or {"piece": piece, "number": 0, "seq": int(seq[0]), "size": 0, "texts": []}
                upto = rest["size"] + np.cumsum(size[:head])
                rest["texts"].append(texts.slice(0, head).filter(pa.array(upto <= limit)))
                rest["size"] = int(upto[-1])
            if rest and after[head - 1] == 0:
                yield shut(False)
                rest = None
            if not len(starts):
                continue
            bounds = np.append(starts, len(seq))
            sizes, upto = np.add.reduceat(size, starts), np.cumsum(size)
            begun = np.repeat(upto[starts] - size[starts], np.diff(bounds))
            keep = upto[head:] - begun <= limit
            kept, places = texts.slice(head).filter(pa.array(keep)), np.append(0, np.cumsum(keep))[bounds - head]
            whole = len(starts) - state
            if whole:
                offsets = pa.array(places[: whole + 1], pa.int32())
                joined = pc.binary_join(pa.ListArray.from_arrays(offsets, kept), "\n")
                columns = [np.full(whole, piece), count + 1 + np.arange(whole), seq[starts[:whole]], sizes[:whole], joined, np.zeros(whole, bool)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
            count += len(starts)
            if state:
                rest = {"piece": piece, "number": count, "seq": int(seq[starts[-1]]), "size": int(sizes[-1]), "texts": [kept.slice(places[-2])]}
        if rest:
            yield shut(True)

    return ways, records


#: Bounds what a Python worker holds of the lines.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000", "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 26)}


def _joined_records(lines: DataFrame, splits: DataFrame, files: DataFrame) -> DataFrame:
    """Records of files in which quotes span lines: (file, split, seq of the first line, number of the record, text, whether it is too long).

    Each split of a file is walked for itself, by the task that scans it: first to learn in which state it would be left, had it been entered outside or inside
    quotes; these pairs, one row per split, are walked file by file and give every split the state it is entered in, and the number of
    records before it. Then records are put together within each split as its lines are scanned, and across its borders only what is open there: no line is
    shuffled or sorted for it. Texts of a record beyond MAX_RECORD are left behind, where it is too long.
    """
    sep, text = F.col("sep"), F.col("text")
    spark = lines.sparkSession

    def ends_open(line: Column) -> Column:
        return F.when(sep == ";", _left_open(line, ";")).otherwise(_left_open(line, ",")).cast("int")

    split = [FILE, SPLIT]
    # A number for each split, so that lines need not carry the path of their file.
    pieces = written(splits.select(*split).join(files.filter("spans").select(F.col("path").alias(FILE)), FILE).select(*split, F.monotonically_increasing_id().alias("piece")))
    n_pieces = pieces.count()
    # What a line does inside quotes is what it does outside after a quote. Without any quote it keeps the state.
    quoted = F.contains(text, F.lit('"'))
    inside = F.when(quoted, ends_open(F.concat(F.lit('"'), text))).otherwise(1)
    marked = lines.withColumns({"outside": F.when(quoted, ends_open(text)).otherwise(0), "inside": inside})

    def by_piece(entered: DataFrame, *columns) -> DataFrame:
        """Lines in the order of their split, a split's behind one another: as the scan gives them, unless the splits are too many to be sent to its tasks."""
        numbered_lines = marked.join(met(entered, n_pieces), split).select("piece", *columns, "outside", "inside")
        return numbered_lines if few(n_pieces) else numbered_lines.repartition("piece").sortWithinPartitions("piece", "seq")

    about = ["sep", "header_seq", "width", "places"]
    ways_of, records_of = _walkers(MAX_RECORD)
    with ExitStack() as settings:
        for key, value in _BATCHES.items():
            settings.enter_context(setting(spark, key, value))
        ways = by_piece(pieces, F.col(SEQ).alias("seq")).mapInArrow(ways_of, "piece long, outside long, inside long, begun_outside long, begun_inside long")
        entered = _states(written(ways).join(pieces, "piece"), [FILE], SPLIT, F.lit(0))
        begun = F.when(F.col("before") == 0, F.col("begun_outside")).otherwise(F.col("begun_inside"))
        ahead = F.sum(begun).over(Window.partitionBy(FILE).orderBy(SPLIT)) - begun
        entered = written(entered.select("piece", *split, F.col("before").cast("int").alias("entry"), ahead.alias("ahead")))
        size = F.length("text").cast("long") + 1
        columns = [F.col(SEQ).alias("seq"), size.alias("size"), F.when(size <= MAX_RECORD, text).otherwise("").alias("text"), "entry"]
        found = by_piece(entered, *columns).mapInArrow(records_of, "piece long, number long, seq long, size long, text string, edge boolean")
        found = written(found)

    known = entered.join(files.select(F.col("path").alias(FILE), *about), FILE)
    near = found.join(met(known, n_pieces), "piece").withColumn("line_number", F.col("ahead") + F.col("number")).withColumnRenamed("seq", SEQ)
    columns = [FILE, "line_number", SPLIT, SEQ, "text", "long", *about]
    alone = near.filter(~F.col("edge")).withColumn("long", F.col("size") > MAX_RECORD).select(*columns)
    upto = F.sum("size").over(Window.partitionBy(FILE, "line_number").orderBy(SPLIT))
    parts = near.filter("edge").withColumn("upto", upto).withColumn("text", F.when((F.col("upto") <= MAX_RECORD) | (F.col("upto") == F.col("size")), F.col("text")))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct(SPLIT, "text")))), lambda r: r["text"]), "\n")
    across = parts.groupBy(FILE, "line_number").agg(
        F.min(SPLIT).alias(SPLIT), F.min(SEQ).alias(SEQ), whole.alias("text"), (F.sum("size") > MAX_RECORD).alias("long"), *[F.first(c).alias(c) for c in about]
    )
    return alone.unionByName(across.select(*columns))


def _scan(spark: SparkSession, paths: Sequence[str], splits: DataFrame, files: DataFrame) -> DataFrame:
    """Every record after its header: position, line_number, raw fields, the header's width and the columns' places in it."""
    about = ["encoding", "sep", "header_seq", "spans", "width", "places"]
    files = written(files)
    n_files, n_splits = files.count(), splits.count()
    lines = (
        _lines(spark, paths)
        .join(met(files.select(F.col("path").alias(FILE), *about), n_files), FILE)
        .withColumn("text", _decoded(F.col("value"), F.col("encoding")))
        .drop("value", "encoding", "bytes", "modified")
    )
    before = F.sum("size").over(Window.partitionBy(FILE).orderBy(SPLIT)) - F.col("size")
    starts = splits.select(FILE, SPLIT, "first", before.alias("before"))
    plain = (
        lines.filter(~F.col("spans"))
        .join(met(starts, n_splits), [FILE, SPLIT])
        .withColumn("line_number", F.col("before") + F.col(SEQ) - F.col("first") + 1)
    )
    columns = [*POSITION, "line_number", "text", "sep", "header_seq", "width", "places"]
    records = plain.select(*columns, F.lit(False).alias("long"))
    spanning = files.filter("spans").count()
    if spanning:
        joined = _joined_records(lines.filter("spans"), splits, files).select(*columns, "long")
        records = joined if spanning == n_files else records.unionByName(joined)
    fields = F.when(F.col("long"), F.array(F.substring("text", 1, LISTED))).otherwise(_parsed(F.col("text"), F.col("sep")))
    parsed = records.filter((F.col(SEQ) > F.col("header_seq")) | (F.col(SPLIT) > 0))
    parsed = parsed.select(*POSITION, "line_number", fields.alias("fields"), "width", "places", "long")
    return parsed.withColumn("n_fields", F.when(F.col("long"), -1).otherwise(F.size("fields"))).drop("long")


def read_dirty_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    expected: Sequence[str] | None = None,
    normalize: bool = True,
    staged: bool = False,
    loaded: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, rejects, dialects) of CSV files whose encoding, delimiter and header may differ.

    Records are all text, with missing-value texts as null and their position in ``POSITION``. Short
    records are padded with nulls, long ones and blank lines left out, however long. Rejects lists
    every record whose field count differs from the header, short ones included, by the fields that
    the records have too. Line breaks inside quotes belong to their field; the files that have such are
    found by the first scan, and their line_number counts records. A quote that is never closed reaches to the
    end of its file; a record of more than MAX_RECORD characters is listed with -1 fields and its first LISTED characters.

    The first scan runs here and decides dialects and line numbers; the second parses. Nothing per file
    comes to the driver: files meet their dialect in a join, which Spark broadcasts while it is small.
    ``staged`` writes the parsed records, so that records and rejects together scan the files once. Files in
    ``loaded`` (path, bytes, modified) are left out.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    splits = written(_splits(spark, paths))
    dialects = written(_dialects(splits))
    if loaded is not None:
        dialects = dialects.join(loaded, ["path", "bytes", "modified"], "left_anti")
    columns, layouts = _layouts(dialects, expected or (), normalize)
    if not columns and loaded is None:
        raise FileNotFoundError(f"no CSV records under {paths}")
    scan = _scan(spark, paths, splits, dialects.join(layouts, "header"))
    scan = written(scan) if staged else scan
    n_fields = F.col("n_fields")
    values = [null_token(_unquoted(F.get("fields", F.get("places", F.lit(i))))).alias(c) for i, c in enumerate(columns)]
    records = scan.filter((n_fields > 0) & (n_fields <= F.col("width"))).select(*values, *POSITION)
    rejects = scan.filter(n_fields != F.col("width")).select(
        F.col(FILE).alias("path"),
        "line_number",
        n_fields,
        F.array_join(F.transform("fields", _unquoted), "|").alias("raw_row"),
    )
    return records, rejects, dialects.select("path", "encoding", "sep", "header", "repeated", "bytes", "modified")


# ---------------------------------------------------------------- loads: one scan of the lines

#: What becomes of a line: the header or a line equal to it, a row, a row that is refused, or no row at all.
FATE, HEAD, ROW, REFUSED, NONE = "_fate", "head", "row", "refused", "none"
#: Kept of every line, beside its position: fields it should not have or lack, their number, and its record number where the scan knows it.
ODD, N_FIELDS, LINE = "_odd", "_n_fields", "_line"
#: Lines a task reads of a file to find its header; blank ones before it included.
_HEADER_LINES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "64", "spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50)}


def file_heads(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row (path, bytes, modified, line) per file that is not empty: its first line that is not blank, as bytes. Each file is opened
    by a task of its own, which reads no further."""

    # Within this function, so that it travels to the workers as it is: they need not have this package.
    def first_lines(batches):
        for batch in batches:
            for i, line in enumerate(batch.column("line")):
                if len(line.as_buffer()):
                    yield batch.slice(i, 1)
                    return

    with ExitStack() as settings:
        for key, value in _HEADER_LINES.items():
            settings.enter_context(setting(spark, key, value))
        lines = _lines(spark, paths).select(F.col(FILE).alias("path"), "bytes", "modified", F.col("value").cast("binary").alias("line"))
        return noted(lines.mapInArrow(first_lines, "path string, bytes long, modified timestamp, line binary"), "path")


def _with_headers(heads: DataFrame) -> DataFrame:
    """``file_heads`` with separator and header fields; a header is read in its own encoding."""
    raw = F.col("line").cast("string")
    text = F.when(F.is_valid_utf8(raw), raw).otherwise(F.decode("line", "ISO-8859-1"))
    read = heads.withColumn("text", F.replace(text, F.lit(BOM), F.lit("")))
    read = read.withColumn("sep", F.when(_count("text", ";") > _count("text", ","), ";").otherwise(","))
    return read.withColumn("header", F.transform(_fields(F.col("text"), F.col("sep")), _unquoted)).drop("text")


@dataclass(frozen=True)
class Load:
    """The records of CSV files, parsed and shaped in one scan of their lines, in a table of their own.

    ``rows`` and ``refused`` have the columns that the shape gave, ``rejects`` those of ``read_dirty_csv``, ``files`` (path, bytes, modified).
    ``sizes`` has the number of rows and refused rows, ``odd`` bounds that of rejects; ``rows`` come with ``NAME`` and ``PLACE``, see ``numbered``.
    """

    rows: DataFrame
    refused: DataFrame
    rejects: DataFrame
    files: DataFrame
    groups: DataFrame
    sizes: dict[str, int]
    odd: int


#: A row's written file and its place there.
NAME, PLACE = "_name", "_place"


def load_files(spark: SparkSession, paths: str | Sequence[str], shape: Callable[[DataFrame, tuple[str, ...]], DataFrame], loaded: DataFrame | None = None) -> Load | None:
    """Parses the files that are not in ``loaded`` (path, bytes, modified), None if there are none; see ``Load``.

    ``shape(records, kept)`` makes rows of the records' text columns; it keeps the columns named in ``kept`` and the order of rows, and may add a
    REASON why a row is refused.

    Header and separator are known from the first line of each file. The lines are then scanned once, on two assumptions: that a line that is not
    UTF-8 belongs to a Latin-1 file and any other to a UTF-8 one, and that no record spans lines. The scan also notes
    which lines speak against it: files that hold both lines that are no UTF-8 and others beyond ASCII, or a line that ends within quotes. Only those files
    are read again, by ``read_dirty_csv``'s way. What was parsed is written once, each fate for itself in the order of positions.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    heads = file_heads(spark, paths)
    if loaded is not None:
        heads = heads.join(loaded, ["path", "bytes", "modified"], "left_anti")
    heads = _with_headers(heads)
    columns, layouts = _layouts(heads, (), True)
    if not columns:
        return None
    n_files = heads.count()
    files = met(heads.join(layouts, "header").select(F.col("path").alias(FILE), F.col("line").alias("head"), "sep", "width", "places"), n_files)
    line = F.col("value")
    valid = F.is_valid_utf8(line)
    lines = _lines(spark, paths).join(files, FILE).withColumn("text", F.when(valid, line).otherwise(F.decode(line.cast("binary"), "ISO-8859-1")))
    quoted = F.contains("text", F.lit('"'))
    open_ = F.when(F.col("sep") == ";", _left_open(F.col("text"), ";")).otherwise(_left_open(F.col("text"), ","))
    parsed = lines.select(
        *POSITION,
        F.lit(None).cast("long").alias(LINE),
        _parsed(F.col("text"), F.col("sep")).alias("fields"),
        "width",
        "places",
        ((F.col(SPLIT) == 0) & (line.cast("binary") == F.col("head"))).alias("_first"),
        (~valid).alias("_latin"),
        (valid & (F.length(line) != F.octet_length(line))).alias("_wide"),
        (quoted & open_).alias("_open"),
    ).withColumn("n_fields", F.size("fields"))
    whole, groups = _shaped(parsed, columns, shape, in_order=few(n_files))

    doubtful = groups.groupBy(FILE).agg(*[F.max(c).alias(c) for c in ("_latin", "_wide", "_open")]).where("_open OR (_latin AND _wide)").select(FILE)
    again = [r[0] for r in doubtful.limit(1).collect()]
    if again:
        doubtful = written(doubtful)
        wrong = doubtful.select(F.col(FILE).alias("path"))
        splits = written(_splits(spark, paths).join(doubtful, FILE, "left_semi"))
        dialects = written(_dialects(splits).join(wrong, "path", "left_semi"))
        scan = _scan(spark, paths, splits, dialects.join(layouts, "header"))
        flags = [F.lit(False).alias(c) for c in ("_first", "_latin", "_wide", "_open")]
        more, more_groups = _shaped(scan.select(*POSITION, F.col("line_number").alias(LINE), "fields", "width", "places", *flags, "n_fields"), columns, shape)
        whole = whole.join(doubtful, FILE, "left_anti").unionByName(more)
        groups = noted(groups.join(doubtful, FILE, "left_anti").unionByName(more_groups), FILE, SPLIT, NAME, FATE)

    # The first line that equals the header is the header; others are rows like any.
    n_groups = groups.count()
    header = groups.where((F.col(FATE) == HEAD) & (F.col(SPLIT) == 0)).groupBy(FILE).agg(F.min("seq").alias("header_seq"))
    kept = groups.join(header, FILE, "left").withColumn("heads", ((F.col(FATE) == HEAD) & (F.col("seq") == F.col("header_seq"))).cast("long"))
    fate = F.when(F.col(FATE) != HEAD, F.col(FATE)).otherwise(F.when(F.col("refused"), REFUSED).otherwise(ROW))
    kept = kept.select(NAME, FATE, FILE, SPLIT, fate.alias("becomes"), "odd", (F.col("n") - F.col("heads")).alias("n"), (F.col("place") + F.col("heads")).alias("first_place"))
    found = kept.groupBy("becomes").agg(F.sum("n").alias("n"), F.sum("odd").alias("odd")).collect()
    sizes = {r["becomes"]: r["n"] for r in found if r["n"]}
    starts = F.sum("n").over(Window.partitionBy(FILE).orderBy(SPLIT)) - F.col("n")
    header = met(header, n_groups)
    lines_before = groups.groupBy(FILE, SPLIT).agg(F.sum("n").alias("n"), F.min("seq").alias("first_seq")).select(FILE, SPLIT, "first_seq", starts.alias("lines_before"))

    def of(becomes: str) -> DataFrame:
        mine = kept.where((F.col("becomes") == becomes) & (F.col("n") > 0)).select(NAME, FATE, FILE, SPLIT, "first_place")
        return whole.join(met(mine, n_groups), [NAME, FATE, FILE, SPLIT]).where(F.col(PLACE) >= F.col("first_place"))

    odd = whole.where(F.col(ODD).isNotNull()).join(header, FILE, "left").where("header_seq IS NULL OR _split > 0 OR _seq > header_seq")
    odd = odd.join(met(lines_before, n_groups), [FILE, SPLIT])
    number = F.coalesce(F.col(LINE), F.col("lines_before") + F.col(SEQ) - F.col("first_seq") + 1)
    rejects = odd.select(F.col(FILE).alias("path"), number.alias("line_number"), F.col(N_FIELDS).alias("n_fields"), F.array_join(F.transform(ODD, _unquoted), "|").alias("raw_row"))
    internal = [FATE, *POSITION, LINE, ODD, N_FIELDS, "first_place"]
    rows, refused = (of(f).drop(*[c for c in internal if c not in POSITION]) for f in (ROW, REFUSED))
    taken = kept.where(F.col("becomes") == ROW).drop("odd")
    odd_lines = sum(r["odd"] for r in found)
    return Load(rows.drop(SEQ), refused.drop(*POSITION, NAME, PLACE), rejects, heads.select("path", "bytes", "modified"), taken, sizes, odd_lines)


def _shaped(parsed: DataFrame, columns: list[str], shape, in_order: bool = False) -> tuple[DataFrame, DataFrame]:
    """Parsed lines as shaped rows in a written table, with the place of each there; and what is to be known of each run of lines of one fate and split.

    The rows of a fate and split lie behind one another in one file: each task sorts its rows for that, unless they come ``in_order``, straight from the scan."""
    n_fields, width = F.col("n_fields"), F.col("width")
    kept = (*POSITION, LINE, ODD, N_FIELDS, FATE, "_first", "_latin", "_wide", "_open")
    values = [null_token(_unquoted(F.get("fields", F.get("places", F.lit(i))))).alias(c) for i, c in enumerate(columns)]
    no_row = (n_fields <= 0) | (n_fields > width)
    flags = [
        F.when(n_fields != width, F.col("fields")).alias(ODD),
        n_fields.alias(N_FIELDS),
        F.when(no_row, NONE).when(F.col("_first"), HEAD).otherwise(ROW).alias(FATE),
    ]
    rows = shape(parsed.select(*values, *POSITION, LINE, *flags, "_first", "_latin", "_wide", "_open"), kept)
    reason = F.col("REASON").isNotNull() if "REASON" in rows.columns else F.lit(False)
    rows = rows.withColumn("_refused", reason).withColumn(FATE, F.when((F.col(FATE) == ROW) & F.col("_refused"), REFUSED).otherwise(F.col(FATE)))
    table = written(rows if in_order else rows.sortWithinPartitions(FATE, *POSITION), by=FATE)
    # A task's files of several fates have one name.
    placed = table.select("*", F.concat_ws("/", FATE, "_metadata.file_name").alias(NAME), F.col("_metadata.row_index").alias(PLACE))
    groups = placed.groupBy(NAME, FATE, FILE, SPLIT).agg(
        F.count("*").alias("n"), F.count(ODD).alias("odd"), F.min(PLACE).alias("place"), F.min(SEQ).alias("seq"), F.max("_refused").alias("refused"),
        *[F.max(c).alias(c) for c in ("_latin", "_wide", "_open")],
    )
    return placed.drop("_first", "_latin", "_wide", "_open", "_refused"), noted(groups, FILE, SPLIT, NAME, FATE)


def numbered(load: Load, key: str, first: int) -> DataFrame:
    """The rows of a load with keys that count up from ``first`` without gaps: a row's place in its run of lines, plus the runs before.

    The table they lie in stays as it is, so a row gets the same key however often it is computed.
    """
    # One row per written file and split.
    ahead = F.coalesce(F.sum("n").over(Window.orderBy(FILE, SPLIT, NAME, FATE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = load.groups.select(NAME, FILE, SPLIT, F.col("first_place"), "n", ahead.alias("_ahead")).where("n > 0")
    at = (F.col(PLACE) >= F.col("first_place")) & (F.col(PLACE) < F.col("first_place") + F.col("n"))
    placed = load.rows.join(met(starts, starts.count()), [NAME, FILE, SPLIT]).where(at)
    return placed.withColumn(key, F.lit(first) + F.col("_ahead") + F.col(PLACE) - F.col("first_place"))


def row_numbered(rows: DataFrame, key: str, first: int) -> DataFrame:
    """Rows of written files, all that a filter leaves, numbered without gaps from ``first`` in the order of files and places."""
    placed = rows.select("*", F.col("_metadata.file_name").alias(NAME), F.col("_metadata.row_index").alias(PLACE))
    along = Window.partitionBy(NAME).orderBy(PLACE)
    counted = placed.withColumn("_at", F.row_number().over(along) - 1)
    sizes = placed.groupBy(NAME).agg(F.count("*").alias("n"))
    # One row per written file.
    ahead = F.coalesce(F.sum("n").over(Window.orderBy(NAME).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = written(sizes.select(NAME, ahead.alias("_ahead")))
    return counted.join(starts, NAME).withColumn(key, F.lit(first) + F.col("_ahead") + F.col("_at")).drop(NAME, PLACE, "_ahead", "_at")
