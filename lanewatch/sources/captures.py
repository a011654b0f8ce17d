"""Packet capture files, cut into byte ranges that are read in parallel.

A capture has no marks at which to cut it: a record's place follows from the
lengths of all before it.  So each range first looks for an offset from which
record headers chain plausibly through to its end.  The chains are then
compared: where every range begins at the offset at which the one before it
ended, starting behind the file header, the cut is proven right.  Ranges that
do not fit, for instance because they begin inside a capture that was itself
sent over the network, are walked once more from where they must begin.  Only
a file that does not fit together even then is read from its start by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lanewatch.schemas import CAPTURED_FRAME
from lanewatch.sources.blocks import file_opener, read_block_ranges

SPLIT_BYTES = 64 * 1024 * 1024


def capture_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of every ``.pcap`` file under a path; contents stay unread."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.pcap").load(path)
        .select("path", "length")
    )


def _range_tasks():
    """The functions that run per byte range.

    They are made inside a function, so that they travel to the workers whole
    and this package need not be installed there.
    """
    import struct

    # File magic as stored -> byte order, fractions per second.
    magics = {
        b"\xd4\xc3\xb2\xa1": ("<", 1_000_000), b"\xa1\xb2\xc3\xd4": (">", 1_000_000),
        b"\x4d\x3c\xb2\xa1": ("<", 1_000_000_000), b"\xa1\xb2\x3c\x4d": (">", 1_000_000_000),
    }
    file_header, record_header = 24, 16

    open_file = file_opener()

    def read_header(file, path):
        head = file.read(file_header)
        if len(head) < file_header or head[:4] not in magics:
            raise ValueError(f"{path} is not a packet capture of the classic format")
        order, per_second = magics[head[:4]]
        snap, link = struct.unpack(order + "II", head[16:24])
        return struct.Struct(order + "IIII"), per_second, snap or 262_144, link & 0xFFFF

    def load(path, start, stop):
        """The bytes of a range, and of a header that reaches past its end."""
        with open_file(path) as file:
            header, per_second, snap, _ = read_header(file, path)
            file.seek(start)
            return file.read(stop - start + record_header), header, per_second, snap

    def chain(data, end, header, at, plausible):
        """Follow record lengths to the end: where that leads, over how many records.

        None as soon as a record is not plausible.
        """
        records = 0
        while at < end and at + record_header <= len(data):
            _, part, kept, sent = header.unpack_from(data, at)
            if not plausible(part, kept, sent):
                return None
            at += record_header + kept
            records += 1
        return at, records

    def table(found):
        import pandas as pd

        columns = ["path", "split", "stop", "length", "first", "after", "records"]
        return pd.DataFrame(found, columns=columns).astype({"first": "Int64", "after": "Int64"})

    def probe(batches):
        """Where a range's records seem to begin and end, and how many there are."""
        for ranges in batches:
            found = []
            for path, number, start, stop, length in ranges[
                    ["path", "split", "start", "stop", "length"]].itertuples(index=False):
                start, stop = max(int(start), file_header), int(stop)
                data, header, per_second, snap = load(path, start, stop)
                end = stop - start

                def plausible(part, kept, sent):
                    return part < per_second and 0 < kept <= snap and kept <= sent

                result = (None, None, 0)
                for at in range(1 if number == 0 else end):
                    test = plausible if number else (lambda *_: True)
                    hit = chain(data, end, header, at, test)
                    if hit and hit[1]:
                        result = (start + at, start + hit[0], hit[1])
                        break
                found.append((path, number, stop, length, *result))
            yield table(found)

    def mend(batches):
        """Ranges that do not begin where the one before ended, walked from there."""
        columns = ["path", "split", "stop", "length", "first", "after", "records", "reached", "fits"]
        for ranges in batches:
            found = []
            for path, number, stop, length, first, after, records, reached, fits in ranges[
                    columns].itertuples(index=False):
                reached, stop = int(reached), int(stop)
                result = (None, None, 0)
                if fits and records:
                    result = (int(first), int(after), records)
                elif not fits and reached < stop:
                    data, header, _, _ = load(path, reached, stop)
                    at, records = chain(data, stop - reached, header, 0, lambda *_: True)
                    if records:
                        result = (reached, reached + at, records)
                found.append((path, number, stop, length, *result))
            yield table(found)

    def read(batches):
        """The frames of a range, numbered on from the frames before it."""
        import pandas as pd

        names = ["file_name", "packet_no", "timestamp", "link_type", "frame"]
        for ranges in batches:
            for path, first, stop, before in ranges[
                    ["path", "first", "stop", "before"]].itertuples(index=False):
                name, number, at = path.rsplit("/", 1)[-1], int(before), int(first)
                with open_file(path) as file:
                    header, per_second, _, link = read_header(file, path)
                    file.seek(at)
                    rows, held = [], 0
                    buffer, pos = b"", 0
                    while at < stop:
                        if len(buffer) - pos < record_header:
                            buffer, pos = buffer[pos:] + file.read(4 << 20), 0
                        if len(buffer) - pos < record_header:
                            break
                        seconds, part, kept, _ = header.unpack_from(buffer, pos)
                        size = record_header + kept
                        if len(buffer) - pos < size:
                            buffer, pos = buffer[pos:] + file.read(max(4 << 20, size)), 0
                        frame = buffer[pos + record_header:pos + size]
                        pos += size
                        at += size
                        number += 1
                        held += len(frame)
                        rows.append((name, number, seconds + part / per_second, link, frame))
                        if len(rows) == 10_000 or held > 32 << 20:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=names)

    return probe, mend, read


def _first_bytes():
    """A function that adds each file's first four bytes; it travels whole."""
    open_file = file_opener()

    def look(batches):
        for files in batches:
            heads = []
            for path in files["path"]:
                with open_file(path) as file:
                    heads.append(file.read(4))
            yield files.assign(head=heads)

    return look


def read_captures(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES,
                  form: str = "classic") -> DataFrame:
    """Frames of all ``.pcap`` files: file_name, packet_no, timestamp, link_type, frame.

    ``packet_no`` counts from 1 in each file, in file order.  ``form`` is ``classic`` (both
    byte orders, both time resolutions), ``block`` (pcapng: sections of either byte order,
    each with interfaces of their own link type and time resolution), or ``any``, which looks
    at the first bytes of every file.  In the block format, simple packet blocks have no time,
    and a packet of an interface that is not described has link type -1.  One short job counts
    the ranges and their bytes: a task reads one range of :data:`SPLIT_BYTES`, or as much in small ones.
    """
    if form not in ("classic", "block", "any"):
        raise ValueError(f"unknown capture form {form!r}")
    files = capture_files(spark, path)
    if form == "any":
        headed = files.repartition(max(1, min(spark.sparkContext.defaultParallelism, 1000))).mapInPandas(
            _first_bytes(), "path string, length long, head binary")
        is_block = F.col("head") == F.lit(b"\x0a\x0d\x0d\x0a")
        return _read_ranges(headed.filter(~is_block).drop("head"), split_bytes, False).unionByName(
            _read_ranges(headed.filter(is_block).drop("head"), split_bytes, True))
    return _read_ranges(files, split_bytes, form == "block")


def _read_ranges(files: DataFrame, split_bytes: int, blocks: bool) -> DataFrame:
    last = F.ceil(F.col("length") / split_bytes).cast("long") - 1
    ranges = files.filter(F.col("length") > 0).select(
        "path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("split")
    ).withColumns({
        "start": F.col("split") * split_bytes,
        "stop": F.least(F.col("length"), (F.col("split") + 1) * split_bytes),
    })
    count, size = ranges.agg(F.count("*"), F.sum(F.col("stop") - F.col("start"))).first()
    # Small ranges share tasks: an exchange holds a block for each two of its tasks.
    spread = max(files.sparkSession.sparkContext.defaultParallelism * 4, -(-(size or 0) // SPLIT_BYTES))
    tasks = max(1, min(count, spread, 100_000))
    if blocks:
        return read_block_ranges(ranges, tasks)
    probe, mend, read = _range_tasks()
    shape = ("path string, split long, stop long, length long,"
             " first long, after long, records long")
    probed = ranges.repartition(tasks, "path", "split").mapInPandas(probe, shape)

    # One row per range from here to the last read, a few bytes each.
    in_file = Window.partitionBy("path").orderBy("split")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)

    def compared(found: DataFrame) -> DataFrame:
        """Add where the ranges before reached, and whether this one goes on from there.

        A range without a record lies inside one, or in a cut-off end of the file.
        """
        fits = F.when(F.col("records") > 0, F.col("first") == F.col("reached")).otherwise(
            (F.col("reached") >= F.col("stop")) | (F.col("reached") + 16 > F.col("length")))
        reached = F.coalesce(F.max("after").over(before), F.lit(24).cast("long"))
        return found.withColumn("reached", reached).withColumn("fits", fits)

    mended = compared(probed).repartition(tasks, "path", "split").mapInPandas(mend, shape)
    checked = compared(mended).withColumns({
        "before": F.coalesce(F.sum("records").over(before), F.lit(0).cast("long")),
        "proven": F.every("fits").over(Window.partitionBy("path")),
    })
    proven = F.col("proven")
    tasks_to_read = checked.filter(
        F.when(proven, F.col("records") > 0).otherwise(F.col("split") == 0)
    ).select(
        "path", "split",
        F.when(proven, F.col("first")).otherwise(24).alias("first"),
        F.when(proven, F.col("stop")).otherwise(F.col("length")).alias("stop"),
        F.when(proven, F.col("before")).otherwise(0).alias("before"),
    )
    return tasks_to_read.repartition(tasks, "path", "split").mapInPandas(read, CAPTURED_FRAME)
