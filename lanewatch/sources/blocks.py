"""Captures of the block format (pcapng), cut into byte ranges that are read in parallel.

A file is a chain of blocks, each with its length at both ends.  Within a range the first
offset is sought from which blocks chain through to its end; ranges that do not begin where
the one before ended are walked again from there, and a file that still does not fit together
is read by one task from its start.  Packet blocks refer to state that stands earlier in the
file: their section's byte order and its interfaces.  So a range reports the state it leaves
behind, and state is handed on from range to range by window functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lanewatch.schemas import CAPTURED_FRAME


def file_opener():
    """A function that opens a path; made inside a function, so that it travels whole."""
    def open_file(path):
        from pyarrow import fs

        if path.startswith("file:/"):
            return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
        system, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        return system.open_input_file(inner)

    return open_file


def _block_tasks():
    """The functions that run per byte range; they travel to the workers whole."""
    import json
    import struct

    open_file = file_opener()
    # Block types, the mark of byte order, option codes.
    section, interface, old_packet, simple_packet, packet = 0x0A0D0D0A, 1, 2, 3, 6
    order_mark, resolution_option, offset_option = 0x1A2B3C4D, 9, 14
    shortest = 12

    def order_of(head, path):
        """Byte order of the section that begins with these twelve bytes."""
        for order in "<>":
            if len(head) >= 12 and struct.unpack_from(order + "I", head, 8)[0] == order_mark:
                return order
        raise ValueError(f"{path} is not a packet capture of the block format")

    class Reader:
        """Bytes of a file from some place on, read as they are asked for."""

        def __init__(self, file, start):
            self.file, self.data, self.start = file, b"", start
            file.seek(start)

        def get(self, at, size):
            """Bytes at a place; fewer at the end of the file.  Places only go up."""
            if at + size > self.start + len(self.data):
                self.data = self.data[at - self.start:] if at < self.start + len(self.data) else b""
                self.start = at
                self.file.seek(at + len(self.data))
                self.data += self.file.read(max(4 << 20, size - len(self.data)))
            return self.data[at - self.start:at - self.start + size]

    def interface_of(body, order):
        """(link type, units per second, seconds to add, longest frame) of an interface block."""
        link, _, snap = struct.unpack_from(order + "HHI", body)
        per_second, added, at = 1e6, 0, 8
        while at + 4 <= len(body):
            code, size = struct.unpack_from(order + "HH", body, at)
            value = body[at + 4:at + 4 + size]
            if code == 0:
                break
            if code == resolution_option and size == 1:
                power = value[0] & 0x7F
                per_second = 2.0**power if value[0] & 0x80 else 10.0**power
            elif code == offset_option and size == 8:
                added = struct.unpack(order + "q", value)[0]
            at += 4 + (size + 3) // 4 * 4
        return [link, per_second, added, snap]

    def walk(reader, path, at, stop, length, order, state):
        """Blocks that begin before ``stop``: (place, type, body), with the state kept up.

        ``state`` is [byte order, interfaces]; it changes in place.  Ends at a block that the
        end of the file cuts off.  Raises ValueError at a block whose lengths differ.
        """
        while at < stop:
            head = reader.get(at, shortest)
            if len(head) < shortest:
                return
            kind = struct.unpack_from("<I", head)[0]
            if kind == section:
                order = order_of(head, path)
            kind, size = struct.unpack_from(order + "II", head)
            if at + size > length:
                return
            if size < shortest or size % 4:
                raise ValueError(f"no block at {at} of {path}")
            whole = reader.get(at, size)
            if struct.unpack_from(order + "I", whole, size - 4)[0] != size:
                raise ValueError(f"no block at {at} of {path}")
            body = whole[8:-4]
            if kind == section:
                state[:] = [order, []]
            elif kind == interface and len(body) >= 8:
                state[1].append(interface_of(body, order))
            yield at, size, kind, body, order
            at += size

    def follow(path, at, stop, length, order):
        """Where the blocks of a range lead: (end, packets, state left, whether it began anew)."""
        state, after, packets, anew = [order, []], at, 0, False
        with open_file(path) as file:
            for place, size, kind, _, _ in walk(Reader(file, at), path, at, stop, length, order, state):
                after = place + size
                packets += kind in (old_packet, simple_packet, packet)
                anew |= kind == section
        return after, packets, json.dumps(state), anew

    def candidates(file, data, start, length):
        """Places at which a block seems to stand, its length at both ends, and its order.

        A block that ends behind the range is tried only where no other one leads on, and only
        the first ten thousand of those: a range not found here is walked from where the one
        before it ended.
        """
        import numpy as np

        usable = len(data) // 4 * 4
        found = []
        for order in "<>":
            words = np.frombuffer(data[:usable], order + "u4")
            sizes = words[1:].astype(np.int64)
            at = np.flatnonzero((sizes >= shortest) & (sizes % 4 == 0))
            at = at[start + 4 * at + sizes[at] <= length]
            last = at + sizes[at] // 4 - 1
            inside = last < len(words)
            same = at[inside][words[last[inside]] == sizes[at[inside]]]
            found += [(0, start + 4 * int(a), order) for a in same]
            for a in at[~inside][:10_000].tolist():
                size = int(sizes[a])
                file.seek(start + 4 * a + size - 4)
                if struct.unpack(order + "I", file.read(4))[0] == size:
                    found.append((1, start + 4 * a, order))
        return sorted(found)

    def table(found):
        import pandas as pd

        columns = ["path", "split", "stop", "length", "first", "after", "packets", "state", "anew"]
        return pd.DataFrame(found, columns=columns).astype({"first": "Int64", "after": "Int64"})

    nothing = (None, None, 0, None, False)

    def probe(batches):
        """Where a range's blocks seem to begin and end, how many packets and what state."""
        for ranges in batches:
            found = []
            for path, number, start, stop, length in ranges[
                    ["path", "split", "start", "stop", "length"]].itertuples(index=False):
                start, stop, length = int(start), int(stop), int(length)
                result = nothing
                if number == 0:
                    with open_file(path) as file:
                        order = order_of(file.read(shortest), path)
                    result = (0, *follow(path, 0, stop, length, order))
                else:
                    start = (start + 3) // 4 * 4  # blocks stand at whole words
                    with open_file(path) as file:
                        file.seek(start)
                        tried = candidates(file, file.read(max(0, stop - start)), start, length)
                    for _, at, order in tried:
                        try:
                            hit = follow(path, at, stop, length, order)
                        except ValueError:
                            continue
                        if hit[0] > at:
                            result = (at, *hit)
                            break
                found.append((path, number, stop, length, *result))
            yield table(found)

    def mend(batches):
        """Ranges that do not begin where the one before ended, walked from there."""
        columns = ["path", "split", "stop", "length", "first", "after", "packets", "state",
                   "anew", "reached", "fits", "order"]
        for ranges in batches:
            found = []
            for (path, number, stop, length, first, after, packets, state, anew, reached, fits,
                 order) in ranges[columns].itertuples(index=False):
                reached, stop, result = int(reached), int(stop), nothing
                if fits and state is not None:
                    result = (int(first), int(after), packets, state, anew)
                elif not fits and reached < stop:
                    try:
                        hit = follow(path, reached, stop, int(length), order)
                        result = (reached, *hit) if hit[0] > reached else nothing
                    except ValueError:
                        pass  # the file does not fit together, and is read from its start
                found.append((path, number, stop, length, *result))
            yield table(found)

    def read(batches):
        """The frames of a range, numbered on from the frames before it."""
        import pandas as pd

        names = ["file_name", "packet_no", "timestamp", "link_type", "frame"]
        for ranges in batches:
            for path, first, stop, length, before, order, interfaces in ranges[
                    ["path", "first", "stop", "length", "before", "order", "interfaces"]
            ].itertuples(index=False):
                name, number = path.rsplit("/", 1)[-1], int(before)
                first = int(first)
                state = [order, [i for part in interfaces for i in json.loads(part)[1]]]
                rows, held = [], 0
                with open_file(path) as file:
                    if first == 0:
                        order = order_of(file.read(shortest), path)
                    blocks = walk(
                        Reader(file, first), path, first, int(stop), int(length), order, state)
                    for _, _, kind, body, order in blocks:
                        if kind == packet and len(body) >= 20:
                            which, high, low, kept, _ = struct.unpack_from(order + "IIIII", body)
                            frame = body[20:20 + kept]
                        elif kind == old_packet and len(body) >= 20:
                            which, _, high, low, kept, _ = struct.unpack_from(order + "HHIIII", body)
                            frame = body[20:20 + kept]
                        elif kind == simple_packet and len(body) >= 4:
                            which, high = 0, None
                            kept = struct.unpack_from(order + "I", body)[0]
                            if state[1] and state[1][0][3]:
                                kept = min(kept, state[1][0][3])
                            frame = body[4:4 + kept]
                        else:
                            continue
                        link, per_second, added, _ = (
                            state[1][which] if which < len(state[1]) else [-1, 1e6, 0, 0])
                        units = None if high is None else (high << 32) | low
                        seconds = None if units is None else (
                            added + units // int(per_second) + units % int(per_second) / per_second)
                        number += 1
                        held += len(frame)
                        rows.append((name, number, seconds, link, frame))
                        if len(rows) == 10_000 or held > 32 << 20:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return probe, mend, read


def read_block_ranges(ranges: DataFrame, tasks: int) -> DataFrame:
    """Frames of block-format files out of their (path, split, start, stop, length) ranges."""
    probe, mend, read = _block_tasks()
    shape = ("path string, split long, stop long, length long, first long, after long,"
             " packets long, state string, anew boolean")
    probed = ranges.repartition(tasks, "path", "split").mapInPandas(probe, shape)

    # One row per range from here to the last read: a few bytes, and the interfaces in force.
    in_file = Window.partitionBy("path").orderBy("split")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    order = F.get_json_object("state", "$[0]")

    def compared(found: DataFrame) -> DataFrame:
        """Add where the ranges before reached, and whether this one goes on from there."""
        fits = F.when(F.col("first").isNotNull(), F.col("first") == F.col("reached")).otherwise(
            (F.col("reached") >= F.col("stop")) | (F.col("reached") + 12 > F.col("length")))
        return found.withColumn(
            "reached", F.coalesce(F.max("after").over(before), F.lit(0).cast("long"))
        ).withColumn("fits", fits).withColumn(
            "order", F.coalesce(F.last(order, ignorenulls=True).over(before), F.lit("<")))

    mended = compared(probed).repartition(tasks, "path", "split").mapInPandas(mend, shape)
    # State since the last range in which a section began, that one's included.
    sections = mended.withColumn("section", F.sum(F.col("anew").cast("int")).over(
        in_file.rowsBetween(Window.unboundedPreceding, 0)))
    since = Window.partitionBy("path", "section").orderBy("split").rowsBetween(
        Window.unboundedPreceding, 0)
    # Only states that name interfaces: a list of all would grow with the square of a file's ranges.
    naming = F.when(F.get_json_object("state", "$[1][0]").isNotNull(), F.col("state"))
    left = sections.withColumn("left", F.collect_list(naming).over(since))
    checked = compared(left).withColumns({
        "before": F.coalesce(F.sum("packets").over(before), F.lit(0).cast("long")),
        "interfaces": F.coalesce(
            F.lag("left").over(in_file), F.array().cast("array<string>")),
        "proven": F.every("fits").over(Window.partitionBy("path")),
    })
    proven = F.col("proven")
    whole = checked.filter(
        F.when(proven, F.col("packets") > 0).otherwise(F.col("split") == 0)
    ).select(
        "path", "split", "length", "order",
        F.when(proven, F.col("first")).otherwise(0).alias("first"),
        F.when(proven, F.col("stop")).otherwise(F.col("length")).alias("stop"),
        F.when(proven, F.col("before")).otherwise(0).alias("before"),
        F.when(proven, F.col("interfaces")).otherwise(
            F.array().cast("array<string>")).alias("interfaces"),
    )
    return whole.repartition(tasks, "path", "split").mapInPandas(read, CAPTURED_FRAME)
