"""Collocations of words, counted in counting quotient filters.

Words that are too rare to be in a phrase are breaks; the others have numbers.  An n-gram
of word numbers is packed into one integer of fixed width, which a Feistel network permutes
one to one.  The top bits of the result name a shard, the next ones a slot of the shard's
filter (the quotient); the rest is kept whole beside a counter (the remainder).  So a filter
is a sorted list of exact counters, without the n-grams themselves, and gives them back by
the inverse permutation.

Every unit of documents makes its own filter.  Filters of a shard are merged; with many
shards in rounds over groups of units, so a unit never sends a row per shard to all of them.
The permutation deals n-grams out evenly, and a frequent one is in each filter once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lanewatch.llm.common import text_of, written
from lanewatch.llm.words import mixed, row_slices, text_buffer

#: Bytes of text whose words are numbered together; a longer text is alone.
UNIT = 8 << 20
#: Bytes of text that are split into words at a time.
_SLICE = 2 << 20
#: Counters of a shard, and bits by which a merge round divides filters.
SHARD = 1 << 21
ROUND_BITS = 8

_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_SIGNS = bytes.maketrans(_BREAKS + b"\t", b"\n" * len(_BREAKS) + b" ")

FILTER = ("prefix long, unit long, slot_bits int, slots binary, remainders binary,"
          " counters binary")


@dataclass(frozen=True)
class NgramCode:
    """Numbers of n-grams: ``longest`` word numbers from 1, each of ``width`` bits."""

    width: int
    longest: int

    def __post_init__(self):
        if self.width * self.longest > 128:
            raise ValueError("an n-gram must fit into 128 bits")

    @property
    def half(self) -> int:
        return max(8, (self.width * self.longest + 1) // 2)

    @property
    def single(self) -> bool:
        """Whether a number fits one 64-bit lane."""
        return self.half <= 32

    def packed(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower half of the n-grams; missing last words are 0."""
        h, mask = self.half, self._mask()
        high = np.zeros(len(words[0]), np.uint64)
        low = high.copy()
        for place, word in enumerate(words):
            shift = self.width * (self.longest - 1 - place)
            if shift >= h:
                high |= word << np.uint64(shift - h)
            else:
                low |= (word << np.uint64(shift)) & mask
                if shift + self.width > h:
                    high |= word >> np.uint64(h - shift)
        return high, low

    def words(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        """The word numbers of packed n-grams."""
        h, keep, found = self.half, np.uint64((1 << self.width) - 1), []
        for place in range(self.longest):
            shift = self.width * (self.longest - 1 - place)
            if shift >= h:
                word = high >> np.uint64(shift - h)
            else:
                word = low >> np.uint64(shift)
                if shift + self.width > h:
                    word = word | (high << np.uint64(h - shift))
            found.append(word & keep)
        return found

    def _mask(self) -> np.uint64:
        return np.uint64((1 << self.half) - 1)

    def _rounds(self) -> list[np.uint64]:
        return [np.uint64(0xA24BAED4963EE407 * (r + 1) % (1 << 64)) for r in range(4)]

    def permuted(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = self._mask()
        for key in self._rounds():
            high, low = low, high ^ (mixed(low + key) & mask)
        return high, low

    def restored(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = self._mask()
        for key in reversed(self._rounds()):
            high, low = low ^ (mixed(high + key) & mask), high
        return high, low

    def counted(self, high: np.ndarray, low: np.ndarray, counts: np.ndarray):
        """Equal numbers together, in order, with the sum of their counts."""
        if not len(low):
            return high, low, counts
        if self.single:
            whole = (high << np.uint64(self.half)) | low
            order = np.argsort(whole, kind="stable")
        else:
            order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        first = np.flatnonzero(new)
        return high[first], low[first], np.add.reduceat(counts[order], first)


def _small(values: np.ndarray) -> bytes:
    """Numbers as bytes; those from 255 on follow in full."""
    large = values >= 255
    return (np.where(large, 255, values).astype(np.uint8).tobytes()
            + values[large].astype("<u8").tobytes())


def _unsmall(raw: bytes, n: int) -> np.ndarray:
    values = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    values[values == 255] = np.frombuffer(raw, "<u8", offset=n).astype(np.int64)
    return values


def _to_bytes(values: np.ndarray, bits: int) -> bytes:
    width = (bits + 7) // 8
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_bytes(raw: memoryview, n: int, bits: int) -> np.ndarray:
    width = (bits + 7) // 8
    whole = np.zeros((n, 8), np.uint8)
    whole[:, :width] = np.frombuffer(raw, np.uint8, n * width).reshape(n, width)
    return whole.view("<u8").ravel().astype(np.uint64)


def filter_of(code: NgramCode, high: np.ndarray, low: np.ndarray, counts: np.ndarray,
              prefix_bits: int) -> tuple[int, bytes, bytes, bytes]:
    """Slot bits, slots, remainders and counters of sorted numbers that share a prefix."""
    h = code.half
    slot_bits = min(h - prefix_bits, max(0, len(low).bit_length() - 1))
    rest = h - prefix_bits - slot_bits
    slot = (high >> np.uint64(rest)) & np.uint64((1 << slot_bits) - 1)
    upper = high & np.uint64((1 << rest) - 1)
    slots = np.bincount(slot.astype(np.int64), minlength=1 << slot_bits)
    if code.single:
        remainders = _to_bytes((upper << np.uint64(h)) | low, rest + h)
    else:
        remainders = _to_bytes(upper, rest) + _to_bytes(low, h)
    return slot_bits, _small(slots), remainders, _small(counts)


def numbers_of(code: NgramCode, prefix: int, prefix_bits: int, slot_bits: int, slots: bytes,
               remainders: bytes, counters: bytes):
    """The sorted numbers of a filter and their counts."""
    h = code.half
    rest = h - prefix_bits - slot_bits
    runs = _unsmall(slots, 1 << slot_bits)
    n = int(runs.sum())
    slot = np.repeat(np.arange(1 << slot_bits, dtype=np.uint64), runs)
    if code.single:
        whole = _from_bytes(remainders, n, rest + h)
        upper, low = whole >> np.uint64(h), whole & code._mask()
    else:
        cut = n * ((rest + 7) // 8)
        upper = _from_bytes(remainders[:cut], n, rest)
        low = _from_bytes(remainders[cut:], n, h)
    start = np.uint64(prefix << (h - prefix_bits)) if prefix_bits else np.uint64(0)
    return start | (slot << np.uint64(rest)) | upper, low, _unsmall(counters, n)


def _segments(code: NgramCode, unit: int, high, low, counts, prefix_bits: int) -> pa.Table:
    """Sorted numbers as one filter per prefix."""
    prefixes = (high >> np.uint64(code.half - prefix_bits) if prefix_bits
                else np.zeros(len(high), np.uint64))
    first = np.flatnonzero(np.diff(prefixes, prepend=np.uint64(0))) if len(prefixes) else []
    cuts = np.unique(np.concatenate([[0], first, [len(prefixes)]])).astype(np.int64)
    rows = [
        (int(prefixes[a]), unit, *filter_of(code, high[a:b], low[a:b], counts[a:b], prefix_bits))
        for a, b in zip(cuts[:-1], cuts[1:])]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = [part.split()[0] for part in FILTER.split(",")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names)


def _word_lists(blob: bytes) -> Iterator[list[bytes]]:
    """The words of lower-cased text in order, with a line feed at each break."""
    at = 0
    while at < len(blob):
        end = min(len(blob), at + _SLICE)
        while end < len(blob) and blob[end] not in b" \t" + _BREAKS:
            end += 1
        part = blob[at:end].lower().translate(_SIGNS).replace(b"\n", b" \n ")
        yield [word for word in part.split(b" ") if word]
        at = end


def _unit_words():
    """Units of documents: their words with counts, and all words as a stream of places."""
    def tables(unit: int, lang: str, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        places: dict[bytes, int] = {b"\n": 0}
        stream = []
        for words in _word_lists(b"\n".join(blobs)):
            for word in dict.fromkeys(words):
                places.setdefault(word, len(places))
            stream.append(np.fromiter(map(places.__getitem__, words), np.uint32, len(words)))
        stream = np.concatenate(stream) if stream else np.zeros(0, np.uint32)
        times = np.bincount(stream, minlength=len(places))[1:]
        n = len(times)
        del places[b"\n"]
        texts = pa.array(list(places), pa.binary()).cast(pa.string())
        for low in range(0, n, 50_000):
            some = min(50_000, n - low)
            yield batch(unit, some, lang, texts[low:low + some], np.arange(low + 1, low + some + 1),
                        times[low:low + some], None)
        if n:
            yield batch(unit, 1, None, None, None, None, [stream.tobytes()])

    def batch(unit, n, lang, words, places, times, stream) -> pa.RecordBatch:
        def of(values, kind):
            return pa.nulls(n, kind) if values is None else pa.array(values, kind)

        return pa.RecordBatch.from_pydict({
            "unit": pa.array([unit] * n, pa.int64()),
            "lang": of(None if lang is None else [lang] * n, pa.string()),
            "word": pa.nulls(n, pa.string()) if words is None else words,
            "place": of(places, pa.int64()), "times": of(times, pa.int64()),
            "stream": of(stream, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        unit = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        size = 0
        for rows in batches:
            for low, high in row_slices(rows.column("_text"), UNIT):
                column = rows.column("_text").slice(low, high - low)
                data, offsets = text_buffer(column)
                raw, offsets = data.tobytes(), offsets.tolist()
                langs = rows.column("_lang").slice(low, high - low).to_pylist()
                for lang, a, b in zip(langs, offsets[:-1], offsets[1:]):
                    held.setdefault(lang, []).append(raw[a:b])
                size += len(raw)
                if size >= UNIT:
                    for lang, blobs in held.items():
                        yield from tables(unit, lang, blobs)
                        unit += 1
                    held, size = {}, 0
        for lang, blobs in held.items():
            yield from tables(unit, lang, blobs)
            unit += 1
    return run


def _unit_filters(code: NgramCode, prefix_bits: int):
    def run(known: pa.Table, streams: pa.Table) -> pa.Table:
        if not streams.num_rows or not known.num_rows:
            return _segments(code, 0, *[np.zeros(0, np.uint64)] * 2, np.zeros(0, np.int64),
                             prefix_bits)
        unit = streams.column("own")[0].as_py()
        stream = np.frombuffer(streams.column("stream")[0].as_buffer(), np.uint32)
        numbers = np.zeros(int(stream.max()) + 1, np.uint64)
        numbers[known.column("place").to_numpy()] = known.column("id").to_numpy() + 1
        words = numbers[stream]
        # A rare word and a sign both are 0; neither is in a phrase.
        highs, lows = [], []
        inside = words != 0
        for n in range(2, code.longest + 1):
            full = len(words) - n + 1
            if full <= 0:
                break
            whole = inside[:full].copy()
            for k in range(1, n):
                whole &= inside[k:full + k]
            at = np.flatnonzero(whole)
            high, low = code.permuted(*code.packed([words[at + k] for k in range(n)]))
            highs.append(high)
            lows.append(low)
        if not highs:
            highs = lows = [np.zeros(0, np.uint64)]
        high, low = np.concatenate(highs), np.concatenate(lows)
        return _segments(
            code, unit, *code.counted(high, low, np.ones(len(low), np.int64)), prefix_bits)
    return run


def _merged(code: NgramCode, filters: pa.Table, prefix_bits: int):
    """One sorted list of numbers out of several filters."""
    parts = [numbers_of(code, row["prefix"], prefix_bits, row["slot_bits"], row["slots"],
                        row["remainders"], row["counters"]) for row in filters.to_pylist()]
    return code.counted(*(np.concatenate(lane) for lane in zip(*parts)))


def _merge_round(code: NgramCode, prefix_bits: int, next_bits: int):
    def run(filters: pa.Table) -> pa.Table:
        unit = filters.column("crowd")[0].as_py()
        return _segments(code, unit, *_merged(code, filters, prefix_bits), next_bits)
    return run


def _frequent(code: NgramCode, prefix_bits: int, least: int):
    def run(filters: pa.Table) -> pa.Table:
        high, low, counts = _merged(code, filters, prefix_bits)
        often = counts >= least
        words = np.stack(code.words(*code.restored(high[often], low[often])), axis=1)
        lengths = (words != 0).sum(axis=1)
        flat = words[words != 0].astype(np.int64) - 1
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.table({
            "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64())),
            "f": pa.array(counts[often], pa.int64())})
    return run


def ngram_counts(units: DataFrame, vocabulary: DataFrame, longest: int, least: int,
                 shard: int = SHARD, round_bits: int = ROUND_BITS) -> DataFrame:
    """``(ids, f)`` of all n-grams of 2 to ``longest`` words that occur ``least`` times."""
    top = vocabulary.agg(F.max("id").alias("id")).first()["id"]
    sizes = units.agg(
        F.sum("times").alias("words"), F.count("stream").alias("units")).first()
    code = NgramCode(((top or 0) + 1).bit_length(), longest)
    entries = (sizes["words"] or 0) * (longest - 1)
    bits = min(code.half, max(5, (entries // shard).bit_length()))
    known = units.where("word is not null").join(vocabulary, ["lang", "word"]).select(
        "unit", "place", "id")
    streams = units.where("stream is not null").select(F.col("unit").alias("own"), "stream")
    done = min(bits, round_bits)
    filters = known.groupBy("unit").cogroup(streams.groupBy("own")).applyInArrow(
        _unit_filters(code, done), FILTER)
    crowds = sizes["units"]
    while done < bits:
        crowds = -(-crowds // (1 << round_bits))
        then = min(bits, done + round_bits)
        filters = written(filters, "ngram-filters", "zstd").withColumn(
            "crowd", F.pmod(F.xxhash64("unit"), F.lit(crowds)))
        filters = filters.groupBy("prefix", "crowd").applyInArrow(
            _merge_round(code, done, then), FILTER)
        done = then
    return filters.groupBy("prefix").applyInArrow(
        _frequent(code, done, least), "ids array<long>, f long")


def _numbered(totals: DataFrame) -> DataFrame:
    """Words with numbers that are nearly gapless: a partition's number, then the place in it."""
    rows = written(totals.withColumn("_at", F.monotonically_increasing_id()), "vocabulary")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    most = rows.agg(F.max(inside).alias("inside")).first()["inside"] or 0
    part = F.shiftright("_at", 33)
    return rows.withColumn(
        "id", F.shiftleft(part, int(most).bit_length()).bitwiseOR(inside)).drop("_at")


def floor_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact for counts below 1e16."""
    wide = "decimal(19,0)"
    above = (a.cast(wide) * a.cast(wide)).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    below = left.cast(wide) * right.cast(wide)
    return F.call_function("div", above.cast("decimal(38,0)"), below.cast("decimal(38,0)"))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, cover: int = 50,
                 most: int = 2000, text_col: str = "text", lang_col: str = "lang",
                 shard: int = SHARD, round_bits: int = ROUND_BITS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``most`` phrases.

    Words are runs of other bytes than blank and tab between the signs ``.,;:!?`` and line
    breaks, A-Z in lower case; null text is empty, null language is ``und``.  ``a``, ``l``
    and ``r`` are all occurrences of the phrase and of its parts at the cut of the lowest
    score; ``n`` is the language's number of words.  Phrases within a longer candidate that
    occurs at least ``cover`` per cent as often are dropped.  Rows that repeat a text count
    each.  A language without candidates has no rows, nor has an empty table.  Only the two
    named columns are read, so other columns may have any name.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"),
        text_of(text_col).alias("_text"))
    units = written(texts.mapInArrow(
        _unit_words(), "unit long, lang string, word string, place long, times long,"
        " stream binary"), "word-units", "zstd")
    words = units.where("word is not null")
    sizes = words.groupBy("lang").agg(F.sum("times").alias("n"))
    vocabulary = _numbered(
        words.groupBy("lang", "word").agg(F.sum("times").alias("f")).where(F.col("f") >= least))
    phrases = written(ngram_counts(
        units, vocabulary.select("lang", "word", "id"), longest, least, shard, round_bits), "phrases")

    # Counts of all parts: whatever is part of a candidate occurs at least as often.
    parts = phrases.unionByName(vocabulary.select(F.array("id").alias("ids"), "f"))
    size = F.size("ids")
    cuts = phrases.withColumnRenamed("f", "a").withColumn(
        "k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select(
        "ids", "a", "k", F.slice("ids", 1, F.col("k")).alias("first"),
        F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("rest"))
    cuts = cuts.join(parts.select(F.col("ids").alias("first"), F.col("f").alias("l")), "first")
    cuts = cuts.join(parts.select(F.col("ids").alias("rest"), F.col("f").alias("r")), "rest")
    scored = cuts.groupBy("ids", "a").agg(F.min(F.struct(
        floor_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("cut"))

    inner = phrases.where(size > 2).select(
        "f", F.explode(F.expr(
            "flatten(transform(sequence(2, size(ids) - 1),"
            " n -> transform(sequence(1, size(ids) - n + 1), p -> slice(ids, p, n))))")).alias("ids"))
    inner = inner.groupBy("ids").agg(F.max("f").alias("longer"))
    kept = scored.join(inner, "ids", "left").where(
        f"longer is null or longer * 100 < a * {int(cover)}").drop("longer")

    named = kept.select("*", F.posexplode("ids").alias("at", "id")).join(
        vocabulary.select("id", "lang", "word"), "id")
    named = named.groupBy("ids", "a", "cut").agg(
        F.first("lang").alias("lang"),
        F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    named = named.select(
        "lang", F.array_join(F.col("words.word"), " ").alias("phrase"), "a", "cut.l", "cut.r",
        "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = named.withColumn("rank", F.row_number().over(order).cast("long")).where(
        F.col("rank") <= most)
    return first.join(sizes, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
