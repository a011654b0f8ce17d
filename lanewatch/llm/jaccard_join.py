"""Near-duplicate groups by exact n-gram Jaccard similarity: a token-group matrix.

1. Each document becomes its set of word shingles.  Equal sets count once.
2. Similar sets are partitioned into groups.  Two sets that reach the threshold
   differ in at most d shingles, so of more than d parts of the shingle space they
   agree in one; sets that agree in a part come into one group.  A part without
   shingles, or with few, says little, so each set leaves out as many of its weakest
   parts as it safely can.  No linked pair is ever in two groups, so only sets of one
   group need to meet.
3. Within a group, sets are ordered so that similar ones follow each other and cut
   into small token groups, each with the union of its shingles.  The overlap of a
   set with the union bounds its overlap with each member; only token groups whose
   bound reaches what the threshold asks for are opened and compared one by one.
4. Links become connected components.

A large group is dealt to tasks in blocks of about ``block`` sets, so no task holds a group.
At first the sets of a block meet each other and a few pivots, sets drawn from the whole
group, so the blocks of near copies become one cluster without meeting.  Sets of one
cluster need not meet any more.  If a group is left with several clusters, it is dealt anew, large
clusters to blocks of their own, and of two blocks those sets meet that share one of their rarest
shingles with one of the other block, unless both blocks are of one cluster.  A task returns a spanning
forest of its links, which keeps the components whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lanewatch.llm.common import components, keys_filtered, text_of, written
from lanewatch.llm.words import mixed, row_slices, shingle_sets, text_buffer

TOKEN_GROUP = 8
#: Sets of a group of several blocks that meet all its blocks at first.
PIVOTS = 8
#: Parts that a shingle space is cut into, for 100 that linked sets could differ in.  More of
#: them leave more weak ones to leave out, but make each smaller.
PARTS_PERCENT = 125
_COLUMNS = 8192
#: Bytes of text whose sets a worker makes at a time, and cells of a matrix it multiplies at a time.
SLICE, CELLS = 1 << 18, 1 << 20


def size_levels(percent: int, most: int) -> np.ndarray:
    """First sizes of levels such that linked sets are of the same or of adjacent levels."""
    bounds = [1]
    while bounds[-1] <= most:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return np.array(bounds, np.int64)


def most_different(sizes: np.ndarray, largest: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles a set of this size and a linked one of up to ``largest`` can differ in."""
    # Of n1 + n2 shingles, at least 2p / (100 + p) lie in the intersection, counted twice.
    other = np.minimum(largest, sizes * 100 // percent)
    return (sizes + other) * (100 - percent) // (100 + percent)


def _sums(slots: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit values per slot, modulo 2**64."""
    low = np.bincount(slots, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    high = np.bincount(slots, (values >> np.uint64(32)).astype(np.float64), n)
    return low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))


def strongest(signatures: np.ndarray, uses: np.ndarray, firsts: np.ndarray,
              wanted: np.ndarray) -> np.ndarray:
    """Whether a part is among the ``wanted`` ones of its run that hold most shingles.

    The order depends on what a part holds only, and all parts that tie with the last are taken.
    """
    runs = np.repeat(np.arange(len(firsts), dtype=np.uint64), np.diff(np.append(firsts, len(uses))))
    rank = (runs << np.uint64(40)) | (np.minimum(uses, 255).astype(np.uint64) << np.uint64(32))
    rank |= signatures >> np.uint64(32)
    ends = np.append(firsts[1:], len(uses))
    last = np.sort(rank)[np.minimum(ends - wanted, len(uses) - 1)] if len(uses) else rank
    return rank >= np.repeat(last, np.diff(np.append(firsts, len(uses))))


def describe_sets(sets: list[np.ndarray], percent: int) -> dict[str, pa.Array]:
    """Size, 128-bit digest and the part signatures of each set.

    Linked sets differ in d shingles at most, so of P parts P - d agree.  A set leaves out its
    P - d - 1 weakest parts, those that hold few shingles or none: one of the agreeing
    parts is stronger, and the other set, for which the same holds, sends it too.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    rows = np.repeat(np.arange(len(sets)), sizes)
    digests = [_sums(rows, mixed(tokens ^ np.uint64(k)), len(sets)) for k in (0xA5A5, 0x5A5A)]
    bounds = size_levels(percent, int(sizes.max(initial=1)) * 2 + 2)
    bounds = np.append(bounds, size_levels(percent, int(bounds[-1]) * 2)[len(bounds):])
    level = np.searchsorted(bounds, np.maximum(sizes, 1), side="right") - 1
    # Each set has the parts of its own level and then those of the next one.
    tags = np.stack([level, level + 1], 1).ravel()
    largest = bounds[tags + 1] - 1
    differ = most_different(np.repeat(sizes, 2), largest, percent)
    parts = np.where(
        np.repeat(sizes, 2) > 0,
        (most_different(largest, largest, percent) + 1) * PARTS_PERCENT // 100, 0)
    base = np.concatenate([[0], np.cumsum(parts)])
    spread = mixed(tokens + np.uint64(77))
    slots = [base[2 * rows + k]
             + (spread % parts[2 * rows + k].astype(np.uint64)).astype(np.int64) for k in range(2)]
    total = int(base[-1])
    sums = _sums(slots[0], spread, total) + _sums(slots[1], spread, total)
    uses = np.bincount(slots[0], minlength=total) + np.bincount(slots[1], minlength=total)
    owner = np.repeat(np.arange(len(parts)), parts)
    place = np.arange(total) - base[owner]
    tag = (tags[owner].astype(np.uint64) << np.uint64(40)) + place.astype(np.uint64)
    signatures = mixed(sums + mixed(tag + np.uint64(1)))
    some = parts > 0
    sent = strongest(signatures, uses, base[:-1][some], differ[some] + 1)
    ends = np.concatenate([[0], np.cumsum(sent)])[base[::2]]
    return {
        "n": pa.array(sizes),
        "d1": pa.array(digests[0].view(np.int64)), "d2": pa.array(digests[1].view(np.int64)),
        "sigs": pa.ListArray.from_arrays(
            pa.array(ends.astype(np.int32)), pa.array(signatures[sent].view(np.int64))),
    }


def _describer(width: int, percent: int, names: tuple[str, ...], once: bool = False):
    """With ``once``, a task gives the rows of equal sets once: copies collapse before a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            texts = batch.column("_text")
            for low, high in row_slices(texts, SLICE):
                sets = shingle_sets(*text_buffer(texts.slice(low, high - low)), width)
                columns = {
                    "doc" if c == "_id" else c: batch.column(c).slice(low, high - low)
                    for c in batch.schema.names if c != "_text"}
                found = describe_sets(sets, percent)
                if once:
                    new = []
                    for k, key in enumerate(zip(*(found[c].to_pylist() for c in ("n", "d1", "d2")))):
                        if key not in seen:
                            seen.add(key)
                            new.append(k)
                    columns = {c: column.take(pa.array(new, pa.int64())) for c, column in columns.items()}
                    found = {name: found[name].take(pa.array(new, pa.int64())) for name in names}
                yield pa.RecordBatch.from_pydict(columns | {name: found[name] for name in names})
    return run


def _first_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature and set, link each to the first with its signature."""
    last, leader = None, None
    for batch in batches:
        sigs = batch.column("sig").to_numpy()
        docs = batch.column("doc").to_numpy()
        if not len(sigs):
            continue
        new = np.ones(len(sigs), bool)
        new[1:] = sigs[1:] != sigs[:-1]
        new[0] = last is None or sigs[0] != last
        at = np.maximum.accumulate(np.where(new, np.arange(len(sigs)), -1))
        leaders = np.where(at < 0, leader if leader is not None else 0, docs[at])
        last, leader = sigs[-1], leaders[-1]
        found = leaders != docs
        links = np.unique(np.stack([docs[found], leaders[found]], 1), axis=0)
        yield pa.RecordBatch.from_pydict({"a": pa.array(links[:, 0]), "b": pa.array(links[:, 1])})


class _Forest:
    """Union-find over the rows of one task's block pair."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[max(self.top(x), self.top(y))] = min(self.top(x), self.top(y))


def token_group_links(sets: list[np.ndarray], percent: int) -> list[int]:
    """Per set the first one that its links lead to, by the token-group matrix."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    # Similar sets share their smallest hashes, so this order puts them side by side.
    order = sorted(range(n), key=lambda i: (sets[i][:4].tolist(), sizes[i]))
    sets, sizes = [sets[i] for i in order], sizes[order]
    owner = np.repeat(np.arange(n), sizes)
    tokens, column, uses = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = uses[column] > 1
    owner, column = owner[shared], (np.cumsum(uses > 1) - 1)[column[shared]]
    width = int((uses > 1).sum())
    firsts = np.arange(0, n, TOKEN_GROUP)
    smallest = np.minimum.reduceat(sizes, firsts)
    largest = np.maximum.reduceat(sizes, firsts)

    def blocks() -> Iterator[np.ndarray]:
        by = np.argsort(column, kind="stable")
        cuts = np.searchsorted(column[by], np.arange(0, width + _COLUMNS, _COLUMNS))
        for k in range(len(cuts) - 1):
            own = by[cuts[k]:cuts[k + 1]]
            block = np.zeros((n, min(_COLUMNS, width - k * _COLUMNS)), np.float32)
            block[owner[own], column[own] - k * _COLUMNS] = 1
            yield block

    bound = np.zeros((n, len(firsts)))
    for block in blocks():
        bound += block @ np.maximum.reduceat(block, firsts, axis=0).T
    # 100 * i >= p * (q + s - i) for the smallest member size that q may meet.
    least = np.maximum(smallest[None, :], -(-sizes[:, None] * percent // 100))
    opened = (
        (100 + percent) * bound >= percent * (sizes[:, None] + least) - 1e-6)
    opened &= largest[None, :] * 100 >= sizes[:, None] * percent
    opened &= smallest[None, :] * percent <= sizes[:, None] * 100
    pairs = np.repeat(opened, np.diff(np.append(firsts, n)), axis=1)
    asked, member = np.nonzero(np.triu(pairs | pairs.T, 1))
    common = np.zeros(len(asked))
    step = max(1, CELLS // max(1, min(width, _COLUMNS)))
    if len(asked):
        rows = np.unique(np.concatenate([asked, member]))
        dense = len(asked) * 4 > len(rows) ** 2
        for block in blocks():
            if dense:
                common += (block[rows] @ block[rows].T)[
                    np.searchsorted(rows, asked), np.searchsorted(rows, member)]
            else:
                for k in range(0, len(asked), step):
                    part = slice(k, k + step)
                    common[part] += np.einsum("ij,ij->i", block[asked[part]], block[member[part]])
    linked = 100 * common >= percent * (sizes[asked] + sizes[member] - common) - 1e-6
    forest = _Forest(n)
    for x, y in zip(asked[linked].tolist(), member[linked].tolist()):
        forest.join(x, y)
    tops = np.empty(n, np.int64)
    tops[order] = [order[forest.top(x)] for x in range(n)]
    return tops.tolist()


def _linker(width: int, percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        column = pa.array(pdf["_text"], pa.large_string())
        sets = []
        for low, high in row_slices(column, SLICE):
            sets += shingle_sets(*text_buffer(column.slice(low, high - low)), width)
        docs = pdf["doc"].to_numpy()
        tops = token_group_links(sets, percent)
        return pd.DataFrame({"a": docs, "b": docs[tops]}).query("a != b")
    return run


def _with_texts(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the text of their ``doc``; other texts are filtered out before the shuffle."""
    # Spark builds its filter of keys only from rows that a comparison has chosen.
    rows = rows.where("own >= 0" if "own" in rows.columns else "low <= high")
    return texts.join(rows, texts["_id"] == rows["doc"])


def _linked(texts: DataFrame, met: DataFrame, key: list[str], width: int, percent: int) -> DataFrame:
    """Links of the sets that meet: rows of one component and ``key``."""
    met = written(met, "jaccard-met")
    with keys_filtered(texts.sparkSession):
        return written(
            _with_texts(texts, met).select("doc", "_text", "component", *key)
            .groupBy("component", *key).applyInPandas(_linker(width, percent), "a long, b long"),
            "jaccard-found")


def _pivots(members: DataFrame) -> DataFrame:
    """``(doc, component, own)``: sets drawn from each group of several blocks, for all its blocks.

    A pivot that links with a set of each of two blocks joins what is linked inside these, so blocks
    of near copies need not meet.
    """
    drawn = F.array_distinct(F.array(*(
        F.min_by("doc", F.xxhash64("doc", F.lit(k))) for k in range(PIVOTS))))
    return (
        members.where("blocks > 1").groupBy("component")
        .agg(F.max("blocks").alias("blocks"), drawn.alias("drawn"))
        .select("component", "blocks", F.explode("drawn").alias("doc"))
        .select("doc", "component", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own")))


def _apart(members: DataFrame, clusters: DataFrame, block: int) -> DataFrame:
    """``(doc, component, blocks, tag, own)``: new blocks for groups whose blocks are not one cluster yet.

    A cluster of ``block`` sets or more has blocks of its own, tagged by its id; sets of smaller
    ones share blocks without a tag.
    """
    sets = written(
        members.where("blocks > 1").select("doc", "component", F.col("blocks").alias("all_blocks"))
        .join(clusters.select(F.col("node").alias("doc"), F.col("component").alias("cluster")), "doc", "left")
        .withColumn("cluster", F.coalesce("cluster", "doc")), "jaccard-clustered")
    sizes = written(
        sets.groupBy("component", "cluster").agg(F.count("*").alias("size"))
        .withColumn("tag", F.when(F.col("size") >= block, F.col("cluster"))), "jaccard-cluster-sizes")
    several = sizes.groupBy("component").agg(F.count("*").alias("n")).where("n > 1")
    tags = sizes.groupBy("component", "tag").agg(
        F.ceil(F.sum("size") / F.lit(block)).cast("int").alias("blocks"))
    # A tag is the cluster itself, so null tags are told by the cluster's size.
    own = sizes.join(several, "component", "left_semi").alias("s").join(
        tags.alias("t"), (F.col("s.component") == F.col("t.component"))
        & F.col("s.tag").eqNullSafe(F.col("t.tag"))).select(
        "s.component", "s.cluster", "s.tag", "t.blocks")
    return written(
        sets.join(own, ["component", "cluster"])
        .withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
        .select("doc", "component", F.col("all_blocks").alias("blocks"), "tag", "own"), "jaccard-apart")


def _shingler(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in row_slices(batch.column("_text"), SLICE):
                part = batch.slice(low, high - low)
                sets = shingle_sets(*text_buffer(part.column("_text")), width)
                ends = np.cumsum([0] + [len(s) for s in sets])
                values = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), *map(part.column, ("component", "blocks", "tag", "own")),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))],
                    ["doc", "component", "blocks", "tag", "own", "shingles"])
    return run


def _counted(able: DataFrame, uses: DataFrame) -> DataFrame:
    """Shingles of each set with their counts, but for those held once or by more sets than there are blocks."""
    few = uses.where("times > 1 and times <= blocks").select("component", "sig", "times")
    return able.select("doc", "key", "component", F.explode("others").alias("sig")).join(few, ["component", "sig"])


def _rare_shingles(texts: DataFrame, apart: DataFrame, width: int, percent: int) -> DataFrame:
    """``(doc, component, tag, own, sig)``: the rarest shingles of each set that other sets hold too.

    Of n shingles, linked sets have at least ``percent`` in a hundred in common, so in any order
    that all sets of a component follow they share one of their first n - ceil(n * percent / 100) + 1.
    Rare ones come first, so that a passage which many sets hold brings only such sets
    together as consist of little else.  Shingles held by more sets than the component has blocks are
    in most blocks, whichever is taken, so they come last, by their hash, and are never joined with
    their counts: the copies of one text cost that join nothing.
    """
    if "blocks" not in apart.columns:  # the last block that holds a shingle stands for their number
        apart = apart.withColumn("blocks", F.col("own") + 1)
    # Shingles outweigh the texts as well: they are counted and looked up where they are made, not stored.
    held = _with_texts(texts, apart).select("_id", "_text", "component", "blocks", "tag", "own").mapInArrow(
        _shingler(width), "doc long, component long, blocks int, tag long, own int, shingles array<long>")
    # Rows that repeat an id with another text are sets of their own.
    held = held.withColumn("key", F.xxhash64("shingles")).withColumn(
        "least", F.ceil(F.size("shingles") * percent / 100).cast("int"))
    with keys_filtered(texts.sparkSession):
        uses = written(
            held.select("doc", "key", "component", "blocks", F.explode("shingles").alias("sig"))
            .groupBy("component", "sig").agg(
                F.count("*").alias("times"), F.min("doc").alias("doc"), F.min("key").alias("key"),
                F.max("blocks").alias("blocks")), "jaccard-uses")
        # Shingles of one set only come first of all, so of the others these are left to look at.  A set
        # with too few left links with nothing, which is known before any shingle is joined with its count.
        alone = uses.where("times = 1").groupBy("doc", "key").agg(F.collect_list("sig").alias("alone"))
        able = written(
            held.join(alone, ["doc", "key"], "left")
            .withColumn("others", F.array_except(
                "shingles", F.coalesce("alone", F.array().cast("array<long>"))))
            .where(F.size("others") >= F.col("least"))
            .select("doc", "key", "least", "component", "tag", "own", "others"), "jaccard-able")
    rare = _counted(able, uses).groupBy("doc", "key").agg(
        F.sort_array(F.collect_set(F.struct("times", "sig"))).alias("rare"))
    ordered = able.join(rare, ["doc", "key"], "left").withColumn(
        "rare", F.coalesce(F.col("rare.sig"), F.array().cast("array<long>"))).withColumn(
        "sigs", F.concat("rare", F.sort_array(F.array_except("others", "rare"))))
    return ordered.select("doc", "component", "tag", "own", F.explode(
        F.slice("sigs", F.lit(1), F.size("others") - F.col("least") + 1)).alias("sig"))


def _visits(texts: DataFrame, apart: DataFrame, width: int, percent: int) -> DataFrame:
    """``(doc, component, low, high)``: pairs of blocks at which a set must be present.

    Sets meet in their own block unless it holds one cluster, and a set visits each block
    that holds a set of another cluster, or without a tag, which shares one of the rarest
    shingles of both.
    """
    parts = written(_rare_shingles(texts, apart, width, percent), "jaccard-rare")
    # Blocks that hold a shingle are bits, so one costs a row per 64 blocks and not one for each.
    hosts = parts.groupBy("component", "sig", F.col("tag").alias("at"), F.expr("own div 64").alias("bits_of")).agg(
        F.bit_or(F.expr("shiftleft(1L, own % 64)")).alias("bits"))
    shared = parts.join(hosts, ["component", "sig"]).where("at is null or not (at <=> tag)").groupBy(
        "doc", "at", "bits_of").agg(F.bit_or("bits").alias("bits"))
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda k: F.getbit("bits", k) == 1)

    def name(tag: str, number: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col(tag).cast("string"), F.lit("")), number.cast("string"))

    there = shared.select("doc", "at", "bits_of", F.explode(set_bits).alias("bit")).select(
        "doc", name("at", F.col("bits_of") * 64 + F.col("bit")).alias("other"))
    here = apart.select("doc", "component", "tag", name("tag", F.col("own")).alias("here"))
    both = here.join(there, "doc").where("here <> other").unionByName(
        here.where("tag is null").withColumn("other", F.col("here")))
    return both.select(
        "doc", "component", F.least("here", "other").alias("low"), F.greatest("here", "other").alias("high"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                width: int = 5, percent: int = 80, block: int = 96) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs``.

    Two texts link when 100 * |intersection| >= percent * |union| of their sets of
    distinct ``width``-word shingles.  ``component_id`` is the smallest id that links
    reach.  Null and empty texts, and those without words, have no shingles and
    link with nothing.  Rows that repeat an id are one document; if their texts
    differ, it has the links of each.  A null id links with nothing, and its component is the
    smallest id of equal sets, or null.  Only the two named columns are read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("_text"))
    described = written(texts.mapInArrow(
        _describer(width, percent, ("n", "d1", "d2")), "doc long, n long, d1 long, d2 long"),
        "shingle-sets")
    some = described.where("n > 0 and doc is not null")
    sets = written(
        some.groupBy("d1", "d2", "n").agg(F.min("doc").alias("rep")), "distinct-sets")
    copies = some.join(sets, ["d1", "d2", "n"]).where("doc <> rep").select(
        F.col("doc").alias("a"), F.col("rep").alias("b"))
    # Signatures outweigh the texts, so they are made where they are needed and not stored.
    signatures = texts.where("_id is not null").mapInArrow(
        _describer(width, percent, ("sigs",), once=True), "doc long, sigs array<long>")
    agreeing = (
        signatures.select("doc", F.explode("sigs").alias("sig"))
        .repartition("sig").sortWithinPartitions("sig", "doc")
        .mapInArrow(_first_of_runs, "a long, b long"))
    groups = components(agreeing.unionByName(copies), "jaccard-groups")
    groups = written(groups.join(
        sets.select(F.col("rep").alias("node")).distinct(), "node", "left_semi"), "jaccard-members")
    sizes = written(
        groups.groupBy("component").agg(F.count("*").alias("size")), "jaccard-sizes")
    members = (
        groups.join(sizes, "component").where("size > 1")
        .withColumn("blocks", F.ceil(F.col("size") / F.lit(block)).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select(F.col("node").alias("doc"), "component", "blocks", "own"))
    members = written(members, "jaccard-blocks")
    met = members.select("doc", "component", "own").unionByName(_pivots(members)).distinct()
    links = _linked(texts, met, ["own"], width, percent)
    clusters = components(links, "jaccard-clusters")
    links = clusters.select(F.col("node").alias("a"), F.col("component").alias("b"))
    apart = _apart(members, clusters, block)
    if not apart.isEmpty():
        links = links.unionByName(
            _linked(texts, _visits(texts, apart, width, percent), ["low", "high"], width, percent))
    joined = components(links, "jaccard-links")
    where = written(
        sets.join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("d1", "d2", "n", F.coalesce("component", "rep").alias("component")), "set-components")
    placed = described.select("doc", "n", "d1", "d2").join(where, ["d1", "d2", "n"], "left")
    return placed.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their group, columns as they are.

    A row with a null id stays.  Rows that repeat a staying id all stay.
    """
    groups = near_groups(docs, id_col, text_col, width, percent)
    stay = written(groups.where("doc_id = component_id").select(
        F.col("doc_id").alias("_stay")).distinct(), "jaccard-staying")
    row = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    kept = row.join(stay, F.col("_id") == F.col("_stay"), "left_semi")
    return kept.unionByName(row.where("_id is null")).select("_row.*")
