"""Main text of web pages: structure first, then differences to the page of the nearest URL.

A page becomes lines, one per block of text in page order.  Elements that never hold main
text (menus, forms, scripts, adverts and so on, by tag, role or class) are left out.  Within
each host pages are sorted by URL path; a page is paired with the nearest page of other main
text, before or after it, whose path shares more with its own.  The two pages' lines are
aligned by longest common subsequence, and shared lines are deleted if ``template_texts`` different
main texts of the host hold them (all where the host has fewer): they belong to the template.  A
page that would be left without lines keeps them all.

Pages count as one main text if they have the same lines, or the same longest line among
those that less than half of the host's different pages hold: copies and mirrored articles do not
delete each other.

Lines of an article or main element, if there are any, are the main text, and they are compared as
those of any other page: what the template puts into the article goes as well.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lanewatch.llm.common import written

# Elements by their part in a page.
RAW = frozenset("script style noscript template textarea title xmp iframe noembed".split())
LEFT_OUT = frozenset(
    "head nav footer aside form button select option datalist svg math canvas audio video"
    " object dialog menu map".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li"
    " main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr"
    " ul".split())
ENDS_PARAGRAPH = BLOCKS - frozenset(
    "body caption dd dt html legend li optgroup option summary tbody td tfoot th thead tr".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table select menu body article main div section".split())
LEFT_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu"
    " menubar".split())
LEFT_OUT_NAMES = frozenset(
    "nav navbar navigation menu sidebar footer ad ads advert adverts advertisement advertising"
    " banner cookie cookies consent gdpr notice popup modal overlay subscribe subscription"
    " newsletter signup promo promotion sponsor sponsored share sharing social breadcrumb"
    " breadcrumbs pagination pager comment comments disqus respond replies related"
    " recommended widget login toolbar skip masthead paywall".split())
#: What may stand before such a name; "has-sidebar" or "with-comments" tell of the whole page.
PLACES = (
    "site main page post entry top bottom left right global primary secondary reader user"
    " article").split()
#: An article of such a class stands for another page's text.
TEASERS = frozenset("teaser card related recommended promo preview".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>?", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PART = re.compile(r"[a-z]+")
_NAME = re.compile(
    rf"(?:(?:{'|'.join(PLACES)})[-_]+)?(?:{'|'.join(sorted(LEFT_OUT_NAMES))})(?:[-_:0-9].*)?")
_BLANK = re.compile(r"\s+")
_RAW_ENDS = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}


@dataclass
class Line:
    text: str
    main: bool
    rescued: bool = False


def _hidden(attributes: str) -> bool:
    return any(m[1].lower() == "hidden" or m[1].lower() == "aria-hidden"
               and (m[2] or m[3] or m[4] or "").lower() == "true" for m in _NAMED.finditer(attributes))


def _left_out(name: str, attributes: str, inside_main: bool) -> bool:
    if name in LEFT_OUT or (name == "header" and not inside_main):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return name == "article" and "comment" in _PART.findall(attributes.lower())
    if _hidden(attributes):
        return True
    for match in _NAMED.finditer(attributes):
        key = match[1].lower()
        value = (match[2] or match[3] or match[4] or "").lower()
        if key == "role" and value.strip() in LEFT_OUT_ROLES:
            return True
        if key in ("class", "id") and any(_NAME.fullmatch(word) for word in value.split()):
            return True
    return False


def _teaser(attributes: str) -> bool:
    return any(
        match[1].lower() in ("class", "id")
        and any(word.split("-")[0].split("_")[0] in TEASERS or _PART.findall(word)[-1:] == ["teaser"]
                for word in (match[2] or match[3] or match[4] or "").lower().split())
        for match in _NAMED.finditer(attributes))


def page_lines(page: str) -> list[Line]:
    """The page's blocks of text in page order, without elements that never hold main text.

    An article or main element within an element left out, or an article marked as the teaser of
    another page, is rescued if the page has no other, unless what holds it is hidden.
    """
    lines: list[Line] = []
    held: list[str] = []
    # name, left out, within main, rescued, hidden
    open_: list[tuple[str, bool, bool, bool, bool]] = []
    skip = main = rescued = hidden = False

    def flush() -> None:
        if held:
            text = _BLANK.sub(" ", html.unescape("".join(held))).strip()
            if text:
                lines.append(Line(text, main, rescued))
            held.clear()

    def close_to(size: int) -> None:
        nonlocal skip, main, rescued, hidden
        if len(open_) > size:
            del open_[size:]
            skip, main, rescued, hidden = open_[-1][1:] if open_ else (False,) * 4

    def innermost(names, bounds) -> int | None:
        for k in range(len(open_) - 1, -1, -1):
            if open_[k][0] in names:
                return k
            if open_[k][0] in bounds:
                return None
        return None

    at = 0
    while True:
        match = _TAG.search(page, at)
        piece = page[at:match.start()] if match else page[at:]
        if piece and not skip:
            held.append(piece)
        if not match:
            break
        at = match.end()
        name = (match[2] or match[5] or "").lower()
        if not name:
            continue
        closing = bool(match[1] or match[4])
        attributes = match[3] or match[6] or ""
        if name in BLOCKS:
            flush()
        elif name == "br" and not skip:
            held.append(" ")
        if closing:
            place = innermost({name}, ())
            if place is not None:
                close_to(place)
            continue
        if name in RAW:
            end = _RAW_ENDS[name].search(page, at)
            at = end.start() if end else len(page)
            continue
        if name in ENDS_PARAGRAPH:
            place = innermost({"p"}, LISTS)
            if place is not None:
                close_to(place)
        elif name in SIBLINGS:
            place = innermost(SIBLINGS[name], LISTS)
            if place is not None:
                close_to(place)
        if name in VOID or attributes.endswith("/") and name not in BLOCKS:
            continue
        within = main or name in ("article", "main") or bool(
            re.search(r"role\s*=\s*[\"']?main\b", attributes, re.I))
        hidden = hidden or bool(attributes) and _hidden(attributes)
        out = _left_out(name, attributes, within)
        if skip and within and not main and not out and not hidden:
            skip, rescued = False, True
        else:
            skip = skip or out
        rescued = rescued or name == "article" and bool(attributes) and _teaser(attributes)
        main = within
        open_.append((name, skip, main, rescued, hidden))
    flush()
    if any(line.main and not line.rescued for line in lines):
        lines = [line for line in lines if not line.rescued]
    return lines


def shared_lines(own: list[str], other: list[str]) -> set[int]:
    """Places in ``own`` of a longest common subsequence with ``other``.

    Bit-parallel: a row of the table is one whole number, a bit per line of ``own``.
    """
    places: dict[str, int] = {}
    for i, line in enumerate(own):
        places[line] = places.get(line, 0) | 1 << i
    every = (1 << len(own)) - 1
    rows, row = [], every
    for line in other:
        found = row & places.get(line, 0)
        row = ((row + found) | (row - found)) & every
        rows.append(row)
    # A zero bit i of row j: the subsequence of own[:i + 1] and other[:j + 1] gains one at i.
    shared, i, j = set(), len(own) - 1, len(other) - 1
    while i >= 0 and j >= 0:
        if rows[j] >> i & 1:
            i -= 1
        elif j and not rows[j - 1] >> i & 1:
            j -= 1
        else:
            shared.add(i)
            i, j = i - 1, j - 1
    return shared


def _common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


_PARSED = ("_host string, _path string, page_id long, url string, _content string,"
           " _lines array<string>, _main array<boolean>")
_KEYED = ("_host string, _path string, page_id long, _content string, _keys array<binary>,"
          " _sizes array<int>")


def _content(lines: list[Line]) -> str:
    # No line holds a line break.
    return hashlib.md5("\n".join(x.text for x in lines).encode()).hexdigest()


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[Line]]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield part, [page_lines(source.as_py()) for source in part.column("_html")]


def _parser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["_host", "_path", "page_id", "url"]
    for part, lines in _parsed(batches):
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in names), pa.array([_content(page) for page in lines], pa.string()),
             pa.array([[x.text for x in page] for page in lines], pa.list_(pa.string())),
             pa.array([[x.main for x in page] for page in lines], pa.list_(pa.bool_()))],
            [*names, "_content", "_lines", "_main"])


def _keyer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes and lengths instead of lines: all that pages are compared by."""
    names = ["_host", "_path", "page_id"]
    for part, lines in _parsed(batches):
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in names), pa.array([_content(page) for page in lines], pa.string()),
             pa.array([[hashlib.md5(x.text.encode()).digest() for x in page] for page in lines],
                      pa.list_(pa.binary())),
             pa.array([[len(x.text) for x in page] for page in lines], pa.list_(pa.int32()))],
            [*names, "_content", "_keys", "_sizes"])


_PLACE = ["_host", "_path", "_first", "_content"]
_LINKS = "_host string, _path string, _content string, _other string"


def _linker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places come sorted by range and place: the nearest of other main text before and after."""
    names, rows = ["_host", "_path", "_content", "_other"], []

    def read():
        for batch in batches:
            columns = [batch.column(c) for c in (
                "_range", "_host", "_path", "_content", "_sign", "_carried")]
            for k in range(batch.num_rows):
                range_, host, path, content, sign, carried = (c[k].as_py() for c in columns)
                yield (range_, host), path, content, sign, carried

    def link(run, before, after):
        near = [p for p in (before, after) if p is not None and p[0] == run[0][0]]
        for group, path, content, _, carried in run:
            if not carried:
                best = max(near, key=lambda p: _common_prefix(p[1], path), default=None)
                rows.append((group[1], path, content, best and best[2]))

    def out():
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string()) for c in zip(*rows)], names)
        rows.clear()
        return batch

    before, run = None, []  # places in a row that have the same main text
    for place in read():
        if run and (run[0][0], run[0][3]) != (place[0], place[3]):
            link(run, before, place)
            before, run = run[-1], []
            if len(rows) > 1 << 12:
                yield out()
        run.append(place)
    if run:
        link(run, before, None)
    if rows:
        yield out()


def _carried(edges: pd.DataFrame) -> pd.DataFrame:
    """Of one host: for each range the last two main texts before it and the first two behind."""
    edges = edges.sort_values(["_range", *_PLACE[1:]]).drop_duplicates()
    rows = edges.to_dict("records")
    found = []
    for ordered in (rows, rows[::-1]):
        last = other = None
        range_, held = None, []
        for row in ordered:
            if row["_range"] != range_:
                range_, held = row["_range"], [x for x in (last, other) if x]
                found += [x | {"_range": range_} for x in held]
            if last and last["_sign"] != row["_sign"]:
                other = last
            last = row
    return pd.DataFrame(found, columns=edges.columns)


def _neighbours(places: DataFrame) -> DataFrame:
    """``(_host, _path, _content, _other)``: the content to compare with, null if there is none.

    Places are dealt by range, so a host of any size spans as many tasks as it needs; a range gets
    the nearest places of other main text from the ranges around it.
    """
    ranged = written(places.repartitionByRange(*_PLACE).withColumn(
        "_range", F.spark_partition_id()), "page-ranges")
    group, place = ["_range", "_host"], F.struct(*_PLACE[1:], "_sign")
    ends = written(ranged.groupBy(*group).agg(
        F.min(place).alias("_low"), F.max(place).alias("_high")), "page-range-ends")
    long = ends.groupBy("_host").count().where("count > 1").select("_host")
    ends = ends.join(long, "_host", "left_semi")
    inner = ranged.join(ends, group).groupBy(*group).agg(
        F.min(F.when(F.col("_sign") != F.col("_low._sign"), place)).alias("_low"),
        F.max(F.when(F.col("_sign") != F.col("_high._sign"), place)).alias("_high"))
    edges = ends.unionByName(inner).select(
        *group, F.explode(F.array("_low", "_high")).alias("_e")).where("_e is not null")
    edges = edges.select(*group, "_e.*").select(ranged.columns)
    carried = edges.groupBy("_host").applyInPandas(_carried, ranged.schema)
    both = ranged.withColumn("_carried", F.lit(False)).unionByName(
        carried.withColumn("_carried", F.lit(True)))
    return (both.repartition("_range").sortWithinPartitions("_range", *_PLACE)
            .mapInArrow(_linker, _LINKS))


def _deleted(pages: DataFrame, template_texts: int) -> DataFrame:
    """``(_host, _path, _content, _gone)``: the places of the lines to delete, where there are any."""
    key, line = ["_host", "_content"], ["_host", "_line"]
    contents = written(pages.groupBy(*key).agg(
        F.first("_keys").alias("_keys"), F.first("_sizes").alias("_sizes")), "page-contents", "zstd")
    held = contents.select(*key, F.explode(F.array_distinct(F.arrays_zip("_keys", "_sizes"))).alias("_l")).select(
        *key, F.col("_l._keys").alias("_line"), F.col("_l._sizes").alias("_n"))

    # The line that stands for a content's main text.
    sizes = contents.groupBy("_host").agg(F.count("*").alias("_contents"))
    support = held.groupBy(*line).agg(F.count("*").alias("_support")).join(sizes, "_host")
    rank = F.when(F.col("_support") * 2 < F.col("_contents"), 0).otherwise(F.col("_support"))
    signs = written(
        held.join(support.select(*line, rank.alias("_rank")), line).groupBy(*key)
        .agg(F.min(F.struct("_rank", (-F.col("_n")).alias("n"), "_line")).alias("_s"))
        .select(*key, F.col("_s._line").alias("_sign")), "page-signs")

    # Lines that enough different main texts hold, as places in each content.
    texts = signs.select("_host", "_sign").distinct().groupBy("_host").agg(
        F.count("*").alias("_texts"))
    template = written(
        held.join(signs, key).select(*line, "_sign").distinct()
        .groupBy(*line).agg(F.count("*").alias("_holders")).join(texts, "_host")
        .where(F.col("_holders") >= F.least("_texts", F.lit(template_texts)))
        .select(*line), "page-template")
    spots = written(
        contents.select(*key, F.posexplode("_keys").alias("_at", "_line")).join(template, line)
        .groupBy(*key).agg(F.collect_list("_at").alias("_spots")), "page-spots")

    places = pages.groupBy("_host", "_path", "_content").agg(
        F.coalesce(F.min("page_id"), F.lit(-1)).alias("_first")).join(signs, key)
    links = written(_neighbours(places.select(*_PLACE, "_sign")), "page-links")
    pairs = links.where("_other is not null").select(*key, "_other").distinct()
    pairs = pairs.join(spots, key).join(contents.select(*key, "_keys"), key).join(contents.select(
        "_host", F.col("_content").alias("_other"), F.col("_keys").alias("_others")), ["_host", "_other"])

    @F.pandas_udf("array<int>")
    def gone(own: pd.Series, other: pd.Series, template: pd.Series) -> pd.Series:
        return pd.Series([sorted(shared_lines(list(a), list(b)) & set(c)) for a, b, c in zip(own, other, template)])

    found = pairs.select(*key, "_other", gone("_keys", "_others", "_spots").alias("_gone"))
    return written(links.join(found.where(F.size("_gone") > 0), [*key, "_other"]).select(
        "_host", "_path", "_content", "_gone"), "page-gone")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html", template_texts: int = 3) -> DataFrame:
    """``(page_id, url, text, n_chars)``: one row per row of ``pages``.

    Blocks are joined by an empty line; white space within a block is one blank, character
    references are decoded.  A null page is empty and has the text ``''``.  Pages that repeat a
    row, or have its lines at another path, get its text.  A page whose URL names no host has no
    neighbours.  A line belongs to a host's template if ``template_texts`` different main texts
    hold it, or all where the host has fewer.  Only the three named columns are read.

    Pages are read twice, first for hashes of their lines, by which all of them are compared, then
    for the text: it is stored nowhere and shuffled once, to the places of its deleted lines.
    """
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("_html"),
        F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1).alias("_host"),
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("_path"))
    keyed = written(rows.where("_host <> ''").drop("url").mapInArrow(_keyer, _KEYED).where(
        F.size("_keys") > 0), "page-keys", "zstd")
    parsed = rows.mapInArrow(_parser, _PARSED).withColumn("_gone", F.lit(None).cast("array<int>"))
    if not keyed.isEmpty():
        deleted = _deleted(keyed, template_texts)
        if not deleted.isEmpty():
            parsed = parsed.drop("_gone").join(deleted, ["_host", "_path", "_content"], "left")

    # A page that would be left without lines keeps them all.
    bare = ~F.array_contains("_main", True)
    own = F.filter("_lines", lambda _, k: F.col("_bare") | F.get("_main", k))
    kept = F.filter("_lines", lambda _, k: (F.col("_bare") | F.get("_main", k)) & ~F.array_contains("_gone", k))
    texts = parsed.withColumn("_bare", bare).withColumn("_own", own).withColumn(
        "_kept", F.when(F.col("_gone").isNull(), F.col("_own")).otherwise(kept))
    text = F.array_join(F.when(F.size("_kept") > 0, F.col("_kept")).otherwise(F.col("_own")), "\n\n")
    return texts.select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
