"""Alignment of two tokenizers' tokens of the same texts, by pointer jumping.

Both token sequences tile the same bytes.  Every token points to the token of the other
sequence that overlaps it and reaches farthest right; a token that ends where its overlapping
one does points there, and that one to itself.  Doubling all pointers at once until none
moves brings each token to the last token of its component, whose number labels the group:
the least run of bytes at whose ends tokens of both sequences end.

Links are overlapping pairs.  A unit of documents lists its different id pairs once; their
counts over the corpus come back to the unit, not to every link.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lanewatch.llm.common import text_of, written
from lanewatch.llm.words import row_slices

#: Bytes of text whose pairs are looked up together; a longer text is alone.
UNIT = 8 << 20
#: Bytes of text given to the tokenizers at a time.
_SLICE = 1 << 20

DOCUMENT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string")


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


#: A run begins with a blank behind another character than white space, or with the text.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_OTHER_WHITE = _WHITE.replace(" ", "", 1)
_RUNS = re.compile(
    f" [{_WHITE}]*[^{_WHITE}]+(?:[{_OTHER_WHITE}][{_WHITE}]*[^{_WHITE}]+)*(?:[{_WHITE}]+\\Z)?"
    f"| [{_WHITE}]*\\Z")

#: Runs that a worker remembers; beyond that it starts anew.
REMEMBERED = 700_000


class TokenPair:
    """Both tokenizers and the bytes of their entries."""

    def __init__(self, bytes_path: str, pieces_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(bytes_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        letters = byte_letters()
        self.spelling = {b: c for c, b in letters.items()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, number in self.a.get_vocab().items():
            self.a_bytes[number] = bytes(letters.get(c, 0) for c in entry)
        self.b_bytes = [self._piece(k) for k in range(self.b.get_piece_size())]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("ids must lie below 65,536")
        if any("\u2581" in self.b.id_to_piece(k).lstrip("\u2581")
               for k in range(len(self.b_bytes))):
            raise ValueError("an entry of the pieces spans two words")
        self.marks = {m: self.a.encode(m, add_special_tokens=False).ids for m in ("", ".", ",")}
        # Ids of both as 16-bit numbers by run; runs whose bytes either does not give back.
        self.a_runs: dict[str, bytes] = {}
        self.b_runs: dict[str, bytes] = {}
        self.lost: set[str] = set()
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        # Every number behind each separator: the text of the groups is a look-up.
        n = max(len(self.a_bytes), len(self.b_bytes))
        self.marked = [f"{mark}{k}" for mark in ",;|" for k in range(n)]
        self.numbers = n

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        if self.b.is_byte(k):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("\u2581", " ").encode()

    def _bytes(self, runs: list[str]) -> list[list[int]]:
        # Letters behind a blank are never cut, so the model alone does, and once for all signs
        # behind them.  Letters beyond these are left to the whole tokenizer.
        found, words, others = {}, {}, []
        for run in runs:
            word, mark = (run[:-1], run[-1]) if run[-1] in ".," else (run, "")
            letters = word[1:] if word[:1] == " " else word
            if letters.isalpha() and max(letters) <= "\u024f":
                ids = words.get(word)
                if ids is None:
                    spelled = word.encode().decode("latin-1").translate(self.spelling)
                    ids = words[word] = [t.id for t in self.a.model.tokenize(spelled)]
                found[run] = ids + self.marks[mark]
            else:
                others.append(run)
        for run, coded in zip(others, self.a.encode_batch_fast(others, add_special_tokens=False)):
            found[run] = coded.ids
        return [found[run] for run in runs]

    def _pieces(self, runs: list[str]) -> list[list[int]]:
        # The model puts a blank before each text itself, but for the empty one.
        blank = [self.b.piece_to_id("\u2581")]
        found = self.b.encode([run[1:] for run in runs], num_threads=1)
        return [blank if run == " " else ids for run, ids in zip(runs, found)]

    def _learn(self, lists: list[list[str]]) -> None:
        """Encode the runs of all lists that are not known yet."""
        known = self.a_runs
        new = list({run: None for runs in lists for run in runs if run not in known})
        if len(known) + len(new) > REMEMBERED:
            for memory in (self.a_runs, self.b_runs, self.lost):
                memory.clear()
            new = list({run: None for runs in lists for run in runs})
        if not new:
            return
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for run, a, b in zip(new, self._bytes(new), self._pieces(new)):
            whole = run.encode()
            if b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
                self.lost.add(run)
            self.a_runs[run] = array("H", a).tobytes()
            self.b_runs[run] = array("H", b).tobytes()

    def encoded(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of both as 16-bit numbers; both empty where either does not give the bytes back.

        Runs are encoded apart.  A byte-level tokenizer cuts before such a blank, and the other
        has no entry that holds a blank behind another character.
        """
        lists = [_RUNS.findall(" " + text) if text else [] for text in texts]
        self._learn(lists)
        a, b = self.a_runs.__getitem__, self.b_runs.__getitem__
        return [(b"", b"") if self.lost and not self.lost.isdisjoint(runs)
                else (b"".join(map(a, runs)), b"".join(map(b, runs))) for runs in lists]


_LOADED: dict[tuple[str, str], TokenPair] = {}


def token_pair(bytes_path: str, pieces_path: str) -> TokenPair:
    """The worker's tokenizers of these files."""
    key = (bytes_path, pieces_path)
    if key not in _LOADED:
        _LOADED[key] = TokenPair(*key)
    return _LOADED[key]


def jumped(pointers: np.ndarray) -> np.ndarray:
    """Where each chain of pointers ends, in a logarithmic number of doublings."""
    while True:
        further = pointers[pointers]
        if np.array_equal(further, pointers):
            return pointers
        pointers = further


def aligned_ends(a_ends: np.ndarray, b_ends: np.ndarray):
    """Group numbers of the tokens of two tilings of the same bytes, and all links.

    Groups are numbered from 0 in order.  A link stands at each place where a token of either
    sequence ends: the two tokens that hold the byte before it.
    """
    n, m = len(a_ends), len(b_ends)
    to_b = np.searchsorted(b_ends, a_ends)  # the token of b that holds a token's last byte
    to_a = np.searchsorted(a_ends, b_ends)
    both = a_ends[to_a] == b_ends
    pointers = np.concatenate([to_b + n, np.where(both, n + np.arange(m), to_a)])
    last = jumped(pointers)
    before = np.concatenate([[0], np.cumsum(both)])
    labels = before[last - n]
    # The place of an end among all different ends.
    place = np.arange(n) + to_b - before[to_b]
    alone = np.flatnonzero(~both)
    place_b = alone + to_a[alone] - before[alone]
    link_a, link_b = (np.empty(n + len(alone), np.int64) for _ in range(2))
    link_a[place], link_b[place] = np.arange(n), to_b
    link_a[place_b], link_b[place_b] = to_a[alone], alone
    return labels[:n], labels[n:], link_a, link_b


def _aligned(pair: TokenPair, texts: list[str]):
    """Per text: tokens, groups, links, the groups' text digest, and its links' pair keys."""
    a_ids, b_ids = zip(*pair.encoded(texts))
    a_counts = np.array([len(x) // 2 for x in a_ids], np.int64)
    b_counts = np.array([len(x) // 2 for x in b_ids], np.int64)
    a = np.frombuffer(b"".join(a_ids), np.uint16).astype(np.int64)
    b = np.frombuffer(b"".join(b_ids), np.uint16).astype(np.int64)
    # Texts are laid one after the other; both sequences end at each text's end.
    a_ends, b_ends = np.cumsum(pair.a_sizes[a]), np.cumsum(pair.b_sizes[b])
    a_cut, b_cut = (np.concatenate([[0], np.cumsum(c)]) for c in (a_counts, b_counts))
    if not len(a):
        none = np.zeros(len(texts), np.int64)
        return none, none, none, none, [""] * len(texts), [np.zeros(0, np.int64)] * len(texts)
    a_group, b_group, a_link, b_link = aligned_ends(a_ends, b_ends)
    keys = a[a_link] * len(pair.b_bytes) + b[b_link]
    n_groups = int(a_group[-1]) + 1
    # First token of each group.
    group_a = np.concatenate([[0], np.cumsum(np.bincount(a_group, minlength=n_groups))])
    group_b = np.concatenate([[0], np.cumsum(np.bincount(b_group, minlength=n_groups))])
    # Tokens in the order of the digest: a group's a tokens, then its b tokens.
    order = np.empty(len(a) + len(b), np.int64)
    at_a = np.arange(len(a)) + group_b[a_group]
    at_b = np.arange(len(b)) + group_a[b_group + 1]
    order[at_a], order[at_b] = a, b
    order[group_a[:-1] + group_b[:-1]] += pair.numbers  # ';' before a group
    order[group_a[1:] + group_b[:-1]] += 2 * pair.numbers  # '|' before its b tokens
    digests, link_cut = [], np.searchsorted(a_link, a_cut)
    token_cut = (a_cut + b_cut).tolist()
    for low, high in zip(token_cut[:-1], token_cut[1:]):
        if high == low:
            digests.append("")
            continue
        text = "".join(map(pair.marked.__getitem__, order[low:high].tolist()))
        digests.append(hashlib.sha256(text[1:].encode()).hexdigest())
    first = np.searchsorted(group_a[:-1], a_cut)
    per_text = [keys[low:high] for low, high in zip(link_cut[:-1], link_cut[1:])]
    return a_counts, b_counts, np.diff(first), np.diff(link_cut), digests, per_text


def _key_type(pair: TokenPair) -> type:
    return np.uint32 if len(pair.a_bytes) * len(pair.b_bytes) < 1 << 32 else np.uint64


def _unit_documents(bytes_path: str, pieces_path: str):
    """Rows of documents with their links, and after each unit a row of its pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair = token_pair(bytes_path, pieces_path)
        kind = _key_type(pair)
        unit = TaskContext.get().partitionId() << 32
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def documents(ids: list, found) -> pa.RecordBatch:
            *numbers, digests, keys = found
            n = len(ids)
            columns = [pa.array([unit] * n, pa.int64()), pa.array(ids, pa.int64())]
            columns += [pa.array(c, pa.int64()) for c in numbers]
            columns += [pa.array(digests), pa.array([k.astype(kind).tobytes() for k in keys],
                                                    pa.binary())]
            columns += [pa.nulls(n, pa.binary())] * 2
            return pa.RecordBatch.from_arrays(columns, names)

        def together() -> tuple[np.ndarray, np.ndarray]:
            keys, where = np.unique(np.concatenate([k for k, _ in seen]), return_inverse=True)
            return keys, np.bincount(where, np.concatenate([t for _, t in seen])).astype(np.int64)

        def pairs() -> pa.RecordBatch:
            keys, times = together()
            columns = [pa.array([unit], pa.int64()), pa.nulls(1, pa.int64())]
            columns += [pa.nulls(1, pa.int64())] * 4 + [pa.nulls(1, pa.string())]
            columns += [pa.nulls(1, pa.binary())]
            columns += [pa.array([keys.astype("<u8").tobytes()], pa.binary()),
                        pa.array([times.astype("<u8").tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names)

        names = ["unit", *[part.split()[0] for part in DOCUMENT.split(",")], "links",
                 "pair_keys", "pair_times"]
        for rows in batches:
            for low, high in row_slices(rows.column("_text"), _SLICE):
                texts = rows.column("_text").slice(low, high - low).to_pylist()
                found = _aligned(pair, texts)
                yield documents(rows.column("_id").slice(low, high - low).to_pylist(), found)
                seen.append(np.unique(np.concatenate(found[-1]), return_counts=True))
                size += sum(map(len, texts))
                if size >= UNIT:
                    yield pairs()
                    unit, seen, size = unit + 1, [], 0
        if seen:
            yield pairs()
    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A unit's pairs as rows."""
    for batch in batches:
        for unit, keys, times in zip(*(batch.column(k) for k in ("unit", "pair_keys", "pair_times"))):
            keys = np.frombuffer(keys.as_buffer(), "<i8")
            times = np.frombuffer(times.as_buffer(), "<i8")
            for low in range(0, len(keys), 100_000):
                some = keys[low:low + 100_000]
                yield pa.RecordBatch.from_pydict({
                    "unit": pa.array([unit.as_py()] * len(some), pa.int64()),
                    "key": pa.array(some), "times": pa.array(times[low:low + 100_000])})


def _judged(width: int):
    """Documents of a unit with the counts of their links."""
    kind = np.dtype(f"<u{width}")

    def run(documents: pa.Table, pairs: pa.Table) -> pa.Table:
        keys = pairs.column("key").to_numpy()
        order = np.argsort(keys)
        keys = keys[order]
        totals = pairs.column("total").to_numpy()[order]
        best = pairs.column("best").to_numpy()[order]
        sums, bests = [], []
        for raw in documents.column("links"):
            links = np.frombuffer(raw.as_buffer(), kind).astype(np.int64)
            at = np.searchsorted(keys, links)
            sums.append(int(totals[at].sum()))
            bests.append(int(best[at].sum()))
        names = [part.split()[0] for part in DOCUMENT.split(",")]
        return pa.table({name: documents.column(name) for name in names}
                        | {"n_best": pa.array(bests, pa.int64()),
                           "count_sum": pa.array(sums, pa.int64())})
    return run


def align_tokens(docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per document its tokens, groups and links under two tokenizers.

    ``bytes_path`` is a byte-level vocabulary for the ``tokenizers`` library, ``pieces_path`` a
    model for ``sentencepiece``.  Both encode the whole text behind a space; strings of special
    tokens are plain text.  A text that is null, empty, or whose bytes either does not give
    back has no tokens: zeros, and an empty digest.  ``n_best`` are links whose id pair is the
    commonest of the second id, ties included; ``count_sum`` adds the corpus-wide counts of
    all links.  Rows that repeat an id or a text are counted each for itself; an empty table
    gives no rows.  Only the two named columns are read, so other columns may have any name.
    """
    pair = token_pair(bytes_path, pieces_path)
    size, width = len(pair.b_bytes), np.dtype(_key_type(pair)).itemsize
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("_text"))
    units = written(texts.mapInArrow(
        _unit_documents(bytes_path, pieces_path),
        f"unit long, {DOCUMENT}, links binary, pair_keys binary, pair_times binary"),
        "aligned-units", "zstd")
    pairs = units.where("pair_keys is not null").select("unit", "pair_keys", "pair_times")
    pairs = pairs.mapInArrow(_spread, "unit long, key long, times long")
    totals = written(pairs.groupBy("key").agg(F.sum("times").alias("total")), "pair-counts")
    second = F.col("key") % size
    most = totals.groupBy(second.alias("second")).agg(F.max("total").alias("most"))
    counts = totals.withColumn("second", second).join(most, "second").select(
        "key", "total", (F.col("total") == F.col("most")).alias("best"))
    known = pairs.join(counts, "key").select(F.col("unit").alias("own"), "key", "total", "best")
    documents = units.where("links is not null").drop("pair_keys", "pair_times")
    out = f"{DOCUMENT}, n_best long, count_sum long"
    linked = documents.where("n_links > 0").groupBy("unit").cogroup(known.groupBy("own"))
    return linked.applyInArrow(_judged(width), out).unionByName(
        documents.where("n_links = 0").select(
            *[part.split()[0] for part in DOCUMENT.split(",")],
            F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum")))
