"""Dual-tree search, token alignment and collocations, against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lanewatch.llm import collocations as C
from lanewatch.llm.common import table
from lanewatch.llm.collocations import NgramCode, collocations, filter_of, floor_score, numbers_of
from lanewatch.llm.dual_tree import Search, bound, cover_tree, largest_products
from lanewatch.llm.token_alignment import TokenPair, aligned_ends, align_tokens, jumped

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
B_FILE = public_tokenizers.path("piece_bpe_32k.model")


# Dual-tree search

def clustered(n: int, seed: int = 3) -> np.ndarray:
    random_ = np.random.default_rng(seed)
    centres = random_.normal(0, 1, (40, 16))
    return centres[random_.integers(0, 40, n)] + random_.normal(0, 0.02, (n, 16))


def plain_products(vectors: dict, k: int = 5) -> dict:
    whole = {i: [int(np.floor(256 * float(c))) for c in v] for i, v in vectors.items()}
    out = {}
    for q in whole:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


def listed(rows) -> dict:
    out: dict = {}
    for row in rows:
        out.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    return {q: sorted(found) for q, found in out.items()}


def test_cover_tree_covers_and_separates():
    points = clustered(600)
    waiting = [cover_tree(points, 10)]
    assert len(waiting[0].leaves()) > 20
    assert sorted(np.concatenate([x.members for x in waiting[0].leaves()])) == list(range(600))
    while waiting:
        node = waiting.pop()
        away = np.linalg.norm(points[node.members] - node.centre, axis=1)
        assert away.max() <= node.radius + 1e-9
        for i, child in enumerate(node.children):
            assert child.radius <= node.radius / 2 + 1e-9
            for other in node.children[:i]:
                assert np.linalg.norm(child.centre - other.centre) > node.radius / 2
        waiting += node.children


def test_bounds_hold_and_descent_prunes():
    x = np.floor(256 * clustered(3000)).astype(np.int64)
    tree = cover_tree(x.astype(float), 50)
    ends = tree.leaves()
    for a in ends[:12]:
        for b in ends:
            assert (x[a.members] @ x[b.members].T).max() <= bound(a, b)
    search = Search(x, np.arange(3000), x[::50], np.arange(0, 3000, 50), [-np.inf] * 60, 5)
    found = search.run(32)
    assert search.scored < 0.3 * 60 * 3000
    scores = x[::50] @ x.T
    scores[np.arange(60), np.arange(0, 3000, 50)] = -(1 << 60)
    best = -np.sort(-scores, axis=1)[:, :5]
    got = found.sort_values(["query_id", "score"], ascending=[True, False])["score"].to_numpy()
    assert (got.reshape(60, 5) == best).all()


def test_large_components_stay_exact():
    random_ = np.random.default_rng(4)
    x = random_.integers(-(1 << 26) + 1, 1 << 26, (300, 64))
    found = Search(x, np.arange(300), x[:4], np.arange(4), [-np.inf] * 4, 5).run(20)
    for q in range(4):
        scores = sorted((-sum(int(a) * int(b) for a, b in zip(x[q], x[i])), i)
                        for i in range(300) if i != q)[:5]
        mine = found[found.query_id == q].sort_values(["score", "vec_id"], ascending=[False, True])
        assert [(-s, i) for s, i in zip(mine.score, mine.vec_id)] == scores


@pytest.mark.parametrize("block,group,leaves", [(400, 8, 30), (8192, 1024, 256), (50, 3, 7)])
def test_products_of_clusters_equal_plain_search(rows, block, group, leaves):
    data = {i: v.tolist() for i, v in enumerate(clustered(1500))}
    table_ = rows("vec_id long, embedding array<double>", list(data.items()), "rank score id leaf")
    got = largest_products(table_, F.col("id") % 50 == 0, block=block, group=group, leaves=leaves)
    assert listed(got.collect()) == plain_products(data)


def test_products_on_odd_vectors(rows):
    nan, inf = float("nan"), float("inf")
    good = {0: [0.0, 0.0], 50: [1.0, -1.0], 7: [0.5, 0.5], 8: [0.5, 0.5], 100: [-0.001, 3.0]}
    data = [*good.items(), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, []),
            (None, [1.0, 1.0]), (6, [1.0, 2.0, 3.0]), (7, [0.5, 0.5])]
    schema = "vec_id long, embedding array<double>"
    got = largest_products(rows(schema, data), F.col("id") % 50 == 0).collect()
    assert listed(got) == plain_products(good)
    copies = {i: [0.25, 0.5] for i in range(700)}
    got = largest_products(rows(schema, list(copies.items())), F.col("id") % 50 == 0, block=100, group=4)
    assert listed(got.collect()) == plain_products(copies)
    assert largest_products(rows(schema, []), F.col("id") % 50 == 0).collect() == []
    assert largest_products(rows(schema, [(1, [1.0])]), F.col("id") % 50 == 0).collect() == []
    assert largest_products(rows(schema, [(50, [1.0])]), F.col("id") % 50 == 0).collect() == []


# Token alignment

def plain_alignment(texts: dict) -> dict:
    pair = TokenPair(A_FILE, B_FILE)
    counts, per = Counter(), {}
    for key, text in texts.items():
        text = text or ""
        a = pair.a.encode(" " + text, add_special_tokens=False).ids
        b = pair.b.encode(text)
        whole = (" " + text).encode()
        if (not text or b"".join(pair.a_bytes[i] for i in a) != whole
                or b"".join(pair.b_bytes[i] for i in b) != whole):
            a, b = [], []
        spans = []
        for ids, entries in ((a, pair.a_bytes), (b, pair.b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(entries[i]), i))
                at += len(entries[i])
            spans.append(own)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, links, start = [], [], 0
        for end in ends:
            x, y = ([t for t in own if start < t[1] <= end] for own in spans)
            groups.append(",".join(str(t[2]) for t in x) + "|" + ",".join(str(t[2]) for t in y))
            links += [(t[2], u[2]) for t in x for u in y if t[0] < u[1] and u[0] < t[1]]
            start = end
        counts.update(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        per[key] = (len(a), len(b), len(groups), links, digest)
    best: dict = {}
    for (_, second), n in counts.items():
        best[second] = max(best.get(second, 0), n)
    return {key: (a, b, g, len(links), sum(counts[x] == best[x[1]] for x in links),
                  sum(counts[x] for x in links), digest)
            for key, (a, b, g, links, digest) in per.items()}


def alignment_rows(df) -> dict:
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
            for r in df.collect()}


def test_pointers_jump_to_the_end_of_their_chain():
    n = 10_000
    assert (jumped(np.minimum(np.arange(n) + 1, n - 1)) == n - 1).all()


def test_random_tilings_equal_interval_overlaps():
    random_ = random.Random(5)
    for _ in range(200):
        size = random_.randint(1, 30)
        a, b = (np.array(sorted({size, *random_.sample(range(1, size + 1), random_.randint(0, size - 1))}))
                for _ in range(2))
        a_group, b_group, link_a, link_b = aligned_ends(a, b)
        shared = sorted(set(a.tolist()) & set(b.tolist()))
        assert [sum(e < end for e in shared) for end in a.tolist()] == a_group.tolist()
        assert [sum(e < end for e in shared) for end in b.tolist()] == b_group.tolist()
        spans = [list(zip([0, *x.tolist()], x.tolist())) for x in (a, b)]
        links = [(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1])
                 if x[0] < y[1] and y[0] < x[1]]
        assert sorted(zip(link_a.tolist(), link_b.tolist())) == links


def test_alignment_of_odd_texts_equals_plain_version(rows):
    random_ = random.Random(6)
    parts = [" ", "a", "\n", "\t", "  ", "\x1c", "\x85", "\xa0", "　", "▁", "<|endoftext|>",
             "<s>", "<unk>", "<0x41>", "'s", "'LL", "12", "é", "ß", "漢字", "🙂", "\x00", ".", "...",
             "İ", "​", " ", "The", "\r\n", "²", "ﬁ", "﻿"]
    texts = {i: "".join(random_.choice(parts) for _ in range(random_.randint(0, 12))) for i in range(600)}
    texts |= {1000: None, 1001: "", 1002: "word " * 5000, 1003: "x" * 20_000, 1004: "same", 1005: "same"}
    table_ = rows("doc_id long, text string", list(texts.items()), "unit links key total n_a")
    got = alignment_rows(align_tokens(table_, A_FILE, B_FILE))
    assert got == plain_alignment(texts)
    assert got[1000] == (0, 0, 0, 0, 0, 0, "")
    repeated = rows("doc_id long, text string", [(1, "a b"), (1, "a b"), (None, "a b")])
    found = align_tokens(repeated, A_FILE, B_FILE).collect()
    assert sorted((r.doc_id or 0, r.n_links, r.n_best, r.count_sum) for r in found) \
        == [(0, 2, 2, 6), (1, 2, 2, 6), (1, 2, 2, 6)]
    assert align_tokens(rows("doc_id long, text string", []), A_FILE, B_FILE).collect() == []


def test_alignment_of_the_whole_table_equals_plain_version(spark, monkeypatch):
    monkeypatch.setattr("lanewatch.llm.token_alignment.UNIT", 100_000)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert alignment_rows(align_tokens(docs, A_FILE, B_FILE)) == plain_alignment(texts)


# Collocations

def plain_collocations(docs, longest=3, least=10, cover=50, most=2000):
    counts: dict = {}
    sizes: Counter = Counter()
    letters = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in docs:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(letters)):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for n in range(1, longest + 1):
                f.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        dropped = set()
        for g, a in candidates.items():
            for n in range(2, len(g)):
                dropped |= {g[i:i + n] for i in range(len(g) - n + 1)
                            if 100 * a >= cover * candidates[g[i:i + n]]}
        scored = []
        for g, a in candidates.items():
            if g not in dropped:
                score, _, l, r = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]])
                                     for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def collocation_rows(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"])
                  for r in df.collect())


@pytest.mark.parametrize("width,longest", [(3, 2), (5, 3), (21, 3), (22, 3), (32, 4), (42, 3)])
def test_filters_give_their_ngrams_back(width, longest):
    code = NgramCode(width, longest)
    random_ = np.random.default_rng(width)
    words = [random_.integers(1, 1 << width, 2000, dtype=np.uint64) for _ in range(longest)]
    words[-1][:900] = 0
    high, low = code.permuted(*code.packed(words))
    back = code.words(*code.restored(high, low))
    assert all((a == b).all() for a, b in zip(words, back))
    high, low, counts = code.counted(high, low, random_.integers(1, 1000, 2000))
    whole = numbers_of(code, 0, 0, *filter_of(code, high, low, counts, 0))
    assert all((a == b).all() for a, b in zip((high, low, counts), whole))
    prefix = int(high[-1] >> np.uint64(code.half - 3))
    same = high >> np.uint64(code.half - 3) == prefix
    part = numbers_of(code, prefix, 3, *filter_of(code, high[same], low[same], counts[same], 3))
    assert all((a[same] == b).all() for a, b in zip((high, low, counts), part))


def test_scores_are_exact_beyond_64_bits(spark):
    big = [(3 * 10**15, 3 * 10**15, 9 * 10**15), (10**9 + 7, 10**9 + 9, 10**9 + 21), (10, 10, 10)]
    got = spark.createDataFrame(big, "a long, l long, r long").select(
        floor_score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert [r[0] for r in got] == [1000000 * a * a // (l * r) for a, l, r in big]


@pytest.mark.parametrize("longest,unit,shard,bits", [(3, 8 << 20, 1 << 21, 8), (4, 2000, 20, 2)])
def test_collocations_equal_plain_version(rows, monkeypatch, longest, unit, shard, bits):
    monkeypatch.setattr(C, "UNIT", unit)
    random_ = random.Random(7)
    words = ["a", "B", "b", "É", "é", "x\xa0y", "new", "york", "city", "-", "the", "\x1c"]
    docs = []
    for i in range(400):
        text = "".join(random_.choice(words) + random_.choice([" ", " ", "\t", "  ", ", ", "\n", ".", "\x0b"])
                       for _ in range(random_.randint(0, 60)))
        docs.append((text + random_.choice(["", " New York city", "new york"]),
                     random_.choice(["en", "de", None, "und", ""])))
    docs += [(None, "en"), ("", "xx"), ("q r " * 20_000, "en"), (" \t\n", None)]
    table_ = rows("text string, lang string", docs, "unit word place id a l r n score rank _lang")
    got = collocations(table_, longest=longest, shard=shard, round_bits=bits)
    assert collocation_rows(got) == plain_collocations(docs, longest)
    few = collocations(table_, longest=longest, least=3, most=4, cover=80)
    assert collocation_rows(few) == plain_collocations(docs, longest, 3, 80, 4)


def test_collocations_of_nothing(rows):
    schema = "text string, lang string"
    assert collocations(rows(schema, [])).collect() == []
    assert collocations(rows(schema, [(None, None), ("a b", "en"), (". , ;", "en")])).collect() == []
