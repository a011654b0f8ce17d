"""The pipeline, stage by stage against plain versions, over real rows and odd ones."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lanewatch.llm import queries as llm
from lanewatch.llm.common import table
from lanewatch.llm.tokens import tokenizer
from lanewatch.llm.toxicity import FOLDS, chain_labels, fit_logistic, train_chain, words_of
from test_copies import brute_groups, normal, pairs

SF = "/root/testdata/sf0.001"
CLASHES = "_id _row _text _hash _keep _p _source _parts _stay component size unit start length".split()
NEAR = [f"near{k}" for k in range(60)]
ODD = [
    (None, "a text without an id", "odd"), (10_001, None, "odd"), (10_002, "", None),
    (10_003, " \t\n ", "odd"), (10_004, "twice the same row", "odd"),
    (10_004, "twice the same row", "odd"), (10_005, "one  text\nwith gaps", "odd"),
    (10_005, "one text with gaps", "odd"), (10_006, "long " * 30_000, "odd"),
    (10_007, "one text with gaps", "other"), (10_008, " ".join(NEAR), "odd"),
    (10_009, " ".join([*NEAR, "more"]), "odd"), (10_010, "é" * 300, "odd"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables with odd rows and clashing columns in ``documents``."""
    path = tmp_path_factory.mktemp("pipeline")
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame(ODD, "doc_id long, text string, source string").select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text", "source")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    for name in CLASHES:
        docs = docs.withColumn(name, F.lit("x"))
    docs.write.parquet(f"{path}/documents.parquet")
    table(spark, SF, "labels").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture(scope="module")
def steps(spark, folder):
    """What goes into each stage and what comes out, as written tables."""
    docs, out = table(spark, folder, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, folder)
        if name != "packing":
            assert result.columns == docs.columns
        path = f"{folder}/out-{name}"
        result.write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def plain_probability(weights, values):
    x = sum(w * v for w, v in zip(weights, values)) + weights[-1]
    return 1 / (1 + math.exp(-x))


def plain_features(text, words):
    seen = Counter(words_of(text or ""))
    return [math.log1p(seen[w]) for w in words]


def test_chain_is_fitted_as_by_hand(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    chain = train_chain(docs, labels)
    texts = dict(pairs(docs))
    targets = {r["doc_id"]: r for r in chain_labels(labels).collect() if r["doc_id"] in texts}
    ids = sorted(targets)
    assert len(ids) > 50
    earlier = {doc: [] for doc in ids}
    for k, category in enumerate(chain.categories):
        row = {doc: plain_features(texts[doc], chain.words_of[category]) + earlier[doc] for doc in ids}
        fold = {doc: (doc * 2654435761 >> 7) % FOLDS for doc in ids}

        def fitted(some):
            return fit_logistic(np.array([row[d] for d in some]),
                                np.array([float(targets[d][category]) for d in some]))

        assert np.allclose(chain.models[k], fitted(ids), atol=1e-6)
        apart = {f: fitted([d for d in ids if fold[d] != f]) for f in set(fold.values())}
        for doc in ids:
            earlier[doc] = earlier[doc] + [plain_probability(apart[fold[doc]], row[doc])]


def test_toxicity_stage(spark, folder, steps):
    docs, kept = steps["toxicity"]
    chain = train_chain(docs, table(spark, folder, "labels"))
    want = Counter()
    for doc, text in pairs(docs):
        values = []
        for k, category in enumerate(chain.categories):
            own = plain_features(text, chain.words_of[category]) + values
            values.append(plain_probability(chain.models[k], own))
        if values[chain.categories.index("toxic")] < 0.7:
            want[doc, text] += 1
    assert Counter(pairs(kept)) == want


def test_exact_stage(steps):
    docs, kept = steps["exact_dedup"]
    first = {}
    for doc, text in pairs(docs):
        key = normal(text)
        known = first.get(key)
        first[key] = doc if known is None else known if doc is None else min(known, doc)
    assert Counter((d, normal(t)) for d, t in pairs(kept)) == Counter((d, t) for t, d in first.items())


def test_near_stage(steps):
    docs, kept = steps["ngram_jaccard"]
    _, top = brute_groups(pairs(docs), 5, 80)
    want = Counter((d, t) for d, t in pairs(docs) if d is None or top(d) == d)
    assert Counter(pairs(kept)) == want
    ids = {doc for doc, _ in want}
    assert 10_008 in ids and 10_009 not in ids and None in ids


def test_mixing_stage(folder, steps):
    docs, mixed = steps["mixing"]
    sql = llm.mixing_sql(f"read_parquet('{folder}/out-ngram_jaccard/*.parquet')", columns="doc_id, text")
    assert Counter(pairs(mixed)) == Counter(duckdb.connect().execute(sql).fetchall())


def packed_as(rows, data):
    words = tokenizer(llm.vocabulary_path())
    copies, ids = Counter(doc for doc, _ in data), {}
    for doc, text in data:
        ids[doc] = np.array([*np.frombuffer(words.encode(text or ""), np.uint16), 2], "<u4")
    held, sequences = {doc: np.zeros(len(i), int) for doc, i in ids.items()}, {}
    for r in rows:
        end = r["start"] + r["length"]
        held[r["doc_id"]][r["start"]:end] += 1
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"]:end].tobytes())
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all((held[doc] == n).all() for doc, n in copies.items())
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0


def test_packing_stage(steps):
    docs, packed = steps["packing"]
    packed_as(packed.collect(), pairs(docs))


def test_run_is_its_stages(spark, folder, steps):
    def tokens(rows):
        found = Counter()
        for r in rows:
            found[r["doc_id"], r["doc_tokens"]] += r["length"]
        return found

    got = corpus_pipeline.run(spark, folder).collect()
    assert tokens(got) == tokens(steps["packing"][1].collect())
    packed_as(got, pairs(steps["packing"][0]))


def test_run_on_nothing(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        table(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() == 0 and "sequence_id" in got.columns
