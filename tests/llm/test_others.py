"""The other operators: round trips, brute force, held-out accuracy, odd rows."""

import hashlib
import json
import os
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from lanewatch.llm import page_diff, queries as llm
from lanewatch.llm.common import table
from lanewatch.llm.mixing import mix_sources, source_rates
from lanewatch.llm.nearest import nearest_neighbours
from lanewatch.llm.packing import hilbert_keys, pack_documents, powers_of_two
from lanewatch.llm.page_diff import extract_main_text, shared_lines
from lanewatch.llm.pii import disguised_spans, find_personal_data, plain_spans
from lanewatch.llm.tokens import tokenizer
from lanewatch.llm.tool_calls import (
    SCHEMAS, calls_of, canonical, dependency_levels, link_tool_calls, results_of, schema_errors)
from lanewatch.llm.toxicity import drop_toxic, toxicity_report

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_query_against_its_sql(spark, name):
    text, _ = differences(spark, connect(SF), SF, name, llm.queries()[name], llm.oracle_sql()[name])
    assert text == ""


# --- personal data -----------------------------------------------------------------------

def test_plain_spans_equal_the_patterns():
    text = ("a.b@c.de, x@y, @z.com q@@w.org 1.2.3.4.5.6.7.8 256.1.1.1 +1 (017) 555-7713; "
            "4111 1111 1111 1111; 4111111111111112; ++49 30 1234567 aa@b.c@d.e 00001.2.3.4")
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    got = plain_spans(text)
    emails = [("email", *m.span()) for m in re.finditer(patterns["email"], text)]
    ips = [("ip", *m.span()) for m in re.finditer(patterns["ip"], text)
           if all(int(p) <= 255 for p in m[0].split("."))]
    assert [s for s in got if s[0] == "email"] == emails
    assert [s for s in got if s[0] == "ip"] == ips
    assert [text[a:b] for k, a, b in got if k == "card"] == ["4111 1111 1111 1111"]
    assert ("phone", text.index("+1 (017)"), text.index("+1 (017)") + 17) in got


@pytest.mark.parametrize("text, kind, source", [
    ("mail john (at) site (dot) com now", "email", "john (at) site (dot) com"),
    ("mail john at site dot com now", "email", "john at site dot com"),
    ("mail jоhn@site.com now", "email", "jоhn@site.com"),
    ("ip １２.３４.５６.７８ x", "ip", "１２.３４.５６.７８"),
    ("ip 10 dot 0 dot 0 dot 1 x", "ip", "10 dot 0 dot 0 dot 1"),
    ("call plus one two three four five six seven eight nine zero now", "phone",
     "plus one two three four five six seven eight nine zero"),
    ("no​one jane@​mail.com", "email", "jane@​mail.com"),
])
def test_disguises_map_back_to_the_source(text, kind, source):
    found = disguised_spans(text, plain_spans(text))
    assert (kind, source) in [(k, text[a:b]) for k, a, b in found]


@pytest.mark.parametrize("text, kind, source", [
    ("ip one nine two dot one six eight dot zero dot one x", "ip",
     "one nine two dot one six eight dot zero dot one"),
    ("ip 192 dot one six eight (dot) 0 dot eins x", "ip", "192 dot one six eight (dot) 0 dot eins"),
    ("ip one.two.three.four x", "ip", "one.two.three.four"),
    ("ip 10.zero.0.1 x", "ip", "10.zero.0.1"),
    ("call plus one.two.three.four.five.six.seven.eight.nine.zero", "phone",
     "plus one.two.three.four.five.six.seven.eight.nine.zero"),
    ("call plus one two three.four five six.seven eight.nine zero", "phone",
     "plus one two three.four five six.seven eight.nine zero"),
    ("card four one one one.one one one one.one one one one.one one one one", "card",
     "four one one one.one one one one.one one one one.one one one one"),
    ("mail jane at example.com now", "email", "jane at example.com"),
    ("mail jane@example dot com now", "email", "jane@example dot com"),
    ("mail jane at mail.example dot com now", "email", "jane at mail.example dot com"),
    (f"mail {'j' * 90} at site dot com now", "email", f"{'j' * 90} at site dot com"),
    (f"mail jane at {'sub dot ' * 12}com", "email", f"jane at {'sub dot ' * 12}com"),
    (f"mail jane at {'d' * 80} dot com", "email", f"jane at {'d' * 80} dot com"),
    (f"mail jane{' ' * 9}at{' ' * 9}site dot com", "email", f"jane{' ' * 9}at{' ' * 9}site dot com"),
    ("call plus 4 nine one five five five 1 two three four now", "phone",
     "plus 4 nine one five five five 1 two three four"),
    ("correo jane arroba mail punto example punto es ya", "email", "jane arroba mail punto example punto es"),
    ("jane arobase example point fr merci", "email", "jane arobase example point fr"),
    ("an jane at example punkt de bitte", "email", "jane at example punkt de"),
    ("mail jane&#64;example.com now", "email", "jane&#64;example.com"),
    ("mail jane&commat;example&#x2E;com now", "email", "jane&commat;example&#x2E;com"),
])
def test_halves_and_long_forms_of_disguises(text, kind, source):
    assert [(k, text[a:b]) for k, a, b in disguised_spans(text, plain_spans(text))] == [(kind, source)]


def test_disguises_take_linear_time():
    for text in ("a" + " " * 200_000 + "at dot", "one " * 50_000 + "dot", "x at " * 40_000 + "y.com",
                 "( " * 100_000 + "at)", "a@b dot " * 30_000, "a" * 200_000 + " at " + "b." * 90_000):
        disguised_spans(text, [])


def test_many_plain_spans_beside_one_disguise_take_linear_time():
    text = "a@b.com " * 60_000 + "jane (at) site (dot) com 10.0.0.1"
    plain = plain_spans(text)
    found = disguised_spans(text, plain)
    assert [text[a:b] for _, a, b in found] == ["jane (at) site (dot) com"]


def test_added_spans_equal_those_found_by_comparing_all(spark):
    """Disguises planted in every text of the table, beside its plain identifiers."""
    planted = ["jane (at) site (dot) com", "joe at mail dot example dot org", "10 dot 0 dot 0 dot 1",
               "plus 4 nine one five five five 1 two three four", "ana&#64;example.com"]
    texts = [r[0] or "" for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    for k, source in enumerate(texts):
        disguise = planted[k % len(planted)]
        at = source.find(" ", len(source) // 2)
        text = f"{source[:at]} | {disguise} | {source[at:]}" if at >= 0 else disguise
        plain = plain_spans(text)
        added = disguised_spans(text, plain)
        assert disguise in [text[a:b] for _, a, b in added]
        for kind, start, end in added:
            assert not any(p == kind and s <= start and end <= e for p, s, e in plain)


@pytest.mark.parametrize("text", [
    "meet at 10.30 or at 1.5", "one. Two dots. Three", "he is at home. Then at work.",
    "look at this point it is", "1, 2, 3, 4 und fünf", "10.0.0.1, two", "er ist at home punkt",
    "+49 30 1234567 one two", "&#64; &amp; &#46;",
    "he was at home and at ease dot", "one two three", "Привет, как дела", "at the dot of two", ""])
def test_prose_has_no_disguises(text):
    assert disguised_spans(text, []) == []


def test_personal_data_on_odd_rows(odd, empty):
    assert find_personal_data(odd).count() == odd.count()
    assert find_personal_data(empty).count() == 0
    none = find_personal_data(odd).where("doc_id = 2").first()
    assert none["base_sha256"] == hashlib.sha256(b"").hexdigest() and none["spans"] == ""


def test_long_runs_take_linear_time():
    plain_spans("a" * 200_000 + "@" + "1" * 200_000)
    plain_spans("1." * 100_000 + "+" * 1000 + "a@" * 50_000)


# --- toxicity ------------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    held = labels.where("doc_id % 4 = 0")
    report = toxicity_report(
        table(spark, sf, "documents").join(labels.select("doc_id"), "doc_id"),
        labels.where("doc_id % 4 <> 0"))
    both = report.join(held, "doc_id").groupBy("toxic", "rejected").count().collect()
    n = {(r["toxic"], r["rejected"]): r["count"] for r in both}
    assert n[(1, True)] >= 0.88 * (n[(1, True)] + n.get((1, False), 0))
    assert n.get((0, True), 0) <= 0.01 * (n[(0, False)] + n.get((0, True), 0))


def test_toxicity_on_odd_rows(spark, rows, odd, empty):
    none = rows("doc_id long, quality int, toxic int", [])
    assert toxicity_report(odd, none).where("rejected").count() == 0
    assert drop_toxic(odd, none).columns == odd.columns
    assert drop_toxic(empty, none).count() == 0
    some = rows("doc_id long, quality int, toxic int",
                [(1, None, 1), (1, 0, None), (5, 1, 0), (None, 1, 1), (99, 1, 1)])
    assert toxicity_report(odd, some).count() == odd.count()


# --- tool calls ----------------------------------------------------------------------------

def test_tool_calls(spark, rows):
    calls = rows("conv_id long, turn long, call_id string, name string, arguments string,"
                 " depends array<string>", [
        (1, 1, "a", "t", '{"b": 1.0, "a": "ü"}', []), (1, 3, "b", "t", '{"b": "x"}', ["a", "zz"]),
        (1, 5, "c", "t", "{", ["b"]), (1, 7, "d", "t", '{"b": 2}', ["e"]),
        (1, 9, "e", "t", '{"b": 2}', ["d"]), (2, 1, "a", "u", "{}", None),
        (None, 1, "a", "t", "{}", []), (3, 2, "a", "t", '{"b": 3}', []),
        (3, 1, "a", "t", '{"b": 4}', [])])
    results = rows("conv_id long, turn long, call_id string, content string", [
        (1, 4, "b", "late"), (1, 2, "a", "r"), (1, 3, "a", "later"), (1, 9, "q", "lost"),
        (3, 3, "a", None), (1, 6, None, "x")])
    schema = {"t": {"type": "object", "required": ["b"], "properties": {"b": {"type": "number"}}}}
    got = {(r["conv_id"], r["call_id"]): r for r in link_tool_calls(calls, results, schema).collect()}
    assert {k: (r["level"], r["status"]) for k, r in got.items()} == {
        (1, "a"): (0, "linked"), (1, "b"): (1, "invalid"), (1, "c"): (2, "invalid"),
        (1, "d"): (None, "cyclic"), (1, "e"): (None, "cyclic"), (2, "a"): (0, "invalid"),
        (3, "a"): (0, "linked")}
    assert got[(1, "a")]["json"] == (
        '{"arguments":{"a":"ü","b":1},"id":"a","name":"t","result":"r","type":"tool_call"}')
    assert got[(1, "a")]["n_results"] == 2 and '"b":4' in got[(3, "a")]["json"]
    nothing = link_tool_calls(calls.limit(0), results.limit(0), schema)
    assert nothing.count() == 0


def test_arguments_that_no_double_and_no_text_hold(rows):
    """Integers of hundreds of digits and halves of surrogate pairs are faults of one call, or none."""
    schema = {"t": {"type": "object", "additionalProperties": False, "properties": {
        "n": {"type": "integer", "maximum": 5}, "s": {"type": "string"}}}}
    big = "1" + "0" * 400
    calls = rows(
        "conv_id long, turn long, call_id string, name string, arguments string, depends array<string>", [
            (1, 1, "a", "t", f'{{"n": {big}}}', []), (1, 2, "b", "t", '{"s": "x\\ud800y"}', []),
            (1, 3, "c", "t", '{"\\udc00": 1, "n": 3.0}', []), (1, 4, "d", "t", '{"s": "\\ud83d\\ude00"}', []),
            (1, 5, "e", "t", '{"n": 1e999}', []), (1, 6, "f", "t", '{"n": ' + "9" * 5000 + "}", []),
            (1, 7, "g", "t", '{"n": 2.5}', [])])
    results = rows("conv_id long, turn long, call_id string, content string", [
        (1, 9, c, "r") for c in "abcdefg"])
    got = {r["call_id"]: r for r in link_tool_calls(calls, results, schema).collect()}
    assert {c: r["errors"] for c, r in got.items()} == {
        "a": "$.n: above 5", "b": "", "c": "$.\\udc00: unknown", "d": "", "e": "$: not JSON",
        "f": "$: not JSON", "g": "$.n: not of type integer"}
    assert '"s":"x\\ud800y"' in got["b"]["json"] and '"s":"\U0001f600"' in got["d"]["json"]
    assert f'"n":{big}' in got["a"]["json"] and '"\\udc00":1' in got["c"]["json"]


def test_tool_call_query_against_brute_force(spark):
    turns = {(r["conv_id"], r["turn"]): r for r in table(spark, SF, "conversations").collect()}
    got = {(r["conv_id"], r["turn"]): r for r in llm.op4_tool_calls(spark, SF).collect()}
    asked = {k for k, r in turns.items() if r["role"] == "assistant"}
    assert set(got) == asked
    for (conv, turn), row in got.items():
        level, at = 0, turn
        while at > 2 and at // 2 % 4 != 0 and (conv, at - 2) in asked:
            level, at = level + 1, at - 2
        assert row["level"] == level
        answer = turns.get((conv, turn + 1))
        assert row["n_results"] == int(answer is not None and answer["role"] == "user")
        assert canonical(json.loads(row["json"])) == row["json"]


def test_levels_through_a_whole_conversation(spark, rows):
    turns = [(1, t, "assistant" if t % 2 == 0 and t else "user", f"t{t}") for t in range(0, 91)]
    turns += [(2, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(0, 32)]
    turns = rows("conv_id long, turn long, role string, text string", turns)
    got = link_tool_calls(calls_of(turns), results_of(turns), SCHEMAS).collect()
    assert {(r["conv_id"], r["turn"]): r["level"] for r in got} == {
        **{(1, t): t // 2 - 1 for t in range(2, 91, 2)}, **{(2, t): t // 2 for t in range(1, 32, 2)}}
    assert [r["level"] for r in got] == [*range(45), *range(16)]


def test_levels_against_brute_force(spark, rows):
    dice, calls = np.random.default_rng(3), []
    for conv in range(6):
        for k in range(40):
            earlier = {int(max(0, k - dice.integers(1, 5))) for _ in range(dice.integers(0, 3))} - {k}
            calls.append((conv, str(k), [str(e) for e in earlier]))
    calls += [(9, str(k), [str(k - 1)] * (k > 0)) for k in range(100)]
    calls += [(9, f"c{k}", [f"c{(k + 1) % 3}", "5"]) for k in range(3)]  # a cycle behind a chain
    calls += [(9, "after", ["c0", "7"]), (9, "self", ["self"]), (9, "ladder0", ["99"]),
              *((9, f"ladder{k}", [f"ladder{k - 1}", str(k)]) for k in range(1, 8))]
    want, waits = {}, {(c, k): [(c, d) for d in ds] for c, k, ds in calls}
    while True:
        new = {k: 1 + max((want[d] for d in ds), default=-1) for k, ds in waits.items()
               if k not in want and all(d in want for d in ds)}
        if not new:
            break
        want.update(new)
    got = dependency_levels(rows("conv_id long, call_id string, depends array<string>", calls)).collect()
    assert {(r["conv_id"], r["call_id"]): r["level"] for r in got} == want and len(got) == len(want)
    assert want[9, "ladder7"] == 107 and (9, "after") not in want


def test_schema_errors():
    schema = {"type": "object", "additionalProperties": False, "properties": {
        "k": {"enum": [1, 2]}, "l": {"type": "array", "items": {"type": "integer", "minimum": 0}}}}
    assert schema_errors({"k": 1, "l": [0, 5]}, schema) == []
    assert len(schema_errors({"k": 3, "l": [-1, "x", True], "m": 0}, schema)) == 5


# --- mixing --------------------------------------------------------------------------------

def test_mixture_reaches_its_weights(spark, rows):
    docs = rows("doc_id long, source string, copy_no int", [
        (k, "a" if k % 10 else "b", 7) for k in range(20_000)] + [(1, None, 7)])
    mixed = mix_sources(docs, weights={"a": 1.0, "b": 3.0})
    n = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["a"] - 5000) < 400 and abs(n["b"] - 15000) < 800 and None not in n
    assert mixed.columns == ["doc_id", "source", "copy_no", "shuffle_key"]
    large = mix_sources(docs.where("source = 'b'").limit(3), total=6000.0)
    assert abs(large.count() - 6000) < 400  # a rate of 2000, drawn in parts
    keys = [r["shuffle_key"] for r in mixed.limit(500).collect()]
    assert keys == sorted(keys)


def test_mixing_of_nothing(empty, odd):
    assert mix_sources(empty).count() == source_rates(empty).count() == 0
    assert set(mix_sources(odd).columns) == set(odd.columns) | {"shuffle_key"}


# --- packing -------------------------------------------------------------------------------

def packs_whole(rows_, texts, path, length):
    words, pieces, sequences = tokenizer(path), {}, {}
    for r in rows_:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for doc, text in texts.items():
        ids = np.array([*np.frombuffer(words.encode(text or ""), np.uint16), 2], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length and at & (at - 1) == 0


def test_packing_round_trip(spark, rows):
    path = llm.vocabulary_path()
    texts = {1: None, 2: "", 3: "Hello, World. it's ＡＢ é é.", 4: "word " * 9000, 5: "x\x85y z",
             6: "<|endoftext|> a", 7: "Hello, World. it's ＡＢ é é."}
    docs = rows("doc_id long, text string", list(texts.items()), "_key start length")
    got = pack_documents(docs, path, length=256, ranges=3).collect()
    packs_whole(got, texts, path, 256)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    for text in texts.values():
        assert np.frombuffer(tokenizer(path).encode(text or ""), np.uint16).tolist() == (
            whole.encode(text or "", add_special_tokens=False).ids)
    assert pack_documents(docs.limit(0), path).count() == 0
    assert sum(powers_of_two(4095)) == 4095


def test_words_learned_alone_equal_the_whole_tokenizer(tmp_path):
    """Letters and marks asked of the model apart, for every character below U+0300."""
    from tokenizers import Tokenizer

    path, random = llm.vocabulary_path(), np.random.default_rng(4)
    whole, words = Tokenizer.from_file(path), tokenizer(path)
    texts = [f.format(chr(c)) for c in range(33, 0x300) for f in (
        "{0}{0}'s..", "ab{0}_", "{0}##'", "A{0}", "{0}B,,")]
    some = [*map(chr, range(32, 0x180)), *"\u0300\u0301\u0307\u0130\u03a3\u1e9e\ufb01\u1100\u1161\u2126\x85\xa0\n\t'"]
    texts += ["".join(random.choice(some, random.integers(0, 12))) for _ in range(5000)]
    for text in texts:
        assert np.frombuffer(words.encode(text), np.uint16).tolist() == (
            whole.encode(text, add_special_tokens=False).ids), repr(text)
    other = json.loads(whole.to_str())
    other["normalizer"] = None
    (tmp_path / "other.json").write_text(json.dumps(other))
    with pytest.raises(ValueError, match="prepares texts"):
        tokenizer(str(tmp_path / "other.json"))


def test_words_are_remembered_in_one_spelling():
    from lanewatch.llm.tokens import WordTokenizer

    words = WordTokenizer(llm.vocabulary_path())
    texts = ["Un Été, UN été, un ÉTÉ,", "<|ENDOFTEXT|> Une", "<|EndOfText|>", "a<|endoftext|> B \u03a3\u0391\u03a3 A",
             "\u0130x \u00b5M \u00df\u00df,", "It'S 4.0 DON'T"]
    for text in texts:
        assert np.frombuffer(words.encode(text), np.uint16).tolist() == (
            words.whole.encode(text, add_special_tokens=False).ids), repr(text)
    assert {"un", "\u00e9t\u00e9,"} <= set(words.words) and not {"Un", "UN", "\u00c9t\u00e9,"} & set(words.words)


def test_packing_query(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    packs_whole(llm.op8_hilbert_packing(spark, SF).collect(), texts, llm.vocabulary_path(), 4096)


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = hilbert_keys(grid, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


# --- pages ---------------------------------------------------------------------------------

def test_pages(spark, rows):
    article = ("<html><head><title>t</title><script>var a='</p>';</script></head><body><nav>menu</nav>"
               "<header>site</header><article class=ad-x><header><h1>Head &amp; x</h1></header><p>One <b>two"
               "<br>three<p>Four<div class='share-buttons'><p>share</div><aside>s</aside>"
               "<section id=comments><p>first!</p></section><p hidden>h</p></article>"
               "<footer>f</footer><form><p>q</form>")
    bare = "<body><div>{}</div><p>Logo</p><p>Main {}</p><p>Imprint</p>"
    data = [(1, "http://a.de/x/1", article), (2, "http://b.de/x/1", bare.format("top", 1)),
            (3, "http://b.de/x/2", bare.format("top", 2)), (4, None, None), (5, "", "a < b &nbsp; c"),
            (6, "http://b.de/z", "")]
    pages = rows("page_id long, url string, html string", data, "text _path n_chars")
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()}
    assert got == {1: "Head & x\n\nOne two three\n\nFour", 2: "Main 1", 3: "Main 2", 4: "",
                   5: "a < b c", 6: ""}
    assert extract_main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("wrapper, kept", [
    ("<div class='page has-sidebar'>", True), ("<div class='no-sidebar'>", True),
    ("<div id=x class='layout with-comments'>", True), ("<div class='widget-area'>", True),
    ("<div class=modal-open><div>", True), ("<form id=aspnetForm>", True), ("<div hidden>", False),
    ("<div class=sidebar aria-hidden=true>", False)])
def test_a_wrapped_article_is_found(wrapper, kept):
    lines = page_diff.page_lines(
        f"<body><p>Top</p>{wrapper}<ul class=site-nav><li>menu</ul><article><h1>Head</h1><p>Text"
        "<div class='related-items'><article><p>teaser</article></div><p>end</article>")
    assert [x.text for x in lines if x.main] == (["Head", "Text", "end"] if kept else [])
    assert "menu" not in [x.text for x in lines]


def test_a_wrapped_article_beside_another_is_left_out():
    lines = page_diff.page_lines(
        "<main><p>Text</main><div class=related><article><p>teaser</article></div><p>no-sidebar")
    assert [(x.text, x.main) for x in lines] == [("Text", True), ("no-sidebar", False)]


@pytest.mark.parametrize("page", [
    "<SCRIPT>var x = 1;</SCRIPT><article><p>İstanbul text here</article>",
    "İ<SCRIPT>var x = 1;</Script><article><p>İstanbul text here</article>",
    "<style>İ</STYLE><article><p>İstanbul text here</article><script>\u017f</\u017fcript>"])
def test_letters_that_grow_in_lower_case_hide_nothing(page):
    assert [x.text for x in page_diff.page_lines(page) if x.main] == ["İstanbul text here"]


@pytest.mark.parametrize("extra", [
    "<section id='reader-comments'><p>first!</section>", "<div class=user-comments><p>first!</div>",
    "<div class='article-comments x'><p>first!</div>", "<article class=teaser><p>other</article>",
    "<article class='x teaser-small'><p>other</article>", "<article id=related-3><p>other</article>"])
def test_comments_and_teasers_are_no_main_text(extra):
    inside = page_diff.page_lines(f"<article><p>One</p>{extra}<p>Two</article>")
    assert [x.text for x in inside if x.main] == ["One", "Two"]
    beside = page_diff.page_lines(f"{extra}<article><p>One</article>{extra}")
    assert [x.text for x in beside if x.main] == ["One"]


def test_teasers_alone_are_the_main_text():
    lines = page_diff.page_lines("<article class=card><p>One</article><article class=card><p>Two</article>")
    assert [(x.text, x.main) for x in lines] == [("One", True), ("Two", True)]


def longest_common(own, other):
    """Length of a longest common subsequence, by the textbook table."""
    row = [0] * (len(other) + 1)
    for x in own:
        diagonal = 0
        for j, y in enumerate(other):
            diagonal, row[j + 1] = row[j + 1], diagonal + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


@pytest.mark.parametrize("least", [2, 3, 5])
def test_template_lines_by_number_of_texts(rows, least):
    """Thousands of pages without an article, in hosts on both sides of ``template_texts``."""
    data, wanted = [], {}
    for host in range(600):
        texts = 2 + host % 5
        held_by = 2 + host % 3  # pages of the host that hold the rare line
        for k in range(texts):
            page = host * 10 + k
            lines = ["Top"] + ["Rare"] * (k < held_by) + [f"Main text {host} {k}", "Foot"]
            data.append((page, f"http://h{host}.de/a/{k}", bare_page(*lines)))
        for k in range(texts):
            # Paths are alike, so the neighbour is the page before, or the one behind the first.
            partner = k - 1 if k else 1
            rare = k < held_by and partner < held_by and min(held_by, texts) >= min(least, texts)
            kept = ["Rare"] * (k < held_by and not rare) + [f"Main text {host} {k}"]
            wanted[host * 10 + k] = "\n\n".join(kept)
    pages = rows("page_id long, url string, html string", data)
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages, template_texts=least).collect()}
    assert got == wanted


def test_shared_lines_are_as_many_as_the_textbook_finds():
    import random
    draw = random.Random(5)
    for _ in range(300):
        own, other = ([draw.choice("abcdef") for _ in range(draw.randrange(12))] for _ in range(2))
        found = shared_lines(own, other)
        assert len(found) == longest_common(own, other)
        picked = iter(other)
        assert all(own[k] in picked for k in sorted(found))


def bare_page(*lines):
    return "<body>" + "".join(f"<p>{line}</p>" for line in lines)


def texts_of(rows, data):
    pages = rows("page_id long, url string, html string", data)
    got = {}
    for r in extract_main_text(pages).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    return got


def test_pages_of_a_large_host_meet_their_nearest_path(spark, rows):
    data = [(100 * s + k, f"http://big.de/s{s:02d}/{k}", bare_page(
        "Logo", f"Menu of section {s}", f"Story {s} {k} is told here at length", "Imprint"))
        for s in range(40) for k in range(5)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so the host spans ranges
    try:
        got = texts_of(rows, data)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == {100 * s + k: [f"Story {s} {k} is told here at length"]
                   for s in range(40) for k in range(5)}


def test_copies_and_mirrors_keep_their_text(rows):
    story = "The long story that two paths of this host tell in the same words"
    data = [(k, f"http://a.de/p/{k}", bare_page("Logo", f"Own text {k} of this page", "Imprint"))
            for k in range(6)]
    data += [(10, "http://a.de/p/1x", bare_page("Logo", story, "Imprint"))] * 2  # a repeated row
    data += [(11, "http://a.de/p/1y", bare_page("Logo", story, "Imprint"))]  # a mirror
    data += [(12, "http://a.de/p/1z", bare_page("Logo", story, "Read at 12:01", "Imprint"))]
    data += [(13, "http://a.de/p/1za", bare_page("Logo", "Imprint"))]  # nothing but template
    data += [(k, "http://b.de/p", bare_page("Alone", "twice")) for k in (20, 21)]
    data += [(30, None, bare_page("x", "one")), (31, None, bare_page("x", "two"))]
    assert texts_of(rows, data) == {
        **{k: [f"Own text {k} of this page"] for k in range(6)}, 10: [story] * 2, 11: [story],
        12: [story + "\n\nRead at 12:01"], 13: ["Logo\n\nImprint"], 20: ["Alone\n\ntwice"],
        21: ["Alone\n\ntwice"], 30: ["x\n\none"], 31: ["x\n\ntwo"]}


def test_carried_places_cross_ranges_of_one_text():
    edges = [(0, "h", "/a", 1, "A", "s"), (0, "h", "/b", 2, "B", "t"), (1, "h", "/c", 3, "C", "t"),
             (2, "h", "/d", 4, "D", "t"), (2, "h", "/e", 5, "E", "u")]
    got = page_diff._carried(pd.DataFrame(edges, columns=["_range", *page_diff._PLACE, "_sign"]))
    found = {}
    for r in got.to_dict("records"):
        found.setdefault(r["_range"], set()).add(r["_content"])
    assert found == {0: {"C", "E"}, 1: {"A", "B", "D", "E"}, 2: {"A", "C"}}


def test_shared_lines_are_a_longest_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = (["abcd"[k] for k in rng.integers(0, 4, rng.integers(0, 14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        places = sorted(shared_lines(a, b))
        assert len(places) == best[-1][-1]
        rest = iter(b)
        assert all(any(a[k] == y for y in rest) for k in places)


# --- neighbours ----------------------------------------------------------------------------

def brute_nearest(ids, vectors, query, k=10):
    score = np.sqrt(((vectors - vectors[ids == query][0]) ** 2).sum(1))
    return [ids[j] for j in np.lexsort((ids, score)) if ids[j] != query][:k]


def test_recall_on_real_vectors(spark):
    data = table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in data]), np.array([r[1] for r in data], float)
    found = {}
    for r in llm.op10_multiprobe_lsh(spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = [len(set(found[q]) & set(brute_nearest(ids, vectors, q))) for q in ids[ids % 100 == 0]]
    assert np.mean(hits) / 10 >= 0.9


def test_neighbours_on_odd_rows(rows):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0, 1.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0]), (9, [1.0]), (9, []),
            (None, [1.0, 1.0])]
    frame = rows("vec_id long, embedding array<double>", data, "key id vec rank")
    got = nearest_neighbours(frame, F.col("id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 0.0), (2, 7, 1.0), (3, 8, 1.0)]
    assert nearest_neighbours(frame.limit(0), F.col("id") == 0).count() == 0
    assert nearest_neighbours(frame.where("vec_id = 0"), F.col("id") == 0).count() == 0


def article_page(*lines):
    return "<body><nav>menu</nav><article>" + "".join(f"<p>{line}</p>" for line in lines) + "</article><p>beside"


def test_template_lines_within_articles_go(rows):
    """Articles are compared too; copies, quotes of few pages and articles of template lines stay."""
    data = [(k, f"http://a.de/p/{k}", article_page("By the desk", f"Story {k} is told at length", "Share this"))
            for k in range(6)]
    data += [(10, "http://a.de/p/1x", article_page("By the desk", "Share this"))]  # nothing but template
    data += [(11, "http://a.de/p/2", article_page("By the desk", "Story 2 is told at length", "Share this"))]  # a copy
    data += [(12, "http://a.de/p/7", article_page("By the desk", "Quote", "A story of its own and long")),
             (13, "http://a.de/p/8", article_page("By the desk", "Quote", "Another story of its own, as long"))]
    data += [(14, "http://a.de/p/9", bare_page("By the desk", "A page without an article here"))]
    data += [(20, "http://b.de/p/1", article_page("Alone", "Share this"))]
    assert texts_of(rows, data) == {
        **{k: [f"Story {k} is told at length"] for k in range(6)}, 10: ["By the desk\n\nShare this"],
        11: ["Story 2 is told at length"], 12: ["Quote\n\nA story of its own and long"],
        13: ["Quote\n\nAnother story of its own, as long"], 14: ["A page without an article here"],
        20: ["Alone\n\nShare this"]}


def plainly_differenced(pages, least=3):
    """Main texts of ``(page_id, url, html)`` rows by loops over each host."""
    hosts, texts = {}, {}
    for page, url, source in pages:
        lines = page_diff.page_lines(source or "")
        parts = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)", url or "")
        own = [k for k, x in enumerate(lines) if x.main] or list(range(len(lines)))
        texts[page] = lines, own, set()
        if parts and parts[1] and lines:
            hosts.setdefault(parts[1].lower(), []).append((parts[2], page, tuple(x.text for x in lines)))
    for found in hosts.values():
        contents = {lines for _, _, lines in found}
        holders = Counter(line for lines in contents for line in set(lines))
        digest = {line: hashlib.md5(line.encode()).digest() for line in holders}
        sign = {lines: min(set(lines), key=lambda x: (
            holders[x] if holders[x] * 2 >= len(contents) else 0, -len(x), digest[x])) for lines in contents}
        held = Counter(line for line, _ in {(line, sign[lines]) for lines in contents for line in lines})
        template = {line for line, n in held.items() if n >= min(least, len(set(sign.values())))}
        first = {}
        for path, page, lines in found:
            first[path, lines] = min(page, first.get((path, lines), page))
        places = sorted(first, key=lambda x: (
            x[0].encode(), first[x], hashlib.md5("\n".join(x[1]).encode()).hexdigest()))
        other = {}
        for at, (path, lines) in enumerate(places):
            near = [next((p for p in side if sign[p[1]] != sign[lines]), None)
                    for side in (places[:at][::-1], places[at + 1:])]
            near = [p for p in near if p]
            if near:
                other[path, lines] = max(near, key=lambda p: len(os.path.commonprefix([p[0], path])))[1]
        for path, page, lines in found:
            if (path, lines) in other:
                texts[page][2].update(k for k in shared_lines(list(lines), list(other[path, lines]))
                                      if lines[k] in template)
    return {page: "\n\n".join(lines[k].text for k in [k for k in own if k not in gone] or own)
            for page, (lines, own, gone) in texts.items()}


def test_pages_equal_a_plain_version(spark, rows):
    import random
    draw = random.Random(9)
    made = []
    for page in range(1500):  # paths, lines and whole pages repeat
        lines = [f"line {draw.randrange(8)}" for _ in range(draw.randrange(5))]
        lines += [f"story {draw.randrange(900)} at some length"] * (draw.random() < 0.9) + ["foot"] * (draw.random() < 0.7)
        host = draw.choice(["big.de"] * 5 + [f"h{draw.randrange(200)}.de"])
        made.append((page, f"http://{host}/{draw.choice('abc')}/{draw.randrange(400)}",
                     draw.choice([article_page, bare_page])(*lines)))
    given = [tuple(r) for r in table(spark, "/root/testdata/sf0.1", "pages").select("page_id", "url", "html").collect()]
    for data in (made, given):
        wanted = plainly_differenced(data)
        pages = rows("page_id long, url string, html string", data)
        assert {r["page_id"]: r["text"] for r in extract_main_text(pages).collect()} == wanted
        whole = {page: page_diff.page_lines(source) for page, _, source in data}
        changed = [k for k, v in wanted.items() if any(x.main for x in whole[k])
                   and v != "\n\n".join(x.text for x in whole[k] if x.main)]
        assert len(changed) > 50  # articles that lose a line
