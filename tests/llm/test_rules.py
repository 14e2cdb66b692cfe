"""Quality votes, license scans, preference pairs, derived web records and the pipeline."""

import json
import random
import re
import time
import tracemalloc
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin

import corpus_pipeline
import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from depthmill.llm import licenses, preferences, quality_votes, queries, warc_derivatives
from tests.llm import brute
from tests.llm.test_dedup import KIND, odd_rows, texts

SMALL = "/root/testdata/sf0.001"


def base_counts(text):
    words = brute.words(text)
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if brute.words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    n = len(words)
    return n, sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(repeated), n < 20 or 100 * len(repeated) > 30 * n


def test_quality_of_odd_rows(spark):
    rows = odd_rows()
    got = quality_votes.judged(spark.createDataFrame(rows, KIND)).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(rows[r.row][1])
        assert 0 <= r.quality <= 1 and r.kept == (not r.base_failed and r.quality >= 0.5)
    assert len(got) == len(rows) and quality_votes.judged(spark.createDataFrame([], KIND)).count() == 0


def test_counting_takes_little_memory_beside_the_texts():
    many, one = [" ".join(f"w{i * k % 977}" for i in range(400)) for k in range(1, 2_001)], "ab, cd#\n" * 500_000
    for rows, most in ((many, 10), (["", one, None], 40)):
        batch = pa.record_batch({"row": pa.array(range(len(rows))), "text": pa.array(rows)})
        tracemalloc.start()
        found = [r for out in quality_votes._count(iter([batch])) for r in out.select(["row", "n_words", "n_symbols"]).to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert [(r["row"], r["n_words"], r["n_symbols"]) for r in found] == [(i, len((t or "").split()), (t or "").count("#")) for i, t in enumerate(rows)]
        assert peak < most * sum(len(t or "") for t in rows)


def test_registered_quality_keeps_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    plain = {r.doc_id: base_counts(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op7_quality_votes(spark, folder)
    for r in found.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain[r.doc_id]
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    judged = found.where("not base_failed").join(labels, "doc_id").select("kept", "label").collect()
    assert all(r.kept for r in judged if r.label == 1)
    assert sum(not r.kept for r in judged if r.label == 0) >= 0.9 * sum(r.label == 0 for r in judged)


def test_estimate_weighs_rules_by_agreement(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(3000):
        good = rng.random() < 0.8
        rows.append(tuple((1 if (rng.random() < a) == good else -1) if rng.random() < 0.9 else 0 for a in (0.95, 0.9, 0.9, 0.6)))
    opinion = quality_votes.estimate(spark.createDataFrame(rows, "a int, b int, c int, noise int"), ["a", "b", "c", "noise"])
    assert opinion.on_good["a"] > 0.9 > opinion.on_good["noise"] and opinion.on_bad["a"] > 0.85 and opinion.good == pytest.approx(0.8, abs=0.05)
    empty = quality_votes.estimate(spark.createDataFrame([], "a int"), ["a"])
    assert empty.good == 0.8


def plain_patience(text, template):
    """The same alignment, said recursively."""
    if not text or not template:
        return 0
    if text[0] == template[0]:
        return 1 + plain_patience(text[1:], template[1:])
    if text[-1] == template[-1]:
        return 1 + plain_patience(text[:-1], template[:-1])
    unique = [w for w in text if text.count(w) == 1 and template.count(w) == 1]
    if not unique:
        return 0
    return licenses.patience(text, template).__len__() if len(unique) > 12 else max_chain(text, template, unique)


def max_chain(text, template, unique):
    places = [template.index(w) for w in unique]
    best = [1] * len(places)
    for i in range(len(places)):
        best[i] = 1 + max([best[j] for j in range(i) if places[j] < places[i]], default=0)
    return max(best)


def test_patience_alignment():
    rng = random.Random(9)
    for _ in range(300):
        text, template = ([rng.randrange(12) for _ in range(rng.randrange(14))] for _ in range(2))
        found = licenses.patience(text, template)
        assert all(text[i] == template[j] for i, j in found)
        assert all(a < c and b < d for (a, b), (c, d) in zip(found, found[1:], strict=False))
        assert len(found) >= plain_patience(text, template)
        values = rng.sample(range(50), 9)
        chain = [values[i] for i in licenses.increasing(values)]
        assert chain == sorted(chain)
    assert licenses.increasing([]) == []


def test_licenses_of_odd_rows(spark):
    mit, short = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["MIT-short"]
    filler = "the of to and software " * 4000
    rows = [(1, None, "x"), (2, "", "x"), (3, filler, "x"), (4, filler + mit.replace("merge, ", "") + filler, "x"), (5, f"{short}\n{short}", "x"), (5, short, "x"), (6, "license mit the under released", "x"), (7, mit[: len(mit) // 2], "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = licenses.licensed(frame).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(4, "MIT"), (5, "MIT-short"), (5, "MIT-short")]
    whole = next(r for r in got if r.doc_id == 4)
    assert whole.n_matched == whole.n_template - 1 and 20_000 <= whole.first_word < whole.last_word < 20_200
    assert licenses.licensed(frame.limit(0)).count() == 0 and licenses.licensed(frame, {"none": "..."}).count() == 0


def test_registered_licenses(spark):
    got = {(r.doc_id, r.license) for r in queries.op4_licenses(spark, "/root/testdata/sf0.01").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    for name in ("MIT-short", "Apache-2.0-short", "GPL-3.0-short", "CC-BY-NC-4.0"):
        assert {i for i, n in got if n == name} >= {r.doc_id for r in rows if licenses.TEMPLATES[name] in r.text}


def test_registered_preferences_equal_sql(spark):
    con = duckdb.connect()
    for folder in (SMALL, "/root/testdata/sf0.01"):
        con.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
        found = queries.op5_preferences(spark, folder)
        assert sorted(map(tuple, found.collect())) == sorted(con.sql(queries.oracle_sql()["op5_preferences"]).fetchall())
        assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_preferences_of_odd_rows(spark):
    rows = [
        (1, "chosen", 0, "user", "hi"), (1, "chosen", 1, "assistant", "yes"), (1, "rejected", 0, "user", "hi"), (1, "rejected", 1, "assistant", "no"), (1, "rejected", 2, "user", "why"),
        (2, "chosen", 0, "user", "x"), (2, "rejected", 0, "user", "x"),
        (3, "chosen", 5, None, None), (3, "other", 0, "user", "gone"),
        (None, "chosen", 0, "user", "a"), (None, "rejected", None, "user", "b"),
        (4, "chosen", 0, "user", "long " * 50_000), (4, "rejected", 0, "user", "long " * 50_000), (4, "rejected", 0, "user", "tie"),
    ]
    got = {r.pair_id: r for r in preferences.preference_pairs(spark.createDataFrame(rows, "pair_id long, side string, turn int, role string, text string").withColumn("prompt", F.lit(1))).collect()}
    one = got[1]
    assert (one.n_prompt_turns, one.prompt) == (1, "<|user|>\nhi<|end|>\n")
    assert [one.chosen[s.start : s.end] for s in one.chosen_spans] == ["yes<|end|>\n"]
    assert [one.rejected[s.start : s.end] for s in one.rejected_spans] == ["no<|end|>\n"] and one.rejected.endswith("why<|end|>\n")
    assert (got[2].n_prompt_turns, got[2].chosen, got[2].rejected, got[2].chosen_spans) == (1, "", "", [])
    assert (got[3].prompt, got[3].chosen, got[3].rejected) == ("", "<|unknown|>\n<|end|>\n", "")
    assert got[None].n_prompt_turns == 0 and got[4].n_prompt_turns == 1 and got[4].rejected == "<|user|>\ntie<|end|>\n"
    empty = spark.createDataFrame([], "pair_id long, side string, turn int, role string, text string")
    assert preferences.preference_pairs(empty).count() == 0


def test_swapped_replies_keep_every_turn(spark):
    rows = [
        (0, None, "user", "no number"), (0, 0, "user", "hi"), (0, 1, "assistant", "own"), (0, 2, "user", "thanks"), (0, 3, None, "bye"),
        (1, 0, "assistant", "other"), (2, 5, "user", "only"), (3, None, "assistant", "unnumbered"), (3, 1, "user", "u"), (None, 1, "assistant", "x"), (None, 2, "user", "y"),
    ]
    turns = preferences.swapped_replies(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert turns.count() == 2 * len(rows)
    got = {r.pair_id: r for r in preferences.preference_pairs(turns).collect()}
    one = got[0]
    assert one.prompt == "<|user|>\nno number<|end|>\n<|user|>\nhi<|end|>\n" and one.n_prompt_turns == 2
    assert one.chosen == "<|assistant|>\nown<|end|>\n<|user|>\nthanks<|end|>\n<|unknown|>\nbye<|end|>\n" and one.rejected == one.chosen.replace("\nown<", "\nother<")
    assert [one.rejected[s.start : s.end] for s in one.rejected_spans] == ["other<|end|>\n"]  # what follows is masked
    assert (got[1].chosen, got[1].rejected) == ("<|assistant|>\nother<|end|>\n", "<|assistant|>\nown<|end|>\n")
    assert got[2].chosen == "" and got[3].prompt.count("<|end|>") == 2
    assert got[None].prompt.count("<|end|>") == 2 and got[None].rejected == ""


def test_registered_preferences_hold_every_turn(spark):
    folder = "/root/testdata/sf0.01"
    n = spark.read.parquet(f"{folder}/conversations.parquet").count()
    rows = queries.op5_preferences(spark, folder).collect()
    assert sum((r.prompt + r.chosen).count(preferences.CLOSE) for r in rows) == n == sum((r.prompt + r.rejected).count(preferences.CLOSE) for r in rows)


class Reader(HTMLParser):
    """What the derived records hold, read by the standard library's parser."""

    BLOCK = set(
        "address article aside blockquote body br dd div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
    )
    SILENT = {"script", "style", "noscript", "template", "svg"}

    def __init__(self, page, base):
        super().__init__(convert_charrefs=True)
        self.base, self.inside, self.out, self.links, self.metas, self.title, self.lang = base, [], [], [], [], None, None
        self.feed(page)
        self.close()
        lines = (" ".join(re.sub(r"[^\S\n]+", " ", x).split(" ")).strip() for x in "".join(self.out).split("\n"))
        self.text = "\n".join(x for x in lines if x)

    def handle_starttag(self, tag, pairs):
        own = {}
        for k, v in pairs:
            own.setdefault(k, v)
        if tag == "html":
            self.lang = (own.get("lang") or "").lower() or None
        if tag == "meta":
            self.metas.append({k: v for k, v in own.items() if k in ("name", "property", "charset", "content", "http-equiv")})
        kind = {"a": "href", "area": "href", "link": "href", "img": "src", "iframe": "src", "script": "src"}.get(tag)
        if kind and own.get(kind):
            self.links.append({"path": f"{tag}@{kind}", "url": urljoin(self.base, own[kind])})
        if tag in self.SILENT or tag in ("head", "title"):
            self.inside.append(tag)
        if tag in self.BLOCK:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in self.inside:
            self.inside.remove(tag)
        if tag in self.BLOCK:
            self.out.append("\n")

    def handle_data(self, data):
        if self.inside[-1:] == ["title"]:
            self.title = " ".join(((self.title or "") + data).split())
        elif not self.inside:
            self.out.append(data.replace("\n", " "))


def test_blocks_are_what_another_parser_reads(spark):
    folder = "/root/testdata/sf0.01"
    pages = {(r.page_id): r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in queries.op8_warc_derivatives(spark, folder).collect():
        seen = Reader(pages[r.page_id].html, pages[r.page_id].url)
        if r.warc_type == "conversion":
            assert r.block == seen.text
        else:
            assert json.loads(r.block)["html"] == {"title": seen.title, "lang": seen.lang, "metas": seen.metas, "links": seen.links}


@pytest.mark.parametrize("part", ["<a ", "<html ", "<title>", "<title ", "<br ", "<!--", "<script>", "</script ", "<meta x=", "a='<", "lang", "<a x", "&#", "<a " + "b" * 200])
def test_time_follows_the_page(part):
    """Markup that never ends: 3 MB take time in proportion, with and without a tag's end after it."""
    for page in (part * (3_000_000 // len(part)), "<p>x</p><a " + part * (3_000_000 // len(part)) + ">"):
        begun = time.process_time()
        warc_derivatives.page_facts(page, "http://h/")
        warc_derivatives.plain_text(page)
        assert time.process_time() - begun < 20


def test_unclosed_markup_reads_as_before():
    assert warc_derivatives.plain_text("<p>a</p> b < c <d e") == "a\nb < c <d e"
    facts = warc_derivatives.page_facts("<html class=x lang=en><title>never closed<a href=/x>l</a><a href=/y", "http://h/")
    assert facts == {"title": None, "lang": "en", "metas": [], "links": [{"path": "a@href", "url": "http://h/x"}]}


def test_records_without_an_id_differ(spark):
    rows = [(None, "http://a/", "D", None, "<p>x</p>"), (None, "http://b/", "D", None, "<p>x</p>"), (None, "http://b/", "D", None, "<p>y</p>"), (None, "http://b/", "E", None, "<p>y</p>"), (None, None, None, None, None)]
    got = warc_derivatives.derivatives(spark.createDataFrame(rows, "record_id string, target_uri string, warc_date string, http_head string, payload string")).collect()
    assert len({r.record_id for r in got}) == 10
    one = next(r for r in got if r.target_uri == "http://a/")
    assert f"WARC-Refers-To-Target-URI: http://a/\r\nWARC-Refers-To-Date: D\r\n" in one.header and f"WARC-Payload-Digest: {one.source_digest}\r\n" in one.header


def test_registered_derivatives(spark):
    pages = {r.url: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    sources = warc_derivatives.responses_of(spark.read.parquet(f"{SMALL}/pages.parquet"), queries.CAPTURED).collect()
    rows = queries.op8_warc_derivatives(spark, SMALL).collect()
    assert len(rows) == 2 * len(sources) and len({r.record_id for r in rows}) == len(rows)
    own = {s.record_id: s for s in sources}
    for r in rows:
        s, body = own[r.refers_to], r.block.encode()
        assert (r.target_uri, r.content_length, r.block_digest) == (s.target_uri, len(body), warc_derivatives.digest(body))
        assert f"WARC-Refers-To: {s.record_id}\r\n" in r.header and r.source_digest == warc_derivatives.digest(pages[r.target_uri].encode())
        if r.warc_type == "metadata":
            facts = json.loads(r.block)
            assert facts["source"]["WARC-Record-ID"] == s.record_id and ["Content-Type", "text/html; charset=utf-8"] in facts["http"]["headers"]
            assert all("//" in x["url"] for x in facts["html"]["links"])


def test_derivatives_of_odd_rows(spark):
    page = "<!-- <p>no --><HTML lang='DE-at'><head><title> A &amp;\n B </title><script>var t='<p>x</p>'</script></head><body><p>One<br>two &lt;three&gt; <b>bo</b>ld</p><script src=/s.js>no</script><a href='../x?a=1&amp;b=2'>l</a><a href=http://[bad>z</a> 1 < 2<!-- open"
    rows = [("a", "http://h/d/p", "D", "HTTP/1.1 200 OK\r\nX-Y: z:1\r\n\r\n", page, "k"), (None, None, None, None, None, "k"), ("b", "u", "D", "", "", "k"), ("b", "u", "D", "", "", "k"), ("c", "http://h/", "D", None, "<p>w</p>" * 60_000, "k")]
    frame = spark.createDataFrame(rows, "record_id string, target_uri string, warc_date string, http_head string, payload string, block string")
    got = warc_derivatives.derivatives(frame).collect()
    assert len(got) == 10 and len({r.record_id for r in got if r.refers_to == "b"}) == 2
    facts = json.loads(next(r.block for r in got if r.refers_to == "a" and r.warc_type == "metadata"))
    assert (facts["html"]["title"], facts["html"]["lang"], facts["http"]["headers"]) == ("A & B", "de-at", [["X-Y", "z:1"]])
    assert [x["url"] for x in facts["html"]["links"]] == ["http://h/s.js", "http://h/x?a=1&b=2", "http://[bad"]
    text = next(r.block for r in got if r.refers_to == "a" and r.warc_type == "conversion")
    assert text == "One\ntwo <three> bold\nlz 1 < 2"
    assert "WARC-Refers-To" not in next(r.header for r in got if r.refers_to is None)
    assert warc_derivatives.derivatives(frame.limit(0)).count() == 0


def plain_pipeline(spark, folder):
    """Ids and texts after each stage but the last, by plain means where the stage has some."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in quality_votes.judged(docs).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept]
    assert all(not base_counts(t)[5] for _, t in rows)
    rows = [r for r, least in zip(rows, brute.similar_classes(rows), strict=True) if r[0] == least]
    rows = [(i, b" ".join(k).decode()) for i, _, k in brute.repeats(rows)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = {i for i, _, hit, _ in brute.leaks(rows, items) if not hit}
    return {i: t.split() for i, t in rows if i in clean}


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SMALL)
        assert kept.columns == columns
    want = plain_pipeline(spark, SMALL)
    assert {r.doc_id: brute.words(r.text) for r in kept.collect()} == {i: [w.encode() for w in t] for i, t in want.items()}
    assert all(r.n_chars == len(r.text) for r in kept.collect())
    assert {r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()} == set(want)
    assert len(texts(spark)) > len(want)


def test_pipeline_of_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_pipeline_of_odd_rows(spark):
    """Each stage against a plain version of it, with columns named like those that stages add."""
    clash = "quality kept n_words n_hit n_removed row own".split()
    rows = [(i, t, "en", len(t or ""), *[f"{c}{k}" for c in clash]) for k, (i, t, *_) in enumerate(odd_rows())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, " + ", ".join(f"{c} string" for c in clash))
    stages = dict(corpus_pipeline.STAGES)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]

    def collected(frame):
        assert frame.columns == docs.columns
        return sorted(map(tuple, frame.collect()), key=str)

    judged = {r.own: r.kept for r in quality_votes.judged(docs.select("text", "own")).collect()}
    kept = stages["quality_votes"](spark, docs, SMALL)
    assert collected(kept) == sorted((r for r in rows if judged[r[-1]]), key=str) and all(not base_counts(r[1])[5] for r in rows if judged[r[-1]])
    least = brute.similar_classes([r[:2] for r in rows])
    distinct = collected(stages["near_copies"](spark, docs, SMALL))
    nameless = [r for r in rows if r[0] is None]
    assert [r for r in distinct if r[0] is None] == sorted(nameless, key=str)
    assert sorted({r[0] for r in distinct} - {None}) == sorted(r[0] for r in distinct if r[0] is not None) == sorted({x for x in least if x is not None})
    assert all(r in rows for r in distinct)
    cut = brute.repeats([r[:2] for r in rows])
    got = {r[-1]: r for r in collected(stages["substring_dedup"](spark, docs, SMALL))}
    for r, (_, _, left) in zip(rows, cut, strict=True):
        new = got[r[-1]]
        assert brute.words(new[1]) == left and new[3] == (None if new[1] is None else len(new[1])) and new[4:] == r[4:]
    clean = [hit == 0 for _, _, hit, _ in brute.leaks([r[:2] for r in rows], items)]
    assert collected(stages["decontamination"](spark, docs, SMALL)) == sorted((r for r, ok in zip(rows, clean, strict=True) if ok), key=str)
    pieces = stages["curve_packing"](spark, docs, SMALL)
    assert pieces.where("start = 0").count() == len(rows)
    chained = docs
    for _, stage in corpus_pipeline.STAGES:
        chained = stage(spark, chained, SMALL)
    assert chained.select("doc_id").distinct().count() > 0
