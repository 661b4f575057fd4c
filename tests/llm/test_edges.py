"""Clashing columns over all operators, very long texts, and cases that earlier versions got wrong."""

import random
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from shared_tables import SF, odd, table  # noqa: F401

from panelrank.llm import decontaminate, html_text, jaccard, kneser_ney, lexical_search, packing, periodic_runs, quality, secrets, syncmers, toxicity, url_filters
from panelrank.llm.queries import QUERIES

# names that operators give to results or use inside
NAMES = ["hits", "lm", "secrets", "fingerprint", "runs", "collapsed", "_gone", "_digest", "_html", "_host", "_drop", "_h", "_w", "_base", "_scanned", "h", "k", "n", "sig", "component", "id", "key", "void", "Verdict", "_rule"]


@pytest.fixture(scope="module")
def crowded(spark, odd):
    return odd.select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(f"own {n}").alias(n) for n in NAMES])


def _kept(out, results):
    """Every column of the input is there once, with its own values unless it is a result."""
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    row = out.where("doc_id = 3").first().asDict()
    for n in NAMES:
        if n.lower() not in results:
            assert row[n] == f"own {n}", n
    assert out.count() == 9


def test_clashing_columns_of_document_operators(spark, crowded):
    items = spark.createDataFrame([(1, "two three FOUR"), (2, "alpha beta")], "item_id long, text string")
    for size in (1 << 20, 10):
        _kept(decontaminate.decontaminate(crowded, items, block_bytes=size), {"hits"})
    _kept(secrets.find_secrets(crowded), {"secrets"})
    _kept(secrets.redact(crowded), set())
    _kept(syncmers.fingerprint(crowded), {"fingerprint"})
    _kept(periodic_runs.periodic_runs(crowded), {"runs", "collapsed"})
    _kept(kneser_ney.score(crowded, kneser_ney.train(crowded)), {"lm"})
    kept = jaccard.keep_one(crowded)
    assert kept.columns == crowded.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "None", "None"]
    assert lexical_search.search(crowded, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_clashing_columns_of_page_operators(spark):
    html = "<article><h1>Title</h1><p>text</p></article>"
    pages = spark.createDataFrame([(3, "http://a.net/x", html), (4, "http://a.net/y", None)], "page_id long, url string, html string").select("*", *[F.lit(f"own {n}").alias(n) for n in NAMES])
    out = html_text.extract(pages, into="h")
    row = out.where("page_id = 3").first().asDict()
    assert row["h"] == "Title\ntext" and all(row[n] == f"own {n}" for n in NAMES if n != "h") and len(out.columns) == len(pages.columns) - 1
    judged = url_filters.judge(pages, url_filters.RULES).where("page_id = 3").first().asDict()
    assert judged["verdict"] == "allow" and all(judged[n] == f"own {n}" for n in NAMES if n != "Verdict")


def test_op1_reads_a_text_column_of_another_name(spark):
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, t string")
    items = spark.createDataFrame([(1, "two three"), (2, "four")], "item_id long, text string")
    for size in (1 << 20, 1):
        assert decontaminate.decontaminate(docs, items, text_col="t", block_bytes=size).first().hits.n_hit == 3


# 2 ------------------------------------------------------------------------------------------------

def test_op2_no_document_is_cut_while_a_sequence_has_room():
    rng = random.Random(4)
    for trial in range(30):
        sizes = [rng.choice([rng.randrange(1, 300), rng.randrange(1, 4097), rng.randrange(4097, 9000)]) for _ in range(rng.randrange(1, 120))]
        done, left = packing.assign(sizes)
        total = sum(sizes) // 4096
        room, cost = [4096] * total, [0.0] * total
        seen = {}
        for d, s, n, q, at in done:
            first = s % 4096 == 0 and d not in seen
            assert at == 4096 - room[q]
            want = min(4096, sizes[d] - s - next((k for i, b, k in left if i == d), 0))
            if first and n < want:
                assert max(room) < want                                  # cut only if it fits nowhere, and then the cheapest takes a part
                assert cost[q] == min(c for c, r in zip(cost, room, strict=True) if r)
            elif n == want:
                assert cost[q] == min(c for c, r in zip(cost, room, strict=True) if r >= n)
            seen[d] = 1
            room[q] -= n
            cost[q] += packing.piece_cost(n)
        assert not any(room) and sum(n for _, _, n in left) == sum(sizes) % 4096


def test_op2_documents_that_fit_stay_whole(spark, table):
    out = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), str(public_tokenizers.path("word_bpe_49k.json")))
    pieces = out.where("doc_tokens <= 4096").groupBy("doc_id").count()
    assert pieces.where("count > 1").count() <= pieces.count() * 0.2


# 3 ------------------------------------------------------------------------------------------------

def test_op3_titles_anchors_and_sections_stay():
    page = """<html><body><header class="site-header"><h1 id="logo">Site</h1></header><article><header class="entry-header"><h1 class="entry-title">Title</h1></header>
    <h2 id="search-algorithms">Search</h2><section id="related-work"><h3>Related work</h3><p>Prose of a section.</p></section><p>Body</p>
    <div id="comments"><p>reader</p></div><div class="responses"><p>reader says</p></div><section class="related"><p>other posts</p></section></article></body></html>"""
    assert [t for t, k in html_text.lines(page) if k] == ["Title", "Search", "Related work", "Prose of a section.", "Body"]


def test_op3_open_tags_quotes_and_nesting_are_linear():
    start = time.time()
    assert html_text.lines("x <a " * 200_000)[0][0].startswith("x <a x")
    assert html_text.lines("<a " * 300_000 + ">") == [] and html_text.lines('<a ">' * 100_001) == []
    assert [t for t, _ in html_text.lines("<div>" * 50_000 + "deep" + "</div>" * 50_000 + "after")] == ["deep", "after"]
    assert [t for t, _ in html_text.lines("<div>" * 20_000 + "</p>" * 20_000 + "x")] == ["x"]
    assert [t for t, _ in html_text.lines("a<!-- <p>b</p> " * 50_000)] == ["a"]
    assert [t for t, _ in html_text.lines('one <b title="x>two</b> three <i>four</i> <u title=">five')] == ["one five"]      # a quoted attribute
    assert [t for t, _ in html_text.lines('one <b title="x>two</b> three <i>four</i> five')] == ["one two three four five"]  # its quote never closes
    assert time.time() - start < 20


@pytest.mark.parametrize("share, deleted", [(0.79, True), (0.81, False)])
def test_op3_copies_are_told_from_templates_at_the_edge(spark, share, deleted):
    """The shared box of two articles goes where they share 79 of 100 paragraphs; with 81 one is a copy of the other."""
    n = round(share * 100)
    page = lambda x: "<article>" + "".join(f"<p>line {i}</p>" for i in range(n)) + "".join(f"<p>{x} {i}</p>" for i in range(100 - n)) + "<div>Shared box</div></article>"
    got = html_text.extract(spark.createDataFrame([(1, "http://a.net/p/1", page("a")), (2, "http://a.net/p/2", page("b"))], "page_id long, url string, html string")).collect()
    assert all(("Shared box" not in r.text) is deleted and "line 0" in r.text for r in got)


# 4 ------------------------------------------------------------------------------------------------

def test_op4_many_spans_are_placed_exactly(spark):
    n = 5000
    text = "é secret=abcdefghijkl12 " * n
    start = time.time()
    got = secrets.find_secrets(spark.createDataFrame([(text,)], "text string")).first().secrets.base
    assert len(got) == n and all((s.start, s.end) == (24 * i + 2, 24 * i + 23) for i, s in enumerate(got))
    assert time.time() - start < 60


def test_op4_keys_are_found_and_paths_left_alone(spark):
    rng = random.Random(8)
    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    keys = ["".join(rng.choice(alnum) for _ in range(rng.choice([24, 32, 40]))) for _ in range(100)]
    keys += ["".join(rng.choice(alnum[:52]) for _ in range(36)) for _ in range(50)] + ["".join(rng.choice(alnum + "+/") for _ in range(40)) for _ in range(50)]
    plain = ["https://example.com/articles/2024/quarterly-report-v2", "/usr/local/lib/python3.11/site-packages/numpy", "src/main/java/org/project/HttpClientFactory", "getUserNameFromDatabaseConnection",
             "MAX_NUMBER_OF_OPEN_CONNECTIONS", "2024-01-31/2024-02-29/2024-03-31", "how-to-train-a-language-model-in-2024", "-" * 60, "=" * 30, "internationalization", "UPPERCASEWORDSRUNTOGETHER",
             "123e4567-e89b-12d3-a456-426614174000", "window_size_2048/layer_12/head_7/weights", "a/b/c/d/e/f/g/h/i/j/k/l/m/n"]
    df = spark.createDataFrame([(True, f"see {k} there") for k in keys] + [(False, f"see {p} there") for p in plain], "secret boolean, text string")
    got = [(r.secret, len(r.s.spans) > 0) for r in secrets.find_secrets(df, into="s").collect()]
    assert sum(f for s, f in got if s) / len(keys) >= 0.9                # recall
    assert not any(f for s, f in got if not s)                             # precision


# 7 ------------------------------------------------------------------------------------------------

def test_op7_repeats_count():
    sentence = "the quick brown fox jumps over the lazy dog near the old river bank. "
    one, many, more = syncmers.fingerprints([sentence, sentence * 50, sentence * 100])
    assert syncmers.likeness(many, many) == 1 and 0.6 < syncmers.likeness(many, more) < 0.72 and syncmers.likeness(one, more) < 0.05
    assert len(more[0]) > 1.9 * len(many[0])


# 9 ------------------------------------------------------------------------------------------------

def test_op9_examples_carry_their_context(spark, table):
    import collections
    import hashlib
    turns = collections.defaultdict(list)
    for r in table("conversations"):
        turns[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    said = r"\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", said), (1, "assistant", said)]
    codes = [("\\", "\\s"), ("###", "\\h"), ("</turn>", "\\t")]

    def esc(s, more=()):
        for a, b in [*codes, *more]:
            s = s.replace(a, b)
        return s
    for r in QUERIES["op9_chat"](spark, SF).collect():
        at, contexts = "", []
        for _, role, text in sorted(turns[r.conv_id]):
            at += f"### {esc(role, [(':', chr(92) + 'c')])}: "
            if role == "assistant":
                contexts.append(hashlib.sha256(at.encode()).hexdigest())
            at += esc(text) + "</turn>\n"
        assert (r.n_examples, r.contexts_sha256) == (len(contexts), hashlib.sha256("\n".join(contexts).encode()).hexdigest())


# 6, 10 --------------------------------------------------------------------------------------------

def test_op6_op10_beat_chance_on_held_out_labels(spark, table):
    labels = {r["doc_id"]: r for r in table("labels")}
    for query, label in (("op6_quality", "quality"), ("op10_toxicity", "toxic")):
        rows = [(r.score, labels[r.doc_id][label]) for r in QUERIES[query](spark, SF).collect() if r.held_out and r.doc_id in labels and labels[r.doc_id][label] is not None]
        pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
        if pos and neg:
            assert sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)) >= 0.8


# 8 ------------------------------------------------------------------------------------------------

def test_op8_files_are_read_from_a_folder_that_is_not_mounted(tmp_path, monkeypatch):
    """Without a mount the arrays come from the shared file system itself; no local copy is made."""
    import os

    import numpy as np
    import pyarrow.fs as pafs
    keys, counts = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64)), np.arange(1000, dtype=np.uint32)
    kneser_ney.write_arrays(str(tmp_path), "pairs-0", [keys, counts])
    kneser_ney.write_arrays(str(tmp_path), "pairs-1", [keys[:0], counts[:0]])
    mapped = kneser_ney.map_arrays(str(tmp_path), "pairs-0", kneser_ney.PAIRS)
    remote = pafs.SubTreeFileSystem("/", pafs.LocalFileSystem())
    monkeypatch.setattr(kneser_ney, "_fs", lambda uri: (remote, uri))
    before = set(os.listdir("/tmp"))
    for got in (mapped, kneser_ney.map_arrays(str(tmp_path), "pairs-0", kneser_ney.PAIRS)):
        assert (got[0] == keys).all() and (got[1] == counts).all() and got[1].dtype == np.uint32
    assert [len(a) for a in kneser_ney.map_arrays(str(tmp_path), "pairs-1", kneser_ney.PAIRS)] == [0, 0] == [len(a) for a in kneser_ney.map_arrays(str(tmp_path), "none", kneser_ney.PAIRS)]
    assert not kneser_ney.is_mounted(str(tmp_path)) and not [f for f in set(os.listdir("/tmp")) - before if len(f) == 32]
