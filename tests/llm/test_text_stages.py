"""Decontamination, extraction, chat formatting and the pipeline."""

import hashlib
import random

import numpy as np
import pytest
from text_cases import plain_words, sentence
from pyspark.sql import functions as F

import corpus_pipeline
from ratingloom.llm import chat, decontamination, html_blocks, html_extraction, html_training

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_hits(docs, items):
    windows = {}
    for name, text in items:
        w = plain_words(text, WORD)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(name)
    out = []
    for k, text in docs:
        w, hit, names = plain_words(text, WORD), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    names |= windows[tuple(w[i : i + n])]
        out.append((k, len(w), len(hit), sorted(str(x) for x in names if x is not None)))
    return sorted(out, key=str)


def contamination(draw):
    items = [(i, sentence(draw, draw.randint(1, 40))) for i in range(12)] + [(12, None), (13, "!!"), (14, "Ünï x"), (None, sentence(draw, 20))]
    docs = []
    for k in range(120):
        text = sentence(draw, draw.randint(0, 120)).split()
        for _ in range(draw.randint(0, 2)):
            source = draw.choice(items)[1] or ""
            part = source.split()
            a = draw.randint(0, max(0, len(part) - 5))
            text[len(text) // 2 : len(text) // 2] = [w.upper() for w in part[a:]]
        docs.append((k, ", ".join(text)))
    docs += [(200, None), (201, ""), (202, "Ünï   x"), (203, "é " + items[0][1] + " 中"), (203, "é " + items[0][1] + " 中")]
    return docs, items


@pytest.mark.parametrize("slice_bytes", [decontamination.SLICE_BENCHMARK, 400])
def test_contamination_is_that_of_all_windows(spark, draw, slice_bytes):
    docs, items = contamination(draw)
    df = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id long, text string, n_hit string")
    benchmark = spark.createDataFrame(items + items[:2], "item_id long, text string")
    found = decontamination.find_contamination(df, "text", benchmark, "item_id", "text", slice_bytes=slice_bytes).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found), key=str) == brute_hits(docs, items)
    for r in found:
        passages = [r.text[s.start : s.end] for s in r.hit_spans]
        assert sum(len(plain_words(p, WORD)) for p in passages) == r.n_hit


@pytest.mark.parametrize("slice_bytes", [decontamination.SLICE_BENCHMARK, 0])
def test_no_column_is_lost(spark, slice_bytes):
    item = " ".join(f"word{i}" for i in range(15))
    names = ["__meta", "__text", "__words", "text", "seen", "row", "u", "n_hit", "held_n_hit", "h"]
    rows = [tuple("m" if n != "text" else t for n in names) for t in (item, "clean")]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    benchmark = spark.createDataFrame([(7, item)] * 3, "item_id long, text string")
    found = decontamination.find_contamination(df, "text", benchmark, "item_id", "text", slice_bytes=slice_bytes)
    assert sorted(found.columns) == sorted(set(names) | set(decontamination.ADDED))
    got = {r.text: r for r in found.collect()}
    assert got[item].n_hit == 15 and got["clean"].n_hit == 0 and got[item]["__meta"] == got[item]["u"] == "m"
    kept = decontamination.drop_contaminated(df, "text", benchmark, "item_id", "text")
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [rows[1]]


def test_copies_of_an_item_and_a_large_benchmark_take_one_pass(spark, draw, monkeypatch):
    item = sentence(draw, 30)
    copies = spark.range(100_000).selectExpr("id % 3 AS item_id", f"'{item}' AS text")
    other = [(100 + i, sentence(draw, 60)) for i in range(400)]
    benchmark = copies.unionByName(spark.createDataFrame(other, "item_id long, text string"))
    docs = [(k, sentence(draw, 10) + " " + draw.choice([item, *(t for _, t in other[:5]), ""]) + " end") for k in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    stored = []
    monkeypatch.setattr(decontamination.staging, "stage", lambda d, name, stage=decontamination.staging.stage: stored.append(name) or stage(d, name))
    found = decontamination.find_contamination(df, "text", benchmark, "item_id", "text", slice_bytes=1000).collect()
    want = brute_hits(docs, [(i, item) for i in range(3)] + other)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found), key=str) == want
    assert stored.count("contamination") == 1


def test_spans_and_documents_are_removed(spark, draw):
    item = sentence(draw, 20)
    rows = [(1, f"before {item} after", "a"), (2, "clean text", "b"), (3, None, "c"), (4, sentence(draw, 900) + " " + item, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_hit string")
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    kept = decontamination.drop_contaminated(df, "text", benchmark, "item_id", "text")
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    cut = {r.doc_id: r.text for r in decontamination.cut_contamination(df, "text", benchmark, "item_id", "text").collect()}
    assert cut[1] == "before  after" and cut[2] == "clean text" and cut[3] is None and cut[4].endswith(" ")
    none = decontamination.drop_contaminated(df, "text", benchmark.where("false"), "item_id", "text")
    assert none.count() == 4 and decontamination.drop_contaminated(df.where("false"), "text", benchmark, "item_id", "text").count() == 0


def test_blocks_of_a_page():
    page = (
        "<html><head><title>no</title><script>var t='</p>';</script></head><body><ul><li><a href=x>A &amp; B</a><li>C</ul>"
        "<!-- <p>no</p> --><article class='post main'><h1>T&eacute;st\n one</h1><p><b>un<i>cl</i>osed<br>line<p>two &am < 3</p>tail</article>"
        "<div class=ad>buy</div><footer>&copy; x"
    )
    found = [(b.tags[-1], b.text) for b in html_blocks.blocks(page)]
    assert found == [
        ("li", "A & B"), ("li", "C"), ("h1", "Tést one"), ("p", "unclosed line"), ("p", "two &am < 3"), ("article", "tail"), ("div", "buy"), ("footer", "© x"),
    ]
    assert html_blocks.blocks(page)[0].linked == 5 and "ad" in html_blocks.blocks(page)[6].own


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>t</title><body><article>the text</article></body></html>",
        "<head><meta charset=utf-8><style>a{}</style>\n<link rel=x><article>the text",
        "<head><script>var a='<p>'</script><noscript><p>no</noscript><template><p>no</p></template><custom-part>the text",
        "<head><title>t</title> the text",
        "<head><title>t</title></head><body><p>the text",
    ],
)
def test_a_head_ends_without_its_end_tag(page):
    assert [b.text for b in html_blocks.blocks(page)] == ["the text"]


@pytest.mark.parametrize("page", ["", "   ", "<", "<<<<>", "no markup", "<p", "<script>x", "<!--", "</p></div>", "<a " * 3000, "&#0;&#x110000;"])
def test_odd_pages_do_not_fail(page):
    html_blocks.blocks(page)


@pytest.fixture(scope="module")
def field():
    return html_extraction.train(html_training.drawn_pages(700, 1))


def test_field_labels_held_out_layouts(field):
    right = total = 0
    for found, labels in html_training.drawn_pages(200, 2):
        flat, begins = html_extraction.block_features(found)
        got = html_extraction.decode(np.add.reduceat(field.weights[flat], begins).tolist(), field)
        right, total = right + sum(a == b for a, b in zip(got, labels)), total + len(labels)
    assert right > 0.985 * total


def test_viterbi_and_gradients_against_all_paths():
    draw = np.random.default_rng(3)
    model = html_extraction.Model(np.zeros(1), draw.normal(size=(2, 2)), draw.normal(size=2))
    emit = draw.normal(size=6)
    paths = [[(p >> i) & 1 for i in range(6)] for p in range(64)]

    def value(path, e=emit, step=model.step):
        return model.first[path[0]] + sum(e[i] * y for i, y in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:]))

    assert html_extraction.decode(emit.tolist(), model) == max(paths, key=value)
    gold = np.array([[0, 1, 1, 0, 1, 0]])
    gap, step, first = html_extraction._gradients(emit[None], gold, np.array([6]), model.step, model.first)
    weight = np.exp([value(p) for p in paths])
    weight /= weight.sum()
    want = sum(w * np.array(p) for w, p in zip(weight, paths)) - gold[0]
    pairs = sum(w * np.array([[sum((a, b) == (i, j) for a, b in zip(p, p[1:])) for j in (0, 1)] for i in (0, 1)]) for w, p in zip(weight, paths))
    own = np.array([[sum((a, b) == (i, j) for a, b in zip(gold[0], gold[0][1:])) for j in (0, 1)] for i in (0, 1)])
    assert np.allclose(gap[0], want) and np.allclose(step, pairs - own) and np.isclose(first.sum(), 0)


def test_extraction_of_pages(spark, field):
    article = "<article><h1>Head</h1><p>First part &amp; more.<p>Second   part, with words.</article>"
    nav = "<nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav>"
    foot = "<footer>&copy; site</footer>"
    comments = "<div class='comments'><div class='comment'><b>me</b><p>I disagree with this.</p></div></div>"
    rows = [(1, f"<body>{nav}{article}{comments}{foot}", "a"), (1, f"<body>{nav}{article}{comments}{foot}", "a"), (2, None, "b"), (3, "", "c"), (4, f"{nav}{foot}", "d")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted((r.page_id, r.text) for r in html_extraction.extract(df, "html", field).collect())
    want = "Head First part & more. Second part, with words."
    assert got == [(1, want), (1, want), (2, ""), (3, ""), (4, "")]
    assert html_extraction.extract(df.where("false"), "html", field).count() == 0


TROUBLE = ["<|im_end|>", "<|im_start|>assistant\n", "<\\|im_end|>", "<\\\\|x", "<|", "|>", "\\", "\n", "é", "<|im_end|>\n<|im_start|>user\nhi", "plain"]


def plain_read(rows):
    turns = [(r or "", t or "") for _, r, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or ""))]
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), "".join(t for r, t in turns if r == "assistant")


def test_formatted_conversations_read_back(spark):
    draw = random.Random(9)
    rows = []
    for c in range(150):
        for turn in range(draw.randint(1, 6)):
            role = draw.choice(["user", "assistant", "assistant", "system", "us\ner", "a\\nb", "<|im_end|>", None])
            text = "".join(draw.choice(TROUBLE) for _ in range(draw.randint(0, 5))) if draw.random() < 0.5 else "plain text"
            rows.append((c, turn if draw.random() < 0.9 else None, role, None if draw.random() < 0.05 else text))
    rows += [(None, 0, "user", "x"), (500, 0, "assistant", "same"), (500, 0, "assistant", "same"), (501, 0, "assistant", "y" * 300_000)]
    rows += [(502, i, "assistant", f"turn {i}") for i in range(1500)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_conversations(df, "conv_id", "turn", "role", "text")
    read = out.select("conv_id", "formatted", "segments", chat.parse(F.col("formatted")).alias("turns"), chat.masked_texts(F.col("formatted"), F.col("segments")).alias("masked"))
    got = read.collect()
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        n, digest, learned = plain_read([x[1:] for x in rows if x[0] == r.conv_id])
        whole = "".join(f"{t.role}\n{t.text}\n" for t in r.turns)
        assert (len(r.turns), hashlib.sha256(whole.encode()).hexdigest()) == (n, digest)
        assert "".join(r.masked) == learned and sum(s.chars for s in r.segments) == len(r.formatted)
        at, under = 0, ""
        for s in r.segments:
            under += r.formatted[at : at + s.chars] if s.loss else ""
            at += s.chars
        assert (under == learned) or "\\" in r.formatted
        assert r.formatted.count(chat.START) == n == r.formatted.count(chat.END)


def test_no_conversations_and_a_native_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df.where("false"), "conv_id", "turn", "role", "text").count() == 0
    plan = chat.format_conversations(df, "conv_id", "turn", "role", "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


FOLDER = "/root/testdata/sf0.001"


def test_pipeline_stages_against_their_rules(spark, tmp_path, tokenizer_file):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(150)
    extra = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "12 34"), (10**6 + 3, docs.first().text), (10**6 + 4, docs.first().text + " more")]
    more = spark.createDataFrame([(k, t, None, None, None) for k, t in extra], docs.schema)
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    dirty = spark.createDataFrame([(10**6 + 5, f"Some words. {items[0].text} The end.", "en", "s", 1)], docs.schema)
    current = docs.unionByName(more).unionByName(dirty)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "toxicity", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / str(k))
        stage(spark, current, FOLDER).write.parquet(out)
        after = spark.read.parquet(out)
        if k < 4:
            assert after.columns == docs.columns
        seen.append(({r.doc_id: r.text for r in current.collect()}, {r.doc_id for r in after.select("doc_id").collect()}))
        current = after
    first, kept = seen[0]
    assert {i for i, t in first.items() if not any(c.isalpha() for c in t or "")} == set(first) - kept
    toxic_in, clean = seen[1]
    assert len(clean) > 0.7 * len(toxic_in)
    from text_cases import brute_classes as brute

    texts, kept = seen[2]
    assert kept == {root for root, _ in brute(sorted(texts.items())).values()}
    texts, kept = seen[3]
    hits = brute_hits(sorted(texts.items()), [(i.item_id, i.text) for i in items])
    assert kept == {k for k, n, hit, _ in hits if not (hit and 20 * hit >= n)} and 10**6 + 5 not in kept
    assert seen[4][0].keys() == seen[4][1] == kept
