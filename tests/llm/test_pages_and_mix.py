"""Main text, the mix and the pipeline."""

import html as entities
import random
import re
import time
from collections import Counter
from fractions import Fraction

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from logquarry.llm import mixing, queries
from logquarry.llm.common import stored
from logquarry.llm.html_text import PLACES, PRIOR, blocks, cut, extract, features, main_text, maximum_flow, trained_weights
from logquarry.llm.mixing import mix, mixed_rows, schedule, shares
from logquarry.llm.quality_rules import quality
from logquarry.llm.token_counts import count_tokens

from .conftest import SF


def article(page):
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    texts = (" ".join(entities.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inner))
    return "\n".join(filter(None, texts))


def test_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.QUERIES["op7_html_text"](spark, SF).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert row.text == article(pages[row.page_id].html) and row.n_chars == len(row.text)
        assert row.url == pages[row.page_id].url


PAGE = """<body><header><h2>Site</h2></header><div class="cookie-notice"><p>We use cookies. Please accept.</p></div>
<main><h1>T &amp; U</h1><p>One  two.<br>Three</p><aside>Rel</aside><div class='comments'><p>Nice post! I agree with
this very much.</p></div><p title="a>b">End of it all, with <a href=x>link</a> in text.</p><form><label>Mail</label>
</form><script>var x = "<p>no</p>"</script></main><footer>(c)</footer>"""


def test_boilerplate():
    assert main_text(PAGE) == "T & U\nOne two. Three\nEnd of it all, with link in text."
    assert main_text(None) == main_text("") == main_text("<") == main_text("<script>x") == main_text("<!-- x") == ""
    assert main_text("<p>a b c d. <p>More text here. <script>x") == "a b c d.\nMore text here."
    assert main_text("<p>x</b></p></p><article><p>It is one. It is two.</article>") == "It is one. It is two."
    assert len(blocks("<div>" * 20_000 + "x")) == 1


def test_text_after_scripts_of_turkish_pages():
    page = f"<article><p>{'İ' * 300} one. Two.</p><SCRIPT>x</Script><p>After it. All of it.</p><button>b</button><p>Last. One.</p></article>"
    assert main_text(page) == f"{'İ' * 300} one. Two.\nAfter it. All of it.\nLast. One."


def test_names_around_the_article():
    inner = "<p>It is one. It is two.</p><figure><figcaption>What it shows.</figcaption></figure><p>Sum <math><mi>x</mi></math> it. End.</p>"
    text = "It is one. It is two.\nWhat it shows.\nSum x it. End."
    boiler = '<div class="right-sidebar-box sidebar"><p>Rel.</p></div>'
    for around in ('<body class="home no-sidebar">', '<body class="right-sidebar">', '<div class="has-header">', '<div id="sidebar">'):
        assert main_text(f"{around}<article class='post comments-open'>{inner}<div class='comments'><p>Nice. Yes.</p></div></article>{boiler}") == text
    assert main_text(f"<body class=sidebar><div class='with-nav'><article>{inner}</article><nav><p>No. No.</p></nav></div>") == text
    cards = "<main><p>It is one. It is two.</p><div class='related'><article><p>Other.</p></article></div></main>"
    assert main_text(cards) == "It is one. It is two."


def test_names_inside_the_article():
    """Whole names count, and those of a text element little."""
    rest = "<p>And more of it. So it is.</p>"
    for named in ("<div class='side-effects'>{}</div>", "<div class='social-studies'>{}</div>", "<p class=social>{}", "<section id=footnotes>{}</section>"):
        text = "It is one. It is two, which is long enough for a text."
        assert main_text(f"<article>{named.format(f'<p>{text}</p>' if '<p' not in named else text)}{rest}</article>") == f"{text}\nAnd more of it. So it is."
    for named in ("post-comments", "comment-list", "cookie-notice", "related-posts", "ad-slot", "Share-Buttons", "comments"):
        assert main_text(f"<article>{rest}<div class='x {named}'><p>Nice one. I like it. Very much. Indeed so.</p></div></article>") == "And more of it. So it is."


ARTICLE_TEXT = "<article><p>It is one. It is two.</p></article>"


def test_tags_that_are_left_open_or_broken():
    assert main_text("<nav>" + "<b>" * 70 + "</nav>" + ARTICLE_TEXT) == "It is one. It is two."
    assert main_text("<aside>" + "<span>" * 65 + "x</aside>" + ARTICLE_TEXT) == "It is one. It is two."
    assert main_text("<article><p>" + "<i>" * 20 + "It is one. It is two.<p>And three. Four.</article>") == "It is one. It is two.\nAnd three. Four."
    assert main_text("<article><p title=it's>It is one. It is two.</p><p>That's all of it. Yes.</p></article>") == "It is one. It is two.\nThat's all of it. Yes."
    assert main_text('<article><p title="x>It is one. It is two.</p></article>') == "It is one. It is two."
    assert main_text('<article><p class="a"b">It is one. It is two.</p></article>') == "It is one. It is two."
    assert main_text("<article><p title='a>b' id=x data-y = \"c>d\">It is one. It is two.</p></article>") == "It is one. It is two."
    assert main_text("<!-->" + ARTICLE_TEXT + "<!--->" + "<!-- > x -->") == "It is one. It is two."
    assert main_text(ARTICLE_TEXT + "<p class=") == main_text(ARTICLE_TEXT + "<!-- x") == "It is one. It is two."


@pytest.mark.parametrize(
    "part", ['<a "b"', "<a ", "<button>", '<a q="', "<a q='>\" ", "<li><b><i>", "<!--", "<", "<a =", "&", "<select>", "</b><i>", "<b><div></i>", "<p class=ad>"]
)
def test_malformed_pages_take_time_by_their_length(part):
    """A megabyte of it: a second or so, where a pattern that looks twice would take half an hour."""
    started = time.process_time()
    main_text(part * (1_000_000 // len(part)))
    assert time.process_time() - started < 20


def test_weights_are_fitted_to_the_texts_alone(spark):
    """Where a block stands makes its label, so those weights stay what they were."""
    weights = trained_weights(spark.read.parquet(f"{SF}/pages.parquet"))
    assert weights[-PLACES:].tolist() == PRIOR[-PLACES:].tolist() and weights[:-PLACES].tolist() != PRIOR[:-PLACES].tolist()


def test_extract_odd_pages(spark):
    named = spark.createDataFrame([(1, PAGE, "a", "b", "c")], "page_id long, html string, html_ string, __html string, HTML__ string")
    (row,) = extract(named).collect()
    assert (row.html_, row["__html"], row["HTML__"], row.n_chars) == ("a", "b", "c", len(main_text(PAGE)))
    odd = spark.createDataFrame([(1, None, 5, 6), (1, "", 5, 6), (2, PAGE, 5, 6)], "page_id long, html string, text int, n_chars int")
    assert sorted(r.n_chars for r in extract(odd).collect()) == [0, 0, len(main_text(PAGE))]
    assert extract(odd.limit(0)).count() == 0


def test_minimum_cut():
    draw = random.Random(3)
    for _ in range(300):
        n = draw.randint(1, 6)
        edges = [e for i in range(n) for e in ((n, i, draw.random() * 3, 0), (i, n + 1, draw.random() * 3, 0))]
        edges += [(i, j, c, c) for i in range(n) for j in range(i) if (c := draw.random() * 2) < 1.2]

        def cost(side):
            return sum(f for a, b, f, k in edges if a in side and b not in side) + sum(k for a, b, f, k in edges if b in side and a not in side)

        best = min(cost({n, *(i for i in range(n) if bits >> i & 1)}) for bits in range(1 << n))
        assert cost(maximum_flow(n + 2, edges, n, n + 1)) == pytest.approx(best)


def test_cut_is_the_best_labelling():
    draw = random.Random(5)
    for _ in range(150):
        n = draw.randint(1, 8)
        page = "".join(f"<div>{'<p>' if draw.random() < 0.7 else ''}{'word ' * draw.randint(1, 9)}{'.' * draw.randint(0, 1)}</div>" for _ in range(n))
        weights = PRIOR * 0 + [draw.uniform(-0.6, 0.6) for _ in PRIOR]
        page = blocks(page)
        score = features(page) @ weights
        near = Counter()
        last = {}
        for i, block in enumerate(page):
            if i:
                near[i - 1, i] += 0.3
            if block.parent in last:
                near[last[block.parent], i] += 0.6
            last[block.parent] = i

        def cost(labels):
            return sum(-s if x else s for s, x in zip(score, labels)) / 2 + sum(c for (a, b), c in near.items() if labels[a] != labels[b])

        best = min(cost([bits >> i & 1 for i in range(len(page))]) for bits in range(1 << len(page)))
        assert cost(cut(page, weights)) == pytest.approx(best)


def test_schedule_stays_within_a_block():
    draw = random.Random(1)
    for _ in range(40):
        parts = shares({f"s{i}": draw.random() * 5 + 0.01 for i in range(draw.randint(1, 12))}, 120)
        assert sum(parts.values()) == 120 and min(parts.values()) >= 1
        ran = Counter()
        for source, block, release, deadline, slot in schedule(parts):
            assert block == ran[source] and release <= slot < deadline
            ran[source] += 1
            assert all(abs(ran[s] - Fraction(parts[s] * (slot + 1), 120)) < 1 for s in parts)


def test_mix(spark, documents, frame):
    rows = queries.QUERIES["op2_source_mix"](spark, SF).collect()
    source = {r.doc_id: r.source for r in documents.collect()}
    assert {r.doc_id: r.source for r in rows} == source and len({(r.slot, r.place) for r in rows}) == len(rows)
    assert all(r.release <= r.slot < r.deadline and 0 <= r.place < 32 for r in rows)
    assert len({(r.slot, r.source, r.block) for r in rows}) == len({r.slot for r in rows})

    # One source holds most rows, one weighs most: while no source ends, slots follow the weights.
    skewed = spark.range(4000).selectExpr("id doc_id", "if(id % 10 < 8, 'hot', if(id % 10 = 8, 'a', 'b')) source", "1 slot")
    got = mix(skewed, {"hot": 1, "a": 2, "b": 1}, order=["doc_id"], block_documents=4, cycle=40).collect()
    slots = {r.slot: r.source for r in got}
    assert len(got) == 4000 and len({(r.slot, r.place) for r in got}) == 4000
    ends = min(max(s for s, x in slots.items() if x == name) for name in ("a", "b", "hot"))
    ran = Counter()
    for slot in range(ends + 1):
        ran[slots[slot]] += 1
        assert all(abs(ran[x] - w * (slot + 1)) < 1 for x, w in (("hot", 0.25), ("a", 0.5), ("b", 0.25)))
    odd = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, None, None), (2, "", "x")], "doc_id long, source string, text string")
    assert mix(odd).count() == 4 and mix(odd.limit(0)).count() == 0
    assert mixed_rows(odd).columns == odd.columns and mixed_rows(odd).count() == 4


def test_both_schedules_are_one(spark):
    """Where the exact cycle is short, it is repeated; written slot by slot, the mix is the same."""
    rows = spark.range(700).selectExpr("id doc_id", "case when id % 9 < 5 then 'a' when id % 9 < 7 then 'b' else 'c' end source")
    got = [sorted(mix(rows, {"a": 1, "b": 2, "c": 0.5}, "source", ["doc_id"], 3, cycle).collect()) for cycle in (2520, 3)]
    assert got[0] == got[1]
    slots = {r.slot for r in got[0]}
    assert slots == set(range(len(slots)))  # no slot is empty


def test_columns_of_any_name_stay(spark):
    names = "slot place block release n row source_ bucket buckets before inside k r d t phase parts cycle first_slot size __n __t __text __w kept given n_words".split()
    schema = "doc_id long, source string, text string, " + ", ".join(f"{n} string" for n in names)
    rows = spark.createDataFrame([(i, "ab"[i % 2], f"t{i} " * 60, *[f"{n}{i}" for n in names]) for i in range(5)], schema)
    want = sorted(tuple(r) for r in rows.collect())
    assert sorted(tuple(r) for r in mixed_rows(rows).collect()) == want
    mixed = mix(rows)
    assert set(mixed.columns) == set(rows.columns) | {"deadline"} and {r.slot for r in mixed.collect()} == {0, 1}
    assert sorted(r.bucket for r in mixed.collect()) == [f"bucket{i}" for i in range(5)]
    counted = count_tokens(rows.withColumn("text_", F.lit("x"))).collect()
    assert sorted(r["__text"] for r in counted) == [f"__text{i}" for i in range(5)] and {r.text_ for r in counted} == {"x"}
    judged = quality(rows, spark.createDataFrame([], "doc_id long, quality int"))
    assert sorted(r["__w"] for r in judged.collect()) == [f"__w{i}" for i in range(5)] and {r.n_words for r in judged.collect()} == {60}
    kept = corpus_pipeline.quality_rules(spark, rows, SF)
    assert kept.columns == rows.columns
    assert {tuple(r) for r in kept.collect()} <= set(want)


def test_slots_follow_the_unrounded_weights(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SEGMENT", 700)  # several rows of the plan
    uneven = {"a": 0.1234567, "b": 1.7071068, "c": 3.1415926, "d": 0.9}
    for weights, sizes in ((queries.WEIGHTS, dict.fromkeys(queries.WEIGHTS, 600)), (uneven, {"a": 300, "b": 2900, "c": 5400, "d": 1700})):
        numbers = spark.createDataFrame([*sizes.items()], "source string, n int")
        rows = numbers.selectExpr("source", "explode(sequence(1, n)) doc_id")
        got = mix(rows, weights, order=["doc_id"], block_documents=1).collect()
        assert len(got) == sum(sizes.values()) == len({r.slot for r in got})
        assert all(r.release <= r.slot < r.deadline for r in got)
        slots = {r.slot: r.source for r in got}
        total = sum(Fraction(str(w)) for w in weights.values())
        share = {x: Fraction(str(w)) / total for x, w in weights.items()}
        ends = min(max(s for s, x in slots.items() if x == name) for name in sizes)
        assert ends > 5_000
        ran = Counter()
        for slot in range(ends + 1):
            ran[slots[slot]] += 1
            assert all(abs(ran[x] - w * (slot + 1)) < 1 for x, w in share.items())
        for x, n in sizes.items():
            assert sorted(r.block for r in got if r.source == x) == list(range(n))


def test_pipeline(spark, texts):
    stages, given = {}, spark.read.parquet(f"{SF}/documents.parquet")
    docs = given
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name.replace(" ", "-"))
        stages[name] = docs
        if name != "token output":
            assert docs.columns == given.columns
    left = {name: [r.doc_id for r in frame.collect()] for name, frame in stages.items()}
    quality = queries.QUERIES["op1_quality_rules"](spark, SF).where("kept").collect()
    assert sorted(left["quality rules"]) == sorted(r.doc_id for r in quality)
    assert set(left["near-dedup"]) <= set(left["quality rules"])
    assert set(left["benchmark decontamination"]) <= set(left["near-dedup"])
    assert sorted(left["source mix"]) == sorted(left["benchmark decontamination"]) == sorted(left["token output"])
    # The token files hold the documents in the order of the mix.
    placed = mix(stages["benchmark decontamination"], queries.WEIGHTS).orderBy("slot", "place").collect()
    assert [r.doc_id for r in stages["token output"].orderBy("start").collect()] == [r.doc_id for r in placed]


def test_run_passes_each_result_on(spark, monkeypatch):
    stages = [x for x in corpus_pipeline.STAGES if x[0] in ("quality rules", "token output")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    kept = queries.QUERIES["op1_quality_rules"](spark, SF).where("kept").collect()
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(r.doc_id for r in kept)


def test_stages_on_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
