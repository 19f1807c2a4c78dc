"""Language, decontamination, main text and the pipeline."""

import math
import os
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import decontaminate, language_id, tag_paths
from starmart.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD, CLASHES

SF_DIR = "/root/testdata/sf0.01"


# --- language ------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    total, right = out.agg(F.count("*"), F.count(F.when(F.col("lang") == F.col("lang_pred"), 1))).first()
    assert total > 100 and right / total > 0.98
    assert out.where("score < 0 OR score > 1").count() == 0


def test_held_out_labels_are_not_used(docs_of):
    rows = [(i, f"the words of {i}", "en") for i in range(40)] + [(i, f"die worte von {i}", "de") for i in range(40, 80)]
    docs = docs_of(rows)
    other = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    first, second = (sorted(map(tuple, language_id.identify(d).collect())) for d in (docs, other))
    assert first == second


def test_language_of_awkward_rows(docs_of):
    labelled = [(i + 100, t, lang) for i, (t, lang) in enumerate([("good day to you", "en"), ("guten tag an dich", "de"), ("bonjour", "fr")] * 9)]
    docs = docs_of(AWKWARD + labelled, CLASHES)
    out = {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect() if r.doc_id is not None}
    assert {out[i] for i in (1, 2, 3, 9)} == {"und"} and out[100] == "en" and out[101] == "de" and out[102] == "fr"
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and {1, 2, 3, 9}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert {r.lang_pred for r in language_id.identify(docs_of(AWKWARD)).collect()} == {"und"}
    assert {r.lang_pred for r in language_id.identify(docs_of([(1, "a", "en"), (2, "b", None)])).collect()} == {"en"}
    assert language_id.identify(docs.where("false")).count() == 0


def test_only_letters_make_a_language(docs_of):
    """Letters are Unicode category L: numbers of other forms and marks are none."""
    labelled = [(k + 100, t, lang) for k, (t, lang) in enumerate([("good day to you", "en"), ("guten tag", "de")] * 9)]
    docs = docs_of([(1, "² ½ ① _ 12"), (2, "½ a"), (3, "日"), (4, "Ⅷ ٣"), (5, "ªº")] + labelled)
    found = {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect()}
    assert [found[k] == "und" for k in (1, 2, 3, 4, 5)] == [True, False, False, True, False]


def test_stage_names_missing_languages_and_needs_no_labels(docs_of):
    labelled = [(k + 100, t, lang) for k, (t, lang) in enumerate([("good day to you", "en"), ("guten tag an dich", "de")] * 9)]
    docs = docs_of([(1, "good day my friend"), (2, "12"), (3, "guten tag mein freund", "xx")] + labelled)
    kept = {r.doc_id: r.lang for r in language_id.keep_identified(docs).collect()}
    assert (kept[1], kept[3]) == ("en", "xx") and 2 not in kept and len(kept) == 20
    without = language_id.keep_identified(docs_of([(1, "some words"), (2, "12"), (3, None), (4, "é")]))
    assert sorted((r.doc_id, r.lang) for r in without.collect()) == [(1, None), (4, None)]


def test_two_steps_equal_a_plain_duel(docs_of):
    """Family first, then its languages, each by counting duels won; margins one by one in plain Python."""
    stems = {"en": "the of and", "de": "der und die", "nl": "het een van", "fr": "le et des", "es": "el los una"}
    rows = [(k, " ".join(stems[lang].split()[(k + j) % 3] + str(k % 7) for j in range(9)), lang)
            for k, lang in enumerate(list(stems) * 12)]
    model = language_id.fit(docs_of(rows).select("doc_id", "text", "lang"))
    weight = {key: model.machines[at] for key, at in model.at.items()}

    def duel(kind, members, x):
        wins = {m: [0, 0.0] for m in members}
        for a in members:
            for b in members:
                if a < b:
                    w = weight[(kind, a, b)]
                    margin = sum(float(p) * float(q) for p, q in zip(w[:-1], x)) + float(w[-1])
                    winner = b if margin > 0 else a
                    wins[winner][0] += 1
                    wins[a][1] -= margin
                    wins[b][1] += margin
        return max(members, key=lambda m: wins[m])

    for _, text, _ in rows[:25]:
        x = language_id.features(text).tolist()
        heads = {name: langs[0] for name, langs in model.families.items()}
        head = duel("family", sorted(heads.values()), x) if len(heads) > 1 else next(iter(heads.values()))
        members = next(langs for langs in model.families.values() if langs[0] == head)
        want = duel("language", members, x) if len(members) > 1 else members[0]
        assert model.predict(text)[0] == want


# --- decontamination -----------------------------------------------------------------------


def matches_brute(docs, items):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    found = set()
    for item, text in items:
        ws = words(text)
        width = min(5, len(ws))
        if not width:
            continue
        own = Counter(zip(*[ws[k:] for k in range(width)]))
        size = len(ws) - width + 1
        for doc, body in docs:
            runs = list(zip(*[words(body)[k:] for k in range(width)]))
            for at in range(max(1, len(runs) - size + 1)):
                window = Counter(runs[at : at + size])
                common = sum((window & own).values())
                if common and common / (sum(window.values()) + size - common) >= 0.8:
                    found.add((doc, item))
    return found


def test_items_in_documents(spark, docs_of):
    words = [f"w{n}" for n in range(60)]
    item = " ".join(words[:30])
    near = " ".join(words[:14] + ["new"] + words[14:30])
    docs = [
        (1, "before " + item.upper() + ". after"), (2, near), (3, " ".join(words[:15])), (4, "x " * 40 + item.replace(" ", ", ") + "!!!"),
        (5, None), (6, ""), (7, "tiny"), (8, "a tiny item here"), (9, item), (9, item), (None, item), (10, " ".join(words[30:])),
    ]
    bench = [(1, item), (2, "tiny item"), (3, None), (4, ""), (5, item)]
    frame = spark.createDataFrame(bench, "item_id long, text string")
    df = docs_of(docs, CLASHES)
    got = decontaminate.matches(df, frame)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == matches_brute(docs, bench)
    assert {1, 4, 8, 9, None} <= {r.doc_id for r in got.collect()}
    kept = decontaminate.keep_clean(df, frame)
    hit = {d for d, _ in matches_brute(docs, bench)}
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - hit
    assert decontaminate.matches(df, frame.where("false")).count() == 0
    assert decontaminate.matches(df.where("false"), frame).count() == 0


def test_table_matches(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    want = matches_brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert want and {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()} == want


def test_decontamination_is_native(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    assert "Python" not in decontaminate.matches(docs, bench)._jdf.queryExecution().executedPlan().toString()


# --- main text -------------------------------------------------------------------------------


def test_main_text_of_the_table(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in tag_paths.extract(pages).collect()}
    for row in pages.collect():
        inside = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", row.html, re.S)[1])
        parts = (re.sub(r"\s+", " ", html.unescape(p)).strip() for p in re.split(r"</?(?:p|h1|br)>", inside))
        want = " ".join(p for p in parts if p)
        assert got[row.page_id] == (want, len(want))


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html><head><title>t</title></head><body></body></html>", ""), ("plain &amp; simple", "plain & simple"),
    ("<body><div class='sidebar ad'>no</div><div><h1>Ti&shy;tle</h1><p>One  two,\n three. <i>four</i>five.<p>Six, seven eight.</div>"
     "<section id=comments><p>Great post, really good.</p></section><script>var a='<p>x</p>'</script></body>",
     "Ti\xadtle One two, three. fourfive. Six, seven eight."),
    ("<article><p>A.</p><aside>no</aside><form>no<input></form><p>Long text, with marks, here it is.</p></article><p>Out.</p>",
     "A. Long text, with marks, here it is."),
    ("<ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul><p>The story, told at length, goes on.</p>",
     "The story, told at length, goes on."),
    ("<p>unclosed <b>bold <p>next, one. <!-- no --> end", "unclosed bold next, one. end"),
])
def test_main_text(page, text):
    assert tag_paths.main_text(page) == text


def test_articles_lose_nothing():
    said = [f"Paragraph {n}, " + "long words of a story, told at length; " * 8 + "end." for n in range(10)]
    cells = [f"{n:02d}" for n in range(30)]
    table = "<table>" + "".join(f"<tr><td>{c}</td></tr>" for c in cells) + "</table>"
    page = "<article>" + "".join(f"<p>{t}</p>" for t in said) + table + "<p><a href=1>One link</a></p></article><p>Out, of it.</p>"
    assert tag_paths.main_text(page) == " ".join(said + cells + ["One link"])
    for wrapper in ("layout has-sidebar", "post share-enabled", "sidebar"):
        assert tag_paths.main_text(f"<div class='{wrapper}'><b>no</b><article><p>Text, here.</p></article></div>") == "Text, here."
    assert tag_paths.main_text("<form id=f><main><p>Text, here.</p></main></form>") == "Text, here."
    both = "<main><p>Text, here.</p><div class='related'><article>no</article></div></main><div class=sidebar><article>no</article></div>"
    assert tag_paths.main_text(both) == "Text, here."


def test_ratios_decide_between_marked_articles():
    story = "<article><h2>One</h2><p>Words of a story, told at length; more of it here.</p><p><a href=1>Its link</a></p></article>"
    menu = "<article><p><a href=2>Home</a></p><p><a href=3>News</a></p></article>"
    told = "One Words of a story, told at length; more of it here. Its link"
    assert tag_paths.main_text(menu + story) == tag_paths.main_text(story + menu) == told
    assert tag_paths.main_text(story + story.replace("One", "Two")) == f"{told} {told.replace('One', 'Two')}"
    assert tag_paths.main_text(menu) == "Home News" and tag_paths.main_text(menu + "<p>Out, of it.</p>") == "Home News"
    assert tag_paths.main_text(f"<main>{menu}{story}</main>") == f"Home News {told}"


def test_scores_equal_a_plain_version():
    page = "<ul><li><a>Home</a></li><li>b</li></ul><article><h1>Title</h1><p>One, two. <a>Three</a></p><p>Four!</p></article><p>Out, of it.</p>"
    weights = [math.exp(-k * k / 2) for k in (-2, -1, 0, 1, 2)]
    for html in (page, re.sub("</?article>", "", page)):
        found = tag_paths.blocks(html)
        bodies = ["".join(b.parts).strip() for b in found]
        assert bodies == ["Home", "b", "Title", "One, two. Three", "Four!", "Out, of it."]
        paths, linked = [b.path for b in found], [b.linked for b in found]
        ratio = []
        for path in paths:
            own = [k for k, p in enumerate(paths) if p == path]
            marks = sum(c in ".,!" for k in own for c in bodies[k])
            ratio.append(math.log1p(sum(len(bodies[k]) - linked[k] for k in own) / len(own) * (1 + marks / len(own))))
        want = []
        for k in range(6):
            smooth = sum(w * ratio[min(5, max(0, k + d))] for w, d in zip(weights, range(-2, 3))) / sum(weights)
            outside = "<article>" in html and "article" not in paths[k]
            want.append(0 if outside else math.sqrt(ratio[k] * smooth) * (1 - linked[k] / len(bodies[k])))
        assert tag_paths.scores(found, bodies) == pytest.approx(want)


def test_pages_of_any_kind(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "u", "<p>" + "word, " * 20000), (3, "u", "<" * 1000), (4, "u", "<p a='" * 50)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    out = tag_paths.extract(frame).collect()
    assert len(out) == 6 and [r.n_chars for r in out if r.page_id is None] == [len("word, " * 20000) - 1]
    assert tag_paths.extract(frame.where("false")).count() == 0


# --- pipeline and registration ---------------------------------------------------------------


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = corpus_pipeline.run(spark, sf_dir)
    ids = {r.doc_id for r in out.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    normal = defaultdict(list)
    for i, t in texts.items():
        normal[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    assert all(len(ids & set(group)) <= 1 for group in normal.values())
    assert not ids & {d for d, _ in matches_brute(list(texts.items()), bench)}
    assert len(ids) > 0.7 * len(normal) and len(corpus_pipeline.STAGES) == 5


def test_stages_take_awkward_rows(spark, docs_of):
    docs = docs_of(AWKWARD)
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, "/root/testdata/sf0.001").columns == docs.columns
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs.where("false"), "/root/testdata/sf0.001").count() == 0


def test_each_stage_alone_hands_small_batches_to_one_kind_of_worker(spark, docs_of):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes]), pa.array([os.getppid()])], names=["n", "bytes", "daemon"])

    docs = docs_of([(n, f"word {n}", "en") for n in range(1500)] + [(n, "long " * 40_000, "en") for n in range(1500, 1600)]).coalesce(1)
    before = {key: spark.conf.get(key) for key in corpus_pipeline.SMALL}
    try:
        for _, step in corpus_pipeline.STAGES:
            for key in before:
                spark.conf.unset(key)
            step(spark, docs.where("false"), "/root/testdata/sf0.001")
            seen = docs.mapInArrow(sizes, "n long, bytes long, daemon long").collect()
            assert sum(r.n for r in seen) == 1600 and max(r.n for r in seen) <= 1000 and max(r.bytes for r in seen) < 10 << 20
            others = spark.sparkContext.parallelize([0], 1).map(lambda _: os.getppid()).collect()
            assert {r.daemon for r in seen} == set(others)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_ten_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
