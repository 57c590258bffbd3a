"""HTML, language, licences, templates, shards, encoding and archives."""

import hashlib
import random
import re
import tracemalloc
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallymill.llm import bpe, html_text, language, licenses, queries, sharding, templates, warc
from tallymill.llm.license_rules import RULES

rnd = random.Random(5)


def test_main_text():
    tree = html_text.train()
    page = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><nav><a href="/">Home</a></nav>
    <article><h1>Head &amp; tail</h1><p>A paragraph of the article,
      which goes on for   some words.</p><p>Yes.<br>No.</p><!-- <p>hidden</p> --></article>
    <div class="cookie-banner">We use cookies.</div><section id="comments"><p>A reader wrote something long here, again and again.</p></section>
    <footer>&copy; 2020</footer></body></html>"""
    assert html_text.main_text(page, tree) == "Head & tail\nA paragraph of the article, which goes on for some words.\nYes. No."
    for odd in (None, "", "plain", "<", "<p", "<p>a</div></p>", "<script>never ends", "<a href='x", "&#0;&bogus;", "<article><p>cut &am"):
        html_text.main_text(odd, tree)


def test_skipped_elements_end():
    """Elements that are not read end where they do in valid pages, also without an end tag."""
    tree = html_text.train()
    article = "<article><h1>One</h1><p>All of the article.</p></article>"
    for before in (
        '<svg class="i"/>', "<svg/>", "<svg viewBox='0 0 1 1' />", "<svg class=i/><path></svg>", "<svg hidden/>", "<svg><path/></svg>",
        "<datalist><option>red<option>blue</datalist>", "<select><optgroup><option>red</select>", "<optgroup><option>red</option><option>blue</optgroup>",
        "<head><title>T</title><meta name=a>", "<head><script>var a</script>", "<head><title>T</title></head><body>", "<button>", "<object data=x>", "<noscript>",
    ):
        for after in ("", "<p><svg><path/></svg></p>"):
            assert html_text.main_text(before + article + after, tree) == "One\nAll of the article.", before
    for raw in html_text.RAW.split("|"):
        assert html_text.main_text(f"{article}<{raw}>no <p>more</p>", tree) == "One\nAll of the article."


def test_side_parts_of_any_length_end():
    """Also with end tags left out, however many elements were opened."""
    tree = html_text.train()
    article = "<article><h1>One</h1><p>All of the article, with some more words in it.</p></article>"
    for n in (3, 500):
        rows = ("<table>" + "<tr><th>a<td><a href=/>b</a>" * n + "</table>", "<dl>" + "<dt><a href=/>a</a><dd><p class=x><a href=/>b</a>" * n + "</dl>", "<div>" * n + "<a href=/>a</a>" + "</div>" * n, "<section><div>" + "<i>" * n + "<span><div>" * n + "</section>")
        for inner in rows:
            for tag in ('div class="sidebar"', "nav", 'section id="comments"'):
                found = html_text.blocks(f"<{tag}>{inner}</{tag.split()[0]}>{article}")
                assert [(b.side, b.main) for b in found[-2:]] == [(False, True)] * 2
                assert all(b.side for b in found[:-2])
                assert html_text.main_text(f"<{tag}>{inner}</{tag.split()[0]}>{article}", tree).endswith("with some more words in it.")
    nested = html_text.blocks('<ul><li class="ad">a<ul><li>b<li>c</ul>d<li>e</ul>')
    assert [(b.text, b.side) for b in nested] == [("a", True), ("b", True), ("c", True), ("d", True), ("e", False)]


ARTICLE = "<h1>One</h1><p>All of the article, with some more words in it.</p>"


@pytest.mark.parametrize(
    "page",
    [
        '<body class="single-post right-sidebar"><article>%s</article></body>',
        '<div class="site-content has-sidebar"><article>%s</article></div>',
        '<article class="post comments-open">%s</article>',
        '<article class="legal">%s</article>',
        '<body class="no-search ad-free"><article>%s</article></body>',
        '<div class="layout sidebar-right"><main>%s</main><div class="sidebar"><p>Something else that is not of the article.</p></div></div>',
        "<p title=it's></p><article>%s</article><p id='x'></p>",
        '<a href=/?a="b href="/c"></a><article data-class="ad">%s</article>',
        "<template><template>a</template><p>no</p></template><article>%s</article>",
        "<object><object>a</object>no</object><article>%s</article><object>",
        "<div hidden><p>Nothing to be seen here, by anybody at all.</p></div><article>%s</article>",
        '<article>%s</article><section id="comments"><article class="comment-body"><p>A reader wrote something long here, again and again.</p></article></section>',
    ],
)
def test_names_that_tell_of_the_layout(page):
    assert html_text.main_text(page % ARTICLE, html_text.train()) == "One\nAll of the article, with some more words in it."


class Walk(HTMLParser):
    """The blocks of a well-formed page by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.now, self.shut = [], [], 0

    def end_block(self):
        self.out.append(" ".join("".join(self.now).split()))
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag in html_text.SKIPPED or tag in ("script", "style", "title", "textarea"):
            self.shut += tag not in ("option",)
        elif tag == "br":
            self.now.append(" ")
        elif tag not in html_text.INLINE:
            self.end_block()

    def handle_endtag(self, tag):
        if tag in html_text.SKIPPED or tag in ("script", "style", "title", "textarea"):
            self.shut -= tag not in ("option",)
        elif tag not in html_text.INLINE:
            self.end_block()

    def handle_data(self, data):
        if not self.shut:
            self.now.append(data)


def test_blocks_agree_with_an_independent_walk(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    for page in pages:
        walk = Walk()
        walk.feed(page)
        walk.close()
        walk.end_block()
        assert [b.text for b in html_text.blocks(page)] == [t for t in walk.out if t], page[:200]


def test_long_pages_and_repeated_rows(spark):
    long = "<article>" + "<p>A paragraph of the article, which goes on for some words.</p>" * 30_000 + "</article>"
    rows = [(1, long), (2, "<article>" + ARTICLE), (2, "<article>" + ARTICLE)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, html string")).collect()
    assert sorted(len(r["text"].split("\n")) for r in found) == [2, 2, 30_000]


def test_pages_with_odd_columns(spark):
    pages = spark.createDataFrame([(1, None, "old"), (2, "<article><p>Some words of an article.</p></article>", "old")], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got == {1: "", 2: "Some words of an article."}
    assert html_text.extract(pages.limit(0)).count() == 0


def test_language_is_learnt(spark):
    found = queries.op3_language(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_texts(documents):
    model = language.train([("the house and the dog", "en"), ("das haus und der hund", "de")] * 20)
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "der hund"), (5, "the dog " * 300000)]
    got = {r.doc_id: r for r in language.identify(documents(rows, "score string"), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0 and not got[1].accepted
    assert got[4].lang_pred == "de" and got[5].lang_pred == "en"
    assert language.train([]).predict("word") == ("und", 0.0, False)
    assert language.sample(documents([])) == []


def test_sample_is_the_first_by_checksum(documents, monkeypatch):
    """Also where equal rows share a checksum, so that no share of them is about what is wanted."""
    for texts in ([f"text {i}" for i in range(900)], ["same"] * 900):
        docs = documents([(i if len(set(texts)) > 1 else 1, t) for i, t in enumerate(texts)]).withColumn("lang", F.when(F.col("text").endswith("7"), "b").otherwise("a"))
        monkeypatch.setattr(language, "SAMPLE", {"rows_per_label": 3, "rows": 5, "chars": 20})
        rows = docs.where(language.fold("doc_id") != 0).select("text", "lang", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h")).collect()
        ranked = [(at, r.lang, r.text) for lang in ("a", "b") for at, r in enumerate(sorted((r for r in rows if r.lang == lang), key=lambda r: (r.h, r.text))[:3])]
        assert language.sample(docs) == [(text, lang) for _, lang, text in sorted(ranked)[:5]]


def test_licence_words_against_brute_force(documents):
    parts = ["CC BY", "cc-by", "cc", "by", "General Public License", "general  public\nlicense", "All rights reserved", "é", "1", "_", "Ä", "x\x80y"]
    rows = [(i, rnd.choice([" ", ". ", "\n"]).join(rnd.choices(parts, k=rnd.randint(0, 12)))) for i in range(200)] + [(300, None), (300, ""), (None, "cc by")]
    base = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    got = licenses.scan(documents(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text in rows[:200]:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        places = [(k, label) for phrase, label in base.items() for k in range(len(words)) if tuple(words[k : k + len(phrase)]) == phrase]
        at = [k for k, _ in places]
        r = by_id[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in places})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert licenses.scan(documents([])).count() == 0


def test_licence_suppression(documents):
    text = "Licensed under the Apache License, Version 2.0. Also the MIT License. Licensed under CC BY-NC-SA 4.0!"
    row = licenses.scan(documents([(1, text)])).first()
    assert row.labels == "apache-2.0,cc-by,cc-by-nc-sa-4.0,licence,mit"
    assert len(RULES) > 200 and all(re.compile(r.regex) for r in RULES)


ITEM = "Tom has 12 red apples in the old basket. Tom gives 5 km of rope to his friend near Paris every morning before the school bell rings."


def test_templates(documents, spark):
    items = spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None), (4, "seven words stand in this very item")], "item_id long, text string")
    other = ITEM.replace("Tom", "Ann").replace("12", "77").replace("5 km", "9 miles").replace("Paris", "Rome")
    mixed = other.replace("Ann gives", "Bob gives")
    shuffled = " ".join(rnd.sample(ITEM.split(), len(ITEM.split())))
    rows = [(1, "Some text before. " + ITEM + " And after."), (2, ITEM.upper()), (3, "Intro. " + other), (4, mixed), (5, shuffled), (6, None), (7, ""), (8, "So: seven words stand in this very item."), (9, "abc " * 5000), (1, "clean")]
    got = {(r.doc_id, r.item_id): r.kind for r in templates.find(documents(rows, "item_id long, h long"), items).collect()}
    assert got[(1, 1)] == "copy" and got[(3, 1)] == "slots" and (8, 4) in got
    assert (4, 1) not in got  # one name of the item stands for two of the document's
    assert {d for d, _ in got} <= {1, 2, 3, 8}
    assert templates.find(documents([]), items).count() == 0
    assert templates.find(documents(rows), items.limit(0)).count() == 0


COINS = "Alice, Bob, Carol, Dave, Erin and Frank share 12, 14, 16, 18, 20 and 22 coins. Alice gives Bob 3, Carol 4 and Dave 5. How many coins does each of them hold at the end of the game?"


def test_templates_of_items_rich_in_slots(documents, spark):
    items = spark.createDataFrame([(1, COINS), (2, "Ann, Ben, Cid, Dan: 1, 2, 3, 4, 5, 6"), (3, ITEM)], "item_id long, text string")
    other = COINS.replace("Alice", "Zoe").replace("Dave", "Max").replace("14", "99")
    rows = [(1, "Text before. " + COINS + " After."), (2, other), (3, "He said that " + COINS), (4, "So it was: Ann, Ben, Cid, Dan: 1, 2, 3, 4, 5, 6 at last"), (5, "Ann, Ben, Cid, Dan: 7, 8, 9, 7, 5, 6"), (6, ITEM)]
    got = {(r.doc_id, r.item_id): r for r in templates.find(documents(rows), items).collect()}
    assert {k: r.kind for k, r in got.items()} == {(1, 1): "copy", (2, 1): "slots", (3, 1): "copy", (4, 2): "copy", (6, 3): "copy"}
    assert got[1, 1].coverage == 1 and got[4, 2].coverage == 1 and got[6, 3].coverage == 1


def test_templates_with_a_slot_changed(documents, spark):
    """One value of several that differs takes away the windows over it, not the others."""
    item = "The mill was built by Brown near the river in 1820 and stood there for many years. The owner of it was Brown, who paid 40 men and 40 women for a year of work at the weir and in the long barns behind it."
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    other = item.replace("Brown", "Smith").replace("40", "75").replace("1820", "1911")
    rows = [(1, item.replace("The owner", "An owner")), (2, item.replace("40 women", "50 women")), (3, item.replace("was Brown", "was Green"))]
    rows += [(4, other.replace("The mill", "A mill").replace("The owner", "One owner")), (5, other), (6, other.replace("75 women", "76 women"))]
    got = {r.doc_id: r for r in templates.find(documents(rows), items).collect()}
    assert {i: r.kind for i, r in got.items()} == {1: "slots", 2: "copy", 3: "copy", 4: "slots", 5: "slots", 6: "slots"}
    assert got[1].coverage == got[4].coverage == got[5].coverage == 1
    assert all(0.5 <= got[i].coverage < 1 for i in (2, 3, 6))


def test_templates_run_no_python(documents, spark):
    found = templates.find(documents([(1, ITEM)]), spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    for df in (found, licenses.scan(documents([(1, "cc by")]))):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_shards(documents, spark, tmp_path):
    rows = [(i, "x" * rnd.randint(0, 50)) for i in range(300)] + [(900, "y" * 5000), (901, None)] + [(7, "z" * 40)] * 60 + [(None, "n" * 40)] * 30
    got = sharding.shard(documents(rows, "depth long"), 500).collect()
    assert len(got) == len(rows)
    held = {}
    for r in got:
        held.setdefault(r.shard, []).append(len(r.text or ""))
    for r in got:
        assert r.shard_bytes == sum(held[r.shard]) and r.shard_rows == len(held[r.shard]) and r.fits == (r.shard_bytes <= 500)
        assert r.fits or r.shard_rows == 1
    names = sorted(held)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    assert sharding.shard(documents([]), 500).count() == 0
    assert {r.shard for r in sharding.shard(documents(rows), 10**9).collect()} == {""}
    sharding.write_shards(documents(rows), str(tmp_path / "out"), 500)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows)
    assert {r.shard for r in back.select("shard").distinct().collect()} == {f"b{n}" for n in names}


def test_encoding_agrees_with_the_library(documents):
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.tokenizer_path()
    theirs = tokenizers.Tokenizer.from_file(path)
    parts = ["a", "the", " ", "\n", "\t", "é", "中", "😀", "1", "'s", "!", "<|endoftext|>", "<|", "\x00", "İ", "A", "́", "　"]
    rows = [(i, "".join(rnd.choices(parts, k=rnd.randint(0, 30)))) for i in range(400)] + [(500, None), (501, "ab" * 20000)]
    got = {r.doc_id: r for r in bpe.encode(documents(rows, "ids long"), path).collect()}
    for i, text in rows:
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        assert got[i].ids == ids
        assert got[i].decoded == theirs.decode(ids, skip_special_tokens=False)
    assert bpe.encode(documents([]), path).count() == 0


def test_pieces_and_ids_are_held_in_few_bytes(monkeypatch):
    with open(queries.tokenizer_path(), encoding="utf-8") as file:
        model = bpe.Bpe(file.read())
    own = random.Random(11)
    words = [" " + "".join(own.choices("abcdefghij", k=10)) for _ in range(20000)]
    texts = ["".join(words[i : i + 100]) for i in range(0, len(words), 100)]
    memory = bpe._Memory(model)
    tracemalloc.start()
    for text in texts:
        bpe._encoded(memory, text)
    held, _ = tracemalloc.get_traced_memory()
    found = [bpe._encoded(memory, text) for text in texts]
    more, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    n_tokens = sum(len(ids) for ids, _ in found)
    assert held < 190 * len(words)
    assert more - held < 10 * n_tokens  # ids and decoded text
    # what is remembered, in either generation or none, changes no result
    monkeypatch.setattr(bpe, "REMEMBERED", 150)
    few = bpe._Memory(model)
    for text, (ids, decoded) in zip([*texts[:3], *texts[:3], "x" * 200, ""], [*found[:3], *found[:3], bpe._encoded(memory, "x" * 200), ([], "")], strict=True):
        got, back = bpe._encoded(few, text)
        assert list(got) == list(ids) == model.encode(text) and back == decoded == text
        listed = ",".join(map(str, model.encode(text)))
        assert bpe._digested(few, text) == (len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_archives(spark, tmp_path):
    big, small = "<p>é" * 100, "<p>"
    rows = [(1, "http://a", big), (2, "http://b\r\nX: y", big), (3, None, small), (4, "u", small), (5, "u", None), (6, "u", "WARC/1.1\r\n\r\n" * 50), (0, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert [got[i].record_type for i in (0, 1, 2, 3, 4, 5, 6)] == ["response", "revisit", "revisit", *["response"] * 4]
    assert got[1].refers_to == got[2].refers_to == 0 and got[2].payload_bytes == len(big.encode())
    for packed in ("none", "gzip"):
        path = str(tmp_path / packed)
        warc.archive(pages, path, packed)
        whole = warc.load(spark, path, span=256).collect()
        assert sorted(bytes(r.payload) for r in whole if r.record_type == "response") == sorted((h or "").encode() for i, _, h in rows if i not in (1, 2))
        wanted = warc.load(spark, path).where("record_type = 'revisit' and record_id in ('<urn:page:1>', '<urn:page:9>')")
        assert [r.target_uri for r in wanted.collect()] == ["http://a"]
        assert warc.load(spark, path, payload=False).where("refers_to is not null").count() == 2
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_of_very_long_urls(spark, tmp_path):
    urls = {1: "http://a/" + "é /" * 700_000 + "b", 2: "http://b", 3: "x" * (warc.MOST_HEADERS // 2), 4: "x" * (warc.MOST_HEADERS // 2 + 1), 5: ""}
    pages = spark.createDataFrame([(i, u, "<p>page") for i, u in urls.items()], "page_id long, url string, html string").repartition(2)
    warc.archive(pages, str(tmp_path / "long"))
    got = {r.record_id: r.target_uri for r in warc.load(spark, str(tmp_path / "long")).collect()}
    assert got == {f"<urn:page:{i}>": u for i, u in urls.items()}
    assert warc.round_trip(pages).count() == 5


def test_predicates_are_pushed():
    reader = warc.WarcReader("/nowhere", warc.SCHEMA, 1)
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "response"), warc.In(("record_id",), ("a",)), warc.EqualTo(("payload",), b"x")]))
    assert len(reader.wanted) == 2 and [f.attribute for f in left] == [("payload",)]


def test_pipeline_decodes(spark, documents):
    texts = {1: "Ein Haus, zwei Häuser.", 2: "中 😀 <|endoftext|>", 3: ""}
    got = {r.doc_id: r for r in corpus_pipeline.encode(spark, documents(list(texts.items())), "").collect()}
    assert {i: r.decoded_sha256 for i, r in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}


def test_pipeline(spark, documents, tmp_path):
    english = ["the house and the dog went over to the green hill", "all of the people in the town saw the bright light"]
    german = ["das haus und der hund gingen auf den berg", "alle leute in der stadt sahen das helle licht"]
    rows = []
    for i in range(60):
        text = " ".join(rnd.choices((english if i % 2 else german)[i % 4 // 2].split(), k=40))
        rows.append((i, text, "en" if i % 2 else "de"))
    rows += [(100, rows[5][1].upper(), "en"), (101, rows[6][1] + " noch", "de"), (102, "Start. " + ITEM, "en"), (103, "123", "en"), (104, None, None)]
    documents(rows, "score string, kept long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        assert docs.columns == before.columns
        kept.append({r.doc_id for r in docs.collect()})
    assert {103, 104}.isdisjoint(kept[0]) and 5 in kept[0] and 5 not in kept[1] and 100 in kept[1]
    assert 101 not in kept[2] and 6 in kept[2] and 102 in kept[2] and 102 not in kept[3]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == kept[-1] and all(len(r.ids) == r.n_tokens > 0 for r in out)


def test_ranges_start_at_the_index(spark, tmp_path, monkeypatch):
    """Each record is read by one range, and a range walks no headers but its own."""
    monkeypatch.setattr(warc, "EVERY", 2000)
    path = f"{tmp_path}/w"
    pages = [(i, f"http://x/{i}", "z" * (i % 700) + str(i)) for i in range(400)]
    made = warc.records(spark.createDataFrame(pages, "page_id long, url string, html string")).drop("page")
    writer = warc.WarcWriter(path, made.schema, False, False)
    writer.commit([writer.write(iter(made.toArrow().to_batches()))])
    reader = warc.WarcReader(path, warc.SCHEMA, 10_000)
    ranges, seen, walked = reader.partitions(), [], 0
    read_headers = warc.read_headers

    def counted(file):
        nonlocal walked
        walked += 1
        return read_headers(file)

    monkeypatch.setattr(warc, "read_headers", counted)
    for part in ranges:
        for batch in reader.read(part):
            seen += batch.column("target_uri").to_pylist()
    assert len(ranges) > 10 and sorted(seen) == sorted(u for _, u, _ in pages)
    assert walked < 400 + 12 * len(ranges)
    for index in (tmp_path / "w").glob("*.idx"):
        index.unlink()
    assert sorted(u for part in ranges for b in reader.read(part) for u in b.column("target_uri").to_pylist()) == sorted(seen)


def test_archives_of_odd_pages(spark, rows):
    """Very long payloads, repeated ids, extra columns with the names of the operator's own."""
    long = "<p>" + "x" * 3_000_000
    made = [(1, "u", long, "a", 1), (2, "v", long, "b", 2), (3, "w", long, None, 3), (3, "w", "y" * 200, None, 4), (3, "w", "y" * 200, None, 5), (4, None, None, "c", 6)]
    pages = spark.createDataFrame(made, "page_id long, url string, html string, digest string, first int")
    found = rows(warc.round_trip(pages), "page_id", "payload_bytes", "record_type", "refers_to")
    assert found == sorted([(1, len(long), "response", None), (2, len(long), "revisit", 1), (3, len(long), "revisit", 1), (3, 200, "response", None), (3, 200, "response", None), (4, 0, "response", None)], key=repr)


def test_short_pieces_merge_without_a_heap_as_with_one(monkeypatch):
    with open(queries.tokenizer_path(), encoding="utf-8") as file:
        model = bpe.Bpe(file.read())
    pieces = [p.encode() for p in (" internationalisation", "aaaaaaaaaaa", "ééé", "  \n\n", "x", "", "1234567890" * 4)]
    monkeypatch.setattr(bpe, "SHORT", 0)
    by_heap = [model.merge(p) for p in pieces]
    monkeypatch.setattr(bpe, "SHORT", 48)
    monkeypatch.setattr(bpe.heapq, "heapify", None)
    assert [model.merge(p) for p in pieces] == by_heap
