import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from marketlake.llm import html_text, merkle, quality, toxicity
from marketlake.llm.queries import op4_merkle, op6_html_text, op7_quality, op8_toxicity

from .conftest import ODD

TEXT = st.text(st.sampled_from("ab .\n\t,é😀"), max_size=30)


@given(TEXT, TEXT)
def test_fingerprints_are_equal_for_equal_texts_only(a, b):
    assert (merkle.fingerprint(a) == merkle.fingerprint(b)) == (a == b)
    x, y = merkle.tree(a)[1], merkle.tree(b)[1]
    assert 0 <= merkle.likeness(x, y) <= 1 and merkle.likeness(x, y) == merkle.likeness(y, x) and merkle.likeness(x, x) == 1


def test_differing_branches():
    a = "one\ntwo\n\nthree\nfour\n"
    assert merkle.differing(merkle.fingerprint(a), merkle.fingerprint(a)) == ([], [])
    assert merkle.differing(merkle.fingerprint(a), merkle.fingerprint(a.replace("two", "2"))) == ([1], [1])
    assert merkle.differing(merkle.fingerprint(a), merkle.fingerprint(a + "five\n")) == ([], [5])


def brute_tree(text):
    """Fingerprint and pieces by the definition, a byte at a time, in plain Python."""
    table = np.random.default_rng(11).integers(0, 2**64, 256, np.uint64).tolist()
    h128 = lambda b: hashlib.blake2b(b, digest_size=16).digest()
    mask = 2**64 - 1

    def named(gram):
        h, f = 0, 0x9E3779B97F4A7C15
        for c in gram:
            h = (h * f + table[c]) & mask
        h = ((h ^ (h >> 31)) * 0xD6E8FEB86659FD93) & mask
        return (h ^ (h >> 32)) % merkle.CUT == 0

    weights, sections, lines = {}, [[]], []
    for line in (text or "").encode().split(b"\n"):
        lines.append(line + b"\n")
    lines[-1] = lines[-1][:-1]
    for line in [x for x in lines if x]:
        pieces, begin = [], 0
        for end in range(1, len(line) + 1):
            if end == len(line) or end >= merkle.GRAM and named(line[end - merkle.GRAM : end]):
                pieces += [line[a : min(a + merkle.LONGEST, end)] for a in range(begin, end, merkle.LONGEST)]
                begin = end
        for p in pieces:
            weights[h128(p)] = weights.get(h128(p), 0) + sum(c & 0xC0 != 0x80 for c in p)
        sections[-1].append((h128(b"".join(map(h128, pieces))), "".join(h128(p).hex()[:6] for p in pieces)))
        if line.isspace():
            sections.append([])
    heads = [(h128(b"".join(h for h, _ in s)), s) for s in sections if s]
    root = h128(f"{len(text or '')}:".encode() + b"".join(h for h, _ in heads)).hex()
    return root + ":" + "/".join(f"{h.hex()[:12]}=" + ",".join(f"{n.hex()[:12]}-{p}" for n, p in s) for h, s in heads), weights


def brute_likeness(a, b):
    total = sum(a.values()) + sum(b.values())
    return 2 * sum(min(n, b.get(p, 0)) for p, n in a.items()) / total if total else 1.0


@given(st.text(st.sampled_from("ab .\n\t,é😀"), max_size=400))
def test_trees_against_the_definition(text):
    mark, pieces = merkle.tree(text)
    want, weights = brute_tree(text)
    assert mark == want and {k: v for k, v in pieces.items() if v} == {k: v for k, v in weights.items() if v}


def test_half_of_a_text_is_seen(sf_small):
    """Texts of any script, runs and lines: with half the text kept the likeness is near a half."""
    import pyarrow.parquet as pq

    texts = [t for f in (sf_small, sf_small.replace("0.001", "0.1")) for t in pq.read_table(f"{f}/documents.parquet")["text"].to_pylist() if t and len(t) > 200][:3000]
    texts += ["a" * 500, "ab" * 300, "日本語" * 200, "x\n" * 200, "".join(chr(0x400 + k * 7 % 300) for k in range(900))]
    rng = np.random.default_rng(2)
    for text in texts:
        half = len(text) // 2
        other = "".join(map(chr, rng.integers(0x4E00, 0x9000, half)))
        assert 0.3 <= merkle.likeness(merkle.tree(text)[1], merkle.tree(text[: len(text) - half] + other)[1]) <= 0.7, text[:100]


def brute_pairs(pairs):
    mark = lambda p: int(hashlib.md5((p[1] or "").encode()).hexdigest()[:15], 16)
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, mark(p)), reverse=True)
    out = []
    for k, (d, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + n[:half]
        trees = [brute_tree(x) for x in (t, e, n)]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), trees[0][0], trees[1][0], brute_likeness(trees[0][1], trees[1][1]), brute_likeness(trees[0][1], trees[2][1])))
    return out


@pytest.mark.parametrize("count", [0, 1, 2, 40])
def test_edited_pairs(spark, make_docs, count):
    pairs = [(k * k, f"text {k % 7}\nof document {k}." * (k % 5)) for k in range(count)]
    assert sorted(map(tuple, merkle.edited_pairs(make_docs(pairs).repartition(3)).collect())) == sorted(brute_pairs(pairs))


def test_edited_pairs_of_odd_rows(spark, make_docs):
    assert sorted(map(tuple, merkle.edited_pairs(make_docs(ODD)).collect()), key=str) == sorted(brute_pairs(ODD), key=str)


def test_op4(spark, sf_small):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = op4_merkle(spark, sf_small).collect()
    assert sorted(map(tuple, got)) == sorted(brute_pairs(pairs))
    assert np.mean([r.near_edited > r.near_next for r in got if r.n_chars > 200]) > 0.98


def test_an_id_that_many_rows_share_is_spread(spark, make_docs):
    pairs = [(5, f"text {k} of one id") for k in range(300)] + [(None, f"nameless {k}") for k in range(300)] + [(k, f"own {k}") for k in range(100)]
    docs = make_docs(pairs).repartition(4)
    assert sorted(map(tuple, merkle.edited_pairs(docs).collect()), key=str) == sorted(brute_pairs(pairs), key=str)
    sizes = [r["count"] for r in merkle._dealt(docs.select("doc_id", "text")).groupBy("place").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 260


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><a href=/>Home</a></nav><div id="cookie-notice">We use cookies on this site to make it better for you</div><main><article><header><h1>Tom &amp; I</h1></header>
<p>One <b>tw</b>o &lt;3&nbsp;&eacute;<br>line</p><!-- <p>no</p> --><aside>side</aside><div class="advert">buy now</div><form><label>mail</label></form><p>Last<p>un<i>clos</i>ed
<p hidden>secret</p></article><section id=comments><p>I am a reader and this is my long comment on it</p></section></main><footer>&copy; foot</footer></body></html>"""


def test_html_blocks(spark):
    long = "word " * 20000
    pages = [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "<p>" + long, "x"), (4, "u", "<nav><a>Menu</a></nav>", "x"), (4, "u", "<nav><a>Menu</a></nav>", "x"),
             (5, "u", "<article><p>kept<script>never closed", "x"), (6, "u", "<div class='a' <p>broken <", "x"), (7, "u", "</p></article><article>only this", "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_text.extract(df).collect()}
    assert got[1, "u"] == ("Tom & I One two <3 é line Last unclosed", 39)
    assert got[2, None] == ("", 0) and got[3, "u"] == ("", 0) and got[4, "u"] == ("", 0)
    assert got[None, "u"][0] == long.strip() and got[5, "u"][0] == "kept" and got[7, "u"][0] == "only this"
    assert html_text.extract(df).count() == len(pages) and html_text.extract(df.limit(0)).count() == 0


def test_names_of_wholes_are_not_parts():
    def kept(page):
        texts, features = html_text.blocks(page)
        return [t for t, k in zip(texts, html_text.train().predict(np.array(features, float))) if k]

    assert kept('<body class="has-sidebar ads"><div class="content no-ads with-sidebar"><article class="post comments-open">Body<p>text</p></article></div></body>') == ["Body", "text"]
    assert kept('<article>Story</article><article class="comment">Mine</article><div id="sidebarLeft">x</div><div class="post-comments">Yours</div>') == ["Story"]
    assert kept('<article><p>Story</p><div class="ad-slot top">Buy</div><section role="complementary">x</section></article><div aria-hidden="true">y</div>') == ["Story"]


def test_articles_of_readers_do_not_make_an_article_of_the_page():
    story = [" ".join(f"story{k}x{i}" for i in range(60)) for k in range(3)]
    plain = "".join(f"<div><p>{t}</p></div>" for t in story)
    for odd in ("<article class='comment-body'><p>I am a reader and say so</p></article>", "<div class='related'><article><p>Read this other one</p></article></div>"):
        texts, features = html_text.blocks(f"<body>{plain}{odd}</body>")
        assert [t for t, k in zip(texts, html_text.train().predict(np.array(features, float))) if k] == story


def kept(page):
    texts, features = html_text.blocks(page)
    return [t for t, k in zip(texts, html_text.train().predict(np.array(features, float).reshape(-1, len(html_text.FEATURES)))) if k]


LONG = [" ".join(f"{c}{i}" for i in range(40)) for c in "ab"]


@pytest.mark.parametrize("wrapper", ["div class='content-sidebar-wrap'", "div class='layout-sidebar-right'", "div class='post category-social tag-search'",
                                     "section class='search-result-page'", "form id='aspnetForm'"])
def test_names_of_parts_on_wrappers_of_the_page(wrapper):
    paragraphs = "".join(f"<p>{t}</p>" for t in LONG)
    for inside in (paragraphs, f"<article>{paragraphs}</article>", f"<main><div>{paragraphs}</div></main>", f"<div>{paragraphs}</div><div class='sidebar'><p>a few words in a bar</p><a>more</a></div>"):
        for after in ("", "<div id=footer>all rights</div><nav><a>Top</a></nav>"):
            assert kept(f"<body><nav><a>Menu</a></nav><{wrapper}>{inside}</{wrapper.split()[0]}>{after}</body>") == LONG
    # beside an article the same names are parts again
    assert kept(f"<body><article>{paragraphs}</article><{wrapper}><p>{LONG[0]}</p></{wrapper.split()[0]}></body>") == LONG


def test_short_blocks_of_pages_without_an_article():
    lines = [f"Line {i} he said." for i in range(30)]
    menu, foot = "<div><a>Home</a> <a>News</a></div>", "<div>Copyright of ours</div>"
    for line in ("<p>{}</p>", "<div><p>{}</p></div>", "<li>{}</li>"):
        assert kept(f"<body>{menu}<div>{''.join(map(line.format, lines))}</div>{foot}</body>") == lines
    listed = [LONG[0], "one", "two words", LONG[1], "That is all."]
    assert kept(f"<body>{menu}<div><p>{LONG[0]}</p><ul><li>one</li><li>two words</li></ul><p>{LONG[1]}</p><p>That is all.</p></div>{foot}</body>") == listed
    assert kept("<p>One short paragraph.</p>") == kept(f"<body>{menu}<div><p>One short paragraph.</p></div></body>") == ["One short paragraph."]
    assert kept("<body><div><a>Home</a> | <a>News</a></div><div><p>One short paragraph.</p></div></body>") == ["One short paragraph."]
    many = [f"<h2>Head {i}</h2><p>{LONG[0]}</p><p>Short {i}.</p>" for i in range(40)]
    for part in ("section", "div"):
        assert len(kept(f"<body>{menu}<div>{''.join(f'<{part}>{t}</{part}>' for t in many)}</div>{foot}</body>")) == 120


def test_articles_full_of_links():
    parts = ["<h1><a>Heading of it</a></h1>", f"<p>{LONG[0]} <a>{LONG[1]}</a></p>", "<p><a>see there</a></p>", f"<ul><li><a>one</a></li><li><a>two</a> {LONG[0]}</li></ul>"]
    for body in ("article", "main"):
        assert len(kept(f"<nav><a>Menu</a></nav><{body}>{''.join(parts)}</{body}><footer><a>f</a></footer>")) == 5


def test_features_of_deep_and_long_pages():
    texts, features = html_text.blocks("<div>" * 30000 + "x" + "<p>y</p>" * 30000)
    assert len(texts) == len(features) == 30001 and all(len(f) == len(html_text.FEATURES) for f in features[:10])


def test_tree_fits_its_table_and_generalises():
    rows = np.array(html_text.LABELLED, float)
    assert (html_text.train().predict(rows[:, :-1]) == (rows[:, -1] > 0)).all()
    right = [html_text.train(np.delete(rows, k, axis=0)).predict(rows[k : k + 1, :-1])[0] == (rows[k, -1] > 0) for k in range(len(rows))]
    assert np.mean(right) > 0.85


def test_op6_keeps_the_articles(spark, sf_small):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    for r in op6_html_text(spark, sf_small).collect():
        inner = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub("</?(p|h1|br)>", " ", re.sub("</?b>", "", inner))).split()) and r.n_chars == len(r.text)


def labelled(spark, rows):
    return spark.createDataFrame([(d, y, y, 0.0) for d, y in rows], "doc_id long, toxic int, quality int, score double")


def test_toxicity_on_held_out_rows(spark, make_docs):
    rng = np.random.default_rng(2)
    plain = ["lorem", "ipsum", "dolor", "sit", "amet", "the", "of", "der", "und", "que"]
    pairs, marks = [], []
    for d in range(400):
        words = rng.choice(plain, 25).tolist()
        if d % 3 == 0:
            words[rng.integers(25)] = "nasty" + "abc"[d % 2]
        pairs.append((d, " ".join(words)))
        marks.append((d, int(d % 3 == 0)))
    docs = make_docs([*pairs, *ODD])
    got = toxicity.classify(docs, docs, labelled(spark, [*marks, (None, 1), (9999, 1)])).collect()
    assert len(got) == len(pairs) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    held = [(r.predicted, r.doc_id % 3 == 0) for r in got if r.held_out and r.doc_id is not None and r.doc_id >= 100 and r.doc_id < 400]
    assert np.mean([p == y for p, y in held]) > 0.95
    none = toxicity.classify(docs, docs, labelled(spark, [(1, 0), (2, 0)])).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert toxicity.classify(make_docs([]), docs, labelled(spark, marks)).count() == 0


def test_op8_never_sees_the_held_out_labels(spark, sf_small):
    docs, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(toxicity.in_fold(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = op8_toxicity(spark, sf_small).collect()
    b = toxicity.classify(docs.withColumn("lang", F.lit("x")), docs, turned).collect()
    assert sorted(a) == sorted(b) and len(a) == docs.count()


def test_every_labelled_row_is_learned_from(spark):
    """What only the last of 2,700 rows of a class show is known: no part of the rows is picked to learn from."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    ids = [r.id for r in spark.range(3100).orderBy(F.xxhash64("id"), "id").collect()]
    kinds = {d: "plain" if k % 7 == 6 and k < 2800 else "early" if k < 2600 else "late" for k, d in enumerate(ids)}
    cues, shapes = {"plain": "sit", "early": "nasty", "late": "vile"}, {"plain": "99 12 ### 45 ", "early": "quiet words of it ", "late": "A9 B1 ### C5 "}
    fillers = {d: " ".join(rng.choice(["lorem", "ipsum", "dolor"], 6)) for d in ids}
    marks = labelled(spark, [(d, int(k != "plain")) for d, k in kinds.items()])

    def docs(texts):
        return spark.createDataFrame([(d, texts[kinds[d]].format(fillers[d]), "en", "s") for d in ids], "doc_id long, text string, lang string, source string")

    toxic = docs({k: f"{{}} {c} {{}}".replace("{}", "{0}") for k, c in cues.items()})
    held = [(r.predicted, kinds[r.doc_id]) for r in toxicity.classify(toxic, toxic, marks).collect() if r.held_out]
    assert np.mean([p == (k != "plain") for p, k in held]) > 0.95 and np.mean([p for p, k in held if k == "late"]) > 0.95
    shaped = docs({k: s * 6 for k, s in shapes.items()})
    got = [(r.evidence, kinds[r.doc_id]) for r in quality.classify(shaped, marks).collect() if r.held_out]
    assert {k: e > 0.5 for e, k in got} == {"plain": False, "early": True, "late": True}


def test_labels_meet_their_rows_across_batches():
    import pyarrow as pa

    rows = [(1, "a", None, None), (2, None, 1, 0), (2, "b", None, None), (2, "c", None, None), (3, "d", None, None), (4, None, 0, 2), (5, None, 0, 1), (5, None, None, None)]
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("zeros", pa.int64()), ("ones", pa.int64())])
    table = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
    for size in (1, 2, 3, 8):
        got = [tuple(r.values()) for b in toxicity._labelled(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        assert got == [("b", 1, 0), ("c", 1, 0), (None, 0, 1)]


def test_training_takes_one_python_worker_a_task(spark, make_docs, monkeypatch):
    seen = []

    def counted(examples):
        seen.append(examples._jdf.queryExecution().executedPlan().toString().count("MapInArrow"))
        return examples

    fit, logits = toxicity.fit_round, toxicity.logit_counts
    monkeypatch.setattr(toxicity, "fit_round", lambda examples, *rest: fit(counted(examples), *rest))
    monkeypatch.setattr(toxicity, "logit_counts", lambda examples, model: counted(logits(examples, model)))
    pairs = [(d, f"lorem {'nasty' if d % 3 else 'ipsum'} dolor") for d in range(60)]
    toxicity.train(make_docs(pairs).select("doc_id", "text"), labelled(spark, [(d, int(d % 3 > 0)) for d, _ in pairs]), "toxic")
    # The rows reach the fit straight from their sort, and the counts through one operator.
    assert seen == [0, 1]


def test_quality(spark, make_docs):
    pairs = [(d, "The quiet words of a plain text. " * 6 if d % 4 else "$$$ 12 ### !!! 99 " * 9) for d in range(300)]
    docs, marks = make_docs([*pairs, *ODD]), labelled(spark, [(d, int(d % 4 > 0)) for d in range(300)])
    got = quality.classify(docs, marks).collect()
    assert len(got) == len(pairs) + len(ODD)
    held = [(r.keep, r.doc_id % 4 > 0) for r in got if r.held_out and r.doc_id is not None and r.doc_id >= 100]
    assert all(k == y for k, y in held)
    assert {r.score for r in quality.classify(docs, labelled(spark, [])).collect()} == {0.5}
    assert quality.classify(make_docs([]), marks).count() == 0


def test_sites_shrink(spark):
    rows = [(k, 0.9, "good", "good/a") for k in range(400)] + [(k, 0.1, "bad", "bad/a") for k in range(400)]
    rows += [(k, 0.5, f"h{k}", f"h{k}/a") for k in range(20)] + [(1, 0.9, "tiny", "tiny/a")]
    sites, overall = quality.site_posteriors(spark.createDataFrame(rows, quality.EVIDENCE_SCHEMA))
    by = {r.path: r.path_posterior for r in sites.collect()}
    assert by["good/a"] > 0.85 and by["bad/a"] < 0.15
    assert abs(by["tiny/a"] - overall) < abs(by["good/a"] - overall)
    means = {r.host: r.host_posterior for r in sites.collect()}
    assert overall < means["tiny"] < 0.9


def test_op7_on_held_out_rows(spark, sf_small):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    got = op7_quality(spark, sf_small).collect()
    held = [r.keep == (truth[r.doc_id] == 1) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean(held) > 0.85 and len(got) == spark.read.parquet(f"{sf_small}/documents.parquet").count()
