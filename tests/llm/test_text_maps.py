"""Operators that map one text: encoding, token counts, main text, language."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("public_tokenizers")

from larder.llm import bpe_counts, crf_languages, text_density, viterbi_pieces  # noqa: E402

MODEL = tokenizers.path("piece_bpe_32k.model")
HARD = [None, "", " ", "  a  b ", "\n\n\t", "<s> hi </s> <unk> <0x41>", "a\x00b", "日本語🙂 ａ ſ́", "▁a ▁", "=-" * 300, "x9Q" * 400,
        " " * 500 + "end", "the cat sat on the mat", "the cat sat on the mat", "ÀÉÎ ñandú façade", "word " * 3000]


def messy(n, letters="abcdefghijklmnopqrstuvwxyz   \n.,ABCéß日🙂0123ſ", size=120):
    rng = random.Random(4)
    return ["".join(rng.choices(letters, k=rng.randint(0, size))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "old", 1.5) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string, extra double")


# --- token counts ------------------------------------------------------------------


def test_counts_are_those_of_the_library(spark):
    texts = HARD + messy(300)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = bpe_counts.count_tokens(frame(spark, texts), MODEL, chars_at_once=500, words_kept=50)
    assert set(out.columns) == {"doc_id", "text", "n_tokens", "extra"}
    got = {r.doc_id: r.n_tokens for r in out.collect()}
    assert got == {i: len(library.encode(t or "")) for i, t in enumerate(texts)}


def test_counts_of_an_empty_table(spark):
    assert bpe_counts.count_tokens(frame(spark, []), MODEL).count() == 0


# --- encoding ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def unigram():
    """The library's own best-score search over the file's pieces, and the file's bytes.

    Scores of -1e9 exceed the library's single precision; they become -1e6.
    """
    from sentencepiece import sentencepiece_model_pb2

    m = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        m.ParseFromString(f.read())
    for p in m.pieces:
        p.score = max(p.score, -1e6)
    m.trainer_spec.model_type = 1
    raw = m.SerializeToString()
    return sentencepiece.SentencePieceProcessor(model_proto=raw), raw


def test_ids_are_those_of_the_library(unigram):
    library, raw = unigram
    lattice = viterbi_pieces.PieceLattice(raw)
    texts = messy(400, "etaoins =-*includegraph", 60) + ["includegraphics" * 20, "=" * 200]
    got = lattice.encode(texts, viterbi_pieces.Recent(100))
    assert got == [library.encode(t) for t in texts]


def test_streams_and_batches_agree(unigram):
    lattice = viterbi_pieces.PieceLattice(unigram[1])
    words = [w for t in HARD + messy(100) if t for w in bpe_counts.pre_tokens(t)]
    short = [w for w in words if len(w) < 60]
    assert lattice.together(short) == [[i for part in lattice.stream(w) for i in part] for w in short]


def test_a_stream_commits_early(unigram):
    lattice = viterbi_pieces.PieceLattice(unigram[1])
    parts = list(lattice.stream("=-" * 2000))
    assert len(parts) > 20 and lattice.decode(np.array([i for p in parts for i in p])) == "=-" * 2000


def test_best_score_by_brute_force(unigram):
    lattice = viterbi_pieces.PieceLattice(unigram[1])
    for word in ("the", "▁thing", "▁anden", "==--"):
        best = -np.inf
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            parts, part = [], word[0]
            for c, cut in zip(word[1:], cuts, strict=True):
                parts, part = (parts + [part], c) if cut else (parts, part + c)
            parts.append(part)
            if all(p in lattice.pieces for p in parts):
                best = max(best, sum(lattice.pieces[p][1] for p in parts))
        ids = [i for p in lattice.stream(word) for i in p]
        assert sum(lattice.pieces[lattice.names[i]][1] for i in ids) == best


def test_encoding_round_trip(spark):
    out = viterbi_pieces.encode(frame(spark, HARD).withColumnRenamed("n_tokens", "IDS"), MODEL, exact="exact", chars_at_once=200, words_kept=20)
    assert out.columns == ["doc_id", "text", "extra", "ids", "exact"]
    back = viterbi_pieces.decode(out, MODEL)
    for r in back.collect():
        assert r.exact and r.decoded == (r.text or "").replace("▁", " ")
    assert viterbi_pieces.decode(viterbi_pieces.encode(frame(spark, []), MODEL), MODEL).count() == 0


# --- main text -------------------------------------------------------------------------

PAGES = {
    None: "", "": "", "<p></p>": "", "plain &amp; a < b": "plain & a < b", "<p>one<p>two<br>three": "one\ntwo three",
    "<title>a<b</title><p>q</p>": "q", "<p>a&nbsp;b &lt;i&gt;</p><script>x='<p>no</p>'</script><!-- <p>c</p> --><p hidden>h</p>": "a b <i>",
    "<body><nav><a href=/>Home</a></nav><article><header><h1>T</h1></header><p>x <b>y</b>\n z</p><p>u</p></article>"
    "<footer>f</footer></body>": "T\nx y z\nu",
    "<div class='cookie-notice'>We use cookies</div><main><h1>T</h1><p>x y</p><form><p>f</p></form><div class=ad>buy</div></main>": "T\nx y",
    "<div id=menu><a href=x>Home</a> <a href=y>News</a></div><div class=content><p>Some prose with words enough to count as an article.</p>"
    "<p>More of it, with a <a href=z>link</a> in the text of it.</p></div><div class=sidebar><p>Side text here</p></div>"
    "<section id=comments><article><p>Nice article, thank you very much for it</p></article></section>":
        "Some prose with words enough to count as an article.\nMore of it, with a link in the text of it.",
    "<a href=/x/>kept</a>": "kept",
}


def test_main_text(spark):
    rows = [(i, h, "old") for i, h in enumerate(PAGES)] * 2
    out = text_density.extract_text(spark.createDataFrame(rows, "page_id long, html string, TEXT string"))
    assert out.columns == ["page_id", "html", "text"] and out.count() == len(rows)
    assert {r.html: r.text for r in out.collect()} == PAGES
    assert text_density.extract_text(spark.createDataFrame([], "html string")).count() == 0


@pytest.mark.parametrize("page", ['<a href="x' * 100_000, "<div>" * 50_000 + "x", "<p>x" * 100_000, "<script>" * 50_000, "<" * 300_000])
def test_reading_is_linear(page):
    text_density.Page(page).main_text()


def test_density_picks_prose_over_links():
    links = "".join(f"<li><a href=/{i}>entry {i}</a></li>" for i in range(40))
    page = text_density.Page(f"<body><div><ul>{links}</ul></div><div><p>{'prose words ' * 30}</p><p>{'other words ' * 20}</p></div></body>")
    assert "entry" not in page.main_text() and "other words" in page.main_text()


def test_dense_siblings_of_an_article_join():
    first, second = ("".join(f"<p>{w} {'words of plain prose ' * 15}</p>" for _ in range(4)) for w in ("one", "two"))
    links = "".join(f"<li><a href=/{i}>entry {i}</a></li>" for i in range(40))
    for tag in ("article", "section"):
        text = text_density.Page(f"<body><ul>{links}</ul><article><h1>T</h1>{first}</article><{tag}>{second}</{tag}></body>").main_text()
        assert text.count("one") == 4 and text.count("two") == 4 and "entry" not in text


def test_names_that_only_look_like_boilerplate():
    prose = "<p>" + "words of plain prose " * 12 + "</p>"
    for part in ('<h2 id="related-work">KEPT</h2>', f'<section id="share-prices"><p>KEPT</p>{prose}</section>',
                 f'<div class="text-widget"><p>KEPT</p>{prose}</div>', '<h2 class="related">KEPT</h2>', "<p>by <label>KEPT</label></p>",
                 "<p>so <math><mi>KEPT</mi></math></p>", "<dir><li>KEPT</li></dir>", "<object><p>KEPT</p></object>",
                 '<section id="chemical-reactions"><p>KEPT</p></section>'):
        assert "KEPT" in text_density.Page(f"<body><article><h1>T</h1>{prose}{part}{prose}</article></body>").main_text()
    whole = f'<div class="recipe cookies"><h2>KEPT</h2>{prose * 3}</div>'
    assert "KEPT" in text_density.Page(f"<body><article><h1>T</h1>{whole}</article></body>").main_text()
    assert "KEPT" in text_density.Page(f'<body><article><h1>T</h1><div class="related">KEPT {prose * 3}</div></article></body>').main_text()
    for gone in ('<div class="share-bar">GONE</div>', '<div class="cookie-notice">GONE</div>', '<div id="newsletter">GONE</div>',
                 '<ul class="related-links"><li><a href=/x>GONE</a></li></ul>', "<div class='ad ad-top'>GONE</div>"):
        assert "GONE" not in text_density.Page(f"<body><article><h1>T</h1>{prose}{gone}{prose}</article></body>").main_text()


@pytest.mark.parametrize("part", ["by <label>K</label> and more", "so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds",
                                  "an <x-term>own element</x-term> here", "is <output>3</output> of <picture><img src=a></picture> it"])
def test_what_flows_in_a_line_stays_in_its_block(part):
    prose = "<p>" + "words of plain prose " * 12 + "</p>"
    lines = text_density.Page(f"<body><article><h1>T</h1><p>{part}</p>{prose}</article></body>").main_text().split("\n")
    assert len(lines) == 3 and lines[1].split()[0] == part.split()[0] and lines[1].split()[-1] == part.split()[-1].replace("</picture>", "")


def plain_choice(root):
    """The chosen nodes of a tree of (tag, [text or child]), written from the definition."""
    nodes = []

    def walk(node, up, in_link):
        me = {"tag": node[0], "up": up, "c": 0, "lc": 0, "t": 0, "lt": 0, "kids": []}
        nodes.append(me)
        for x in node[1]:
            if isinstance(x, str):
                me["c"] += len(x)
                me["lc"] += len(x) * (in_link or node[0] == "a")
            else:
                kid = walk(x, me, in_link or node[0] == "a")
                me["kids"].append(kid)
                for k in ("c", "lc", "t", "lt"):
                    me[k] += kid[k]
                me["t"] += 1
                me["lt"] += kid["tag"] == "a"
        return me

    body = walk(root, None, False)
    for x in nodes:
        x["d"] = 0.0
        if x["c"]:
            c, lc, t, lt = x["c"], max(x["lc"], 1), max(x["t"], 1), max(x["lt"], 1)
            base = math.log(c / max(c - x["lc"], 1) * x["lc"] + body["lc"] / body["c"] * c + math.e)
            x["d"] = c / t * math.log(c / lc * t / lt) / math.log(base) if base > 1 else c / t * math.log(c / lc * t / lt)
    for x in nodes:
        x["sum"] = sum(k["d"] for k in x["kids"])
    best = max(nodes, key=lambda x: (x["sum"], x["c"]))
    path, x = [], best
    while x is not None:
        path.append(x["d"])
        x = x["up"]
    out = []
    for x in nodes:
        up = x["up"]
        x["in"] = x is best or (x is not body and x["c"] > 0 and x["d"] >= min(path)) or (up is not None and up["in"])
        out.append(x["in"])
    return out


def test_density_sums_by_a_plain_tree():
    rng = random.Random(4)

    def tree(depth):
        kids = []
        for _ in range(rng.randint(1, 5)):
            k = rng.random()
            if depth and k < 0.5:
                kids.append(tree(depth - 1))
            elif k < 0.65:
                kids.append(("a", ["l" * rng.randint(1, 20)]))
            else:
                kids.append(("p", ["w" * rng.randint(1, 300)]))
        return ("div", kids)

    def shown(node):
        return f"<{node[0]}>" + "".join(x if isinstance(x, str) else shown(x) for x in node[1]) + f"</{node[0]}>"

    chosen = 0
    for _ in range(200):
        root = ("body", [tree(3) for _ in range(3)])
        got = text_density.Page(shown(root)).content()[1:]
        assert got == plain_choice(root)
        chosen += sum(got) < len(got)
    assert chosen > 50


# --- language ----------------------------------------------------------------------------


def brute(emit, start, move):
    k = len(start)
    total, marginal, pairs = 0.0, np.zeros_like(emit), np.zeros((k, k))
    for y in itertools.product(range(k), repeat=len(emit)):
        v = np.exp(start[y[0]] + sum(emit[t, y[t]] for t in range(len(y))) + sum(move[a, b] for a, b in itertools.pairwise(y)))
        total += v
        for t, a in enumerate(y):
            marginal[t, a] += v
        for a, b in itertools.pairwise(y):
            pairs[a, b] += v
    return marginal / total, pairs / total


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(1)
    emit = [rng.normal(size=(n, 3)) for n in (4, 1, 0, 6, 3)]
    start, move, pairs = rng.normal(size=3), rng.normal(size=(3, 3)), np.zeros((3, 3))
    got = crf_languages.forward_backward(emit, start, move, pairs)
    want = [brute(e, start, move) for e in emit if len(e)]
    assert all(np.allclose(p, w) for p, (w, _) in zip([p for p in got if len(p)], want, strict=True))
    assert np.allclose(pairs, sum(w for _, w in want))


ENGLISH = "the house of the man and this thing with that in which they were working"
GERMAN = "das haus und der mann ist nicht mit einer sache auf die sich alles bezieht"


def test_languages_of_words_and_texts(spark):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        lang, base = ("en", ENGLISH) if i % 2 else ("de", GERMAN)
        rows.append((i, " ".join(rng.choices(base.split(), k=25)), lang))
    rows += [(1000, None, "en"), (1001, "", None), (1002, "12 34 ½ !", "de"), (1003, "the and with this", None), (None, "und der mann ist", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    field = crf_languages.learn(docs, rows_per_language=40)
    assert field.labels == ["de", "en"]
    out = crf_languages.identify(docs.withColumn("score", docs.lang), field, chars_at_once=300, words_kept=10)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:120])
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "en", "de"]
    mixed = field.read([f"{ENGLISH} {GERMAN}"], crf_languages.Memory(2))[0].argmax(axis=1)
    n = len(ENGLISH.split())
    assert (mixed[:n] == 1).mean() > 0.9 and (mixed[n:] == 0).mean() > 0.9


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert crf_languages.identify(docs, crf_languages.learn(docs)).first().lang_pred == "und"
    assert crf_languages.identify(docs.limit(0), crf_languages.learn(docs.limit(0))).count() == 0


def test_held_out_rows_are_crc32(spark):
    import zlib

    got = spark.range(50).select("id", crf_languages.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_letters_beside_other_signs_are_words():
    assert crf_languages.words_of("m² x_y 12ab ½ Große") == ["m", "x", "y", "ab", "große"]
    assert crf_languages.words_of(None) == [] and crf_languages.words_of("² 3") == []


def test_every_label_is_learned_also_of_long_rows(spark):
    rows = [(i, ("alpha beta " if i % 2 else "gamma delta ") * 4000, "long" if i % 2 else "other") for i in range(12)]
    docs = spark.createDataFrame([*rows, (50, "m²", None)], "doc_id long, text string, lang string").withColumn("_told", F.lit(3))
    field = crf_languages.learn(docs, rows_per_language=4, most_chars=300)
    assert field.labels == ["long", "other"]
    out = crf_languages.identify(docs, field)
    assert out.columns == ["doc_id", "text", "lang", "_told", "lang_pred", "score"]
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].lang_pred == lang and got[i]._told == 3 for i, _, lang in rows) and got[50].lang_pred != "und"


def test_a_column_named_like_the_coded_struct_stays(spark):
    docs = spark.createDataFrame([(1, "some text", 7)], "doc_id long, text string, _coded int")
    assert viterbi_pieces.encode(docs, MODEL).first()._coded == 7
