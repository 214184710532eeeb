"""Each operator against a plain version, and on rows that are odd in every column."""

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlens.llm import (
    bpe,
    decontaminate,
    html_text,
    jaccard_join,
    lm_score,
    quality_rules,
    secret_scan,
    sharding,
    suffix_array,
    suffix_dedup,
    warc,
)
from eventlens.llm import queries as Q
from eventlens.llm.common import new_dir

BENCHMARK = "item_id bigint, text string"


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=repr)


# ---- 1: language models ----------------------------------------------------------------

def test_losses_equal_a_plain_model(spark, docs, words):
    texts = [(i, " ".join(words(i % 7, 40 + i))) for i in range(20)] + [(20, ""), (21, None)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i == 6)) for i in range(15)],
                                   "doc_id bigint, quality int, toxic int")
    model = lm_score.train(docs(*texts), labels, word_bits=22, pair_bits=22)
    got = {r.doc_id: r for r in lm_score.score(docs(*texts), model).collect()}
    good = {i for i in range(15) if i % 3 == 0 and i != 6}
    word, pair, start = [Counter(), Counter()], [Counter(), Counter()], [0, 0]
    for i, t in texts:
        w, k = brute.words(t), int(i not in good)
        word[k].update(w)
        pair[k].update(zip([None, *w], w))
        start[k] += bool(w)
    import math
    total = [sum(c.values()) for c in word]
    for i, t in texts:
        w = brute.words(t)
        if not w:
            assert (got[i].n_tokens, got[i].score) == (0, None)
            continue
        means = []
        for k in (0, 1):
            scale = total[0] / total[k]
            losses = []
            for v, x in zip([None, *w], w):
                plain = (word[k][x] * scale + 0.1) / (total[0] + 0.1 * 2**22)
                seen = start[k] if v is None else word[k][v]
                p = 0.6 * pair[k][v, x] / seen + 0.4 * plain if seen else plain
                losses.append(-math.log(p))
            means.append(sum(losses) / len(losses))
        assert got[i].target_loss == pytest.approx(means[0], rel=1e-6)
        assert got[i].score == pytest.approx(means[0] - means[1], rel=1e-6)


def test_scores_tell_good_from_bad_documents_that_were_held_out(table):
    d, labels = table("documents"), table("labels")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = lm_score.train(d, labels.filter(~held))
    found = (lm_score.score(d.join(labels.filter(held), "doc_id"), model).join(labels, "doc_id")
             .filter("toxic = 0").select("quality", "score").collect())
    good = [r.score for r in found if r.quality]
    bad = [r.score for r in found if not r.quality]
    assert good and bad
    better = sum(g < b for g in good for b in bad) / (len(good) * len(bad))
    assert better > 0.7


# ---- 2: suffix arrays ------------------------------------------------------------------

@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_repeats_equal_brute_force(docs, hot):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdeé ") for _ in range(900))
    rows = [(1, text), (2, "x" + text[100:500] + "y" * 90), (3, text), (4, "z" * 200), (5, None),
            (6, text[:39]), (7, text[300:340]), (8, text[:450] + "Q" + text[451:]), (None, "ab" * 60),
            (9, "".join(rng.choice("ab") for _ in range(800)))]
    got = suffix_dedup.remove_repeats(docs(*rows), length=40, gram=12, hot=hot)
    assert ordered(tuple(r[:5]) for r in got.drop("kept", "spans").collect()) == ordered(
        brute.without_repeats(rows, 40))


@given(st.lists(st.binary(max_size=60), max_size=4), st.integers(1, 30))
@settings(max_examples=150, deadline=None)
def test_suffix_arrays_equal_sorting(parts, times):
    text = [b + 2 for part in parts for b in part * times] + [0]
    assert suffix_array.induced_sort(np.array(text)).tolist() == sorted(
        range(len(text)), key=lambda k: text[k:])


def test_common_texts_and_copies_of_a_text_with_a_shared_passage(docs):
    rng = random.Random(6)
    passage, a, b = ("".join(rng.choice("abcdefgh ") for _ in range(80)) for _ in range(3))
    rows = [(k, a) for k in range(30)] + [(None, b + passage), (41, b + passage), (42, passage + "q" * 39)]
    rows += [(50 + k, f"{k}" * 41 + passage[:45]) for k in range(3)]
    got = suffix_dedup.remove_repeats(docs(*rows), length=40, gram=12)
    assert ordered(tuple(r[:5]) for r in got.drop("kept", "spans").collect()) == ordered(
        brute.without_repeats(rows, 40))


def test_repeats_of_the_given_table(spark, table):
    d = table("documents")
    got = suffix_dedup.remove_repeats(d).drop("kept", "spans").collect()
    assert ordered(tuple(r) for r in got) == ordered(brute.without_repeats(rows_of(d), 400))


# ---- 3: similar documents --------------------------------------------------------------

def near_copies(words, groups, copies):
    rows, i = [], 0
    for g in range(groups):
        base = words(g, 120)
        for c in range(copies):
            rng, w = random.Random(g * 1000 + c), list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 6])):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
            rows.append((i, " ".join(w) + " the same line stands in all of these texts here"))
            i += 1
    return rows


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_components_equal_brute_force(docs, words, size, percent):
    rows = near_copies(words, 6, 25) + [(900, "one two"), (901, "ONE two"), (902, None), (903, " "),
                                        (904, "one"), (905, "one")]
    got = jaccard_join.cluster(docs(*rows), size=size, percent=percent).collect()
    assert ordered(tuple(r) for r in got) == ordered(brute.components(rows, size, percent))


def test_trees_in_chunks_lose_no_pair(spark, words):
    import numpy as np

    from eventlens.llm import signature_tree as S
    rng = np.random.default_rng(1)
    sets = []
    for g in range(12):
        base = rng.integers(1, 2**63, rng.integers(30, 200), dtype=np.uint64)
        for _ in range(6):
            s = base.copy()
            s[rng.integers(0, len(s), rng.integers(0, 12))] = rng.integers(1, 2**63, dtype=np.uint64)
            sets.append(np.unique(s))
    frame = spark.createDataFrame(
        [(k, len(s), s.view(np.int64).tolist(), bytearray(S.bitmap(s, S.width_for(len(s))).tobytes()))
         for k, s in enumerate(sets)], "node bigint, n bigint, elements array<bigint>, bitmap binary")
    lists = frame.select(F.lit(7).cast("bigint").alias("element"), "node", F.col("node").alias("component"))
    found = jaccard_join.candidate_pairs(lists, frame, 85, chunk=10)
    got = {tuple(r) for r in jaccard_join.similar(found, frame, 85).collect()}
    wanted = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
              if 100 * len(x := np.intersect1d(sets[i], sets[j])) >= 85 * (len(sets[i]) + len(sets[j]) - len(x))}
    assert got == wanted and len(wanted) > 50


def test_repeated_rows_are_one_set(spark, docs, words):
    rows = [(None, t) for _, t in near_copies(words, 2, 3) for _ in range(4)]
    found = jaccard_join._relatives(docs(*rows), 4, 85)
    assert found.sets.count() == found.sets.select("node").distinct().count() > 0
    assert ordered(tuple(r) for r in jaccard_join.cluster(docs(*rows)).collect()) == ordered(
        brute.components(rows, 4, 85))


def test_links_inside_a_component_are_counted(docs, words):
    rows = near_copies(words, 3, 5) + [(900, "alone here"), (901, None)]
    rows += [rows[0], (902, rows[0][1])]
    sets = []
    for _, t in rows:
        w = brute.words(t)
        sets.append({tuple(w[k:k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set()))
    wanted = [(i, sum(k != j and bool(a | b) and 100 * len(a & b) >= 85 * len(a | b)
                      for j, b in enumerate(sets)))
              for k, ((i, _), a) in enumerate(zip(rows, sets, strict=True))]
    assert ordered(tuple(r) for r in jaccard_join.link_counts(docs(*rows)).collect()) == ordered(wanted)
    assert jaccard_join.links(docs(*rows)).filter("a >= b").isEmpty()


def test_one_of_each_component_stays_without_ids(docs, words):
    plain, other, near = (" ".join(words(k, 60)) for k in (21, 22, 23))
    rows = [(None, plain), (None, plain), (None, other), (None, near), (None, near + " more"),
            (4, "held " + other), (None, None), (None, " "), (5, other + " held"), (5, " ".join(words(24, 30)))]
    kept = [(r.doc_id, r.text) for r in jaccard_join.keep_one(docs(*rows)).collect()]
    assert kept.count((None, plain)) == 1, "alone, copies go"
    assert (4, "held " + other) in kept and (None, other) not in kept and (5, other + " held") not in kept
    assert sum(r in kept for r in [(None, near), (None, near + " more")]) == 1
    assert (None, None) in kept and (None, " ") in kept and rows[-1] in kept
    assert len(kept) == 6


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 101)], "a bigint, b bigint")
    got = {r.node: r.component for r in jaccard_join.components(edges).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


# ---- 4: main text ----------------------------------------------------------------------

PAGE = """<html><head><title>no</title><style>p{}</style></head><body><header>Site</header>
<nav><ul><li><a href=x>Home</a></li><li><a href=y>News of the day</a></li></ul></nav>
<div class="cookie-notice">We use cookies and would like you to agree to all of them now</div>
<article><h1>A &amp; B</h1><p>First   long paragraph of the article with many words in it<br>goes on.
<p>Short.<p>Last long paragraph of the article &mdash; with <b>bold</b> words and a &lt;tag&gt; in it.
<script>var a = "<p>no</p>";</script><form><p>Your mail</p><button>Go</button></form></article>
<aside><p>Related: another article that nobody asked for but that is long</p></aside>
<div id="comments"><p>A reader has a long opinion about this article and writes it down</p></div>
<footer>&copy; someone</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == (
        "A & B First long paragraph of the article with many words in it goes on. Short. "
        "Last long paragraph of the article — with bold words and a <tag> in it.")


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("  ", ""), ("just text", "just text"), ("<p>one</p>", "one"),
    ("<nav>menu</nav>", ""), ("<p>open <b>tags <i>everywhere", "open tags everywhere"),
    ("</div></p><p>a &amp;amp; b", "a &amp; b"), ("<!-- <p>no</p> --><p>yes", "yes"),
])
def test_main_text_of_odd_pages(html, text):
    assert html_text.main_text(html) == text


LONG = "A long paragraph of the article with very many words in it that goes on and on to its end. " * 3


@pytest.mark.parametrize("html, parts", [
    ("<article><h1>Title</h1><p>Lead</p><div class=body><p>{0}</p><p>{0}</p></div></article>", ["Title", "Lead"]),
    ("<div><div>" + "<p>{0}" * 6 + "</div><div><p>{0}<p>{0}Second</div></div>", ["Second"]),
    ("<h1>Title</h1><div><p>{0}<p>{0}</div><nav>menu</nav>", ["Title"]),
    ("<div><p>Before<blockquote>{0}{0}</blockquote><p>After</div>", ["Before", "After"]),
    ("<div class='page no-sidebar'><p>{0}<p>End</div>", ["A long", "End"]),
    ("<div class='has-sidebar menu-open'><p class=share-price>{0}<p>End</div>", ["A long", "End"]),
    ("<div class=widget><p>{0}<p>{0}</div><p>Foot", ["A long"]),
])
def test_no_part_of_an_article_is_dropped(html, parts):
    got = html_text.main_text(html.format(LONG))
    assert all(p in got for p in parts), got
    assert got.count("goes on and on") == html.count("{0}") * 3


def test_whole_names_still_drop_adverts():
    got = html_text.main_text(f"<div><p>{LONG}<p>{LONG}<div class=ad>Buy</div><ul id=comment-list><li>Me</ul></div>")
    assert "Buy" not in got and "Me" not in got and "menu" not in got


def test_extract_returns_every_page(spark, table):
    pages = table("pages")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for p in pages.collect():
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        inner = re.sub(r"<br>", " ", re.sub(r"</?b>", "", article))
        import html as H
        blocks = [" ".join(H.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[p.page_id].text == " ".join(b for b in blocks if b)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


# ---- 5: BPE ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizers():
    public = pytest.importorskip("public_tokenizers")
    library = pytest.importorskip("tokenizers")
    path = public.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        ours = bpe.Tokenizer(bpe.Merges.from_json(file.read()))
    return ours, library.Tokenizer.from_file(path)


def test_ids_and_texts_equal_the_library(tokenizers):
    ours, theirs = tokenizers
    rng = random.Random(9)
    alphabet = "aaab -=_  \n\t\r'sdé漢字́\x1c\x85 😀<|>0123٣Ⅷ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([3, 20, 200]))) for _ in range(400)]
    texts += ["", "<|endoftext|>", "a<|endoftext|><|endof", "=" * 9000, "ab" * 5000, " " * 3000,
              "".join(rng.choice("aeiouthsnr") for _ in range(20_000))]
    for text in texts:
        ids = ours.encode(text)
        assert ids == theirs.encode(text, add_special_tokens=False).ids
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)
    for _ in range(200):
        ids = [rng.randrange(50_300) for _ in range(20)]
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_a_stream_holds_little_and_gives_the_same_tokens(tokenizers):
    merges = tokenizers[0].merges
    rng = random.Random(4)
    data = bytes(rng.choice(b"-=aeth") for _ in range(60_000))
    encoder, out, held = bpe.Encoder(merges, step=512), [], 0
    for at in range(0, len(data), 777):
        out += encoder.feed(data[at:at + 777])
        held = max(held, len(encoder.held))
    assert [*out, *encoder.flush()] == merges.merge(data)
    assert held <= 3 * 512 + merges.lookahead


def test_lookahead_of_a_small_list():
    vocab = {c: i for i, c in enumerate(bpe.byte_alphabet())}
    for t in ("bc", "ab"):
        vocab[t] = len(vocab)
    # bc wins over ab, so an a followed by b waits for one more byte.
    merges = bpe.Merges(vocab, ["b c", "a b"])
    assert [merges.tokens[i] for i in merges.merge(b"abcab")] == [b"a", b"bc", b"ab"]
    assert merges.lookahead == 2
    with pytest.raises(ValueError):
        bpe.Merges(vocab, ["ab c"])


def test_decoder_holds_open_characters(tokenizers):
    merges = tokenizers[0].merges
    decoder, out = bpe.Decoder(merges), []
    for byte in "é漢".encode():
        out.append(decoder.feed([merges.bytes_ids[byte]]))
    assert out == ["", "é", "", "", "漢"]


def test_digests(docs, tokenizers):
    rows = [(1, "one two <|endoftext|> three"), (2, None), (3, ""), (None, "x"), (1, "é" * 500)]
    ours, theirs = tokenizers
    got = bpe.digests(docs(*rows), Q.tokenizer_path()).collect()
    wanted = []
    for i, t in rows:
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        text = theirs.decode(ids, skip_special_tokens=False)
        wanted.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(text.encode()).hexdigest()))
    assert ordered(map(tuple, got)) == ordered(wanted)


# ---- 6: shards -------------------------------------------------------------------------

def test_shards_are_even_and_match_the_mixture(docs, spark):
    rng = random.Random(2)
    rows = [(i, "t" * (i % 9), "big" if rng.random() < 0.5 else f"s{i % 5}") for i in range(2003)]
    frame = docs(*rows)
    got = sharding.assign(sharding.summary_rows(frame), "doc_id", "source", 24).collect()
    sizes, per = Counter(r.shard for r in got), Counter((r.shard, r.source) for r in got)
    assert len(got) == 2003 and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    for source, n in Counter(r[2] for r in rows).items():
        assert all(abs(per[shard, source] - n / 24) <= 2 for shard in range(24))
    texts = dict((i, t) for i, t, _ in rows)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id]) + 8
               for r in got)
    again = sharding.assign(sharding.summary_rows(frame.repartition(7)), "doc_id", "source", 24).collect()
    assert ordered(map(tuple, again)) == ordered(map(tuple, got))


def test_sharding_has_no_python(docs):
    plan = sharding.assign(sharding.summary_rows(docs((1, "a"))), "doc_id", "source", 3)
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().toString())


def test_write_shards(spark, odd_docs):
    path = new_dir(spark, "shards")
    sharding.write_shards(odd_docs, path, 5)
    back = spark.read.parquet(path)
    assert back.count() == odd_docs.count()
    assert back.groupBy("shard").count().agg(F.max("count") - F.min("count")).first()[0] <= 1


# ---- 7: secrets ------------------------------------------------------------------------

def test_secrets_are_found_and_cut_out(docs, words):
    rng = random.Random(3)
    rows, truth = [], {}
    for i in range(120):
        w = words(i, 80)
        if i % 3 == 0:
            truth[i] = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            w.insert(i % 70, f'token = "{truth[i]}"')
        if i % 4 == 0:
            w.insert(i % 50, "".join(rng.choice("0123456789") for _ in range(16)))
        rows.append((i, " ".join(w)))
    frame = docs(*rows)
    got = secret_scan.findings(frame).collect()
    assert {r.doc_id: r.candidate for r in got} == truth
    texts = dict(rows)
    assert all(texts[r.doc_id][r.start:r.start + r.n_chars] == r.candidate for r in got)
    clean = {r.doc_id: r for r in secret_scan.redact(frame).collect()}
    for i, t in texts.items():
        wanted = t.replace(truth[i], secret_scan.MARK) if i in truth else t
        assert (clean[i].text, clean[i].n_chars) == (wanted, len(wanted))


def test_forest_holds_out(docs, words):
    rng = random.Random(6)
    texts = []
    for i in range(400):
        w = words(i, 30)
        kind = i % 4
        digits = "".join(rng.choice("0123456789abcdef" if kind < 2 else "0123456789") for _ in range(32))
        before = ("secret: ", "commit ", "number ", "token = ")[kind]
        texts.append((i, " ".join(w[:15]) + f" {before}{digits} " + " ".join(w[15:])))
    rows = secret_scan.features(secret_scan.candidates(docs(*texts))).cache()
    labelled = secret_scan.labelled(rows)
    train, test = labelled.randomSplit([0.7, 0.3], seed=1)
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    to = VectorAssembler(inputCols=list(secret_scan.FEATURES), outputCol="features")
    model = RandomForestClassifier(numTrees=10, seed=1).fit(to.transform(train))
    found = model.transform(to.transform(test))
    assert found.filter("label = prediction").count() >= 0.9 * found.count() > 0


def test_secret_scan_has_no_python(docs):
    plan = secret_scan.features(secret_scan.candidates(docs((1, "a"))))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().toString())


# ---- 8: archives -----------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, key string"


def test_archives_round_trip(spark):
    rows = [(1, "http://a/é b\r\nx", "<p>same</p>", "k"), (5, None, "<p>same</p>", "k"), (3, "u", "<p>same</p>", "k"),
            (4, "", None, "k"), (2, "u", "", "k"), (7, "u", "é\r\n\r\nx" * 9000, "k"), (None, "u", "alone", "k"),
            (9, "u", "twice", "k"), (9, "u", "twice", "k")]
    pages = spark.createDataFrame(rows, PAGES)
    got = warc.archive(pages).collect()
    best = {}
    for i, _, h, _ in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    wanted = []
    for i, url, h, _ in rows:
        response = i == best[h or ""] or best[h or ""] == -1
        wanted.append((i, url or "", len((h or "").encode()), warc.digest_of((h or "").encode()),
                       "response" if response else "revisit", None if response else best[h or ""],
                       (h or "").encode() if response else None))
    assert ordered((*r[:6], None if r.payload is None else bytes(r.payload)) for r in got) == ordered(wanted)


def test_selected_records_are_read_by_their_index(spark):
    pages = spark.createDataFrame([(k, f"u{k}", f"<p>{k}</p>" * 50, "") for k in range(60)], PAGES)
    folder = new_dir(spark, "warc")
    index = warc.write(pages.repartition(3), folder)
    some = index.filter("page_id % 7 = 0")
    assert {r.page_id: bytes(r.payload).decode() for r in warc.read(some, folder).collect()} == {
        k: f"<p>{k}</p>" * 50 for k in range(0, 60, 7)}
    entry = index.orderBy("page_id").first()
    import pyarrow.fs as pafs
    fs, base = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{base}/{entry.file}") as file:
        raw = gzip.decompress(file.read_at(entry.length, entry.offset))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: u0\r\n")
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"<p>0", b"<p>1"))


def test_ranges_are_coalesced():
    got = list(warc.coalesce_ranges([(0, 10), (10, 5), (40, 5), (200, 10)], gap=30, longest=100))
    assert got == [(0, 45, [(0, 10), (10, 5), (40, 5)]), (200, 210, [(200, 10)])]
    assert [x[:2] for x in warc.coalesce_ranges([(0, 60), (60, 60)], longest=100)] == [(0, 60), (60, 120)]


# ---- 9: benchmark passages -------------------------------------------------------------

def test_matches_equal_brute_force(spark, docs, words):
    rng = random.Random(8)
    items = [(k, " ".join(words(100 + k, n))) for k, n in enumerate((3, 6, 9, 15, 24, 40, 60))]
    rows = []
    for i in range(120):
        w, inside = words(i, 90), list(rng.choice(items)[1].split())
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8, 14])):
            at = rng.randrange(len(inside))
            rng.choice([lambda: inside.insert(at, "new"), lambda: inside.__setitem__(at, "changed"),
                        lambda: len(inside) > 1 and inside.pop(at)])()
        at = rng.randrange(90)
        rows.append((i, " ".join(w[:at] + inside + w[at:]).upper() if i % 2 else " ".join(w[:at] + inside + w[at:])))
    benchmark = spark.createDataFrame([*items, (50, None), (51, " "), (0, items[0][1])], BENCHMARK)
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(docs(*rows), benchmark).collect()}
    wanted = {(i, k) for i, t in rows for k, x in items if brute.contains(t, x, 0.2)}
    assert set(got) == wanted and len(wanted) > 60
    for (i, k), r in got.items():
        run = brute.words(dict(rows)[i])[r.start_word:r.end_word]
        assert brute.edit_distance(brute.words(dict(items)[k]), run) == r.distance


def test_blocks_of_the_benchmark_give_the_same(docs, table):
    whole = decontaminate.matches(table("documents"), table("benchmark"))
    parts = decontaminate.matches(table("documents"), table("benchmark"), block_bytes=4000)
    assert ordered(map(tuple, whole.collect())) == ordered(map(tuple, parts.collect()))


@pytest.mark.parametrize("m", [100, 200, 500])
def test_long_items_are_found_at_the_largest_distance(words, m):
    found = 0
    for k in range(8):
        rng, item = random.Random(k), words(m + k, m)
        run = list(item)
        for j in range(m // 5):
            run.insert(rng.randrange(1, len(run)), f"put{j}")
        text = " ".join([*words(k + 1, 30), *run, *words(k + 2, 30)])
        got = list(decontaminate.Items([1], [" ".join(item)]).match(
            decontaminate.W.words_of(pa.array([text]))))
        found += bool(got) and got[0][4] <= m // 5
    assert found == 8


# ---- 10: quality rules -----------------------------------------------------------------

def test_base_figures_equal_brute_force(docs, words):
    rows = [(1, " ".join(words(1, 50))), (2, "a b c d e f g h\n" * 4), (3, None), (4, "\n\n x \n x \n x"),
            (5, "#* $%&|<> é\x0b漢\x0cx y\x85z\n"), (6, " ".join(["q"] * 30)),
            (7, " ".join(words(2, 30)) + "\n" + " ".join(words(2, 30)[5:20])), (None, "A a A a A a A a a A")]
    got = {r.doc_id: r for r in quality_rules.judge(docs(*rows)).collect()}
    for i, t in rows:
        r, base = got[i], brute.base_figures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 20 or 100 * base[4] > 30 * base[0])


def test_frequent_lines_deplete_a_document(docs, words):
    menu = "home news sport weather\nall rights are reserved by us\nsubscribe to our letter today and tomorrow"
    rows = [(i, menu.upper() + "\n" + "\n".join(" ".join(words(i * 10 + k, 12)) for k in range(4)), "h")
            for i in range(60)]
    rows += [(100, menu + "\n" + menu + "\nown words", "h"), (101, menu + "\nfour words of its own", "other")]
    copy = "\n".join(" ".join(words(999 + k, 12)) for k in range(5))
    rows += [(200 + k, copy, "h") for k in range(40)]
    got = {r.doc_id: r for r in quality_rules.judge(docs(*rows), max_share=0.3).collect()}
    assert not got[100].kept and got[100].n_removed_words == got[100].n_words - 2
    assert got[101].kept, "the line is rare on that host"
    assert all(got[i].kept for i in range(60))
    assert all(got[200 + k].kept for k in range(40)), "copies are not boilerplate"


def test_documents_that_share_their_smallest_line_are_counted_each(docs, words):
    shared = min((" ".join(words(k, 12)) for k in range(3000, 3400)),
                 key=lambda x: quality_rules.line_key(x.encode()))
    rows = [(i, shared + "\n" + " ".join(words(7000 + i, 12)), "h") for i in range(60)]
    smallest = [min(quality_rules.features_of(t)[6]) for _, t, _ in rows]
    assert smallest.count(quality_rules.line_key(shared.encode())) > 40
    got = quality_rules.judge(docs(*rows), min_docs=50).collect()
    assert [r.n_removed_words for r in got] == [12] * 60


# ---- odd rows, for all -----------------------------------------------------------------

def test_odd_rows_are_defined_for_all(spark, odd_docs, tokenizers):
    n = odd_docs.count()
    labels = spark.createDataFrame([(1, 1, None), (1, None, 0), (None, 1, 0), (6, 0, 1)],
                                   "doc_id bigint, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, "nothing like this text stands anywhere")], BENCHMARK)
    scored = lm_score.cross_entropy_difference(odd_docs, labels).collect()
    assert len(scored) == n and all((r.score is None) == (r.n_tokens == 0) for r in scored)
    assert ordered(tuple(r[:5]) for r in suffix_dedup.remove_repeats(odd_docs).drop("kept", "spans").collect()) \
        == ordered(brute.without_repeats(rows_of(odd_docs), 400))
    assert ordered(tuple(r) for r in jaccard_join.cluster(odd_docs).collect()) == ordered(
        brute.components(rows_of(odd_docs), 4, 85))
    assert bpe.digests(odd_docs, Q.tokenizer_path()).count() == n
    shards = sharding.assign(odd_docs, "doc_id", "source", 4)
    assert shards.count() == n and shards.columns[-2:] == ["shard", "slot"]
    assert secret_scan.findings(odd_docs).count() == 0
    assert secret_scan.redact(odd_docs).count() == n
    assert decontaminate.matches(odd_docs, benchmark).count() == 0
    assert quality_rules.judge(odd_docs).count() == n
    for stage in (quality_rules.keep_good, jaccard_join.keep_one, secret_scan.redact,
                  lambda d: decontaminate.drop_contaminated(d, benchmark)):
        assert stage(odd_docs).columns == odd_docs.columns
    assert quality_rules.keep_good(odd_docs).count() == 5  # the plain text's four rows, the long one
    # Rows of a kept id stay: 1 twice, 3 to 8, and 8 again; copies under other ids go.
    assert Counter(r.doc_id for r in jaccard_join.keep_one(odd_docs).collect())[1] == 2


def test_empty_tables_give_empty_results(spark, docs):
    none = docs().limit(0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    benchmark = spark.createDataFrame([], BENCHMARK)
    pages = spark.createDataFrame([], PAGES)
    for df in (lm_score.cross_entropy_difference(none, labels), suffix_dedup.remove_repeats(none),
               jaccard_join.cluster(none), html_text.extract(pages), bpe.digests(none, Q.tokenizer_path()),
               sharding.assign(none, "doc_id", "source", 4), secret_scan.findings(none),
               warc.archive(pages), decontaminate.matches(none, benchmark), quality_rules.judge(none),
               secret_scan.redact(none), jaccard_join.keep_one(none)):
        assert df.count() == 0
    assert decontaminate.matches(docs((1, "some text")), benchmark).count() == 0
