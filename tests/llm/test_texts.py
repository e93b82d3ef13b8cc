"""Personal data, page text, language, scoring."""

from __future__ import annotations

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import AWKWARD, EXTRA
from novalake.llm import boosting, context_tree, html_text, language, lm_scoring, markup, pii
from novalake.llm.queries import op3_personal_data, op4_html_text, op8_language, op10_context_tree

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base(text):
    found = [(m.start(), "email", m.end()) for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), "ip", m.end()))
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), "card", m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[1])))


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("a@.1 2+-(9)b%é\n0"), max_size=70))
def test_base_spans(text):
    assert pii.base_spans(text) == base(text)


def test_long_local_part_and_long_number():
    text = "x" * 3000 + "@" + "y" * 50 + ".org " + "7" * 9000 + ".1.1.1"
    assert pii.base_spans(text) == [(0, "email", 3055)]


def test_personal_data_query(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")["text"]
    got = op3_personal_data(spark, SF).toPandas().set_index("doc_id")
    assert sorted(got.index) == sorted(docs.index)
    for doc, row in got.iterrows():
        spans = base(docs[doc])
        kinds = Counter(k for _, k, _ in spans)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [kinds[k] for k in pii.KINDS]
        assert row["base_sha256"] == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert set(listed(spans).split(",")) - {""} <= set(row["spans"].split(","))


@pytest.fixture(scope="module")
def detector(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_trees_add_what_the_patterns_miss(detector):
    missed = {"phone (386) 555-1832 or": "phone", "call 212-555-0123 please": "phone",
              "mail me john.smith [at] example [dot] com now": "email", "a 7536784127813050 4845168114407329 b": "card"}
    for text, kind in missed.items():
        assert kind in [k for _, k, _ in detector.spans(text)], text


def test_trees_leave_ordinary_numbers_alone(detector):
    for text in ("version 1.2.3 of", "on 2024-01-15 we", "pages 1024-2048", "look at it. then go", "it cost 1,250.50 in 1999"):
        assert detector.spans(text) == [], text


def quadratic_spans(detector, text):
    """Each proposal compared with every span."""
    def apart(spans, start, end):
        return all(e <= start or end <= s for s, _, e in spans)

    base, added = pii.base_spans(text), []
    free = [s for s in pii.proposals(text) if apart(base, s[0], s[2])]
    likely = [detector.trees.probability(np.array([pii.features(text, *s)]))[0] for s in free]
    for p, n in sorted((-p, n) for n, p in enumerate(likely)):
        start, kind, end = free[n]
        if -p >= detector.least[pii.KINDS.index(kind)] and apart(added, start, end):
            added.append(free[n])
    return sorted(base + added, key=lambda s: (s[0], pii.KINDS.index(s[1])))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([
    "call 212-555-0123 ", "(386) 555-1832", "+1 (212) 555-0123 ", "john.smith [at] example [dot] com ", "a.b@c.org ",
    "10.0.0.1", "10[.]0[.]0[.]1 ", "4111 1111 1111 1111 ", "4111.1111.1111.1111", " at ", "7", " ", "\n", "é", ":"]), max_size=25))
def test_spans_are_those_of_the_plain_way(detector, parts):
    text = "".join(parts)
    assert detector.spans(text) == quadratic_spans(detector, text)


def test_long_texts_take_time_with_their_length(detector):
    begun = time.monotonic()
    lines = "call 212-555-0123 or (386) 555-1832, mail a.b@c.org\n" * 20_000  # 1 MB of proposals
    assert len(detector.spans(lines)) >= 20_000
    for text in ("a" * 500_000 + " " + "a" * 400_000 + "@b.c", "7" * 1_000_000 + ".", "1." * 500_000, "@" * 1_000_000):
        pii.base_spans(text)
    assert time.monotonic() - begun < 60


def test_a_long_text_does_not_take_all_examples(make_docs):
    mail = "write to some{0}.one{0}@example{0}.org or 10.0.0.{0}"
    docs = make_docs([(0, "\n".join(f"+1 212 555 0{n:03}" for n in range(800))),
                      *((n, mail.format(n)) for n in range(1, 60))])
    trained = pii.train(docs, max_examples=600)
    assert trained.trees is not None and min(trained.least[:2]) < 2


def test_redaction_keeps_rows_and_columns(spark, awkward, make_docs, detector):
    got = pii.redact(awkward, detector)
    assert got.schema == awkward.schema and got.count() == len(AWKWARD)
    docs = make_docs([(1, "write to a.b@c.org or 10.0.0.1!"), (2, None)])
    assert sorted((r.text or "", r.n_chars) for r in pii.redact(docs, detector).collect()) == [
        ("", None), ("write to [EMAIL] or [IP]!", 25)]
    assert pii.find(make_docs([]), pii.train(make_docs([]))).count() == 0


def test_detector_without_examples_has_base_spans(awkward):
    small = pii.train(awkward)
    assert small.trees is None and small.spans("a@b.co") == [(0, "email", 6)]


def test_boosting_learns_an_interaction():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(1500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(int)
    model = boosting.fit(x, y)
    fresh = draw.normal(size=(500, 4))
    assert ((model.probability(fresh) > 0.5) == ((fresh[:, 0] > 0) ^ (fresh[:, 1] > 0.3))).mean() > 0.9


PAGES = [(i, f"http://a.b/x{i}", "<div><div>Welcome to the site of all sites</div><div>short" + str(i) + "</div>"
          f"<div>Unique text number {i} of this page</div><div>Home</div><div>About our company</div></div>")
         for i in range(6)]


def test_repeats_within_a_host_go_where_structure_is_silent(spark):
    rows = PAGES + [(7, None, None), (8, "http://c.d/", "<div>Welcome to the site of all sites</div>"),
                    (None, "bad url", "<p>x</p>"), (9, "http://a.b/", ""), (8, "http://c.d/", "<div>Welcome to the site of all sites</div>")]
    df = spark.createDataFrame([(*r, "u") for r in rows], "page_id bigint, url string, html string, host string")
    got = html_text.main_text(df).toPandas()
    texts = Counter(got["text"])
    expected = Counter(f"short{i}\nUnique text number {i} of this page" for i in range(6))
    assert texts == expected + Counter({"": 2, "Welcome to the site of all sites": 2, "x": 1})
    assert (got["n_chars"] == got["text"].str.len()).all()
    assert html_text.main_text(df.limit(0)).count() == 0


def test_copies_and_quotations_stay(spark):
    """The same page under two addresses, and a passage that two of many pages share."""
    quote = "<p>A long passage that two articles of the host quote</p>"
    rows = [(i, f"http://a.b/{i}", PAGES[0][2].replace("0", f"0{i}") + (quote if i < 2 else "")) for i in range(8)]
    rows += [(20, "http://a.b/0?utm_source=x", rows[0][2]), (30, "http://q/1", "<p>All of the text of a mirrored page</p>"),
             (31, "http://q/1?print", "<p>All of the text of a mirrored page</p>")]
    rows += [(40 + i, "http://z/" + str(i), f"<p>{'Same article with another date. ' * 9}</p><p>Day {i}</p>") for i in range(4)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).toPandas()
    got = got.set_index("page_id")["text"]
    passage = "\nA long passage that two articles of the host quote"
    for i in range(8):
        assert got[i] == f"short0{i}\nUnique text number 0{i} of this page" + (passage if i < 2 else "")
    assert got[20] == got[0] and got[30] == got[31] == "All of the text of a mirrored page"
    assert all(got[40 + i].endswith(f"Day {i}") and got[40 + i].startswith("Same article") for i in range(4))


@pytest.mark.parametrize("around", ["<div class='layout sidebar-right'>", "<div id='has-sidebar'>", "<form action=x>"])
def test_most_of_the_page_is_no_noise(around):
    text = "The whole article is in here, whatever the layout is called"
    for page in (f"{around}<article><p>{text}</article><div class=ad>Buy</div>", f"{around}<p>{text}<div class=ad>Buy</div>"):
        blocks = markup.read_blocks(page)
        assert [blocks[n].text for n in html_text.chosen(blocks)[0]] == [text]
    blocks = markup.read_blocks(f"{around}<p>Short</div></form><p>{text}")
    assert [blocks[n].text for n in html_text.chosen(blocks)[0]] == [text]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=9), min_size=1, max_size=5))
def test_sharded_suffixes_find_all_repeats(pages):
    pairs = [(p, tuple(page[n : n + html_text.DEPTH])) for p, page in enumerate(pages) for n in range(len(page))]
    on = defaultdict(set)
    for p, suffix in pairs:
        on[suffix].add(p)
    for first in {s[0] for s in on}:
        mine = sorted(s for s in on if s[0] == first)
        got = html_text.repeated_prefixes(
            [np.array(s) for s in mine], np.array([min(on[s]) for s in mine]), np.array([max(on[s]) for s in mine]))
        for suffix, common in zip(mine, got):
            want = max((n for n in range(1, len(suffix) + 1)
                        if len({p for p, other in pairs if other[:n] == suffix[:n]}) > 1), default=0)
            assert common == want


@pytest.mark.parametrize("page, expected", [
    ("", []), ("a < b", ["a < b"]), ("<p", []), ("<p>x &am", ["x &am"]), ("<!-- x", []), ("<script>foo", []),
    ("<article><p title='a>b'>T&amp;U &#233;</p>", ["T&U é"]), ("<div title=\"abc>d</div><p>e", ["d", "e"]),
    ("<main><p class=ad>Buy<p>Keep<div class='comments'>no</div><form>q</form></main><aside>x</aside>", ["Keep"]),
    ("<article class=comment>c</article><article><header><h1>H</h1></header>x<br>y<b>z</b></article>", ["H", "x yz"]),
    ("<p hidden>a<p style='display: none'>b<p role=alert>c<p>d", ["d"]),
])
def test_page_reader(page, expected):
    blocks = markup.read_blocks(page)
    assert [blocks[n].text for n in html_text.chosen(blocks)[0]] == expected


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("<>/pabdiv \"'=!-&;scripnote"), max_size=80))
def test_any_markup_is_read(page):
    markup.read_blocks(page)


def test_pages_query(spark):
    pages = pd.read_parquet(f"{SF}/pages.parquet").set_index("page_id")["html"]
    got = op4_html_text(spark, SF).toPandas().set_index("page_id")
    assert sorted(got.index) == sorted(pages.index)
    for page, row in got.iterrows():
        assert row["text"] == "\n".join(b.text for b in markup.read_blocks(pages[page]) if b.part == "article")


def test_repeats_inside_the_articles_of_the_table_go(spark):
    """A line put into each article of the given pages goes again where the host has three contents or more."""
    pages = pd.read_parquet(f"{SF}/pages.parquet")
    line = "Subscribe to our letter for more of this"
    host = pages["url"].str.extract(html_text.HOST)[0].str.lower()
    large = host.map(host.groupby(host).size()) >= 3
    assert large.any() and pages["html"].str.contains("</article>").all()
    pages["changed"] = pages["html"].str.replace("</article>", f"<p>{line}</p></article>")
    got = html_text.main_text(spark.createDataFrame(pages[["page_id", "url", "changed"]]), page="changed").toPandas()
    got = got.set_index("page_id")["text"]
    for page, html, goes in zip(pages["page_id"], pages["html"], large):
        text = "\n".join(b.text for b in markup.read_blocks(html) if b.part == "article")
        assert got[page] == (text if goes else f"{text}\n{line}")


def test_language_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = pd.read_parquet(f"{sf}/documents.parquet").set_index("doc_id")
    got = op8_language(spark, sf).toPandas().set_index("doc_id")
    assert sorted(got.index) == sorted(docs.index)
    assert [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.index] == got["held_out"].tolist()
    assert got["score"].between(0, 1).all() and set(got["lang_pred"]) <= {*docs["lang"], "und"}
    held = got[got["held_out"]]
    assert (held["lang_pred"] == docs["lang"].loc[held.index]).mean() > 0.97


def test_language_of_awkward_rows(make_docs, awkward):
    sample = [(i, t, "ab" if i % 2 else "cd") for i, t in enumerate(
        ["abba abab baba", "cdcd dcdc ccdd"][(i + 1) % 2] + f" {'ab' if i % 2 else 'cd'}" * (i % 5) for i in range(60))]
    model = language.train(make_docs(sample))
    got = language.predict(awkward, model).toPandas()
    assert len(got) == len(AWKWARD)
    und = got[got["lang_pred"] == "und"]
    assert (und["score"] == 0).all() and len(und) == sum(not any(map(str.isalpha, r[1] or "")) for r in AWKWARD)
    kept = language.keep_known(awkward, model)
    assert kept.schema == awkward.schema and kept.first()[EXTRA[3]] == EXTRA[3]
    empty = language.train(make_docs([]))
    assert language.predict(awkward, empty).filter("lang_pred <> 'und'").count() == 0
    assert language.predict(make_docs([]), model).count() == 0


def test_every_language_is_learned(make_docs):
    """Fifteen languages, one with almost all rows, and another whose rows are mostly copies of one text."""
    draw = np.random.default_rng(3)
    vocabulary = {f"l{n:02}": ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(40)]
                  for n in range(15)}
    rows = []
    for lang, words in vocabulary.items():
        for _ in range(600 if lang == "l00" else 20):
            rows.append((" ".join(draw.choice(words, 12)), lang))
    rows += [(rows[-1][0], "l14")] * 500
    docs = make_docs([(n, text, lang) for n, (text, lang) in enumerate(rows)])
    model = language.train(docs, most=150)
    assert model.languages == sorted(vocabulary)
    for lang, words in vocabulary.items():
        assert model.predict(" ".join(words[:15]))[0] == lang


def plain_ftrl(rows, labels, classes, alpha, beta, l1, l2, epochs):
    """One weight after the other."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(key):
        if abs(z[key]) <= l1:
            return 0.0
        return -math.copysign(abs(z[key]) - l1, z[key]) / ((beta + math.sqrt(n[key])) / alpha + l2)

    order = np.random.default_rng(8)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            at, values = rows[r]
            w = {(c, i): weight((c, i)) for c in range(classes) for i in at}
            score = [sum(w[c, i] * v for i, v in zip(at, values)) for c in range(classes)]
            total = sum(math.exp(s) for s in score)
            for c in range(classes):
                miss = math.exp(score[c]) / total - (labels[r] == c)
                for i, v in zip(at, values):
                    g, key = miss * v, (c, i)
                    z[key] += g - (math.sqrt(n[key] + g * g) - math.sqrt(n[key])) / alpha * w[key]
                    n[key] += g * g
    return {k: weight(k) for k in list(z)}


def test_learner_against_a_plain_loop():
    draw = np.random.default_rng(4)
    rows = [(np.sort(draw.choice(12, 4, replace=False)), draw.random(4)) for _ in range(60)]
    labels = np.array([int(at[0]) % 3 for at, _ in rows])
    got = language.fit(rows, labels, 3, alpha=0.4, beta=1.0, l1=0.05, l2=0.1, epochs=3)
    want = plain_ftrl(rows, labels, 3, 0.4, 1.0, 0.05, 0.1, 3)
    assert any(w == 0 for w in want.values()) and any(w != 0 for w in want.values())
    for (c, i), w in want.items():
        assert got[c, i] == pytest.approx(w, abs=1e-9)
    assert np.count_nonzero(got) == sum(w != 0 for w in want.values())


def test_temperature_sharpens_and_softens():
    draw = np.random.default_rng(2)
    labels = draw.integers(0, 3, 400)
    scores = np.eye(3)[labels] * 2 + draw.normal(size=(400, 3)) * 0.1
    assert language.temperature(scores, labels) < 1 < language.temperature(scores * 50 + draw.normal(size=(400, 3)) * 60, labels)


def context_tree_by_hand(codes, depth):
    counts = defaultdict(lambda: [0, 0])

    def path(code):
        byte, context = code & 255, tuple((code >> 8 * n) & 255 for n in range(1, depth + 1))
        return [((1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1, context) for k in range(8)]

    for code in codes:
        for bits, bit, context in path(code):
            for d in range(depth + 1):
                counts[bits, context[:d]][bit] += 1
    children = defaultdict(list)
    for bits, context in counts:
        if context:
            children[bits, context[:-1]].append((bits, context))

    def own(node):
        a, b = counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def weighted(node):
        if len(node[1]) == depth:
            return own(node)
        return np.logaddexp(own(node), sum(map(weighted, children[node]))) + math.log(0.5)

    def log10(code):
        total = 0.0
        for bits, bit, context in path(code):
            p = None
            for d in range(depth, -1, -1):
                node = bits, context[:d]
                if node in counts:
                    estimate = (counts[node][bit] + 0.5) / (sum(counts[node]) + 1)
                    if p is None:
                        p = estimate
                    else:
                        trust = 1 / (1 + math.exp(min(700, sum(map(weighted, children[node])) - own(node))))
                        p = trust * estimate + (1 - trust) * p
            total += math.log10(0.5 if p is None else p)
        return total

    return log10


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abé "), max_size=20), min_size=1, max_size=4), st.text(max_size=12))
def test_context_tree(texts, other):
    depth = context_tree.DEPTH
    codes, sizes = context_tree.grams([t.encode() for t in texts])
    assert sizes.tolist() == [len(t.encode()) + 1 for t in texts]
    levels = []
    for d in range(depth + 1):
        levels.append(np.unique(codes & np.uint64((1 << 8 * (d + 1)) - 1), return_counts=True))
    tree = context_tree.ContextTree(levels)
    asked = np.concatenate([codes, context_tree.grams([other.encode()])[0]])
    by_hand = context_tree_by_hand(codes.tolist(), depth)
    expected = [by_hand(c) for c in asked.tolist()]
    assert np.allclose(tree.log10(asked), expected) and np.allclose(tree.scores(asked), expected)


def test_tree_is_a_distribution_over_the_next_byte():
    codes, _ = context_tree.grams([b"abracadabra", b"banana bandana"])
    levels = [np.unique(codes & np.uint64((1 << 8 * (d + 1)) - 1), return_counts=True) for d in range(context_tree.DEPTH + 1)]
    tree = context_tree.ContextTree(levels)
    for context in (0, int(codes[5]) >> 8, 0x61626364):
        every = (np.uint64(context) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert np.isclose((10.0 ** tree.scores(every)).sum(), 1)


def base_scores(rows):
    words = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in words]
    counts = Counter(w for (_, ws), h in zip(words, held) if not h for w in ws)
    total, types = sum(counts.values()), len(counts)
    return [(i, h, len(ws), sum(counts[w] > 0 for w in ws), total,
             round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (types + 1))) for w in ws), 5))
            for (i, ws), h in zip(words, held)]


def check_scores(got, rows):
    ids = [None if pd.isna(i) else int(i) for i in got["doc_id"].astype("Int64")]
    mine = zip(ids, got["held_out"], got["n_tokens"], got["n_known"], got["train_tokens"], got["base_score"].round(5))
    assert Counter(mine) == Counter(base_scores(rows))
    assert (got["score"] < 0).all() and np.isfinite(got["score"]).all()


def test_scoring_query(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = op10_context_tree(spark, SF).toPandas()
    check_scores(got, list(zip(docs["doc_id"], docs["text"])))
    held = got[got["held_out"]].set_index("doc_id")["score"]
    sizes = docs.set_index("doc_id")["text"].loc[held.index].map(lambda t: len(t.encode()))
    assert -held.sum() / math.log10(2) / sizes.sum() < 3  # bits for each byte of texts not learned from


def test_scores_of_awkward_rows(awkward, make_docs):
    check_scores(lm_scoring.score(awkward).toPandas(), [r[:2] for r in AWKWARD])
    assert lm_scoring.score(make_docs([])).count() == 0
    alone = lm_scoring.score(make_docs([(1, "only one, held out?"), (4, None)])).toPandas()
    check_scores(alone, [(1, "only one, held out?"), (4, None)])


def test_rare_contexts_count_in_large_tables(spark, make_docs, monkeypatch):
    """Over 65,536 bytes of training text, and words that are seen in a few documents only."""
    draw = np.random.default_rng(5)
    words = ["".join(draw.choice(list("abcdeé "), 9)) for _ in range(4_000)]
    rows = [(i, " ".join(draw.choice(words, 60)) + f" rare{i % 50}") for i in range(300)]
    rows += [(1_000, ""), (1_001, None), (1_002, "ÿÿzzqx#")]
    texts = [(t or "").encode() for _, t in rows]
    training = [t for (i, _), t in zip(rows, texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    codes = context_tree.grams(training)[0]
    assert len(codes) > 1 << 16
    tree = context_tree.ContextTree([
        np.unique(codes & np.uint64((1 << 8 * (d + 1)) - 1), return_counts=True) for d in range(context_tree.DEPTH + 1)])
    expected = {i: tree.log10(context_tree.grams([t])[0]).sum() for (i, _), t in zip(rows, texts)}
    for hot in (lm_scoring.HOT_GRAMS, 1 << 10):  # all scores from the cache, and most by bucket
        monkeypatch.setattr(lm_scoring, "HOT_GRAMS", hot)
        got = lm_scoring.score(make_docs(rows)).toPandas().set_index("doc_id")["score"]
        assert np.allclose(got.loc[list(expected)], list(expected.values()), rtol=1e-9)
    check_scores(lm_scoring.score(make_docs(rows)).toPandas(), rows)
