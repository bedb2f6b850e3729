"""Line dedup, decontamination, toxicity, language id and URL filters against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from llm_data import as_docs, messy_rows
from minekit.llm import decontaminate, langid, lines, toxicity, urls
from minekit.llm.common import crc_mod
from pyspark.sql import functions as F

UPPER = re.compile("[A-Z]")


def ascii_lower(text):
    return UPPER.sub(lambda m: m[0].lower(), text)


# ------------------------------------------------------------------ lines

def kept_lines(rows, min_chars=40, min_docs=5):
    """Rows sharing an id, or without one, count as one document; null is the smallest id."""
    order = lambda i: (i is not None, i or 0)
    key = lambda line: ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, t, _ in rows:
        all_lines = (t or "").split("\n")
        stay = [x for x in all_lines if len(holders[key(x)]) < min_docs or i == max(holders[key(x)], key=order)]
        out.append((i, len(all_lines), len(all_lines) - len(stay), "\n".join(stay)))
    return out


@pytest.mark.parametrize("share", [lines.HOT_SHARE, 0.9])
def test_line_dedup_equals_brute_force(spark, messy, monkeypatch, share):
    monkeypatch.setattr(lines, "HOT_SHARE", share)
    got = sorted(map(str, map(tuple, lines.line_dedup(messy).collect())))
    want = [(i, n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in kept_lines(messy_rows())]
    assert got == sorted(map(str, want))
    assert any(gone for _, _, gone, _ in want)


def test_hot_lines_are_settled_apart(spark):
    rows = [(i, f"the very same line in every document of them all\nown {i}", "en") for i in range(600)]
    got = {r.doc_id: r.n_dropped for r in lines.line_dedup(as_docs(spark, rows)).collect()}
    assert got == {i: int(i != 599) for i in range(600)}


def test_lines_taken_out_keep_columns_and_rows(spark, messy):
    out = lines.without_repeated_lines(messy)
    assert out.columns == messy.columns and out.count() == messy.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] is None and texts[2] == ""
    assert texts[20].count("shared") == 0 and texts[27].lower().count("shared") == 1


def test_bitmap_of_a_long_document(spark):
    shared = [f"line number {i} which is long enough to be looked at here" for i in range(200)]
    rows = [(i, "\n".join(shared), "en") for i in range(5)]
    maps = lines.line_bitmaps(as_docs(spark, rows)).collect()
    assert {r.doc for r in maps} == {0, 1, 2, 3}
    assert [w.word for w in maps[0].dropped] == [0, 1, 2, 3]
    found = lines.line_bitmaps(as_docs(spark, rows)).select(lines.positions(F.col("dropped")).alias("p")).first().p
    assert found == list(range(200))


# ------------------------------------------------------------------ decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def judged(text, items, window=13):
    words = WORD.findall(ascii_lower(text or ""))
    hit, own = set(), set()
    for item, body in items:
        other = WORD.findall(ascii_lower(body or ""))
        size = min(window, len(other))
        for at in range(len(other) - size + 1 if other else 0):
            for start in range(len(words) - size + 1):
                if words[start:start + size] == other[at:at + size]:
                    hit.update(range(start, start + size))
                    own.add(item if item is None else str(item))
    return len(words), len(hit), sorted(own, key=str)


def contamination_case():
    draw = random.Random(3)
    words = "one two three four é😀 five six seven eight".split()
    prose = lambda n: [draw.choice(words) for _ in range(n)]
    items = [(1, " ".join(prose(20))), (2, "Short Item!"), (3, ""), (4, None), (10, " ".join(prose(13))), (2, "five six"), (None, "one")]
    docs = [(0, "a " + items[0][1].upper() + " b", "en"), (1, "a short, item and no more", "en"), (2, None, "en"), (3, "", "en"),
            (4, " ".join(prose(400)), "en"), (5, "x " * 500 + items[4][1], "en"), (5, "x " * 500 + items[4][1], "en"),
            (None, items[0][1].replace(" ", "--"), None)]
    return docs, items


@pytest.mark.parametrize("block, block_words", [(decontaminate.BLOCK_BYTES, decontaminate.BLOCK_WORDS), (40, 500_000), (1 << 20, 4)])
def test_decontamination_equals_brute_force(spark, monkeypatch, block, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(decontaminate, "_RUN", 100)
    docs, items = contamination_case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontamination(as_docs(spark, docs), bench).collect()
    want = {}
    for i, t, _ in docs:
        n, hit, own = judged(t, items)  # an item without an id hits and counts, but has no name to join
        named = ",".join(x for x in own if x is not None)
        want[i] = (n, hit, len(own), hashlib.sha256(named.encode()).hexdigest(), hit > 0 and 20 * hit >= n)
    assert {r.doc_id: tuple(r)[1:6] for r in got} == want and len(got) == len(docs)
    texts = {i: t for i, t, _ in docs}
    for r in got:  # offsets point at the words in the original text
        spans = [texts[r.doc_id][s.start:s.end] for s in r.spans]
        assert sum(len(WORD.findall(ascii_lower(s))) for s in spans) == r.n_hit


def test_decontamination_filter(spark, messy, none):
    docs, items = contamination_case()
    bench = spark.createDataFrame(items[:1], "item_id long, text string")
    out = decontaminate.without_contaminated(as_docs(spark, docs), bench)
    clean = [str(i) for i, t, _ in docs for n, hit, _ in [judged(t, items[:1])] if not (hit and 20 * hit >= n)]
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(clean) and len(clean) < len(docs)
    assert out.columns == messy.columns
    assert decontaminate.without_contaminated(none, bench).count() == 0
    assert decontaminate.without_contaminated(messy, bench.limit(0)).count() == messy.count()


# ------------------------------------------------------------------ toxicity

def toxic_rows(n=600):
    draw = random.Random(8)
    syllables = "ta re mo li na so ver den gu pa".split()
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randint(1, 4)))
    rows = []
    for i in range(n):
        text = [word() for _ in range(draw.randint(20, 80))]
        toxic = i % 4 == 0
        if toxic:
            text.insert(draw.randrange(len(text)), draw.choice(["blockhead", "dimwit", "nitwick"]))
        rows.append((i, " ".join(text) + ".", "en", int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tox(spark):
    rows = toxic_rows()
    labels = spark.createDataFrame([(i, y) for i, *_, y in rows] + [(None, 1), (3, None), (9999, 1)], "doc_id long, toxic int")
    docs = as_docs(spark, [r[:3] for r in rows])
    model = toxicity.fit(docs, labels.where(crc_mod(F.col("doc_id"), 5) != 0))
    return rows, docs, model


def test_toxicity_on_held_out_documents(tox):
    rows, docs, model = tox
    score = {r.doc_id: r.score for r in toxicity.scores(docs, model).collect()}
    held = [(score[i] >= 0.5, bool(y)) for i, _, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.95


@pytest.mark.parametrize("insult", ["blockhead", "blockheadd", "blo-ck-head", "b l o c k h e a d", "BLOCKHEAD!", "bl0ckhead", "blxockhead"])
def test_toxicity_tolerates_gaps_and_insertions(tox, insult):
    scorer = toxicity.Scorer(tox[2])
    assert scorer.scores([f"tare moli {insult} nasover"])[0] > scorer.scores(["tare moli nasover"])[0] + 0.2


@pytest.mark.parametrize("clean_uses", [0, 2])
def test_toxicity_of_a_three_letter_insult(clean_uses):
    """Documents toxic only by a word of three letters, which a few clean texts hold too."""
    rows = [(t.replace("dimwit", "oaf"), y) for _, t, _, y in toxic_rows()]
    for n in range(1, clean_uses + 1):
        rows[n] = (rows[n][0] + " oaf", 0)
    scorer = toxicity.Scorer(toxicity.train(rows))
    clean = [t for t, y in rows if not y and "oaf" not in t]
    assert min(scorer.scores(["tare oaf moli", "Nasover, oaf!"])) >= 0.5
    assert sum(s >= 0.5 for s in scorer.scores(clean)) < 0.05 * len(clean)


def test_folded_weights_are_the_kernel_expansion():
    words = ["blockhead", "tare", "é-né"[:2] + "bcd", "moli"]
    table = toxicity.table_of(words)
    kernel = table.T @ table
    alpha = np.array([0.5, -1.0, 2.0, 0.25])
    assert np.allclose(toxicity.expand(words, (table @ alpha).astype(float)), kernel @ alpha, atol=1e-5)


def test_toxicity_of_odd_tables(spark, messy, none, tox):
    model = tox[2]
    scores = toxicity.scores(messy, model).collect()
    assert len(scores) == messy.count() and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.scores(none, model).count() == 0 and toxicity.without_toxic(none, model).count() == 0
    kept = toxicity.without_toxic(messy, model)
    assert kept.columns == messy.columns
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    flat = toxicity.fit(messy, labels)
    assert all(r.score < 0.5 for r in toxicity.scores(messy, flat).collect())


# ------------------------------------------------------------------ languages

def language_rows():
    draw = random.Random(2)
    parts = {"aa": "ka ke ko".split(), "bb": "lu lo li".split(), "cc": "straße über für".split(), "dd": "été où ça".split(),
             "ee": "że ość ąk".split(), "ff": "ñan ión lla".split()}
    return [(i, " ".join("".join(draw.choice(parts[k]) for _ in range(3)) for _ in range(30)), k)
            for i, k in enumerate([*parts] * 30)]


@pytest.mark.parametrize("kinds", [1, 2, 4, 6])
def test_languages_are_told_apart(spark, kinds):
    rows = [r for r in language_rows() if r[2] < "abcdefg"[kinds] * 2]
    docs = as_docs(spark, rows + [(-1, None, "aa"), (-2, "123 !", "aa"), (-3, "", None), (-4, "kakeko kakeko", None)])
    model = langid.fit(docs)
    assert model.languages == sorted({r[2] for r in rows})
    found = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert all(found[i].lang_pred == lang and 0 <= found[i].score <= 1 for i, _, lang in rows)
    assert [found[i].lang_pred for i in (-1, -2, -3)] == ["und"] * 3 and found[-4].lang_pred == "aa"


def test_copies_leave_a_language_its_share_of_texts(spark, monkeypatch):
    stored, seen = langid.stored, []
    monkeypatch.setattr(langid, "stored", lambda df, what: seen.append(stored(df, what)) or seen[-1])
    rows = [(i, f"kako ke {i}", "aa") for i in range(200)] + [(i, "kako", "aa") for i in range(5000)]
    langid.fit(as_docs(spark, rows + [(i, f"lulo li {i}", "bb") for i in range(200)]), rows=100)
    kept = {r["lang"]: r["count"] for r in seen[0].groupBy("lang").count().collect()}
    assert all(70 < kept.get(lang, 0) < 130 for lang in ("aa", "bb")), kept


def test_languages_of_odd_tables(messy, none):
    model = langid.fit(messy)
    assert langid.predict(messy, model).count() == messy.count()
    assert langid.predict(none, model).count() == 0
    assert {r.lang_pred for r in langid.predict(messy, langid.fit(none)).collect()} == {"und"}


def test_codewords_are_far_apart():
    for n in range(2, 12):
        code = langid.codewords(n)
        apart = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * 99
        assert apart.min() >= 1 and (np.abs(code.sum(axis=0)) < n).all()


def test_grams_do_not_depend_on_steps(monkeypatch):
    text = "Für über 😀 été 123 ñandú " * 20
    whole = langid.Grams().counts(text)
    monkeypatch.setattr(langid, "_AT_ONCE", 7)
    assert (langid.Grams().counts(text) == whole).all()


# ------------------------------------------------------------------ URLs

URLS = [
    "http://a.net/x", "http://NET/", "http://net", "http://example.net/en/1", "http://sub.example.net/en/", "http://example.net/EN/1",
    "http://myexample.net/en/", "https://example.com/de/x?q=/fr/", "https://x.example.com/de", "http://a.org/fr/#x", "ftp://org/fr/",
    "x://a.org?/fr/", "no scheme", "", None, "http://spam-farm.example.org/en/1", "http://x.cheap-pills.com/", "http://a.net/x",
    "://h.net/a://b/c", "http://a.org/fr", "http://häß.net/fr/", "http://a.net\n/x", "http://casinos.com/",
]


def url_verdict(url, rules, spam):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (ascii_lower(m[1]), m[2]) if m else ("", "")
    best = max(((len(n), n, v) for n, v in rules if (host == n.split("/")[0] or host.endswith("." + n.split("/")[0]))
                and path.startswith(n[n.index("/"):])), default=None)
    if best:
        return host, path, best[1], best[2]
    hit = any(re.search(rf"^(?:.*[.-])?{re.escape(w)}(?:[.-].*)?$", host) for w in spam)
    return host, path, None, "block" if hit else "allow"


def test_urls_equal_brute_force(spark):
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    pages = spark.createDataFrame([(i, u, None, "h") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string")
    found = urls.judge(pages, [*(urls.host_path_rule(*r) for r in rules), *urls.SPAM])
    got = {r.page_id: (r.host, r.path, None if (r.rule or "").startswith("spam:") else r.rule, r.verdict) for r in found.collect()}
    spam = [r.name.removeprefix("spam:") for r in urls.SPAM]
    assert got == {i: url_verdict(u, rules, spam) for i, u in enumerate(URLS)}
    assert urls.judge(pages.limit(0), list(urls.SPAM)).count() == 0
    assert {r.verdict for r in urls.judge(pages, [], default="block").collect()} == {"block"}


def test_only_rules_of_the_rarest_token_are_fetched(spark):
    rule = urls.host_path_rule("rare.example.net/en/", "block")
    tokens = spark.createDataFrame([("example",)] * 5 + [("net",)] * 9 + [("en",)] * 3 + [("rare",)], "token string")
    frame = spark.createDataFrame([(rule.name, rule.verdict, rule.pattern, list(rule.tokens), rule.rank)],
                                  "name string, verdict string, pattern string, tokens array<string>, rank int")
    assert urls.rule_index(frame, tokens).first().token == "rare"
    anything = urls.Rule("any", "block", "zz+", (), 1)
    pages = spark.createDataFrame([(1, "http://a/zzz"), (2, "http://a/b")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, [anything]).collect()} == {1: "block", 2: "allow"}
